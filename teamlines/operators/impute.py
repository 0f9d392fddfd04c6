"""Filling missing values."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from teamlines.functions.situation import or_unknown
from teamlines.session import materialized


def medians(df: DataFrame, columns, exact=True, accuracy=100_000) -> DataFrame:
    """One row with each column's median; null for a column without values.

    The exact median counts rows per value, so a value that many rows have is one row, and finds
    the middle by a search over cells: values are cut into ranges of about equal number of
    distinct values, the range that holds the middle is found from the ranges' counts, and
    only its values are put in order. No task holds all values. ``exact=False`` is one
    pass with an error of one part in ``accuracy``.
    """
    if not exact:
        return df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias(c) for c in columns])
    each = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns]))
    )
    counts = each.where("value IS NOT NULL").groupBy("name", "value").agg(F.count("*").alias("n"))
    # Sampled bounds may differ between two runs of a plan, so the ranges are written once.
    cells = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = materialized(counts.repartitionByRange(cells, "name", "value").withColumn("cell", F.spark_partition_id()))
    sizes = ranged.groupBy("name", "cell").agg(F.sum("n").alias("size"))
    over = Window.partitionBy("name")
    placed = sizes.select(
        "name",
        "cell",
        (F.sum("size").over(over.orderBy("cell")) - F.col("size")).alias("before"),
        F.col("size"),
        F.sum("size").over(over).alias("total"),
    )
    low, high = F.expr("(total - 1) div 2"), F.expr("total div 2")
    middle = placed.select("*", F.explode(F.array(low, high)).alias("at"))
    middle = middle.where((F.col("at") >= F.col("before")) & (F.col("at") < F.col("before") + F.col("size")))
    inside = ranged.join(middle.select("name", "cell", (F.col("at") - F.col("before")).alias("at")).distinct(), ["name", "cell"])
    within = Window.partitionBy("name", "cell", "at").orderBy("value")
    last = F.sum("n").over(within)
    hit = inside.select("name", "value", "at", (last - F.col("n")).alias("first"), last.alias("last"))
    hit = hit.where((F.col("at") >= F.col("first")) & (F.col("at") < F.col("last")))
    return hit.agg(*[F.avg(F.when(F.col("name") == c, F.col("value"))).alias(c) for c in columns])


def fill_medians(df: DataFrame, columns, fitted_on=None, exact=True, middle=None) -> DataFrame:
    """Missing values replaced by medians of ``fitted_on``, or of ``df`` itself; ``middle`` is such a row already found.

    The medians enter as a scalar subquery: no join, and no action before the plan runs.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    if middle is None:
        middle = medians(df if fitted_on is None else fitted_on, present, exact)
    packed = middle.select(F.struct(*present)).scalar()
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), packed.getField(c)) for c in present}
    )


def fill_unknown(df: DataFrame, columns=("roof", "surface")) -> DataFrame:
    """``UNK`` for missing categories."""
    return df.withColumns({c: or_unknown(c) for c in columns if c in df.columns})


def fill_constant(df: DataFrame, columns, value=0.0) -> DataFrame:
    """A constant for missing values."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in columns})

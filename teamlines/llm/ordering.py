"""Places of rows in an order, and joins with a table of keys, without a task or a key that grows with the data."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from teamlines.session import materialized, scratch_path

HOT_KEYS = 10_000


def in_order(df: DataFrame, *keys, name="position"):
    """``df`` written in the order of ``keys``, read back with each row's place in the whole, from 0.

    Tasks write ranges of the order; a row's place is that of its file's first row, from one sum over
    the files' row counts, and its place in the file. There are as many files as shuffle partitions.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ordered")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).write.parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    meta = read.metadataColumn("_metadata")
    numbers = F.regexp_extract_all(meta["file_name"], F.lit(r"^part-(\d+)-|-c(\d+)"), 0)
    digits = F.transform(numbers, lambda x: F.regexp_extract(x, r"(\d+)", 1).cast("long"))
    file = digits[0] * (1 << 20) + F.get(digits, F.lit(1))
    told = read.select("*", file.alias("_file"), meta["row_index"].alias("_at"))
    sizes = told.groupBy("_file").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_first"))
    placed = told.join(F.broadcast(first), "_file")  # a row a file
    return placed.select(*df.columns, (F.col("_first") + F.col("_at")).alias(name))


def hot_keys(counts: DataFrame, keys, count, hot=HOT_KEYS):
    """The ``keys`` of ``counts`` that have at least one in ``hot`` of all rows: at most ``hot``, written once as one file."""
    total = counts.agg(F.sum(count)).first()[0] or 0
    return materialized(counts.where(F.col(count) * hot >= F.lit(total)).select(*keys).repartition(1))


def join_hot(left: DataFrame, right: DataFrame, keys, frequent: DataFrame):
    """``left`` joined with ``right``, whose ``keys`` are unique; those in ``frequent`` (few) are broadcast, the rest shuffled.

    ``left`` and ``right`` are each read twice.
    """
    listed = F.broadcast(frequent)
    many = F.broadcast(right.join(listed, keys, "left_semi"))
    return left.join(many, keys).unionByName(left.join(listed, keys, "left_anti").join(right, keys))


def join_counted(left: DataFrame, right: DataFrame, keys, count, hot=HOT_KEYS):
    """``left`` joined with ``right``, whose ``keys`` are unique and whose ``count`` is how many rows of ``left`` have them.

    Keys with at least one in ``hot`` of all rows are at most ``hot``: they are broadcast. The rest are
    shuffled, where no key has more than that share. ``right`` is read several times.
    """
    return join_hot(left, right.drop(count), keys, hot_keys(right, keys, count, hot))

"""Removal of lines that many distinct sites share.

Each line is known by two 64-bit hashes. Per line, a HyperLogLog sketch of its sites is built
in every task and merged by aggregation. Lines whose estimate is far from the threshold are
decided by the sketch; the sites of lines near it are counted exactly. Lines with at least
``min_sites`` sites are boilerplate and leave every document that has them. How often each line
occurs is counted beside its sketch, and joins by line broadcast the lines of a large share.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teamlines.llm.common import numbered, rows_of
from teamlines.llm.ordering import join_counted
from teamlines.session import materialized

MIN_SITES = 10
SKETCH_BITS = 12  # relative standard error 1.04 / sqrt(4096), 1.6 %
NEAR = 0.25  # 15 standard errors on either side of the threshold
KEY = ["line_a", "line_b"]


def document_lines(docs: DataFrame, text="text", site="source"):
    """``row_id, site, at`` and the hashes of every line that isn't blank."""
    rows = rows_of(docs, text=text, site=site)
    split = rows.select("row_id", "site", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("at", "raw"))
    line = F.trim("raw")
    return split.where(line != "").select(
        "row_id", "site", "at", F.xxhash64(line).alias("line_a"), F.xxhash64(line, F.lit(1)).alias("line_b")
    )


def boilerplate_lines(lines: DataFrame, min_sites=MIN_SITES, bits=SKETCH_BITS, near=NEAR):
    """Hashes of the lines that at least ``min_sites`` distinct sites have, and how ``often`` each occurs; a null site counts for none."""
    sketched = lines.groupBy(*KEY).agg(F.hll_sketch_agg("site", F.lit(bits)).alias("sites"), F.count("*").alias("often"))
    spread = materialized(
        sketched.select(*KEY, "often", F.hll_sketch_estimate("sites").alias("estimate"))
        .where(F.col("estimate") >= min_sites * (1 - near))
    )
    sure = spread.where(F.col("estimate") > min_sites * (1 + near)).drop("estimate")
    unsure = spread.where(F.col("estimate") <= min_sites * (1 + near)).drop("estimate")
    pairs = join_counted(lines.where("site IS NOT NULL"), unsure, KEY, "often").select(*KEY, "site").distinct()
    exact = pairs.groupBy(*KEY).agg(F.count("*").alias("n")).where(F.col("n") >= min_sites).select(*KEY)
    return sure.unionByName(unsure.join(exact, KEY))


def remove_boilerplate(docs: DataFrame, text="text", site="source", doc_id="doc_id", **settings):
    """``row_id, doc_id, n_lines, n_removed, clean_text``, one row per row of ``docs``.

    Lines compare without the spaces around them; blank lines stay. A null text is empty and
    has one blank line. Lines that stay keep their order and their own spaces. Repeated rows
    each get a result; sites that tie count once. Very long texts are split whole. An empty table gives no
    rows. Only the named columns are read, under names of their own.
    """
    docs = numbered(docs)
    lines = document_lines(docs, text, site)
    shared = materialized(boilerplate_lines(lines, **settings))
    removed = join_counted(lines, shared, KEY, "often").groupBy("row_id").agg(F.collect_set("at").alias("removed"))
    rows = rows_of(docs, doc_id=doc_id, text=text).join(removed, "row_id", "left")
    parts = rows.withColumn("parts", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    n, gone = F.size("parts"), F.coalesce("removed", F.array().cast("array<int>"))
    cuts = parts.withColumn("cuts", F.array_append(F.array_sort(gone), n))

    def run_before(cut, i):  # the lines between one removed line and the next
        last = F.coalesce(F.get("cuts", i - 1), F.lit(-1))
        return F.slice("parts", last + 2, cut - last - 1)

    return cuts.select(
        "row_id",
        "doc_id",
        n.cast("long").alias("n_lines"),
        (F.size("cuts") - 1).cast("long").alias("n_removed"),
        F.array_join(F.flatten(F.transform("cuts", run_before)), "\n").alias("clean_text"),
    )

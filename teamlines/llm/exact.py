"""Exact deduplication with skew-safe combining.

Texts are equal when identical after each run of ASCII white space becomes one space.

1. *Locally*: every task merges the equal texts it reads (the map side of the first grouping;
   its salt is the task's number, so one text leaves a task as one row).
2. *Salted*: the rows of a digest meet in ``salts`` groups, so a text that a third of all
   rows hold is merged by many tasks.
3. *Globally*: the salt winners of a digest, at most ``salts`` rows for a text, are combined.

The grouping key is the digest **and the whole text** at each stage, so texts that share a
digest are never merged. Rows then find their group by digest alone; where a digest has
several texts, they find it by digest and text.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teamlines.llm.common import WHITE, ids_first, keep_rows, numbered, rows_of
from teamlines.session import materialized


def normalised(text):
    """White space runs as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def sha256(content):
    """Digest of a text."""
    return F.sha2(content, 256)


def duplicate_groups(docs: DataFrame, salts=16, digest=sha256, text="text", doc_id="doc_id"):
    """For each row of ``docs`` the group of equal texts it is in.

    Returns ``row_id, doc_id, keep_id, keep_row, group_size, kept, text_sha256``, one row per
    row of ``docs``. The row with the smallest id stays; rows without an id come last, and of
    rows that repeat an id exactly one stays. Very long texts are compared whole. An empty table gives
    an empty result. Only the named columns are read, under names of their own.
    """
    rows = rows_of(numbered(docs), doc_id=doc_id, text=text)
    keyed = rows.select("row_id", "doc_id", normalised(F.col("text")).alias("content"))
    keyed = keyed.withColumn("digest", digest(F.col("content")))
    salted = keyed.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    by_salt = salted.groupBy("digest", "salt", "content").agg(F.min(ids_first()).alias("first"), F.count("*").alias("n"))
    merged = by_salt.groupBy("digest", "content").agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    # One row per digest: its only text, or a mark that several texts share it.
    groups = materialized(
        merged.groupBy("digest").agg(
            F.count("*").alias("texts"), F.min("first").alias("first"), F.sum("n").alias("group_size")
        )
    )
    narrow = keyed.select("row_id", "doc_id", "digest", F.sha2("content", 256).alias("text_sha256"))
    found = narrow.join(groups.where("texts = 1"), "digest")
    shared = groups.where("texts > 1").select("digest")
    if not shared.isEmpty():
        apart = merged.join(shared, "digest", "left_semi").withColumnRenamed("n", "group_size")
        found = found.drop("texts").unionByName(
            keyed.join(apart, ["digest", "content"])
            .select("row_id", "doc_id", "digest", F.sha2("content", 256).alias("text_sha256"), "first", "group_size")
        )
    return found.select(
        "row_id",
        "doc_id",
        F.col("first.id").alias("keep_id"),
        F.col("first.row").alias("keep_row"),
        "group_size",
        (F.col("row_id") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame, **settings):
    """``docs`` without the rows whose text an earlier id has; all columns stay."""
    docs = numbered(docs)
    return keep_rows(docs, duplicate_groups(docs, **settings).where("kept"))

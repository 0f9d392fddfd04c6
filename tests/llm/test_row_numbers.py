"""Row numbers stay the same when the files are split otherwise between two readings."""

import pytest
from pyspark.sql import functions as F

from teamlines.llm import common, exact, lines, neardup, tokens, warc

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def resplit(spark):
    """Sets how the files are split; the setting before comes back at the end."""
    before = spark.conf.get(SPLIT)
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield lambda size: spark.conf.set(SPLIT, size)
    spark.conf.set(SPLIT, before)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


@pytest.fixture
def docs(written):
    rows = [(i, f"alpha beta {i // 2} gamma delta epsilon {i // 2}\nshared line", "web", f"s{i % 20}") for i in range(60)]
    return written(rows, "doc_id long, text string, lang string, source string", "split")


def numbers(df):
    return {r.doc_id: r.row_id for r in common.rows_of(df, doc_id="doc_id").collect()}


def test_numbers_do_not_follow_splits(docs, resplit):
    resplit("128m")
    whole = numbers(docs)
    resplit("200b")
    assert numbers(docs) == whole and len(set(whole.values())) == 60
    tagged, name = common.with_row_id(docs)
    assert {r.doc_id: r[name] for r in tagged.collect()} == whole


def test_operators_read_alike(spark, docs, resplit):
    calls = {
        "exact": (lambda: exact.duplicate_groups(docs), lambda out: out.where("kept").count() == 30),
        "lines": (lambda: lines.remove_boilerplate(docs), lambda out: out.where("n_removed = 1").count() == 60),
        "tokens": (lambda: tokens.token_counts(docs), lambda out: out.select("doc_id").distinct().count() == 60),
        "near": (lambda: neardup.drop_near_duplicates(docs, width=4), lambda out: out.where("doc_id % 2 = 0").count() == 30),
    }
    for name, (plan, right) in calls.items():
        resplit("128m")
        out = plan()
        resplit("200b")  # what isn't written yet is read with other splits
        assert right(out), name


def test_shuffled_frame_is_written_once(docs, spark):
    shuffled = docs.repartition(7).withColumn("salt", F.rand())
    kept = common.numbered(shuffled)
    assert kept.columns == shuffled.columns and numbers(kept) == numbers(kept)
    assert common.numbered(docs) is docs
    assert exact.drop_duplicates(shuffled).count() == 30
    assert warc.write_packages(shuffled.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))).count() > 0


@pytest.mark.parametrize("most", [common.MOST_BUCKETS, 0])
def test_picked_and_flagged_rows(spark, written, most):
    """By broadcast bitmaps and by a shuffle alike; numbers over several runs, clashing names and repeated rows."""
    n = 3 * (1 << common.BUCKET_BITS) // 2
    schema = "doc_id long, bits binary, bucket long, row_id int"
    docs = spark.range(0, n, 1, 1).selectExpr("id % 1000 AS doc_id", "binary('x') AS bits", "id AS bucket", "1 AS row_id")
    docs = common.numbered(docs)
    ids = common.rows_of(docs, bucket="bucket")
    chosen = ids.where("bucket % 7 = 0 OR bucket IN (32767, 32768, 32769)")
    want = {i for i in range(n) if i % 7 == 0 or i in (32767, 32768, 32769)}
    kept, left = common.keep_rows(docs, chosen, most), common.drop_rows(docs, chosen, most)
    assert kept.columns == left.columns == docs.columns
    assert {r.bucket for r in kept.select("bucket").collect()} == want
    assert {r.bucket for r in left.select("bucket").collect()} == set(range(n)) - want
    told = common.with_flags(ids, chosen, most, odd=F.col("bucket") % 2 == 1, low=F.col("bucket") < 100)
    assert {r.bucket for r in told.where("odd").collect()} == {i for i in want if i % 2}
    assert {r.bucket for r in told.where("low").collect()} == {i for i in want if i < 100}
    assert told.count() == n and told.where("odd IS NULL OR low IS NULL").count() == 0
    none = written([], schema, "none")
    assert common.keep_rows(docs, ids.limit(0), most).count() == 0 and common.drop_rows(docs, ids.limit(0), most).count() == n
    assert common.keep_rows(none, chosen, most).count() == 0

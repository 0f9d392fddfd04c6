"""Helpers the corpus operators share."""

import os
import re
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teamlines.session import materialized

ROOT = str(Path(__file__).resolve().parents[2])
ROW_BITS = 40  # of a row number, for the place in a file
MOST_FILES = 100_000  # whose list is broadcast; more are joined by a shuffle
BUCKET_BITS = 15  # row numbers of one bitmap, which takes 4 KB
MOST_BUCKETS = 8_192  # bitmaps that are broadcast, 32 MB; more rows are joined by a shuffle
SLASHES = "^([A-Za-z0-9+.-]+):/+"
WHITE = r"[\x20\x09-\x0D]+"


def read_table(spark, sf_dir, name):
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(columns, wanted):
    """``wanted``, with underscores in front until no column has that name."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def _in_files(df: DataFrame):
    """Whether each row of ``df`` is one row of a Parquet file, picked the same way at each reading."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        if not plan.deterministic():
            return False
        plan = plan.children().head()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return False
    relation = plan.relation()
    return relation.getClass().getSimpleName() == "HadoopFsRelation" and relation.fileFormat().toString() == "Parquet"


def numbered(df: DataFrame):
    """``df`` where every reading gives a row the same number: itself if it is a Parquet table, else written once.

    Operators that read their input more than once begin with it.
    """
    return df if _in_files(df) else materialized(df)


def _with_number(df: DataFrame, columns, name):
    """``columns`` of ``df`` and the number of each row: its file's place among the sorted files, and its place in the file.

    Neither depends on how the files are split, so executors may come and go between readings.
    """
    if not _in_files(df):  # read once only, or it would be numbered()
        return df.select(*columns, F.monotonically_increasing_id().alias(name))
    # A list of files writes file:///a, a row's metadata file:/a; all else is alike.
    files = [(re.sub(SLASHES, r"\1:/", path), i << ROW_BITS) for i, path in enumerate(sorted(df.inputFiles()))]
    path, first, at = (fresh_name([*df.columns, name], f"{name}_{x}") for x in ("path", "first", "at"))
    meta = df.metadataColumn("_metadata")
    found = df.select(*columns, F.regexp_replace(meta["file_path"], SLASHES, "$1:/").alias(path), meta["row_index"].alias(at))
    listed = df.sparkSession.createDataFrame(files, f"`{path}` string, `{first}` long")
    unknown = F.raise_error(F.lit("a row of a file that wasn't listed")).cast("long")
    found = found.join(F.broadcast(listed) if len(files) <= MOST_FILES else listed, path, "left")
    return found.withColumn(name, F.coalesce(F.col(first), unknown) + F.col(at)).drop(path, first, at)


def with_row_id(df: DataFrame, name="row_id"):
    """``df`` and a number for each row, and that column's name.

    Rows that repeat in every column still get numbers of their own. Each reading of a Parquet
    table gives the same numbers; other frames must have gone through ``numbered``.
    """
    name = fresh_name(df.columns, name)
    return _with_number(df, [df[c] for c in df.columns], name), name


def _importable(spark):
    """Lets Python workers import this package from where the driver did (a cluster has it installed there or gets it by --py-files)."""
    workers = spark.sparkContext.environment
    paths = workers.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        workers["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def rows_of(df: DataFrame, **columns):
    """Only the named columns under fixed names, with ``row_id``: extra or clashing columns never matter."""
    _importable(df.sparkSession)
    picked = [(df[c] if isinstance(c, str) else c).alias(k) for k, c in columns.items()]
    return _with_number(df, picked, "row_id")


def _bit(bits, number):
    """Whether the bitmap column ``bits`` (none: no) holds the place of the row number ``number`` in its run."""
    low = (1 << BUCKET_BITS) - 1
    byte = f"conv(hex(substring(`{bits}`, int(shiftright(`{number}` & {low}, 3)) + 1, 1)), 16, 10)"
    return F.coalesce(F.expr(f"shiftright(int({byte}), int(`{number}` & 7)) & 1"), F.lit(0)) == 1


def _bitmaps(rows: DataFrame, bucket, **flags):
    """``bucket`` and a bitmap for each flag of the ``row_id`` where it holds, written once. Native functions only."""
    place = F.col("row_id").bitwiseAND((1 << BUCKET_BITS) - 1)
    made = [F.bitmap_construct_agg(F.when(flag, place)).alias(name) for name, flag in flags.items()]
    return materialized(rows.groupBy(F.shiftright("row_id", BUCKET_BITS).alias(bucket)).agg(*made))


def with_flags(rows: DataFrame, found: DataFrame, most=MOST_BUCKETS, **flags):
    """``rows`` with a boolean column per flag: whether ``found`` has its ``row_id`` and the flag's condition on ``found`` holds.

    ``found`` has each ``row_id`` once. As long as the bitmaps of its numbers are few they are broadcast and ``rows``
    stay where they are; else the two meet by a shuffle.
    """
    named = {f"{name}_bits": flag for name, flag in flags.items()}
    bucket = fresh_name([*rows.columns, *named], "bucket")
    maps = _bitmaps(found, bucket, **named)
    if maps.count() * len(flags) > most:
        met = rows.join(found.select("row_id", *[flag.alias(name) for name, flag in flags.items()]), "row_id", "left")
        return met.fillna(False, list(flags))
    met = rows.withColumn(bucket, F.shiftright("row_id", BUCKET_BITS)).join(F.broadcast(maps), bucket, "left")
    return met.withColumns({name: _bit(f"{name}_bits", "row_id") for name in flags}).drop(bucket, *named)


def _picked(df: DataFrame, rows: DataFrame, keep, most):
    """The rows of ``df`` whose number is, or isn't, in ``rows.row_id``.

    The numbers become bitmaps, one for each run of numbers. As long as these are few, they are broadcast and
    the rows of ``df`` stay where they are; else rows and numbers meet by a shuffle.
    """
    tagged, name = with_row_id(df)
    back = [tagged[c] for c in df.columns]
    bucket, bits = (fresh_name([*df.columns, name], x) for x in ("bucket", "bits"))
    maps = _bitmaps(rows, bucket, **{bits: F.lit(True)})
    if maps.count() > most:
        numbers = rows.select(F.col("row_id").alias(name))
        return tagged.join(numbers, name, "left_semi" if keep else "left_anti").select(*back)
    met = tagged.join(F.broadcast(maps), F.shiftright(name, BUCKET_BITS) == maps[bucket], "left")
    return met.where(_bit(bits, name) if keep else ~_bit(bits, name)).select(*back)


def keep_rows(df: DataFrame, wanted: DataFrame, most=MOST_BUCKETS):
    """The rows of ``df`` whose number is in ``wanted.row_id``, with the columns of ``df`` only."""
    return _picked(df, wanted, True, most)


def drop_rows(df: DataFrame, unwanted: DataFrame, most=MOST_BUCKETS):
    """The rows of ``df`` whose number isn't in ``unwanted.row_id``, with the columns of ``df`` only."""
    return _picked(df, unwanted, False, most)


def ids_first(doc_id="doc_id", row_id="row_id"):
    """Sort key by id, rows without an id last, equal ids by row."""
    return F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), F.col(row_id).alias("row"))

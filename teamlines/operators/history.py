"""Per-key history windows that stay parallel when one key holds much of the data.

A window over ``partitionBy(team)`` puts a whole team into one task. That is the cheapest
plan while no team is large, and it is the plan used then. A team with more rows than
``hot_rows`` is range-partitioned on its own time order instead, so that it is cut into
contiguous chunks, and each chunk gets copies of the few rows that precede it. As every
frame looks back over a fixed number of rows, the values are the same either way.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from teamlines.schema import ORDER
from teamlines.session import checkpointed

CHUNK, HALO, HOT, AT = "_chunk", "_halo", "_hot", "_at"

HOT_ROWS = 500_000
PLACES = 1 << 33


@dataclass(frozen=True)
class HotTeams:
    """Teams with more than ``limit`` rows: their names as column ``_hot`` (None if there are none) and their rows."""

    teams: DataFrame | None
    rows: int
    limit: int


def hot_rows_limit(df: DataFrame, given=None) -> int:
    """Rows above which a key is split: the argument, the session's setting or the default."""
    if given is not None:
        return given
    return int(df.sparkSession.conf.get("spark.teamlines.hotRows", str(HOT_ROWS)))


def find_hot(df: DataFrame, hot_rows=None, key="team") -> HotTeams:
    """The hot teams of ``df``, by one pre-aggregated count over the key alone.

    A pipeline calls this once, on its schedule rows, and hands the result to its stages in
    place of ``hot_rows``. Which keys are split never changes a value, only the balance, so
    teams found on the schedule also serve windows by opponent or by team and season.
    """
    if isinstance(hot_rows, HotTeams):
        return hot_rows
    limit = hot_rows_limit(df, hot_rows)
    counted = df.groupBy(F.col(key).alias(HOT)).agg(F.count("*").alias("_n")).where(F.col("_n") > limit)
    n_keys, n_rows = counted.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()
    return HotTeams(checkpointed(counted.select(HOT)) if n_keys else None, n_rows, limit)


def _is_hot(key):
    return F.col(key).eqNullSafe(F.col(HOT))


def _cut(df, keys, order, hot):
    """Hot rows in contiguous pieces of their order, the piece's number in ``_chunk`` and the row's place in ``_at``.

    A piece has at most ``hot.limit`` rows, and a range partition holds many small pieces, so that a
    low limit makes no more tasks. Written out once: sampled range bounds may differ between two
    runs of a plan, and the chunk numbers must not.
    """
    n_chunks = max(2, -(-hot.rows // hot.limit))
    n_ranges = max(2, -(-hot.rows // HOT_ROWS), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by = [F.col(c) for c in (*keys, *order)]
    ranged = df.join(hot.teams, _is_hot(keys[0]), "left_semi").repartitionByRange(min(n_chunks, n_ranges), *by)
    placed = ranged.sortWithinPartitions(*by).withColumn(AT, F.monotonically_increasing_id())
    within = F.col(AT).bitwiseAND(PLACES - 1)  # the id has the partition above its lower 33 bits
    return checkpointed(placed.withColumn(CHUNK, F.col(AT) - within + F.floor(within / max(1, hot.limit))))


def _chunk_starts(cut, keys):
    """Rows per (key, chunk) and the position of each chunk's first row within its key."""
    sizes = cut.groupBy(*keys, CHUNK).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy(CHUNK)
    return sizes.withColumn("_start", F.sum("_n").over(before) - F.col("_n"))


def _null_safe(left, right, names):
    condition = F.lit(True)
    for n in names:
        condition = condition & left[n].eqNullSafe(right[n])
    return condition


def _halo_rows(cut, keys, span):
    """Copies of the ``span`` rows before each chunk, carrying that chunk's number."""
    starts = _chunk_starts(cut, keys)
    latest = Window.partitionBy(*keys, CHUNK).orderBy(F.desc(AT))
    tails = cut.withColumn("_back", F.row_number().over(latest)).where(F.col("_back") <= span)
    tails = tails.alias("t").join(
        starts.alias("s"),
        _null_safe(tails, starts, [*keys, CHUNK]),
    ).select("t.*", (F.col("s._start") + F.col("s._n") - F.col("t._back")).alias("_pos"))
    wanted = starts.select(
        *[F.col(k).alias(f"_w_{k}") for k in keys],
        F.col(CHUNK).alias("_w_chunk"),
        F.explode(F.sequence(F.col("_start") - span, F.col("_start") - 1)).alias("_w_pos"),
    ).where(F.col("_w_pos") >= 0)
    condition = F.col("_pos") == F.col("_w_pos")
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_w_{k}"))
    return tails.join(wanted, condition).select(
        *[F.col("_w_chunk").alias(CHUNK) if c == CHUNK else F.col(c) for c in cut.columns]
    )


def over_history(df: DataFrame, build, key="team", order=ORDER, span=16, hot_rows=None):
    """``build(df, window)`` with one window per ``key`` in ``order``.

    ``build`` adds columns whose values depend on at most ``span`` rows back. ``hot_rows`` is
    a limit or what :func:`find_hot` found.
    """
    hot = find_hot(df, hot_rows, key)
    if hot.teams is None:
        return build(df, Window.partitionBy(key).orderBy(*order))
    cut = _cut(df, [key], order, hot)
    halo = _halo_rows(cut, [key], span)
    rest = df.join(hot.teams, _is_hot(key), "left_anti").withColumns({AT: F.lit(0).cast("long"), CHUNK: F.lit(-1).cast("long")})
    rows = (
        rest.withColumn(HALO, F.lit(False))
        .unionByName(cut.withColumn(HALO, F.lit(False)))
        .unionByName(halo.withColumn(HALO, F.lit(True)))
    )
    window = Window.partitionBy(key, CHUNK).orderBy(*order, AT)  # rows that tie keep their places across pieces
    return build(rows, window).where(~F.col(HALO)).drop(CHUNK, HALO, AT)


def running_position(df: DataFrame, name: str, keys, order=ORDER, hot_rows=None):
    """0-based position of each row within its ``keys`` group; hot teams, the first key, are counted by chunk."""
    hot = find_hot(df, hot_rows, keys[0])
    if hot.teams is None:
        at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
        return df.withColumn(name, at)
    cut = _cut(df, keys, order, hot)
    starts = _chunk_starts(cut, keys)
    placed = (
        cut.alias("c")
        .join(starts.alias("s"), _null_safe(cut, starts, [*keys, CHUNK]))
        .select("c.*", F.col("s._start"))
    )
    rest = (
        df.join(hot.teams, _is_hot(keys[0]), "left_anti")
        .withColumns({AT: F.lit(0).cast("long"), CHUNK: F.lit(-1).cast("long"), "_start": F.lit(0).cast("long")})
    )
    at = F.row_number().over(Window.partitionBy(*keys, CHUNK).orderBy(*order, AT)) - 1
    rows = rest.unionByName(placed)
    return rows.withColumn(name, (F.col("_start") + at).cast("int")).drop(CHUNK, "_start", AT)

"""Chronological and stratified splits that never sort or move the whole frame.

A cut at position p of an ordered frame needs one row, the p-th. Rows are counted per cell
of the order (a date, or a hash range), the cell that holds the position is found from the
running counts, and only that cell's rows are ranked. The cut row then comes back as a
scalar and each row compares its own order key with it.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from teamlines.session import materialized

# The multiplicative hash behind the seeded shuffle.
HASH_FACTOR, HASH_MODULUS = 2654435761, 1000003
HASH_CELL = 1000  # outer cells hold a thousand hash values; each value is an inner cell


def holdout_split(df: DataFrame, test_season: int):
    """Train on earlier seasons, test on one season."""
    return df.where(F.col("season") < test_season), df.where(F.col("season") == test_season)


def expanding_seasons(df: DataFrame, warm_up=5):
    """``(season, train, test)`` for every season after the first ``warm_up``: all earlier seasons train."""
    for season in [row.season for row in seasons(df).collect()][warm_up:]:
        yield season, *holdout_split(df, season)


def expanding_sizes(df: DataFrame, warm_up=5) -> DataFrame:
    """``test_season, part, n_rows`` of the same splits, from one count per season and its running sum."""
    counts = df.groupBy("season").agg(F.count("*").alias("n"))
    order = Window.orderBy("season")  # one row a season
    sums = counts.select("season", "n", F.row_number().over(order).alias("place"), (F.sum("n").over(order) - F.col("n")).alias("earlier"))
    parts = F.array(F.struct(F.lit("train").alias("part"), F.col("earlier").alias("n_rows")), F.struct(F.lit("test").alias("part"), F.col("n").alias("n_rows")))
    return sums.where(F.col("place") > warm_up).select(F.col("season").alias("test_season"), F.inline(parts))


def season_list_split(df: DataFrame, test_seasons):
    """Test on the listed seasons, train on all others, later ones included."""
    listed = F.col("season").isin(*test_seasons)
    return df.where(~listed), df.where(listed)


def year_subset(df: DataFrame, years) -> DataFrame:
    return df.where(F.col("season").isin(*years))


def with_target(df: DataFrame, target: str) -> DataFrame:
    """Rows whose target is known."""
    return df.na.drop(subset=[target])


def seasons(df: DataFrame) -> DataFrame:
    """The distinct seasons in order."""
    return df.select("season").distinct().orderBy("season")


def chronological_key(df: DataFrame) -> Column:
    """The order of all rows in time: date, a digest of the game, game, home row first.

    Any order of one day's games is as good as another. The digest spreads a day over 256
    cells, so that a day with very many rows is still ranked in pieces.
    """
    return F.struct(
        F.col("date").alias("date"),
        F.substring(F.md5(F.col("game_id").cast("string")), 1, 2).alias("cell"),
        F.col("game_id").alias("game_id"),
        (-F.col("is_home")).alias("side"),
    )


def _same(left, right):
    """Null-safe equality of the columns two frames share by position."""
    condition = F.lit(True)
    for a, b in zip(left, right):
        condition = condition & a.eqNullSafe(b)
    return condition


def _hits(counted: DataFrame, group, cells, wanted: DataFrame) -> DataFrame:
    """Of ``wanted`` (``group, cut, at``, and the cells found so far) the next cell and the place inside it.

    ``counted`` has rows per ``group`` and ``cells``; the last cell is the one to find. Running
    counts are kept per group and outer cell, so no window holds more than one level's cells.
    """
    *outer, inner = cells
    over = Window.partitionBy(*group, *outer).orderBy(F.col(inner).asc_nulls_first())
    placed = counted.withColumn("_before", F.sum("_n").over(over) - F.col("_n"))
    keys = [*group, *outer]
    named = wanted.select(*[F.col(k).alias(f"_w{k}") for k in keys], "cut", "at")
    met = placed.join(named, _same([F.col(k) for k in keys], [F.col(f"_w{k}") for k in keys]))
    inside = (F.col("at") >= F.col("_before")) & (F.col("at") < F.col("_before") + F.col("_n"))
    return met.where(inside).select(*group, *cells, "cut", (F.col("at") - F.col("_before")).alias("at"))


def _cut_keys(keyed: DataFrame, group, positions: dict):
    """The order keys at some positions, as one row, or one row per ``group``.

    ``keyed`` has the group columns and ``_key``, whose first two fields are an outer and an
    inner cell of the order. ``positions`` maps a name to a function of the row count giving
    a 0-based position. The narrow key rows are written once; rows per cell are counted once
    from them, and only the rows of the cells that hold a cut are ranked.
    """
    first, second = keyed.schema["_key"].dataType.names[:2]
    cells = ["_outer", "_inner"]
    rows = materialized(
        keyed.select(*group, "_key", F.col(f"_key.{first}").alias("_outer"), F.col(f"_key.{second}").alias("_inner"))
    )
    counts = materialized(rows.groupBy(*group, *cells).agg(F.count("*").alias("_n")))
    outer = counts.groupBy(*group, "_outer").agg(F.sum("_n").alias("_n"))
    wanted = F.array(
        *[F.struct(F.lit(name).alias("cut"), at(F.col("_total")).alias("at")) for name, at in positions.items()]
    )
    totals = outer.groupBy(*group).agg(F.sum("_n").alias("_total"))
    found = _hits(outer, group, ["_outer"], totals.select(*group, F.inline(wanted)))
    found = _hits(counts, group, cells, found)
    keys = [*group, *cells]
    named = found.select(*[F.col(k).alias(f"_w{k}") for k in keys], "cut", "at")
    ranked = rows.join(named, _same([F.col(k) for k in keys], [F.col(f"_w{k}") for k in keys]))
    inside = Window.partitionBy(*group, "cut").orderBy("_key")
    hit = ranked.withColumn("_at", F.row_number().over(inside) - 1).where(F.col("_at") == F.col("at"))
    return hit.groupBy(*group).agg(
        *[F.max(F.when(F.col("cut") == name, F.col("_key"))).alias(name) for name in positions]
    )


def _blocks(df: DataFrame, key: Column, name: str, positions: dict) -> DataFrame:
    """``name``: how many of the cut positions lie at or before the row."""
    cuts = materialized(_cut_keys(df.select(key.alias("_key")), [], positions)).select(F.struct(*positions)).scalar()
    block = F.lit(0)
    for cut in positions:
        block = block + F.when(key >= cuts.getField(cut), 1).otherwise(0)
    return df.withColumn(name, block)


def time_folds(df: DataFrame, k=4, name="fold") -> DataFrame:
    """Expanding-window folds: 0 for the rows only trained on, then 1 to k in time order.

    Each validation fold has floor(N / (k + 1)) rows and is preceded by its training rows.
    """
    def start(fold):
        return lambda n: n - (k + 1 - fold) * F.floor(n / (k + 1))

    return _blocks(df, chronological_key(df), name, {f"c{i}": start(i) for i in range(1, k + 1)})


def fold_rows(df: DataFrame, fold: int, name="fold"):
    """Training and validation rows of one fold."""
    return df.where(F.col(name) < fold), df.where(F.col(name) == fold)


def contiguous_folds(df: DataFrame, k=3, name="block") -> DataFrame:
    """k equal blocks in time order, numbered from 0; the first blocks take the remainder."""
    def start(block):
        return lambda n: block * F.floor(n / k) + F.least(F.lit(block), n % k)

    return _blocks(df, chronological_key(df), name, {f"c{i}": start(i) for i in range(1, k)})


def seeded_hash(column="game_id", seed=42) -> Column:
    """A repeatable shuffle key of a whole-number column."""
    reduced = F.pmod(F.col(column) + F.lit(seed), F.lit(HASH_MODULUS))
    return reduced * F.lit(HASH_FACTOR) % F.lit(HASH_MODULUS)


def text_hash(column="game_id", seed=42) -> Column:
    """A repeatable shuffle key of any other column, from its digest."""
    digest = F.md5(F.concat(F.col(column).cast("string"), F.lit(f"/{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % HASH_MODULUS


def stratified_split(df: DataFrame, target: str, train_share=0.8, seed=42, name="is_train") -> DataFrame:
    """A seeded split that keeps each class's share: the first 80 % of a class by hash train."""
    numeric = df.schema["game_id"].dataType.typeName() in ("long", "integer", "short", "byte")
    hashed = seeded_hash(seed=seed) if numeric else text_hash(seed=seed)
    key = F.struct(
        F.floor(hashed / HASH_CELL).alias("cell"),
        hashed.alias("hash"),
        F.col("game_id").alias("game_id"),
    )
    keyed = df.select(F.col(target).alias("_class"), key.alias("_key"))
    cuts = materialized(_cut_keys(keyed, ["_class"], {"first_test": lambda n: F.floor(n * train_share)}))
    # one row per class; a class is a key like any other, and a hot one is split by the skew handling
    return df.join(cuts, df[target].eqNullSafe(cuts["_class"]), "left").select(
        *[df[c] for c in df.columns], F.coalesce(key < F.col("first_test"), F.lit(True)).alias(name)
    )

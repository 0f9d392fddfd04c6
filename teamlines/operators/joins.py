"""Bringing the two sides of a game together."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from teamlines.operators.history import hot_rows_limit
from teamlines.session import materialized

MOST_PAIRS = 100_000


def _facing(df: DataFrame, columns) -> DataFrame:
    """``columns`` packed as ``_own``, and the other row's as ``_other``, beside the rest.

    A game has two rows, so the neighbour within ``game_id`` is the other side: one shuffle
    on the game key and no self-join. Packing keeps each value in the shuffle once.
    """
    window = Window.partitionBy("game_id").orderBy("is_home")
    rest = [c for c in df.columns if c not in columns or c in ("game_id", "is_home")]
    packed = df.select(*rest, F.struct(*columns).alias("_own"))
    other = F.coalesce(F.lead("_own").over(window), F.lag("_own").over(window))
    return packed.withColumn("_other", other)


def hot_pairs(left: DataFrame, keys, limit) -> DataFrame | None:
    """``keys, salts`` of the key values with more than ``limit`` rows of ``left``; None if there are none.

    One count with partial sums. The limit is raised so that at most ``MOST_PAIRS`` values can pass it.
    """
    counts = materialized(left.where(F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull()).groupBy(*keys).agg(F.count("*").alias("_n")))
    total, largest = counts.agg(F.sum("_n"), F.max("_n")).first()
    limit = max(limit, (total or 0) // MOST_PAIRS, 1)
    if (largest or 0) <= limit:
        return None
    return counts.where(F.col("_n") > limit).select(*keys, F.ceil(F.col("_n") / limit).cast("int").alias("salts"))


def salted_join(left: DataFrame, right: DataFrame, keys, row_key, hot_rows=None) -> DataFrame:
    """``left`` left-joined with ``right`` on ``keys``, also if few key values hold a great part of the rows.

    Rows of a hot key value are dealt over as many salts as it has times the limit, by a hash of
    ``row_key``, and the right rows of that value are copied to each of them. So no task has more than
    about ``hot_rows`` left rows of one value. Other rows have salt 0.
    """
    hot = hot_pairs(left, keys, hot_rows_limit(left, hot_rows))
    if hot is None:
        return left.join(right, keys, "left")
    listed = F.broadcast(hot)  # at most MOST_PAIRS rows
    salt = F.coalesce(F.pmod(F.xxhash64(*row_key), F.col("salts")).cast("int"), F.lit(0))
    dealt = left.join(listed, keys, "left").withColumn("_salt", salt).drop("salts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    copied = right.join(listed, keys, "left").withColumn("_salt", copies).drop("salts")
    return dealt.join(copied, [*keys, "_salt"], "left").drop("_salt")


def opponent_columns(df: DataFrame, columns, key="game", prefix="opp_", hot_rows=None) -> DataFrame:
    """The opponent's ``columns`` beside the row's own, named with ``prefix``.

    ``game`` takes the other row of the game. ``date`` joins the opponent's rows of that
    date, more than one if it played twice; dates on which one opponent has more rows than the limit of
    hot teams are salted. ``self`` joins the row with itself.
    """
    if key == "self":
        return df.select("*", *[F.col(c).alias(prefix + c) for c in columns])
    if key == "game":
        packed = ["team", *columns]
        facing = _facing(df, packed)
        # a row whose partner is another team than its opponent gets nothing
        matched = F.col("_other.team") == F.col("opp")
        return facing.select(
            *[F.col(f"_own.{c}") if c in packed else F.col(c) for c in df.columns],
            *[F.when(matched, F.col(f"_other.{c}")).alias(prefix + c) for c in columns],
        )
    if key != "date":
        raise ValueError(f"unknown opponent key {key!r}")
    theirs = df.select(
        F.col("team").alias("opp"), "date", *[F.col(c).alias(prefix + c) for c in columns]
    )
    return salted_join(df, theirs, ["opp", "date"], ["game_id", "is_home"], hot_rows).select(
        *df.columns, *[prefix + c for c in columns]
    )


def pair_sides(df: DataFrame, how="inner", columns=None) -> DataFrame:
    """One row per game from the home row, columns suffixed ``_home`` and ``_away``.

    ``inner`` keeps games with both rows, ``left`` every home row.
    """
    columns = [c for c in (columns or df.columns) if c != "game_id"]
    packed = list(dict.fromkeys(["is_home", *columns]))
    wide = _facing(df.select("game_id", *packed), packed).where(F.col("is_home") == 1)
    if how == "inner":
        wide = wide.where(F.col("_other.is_home") == 0)
    elif how != "left":
        raise ValueError(f"unknown pairing {how!r}")
    away = F.when(F.col("_other.is_home") == 0, F.col("_other"))  # another home row is no partner
    return wide.withColumn("_other", away).select(
        "game_id",
        *[F.col(f"_own.{c}").alias(f"{c}_home") for c in columns],
        *[F.col(f"_other.{c}").alias(f"{c}_away") for c in columns],
    )


def first_per_game(df: DataFrame, columns) -> DataFrame:
    """The first non-null value of each column per game; both rows carry the same one."""
    return df.groupBy("game_id").agg(*[F.max(c).alias(c) for c in columns])

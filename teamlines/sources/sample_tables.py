"""A schedule derived from the order tables: an order is a game, a customer is a team."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from teamlines.schema import SCHEDULE_COLUMNS
from teamlines.sources.schedules import countable_games, to_team_games


def _cycle(key, *values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def schedule(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order in the 20 schedule columns."""
    def table(name):
        return spark.read.parquet(f"{folder}/{name}.parquet")

    odd = F.col("l_linenumber") % 2 == 1
    scores = (
        table("lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(F.when(odd, F.col("l_quantity")).otherwise(0)).cast("long").alias("odd_units"),
            F.sum(F.when(~odd, F.col("l_quantity")).otherwise(0)).cast("long").alias("even_units"),
        )
    )
    teams = table("customer").agg(F.count("*").alias("nc")).scalar()
    orders = table("orders").join(scores, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    priced = key % 40 != 3
    favourite, outsider = -(100 + key % 300), 100 + key % 250
    return orders.select(
        key.alias("game_id"),
        F.year(day).alias("season"),
        (1 + F.floor((F.dayofyear(day) - 1) * 18 / F.lit(366.0))).cast("int").alias("week"),
        day.alias("gameday"),
        _cycle(key, "20:20", "20:15", "13:00", "16:25", None).alias("gametime"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "POST")
        .when(F.col("o_orderpriority") == "5-LOW", "PRE")
        .otherwise("REG")
        .alias("game_type"),
        F.col("o_custkey").alias("home_team"),
        ((F.col("o_custkey") + 1 + key % (teams - 1)) % teams).alias("away_team"),
        (F.col("odd_units") % 46).alias("home_score"),
        (F.col("even_units") % 46).alias("away_score"),
        F.when(key % 20 == 0, "Neutral").otherwise("Home").alias("location"),
        F.when(key % 16 == 0, 1).otherwise(0).alias("overtime"),
        F.when(key % 50 != 7, (key * 7 % 29 - 14) / F.lit(2.0)).alias("spread_line"),
        F.when(key % 50 != 9, 30 + (key * 13 % 41) / F.lit(2.0)).alias("total_line"),
        F.when(priced, F.when(key % 2 == 0, favourite).otherwise(outsider)).cast("double").alias("home_moneyline"),
        F.when(priced, F.when(key % 2 == 0, outsider).otherwise(favourite)).cast("double").alias("away_moneyline"),
        (3 + key % 12).alias("home_rest"),
        (3 + (key * 5) % 12).alias("away_rest"),
        _cycle(key, "grass", "turf", None).alias("surface"),
        _cycle(key, "dome", "outdoors", "closed", None).alias("roof"),
    ).select(*SCHEDULE_COLUMNS)


def team_games(spark: SparkSession, folder: str) -> DataFrame:
    """The team-game rows of the derived schedule."""
    return to_team_games(countable_games(schedule(spark, folder)))

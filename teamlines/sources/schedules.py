"""Schedule files in, team-game rows and feature files out."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from teamlines.schema import DEFAULT_YEARS, GAME_TYPES, SCHEDULE, SCHEDULE_COLUMNS, TEAM_GAME_COLUMNS


def nan_to_null(df: DataFrame) -> DataFrame:
    """NULL for every NaN, so that later aggregates and filters see one kind of missing."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    if not floats:
        return df
    return df.select(
        *[
            F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c)
            for c in df.columns
        ]
    )


def read_schedule(spark: SparkSession, path: str, years=None, fmt="parquet", schema=SCHEDULE):
    """The games of ``years`` (2009-2024 by default) from Parquet, CSV, ORC or JSON files.

    The season and type filters sit on raw columns, so they reach the scan, and prune
    folders where the files are laid out by season.
    """
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    games = reader.format(fmt).load(path)
    return nan_to_null(games.where(F.col("season").isin(list(DEFAULT_YEARS if years is None else years))))


def countable_games(games: DataFrame) -> DataFrame:
    """Games of the types that count, in the 20 columns the engine uses."""
    return games.where(F.col("game_type").isin(*GAME_TYPES)).select(*SCHEDULE_COLUMNS)


def season_week() -> Column:
    return F.concat_ws("-", F.col("season").cast("string"), F.col("week").cast("string"))


def _by_side(home: str, away: str) -> Column:
    return F.when(F.col("is_home") == 1, F.col(home)).otherwise(F.col(away))


def to_team_games(games: DataFrame) -> DataFrame:
    """Two rows per game, one per side, from a single pass over the games.

    Each column is an expression of its own, so that a reader of the teams alone reads no scores.
    """
    both = games.select("*", F.explode(F.array(F.lit(1), F.lit(0))).alias("is_home"))
    return both.withColumns(
        {
            "team": _by_side("home_team", "away_team"),
            "opp": _by_side("away_team", "home_team"),
            "points_for": _by_side("home_score", "away_score"),
            "points_against": _by_side("away_score", "home_score"),
            "date": F.to_date("gameday"),
            "season_week": season_week(),
        }
    ).select(*TEAM_GAME_COLUMNS)


def load_schedules(spark: SparkSession, path: str, years=None, fmt="parquet", schema=SCHEDULE):
    """Files to team-game rows: season and type filter, column pruning, two sides, keys."""
    return to_team_games(countable_games(read_schedule(spark, path, years, fmt, schema)))


def save_features(df: DataFrame, path: str, fmt="parquet", mode="overwrite") -> None:
    """Feature rows to Parquet in folders by season, or to CSV with a header.

    ``overwrite`` replaces all that lies at ``path``; :func:`save_seasons` replaces single seasons.
    """
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.partitionBy("season").format(fmt).save(path)


def save_seasons(df: DataFrame, path: str, fmt="parquet", seasons=None) -> None:
    """Feature rows into their seasons' folders; folders of other seasons stay as they are.

    The files are staged beside the folders and each season is replaced when all tasks are done, so a
    load that fails changes nothing and one that is repeated gives the same rows again. Rows are
    rebalanced by season first: a season is few files, and a large one is still written by many tasks.
    ``seasons`` are those the load stands for; other rows in ``df`` are an error, as is a null season.
    A season listed without rows is left as it was.
    """
    if seasons is not None:
        known = F.col("season").isin([int(s) for s in seasons])
        told = F.raise_error(F.concat(F.lit("a row of a season that is not loaded: "), F.coalesce(F.col("season").cast("string"), F.lit("null"))))
        season = F.when(known, F.col("season")).otherwise(told.cast("int"))
    else:
        season = F.coalesce("season", F.raise_error(F.lit("a row without a season")).cast("int"))
    rows = df.withColumn("season", season.cast(df.schema["season"].dataType)).hint("rebalance", "season")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("season").format(fmt).save(path)


def load_games(spark: SparkSession, path: str, schema, fmt="csv") -> DataFrame:
    """Feature rows back from a file written by :func:`save_features`, under a known schema."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return nan_to_null(reader.format(fmt).load(path))


def build_and_save_features(spark, source, target, builder, years=None, fmt="csv", schema=SCHEDULE, seasons=None):
    """Load, add features with ``builder`` and write; the feature-file job in one call.

    With ``seasons``, features are built over all ``years``, since they look back, and only those
    seasons are written, into a sink by season whose other seasons stay.
    """
    built = builder(load_schedules(spark, source, years, schema=schema))
    if seasons is None:
        save_features(built, target, fmt)
    elif fmt == "csv":
        raise ValueError("a CSV feature file has no seasons of its own")
    else:
        save_seasons(built.where(F.col("season").isin(list(seasons))), target, fmt, seasons)

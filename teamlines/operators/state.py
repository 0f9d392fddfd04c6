"""What new games need to know of the past: a small snapshot per team, kept up to date without the history.

Every rolling column looks back over at most ``SPAN`` rows of a team, so those rows take the place of
all earlier ones. Whole-season quantities are totals: games per team and season, and results per
season and opponent. A snapshot is three Parquet tables of that. It grows with the teams, not with
the games, and a later snapshot follows from the earlier one and the games played since.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from teamlines.functions.outcome import won
from teamlines.functions.windows import FORM_GAMES, WINDOWS
from teamlines.schema import ORDER, TEAM_GAME_COLUMNS
from teamlines.session import scratch_path

SPAN = max(*WINDOWS, FORM_GAMES)
TABLES = ("recent", "seasons", "facing")


def last_rows(df: DataFrame, span=SPAN) -> DataFrame:
    """The last ``span`` rows of each team; Spark limits them per task before it shuffles, so no team is gathered."""
    latest = Window.partitionBy("team").orderBy(*[F.col(c).desc_nulls_last() for c in ORDER])
    return df.withColumn("_back", F.row_number().over(latest)).where(F.col("_back") <= span).drop("_back")


def season_games(df: DataFrame) -> DataFrame:
    """Rows per team and season."""
    return df.groupBy("season", "team").agg(F.count("*").alias("n_games"))


def facing_results(df: DataFrame) -> DataFrame:
    """Wins and rows of all who faced an opponent in a season."""
    return df.groupBy("season", "opp").agg(F.sum(won()).alias("n_won"), F.count("*").alias("n_faced"))


def _summed(a: DataFrame, b: DataFrame) -> DataFrame:
    keys = a.columns[:2]
    return a.unionByName(b).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in a.columns[2:]])


def take_snapshot(df: DataFrame, path: str, before: str | None = None) -> str:
    """Writes the snapshot of ``df`` to ``path``; ``before`` names the snapshot that ``df``'s rows come after.

    The rows of ``df`` must be later than all that went into ``before`` for each team, and not be among them.
    """
    spark = df.sparkSession
    rows = df.select(*TEAM_GAME_COLUMNS)
    made = dict(zip(TABLES, (rows, season_games(rows), facing_results(rows))))
    if before:
        old = read_snapshot(spark, before)
        made["recent"] = old["recent"].unionByName(rows)
        for name in TABLES[1:]:
            made[name] = _summed(old[name], made[name])
    made["recent"] = last_rows(made["recent"])
    for name, table in made.items():
        table.write.mode("errorifexists").parquet(f"{path}/{name}")
    return path


def read_snapshot(spark, path: str) -> dict:
    return {name: spark.read.parquet(f"{path}/{name}") for name in TABLES}


def temporary_snapshot(df: DataFrame) -> str:
    """A snapshot in the session's shared folder."""
    return take_snapshot(df, scratch_path(df.sparkSession, "state"))

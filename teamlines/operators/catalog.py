"""Which columns feed a learner, and checks of their quality."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# The feature names offered to the score models, by group.
FEATURE_WINDOWS = [1, 2, 3, 4, 5, 6, 8, 10]
BASE = ["is_home", "neutral", "rest_days"]
MARKET = ["spread_line", "total_line", "implied_points", "implied_spread", "implied_total"]
CATEGORICAL = ["roof", "surface"]
OWN_ROLLING = ["pf_avg", "pf_std", "pa_avg", "pa_std"]
OPPONENT_ROLLING = ["opp_pf_avg", "opp_pa_avg", "opp_pf_std", "opp_pa_std"]
INTERACTION = [
    "off_vs_def", "def_vs_off", "total_avg_5", "opp_total_avg_5", "win_streak",
    "recent_form", "loss_streak", "games_played", "season_progress", "rest_differential",
]
CONTEXT = [
    "dome_game", "outdoor_game", "turf_game", "early_season", "late_season", "mid_season",
    "is_playoff", "playoff_race", "went_overtime", "home_advantage",
]
STRICT_INTERACTION = ["off_vs_def", "def_vs_off", "total_avg_5", "opp_total_avg_5", "win_streak", "recent_form"]
STRICT_CONTEXT = ["dome_game", "outdoor_game", "turf_game", "season_progress"]
OUTCOMES = {"points_for_home", "points_for_away", "actual_spread", "ats_margin", "beat_spread_home"}
MIN_NONNULL, MIN_STD, MAX_PICKED, MAX_FALLBACK = 0.9, 1e-6, 25, 12
CATEGORY_MARKS = {
    "market": ["spread", "total", "implied"],
    "form": ["pf_avg", "pa_avg", "win_streak", "recent_form"],
    "matchup": ["opp_", "off_vs", "def_vs"],
    "situational": ["rest", "neutral", "dome", "turf", "season_progress"],
}


def _rolling_names(patterns):
    return [f"{p}_{n}" for p in patterns for n in FEATURE_WINDOWS]


def offered_features() -> list:
    """All names offered to the score models."""
    return BASE + MARKET + CATEGORICAL + _rolling_names(OWN_ROLLING + OPPONENT_ROLLING) + INTERACTION + CONTEXT


def available_features(columns) -> list:
    """The offered names that the frame has."""
    present = set(columns)
    return [f for f in offered_features() if f in present]


class MissingFeatures(ValueError):
    """A fixed feature list names columns the frame lacks."""


def fixed_features(columns, strict=True) -> list:
    """The fixed 68-name list; ``strict`` raises where the frame lacks any of them."""
    implied = [c for c in MARKET if c.startswith("implied")]
    names = BASE + MARKET[:2] + CATEGORICAL + implied
    names += _rolling_names(OWN_ROLLING + OPPONENT_ROLLING[:2]) + STRICT_INTERACTION + STRICT_CONTEXT
    missing = [n for n in names if n not in set(columns)]
    if strict and missing:
        raise MissingFeatures(f"not in the frame: {', '.join(missing)}")
    return names


def category_counts(names) -> dict:
    """How many names carry each group's marks; a name may count in several groups."""
    marked = {g: [n for n in names if any(m in n for m in marks)] for g, marks in CATEGORY_MARKS.items()}
    counts = {g: len(found) for g, found in marked.items()}
    seen = set().union(*marked.values())
    counts["other"] = sum(n not in seen for n in names)
    return counts


def category_report(spark: SparkSession, names) -> DataFrame:
    """:func:`category_counts` as a frame of (category, features)."""
    return spark.createDataFrame(list(category_counts(names).items()), "category string, features int")


def feature_quality(games: DataFrame) -> DataFrame:
    """Non-null share and deviation of every candidate column, from one aggregate."""
    picked = [
        f.name
        for f in games.schema.fields
        if isinstance(f.dataType, NumericType)
        and f.name not in OUTCOMES
        and (f.name.startswith("diff_") or f.name in ("rest_advantage", "spread_line_signed"))
    ]
    stats = games.agg(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(c).alias("feature"),
                    F.try_divide(F.count(c), F.count("*")).alias("nonnull_share"),
                    F.stddev_samp(c).alias("std"),
                )
                for i, c in enumerate(picked)
            ]
        ).alias("stats")
    )
    return stats.select(F.inline("stats"))


def select_features(games: DataFrame, min_nonnull=MIN_NONNULL, most=MAX_PICKED, fallback=MAX_FALLBACK) -> list:
    """Candidates that are mostly present and vary, the first ``most`` in column order (None: all).

    Without any, the first ``fallback`` difference columns (None: all).
    """
    good = (
        feature_quality(games)
        .where((F.col("nonnull_share") >= min_nonnull) & (F.col("std") > MIN_STD))
        .orderBy("position")
    )
    # as many rows as the frame has candidate columns
    names = [row.feature for row in good.select("feature").collect()][:most]
    return names or [c for c in games.columns if c.startswith("diff_")][:fallback]


def class_counts(df: DataFrame, target: str) -> DataFrame:
    return df.agg(F.count_distinct(target).alias("classes"))


def require_classes(df: DataFrame, target: str, least=2) -> None:
    """An error where the target has fewer than two classes."""
    if class_counts(df, target).first().classes < least:
        raise ValueError(f"{target} has fewer than {least} classes, so no classifier can be fitted on it")


def profile(df: DataFrame) -> DataFrame:
    """Rows, season range, distinct teams and games."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.min("season").alias("first_season"),
        F.max("season").alias("last_season"),
        F.count_distinct("team").alias("teams"),
        F.floor(F.count("*") / 2).alias("games"),
    )


def column_types(df: DataFrame) -> DataFrame:
    """Position, name and type of each column."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, feature string, dtype string")


def null_audit(df: DataFrame, before=()) -> DataFrame:
    """Null counts of the columns not in ``before``, those with any, from one aggregate."""
    added = [c for c in df.columns if c not in set(before)]
    counts = df.agg(
        F.array(
            *[F.struct(F.lit(c).alias("feature"), F.count_if(F.col(c).isNull()).alias("nulls")) for c in added]
        ).alias("counts")
    )
    return counts.select(F.inline("counts")).where(F.col("nulls") > 0)

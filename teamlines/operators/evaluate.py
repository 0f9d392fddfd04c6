"""Score errors, against-the-spread and over/under accuracy, cross-validation summaries."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from teamlines.operators.joins import pair_sides


def _or_false(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _rmse(error: Column) -> Column:
    return F.sqrt(F.avg(error * error))


def team_errors(df: DataFrame, prediction="prediction", target="points_for") -> DataFrame:
    """Mean absolute and root mean squared error of team predictions, as one row."""
    error = F.col(prediction) - F.col(target)
    return df.agg(F.avg(F.abs(error)).alias("mae"), _rmse(error).alias("rmse"))


def game_predictions(df: DataFrame, prediction="prediction", extra=()) -> DataFrame:
    """Team predictions rolled up to games: one row per home row, the away side nullable.

    ``extra`` names columns of the home row to keep.
    """
    lines = [c for c in ("spread_line", "total_line") if c in df.columns]
    named = df.withColumnRenamed(prediction, "_pred").select("game_id", "is_home", "points_for", "_pred", *lines, *extra)
    c = F.col
    games = pair_sides(named, "left").select(
        "game_id",
        c("_pred_home").alias("home_pred"),
        c("_pred_away").alias("away_pred"),
        (c("_pred_home") + c("_pred_away")).alias("pred_total"),
        (c("_pred_home") - c("_pred_away")).alias("pred_spread"),
        c("points_for_home").alias("home_actual"),
        c("points_for_away").alias("away_actual"),
        (c("points_for_home") + c("points_for_away")).alias("actual_total"),
        (c("points_for_home") - c("points_for_away")).alias("actual_spread"),
        *[c(f"{kept}_home").alias(kept) for kept in (*lines, *extra)],
    )
    made = {
        f"ae_{what}": F.abs(c(predicted) - c(actual))
        for what, predicted, actual in (
            ("home", "home_pred", "home_actual"),
            ("away", "away_pred", "away_actual"),
            ("total", "pred_total", "actual_total"),
            ("spread", "pred_spread", "actual_spread"),
        )
    }
    for line, call, what in (("spread_line", "ats", "spread"), ("total_line", "over", "total")):
        if line in lines:
            made[f"pred_{call}"] = _or_false(c(f"pred_{what}") > c(line))
            made[f"actual_{call}"] = _or_false(c(f"actual_{what}") > c(line))
    return games.withColumns(made)


def game_metrics(games: DataFrame) -> DataFrame:
    """Errors, accuracy against the lines and correlations over game predictions, as one row."""
    c = F.col
    made = [F.avg(f"ae_{what}").alias(f"mae_{what}") for what in ("home", "away", "total", "spread")]
    made += [
        _rmse(c(f"pred_{what}") - c(f"actual_{what}")).alias(f"rmse_{what}")
        for what in ("total", "spread")
    ]
    for call, what, name in (("ats", "spread", "ats_accuracy"), ("over", "total", "ou_accuracy")):
        if f"pred_{call}" in games.columns:
            agree = c(f"pred_{call}") == c(f"actual_{call}")
            made.append(F.avg(agree.cast("double")).alias(name))
            made.append(F.corr(f"pred_{what}", f"actual_{what}").alias(f"{what}_correlation"))
    return games.agg(*made)


def comprehensive_evaluation(df: DataFrame, prediction="prediction"):
    """Game predictions and their metrics."""
    games = game_predictions(df, prediction)
    return games, game_metrics(games)


def fold_scores(df: DataFrame, models: dict, target="points_for", fold="fold") -> DataFrame:
    """Mean absolute error per (fold, model) of prediction columns already in the frame.

    One aggregate per fold over all models; folds count from 1.
    """
    scores = df.where(F.col(fold) > 0).groupBy(fold).agg(
        *[F.avg(F.abs(F.col(column) - F.col(target))).alias(name) for name, column in models.items()]
    )
    packed = F.array(*[F.struct(F.lit(i).alias("model_order"), F.lit(n).alias("model"), F.col(n).alias("mae")) for i, n in enumerate(models)])
    return scores.select(F.col(fold).alias("fold"), F.inline(packed))


def cv_summary(scores: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold scores per model."""
    return scores.groupBy("model", "model_order").agg(
        F.avg("mae").alias("mean_mae"), F.stddev_pop("mae").alias("std_mae")
    )


def best_model(summary: DataFrame) -> DataFrame:
    """The model with the lowest mean error; the first listed wins a tie."""
    return summary.orderBy(F.col("mean_mae").asc_nulls_last(), "model_order").limit(1)

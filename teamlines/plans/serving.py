"""Scoring new games from a saved bundle and a team snapshot, without reading the history.

A bundle is what a fit leaves behind for scoring: the fitted pipeline, the columns and types it
reads, the medians that fill lines, and the category values it knows. All of it is checked when it
is loaded, and a frame is checked against it before it is scored.
"""

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructField, StructType

from teamlines.functions.situation import SEASON_GAMES
from teamlines.operators.impute import medians
from teamlines.operators.state import facing_results, read_snapshot
from teamlines.plans import features as f
from teamlines.plans.encode import category_levels
from teamlines.plans.models import score

FORMAT = 1


class BundleMismatch(ValueError):
    """A bundle whose parts don't fit each other, or a frame that doesn't fit the bundle."""


@dataclass(frozen=True)
class Bundle:
    pipeline: PipelineModel
    schema: StructType
    medians: dict
    levels: dict

    def check(self, df: DataFrame) -> None:
        """An error if ``df`` lacks a column that the pipeline reads, or has it as another kind."""
        have = {field.name: field.dataType for field in df.schema.fields}
        wrong = []
        for field in self.schema.fields:
            got = have.get(field.name)
            if got is None:
                wrong.append(f"{field.name} is missing")
            elif got != field.dataType and not (isinstance(got, NumericType) and isinstance(field.dataType, NumericType)):
                wrong.append(f"{field.name} is {got.simpleString()}, not {field.dataType.simpleString()}")
        if wrong:
            raise BundleMismatch("; ".join(wrong))

    def unseen(self, df: DataFrame) -> DataFrame:
        """``feature, value, n_rows`` of the category values that the fit didn't know; they score as all zeros."""
        told = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in self.levels if c in df.columns]
        if not told:
            return df.sparkSession.createDataFrame([], "feature string, value string, n_rows long")
        known = F.lit(False)
        for c, values in self.levels.items():
            known = known | ((F.col("feature") == c) & F.col("value").isin([str(v) for v in values]))
        each = df.select(F.inline(F.array(*told))).where(F.col("value").isNotNull())
        return each.groupBy("feature", "value").agg(F.count("*").alias("n_rows")).where(~known)

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with a ``prediction``, after the check."""
        self.check(df)
        return score(self.pipeline, df)


def fitted_medians(df: DataFrame, columns=f.LINES, exact=True) -> dict:
    """The medians that new games are filled with, as numbers; None for a column without values."""
    return medians(df, list(columns), exact).first().asDict()


def make_bundle(pipeline, train: DataFrame, inputs, medians=None, categorical=()) -> Bundle:
    """A bundle of a pipeline fitted on ``train``, which reads the columns ``inputs``."""
    schema = StructType([StructField(c, train.schema[c].dataType) for c in inputs])
    return Bundle(pipeline, schema, dict(medians or {}), category_levels(train, [c for c in categorical if c in inputs]))


def _assembled(pipeline) -> set:
    return {c for stage in pipeline.stages if isinstance(stage, VectorAssembler) for c in stage.getInputCols()}


def save_bundle(spark, bundle: Bundle, path: str) -> str:
    """The pipeline and, written last, what a reader checks it with; a bundle without that is unfinished."""
    bundle.pipeline.write().save(f"{path}/pipeline")
    told = {"format": FORMAT, "schema": bundle.schema.json(), "medians": bundle.medians, "levels": bundle.levels, "assembled": sorted(_assembled(bundle.pipeline))}
    spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.text(f"{path}/contract")
    return path


def load_bundle(spark, path: str) -> Bundle:
    """The bundle at ``path``; an error if the pipeline doesn't take the columns or category values stored with it."""
    told = json.loads(spark.read.text(f"{path}/contract").first().value)
    if told["format"] != FORMAT:
        raise BundleMismatch(f"bundle format {told['format']}, not {FORMAT}")
    pipeline = PipelineModel.load(f"{path}/pipeline")
    schema, levels = StructType.fromJson(json.loads(told["schema"])), told["levels"]
    taken = _assembled(pipeline)
    if sorted(taken) != told["assembled"]:
        raise BundleMismatch("the pipeline assembles other columns than were stored")
    names = set(schema.names)
    absent = [f"in_{c}_{v}" for c, values in levels.items() for v in values[1:] if taken and f"in_{c}_{v}" not in taken]
    absent += [c for c in levels if c not in names]
    if absent:
        raise BundleMismatch(f"the pipeline doesn't know {', '.join(absent)}")
    return Bundle(pipeline, schema, told["medians"], levels)


def features_from_state(new: DataFrame, snapshot: dict, medians: dict) -> DataFrame:
    """The columns of ``create_all_features`` for new team-game rows, from a snapshot instead of all earlier rows.

    New rows come after the snapshot's. Each team's last rows are put before its new ones, and
    whole-season quantities are the snapshot's totals and the new rows' together, so the values equal
    those of the whole history. Missing lines take ``medians``.
    """
    flag = "_is_new"
    rows = snapshot["recent"].withColumn(flag, F.lit(False)).unionByName(new.select(*snapshot["recent"].columns).withColumn(flag, F.lit(True)))
    facing = snapshot["facing"].unionByName(facing_results(new)).groupBy("season", "opp").agg(
        (F.sum("n_won") / F.sum("n_faced")).alias("opp_win_pct")
    )
    rated = rows.join(facing, ["season", "opp"], "left")
    built = f.create_advanced_team_features(rated, rates=True)
    only = built.where(F.col(flag)).drop(flag)
    earlier = snapshot["seasons"].withColumnRenamed("n_games", "_earlier")
    placed = f.create_situational_features(only).join(earlier, ["season", "team"], "left")
    games = (F.col("games_played") + F.coalesce("_earlier", F.lit(0))).cast("int")
    placed = placed.withColumn("games_played", games).withColumn("season_progress", F.col("games_played") / SEASON_GAMES).drop("_earlier")
    return f.create_interaction_features(f.create_market_features(f.create_matchup_features(placed), fitted=medians))


def score_from_state(spark, bundle_path: str, snapshot_path: str, new: DataFrame) -> DataFrame:
    """Predicted points of new schedule rows (team-games without scores): load, preprocess, predict.

    Reads the bundle, the snapshot and ``new``; no earlier game. The rows returned are those of ``new``.
    """
    bundle = load_bundle(spark, bundle_path)
    rows = features_from_state(new, read_snapshot(spark, snapshot_path), bundle.medians)
    wanted = ["game_id", "season", "week", "date", "team", "opp", "is_home", "points_for", "spread_line", "total_line"]
    return bundle.score(rows).select(*wanted, "prediction")

"""Fitted models: shape, finite predictions, repeatability, saving and loading."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from contract import queries
from contract.queries import QUICK, QUICK_FOREST, QUICK_SELECTOR, QUICK_SPACE
from helpers import SMALL
from teamlines.operators.impute import fill_medians
from teamlines.operators.splits import contiguous_folds
from teamlines.plans import betting_runs, encode, models
from teamlines.plans.betting_runs import BACKTEST_FEATURES, run_backtest, run_training
from teamlines.plans.features import LINES, build_features, create_all_features
from teamlines.plans.prepare import prepare_data
from teamlines.plans.scoring import format_predictions, predict_upcoming_games
from teamlines.session import materialized


@pytest.fixture(scope="module")
def prepared(team_games):
    return prepare_data(materialized(create_all_features(team_games)), 2001)


@pytest.fixture(scope="module")
def small(prepared):
    """A small matrix with block numbers."""
    train, _, names, target = prepared
    stages, encoded = encode.encoding_stages(train, names[:12])
    rows = models.matrix(contiguous_folds(train), stages, target, ["block"])
    return materialized(rows).persist(), encoded


def finite(scored, expected):
    got = scored.agg(F.count("*"), F.count_if(F.isnan("prediction") | F.col("prediction").isNull())).first()
    assert tuple(got) == (expected, 0)


def test_final_fit_saves_and_scores_upcoming_games(prepared, tmp_path):
    train, test, names, target = prepared
    made = [
        models.train_final(train, test, names, target, boosted=QUICK, selector=QUICK_SELECTOR) for _ in range(2)
    ]
    pipeline, scored, errors = made[0]
    finite(scored, test.count())
    assert errors.columns == ["mae", "rmse"]
    same = [m[1].agg(F.sum("prediction")).first()[0] for m in made]
    assert same[0] == pytest.approx(same[1], abs=1e-9)
    pipeline.write().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    again = predict_upcoming_games(loaded, test)
    assert again.count() == test.where("points_for is null").count()


@pytest.mark.parametrize("kind", ["stacking", "vote", "poisson", "poisson_line", "forest"])
def test_model_kinds(small, kind):
    rows, _ = small
    model = models.fit_model(kind, rows, boosted=QUICK, forest=QUICK_FOREST)
    finite(model.transform(rows), rows.count())


def test_unknown_model_is_an_error(small):
    with pytest.raises(ValueError, match="unknown model"):
        models.fit_model("other", small[0])


def test_importances_and_top_features(small):
    rows, encoded = small
    frame = models.feature_importance(rows, encoded, **QUICK_SELECTOR)
    assert frame.count() == len(encoded)
    assert frame.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    picked = models.top_features(frame, 5)
    assert len(set(picked)) == 5


def test_search_draws_are_seeded_and_in_range():
    a, b = models.sample_params(20), models.sample_params(20)
    assert a == b
    assert all(4 <= d["maxDepth"] <= 12 and 500 <= d["maxIter"] <= 1500 for d in a)


def test_search_picks_the_lowest_error(small):
    rows, _ = small
    fit_rows, check = rows.where("block < 2"), rows.where("block = 2")
    params, trials = models.random_search(fit_rows, check, trials=2, space=QUICK_SPACE)
    got = trials.orderBy("mae", "trial").first()
    assert got.chosen and got.maxDepth == params["maxDepth"]


def test_walk_forward(prepared):
    train, _, names, target = prepared
    scores, best, params = models.walk_forward(
        train, names[:10], target, n_folds=2, models=["base", "forest"], n_features=5, trials=0,
        boosted=QUICK, forest=QUICK_FOREST, selector=QUICK_SELECTOR,
    )
    assert scores.count() == 4 and best in ("base", "forest") and params is None


def test_missing_numbers_become_zero_with_a_flag(spark):
    rows = spark.createDataFrame([(None, "dome", "x'y"), (2.0, None, "a")], "rest_days double, roof string, surface string")
    stages, names = encode.encoding_stages(rows, ["rest_days", "roof", "surface"], missing_flags=True)
    assert names == ["rest_days", "surface_x'y", "rest_days_missing"]
    for stage in stages:
        rows = stage.transform(rows)
    got = [list(r.features.toArray()) for r in rows.orderBy(F.col("rest_days").asc_nulls_first()).collect()]
    assert got == [[0.0, 1.0, 1.0], [2.0, 0.0, 0.0]]


def test_inputs_are_assembled_outside_of_whole_stage_code(spark, prepared):
    train, _, names, target = prepared
    stages, _ = encode.encoding_stages(train, names)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan is then the one that runs
    try:
        plan = models.matrix(train, stages, target)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assembled = [line for line in plan.splitlines() if "Project [" in line and "UDF(struct(" in line]
    assert assembled and not any("*(" in line.split("Project [")[0] for line in assembled)


def test_selector_query_lays_its_rows_out_once(spark, monkeypatch):
    seen, importance = [], models.feature_importance
    monkeypatch.setattr(models, "feature_importance", lambda rows, *a, **k: seen.append(rows) or importance(rows, *a, **k))
    found = queries.feature_select(spark, SMALL)
    assert found.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    held = seen[0].storageLevel
    assert not (held.useMemory or held.useDisk)  # released at the end
    monkeypatch.setattr(models, "feature_importance", lambda rows, *a, **k: rows.storageLevel.useMemory)
    assert queries.feature_select(spark, SMALL)


def test_unknown_category_gives_zeros(spark, prepared):
    train = prepared[0]
    odd = train.limit(1).withColumn("roof", F.lit("glass"))
    got = encode.one_hot(odd, train, ["roof"]).first()
    assert got.roof_closed == got.roof_dome == got.roof_outdoors == 0


def test_every_category_is_kept(prepared):
    ids = prepared[0].withColumn("roof", F.col("game_id").cast("string"))
    levels = encode.category_levels(ids, ["roof"])["roof"]
    assert levels == sorted(levels) and len(levels) == ids.select("roof").distinct().count() > 1000


def test_ridge_equals_the_closed_form(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(50, 2)) * [1.0, 3.0]
    y = x @ [40.0, -20.0] + rng.normal(size=50) * 9 + 7
    rows = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, label double")
    train = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    fitted = models.ridge(train).fit(train)
    centred = x - x.mean(axis=0)
    want = np.linalg.solve(centred.T @ centred + np.eye(2), centred.T @ (y - y.mean()))
    assert fitted.coefficients.toArray() == pytest.approx(want, abs=1e-6)
    assert fitted.intercept == pytest.approx(y.mean() - x.mean(axis=0) @ want, abs=1e-6)


def test_trees_stop_on_the_validation_rows(small):
    rows, _ = small
    both = models.with_validation(rows.where("block < 2"), rows.where("block = 2"))
    assert both.where(models.VALIDATION).count() == rows.where("block = 2").count()
    learner = models.boosted_trees(dict(maxIter=30, maxDepth=5, stepSize=0.9), validation=models.VALIDATION)
    assert learner.fit(both).getNumTrees < 30


def test_walk_forward_releases_frames_when_a_fit_fails(spark, prepared):
    train, _, names, target = prepared
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    with pytest.raises(ValueError, match="unknown model"):
        models.walk_forward(train, names[:4], target, n_folds=1, models=["other"], n_features=2, trials=0, selector=QUICK_SELECTOR)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_report_reads_written_scores(team_games):
    report, _ = run_backtest(materialized(build_features(team_games)), BACKTEST_FEATURES, settings=dict(numTrees=2))
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Window" not in plan


def test_games_without_scores_get_intervals(team_games):
    rows = fill_medians(team_games, LINES).withColumn("prediction", F.col("total_line") / 2 + F.col("is_home"))
    played = rows.where("points_for IS NOT NULL")
    found = format_predictions(rows.where("points_for IS NULL"), fitted_on=played)
    got = found.agg(F.count("*"), F.count("spread_low"), F.count("confidence")).first()
    assert got[0] > 0 and len(set(got)) == 1


def test_forest_of_many_rows_is_fitted_in_parts(spark, tmp_path, monkeypatch):
    rows = spark.range(400).selectExpr("CAST(id % 2 AS DOUBLE) AS label", "CAST(id % 7 AS DOUBLE) AS a", "CAST(id % 2 + id % 5 AS DOUBLE) AS b")
    train = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows).persist()
    sizes, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df: sizes.append(self.getNumTrees()) or fit(self, df))
    whole = betting_runs.fit_forest(train, dict(numTrees=11, maxDepth=3))
    assert sizes == [11] and whole.getNumTrees == 11
    sizes.clear()
    monkeypatch.setattr(betting_runs, "BAGGED", 1600)
    monkeypatch.setattr(betting_runs, "LEAST_TREES", 2)
    model = betting_runs.fit_forest(train, dict(numTrees=11, maxDepth=3))
    assert sizes == [4, 4, 3] and model.getNumTrees == len(model.trees) == 11
    assert len({t.toDebugString.partition("\n")[2] for t in model.trees}) > 4
    row = train.first().features
    votes = sum(t.predictRaw(row).toArray() / t.predictRaw(row).toArray().sum() for t in model.trees) / 11
    assert list(model.predictProbability(row).toArray()) == pytest.approx(list(votes))
    model.write().overwrite().save(str(tmp_path / "forest"))
    assert RandomForestClassificationModel.load(str(tmp_path / "forest")).getNumTrees == 11
    train.unpersist()


def test_forest_keeps_the_nodes_of_its_rows_and_grows_the_same_trees(small, monkeypatch):
    rows = small[0].withColumn("label", (F.col("label") > 22).cast("double"))
    seen, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df: seen.append(self.getCacheNodeIds()) or fit(self, df))
    kept, plain = (betting_runs.fit_forest(rows, dict(numTrees=6, **more)) for more in ({}, {"cacheNodeIds": False}))
    assert seen == [True, False] and kept.getMaxDepth() == plain.getMaxDepth() == 6
    assert [t.toDebugString.partition("\n")[2] for t in kept.trees] == [t.toDebugString.partition("\n")[2] for t in plain.trees]


def test_final_fit_reads_the_picked_features_alone(prepared, monkeypatch):
    train, test, names, target = prepared
    seen, fit = [], models.fit_model
    monkeypatch.setattr(models, "fit_model", lambda kind, rows, *a, **k: seen.append((rows.columns, rows.storageLevel.useMemory)) or fit(kind, rows, *a, **k))
    models.train_final(train, test, names, target, "forest", n_features=4, forest=QUICK_FOREST, selector=QUICK_SELECTOR)
    assert seen == [(["game_id", "is_home", "label", "features"], True)]


def test_walk_forward_lays_its_rows_out_once(prepared, monkeypatch):
    train, _, names, target = prepared
    calls, laid_out = [], models.matrix
    monkeypatch.setattr(models, "matrix", lambda *a, **k: calls.append(1) or laid_out(*a, **k))
    models.walk_forward(
        train, names[:6], target, n_folds=2, models=["forest"], n_features=3, trials=0, forest=QUICK_FOREST, selector=QUICK_SELECTOR
    )
    assert len(calls) == 1


def test_search_of_many_rows_runs_fewer_fits_at_a_time(small, monkeypatch):
    rows, _ = small
    ran, side_by_side = [], models._side_by_side
    monkeypatch.setattr(models, "_side_by_side", lambda spark, work, items, n: ran.append(n) or side_by_side(spark, work, items, n))
    fit_rows, check = rows.where("block < 2"), rows.where("block = 2")
    first = models.random_search(fit_rows, check, trials=2, space=QUICK_SPACE)
    monkeypatch.setattr(models, "ROWS_AT_ONCE", 1)
    second = models.random_search(fit_rows, check, trials=2, space=QUICK_SPACE)
    assert ran == [4, 1]
    assert first[0] == second[0]
    assert [(r.trial, r.rounds, r.chosen) for r in first[1].collect()] == [(r.trial, r.rounds, r.chosen) for r in second[1].collect()]


def test_backtest_and_training_run(team_games):
    built = materialized(build_features(team_games))
    report, summary = run_backtest(built, BACKTEST_FEATURES, settings=dict(numTrees=5))
    assert [r.season for r in report.orderBy("season").collect()] == [2000, 2001]
    assert summary.count() == 1
    found = run_training(team_games, range(1995, 2000), [2000, 2001], settings=dict(maxIter=3, stepSize=0.1))
    assert 0.35 <= found["best_threshold"] <= 0.65
    assert found["roi_60"]["threshold"] >= 0.6
    assert found["test_size"] > 0


class Seen(Exception):
    """Ends a run where its test has seen enough."""


@pytest.mark.parametrize("walk", [False, True])
def test_matrix_of_all_features_leaves_the_memory_to_bins(prepared, monkeypatch, walk):
    train, test, names, target = prepared
    made, levels, lay_out = [], [], models.matrix

    def kept(*args):
        made.append(lay_out(*args))
        return made[-1]

    def looked_at(*args, **kwargs):
        levels.append(made[0].storageLevel)
        raise Seen

    monkeypatch.setattr(models, "matrix", kept)
    monkeypatch.setattr(models, "feature_importance", looked_at)
    with pytest.raises(Seen):
        models.walk_forward(train, names, target, n_folds=2) if walk else models.train_final(train, test, names, target)
    assert [(level.useDisk, level.useMemory) for level in levels] == [(True, False)]
    assert not made[0].storageLevel.useDisk


def test_search_keeps_the_rows_it_fits_in_memory_and_the_others_on_disk(spark):
    levels = queries._first_fold(spark, SMALL, lambda *frames: [frame.storageLevel for frame in frames])
    assert [(level.useDisk, level.useMemory) for level in levels] == [(True, True), (True, False)]

"""Scoring from a bundle and a snapshot against the whole history; what a bundle refuses."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from helpers import rows_of
from teamlines.operators import state
from teamlines.operators.impute import fill_medians
from teamlines.plans import models, serving
from teamlines.plans.features import LINES, create_all_features, create_situational_features
from teamlines.session import materialized

CUT = 2001


@pytest.fixture(scope="module")
def parts(team_games):
    unplayed = {c: F.lit(None).cast(team_games.schema[c].dataType) for c in ("points_for", "points_against")}
    past = team_games.where(F.col("season") < CUT)
    return past, team_games.where(F.col("season") >= CUT).withColumns(unplayed)


def test_features_from_a_snapshot_equal_those_of_the_history(spark, parts):
    past, new = parts
    lines = serving.fitted_medians(past)
    filled = past.unionByName(new).withColumns({c: F.coalesce(F.col(c), F.lit(lines[c])) for c in LINES})
    whole = create_all_features(past.unionByName(new)).where(F.col("season") >= CUT)
    snapshot = state.read_snapshot(spark, state.temporary_snapshot(past))
    found = serving.features_from_state(new, snapshot, lines)
    # Lines are filled at the end, by medians of the past here and of all rows there.
    odd = {"spread_line", "total_line"}
    known = whole.join(filled.where("spread_line IS NOT NULL").select("game_id", "team"), ["game_id", "team"], "left_semi")
    assert set(found.columns) == set(whole.columns)
    names = [c for c in whole.columns if c not in odd and not c.startswith(("implied", "opp_implied", "total_vs", "market_"))]
    assert rows_of(found, names) == rows_of(known, names)
    assert found.where("spread_line IS NULL OR total_line IS NULL").count() == 0


def test_a_snapshot_brought_up_to_date_equals_one_taken_at_once(spark, parts, tmp_path):
    past, _ = parts
    first = state.take_snapshot(past.where("season < 1998"), str(tmp_path / "a"))
    second = state.take_snapshot(past.where("season IN (1998, 1999)"), str(tmp_path / "b"), before=first)
    third = state.take_snapshot(past.where("season = 2000"), str(tmp_path / "c"), before=second)
    once = state.take_snapshot(past, str(tmp_path / "d"))
    a, b = state.read_snapshot(spark, third), state.read_snapshot(spark, once)
    for name in state.TABLES:
        assert rows_of(a[name]) == rows_of(b[name])
    most = a["recent"].groupBy("team").count().agg(F.max("count")).first()[0]
    assert most == state.SPAN
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        state.take_snapshot(past, str(tmp_path / "d"))


def test_no_old_game_is_read(spark, parts):
    past, new = parts
    snapshot = state.read_snapshot(spark, state.temporary_snapshot(past))
    assert snapshot["recent"].count() < past.count()
    assert serving.features_from_state(new.limit(0), snapshot, {}).count() == 0


NAMES = ["rest_days", "is_home", "roof", "surface"]


@pytest.fixture(scope="module")
def fitted(team_games):
    rows = materialized(fill_medians(create_situational_features(team_games), LINES))
    train, test = rows.where(F.col("season") < CUT), rows.where(F.col("season") == CUT)
    pipeline, scored, _ = models.train_final(train, test, NAMES, "points_for", select=False, boosted=dict(maxIter=2, maxDepth=2))
    return train, test, scored, serving.make_bundle(pipeline, train, NAMES, {"spread_line": 1.5}, ["roof", "surface"])


def test_a_loaded_bundle_gives_the_same_predictions(spark, fitted, tmp_path):
    train, test, scored, bundle = fitted
    loaded = serving.load_bundle(spark, serving.save_bundle(spark, bundle, str(tmp_path / "bundle")))
    keys = ["game_id", "team", "prediction"]
    assert sorted(map(tuple, loaded.score(test).select(*keys).collect())) == sorted(map(tuple, scored.select(*keys).collect()))
    assert loaded.schema == bundle.schema and loaded.medians == {"spread_line": 1.5} and loaded.levels == bundle.levels
    assert loaded.levels["roof"][0] == sorted(loaded.levels["roof"])[0]


def test_a_frame_that_does_not_fit_is_refused(fitted):
    _, test, _, bundle = fitted
    with pytest.raises(serving.BundleMismatch, match="roof is missing"):
        bundle.score(test.drop("roof"))
    with pytest.raises(serving.BundleMismatch, match="rest_days is string"):
        bundle.score(test.withColumn("rest_days", F.lit("seven")))
    bundle.check(test.withColumn("rest_days", F.col("rest_days").cast("double")))


def test_unseen_values_are_told(fitted):
    _, test, _, bundle = fitted
    odd = test.withColumn("roof", F.when(F.col("is_home") == 1, "glass").otherwise(F.col("roof")))
    assert [(r.feature, r.value, r.n_rows) for r in bundle.unseen(odd).collect()] == [("roof", "glass", test.where("is_home = 1").count())]
    assert bundle.unseen(test).count() == 0


def test_a_bundle_whose_parts_do_not_fit_is_refused(spark, fitted, tmp_path):
    train, _, _, bundle = fitted
    more = serving.Bundle(bundle.pipeline, bundle.schema, {}, {**bundle.levels, "roof": [*bundle.levels["roof"], "glass"]})
    with pytest.raises(serving.BundleMismatch, match="in_roof_glass"):
        serving.load_bundle(spark, serving.save_bundle(spark, more, str(tmp_path / "more")))
    path = serving.save_bundle(spark, bundle, str(tmp_path / "other"))
    other = PipelineModel([SQLTransformer(statement="SELECT *, 1D AS prediction FROM __THIS__")])
    other.write().overwrite().save(f"{path}/pipeline")
    with pytest.raises(serving.BundleMismatch, match="other columns"):
        serving.load_bundle(spark, path)

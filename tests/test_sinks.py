"""Season sinks, salted joins, grouped intervals and season sizes."""

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import rows_of, schedule
from teamlines.operators import joins, splits
from teamlines.operators.evaluate import game_predictions
from teamlines.operators.impute import fill_medians
from teamlines.plans.features import LINES, build_features
from teamlines.plans.scoring import PRIOR_GAMES, format_predictions, group_noise
from teamlines.sources.schedules import build_and_save_features, load_games, save_features, save_seasons


def files(path):
    return {str(f.relative_to(path)): hashlib.md5(f.read_bytes()).hexdigest() for f in Path(path).rglob("part-*")}


def of_season(told, season):
    return {k: v for k, v in told.items() if k.startswith(f"season={season}/")}


def test_a_season_is_replaced_and_others_stay(spark, team_games, tmp_path):
    path, built = str(tmp_path / "features"), build_features(team_games)
    save_features(built, path)
    before = files(path)
    assert {k.split("/")[0] for k in before} == {f"season={r.season}" for r in splits.seasons(team_games).collect()}
    wrong = built.where("season = 1998").withColumn("points_for", F.lit(7).cast("long"))
    for rows in (wrong, built.where("season = 1998"), built.where("season = 1998")):
        save_seasons(rows, path, seasons=[1998])
        after = files(path)
        assert {k: v for k, v in after.items() if "season=1998" not in k} == {k: v for k, v in before.items() if "season=1998" not in k}
        assert of_season(after, 1998).keys().isdisjoint(of_season(before, 1998))
    found = load_games(spark, path, built.schema, "parquet")
    assert rows_of(found, built.columns) == rows_of(built)


def test_a_failed_load_changes_nothing(team_games, tmp_path):
    path, built = str(tmp_path / "features"), build_features(team_games)
    save_features(built, path)
    before = files(path)
    with pytest.raises(Exception, match="not loaded"):
        save_seasons(built.where("season IN (1998, 1999)"), path, seasons=[1998])
    with pytest.raises(Exception, match="without a season"):
        save_seasons(built.withColumn("season", F.lit(None).cast("int")), path)
    assert files(path) == before
    save_seasons(built.where("season = 1900"), path, seasons=[1900])
    assert files(path) == before


def test_a_large_season_is_written_by_many_tasks(spark, team_games, tmp_path):
    path = str(tmp_path / "features")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        save_seasons(team_games.repartition(6), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(of_season(files(path), 1998)) > 1


def test_the_season_job_needs_a_sink_by_season(spark, tmp_path):
    source = str(tmp_path / "games")
    schedule(spark, [{}]).write.parquet(source)
    with pytest.raises(ValueError, match="CSV"):
        build_and_save_features(spark, source, str(tmp_path / "out"), build_features, [2020], "csv", seasons=[2020])


def test_hot_pairs_are_salted(spark):
    """One opponent and date holds a third of the rows; salted or not, every pair is there."""
    rows = spark.range(900).selectExpr(
        "id AS game_id", "int(id % 2) AS is_home", "IF(id < 300, 'hot', concat('t', id % 60)) AS team", "IF(id < 300, 'hot', concat('t', (id + 7) % 60)) AS opp",
        "IF(id % 50 = 49, NULL, date_add(DATE'2020-01-01', int(IF(id < 300, 0, id % 9)))) AS date", "double(id) AS v",
    )
    plain = joins.opponent_columns(rows, ["v"], "date", hot_rows=10_000)
    for limit in (1, 20, 299):
        salted = joins.opponent_columns(rows, ["v"], "date", hot_rows=limit)
        assert rows_of(salted) == rows_of(plain)
    hot = joins.hot_pairs(rows, ["opp", "date"], 20)
    (pair,) = [r for r in hot.collect() if r.opp == "hot"]
    assert pair.salts == -(-rows.where("opp = 'hot' AND date IS NOT NULL").count() // 20)
    assert joins.hot_pairs(rows, ["opp", "date"], 10_000) is None
    assert joins.hot_pairs(rows.limit(0), ["opp", "date"], 1) is None


def test_group_deviations_are_drawn_to_the_whole(team_games):
    rows = fill_medians(team_games, LINES).withColumn("prediction", F.col("total_line") / 2 + F.col("is_home"))
    games = game_predictions(rows, extra=["roof", "season"]).toPandas()
    error = games.pred_spread - games.actual_spread
    for by in (["roof"], ["season", "roof"]):
        for r in group_noise(game_predictions(rows, extra=by), by).collect():
            mine = error[[all((g[c] == r[c]) or (r[c] is None and g[c] is None) for c in by) for _, g in games.iterrows()]].dropna()
            weight = max(len(mine) - 1, 0)
            own = mine.var() if len(mine) > 1 else 0
            assert r.n_games == len(mine)
            assert r.spread_noise == pytest.approx(((weight * own + PRIOR_GAMES * error.var()) / (weight + PRIOR_GAMES)) ** 0.5)


def test_a_group_without_played_games_has_the_whole_deviation(team_games):
    rows = fill_medians(team_games, LINES).withColumn("prediction", F.col("total_line") / 2 + F.col("is_home"))
    played = rows.where("points_for IS NOT NULL")
    new = rows.where("points_for IS NULL").withColumn("roof", F.lit("glass"))
    plain = format_predictions(new, fitted_on=played)
    grouped = format_predictions(new, fitted_on=played, by=["roof"])
    assert {(r.roof, r.n_games) for r in grouped.collect()} == {("glass", 0)}
    assert rows_of(grouped.drop("roof", "n_games")) == rows_of(plain)


def test_season_sizes_equal_the_splits(team_games):
    want = []
    for season, train, test in splits.expanding_seasons(team_games, 2):
        want += [(season, "test", test.count()), (season, "train", train.count())]
    assert sorted(map(tuple, splits.expanding_sizes(team_games, 2).collect())) == want

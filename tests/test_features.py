"""Hand-made cases for single operators and stages."""

import statistics

import pytest
from pyspark.sql import functions as F

from contract.queries import rounded
from helpers import SMALL, one_team, rows_of, schedule, values
from teamlines.functions import windows as w
from teamlines.operators import betting, catalog, game_level, impute, rolling
from teamlines.operators.joins import opponent_columns, pair_sides
from teamlines.plans import features as f
from teamlines.plans.scoring import format_predictions
from teamlines.schema import TEAM_GAME_COLUMNS
from teamlines.sources.sample_tables import team_games
from teamlines.sources.schedules import (
    countable_games,
    load_games,
    load_schedules,
    nan_to_null,
    save_features,
    to_team_games,
)


def test_rolling_mean_skips_gaps(spark):
    df = one_team(spark, [3, None, 5, 6, 7])
    rolled = rolling.create_team_rolling_features(df, [3])
    assert values(rolled, "pf_avg_3") == [None, 3, 3, 4, 5.5]


def test_strict_mean_needs_every_game(spark):
    assert values(f.build_features(one_team(spark, [3, None, 5, 6, 7])), "pf_avg_3") == [None] * 5


def test_rolling_deviation(spark):
    df = one_team(spark, [1, 0, 1, 1, 0])
    rolled = f.create_advanced_team_features(df)
    assert values(rolled, "pf_std_1") == [None] * 5
    assert values(rolled, "pf_std_3") == [None, None, 0.7071, 0.5774, 0.5774]


WON = [1, 0, 1, 1, 0, 1, 0, 0, 1, 1, 1, 0, 1]


def test_decayed_form(spark):
    rolled = f.create_advanced_team_features(one_team(spark, WON))
    assert values(rolled, "form_ema_9") == [None] * 10 + [0.607, 0.6463, 0.5816]


def test_trend(spark):
    df = one_team(spark, WON).withColumn("won", F.col("points_for"))
    rolled = rolling.rolling(df, {}, [w.trend("won").alias("slope")], carried=["won"], lags=range(1, 6))
    assert values(rolled, "slope") == [None] * 5 + [-0.1, 0.1, -0.2, -0.2, 0.1, 0.1, 0.3, 0]


def test_efficiency_clips_the_sum(spark):
    df = rolling.with_outcomes(one_team(spark, [20, 0, 0], [10, 0, 1]))
    assert values(df, "off_efficiency") == [20.202, 0, 0]


def test_cover_rate(spark):
    df = one_team(spark, [1, 0, 1]).withColumn("spread_line", F.lit(0.5))
    assert values(f.create_advanced_team_features(df), "ats_record_5") == [None, 1.0, 0.5]


def test_clutch_without_close_games(spark):
    rolled = f.create_advanced_team_features(one_team(spark, [30, 30, 3, 3]))
    assert values(rolled, "clutch_record") == [None, 0, 0, 1]


def test_stage_sizes(spark, team_games):
    assert team_games.columns == TEAM_GAME_COLUMNS
    rows, sizes = team_games, []
    for stage in (
        f.create_advanced_team_features, f.create_situational_features, f.create_matchup_features,
        f.create_market_features, f.create_interaction_features,
    ):
        rows = stage(rows)
        sizes.append(len(rows.columns))
    assert sizes == [89, 108, 165, 176, 184]
    assert len(catalog.available_features(rows.columns)) == 84
    with pytest.raises(catalog.MissingFeatures, match="win_streak"):
        catalog.fixed_features([*rows.columns, "implied_spread"])
    assert len(catalog.fixed_features([], strict=False)) == 68


def test_frame_without_lines(spark):
    rows = one_team(spark, [3, 7]).drop("spread_line", "total_line", "home_moneyline", "away_moneyline", "gametime")
    built = f.create_all_features(rows)
    assert "home_spread_cover" not in built.columns and "implied_points" not in built.columns
    assert built.agg(F.sum("prime_time")).first()[0] == 0


def test_self_key_gives_zero_and_game_key_mirrors(spark, team_games):
    own = f.add_features(team_games, "self").where("diff_pf3 <> 0").count()
    assert own == 0
    both = f.add_features(team_games).groupBy("game_id").agg(F.sum("diff_pf3").alias("s"))
    assert both.where("abs(s) > 1e-9").count() == 0


def test_game_key_needs_the_named_opponent(spark):
    games = [dict(home_score=7, away_score=3), dict(home_score=1, away_score=2)]
    rows = to_team_games(schedule(spark, games)).withColumn(
        "opp", F.when(F.col("game_id") == "g001", "Z").otherwise(F.col("opp"))
    )
    got = {(r.game_id, r.team): r.opp_points_for for r in opponent_columns(rows, ["points_for"]).collect()}
    assert got == {("g000", "A"): 3, ("g000", "B"): 7, ("g001", "A"): None, ("g001", "B"): None}


def test_pairing_keeps_home_rows_on_the_left(spark, team_games):
    one_sided = team_games.where("is_home = 1 or game_id % 2 = 0")
    games = team_games.count() // 2
    assert pair_sides(one_sided, "left", ["team"]).count() == games
    assert pair_sides(one_sided, "inner", ["team"]).count() < games


def test_pushes_and_unplayed(spark):
    games = [
        dict(home_score=None, away_score=None), dict(home_score=3, away_score=3, spread_line=0.0),
        dict(home_score=3, away_score=2, spread_line=0.0),
    ]
    rows = rolling.create_team_rolling_features(to_team_games(schedule(spark, games)))
    plain = game_level.to_game_level_with_diffs(rows)
    assert [r.game_id for r in plain.collect()] == ["g002"]
    kept = game_level.to_game_level_with_diffs(rows, keep_unplayed=True).orderBy("game_id").collect()
    assert [(r.game_id, r.beat_spread_home) for r in kept] == [("g000", 0), ("g002", 1)]


def test_moneylines(spark):
    games = [dict(home_moneyline=150.0), dict(home_moneyline=-150.0), dict(home_moneyline=None)]
    rows = f.create_all_features(to_team_games(schedule(spark, games)))
    assert values(rows, "home_ml_prob") == [0.4, 0.6, None]


def test_opponent_rate_as_of_ignores_the_future(spark, team_games):
    full = rolling.opponent_win_rate(team_games)
    late = team_games.where(F.col("date") < F.lit("1998-01-01").cast("date"))
    early = [rolling.opponent_win_rate(x, as_of=True).where("season <= 1997") for x in (team_games, late)]
    assert rows_of(early[0], ["game_id", "team", "opp_win_pct"]) == rows_of(early[1], ["game_id", "team", "opp_win_pct"])
    assert full.count() == team_games.count()


def test_roi(spark):
    rows = spark.createDataFrame([(0.9, 1), (0.9, 1), (0.1, 0), (0.1, 1), (0.5, 1)], "prob double, label int")
    got = betting.roi_report(rows, 0.6).first()
    assert (got.n_bets, round(got.units, 4), round(got.roi, 6)) == (4, 172.7273, 0.431818)
    none = betting.roi_report(rows, 0.95).first()
    assert (none.n_bets, none.hit_rate, none.units, none.roi) == (0, None, 0.0, None)
    plus = betting.roi_report(rows, 0.6, odds=150).first()
    assert plus.units == 3 * 150 - 100


def test_threshold_tie_takes_the_lowest(spark):
    rows = spark.createDataFrame([(0.9, 1), (0.1, 0)], "prob double, label int")
    scan = betting.threshold_scan(rows)
    assert scan.count() == 61
    assert betting.best_threshold(scan).first().threshold == 0.35


def test_season_without_bets(spark):
    rows = spark.createDataFrame([(2020, 0.5, 1)], "season int, prob double, label int")
    got = betting.season_report(rows).first()
    assert (got.bets, got.bet_acc, got.profit, got.roi) == (0, None, 0.0, 0.0)


def test_returns_stay_in_bounds(spark, team_games):
    from contract.queries import stand_in

    rows = stand_in(f.build_features(team_games)).where("prob is not null")
    got = betting.season_report(rows, "prob", "beat_spread").agg(F.min("roi"), F.max("roi")).first()
    assert -1 <= got[0] and got[1] <= 100 / 110


def test_medians_exact_and_approximate(spark, team_games):
    exact = impute.medians(team_games, ["spread_line"]).first()[0]
    near = impute.medians(team_games, ["spread_line"], exact=False).first()[0]
    assert abs(exact - near) <= 0.5


def test_category_counts():
    counts = catalog.category_counts(["spread_line", "pf_avg_3", "opp_pf_avg_3", "rest_days", "is_home"])
    assert counts == {"market": 1, "form": 2, "matchup": 1, "situational": 1, "other": 1}


def test_quality_pick(spark):
    rows = spark.createDataFrame(
        [(1.0, 5.0, None, 1), (2.0, 5.0, 1.0, 0), (3.0, 5.0, None, 1)],
        "diff_a double, diff_b double, diff_c double, beat_spread_home int",
    )
    assert catalog.select_features(rows) == ["diff_a"]
    assert catalog.select_features(rows.select("diff_b", "diff_c")) == ["diff_b", "diff_c"]
    with pytest.raises(ValueError, match="classes"):
        catalog.require_classes(rows.where("diff_a > 2.5"), "beat_spread_home")


def test_schedule_files_round_trip(spark, tmp_path):
    games = schedule(spark, [dict(season=2008), dict(season=2020), dict(season=2021, game_type="PRE", spread_line=float("nan"))])
    for fmt in ("parquet", "csv", "json", "orc"):
        path = str(tmp_path / fmt)
        writer = games.write.option("header", True) if fmt == "csv" else games.write
        writer.format(fmt).save(path)
        assert {r.season for r in load_schedules(spark, path, fmt=fmt).collect()} == {2020}
    assert countable_games(games).count() == 2
    assert nan_to_null(games).where("spread_line is null").count() == 1


def test_feature_files_round_trip(spark, tmp_path):
    built = f.build_features(one_team(spark, [3, None, 5, 6, 7]))
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / fmt)
        save_features(built, path, fmt)
        back = load_games(spark, path, built.schema, fmt)
        assert rows_of(back) == rows_of(built)


def test_season_filter_reaches_the_folders(spark, tmp_path):
    path = str(tmp_path / "by_season")
    schedule(spark, [dict(season=2019), dict(season=2020)]).write.partitionBy("season").parquet(path)
    plan = load_schedules(spark, path, [2020])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [season" in plan.replace("isnotnull(season", "season") or "season#" in plan.split("PartitionFilters")[1][:80]


def test_formatted_predictions_are_sorted(spark, team_games):
    from contract.queries import stand_in

    rows = format_predictions(stand_in(team_games)).select("confidence", "spread_low", "spread_high").collect()
    sure = [r.confidence for r in rows if r.confidence is not None]
    assert sure == sorted(sure, reverse=True)
    assert all(r.spread_low < r.spread_high for r in rows if r.spread_low is not None)


@pytest.mark.parametrize("values", [[], [None], [3.0], [1.0, 2.0], [5.0, 1.0, None, 1.0], [1.0, 1.0, 2.0, 9.0], list(map(float, range(101)))])
def test_medians_of_few_and_many_values(spark, values):
    rows = spark.createDataFrame([(v, 7.5) for v in values] or [(None, 7.5)], "a double, b double")
    got = impute.medians(rows, ["a", "b"]).first()
    known = [v for v in values if v is not None]
    assert got.a == (statistics.median(known) if known else None) and got.b == 7.5


def test_a_home_row_is_no_partner(spark):
    rows = spark.createDataFrame([("g", 1, 3), ("g", 1, 4), ("h", 1, 5), ("h", 0, 6)], "game_id string, is_home int, points int")
    got = {(r.points_home, r.points_away) for r in pair_sides(rows, "left").collect()}
    assert got == {(3, None), (4, None), (5, 6)}


def test_no_years_means_no_season(spark, tmp_path):
    path = str(tmp_path / "games")
    schedule(spark, [dict(season=2020), dict(season=2008)]).write.parquet(path)
    assert load_schedules(spark, path, []).count() == 0
    assert load_schedules(spark, path).count() == 2


def test_rounding_is_that_of_spark(spark):
    values = [0.0, -0.0, 1e-9, -1e-9, 0.5e-6, 1.5e-6, -2.5e-6, 1.0000005, 2.6753215, 99999.9999995, 123456.1234565, 1e11, -1e300, float("inf"), float("nan"), None]
    values += [(i * 7919 % 99991) / 777 * (-1) ** i for i in range(3000)] + [i / 2e6 for i in range(-500, 500)]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    both = rounded(rows.select("x", F.col("x").alias("y"))).select(F.col("x").cast("string").alias("got")).collect()
    want = rows.select(F.round("x", 6).cast("string").alias("want")).collect()
    assert [r.got for r in both] == [r.want for r in want]


def test_teams_alone_need_no_scores(spark):
    plan = team_games(spark, SMALL).groupBy("team").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "l_quantity" not in plan and "Join" not in plan


def test_derived_columns_are_not_shuffled(spark):
    built = f.build_features(one_team(spark, [3, 7, 10, 14, 17]))
    plan = built._jdf.queryExecution().executedPlan().toString()
    last = plan[plan.rindex("Exchange hashpartitioning(opp"):] if "Exchange hashpartitioning(opp" in plan else plan
    assert "pd_avg_3" not in last and "spread_line_signed" not in last

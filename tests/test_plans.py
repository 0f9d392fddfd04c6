"""Shapes of the physical plans: shuffles, pruning, no Python workers."""

import time

from pyspark.sql import functions as F

from helpers import SMALL, rows_of
from teamlines.operators import rolling
from teamlines.operators.joins import opponent_columns, pair_sides
from teamlines.plans.features import create_all_features, create_advanced_team_features
from teamlines.session import materialized
from teamlines.sources.sample_tables import team_games as derived


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rolling_needs_one_shuffle(team_games):
    text = plan(rolling.create_team_rolling_features(team_games))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Sort [") == 1


def test_pairing_adds_one_shuffle_and_no_join(team_games):
    text = plan(pair_sides(rolling.create_team_rolling_features(team_games)))
    assert text.count("Exchange hashpartitioning") == 2
    assert "Join" not in text


def test_opponent_columns_need_no_join(team_games):
    rolled = rolling.create_team_rolling_features(team_games)
    assert "Join" not in plan(opponent_columns(rolled, ["pf_avg_5"]))


def test_situation_reuses_the_team_shuffle(team_games):
    """Games played is counted per team and season on rows already hashed by team."""
    rows = create_advanced_team_features(team_games)
    before = plan(rows).count("Exchange hashpartitioning(team#")
    assert plan(rolling.games_played(rows)).count("Exchange hashpartitioning(team#") == before == 1


def test_no_python_in_the_feature_plan(team_games):
    assert "Python" not in plan(create_all_features(team_games))


def test_only_needed_columns_are_read(spark):
    text = plan(derived(spark, SMALL).select("team", "points_for"))
    scans = [line for line in text.splitlines() if "ReadSchema" in line]
    assert not any("o_totalprice" in line or "l_extendedprice" in line for line in scans)


def test_unused_features_leave_the_plan(team_games):
    text = plan(create_all_features(team_games).select("game_id", "rest_days"))
    assert "Window" not in text


def test_games_are_counted_and_sides_met_on_narrow_rows(team_games):
    """The (team, season) sort is below the rolling columns; what a row alone tells is made above the game's shuffle."""
    frame = create_all_features(team_games)
    text = plan(frame)
    assert text.count("Exchange hashpartitioning(team#") == 1
    counted, rolled = text.index("AS games_played#"), text.index("_lag_16")
    assert counted > rolled  # lower in the plan
    below = text[text.index("Exchange hashpartitioning(game_id#") :]
    made = ["rest_advantage", "prime_time", "month", "season_progress"]
    assert not any(f"AS {c}#" in below for c in made) and "AS margin#" not in below.partition("Window [")[0]


def test_only_the_wanted_opponent_columns_are_taken_over(team_games):
    full, some = create_all_features(team_games), create_all_features(team_games, opponents={"pf_avg_3"})
    left = set(full.columns) - set(some.columns)
    assert "opp_pf_avg_3" in some.columns and left and all(c.startswith("opp_") for c in left)
    names = ["game_id", "team", "opp_pf_avg_3", "form_diff", "volatility_diff", "games_played", "market_form_diff"]
    assert rows_of(some, names) == rows_of(full, names)


def test_shuffles_of_a_written_frame_leave_the_disk(spark):
    """Their files go with the plan at once, not at the next run of the collector."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    before, made = shuffles(), []
    frame = materialized(spark.range(1000).repartition(5, "id").withColumn("made", F.lit(1)), release=True)
    until = time.time() + 20
    while (made := shuffles() - before) and time.time() < until:
        time.sleep(0.2)
    assert not made and frame.count() == 1000

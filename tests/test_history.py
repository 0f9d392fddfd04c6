"""Hot keys give the same values as one window per key."""

import pytest
from pyspark.sql import functions as F

from helpers import one_team, rows_of, schedule
from teamlines.operators import history, rolling
from teamlines.operators.joins import pair_sides
from teamlines.plans.features import (
    build_features,
    create_advanced_team_features,
    create_all_features,
    create_situational_features,
)
from teamlines.sources.schedules import to_team_games


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows belong to one team; every few games share a date."""
    games = []
    for i in range(180):
        hot = i % 3 != 2
        games.append(
            dict(
                game_id=f"g{(i * 37) % 180:03d}", gameday=f"2020-{1 + i // 20:02d}-{1 + (i % 20) // 2:02d}",
                season=2020 if i < 100 else 2021, home_team="HOT" if hot else f"T{i % 7}",
                away_team=f"U{i % 11}", home_score=None if i % 17 == 0 else i * 7 % 40,
                away_score=None if i % 17 == 0 else i * 11 % 35,
            )
        )
    return to_team_games(schedule(spark, games))


@pytest.mark.parametrize(
    "stage",
    [
        rolling.create_team_rolling_features,
        rolling.games_played,
        rolling.schedule_strength,
        create_advanced_team_features,
        create_situational_features,
        build_features,
    ],
)
def test_split_equals_plain(skewed, stage):
    plain, cut = stage(skewed), stage(skewed, hot_rows=10)
    assert cut.columns == plain.columns
    assert rows_of(cut) == rows_of(plain)


def test_chunks_shorter_than_the_look_back(skewed):
    """Chunks of a few rows take their look-back from several chunks before."""
    plain = rolling.create_team_rolling_features(skewed, [3, 16])
    cut = rolling.create_team_rolling_features(skewed, [3, 16], hot_rows=3)
    assert rows_of(cut) == rows_of(plain)


def test_split_breaks_up_the_hot_team(skewed):
    hot = history.find_hot(skewed, 10)
    assert hot.rows >= 120
    cut = history._cut(skewed, ["team"], ("date", "game_id"), hot)
    largest = cut.groupBy("team", history.CHUNK).count().agg(F.max("count")).first()[0]
    assert largest < 60


def test_small_pieces_share_partitions(spark, skewed):
    """A low limit makes short pieces, not a task for each."""
    hot = history.find_hot(skewed, 1)
    cut = history._cut(skewed, ["team"], ("date", "game_id"), hot)
    assert cut.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions")) < hot.rows
    pieces = cut.groupBy("team", history.CHUNK).count()
    assert pieces.agg(F.max("count")).first()[0] == 1 and pieces.count() == hot.rows


def test_rows_that_come_twice_are_split_alike(skewed):
    twice = skewed.unionByName(skewed)
    plain = rolling.create_team_rolling_features(twice)
    assert rows_of(rolling.create_team_rolling_features(twice, hot_rows=3)) == rows_of(plain)


def test_missing_team_is_kept(skewed):
    odd = skewed.withColumn("team", F.when(F.col("team") != "HOT", F.col("team")))
    plain = rolling.create_team_rolling_features(odd)
    cut = rolling.create_team_rolling_features(odd, hot_rows=10)
    assert rows_of(cut) == rows_of(plain)


def test_hot_teams_are_counted_once(skewed, monkeypatch):
    """The stages take over what the pipeline found."""
    counted = []
    real = history.hot_rows_limit
    monkeypatch.setattr(history, "hot_rows_limit", lambda df, given=None: counted.append(1) or real(df, given))
    cut = create_all_features(skewed, hot_rows=10)
    assert counted == [1]
    assert history.find_hot(skewed).teams is None
    assert rows_of(cut) == rows_of(create_all_features(skewed))


def test_opponents_are_split_by_the_teams_found(skewed):
    hot = history.find_hot(skewed, 10)
    assert rows_of(build_features(skewed, hot_rows=hot)) == rows_of(build_features(skewed))
    assert rows_of(rolling.games_played(skewed, hot_rows=hot)) == rows_of(rolling.games_played(skewed))


def test_setting_overrides_the_default(spark, skewed):
    spark.conf.set("spark.teamlines.hotRows", "10")
    try:
        assert history.hot_rows_limit(skewed) == 10
        cut = rows_of(pair_sides(rolling.create_team_rolling_features(skewed)))
    finally:
        spark.conf.unset("spark.teamlines.hotRows")
    assert cut == rows_of(pair_sides(rolling.create_team_rolling_features(skewed)))


def test_past_rows_do_not_see_a_changed_score(spark):
    """Only later rows of the teams involved move when one score changes."""
    scores = [3, 7, 10, 14, 17, 20, 21, 24]
    before = create_advanced_team_features(one_team(spark, scores))
    changed = create_advanced_team_features(one_team(spark, scores[:5] + [99] + scores[6:]))
    names = [c for c in before.columns if "_avg_" in c or "_std_" in c or "trend" in c or "record" in c]
    a, b = (x.where("team = 'A'").orderBy("date").select(*names).collect() for x in (before, changed))
    assert a[:6] == b[:6]
    assert a[6:] != b[6:]

"""Cuts by cell counts equal cuts by a global ranking."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from teamlines.operators import splits


def ranked(df):
    whole = Window.partitionBy(F.lit(1)).orderBy(splits.chronological_key(df))
    return df.withColumn("pos", F.row_number().over(whole) - 1)


def test_folds_equal_a_global_ranking(team_games):
    n = team_games.count()
    size = n // 5
    start = n - 4 * size
    expected = F.when(F.col("pos") < start, 0).otherwise(F.floor((F.col("pos") - start) / size) + 1)
    rows = ranked(splits.time_folds(team_games))
    assert rows.where(F.col("fold") != expected).count() == 0
    sizes = {r.fold: r["count"] for r in rows.groupBy("fold").count().collect()}
    assert [sizes[i] for i in (1, 2, 3, 4)] == [size] * 4


def test_folds_follow_the_dates(team_games):
    spans = (
        splits.time_folds(team_games).groupBy("fold").agg(F.min("date").alias("a"), F.max("date").alias("b"))
        .orderBy("fold").collect()
    )
    assert all(x.b <= y.a for x, y in zip(spans, spans[1:]))


def test_one_hot_date(team_games):
    """All games on one day still give equal folds."""
    day = team_games.withColumn("date", F.lit("2000-01-01").cast("date"))
    sizes = {r.fold: r["count"] for r in splits.time_folds(day).groupBy("fold").count().collect()}
    n = team_games.count()
    assert [sizes[i] for i in (1, 2, 3, 4)] == [n // 5] * 4


def test_contiguous_blocks_differ_by_at_most_one(team_games):
    sizes = [r["count"] for r in splits.contiguous_folds(team_games).groupBy("block").count().orderBy("block").collect()]
    n = team_games.count()
    assert sizes == [n // 3 + (i < n % 3) for i in range(3)]


def test_split_keeps_class_shares(team_games):
    games = team_games.where("is_home = 1").withColumn("label", F.when(F.col("game_id") % 7 == 0, 1).otherwise(0))
    for rows in (games, games.withColumn("game_id", F.col("game_id").cast("string"))):
        counts = rows.groupBy("label").count().collect()
        parted = splits.stratified_split(rows, "label")
        trained = {r.label: r["count"] for r in parted.where("is_train").groupBy("label").count().collect()}
        assert trained == {r.label: int(r["count"] * 0.8) for r in counts}
        assert parted.count() == rows.count()


def test_fold_plan_has_no_shuffle_of_the_wide_frame(spark, team_games):
    """The frame itself is only compared with the cut row, not moved."""
    plan = splits.time_folds(team_games)._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subqueries")[0]
    assert "Exchange" not in main.split("Subquery")[0]


def test_rows_without_a_date_or_class_are_cut_too(spark, team_games):
    """A null is a cell and a class like any other; nulls come first in time."""
    odd = team_games.withColumn("date", F.when(F.col("game_id") % 3 != 0, F.col("date")))
    n = odd.count()
    sizes = {r.fold: r["count"] for r in splits.time_folds(odd).groupBy("fold").count().collect()}
    assert [sizes[i] for i in (1, 2, 3, 4)] == [n // 5] * 4
    late = splits.time_folds(odd).where("date IS NULL").agg(F.max("fold")).first()[0]
    assert late <= splits.time_folds(odd).where("date IS NOT NULL").agg(F.max("fold")).first()[0]
    games = team_games.where("is_home = 1").withColumn("label", F.when(F.col("game_id") % 3 == 0, 1))
    counts = {r.label: r["count"] for r in games.groupBy("label").count().collect()}
    trained = {r.label: r["count"] for r in splits.stratified_split(games, "label").where("is_train").groupBy("label").count().collect()}
    assert None in counts and trained == {k: int(v * 0.8) for k, v in counts.items()}


def test_seasons_after_the_warm_up(team_games):
    found = [(season, train.agg(F.max("season")).first()[0], test.select("season").distinct().count()) for season, train, test in splits.expanding_seasons(team_games)]
    assert found == [(2000, 1999, 1), (2001, 2000, 1)]

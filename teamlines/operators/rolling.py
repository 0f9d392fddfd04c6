"""Rolling team statistics: one function per family, each ``DataFrame -> DataFrame``."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from teamlines.functions import windows as w
from teamlines.functions.outcome import home_spread_cover, outcome_columns, point_diff, won
from teamlines.operators.history import find_hot, over_history, running_position
from teamlines.schema import ORDER

SCORES = {"pf": "points_for", "pa": "points_against"}


def score_measures():
    return {name: F.col(column) for name, column in SCORES.items()}


def flag_measures(columns):
    """The 0/1 columns whose rolling shares are features."""
    made = {
        "close_game": F.col("close_game"),
        "close_win": F.col("won") * F.col("close_game"),
        "blowout_win": F.col("blowout_win"),
        "blowout_loss": F.col("blowout_loss"),
    }
    if "home_spread_cover" in columns:
        made["cover"] = F.col("home_spread_cover").cast("int")
    return made


def mean_columns(sizes=w.WINDOWS):
    return [w.rolling_mean(p, n).alias(f"{p}_avg_{n}") for n in sizes for p in SCORES]


def std_columns(sizes=w.WINDOWS):
    return [w.rolling_std(p, n).alias(f"{p}_std_{n}") for n in sizes for p in SCORES]


def margin_columns(sizes=w.WINDOWS, prefix="point_diff_avg"):
    return [w.rolling_mean("diff", n).alias(f"{prefix}_{n}") for n in sizes]


def strict_columns(sizes=w.SHORT_WINDOWS):
    return [w.strict_mean(p, n).alias(f"{p}_avg_{n}") for n in sizes for p in SCORES]


def form_columns(decays=w.DECAYS):
    return [w.decayed_form("won", d).alias(f"form_ema_{round(d * 10)}") for d in decays]


def cover_columns():
    return [w.rolling_mean("cover", n).alias(f"ats_record_{n}") for n in w.COVER_WINDOWS]


def clutch_columns():
    return [w.clutch().alias("clutch_record")]


def blowout_columns():
    return [
        w.rolling_mean(c, w.BLOWOUT_GAMES).alias(f"{c}_rate_8")
        for c in ("blowout_win", "blowout_loss")
    ]


def trend_columns():
    return [w.trend(c).alias(f"{c}_trend_5") for c in ("off_efficiency", "def_efficiency")]


def schedule_columns(window):
    return [
        w.sliding_mean(F.col("opp_win_pct"), window, n).alias(f"sos_{n}")
        for n in w.SCHEDULE_WINDOWS
    ]


def rolling(
    df: DataFrame, measures, columns, squares=(), carried=(), lags=w.WINDOWS,
    sliding=None, order=ORDER, hot_rows=None,
) -> DataFrame:
    """``df`` plus ``columns``, computed from each team's earlier rows under one window.

    ``sliding(window)`` may add columns that read at most ``max(lags)`` rows back.
    """
    def build(rows, window):
        packed = w.add_recent(rows, window, measures, squares, carried, lags)
        made = [*columns, *(sliding(window) if sliding else [])]
        return w.drop_recent(packed.select("*", *made))

    return over_history(df, build, order=order, span=max(lags), hot_rows=hot_rows)


def opponent_win_rate(df: DataFrame, as_of=False) -> DataFrame:
    """``opp_win_pct``: mean of ``won`` over the rows facing the same opponent that season.

    By default the whole season counts, later games included. ``as_of`` counts only games
    before the row's date. Either way rows are reduced before they are shuffled, and the
    result is joined back, so an opponent with very many rows stays spread over tasks.
    """
    df = df if "won" in df.columns else df.withColumn("won", won())
    if not as_of:
        keys = ["season", "opp"]
        rates = df.groupBy(*keys).agg(F.avg("won").alias("opp_win_pct"))
        return df.join(rates, keys, "left").select(*df.columns, "opp_win_pct")
    keys = ["season", "opp", "date"]
    daily = df.groupBy(*keys).agg(F.sum("won").alias("_won"), F.count("won").alias("_n"))
    before = Window.partitionBy("season", "opp").orderBy("date").rowsBetween(
        Window.unboundedPreceding, -1
    )
    rates = daily.select(
        *keys, (F.sum("_won").over(before) / F.sum("_n").over(before)).alias("opp_win_pct")
    )
    return df.join(rates, keys, "left").select(*df.columns, "opp_win_pct")


def schedule_strength(df: DataFrame, as_of=False, hot_rows=None) -> DataFrame:
    """``opp_win_pct`` and its rolling means ``sos_3`` and ``sos_8``."""
    hot_rows = find_hot(df, hot_rows)
    rows = opponent_win_rate(df, as_of)

    def build(part, window):
        return part.select("*", *schedule_columns(window))

    return over_history(rows, build, span=max(w.SCHEDULE_WINDOWS), hot_rows=hot_rows)


def with_outcomes(df: DataFrame, corrected_efficiency=False) -> DataFrame:
    """The result columns of each row, and the cover flag where there is a line."""
    columns = outcome_columns(corrected_efficiency)
    if "spread_line" in df.columns:
        columns["home_spread_cover"] = home_spread_cover()
    return df.withColumns(columns)


def games_played(df: DataFrame, hot_rows=None) -> DataFrame:
    """How many games the team has played earlier in the season."""
    return running_position(df, "games_played", ["team", "season"], hot_rows=hot_rows)


def create_team_rolling_features(df: DataFrame, windows=w.SHORT_WINDOWS, hot_rows=None) -> DataFrame:
    """Game margin and lagged rolling means of points for, against and margin."""
    measures = {**score_measures(), "diff": F.col("point_diff_game")}
    named = df.withColumn("point_diff_game", point_diff())
    columns = mean_columns(windows) + margin_columns(windows, "pd_avg")
    return rolling(named, measures, columns, lags=windows, hot_rows=hot_rows)

"""Feature stages: team history, situation, matchup, market and interactions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teamlines.functions import market as m
from teamlines.functions import outcome as o
from teamlines.functions import situation as s
from teamlines.functions import windows as w
from teamlines.operators import rolling as r
from teamlines.operators.history import find_hot, over_history
from teamlines.operators.impute import fill_medians, fill_unknown
from teamlines.operators.joins import opponent_columns
from teamlines.schema import ORDER

# Name parts that mark a column as one to take from the opponent.
OPPONENT_MARKS = ["pf_", "pa_", "point_diff_", "form_ema"]
COMPARED = ["pf_avg_5", "pa_avg_5", "pf_std_5", "pa_std_5", "form_ema_9"]
LINES = ["spread_line", "total_line"]


def create_advanced_team_features(
    df: DataFrame, opponent_as_of=False, corrected_efficiency=False, hot_rows=None, rates=False
) -> DataFrame:
    """Rolling scoring, form, schedule strength, cover rate, clutch, blowouts and trends.

    All history columns share one window per team, hence one shuffle and one sort. With ``rates``
    the frame already holds ``opp_win_pct``.
    """
    hot_rows = find_hot(df, hot_rows)
    rows = r.with_outcomes(df, corrected_efficiency)
    if not rates:
        rows = r.opponent_win_rate(rows, opponent_as_of)
    has_line = "spread_line" in df.columns
    measures = {**r.score_measures(), "diff": o.point_diff(), **r.flag_measures(rows.columns)}
    columns = r.mean_columns() + r.std_columns() + r.margin_columns() + r.form_columns()
    columns += r.clutch_columns() + r.blowout_columns() + r.trend_columns()
    if has_line:
        columns += r.cover_columns()
    rows = r.rolling(
        rows,
        measures,
        columns,
        squares=list(r.SCORES),
        carried=["won", "off_efficiency", "def_efficiency"],
        lags=[*w.WINDOWS, *range(1, w.FORM_GAMES + 1)],
        sliding=r.schedule_columns,
        hot_rows=hot_rows,
    )
    scoring = [f"{p}_{n}" for n in w.WINDOWS for p in ("pf_avg", "pf_std", "pa_avg", "pa_std", "point_diff_avg")]
    form = [f"form_ema_{round(d * 10)}" for d in w.DECAYS]
    cover = ["home_spread_cover", "ats_record_5", "ats_record_10"] if has_line else []
    return rows.select(
        *[c for c in df.columns if c != "opp_win_pct"], *scoring, "won", *form, "opp_win_pct", "sos_3", "sos_8", *cover,
        "margin", "close_game", "clutch_record", "blowout_win", "blowout_loss",
        "blowout_win_rate_8", "blowout_loss_rate_8", "off_efficiency", "def_efficiency",
        "off_efficiency_trend_5", "def_efficiency_trend_5",
    )


def create_situational_features(df: DataFrame, hot_rows=None) -> DataFrame:
    """Rest, calendar, season progress, venue and broadcast slot."""
    return _situated(_dated(r.games_played(df, hot_rows=hot_rows)))


def _dated(df: DataFrame) -> DataFrame:
    """Known venue words and the date of the game day, which the situational columns and joins by date read."""
    return fill_unknown(df).withColumn("date", F.to_date("gameday"))


def _situated(df: DataFrame) -> DataFrame:
    """The situational columns of rows that hold ``games_played``."""
    progress = F.col("games_played") / s.SEASON_GAMES
    return df.withColumns({**s.situation_columns(df.columns), "season_progress": progress})


def opponent_names(columns) -> list:
    """The columns a matchup takes over from the opponent."""
    return [c for c in columns if any(mark in c for mark in OPPONENT_MARKS)]


def create_matchup_features(df: DataFrame, key="game", opponents=None) -> DataFrame:
    """The opponent's pre-game columns and how they compare with the row's own.

    ``opponents`` names the columns to take over where not all are wanted; those compared here always are.
    """
    names = opponent_names(df.columns)
    if opponents is not None:
        names = [c for c in names if c in opponents or c in COMPARED]
    rows = opponent_columns(df, names, key)
    c = F.col
    pace, opp_pace = c("pf_avg_5") + c("pa_avg_5"), c("opp_pf_avg_5") + c("opp_pa_avg_5")
    swing = (c("pf_std_5") + c("pa_std_5")) / 2
    opp_swing = (c("opp_pf_std_5") + c("opp_pa_std_5")) / 2
    return rows.withColumns(
        {
            "off_vs_def": c("pf_avg_5") - c("opp_pa_avg_5"),
            "def_vs_off": c("pa_avg_5") - c("opp_pf_avg_5"),
            "total_pace": pace,
            "opp_total_pace": opp_pace,
            "pace_differential": pace - opp_pace,
            "form_diff": c("form_ema_9") - c("opp_form_ema_9"),
            "volatility": swing,
            "opp_volatility": opp_swing,
            "volatility_diff": swing - opp_swing,
        }
    )


def create_market_features(df: DataFrame, exact=True, fitted=None) -> DataFrame:
    """Points and probabilities implied by the lines, after filling lines with medians.

    ``fitted`` gives the medians of an earlier fit by column; otherwise they are the frame's own.
    """
    if fitted is None:
        rows = fill_medians(df, LINES, exact=exact)
    else:
        rows = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(fitted.get(c)).cast("double")) for c in LINES if c in df.columns})
    c, made = F.col, {}
    if set(LINES) <= set(df.columns):
        own, other = m.implied_points()
        recent = c("pf_avg_3") + c("pa_avg_3")
        made.update(
            implied_points=own,
            opp_implied_points=other,
            implied_vs_avg=own - c("pf_avg_5"),
            opp_implied_vs_avg=other - c("opp_pf_avg_5"),
            implied_total=c("total_line"),
            recent_total_avg=recent,
            total_vs_recent=c("total_line") - recent,
        )
    if {"home_moneyline", "away_moneyline"} <= set(df.columns):
        home = m.moneyline_probability(c("home_moneyline"))
        away = m.moneyline_probability(c("away_moneyline"))
        made.update(
            home_ml_prob=home,
            away_ml_prob=away,
            ml_prob=m.by_side(home, away),
            opp_ml_prob=m.by_side(away, home),
        )
    return rows.withColumns(made) if made else rows


def create_interaction_features(df: DataFrame) -> DataFrame:
    """Products of rest, venue, timing and market columns with form and pace."""
    c = F.col
    form, pace = c("form_ema_9"), c("total_pace")
    made = {
        "rest_form_interaction": c("rest_days") * form,
        "bye_week_form": c("bye_week") * form,
        "dome_pace": c("dome_game") * pace,
        "turf_pace": c("turf_game") * pace,
        "late_season_form": c("late_season") * form,
        "playoff_race_form": c("playoff_race") * form,
        "home_rest_advantage": c("is_home") * c("rest_advantage"),
    }
    if "implied_points" in df.columns:
        made["market_form_diff"] = (c("implied_points") - c("pf_avg_3")) * form
    return df.withColumns(made)


def create_all_features(
    df: DataFrame, key="game", opponent_as_of=False, hot_rows=None, exact_medians=True, opponents=None
) -> DataFrame:
    """All five stages: 23 team-game columns and 161 features. Hot teams are counted once, on ``df``.

    ``opponents`` is that of :func:`create_matchup_features`. Rows are shuffled and sorted as narrow as they can be: games
    are counted before the rolling columns are there, on rows already hashed by team, and what follows
    from a row alone is made after the two sides of its game have met.
    """
    hot_rows = find_hot(df, hot_rows)
    rows = r.opponent_win_rate(df, opponent_as_of).select(*df.columns, "opp_win_pct")
    if hot_rows.teams is None:
        rows = rows.repartition("team")
    rows = r.games_played(rows, hot_rows=hot_rows)
    rows = _dated(create_advanced_team_features(rows, hot_rows=hot_rows, rates=True))
    counted = [] if "games_played" in df.columns else ["games_played"]
    own = [c for c in rows.columns if c not in counted]
    faced = create_matchup_features(rows, key, opponents)
    made = _situated(r.with_outcomes(faced))
    situation = [c for c in made.columns if c not in faced.columns]
    rows = made.select(*own, *counted, *situation, *[c for c in faced.columns if c not in rows.columns])
    return create_interaction_features(create_market_features(rows, exact_medians))


def add_features(df: DataFrame, key="game", hot_rows=None) -> DataFrame:
    """Short rolling means, signed line, rest advantage and differences to the opponent.

    ``key="self"`` joins each row with itself, which makes every difference 0.
    """
    names = [f"{p}_avg_{n}" for n in w.SHORT_WINDOWS for p in ("pf", "pa", "pd")]
    means = r.rolling(
        df, r.score_measures(), r.mean_columns(w.SHORT_WINDOWS), lags=w.SHORT_WINDOWS, hot_rows=hot_rows
    )
    rows = means.withColumns(
        {f"pd_avg_{n}": F.col(f"pf_avg_{n}") - F.col(f"pa_avg_{n}") for n in w.SHORT_WINDOWS}
    ).select(
        *df.columns,
        *names,
        s.rest_advantage("filled").alias("rest_advantage"),
        o.spread_line_signed().alias("spread_line_signed"),
    )
    return opponent_columns(rows, names, key).withColumns(
        {f"diff_{n.replace('_avg_', '')}": F.col(n) - F.col(f"opp_{n}") for n in names}
    )


def build_features(df: DataFrame, order=ORDER, hot_rows=None) -> DataFrame:
    """Strict rolling means, differences to the previous row facing the same opponent, target.

    ``order`` is the row order that "previous" refers to.
    """
    names = [f"{p}_avg_{n}" for n in w.SHORT_WINDOWS for p in ("pf", "pa", "pd")]
    hot_rows = find_hot(df, hot_rows)
    rows = r.rolling(
        df, r.score_measures(), r.strict_columns(), lags=w.SHORT_WINDOWS, order=order, hot_rows=hot_rows
    )
    # Columns that follow from others are made after the shuffles.
    margins = {f"pd_avg_{n}": F.col(f"pf_avg_{n}") - F.col(f"pa_avg_{n}") for n in w.SHORT_WINDOWS}

    def differences(part, window):
        return part.select(
            "*", *[(made - F.lag(made).over(window)).alias(f"diff_{n}") for n in names for made in (margins.get(n, F.col(n)),)]
        )

    rows = over_history(rows, differences, key="opp", order=order, span=1, hot_rows=hot_rows)
    made = {"rest_advantage": s.rest_advantage("own"), "beat_spread": o.beat_spread()}
    rows = rows.withColumns({"spread_line_signed": o.spread_line_signed(), "point_diff": o.point_diff(), **margins})
    return rows.withColumns(made).select(
        *df.columns, "spread_line_signed", "point_diff", *names, *[f"diff_{n}" for n in names], *made
    )

"""SQL twins of the registered queries, written for DuckDB over the same tables.

Each is plain SQL put together from shared WITH clauses; none uses the library's code.
"""

WINDOWS = [1, 2, 3, 4, 5, 6, 8, 10, 16]
SHORT = [3, 5, 8]

GAMES = """
teams AS (SELECT count(*) AS nc FROM customer),
units AS (
  SELECT l_orderkey,
         CAST(sum(CASE WHEN l_linenumber % 2 = 1 THEN l_quantity ELSE 0 END) AS BIGINT) AS odd_units,
         CAST(sum(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity ELSE 0 END) AS BIGINT) AS even_units
  FROM lineitem GROUP BY l_orderkey),
games AS (
  SELECT o_orderkey AS game_id,
         CAST(year(o_orderdate) AS INTEGER) AS season,
         CAST(1 + floor((dayofyear(o_orderdate) - 1) * 18 / 366.0e0) AS INTEGER) AS week,
         CAST(o_orderdate AS DATE) AS gameday,
         CASE o_orderkey % 5 WHEN 0 THEN '20:20' WHEN 1 THEN '20:15' WHEN 2 THEN '13:00' WHEN 3 THEN '16:25' END AS gametime,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'POST' WHEN '5-LOW' THEN 'PRE' ELSE 'REG' END AS game_type,
         o_custkey AS home_team,
         (o_custkey + 1 + o_orderkey % (nc - 1)) % nc AS away_team,
         odd_units % 46 AS home_score,
         even_units % 46 AS away_score,
         CASE WHEN o_orderkey % 20 = 0 THEN 'Neutral' ELSE 'Home' END AS location,
         CASE WHEN o_orderkey % 16 = 0 THEN 1 ELSE 0 END AS overtime,
         CASE WHEN o_orderkey % 50 <> 7 THEN (o_orderkey * 7 % 29 - 14) / 2.0e0 END AS spread_line,
         CASE WHEN o_orderkey % 50 <> 9 THEN 30 + (o_orderkey * 13 % 41) / 2.0e0 END AS total_line,
         CASE WHEN o_orderkey % 40 = 3 THEN NULL WHEN o_orderkey % 2 = 0
              THEN CAST(-(100 + o_orderkey % 300) AS DOUBLE) ELSE CAST(100 + o_orderkey % 250 AS DOUBLE) END AS home_moneyline,
         CASE WHEN o_orderkey % 40 = 3 THEN NULL WHEN o_orderkey % 2 = 0
              THEN CAST(100 + o_orderkey % 250 AS DOUBLE) ELSE CAST(-(100 + o_orderkey % 300) AS DOUBLE) END AS away_moneyline,
         3 + o_orderkey % 12 AS home_rest,
         3 + (o_orderkey * 5) % 12 AS away_rest,
         CASE o_orderkey % 3 WHEN 0 THEN 'grass' WHEN 1 THEN 'turf' END AS surface,
         CASE o_orderkey % 4 WHEN 0 THEN 'dome' WHEN 1 THEN 'outdoors' WHEN 2 THEN 'closed' END AS roof
  FROM orders CROSS JOIN teams LEFT JOIN units ON o_orderkey = l_orderkey),
tg AS (
  SELECT game_id, season, week, gameday, gametime, game_type,
         CASE WHEN side = 1 THEN home_team ELSE away_team END AS team,
         CASE WHEN side = 1 THEN away_team ELSE home_team END AS opp,
         CASE WHEN side = 1 THEN home_score ELSE away_score END AS points_for,
         CASE WHEN side = 1 THEN away_score ELSE home_score END AS points_against,
         side AS is_home, location, overtime, spread_line, total_line, home_moneyline,
         away_moneyline, home_rest, away_rest, surface, roof, gameday AS date,
         season || '-' || week AS season_week
  FROM games CROSS JOIN (VALUES (1), (0)) AS sides(side)
  WHERE game_type IN ('REG', 'POST'))"""

BY_TEAM = "PARTITION BY team ORDER BY date, game_id"


def frame(n, by=BY_TEAM):
    return f"OVER ({by} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


def means(sizes=WINDOWS):
    return {
        f"{p}_avg_{n}": f"avg({c}) {frame(n)}"
        for p, c in (("pf", "points_for"), ("pa", "points_against"))
        for n in sizes
    }


def stds(sizes=WINDOWS):
    return {
        f"{p}_std_{n}": f"stddev_samp({c}) {frame(n)}"
        for p, c in (("pf", "points_for"), ("pa", "points_against"))
        for n in sizes
    }


def margins(sizes=WINDOWS, prefix="point_diff_avg"):
    return {f"{prefix}_{n}": f"avg(points_for - points_against) {frame(n)}" for n in sizes}


def forms():
    made = {}
    for tenths in (9, 8, 7):
        weights = [(tenths / 10) ** k for k in range(10)]
        terms = " + ".join(f"{x!r} * lag(won, {k + 1}) OVER ({BY_TEAM})" for k, x in enumerate(weights))
        made[f"form_ema_{tenths}"] = f"({terms}) / {sum(weights)!r}"
    return made


def trends():
    return {
        f"{c}_trend_5": f"CASE WHEN count({c}) {frame(5)} = 5 THEN regr_slope({c}, rn) {frame(5)} END"
        for c in ("off_efficiency", "def_efficiency")
    }


SCHEDULE = {f"sos_{n}": f"avg(opp_win_pct) {frame(n)}" for n in (3, 8)}
COVER = {f"ats_record_{n}": f"avg(CAST(home_spread_cover AS INTEGER)) {frame(n)}" for n in (5, 10)}
CLUTCH = {"clutch_record": f"sum(won * close_game) {frame(10)} / greatest(sum(close_game) {frame(10)}, 1)"}
BLOWOUT = {f"{c}_rate_8": f"avg({c}) {frame(8)}" for c in ("blowout_win", "blowout_loss")}

OUTCOMES = """
outcomes AS (
  SELECT tg.*,
         CASE WHEN points_for > points_against THEN 1 ELSE 0 END AS won,
         abs(points_for - points_against) AS margin,
         CASE WHEN abs(points_for - points_against) <= 7 THEN 1 ELSE 0 END AS close_game,
         CASE WHEN points_for - points_against >= 14 THEN 1 ELSE 0 END AS blowout_win,
         CASE WHEN points_against - points_for >= 14 THEN 1 ELSE 0 END AS blowout_loss,
         CASE WHEN points_for IS NOT NULL THEN points_for / CASE WHEN points_for + points_against >= 1 THEN 0.99e0 ELSE 0.01e0 END END AS off_efficiency,
         CASE WHEN points_for IS NOT NULL THEN points_against / CASE WHEN points_for + points_against >= 1 THEN 0.99e0 ELSE 0.01e0 END END AS def_efficiency,
         coalesce(CASE WHEN is_home = 1 THEN points_for - points_against > spread_line
                       ELSE points_against - points_for > -spread_line END, false) AS home_spread_cover,
         CASE WHEN is_home = 1 THEN spread_line ELSE -spread_line END AS spread_line_signed,
         row_number() OVER (PARTITION BY team ORDER BY date, game_id) AS rn
  FROM tg)"""

RATED = """
rated AS (SELECT *, avg(won) OVER (PARTITION BY season, opp) AS opp_win_pct FROM outcomes)"""


def columns(made):
    return ", ".join(f"{sql} AS {name}" for name, sql in made.items())


TEAM_COLUMNS = {**means(), **stds(), **margins(), **forms(), **SCHEDULE, **COVER, **CLUTCH, **BLOWOUT, **trends()}
TEAM = f"""
team_rows AS (SELECT *, {columns(TEAM_COLUMNS)} FROM rated)"""

SITUATION = {
    "rest_days": "CASE WHEN is_home = 1 THEN home_rest ELSE away_rest END",
    "rest_advantage": "home_rest - away_rest",
    "short_rest": "CASE WHEN CASE WHEN is_home = 1 THEN home_rest ELSE away_rest END <= 5 THEN 1 ELSE 0 END",
    "long_rest": "CASE WHEN CASE WHEN is_home = 1 THEN home_rest ELSE away_rest END >= 10 THEN 1 ELSE 0 END",
    "bye_week": "CASE WHEN CASE WHEN is_home = 1 THEN home_rest ELSE away_rest END >= 13 THEN 1 ELSE 0 END",
    "month": "CAST(month(date) AS INTEGER)",
    "day_of_week": "CAST(isodow(date) - 1 AS INTEGER)",
    "games_played": "CAST(row_number() OVER (PARTITION BY team, season ORDER BY date, game_id) - 1 AS INTEGER)",
    "season_progress": "(row_number() OVER (PARTITION BY team, season ORDER BY date, game_id) - 1) / 17.0e0",
    "early_season": "CASE WHEN week <= 4 THEN 1 ELSE 0 END",
    "mid_season": "CASE WHEN week BETWEEN 5 AND 13 THEN 1 ELSE 0 END",
    "late_season": "CASE WHEN week BETWEEN 14 AND 18 THEN 1 ELSE 0 END",
    "playoff_race": "CASE WHEN week >= 15 AND game_type = 'REG' THEN 1 ELSE 0 END",
    "dome_game": "CASE WHEN lower(roof) IN ('dome', 'closed') THEN 1 ELSE 0 END",
    "outdoor_game": "CASE WHEN lower(roof) = 'outdoors' THEN 1 ELSE 0 END",
    "turf_game": "CASE WHEN lower(surface) = 'turf' THEN 1 ELSE 0 END",
    "neutral": "CASE WHEN contains(lower(location), 'neutral') THEN 1 ELSE 0 END",
    "division_game": "0",
    "prime_time": "CASE WHEN regexp_matches(gametime, '20:20|20:15|17:00') THEN 1 ELSE 0 END",
}
PLACES = "coalesce(roof, 'UNK') AS roof, coalesce(surface, 'UNK') AS surface"
SITUATED = f"""
situated AS (SELECT * REPLACE ({PLACES}), {columns(SITUATION)} FROM team_rows)"""

OPPONENT = [*means(), *stds(), *margins(), "form_ema_9", "form_ema_8", "form_ema_7"]
MATCHUP = {
    "off_vs_def": "pf_avg_5 - opp_pa_avg_5",
    "def_vs_off": "pa_avg_5 - opp_pf_avg_5",
    "total_pace": "pf_avg_5 + pa_avg_5",
    "opp_total_pace": "opp_pf_avg_5 + opp_pa_avg_5",
    "pace_differential": "pf_avg_5 + pa_avg_5 - (opp_pf_avg_5 + opp_pa_avg_5)",
    "form_diff": "form_ema_9 - opp_form_ema_9",
    "volatility": "(pf_std_5 + pa_std_5) / 2",
    "opp_volatility": "(opp_pf_std_5 + opp_pa_std_5) / 2",
    "volatility_diff": "(pf_std_5 + pa_std_5) / 2 - (opp_pf_std_5 + opp_pa_std_5) / 2",
}
MATCHED = f"""
faced AS (
  SELECT a.*, {", ".join(f"b.{c} AS opp_{c}" for c in OPPONENT)}
  FROM situated a LEFT JOIN situated b ON a.game_id = b.game_id AND a.opp = b.team),
matched AS (SELECT *, {columns(MATCHUP)} FROM faced)"""

HOME_ML = "CASE WHEN home_moneyline > 0 THEN 100 / (home_moneyline + 100) ELSE -home_moneyline / (-home_moneyline + 100) END"
AWAY_ML = "CASE WHEN away_moneyline > 0 THEN 100 / (away_moneyline + 100) ELSE -away_moneyline / (-away_moneyline + 100) END"
OWN_POINTS = "CASE WHEN is_home = 1 THEN total_line / 2 + spread_line / 2 ELSE total_line / 2 - spread_line / 2 END"
OTHER_POINTS = "CASE WHEN is_home = 1 THEN total_line / 2 - spread_line / 2 ELSE total_line / 2 + spread_line / 2 END"
MARKET = {
    "implied_points": OWN_POINTS,
    "opp_implied_points": OTHER_POINTS,
    "implied_vs_avg": f"{OWN_POINTS} - pf_avg_5",
    "opp_implied_vs_avg": f"{OTHER_POINTS} - opp_pf_avg_5",
    "implied_total": "total_line",
    "recent_total_avg": "pf_avg_3 + pa_avg_3",
    "total_vs_recent": "total_line - (pf_avg_3 + pa_avg_3)",
    "home_ml_prob": HOME_ML,
    "away_ml_prob": AWAY_ML,
    "ml_prob": f"CASE WHEN is_home = 1 THEN {HOME_ML} ELSE {AWAY_ML} END",
    "opp_ml_prob": f"CASE WHEN is_home = 1 THEN {AWAY_ML} ELSE {HOME_ML} END",
}


def filled(source, medians_of="tg", where="true"):
    return f"""SELECT * REPLACE (
        coalesce(spread_line, (SELECT median(spread_line) FROM {medians_of} WHERE {where})) AS spread_line,
        coalesce(total_line, (SELECT median(total_line) FROM {medians_of} WHERE {where})) AS total_line) FROM {source}"""


PRICED = f"""
lined AS ({filled("matched")}),
priced AS (SELECT *, {columns(MARKET)} FROM lined)"""

INTERACTION = {
    "rest_form_interaction": "rest_days * form_ema_9",
    "bye_week_form": "bye_week * form_ema_9",
    "dome_pace": "dome_game * total_pace",
    "turf_pace": "turf_game * total_pace",
    "late_season_form": "late_season * form_ema_9",
    "playoff_race_form": "playoff_race * form_ema_9",
    "home_rest_advantage": "is_home * rest_advantage",
    "market_form_diff": "(implied_points - pf_avg_3) * form_ema_9",
}
FULL = f"""
full_rows AS (SELECT *, {columns(INTERACTION)} FROM priced)"""

TEAM_PLAIN = [
    "won", "opp_win_pct", "home_spread_cover", "margin", "close_game", "blowout_win", "blowout_loss",
    "off_efficiency", "def_efficiency",
]
TG_COLUMNS = [
    "game_id", "season", "week", "gameday", "gametime", "game_type", "team", "opp", "points_for",
    "points_against", "is_home", "location", "overtime", "spread_line", "total_line", "home_moneyline",
    "away_moneyline", "home_rest", "away_rest", "surface", "roof", "date", "season_week",
]
ALL_COLUMNS = [
    *TG_COLUMNS, *TEAM_COLUMNS, *TEAM_PLAIN, *SITUATION, *[f"opp_{c}" for c in OPPONENT], *MATCHUP,
    *MARKET, *INTERACTION,
]
WHOLE_NUMBERS = {
    "won", "margin", "close_game", "blowout_win", "blowout_loss", "rest_days", "rest_advantage",
    "short_rest", "long_rest", "bye_week", "month", "day_of_week", "games_played", "early_season",
    "mid_season", "late_season", "playoff_race", "dome_game", "outdoor_game", "turf_game", "neutral",
    "division_game", "prime_time", "home_rest_advantage", "home_spread_cover", "is_home", "roof", "surface",
}


def doubles_in(names):
    """Those of the feature names that hold doubles."""
    made = {*TEAM_COLUMNS, *TEAM_PLAIN, *SITUATION, *[f"opp_{c}" for c in OPPONENT], *MATCHUP, *MARKET, *INTERACTION}
    made |= {"spread_line", "total_line", "home_moneyline", "away_moneyline", "implied_spread"}
    return [n for n in names if n in made and n not in WHOLE_NUMBERS]


OUT = f"{GAMES},{OUTCOMES}"
RATE = f"{OUT},{RATED}"
ROLLED = f"{RATE},{TEAM}"
EVERYTHING = f"{ROLLED},{SITUATED},{MATCHED},{PRICED},{FULL}"


def tidy(names):
    return ", ".join(
        f'CASE WHEN round({n}, 6) = 0 THEN 0e0 ELSE round({n}, 6) END AS {n}' for n in names
    )


def query(body, doubles=(), ctes=GAMES):
    """One statement: the shared clauses, the body, and its doubles to six digits."""
    picked = f"* REPLACE ({tidy(doubles)})" if doubles else "*"
    return f"WITH {ctes},\nbody AS ({body})\nSELECT {picked} FROM body"


def picked(names, source, ctes, keys="game_id, team"):
    return query(f"SELECT {keys}, {', '.join(names)} FROM {source}", doubles_in(names), ctes)


def computed(made, source, ctes, doubles=None, keys="game_id, team"):
    doubles = list(made) if doubles is None else doubles
    return query(f"SELECT {keys}, {columns(made)} FROM {source}", doubles, ctes)


# short rolling means as three builders define them

SHORT_MEANS = {
    **means(SHORT),
    **{f"pd_avg_{n}": f"avg(points_for - points_against) {frame(n)}" for n in SHORT},
}
SPLIT_MEANS = {
    **means(SHORT),
    **{f"pd_avg_{n}": f"avg(points_for) {frame(n)} - avg(points_against) {frame(n)}" for n in SHORT},
}
SHORT_NAMES = [f"{p}_avg_{n}" for p in ("pf", "pa", "pd") for n in SHORT]


def strict_means(by=BY_TEAM):
    made = {}
    for n in SHORT:
        for p, c in (("pf", "points_for"), ("pa", "points_against")):
            made[f"{p}_avg_{n}"] = f"CASE WHEN count({c}) {frame(n, by)} = {n} THEN avg({c}) {frame(n, by)} END"
        made[f"pd_avg_{n}"] = f"({made[f'pf_avg_{n}']}) - ({made[f'pa_avg_{n}']})"
    return made


def built(order="date, game_id"):
    """The backtest feature rows with strict means and the lag over the opponent."""
    by = f"PARTITION BY team ORDER BY {order}"
    facing = {f"diff_{c}": f"{c} - lag({c}) OVER (PARTITION BY opp ORDER BY {order})" for c in SHORT_NAMES}
    return f"""{GAMES},
strict_rows AS (
  SELECT *, {columns(strict_means(by))},
         CASE WHEN is_home = 1 THEN spread_line ELSE -spread_line END AS spread_line_signed,
         points_for - points_against AS point_diff,
         CASE WHEN is_home = 1 THEN home_rest - away_rest ELSE away_rest - home_rest END AS rest_advantage
  FROM tg),
built AS (
  SELECT *, {columns(facing)},
         coalesce(point_diff + spread_line_signed > 0, false) AS beat_spread
  FROM strict_rows)"""


ADDED = f"""{GAMES},
short_rows AS (
  SELECT *, {columns(SPLIT_MEANS)},
         CASE WHEN is_home = 1 THEN home_rest - away_rest ELSE away_rest - home_rest END AS rest_advantage,
         CASE WHEN is_home = 1 THEN spread_line ELSE -spread_line END AS spread_line_signed
  FROM tg)"""


def game_rows(source="short_rows"):
    """Home row beside away row, with margin, label and differences."""
    return f"""
sides AS (
  SELECT a.*, b.team AS team_away, b.points_for AS points_for_away,
         {", ".join(f"a.{c} - b.{c} AS diff_{c}" for c in SHORT_NAMES)},
         a.points_for - b.points_for AS actual_spread,
         a.points_for - b.points_for + a.spread_line AS ats_margin
  FROM {source} a JOIN {source} b ON a.game_id = b.game_id AND a.is_home = 1 AND b.is_home = 0),
game_rows AS (
  SELECT *, CASE WHEN ats_margin > 0 THEN 1 ELSE 0 END AS beat_spread_home FROM sides)"""


def leveled(means_sql=None, partition=BY_TEAM):
    sql = columns(SHORT_MEANS).replace(BY_TEAM, partition)
    return f"{GAMES},\nshort_rows AS (SELECT *, {sql} FROM tg),{game_rows()}"


STAND_IN = f"""{GAMES},
stand_lines AS ({filled("tg")}),
stand_in AS (
  SELECT *, {OWN_POINTS} AS prediction,
         CASE WHEN is_home = 1 THEN {HOME_ML} ELSE {AWAY_ML} END AS prob
  FROM stand_lines)"""

LABELLED = f"""{STAND_IN},
labelled AS (
  SELECT a.game_id, a.season, a.prob,
         CASE WHEN a.points_for - b.points_for + a.spread_line > 0 THEN 1 ELSE 0 END AS label
  FROM stand_in a JOIN stand_in b ON a.game_id = b.game_id AND a.is_home = 1 AND b.is_home = 0
  WHERE a.points_for - b.points_for + a.spread_line <> 0)"""

PAIRED = f"""{STAND_IN},
predicted AS (
  SELECT a.game_id, a.prediction AS home_pred, b.prediction AS away_pred,
         a.prediction + b.prediction AS pred_total, a.prediction - b.prediction AS pred_spread,
         a.points_for AS home_actual, b.points_for AS away_actual,
         a.points_for + b.points_for AS actual_total, a.points_for - b.points_for AS actual_spread,
         a.spread_line, a.total_line,
         abs(a.prediction - a.points_for) AS ae_home, abs(b.prediction - b.points_for) AS ae_away,
         abs(a.prediction + b.prediction - (a.points_for + b.points_for)) AS ae_total,
         abs(a.prediction - b.prediction - (a.points_for - b.points_for)) AS ae_spread,
         coalesce(a.prediction - b.prediction > a.spread_line, false) AS pred_ats,
         coalesce(a.points_for - b.points_for > a.spread_line, false) AS actual_ats,
         coalesce(a.prediction + b.prediction > a.total_line, false) AS pred_over,
         coalesce(a.points_for + b.points_for > a.total_line, false) AS actual_over
  FROM stand_in a LEFT JOIN stand_in b ON a.game_id = b.game_id AND b.is_home = 0
  WHERE a.is_home = 1)"""

# Games from 2001 on without scores; lines filled with the medians of those before.
NOT_YET = GAMES.replace("\ntg AS (", "\nall_games AS (") + """,
tg AS (
  SELECT * REPLACE (CASE WHEN season < 2001 THEN points_for END AS points_for, CASE WHEN season < 2001 THEN points_against END AS points_against)
  FROM all_games)"""
UPCOMING = (
    f"{NOT_YET},{OUTCOMES},{RATED},{TEAM},{SITUATED},{MATCHED},"
    f"\nlined AS ({filled('matched', where='season < 2001')}),\npriced AS (SELECT *, {columns(MARKET)} FROM lined)"
)
HISTORY_RULE = """implied_points + 0.1e0 * coalesce(pf_avg_5 - opp_pa_avg_5, 0) + coalesce(form_ema_9, 0) + coalesce(sos_8, 0) + opp_win_pct
  + season_progress + 0.1e0 * coalesce(pf_std_16, 0) + coalesce(ats_record_10, 0) + coalesce(clutch_record, 0) + 0.01e0 * coalesce(off_efficiency_trend_5, 0)"""

# Deviations by roof: a group's variance weighs its games less one, that of all games weighs 20.
ROOFED = f"""{PAIRED},
roofs AS (
  SELECT p.*, t.roof, pred_spread - actual_spread AS ds, pred_total - actual_total AS dt
  FROM predicted p JOIN tg t ON t.game_id = p.game_id AND t.is_home = 1),
every AS (SELECT var_samp(ds) AS vs, var_samp(dt) AS vt FROM roofs),
noise AS (
  SELECT roof, n_games, sqrt((greatest(n_games - 1, 0) * coalesce(gs, 0) + 20 * vs) / (greatest(n_games - 1, 0) + 20)) AS s,
         sqrt((greatest(n_t - 1, 0) * coalesce(gt, 0) + 20 * vt) / (greatest(n_t - 1, 0) + 20)) AS t
  FROM (SELECT roof, count(ds) AS n_games, count(dt) AS n_t, var_samp(ds) AS gs, var_samp(dt) AS gt FROM roofs GROUP BY roof), every)"""

IN_TIME = "ORDER BY date, substr(md5(CAST(game_id AS VARCHAR)), 1, 2), game_id, -is_home"


def fold_of(k=4):
    size = f"(n // {k + 1})"
    return f"CASE WHEN pos < n - {k} * {size} THEN 0 ELSE CAST(1 + (pos - (n - {k} * {size})) // {size} AS INTEGER) END"


def placed(source):
    return f"SELECT *, row_number() OVER ({IN_TIME}) - 1 AS pos, count(*) OVER () AS n FROM {source}"


CV = f"""{STAND_IN},
guesses AS (
  SELECT *, prediction AS lines, avg(points_for) {frame(5)} AS recent_5, avg(points_for) {frame(16)} AS recent_16
  FROM stand_in),
places AS ({placed("(SELECT * FROM guesses WHERE points_for IS NOT NULL)")}),
folds AS (SELECT *, {fold_of()} AS fold FROM places),
cv AS (
  SELECT fold, 0 AS model_order, 'lines' AS model, avg(abs(lines - points_for)) AS mae FROM folds WHERE fold > 0 GROUP BY fold
  UNION ALL
  SELECT fold, 1, 'recent_5', avg(abs(recent_5 - points_for)) FROM folds WHERE fold > 0 GROUP BY fold
  UNION ALL
  SELECT fold, 2, 'recent_16', avg(abs(recent_16 - points_for)) FROM folds WHERE fold > 0 GROUP BY fold)"""
CV_SUMMARY = "SELECT model, model_order, avg(mae) AS mean_mae, stddev_pop(mae) AS std_mae FROM cv GROUP BY model, model_order"

SCAN = """SELECT threshold, avg(CASE WHEN (CASE WHEN prob >= threshold THEN 1 ELSE 0 END) = label THEN 1e0 ELSE 0e0 END) AS accuracy
FROM labelled CROSS JOIN (SELECT (350 + 5 * i) / 1000e0 AS threshold FROM range(61) t(i)) GROUP BY threshold"""


def roi(threshold, group=""):
    """Bets, hits, units and return at a threshold, stake 100 at odds of -110."""
    bet = f"(prob >= {threshold} OR prob <= 1e0 - {threshold})"
    hit = "(CASE WHEN prob >= 0.5e0 THEN 1 ELSE 0 END) = label"
    lead = f"{group}, " if group else ""
    tail = f"GROUP BY {group}" if group else ""
    return f"""SELECT {lead}n_bets, CASE WHEN n_bets > 0 THEN hits / CAST(n_bets AS DOUBLE) END AS hit_rate,
       hits * (10000e0 / 110) - (n_bets - hits) * 100e0 AS units,
       CASE WHEN n_bets > 0 THEN (hits * (10000e0 / 110) - (n_bets - hits) * 100e0) / (n_bets * 100e0) END AS roi
FROM (SELECT {lead}count(*) FILTER ({bet}) AS n_bets, count(*) FILTER ({bet} AND {hit}) AS hits FROM labelled {tail})"""


SEASON_REPORT = f"""{built()},
season_lines AS ({filled("built")}),
probable AS (
  SELECT season, beat_spread, CASE WHEN is_home = 1 THEN {HOME_ML} ELSE {AWAY_ML} END AS prob FROM season_lines),
called AS (
  SELECT season, coalesce(prob >= 0.55e0, false) = beat_spread AS good, (prob >= 0.6e0 OR prob <= 0.4e0) AS bet
  FROM probable),
counted AS (
  SELECT season, count(*) AS games, count(*) FILTER (bet) AS bets, avg(CAST(good AS INTEGER)) AS acc,
         count(*) FILTER (bet AND good) AS wins
  FROM called GROUP BY season),
report AS (
  SELECT season, games, bets, acc,
         CASE WHEN bets > 0 THEN wins / CAST(bets AS DOUBLE) END AS bet_acc,
         wins * (10000e0 / 110) - (bets - wins) * 100e0 AS profit,
         CASE WHEN bets > 0 THEN (wins * (10000e0 / 110) - (bets - wins) * 100e0) / (bets * 100e0) ELSE 0e0 END AS roi
  FROM counted)"""

FEATURE_WINDOWS = [1, 2, 3, 4, 5, 6, 8, 10]
PREPARED_NAMES = [
    "is_home", "neutral", "rest_days", "spread_line", "total_line", "implied_points", "implied_total",
    "roof", "surface",
    *[f"{p}_{n}" for p in ("pf_avg", "pf_std", "pa_avg", "pa_std", "opp_pf_avg", "opp_pa_avg", "opp_pf_std", "opp_pa_std") for n in FEATURE_WINDOWS],
    "off_vs_def", "def_vs_off", "games_played", "season_progress",
    "dome_game", "outdoor_game", "turf_game", "early_season", "late_season", "mid_season", "playoff_race",
]


FIXED_PRESENT = [
    "is_home", "neutral", "rest_days", "spread_line", "total_line", "roof", "surface", "implied_points", "implied_total",
    *[f"{p}_{n}" for p in ("pf_avg", "pf_std", "pa_avg", "pa_std", "opp_pf_avg", "opp_pa_avg") for n in FEATURE_WINDOWS],
    "off_vs_def", "def_vs_off", "dome_game", "outdoor_game", "turf_game", "season_progress",
]
CATEGORY_MARKS = {
    "market": ("spread", "total", "implied"),
    "form": ("pf_avg", "pa_avg", "win_streak", "recent_form"),
    "matchup": ("opp_", "off_vs", "def_vs"),
    "situational": ("rest", "neutral", "dome", "turf", "season_progress"),
}
CATEGORY_SIZES = {k: sum(any(m in c for m in marks) for c in PREPARED_NAMES) for k, marks in CATEGORY_MARKS.items()}
CATEGORY_SIZES["other"] = sum(not any(m in c for marks in CATEGORY_MARKS.values() for m in marks) for c in PREPARED_NAMES)
TG_TYPES = {
    **dict.fromkeys(["game_id", "team", "opp", "points_for", "points_against", "home_rest", "away_rest"], "bigint"),
    **dict.fromkeys(["season", "week", "is_home", "overtime"], "int"),
    **dict.fromkeys(["spread_line", "total_line", "home_moneyline", "away_moneyline"], "double"),
    **dict.fromkeys(["gameday", "date"], "date"),
}


def restarted():
    """Rolling means that start anew in the test seasons."""
    return leveled(partition="PARTITION BY season IN (2000, 2001), team ORDER BY date, game_id")


def oracles():
    diffs = [f"diff_{c}" for c in SHORT_NAMES]
    game_diffs = ", ".join(diffs)
    rolled_means = list(means())
    named_diffs = {f"diff_{c.replace('_avg_', '')}": c for c in SHORT_NAMES}
    lines = ["spread_line", "total_line"]
    part = "CASE WHEN season IN (2000, 2001) THEN 'test' ELSE 'train' END AS part"
    prepared = PREPARED_NAMES
    rest = "CASE WHEN is_home = 1 THEN home_rest ELSE away_rest END AS rest_days"
    rested = f"{GAMES},\nshort_rows AS (SELECT *, {columns(SHORT_MEANS)}, {rest} FROM tg),{game_rows()}"
    rest_diff = "(CASE WHEN true THEN home_rest - away_rest END) AS rest_advantage"
    stat_names = [*diffs, "rest_advantage", "spread_line_signed"]
    # column order of the game frame: spread_line_signed, differences, rest_advantage
    ordered = ["spread_line_signed", *diffs, "rest_advantage"]
    audited = [c for c in ALL_COLUMNS if c not in TG_COLUMNS]
    return {
        "schedule": query("SELECT * FROM games", ["spread_line", "total_line", "home_moneyline", "away_moneyline"]),
        "load_team_games": query("SELECT * FROM tg", ["spread_line", "total_line", "home_moneyline", "away_moneyline"]),
        "schedule_files": query(
            "SELECT * FROM tg WHERE season BETWEEN 1995 AND 1999",
            ["spread_line", "total_line", "home_moneyline", "away_moneyline"],
        ),
        "feature_file": query(
            f"SELECT game_id, team, date, gametime, roof, {game_diffs}, beat_spread FROM built", diffs, built()
        ),
        "feature_job": query(
            "SELECT game_id, team, date, season, beat_spread, diff_pf_avg_3, pd_avg_8 FROM built", ["diff_pf_avg_3", "pd_avg_8"], built()
        ),
        "column_profile": query(
            " UNION ALL ".join(
                f"SELECT {i} AS position, '{c}' AS feature, '{TG_TYPES.get(c, 'string')}' AS dtype, count({c}) AS known FROM tg"
                for i, c in enumerate(TG_COLUMNS)
            )
        ),
        "fixed_features": query(
            " UNION ALL ".join(
                f"SELECT {i} AS position, '{c}' AS feature, count({c}) AS known FROM full_rows" for i, c in enumerate(FIXED_PRESENT)
            ),
            (),
            EVERYTHING,
        ),
        "category_report": query(
            "SELECT category, CAST(features AS INTEGER) AS features, n_rows FROM (VALUES "
            + ", ".join(f"('{k}', {v})" for k, v in CATEGORY_SIZES.items())
            + ") AS sizes(category, features) CROSS JOIN (SELECT count(*) AS n_rows FROM tg)"
        ),
        "profile": query(
            "SELECT count(*) AS n_rows, min(season) AS first_season, max(season) AS last_season, "
            "count(DISTINCT team) AS teams, count(*) // 2 AS games FROM tg"
        ),
        "null_audit": query(
            "SELECT feature, nulls FROM (UNPIVOT (SELECT "
            + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in audited)
            + " FROM full_rows) ON COLUMNS(*) INTO NAME feature VALUE nulls) WHERE nulls > 0",
            (),
            EVERYTHING,
        ),
        "year_subset": query("SELECT season, count(*) AS n_rows FROM tg WHERE season BETWEEN 1995 AND 1999 GROUP BY season"),
        "season_list": query("SELECT DISTINCT season FROM tg"),
        "season_split": query(
            "SELECT game_id, team, season, CASE WHEN season < 1999 THEN 'train' ELSE 'test' END AS part FROM tg WHERE season <= 1999"
        ),
        "season_list_split": query(
            "SELECT game_id, team, season, CASE WHEN season IN (1997, 2000) THEN 'test' ELSE 'train' END AS part FROM tg"
        ),
        "expanding_split": query(
            "SELECT CASE WHEN season < 2000 THEN 'train' ELSE 'test' END AS part, season, count(*) AS n_rows "
            "FROM tg WHERE season <= 2000 AND points_for IS NOT NULL GROUP BY ALL"
        ),
        "expanding_seasons": query(
            "SELECT CASE WHEN tg.season < t.season THEN 'train' ELSE 'test' END AS part, t.season AS test_season, count(*) AS n_rows "
            "FROM tg JOIN (SELECT DISTINCT season FROM tg ORDER BY season OFFSET 3) t ON tg.season <= t.season "
            "WHERE points_for IS NOT NULL GROUP BY ALL"
        ),
        "drop_pushes": query(
            "SELECT game_id, actual_spread, spread_line AS spread_line_signed, ats_margin, beat_spread_home "
            "FROM game_rows WHERE coalesce(ats_margin <> 0, true)",
            ["spread_line_signed", "ats_margin"],
            leveled(),
        ),
        "median_values": query(
            "SELECT median(spread_line) AS spread_line, median(total_line) AS total_line, median(home_moneyline) AS home_moneyline FROM tg",
            [*lines, "home_moneyline"],
        ),
        "median_impute_all": query(f"SELECT game_id, team, spread_line, total_line FROM ({filled('tg')})", lines),
        "median_impute_train": query(
            f"SELECT game_id, team, spread_line, total_line FROM ({filled('tg', where='season < 2001')}) WHERE season = 2001", lines
        ),
        "default_fill": query(
            f"SELECT game_id, team, {PLACES}, coalesce(spread_line, 0e0) AS spread_line, coalesce(points_for, 0) AS points_for FROM tg",
            ["spread_line"],
        ),
        "select_features_stats": query(
            " UNION ALL ".join(
                f"SELECT {i} AS position, '{c}' AS feature, count({c}) / CAST(count(*) AS DOUBLE) AS nonnull_share, "
                f"stddev_samp({c}) AS std FROM kept"
                for i, c in enumerate(ordered)
            ),
            ["nonnull_share", "std"],
            f"{rested},\nkept AS (SELECT spread_line AS spread_line_signed, {game_diffs}, {rest_diff} FROM game_rows WHERE ats_margin <> 0)",
        ),
        "class_diversity": query("SELECT count(DISTINCT label) AS classes FROM labelled", (), LABELLED),
        "opponent_join_self": query(
            f"SELECT game_id, team, {', '.join(f'{c} - {c} AS {n}' for n, c in named_diffs.items())} FROM short_rows",
            list(named_diffs),
            ADDED,
        ),
        "opponent_join_game": query(
            f"SELECT a.game_id, a.team, {', '.join(f'a.{c} - b.{c} AS {n}' for n, c in named_diffs.items())} "
            "FROM short_rows a LEFT JOIN short_rows b ON a.game_id = b.game_id AND a.opp = b.team",
            list(named_diffs),
            ADDED,
        ),
        "opponent_join_date": query(
            "SELECT a.game_id, a.team, b.pf_avg_5 AS opp_pf_avg_5, b.pa_avg_5 AS opp_pa_avg_5 "
            "FROM short_rows a LEFT JOIN short_rows b ON a.opp = b.team AND a.date = b.date",
            ["opp_pf_avg_5", "opp_pa_avg_5"],
            ADDED,
        ),
        "game_level": query(
            f"SELECT game_id, team AS team_home, team_away, season AS season_home, actual_spread, ats_margin, "
            f"beat_spread_home, {game_diffs}, {rest_diff}, spread_line AS spread_line_signed FROM game_rows WHERE ats_margin <> 0",
            ["ats_margin", *diffs, "spread_line_signed"],
            rested,
        ),
        "home_anchor": query(
            "SELECT a.game_id, a.team AS team_home, a.points_for AS points_for_home, b.team AS team_away, b.points_for AS points_for_away "
            "FROM tg a LEFT JOIN tg b ON a.game_id = b.game_id AND b.is_home = 0 AND b.game_id % 3 <> 0 WHERE a.is_home = 1"
        ),
        "first_per_game": query("SELECT game_id, max(home_rest) AS home_rest, max(away_rest) AS away_rest FROM tg GROUP BY game_id"),
        "rolling_mean": computed(means(), "tg", GAMES),
        "rolling_std": computed(stds(), "tg", GAMES),
        "rolling_margin": computed(margins(), "tg", GAMES),
        "rolling_strict": computed({k: v for k, v in strict_means().items() if not k.startswith("pd")}, "tg", GAMES),
        "outcomes": query(
            "SELECT game_id, team, won, margin, close_game, blowout_win, blowout_loss, off_efficiency, def_efficiency, "
            "home_spread_cover, spread_line_signed FROM outcomes",
            ["off_efficiency", "def_efficiency", "spread_line_signed"],
            OUT,
        ),
        "corrected_efficiency": query(
            "SELECT game_id, team, CASE WHEN points_for + points_against <> 0 THEN points_for / CAST(points_for + points_against AS DOUBLE) END AS off_efficiency, "
            "CASE WHEN points_for + points_against <> 0 THEN points_against / CAST(points_for + points_against AS DOUBLE) END AS def_efficiency FROM tg",
            ["off_efficiency", "def_efficiency"],
        ),
        "form_decay": computed(forms(), "outcomes", OUT),
        "schedule_strength": computed({"opp_win_pct": "opp_win_pct", **SCHEDULE}, "rated", RATE),
        "schedule_strength_as_of": computed(
            {"opp_win_pct": "opp_win_pct", **SCHEDULE},
            "as_of",
            f"{OUT},\nas_of AS (SELECT *, avg(won) OVER (PARTITION BY season, opp ORDER BY date RANGE BETWEEN UNBOUNDED PRECEDING "
            "AND INTERVAL 1 DAY PRECEDING) AS opp_win_pct FROM outcomes)",
        ),
        "cover_rate": computed({"home_spread_cover": "home_spread_cover", **COVER}, "outcomes", OUT, list(COVER)),
        "clutch": computed(CLUTCH, "outcomes", OUT),
        "blowout_rate": computed(BLOWOUT, "outcomes", OUT),
        "efficiency_trend": computed(trends(), "outcomes", OUT),
        "games_played": computed({"games_played": SITUATION["games_played"]}, "tg", GAMES, []),
        "prev_vs_opp": query(f"SELECT game_id, team, {game_diffs} FROM built", diffs, built()),
        "prev_vs_opp_input_order": query(
            "SELECT game_id, team, pf_avg_3, diff_pf_avg_3, diff_pd_avg_8 FROM built",
            ["pf_avg_3", "diff_pf_avg_3", "diff_pd_avg_8"],
            built("-is_home, date, game_id"),
        ),
        "team_features": picked([*TEAM_COLUMNS, *TEAM_PLAIN], "team_rows", ROLLED),
        "team_features_split": picked([*TEAM_COLUMNS, *TEAM_PLAIN], "team_rows", ROLLED),
        "matchup_date": query(
            "SELECT a.game_id, a.team, b.pf_avg_5 AS opp_pf_avg_5, b.form_ema_9 AS opp_form_ema_9, a.pf_avg_5 - b.pa_avg_5 AS off_vs_def, "
            "a.pf_avg_5 + a.pa_avg_5 - (b.pf_avg_5 + b.pa_avg_5) AS pace_differential, a.form_ema_9 - b.form_ema_9 AS form_diff, "
            "(a.pf_std_5 + a.pa_std_5) / 2 - (b.pf_std_5 + b.pa_std_5) / 2 AS volatility_diff "
            "FROM team_rows a LEFT JOIN team_rows b ON a.opp = b.team AND a.date = b.date",
            ["opp_pf_avg_5", "opp_form_ema_9", "off_vs_def", "pace_differential", "form_diff", "volatility_diff"],
            ROLLED,
        ),
        "situational": query(
            f"SELECT game_id, team, {PLACES}, {columns(SITUATION)} FROM tg", ["season_progress"]
        ),
        "matchup": picked([*[f"opp_{c}" for c in OPPONENT], *MATCHUP], "matched", f"{ROLLED},{SITUATED},{MATCHED}"),
        "market": picked([*lines, *MARKET], "priced", f"{ROLLED},{SITUATED},{MATCHED},{PRICED}"),
        "interactions": picked(list(INTERACTION), "full_rows", EVERYTHING),
        "all_features": query(f"SELECT {', '.join(ALL_COLUMNS)} FROM full_rows", doubles_in(ALL_COLUMNS), EVERYTHING),
        "add_features": query(
            f"SELECT game_id, team, {', '.join(SHORT_NAMES)}, rest_advantage, spread_line_signed FROM short_rows",
            [*SHORT_NAMES, "spread_line_signed"],
            ADDED,
        ),
        "build_features": query(
            f"SELECT game_id, team, spread_line_signed, point_diff, {', '.join(SHORT_NAMES)}, rest_advantage, beat_spread FROM built",
            [*SHORT_NAMES, "spread_line_signed"],
            built(),
        ),
        "team_rolling": computed({"point_diff_game": "points_for - points_against", **SHORT_MEANS}, "tg", GAMES, list(SHORT_MEANS)),
        "prepare_games": query(
            f"SELECT game_id, {part}, beat_spread_home, {game_diffs} FROM game_rows WHERE ats_margin <> 0", diffs, leveled()
        ),
        "prepare_games_restart": query(
            f"SELECT game_id, {part}, beat_spread_home, {game_diffs} FROM game_rows WHERE ats_margin <> 0", diffs, restarted()
        ),
        "prepare_data": query(
            f"SELECT game_id, team, CASE WHEN season < 2001 THEN 'train' ELSE 'test' END AS part, points_for, "
            f"spread_line AS implied_spread, {', '.join('CAST(rest_days AS DOUBLE) AS rest_days' if c == 'rest_days' else c for c in prepared)} FROM full_rows WHERE season <= 2001",
            ["implied_spread", "rest_days", *doubles_in(prepared)],
            EVERYTHING,
        ),
        "chronological": query("SELECT game_id, team, date FROM tg"),
        "team_head": query(
            f"SELECT game_id, team, opp, date, points_for, avg(points_for) {frame(3)} AS pf_avg_3 FROM tg WHERE team = 20 ORDER BY date, game_id LIMIT 5",
            ["pf_avg_3"],
        ),
        "time_folds": query(f"SELECT game_id, team, {fold_of()} AS fold FROM ({placed('tg')})"),
        "contiguous_folds": query(
            f"SELECT game_id, team, CAST(CASE WHEN pos < (n % 3) * (n // 3 + 1) THEN pos // (n // 3 + 1) "
            f"ELSE (pos - n % 3) // (n // 3) END AS INTEGER) AS block FROM ({placed('tg')})"
        ),
        "stratified_split": query(
            "SELECT game_id, label, row_number() OVER (PARTITION BY label ORDER BY ((game_id + 42) % 1000003 * 2654435761) % 1000003, game_id) "
            "<= floor(count(*) OVER (PARTITION BY label) * 0.8e0) AS is_train FROM labelled",
            (),
            LABELLED,
        ),
        "one_hot": query(
            "SELECT game_id, team, CASE WHEN roof = 'closed' THEN 1 ELSE 0 END AS roof_closed, CASE WHEN roof = 'dome' THEN 1 ELSE 0 END AS roof_dome, "
            "CASE WHEN roof = 'outdoors' THEN 1 ELSE 0 END AS roof_outdoors, CASE WHEN surface = 'grass' THEN 1 ELSE 0 END AS surface_grass, "
            "CASE WHEN surface = 'turf' THEN 1 ELSE 0 END AS surface_turf FROM tg WHERE season = 2001"
        ),
        "team_errors": query(
            "SELECT avg(abs(prediction - points_for)) AS mae, sqrt(avg((prediction - points_for) ** 2)) AS rmse FROM stand_in",
            ["mae", "rmse"],
            STAND_IN,
        ),
        "game_eval": query(
            "SELECT * FROM predicted",
            ["home_pred", "away_pred", "pred_total", "pred_spread", "spread_line", "total_line", "ae_home", "ae_away", "ae_total", "ae_spread"],
            PAIRED,
        ),
        "game_metrics": query(
            "SELECT avg(ae_home) AS mae_home, avg(ae_away) AS mae_away, avg(ae_total) AS mae_total, avg(ae_spread) AS mae_spread, "
            "sqrt(avg((pred_total - actual_total) ** 2)) AS rmse_total, sqrt(avg((pred_spread - actual_spread) ** 2)) AS rmse_spread, "
            "avg(CAST(pred_ats = actual_ats AS INTEGER)) AS ats_accuracy, corr(pred_spread, actual_spread) AS spread_correlation, "
            "avg(CAST(pred_over = actual_over AS INTEGER)) AS ou_accuracy, corr(pred_total, actual_total) AS total_correlation FROM predicted",
            ["mae_home", "mae_away", "mae_total", "mae_spread", "rmse_total", "rmse_spread", "ats_accuracy", "spread_correlation", "ou_accuracy", "total_correlation"],
            PAIRED,
        ),
        "cv_scores": query("SELECT fold, model_order, model, mae FROM cv", ["mae"], CV),
        "cv_summary": query(CV_SUMMARY, ["mean_mae", "std_mae"], CV),
        "best_model": query(f"{CV_SUMMARY} ORDER BY mean_mae, model_order LIMIT 1", ["mean_mae", "std_mae"], CV),
        "top_features": query(
            "SELECT * FROM ("
            + " UNION ALL ".join(f"SELECT {i} AS idx, '{c}' AS feature, round(abs(corr({c}, points_for)), 6) AS importance FROM short_rows" for i, c in enumerate(SHORT_NAMES))
            + ") ORDER BY importance DESC, idx LIMIT 4",
            ["importance"],
            leveled(),
        ),
        "vote_blend": query(
            f"SELECT game_id, team, 0.6e0 * prediction + 0.3e0 * avg(points_for) {frame(5)} + 0.1e0 * avg(points_for) {frame(16)} AS prediction FROM stand_in",
            ["prediction"],
            STAND_IN,
        ),
        "threshold_scan": query(SCAN, ["threshold", "accuracy"], LABELLED),
        "best_threshold": query(f"SELECT * FROM ({SCAN}) ORDER BY accuracy DESC, threshold LIMIT 1", ["threshold", "accuracy"], LABELLED),
        "roi_report": query(roi("0.6e0"), ["hit_rate", "units", "roi"], LABELLED),
        "roi_by_season": query(roi("0.6e0", "season"), ["hit_rate", "units", "roi"], LABELLED),
        "roi_two_level": query(
            f"SELECT 0.6e0 AS threshold, * FROM ({roi('0.6e0')}) UNION ALL SELECT 0.65e0, * FROM ({roi('0.65e0')})",
            ["threshold", "hit_rate", "units", "roi"],
            LABELLED,
        ),
        "season_backtest": query("SELECT * FROM report", ["acc", "bet_acc", "profit", "roi"], SEASON_REPORT),
        "backtest_summary": query(
            "SELECT avg(acc) AS avg_acc, avg(roi) AS avg_roi, sum(profit) AS total_profit FROM report",
            ["avg_acc", "avg_roi", "total_profit"],
            SEASON_REPORT,
        ),
        "format_predictions": query(
            "SELECT game_id, round(home_pred, 1) AS home_pred, round(away_pred, 1) AS away_pred, round(pred_spread, 1) AS pred_spread, "
            "round(pred_spread - 1.96e0 * s, 1) AS spread_low, round(pred_spread + 1.96e0 * s, 1) AS spread_high, "
            "round(pred_total, 1) AS pred_total, round(pred_total - 1.96e0 * t, 1) AS total_low, round(pred_total + 1.96e0 * t, 1) AS total_high, "
            "abs(pred_spread - spread_line) / s AS confidence FROM predicted CROSS JOIN (SELECT stddev_samp(pred_spread - actual_spread) AS s, "
            "stddev_samp(pred_total - actual_total) AS t FROM predicted)",
            ["home_pred", "away_pred", "pred_spread", "spread_low", "spread_high", "pred_total", "total_low", "total_high", "confidence"],
            PAIRED,
        ),
        "format_predictions_grouped": query(
            "SELECT game_id, r.roof, n_games, round(home_pred, 1) AS home_pred, round(away_pred, 1) AS away_pred, round(pred_spread, 1) AS pred_spread, "
            "round(pred_spread - 1.96e0 * s, 1) AS spread_low, round(pred_spread + 1.96e0 * s, 1) AS spread_high, "
            "round(pred_total, 1) AS pred_total, round(pred_total - 1.96e0 * t, 1) AS total_low, round(pred_total + 1.96e0 * t, 1) AS total_high, "
            "abs(pred_spread - spread_line) / s AS confidence FROM roofs r JOIN noise n ON r.roof IS NOT DISTINCT FROM n.roof",
            ["home_pred", "away_pred", "pred_spread", "spread_low", "spread_high", "pred_total", "total_low", "total_high", "confidence"],
            ROOFED,
        ),
        "score_from_state": query(
            f"SELECT game_id, season, week, date, team, opp, is_home, points_for, spread_line, total_line, {HISTORY_RULE} AS prediction "
            "FROM priced WHERE season >= 2001",
            [*lines, "prediction"],
            UPCOMING,
        ),
        "bundle_reload": query("SELECT season, count(*) AS n_rows, count(*) AS n_equal FROM tg WHERE season = 2001 GROUP BY season"),
        "season_sink": query(
            "SELECT game_id, team, season, points_for, beat_spread, diff_pf_avg_3, pd_avg_8 FROM built",
            ["diff_pf_avg_3", "pd_avg_8"],
            built(),
        ),
        "missing_flags": query(
            "SELECT game_id, team, "
            + ", ".join(f"coalesce({c}, 0e0) AS filled_{c}, CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END AS filled_{c}_missing" for c in (*lines, "home_moneyline", "away_moneyline"))
            + " FROM tg",
        ),
        "opponent_join_date_split": query(
            "SELECT a.game_id, a.team, b.pf_avg_5 AS opp_pf_avg_5, b.pa_avg_5 AS opp_pa_avg_5 "
            "FROM short_rows a LEFT JOIN short_rows b ON a.opp = b.team AND a.date = b.date",
            ["opp_pf_avg_5", "opp_pa_avg_5"],
            ADDED,
        ),
        "upcoming_predictions": query(
            "SELECT game_id, season, week, date, team, opp, is_home, points_for, spread_line, total_line, prediction FROM stand_in "
            "WHERE points_for IS NULL",
            [*lines, "prediction"],
            STAND_IN,
        ),
        "upcoming_formatted": query(
            "SELECT game_id, round(home_pred, 1) AS home_pred, round(away_pred, 1) AS away_pred, round(pred_spread, 1) AS pred_spread, "
            "round(pred_spread - 1.96e0 * s, 1) AS spread_low, round(pred_spread + 1.96e0 * s, 1) AS spread_high, "
            "round(pred_total, 1) AS pred_total, round(pred_total - 1.96e0 * t, 1) AS total_low, round(pred_total + 1.96e0 * t, 1) AS total_high, "
            "abs(pred_spread - spread_line) / s AS confidence FROM predicted CROSS JOIN (SELECT stddev_samp(pred_spread - actual_spread) AS s, "
            "stddev_samp(pred_total - actual_total) AS t FROM predicted) WHERE home_actual IS NULL",
            ["home_pred", "away_pred", "pred_spread", "spread_low", "spread_high", "pred_total", "total_low", "total_high", "confidence"],
            PAIRED,
        ),
        "ridge_line": query(
            "SELECT sxy / (sxx + 1) AS coefficient, my - sxy / (sxx + 1) * mx AS intercept FROM (SELECT regr_sxy(points_for, total_line) AS sxy, "
            "regr_sxx(points_for, total_line) AS sxx, regr_avgx(points_for, total_line) AS mx, regr_avgy(points_for, total_line) AS my FROM tg)",
            ["coefficient", "intercept"],
        ),
    }

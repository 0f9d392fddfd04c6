"""Hand-made schedules for small tests."""

from teamlines.schema import SCHEDULE
from teamlines.sources.schedules import to_team_games

SMALL = "/root/testdata/sf0.001"

DEFAULTS = dict(
    season=2020, week=1, gameday=None, gametime="13:00", game_type="REG", home_team="A", away_team="B",
    home_score=None, away_score=None, location="Home", overtime=0, spread_line=0.5, total_line=40.0,
    home_moneyline=-110.0, away_moneyline=100.0, home_rest=7, away_rest=7, surface="grass", roof="dome",
)


def schedule(spark, games):
    """Games from partial dicts; ids and dates count up where not given."""
    rows = []
    for i, game in enumerate(games):
        row = {**DEFAULTS, "game_id": f"g{i:03d}", "gameday": f"2020-09-{i + 1:02d}", **game}
        rows.append(tuple(row[name] for name in SCHEDULE.names))
    return spark.createDataFrame(rows, SCHEDULE)


def one_team(spark, scores, against=None):
    """Team A at home against ever new opponents, with the given scores."""
    against = against or [0] * len(scores)
    games = [
        dict(home_score=s, away_score=None if s is None else a, away_team=f"B{i}")
        for i, (s, a) in enumerate(zip(scores, against))
    ]
    return to_team_games(schedule(spark, games))


def values(df, column, team="A"):
    rows = df.where(f"team = '{team}'").orderBy("date", "game_id").select(column).collect()
    return [None if r[0] is None else round(float(r[0]), 4) for r in rows]


def rows_of(df, columns=None):
    """All rows as a sorted list, doubles rounded."""
    picked = sorted(columns or df.columns)

    def plain(v):
        return round(v, 6) + 0.0 if isinstance(v, float) else v

    return sorted((tuple(map(plain, r)) for r in df.select(*picked).collect()), key=repr)

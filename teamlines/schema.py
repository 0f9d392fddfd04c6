"""Column names and types shared by every stage."""

from pyspark.sql import types as T

SCHEDULE = T.StructType(
    [
        T.StructField("game_id", T.StringType(), False),
        T.StructField("season", T.IntegerType(), False),
        T.StructField("week", T.IntegerType(), False),
        T.StructField("gameday", T.StringType(), False),
        T.StructField("gametime", T.StringType()),
        T.StructField("game_type", T.StringType(), False),
        T.StructField("home_team", T.StringType(), False),
        T.StructField("away_team", T.StringType(), False),
        T.StructField("home_score", T.LongType()),
        T.StructField("away_score", T.LongType()),
        T.StructField("location", T.StringType()),
        T.StructField("overtime", T.IntegerType()),
        T.StructField("spread_line", T.DoubleType()),
        T.StructField("total_line", T.DoubleType()),
        T.StructField("home_moneyline", T.DoubleType()),
        T.StructField("away_moneyline", T.DoubleType()),
        T.StructField("home_rest", T.LongType()),
        T.StructField("away_rest", T.LongType()),
        T.StructField("surface", T.StringType()),
        T.StructField("roof", T.StringType()),
    ]
)

SCHEDULE_COLUMNS = SCHEDULE.names

TEAM_GAME_COLUMNS = [
    "game_id", "season", "week", "gameday", "gametime", "game_type",
    "team", "opp", "points_for", "points_against", "is_home",
    "location", "overtime", "spread_line", "total_line",
    "home_moneyline", "away_moneyline", "home_rest", "away_rest",
    "surface", "roof", "date", "season_week",
]

# The game types that count and the seasons read by default.
GAME_TYPES = ["REG", "POST"]
DEFAULT_YEARS = list(range(2009, 2025))

# Chronological order of one team's games; game_id breaks ties on a date.
ORDER = ("date", "game_id")

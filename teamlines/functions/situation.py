"""Columns that describe the setting of a game: rest, calendar, venue, broadcast slot."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from teamlines.functions.outcome import flag

# Day and week limits, venue words and evening kick-off times.
SHORT_REST, LONG_REST, BYE_REST = 5, 10, 13
EARLY_WEEKS, MID_WEEKS, LATE_WEEKS = (None, 4), (5, 13), (14, 18)
PLAYOFF_RACE_WEEK, PLAYOFF_RACE_TYPE = 15, "REG"
SEASON_GAMES = 17
INDOOR_ROOFS = ["dome", "closed"]
OUTDOOR_ROOF = "outdoors"
TURF_SURFACE = "turf"
NEUTRAL_WORD = "neutral"
PRIME_TIMES = "20:20|20:15|17:00"
UNKNOWN = "UNK"


def rest_days() -> Column:
    return F.when(F.col("is_home") == 1, F.col("home_rest")).otherwise(F.col("away_rest"))


def rest_advantage(variant="home") -> Column:
    """Rest difference of the two sides.

    ``home``: home minus away on both rows. ``filled``: missing rest counts as 0 and away
    rows change sign. ``own``: away rows change sign, missing stays missing.
    """
    home, away = F.col("home_rest"), F.col("away_rest")
    if variant == "home":
        return home - away
    if variant == "filled":
        home, away = F.coalesce(home, F.lit(0)), F.coalesce(away, F.lit(0))
    elif variant != "own":
        raise ValueError(f"unknown rest variant {variant!r}")
    return F.when(F.col("is_home") == 0, away - home).otherwise(home - away)


def weeks(low, high) -> Column:
    week = F.col("week")
    return flag(week <= high) if low is None else flag(week.between(low, high))


def or_unknown(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(UNKNOWN))


def prime_time() -> Column:
    return flag(F.col("gametime").rlike(PRIME_TIMES))


def situation_columns(columns) -> dict:
    """The situational columns that need nothing but the row itself, by name."""
    rest = rest_days()
    day = F.to_date("gameday")
    roof, surface = F.lower("roof"), F.lower("surface")
    return {
        "rest_days": rest,
        "rest_advantage": rest_advantage("home"),
        "short_rest": flag(rest <= SHORT_REST),
        "long_rest": flag(rest >= LONG_REST),
        "bye_week": flag(rest >= BYE_REST),
        "month": F.month(day),
        "day_of_week": F.weekday(day),
        "early_season": weeks(*EARLY_WEEKS),
        "mid_season": weeks(*MID_WEEKS),
        "late_season": weeks(*LATE_WEEKS),
        "playoff_race": flag(
            (F.col("week") >= PLAYOFF_RACE_WEEK) & (F.col("game_type") == PLAYOFF_RACE_TYPE)
        ),
        "dome_game": flag(roof.isin(*INDOOR_ROOFS)),
        "outdoor_game": flag(roof == OUTDOOR_ROOF),
        "turf_game": flag(surface == TURF_SURFACE),
        "neutral": flag(F.lower("location").contains(NEUTRAL_WORD)),
        "division_game": F.lit(0),
        "prime_time": prime_time() if "gametime" in columns else F.lit(0),
    }

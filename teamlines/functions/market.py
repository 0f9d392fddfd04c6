"""Columns derived from betting lines and moneylines."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def by_side(home: Column, away: Column) -> Column:
    return F.when(F.col("is_home") == 1, home).otherwise(away)


def implied_points(line: Column | None = None, total: Column | None = None):
    """Points the lines imply for the row's own side and for the other side."""
    half_line = (F.col("spread_line") if line is None else line) / 2.0
    half_total = (F.col("total_line") if total is None else total) / 2.0
    home, away = half_total + half_line, half_total - half_line
    return by_side(home, away), by_side(away, home)


def moneyline_probability(odds: Column) -> Column:
    """Win probability implied by American odds; both denominators are at least 100."""
    return F.when(odds > 0, 100 / (odds + 100)).otherwise(-odds / (100 - odds))


def win_units(wager: float, odds: int) -> float:
    """Profit of one winning bet at American odds."""
    return wager * 100 / abs(odds) if odds < 0 else wager * odds / 100

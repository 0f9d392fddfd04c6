"""Columns that describe one team's result in one game."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Point margins and the bounds of the efficiency denominator.
CLOSE_MARGIN = 7
BLOWOUT_MARGIN = 14
EFFICIENCY_FLOOR, EFFICIENCY_CEILING = 0.01, 0.99


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0; missing counts as 0."""
    return F.when(condition, 1).otherwise(0)


def point_diff() -> Column:
    return F.col("points_for") - F.col("points_against")


def won() -> Column:
    return flag(F.col("points_for") > F.col("points_against"))


def margin() -> Column:
    return F.abs(point_diff())


def efficiency(points: str, corrected=False) -> Column:
    """Points per clipped point sum; ``corrected`` gives the plain share of the points."""
    both = F.col("points_for") + F.col("points_against")
    if corrected:
        return F.try_divide(F.col(points).cast("double"), both)
    clipped = F.least(F.greatest(both.cast("double"), F.lit(EFFICIENCY_FLOOR)), F.lit(EFFICIENCY_CEILING))
    return F.when(both.isNotNull(), F.col(points) / clipped)


def home_spread_cover() -> Column:
    """Did the home side's margin beat the line, as each row's side tells it; missing is false.

    The away row compares the home margin with the negated line.
    """
    line = F.col("spread_line")
    home, away = point_diff() > line, -point_diff() > -line
    return F.coalesce(F.when(F.col("is_home") == 1, home).otherwise(away), F.lit(False))


def spread_line_signed() -> Column:
    """The line from the row's own side: negated on away rows."""
    return F.when(F.col("is_home") == 1, F.col("spread_line")).otherwise(-F.col("spread_line"))


def beat_spread(diff="point_diff", line="spread_line_signed") -> Column:
    """Margin plus signed line above zero; missing is false."""
    return F.coalesce(F.col(diff) + F.col(line) > 0, F.lit(False))


def outcome_columns(corrected_efficiency=False) -> dict:
    """The outcome columns of one row, by name."""
    diff = point_diff()
    return {
        "won": won(),
        "margin": margin(),
        "close_game": flag(margin() <= CLOSE_MARGIN),
        "blowout_win": flag(diff >= BLOWOUT_MARGIN),
        "blowout_loss": flag(-diff >= BLOWOUT_MARGIN),
        "off_efficiency": efficiency("points_for", corrected_efficiency),
        "def_efficiency": efficiency("points_against", corrected_efficiency),
    }

"""Expressions over a team's previous games; the current game is never in the frame.

Means, deviations and shares over the last n games come from running totals: the total
before this game minus the total before the game n rows back. A row then costs the same
whatever the window length, where a sliding frame would add up its rows anew each time.
The totals are exact for whole numbers, which scores and flags are.
"""

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# Window lengths, decay rates and look-back lengths.
WINDOWS = [1, 2, 3, 4, 5, 6, 8, 10, 16]
SHORT_WINDOWS = [3, 5, 8]
DECAYS = [0.9, 0.8, 0.7]
FORM_GAMES = 10
TREND_GAMES = 5
CLUTCH_GAMES = 10
SCHEDULE_WINDOWS = [3, 8]
COVER_WINDOWS = [5, 10]
BLOWOUT_GAMES = 8

RUN, LAG = "_run", "_lag_"


def add_recent(df: DataFrame, window: WindowSpec, measures: dict, squares=(), carried=(), lags=WINDOWS):
    """``df`` with the running totals of ``measures`` and the rows ``lags`` back packed beside it.

    ``squares`` names measures whose squares are totalled too, ``carried`` columns whose
    single past values are wanted. :func:`total` and the rest read the packed columns.
    """
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    totals = []
    for name, value in measures.items():
        totals.append(F.coalesce(F.sum(value).over(before), F.lit(0)).alias(name))
        totals.append(F.count(value).over(before).alias(f"{name}_n"))
        if name in squares:
            totals.append(F.coalesce(F.sum(value * value).over(before), F.lit(0)).alias(f"{name}_sq"))
    packed = list(carried)
    if totals:
        df = df.withColumn(RUN, F.struct(*totals))
        packed.append(RUN)
    row = F.struct(*packed)
    return df.select("*", *[F.lag(row, n).over(window).alias(f"{LAG}{n}") for n in sorted(set(lags))])


def drop_recent(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c == RUN or c.startswith(LAG)])


def total(name: str, n: int) -> str:
    """Sum over the last ``n`` games, 0 if nothing was observed; SQL text, as the next two."""
    return f"({RUN}.{name} - coalesce({LAG}{n}.{RUN}.{name}, 0))"


def observed(name: str, n: int) -> str:
    """Number of observed values among the last ``n`` games."""
    return total(f"{name}_n", n)


def past(name: str, k: int) -> str:
    """The carried value ``k`` games ago."""
    return f"{LAG}{k}.{name}"


def rolling_mean(name: str, n: int) -> Column:
    """Mean of the observed values among the last ``n`` games, given at least one."""
    return F.expr(f"try_divide({total(name, n)}, {observed(name, n)})")


def rolling_std(name: str, n: int) -> Column:
    """Sample deviation of the observed values; NULL below two."""
    count, value, square = observed(name, n), total(name, n), total(f"{name}_sq", n)
    spread = f"greatest({count} * {square} - {value} * {value}, 0)"
    return F.expr(f"sqrt(try_divide({spread}, {count} * ({count} - 1)))")


def strict_mean(name: str, n: int) -> Column:
    """Mean of the last ``n`` games, NULL unless all ``n`` are observed."""
    return F.expr(f"CASE WHEN {observed(name, n)} = {n} THEN {total(name, n)} / {n} END")


def decayed_form(name: str, decay: float, games=FORM_GAMES) -> Column:
    """Weighted mean of the last ``games`` values, the latest weighing most.

    NULL until a team has that many earlier games.
    """
    weights = [decay**k for k in range(games)]
    weighted = " + ".join(f"{weight!r}D * {past(name, k + 1)}" for k, weight in enumerate(weights))
    return F.expr(f"({weighted}) / {sum(weights)!r}D")


def trend(name: str, games=TREND_GAMES) -> Column:
    """Least-squares slope per game over the last ``games`` values; NULL below that many.

    With equal steps the slope is a fixed weighting of the values by their distance from
    the middle of the frame.
    """
    centre = (games - 1) / 2
    scale = sum((i - centre) ** 2 for i in range(games))
    return F.expr(" + ".join(f"{(i - centre) / scale!r}D * {past(name, games - i)}" for i in range(games)))


def clutch(games=CLUTCH_GAMES) -> Column:
    """Share of recent close games won; NULL on a team's first row, 0 without close games."""
    share = f"{total('close_win', games)} / greatest({total('close_game', games)}, 1)"
    return F.expr(f"CASE WHEN {LAG}1 IS NOT NULL THEN {share} END")


def sliding_mean(value: Column, window: WindowSpec, n: int) -> Column:
    """Mean over the last ``n`` rows by a sliding frame, for values that are not whole numbers."""
    return F.avg(value).over(window.rowsBetween(-n, -1))

"""Team rows to game rows with margins, cover label and home-minus-away differences."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teamlines.functions.windows import SHORT_WINDOWS
from teamlines.operators.joins import pair_sides
from teamlines.operators.rolling import create_team_rolling_features
from teamlines.operators.splits import season_list_split

DIFFERENCES = [f"{p}_avg_{n}" for p in ("pf", "pa", "pd") for n in SHORT_WINDOWS]


def drop_pushes(games: DataFrame, keep_unplayed=False) -> DataFrame:
    """Games whose margin met the line exactly are removed.

    ``keep_unplayed`` keeps games without a margin, which then count as not covered.
    """
    return games.where(F.coalesce(F.col("ats_margin") != 0, F.lit(keep_unplayed)))


def to_game_level_with_diffs(team_games: DataFrame, keep_unplayed=False) -> DataFrame:
    """One row per game: both sides' columns, margin, label and matchup differences."""
    games = pair_sides(team_games)
    line = F.col("spread_line_home") if "spread_line_home" in games.columns else F.lit(0.0)
    margin = F.col("points_for_home") - F.col("points_for_away")
    games = games.withColumns(
        {"actual_spread": margin, "spread_line_signed": line, "ats_margin": margin + line}
    )
    made = {"beat_spread_home": F.when(F.col("ats_margin") > 0, 1).otherwise(0)}
    for f in DIFFERENCES:
        if f"{f}_home" in games.columns:
            made[f"diff_{f}"] = F.col(f"{f}_home") - F.col(f"{f}_away")
    if "rest_days_home" in games.columns:
        made["rest_advantage"] = F.col("rest_days_home") - F.col("rest_days_away")
    return drop_pushes(games, keep_unplayed).withColumns(made)


def candidate_features(columns) -> list:
    """The names a game frame offers to a learner."""
    names = [c for c in columns if c.startswith("diff_")]
    return names + [c for c in ("rest_advantage", "spread_line_signed") if c in columns]


def prepare_games_for_seasons(
    team_games: DataFrame, test_seasons, restart=False, keep_unplayed=False, hot_rows=None
):
    """Game-level train and test frames.

    By default a team's history runs on into the test seasons. ``restart`` computes the
    rolling columns of each part from its own rows only.
    """
    def games(rows):
        return to_game_level_with_diffs(rows, keep_unplayed)

    if restart:
        return tuple(
            games(create_team_rolling_features(part, hot_rows=hot_rows))
            for part in season_list_split(team_games, test_seasons)
        )
    rolled = create_team_rolling_features(team_games, hot_rows=hot_rows)
    listed = F.col("season_home").isin(*test_seasons)
    both = games(rolled)
    return both.where(~listed), both.where(listed)

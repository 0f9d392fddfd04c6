import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[i]) for i in (1, 0)]

from helpers import SMALL  # noqa: E402
from teamlines.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, name="teamlines-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def team_games(spark):
    """The derived team-games of the smallest tables, written once."""
    from teamlines.session import materialized
    from teamlines.sources.sample_tables import team_games

    return materialized(team_games(spark, SMALL))

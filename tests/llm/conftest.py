import pytest

from caseweek.session import build_session


@pytest.fixture(scope="session")
def spark():
    return build_session("local[4]", shuffle_partitions=4)

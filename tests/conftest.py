from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import local_session

    session = local_session("8", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def key_columns(state: str, metric: str, year: str = "2019-20") -> dict[str, object]:
    return {
        "scheme": "S", "geo_level": "state", "state_code": state, "district_code": None,
        "fin_year": year, "month": None, "metric": metric,
    }

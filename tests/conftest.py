from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roadstats.schemas import EVENT_SCHEMA  # noqa: E402
from roadstats.session import get_session, new_work_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[*]", app_name="roadstats-tests", shuffle_partitions=8)
    yield session


@pytest.fixture()
def work(spark):
    """A fresh folder under the session's shared checkpoint root."""
    return new_work_dir(spark, "test")


def ev(t, link, v=None, name="p", dn=5, orig="A", dest="B", x=None, s=None):
    """One event row in schema order; status rows default to -1 for x, s, v."""
    status = link in ("waiting_at_origin_node", "trip_end")
    default = -1.0 if status else 0.0
    return (
        name,
        dn,
        orig,
        dest,
        None if t is None else float(t),
        link,
        default if x is None else float(x),
        default if s is None else float(s),
        (-1.0 if status else None) if v is None else float(v),
    )


@pytest.fixture()
def events_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, EVENT_SCHEMA)

    return make

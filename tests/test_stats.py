"""Per-step and windowed statistics on inline rows (values from FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt

import pytest

from roadstats.operators.stats import link_stats, status_filter, windowed_stats
from tests.conftest import ev


def _by_key(rows, *key):
    return {tuple(r[k] for k in key): r for r in rows}


def test_link_stats_counts_and_means(events_df):
    df = events_df([ev(10, "I1I2", 12), ev(10, "I1I2", 18), ev(10, "I2I3", 20), ev(11, "I1I2", 14)])
    out = link_stats(df)
    assert out.columns == ["t", "link", "vcount", "vspeed"]
    rows = _by_key(out.collect(), "t", "link")
    assert (rows[(10.0, "I1I2")].vcount, rows[(10.0, "I1I2")].vspeed) == (2, 15.0)
    assert (rows[(10.0, "I2I3")].vcount, rows[(10.0, "I2I3")].vspeed) == (1, 20.0)
    assert (rows[(11.0, "I1I2")].vcount, rows[(11.0, "I1I2")].vspeed) == (1, 14.0)
    assert len(rows) == 3


def test_link_stats_drops_status_rows(events_df):
    df = events_df([ev(5, "I1I2", 13), ev(5, "waiting_at_origin_node"), ev(5, "trip_end")])
    rows = link_stats(df).collect()
    assert [(r.link, r.vcount, r.vspeed) for r in rows] == [("I1I2", 1, 13.0)]


def test_link_stats_filter_off_keeps_status(events_df):
    rows = link_stats(events_df([ev(5, "trip_end")]), status_links=()).collect()
    assert [(r.link, r.vcount) for r in rows] == [("trip_end", 1)]


def test_status_filter_is_three_valued(events_df):
    df = events_df([ev(1, None, 3.0), ev(1, "I1W1", 4.0), ev(1, "trip_end")])
    assert [r.link for r in status_filter(df).collect()] == ["I1W1"]
    assert status_filter(df, ()).count() == 3


def test_null_speed_counted_not_averaged(events_df):
    rows = link_stats(events_df([ev(1, "L", None), ev(1, "L", 10.0)])).collect()
    assert (rows[0].vcount, rows[0].vspeed) == (2, 10.0)


def test_null_t_is_a_group_in_link_stats_but_not_in_windows(events_df):
    df = events_df([ev(None, "L", 1.0), ev(3, "L", 2.0)])
    assert sorted((r.t is None, r.vcount) for r in link_stats(df).collect()) == [(False, 1), (True, 1)]
    assert [r.vcount for r in windowed_stats(df).collect()] == [1]


def test_windowed_30s(events_df):
    df = events_df([ev(t, "L", v) for t, v in [(0, 10), (15, 20), (29, 30), (30, 40), (59, 60)]])
    out = windowed_stats(df, window_seconds=30)
    assert out.columns == ["window_start", "window_end", "link", "vcount", "vspeed_avg", "vspeed_min", "vspeed_max"]
    rows = sorted(out.collect(), key=lambda r: r.window_start)
    epoch = dt.datetime(1970, 1, 1)
    assert [(r.window_start - epoch).total_seconds() for r in rows] == [0, 30]
    assert [(r.window_end - epoch).total_seconds() for r in rows] == [30, 60]
    first, second = rows
    assert (first.vcount, first.vspeed_min, first.vspeed_max, first.vspeed_avg) == (3, 10.0, 30.0, 20.0)
    assert (second.vcount, second.vspeed_min, second.vspeed_max) == (2, 40.0, 60.0)


def test_windowed_custom_size(events_df):
    df = events_df([ev(t, "L", v) for t, v in [(0, 10), (9, 20), (10, 30)]])
    rows = sorted(windowed_stats(df, window_seconds=10).collect(), key=lambda r: r.window_start)
    assert [r.vcount for r in rows] == [2, 1]


def test_windowed_excludes_status(events_df):
    df = events_df([ev(1, "L", 10), ev(1, "trip_end"), ev(2, "waiting_at_origin_node")])
    assert [r.link for r in windowed_stats(df).collect()] == ["L"]


def test_event_time_truncates_toward_zero_and_nan_is_null(events_df, spark):
    from pyspark.sql import functions as F

    from roadstats.functions.columns import event_time

    df = spark.createDataFrame([(5.9,), (-0.5,), (float("nan"),), (None,)], "t double")
    got = [r.s for r in df.select(F.unix_seconds(event_time("t")).alias("s")).collect()]
    assert got == [5, 0, None, None]


def test_windowed_rejects_bad_size(events_df):
    with pytest.raises(ValueError):
        windowed_stats(events_df([ev(1, "L", 1)]), window_seconds=0)

"""Read queries: argument checks, tie rules, empty tables, composite calls."""

from __future__ import annotations

import pytest

from roadstats.operators import queries as q
from roadstats.schemas import EVENT_SCHEMA, STATS_SCHEMA


@pytest.fixture()
def stats(spark):
    rows = [
        (10.0, "A", 2, 30.0),
        (15.0, "A", 4, 10.0),
        (20.0, "A", 4, 20.0),
        (10.0, "B", 4, 50.0),
        (1818.0, "B", 1, 40.0),
        (1820.0, "B", 3, 45.0),
        (1821.0, "B", 9, 1.0),
        (1819.0, "C", 2, 5.0),
        (5.0, "D", 1, None),
    ]
    return spark.createDataFrame(rows, STATS_SCHEMA)


@pytest.mark.parametrize("n", [0, -2])
def test_top_n_rejects_non_positive(stats, n):
    with pytest.raises(ValueError):
        q.top_n_congested(stats, n)
    with pytest.raises(ValueError):
        q.max_speed_delta(stats, n)
    with pytest.raises(ValueError):
        q.latest_n(stats, n)


def test_negative_tolerance(stats):
    with pytest.raises(ValueError):
        q.link_state_at(stats, 1820, tolerance=-0.1)


def test_link_state_range_includes_both_ends(stats):
    rows = {r.link: r for r in q.link_state_at(stats, 1820, tolerance=2).collect()}
    assert set(rows) == {"B", "C"}
    assert (rows["B"].t, rows["B"].vcount, rows["B"].vspeed) == (1820.0, 3, 45.0)
    assert rows["C"].t == 1819.0
    only_b = {r.link for r in q.link_state_at(stats, 1818, tolerance=0).collect()}
    assert only_b == {"B"}


def test_top_n_peak_ties_take_earliest_t_and_link_order(stats):
    rows = q.top_n_congested(stats, 3).collect()
    assert [(r.link, r.peak_vcount, r.argmax_t) for r in rows] == [("B", 9, 1821.0), ("A", 4, 15.0), ("C", 2, 1819.0)]


def test_avg_speed_order_and_null_speed(stats):
    rows = q.avg_speed_per_link(stats).collect()
    assert [r.link for r in rows] == ["B", "A", "C", "D"]
    d = rows[-1]
    assert d.avg_speed is None and d.samples == 1
    asc = q.avg_speed_per_link(stats, ascending=True).collect()
    assert [r.link for r in asc] == ["D", "C", "A", "B"]


def test_max_speed_delta(stats):
    rows = q.max_speed_delta(stats, 2).collect()
    assert [(r.link, r.delta) for r in rows] == [("B", 49.0), ("A", 20.0)]


def test_link_summary_and_detail(stats):
    (s,) = q.link_summary(stats, "A").collect()
    assert (s.samples, s.avg_speed, s.min_speed, s.max_speed, s.peak_vcount, s.first_t, s.last_t) == (3, 20.0, 10.0, 30.0, 4, 10.0, 20.0)
    assert q.link_summary(stats, "nope").count() == 0
    assert q.link_detail(stats, "nope") is None
    detail = q.link_detail(stats, "A")
    assert detail["link"] == "A"
    assert [r.t for r in detail["series"].collect()] == [10.0, 15.0, 20.0]
    assert q.link_summary_all(stats).count() == 4


def test_latest_and_counts(spark, stats):
    assert q.latest_t(stats).first().latest_t == 1821.0
    assert [(r.t, r.link) for r in q.latest_n(stats, 2, "t", ["link"]).collect()] == [(1821.0, "B"), (1820.0, "B")]
    assert [r.link for r in q.distinct_links(stats).collect()] == ["A", "B", "C", "D"]


def test_empty_tables(spark):
    stats = spark.createDataFrame([], STATS_SCHEMA)
    raw = spark.createDataFrame([], EVENT_SCHEMA)
    assert q.latest_t(stats).collect()[0].latest_t is None
    ov = q.overview(raw, stats).collect()
    assert [(r.raw_rows, r.current_t, r.active_links) for r in ov] == [(0, None, 0)]
    assert q.top_n_congested(stats).count() == 0
    checks = {r.check: (r.ok, r.detail) for r in q.volume_checks(raw, stats).collect()}
    assert checks == {"raw_data": (False, "0 docs (min 1)"), "stats": (False, "0 docs (min 1)")}


def test_overview_counts_null_link_group(spark, stats):
    extra = spark.createDataFrame([(7.0, None, 1, 3.0)], STATS_SCHEMA)
    raw = spark.createDataFrame([], EVENT_SCHEMA)
    (row,) = q.overview(raw, stats.unionByName(extra)).collect()
    assert row.active_links == 5 and row.current_t == 1821.0


def test_sample_row(stats):
    assert q.sample_row(stats).count() == 1


def test_link_history_source(spark, stats):
    from roadstats.schemas import WINDOWED_SCHEMA

    windowed = spark.createDataFrame([], WINDOWED_SCHEMA)
    assert q.link_history(stats, windowed, "A").count() == 3
    assert q.link_history(stats, windowed, "A", "windowed").count() == 0
    with pytest.raises(ValueError):
        q.link_history(stats, windowed, "A", "raw")


def test_ties_break_on_link_name(spark):
    rows = [(1.0, "Z", 1, 10.0), (2.0, "Z", 1, 20.0), (1.0, "M", 1, 30.0), (2.0, "M", 1, 40.0), (1.0, "A", 1, 5.0)]
    stats = spark.createDataFrame(rows, STATS_SCHEMA)
    assert [r.link for r in q.max_speed_delta(stats, 2).collect()] == ["M", "Z"]  # equal deltas of 10
    assert [r.link for r in q.latest_n(stats, 2, "t", ["link"]).collect()] == ["M", "Z"]  # equal t = 2
    same_avg = spark.createDataFrame([(1.0, "B", 1, 7.0), (1.0, "A", 1, 7.0)], STATS_SCHEMA)
    assert [r.link for r in q.avg_speed_per_link(same_avg).collect()] == ["A", "B"]


NAN = float("nan")


def _nan_rows(spark):
    rows = [(1.0, "A", 2, 10.0), (2.0, "A", 3, NAN), (NAN, "A", 9, 5.0), (3.0, "B", 1, 7.0), (NAN, "C", 4, NAN), (None, "D", 1, None)]
    return spark.createDataFrame(rows, STATS_SCHEMA)


def test_nan_stands_below_numbers(spark):
    stats = _nan_rows(spark)
    shown = lambda x: "nan" if x is not None and x != x else x
    assert q.latest_t(stats).first().latest_t == 3.0
    assert q.overview(stats, stats).first().current_t == 3.0
    assert [shown(r.t) for r in q.latest_n(stats, 6).collect()] == [3.0, 2.0, 1.0, "nan", "nan", None]
    assert [(r.link, shown(r.avg_speed)) for r in q.avg_speed_per_link(stats).collect()] == [("B", 7.0), ("A", "nan"), ("C", "nan"), ("D", None)]
    assert [(r.link, shown(r.avg_speed)) for r in q.avg_speed_per_link(stats, ascending=True).collect()][:2] == [("D", None), ("A", "nan")]
    assert [(r.link, shown(r.max_speed), shown(r.min_speed)) for r in q.max_speed_delta(stats, 3).collect()] == [
        ("B", 7.0, 7.0), ("A", 10.0, "nan"), ("C", "nan", "nan")]
    summary = q.link_summary(stats, "A").first()
    assert (summary.max_speed, shown(summary.min_speed), summary.last_t, shown(summary.first_t)) == (10.0, "nan", 2.0, "nan")
    assert [shown(r.t) for r in q.link_series(stats, "A").collect()] == ["nan", 1.0, 2.0]


def test_event_time_range(spark):
    from roadstats.functions.columns import MAX_EVENT_SECONDS, MIN_EVENT_SECONDS, event_time

    times = [1e13, 1e15, 9e18, -1e15, 1e300, NAN, float("inf"), MAX_EVENT_SECONDS * 1.0, MIN_EVENT_SECONDS * 1.0, 5.9]
    df = spark.createDataFrame([(t,) for t in times], "t double")
    from pyspark.sql import functions as F

    found = [r.s for r in df.select(F.unix_seconds(event_time("t")).alias("s")).collect()]
    assert found == [None] * 7 + [MAX_EVENT_SECONDS, MIN_EVENT_SECONDS, 5]

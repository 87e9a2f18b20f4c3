"""Network dimension: referential integrity and the map state."""

from __future__ import annotations

import math

from roadstats.operators.network import link_segments, network_checks, network_state_at
from roadstats.schemas import STATS_SCHEMA
from roadstats.sources.network import LINKS, NODES


def test_segments_one_finite_entry_per_link(spark):
    segs = link_segments(spark).collect()
    assert len(segs) == len(LINKS) == 13
    assert {s.link for s in segs} == set(LINKS)
    for s in segs:
        assert all(math.isfinite(getattr(s, c)) for c in ("x0", "y0", "x1", "y1"))
        assert (s.x0, s.y0) == NODES[s.start] and (s.x1, s.y1) == NODES[s.end]
        assert s.link == s.start + s.end


def test_builtin_network_passes_all_checks(spark):
    report = {r.check: (r.violations, r.ok) for r in network_checks(spark).collect()}
    assert set(report) == {"unknown_endpoint", "orphan_node", "segment_count", "non_finite_coordinate", "duplicate_link", "duplicate_coordinate"}
    assert all(ok for _, ok in report.values())


def test_checks_find_broken_network(spark):
    nodes = spark.createDataFrame([("A", 0.0, 0.0), ("B", 0.0, 0.0), ("C", 1.0, 1.0)], "node string, x double, y double")
    links = spark.createDataFrame([("AB", "A", "B"), ("AB", "A", "B"), ("AZ", "A", "Z")], "link string, start string, `end` string")
    observed = spark.createDataFrame([(1.0, "QQ", 1, 1.0), (1.0, "AB", 1, 1.0)], STATS_SCHEMA)
    report = {r.check: r.violations for r in network_checks(spark, observed, nodes, links).collect()}
    assert report["unknown_endpoint"] == 1
    assert report["orphan_node"] == 1
    assert report["segment_count"] == 1
    assert report["duplicate_link"] == 1
    assert report["duplicate_coordinate"] == 1
    assert report["unmapped_link"] == 1


def test_network_state_colours_and_widths(spark):
    stats = spark.createDataFrame(
        [(100.0, "I1W1", 4, 50.0), (100.0, "I2I1", 2, 0.0), (99.0, "I3I2", 1, 25.0), (90.0, "I4I3", 8, 10.0), (100.0, "XX", 8, 5.0)],
        STATS_SCHEMA,
    )
    rows = {r.link: r for r in network_state_at(spark, stats).collect()}
    assert len(rows) == 13  # every segment, unknown state link dropped
    assert rows["I1W1"].color == "rgb(0,180,60)" and rows["I1W1"].width == 8.0  # vmax 8 from the unknown link
    assert rows["I2I1"].color == "rgb(220,0,60)"
    assert rows["I3I2"].color == "rgb(110,90,60)"  # ratio 0.5, half-even rounding
    assert rows["I4I3"].has_data is False and rows["I4I3"].color == "#bbbbbb" and rows["I4I3"].width == 2.0
    at_90 = {r.link: r for r in network_state_at(spark, stats, t=90.0, tolerance=0).collect()}
    assert at_90["I4I3"].width == 14.0 and at_90["I1W1"].has_data is False


def test_network_state_empty_stats(spark):
    stats = spark.createDataFrame([], STATS_SCHEMA)
    rows = network_state_at(spark, stats).collect()
    assert len(rows) == 13 and all(not r.has_data and r.width == 2.0 for r in rows)


def test_segments_of_observed_links(spark):
    stats = spark.createDataFrame([(1.0, "I1W1", 1, 1.0), (2.0, "I1W1", 1, 1.0), (1.0, "XX", 1, 1.0), (1.0, None, 1, 1.0)], STATS_SCHEMA)
    rows = link_segments(spark, observed=stats).collect()
    assert [(r.link, r.start, r.end) for r in rows] == [("I1W1", "I1", "W1")]


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_latest_state_prunes_the_scan_and_ignores_nan(spark, work):
    from roadstats.operators.network import network_state_at
    from roadstats.schemas import STATS_SCHEMA

    rows = [(1.0, "I2I1", 1, 9.0), (10.0, "I2I1", 4, 25.0), (10.0, "I1W1", 2, None), (float("nan"), "I2I1", 7, 1.0)]
    spark.createDataFrame(rows, STATS_SCHEMA).write.parquet(f"{work}/stats")
    stats = spark.read.parquet(f"{work}/stats")
    state = network_state_at(spark, stats)
    found = {r.link: r for r in state.collect() if r.has_data}
    assert {k: (r.t, r.vcount) for k, r in found.items()} == {"I2I1": (10.0, 4), "I1W1": (10.0, 2)}
    assert found["I2I1"].width > found["I1W1"].width
    assert found["I1W1"].ratio is None and found["I1W1"].color == "#bbbbbb"  # a row without a speed is not a jam
    assert "GreaterThanOrEqual(t,ScalarSubquery" in _plan(state).replace("ScalarSubquery#", "ScalarSubquery").replace(" ", "")


def test_shared_root_needs_a_setting_on_a_cluster():
    import pytest

    from roadstats.session import shared_root

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session())

"""One key holding a third of all rows: results stay exact and the hot key is pre-aggregated."""

from __future__ import annotations

import math
import re

from roadstats.operators import queries as q
from roadstats.operators.stats import link_partials, link_stats, stats_from_partials, windowed_stats
from roadstats.schemas import EVENT_SCHEMA


def _skewed(spark, n=6000):
    # A third of the rows on (t=10, link HOT); the rest spread over 500 (t, link) keys.
    hot = [("p", 5, "A", "B", 10.0, "HOT", 0.0, 0.0, float(i % 50)) for i in range(n // 3)]
    rest = [("p", 5, "A", "B", float(i % 100), f"L{i % 5}", 0.0, 0.0, float(i % 7)) for i in range(n - n // 3)]
    return spark.createDataFrame(hot + rest, EVENT_SCHEMA).repartition(8)


def test_hot_key_is_exact(spark):
    events = _skewed(spark)
    got = {(r.t, r.link): (r.vcount, r.vspeed) for r in link_stats(events).collect()}
    assert got[(10.0, "HOT")][0] == 2000 and math.isclose(got[(10.0, "HOT")][1], sum(i % 50 for i in range(2000)) / 2000)
    assert sum(c for c, _ in got.values()) == 6000
    top = q.top_n_congested(link_stats(events), 1).first()
    assert (top.link, top.peak_vcount, top.argmax_t) == ("HOT", 2000, 10.0)
    windows = {(r.window_start, r.link): r.vcount for r in windowed_stats(events).collect()}
    assert sum(windows.values()) == 6000
    rolled = {(r.t, r.link): r.vcount for r in stats_from_partials(link_partials(events)).collect()}
    assert rolled == {k: v[0] for k, v in got.items()}


def test_hot_key_is_pre_aggregated_before_the_shuffle(spark):
    plan = link_stats(_skewed(spark))._jdf.queryExecution().executedPlan().toString()
    # partial aggregate (map side) -> exchange on the keys -> final aggregate
    assert re.search(r"HashAggregate\(keys=\[t#\d+, link#\d+\], functions=\[count\(1\), avg", plan)
    assert "partial_count(1)" in plan and "partial_avg" in plan
    assert plan.index("Exchange hashpartitioning(t") < plan.index("partial_count(1)")  # tree order: exchange above partial

"""DuckDB oracle SQL for the batch contract, written independently of the Spark operators.

Tables ``events`` etc. are views over the same parquet files. ``ev`` re-states the adapter
rule of ``sources.events`` in SQL; ``stats_t`` and ``win_t`` re-state the two aggregations.
Floating aggregates are quantized to multiples of 2**-20 on both sides (see
``plans.views``); timestamps are compared as UTC wall clock.
"""

from __future__ import annotations

from roadstats.sources.network import LINK_ORDER, LINKS, NODES

_LINK_LIST = "[" + ", ".join(f"'{x}'" for x in LINK_ORDER) + "]"
_STATUS = "('trip_end', 'waiting_at_origin_node')"

EV = f"""ev AS (
  SELECT CAST(user_id AS VARCHAR) AS name,
         CAST(5 AS INTEGER) AS dn,
         substr(base, 1, 2) AS orig,
         substr(base, 3, 2) AS dest,
         CAST(5 AS DOUBLE) * floor(CAST(epoch_us(ts) - 1704067200000000 AS DOUBLE) / 3600000000.0) AS t,
         CASE event_type WHEN 'signup' THEN 'waiting_at_origin_node'
                         WHEN 'error' THEN 'trip_end' ELSE base END AS link,
         CASE WHEN event_type IN ('signup', 'error') THEN CAST(-1 AS DOUBLE) ELSE CAST(5 AS DOUBLE) * k END AS x,
         CASE WHEN event_type IN ('signup', 'error') THEN CAST(-1 AS DOUBLE) ELSE CAST(500 AS DOUBLE) - CAST(5 AS DOUBLE) * k END AS s,
         CASE WHEN event_type IN ('signup', 'error') THEN CAST(-1 AS DOUBLE) ELSE value END AS v,
         event_type
  FROM (SELECT *, ({_LINK_LIST})[((user_id % 13) + 13) % 13 + 1] AS base,
               TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k
        FROM events) e
)"""

STATS = f"""stats_t AS (
  SELECT t, link, count(*) AS vcount, avg(v) AS vspeed
  FROM ev WHERE link NOT IN {_STATUS} GROUP BY t, link
)"""


def q20(expr: str) -> str:
    return f"(round(({expr}) * 1048576.0) / 1048576.0)"


def win(seconds: int = 30, name: str = "win_t") -> str:
    return f"""{name} AS (
  SELECT make_timestamp(CAST(floor(trunc(t) / {seconds}.0) * {seconds} AS BIGINT) * 1000000) AS window_start,
         make_timestamp((CAST(floor(trunc(t) / {seconds}.0) * {seconds} AS BIGINT) + {seconds}) * 1000000) AS window_end,
         link, count(*) AS vcount,
         {q20('avg(v)')} AS vspeed_avg, {q20('min(v)')} AS vspeed_min, {q20('max(v)')} AS vspeed_max
  FROM ev WHERE link NOT IN {_STATUS} AND t IS NOT NULL
  GROUP BY 1, 2, link
)"""


NODES_SQL = "nodes_t(node, x, y) AS (VALUES " + ", ".join(
    f"('{n}', CAST({x} AS DOUBLE), CAST({y} AS DOUBLE))" for n, (x, y) in NODES.items()
) + ")"
LINKS_SQL = "links_t(link, start, \"end\", seq) AS (VALUES " + ", ".join(
    f"('{n}', '{a}', '{b}', CAST({i} AS INTEGER))" for i, (n, (a, b)) in enumerate(LINKS.items())
) + ")"
SEGS = """segs_t AS (
  SELECT l.link, l.start, l."end", a.x AS x0, a.y AS y0, b.x AS x1, b.y AS y1, l.seq
  FROM links_t l JOIN nodes_t a ON a.node = l.start JOIN nodes_t b ON b.node = l."end"
)"""

EV_COLS = "name, dn, orig, dest, t, link, x, s, v"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def qcol(expr: str, alias: str) -> str:
    """``expr`` quantized like ``plans.views.rounded``, aliased."""
    return f"{q20(expr)} AS {alias}"

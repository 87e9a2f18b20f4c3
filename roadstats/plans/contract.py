"""The named query contract: one Spark plan per operator, plus its DuckDB oracle.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole driver
tables. Presentation for the comparison only: floating aggregates are quantized to multiples of 2**-20
and event-time columns are shown as UTC wall clock (``TIMESTAMP_NTZ``); the operators
themselves return full precision and ``TIMESTAMP``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstats.functions.columns import event_time, to_utc_ntz
from roadstats.operators import network as net
from roadstats.operators import queries as q
from roadstats.operators.stats import link_stats, status_filter, windowed_stats
from roadstats.plans import oracle as o
from roadstats.plans.streamed import STREAM_QUERIES, stream_sql
from roadstats.plans.tables import stored_tables
from roadstats.plans.views import rounded, stats_view, windowed_view
from roadstats.schemas import EVENT_COLUMNS, EVENT_SCHEMA
from roadstats.sources.codec import encode_events, parse_events
from roadstats.sources.events import events_from_table, load_events

# --- Contract parameters ---------------------------------------------------------------------
LINK_ID = "I2I1"
STATE_T, STATE_TOL = 1820.0, 10.0
TOP_N = 5
LATEST_N = 5
# -----------------------------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


# --- batch: decode / filter / aggregate -------------------------------------------------------


def _parse_events(spark: SparkSession, sf: str) -> DataFrame:
    return parse_events(encode_events(load_events(spark, sf)))


def _encode_events(spark: SparkSession, sf: str) -> DataFrame:
    # Read the encoded JSON back by field extraction (independent of from_json); json_tuple
    # parses each message once for all fields.
    msg = encode_events(load_events(spark, sf)).select(F.col("value").cast("string").alias("j"))
    fields = msg.select(F.json_tuple("j", *EVENT_COLUMNS).alias(*EVENT_COLUMNS))
    return fields.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields])


def odd_times(events: DataFrame) -> DataFrame:
    """Events whose time is spoilt by event type: view -> NaN, click -> 1e15 (no event time)."""
    t = F.when(F.col("event_type") == "view", F.lit(float("nan"))).when(F.col("event_type") == "click", F.lit(1e15)).otherwise(F.col("t"))
    return events.withColumn("t", t).drop("event_type")


def _windowed_odd_times(spark: SparkSession, sf: str) -> DataFrame:
    raw = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet").select("ts", "user_id", "event_type", "value", "props")
    return windowed_view(windowed_stats(odd_times(events_from_table(raw, keep=["event_type"]))))


def _nan_stats(spark: SparkSession, sf: str) -> DataFrame:
    """``stats`` with NaN as speed where the count divides by 7 and as time where it does by 11."""
    nan, n = F.lit(float("nan")), F.col("vcount")
    stats = stored_tables(spark, sf).stats
    return stats.withColumn("vspeed", F.when(n % 7 == 0, nan).otherwise(F.col("vspeed"))).withColumn("t", F.when(n % 11 == 0, nan).otherwise(F.col("t")))


def _nan_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = q.link_summary_all(_nan_stats(spark, sf)).crossJoin(F.broadcast(q.latest_t(_nan_stats(spark, sf))))  # one row
    return rounded(rows, *_SUMMARY_FLOATS)


def _nan_speed_delta(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(q.max_speed_delta(_nan_stats(spark, sf), TOP_N), "max_speed", "min_speed", "delta")


def _link_detail(spark: SparkSession, sf: str) -> DataFrame:
    """The detail view of one link as rows: its series, each row beside the summary."""
    detail = q.link_detail(stored_tables(spark, sf).stats, LINK_ID)
    series = rounded(detail["series"], "vspeed").withColumn("link", F.lit(detail["link"]))
    summary = rounded(detail["summary"], *_SUMMARY_FLOATS).withColumn("link", F.lit(detail["link"]))
    return series.join(summary, "link")


def malformed_messages(events: DataFrame) -> DataFrame:
    """Encoded events with a defect chosen by event type (whole payloads, nothing cut):

    signup -> a JSON array of two objects; error -> text that is not JSON; view -> ``t`` as a
    JSON string; click -> ``dn`` as a fractional number; purchase -> unchanged.
    """
    j = F.col("value").cast("string")
    et = F.col("event_type")
    bad = (
        F.when(et == "signup", F.concat(F.lit("["), j, F.lit(","), j, F.lit("]")))
        .when(et == "error", F.concat(F.lit("not json "), j))
        .when(et == "view", F.regexp_replace(j, r'"t":([^,}]*)', '"t":"$1"'))
        .when(et == "click", F.regexp_replace(j, r'"dn":([0-9]+)', '"dn":$1.0'))
        .otherwise(j)
    )
    encoded = events.select(F.to_json(F.struct(*EVENT_COLUMNS)).alias("value"), "event_type")
    return encoded.select(bad.cast("binary").alias("value"))


def _parse_malformed(spark: SparkSession, sf: str) -> DataFrame:
    raw = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet").select("ts", "user_id", "event_type", "value", "props")
    return parse_events(malformed_messages(events_from_table(raw, keep=["event_type"])))


def _status_filter(spark: SparkSession, sf: str) -> DataFrame:
    return status_filter(load_events(spark, sf))


def _event_time(spark: SparkSession, sf: str) -> DataFrame:
    return load_events(spark, sf).select("t", "link", to_utc_ntz(event_time("t")).alias("event_ts"))


def _link_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats_view(link_stats(load_events(spark, sf)))


def _link_stats_unfiltered(spark: SparkSession, sf: str) -> DataFrame:
    return stats_view(link_stats(load_events(spark, sf), status_links=()))


def _windowed(seconds: int) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return windowed_view(windowed_stats(load_events(spark, sf), window_seconds=seconds))

    return run


# --- batch: read queries over the stored tables ------------------------------------------------


def _avg_speed(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(q.avg_speed_per_link(stored_tables(spark, sf).stats), "avg_speed")


def _top_n(spark: SparkSession, sf: str) -> DataFrame:
    return q.top_n_congested(stored_tables(spark, sf).stats, TOP_N)


def _delta(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(q.max_speed_delta(stored_tables(spark, sf).stats, TOP_N), "max_speed", "min_speed", "delta")


def _state_at(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(q.link_state_at(stored_tables(spark, sf).stats, STATE_T, STATE_TOL), "vspeed")


_SUMMARY_FLOATS = ("avg_speed", "min_speed", "max_speed")


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(q.link_summary(stored_tables(spark, sf).stats, LINK_ID), *_SUMMARY_FLOATS)


def _summary_all(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(q.link_summary_all(stored_tables(spark, sf).stats), *_SUMMARY_FLOATS)


def _series(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(q.link_series(stored_tables(spark, sf).stats, LINK_ID), "vspeed")


def _wseries(spark: SparkSession, sf: str) -> DataFrame:
    return windowed_view(q.windowed_series(stored_tables(spark, sf).windowed, LINK_ID))


def _latest_t(spark: SparkSession, sf: str) -> DataFrame:
    return q.latest_t(stored_tables(spark, sf).stats)


def _table_counts(spark: SparkSession, sf: str) -> DataFrame:
    tb = stored_tables(spark, sf)
    return q.default_table_counts(tb.raw, tb.stats, tb.windowed)


def _distinct_links(spark: SparkSession, sf: str) -> DataFrame:
    return q.distinct_links(stored_tables(spark, sf).stats)


def _distinct_links_raw(spark: SparkSession, sf: str) -> DataFrame:
    return q.distinct_links(stored_tables(spark, sf).raw)


def _overview(spark: SparkSession, sf: str) -> DataFrame:
    tb = stored_tables(spark, sf)
    return q.overview(tb.raw, tb.stats)


def _volume_checks(spark: SparkSession, sf: str) -> DataFrame:
    tb = stored_tables(spark, sf)
    return q.volume_checks(tb.raw, tb.stats)


def _latest_n_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats_view(q.latest_n(stored_tables(spark, sf).stats, LATEST_N, "t", ["link"]))


def _latest_n_windowed(spark: SparkSession, sf: str) -> DataFrame:
    return windowed_view(q.latest_n(stored_tables(spark, sf).windowed, LATEST_N, "window_end", ["link"]))


def _latest_n_raw(spark: SparkSession, sf: str) -> DataFrame:
    # Many raw rows share the last step: every other column breaks the tie, in schema order.
    return q.latest_n(stored_tables(spark, sf).raw, LATEST_N, "t")


def _sample_row(spark: SparkSession, sf: str) -> DataFrame:
    # Which row it is, is free: there is one, and it is a row of the table.
    stats = stored_tables(spark, sf).stats
    row = q.sample_row(stats).select(*[F.col(c).alias(f"_{c}") for c in stats.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in stats.columns]
    found = stats.join(F.broadcast(row), same[0] & same[1] & same[2] & same[3])
    one = q.sample_row(stats).agg(F.count(F.lit(1)).alias("n_rows"))
    return one.crossJoin(F.broadcast(found.agg((F.count(F.lit(1)) > 0).alias("in_stats"))))  # one row each


def _link_segments(spark: SparkSession, sf: str) -> DataFrame:
    # The segments of the links that carry traffic in the data (J1 over the observed links).
    return net.link_segments(spark, observed=stored_tables(spark, sf).stats)


def _network_checks(spark: SparkSession, sf: str) -> DataFrame:
    return net.network_checks(spark, observed=stored_tables(spark, sf).stats)


def _network_state_at(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(net.network_state_at(spark, stored_tables(spark, sf).stats), "vspeed", "ratio", "width")


BATCH: dict[str, Query] = {
    "parse_events": _parse_events,
    "encode_events": _encode_events,
    "parse_malformed": _parse_malformed,
    "status_filter": _status_filter,
    "event_time": _event_time,
    "link_stats": _link_stats,
    "link_stats_unfiltered": _link_stats_unfiltered,
    "windowed_stats": _windowed(30),
    "windowed_stats_10s": _windowed(10),
    "avg_speed_per_link": _avg_speed,
    "top_n_congested": _top_n,
    "max_speed_delta": _delta,
    "link_state_at": _state_at,
    "link_summary": _summary,
    "link_summary_all": _summary_all,
    "link_series": _series,
    "windowed_series": _wseries,
    "latest_t": _latest_t,
    "table_counts": _table_counts,
    "distinct_links": _distinct_links,
    "distinct_links_raw": _distinct_links_raw,
    "overview": _overview,
    "volume_checks": _volume_checks,
    "latest_n_stats": _latest_n_stats,
    "latest_n_windowed": _latest_n_windowed,
    "latest_n_raw": _latest_n_raw,
    "sample_row": _sample_row,
    "link_detail": _link_detail,
    "nan_link_summary": _nan_summary,
    "nan_speed_delta": _nan_speed_delta,
    "windowed_odd_times": _windowed_odd_times,
    "link_segments": _link_segments,
    "network_checks": _network_checks,
    "network_state_at": _network_state_at,
}

# --- oracle SQL -------------------------------------------------------------------------------

_EV = o.with_(o.EV)
_ST = o.with_(o.EV, o.STATS)
_WN = o.with_(o.EV, o.win(30))
_ALL = o.with_(o.EV, o.STATS, o.win(30))
_STATUS = "('trip_end', 'waiting_at_origin_node')"
_SUMMARY_SQL = f"""link, count(*) AS samples, {o.qcol('avg(vspeed)', 'avg_speed')}, {o.qcol('min(vspeed)', 'min_speed')},
  {o.qcol('max(vspeed)', 'max_speed')}, max(vcount) AS peak_vcount, min(t) AS first_t, max(t) AS last_t"""
_ODD = """SELECT link, vcount, CASE WHEN vcount % 11 = 0 THEN CAST('NaN' AS DOUBLE) ELSE t END AS t,
  CASE WHEN vcount % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE vspeed END AS vspeed FROM stats_t"""
_WIN_COLS = "window_start, window_end, link, vcount, vspeed_avg, vspeed_min, vspeed_max"

BATCH_SQL: dict[str, str] = {
    "parse_events": _EV + f"SELECT {o.EV_COLS} FROM ev",
    "encode_events": _EV + f"SELECT {o.EV_COLS} FROM ev",
    "parse_malformed": _EV + """SELECT
  CASE WHEN event_type IN ('signup', 'error') THEN NULL ELSE name END AS name,
  CASE WHEN event_type IN ('signup', 'error', 'click') THEN NULL ELSE dn END AS dn,
  CASE WHEN event_type IN ('signup', 'error') THEN NULL ELSE orig END AS orig,
  CASE WHEN event_type IN ('signup', 'error') THEN NULL ELSE dest END AS dest,
  CASE WHEN event_type IN ('signup', 'error', 'view') THEN NULL ELSE t END AS t,
  CASE WHEN event_type IN ('signup', 'error') THEN NULL ELSE link END AS link,
  CASE WHEN event_type IN ('signup', 'error') THEN NULL ELSE x END AS x,
  CASE WHEN event_type IN ('signup', 'error') THEN NULL ELSE s END AS s,
  CASE WHEN event_type IN ('signup', 'error') THEN NULL ELSE v END AS v
FROM ev""",
    "status_filter": _EV + f"SELECT {o.EV_COLS} FROM ev WHERE link NOT IN {_STATUS}",
    "event_time": _EV + "SELECT t, link, make_timestamp(CAST(trunc(t) AS BIGINT) * 1000000) AS event_ts FROM ev",
    "link_stats": _ST + f"SELECT t, link, vcount, {o.qcol('vspeed', 'vspeed')} FROM stats_t",
    "link_stats_unfiltered": _EV + f"SELECT t, link, count(*) AS vcount, {o.qcol('avg(v)', 'vspeed')} FROM ev GROUP BY t, link",
    "windowed_stats": _WN + f"SELECT {_WIN_COLS} FROM win_t",
    "windowed_stats_10s": o.with_(o.EV, o.win(10)) + f"SELECT {_WIN_COLS} FROM win_t",
    "avg_speed_per_link": _ST + f"""SELECT link, {o.qcol('avg(vspeed)', 'avg_speed')}, count(*) AS samples
FROM stats_t GROUP BY link ORDER BY avg(vspeed) DESC NULLS LAST, link ASC NULLS FIRST""",
    "top_n_congested": _ST + f"""SELECT link, peak_vcount, argmax_t FROM (
  SELECT link, vcount AS peak_vcount, t AS argmax_t,
         row_number() OVER (PARTITION BY link ORDER BY vcount DESC, t ASC NULLS LAST) AS rn
  FROM stats_t) WHERE rn = 1
ORDER BY peak_vcount DESC NULLS LAST, link ASC NULLS FIRST LIMIT {TOP_N}""",
    "max_speed_delta": _ST + f"""SELECT link, {o.qcol('max_speed', 'max_speed')}, {o.qcol('min_speed', 'min_speed')}, {o.qcol('max_speed - min_speed', 'delta')}
FROM (SELECT link, max(vspeed) AS max_speed, min(vspeed) AS min_speed FROM stats_t GROUP BY link)
ORDER BY max_speed - min_speed DESC NULLS LAST, link ASC NULLS FIRST LIMIT {TOP_N}""",
    "link_state_at": _ST + f"""SELECT link, arg_max(vcount, t) AS vcount, {o.qcol('arg_max(vspeed, t)', 'vspeed')}, max(t) AS t
FROM stats_t WHERE t >= {STATE_T - STATE_TOL} AND t <= {STATE_T} GROUP BY link""",
    "link_summary": _ST + f"SELECT {_SUMMARY_SQL} FROM stats_t WHERE link = '{LINK_ID}' GROUP BY link",
    "link_summary_all": _ST + f"SELECT {_SUMMARY_SQL} FROM stats_t GROUP BY link",
    "link_series": _ST + f"SELECT t, vcount, {o.qcol('vspeed', 'vspeed')} FROM stats_t WHERE link = '{LINK_ID}' ORDER BY t",
    "windowed_series": _WN + f"""SELECT window_start, window_end, vcount, vspeed_avg, vspeed_min, vspeed_max
FROM win_t WHERE link = '{LINK_ID}' ORDER BY window_start""",
    "latest_t": _ST + "SELECT max(t) AS latest_t FROM stats_t",
    "table_counts": _ALL + """SELECT 'raw_data' AS "table", count(*) AS "rows" FROM ev
UNION ALL SELECT 'stats', count(*) FROM stats_t
UNION ALL SELECT 'stats_windowed', count(*) FROM win_t""",
    "distinct_links": _ST + "SELECT DISTINCT link FROM stats_t WHERE link IS NOT NULL ORDER BY link",
    "distinct_links_raw": _EV + "SELECT DISTINCT link FROM ev WHERE link IS NOT NULL ORDER BY link",
    "overview": _ST + """SELECT (SELECT count(*) FROM ev) AS raw_rows, (SELECT max(t) FROM stats_t) AS current_t,
  (SELECT count(*) FROM (SELECT link FROM stats_t GROUP BY link)) AS active_links""",
    "volume_checks": _ST + """SELECT "check", n >= 1 AS ok, format('{} docs (min {})', n, 1) AS detail FROM (
  SELECT 'raw_data' AS "check", count(*) AS n FROM ev UNION ALL SELECT 'stats', count(*) FROM stats_t)""",
    "latest_n_stats": _ST + f"""SELECT t, link, vcount, {o.qcol('vspeed', 'vspeed')} FROM stats_t
ORDER BY t DESC NULLS LAST, link ASC NULLS FIRST LIMIT {LATEST_N}""",
    "latest_n_windowed": _WN + f"""SELECT {_WIN_COLS} FROM win_t
ORDER BY window_end DESC NULLS LAST, link ASC NULLS FIRST LIMIT {LATEST_N}""",
    "latest_n_raw": _EV + f"""SELECT {o.EV_COLS} FROM ev
ORDER BY t DESC NULLS LAST, name ASC NULLS FIRST, dn ASC NULLS FIRST, orig ASC NULLS FIRST, dest ASC NULLS FIRST,
         link ASC NULLS FIRST, x ASC NULLS FIRST, s ASC NULLS FIRST, v ASC NULLS FIRST LIMIT {LATEST_N}""",
    "sample_row": _ST + "SELECT CAST(1 AS BIGINT) AS n_rows, true AS in_stats FROM (SELECT count(*) FROM stats_t)",
    "link_detail": _ST + f"""SELECT t, vcount, {o.qcol('vspeed', 'vspeed')}, s.* FROM stats_t JOIN (
  SELECT {_SUMMARY_SQL} FROM stats_t WHERE link = '{LINK_ID}' GROUP BY link) s USING (link)""".replace("t, vcount,", "stats_t.t, stats_t.vcount,", 1),
    "nan_link_summary": _ST + f""", odd AS ({_ODD}), numbers AS (
  SELECT link, count(*) AS samples, avg(vspeed) AS avg_speed, min(vspeed) AS least_speed,
         max(vspeed) FILTER (NOT isnan(vspeed)) AS most_speed, bool_or(isnan(vspeed)) AS odd_speed, max(vcount) AS peak_vcount,
         min(t) AS least_t, max(t) FILTER (NOT isnan(t)) AS most_t, bool_or(isnan(t)) AS odd_t
  FROM odd GROUP BY link)
SELECT link, samples, {o.qcol('avg_speed', 'avg_speed')},
       {o.qcol("CASE WHEN odd_speed THEN CAST('NaN' AS DOUBLE) ELSE least_speed END", 'min_speed')},
       {o.qcol("coalesce(most_speed, CASE WHEN odd_speed THEN CAST('NaN' AS DOUBLE) END)", 'max_speed')}, peak_vcount,
       CASE WHEN odd_t THEN CAST('NaN' AS DOUBLE) ELSE least_t END AS first_t,
       coalesce(most_t, CASE WHEN odd_t THEN CAST('NaN' AS DOUBLE) END) AS last_t,
       (SELECT max(t) FROM odd WHERE NOT isnan(t)) AS latest_t
FROM numbers""",
    "nan_speed_delta": _ST + f""", odd AS ({_ODD}), numbers AS (
  SELECT link, max(vspeed) FILTER (NOT isnan(vspeed)) AS most, min(vspeed) AS least, bool_or(isnan(vspeed)) AS odd_speed
  FROM odd GROUP BY link), spread AS (
  SELECT link, coalesce(most, CASE WHEN odd_speed THEN CAST('NaN' AS DOUBLE) END) AS max_speed,
         CASE WHEN odd_speed THEN CAST('NaN' AS DOUBLE) ELSE least END AS min_speed FROM numbers)
SELECT link, {o.qcol('max_speed', 'max_speed')}, {o.qcol('min_speed', 'min_speed')}, {o.qcol('max_speed - min_speed', 'delta')} FROM spread
ORDER BY CASE WHEN max_speed - min_speed IS NULL THEN 0 WHEN isnan(max_speed - min_speed) THEN 1 ELSE 2 END DESC,
         max_speed - min_speed DESC, link ASC NULLS FIRST LIMIT {TOP_N}""",
    "windowed_odd_times": o.with_(o.EV, "ev_odd AS (SELECT * FROM ev WHERE event_type NOT IN ('view', 'click'))", o.win(30).replace("FROM ev", "FROM ev_odd"))
    + f"SELECT {_WIN_COLS} FROM win_t",
    "link_segments": o.with_(o.EV, o.STATS, o.NODES_SQL, o.LINKS_SQL, o.SEGS)
    + """SELECT link, start, "end", x0, y0, x1, y1, seq FROM segs_t
WHERE link IN (SELECT link FROM stats_t WHERE link IS NOT NULL)""",
    "network_checks": o.with_(o.EV, o.STATS, o.NODES_SQL, o.LINKS_SQL, o.SEGS) + """, ends AS (
  SELECT start AS endpoint FROM links_t UNION ALL SELECT "end" FROM links_t)
SELECT "check", violations, violations = 0 AS ok FROM (
  SELECT 'unknown_endpoint' AS "check", (SELECT count(*) FROM ends WHERE endpoint NOT IN (SELECT node FROM nodes_t)) AS violations
  UNION ALL SELECT 'orphan_node', (SELECT count(*) FROM nodes_t WHERE node NOT IN (SELECT endpoint FROM ends))
  UNION ALL SELECT 'segment_count', (SELECT count(*) FROM (SELECT (SELECT count(*) FROM links_t) - (SELECT count(*) FROM segs_t) AS d) WHERE d <> 0)
  UNION ALL SELECT 'non_finite_coordinate', (SELECT count(*) FROM segs_t WHERE NOT (isfinite(x0) AND isfinite(y0) AND isfinite(x1) AND isfinite(y1)))
  UNION ALL SELECT 'duplicate_link', (SELECT count(*) FROM (SELECT link FROM links_t GROUP BY link HAVING count(*) > 1))
  UNION ALL SELECT 'duplicate_coordinate', (SELECT count(*) FROM (SELECT x, y FROM nodes_t GROUP BY x, y HAVING count(*) > 1))
  UNION ALL SELECT 'unmapped_link', (SELECT count(*) FROM (SELECT DISTINCT link FROM stats_t WHERE link IS NOT NULL) s
                                      WHERE link NOT IN (SELECT link FROM links_t)))""",
    "network_state_at": o.with_(o.EV, o.STATS, o.NODES_SQL, o.LINKS_SQL, o.SEGS) + """, lt AS (SELECT max(t) AS t0 FROM stats_t),
state AS (
  SELECT link, arg_max(vcount, t) AS vcount, arg_max(vspeed, t) AS vspeed, max(t) AS t
  FROM stats_t WHERE t >= (SELECT t0 FROM lt) - 2.0 AND t <= (SELECT t0 FROM lt) GROUP BY link),
vm AS (SELECT coalesce(max(vcount), 0) AS vmax FROM state),
j AS (
  SELECT s.*, st.vcount, st.vspeed, st.t, st.t IS NOT NULL AS has_data,
         least(1.0, greatest(0.0, st.vspeed / 50.0)) AS r
  FROM segs_t s LEFT JOIN state st ON s.link = st.link)
SELECT link, start, "end", x0, y0, x1, y1, seq, has_data, vcount, """ + o.qcol("vspeed", "vspeed") + """, t,
  """ + o.qcol("CASE WHEN has_data THEN r END", "ratio") + """,
  CASE WHEN has_data THEN printf('rgb(%d,%d,60)', CAST(round_even(220.0 * (1.0 - r), 0) AS INTEGER),
                                 CAST(round_even(180.0 * r, 0) AS INTEGER)) ELSE '#bbbbbb' END AS color,
  """ + o.qcol("CASE WHEN has_data AND (SELECT vmax FROM vm) > 0 THEN 2.0 + 12.0 * least(1.0, vcount / (SELECT vmax FROM vm)) ELSE 2.0 END", "width") + """
FROM j""",
}

ALL_QUERIES: dict[str, Query] = {**BATCH, **STREAM_QUERIES}
ALL_SQL: dict[str, str] = {k: v for k, v in {**BATCH_SQL, **stream_sql(BATCH_SQL)}.items() if k in ALL_QUERIES}


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Mean speed per link over the per-step statistics."""
    return _avg_speed(spark, sf)

"""Read queries over the stored tables (``stats``, ``stats_windowed``, ``raw_data``).

Every query is a lazy ``DataFrame -> DataFrame``; argument errors raise ``ValueError``
before a plan is built. Aggregations are hash aggregates with map-side partial
aggregation (shuffle on ``link`` only carries one partial row per link and partition);
top-n reports end in ``orderBy().limit(n)``, which Spark plans as a per-partition top-k
(``TakeOrderedAndProject``) instead of a global sort.

NaN (a JSON ``NaN`` the parser accepts) stands between NULL and the numbers: descending sorts
put it after them, a maximum ignores it unless nothing else is there, a minimum shows it.

Ties are broken deterministically: ``link`` ascending is always the last sort key, and the
time of a peak is the earliest step that reached it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstats.functions.columns import max_number, min_number, ordered
from roadstats.schemas import DEFAULT_STATE_TOLERANCE, RAW_TABLE, STATS_TABLE, VOLUME_DETAIL_FORMAT, WINDOWED_TABLE


def _positive(n: int, name: str = "n") -> int:
    if isinstance(n, bool) or int(n) != n or n <= 0:
        raise ValueError(f"{name} must be a positive integer, got {n!r}")
    return int(n)


def avg_speed_per_link(stats: DataFrame, ascending: bool = False) -> DataFrame:
    """``link, avg_speed, samples``: mean ``vspeed`` and number of (t, link) rows per link."""
    speed = ordered("avg_speed", descending=not ascending)
    return (
        stats.groupBy("link")
        .agg(F.avg("vspeed").alias("avg_speed"), F.count(F.lit(1)).alias("samples"))
        .orderBy(*speed, F.col("link").asc_nulls_first())
    )


def top_n_congested(stats: DataFrame, n: int = 5) -> DataFrame:
    """``link, peak_vcount, argmax_t``: the n links with the largest peak ``vcount``.

    ``argmax_t`` is the earliest step at which the link reached its peak. Two hash
    aggregates: the earliest ``t`` per ``(link, vcount)`` (map-side combined, so its output
    is at most links x distinct counts), then ``max_by`` per link, which is exact because
    ``vcount`` is now unique within a link. Both keep fixed-width buffers, so neither falls
    back to a sort-based aggregate.
    """
    n = _positive(n)
    first_at_count = stats.groupBy("link", "vcount").agg(F.min("t").alias("first_t"))
    return (
        first_at_count.groupBy("link")
        .agg(F.max("vcount").alias("peak_vcount"), F.max_by("first_t", "vcount").alias("argmax_t"))
        .orderBy(F.col("peak_vcount").desc_nulls_last(), F.col("link").asc_nulls_first())
        .limit(n)
    )


def max_speed_delta(stats: DataFrame, n: int = 5) -> DataFrame:
    """``link, max_speed, min_speed, delta``: the n links with the widest speed range."""
    n = _positive(n)
    return (
        stats.groupBy("link")
        .agg(max_number("vspeed").alias("max_speed"), min_number("vspeed").alias("min_speed"))
        .withColumn("delta", F.col("max_speed") - F.col("min_speed"))
        .orderBy(*ordered("delta", descending=True), F.col("link").asc_nulls_first())
        .limit(n)
    )


def link_state_at(stats: DataFrame, t: float, tolerance: float = DEFAULT_STATE_TOLERANCE) -> DataFrame:
    """``link, vcount, vspeed, t``: per link, the latest row with ``t - tolerance <= t' <= t``.

    Links without a row in that range are omitted. The range filter reaches the parquet scan;
    the latest row is picked by ``max_by`` in a hash aggregate (no sort).
    """
    if tolerance < 0:
        raise ValueError(f"tolerance must be non-negative, got {tolerance}")
    t = float(t)
    lo = t - float(tolerance)
    return latest_per_link(stats.where((F.col("t") >= F.lit(lo)) & (F.col("t") <= F.lit(t))))


def latest_per_link(stats: DataFrame) -> DataFrame:
    """``link, vcount, vspeed, t`` of each link's row with the largest ``t``."""
    return stats.groupBy("link").agg(
        F.max_by("vcount", "t").alias("vcount"), F.max_by("vspeed", "t").alias("vspeed"), F.max("t").alias("t")
    )


def _summary_aggs() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("samples"),
        F.avg("vspeed").alias("avg_speed"),
        min_number("vspeed").alias("min_speed"),
        max_number("vspeed").alias("max_speed"),
        F.max("vcount").alias("peak_vcount"),
        min_number("t").alias("first_t"),
        max_number("t").alias("last_t"),
    ]


def link_summary(stats: DataFrame, link_id: str) -> DataFrame:
    """``link, samples, avg_speed, min_speed, max_speed, peak_vcount, first_t, last_t`` of one link.

    Zero rows for an unknown link. The equality filter is pushed to the parquet scan.
    """
    return stats.where(F.col("link") == F.lit(link_id)).groupBy("link").agg(*_summary_aggs())


def link_summary_all(stats: DataFrame) -> DataFrame:
    """``link_summary`` for every link at once (one aggregation)."""
    return stats.groupBy("link").agg(*_summary_aggs())


def link_series(stats: DataFrame, link_id: str) -> DataFrame:
    """``t, vcount, vspeed`` of one link by ascending ``t``."""
    return stats.where(F.col("link") == F.lit(link_id)).select("t", "vcount", "vspeed").orderBy(*ordered("t"))


def windowed_series(windowed: DataFrame, link_id: str) -> DataFrame:
    """Windowed rows of one link by ascending ``window_start``."""
    return (
        windowed.where(F.col("link") == F.lit(link_id))
        .select("window_start", "window_end", "vcount", "vspeed_avg", "vspeed_min", "vspeed_max")
        .orderBy(F.col("window_start").asc_nulls_first())
    )


def link_detail(stats: DataFrame, link_id: str) -> dict | None:
    """``{"link", "summary", "series"}`` (both DataFrames), or None for an unknown link.

    The existence check is one bounded action (``isEmpty`` on the filtered aggregate); the
    series is not evaluated when the link is unknown.
    """
    summary = link_summary(stats, link_id)
    if summary.isEmpty():
        return None
    return {"link": link_id, "summary": summary.drop("link"), "series": link_series(stats, link_id)}


def link_history(stats: DataFrame, windowed: DataFrame, link_id: str, source: str = "stats") -> DataFrame:
    """The series shown for one link: per-step rows (``stats``) or windowed rows (``windowed``)."""
    if source == "stats":
        return link_series(stats, link_id)
    if source == "windowed":
        return windowed_series(windowed, link_id)
    raise ValueError(f"source must be 'stats' or 'windowed', got {source!r}")


def latest_t(stats: DataFrame) -> DataFrame:
    """One row ``latest_t``: the largest ``t`` (NaN only if there is no number), NULL for an empty table."""
    return stats.agg(max_number("t").alias("latest_t"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table, rows``: exact row count per table (parquet counts come from footers)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def default_table_counts(raw: DataFrame, stats: DataFrame, windowed: DataFrame) -> DataFrame:
    return table_counts({RAW_TABLE: raw, STATS_TABLE: stats, WINDOWED_TABLE: windowed})


def distinct_links(df: DataFrame) -> DataFrame:
    """Sorted distinct non-NULL ``link`` values."""
    return df.select("link").where(F.col("link").isNotNull()).distinct().orderBy("link")


def overview(raw: DataFrame, stats: DataFrame) -> DataFrame:
    """One row ``raw_rows, current_t, active_links``.

    Two global aggregates (each a partial per partition plus one final row) combined by a
    union and a final one-row aggregate, so no join and no large exchange. ``active_links``
    counts link groups of ``stats``, a NULL link being one group.
    """
    raw_part = raw.agg(F.count(F.lit(1)).alias("raw_rows")).select(
        "raw_rows", F.lit(None).cast("double").alias("current_t"), F.lit(None).cast("long").alias("active_links")
    )
    per_link = stats.groupBy("link").agg(max_number("t").alias("t_max"))
    stats_part = per_link.agg(max_number("t_max").alias("current_t"), F.count(F.lit(1)).alias("active_links")).select(
        F.lit(None).cast("long").alias("raw_rows"), "current_t", "active_links"
    )
    return raw_part.unionByName(stats_part).agg(
        F.coalesce(F.max("raw_rows"), F.lit(0)).cast("long").alias("raw_rows"),
        F.max("current_t").alias("current_t"),
        F.coalesce(F.max("active_links"), F.lit(0)).cast("long").alias("active_links"),
    )


def checks_of_counts(counts: DataFrame, min_raw: int = 1, min_stats: int = 1) -> DataFrame:
    """``check, ok, detail`` of ``table, rows``: raw and stats row counts against minimums."""
    minimum = F.when(F.col("table") == RAW_TABLE, F.lit(int(min_raw))).otherwise(F.lit(int(min_stats)))
    return counts.select(
        F.col("table").alias("check"),
        (F.col("rows") >= minimum).alias("ok"),
        F.format_string(VOLUME_DETAIL_FORMAT, F.col("rows"), minimum).alias("detail"),
    )


def volume_checks(raw: DataFrame, stats: DataFrame, min_raw: int = 1, min_stats: int = 1) -> DataFrame:
    """``check, ok, detail``: raw and stats row counts against minimums."""
    return checks_of_counts(table_counts({RAW_TABLE: raw, STATS_TABLE: stats}), min_raw, min_stats)


def latest_n(df: DataFrame, n: int = 5, sort_field: str = "t", tie_keys: list[str] | None = None) -> DataFrame:
    """The n rows with the largest ``sort_field`` (top-k, no global sort).

    ``tie_keys`` (ascending) make the choice among equal values deterministic; by default
    all other columns.
    """
    n = _positive(n)
    keys = tie_keys if tie_keys is not None else [c for c in df.columns if c != sort_field]
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    order = ordered(sort_field, descending=True, floating=sort_field in floats)
    return df.orderBy(*order, *[F.col(k).asc_nulls_first() for k in keys]).limit(n)


def sample_row(df: DataFrame) -> DataFrame:
    """Any one row (zero rows when empty)."""
    return df.limit(1)

"""The two aggregations: per-(t, link) statistics and tumbling-window statistics.

Pure ``DataFrame -> DataFrame``; the same code runs in batch and in Structured Streaming.
Both are hash aggregations with partial (map-side) aggregation, so a hot key costs one
partial row per input partition, never a third of the data in one task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstats.functions.columns import event_time, not_status
from roadstats.schemas import DEFAULT_WATERMARK, DEFAULT_WINDOW_SECONDS, STATUS_LINKS


def status_filter(events: DataFrame, status_links: Iterable[str] = STATUS_LINKS) -> DataFrame:
    """Drop status rows (sentinel links); an empty set disables the filter."""
    predicate = not_status("link", status_links)
    return events if predicate is None else events.where(predicate)


def link_stats(events: DataFrame, status_links: Iterable[str] = STATUS_LINKS) -> DataFrame:
    """``t, link, vcount, vspeed`` per (t, link): platoon rows and mean speed.

    No watermark: in streaming it needs output mode ``update`` (or ``complete``).
    ``vcount`` counts rows; NULL speeds count there but not in the mean.
    """
    return (
        status_filter(events, status_links)
        .groupBy("t", "link")
        .agg(F.count(F.lit(1)).alias("vcount"), F.avg("v").alias("vspeed"))
    )


def with_event_time(events: DataFrame, column: str = "event_ts") -> DataFrame:
    """Add the event-time column derived from ``t`` (see ``functions.event_time``)."""
    return events.withColumn(column, event_time("t"))


def windowed_stats(
    events: DataFrame,
    window_seconds: int = DEFAULT_WINDOW_SECONDS,
    watermark: str | None = DEFAULT_WATERMARK,
    status_links: Iterable[str] = STATUS_LINKS,
) -> DataFrame:
    """Per (tumbling window, link): ``vcount`` and avg/min/max of ``v``.

    Windows are ``[start, end)``, epoch-aligned on simulation seconds. The watermark makes
    output mode ``append`` legal in streaming (closed windows only); batch ignores it. Rows
    without an event time (NULL/NaN ``t``) fall out, since a window needs a time.
    """
    if int(window_seconds) <= 0:
        raise ValueError(f"window_seconds must be positive, got {window_seconds}")
    timed = with_event_time(status_filter(events, status_links))
    if watermark:
        timed = timed.withWatermark("event_ts", watermark)
    return (
        timed.groupBy(F.window("event_ts", f"{int(window_seconds)} seconds").alias("window"), "link")
        .agg(
            F.count(F.lit(1)).alias("vcount"),
            F.avg("v").alias("vspeed_avg"),
            F.min("v").alias("vspeed_min"),
            F.max("v").alias("vspeed_max"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "link",
            "vcount",
            "vspeed_avg",
            "vspeed_min",
            "vspeed_max",
        )
    )


# --- Batch roll-up: one pass over the events for both tables ----------------------------------


def link_partials(events: DataFrame, status_links: Iterable[str] = STATUS_LINKS) -> DataFrame:
    """Per-(t, link) partial aggregates: ``vcount, v_sum, v_count, v_min, v_max``.

    Both tables follow from these without touching the events again: ``stats`` is a projection
    and ``windowed`` a roll-up, because a tumbling window is a union of whole steps (every ``t``
    maps to exactly one window). For batch backfills this halves the scans of the raw events.
    """
    return (
        status_filter(events, status_links)
        .groupBy("t", "link")
        .agg(
            F.count(F.lit(1)).alias("vcount"),
            F.sum("v").alias("v_sum"),
            F.count("v").alias("v_count"),
            F.min("v").alias("v_min"),
            F.max("v").alias("v_max"),
        )
    )


def _mean(total: str, n: str) -> "F.Column":
    # Like avg(): NULL when no value was present.
    return F.when(F.col(n) > 0, F.col(total) / F.col(n).cast("double"))


def link_changes(events: DataFrame, status_links: Iterable[str] = STATUS_LINKS) -> DataFrame:
    """Per-(t, link) additive statistics of some events: ``vcount, v_sum, v_count``.

    Sums over any split of the events give those of the whole, in any order, so batches need not
    know each other (``stats_from_partials`` turns the sums into ``link_stats``).
    """
    return (
        status_filter(events, status_links)
        .groupBy("t", "link")
        .agg(F.count(F.lit(1)).alias("vcount"), F.sum("v").alias("v_sum"), F.count("v").alias("v_count"))
    )


def stats_from_partials(partials: DataFrame) -> DataFrame:
    """``link_stats`` from ``link_partials`` (a projection; the mean is ``sum / count`` as in ``avg``)."""
    return partials.select("t", "link", "vcount", _mean("v_sum", "v_count").alias("vspeed"))


def windowed_from_partials(partials: DataFrame, window_seconds: int = DEFAULT_WINDOW_SECONDS) -> DataFrame:
    """``windowed_stats`` (batch) rolled up from ``link_partials``; steps without an event time drop out."""
    if int(window_seconds) <= 0:
        raise ValueError(f"window_seconds must be positive, got {window_seconds}")
    timed = partials.withColumn("event_ts", event_time("t")).where(F.col("event_ts").isNotNull())
    rolled = timed.groupBy(F.window("event_ts", f"{int(window_seconds)} seconds").alias("window"), "link").agg(
        F.sum("vcount").alias("vcount"),
        F.sum("v_sum").alias("v_sum"),
        F.sum("v_count").alias("v_count"),
        F.min("v_min").alias("vspeed_min"),
        F.max("v_max").alias("vspeed_max"),
    )
    return rolled.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "link",
        "vcount",
        _mean("v_sum", "v_count").alias("vspeed_avg"),
        "vspeed_min",
        "vspeed_max",
    )

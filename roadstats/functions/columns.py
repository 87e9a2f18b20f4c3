"""Scalar column functions.

Each returns a ``Column`` built from built-in functions only (no Python UDF), so Catalyst can
push, fold and code-generate them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadstats.schemas import (
    FREE_FLOW_SPEED,
    MAP_BLUE,
    MAP_GREEN,
    MAP_RED,
    MAP_WIDTH_MIN,
    MAP_WIDTH_SPAN,
    NO_DATA_COLOR,
    STATUS_LINKS,
)


#: Simulation seconds with an event time (years 6 to 9999 as epoch seconds). The margin to the
#: ends of TIMESTAMP leaves room for window ends, the watermark and the state TTL's shift.
MIN_EVENT_SECONDS, MAX_EVENT_SECONDS = -62_000_000_000, 253_400_000_000


def not_status(link: Column | str = "link", status_links: Iterable[str] = STATUS_LINKS) -> Column | None:
    """Predicate that keeps road links and drops status sentinels.

    Three-valued like SQL ``NOT IN``: a NULL link is dropped while filtering is on. Returns
    None for an empty sentinel set, meaning "no filter".
    """
    values = sorted(set(status_links))
    if not values:
        return None
    col = F.col(link) if isinstance(link, str) else link
    return ~col.isin(values)


def event_time(t: Column | str = "t") -> Column:
    """Simulation seconds -> event-time TIMESTAMP (epoch + whole seconds).

    The fraction is truncated toward zero (5.9 -> 5, -0.5 -> 0). NaN, infinities and values
    outside ``MIN_EVENT_SECONDS`` .. ``MAX_EVENT_SECONDS`` give NULL; such rows have no event
    time and leave the windowed aggregation only.
    """
    col = F.col(t) if isinstance(t, str) else t
    inside = col.between(F.lit(float(MIN_EVENT_SECONDS)), F.lit(float(MAX_EVENT_SECONDS)))  # NaN is above all
    return F.when(inside, col.try_cast("long").try_cast("timestamp"))


def to_utc_ntz(ts: Column | str) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ showing the UTC wall clock, independent of the session zone."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_add("MICROSECOND", F.unix_micros(col), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def speed_ratio(vspeed: Column | str = "vspeed", free_flow: float = FREE_FLOW_SPEED) -> Column:
    """``vspeed / free_flow`` clamped to [0, 1]; NULL without a speed."""
    col = F.col(vspeed) if isinstance(vspeed, str) else vspeed
    return F.when(col.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), col / F.lit(float(free_flow)))))


def speed_color(ratio: Column, has_data: Column) -> Column:
    """Green-to-red map colour ``rgb(r,g,b)``; half-even rounding; grey without data or speed."""
    red = F.bround(F.lit(float(MAP_RED)) * (F.lit(1.0) - ratio), 0).cast("int")
    green = F.bround(F.lit(float(MAP_GREEN)) * ratio, 0).cast("int")
    text = F.format_string(f"rgb(%d,%d,{MAP_BLUE})", red, green)
    return F.when(has_data & ratio.isNotNull(), text).otherwise(F.lit(NO_DATA_COLOR))


def line_width(vcount: Column, vmax: Column, has_data: Column) -> Column:
    """Map line width: ``MIN + SPAN * min(1, vcount / vmax)``; MIN without data or when vmax <= 0."""
    share = F.least(F.lit(1.0), vcount.cast("double") / vmax.cast("double"))
    scaled = F.lit(MAP_WIDTH_MIN) + F.lit(MAP_WIDTH_SPAN) * share
    return F.when(has_data & (vmax > 0), scaled).otherwise(F.lit(MAP_WIDTH_MIN))


# NaN order of the read layer: NULL, then NaN, then numbers.


def max_number(col: str) -> Column:
    """Largest value, NaN only if there is no number."""
    return F.coalesce(F.max(F.when(~F.isnan(col), F.col(col))), F.max(col))


def min_number(col: str) -> Column:
    """Smallest value, NaN if there is any."""
    return F.when(F.max(F.isnan(col)), F.lit(float("nan"))).otherwise(F.min(col))


def ordered(col: str, descending: bool = False, floating: bool = True) -> list[Column]:
    """Sort keys of a column: numbers, NaN, NULL when descending, the reverse when ascending."""
    column = F.col(col)
    if not floating:
        return [column.desc_nulls_last() if descending else column.asc_nulls_first()]
    group = F.when(column.isNull(), 0).when(F.isnan(column), 1).otherwise(2)
    return [group.desc(), column.desc_nulls_last()] if descending else [group.asc(), column.asc_nulls_first()]

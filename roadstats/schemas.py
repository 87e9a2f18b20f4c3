"""Declared schemas and fixed values of the data model.

The event schema is fixed and declared up front: no inference, no evolution. Every field is
nullable so a malformed payload decodes to an all-NULL row instead of failing the batch.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- Fixed values (must equal the reference for identical results) -------------------------
# Sentinel values of the ``link`` column that mark a vehicle that is not on a road link:
# waiting_at_origin_node, trip_end.
STATUS_LINKS: frozenset[str] = frozenset({"waiting_at_origin_node", "trip_end"})
# Default tumbling window and watermark of the windowed statistics.
DEFAULT_WINDOW_SECONDS = 30
DEFAULT_WATERMARK = "60 seconds"
# Free-flow speed (km/h) used by the network map colour scale.
FREE_FLOW_SPEED = 50.0
# Default lookback of ``link_state_at`` and the one the network map uses.
DEFAULT_STATE_TOLERANCE = 1.0
MAP_STATE_TOLERANCE = 2.0
# Map colour for a link without data.
NO_DATA_COLOR = "#bbbbbb"
# Network map encoding: colour rgb(220 * (1 - ratio), 180 * ratio, 60) with half-even rounding,
# line width 2 + 12 * min(1, vcount / vmax).
MAP_RED, MAP_GREEN, MAP_BLUE = 220, 180, 60
MAP_WIDTH_MIN, MAP_WIDTH_SPAN = 2.0, 12.0
# Volume check detail text: "<rows> docs (min <minimum>)".
VOLUME_DETAIL_FORMAT = "%d docs (min %d)"
# Default table names of the three sinks.
RAW_TABLE = "raw_data"
STATS_TABLE = "stats"
WINDOWED_TABLE = "stats_windowed"
# -------------------------------------------------------------------------------------------

#: One vehicle (platoon) record at one simulation step.
EVENT_SCHEMA = StructType(
    [
        StructField("name", StringType()),  # platoon id
        StructField("dn", IntegerType()),  # platoon size
        StructField("orig", StringType()),  # origin node
        StructField("dest", StringType()),  # destination node
        StructField("t", DoubleType()),  # simulation seconds
        StructField("link", StringType()),  # road link or a status sentinel
        StructField("x", DoubleType()),  # position on link, -1 on status rows
        StructField("s", DoubleType()),  # spacing to leader, -1 on status rows
        StructField("v", DoubleType()),  # speed km/h, -1 on status rows
    ]
)

EVENT_COLUMNS: tuple[str, ...] = tuple(f.name for f in EVENT_SCHEMA.fields)

#: Broker message: only the payload column is used.
MESSAGE_SCHEMA = StructType([StructField("value", BinaryType())])

#: Per-(t, link) statistics.
STATS_SCHEMA = StructType(
    [
        StructField("t", DoubleType()),
        StructField("link", StringType()),
        StructField("vcount", LongType()),
        StructField("vspeed", DoubleType()),
    ]
)
STATS_KEYS: tuple[str, ...] = ("t", "link")

#: Additive form of the per-(t, link) statistics: what one batch adds to a key.
CHANGES_SCHEMA = StructType(
    [
        StructField("t", DoubleType()),
        StructField("link", StringType()),
        StructField("vcount", LongType()),
        StructField("v_sum", DoubleType()),
        StructField("v_count", LongType()),
    ]
)

#: Per-(tumbling window, link) statistics.
WINDOWED_SCHEMA = StructType(
    [
        StructField("window_start", TimestampType()),
        StructField("window_end", TimestampType()),
        StructField("link", StringType()),
        StructField("vcount", LongType()),
        StructField("vspeed_avg", DoubleType()),
        StructField("vspeed_min", DoubleType()),
        StructField("vspeed_max", DoubleType()),
    ]
)
WINDOWED_KEYS: tuple[str, ...] = ("window_start", "window_end", "link")

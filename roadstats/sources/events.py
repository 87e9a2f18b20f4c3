"""Adapter from the driver's ``events`` table to the vehicle event schema.

The driver data has no vehicle records, so each row of ``events``
(``event_id, ts, user_id, event_type, value, props``) is projected onto the nine event
fields by one deterministic rule. It is a pure projection (no shuffle): ``t`` is the
5-second simulation step of the hour since 2024-01-01, the link comes from ``user_id``, and
``signup`` / ``error`` rows become the two status sentinels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstats.sources.network import LINK_ORDER

# --- Fixed values of the adapter rule ---------------------------------------------------------
EPOCH_NTZ = "2024-01-01 00:00:00"  # step 0
STEP_SECONDS = 5.0  # one simulation step per hour of event time
PLATOON_SIZE = 5
STATUS_BY_EVENT_TYPE = {"signup": "waiting_at_origin_node", "error": "trip_end"}
# ----------------------------------------------------------------------------------------------


def events_from_table(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Project driver ``events`` rows onto the event schema (see module doc).

    ``keep`` names source columns to carry along after the nine event fields.
    """
    base = F.element_at(F.array(*[F.lit(x) for x in LINK_ORDER]), F.pmod(F.col("user_id"), F.lit(len(LINK_ORDER))).cast("int") + 1)
    micros = F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), F.col("ts"))
    step = F.lit(STEP_SECONDS) * F.floor(micros / F.lit(3_600_000_000.0)).cast("double")
    status = F.col("event_type").isin(list(STATUS_BY_EVENT_TYPE))
    link = F.when(F.col("event_type") == "signup", F.lit(STATUS_BY_EVENT_TYPE["signup"]))
    link = link.when(F.col("event_type") == "error", F.lit(STATUS_BY_EVENT_TYPE["error"])).otherwise(base)
    k = F.regexp_extract(F.col("props"), r"([0-9]+)", 1).try_cast("double")
    minus_one = F.lit(-1.0)
    return events.select(
        F.col("user_id").cast("string").alias("name"),
        F.lit(PLATOON_SIZE).cast("int").alias("dn"),
        F.substring(base, 1, 2).alias("orig"),
        F.substring(base, 3, 2).alias("dest"),
        step.alias("t"),
        link.alias("link"),
        F.when(status, minus_one).otherwise(F.lit(STEP_SECONDS) * k).alias("x"),
        F.when(status, minus_one).otherwise(F.lit(500.0) - F.lit(STEP_SECONDS) * k).alias("s"),
        F.when(status, minus_one).otherwise(F.col("value")).alias("v"),
        *[F.col(c) for c in (keep or [])],
    )


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read ``{sf_dir}/events.parquet`` (only the columns the rule needs) and adapt it."""
    raw = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return events_from_table(raw.select("ts", "user_id", "event_type", "value", "props"))

"""The three stored tables, built in batch from the driver's ``events`` table.

``raw`` is the adapted event table, ``stats`` and ``windowed`` are the two aggregations over
it. ``batch_tables`` gives them as lazy plans. ``stored_tables`` writes the aggregates once per
input (as parquet under the shared ``spark.checkpoint.dir``, one pass over the events for both)
and reads them back. That is
the shape of the read layer: questions are answered from the stored aggregates with column
pruning and pushdown, not by re-aggregating the raw events for every query, and the written
tables cut the lineage. ``raw`` stays a projection of ``events`` (a stored copy would be
the same scan).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from roadstats.operators.stats import link_partials, link_stats, stats_from_partials, windowed_from_partials, windowed_stats
from roadstats.schemas import WINDOWED_SCHEMA, WINDOWED_TABLE
from roadstats.session import folder_stamp, new_work_dir, path_exists
from roadstats.streaming.store import time_local
from roadstats.sources.events import load_events


@dataclass(frozen=True)
class Tables:
    raw: DataFrame
    stats: DataFrame
    windowed: DataFrame


def batch_tables(spark: SparkSession, sf_dir: str, window_seconds: int = 30) -> Tables:
    raw = load_events(spark, sf_dir)
    return Tables(raw=raw, stats=link_stats(raw), windowed=windowed_stats(raw, window_seconds=window_seconds))


def fingerprint(spark: SparkSession, path: str) -> str:
    """Changes when the files under ``path`` do (a summary of the folder, no loop over files)."""
    return hashlib.sha256(folder_stamp(spark, path).encode()).hexdigest()[:16]


_STORED: dict[tuple[str, int], str] = {}
PARTIALS = "stats_partials"
PARTIALS_SCHEMA = StructType(
    [
        StructField("t", DoubleType()),
        StructField("link", StringType()),
        StructField("vcount", LongType()),
        StructField("v_sum", DoubleType()),
        StructField("v_count", LongType()),
        StructField("v_min", DoubleType()),
        StructField("v_max", DoubleType()),
    ]
)


def stored_tables(spark: SparkSession, sf_dir: str, window_seconds: int = 30) -> Tables:
    """``stats`` and ``windowed`` from tables written once per input version.

    One pass over the events writes the per-(t, link) partials (``link_partials``). ``stats`` is
    a projection of that table and ``windowed`` is rolled up from it and written too, so the raw
    events are scanned and shuffled once for both. Both are laid out by ``time_local`` (files
    cover narrow time ranges, rows sorted by link inside), so a time slice opens few files and a
    link filter prunes row groups. The folder is used only after both writes have committed. ``raw`` is the lazy
    adapted ``events``.
    """
    events_path = f"{sf_dir.rstrip('/')}/events.parquet"
    key = (fingerprint(spark, events_path), int(window_seconds))
    root = _STORED.get(key)
    if root is None or not path_exists(spark, f"{root}/{WINDOWED_TABLE}/_SUCCESS"):
        root = new_work_dir(spark, f"tables-{key[0]}-{key[1]}s")
        time_local(link_partials(load_events(spark, sf_dir)), "t").write.mode("overwrite").parquet(f"{root}/{PARTIALS}")
        partials = spark.read.schema(PARTIALS_SCHEMA).parquet(f"{root}/{PARTIALS}")
        windowed = time_local(windowed_from_partials(partials, window_seconds), "window_start")
        windowed.write.mode("overwrite").parquet(f"{root}/{WINDOWED_TABLE}")
        _STORED[key] = root
    partials = spark.read.schema(PARTIALS_SCHEMA).parquet(f"{root}/{PARTIALS}")
    return Tables(
        raw=load_events(spark, sf_dir),
        stats=stats_from_partials(partials),
        windowed=spark.read.schema(WINDOWED_SCHEMA).parquet(f"{root}/{WINDOWED_TABLE}"),
    )

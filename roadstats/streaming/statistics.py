"""Statistics of the sink tables' folders: counts and latest times without reading data.

Every batch folder and every segment has a small JSON file of its own under ``{table}__stats``: rows,
smallest and largest time (numbers apart from NaN and NULL) and the distinct links. The sink writes it
from what it observes during the write itself, compaction from the segment it wrote. A folder
without one (its writer died, or it is older) is read instead, so answers are always exact.

``latest_t``, ``table_counts``, ``overview`` and ``distinct_links`` here answer the same questions as
``operators.queries``, over these files. The files are read by Spark, as a table with one row a folder.
``folders_with`` says which folders a slice of time or a link can lie in, so other reads skip the rest.

What cannot be told from statistics is read: a keyed table holds a key in several folders only at
times that several folders share, so there its keys are counted, and its rows elsewhere add up.
Compaction leaves few such times.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadstats.session import delete_path, list_dir, write_small_text

STATS_SUFFIX = "__stats"
#: Most distinct links that a folder's statistics list (about 2 MB); beyond it the links are read.
MOST_LINKS = 100_000
_FIELDS = ("folder", "rows", "t_min", "t_max", "nans", "nulls", "links", "no_link")
FILE_SCHEMA = "folder string, rows bigint, t_min double, t_max double, nans bigint, nulls bigint, links array<string>, no_link boolean"


def time_column(schema: StructType) -> Column:
    """The table's time as a number: simulation seconds, or those of the window's start."""
    if "t" in schema.names:
        return F.col("t")
    return F.unix_micros("window_start") / F.lit(1e6)


def observed(schema: StructType) -> list[Column]:
    """Aggregates of a folder's rows, cheap enough to be observed while they are written."""
    t = time_column(schema)
    number = F.when(~F.isnan(t), t)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.min(number).alias("t_min"),
        F.max(number).alias("t_max"),
        F.count_if(F.isnan(t)).alias("nans"),
        F.count_if(t.isNull()).alias("nulls"),
        F.collect_set("link").alias("links"),
        F.coalesce(F.max(F.col("link").isNull()), F.lit(False)).alias("no_link"),
    ]


def stats_path(table_path: str, folder: str) -> str:
    """File of a folder's statistics; ``folder`` is relative to the table (or its snapshots)."""
    return f"{table_path.rstrip('/')}{STATS_SUFFIX}/{folder.replace('/', ',')}.json"


def write_stats(spark: SparkSession, table_path: str, folder: str, found: dict) -> dict:
    """Store what was observed of ``folder``, in place of what an earlier attempt stored."""
    forget_stats(spark, table_path, folder)
    links = sorted(found["links"]) if len(found["links"]) <= MOST_LINKS else None
    record = {"folder": folder, **{k: found[k] for k in ("rows", "t_min", "t_max", "nans", "nulls", "no_link")}, "links": links}
    # JSON has no infinities; they are stored as the text that Spark's reader takes for them.
    for k in ("t_min", "t_max"):
        if record[k] is not None and abs(record[k]) == float("inf"):
            record[k] = "Infinity" if record[k] > 0 else "-Infinity"
    write_small_text(spark, stats_path(table_path, folder), json.dumps(record))
    return record


def forget_stats(spark: SparkSession, table_path: str, folder: str) -> None:
    """Drop a folder's statistics before the folder is written again or deleted."""
    delete_path(spark, stats_path(table_path, folder))


@dataclass
class FolderStats:
    """The folders that hold a table's rows now, and their statistics, one row a folder."""

    schema: StructType
    keys: Sequence[str] | None
    rows: DataFrame
    #: Stored rows of some of the folders; given a link too, at least that link's.
    read: Callable[..., DataFrame]


def statistics(spark: SparkSession, table_path: str, schema: StructType, keys: Sequence[str] | None, folders: Sequence[str], read: Callable[..., DataFrame]) -> FolderStats:
    """Statistics of ``folders``: stored ones, and for folders without them what their rows say.

    ``read`` gives the rows of some folders, with the folder as ``_folder``.
    """
    known, missing = read_stats(spark, table_path, folders)
    parts = [known] if known is not None else []
    if missing:
        parts.append(read(missing).groupBy(F.col("_folder").alias("folder")).agg(*observed(schema)).select(*_FIELDS))
    rows = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0] if parts else spark.createDataFrame([], FILE_SCHEMA)
    return FolderStats(schema, keys, rows, read)


def read_stats(spark: SparkSession, table_path: str, folders: Sequence[str]) -> tuple[DataFrame | None, list[str]]:
    """(statistics of ``folders``, the folders that have none), from one listing."""
    have = set(list_dir(spark, table_path.rstrip("/") + STATS_SUFFIX))
    named = {f: stats_path(table_path, f) for f in folders}
    found = [p for p in named.values() if p.rsplit("/", 1)[1] in have]
    missing = [f for f, p in named.items() if p.rsplit("/", 1)[1] not in have]
    return (spark.read.schema(FILE_SCHEMA).json(found) if found else None), missing


# --- questions --------------------------------------------------------------------------------


def latest_t(stats: FolderStats) -> DataFrame:
    """One row ``latest_t``: the largest time (NaN only if there is no number)."""
    nan = F.when(F.max("nans") > 0, F.lit(float("nan")))
    return stats.rows.agg(F.coalesce(F.max("t_max"), nan).alias("latest_t"))


def links(stats: FolderStats) -> DataFrame:
    """Distinct ``link`` values, NULL included."""
    none = F.array().cast("array<string>")
    listed = F.concat(F.coalesce("links", none), F.when(F.col("no_link"), F.array(F.lit(None).cast("string"))).otherwise(none))
    found = stats.rows.select(F.explode(listed).alias("link"))
    # Folders with too many links to list are read.
    many = [r["folder"] for r in stats.rows.where(F.col("links").isNull()).select("folder").collect()]
    return (found.unionByName(stats.read(many).select("link")) if many else found).distinct()


def distinct_links(stats: FolderStats) -> DataFrame:
    """Sorted distinct non-NULL ``link`` values."""
    return links(stats).where(F.col("link").isNotNull()).orderBy("link")


def count_rows(stats: FolderStats) -> DataFrame:
    """One row ``rows``: the rows of the table, of a keyed one the keys.

    Keys repeat only where the times of two folders meet: the rows stored there are read and
    counted once a key, all others are known.
    """
    total = stats.rows.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    if stats.keys is None:
        return total
    spans = [tuple(r) for r in stats.rows.select("folder", "t_min", "t_max", (F.col("nans") + F.col("nulls") > 0).alias("odd")).collect()]
    ranges, odd = shared_times([s[1:] for s in spans])
    if not ranges and not odd:
        return total
    meets = [f for f, lo, hi, o in spans if (o and odd) or (lo is not None and any(lo <= b and a <= hi for a, b in ranges))]
    time, of = ("t", F.lit) if "t" in stats.schema.names else ("window_start", lambda x: F.timestamp_micros(F.lit(round(x * 1e6))))
    inside = F.lit(False)
    for a, b in ranges:
        inside = inside | F.col(time).between(of(a), of(b))
    if odd:
        inside = inside | F.col(time).isNull() | (F.isnan(time) if time == "t" else F.lit(False))
    by_key = stats.read(meets).where(inside).groupBy(*stats.keys).agg(F.count(F.lit(1)).alias("n"))
    again = by_key.agg(F.coalesce(F.sum(F.lit(1) - F.col("n")), F.lit(0)).alias("rows"))
    return total.unionByName(again).agg(F.sum("rows").alias("rows"))


def shared_times(spans: Sequence[tuple[float | None, float | None, bool]], most: int = 64) -> tuple[list[tuple[float, float]], bool]:
    """(ranges of time that lie in two or more of the spans, whether two have rows without a time).

    At most ``most`` ranges: nearer ones are joined, so they cover somewhat more.
    """
    found: list[list[float]] = []
    end = None
    for lo, hi in sorted((s[0], s[1]) for s in spans if s[0] is not None):
        if end is not None and lo <= end:
            top = min(hi, end)
            if found and lo <= found[-1][1]:
                found[-1][1] = max(found[-1][1], top)
            else:
                found.append([lo, top])
        end = hi if end is None else max(end, hi)
    if len(found) > most:
        gaps = sorted(range(1, len(found)), key=lambda k: found[k][0] - found[k - 1][1], reverse=True)[: most - 1]
        edges = [0, *sorted(gaps), len(found)]
        found = [[found[a][0], found[b - 1][1]] for a, b in zip(edges, edges[1:])]
    return [(a, b) for a, b in found], sum(bool(s[2]) for s in spans) > 1


def folders_with(stats: FolderStats, t_min: float | None = None, t_max: float | None = None, link: str | None = None) -> list[str]:
    """The folders that may hold rows of a closed range of times and of a link."""
    may = F.lit(True)
    if t_min is not None:
        may = may & (F.col("t_max") >= F.lit(float(t_min)))
    if t_max is not None:
        may = may & (F.col("t_min") <= F.lit(float(t_max)))
    if link is not None:
        may = may & (F.col("links").isNull() | F.array_contains("links", F.lit(link)))
    return sorted(r["folder"] for r in stats.rows.where(may).select("folder").collect())


def overview(raw: FolderStats, stats: FolderStats) -> DataFrame:
    """One row ``raw_rows, current_t, active_links``, like ``operators.queries.overview``.

    Three one-row aggregates over the statistics, put together by a union.
    """
    none = lambda kind: F.lit(None).cast(kind)
    parts = [
        count_rows(raw).select(F.col("rows").alias("raw_rows"), none("double").alias("current_t"), none("long").alias("active_links")),
        latest_t(stats).select(none("long").alias("raw_rows"), F.col("latest_t").alias("current_t"), none("long").alias("active_links")),
        links(stats).agg(F.count(F.lit(1)).alias("n")).select(none("long").alias("raw_rows"), none("double").alias("current_t"), F.col("n").alias("active_links")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).agg(
        F.max("raw_rows").alias("raw_rows"), F.max("current_t").alias("current_t"), F.max("active_links").alias("active_links")
    )


def table_counts(tables: Mapping[str, FolderStats]) -> DataFrame:
    """``table, rows``: exact row count per table."""
    out = None
    for name, stats in tables.items():
        part = count_rows(stats).select(F.lit(name).alias("table"), "rows")
        out = part if out is None else out.unionByName(part)
    return out

"""Reading the sink tables back: committed batches, one row per key, and compaction.

``stats`` comes in two kinds, said by a marker beside the table:

* ``changes``: each batch holds what it adds to a key ``(t, link)`` (count, sum, non-null count).
  The stored table is the sum over the batches of the newest run that has the key.
* ``versions`` (no marker; also ``windowed``): a batch holds the key's value as of then, and the
  stored table is the newest version of each key.

Either way the resolve is a hash aggregate per key with map-side partial aggregation, so a
hot key never gathers in one task.

Compaction adds segments: each call folds only the batches that came after the ones folded
before, and commits by creating the next manifest, which lists the segments in use and, for each
run, the last batch they hold. A run that resumes later is judged by its own bound, so none
of its batches is ever taken for folded. Segments of similar size are merged (``plan_merge``), so a
row is rewritten about once per size tier, not with every merge.

A segment of a keyed table can be cut by link as well as by time (``link_buckets``): links are dealt to
folders by hash, so a read of one link opens the files of one folder.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from roadstats.operators.stats import stats_from_partials
from roadstats.schemas import (
    CHANGES_SCHEMA,
    EVENT_SCHEMA,
    RAW_TABLE,
    STATS_KEYS,
    STATS_SCHEMA,
    STATS_TABLE,
    WINDOWED_KEYS,
    WINDOWED_SCHEMA,
    WINDOWED_TABLE,
)
from roadstats.session import delete_path, folder_bytes, list_dir, modified_at, path_exists, read_small_text, write_small_text
from roadstats.streaming.statistics import FolderStats, folders_with, forget_stats, observed, statistics, write_stats

SNAPSHOT_SUFFIX = "__snapshot"
KIND_SUFFIX = "__kind"
#: Folder column of a segment cut by link.
BUCKET = "link_bucket"
CHANGES = "changes"
VERSIONS = "versions"
#: Segments of a size tier that are merged into one; a tier's sizes span this factor.
FAN_IN = 4
#: Segments up to this size are one tier.
LEAST_TIER_BYTES = 1 << 20
#: A raw segment of this size is never rewritten.
RAW_TARGET_BYTES = 16 << 30
ROLES = {
    "raw": (RAW_TABLE, EVENT_SCHEMA, None),
    "stats": (STATS_TABLE, STATS_SCHEMA, STATS_KEYS),
    "windowed": (WINDOWED_TABLE, WINDOWED_SCHEMA, WINDOWED_KEYS),
    CHANGES: (STATS_TABLE, CHANGES_SCHEMA, STATS_KEYS),
}


def table_kind(spark: SparkSession, path: str) -> str:
    """How the table at ``path`` stores its keys: ``changes`` or ``versions``."""
    return read_small_text(spark, path.rstrip("/") + KIND_SUFFIX) or VERSIONS


def set_kind(spark: SparkSession, path: str, kind: str) -> None:
    """Mark a table's kind; an error if it holds rows of another kind."""
    path = path.rstrip("/")
    if read_small_text(spark, path + KIND_SUFFIX) is None and kind != VERSIONS:
        manifest = read_manifest(spark, path)
        if not manifest.segments and not committed_batches(spark, path):
            write_small_text(spark, path + KIND_SUFFIX, kind)
    if table_kind(spark, path) != kind:
        raise ValueError(f"{path} stores {table_kind(spark, path)}, not {kind}: give the table another name or its own mode")


def time_local(df: DataFrame, time_col: str, files: int | None = None) -> DataFrame:
    """Lay out an aggregate table for reading: range-partitioned on time, sorted by link inside.

    Each output file covers a narrow time range (a time slice, e.g. the map's latest step, opens
    few files), and rows are sorted by ``(link, time)`` within it (a link filter prunes row
    groups). The range exchange samples the data once. With AQE on, small range partitions are
    coalesced, so ``files`` (default: the shuffle partitions) is an upper bound.
    """
    ranged = df.repartitionByRange(int(files), time_col) if files else df.repartitionByRange(time_col)
    return ranged.sortWithinPartitions("link", time_col)


def bucket_of(link: Column, buckets: int) -> Column:
    """Bucket of a link, 0 to ``buckets - 1`` (NULL has one too)."""
    return F.pmod(F.xxhash64(link), F.lit(int(buckets))).cast("int")


def link_and_time_local(df: DataFrame, time_col: str, buckets: int, files: int | None = None) -> DataFrame:
    """``df`` and its ``BUCKET``, range-partitioned on bucket and time and sorted by link inside.

    Written with a folder a bucket, each file holds a range of times of one bucket. The ranges are
    of equal weight, so a bucket with a busy link has more of them and no task gathers it.
    """
    rows = df.withColumn(BUCKET, bucket_of(F.col("link"), buckets))
    ranged = rows.repartitionByRange(int(files), BUCKET, time_col) if files else rows.repartitionByRange(BUCKET, time_col)
    return ranged.sortWithinPartitions(BUCKET, "link", time_col)


def _with_batch_cols(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField("run_id", LongType()), StructField("batch_id", LongType())])


def _version() -> Column:
    return F.struct("run_id", "batch_id")


@dataclass(frozen=True)
class Segment:
    name: str
    bytes: int = 0
    #: Folders by link; 0: not cut by link.
    buckets: int = 0


@dataclass
class Manifest:
    """Segments in use and, by run, the last batch they hold."""

    number: int = -1  #: The newest name taken, readable or not.
    segments: list[Segment] = field(default_factory=list)
    bounds: dict[int, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"segments": [[s.name, s.bytes, s.buckets] for s in self.segments], "bounds": self.bounds})

    @classmethod
    def parse(cls, number: int, text: str) -> "Manifest":
        found = json.loads(text)
        # Older manifests list names alone, or without the buckets.
        segments = [Segment(s) if isinstance(s, str) else Segment(*s) for s in found["segments"]]
        return cls(number, segments, {int(r): int(b) for r, b in found["bounds"].items()})


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    """The newest manifest of the table at ``path`` (an empty one before the first compaction)."""
    base = path.rstrip("/") + SNAPSHOT_SUFFIX
    numbers = sorted((int(n) for n in list_dir(spark, f"{base}/manifests") if n.isdigit()), reverse=True)
    for number in numbers:
        try:
            return Manifest.parse(numbers[0], read_small_text(spark, f"{base}/manifests/{number}") or "")
        except ValueError:
            continue  # its writer died: the one before holds, and the next one takes a new number
    return Manifest(numbers[0] if numbers else -1)


def committed_batches(spark: SparkSession, path: str, after: dict[int, int] | None = None) -> list[tuple[int, int]]:
    """``(run_id, batch_id)`` of the batch folders whose write committed, in order; only those
    after the run's bound in ``after``."""
    found = []
    for run in list_dir(spark, path):
        if not run.startswith("run_id="):
            continue
        run_id = int(run[len("run_id="):])
        for batch in list_dir(spark, f"{path}/{run}"):
            if not batch.startswith("batch_id="):
                continue
            batch_id = int(batch[len("batch_id="):])
            if batch_id > (after or {}).get(run_id, -1) and path_exists(spark, f"{path}/{run}/{batch}/_SUCCESS"):
                found.append((run_id, batch_id))
    return sorted(found)


def _read_batches(spark: SparkSession, path: str, schema: StructType, batches: list[tuple[int, int]], fmt: str) -> DataFrame:
    full = _with_batch_cols(schema)
    paths = [f"{path}/run_id={r}/batch_id={b}" for r, b in batches]
    return spark.read.schema(full).format(fmt).option("basePath", path).load(paths).select(*full.names)


def _read_segments(spark: SparkSession, path: str, schema: StructType, segments: Sequence[Segment], link: str | None = None) -> DataFrame:
    """Rows of some segments; with ``link``, of segments cut by link only its bucket's."""
    full = _with_batch_cols(schema)
    folder = lambda s: f"{path}{SNAPSHOT_SUFFIX}/{s.name}"
    whole, parts = [folder(s) for s in segments if not s.buckets], []
    if whole:
        parts.append(spark.read.schema(full).parquet(*whole))
    for s in segments:
        if s.buckets:
            # The bucket's type is given, so no listing decides it.
            rows = spark.read.schema(StructType([*full.fields, StructField(BUCKET, IntegerType())])).parquet(folder(s))
            parts.append(rows if link is None else rows.where(F.col(BUCKET) == bucket_of(F.lit(link), s.buckets)))
    out = parts[0].select(*full.names)
    for part in parts[1:]:
        out = out.unionByName(part.select(*full.names))
    return out


def read_log(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", runs: Sequence[int] | None = None) -> DataFrame | None:
    """Stored rows of a sink table with their ``run_id`` and ``batch_id``: the segments of the
    newest manifest plus the committed batches after its bounds. With ``runs``, only theirs.
    None when there is nothing.
    """
    path = path.rstrip("/")
    manifest = read_manifest(spark, path)
    batches = committed_batches(spark, path, manifest.bounds)
    parts = []
    if manifest.segments:
        parts.append(_read_segments(spark, path, schema, manifest.segments))
    if runs is not None:
        batches = [b for b in batches if b[0] in runs]
        parts = [p.where(F.col("run_id").isin(list(runs))) for p in parts]
    if batches:
        parts.append(_read_batches(spark, path, schema, batches, fmt))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _newest(log: DataFrame, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key, with its ``run_id`` and ``batch_id``."""
    values = [c for c in schema.names if c not in keys]
    rows = log.withColumn("_version", _version())
    newest = rows.groupBy(*keys).agg(*[F.max_by(c, "_version").alias(c) for c in values], F.max("_version").alias("_version"))
    return newest.select(*schema.names, "_version.run_id", "_version.batch_id")


def _summed(log: DataFrame, one_run: bool) -> DataFrame:
    """The changes of each key added up, with their run and its last batch: those of the newest run
    that has the key (a run that replays the source replaces what an older one stored)."""
    sums = [F.sum(c).alias(c) for c in ("vcount", "v_sum", "v_count")]
    by_run = log.groupBy(*STATS_KEYS, "run_id").agg(*sums, F.max("batch_id").alias("batch_id"))
    if not one_run:
        values = F.struct("vcount", "v_sum", "v_count", "run_id", "batch_id")
        by_run = by_run.groupBy(*STATS_KEYS).agg(F.max_by(values, "run_id").alias("_of")).select(*STATS_KEYS, "_of.*")
    return by_run.select(*CHANGES_SCHEMA.names, "run_id", "batch_id")


def read_changes(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``link_stats`` as stored in a table of changes: late rows count, whatever their batch."""
    log = read_log(spark, path, CHANGES_SCHEMA, fmt)
    if log is None:
        return spark.createDataFrame([], STATS_SCHEMA)
    return stats_from_partials(_summed(log, len(_runs(spark, path)) < 2))


def _runs(spark: SparkSession, path: str) -> set[int]:
    manifest = read_manifest(spark, path)
    return {r for r, _ in committed_batches(spark, path.rstrip("/"), manifest.bounds)} | set(manifest.bounds)


def read_table(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """Read a sink table; with ``keys``, resolve to the newest row per key.

    The resolve is one hash aggregate per key (``max_by`` over the version). A table that does
    not exist yet reads as empty with ``schema``.
    """
    log = read_log(spark, path, schema, fmt)
    if log is None:
        return spark.createDataFrame([], schema)
    return (_newest(log, schema, keys) if keys else log).select(*schema.names)


def latest_run(spark: SparkSession, path: str) -> int | None:
    """The largest run id that a sink table holds (from listings, no data read)."""
    return max(_runs(spark, path), default=None)


def read_stats_table(spark: SparkSession, path: str) -> DataFrame:
    """The per-(t, link) statistics of a table of either kind."""
    if table_kind(spark, path) == CHANGES:
        return read_changes(spark, path)
    return read_table(spark, path, STATS_SCHEMA, STATS_KEYS)


def table_statistics(spark: SparkSession, root: str, table: str, role: str | None = None) -> FolderStats:
    """Statistics of the folders that hold a sink table's rows now (see ``statistics``)."""
    path = f"{root.rstrip('/')}/{table}"
    _, schema, keys = ROLES[_role_of(spark, path, table, role)]
    manifest = read_manifest(spark, path)
    segments = {s.name: s for s in manifest.segments}
    batches = {f"run_id={r}/batch_id={b}": (r, b) for r, b in committed_batches(spark, path, manifest.bounds)}

    def read(folders: Sequence[str], link: str | None = None) -> DataFrame:
        parts = [_read_segments(spark, path, schema, [segments[f]], link).withColumn("_folder", F.lit(f)) for f in folders if f in segments]
        own = [batches[f] for f in folders if f in batches]
        if own:
            name = F.format_string("run_id=%d/batch_id=%d", "run_id", "batch_id")
            parts.append(_read_batches(spark, path, schema, own, "parquet").withColumn("_folder", name))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    return statistics(spark, path, schema, keys, [*segments, *batches], read)


def open_tables(
    spark: SparkSession,
    root: str,
    raw: str = RAW_TABLE,
    stats: str = STATS_TABLE,
    windowed: str = WINDOWED_TABLE,
    raw_latest_run_only: bool = False,
) -> dict[str, DataFrame]:
    """``{"raw", "stats", "windowed"}`` over the sink tables under ``root``.

    ``stats`` and ``windowed`` are resolved to the newest version per key (a re-run over the
    same keys replaces older rows). ``raw`` is the append-only event log of all runs, or with
    ``raw_latest_run_only`` only the newest run's (a re-run that replays the topic then does
    not double the events); other runs' batch folders are not read.
    """
    root = root.rstrip("/")
    raw_df = read_table(spark, f"{root}/{raw}", EVENT_SCHEMA)
    if raw_latest_run_only:
        run = latest_run(spark, f"{root}/{raw}")
        log = read_log(spark, f"{root}/{raw}", EVENT_SCHEMA, runs=[run]) if run is not None else None
        if log is not None:
            raw_df = log.select(*EVENT_SCHEMA.names)
    return {
        "raw": raw_df,
        "stats": read_stats_table(spark, f"{root}/{stats}"),
        "windowed": read_table(spark, f"{root}/{windowed}", WINDOWED_SCHEMA, WINDOWED_KEYS),
    }


def open_slice(
    spark: SparkSession, root: str, table: str, t_min: float | None = None, t_max: float | None = None,
    link: str | None = None, role: str | None = None,
) -> DataFrame:
    """Rows of a sink table with ``t_min <= time <= t_max`` and of one link, read from the folders
    that can hold such rows by their statistics; the others are not opened, nor, in a segment cut by
    link, the other links' buckets.

    All rows of a key have its time and link, so resolving the key from these folders gives what
    the whole table gives. Reads of the newest steps thus cost the same however long the history is.
    Rows without a time (NULL, NaN) are in no range of times.
    """
    path = f"{root.rstrip('/')}/{table}"
    role = _role_of(spark, path, table, role)
    _, schema, keys = ROLES[role]
    shown = STATS_SCHEMA if role == CHANGES else schema
    stats = table_statistics(spark, root, table, role)
    folders = folders_with(stats, t_min, t_max, link)
    if not folders:
        return spark.createDataFrame([], shown)
    inside, of = F.lit(True), F.lit if "t" in schema.names else (lambda x: F.timestamp_micros(F.lit(round(x * 1e6))))
    time_col = "t" if "t" in schema.names else "window_start"
    if t_min is not None:
        inside = inside & (F.col(time_col) >= of(float(t_min)))
    if t_max is not None:
        inside = inside & (F.col(time_col) <= of(float(t_max)))
    if time_col == "t" and (t_min is not None or t_max is not None):
        inside = inside & ~F.isnan(time_col)
    if link is not None:
        inside = inside & (F.col("link") == F.lit(link))
    rows = stats.read(folders, link).where(inside)
    if role == CHANGES:
        return stats_from_partials(_summed(rows, len(_runs(spark, path)) < 2))
    return (_newest(rows, schema, keys) if keys else rows).select(*shown.names)


def _role_of(spark: SparkSession, path: str, table: str, role: str | None) -> str:
    if role is None:
        role = next((name for name, (default, _, _) in ROLES.items() if default == table), None)
        if role is None:
            raise ValueError(f"unknown table {table!r}: name its role, one of {sorted(ROLES)}")
    if role not in ROLES:
        raise ValueError(f"unknown role {role!r}; one of {sorted(ROLES)}")
    return CHANGES if role == "stats" and table_kind(spark, path) == CHANGES else role


def _tier(size: int) -> int:
    tier = 0
    while size > LEAST_TIER_BYTES * FAN_IN**tier:
        tier += 1
    return tier


def plan_merge(segments: Sequence[Segment], new_bytes: int, most_bytes: int | None = None) -> list[Segment]:
    """The segments to write together with ``new_bytes`` of new rows.

    Whenever the new segment and those of its size tier would be ``FAN_IN``, they are merged, and
    the result may meet ``FAN_IN - 1`` segments of the next tier. A byte thus climbs a tier with every
    rewrite, and n compactions rewrite about n log n. Segments of ``most_bytes`` or more stay as
    they are.
    """
    merged: list[Segment] = []
    size = new_bytes
    while most_bytes is None or size < most_bytes:
        same = [s for s in segments if s not in merged and _tier(s.bytes) <= _tier(size) and (most_bytes is None or s.bytes < most_bytes)]
        if len(same) + 1 < FAN_IN:
            break
        merged += same
        size += sum(s.bytes for s in same)
    return merged


def compact(
    spark: SparkSession,
    root: str,
    table: str,
    include_latest: bool = False,
    sort_within: Sequence[str] = ("link", "t"),
    role: str | None = None,
    retain_seconds: float | None = None,
    raw_target_bytes: int = RAW_TARGET_BYTES,
    link_buckets: int = 0,
) -> str | None:
    """Fold the batches that no segment holds yet into a new segment; returns its folder.

    Keyed tables: the segment holds one row per key of those batches (``changes`` added up, else the
    newest version), laid out by ``time_local``, or with ``link_buckets`` by ``link_and_time_local`` in a
    folder a bucket; segments of either layout are read and merged together. Raw: every row, without a shuffle (the scan packs
    the many small batch files into splits of ``spark.sql.files.maxPartitionBytes``). Rows keep
    their ``run_id``/``batch_id``. Segments of similar size go into the new one with them
    (``plan_merge``); a raw segment of ``raw_target_bytes`` is never rewritten.

    The segment counts once the next manifest is created, which only one of two concurrent
    compactions can do; the other's segment is then named by nothing. Compaction can run while
    the stream keeps writing. By default each run's newest batch is left out, because it may
    still be landing; pass ``include_latest=True`` once the streams are stopped. ``role`` says
    what a renamed table holds. With ``retain_seconds``, folded batch folders, and segments that
    a merge replaced, are deleted when they are older. Returns None when there is nothing to
    fold.
    """
    path = f"{root.rstrip('/')}/{table}"
    role = _role_of(spark, path, table, role)
    _, schema, keys = ROLES[role]
    if link_buckets < 0 or (link_buckets and not keys):
        raise ValueError("link_buckets is 0 or more, and 0 for a table without keys")
    base = path + SNAPSHOT_SUFFIX
    manifest = read_manifest(spark, path)
    batches = committed_batches(spark, path, manifest.bounds)
    if not include_latest:
        newest = {r: b for r, b in batches}  # in order: the last of each run stays
        batches = [(r, b) for r, b in batches if b < newest[r]]
    out = None
    if batches:
        rows = _read_batches(spark, path, schema, batches, "parquet")
        new_bytes = sum(folder_bytes(spark, f"{path}/run_id={r}/batch_id={b}") for r, b in batches)
        merged = plan_merge(manifest.segments, new_bytes, None if keys else raw_target_bytes)
        if merged:
            rows = rows.unionByName(_read_segments(spark, path, schema, merged))
        if keys:
            # The resolve already shuffled; lay the (small) aggregate out for slice reads.
            one = _summed(rows, len(_runs(spark, path)) < 2) if role == CHANGES else _newest(rows, schema, keys)
            time_col = "t" if "t" in schema.names else "window_start"
            rows = link_and_time_local(one, time_col, link_buckets) if link_buckets else time_local(one, time_col)
        else:
            cols = [c for c in sort_within if c in schema.names]
            rows = rows.sortWithinPartitions(*cols) if cols else rows
        name = f"segments/{manifest.number + 1:08d}-{uuid.uuid4().hex[:8]}"
        seen = Observation()
        rows.observe(seen, *observed(schema)).write.partitionBy(*[BUCKET] * bool(link_buckets)).parquet(f"{base}/{name}")
        write_stats(spark, path, name, seen.get)
        kept = [s for s in manifest.segments if s not in merged]
        bounds = {**manifest.bounds, **{r: b for r, b in batches}}
        new = Manifest(manifest.number + 1, [*kept, Segment(name, folder_bytes(spark, f"{base}/{name}"), link_buckets)], bounds)
        if not write_small_text(spark, f"{base}/manifests/{new.number}", new.text()):
            raise RuntimeError(f"another compaction of {path} committed first; run it again")
        out = f"{base}/{name}"
    if retain_seconds is not None:
        _remove_folded(spark, path, retain_seconds)
    return out


def _remove_folded(spark: SparkSession, path: str, retain_seconds: float) -> None:
    """Delete batch folders and segments that the newest manifest replaces, once they are older
    than ``retain_seconds`` (longer than any reader keeps a plan), and their statistics."""
    manifest = read_manifest(spark, path)
    limit = time.time() - retain_seconds
    base, used = path + SNAPSHOT_SUFFIX, {s.name for s in manifest.segments}
    old = []
    for run_id, bound in manifest.bounds.items():
        for batch in list_dir(spark, f"{path}/run_id={run_id}"):
            if batch.startswith("batch_id=") and int(batch[len("batch_id="):]) <= bound:
                old.append((f"run_id={run_id}/{batch}", f"{path}/run_id={run_id}/{batch}"))
    old += [(f"segments/{n}", f"{base}/segments/{n}") for n in list_dir(spark, f"{base}/segments") if f"segments/{n}" not in used]
    for name, folder in old:
        if modified_at(spark, folder) <= limit:
            delete_path(spark, folder)
            forget_stats(spark, path, name)

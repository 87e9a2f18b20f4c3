"""Replay-safe micro-batch sink.

Each micro-batch is written to its own directory ``{table}/run_id=R/batch_id=N`` with
``mode("overwrite")``: when Spark re-runs batch N after a failure (offsets and state come
back from the checkpoint), the retry replaces the first attempt instead of appending a
second copy. One write per batch, no extra ``count()`` action, so the micro-batch plan
(source read, parse, aggregate) runs once. The folder's statistics (rows, times, links; see
``statistics``) are observed during the write and stored after it, and a batch without rows
leaves no folder. Readers take only folders whose write committed.

``run_id`` orders runs: batch ids restart at 0 with a new checkpoint, so the run id is
fixed when a checkpoint is first used and stored next to it; a restart from the same
checkpoint reuses it, a fresh run reserves a larger one at its table. Readers resolve keyed
tables to the row of the largest ``(run_id, batch_id)``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from roadstats.session import delete_path, list_dir, read_small_text, write_small_text
from roadstats.streaming.statistics import forget_stats, observed, write_stats

RUN_MARKER = "_roadstats_run"
RUNS_SUFFIX = "__runs"


def _numbers(names: list[str], prefix: str) -> list[int]:
    return [int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit()]


def reserve_run_id(spark: SparkSession, table_path: str) -> int:
    """A run id larger than every one used or reserved at the table before.

    A reservation is a file created only if it is absent, so two starters never share an id,
    whatever their clocks say. The first id of a table is the epoch second.
    """
    base = table_path.rstrip("/")
    used = _numbers(list_dir(spark, base), "run_id=") + _numbers(list_dir(spark, base + RUNS_SUFFIX), "")
    run_id = max([int(time.time()) - 1, *used]) + 1
    while not write_small_text(spark, f"{base}{RUNS_SUFFIX}/{run_id}", str(run_id)):
        run_id += 1
    return run_id


def run_id_for(spark: SparkSession, checkpoint: str, table_path: str) -> int:
    """The run id bound to ``checkpoint``, reserved at the table on first use.

    Stored as a one-line file next to the checkpoint's own files, written in one step and only
    if absent, so two starters cannot both win and a start that died leaves nothing behind.
    """
    marker = f"{checkpoint.rstrip('/')}/{RUN_MARKER}"
    text = read_small_text(spark, marker)
    if not text:
        write_small_text(spark, marker, str(reserve_run_id(spark, table_path)))
        text = read_small_text(spark, marker)
    return int(str(text).strip())


def batch_path(table_path: str, run_id: int, batch_id: int) -> str:
    return f"{table_path.rstrip('/')}/run_id={int(run_id)}/batch_id={int(batch_id)}"


def batch_writer(
    table_path: str,
    run_id: int,
    fmt: str = "parquet",
    sort_within: Sequence[str] | None = ("link", "t"),
    output_files: int | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing each micro-batch to its own overwritable directory.

    ``prepare`` turns the batch into the rows to store (e.g. ``link_changes``), without state.

    Rows are sorted within each output file by ``sort_within`` (when present), so parquet
    row-group min/max statistics prune reads filtered on ``link`` and ``t``. A stateful query
    emits one partition per state partition; ``output_files`` re-partitions the (aggregated,
    small) batch output to that many files so thousands of state partitions do not become
    thousands of tiny files per trigger. The state operator keeps its parallelism (a
    ``coalesce`` would shrink it).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, path = batch.sparkSession, batch_path(table_path, run_id, batch_id)
        folder = path[len(table_path.rstrip("/")) + 1 :]
        rows, seen = prepare(batch) if prepare else batch, Observation()
        out = rows.observe(seen, *observed(rows.schema))
        out = out.repartition(int(output_files)) if output_files else out
        cols = [c for c in (sort_within or ()) if c in rows.columns]
        if cols:
            out = out.sortWithinPartitions(*cols)
        forget_stats(spark, table_path, folder)  # of an attempt that this one replaces
        out.write.mode("overwrite").format(fmt).save(path)
        found = seen.get
        if not found.get("rows"):
            delete_path(spark, path)
            return
        write_stats(spark, table_path, folder, found)

    return write

"""The streaming job: one message source, three independent queries, three sink tables.

* ``raw``      parsed events, output mode ``append``
* ``stats``    per-(t, link) statistics: each batch's additions (``changes``, no state: late rows count
               and nothing grows in memory), or newest versions from state (``update``)
* ``windowed`` tumbling-window statistics, output mode ``append`` (closed windows only)

Each query reads and parses the source itself and has its own checkpoint folder and name.
State partitions of a stateful query are frozen in its checkpoint (AQE does not apply to
stateful streaming), so they are a parameter here.
"""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Iterable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from roadstats.functions.columns import event_time
from roadstats.operators.stats import link_changes, link_stats, status_filter, windowed_stats
from roadstats.schemas import (
    DEFAULT_WATERMARK,
    DEFAULT_WINDOW_SECONDS,
    RAW_TABLE,
    STATS_TABLE,
    STATUS_LINKS,
    WINDOWED_TABLE,
)
from roadstats.sources.codec import parse_events
from roadstats.sources.stream import StreamSource
from roadstats.streaming.sink import batch_writer, run_id_for
from roadstats.streaming.store import CHANGES, VERSIONS, set_kind

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Event-time offset of the state-TTL mode: the first watermark is epoch 0 and the late test
# is "<=", so steps in (-1, 1) would be dropped in the first batch without a positive shift.
TTL_TIME_SHIFT_SECONDS = 86_400


def link_stats_with_ttl(events: DataFrame, ttl: str, status_links: Iterable[str] = STATUS_LINKS) -> DataFrame:
    """``link_stats`` whose state is evicted once the watermark passes a step.

    Groups by ``(event_ts, t, link)`` with a watermark of ``ttl`` on ``event_ts`` (the same
    groups, since ``event_ts`` is a function of ``t``), then drops ``event_ts``. Rows later
    than the watermark are dropped in this mode, and rows without an event time are dropped
    up front (their group could never be evicted).
    """
    shifted = F.timestamp_seconds(F.unix_seconds(event_time("t")) + F.lit(TTL_TIME_SHIFT_SECONDS))
    timed = status_filter(events, status_links).withColumn("event_ts", shifted).where(F.col("event_ts").isNotNull())
    return (
        timed.withWatermark("event_ts", ttl)
        .groupBy("event_ts", "t", "link")
        .agg(F.count(F.lit(1)).alias("vcount"), F.avg("v").alias("vspeed"))
        .select("t", "link", "vcount", "vspeed")
    )


class BatchLogger(StreamingQueryListener):
    """Logs each micro-batch's input rows, rate and watermark drops from query progress.

    Counts come from ``StreamingQueryProgress``, so the sink needs no extra ``count()``
    action (which would run the micro-batch twice).
    """

    def __init__(self, logger_name: str = "roadstats.streaming", remembered: int = 1000) -> None:
        import logging

        self.log = logging.getLogger(logger_name)
        #: The last batches, ``remembered`` at most: (query, batch id, rows).
        self.batches: deque[tuple[str, int, int]] = deque(maxlen=remembered)
        self.started: set[str] = set()
        self.terminated: set[str] = set()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.started.add(str(event.id))
        self.log.info("query %s started (id %s)", event.name, event.id)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        dropped = sum(getattr(op, "numRowsDroppedByWatermark", 0) or 0 for op in (p.stateOperators or []))
        self.batches.append((p.name, p.batchId, p.numInputRows))
        self.log.info(
            "query %s batch %d: %d rows in, %.1f rows/s, %d dropped by watermark",
            p.name, p.batchId, p.numInputRows, p.processedRowsPerSecond or 0.0, dropped,
        )

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.terminated.add(str(event.id))
        self.log.info("query %s terminated%s", event.id, f": {event.exception}" if event.exception else "")


@dataclass
class StreamJob:
    queries: dict[str, StreamingQuery]
    out_root: str
    checkpoint_root: str
    run_ids: dict[str, int]
    session: SparkSession | None = None  # the session the queries run in (see start_streams)
    listener: StreamingQueryListener | None = None

    def drain(self) -> "StreamJob":
        """Wait for ``availableNow`` queries, whose listener then has heard all it will."""
        try:
            drain(self.queries.values())
        finally:
            self._forget_listener()
        return self

    def stop(self) -> None:
        for q in self.queries.values():
            if q.isActive:
                q.stop()
        self._forget_listener()

    def _forget_listener(self, wait_seconds: float = 5.0) -> None:
        """Unregister the listener once it has heard of every query's end."""
        if self.listener is None or self.session is None:
            return
        ids, until = {str(q.id) for q in self.queries.values()}, time.monotonic() + wait_seconds
        while not ids <= getattr(self.listener, "terminated", ids) and time.monotonic() < until:
            time.sleep(0.05)
        self.session.streams.removeListener(self.listener)
        self.listener = None


def run_until_first_ends(spark: SparkSession, job: StreamJob, timeout_seconds: float | None = None, poll_seconds: float = 0.5) -> None:
    """Block until one query of ``job`` ends (or the timeout passes), then stop the others.

    Polls this job's own queries (``awaitAnyTermination`` would also return for queries that
    ended earlier in the session). A failed query re-raises its error here.
    """
    deadline = None if timeout_seconds is None else time.monotonic() + timeout_seconds
    try:
        while deadline is None or time.monotonic() < deadline:
            if any(q.awaitTermination(poll_seconds / max(len(job.queries), 1)) for q in job.queries.values()):
                return
    finally:
        job.stop()


def stream_session(spark: SparkSession, overrides: dict[str, str]) -> SparkSession:
    """A sibling session with the caller's runtime SQL settings plus ``overrides``.

    Stream-only settings (state partitions, state store provider) are applied there, so the
    caller's session is never changed, not even for a moment while queries start.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            session.conf.set(key, value)
    for key, value in overrides.items():
        session.conf.set(key, value)
    return session


def drain(queries: Iterable[StreamingQuery]) -> None:
    """Wait for (``availableNow``) queries to finish; re-raise the first failure."""
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"streaming query {q.name!r} failed: {q.exception()}")


def start_streams(
    spark: SparkSession,
    source: StreamSource,
    out_root: str,
    checkpoint_root: str,
    window_seconds: int = DEFAULT_WINDOW_SECONDS,
    watermark: str = DEFAULT_WATERMARK,
    status_links: Iterable[str] = STATUS_LINKS,
    state_partitions: int | None = None,
    trigger: dict | None = None,
    tables: dict[str, str] | None = None,
    stats_mode: str | None = None,
    state_ttl: str | None = None,
    rocksdb: bool = True,
    debug: bool = False,
    name_prefix: str = "",
    output_files: int | None = None,
    listener: StreamingQueryListener | None = None,
) -> StreamJob:
    """Start the raw, stats and windowed queries (plus a console query when ``debug``).

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (e.g. ``{"availableNow": True}``
    to drain what is there, ``{"processingTime": "1 second"}`` to run continuously).
    The queries run in a sibling session (``stream_session``) with the stream-only settings, so
    the caller's session is left as it was; ``StreamJob.session`` is that session. Wait with
    ``StreamJob.drain()`` or ``run_until_first_ends``. ``output_files`` bounds the
    files per micro-batch of the two aggregate tables (default: one per state partition).
    ``listener`` (e.g. ``BatchLogger()``) is registered on the session before the queries start,
    and unregistered when they have ended. State lives off-heap in RocksDB unless ``rocksdb`` is
    False (the in-memory provider, for small state).

    ``stats_mode``: ``changes`` (default) stores what each batch adds to a key; reads add it up. It
    keeps no state, so it needs no bound. ``update`` keeps every key's running value in state, which
    ``state_ttl`` bounds at the price of dropping later rows. A table keeps the mode it began with.
    """
    names = {"raw": RAW_TABLE, "stats": STATS_TABLE, "windowed": WINDOWED_TABLE, **(tables or {})}
    out_root, checkpoint_root = out_root.rstrip("/"), checkpoint_root.rstrip("/")
    status_links = tuple(status_links)
    if state_ttl is not None and not state_ttl.strip():
        raise ValueError("state_ttl must be a duration such as '10 minutes'")
    stats_mode = stats_mode or ("update" if state_ttl else "changes")
    if stats_mode not in ("changes", "update") or (state_ttl and stats_mode == "changes"):
        raise ValueError("stats_mode is 'changes' (which has no state to bound) or 'update'")
    if not watermark:
        raise ValueError("the windowed query writes closed windows (append) and needs a watermark")

    overrides: dict[str, str] = {}
    if state_partitions:
        overrides["spark.sql.shuffle.partitions"] = str(int(state_partitions))
    if rocksdb:
        # Large state lives off-heap in RocksDB; changelog checkpointing uploads only the
        # changes of each micro-batch instead of a full snapshot.
        overrides["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
        overrides["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    session = stream_session(spark, overrides)

    def parsed() -> DataFrame:
        return parse_events(source.read(session))

    def versions() -> DataFrame:
        return link_stats_with_ttl(parsed(), state_ttl, status_links) if state_ttl else link_stats(parsed(), status_links)

    changes = stats_mode == "changes"
    plans = {
        "raw": (parsed(), "append"),
        "stats": (parsed().select("t", "link", "v"), "append") if changes else (versions(), "update"),
        "windowed": (windowed_stats(parsed(), window_seconds, watermark, status_links), "append"),
    }
    queries: dict[str, StreamingQuery] = {}
    run_ids: dict[str, int] = {}
    if listener is not None:
        session.streams.addListener(listener)
    try:
        for role, (df, mode) in plans.items():
            table = names[role]
            ckpt = f"{checkpoint_root}/{table}"
            if role == "stats":
                set_kind(session, f"{out_root}/{table}", CHANGES if changes else VERSIONS)
            run_ids[role] = run_id_for(session, ckpt, f"{out_root}/{table}")
            writer = (
                df.writeStream.queryName(f"{name_prefix}{table}")
                .outputMode(mode)
                .option("checkpointLocation", ckpt)
                .foreachBatch(
                    batch_writer(
                        f"{out_root}/{table}", run_ids[role], output_files=None if role == "raw" else output_files,
                        prepare=partial(link_changes, status_links=status_links) if role == "stats" and changes else None,
                    )
                )
            )
            if trigger:
                writer = writer.trigger(**trigger)
            queries[role] = writer.start()
        if debug:
            console = (
                versions().writeStream.queryName(f"{name_prefix}debug_console")
                .outputMode("update")
                .format("console")
                .option("truncate", False)
                .option("checkpointLocation", f"{checkpoint_root}/debug")
            )
            queries["debug"] = (console.trigger(**trigger) if trigger else console).start()
    except Exception:
        # Do not leave half a job running; the listener hears of each query's end first.
        StreamJob(queries, out_root, checkpoint_root, run_ids, session, listener).stop()
        raise
    return StreamJob(queries, out_root, checkpoint_root, run_ids, session, listener)

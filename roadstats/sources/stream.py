"""Message stream sources and the time-ordered replay of a finished event table.

A message stream is a streaming DataFrame with a ``value`` column (JSON bytes). It comes from
a broker topic (``format("kafka")``) or from a directory of files holding ``value``; the
same parser and aggregations run on either.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstats.schemas import MESSAGE_SCHEMA
from roadstats.sources.codec import message_value

FILE_FORMATS = ("parquet", "json", "orc", "avro")


def kafka_options(bootstrap_servers: str, topic: str, starting_offsets: str = "latest") -> dict[str, str]:
    """Reader options for one broker topic. ``latest`` skips the backlog, ``earliest`` replays it."""
    if starting_offsets not in ("latest", "earliest") and not starting_offsets.startswith("{"):
        raise ValueError(f"starting_offsets must be 'latest', 'earliest' or a JSON offset map, got {starting_offsets!r}")
    return {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic, "startingOffsets": starting_offsets}


@dataclass(frozen=True)
class StreamSource:
    """Where messages come from: ``fmt`` plus reader options (and a path for files).

    File sources always start at the earliest file; asking one for ``latest`` is an error
    rather than silently ignored. ``max_files_per_trigger`` paces a file replay and
    ``max_offsets_per_trigger`` a topic (the micro-batch size bound of each source type).
    """

    fmt: str = "parquet"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    max_files_per_trigger: int | None = None
    max_offsets_per_trigger: int | None = None

    def __post_init__(self) -> None:
        if self.fmt in FILE_FORMATS:
            if not self.path:
                raise ValueError(f"a {self.fmt} stream source needs a path")
            if self.options.get("startingOffsets", "earliest") != "earliest":
                raise ValueError("file stream sources always start at the earliest file; 'latest' is not supported")
        elif self.fmt != "kafka":
            raise ValueError(f"unsupported stream format {self.fmt!r}")

    @classmethod
    def kafka(
        cls,
        bootstrap_servers: str,
        topic: str,
        starting_offsets: str = "latest",
        max_offsets_per_trigger: int | None = None,
        **extra: str,
    ) -> "StreamSource":
        return cls(
            fmt="kafka",
            options={**kafka_options(bootstrap_servers, topic, starting_offsets), **extra},
            max_offsets_per_trigger=max_offsets_per_trigger,
        )

    def read(self, spark: SparkSession) -> DataFrame:
        """The message stream: a streaming DataFrame whose ``value`` column holds the payload."""
        reader = spark.readStream.format(self.fmt)
        opts = {k: v for k, v in self.options.items() if not (self.fmt != "kafka" and k == "startingOffsets")}
        if self.fmt != "kafka":
            reader = reader.schema(MESSAGE_SCHEMA)
            if self.max_files_per_trigger:
                opts["maxFilesPerTrigger"] = str(int(self.max_files_per_trigger))
        elif self.max_offsets_per_trigger:
            opts["maxOffsetsPerTrigger"] = str(int(self.max_offsets_per_trigger))
        reader = reader.options(**opts)
        stream = reader.load(self.path) if self.path else reader.load()
        return stream.select("value")


def _time_bounds() -> list:
    """min/max of the staged time, NaN excluded (Spark orders NaN above every number)."""
    t = F.when(~F.isnan("_t"), F.col("_t"))
    return [F.min(t).alias("lo"), F.max(t).alias("hi"), F.count(F.lit(1)).alias("n"), _quantiles(CUTS).alias("cuts")]


#: Quantiles of the time that are sketched while staging.
CUTS = 1000


def _quantiles(parts: int):
    """The values of ``_t`` below which lie 1, 2, .. of ``parts`` parts of the rows with a time."""
    shares = [k / parts for k in range(1, parts)]
    return F.approx_percentile(F.when(~F.isnan("_t"), F.col("_t")), F.array(*[F.lit(x) for x in shares]), F.lit(10 * max(parts, CUTS)))


def _equal_weight(staged: DataFrame, cuts: list[float], chunks: int, lo: float, hi: float) -> list[tuple[float, float]]:
    """At most ``chunks`` ranges of about equal weight; a value that fills several is one range."""
    if chunks > CUTS:  # finer than what was sketched: one more pass over the times alone
        cuts, parts = staged.agg(_quantiles(chunks).alias("cuts")).first()["cuts"], chunks
    else:
        parts = CUTS
    chosen = [cuts[round(k * parts / chunks) - 1] for k in range(1, chunks)]
    edges = [lo, *sorted({c for c in chosen if lo < c <= hi}), hi]
    return list(zip(edges[:-1], edges[1:])) if len(edges) > 2 or hi > lo else [(lo, lo + 1.0)]


def replay_to_dir(
    events: DataFrame,
    path: str,
    staging: str,
    chunks: int = 3,
    time_col: str = "t",
    split_steps: bool = False,
    files_per_chunk: int | None = None,
    fmt: str = "parquet",
    ranges: list[tuple[float, float]] | None = None,
    whole: bool = True,
    restage: bool = True,
    pause_seconds: float = 0.0,
    rows_per_range: int = 50_000_000,
    by: str = "rows",
) -> list[tuple[float, float]]:
    """Write ``events`` as messages into ``path`` in time order, one write job per time range.

    The encoded events are staged once (one scan of the source), range-partitioned and sorted
    by time, so that each range's job reads only its part of the staging. Then each of ``chunks``
    ranges of ``time_col`` (more, if a range would average over ``rows_per_range`` rows) is appended
    by its own job, so file modification times follow simulation time and a file stream reads the
    steps in order (pace it with ``max_files_per_trigger``). Ranges hold about as many rows each
    (``by="rows"``: cut at quantiles, sketched while staging; a single step is never cut), so a busy hour
    becomes many batches, or are equally wide (``by="width"``). ``split_steps`` writes each range in two halves chosen by a
    row hash, so every step is spread over two jobs, i.e. two micro-batches. Every row is
    written exactly once. Returns the ranges used (``[lo, hi)``, the last one closed).

    ``whole=False`` replays only the given ``ranges`` (all half-open, no rows without a time),
    e.g. to send a time range again as late data. ``restage=False`` reuses a ``staging``
    folder written by an earlier call over the same events. ``pause_seconds`` waits between
    range writes (producer-side pacing of a live-looking replay); consumers can also pace with
    ``max_files_per_trigger`` or a processing-time trigger. ``files_per_chunk`` sets the files
    per range, like the partitions of a topic.
    """
    if chunks <= 0:
        raise ValueError(f"chunks must be positive, got {chunks}")
    if by not in ("rows", "width"):
        raise ValueError(f"by is 'rows' or 'width', got {by!r}")
    spark = events.sparkSession
    encoded = events.select(
        F.col(time_col).alias("_t"),
        F.xxhash64(*[F.col(c) for c in events.columns]).alias("_h"),
        message_value(events.columns).alias("value"),
    )
    bounds = None
    if restage:
        # The time bounds are observed while staging (no second pass over the data).
        from pyspark.sql import Observation

        seen = Observation()
        ordered = encoded.observe(seen, *_time_bounds()).repartitionByRange("_t").sortWithinPartitions("_t")
        ordered.write.mode("overwrite").parquet(staging)
        bounds = seen.get
    staged = spark.read.parquet(staging)
    if ranges is None:
        if bounds is None:
            bounds = staged.agg(*_time_bounds()).first().asDict()
        lo, hi = bounds.get("lo"), bounds.get("hi")
        if lo is None:
            return []
        chunks = max(chunks, -(-int(bounds["n"]) // rows_per_range))
        if by == "rows":
            ranges = _equal_weight(staged, bounds["cuts"], chunks, lo, hi)
        else:
            width = (hi - lo) / chunks if hi > lo else 1.0
            ranges = [(lo + i * width, lo + (i + 1) * width) for i in range(chunks)]
    timeless = staged.where(F.col("_t").isNull() | F.isnan("_t"))
    for i, (a, b) in enumerate(ranges):
        last = whole and i == len(ranges) - 1
        cond = (F.col("_t") >= F.lit(a)) & ((F.col("_t") <= F.lit(b)) if last else (F.col("_t") < F.lit(b)))
        part = staged.where(cond)
        if last:
            part = part.unionByName(timeless)
        halves = [part.where(F.pmod("_h", F.lit(2)) == 0), part.where(F.pmod("_h", F.lit(2)) == 1)] if split_steps else [part]
        for half in halves:
            out = half.select("value")
            if files_per_chunk:
                out = out.repartition(int(files_per_chunk))
            out.write.mode("append").format(fmt).save(path)
        if pause_seconds > 0 and i < len(ranges) - 1:
            time.sleep(pause_seconds)
    return ranges


def publish_events(
    events: DataFrame,
    fmt: str = "parquet",
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> int:
    """Encode ``events`` as messages and append them to a topic or a folder, unpaced.

    Returns the number of messages written, counted with ``observe`` during the write itself
    (no second pass over the data). For a broker, ``options`` carries
    ``kafka.bootstrap.servers`` and ``topic``.
    """
    from pyspark.sql import Observation

    counter = Observation()
    messages = events.select(message_value(events.columns).alias("value")).observe(counter, F.count(F.lit(1)).alias("n"))
    writer = messages.write.mode("append").format(fmt).options(**(options or {}))
    if path:
        writer.save(path)
    else:
        writer.save()
    return int(counter.get["n"])

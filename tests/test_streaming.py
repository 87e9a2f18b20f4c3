"""Structured Streaming: equivalence with batch, restart, retry, late data, sink rules."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from roadstats.operators.stats import link_stats, windowed_stats
from roadstats.sources.codec import encode_events, parse_events
from roadstats.sources.events import load_events
from roadstats.sources.stream import StreamSource, kafka_options, replay_to_dir
from roadstats.streaming.job import start_streams
from roadstats.streaming.sink import batch_writer
from roadstats.streaming.store import open_tables, read_table
from roadstats.schemas import STATS_KEYS, STATS_SCHEMA
from tests.conftest import SF_SMALL, ev

AVAILABLE_NOW = {"availableNow": True}


def _sorted(df):
    """Rows in order; sums of parts may differ from one sum in the last bits."""
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


def _run(spark, work, messages, **kw):
    source = StreamSource("parquet", messages, max_files_per_trigger=kw.pop("max_files", 1))
    return start_streams(spark, source, f"{work}/tables", f"{work}/ckpt", trigger=AVAILABLE_NOW, **kw).drain()


def _write_files(spark, path, files):
    """Each inner list becomes one message file, written in order (increasing mtimes)."""
    from roadstats.schemas import EVENT_SCHEMA

    for rows in files:
        encode_events(spark.createDataFrame(rows, EVENT_SCHEMA)).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)


@pytest.mark.parametrize("chunks,split,mode", [(1, False, "update"), (3, False, "changes"), (10, False, "changes"), (5, True, "changes"), (4, True, "update")])
def test_stream_equals_batch(spark, work, chunks, split, mode):
    events = load_events(spark, SF_SMALL)
    replay_to_dir(events, f"{work}/msg", f"{work}/stage", chunks=chunks, split_steps=split)
    job = _run(spark, work, f"{work}/msg", stats_mode=mode)
    tables = open_tables(spark, job.out_root)
    assert _sorted(tables["stats"]) == _sorted(link_stats(events))
    assert tables["raw"].count() == events.count()
    if split:  # keys come in two batches; the log holds more rows than the resolved table
        log = spark.read.parquet(f"{job.out_root}/stats")
        assert log.count() > tables["stats"].count()
    max_sec = events.where(~F.col("link").isin("trip_end", "waiting_at_origin_node")).agg(F.max("t")).first()[0]
    closed = windowed_stats(events).where(F.unix_seconds("window_end") <= int(max_sec) - 60)
    assert _sorted(tables["windowed"]) == _sorted(closed)


def test_restart_from_checkpoint_continues(spark, work):
    events = load_events(spark, SF_SMALL)
    ranges = replay_to_dir(events.where("t < 1800"), f"{work}/msg", f"{work}/stage1", chunks=2)
    first = _run(spark, work, f"{work}/msg")
    assert ranges and first.run_ids["stats"] > 0
    replay_to_dir(events.where("t >= 1800"), f"{work}/msg", f"{work}/stage2", chunks=2)
    second = _run(spark, work, f"{work}/msg")
    assert second.run_ids == first.run_ids  # same checkpoint, same run
    batches = {r.batch_id for r in spark.read.parquet(f"{work}/tables/stats").select("batch_id").distinct().collect()}
    assert max(batches) >= 3
    tables = open_tables(spark, second.out_root)
    assert _sorted(tables["stats"]) == _sorted(link_stats(events))
    assert tables["raw"].count() == events.count()


def test_retried_batch_replaces_itself(spark, work, events_df):
    write = batch_writer(f"{work}/stats", run_id=7)
    first = link_stats(events_df([ev(1, "L", 10.0), ev(1, "L", 20.0)]))
    retry = link_stats(events_df([ev(1, "L", 10.0)]))
    write(first, 0)
    write(retry, 0)
    rows = read_table(spark, f"{work}/stats", STATS_SCHEMA, STATS_KEYS).collect()
    assert [(r.t, r.link, r.vcount) for r in rows] == [(1.0, "L", 1)]
    assert spark.read.parquet(f"{work}/stats").count() == 1


def test_newer_version_wins(spark, work, events_df):
    write = batch_writer(f"{work}/stats", run_id=1)
    write(link_stats(events_df([ev(1, "L", 10.0)])), 0)
    write(link_stats(events_df([ev(1, "L", 10.0), ev(1, "L", 30.0), ev(2, "L", 5.0)])), 1)
    batch_writer(f"{work}/stats", run_id=2)(link_stats(events_df([ev(2, "L", 7.0)])), 0)
    rows = {(r.t, r.link): (r.vcount, r.vspeed) for r in read_table(spark, f"{work}/stats", STATS_SCHEMA, STATS_KEYS).collect()}
    assert rows == {(1.0, "L"): (2, 20.0), (2.0, "L"): (1, 7.0)}


def test_late_data_emission(spark, work):
    """Files t={0,10},{10,95},{20,200},{1}; window 30 s, watermark 60 s."""
    files = [[ev(0, "L", 1), ev(10, "L", 1)], [ev(10, "L", 1), ev(95, "L", 1)], [ev(20, "L", 1), ev(200, "L", 1)], [ev(1, "L", 1)]]
    _write_files(spark, f"{work}/msg", files)
    job = _run(spark, work, f"{work}/msg")
    log = spark.read.parquet(f"{work}/tables/stats_windowed")
    emitted = sorted(tuple(r) for r in log.select("batch_id", F.unix_seconds("window_start"), "vcount").collect())
    assert emitted == [(2, 0, 4), (3, 90, 1)]
    progress = job.queries["windowed"].recentProgress
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in progress for op in p["stateOperators"])
    assert dropped == 1
    stats = {(r.t, r.vcount) for r in open_tables(spark, job.out_root)["stats"].collect()}
    assert (1.0, 1) in stats and (10.0, 2) in stats  # stats never drop late rows


def test_append_without_watermark_is_rejected(spark, work):
    _write_files(spark, f"{work}/msg", [[ev(1, "L", 1)]])
    agg = link_stats(parse_events(StreamSource("parquet", f"{work}/msg").read(spark)))
    with pytest.raises(AnalysisException):
        agg.writeStream.outputMode("append").format("console").option("checkpointLocation", f"{work}/c").start()


def test_source_options():
    assert kafka_options("b:9092", "vehicle-events", "earliest") == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "vehicle-events",
        "startingOffsets": "earliest",
    }
    with pytest.raises(ValueError):
        kafka_options("b:9092", "vehicle-events", "newest")
    with pytest.raises(ValueError):
        StreamSource("parquet", "/x", options={"startingOffsets": "latest"})
    with pytest.raises(ValueError):
        StreamSource("parquet", None)
    src = StreamSource.kafka("b:9092", "vehicle-events", "earliest")
    assert src.fmt == "kafka" and src.options["subscribe"] == "vehicle-events"


def test_state_ttl_mode_matches_batch_for_in_order_data(spark, work):
    events = load_events(spark, SF_SMALL)
    replay_to_dir(events, f"{work}/msg", f"{work}/stage", chunks=3)
    job = _run(spark, work, f"{work}/msg", state_ttl="10 minutes", max_files=1)
    assert _sorted(open_tables(spark, job.out_root)["stats"]) == _sorted(link_stats(events))


def test_publish_counts_messages(spark, work):
    from roadstats.sources.stream import publish_events

    events = load_events(spark, SF_SMALL)
    n = publish_events(events, "parquet", f"{work}/pub")
    assert n == events.count()
    back = parse_events(spark.read.parquet(f"{work}/pub"))
    assert _sorted(back) == _sorted(events)


def test_run_until_first_ends(spark, work):
    from roadstats.streaming.job import run_until_first_ends

    _write_files(spark, f"{work}/msg", [[ev(1, "L", 1.0)]])
    job = start_streams(spark, StreamSource("parquet", f"{work}/msg"), f"{work}/t", f"{work}/c", trigger=AVAILABLE_NOW)
    run_until_first_ends(spark, job, timeout_seconds=120)
    assert not any(q.isActive for q in job.queries.values())


def test_compaction_snapshot_and_later_batches(spark, work, events_df):
    from roadstats.streaming.store import compact, read_manifest

    root = f"{work}/tables"
    write = batch_writer(f"{root}/stats", run_id=3)
    write(link_stats(events_df([ev(1, "L", 10.0)])), 0)
    write(link_stats(events_df([ev(1, "L", 10.0), ev(1, "L", 20.0), ev(2, "L", 4.0)])), 1)
    write(link_stats(events_df([ev(3, "L", 6.0)])), 2)
    before = _sorted(read_table(spark, f"{root}/stats", STATS_SCHEMA, STATS_KEYS))
    snap = compact(spark, root, "stats")  # folds batches 0 and 1, leaves the newest
    assert snap is not None and read_manifest(spark, f"{root}/stats").bounds == {3: 1}
    assert _sorted(read_table(spark, f"{root}/stats", STATS_SCHEMA, STATS_KEYS)) == before
    write(link_stats(events_df([ev(2, "L", 8.0), ev(2, "L", 4.0)])), 3)  # newer version of t=2
    rows = {r.t: (r.vcount, r.vspeed) for r in read_table(spark, f"{root}/stats", STATS_SCHEMA, STATS_KEYS).collect()}
    assert rows == {1.0: (2, 15.0), 2.0: (2, 6.0), 3.0: (1, 6.0)}
    # The second compaction reads the two batches after the first one only.
    final = compact(spark, root, "stats", include_latest=True)
    assert {r.batch_id for r in spark.read.parquet(final).collect()} == {2, 3}
    assert read_manifest(spark, f"{root}/stats").bounds == {3: 3}
    assert {r.t: (r.vcount, r.vspeed) for r in read_table(spark, f"{root}/stats", STATS_SCHEMA, STATS_KEYS).collect()} == rows
    assert compact(spark, root, "stats", include_latest=True) is None  # nothing new


def test_rocksdb_state_store_and_output_files(spark, work):
    events = load_events(spark, SF_SMALL)
    replay_to_dir(events, f"{work}/msg", f"{work}/stage", chunks=2)
    job = _run(spark, work, f"{work}/msg", rocksdb=True, state_partitions=4, output_files=1)
    assert _sorted(open_tables(spark, job.out_root)["stats"]) == _sorted(link_stats(events))
    files = spark.read.parquet(f"{job.out_root}/stats").select(F.input_file_name().alias("f"), "batch_id").distinct()
    per_batch = files.groupBy("batch_id").count().collect()
    assert per_batch and all(r["count"] == 1 for r in per_batch)


def test_cli_stream_query_check(spark, work, capsys):
    from roadstats.__main__ import main

    events = load_events(spark, SF_SMALL)
    replay_to_dir(events, f"{work}/msg", f"{work}/stage", chunks=2)
    assert main(["stream", "--format", "parquet", "--path", f"{work}/msg", "--out", f"{work}/tables",
                 "--checkpoint", f"{work}/ckpt", "--available-now", "--state-partitions", "2"]) == 0
    assert main(["check", "--root", f"{work}/tables"]) == 0
    assert "[OK] raw_data" in capsys.readouterr().out
    assert main(["query", "top-congested", "--root", f"{work}/tables", "--n", "3"]) == 0
    assert main(["check", "--root", f"{work}/tables", "--min-raw", str(10**9)]) == 1
    root = ["--root", f"{work}/tables"]
    for name, extra in [
        ("avg-speed", ["--ascending"]), ("speed-delta", []), ("state", ["--t", "1820", "--tolerance", "10"]),
        ("network", []), ("link", ["--link", "I2I1"]), ("series", ["--link", "I2I1"]),
        ("windowed-series", ["--link", "I2I1"]), ("latest-t", []), ("counts", []),
        ("distinct-links", ["--table", "raw"]), ("overview", []), ("latest-n", ["--table", "windowed"]),
    ]:
        assert main(["query", name, *root, "--rows", "3", *extra]) == 0, name
    with pytest.raises(ValueError):
        main(["query", "state", *root])
    assert main(["query", "series", *root, "--link", "I2I1", "--out", f"{work}/series"]) == 0
    assert spark.read.parquet(f"{work}/series").count() == link_stats(events).where("link = 'I2I1'").count()
    assert main(["compact", "--root", f"{work}/tables", "--include-latest"]) == 0
    assert main(["compact", "--root", f"{work}/tables", "--table", "raw_data", "--include-latest"]) == 0
    # Renamed tables, as with configurable collection names.
    assert main(["stream", "--format", "parquet", "--path", f"{work}/msg", "--out", f"{work}/named",
                 "--checkpoint", f"{work}/ckpt2", "--available-now", "--state-partitions", "2",
                 "--stats-table", "per_step", "--windowed-table", "per_window", "--raw-table", "events_raw"]) == 0
    assert sorted(n for n in os.listdir(f"{work}/named") if "__" not in n) == ["events_raw", "per_step", "per_window"]
    assert main(["compact", "--root", f"{work}/named", "--table", "per_step", "--role", "stats", "--include-latest"]) == 0
    assert main(["check", "--root", f"{work}/named", "--stats-table", "per_step", "--raw-table", "events_raw"]) == 0


def test_debug_console_query(spark, work):
    _write_files(spark, f"{work}/msg", [[ev(1, "L", 1.0), ev(1, "L", 3.0)]])
    job = start_streams(spark, StreamSource("parquet", f"{work}/msg"), f"{work}/t", f"{work}/c", trigger=AVAILABLE_NOW, debug=True)
    job.drain()
    assert set(job.queries) == {"raw", "stats", "windowed", "debug"}
    assert job.queries["debug"].lastProgress["numInputRows"] == 2
    assert os.path.isdir(f"{work}/c/debug")  # its checkpoint lies with the others


def test_incomplete_compaction_is_ignored(spark, work, events_df):
    from roadstats.session import write_small_text
    from roadstats.streaming.store import SNAPSHOT_SUFFIX, compact

    root = f"{work}/tables"
    write = batch_writer(f"{root}/stats", run_id=5)
    write(link_stats(events_df([ev(1, "L", 10.0)])), 0)
    write(link_stats(events_df([ev(2, "L", 20.0)])), 1)
    compact(spark, root, "stats", include_latest=True)
    # A segment no manifest names, and a manifest that was cut short, must not count.
    events_df([ev(9, "L")]).write.parquet(f"{root}/stats{SNAPSHOT_SUFFIX}/segments/00000001-dead")
    write_small_text(spark, f"{root}/stats{SNAPSHOT_SUFFIX}/manifests/1", '{"segm')
    rows = {(r.t, r.vcount) for r in read_table(spark, f"{root}/stats", STATS_SCHEMA, STATS_KEYS).collect()}
    assert rows == {(1.0, 1), (2.0, 1)}


def test_empty_markers_stop_nothing(spark, work, events_df):
    from roadstats.session import read_small_text, write_small_text
    from roadstats.streaming.sink import run_id_for
    from roadstats.streaming.store import SNAPSHOT_SUFFIX, compact

    root = f"{work}/tables"
    write = batch_writer(f"{root}/stats", run_id=5)
    write(link_stats(events_df([ev(1, "L", 10.0)])), 0)
    os.makedirs(f"{root}/stats{SNAPSHOT_SUFFIX}/manifests")
    open(f"{root}/stats{SNAPSHOT_SUFFIX}/manifests/0", "w").close()  # its writer died
    assert compact(spark, root, "stats", include_latest=True) is not None
    write(link_stats(events_df([ev(2, "L", 20.0)])), 1)
    assert compact(spark, root, "stats", include_latest=True) is not None  # and the next one
    rows = {(r.t, r.vcount) for r in read_table(spark, f"{root}/stats", STATS_SCHEMA, STATS_KEYS).collect()}
    assert rows == {(1.0, 1), (2.0, 1)}
    os.makedirs(f"{work}/ckpt")
    open(f"{work}/ckpt/_roadstats_run", "w").close()
    assert run_id_for(spark, f"{work}/ckpt", f"{root}/stats") == run_id_for(spark, f"{work}/ckpt", f"{root}/stats") >= 6
    # One of two writers of a name wins, and no draft is left.
    assert write_small_text(spark, f"{work}/m/one", "a") and not write_small_text(spark, f"{work}/m/one", "b")
    assert read_small_text(spark, f"{work}/m/one") == "a" and os.listdir(f"{work}/m") == ["one"]
    assert read_small_text(spark, f"{work}/m/none") is None
    with pytest.raises(ValueError):
        write_small_text(spark, f"{work}/m/two", "")


def test_older_run_that_resumes_after_compaction_keeps_its_rows(spark, work, events_df):
    from roadstats.streaming.store import compact

    root = f"{work}/tables"
    old, new = batch_writer(f"{root}/raw_data", run_id=100), batch_writer(f"{root}/raw_data", run_id=200)
    old(events_df([ev(1, "L")]), 0)
    new(events_df([ev(2, "L")]), 0)
    compact(spark, root, "raw_data", include_latest=True)
    old(events_df([ev(3, "L")]), 1)
    assert sorted(r.t for r in open_tables(spark, root)["raw"].collect()) == [1.0, 2.0, 3.0]
    compact(spark, root, "raw_data", include_latest=True)
    assert sorted(r.t for r in open_tables(spark, root)["raw"].collect()) == [1.0, 2.0, 3.0]


def test_uncommitted_and_empty_batches(spark, work, events_df):
    root = f"{work}/tables"
    write = batch_writer(f"{root}/raw_data", run_id=1)
    write(events_df([ev(1, "L")]), 0)
    write(events_df([]), 1)  # no folder for a batch without rows
    assert sorted(os.listdir(f"{root}/raw_data/run_id=1")) == ["batch_id=0"]
    write(events_df([ev(2, "L")]), 2)
    os.remove(f"{root}/raw_data/run_id=1/batch_id=2/_SUCCESS")  # the job died while it committed
    assert [r.t for r in open_tables(spark, root)["raw"].collect()] == [1.0]


def test_retention_merging_and_renamed_tables(spark, work, events_df):
    from roadstats.streaming import store

    root, n = f"{work}/tables", store.FAN_IN + 1
    write = batch_writer(f"{root}/per_step", run_id=1)
    for b in range(n):
        write(link_stats(events_df([ev(b, "L", 1.0), ev(0, "L", float(b))])), b)
        assert store.compact(spark, root, "per_step", include_latest=True, role="stats", retain_seconds=0) is not None
        assert os.listdir(f"{root}/per_step/run_id=1") == []  # folded and past its retention
    manifest = store.read_manifest(spark, f"{root}/per_step")
    assert len(manifest.segments) == len(os.listdir(f"{root}/per_step__snapshot/segments")) == len(os.listdir(f"{root}/per_step__stats")) == 2
    rows = {r.t: r.vspeed for r in open_tables(spark, root, stats="per_step")["stats"].collect()}
    assert rows == {0.0: float(n - 1), **{float(b): 1.0 for b in range(1, n)}}
    with pytest.raises(ValueError, match="role"):
        store.compact(spark, root, "per_step")


@pytest.mark.parametrize("ttl", [None, "10 minutes"])
def test_times_out_of_range_do_not_stop_the_stream(spark, work, ttl):
    odd = [1e13, 1e15, 9e18, -1e15, float("nan")]
    _write_files(spark, f"{work}/msg", [[ev(1, "L", 1.0), *[ev(t, "L", 2.0) for t in odd]]])
    _run(spark, work, f"{work}/msg", state_ttl=ttl)
    _write_files(spark, f"{work}/msg", [[ev(200, "L", 3.0)]])
    job = _run(spark, work, f"{work}/msg", state_ttl=ttl)
    tables = open_tables(spark, job.out_root)
    assert tables["raw"].count() == 7
    stats = {r.t for r in tables["stats"].collect() if r.t == r.t}
    assert stats == ({1.0, 200.0} if ttl else {1.0, 200.0, *odd[:4]})
    assert [r.vcount for r in tables["windowed"].collect()] == [1]  # the first window is closed by t = 200


def test_nan_and_null_time_do_not_stop_the_stream(spark, work):
    nan = float("nan")
    _write_files(spark, f"{work}/msg", [[ev(1, "L", 1.0), ev(nan, "L", 2.0), ev(None, "L", 3.0), ev(1e300, "L", 4.0)]])
    job = _run(spark, work, f"{work}/msg")
    tables = open_tables(spark, job.out_root)
    assert tables["raw"].count() == 4
    wq = job.queries["windowed"]
    assert wq.exception() is None
    assert sum(p["numInputRows"] for p in wq.recentProgress) == 4  # read all, no ANSI cast failure
    stats = {(None if r.t is None else ("nan" if r.t != r.t else r.t)): r.vcount for r in tables["stats"].collect()}
    assert stats == {1.0: 1, "nan": 1, None: 1, 1e300: 1}


def test_batch_logger_counts_rows(spark, work):
    import time as _time

    from roadstats.streaming.job import BatchLogger

    _write_files(spark, f"{work}/msg", [[ev(1, "L", 1.0)], [ev(2, "L", 2.0), ev(3, "L", 2.0)]])
    logger = BatchLogger()
    job = None
    try:
        job = _run(spark, work, f"{work}/msg", listener=logger, name_prefix="logged_")
        deadline = _time.time() + 30
        while _time.time() < deadline and sum(n for name, _, n in logger.batches if name == "logged_raw_data") < 3:
            _time.sleep(0.2)  # listener events arrive asynchronously
        assert sum(n for name, _, n in logger.batches if name == "logged_raw_data") == 3
        assert job.queries["raw"].lastProgress is not None
    finally:
        if job is not None:
            job.session.streams.removeListener(logger)


def test_malformed_messages_kept_raw_dropped_from_stats(spark, work):
    good = '{"name":"a","dn":5,"orig":"I1","dest":"W1","t":5.0,"link":"I1W1","x":1.0,"s":2.0,"v":30.0}'
    payloads = [good, "not json", "", "[]", '{"name":"b","t":"abc","link":"I1W1","v":10.0}']
    spark.createDataFrame([(p.encode(),) for p in payloads], "value binary").coalesce(1).write.parquet(f"{work}/msg")
    job = _run(spark, work, f"{work}/msg")
    tables = open_tables(spark, job.out_root)
    raw = tables["raw"].collect()
    assert len(raw) == 5
    assert sum(all(v is None for v in r) for r in raw) == 3
    stats = {(r.t, r.link): r.vcount for r in tables["stats"].collect()}
    assert stats == {(5.0, "I1W1"): 1, (None, "I1W1"): 1}  # t NULL keeps its group, status filter drops NULL links


def test_raw_latest_run_only(spark, work, events_df):
    from roadstats.schemas import EVENT_SCHEMA

    root = f"{work}/tables"
    rows = [ev(1, "L", 1.0), ev(2, "L", 2.0)]
    batch_writer(f"{root}/raw_data", run_id=10)(events_df(rows), 0)
    batch_writer(f"{root}/raw_data", run_id=11)(events_df(rows), 0)  # a fresh run replaying the topic
    assert open_tables(spark, root)["raw"].count() == 4
    latest = open_tables(spark, root, raw_latest_run_only=True)["raw"]
    assert latest.count() == 2 and latest.columns == list(EVENT_SCHEMA.names)


def test_replay_pacing_and_file_order(spark, work):
    events = load_events(spark, SF_SMALL)
    t0 = time.time()
    ranges = replay_to_dir(events, f"{work}/msg", f"{work}/stage", chunks=3, files_per_chunk=2, pause_seconds=0.5)
    assert time.time() - t0 >= 1.0 and len(ranges) == 3
    msgs = spark.read.parquet(f"{work}/msg")
    assert parse_events(msgs).count() == events.count()
    per_file = (
        msgs.select(
            F.col("_metadata.file_path").alias("f"),
            F.col("_metadata.file_modification_time").alias("m"),
            F.get_json_object(F.col("value").cast("string"), "$.t").cast("double").alias("t"),
        )
        .groupBy("f")
        .agg(F.max("m").alias("m"), F.min("t").alias("tmin"))
        .orderBy("m")
        .collect()
    )
    assert len(per_file) == 6  # 3 ranges x 2 files
    index = [max(i for i, (lo, _) in enumerate(ranges) if r.tmin >= lo) for r in per_file]
    assert index == sorted(index)  # files of a later range are all newer


def test_raw_compaction_packs_files_and_keeps_rows(spark, work, events_df):
    from roadstats.streaming.store import compact

    root = f"{work}/tables"
    for b in range(4):
        batch_writer(f"{root}/raw_data", run_id=2)(events_df([ev(b, "L", 1.0), ev(b, "trip_end")]).repartition(2), b)
    before = _sorted(open_tables(spark, root)["raw"])
    snap = compact(spark, root, "raw_data")  # folds batches 0-2
    assert snap is not None
    assert spark.read.parquet(snap).count() == 6
    assert _sorted(open_tables(spark, root)["raw"]) == before
    batch_writer(f"{root}/raw_data", run_id=2)(events_df([ev(9, "L", 1.0)]), 4)
    assert open_tables(spark, root)["raw"].count() == 9
    assert open_tables(spark, root, raw_latest_run_only=True)["raw"].count() == 9


def test_caller_session_conf_is_untouched(spark, work):
    _write_files(spark, f"{work}/msg", [[ev(1, "L", 1.0)]])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    job = _run(spark, work, f"{work}/msg", state_partitions=3, rocksdb=True)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert job.session.conf.get("spark.sql.shuffle.partitions") == "3"
    assert job.session.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")


def test_replay_ranges_ignore_nan_and_keep_every_row(spark, work, events_df):
    rows = [ev(0, "L", 1.0), ev(10, "L", 1.0), ev(float("nan"), "L", 1.0), ev(None, "L", 1.0), ev(30, "L", 1.0)]
    ranges = replay_to_dir(events_df(rows), f"{work}/msg", f"{work}/stage", chunks=3, by="width")
    assert ranges == [(0.0, 10.0), (10.0, 20.0), (20.0, 30.0)]
    assert spark.read.parquet(f"{work}/msg").count() == 5


def test_stop_midway_then_resume(spark, work):
    events = load_events(spark, SF_SMALL)
    replay_to_dir(events, f"{work}/msg", f"{work}/stage", chunks=6)
    source = StreamSource("parquet", f"{work}/msg", max_files_per_trigger=1)
    args = (spark, source, f"{work}/tables", f"{work}/ckpt")
    job = start_streams(*args, trigger={"processingTime": "0 seconds"}, state_partitions=2)
    deadline = time.time() + 60
    while time.time() < deadline:
        p = job.queries["stats"].lastProgress
        if p is not None and p["batchId"] >= 1:
            break
        time.sleep(0.05)
    job.stop()  # may interrupt a batch half way; it is re-run on restart
    done = job.queries["stats"].lastProgress["batchId"]
    assert done < 5, "stopped too late to test a resume"
    resumed = start_streams(*args, trigger=AVAILABLE_NOW, state_partitions=2).drain()
    assert resumed.run_ids == job.run_ids
    tables = open_tables(spark, resumed.out_root)
    assert _sorted(tables["stats"]) == _sorted(link_stats(events))
    assert tables["raw"].count() == events.count()
    max_sec = events.where(~F.col("link").isin("trip_end", "waiting_at_origin_node")).agg(F.max("t")).first()[0]
    closed = windowed_stats(events).where(F.unix_seconds("window_end") <= int(max_sec) - 60)
    assert _sorted(tables["windowed"]) == _sorted(closed)


def test_failed_start_leaves_nothing_running(spark, work):
    from roadstats.streaming.job import BatchLogger

    _write_files(spark, f"{work}/msg", [[ev(1, "L", 1.0)]])
    src = StreamSource("parquet", f"{work}/msg")
    with pytest.raises(ValueError):
        start_streams(spark, src, f"{work}/t", f"{work}/c", watermark=None)
    watcher = BatchLogger()
    with pytest.raises(Exception):  # raw starts, then stats reuses its name while raw is active
        start_streams(
            spark, src, f"{work}/t", f"{work}/c", tables={"stats": "raw_data"}, listener=watcher,
            trigger={"processingTime": "30 seconds"},
        )
    deadline = time.time() + 30
    while time.time() < deadline and (not watcher.started or watcher.started - watcher.terminated):
        time.sleep(0.1)
    assert watcher.started and watcher.started <= watcher.terminated


@pytest.mark.parametrize("fmt", ["json", "orc", "avro"])
def test_folder_source_formats(spark, work, fmt):
    events = load_events(spark, SF_SMALL)
    try:
        replay_to_dir(events, f"{work}/msg", f"{work}/stage", chunks=2, fmt=fmt)
    except Exception as exc:  # noqa: BLE001
        if fmt == "avro" and "avro" in str(exc).lower():
            pytest.skip("spark-avro is not on the classpath")
        raise
    job = start_streams(spark, StreamSource(fmt, f"{work}/msg"), f"{work}/t", f"{work}/c", trigger=AVAILABLE_NOW).drain()
    assert _sorted(open_tables(spark, job.out_root)["stats"]) == _sorted(link_stats(events))


def test_run_ids_bound_to_checkpoints(spark, work):
    from roadstats.streaming.sink import reserve_run_id, run_id_for

    table = f"{work}/tables/raw_data"
    first = run_id_for(spark, f"{work}/ckpt-a", table)
    assert run_id_for(spark, f"{work}/ckpt-a", table) == first  # a restart keeps its run
    # Fresh checkpoints get newer runs, also within the same second.
    others = [run_id_for(spark, f"{work}/ckpt-{k}", table) for k in "bcd"]
    assert [first, *others] == list(range(first, first + 4))
    os.makedirs(f"{table}/run_id={first + 50}")  # a clock that stepped back
    assert reserve_run_id(spark, table) == first + 51


def test_cli_continuous_with_timeout(spark, work):
    from roadstats.__main__ import main

    _write_files(spark, f"{work}/msg", [[ev(1, "L", 1.0)], [ev(2, "L", 2.0)]])
    t0 = time.time()
    assert main(["stream", "--format", "parquet", "--path", f"{work}/msg", "--out", f"{work}/t", "--checkpoint",
                 f"{work}/c", "--trigger-seconds", "0.5", "--timeout-seconds", "6", "--state-partitions", "2"]) == 0
    assert 5 <= time.time() - t0 < 60
    assert open_tables(spark, f"{work}/t")["raw"].count() == 2


def test_compacting_every_table_keeps_reads(spark, work):
    from roadstats.streaming.store import compact

    events = load_events(spark, SF_SMALL)
    replay_to_dir(events, f"{work}/msg", f"{work}/stage", chunks=4)
    job = _run(spark, work, f"{work}/msg", state_partitions=2)
    before = {k: _sorted(v) for k, v in open_tables(spark, job.out_root).items()}
    for table in ("stats", "stats_windowed", "raw_data"):
        assert compact(spark, job.out_root, table, include_latest=True) is not None
    after = {k: _sorted(v) for k, v in open_tables(spark, job.out_root).items()}
    assert after == before

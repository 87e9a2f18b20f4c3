"""Additive stats, folder statistics and compaction by size tiers."""

from __future__ import annotations

import math
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from roadstats.operators import queries as q
from roadstats.operators.stats import link_changes, link_stats
from roadstats.schemas import CHANGES_SCHEMA, EVENT_SCHEMA, STATS_KEYS
from roadstats.sources.codec import encode_events
from roadstats.sources.stream import StreamSource
from roadstats.streaming import statistics as st
from roadstats.streaming import store
from roadstats.streaming.job import start_streams
from roadstats.streaming.sink import batch_writer
from tests.conftest import ev

NAN = float("nan")


def _rows(df):
    out = []
    for r in df.collect():
        out.append(tuple("nan" if isinstance(x, float) and math.isnan(x) else round(x, 9) if isinstance(x, float) else x for x in r))
    return sorted(out, key=repr)


def _changes(spark, root, batches, events_df, run=1, first=0):
    """Batches written as a job in the mode ``changes`` writes them."""
    store.set_kind(spark, f"{root}/stats", store.CHANGES)
    write = batch_writer(f"{root}/stats", run_id=run, prepare=link_changes)
    for b, rows in enumerate(batches, start=first):
        write(events_df(rows), b)


def _files(df):
    return [f for f in df.inputFiles() if "__stats/" not in f]


BATCHES = [
    [ev(1, "A", 10.0), ev(1, "A", 20.0), ev(2, "B", 5.0)],
    [ev(2, "B", 7.0), ev(3, "A"), ev(3, "C", NAN)],
    [ev(1, "A", 0.5), ev(9, "D", 1.0), ev(NAN, "A", 2.0), ev(None, "B", 3.0)],
    [ev(20, "A", 4.0), ev(NAN, "A", 6.0)],
]


def test_changes_add_up_to_the_batch_result(spark, work, events_df):
    root = f"{work}/tables"
    _changes(spark, root, BATCHES, events_df)
    every = events_df([r for b in BATCHES for r in b])
    assert _rows(store.open_tables(spark, root)["stats"]) == _rows(link_stats(every))
    store.compact(spark, root, "stats", include_latest=True)
    assert _rows(store.open_tables(spark, root)["stats"]) == _rows(link_stats(every))
    # Batches after the fold, the first of them written twice.
    _changes(spark, root, [[ev(99, "Z", 1.0)]], events_df, first=4)
    _changes(spark, root, BATCHES, events_df, first=4)
    twice = every.unionByName(every)
    assert _rows(store.open_tables(spark, root)["stats"]) == _rows(link_stats(twice))
    # A newer run that replays some of the source replaces its keys; the older one resumes in vain.
    _changes(spark, root, BATCHES[:1], events_df, run=2)
    _changes(spark, root, BATCHES[:1], events_df, run=1, first=8)
    fresh = {(r.t, r.link): r.vcount for r in link_stats(events_df(BATCHES[0])).collect()}
    got = {(r.t, r.link): r.vcount for r in store.open_tables(spark, root)["stats"].collect() if r.t is not None and not math.isnan(r.t)}
    old = {(r.t, r.link): r.vcount for r in link_stats(twice.where("t > 2 AND NOT isnan(t)")).collect()}
    assert got == {**old, **fresh}
    for _ in range(2):
        store.compact(spark, root, "stats", include_latest=True)
        again = {(r.t, r.link): r.vcount for r in store.open_tables(spark, root)["stats"].collect() if r.t is not None and not math.isnan(r.t)}
        assert again == got


def test_changes_mode_keeps_no_state_and_counts_late_rows(spark, work):
    for k, rows in enumerate([[ev(0, "L", 1.0), ev(500, "L", 2.0)], [ev(900, "L", 3.0)], [ev(0, "L", 5.0)]]):
        encode_events(spark.createDataFrame(rows, EVENT_SCHEMA)).coalesce(1).write.mode("append").parquet(f"{work}/msg")
    source = StreamSource("parquet", f"{work}/msg", max_files_per_trigger=1)
    job = start_streams(spark, source, f"{work}/t", f"{work}/c", trigger={"availableNow": True}).drain()
    assert all(not p["stateOperators"] for p in job.queries["stats"].recentProgress)
    assert not os.path.exists(f"{work}/c/stats/state")
    assert _rows(store.open_tables(spark, f"{work}/t")["stats"]) == [(0.0, "L", 2, 3.0), (500.0, "L", 1, 2.0), (900.0, "L", 1, 3.0)]
    with pytest.raises(ValueError, match="changes"):  # a table keeps its mode
        start_streams(spark, source, f"{work}/t", f"{work}/c2", trigger={"availableNow": True}, stats_mode="update")
    with pytest.raises(ValueError, match="stats_mode"):
        start_streams(spark, source, f"{work}/t2", f"{work}/c3", stats_mode="changes", state_ttl="1 minute")
    versions = start_streams(spark, source, f"{work}/t4", f"{work}/c4", trigger={"availableNow": True}, stats_mode="update").drain()
    assert _rows(store.open_tables(spark, versions.out_root)["stats"]) == _rows(store.open_tables(spark, f"{work}/t")["stats"])
    with pytest.raises(ValueError, match="versions"):
        start_streams(spark, source, f"{work}/t4", f"{work}/c5", trigger={"availableNow": True})


@pytest.mark.parametrize("folded", [0, 2, 4])
def test_statistics_answer_like_the_tables(spark, work, events_df, folded):
    root = f"{work}/tables"
    raw = batch_writer(f"{root}/raw_data", run_id=1)
    for b, rows in enumerate(BATCHES):
        _changes(spark, root, [rows], events_df, first=b)
        raw(events_df(rows), b)
        if b + 1 == folded:
            store.compact(spark, root, "stats", include_latest=True)
            store.compact(spark, root, "raw_data", include_latest=True)
    t, s = store.open_tables(spark, root), {n: store.table_statistics(spark, root, n) for n in ("raw_data", "stats", "stats_windowed")}
    every = {"raw_data": t["raw"], "stats": t["stats"], "stats_windowed": t["windowed"]}
    check = lambda: (
        _rows(st.overview(s["raw_data"], s["stats"])) == _rows(q.overview(t["raw"], t["stats"]))
        and _rows(st.latest_t(s["stats"])) == _rows(q.latest_t(t["stats"]))
        and _rows(st.table_counts(s)) == _rows(q.table_counts(every))
        and _rows(st.distinct_links(s["raw_data"])) == _rows(q.distinct_links(t["raw"]))
    )
    assert check()
    for df in (st.overview(s["raw_data"], s["stats"]), st.latest_t(s["stats"]), st.count_rows(s["raw_data"]), st.distinct_links(s["stats"])):
        assert _files(df) == []  # no data file is opened
    # A folder without statistics is read instead.
    os.remove(f"{root}/stats__stats/" + sorted(os.listdir(f"{root}/stats__stats"))[0])
    s["stats"] = store.table_statistics(spark, root, "stats")
    assert check()


def test_counts_read_nothing_where_times_are_apart(spark, work, events_df):
    root = f"{work}/tables"
    _changes(spark, root, [[ev(k * 10 + j, "A", 1.0) for j in range(3)] for k in range(4)], events_df)
    s = store.table_statistics(spark, root, "stats")
    assert _files(st.count_rows(s)) == [] and st.count_rows(s).first().rows == 12
    _changes(spark, root, [[ev(12, "A", 1.0), ev(13, "A", 1.0)]], events_df, first=4)  # meets one folder at one step
    s = store.table_statistics(spark, root, "stats")
    assert st.count_rows(s).first().rows == 13
    assert {f.split("batch_id=")[1].split("/")[0] for f in _files(st.count_rows(s))} == {"1", "4"}


def test_many_links_are_read(spark, work, events_df, monkeypatch):
    monkeypatch.setattr(st, "MOST_LINKS", 2)
    root = f"{work}/tables"
    _changes(spark, root, [[ev(1, x, 1.0) for x in "ABC"], [ev(2, x, 1.0) for x in "CD"], [ev(3, None, 1.0)]], events_df)
    s = store.table_statistics(spark, root, "stats")
    assert [r.link for r in st.distinct_links(s).collect()] == list("ABCD")
    assert len(_files(st.distinct_links(s))) == 1 or {f.split("batch_id=")[1][0] for f in _files(st.distinct_links(s))} == {"0"}


def test_statistics_of_an_empty_table_and_of_infinite_times(spark, work, events_df):
    s = store.table_statistics(spark, f"{work}/none", "stats")
    assert _rows(st.table_counts({"stats": s})) == [("stats", 0)] and st.latest_t(s).first().latest_t is None
    _changes(spark, f"{work}/tables", [[ev(float("inf"), "A", 1.0), ev(float("-inf"), "A", 1.0)], [ev(1, "A", 1.0)]], events_df)
    s = store.table_statistics(spark, f"{work}/tables", "stats")
    assert st.latest_t(s).first().latest_t == float("inf") and st.count_rows(s).first().rows == 3


spans = hs.lists(hs.tuples(hs.integers(0, 30), hs.integers(0, 6), hs.booleans()), max_size=12)


@settings(max_examples=300, deadline=None)
@given(spans, hs.integers(1, 5))
def test_shared_times_are_those_of_two_spans(found, most):
    given_spans = [(float(lo), float(lo + size), odd) for lo, size, odd in found]
    ranges, odd = st.shared_times(given_spans)
    for t in range(40):
        inside = sum(lo <= t <= hi for lo, hi, _ in given_spans)
        assert any(a <= t <= b for a, b in ranges) == (inside > 1)
    assert odd == (sum(o for _, _, o in given_spans) > 1)
    fewer, _ = st.shared_times(given_spans, most)
    assert len(fewer) <= most and all(any(a <= lo and hi <= b for a, b in fewer) for lo, hi in ranges)


def _rewritten(n, sizes, most=None):
    """Bytes of segments that n compactions rewrite, and the segments left."""
    segments, written = [], 0
    for k in range(n):
        size = sizes(k)
        merged = store.plan_merge(segments, size, most)
        written += sum(s.bytes for s in merged)
        segments = [s for s in segments if s not in merged] + [store.Segment(str(k), size + sum(s.bytes for s in merged))]
    return written, segments


@pytest.mark.parametrize("size", [1 << 10, 3 << 20, 1 << 30])
def test_compactions_rewrite_n_log_n(size):
    unit = max(size, store.LEAST_TIER_BYTES)
    for n in (64, 256, 1024):
        written, segments = _rewritten(n, lambda k: size)
        assert written <= n * unit * (math.log(n, store.FAN_IN) + 1)
        assert len(segments) <= store.FAN_IN * (math.log(n, store.FAN_IN) + 2)
    uneven, segments = _rewritten(300, lambda k: (k % 7 + 1) * size)
    assert uneven <= 300 * 8 * unit * (math.log(300 * 8, store.FAN_IN) + 1) and len(segments) <= 30


def test_raw_segments_of_the_target_size_are_left_alone(spark, work, events_df):
    written, segments = _rewritten(200, lambda k: 10 << 20, most=100 << 20)
    assert all(s.bytes < 100 << 20 or s.bytes <= store.FAN_IN * (100 << 20) for s in segments)
    done = [s for s in segments if s.bytes >= 100 << 20]
    assert not set(done) & set(store.plan_merge(segments, 90 << 20, 100 << 20)) and len(done) > 5
    root = f"{work}/tables"
    write = batch_writer(f"{root}/raw_data", run_id=1)
    names = []
    for b in range(6):
        write(events_df([ev(b, "L", float(b))]), b)
        names.append(store.compact(spark, root, "raw_data", include_latest=True, raw_target_bytes=1))
    kept = [s.name for s in store.read_manifest(spark, f"{root}/raw_data").segments]
    assert [n.split("__snapshot/")[1] for n in names] == kept  # each still the one first written
    assert sorted(r.t for r in store.open_tables(spark, root)["raw"].collect()) == [float(b) for b in range(6)]


def test_changes_and_statistics_columns(spark, work, events_df):
    changes = link_changes(events_df(BATCHES[1]))
    assert changes.schema.simpleString() == CHANGES_SCHEMA.simpleString()
    assert [f.name for f in CHANGES_SCHEMA.fields][: len(STATS_KEYS)] == list(STATS_KEYS)
    found = changes.agg(*st.observed(changes.schema)).first().asDict()
    record = st.write_stats(spark, f"{work}/t", "run_id=1/batch_id=0", found)
    read, missing = st.read_stats(spark, f"{work}/t", ["run_id=1/batch_id=0", "run_id=1/batch_id=1"])
    assert missing == ["run_id=1/batch_id=1"] and read.first().asDict() == {**record, "links": sorted(found["links"])}
    assert read.select(F.size("links")).first()[0] == 3


@pytest.mark.parametrize("folded", [0, 3])
def test_slices_read_only_folders_that_can_hold_them(spark, work, events_df, folded):
    root = f"{work}/tables"
    raw = batch_writer(f"{root}/raw_data", run_id=1)
    batches = [[ev(100 * k + j, "AB"[(k + j) % 2] if k % 3 else "A", float(j)) for j in range(10)] for k in range(8)]
    batches.append([ev(205, "C", 1.0), ev(NAN, "C", 2.0), ev(None, "A", 3.0)])  # late, and without a time
    for b, rows in enumerate(batches):
        _changes(spark, root, [rows], events_df, first=b)
        raw(events_df(rows), b)
        if b + 1 == folded:
            for table in ("stats", "raw_data"):
                store.compact(spark, root, table, include_latest=True)
    t = store.open_tables(spark, root)
    for lo, hi, link in [(203, 302, None), (None, 150, "B"), (700, None, "A"), (900, None, None), (None, None, "C"), (204.5, 205, None), (None, None, "none"), (None, None, None)]:
        want = F.lit(True)
        if lo is not None:
            want = want & (F.col("t") >= lo) & ~F.isnan("t")
        if hi is not None:
            want = want & (F.col("t") <= hi)
        if link is not None:
            want = want & (F.col("link") == link)
        for table, whole in (("stats", t["stats"]), ("raw_data", t["raw"])):
            assert _rows(store.open_slice(spark, root, table, lo, hi, link)) == _rows(whole.where(want)), (lo, hi, link, table)
    newest = store.open_slice(spark, root, "stats", 700, 709)
    assert {f.split("batch_id=")[1].split("/")[0] for f in newest.inputFiles() if "batch_id=" in f} == {"7"}
    assert _rows(q.link_state_at(newest, 709, 2)) == _rows(q.link_state_at(t["stats"], 709, 2))


def test_a_link_is_read_from_its_bucket_alone(spark, work, events_df):
    root, links = f"{work}/tables", [f"L{k}" for k in range(12)]
    batch = lambda k: [ev(100 * k + j, links[j % 12], float(j)) for j in range(48)] + [ev(NAN, "L1", 1.0), ev(None, "L2", 2.0), ev(100 * k, None, 3.0)]
    for table, key in (("stats", "stats"), ("stats_windowed", "windowed")):
        with pytest.raises(ValueError, match="link_buckets"):
            store.compact(spark, root, table, link_buckets=-1)
    with pytest.raises(ValueError, match="link_buckets"):
        store.compact(spark, root, "raw_data", link_buckets=4)
    _changes(spark, root, [batch(0), batch(1)], events_df)
    store.compact(spark, root, "stats", include_latest=True)  # a segment by time alone
    _changes(spark, root, [batch(1), batch(2)], events_df, first=2)
    cut = store.compact(spark, root, "stats", include_latest=True, link_buckets=4)
    _changes(spark, root, [batch(3)], events_df, first=4)  # and a batch that no segment holds
    every = events_df(batch(0) + batch(1) + batch(1) + batch(2) + batch(3))
    whole = store.open_tables(spark, root)["stats"]
    assert _rows(whole) == _rows(link_stats(every))
    folders = sorted(n for n in os.listdir(cut) if n.startswith(store.BUCKET))
    assert set(folders) <= {f"{store.BUCKET}={b}" for b in range(4)} and len(folders) > 1
    wanted = {link: (_rows(whole.where(F.col("link") == link)), _rows(whole.where((F.col("link") == link) & F.col("t").between(105, 230)))) for link in ("L1", "L2", "L7")}
    for link, (series, part) in wanted.items():
        assert series and part and _rows(store.open_slice(spark, root, "stats", link=link)) == series
        assert _rows(store.open_slice(spark, root, "stats", 105, 230, link)) == part
        # No file of another bucket is opened: a read holds even when these are no Parquet files.
        bucket = spark.range(1).select(store.bucket_of(F.lit(link), 4)).first()[0]
        held = {}
        for other in folders:
            for name in os.listdir(f"{cut}/{other}"):
                file = f"{cut}/{other}/{name}"
                if other != f"{store.BUCKET}={bucket}" and name.endswith(".parquet"):
                    with open(file, "rb") as f:
                        held[file] = f.read()
                    with open(file, "wb") as f:
                        f.write(b"x" * len(held[file]))
        assert held and _rows(store.open_slice(spark, root, "stats", link=link)) == series
        for file, data in held.items():
            with open(file, "wb") as f:
                f.write(data)
    for buckets in (0, 3):  # merged with segments of either layout
        _changes(spark, root, [batch(4), batch(5)], events_df, first=5 + buckets)
        store.compact(spark, root, "stats", include_latest=True, link_buckets=buckets)
    every = every.unionByName(events_df((batch(4) + batch(5)) * 2))
    assert _rows(store.open_tables(spark, root)["stats"]) == _rows(link_stats(every))
    assert len(store.read_manifest(spark, f"{root}/stats").segments) == 1
    assert _rows(store.open_slice(spark, root, "stats", link="L7")) == _rows(link_stats(every.where("link = 'L7'")))
    s = store.table_statistics(spark, root, "stats")
    assert st.count_rows(s).first()[0] == link_stats(every).count()


def test_ranges_of_equal_weight_cut_a_busy_hour(spark, work, events_df):
    from roadstats.sources.stream import replay_to_dir

    busy = spark.range(9000).select((F.lit(50.0) + F.col("id") / 9000).alias("t"))  # 90 % of the rows in 1 % of the time
    quiet = spark.range(1000).select((F.col("id") / 10.0).alias("t"))
    frame = events_df([ev(0, "L", 1.0)]).limit(1).drop("t").crossJoin(busy.union(quiet)).select(*EVENT_SCHEMA.names)  # one row times all
    ranges = replay_to_dir(frame, f"{work}/rows", f"{work}/s1", chunks=10)
    counts = [frame.where((F.col("t") >= a) & ((F.col("t") < b) | ((F.col("t") <= b) & F.lit(k == len(ranges) - 1)))).count() for k, (a, b) in enumerate(ranges)]
    assert len(ranges) == 10 and sum(counts) == 10000 and max(counts) <= 1100
    wide = replay_to_dir(frame, f"{work}/width", f"{work}/s2", chunks=10, by="width")
    assert max(frame.where((F.col("t") >= a) & (F.col("t") < b)).count() for a, b in wide) > 9000
    assert spark.read.parquet(f"{work}/rows").count() == spark.read.parquet(f"{work}/width").count() == 10000
    # One step is never cut.
    same = events_df([ev(5, "L", 1.0)] * 20 + [ev(6, "L", 1.0), ev(NAN, "L", 1.0), ev(None, "L", 1.0)])
    assert replay_to_dir(same, f"{work}/same", f"{work}/s3", chunks=5) in ([(5.0, 6.0)], [(5.0, 6.0), (6.0, 6.0)])
    assert spark.read.parquet(f"{work}/same").count() == 23
    with pytest.raises(ValueError, match="by is"):
        replay_to_dir(same, f"{work}/x", f"{work}/s5", by="hours")

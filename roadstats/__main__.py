"""Command line: run the streaming job, query the stored tables, check volumes, compact.

    python -m roadstats stream --format kafka --bootstrap-servers b:9092 --topic vehicle-events --out DIR
    python -m roadstats query avg-speed --root DIR
    python -m roadstats check --root DIR --min-raw 1 --min-stats 1
    python -m roadstats compact --root DIR --table stats
"""

from __future__ import annotations

import argparse
import logging
import sys

from roadstats.schemas import (
    DEFAULT_WATERMARK,
    DEFAULT_WINDOW_SECONDS,
    MAP_STATE_TOLERANCE,
    RAW_TABLE,
    STATS_TABLE,
    WINDOWED_TABLE,
)


def _table_names(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--raw-table", default=RAW_TABLE)
    parser.add_argument("--stats-table", default=STATS_TABLE)
    parser.add_argument("--windowed-table", default=WINDOWED_TABLE)


def _open(spark, args):
    from roadstats.streaming.store import open_tables

    return open_tables(spark, args.root, raw=args.raw_table, stats=args.stats_table, windowed=args.windowed_table)


def _statistics(spark, args):
    from roadstats.streaming.store import table_statistics

    names = {"raw": args.raw_table, "stats": args.stats_table, "windowed": args.windowed_table}
    return {role: table_statistics(spark, args.root, table, role) for role, table in names.items()}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="roadstats")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("stream", help="start the raw / stats / windowed streaming queries")
    s.add_argument("--format", default="kafka", choices=["kafka", "parquet", "json", "orc", "avro"])
    s.add_argument("--path", help="message folder for file formats")
    s.add_argument("--bootstrap-servers")
    s.add_argument("--topic", default="vehicle-events")
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--max-files-per-trigger", type=int)
    s.add_argument("--max-offsets-per-trigger", type=int)
    s.add_argument("--out", help="table root (default: <spark.checkpoint.dir>/tables)")
    s.add_argument("--checkpoint", help="checkpoint root (default: <spark.checkpoint.dir>/streams)")
    s.add_argument("--window-seconds", type=int, default=DEFAULT_WINDOW_SECONDS)
    s.add_argument("--watermark", default=DEFAULT_WATERMARK)
    s.add_argument("--state-partitions", type=int)
    s.add_argument("--output-files", type=int)
    s.add_argument("--trigger-seconds", type=float, help="processing-time trigger; default: as fast as possible")
    s.add_argument("--available-now", action="store_true", help="drain what is there, then stop")
    s.add_argument("--timeout-seconds", type=float, help="stop all queries after this long (continuous mode)")
    s.add_argument("--stats-mode", choices=["changes", "update"], help="changes (default): no state; update: running values from state")
    s.add_argument("--state-ttl", help="bound the state of --stats-mode update")
    s.add_argument("--memory-state", action="store_true", help="keep state on the heap instead of in RocksDB")
    s.add_argument("--debug", action="store_true", help="also print per-step stats to the console")
    _table_names(s)

    q = sub.add_parser("query", help="run one read query over the stored tables")
    q.add_argument(
        "name",
        choices=["avg-speed", "top-congested", "speed-delta", "state", "network", "link", "series", "windowed-series",
                 "latest-t", "counts", "distinct-links", "overview", "latest-n"],
    )
    q.add_argument("--root", required=True)
    q.add_argument("--n", type=int, default=5)
    q.add_argument("--link")
    q.add_argument("--t", type=float)
    q.add_argument("--tolerance", type=float)
    q.add_argument("--table", default="stats", choices=["raw", "stats", "windowed"])
    q.add_argument("--ascending", action="store_true")
    q.add_argument("--rows", type=int, default=50, help="rows to print")
    q.add_argument("--out", help="write the whole result to this folder instead of printing")
    q.add_argument("--out-format", default="parquet", choices=["parquet", "json", "csv", "orc"])
    _table_names(q)

    c = sub.add_parser("check", help="raw and stats row counts against minimums (exit 1 on failure)")
    c.add_argument("--root", required=True)
    c.add_argument("--min-raw", type=int, default=1)
    c.add_argument("--min-stats", type=int, default=1)
    _table_names(c)

    k = sub.add_parser("compact", help="fold a table's batch folders into a snapshot")
    k.add_argument("--link-buckets", type=int, default=0, help="cut the segment by link too, into so many folders (stats, windowed)")
    k.add_argument("--root", required=True)
    k.add_argument("--table", default=STATS_TABLE, help="the table's name; give --role for a renamed one")
    k.add_argument("--role", choices=["raw", "stats", "windowed"])
    k.add_argument("--include-latest", action="store_true")
    k.add_argument("--retain-seconds", type=float, help="delete folded batches and replaced segments older than this")
    return p


def _query(spark, args):
    from roadstats.operators import network as net
    from roadstats.operators import queries as q
    from roadstats.streaming import statistics as st
    from roadstats.streaming.store import open_slice

    name = args.name
    if name in ("latest-t", "counts", "distinct-links", "overview"):  # from the folders' statistics
        s = _statistics(spark, args)
        if name == "latest-t":
            return st.latest_t(s["stats"])
        if name == "distinct-links":
            return st.distinct_links(s[args.table])
        if name == "overview":
            return st.overview(s["raw"], s["stats"])
        return st.table_counts({RAW_TABLE: s["raw"], STATS_TABLE: s["stats"], WINDOWED_TABLE: s["windowed"]})
    if name in ("state", "network"):  # from the folders that hold the slice of time
        at = args.t
        if name == "state" and at is None:
            raise ValueError("--t is required for 'state'")
        back = args.tolerance if args.tolerance is not None else 1.0 if name == "state" else MAP_STATE_TOLERANCE
        if at is None:
            at = st.latest_t(_statistics(spark, args)["stats"]).first()["latest_t"]
        stats = open_slice(spark, args.root, args.stats_table, None if at is None else at - back, at, role="stats")
        return q.link_state_at(stats, at, back) if name == "state" else net.network_state_at(spark, stats, at, back)
    t = _open(spark, args)
    stats = t["stats"]
    if name == "avg-speed":
        return q.avg_speed_per_link(stats, ascending=args.ascending)
    if name == "top-congested":
        return q.top_n_congested(stats, args.n)
    if name == "speed-delta":
        return q.max_speed_delta(stats, args.n)
    if name in ("link", "series", "windowed-series"):
        if not args.link:
            raise ValueError(f"--link is required for '{name}'")
        if name == "link":
            return q.link_summary(stats, args.link)
        return q.link_series(stats, args.link) if name == "series" else q.windowed_series(t["windowed"], args.link)
    if name == "latest-n":
        field = "window_end" if args.table == "windowed" else "t"
        return q.latest_n(t[args.table], args.n, field)
    raise ValueError(name)


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from roadstats.session import get_session, shared_root

    spark = get_session()
    if args.cmd == "stream":
        from roadstats.sources.stream import StreamSource
        from roadstats.streaming.job import BatchLogger, run_until_first_ends, start_streams

        logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")

        if args.format == "kafka":
            if not args.bootstrap_servers:
                raise SystemExit("--bootstrap-servers is required for kafka")
            source = StreamSource.kafka(
                args.bootstrap_servers, args.topic, args.starting_offsets, max_offsets_per_trigger=args.max_offsets_per_trigger
            )
        else:
            source = StreamSource(args.format, args.path, max_files_per_trigger=args.max_files_per_trigger)
        root = shared_root(spark)
        trigger = {"availableNow": True} if args.available_now else (
            {"processingTime": f"{args.trigger_seconds} seconds"} if args.trigger_seconds else None
        )
        job = start_streams(
            spark, source, args.out or f"{root}/tables", args.checkpoint or f"{root}/streams",
            window_seconds=args.window_seconds, watermark=args.watermark, state_partitions=args.state_partitions,
            trigger=trigger, stats_mode=args.stats_mode, state_ttl=args.state_ttl, rocksdb=not args.memory_state, debug=args.debug,
            output_files=args.output_files, listener=BatchLogger(),
            tables={"raw": args.raw_table, "stats": args.stats_table, "windowed": args.windowed_table},
        )
        if args.available_now:
            job.drain()
        else:
            run_until_first_ends(spark, job, timeout_seconds=args.timeout_seconds)
        return 0
    if args.cmd == "query":
        result = _query(spark, args)
        if args.out:
            result.write.format(args.out_format).save(args.out)
        else:
            result.show(args.rows, truncate=False)
        return 0
    if args.cmd == "check":
        from roadstats.operators.queries import checks_of_counts
        from roadstats.streaming.statistics import table_counts

        s = _statistics(spark, args)
        rows = checks_of_counts(table_counts({RAW_TABLE: s["raw"], STATS_TABLE: s["stats"]}), args.min_raw, args.min_stats).collect()
        for r in rows:
            print(f"[{'OK' if r.ok else 'FAIL'}] {r.check}: {r.detail}")
        return 0 if all(r.ok for r in rows) else 1
    if args.cmd == "compact":
        from roadstats.streaming.store import compact

        print(compact(
            spark, args.root, args.table, include_latest=args.include_latest, role=args.role, retain_seconds=args.retain_seconds,
            link_buckets=args.link_buckets,
        ))
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())

"""Structured Streaming: replay-safe sinks, the three-query job, latest-version table reads."""

from roadstats.streaming.job import StreamJob, drain, run_until_first_ends, start_streams  # noqa: F401
from roadstats.streaming.sink import batch_writer, run_id_for  # noqa: F401
from roadstats.streaming.store import compact, open_slice, open_tables, read_table, table_statistics  # noqa: F401

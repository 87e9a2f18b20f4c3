"""roadstats: Spark-native analytics over road-link vehicle events.

Batch and Structured Streaming share the same DataFrame operators:

* ``sources``    -- event decoding/encoding, the driver-table adapter, the road network,
                    file/broker stream sources and the time-ordered replay.
* ``functions``  -- column expressions (status predicate, event time, map colour/width).
* ``operators``  -- DataFrame -> DataFrame transformations (aggregations, read queries,
                    network joins).
* ``streaming``  -- replay-safe sinks, the three-query streaming job, latest-version reads.
* ``plans``      -- the named query contract used by ``__spark_entry__`` and ``bench.py``.
"""

from roadstats.schemas import EVENT_SCHEMA, STATUS_LINKS  # noqa: F401

__version__ = "0.1.0"
__all__ = ["EVENT_SCHEMA", "STATUS_LINKS", "__version__"]

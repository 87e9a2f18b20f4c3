"""Event codec: typed rows <-> JSON messages (``value BINARY``).

Both directions are single projections, so they run the same in batch and streaming and
fuse into the surrounding whole-stage-codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadstats.schemas import EVENT_SCHEMA


def parse_events(messages: DataFrame, schema: StructType = EVENT_SCHEMA, value_col: str = "value") -> DataFrame:
    """Decode JSON payloads into one typed column per schema field.

    PERMISSIVE: a payload that is not a JSON object becomes an all-NULL row, and a field of
    the wrong type becomes NULL while the rest of the record is kept. Nothing is dropped here;
    downstream filters decide. Works on BINARY (broker) or STRING payloads.
    """
    payload = F.col(value_col).cast("string")
    return messages.select(F.from_json(payload, schema).alias("_event")).select("_event.*")


def message_value(columns: list[str]) -> Column:
    """The JSON message of one row: ``to_json(struct(columns))`` as UTF-8 bytes."""
    return F.to_json(F.struct(*[F.col(c) for c in columns])).cast("binary")


def encode_events(events: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Encode each row as one UTF-8 JSON object in a ``value BINARY`` column.

    NULL fields are omitted from the object; the parser maps a missing field back to NULL,
    so ``parse_events(encode_events(df)) == df``.
    """
    cols = columns or [f.name for f in EVENT_SCHEMA.fields]
    return events.select(message_value(cols).alias("value"))

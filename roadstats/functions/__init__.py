"""Column expressions: all built-in Spark functions, so they stay inside whole-stage codegen."""

from roadstats.functions.columns import (  # noqa: F401
    event_time,
    line_width,
    not_status,
    speed_color,
    speed_ratio,
    to_utc_ntz,
)

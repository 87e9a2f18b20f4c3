"""Inputs: event decoding/encoding, the driver-table adapter, the road network, stream sources."""

from roadstats.sources.codec import encode_events, parse_events  # noqa: F401
from roadstats.sources.events import events_from_table, load_events  # noqa: F401
from roadstats.sources.network import links_df, nodes_df  # noqa: F401

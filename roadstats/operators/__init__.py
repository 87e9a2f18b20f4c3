"""DataFrame -> DataFrame operators."""

from roadstats.operators.network import link_segments, network_checks, network_state_at  # noqa: F401
from roadstats.operators.queries import (  # noqa: F401
    avg_speed_per_link,
    default_table_counts,
    distinct_links,
    latest_n,
    latest_t,
    link_detail,
    link_history,
    link_series,
    link_state_at,
    link_summary,
    link_summary_all,
    max_speed_delta,
    overview,
    sample_row,
    table_counts,
    top_n_congested,
    volume_checks,
    windowed_series,
)
from roadstats.operators.stats import link_stats, status_filter, windowed_stats, with_event_time  # noqa: F401

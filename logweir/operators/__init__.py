from logweir.operators.cleaning import (
    clean_logs,
    malformed_lines,
    parse_access_log,
    select_batch,
    tag_batch,
)
from logweir.operators.errors import (
    distinct_error_host_rows,
    distinct_error_hosts,
    error_counts,
    error_logs,
    hourly_errors,
    hourly_errors_by_join,
    hourly_errors_by_two_joins,
    hourly_totals,
)
from logweir.operators.quality import (
    batch_metadata,
    malformed_summary,
    run_record,
    run_stats,
    stats_row,
)
from logweir.operators.sketches import (
    error_host_sketches,
    resource_host_sketches,
    sketched_hosts,
)
from logweir.operators.traffic import (
    daily_traffic,
    distinct_hosts,
    possible_winners,
    resource_traffic,
    top_resources,
)

__all__ = [
    "batch_metadata",
    "clean_logs",
    "daily_traffic",
    "distinct_error_host_rows",
    "distinct_error_hosts",
    "distinct_hosts",
    "error_counts",
    "error_host_sketches",
    "error_logs",
    "hourly_errors",
    "hourly_errors_by_join",
    "hourly_errors_by_two_joins",
    "hourly_totals",
    "malformed_lines",
    "malformed_summary",
    "parse_access_log",
    "possible_winners",
    "resource_host_sketches",
    "resource_traffic",
    "run_record",
    "run_stats",
    "select_batch",
    "sketched_hosts",
    "stats_row",
    "tag_batch",
    "top_resources",
]

"""Batch analytics over web-server access logs on Spark."""

from logweir.operators import (
    clean_logs,
    daily_traffic,
    hourly_errors,
    malformed_lines,
    parse_access_log,
    resource_traffic,
    run_stats,
    select_batch,
    tag_batch,
    top_resources,
)
from logweir.plans import report, run
from logweir.sources import read_raw_logs, read_store, read_table, read_tsv

__all__ = [
    "clean_logs",
    "daily_traffic",
    "hourly_errors",
    "malformed_lines",
    "parse_access_log",
    "read_raw_logs",
    "read_store",
    "read_table",
    "read_tsv",
    "report",
    "resource_traffic",
    "run",
    "run_stats",
    "select_batch",
    "tag_batch",
    "top_resources",
]

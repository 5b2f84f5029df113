"""Schemas and the fixed values of the access-log job."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values -------------------------------------------------------------
# These decide results (which lines are valid, which batch a line belongs to,
# what counts as an error, how many rows are reported), so they are stated
# here as plain text and nowhere else.

#: Shape of one request line; eight groups: host, date, hour, method, path,
#: protocol, status, bytes text.
ACCESS_LOG_PATTERN = (
    r'^(\S+) - - \[(\d{2}/\w{3}/\d{4}):(\d{2}):\d{2}:\d{2} [^\]]+\] '
    r'"(\S+) (\S+) (\S+)" (\d{3}) (\S+)'
)
#: A file name or path with this text is batch 2, any other is batch 1.
SECOND_BATCH_FILE_MARK = "Aug"
#: The same for the rule that looks at the line itself.
SECOND_BATCH_LINE_MARK = "/Aug/"
#: Statuses from the first to the last, both included, are errors.
ERROR_STATUSES = (400, 599)
TOP_RESOURCES = 20
PREVIEW_ROWS = 10
#: Paths longer than the first number are shown as that many leading
#: characters (second number) and "...".
PATH_DISPLAY = (39, 36)
#: What each batch selection is called, and the file it is read from
#: (an empty name stands for the whole input directory).
BATCH_LABELS = {0: "Combined", 1: "July 1995", 2: "August 1995"}
BATCH_FILES = {0: "", 1: "NASA_access_log_Jul95", 2: "NASA_access_log_Aug95"}
#: The input that these files are in.
DEFAULT_INPUT = "/input/logs"
QUERY_NAMES = ("Query1", "Query2", "Query3")

# Schemas ------------------------------------------------------------------


_TYPES = {
    "binary": T.BinaryType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "total": T.DecimalType(38, 0),  # a sum of longs
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    """``name type, ...`` as a schema, without needing a session as DDL does."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


VALID_LOGS = _schema(
    "batch_id int, host string, log_date string, log_hour int, method string, "
    "resource_path string, protocol string, status_code int, bytes bigint"
)

DAILY_TRAFFIC = _schema(
    "batch_id int, log_date string, status_code int, request_count bigint, "
    "total_bytes total"
)
TOP_RESOURCE = _schema(
    "batch_id int, resource_path string, request_count bigint, "
    "total_bytes total, distinct_host_count bigint"
)
HOURLY_ERRORS = _schema(
    "batch_id int, log_date string, log_hour int, error_request_count bigint, "
    "total_request_count bigint, error_rate double, distinct_error_hosts bigint"
)
QUERY_SCHEMAS = {
    "Query1": DAILY_TRAFFIC,
    "Query2": TOP_RESOURCE,
    "Query3": HOURLY_ERRORS,
}

RUNS = _schema(
    "run_id bigint, pipeline_name string, query_name string, batch_id int, "
    "batch_size int, avg_batch_size double, records_processed bigint, "
    "malformed_record_count bigint, runtime_ms bigint, executed_at timestamp"
)
BATCH_METADATA = _schema(
    "run_id bigint, batch_id int, batch_label string, source_file string, "
    "record_count bigint"
)
MALFORMED_SUMMARY = _schema(
    "run_id bigint, batch_id int, malformed_count bigint, total_count bigint, "
    "malformed_pct double"
)


def _stored(result: T.StructType) -> T.StructType:
    """A query result as stored: run columns around the batch, then the rest."""
    run = _schema("run_id bigint, pipeline_name string, batch_id int, executed_at timestamp")
    return T.StructType(run.fields + [f for f in result if f.name != "batch_id"])


# Names of the store's tables and columns (with the schemas above).
#: Tables of the run store.
STORE_TABLES = {
    "query1_results": _stored(DAILY_TRAFFIC),
    "query2_results": _stored(TOP_RESOURCE),
    "query3_results": _stored(HOURLY_ERRORS),
    "batch_metadata": BATCH_METADATA,
    "malformed_records_summary": MALFORMED_SUMMARY,
    "runs": RUNS,
}
QUERY_TABLES = {
    "Query1": "query1_results",
    "Query2": "query2_results",
    "Query3": "query3_results",
}

#: Tables of the run store that a run may have beside the others: sketches of hosts.
SKETCH_TABLES = {
    "resource_host_sketches": _schema(
        "run_id bigint, pipeline_name string, batch_id int, executed_at timestamp, "
        "resource_path string, hosts binary"
    ),
    "error_host_sketches": _schema(
        "run_id bigint, pipeline_name string, batch_id int, executed_at timestamp, "
        "log_date string, log_hour int, hosts binary"
    ),
}
#: All tables of the run store.
ALL_TABLES = {**STORE_TABLES, **SKETCH_TABLES}

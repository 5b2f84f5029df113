"""The report of a run, as small DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.functions.measures import as_percent, shorten_path
from logweir.schemas import PREVIEW_ROWS, QUERY_NAMES, QUERY_TABLES
from logweir.sources.tables import read_store


def run_header(spark: SparkSession, store: str, run_id: int) -> DataFrame:
    return read_store(spark, store, "runs", run_id)


def malformed_line(spark: SparkSession, store: str, run_id: int) -> DataFrame:
    return read_store(spark, store, "malformed_records_summary", run_id).select(
        "run_id", "malformed_count", "total_count", "malformed_pct"
    )


def preview(result: DataFrame, query: str, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of a query result, in its order and for display.

    Order is total: where dates or counts are equal, path and batch decide.
    """
    if query == "Query1":
        first = result.orderBy("log_date", "status_code", "batch_id").limit(rows)
        return first.select("log_date", "status_code", "request_count", "total_bytes")
    if query == "Query2":
        first = result.orderBy(F.desc("request_count"), "resource_path", "batch_id").limit(rows)
        return first.select(
            shorten_path(F.col("resource_path")).alias("resource_path"),
            "request_count",
            "total_bytes",
            "distinct_host_count",
        )
    if query == "Query3":
        first = result.orderBy("log_date", "log_hour", "batch_id").limit(rows)
        return first.select(
            "log_date",
            "log_hour",
            "error_request_count",
            "total_request_count",
            as_percent(F.col("error_rate")).alias("error_percent"),
            "distinct_error_hosts",
        )
    raise ValueError(f"query must be one of {QUERY_NAMES}, not {query!r}")


def report(spark: SparkSession, store: str, run_id: int) -> dict[str, DataFrame]:
    """Header, malformed line and the three previews (empty if not run).

    A run that the store does not have, or has not finished, is an error.
    """
    if run_header(spark, store, run_id).isEmpty():
        raise ValueError(f"no finished run {run_id} in {store}")
    previews = {
        query: preview(read_store(spark, store, QUERY_TABLES[query], run_id), query)
        for query in QUERY_NAMES
    }
    return {
        "run": run_header(spark, store, run_id),
        "malformed": malformed_line(spark, store, run_id),
        **previews,
    }

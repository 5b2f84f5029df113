"""Error rates per hour, in one pass and as joins of their parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.functions.measures import error_rate, is_error
from logweir.schemas import HOURLY_ERRORS

_HOUR = ["batch_id", "log_date", "log_hour"]


def _hourly(counts: DataFrame, ordered: bool) -> DataFrame:
    result = counts.withColumn(
        "error_rate", error_rate(F.col("error_request_count"), F.col("total_request_count"))
    ).select(*HOURLY_ERRORS.fieldNames())
    return result.orderBy("log_date", "log_hour", "batch_id") if ordered else result


def hourly_errors(valid: DataFrame, ordered: bool = True) -> DataFrame:
    """Errors, requests, error rate and distinct failing hosts per hour.

    One scan. The distinct count makes Spark aggregate by hour and host first,
    so a busy hour is spread by host; requests without an error share one NULL
    host per hour and are summed before the shuffle.
    """
    failed = is_error(F.col("status_code"))
    counts = valid.groupBy(*_HOUR).agg(
        F.count_if(failed).alias("error_request_count"),
        F.count(F.lit(1)).alias("total_request_count"),
        F.count_distinct(F.when(failed, F.col("host"))).alias("distinct_error_hosts"),
    )
    return _hourly(counts, ordered)


def error_logs(valid: DataFrame) -> DataFrame:
    return valid.where(is_error(F.col("status_code")))


def hourly_totals(valid: DataFrame) -> DataFrame:
    return valid.groupBy(*_HOUR).agg(F.count(F.lit(1)).alias("total_request_count"))


def error_counts(valid: DataFrame) -> DataFrame:
    return (
        error_logs(valid).groupBy(*_HOUR).agg(F.count(F.lit(1)).alias("error_request_count"))
    )


def distinct_error_host_rows(valid: DataFrame) -> DataFrame:
    return error_logs(valid).select(*_HOUR, "host").distinct()


def distinct_error_hosts(valid: DataFrame) -> DataFrame:
    return (
        distinct_error_host_rows(valid)
        .groupBy(*_HOUR)
        .agg(F.count(F.lit(1)).alias("distinct_error_hosts"))
    )


def _zero_if_missing(joined: DataFrame) -> DataFrame:
    return joined.na.fill(0, ["error_request_count", "distinct_error_hosts"])


def hourly_errors_by_join(valid: DataFrame, ordered: bool = True) -> DataFrame:
    """As ``hourly_errors``: hourly totals left-joined with the error side.

    Both sides leave their aggregation partitioned by the join key, so the join
    adds no shuffle. No broadcast hint: the sides grow with the data.
    """
    errors = (
        error_logs(valid)
        .groupBy(*_HOUR)
        .agg(
            F.count(F.lit(1)).alias("error_request_count"),
            F.count_distinct("host").alias("distinct_error_hosts"),
        )
    )
    return _hourly(_zero_if_missing(hourly_totals(valid).join(errors, _HOUR, "left")), ordered)


def hourly_errors_by_two_joins(valid: DataFrame, ordered: bool = True) -> DataFrame:
    """As ``hourly_errors``: totals, error counts and failing hosts, joined."""
    joined = (
        hourly_totals(valid)
        .join(error_counts(valid), _HOUR, "left")
        .join(distinct_error_hosts(valid), _HOUR, "left")
    )
    return _hourly(_zero_if_missing(joined), ordered)

"""Run statistics and the rows that describe a run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.functions.measures import percentage
from logweir.operators.cleaning import parse_access_log, select_batch
from logweir.schemas import (
    BATCH_FILES,
    BATCH_LABELS,
    BATCH_METADATA,
    DEFAULT_INPUT,
    MALFORMED_SUMMARY,
    RUNS,
)


def record_counts(is_valid: Column) -> list[Column]:
    """Aggregates over parsed lines: how many, and how many are valid."""
    return [
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(is_valid).alias("valid_records"),
    ]


def _stats(counts: DataFrame, batch: int) -> DataFrame:
    batches = 2 if batch == 0 else 1
    total = F.col("total_records")
    return counts.select(
        total,
        (total - F.col("valid_records")).alias("malformed_records"),
        F.lit(batches).alias("total_batches"),
        (total / F.lit(float(batches))).alias("avg_batch_size"),
    )


def run_stats(tagged: DataFrame, match: str = "full", batch: int = 0) -> DataFrame:
    """One row: lines read, lines malformed, batches, lines per batch."""
    parsed = parse_access_log(select_batch(tagged, batch), match)
    return _stats(parsed.agg(*record_counts(F.col("is_valid"))), batch)


def stats_row(spark: SparkSession, total: int, valid: int, batch: int = 0) -> DataFrame:
    """The row of ``run_stats`` from counts that are already known."""
    counts = spark.sql(
        "SELECT CAST(:total AS BIGINT) AS total_records, CAST(:valid AS BIGINT) AS valid_records",
        args={"total": total, "valid": valid},
    )
    return _stats(counts, batch)


def run_record(
    stats: DataFrame,
    run_id: int,
    pipeline_name: str,
    query_name: str,
    batch: int,
    runtime_ms: int,
    executed_at: datetime,
) -> DataFrame:
    """The ``runs`` row. The batch size is not used by anything and stays 0."""
    return _typed(
        stats,
        RUNS,
        run_id=F.lit(run_id),
        pipeline_name=F.lit(pipeline_name),
        query_name=F.lit(query_name),
        batch_id=F.lit(batch),
        batch_size=F.lit(0),
        records_processed=F.col("total_records"),
        malformed_record_count=F.col("malformed_records"),
        runtime_ms=F.lit(runtime_ms),
        executed_at=F.lit(executed_at),
    )


def _source(batch: int, input_dir: str, batch_rule: str | int) -> str:
    """What was read: the input, and for one batch the rule that chose its lines."""
    if input_dir == DEFAULT_INPUT and batch_rule == "file_name":
        return "/".join(part for part in (input_dir, BATCH_FILES[batch]) if part)
    return input_dir if batch == 0 else f"{input_dir} [batch {batch} by {batch_rule}]"


def batch_metadata(
    stats: DataFrame,
    run_id: int,
    batch: int = 0,
    input_dir: str = DEFAULT_INPUT,
    batch_rule: str | int = "file_name",
) -> DataFrame:
    """What a run read: the batch's label, its source and its number of lines.

    The fixed file names stand for the fixed input only.
    """
    source = _source(batch, input_dir, batch_rule)
    return _typed(
        stats,
        BATCH_METADATA,
        run_id=F.lit(run_id),
        batch_id=F.lit(batch),
        batch_label=F.lit(BATCH_LABELS[batch]),
        source_file=F.lit(source),
        record_count=F.col("total_records"),
    )


def malformed_summary(stats: DataFrame, run_id: int, batch: int = 0) -> DataFrame:
    malformed, total = F.col("malformed_records"), F.col("total_records")
    return _typed(
        stats,
        MALFORMED_SUMMARY,
        run_id=F.lit(run_id),
        batch_id=F.lit(batch),
        malformed_count=malformed,
        total_count=total,
        malformed_pct=percentage(malformed, total),
    )


def _typed(stats: DataFrame, schema, **columns: Column) -> DataFrame:
    return stats.select(
        *[
            columns.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )

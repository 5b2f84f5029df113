"""The whole job: clean once, answer the queries, record the run."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logweir.operators.cleaning import parse_access_log, select_batch, tag_batch
from logweir.operators.errors import hourly_errors
from logweir.operators.quality import record_counts, stats_row
from logweir.operators.traffic import daily_traffic, top_resources
from logweir.schemas import QUERY_NAMES, QUERY_SCHEMAS, QUERY_TABLES, VALID_LOGS
from logweir.sinks.runs import (
    Run,
    append_results,
    append_run_rows,
    append_sketches,
    check_new,
    next_run_id,
    written_tables,
)
from logweir.sinks.tables import publish, write_table
from logweir.sources.raw import read_raw_logs
from logweir.sources.tables import read_attempts, read_store, read_table, version_path

TABLE_SPLIT_BYTES = "128m"


@dataclass(frozen=True)
class RunOutput:
    """What ``run`` leaves: all read back from storage, nothing recomputed."""

    run: Run
    valid_logs: DataFrame
    results: dict[str, DataFrame]
    stats: DataFrame


def _chosen(query: str) -> tuple[str, ...]:
    if query == "All":
        return QUERY_NAMES
    if query not in QUERY_NAMES:
        raise ValueError(f"query must be 'All' or one of {QUERY_NAMES}, not {query!r}")
    return (query,)


def query_results(
    valid: DataFrame,
    query: str = "All",
    ordered: bool = True,
    tie: str = "path",
    rescan: bool = False,
) -> dict[str, DataFrame]:
    """The chosen query, or all three, over one frame of valid logs.

    ``rescan`` is for a stored table (see ``top_resources``).
    """
    plans = {
        "Query1": lambda: daily_traffic(valid, ordered),
        "Query2": lambda: top_resources(valid, tie=tie, rescan=rescan),
        "Query3": lambda: hourly_errors(valid, ordered),
    }
    return {name: plans[name]() for name in _chosen(query)}


def clean_to_table(
    tagged: DataFrame, path: str, match: str = "full", batch: int = 0, fmt: str = "parquet"
) -> DataFrame:
    """Write the valid logs of tagged lines and return the run statistics.

    Lines and valid lines are counted while they are written, so the raw files
    are read once. The write has no shuffle, and Spark adds up a task's counts
    only when its partition first completes: retried and speculative tasks are
    not counted twice.
    """
    spark = tagged.sparkSession
    counted = Observation()
    parsed = parse_access_log(select_batch(tagged, batch), match).observe(
        counted, *record_counts(F.col("is_valid"))
    )
    valid = parsed.where("is_valid").select(*VALID_LOGS.fieldNames())
    write_table(valid, path, fmt)
    counts = counted.get
    return stats_row(spark, counts["total_records"], counts["valid_records"], batch)


@contextmanager
def _table_splits(spark: SparkSession) -> Iterator[None]:
    """Reads the table in splits of TABLE_SPLIT_BYTES, whatever suits raw text.

    Parquet holds about eight times as many lines in a byte.
    """
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name, None)
    spark.conf.set(name, TABLE_SPLIT_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _results_of(spark: SparkSession, store: str, run: Run, query: str) -> dict[str, DataFrame]:
    """What an attempt has written, finished or not."""
    there = written_tables(spark, store, run)
    of = [(run.run_id, run.attempt)]
    return {
        name: read_attempts(spark, store, table, of if table in there else []).select(
            *QUERY_SCHEMAS[name].fieldNames()
        )
        for name, table in ((n, QUERY_TABLES[n]) for n in _chosen(query))
    }


def run(
    spark: SparkSession,
    input_path: str,
    output: str,
    query: str = "All",
    batch: int = 0,
    match: str = "full",
    batch_rule: str | int = "file_name",
    tie: str = "path",
    run_id: int | None = None,
    pipeline_name: str = "Spark",
    partitions: int | None = None,
    sketches: bool = False,
) -> RunOutput:
    """Run the job on the files under ``input_path`` and add it to the store.

    ``output/valid_logs`` gets a new version, which replaces the last one when the run is
    recorded, and ``output/store`` is added to; both must be on storage that every executor
    sees. The results are computed from the run's own version, so other runs on the same
    output, also at the same time, do not change them. Without a ``run_id`` the next free
    one is taken, and another if a run elsewhere finishes under it first. ``sketches`` also
    stores sketches of hosts, which add up over runs (see ``sketched_hosts``).
    """
    _chosen(query)
    store, versions = f"{output}/store", f"{output}/valid_logs"
    chosen = run_id is not None
    if chosen:
        check_new(spark, store, run_id)
    else:
        run_id = next_run_id(spark, store)
    this = Run(run_id, query, batch, pipeline_name, input_path, batch_rule=batch_rule)

    version, table = this.attempt, version_path(versions, this.attempt)
    started = time.monotonic()
    tagged = tag_batch(read_raw_logs(spark, input_path, partitions), batch_rule)
    stats = clean_to_table(tagged, table, match, batch)
    valid = read_table(spark, table)
    results = query_results(valid, query, ordered=False, tie=tie, rescan=True)
    with _table_splits(spark):
        append_results(store, this, results)
        if sketches:
            append_sketches(store, this, valid)
    runtime_ms = round((time.monotonic() - started) * 1000)
    while True:
        try:
            append_run_rows(store, this, stats, runtime_ms)
            break
        except ValueError:
            if chosen:
                raise
            kept = _results_of(spark, store, this, query)
            this = this.renumbered(next_run_id(spark, store))
            append_results(store, this, kept)
            if sketches:
                append_sketches(store, this, valid)
    publish(spark, versions, version)

    stored = {
        name: read_store(spark, store, QUERY_TABLES[name], this.run_id).select(
            *QUERY_SCHEMAS[name].fieldNames()
        )
        for name in _chosen(query)
    }
    return RunOutput(this, valid, stored, stats)

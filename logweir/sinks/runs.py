"""The run store: results and descriptions of runs, accumulated in Parquet.

Every attempt at a run writes below ``run_id=.../attempt=...``, and the attempt is a
random name of its own. A small manifest ``manifest/run-<id>.json`` is written last, must
not exist before, and names the attempt and its tables; only rows of attempts so named are
read. So what a lost driver or another driver with the same id has left is never seen, and
nothing is ever overwritten. One run is opened by its manifest, without a listing of others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir import storage
from logweir.operators.quality import batch_metadata, malformed_summary, run_record
from logweir.operators.sketches import SKETCHED
from logweir.schemas import ALL_TABLES, DEFAULT_INPUT, QUERY_TABLES
from logweir.sources.tables import (
    ATTEMPT, all_finished, attempt_path, compacted_path, is_finished, manifest_path,
    read_attempts, read_table, run_ids,
)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _attempt() -> str:
    return uuid.uuid4().hex


@dataclass(frozen=True)
class Run:
    """What identifies a run, and one attempt at it, in the store."""

    run_id: int
    query: str = "All"
    batch: int = 0
    pipeline_name: str = "Spark"
    input_dir: str = DEFAULT_INPUT
    executed_at: datetime = field(default_factory=_now)
    batch_rule: str | int = "file_name"
    attempt: str = field(default_factory=_attempt)

    def renumbered(self, run_id: int) -> Run:
        """The same run as a new attempt under another id."""
        return replace(self, run_id=run_id, attempt=_attempt())


def stamp(result: DataFrame, query: str, run: Run) -> DataFrame:
    """A query result as rows of its store table."""
    return _stamped(result, QUERY_TABLES[query], run)


def _stamped(result: DataFrame, table: str, run: Run) -> DataFrame:
    schema = ALL_TABLES[table]
    stamps = {
        "run_id": F.lit(run.run_id),
        "pipeline_name": F.lit(run.pipeline_name),
        "executed_at": F.lit(run.executed_at),
    }
    return result.select(
        *[stamps.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema]
    )


def _write(rows: DataFrame, store: str, table: str, run: Run) -> None:
    # The attempt is new, so its folder is, too: nothing is there to be replaced.
    named = rows.withColumn(ATTEMPT, F.lit(run.attempt))
    named.write.mode("append").partitionBy("run_id", ATTEMPT).parquet(f"{store}/{table}")


def next_run_id(spark: SparkSession, store: str) -> int:
    """One more than the highest id in any table, of finished runs or not."""
    return max(run_ids(spark, store), default=0) + 1


def append_results(store: str, run: Run, results: Mapping[str, DataFrame]) -> None:
    """Write the results of this attempt. They are not seen before its manifest."""
    for query, result in results.items():
        _write(stamp(result, query, run), store, QUERY_TABLES[query], run)


def append_sketches(store: str, run: Run, valid: DataFrame) -> None:
    """Write sketches of the hosts of this attempt's valid logs, beside its results."""
    for table, made in SKETCHED.items():
        _write(_stamped(made(valid), table, run), store, table, run)


def append_run_rows(store: str, run: Run, stats: DataFrame, runtime_ms: int) -> None:
    """Describe ``run``, and then mark the attempt finished by its manifest.

    If another attempt under this id has finished meanwhile, that is an error, and
    this attempt stays unseen.
    """
    metadata = batch_metadata(stats, run.run_id, run.batch, run.input_dir, run.batch_rule)
    _write(metadata, store, "batch_metadata", run)
    summary = malformed_summary(stats, run.run_id, run.batch)
    _write(summary, store, "malformed_records_summary", run)
    record = run_record(
        stats, run.run_id, run.pipeline_name, run.query, run.batch, runtime_ms, run.executed_at
    )
    _write(record, store, "runs", run)
    _finish(stats.sparkSession, store, run)


def written_tables(spark: SparkSession, store: str, run: Run) -> list[str]:
    """Tables of which this attempt has a folder: an empty result leaves none."""
    return [
        table for table in ALL_TABLES
        if storage.exists(spark, attempt_path(store, table, run.run_id, run.attempt))
    ]


def _finish(spark: SparkSession, store: str, run: Run) -> None:
    tables = written_tables(spark, store, run)
    said = json.dumps({"run_id": run.run_id, ATTEMPT: run.attempt, "tables": tables})
    check_new(spark, store, run.run_id)
    if not storage.create(spark, manifest_path(store, run.run_id), said):
        raise ValueError(f"run {run.run_id} is already in {store}")


def check_new(spark: SparkSession, store: str, run_id: int) -> None:
    if is_finished(spark, store, run_id):
        raise ValueError(f"run {run_id} is already in {store}")


def compact_store(spark: SparkSession, store: str, remove: bool = False) -> int:
    """Put the rows of all finished runs together, and return how many runs that are.

    Each table becomes few files, in the order of run ids, so that one run is found by the
    files' statistics. Runs that finish meanwhile, and later ones, keep their own folders;
    the next compaction takes them in. Readers see the old folders or the new one, and of
    two compactions at once one gives up. ``remove`` removes the old folders and manifests
    afterwards: only where nobody reads them still.
    """
    own, before = all_finished(spark, store)
    ids = sorted({*(r.run_id for r in own), *(before.runs if before else ())})
    if not own:
        return len(ids)
    name = _attempt()
    for table, schema in ALL_TABLES.items():
        rows = read_attempts(
            spark, store, table, [(r.run_id, r.attempt) for r in own if table in r.tables]
        )
        if before:
            rows = rows.unionByName(read_table(spark, f"{before.path}/{table}", schema=schema))
        ordered = rows.repartitionByRange("run_id").sortWithinPartitions("run_id")
        ordered.write.parquet(f"{store}/compacted/{name}/{table}")
    number = before.number + 1 if before else 1
    said = json.dumps({"name": name, "runs": ids})
    if not storage.create(spark, compacted_path(store, number), said):
        storage.remove(spark, f"{store}/compacted/{name}")
        return compact_store(spark, store, remove)
    if remove:
        for run in own:
            storage.remove(spark, manifest_path(store, run.run_id))
            for table in run.tables:
                storage.remove(spark, attempt_path(store, table, run.run_id, run.attempt))
        if before:
            storage.remove(spark, compacted_path(store, before.number))
            storage.remove(spark, before.path)
    return len(ids)


def append_run(
    spark: SparkSession,
    store: str,
    run: Run,
    results: Mapping[str, DataFrame],
    stats: DataFrame,
    runtime_ms: int = 0,
) -> None:
    """Add a run to the store. A finished run of the same id is an error."""
    check_new(spark, store, run.run_id)
    append_results(store, run, results)
    append_run_rows(store, run, stats, runtime_ms)

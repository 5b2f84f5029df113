"""Columnar tables, their current version, and the run store."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir import storage
from logweir.schemas import ALL_TABLES, VALID_LOGS

#: The store's partition column below ``run_id``: which attempt wrote a row.
ATTEMPT = "attempt"
#: So many manifests are read one by one; more are read by Spark.
_FEW = 32


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = VALID_LOGS
) -> DataFrame:
    """A Parquet or ORC table, columns in the order of ``schema``."""
    return spark.read.schema(schema).format(fmt).load(path).select(*schema.fieldNames())


# Versions of a table -------------------------------------------------------------


class Current(NamedTuple):
    """What the last pointer of a table says: its version, and those before that are kept."""

    number: int
    version: str
    before: list[str]


def current(spark: SparkSession, table: str) -> Current | None:
    """The last pointer ``current-<number>.json`` of a versioned table."""
    while True:
        found = [re.fullmatch(r"current-(\d+)\.json", name) for name in storage.names(spark, table)]
        numbers = [int(m[1]) for m in found if m]
        if not numbers:
            return None
        text = storage.read(spark, f"{table}/current-{max(numbers)}.json")
        if text:  # else it has just been removed, or is being written
            said = json.loads(text)
            return Current(max(numbers), said["version"], said["before"])


def version_path(table: str, version: str) -> str:
    return f"{table}/version-{version}"


def read_current(
    spark: SparkSession, table: str, fmt: str = "parquet", schema: T.StructType = VALID_LOGS
) -> DataFrame:
    """The published version of a table that ``run`` writes, such as ``output/valid_logs``."""
    now = current(spark, table)
    if now is None:
        raise ValueError(f"no version of {table} has been published")
    return read_table(spark, version_path(table, now.version), fmt, schema)


# The run store -------------------------------------------------------------------


class Finished(NamedTuple):
    """A finished run: its attempt and the tables that have rows of it."""

    run_id: int
    attempt: str
    tables: tuple[str, ...]


class Compacted(NamedTuple):
    """Runs whose rows are together in one folder."""

    number: int
    runs: frozenset[int]
    path: str


def manifest_path(store: str, run_id: int) -> str:
    return f"{store}/manifest/run-{run_id}.json"


def compacted_path(store: str, number: int) -> str:
    return f"{store}/manifest/compacted-{number}.json"


def attempt_path(store: str, table: str, run_id: int, attempt: str) -> str:
    return f"{store}/{table}/run_id={run_id}/{ATTEMPT}={attempt}"


def _numbers(names: Sequence[str], pattern: str) -> list[int]:
    return [int(m[1]) for m in (re.fullmatch(pattern, name) for name in names) if m]


def run_ids(spark: SparkSession, store: str) -> set[int]:
    """Ids of which the store has anything, of finished runs or not: one listing a table."""
    found: set[int] = set()
    for table in ALL_TABLES:
        found.update(_numbers(storage.names(spark, f"{store}/{table}"), r"run_id=(\d+)"))
    manifests = storage.names(spark, f"{store}/manifest")
    found.update(_numbers(manifests, r"run-(\d+)\.json"))
    compacted = _compacted(spark, store, manifests)
    return found | (compacted.runs if compacted else set())


def finished(spark: SparkSession, store: str, run_id: int) -> Finished | None:
    """What a run's manifest says, if it has one of its own."""
    text = storage.read(spark, manifest_path(store, run_id))
    if not text:
        return None
    said = json.loads(text)
    return Finished(run_id, said["attempt"], tuple(said["tables"]))


def is_finished(spark: SparkSession, store: str, run_id: int) -> bool:
    if storage.exists(spark, manifest_path(store, run_id)):
        return True
    compacted = _compacted(spark, store)
    return compacted is not None and run_id in compacted.runs


def _compacted(
    spark: SparkSession, store: str, manifests: Sequence[str] | None = None
) -> Compacted | None:
    """The last compaction."""
    if manifests is None:
        manifests = storage.names(spark, f"{store}/manifest")
    numbers = _numbers(manifests, r"compacted-(\d+)\.json")
    if not numbers:
        return None
    said = json.loads(storage.read(spark, compacted_path(store, max(numbers))) or "{}")
    return Compacted(max(numbers), frozenset(said["runs"]), f"{store}/compacted/{said['name']}")


def all_finished(spark: SparkSession, store: str) -> tuple[list[Finished], Compacted | None]:
    """Finished runs with a folder of their own, and the last compaction of others."""
    manifests = storage.names(spark, f"{store}/manifest")
    compacted = _compacted(spark, store, manifests)
    ids = sorted(set(_numbers(manifests, r"run-(\d+)\.json")))
    own = [n for n in ids if compacted is None or n not in compacted.runs]
    if len(own) <= _FEW:
        return [f for f in (finished(spark, store, n) for n in own) if f], compacted
    schema = f"run_id bigint, {ATTEMPT} string, tables array<string>"
    rows = spark.read.schema(schema).json([manifest_path(store, n) for n in own]).collect()
    return [Finished(r.run_id, r[ATTEMPT], tuple(r.tables)) for r in rows], compacted


def read_attempts(
    spark: SparkSession, store: str, table: str, attempts: Sequence[tuple[int, str]]
) -> DataFrame:
    """Rows of one table that these attempts (run id, attempt) have written: no other
    folder is opened."""
    schema = ALL_TABLES[table]
    paths = [attempt_path(store, table, *a) for a in attempts]
    if not paths:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    with_attempt = T.StructType([*schema, T.StructField(ATTEMPT, T.StringType())])
    reader = spark.read.schema(with_attempt).option("basePath", f"{store}/{table}")
    return reader.parquet(*paths).select(*schema.fieldNames())


def read_store(
    spark: SparkSession, store: str, table: str, run_id: int | None = None
) -> DataFrame:
    """Finished runs' rows of one table.

    A ``run_id`` opens that run's manifest and then its one folder, however many runs the
    store has. A run is finished when its manifest names its attempt; rows of others are
    not seen. Runs that ``compact_store`` has put together are read from there.
    """
    if run_id is not None and (run := finished(spark, store, run_id)) is not None:
        there = [(run_id, run.attempt)] if table in run.tables else []
        return read_attempts(spark, store, table, there)
    own, compacted = ([], _compacted(spark, store)) if run_id is not None else all_finished(spark, store)
    rows = read_attempts(
        spark, store, table, [(r.run_id, r.attempt) for r in own if table in r.tables]
    )
    if compacted and (run_id is None or run_id in compacted.runs):
        together = read_table(spark, f"{compacted.path}/{table}", schema=ALL_TABLES[table])
        rows = together if not own else rows.unionByName(together)
        rows = rows.where(F.col("run_id") == run_id) if run_id is not None else rows
    return rows

"""Columnar tables."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from logweir import storage
from logweir.sources.tables import current, version_path


def write_table(
    frame: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = ("batch_id",),
    compression: str = "zstd",
) -> None:
    """Write a Parquet or ORC table, partitioned for batch selection.

    Nothing is shuffled first: under the file rules a task's input belongs to
    one batch, so it writes one file. Spark sorts each task's rows by batch
    unless ``spark.sql.maxConcurrentOutputFileWriters`` is set.
    """
    writer = frame.write.mode(mode).format(fmt).option("compression", compression)
    writer.partitionBy(*partition_by).save(path)


def publish(spark: SparkSession, table: str, version: str, keep: int = 2) -> None:
    """Make ``version``, written to ``version_path``, what ``read_current`` reads.

    The pointer is a small numbered file that must not exist, so of two drivers at once
    one comes after the other, and the last one's version is current. Of earlier versions
    the ``keep - 1`` last ones stay for those who still read them; older ones are removed.
    A version that was never published is not touched: another driver may be writing it.
    """
    while True:
        last = current(spark, table)
        earlier = [last.version, *last.before] if last else []
        number = last.number + 1 if last else 1
        said = json.dumps({"version": version, "before": earlier[: keep - 1]})
        if storage.create(spark, f"{table}/current-{number}.json", said):
            break
    for old in earlier[keep - 1 :]:
        storage.remove(spark, version_path(table, old))
    storage.remove(spark, f"{table}/current-{number - 2}.json")

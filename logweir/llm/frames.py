"""Small helpers shared by the operators: numpy over text columns, written tables."""

from __future__ import annotations

import contextlib
import ctypes
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logweir.scratch import scratch_dir

#: What a function over texts returns: one Arrow array for each field.
Arrays = Sequence[pa.Array]
#: Bytes of rows that Spark sends to Python at once, and of texts that are handled at once.
BATCH_BYTES = 8 << 20
SLICE_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession) -> None:
    """Lets this session send at most BATCH_BYTES at once to Python, where it sends more.

    Spark's own limit lets each task hold several times 64 MB, in the JVM and in Python.
    """
    given = spark.conf.get(_BATCH_SETTING, None) or ""
    said = re.fullmatch(r"(\d+)([kmgt]?)b?", given.strip().lower())
    size = int(said[1]) << (10 * " kmgt".index(said[2] or " ")) if said else 0
    if not 0 < size <= BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """First row and number of rows of pieces of about ``size`` bytes of text."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    ends = np.cumsum(lengths.astype(np.int64))
    row, done = 0, 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield row, stop - row
        row, done = stop, int(ends[stop - 1])


def give_back() -> None:
    """Returns to the system what a task's arrays have taken: idle workers keep it else."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def map_texts(
    docs: DataFrame,
    text: str,
    fields: str,
    compute: Callable[[pa.Array], Arrays],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Each row as a struct ``row`` of the columns ``keep`` (default: all), and new fields.

    ``compute`` gets the texts of some rows. The struct keeps the fields from clashing with
    columns of the input. A text that is kept is sent to Python once, as part of the row.
    """
    small_batches(docs.sparkSession)
    names = list(docs.columns if keep is None else keep)
    columns = [docs[c] for c in names]
    inside = names.index(text) if names.count(text) == 1 else None
    source = docs.select(
        F.struct(*columns, *[] if columns else [F.lit(True).alias("_")]).alias("row"),
        *[docs[text].alias("text")] if inside is None else [],
    )
    added = StructType.fromDDL(fields)
    schema = StructType([source.schema["row"], *added])
    out_names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0)
            texts = batch.column(1) if inside is None else rows.field(inside)
            for at, n in slices(texts):
                out = [rows.slice(at, n), *compute(texts.slice(at, n))]
                yield pa.RecordBatch.from_arrays(out, names=out_names)
        give_back()

    return source.mapInArrow(run, schema)


def stored(frame: DataFrame, path: str | None = None, used_once: bool = False) -> DataFrame:
    """The frame written to the shared scratch folder and read back: lineage ends there.

    What it shuffles is removed from disk with the write if it is ``used_once``: nothing else
    has to need the frame itself.
    """
    spark: SparkSession = frame.sparkSession
    path = path or scratch_dir(spark)
    before = spark.conf.get(_CLEANUP_SETTING, "false")
    spark.conf.set(_CLEANUP_SETTING, "true" if used_once else before)
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP_SETTING, before)
    return spark.read.schema(frame.schema).parquet(path)


def lanes(spark: SparkSession) -> int:
    """Partitions that shuffles of this session have."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")

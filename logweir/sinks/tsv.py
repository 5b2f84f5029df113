"""Tab-separated text without quoting or escaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tsv_line(frame: DataFrame) -> Column:
    """A row's values joined by tabs; NULL is an empty field."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in frame.columns]
    return F.concat_ws("\t", *values)


def write_tsv(
    frame: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None
) -> None:
    """Write ``frame`` as text, replacing earlier output by default."""
    frame.select(tsv_line(frame).alias("value")).write.mode(mode).text(
        path, compression=compression
    )

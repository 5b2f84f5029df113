"""Documents with labels, and folds by CRC-32 of the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: So many labels are broadcast; more are joined by a shuffle.
BROADCAST_LABELS = 1_000_000


def fold(ident: Column, folds: int) -> Column:
    """crc32 of the id as text (null: '') mod ``folds``."""
    return F.crc32(F.coalesce(ident.cast("string"), F.lit(""))) % folds


def with_labels(
    docs: DataFrame, labels: DataFrame, label: str, ident: str, text: str
) -> DataFrame:
    """``ident``, ``label`` (int) and ``text`` of documents with a label of 0 or 1."""
    marks = labels.select(labels[ident].alias("of"), labels[label].cast("int").alias("label"))
    marks = marks.where("of IS NOT NULL AND label IN (0, 1)")
    if marks.count() <= BROADCAST_LABELS:
        marks = F.broadcast(marks)
    rows = docs.select(docs[ident].alias("ident"), docs[text].alias("text"))
    return rows.join(marks, F.col("ident") == F.col("of")).select("ident", "label", "text")

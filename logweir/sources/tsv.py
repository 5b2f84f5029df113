"""Tab-separated text, exactly as written by ``sinks.tsv``.

The CSV reader is not used: it gives quotes, ``#`` and empty strings a meaning
that these files do not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.functions.measures import coerce_double, coerce_long


def _value(text, data_type: T.DataType, numbers: str, empty: str):
    if isinstance(data_type, T.StringType):
        return text
    if numbers == "lenient":
        if isinstance(data_type, T.DoubleType):
            return coerce_double(text)
        if isinstance(data_type, T.DecimalType):
            return F.coalesce(text.try_cast(data_type), F.lit(0).cast(data_type))
        return coerce_long(text).cast(data_type)
    if empty == "null":
        text = F.nullif(text, F.lit(""))
    return text.cast(data_type)


def read_tsv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    arity: str = "exact",
    numbers: str = "strict",
    empty: str = "null",
) -> DataFrame:
    """Rows by position; blank lines and rows of the wrong length are skipped.

    ``arity="exact"`` wants as many fields as ``schema`` has, ``"at_least"``
    ignores further ones. Text that is no number fails the query under
    ``numbers="strict"`` and becomes 0 under ``"lenient"``. An empty field where a
    strict number is wanted is NULL, as ``write_tsv`` writes it, or under
    ``empty="error"`` fails like other text. Of text, NULL and '' look the same and
    are read as ''.
    """
    if arity not in ("exact", "at_least"):
        raise ValueError(f"arity must be 'exact' or 'at_least', not {arity!r}")
    if numbers not in ("strict", "lenient"):
        raise ValueError(f"numbers must be 'strict' or 'lenient', not {numbers!r}")
    if empty not in ("null", "error"):
        raise ValueError(f"empty must be 'null' or 'error', not {empty!r}")
    width = len(schema)
    # Exploding the one-element array keeps the split from being evaluated
    # both by the length filter and by the projection above it.
    split = F.explode(F.array(F.split("value", "\t", -1))).alias("fields")
    rows = spark.read.text(path).where(F.col("value").rlike(r"[^\x00-\x20]")).select(split)
    size = F.size("fields")
    rows = rows.where(size == width if arity == "exact" else size >= width)
    return rows.select(
        *[
            _value(F.get("fields", F.lit(i)), field.dataType, numbers, empty).alias(field.name)
            for i, field in enumerate(schema)
        ]
    )

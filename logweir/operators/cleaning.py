"""Raw lines to valid log records. Every step is narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.functions.parsing import PART_COUNT, batch_of, line_parts, normalize_bytes
from logweir.schemas import VALID_LOGS

_PARTS = "line_parts"
_BYTES = VALID_LOGS["bytes"].name


def tag_batch(lines: DataFrame, rule: str | int = "file_name") -> DataFrame:
    """Add ``batch_id`` to lines (see ``functions.batch_of`` for the rules)."""
    needed = {"file_name": "file_name", "path": "file_path", "line": "line"}
    columns = {name: F.col(name) for name in needed.values() if name in lines.columns}
    if rule in needed and needed[rule] not in columns:
        raise ValueError(f"batch rule {rule!r} needs a column {needed[rule]!r}")
    return lines.withColumn("batch_id", batch_of(rule, **columns))


def select_batch(tagged: DataFrame, batch: int = 0) -> DataFrame:
    """Keep one batch; 0 keeps all.

    On tagged files this becomes a filter on the file name, on a stored table
    one on its partition column: files of other batches are not opened.
    """
    if batch not in (0, 1, 2):
        raise ValueError(f"batch must be 0 (all), 1 or 2, not {batch!r}")
    return tagged if batch == 0 else tagged.where(F.col("batch_id") == batch)


def _with_parts(tagged: DataFrame, match: str, kept: Sequence[str]) -> DataFrame:
    # `explode` of a one-element array yields one row per line and is a fence:
    # the optimizer cannot copy the regex into the filters and projections
    # above it, so each line is matched once instead of twice or more.
    parts = F.explode(F.array(line_parts(F.col("line"), match))).alias(_PARTS)
    return tagged.select(*kept, parts)


def _field(position: int) -> Column:
    return F.get(_PARTS, F.lit(position))


def _fields() -> dict[str, Column]:
    text = ["host", "log_date", "log_hour", "method", "resource_path", "protocol", "status_code"]
    # The regex leaves only digits to cast; `try_cast` is for a filter that a
    # later step adds and Catalyst moves below the one on validity.
    fields = {name: _field(i).try_cast(VALID_LOGS[name].dataType) for i, name in enumerate(text)}
    fields[_BYTES] = normalize_bytes(_field(PART_COUNT - 1))
    return fields


def _is_valid() -> Column:
    return (F.size(_PARTS) == PART_COUNT) & normalize_bytes(_field(PART_COUNT - 1)).isNotNull()


def parse_access_log(
    tagged: DataFrame, match: str = "full", keep: Sequence[str] = ()
) -> DataFrame:
    """Every line, valid or not: ``keep``, ``line``, ``is_valid`` and the fields.

    The fields of a malformed line are NULL.
    """
    kept = list(dict.fromkeys([*keep, "batch_id", "line"]))
    valid = F.coalesce(_is_valid(), F.lit(False))
    rest = [F.when(valid, field).alias(name) for name, field in _fields().items()]
    return _with_parts(tagged, match, kept).select(*kept, valid.alias("is_valid"), *rest)


def clean_logs(
    tagged: DataFrame, match: str = "full", batch: int = 0, keep: Sequence[str] = ()
) -> DataFrame:
    """Valid records of tagged lines, in the schema ``VALID_LOGS``.

    ``keep`` names further input columns to carry along, in front.
    """
    kept = list(dict.fromkeys([*keep, "batch_id"]))
    fields = [field.alias(name) for name, field in _fields().items()]
    parts = _with_parts(select_batch(tagged, batch), match, kept)
    return parts.where(_is_valid()).select(*kept, *fields)


def malformed_lines(
    tagged: DataFrame, match: str = "full", batch: int = 0, keep: Sequence[str] = ()
) -> DataFrame:
    """The lines that ``clean_logs`` drops."""
    kept = list(dict.fromkeys([*keep, "batch_id", "line"]))
    rejected = ~F.coalesce(_is_valid(), F.lit(False))
    return _with_parts(select_batch(tagged, batch), match, kept).where(rejected).select(*kept)

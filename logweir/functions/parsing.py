"""Column expressions that take a log line apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweir.schemas import (
    ACCESS_LOG_PATTERN,
    SECOND_BATCH_FILE_MARK,
    SECOND_BATCH_LINE_MARK,
)

PART_COUNT = 8
_GROUPS_ON_LINES = "\n".join(f"${group}" for group in range(1, PART_COUNT + 1))

# What may follow the pattern. `(?s)` lets the tail hold Unicode line
# separators; a bare `.*` would stop there and leave the rest in the bytes.
_TAILS = {"full": r"\z", "prefix": r"(?s).*\z"}


def line_parts(line: Column, match: str = "full") -> Column:
    """The eight fields of a valid line as an array, else an array of one.

    The line is rewritten to its groups, one per text line, in one regex pass.
    A text file's line has no line feed, so only a match can give eight parts;
    a longer in-memory string that holds one is no line and counts as malformed.
    """
    if match not in _TAILS:
        raise ValueError(f"match must be one of {sorted(_TAILS)}, not {match!r}")
    single = F.when(line.contains("\n"), F.lit("")).otherwise(line)
    rewritten = F.regexp_replace(single, ACCESS_LOG_PATTERN + _TAILS[match], _GROUPS_ON_LINES)
    return F.split(rewritten, "\n", -1)


def normalize_bytes(bytes_text: Column) -> Column:
    """Digits as a long, anything else 0; NULL for digits beyond a long."""
    return F.when(bytes_text.rlike(r"^\d+\z"), bytes_text.try_cast("bigint")).otherwise(
        F.lit(0).cast("bigint")
    )


def batch_of(
    rule: str | int,
    *,
    file_name: Column | None = None,
    file_path: Column | None = None,
    line: Column | None = None,
) -> Column:
    """Batch id of a line under a rule.

    ``file_name`` looks at the base name, ``path`` at the whole path, ``line``
    at the line text (its URL included); a number puts every line in that batch.
    """
    if isinstance(rule, int):
        return F.lit(rule).cast("int")
    looked_at = {
        "file_name": (file_name, SECOND_BATCH_FILE_MARK),
        "path": (file_path, SECOND_BATCH_FILE_MARK),
        "line": (line, SECOND_BATCH_LINE_MARK),
    }
    if rule not in looked_at:
        raise ValueError(f"batch rule must be a number or one of {sorted(looked_at)}, not {rule!r}")
    text, mark = looked_at[rule]
    return F.when(text.contains(mark), F.lit(2)).otherwise(F.lit(1))

from logweir.functions.measures import (
    as_percent,
    coerce_double,
    coerce_long,
    error_rate,
    is_error,
    percentage,
    shorten_path,
    truncate,
)
from logweir.functions.parsing import batch_of, line_parts, normalize_bytes

__all__ = [
    "as_percent",
    "batch_of",
    "coerce_double",
    "coerce_long",
    "error_rate",
    "is_error",
    "line_parts",
    "normalize_bytes",
    "percentage",
    "shorten_path",
    "truncate",
]

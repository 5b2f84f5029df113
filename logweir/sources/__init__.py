from logweir.sources.documents import coerce_numbers, read_documents
from logweir.sources.raw import read_raw_logs
from logweir.sources.tables import read_current, read_store, read_table
from logweir.sources.tsv import read_tsv

__all__ = [
    "coerce_numbers",
    "read_current",
    "read_documents",
    "read_raw_logs",
    "read_store",
    "read_table",
    "read_tsv",
]

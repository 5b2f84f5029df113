from logweir.sinks.jdbc import append_jdbc, insert_once, insert_run
from logweir.sinks.runs import Run, append_run, compact_store, next_run_id, stamp
from logweir.sinks.tables import publish, write_table
from logweir.sinks.tsv import write_tsv

__all__ = [
    "Run",
    "append_jdbc",
    "append_run",
    "compact_store",
    "insert_once",
    "insert_run",
    "next_run_id",
    "publish",
    "stamp",
    "write_table",
    "write_tsv",
]

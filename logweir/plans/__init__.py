from logweir.plans.job import RunOutput, clean_to_table, query_results, run
from logweir.plans.report import preview, report, run_header

__all__ = [
    "RunOutput",
    "clean_to_table",
    "preview",
    "query_results",
    "report",
    "run",
    "run_header",
]

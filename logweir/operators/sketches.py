"""Distinct hosts that add up: sketches beside the exact counts.

Exact distinct counts of two runs cannot be added, since hosts are in both. A sketch of a
group's hosts can be kept with a run's results and merged with those of other runs, without
reading their logs again. Estimates are off by about 1.04 / 2 ** (SKETCH_BITS / 2), and
exact counts stay what the queries report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.operators.errors import error_logs

#: Log2 of a sketch's registers: 4,096 of them, an error of 1.6 %.
SKETCH_BITS = 12


def _hosts() -> Column:
    # Registers are merged map-side: a hot path is no hot task.
    return F.hll_sketch_agg("host", F.lit(SKETCH_BITS)).alias("hosts")


def resource_host_sketches(valid: DataFrame) -> DataFrame:
    """``hosts``, a sketch of the hosts of every resource of every batch."""
    return valid.groupBy("batch_id", "resource_path").agg(_hosts())


def error_host_sketches(valid: DataFrame) -> DataFrame:
    """``hosts``, a sketch of the hosts with errors of every hour of every batch."""
    return error_logs(valid).groupBy("batch_id", "log_date", "log_hour").agg(_hosts())


def sketched_hosts(sketches: DataFrame, *by: str) -> DataFrame:
    """Estimated distinct hosts by these columns, over all sketches there are of each.

    Nothing of an empty frame, and one row of 0 where there is no column to group by.
    """
    merged = F.hll_sketch_estimate(F.hll_union_agg("hosts"))
    estimate = F.coalesce(merged, F.lit(0)).cast("bigint").alias("host_estimate")
    return sketches.groupBy(*by).agg(estimate)


#: How each table of sketches is made from valid logs.
SKETCHED = {
    "resource_host_sketches": resource_host_sketches,
    "error_host_sketches": error_host_sketches,
}

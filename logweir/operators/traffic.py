"""Traffic per day and per resource."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.schemas import DAILY_TRAFFIC, TOP_RESOURCE, TOP_RESOURCES

_RESOURCE = ["batch_id", "resource_path"]

# Winners up to this many rows are broadcast to a second scan. For more, the
# one-scan form is used: a join of raw rows by path would have a hot key.
BROADCAST_ROWS = 1_000

# Resources are counted in so many buckets by hash to find those that cannot be among the
# first k: that many rows of two numbers at most leave a task, and reach the driver.
PRUNE_BUCKETS = 1 << 18
# The fullest buckets whose resources are counted for a bound of the k-th count, for each k.
_PROBES = 4

# A byte count is summed in parts of so many bits. The sum of a part stays within
# a long for 2**42 lines in a group, and all parts together are exact.
_PART_BITS = 21


def _volume() -> list[Column]:
    return [F.count(F.lit(1)).alias("request_count"), exact_total("bytes").alias("total_bytes")]


def exact_total(name: str) -> Column:
    """The exact sum of a column of longs of 0 or more, as ``decimal(38,0)``."""
    mask = F.lit((1 << _PART_BITS) - 1)
    total = None
    for part in range(3):
        bits = F.shiftright(F.col(name), part * _PART_BITS).bitwiseAND(mask)
        scaled = F.sum(bits).cast("decimal(19,0)") * F.lit(1 << (part * _PART_BITS)).cast(
            "decimal(19,0)"
        )
        total = scaled if total is None else total + scaled
    return total.cast("decimal(38,0)")


def daily_traffic(valid: DataFrame, ordered: bool = True) -> DataFrame:
    """Requests and bytes per batch, date and status.

    Dates are ordered as text, as they are written in the log.
    """
    result = (
        valid.groupBy("batch_id", "log_date", "status_code")
        .agg(*_volume())
        .select(*DAILY_TRAFFIC.fieldNames())
    )
    return result.orderBy("log_date", "status_code", "batch_id") if ordered else result


def _requests(valid: DataFrame) -> DataFrame:
    return valid.groupBy(*_RESOURCE).agg(*_volume())


def resource_traffic(valid: DataFrame) -> DataFrame:
    """Requests, bytes and distinct hosts of every resource of every batch.

    The distinct count shuffles on (batch, path, host) first, which spreads the
    hosts of a hot path over all tasks.
    """
    return (
        valid.groupBy(*_RESOURCE)
        .agg(*_volume(), F.count_distinct("host").alias("distinct_host_count"))
        .select(*TOP_RESOURCE.fieldNames())
    )


def distinct_hosts(valid: DataFrame) -> DataFrame:
    """Distinct hosts per resource, from the distinct rows themselves.

    Counts rows after a DISTINCT instead of measuring a set built per group:
    a set of all hosts of a hot path would have to fit in one task.
    """
    return (
        valid.select(*_RESOURCE, "host")
        .distinct()
        .groupBy(*_RESOURCE)
        .agg(F.count(F.lit(1)).alias("distinct_host_count"))
    )


def _ranking(tie: str) -> list:
    ties = {"path": ["resource_path", "batch_id"], "batch": ["batch_id", "resource_path"]}
    if tie not in ties:
        raise ValueError(f"tie must be one of {sorted(ties)}, not {tie!r}")
    return [F.desc("request_count"), *ties[tie]]


def possible_winners(valid: DataFrame, k: int) -> DataFrame:
    """The rows of ``valid`` whose resource may be among the ``k`` most requested.

    Resources are dealt by hash to PRUNE_BUCKETS, and lines are counted by bucket. The exact
    counts of resources in the fullest buckets give a k-th count that the true one is not
    below. A resource has no more lines than its bucket; so buckets below that count hold no
    winner, whatever decides between equal counts, and their lines are left out. Where all
    counts are alike, nothing is.
    """
    spark = valid.sparkSession
    bucket = F.pmod(F.xxhash64(*_RESOURCE), F.lit(PRUNE_BUCKETS)).cast("int")
    loads = spark.createDataFrame(
        valid.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("load")).toArrow(),
        "bucket int, load bigint",
    )

    def inside(buckets: DataFrame) -> DataFrame:
        chosen = F.broadcast(buckets.select(F.col("bucket").alias("of")))
        return valid.join(chosen, bucket == F.col("of"), "left_semi")

    fullest = loads.orderBy(F.desc("load"), "bucket").limit(_PROBES * k)
    counts = inside(fullest).groupBy(*_RESOURCE).agg(F.count(F.lit(1)).alias("n"))
    best = counts.orderBy(F.desc("n")).limit(k).agg(F.min("n"), F.count(F.lit(1))).first()
    least = best[0] if best[1] == k else 1
    return inside(loads.where(F.col("load") >= least))


def top_resources(
    valid: DataFrame,
    k: int = TOP_RESOURCES,
    tie: str = "path",
    rescan: bool = False,
    prune: bool = False,
) -> DataFrame:
    """The ``k`` most requested resources over all batches together.

    ``tie`` decides between equal counts: by path, then batch, or the reverse.

    By default one scan makes the complete ``resource_traffic`` and cuts it,
    which suits logs that are parsed on the fly. ``rescan`` suits a stored
    table: the ranking is made from counts alone, then the winners are broadcast
    to a second scan that counts hosts for them only. That keeps the (batch,
    path, host) rows of all other resources out of the shuffle. Beyond
    ``BROADCAST_ROWS`` winners there is one scan either way. Results are equal,
    and no plan shuffles raw rows by path alone. ``prune`` first leaves out what cannot
    win (see ``possible_winners``), in two more scans of two columns: for stored tables of
    very many different paths, of which only a few are requested much.
    """
    order = _ranking(tie)
    if prune and k:
        valid = possible_winners(valid, k)
    if not rescan or k > BROADCAST_ROWS:
        return resource_traffic(valid).orderBy(*order).limit(k)
    winners = F.broadcast(_requests(valid).orderBy(*order).limit(k))
    return (
        valid.select(*_RESOURCE, "host")
        .join(winners, _RESOURCE)
        .groupBy(*_RESOURCE, "request_count", "total_bytes")
        .agg(F.count_distinct("host").alias("distinct_host_count"))
        .select(*TOP_RESOURCE.fieldNames())
        .orderBy(*order)
        .limit(k)
    )

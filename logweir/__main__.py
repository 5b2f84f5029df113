"""``spark-submit``-able form of ``run`` and ``report``.

    python -m logweir --input /logs --output /results --query All --batch 0
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from logweir.plans import report, run
from logweir.schemas import QUERY_NAMES


def session() -> SparkSession:
    """A session whose table writes need no sort: at most two batches are open at once."""
    spark = SparkSession.builder.appName("logweir").getOrCreate()
    name = "spark.sql.maxConcurrentOutputFileWriters"
    if int(spark.conf.get(name, "0")) == 0:
        spark.conf.set(name, "4")
    return spark


def main() -> None:
    options = argparse.ArgumentParser(prog="logweir")
    options.add_argument("--input", required=True, help="directory of access logs")
    options.add_argument("--output", required=True, help="directory for valid logs and the store")
    options.add_argument("--query", default="All", choices=[*QUERY_NAMES, "All"])
    options.add_argument("--batch", type=int, default=0, choices=[0, 1, 2], help="0 is both")
    options.add_argument("--match", default="full", choices=["full", "prefix"])
    options.add_argument("--batch-rule", default="file_name", choices=["file_name", "path", "line"])
    options.add_argument("--run-id", type=int, default=None)
    options.add_argument("--partitions", type=int, default=None, help="spread unsplittable input")
    given = options.parse_args()

    spark = session()
    done = run(
        spark,
        given.input,
        given.output,
        query=given.query,
        batch=given.batch,
        match=given.match,
        batch_rule=given.batch_rule,
        run_id=given.run_id,
        partitions=given.partitions,
    )
    for frame in report(spark, f"{given.output}/store", done.run.run_id).values():
        frame.show(truncate=False)


if __name__ == "__main__":
    main()

"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

Each query is run once to warm up, then three times; the median counts. Results
go to Spark's no-op sink, so all rows are computed and none come to the driver.
The files and the table that the stored queries read are made beforehand.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from logweir import fixtures
from logweir import operators as op
from logweir.plans import clean_to_table, run
from logweir.scratch import scratch_dir
from logweir.sources import read_raw_logs, read_table

RUNS = 3


def _session(cpus: str) -> SparkSession:
    session = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("logweir-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        # A few megabytes of text: let every core have a split of it.
        .config("spark.sql.files.openCostInBytes", "256k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def _consume(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = _session(os.environ.get("BENCH_CPUS", "8"))
    work = scratch_dir(spark)
    logs, table = f"{work}/logs", f"{work}/valid_logs"
    fixtures.write_log_files(fixtures.raw_lines(spark, sf_dir), logs)

    def tagged() -> DataFrame:
        return op.tag_batch(read_raw_logs(spark, logs))

    def parsed() -> DataFrame:
        return op.clean_logs(tagged())

    clean_to_table(tagged(), table)
    stored = read_table(spark, table)
    outputs = iter(range(1_000))
    jobs = {
        "clean": lambda: _consume(parsed()),
        "clean_to_table": lambda: clean_to_table(tagged(), f"{work}/again"),
        "run_stats": lambda: _consume(op.run_stats(tagged())),
        "q1_daily_traffic": lambda: _consume(op.daily_traffic(parsed())),
        "q2_top_resources": lambda: _consume(op.top_resources(parsed())),
        "q3_hourly_errors": lambda: _consume(op.hourly_errors(parsed())),
        "q1_stored": lambda: _consume(op.daily_traffic(stored)),
        "q2_stored": lambda: _consume(op.top_resources(stored, rescan=True)),
        "q2_resource_traffic_stored": lambda: _consume(op.resource_traffic(stored)),
        "q3_stored": lambda: _consume(op.hourly_errors(stored)),
        "q3_join_stored": lambda: _consume(op.hourly_errors_by_join(stored)),
        "q3_two_joins_stored": lambda: _consume(op.hourly_errors_by_two_joins(stored)),
        "one_batch_stored": lambda: _consume(op.daily_traffic(op.select_batch(stored, 2))),
        "run_all": lambda: run(spark, logs, f"{work}/run-{next(outputs)}"),
    }
    seconds = {}
    for name, job in jobs.items():
        job()
        times = []
        for _ in range(RUNS):
            started = time.perf_counter()
            job()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times), 4)
    print(
        json.dumps(
            {
                "metric": "access_log_queries_total",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "lines": tagged().count(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

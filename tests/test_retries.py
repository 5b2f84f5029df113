"""Counts and rows stay exact when tasks fail and are run again."""

import subprocess
import sys
import textwrap

from conftest import ROOT

SCRIPT = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
from logweir import fixtures
from logweir.operators import hourly_errors, tag_batch
from logweir.plans import clean_to_table
from logweir.sources import read_table

spark = (
    SparkSession.builder.master("local[4,4]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")

def fail_late_once(batches):
    yield from batches
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost after all rows were produced")

raw = fixtures.raw_lines(spark, "/root/testdata/sf0.001").repartition(6)
flaky = raw.mapInPandas(fail_late_once, raw.schema)
stats = clean_to_table(tag_batch(flaky), sys.argv[1]).first()
valid = read_table(spark, sys.argv[1])
print("RESULT", stats.total_records, stats.malformed_records, valid.count(),
      hourly_errors(valid).count())
"""


def test_retried_tasks_are_counted_once(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(SCRIPT), str(tmp_path / "valid")],
        cwd=ROOT,
        capture_output=True,
        text=True,
        timeout=180,
    )
    assert "RESULT 1000 90 910 762" in done.stdout, done.stderr[-2000:]

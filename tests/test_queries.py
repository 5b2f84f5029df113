import random
import re

import helpers
import pytest
from pyspark.sql import functions as F

from logweir import fixtures
from logweir import operators as op
from logweir.plans import query_results
from logweir.schemas import DAILY_TRAFFIC, HOURLY_ERRORS, TOP_RESOURCE, VALID_LOGS

SF = "/root/testdata/sf0.001"


def _rows(frame):
    return [tuple(r) for r in frame.collect()]


@pytest.fixture(scope="module")
def skewed():
    """A third of all rows on one path, a third from one host, one hot hour."""
    rng = random.Random(7)
    rows = []
    for _ in range(6000):
        path = "/hot" if rng.random() < 0.33 else f"/p{rng.randrange(40)}"
        host = "hot.example" if rng.random() < 0.33 else f"h{rng.randrange(700)}"
        hour = 12 if rng.random() < 0.5 else rng.randrange(24)
        date = f"0{rng.randrange(1, 4)}/{rng.choice(['Jul', 'Aug'])}/1995"
        status = rng.choice([200, 304, 399, 400, 404, 599, 600])
        size = rng.randrange(10**6)
        rows.append(
            (rng.choice([1, 2]), host, date, hour, "GET", path, "HTTP/1.0", status, size)
        )
    return rows


@pytest.fixture(scope="module")
def valid(spark, skewed):
    return spark.createDataFrame(skewed, VALID_LOGS).repartition(16)


def test_against_brute_force(valid, skewed):
    assert set(_rows(op.daily_traffic(valid))) == helpers.daily(skewed)
    assert set(_rows(op.resource_traffic(valid))) == helpers.resources(skewed)
    hourly = helpers.hourly(skewed)
    for form in (op.hourly_errors, op.hourly_errors_by_join, op.hourly_errors_by_two_joins):
        assert set(_rows(form(valid))) == hourly
    hosts = {(b, p, h) for b, p, _, _, h in helpers.resources(skewed)}
    assert set(_rows(op.distinct_hosts(valid))) == hosts


def test_parts_of_hourly_errors(valid, skewed):
    hourly = helpers.hourly(skewed)
    assert set(_rows(op.hourly_totals(valid))) == {(*r[:3], r[4]) for r in hourly}
    assert set(_rows(op.error_counts(valid))) == {(*r[:3], r[3]) for r in hourly if r[3]}
    assert set(_rows(op.distinct_error_hosts(valid))) == {(*r[:3], r[6]) for r in hourly if r[3]}
    distinct = _rows(op.distinct_error_host_rows(valid))
    assert len(distinct) == len(set(distinct)) == sum(r[6] for r in hourly)
    assert op.error_logs(valid).count() == sum(r[3] for r in hourly)


@pytest.mark.parametrize("k", [1, 5, 20, 500])
@pytest.mark.parametrize("rescan", [False, True])
def test_top_resources_order_and_ties(valid, skewed, k, rescan):
    everything = helpers.resources(skewed)
    by_path = sorted(everything, key=lambda r: (-r[2], r[1], r[0]))[:k]
    assert _rows(op.top_resources(valid, k, rescan=rescan)) == by_path
    by_batch = sorted(everything, key=lambda r: (-r[2], r[0], r[1]))[:k]
    assert _rows(op.top_resources(valid, k, tie="batch", rescan=rescan)) == by_batch


def test_boundary_tie_picks_by_rule(spark):
    rows = [(b, "h", "d", 0, "GET", p, "H", 200, 1) for b, p in ((1, "/b"), (2, "/a"))]
    valid = spark.createDataFrame(rows, VALID_LOGS)
    for rescan in (False, True):
        assert op.top_resources(valid, 1, rescan=rescan).first()[:2] == (2, "/a")
        assert op.top_resources(valid, 1, tie="batch", rescan=rescan).first()[:2] == (1, "/b")
    with pytest.raises(ValueError):
        op.top_resources(valid, tie="host")


def test_total_beyond_a_long_does_not_fail_the_job(spark):
    rows = [(1, "h", "d", 0, "GET", "/big", "H", 200, 2**63 - 1)] * 2
    rows += [(1, "h", "d", 0, "GET", "/a", "H", 404, 5)]
    valid = spark.createDataFrame(rows, VALID_LOGS).repartition(3)
    daily = [(1, "d", 200, 2, 2**64 - 2), (1, "d", 404, 1, 5)]
    assert _rows(op.daily_traffic(valid)) == daily
    assert _rows(op.top_resources(valid))[0] == (1, "/big", 2, 2**64 - 2, 1)
    assert op.top_resources(valid, rescan=True).collect() == op.top_resources(valid).collect()


def test_totals_are_exact(spark):
    rng = random.Random(5)
    sizes = [rng.choice([0, 1, 2**21 - 1, 2**42, rng.randrange(2**63), 2**63 - 1]) for _ in range(3000)]
    rows = [(1, "h", "d", 0, "GET", f"/{i % 7}", "H", 200, size) for i, size in enumerate(sizes)]
    valid = spark.createDataFrame(rows, VALID_LOGS).repartition(5)
    assert set(_rows(op.resource_traffic(valid))) == helpers.resources(rows)
    # A byte count that is NULL counts for nothing.
    no_bytes = valid.withColumn("bytes", F.lit(None).cast("bigint"))
    assert op.daily_traffic(no_bytes).first().total_bytes is None


def test_row_order(valid, skewed):
    daily = sorted(helpers.daily(skewed), key=lambda r: (r[1], r[2], r[0]))
    assert _rows(op.daily_traffic(valid)) == daily
    hourly = sorted(helpers.hourly(skewed), key=lambda r: (r[1], r[2], r[0]))
    assert _rows(op.hourly_errors(valid)) == hourly
    # Dates are text: the first of August is before the first of July.
    assert [r[1] for r in daily][0].startswith("01/Aug") and "01/Jul/1995" in [r[1] for r in daily]


def test_result_schemas(valid):
    results = query_results(valid)
    for name, schema in (
        ("Query1", DAILY_TRAFFIC),
        ("Query2", TOP_RESOURCE),
        ("Query3", HOURLY_ERRORS),
    ):
        found = [(f.name, f.dataType) for f in results[name].schema]
        assert found == [(f.name, f.dataType) for f in schema]
    assert list(query_results(valid, "Query3")) == ["Query3"]
    with pytest.raises(ValueError):
        query_results(valid, "Query4")


def test_invariants(spark):
    tagged = op.tag_batch(fixtures.raw_lines(spark, SF))
    valid = op.clean_logs(tagged)
    stats = op.run_stats(tagged).first()
    kept, dropped = valid.count(), op.malformed_lines(tagged).count()
    assert (stats.total_records, stats.malformed_records) == (kept + dropped, dropped)
    assert (kept, dropped, stats.avg_batch_size) == (910, 90, 500.0)
    assert op.daily_traffic(valid).agg(F.sum("request_count")).first()[0] == kept
    assert op.hourly_errors(valid).agg(F.sum("total_request_count")).first()[0] == kept
    assert op.resource_traffic(valid).where("distinct_host_count > request_count").isEmpty()
    assert op.clean_logs(tagged, match="prefix").count() == 930


def test_nothing_and_only_malformed(spark):
    for lines, percent in (([], 0.0), (["junk", ""], 100.0)):
        tagged = op.tag_batch(helpers.lines_frame(spark, lines))
        valid = op.clean_logs(tagged)
        for result in query_results(valid).values():
            assert result.isEmpty()
        assert op.top_resources(valid, rescan=True).isEmpty()
        summary = op.malformed_summary(op.run_stats(tagged), 1).first()
        assert summary.malformed_pct == percent
        assert summary.total_count == summary.malformed_count == len(lines)


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory, skewed):
    path = str(tmp_path_factory.mktemp("plans") / "valid_logs")
    spark.createDataFrame(skewed, VALID_LOGS).write.partitionBy("batch_id").parquet(path)
    return spark.read.schema(VALID_LOGS).parquet(path)


def test_plans_read_only_what_they_need(stored):
    schema = re.findall(r"ReadSchema: (struct<[^>]*>)", _plan(op.daily_traffic(stored)))
    assert schema == ["struct<log_date:string,status_code:int,bytes:bigint>"]
    errors = _plan(op.error_counts(stored))
    assert "GreaterThanOrEqual(status_code,400), LessThanOrEqual(status_code,599)" in errors
    one_batch = _plan(op.daily_traffic(op.select_batch(stored, 2)))
    assert re.search(r"PartitionFilters: \[[^\]]*batch_id#\d+ = 2", one_batch)


def test_plans_aggregate_before_they_shuffle(stored):
    for frame in (op.daily_traffic(stored), op.hourly_errors(stored), op.resource_traffic(stored)):
        plan = _plan(frame)
        assert "partial_count" in plan
        assert "Expand" not in plan and "CartesianProduct" not in plan
    # Distinct hosts are spread by host before they are counted by group.
    assert re.search(r"hashpartitioning\(batch_id#\d+, resource_path#\d+, host", _plan(
        op.resource_traffic(stored)
    ))


def test_top_plan_broadcasts_only_a_bounded_side(stored):
    assert "TakeOrderedAndProject" in _plan(op.top_resources(stored))
    small = _plan(op.top_resources(stored, rescan=True))
    assert "BroadcastHashJoin" in small and small.count("TakeOrderedAndProject") == 2
    spark = stored.sparkSession
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = _plan(op.top_resources(stored, 20_000, rescan=True))
        joins = _plan(op.hourly_errors_by_join(stored))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Beyond the broadcast, rows are spread by host before they meet by path.
    assert "Join" not in many
    by_host = r"hashpartitioning\(batch_id#\d+, resource_path#\d+, host"
    by_path = r"hashpartitioning\(batch_id#\d+, resource_path#\d+, \d+\)"
    assert re.search(by_path, many).start() < re.search(by_host, many).start()
    assert len(re.findall("Exchange hashpartitioning", many)) == 2
    # Three exchanges feed the join (one is the distinct count's), one the final
    # order; the join itself adds none.
    assert joins.count("Exchange hashpartitioning") == 3

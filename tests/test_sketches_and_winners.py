"""Sketches of hosts that add up over runs, and top resources with losers left out."""

import random

import pytest

from logweir import fixtures
from logweir import operators as op
from logweir.operators import traffic
from logweir.plans import run
from logweir.schemas import VALID_LOGS
from logweir.sinks import compact_store
from logweir.sources import read_store


def _lines(spark, rows):
    """Valid logs from (batch, host, path, status)."""
    full = [(b, h, "01/Jul/1995", s % 24, "GET", p, "HTTP/1.0", s, 7) for b, h, p, s in rows]
    return spark.createDataFrame(full, VALID_LOGS).repartition(5)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice([1, 2]), f"h{rng.randrange(3_000)}", "/hot" if rng.random() < 0.3 else f"/p{int(rng.paretovariate(0.4)) % 3_000}",
         rng.choice([200, 404, 500]))
        for _ in range(8_000)
    ]
    return rows, _lines(spark, rows).cache()


@pytest.mark.parametrize("k", [1, 3, 20, 5_000])
@pytest.mark.parametrize("buckets", [7, 256, 1 << 18])
def test_pruned_winners_are_the_winners(skewed, monkeypatch, k, buckets):
    monkeypatch.setattr(traffic, "PRUNE_BUCKETS", buckets)
    _, valid = skewed
    for tie in ("path", "batch"):
        wanted = op.top_resources(valid, k, tie).collect()
        assert op.top_resources(valid, k, tie, rescan=k == 3, prune=True).collect() == wanted


def test_most_resources_are_left_out(skewed):
    _, valid = skewed
    of = valid.select("batch_id", "resource_path").distinct().count()
    left = op.possible_winners(valid, 5)
    assert left.select("batch_id", "resource_path").distinct().count() < of / 20
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_winners_of_equal_counts_and_of_nothing(spark):
    rows = [(1, "h", f"/p{i:03}", 200) for i in range(50)]
    wanted = [f"/p{i:03}" for i in range(4)]
    got = op.top_resources(_lines(spark, rows), 4, prune=True).collect()
    assert [r.resource_path for r in got] == wanted
    assert op.top_resources(_lines(spark, []), 4, prune=True).count() == 0
    assert op.top_resources(_lines(spark, rows), 0, prune=True).count() == 0


def test_merged_sketches_are_near_the_exact_counts(skewed):
    rows, valid = skewed
    by_batch = op.resource_host_sketches(valid)
    for by, key in ((["resource_path"], lambda r: r[2]), ([], lambda r: None)):
        exact = {}
        for r in rows:
            exact.setdefault(key(r), set()).add(r[1])
        for r in op.sketched_hosts(by_batch, *by).collect():
            n = len(exact[r.resource_path if by else None])
            assert abs(r.host_estimate - n) <= max(1, 0.07 * n)
    errors = op.sketched_hosts(op.error_host_sketches(valid), "log_hour").collect()
    wanted = {s % 24: len({h for _, h, _, t in rows if t % 24 == s % 24 and t >= 400}) for s in (404, 500)}
    assert {r.log_hour for r in errors} == set(wanted)
    assert all(abs(r.host_estimate - wanted[r.log_hour]) <= 0.07 * wanted[r.log_hour] for r in errors)


def test_sketches_of_nothing(spark):
    none = op.resource_host_sketches(_lines(spark, []))
    assert op.sketched_hosts(none, "resource_path").count() == 0
    assert op.sketched_hosts(none).first().host_estimate == 0


def test_runs_keep_sketches_where_asked(spark, tmp_path):
    logs = str(tmp_path / "logs")
    fixtures.write_log_files(fixtures.raw_lines(spark, "/root/testdata/sf0.001"), logs)
    runs = [run(spark, logs, str(tmp_path), "Query1", batch=b, sketches=b > 0) for b in (0, 1, 2)]
    store = f"{tmp_path}/store"

    def hosts(run_id=None):
        rows = read_store(spark, store, "resource_host_sketches", run_id)
        return op.sketched_hosts(rows).first().host_estimate

    assert [r.run.run_id for r in runs] == [1, 2, 3]
    assert hosts(1) == 0 and hosts(2) > 0
    both = hosts()
    assert max(hosts(2), hosts(3)) <= both <= hosts(2) + hosts(3)
    compact_store(spark, store, remove=True)
    assert hosts() == both
    for table in ("resource_host_sketches", "error_host_sketches"):
        assert {r.run_id for r in read_store(spark, store, table).select("run_id").distinct().collect()} <= {2, 3}

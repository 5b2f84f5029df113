from datetime import datetime, timezone

import pytest
from helpers import PLAIN, lines_frame

from logweir import fixtures, storage
from logweir.operators import batch_metadata, clean_logs, run_stats, stats_row, tag_batch
from logweir.plans import clean_to_table, preview, query_results, report, run
from logweir.schemas import QUERY_TABLES, STORE_TABLES, VALID_LOGS
from logweir.sinks import Run, append_jdbc, append_run, compact_store, next_run_id, publish
from logweir.sinks.runs import append_results, append_run_rows
from logweir.sources import read_current, read_store, read_table
from logweir.sources.tables import current, manifest_path, version_path

SF = "/root/testdata/sf0.001"
WHEN = datetime(2024, 9, 1, 12, tzinfo=timezone.utc)


def _counts(spark, store, run_id=None):
    return {t: read_store(spark, store, t, run_id).count() for t in STORE_TABLES}


@pytest.fixture(scope="module")
def logs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("input") / "logs")
    fixtures.write_log_files(fixtures.raw_lines(spark, SF), path)
    return path


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory, logs):
    """Two runs into one store: everything, then one query of one batch."""
    output = str(tmp_path_factory.mktemp("output"))
    first = run(spark, logs, output)
    first_valid = first.valid_logs.count()
    second = run(spark, logs, output, query="Query3", batch=2)
    return output, first, first_valid, second


def test_run_results_equal_the_queries(spark, logs, runs):
    _, first, first_valid, second = runs
    valid = clean_logs(tag_batch(fixtures.raw_lines(spark, SF)))
    assert first_valid == 910
    for name, wanted in query_results(valid).items():
        got = first.results[name]
        assert got.columns == wanted.columns
        assert sorted(got.collect()) == sorted(wanted.collect())
    assert list(second.results) == ["Query3"]
    wanted = query_results(valid.where("batch_id = 2"), "Query3")["Query3"]
    assert sorted(second.results["Query3"].collect()) == sorted(wanted.collect())


def test_valid_logs_hold_the_last_run(runs):
    second = runs[3]
    assert second.valid_logs.columns == VALID_LOGS.names
    assert {r.batch_id for r in second.valid_logs.select("batch_id").distinct().collect()} == {2}


def test_run_rows(spark, logs, runs):
    store = f"{runs[0]}/store"
    first, second = read_store(spark, store, "runs").orderBy("run_id").collect()
    assert (first.run_id, first.query_name, first.batch_id, first.batch_size) == (1, "All", 0, 0)
    assert (first.records_processed, first.malformed_record_count) == (1000, 90)
    assert first.avg_batch_size == 500.0 and first.runtime_ms > 0
    assert (second.run_id, second.query_name, second.batch_id) == (2, "Query3", 2)
    assert (second.records_processed, second.malformed_record_count) == (500, 90)
    assert second.avg_batch_size == 500.0
    metadata = read_store(spark, store, "batch_metadata").orderBy("run_id").collect()
    assert [tuple(r) for r in metadata] == [
        (1, 0, "Combined", logs, 1000),
        (2, 2, "August 1995", f"{logs} [batch 2 by file_name]", 500),
    ]
    summary = read_store(spark, store, "malformed_records_summary").orderBy("run_id").collect()
    assert [tuple(r) for r in summary] == [(1, 0, 90, 1000, 9.0), (2, 2, 90, 500, 18.0)]


def test_runs_stay_apart(spark, runs):
    store = f"{runs[0]}/store"
    assert _counts(spark, store, 2) == {
        "query1_results": 0,
        "query2_results": 0,
        "query3_results": runs[3].results["Query3"].count(),
        "batch_metadata": 1,
        "malformed_records_summary": 1,
        "runs": 1,
    }
    for table, schema in STORE_TABLES.items():
        assert read_store(spark, store, table).columns == schema.names


def test_reading_a_run_opens_its_folder_only(spark, runs, monkeypatch):
    store = f"{runs[0]}/store"
    attempt = runs[1].run.attempt
    listed = []
    names = storage.names
    monkeypatch.setattr(storage, "names", lambda spark, path: listed.append(path) or names(spark, path))
    rows = read_store(spark, store, "query1_results", 1)
    assert not listed
    files = rows.inputFiles()
    assert files and all(f"query1_results/run_id=1/attempt={attempt}/" in f for f in files)
    assert {r.run_id for r in rows.select("run_id").distinct().collect()} == {1}


def test_finished_run_is_not_replaced(spark, logs, runs):
    with pytest.raises(ValueError, match="run 1 is already"):
        run(spark, logs, runs[0], run_id=1)
    assert next_run_id(spark, f"{runs[0]}/store") == 3


def test_unfinished_run_is_not_seen(spark, tmp_path):
    store = str(tmp_path / "store")
    valid = clean_logs(tag_batch(lines_frame(spark, [PLAIN])))
    results, this = query_results(valid), Run(4, executed_at=WHEN)
    append_results(store, this, results)  # and then the driver is lost
    assert set(_counts(spark, store).values()) == {0}
    assert next_run_id(spark, store) == 5
    with pytest.raises(ValueError, match="no finished run 4"):
        report(spark, store, 4)
    append_run(spark, store, this.renumbered(4), results, stats_row(spark, 1, 1), runtime_ms=5)
    append_run(spark, store, Run(5, executed_at=WHEN), results, stats_row(spark, 1, 1))
    assert set(_counts(spark, store, 4).values()) == {1}
    assert set(_counts(spark, store).values()) == {2}
    row = read_store(spark, store, "query2_results", 4).first()
    assert (row.pipeline_name, row.executed_at.timestamp()) == ("Spark", WHEN.timestamp())


def _one_line(spark, path):
    return query_results(clean_logs(tag_batch(lines_frame(spark, [PLAIN.replace("/a", path)]))))


def test_two_drivers_with_one_id_do_not_mix(spark, tmp_path):
    store = str(tmp_path / "store")
    stats = stats_row(spark, 1, 1)
    one, two = (Run(next_run_id(spark, store), executed_at=WHEN) for _ in range(2))
    assert one.run_id == two.run_id and one.attempt != two.attempt
    append_results(store, one, _one_line(spark, "/one"))
    append_results(store, two, _one_line(spark, "/two"))
    append_run_rows(store, two, stats, 1)
    with pytest.raises(ValueError, match="run 1 is already"):
        append_run_rows(store, one, stats, 1)
    assert read_store(spark, store, "query2_results").first().resource_path == "/two"
    assert set(_counts(spark, store, 1).values()) == {1}
    # Both at the same moment, after both have looked: the manifest is made once.
    assert not storage.create(spark, manifest_path(store, 1), "{}")
    assert set(_counts(spark, store, 1).values()) == {1}


def test_run_moves_to_a_free_id(spark, logs, tmp_path, monkeypatch):
    """Another driver finishes under the id that this one has taken."""
    import logweir.plans.job as job

    store, write = f"{tmp_path}/store", job.append_results

    def overtaken(store, this, results):
        if this.run_id == 1:
            append_run(spark, store, Run(1), _one_line(spark, "/other"), stats_row(spark, 1, 1))
        write(store, this, results)

    monkeypatch.setattr(job, "append_results", overtaken)
    done = run(spark, logs, str(tmp_path), query="Query3")
    assert done.run.run_id == 2
    assert done.results["Query3"].count() == 762
    assert read_store(spark, store, "query2_results").first().resource_path == "/other"
    assert _counts(spark, store)["runs"] == 2


def test_runs_on_one_output_at_once_do_not_mix(spark, logs, tmp_path, monkeypatch):
    """Another driver runs a batch between this one's write and read of its valid logs."""
    import logweir.plans.job as job

    results, others = job.query_results, []

    def interleaved(valid, *given, **options):
        if not others:
            others.append(None)
            others.append(run(spark, logs, str(tmp_path), query="Query1", batch=2))
        return results(valid, *given, **options)

    monkeypatch.setattr(job, "query_results", interleaved)
    one = run(spark, logs, str(tmp_path), query="Query1", batch=1)
    for done, batch in ((one, 1), (others[1], 2)):
        assert {r.batch_id for r in done.results["Query1"].collect()} == {batch}
        assert {r.batch_id for r in done.valid_logs.collect()} == {batch}
        header = read_store(spark, f"{tmp_path}/store", "runs", done.run.run_id).first()
        assert header.batch_id == batch
    assert one.run.run_id != others[1].run.run_id
    valid = read_current(spark, f"{tmp_path}/valid_logs")
    assert {r.batch_id for r in valid.collect()} == {1}  # the last to finish


def test_versions_of_a_table(spark, tmp_path):
    table = str(tmp_path / "valid_logs")
    with pytest.raises(ValueError, match="no version"):
        read_current(spark, table)
    valid = clean_logs(tag_batch(lines_frame(spark, [PLAIN])))
    for name in ("a", "b", "other driver", "c", "d"):
        valid.write.partitionBy("batch_id").parquet(version_path(table, name))
        if name != "other driver":
            publish(spark, table, name)
            assert current(spark, table).version == name
            assert read_current(spark, table).count() == 1
    assert current(spark, table)[1:] == ("d", ["c"])
    folders = {n for n in storage.names(spark, table) if n.startswith("version-")}
    assert folders == {"version-d", "version-c", "version-other driver"}
    pointers = [n for n in storage.names(spark, table) if n.startswith("current-")]
    assert sorted(pointers) == ["current-3.json", "current-4.json"]


def test_pointer_taken_meanwhile(spark, tmp_path, monkeypatch):
    table, create, taken = str(tmp_path / "t"), storage.create, []

    def overtaken(spark, path, text):
        if not taken:
            taken.append(path)
            assert create(spark, path, text.replace("mine", "other"))
        return create(spark, path, text)

    monkeypatch.setattr(storage, "create", overtaken)
    publish(spark, table, "mine")
    assert current(spark, table) == (2, "mine", ["other"])


@pytest.mark.parametrize("remove", [False, True])
def test_compacted_runs_read_alike(spark, tmp_path, remove, monkeypatch):
    import logweir.sources.tables as tables

    store, stats = str(tmp_path / "store"), stats_row(spark, 2, 1)
    for n in (1, 2, 3):
        results = _one_line(spark, f"/{n}")
        append_run(spark, store, Run(n, executed_at=WHEN), {"Query2": results["Query2"]}, stats)
    append_results(store, Run(7), _one_line(spark, "/dead"))

    def paths(run_id=None):
        return sorted(r.resource_path for r in read_store(spark, store, "query2_results", run_id).collect())

    for runs_so_far in (3, 4):
        before = {t: sorted(read_store(spark, store, t).collect()) for t in STORE_TABLES}
        assert compact_store(spark, store, remove) == runs_so_far
        assert {t: sorted(read_store(spark, store, t).collect()) for t in STORE_TABLES} == before
        assert paths(2) == ["/2"] and _counts(spark, store, 2)["query1_results"] == 0
        assert next_run_id(spark, store) == runs_so_far + 5
        with pytest.raises(ValueError, match="run 2 is already"):
            append_run(spark, store, Run(2), {}, stats)
        new = runs_so_far + 4
        append_run(spark, store, Run(new + 1, executed_at=WHEN), _one_line(spark, f"/{new}"), stats)
        assert f"/{new}" in paths() and paths(new + 1) == [f"/{new}"]
        monkeypatch.setattr(tables, "_FEW", 0)  # manifests read by Spark
        assert f"/{new}" in paths()
        monkeypatch.undo()
    manifests = storage.names(spark, f"{store}/manifest")
    assert ("run-1.json" in manifests) == (not remove)
    assert sum(n.startswith("compacted-") for n in manifests) == (1 if remove else 2)


def test_two_compactions_at_once(spark, tmp_path, monkeypatch):
    import logweir.sinks.runs as runs_module

    store, stats = str(tmp_path / "store"), stats_row(spark, 1, 1)
    append_run(spark, store, Run(1, executed_at=WHEN), _one_line(spark, "/1"), stats)
    create, inside = storage.create, []

    def overtaken(spark, path, text):
        if "compacted-" in path and not inside:
            inside.append(0)
            inside[0] = compact_store(spark, store)
        return create(spark, path, text)

    monkeypatch.setattr(runs_module.storage, "create", overtaken)
    assert compact_store(spark, store) == 1 and inside == [1]
    assert len(storage.names(spark, f"{store}/compacted")) == 1
    assert set(_counts(spark, store, 1).values()) == {1}


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "a" / "b.json")
    assert storage.read(spark, path) is None and storage.names(spark, str(tmp_path / "a")) == []
    assert storage.create(spark, path, "\u00e9") and storage.read(spark, path) == "\u00e9"
    assert not storage.create(spark, path, "other") and storage.read(spark, path) == "\u00e9"
    assert storage.names(spark, str(tmp_path / "a")) == ["b.json"]
    storage.remove(spark, str(tmp_path / "a"))
    storage.remove(spark, str(tmp_path / "a"))
    assert not storage.exists(spark, path)


def test_unknown_run_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no finished run"):
        report(spark, str(tmp_path / "nothing"), 1)


def test_source_is_what_was_read(spark):
    def source(**given):
        return batch_metadata(stats_row(spark, 1, 1), 1, **given).first().source_file

    assert source() == "/input/logs"
    assert source(batch=2) == "/input/logs/NASA_access_log_Aug95"
    assert source(batch=2, input_dir="/x") == "/x [batch 2 by file_name]"
    assert source(batch=1, batch_rule="line") == "/input/logs [batch 1 by line]"
    assert source(input_dir="/x") == "/x"


def test_stats_while_writing_equal_the_query(spark, tmp_path):
    tagged = tag_batch(fixtures.raw_lines(spark, SF))
    for batch in (0, 1, 2):
        for match in ("full", "prefix"):
            path = str(tmp_path / f"{match}{batch}")
            counted = clean_to_table(tagged, path, match, batch).collect()
            assert counted == run_stats(tagged, match, batch).collect()
            wanted = clean_logs(tagged, match, batch).collect()
            assert sorted(read_table(spark, path).collect()) == sorted(wanted)


def test_counting_pass_parses_once(spark, tmp_path, monkeypatch):
    """The counted and the written rows come from one evaluation of the regex."""
    import logweir.plans.job as job

    plans = []
    monkeypatch.setattr(
        job,
        "write_table",
        lambda frame, path, fmt: plans.append(frame) or frame.write.parquet(path),
    )
    clean_to_table(tag_batch(fixtures.raw_lines(spark, SF)), str(tmp_path / "t"))
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") == 1 and "Exchange" not in plan


@pytest.mark.parametrize("lines", [[], ["junk", ""]])
def test_run_without_valid_lines(spark, tmp_path, lines):
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "access_log_Jul95").write_text("".join(f"{x}\n" for x in lines))
    done = run(spark, str(tmp_path / "logs"), str(tmp_path / "out"))
    assert done.valid_logs.isEmpty() and all(r.isEmpty() for r in done.results.values())
    frames = report(spark, f"{tmp_path}/out/store", done.run.run_id)
    summary = frames["malformed"].first()
    assert tuple(summary)[1:] == (len(lines), len(lines), 100.0 if lines else 0.0)
    assert frames["run"].count() == 1 and frames["Query2"].isEmpty()


def test_report(spark, runs):
    frames = report(spark, f"{runs[0]}/store", 1)
    assert list(frames) == ["run", "malformed", "Query1", "Query2", "Query3"]
    assert tuple(frames["malformed"].first()) == (1, 90, 1000, 9.0)
    for name, rate in (("Query1", None), ("Query2", None), ("Query3", "error_percent")):
        shown = frames[name]
        assert shown.count() == 10 and "run_id" not in shown.columns
        if rate:
            full = runs[1].results["Query3"].orderBy("log_date", "log_hour", "batch_id")
            assert [r[rate] for r in shown.collect()] == [
                r.error_rate * 100 for r in full.limit(10).collect()
            ]
    counts = [r.request_count for r in frames["Query2"].collect()]
    assert counts == sorted(counts, reverse=True)
    assert report(spark, f"{runs[0]}/store", 2)["Query1"].isEmpty()


def test_preview_shortens_paths(spark):
    long_path = "/" + "p" * 50
    valid = clean_logs(tag_batch(lines_frame(spark, [PLAIN.replace("/a", long_path)])))
    shown = preview(query_results(valid, "Query2")["Query2"], "Query2").first()
    assert shown.resource_path == long_path[:36] + "..."
    with pytest.raises(ValueError):
        preview(valid, "Query4")


def test_jdbc_gets_the_rows_of_a_run(spark, runs, monkeypatch):
    """Without a database: what is handed to Spark's own writer."""
    from pyspark.sql.readwriter import DataFrameWriter

    calls = []
    monkeypatch.setattr(
        DataFrameWriter,
        "jdbc",
        lambda self, url, table, mode, properties: calls.append(
            (self._df.count(), self._df.rdd.getNumPartitions(), url, table, mode, properties)
        ),
    )
    rows = read_store(spark, f"{runs[0]}/store", "query2_results", 1)
    append_jdbc(rows, "jdbc:x", "query2_results", {"user": "u"}, connections=1)
    assert calls == [(20, 1, "jdbc:x", "query2_results", "append", {"user": "u"})]


def test_jdbc_refuses_speculation():
    class Frame:
        class sparkSession:
            conf = {"spark.speculation": "true"}

    with pytest.raises(RuntimeError, match="speculation"):
        append_jdbc(Frame(), "jdbc:x", "t", {})


def test_command_line_writes_without_a_sort(spark, tmp_path):
    from logweir.__main__ import session

    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    try:
        chosen = session()
        assert int(chosen.conf.get(name)) >= 2
        tagged = tag_batch(fixtures.raw_lines(spark, SF))
        clean_to_table(tagged, str(tmp_path / "sorted-not"))
        spark.conf.set(name, "7")
        assert session().conf.get(name) == "7"
    finally:
        spark.conf.set(name, before)


def test_queries_read_smaller_splits(spark, logs, tmp_path, monkeypatch):
    import logweir.plans.job as job

    name, seen, write = "spark.sql.files.maxPartitionBytes", [], job.append_results
    monkeypatch.setattr(
        job, "append_results", lambda *given: seen.append(spark.conf.get(name)) or write(*given)
    )
    before = spark.conf.get(name)
    spark.conf.set(name, "1g")
    try:
        run(spark, logs, str(tmp_path), query="Query1")
        assert spark.conf.get(name) == "1g"
    finally:
        spark.conf.set(name, before)
    assert seen == [job.TABLE_SPLIT_BYTES]


def test_command_line(spark, logs, tmp_path, monkeypatch, capsys):
    from logweir.__main__ import main

    given = ["--input", logs, "--output", str(tmp_path), "--query", "Query1", "--batch", "1"]
    monkeypatch.setattr("sys.argv", ["logweir", *given])
    main()
    printed = capsys.readouterr().out
    assert "|Query1" in printed and "01/Jul/2024" in printed


def test_bad_query_is_refused_before_any_work(spark, tmp_path):
    with pytest.raises(ValueError):
        run(spark, "/nowhere", str(tmp_path / "out"), query="Query9")
    assert not (tmp_path / "out").exists()


def test_store_tables_cover_the_queries():
    assert set(QUERY_TABLES.values()) < set(STORE_TABLES)
    assert list(STORE_TABLES)[-1] == "runs"

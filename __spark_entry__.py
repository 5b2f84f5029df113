"""

Every query runs over the whole table. The oracles are plain SQL over the columns
that the log lines are made of; they use neither the parser's regex nor any of
this package's code.
"""

from __future__ import annotations

import importlib
import importlib.util
import os
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir import fixtures
from logweir import operators as op
from logweir.functions import coerce_long, normalize_bytes, shorten_path
from logweir.plans import query_results, report, run
from logweir.plans.job import clean_to_table
from logweir.plans.report import malformed_line
from logweir.schemas import (
    DAILY_TRAFFIC,
    HOURLY_ERRORS,
    QUERY_TABLES,
    TOP_RESOURCE,
    VALID_LOGS,
)
from logweir.scratch import scratch_dir
from logweir.sinks import Run, append_run, write_table, write_tsv
from logweir.sinks.runs import append_results
from logweir.sources import read_documents, read_raw_logs, read_store, read_table, read_tsv

FLAGSHIP_DIR = "/root/testdata/sf0.001"
_WHEN = datetime(2024, 9, 1, 12, 0, 0, tzinfo=timezone.utc)
_KEEP = ("event_id",)

Query = Callable[[SparkSession, str], DataFrame]


# Inputs -------------------------------------------------------------------


def _tagged(spark: SparkSession, sf_dir: str, rule: str | int = "file_name") -> DataFrame:
    return op.tag_batch(fixtures.raw_lines(spark, sf_dir), rule)


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean_logs(_tagged(spark, sf_dir))


def _log_files(spark: SparkSession, sf_dir: str, folder: str = "logs") -> str:
    path = f"{scratch_dir(spark)}/{folder}"
    fixtures.write_log_files(fixtures.raw_lines(spark, sf_dir), path)
    return path


def _over_valid(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_valid(spark, sf_dir))


# Scans, parsing, cleaning -------------------------------------------------


def scan_tagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_raw_logs(spark, _log_files(spark, sf_dir))
    return lines.select(F.split_part("file_name", F.lit("-"), F.lit(1)).alias("file_name"), "line")


def batch_tag_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By path, everything below a folder named after August is batch 2."""
    lines = read_raw_logs(spark, _log_files(spark, sf_dir, "Aug-archive"))
    by_path = op.tag_batch(lines, "path").withColumnRenamed("batch_id", "path_batch_id")
    return op.tag_batch(by_path).select("path_batch_id", "batch_id", "line")


def batch_tag_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.tag_batch(fixtures.raw_lines(spark, sf_dir)).select("event_id", "batch_id")


def batch_tag_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the batch their text names, stored and read back."""
    tagged = _tagged(spark, sf_dir, "line").select("event_id", "batch_id", "line")
    path = f"{scratch_dir(spark)}/raw_logs"
    tagged.write.parquet(path)
    return op.clean_logs(spark.read.parquet(path), keep=_KEEP).select("event_id", "batch_id")


def batch_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.daily_traffic(op.clean_logs(_tagged(spark, sf_dir, 2)))


def batch_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = op.tag_batch(read_raw_logs(spark, _log_files(spark, sf_dir)))
    return op.clean_logs(tagged, batch=1)


def parse_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with its fields; those of malformed lines as '' and -1."""
    parsed = op.parse_access_log(_tagged(spark, sf_dir), keep=_KEEP)
    return parsed.na.fill("").na.fill(-1)


def valid_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean_logs(_tagged(spark, sf_dir), keep=_KEEP)


def match_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean_logs(_tagged(spark, sf_dir), match="prefix", keep=_KEEP)


def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.malformed_lines(_tagged(spark, sf_dir), keep=_KEEP).select("event_id", "line")


def bytes_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = fixtures.bytes_texts(spark, sf_dir)
    size = normalize_bytes(F.col("bytes_text"))
    return texts.select("event_id", size.alias("bytes")).where("bytes IS NOT NULL")


def numeric_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = fixtures.bytes_texts(spark, sf_dir)
    return texts.select("event_id", coerce_long(F.col("bytes_text")).alias("bytes"))


# Round trips --------------------------------------------------------------


def tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/valid_logs"
    write_tsv(_valid(spark, sf_dir), path)
    return read_tsv(spark, path, VALID_LOGS, arity="at_least")


def _table_roundtrip(fmt: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{scratch_dir(spark)}/valid_logs"
        write_table(_valid(spark, sf_dir), path, fmt)
        return read_table(spark, path, fmt)

    return query


def _result_roundtrip(name: str, schema) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{scratch_dir(spark)}/{name}"
        write_tsv(query_results(_valid(spark, sf_dir), name)[name], path)
        return read_tsv(spark, path, schema)

    return query


def documents_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily traffic as documents whose numbers are ints, longs and doubles.

    Totals of odd statuses are longs above 2**53, those of even ones doubles.
    """
    path = f"{scratch_dir(spark)}/query1"
    even = F.col("status_code") % 2 == 0
    text = {name: F.col(name).cast("string") for name in DAILY_TRAFFIC.fieldNames()}
    text["log_date"] = F.concat(F.lit('"'), "log_date", F.lit('"'))
    text["request_count"] = F.when(even, F.concat("request_count", F.lit(".75"))).otherwise(
        text["request_count"]
    )
    text["total_bytes"] = F.when(even, F.concat("total_bytes", F.lit(".0e0"))).otherwise(
        (F.col("total_bytes") + 2**53 + 1).cast("string")
    )
    fields = [F.concat(F.lit(f'"{name}": '), value) for name, value in text.items()]
    document = F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))
    daily = op.daily_traffic(_valid(spark, sf_dir), ordered=False)
    daily.select(document.alias("value")).write.text(path)
    return read_documents(spark, path, DAILY_TRAFFIC)


def results_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written over the result of one batch, the result of both is what is left."""
    path = f"{scratch_dir(spark)}/query1"
    tagged = _tagged(spark, sf_dir)
    for batch in (2, 0):
        result = op.daily_traffic(op.clean_logs(tagged, batch=batch), ordered=False)
        write_table(result, path, partition_by=())
    return read_table(spark, path, schema=DAILY_TRAFFIC)


# Statistics, store, report ------------------------------------------------


def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.run_stats(_tagged(spark, sf_dir))


def run_stats_one_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.run_stats(_tagged(spark, sf_dir), batch=2)


def run_stats_while_writing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_to_table(_tagged(spark, sf_dir), f"{scratch_dir(spark)}/valid_logs")


def batch_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    one, both = _tagged(spark, sf_dir), _tagged(spark, sf_dir)
    return op.batch_metadata(op.run_stats(one, batch=1), run_id=1, batch=1).unionByName(
        op.batch_metadata(op.run_stats(both), run_id=2)
    )


def malformed_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.malformed_summary(op.run_stats(_tagged(spark, sf_dir)), run_id=1)


def _two_runs(spark: SparkSession, sf_dir: str) -> str:
    """A store with run 1, where fields may follow the byte count, and run 2."""
    store = f"{scratch_dir(spark)}/store"
    tagged = _tagged(spark, sf_dir)
    for run_id, match in ((1, "prefix"), (2, "full")):
        table = f"{store}-valid-{run_id}"
        stats = clean_to_table(tagged, table, match=match)
        results = query_results(read_table(spark, table), ordered=False)
        this = Run(run_id, executed_at=_WHEN)
        append_run(spark, store, this, results, stats, runtime_ms=0)
    return store


def _results_append(query: str) -> Query:
    def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
        stored = read_store(spark, _two_runs(spark, sf_dir), QUERY_TABLES[query])
        return stored.drop("executed_at")

    return rows


def results_after_dead_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of each run are seen after one that died before its record.

    The dead run had all results under id 1; the next, one query of one batch,
    gets another id, and so does not show them.
    """
    output = scratch_dir(spark)
    dead = query_results(_valid(spark, sf_dir), ordered=False)
    append_results(f"{output}/store", Run(1, executed_at=_WHEN), dead)
    done = run(spark, _log_files(spark, sf_dir), output, query="Query3", batch=2)
    seen = [
        read_store(spark, f"{output}/store", table).select("run_id", F.lit(query).alias("query"))
        for query, table in QUERY_TABLES.items()
    ]
    rows = seen[0].unionAll(seen[1]).unionAll(seen[2])
    counts = rows.groupBy("run_id", "query").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("given_id", F.lit(done.run.run_id).cast("bigint"))


def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two runs say of their input, read back from the store."""
    output, files = scratch_dir(spark), _log_files(spark, sf_dir)
    for batch in (0, 2):
        run(spark, files, output, query="Query1", batch=batch)
    rows = read_store(spark, f"{output}/store", "batch_metadata")
    name = F.regexp_replace("source_file", "^.*/", "")
    return rows.withColumn("source_file", name)


def hosts_over_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts of each resource over two runs, one a batch: sketches merged, and counted.

    The estimate is compared here, since only the exact count is the same in any engine.
    """
    output, files = scratch_dir(spark), _log_files(spark, sf_dir)
    for batch in (1, 2):
        last = run(spark, files, output, query="Query1", batch=batch, sketches=True)
    sketches = read_store(spark, f"{output}/store", "resource_host_sketches")
    estimates = op.sketched_hosts(sketches, "resource_path")
    exact = (
        _valid(spark, sf_dir).groupBy("resource_path").agg(F.count_distinct("host").alias("hosts"))
    )
    near = F.abs(F.col("host_estimate") - F.col("hosts")) <= F.greatest(F.lit(1), F.col("hosts") * 0.06)
    both = exact.join(estimates, "resource_path", "full")
    return both.select("resource_path", "hosts", near.alias("estimate_is_near")).withColumn(
        "run_id", F.lit(last.run.run_id).cast("bigint")
    )


def _beyond_long(operator: Callable[[DataFrame], DataFrame]) -> Query:
    """Over lines of which some claim the greatest long; totals as text."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        valid = op.clean_logs(op.tag_batch(fixtures.raw_lines(spark, sf_dir, huge=True)))
        return _text_totals(operator(valid))

    return query


def _text_totals(frame: DataFrame) -> DataFrame:
    return frame.withColumn("total_bytes", F.col("total_bytes").cast("string"))


def totals_beyond_long_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/query1"
    valid = op.clean_logs(op.tag_batch(fixtures.raw_lines(spark, sf_dir, huge=True)))
    write_tsv(op.daily_traffic(valid, ordered=False), path)
    return _text_totals(read_tsv(spark, path, DAILY_TRAFFIC))


def report_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run 2's header with its malformed line, from a store of two runs of both batches."""
    store = _two_runs(spark, sf_dir)
    header = report(spark, store, 2)["run"].drop("executed_at", "runtime_ms")
    return header.join(malformed_line(spark, store, 2), "run_id")


def _preview(name: str) -> Query:
    return lambda spark, sf_dir: report(spark, _two_runs(spark, sf_dir), 2)[name]


def path_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    long_path = F.concat(F.lit("/"), "host", "resource_path")
    return valid_logs(spark, sf_dir).select("event_id", shorten_path(long_path).alias("path"))


def run_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job, from files to the store, with all results as one frame."""
    output = scratch_dir(spark)
    done = run(spark, _log_files(spark, sf_dir), output)
    no, zero = F.lit(0).cast("bigint"), F.lit(0)

    def rows(frame, result, batch, item, detail, requests, size, errors, hosts):
        return frame.select(
            F.lit(result).alias("result"),
            batch.alias("batch_id"),
            item.alias("item"),
            detail.alias("detail"),
            requests.alias("requests"),
            size.alias("bytes"),
            errors.alias("errors"),
            hosts.alias("hosts"),
        )

    c = F.col
    day, resource, hour = (done.results[q] for q in ("Query1", "Query2", "Query3"))
    requests, size, batch = c("request_count"), c("total_bytes"), c("batch_id")
    path_hosts, error_hosts = c("distinct_host_count"), c("distinct_error_hosts")
    errors, total = c("error_request_count"), c("total_request_count")
    parts = [
        rows(day, "Query1", batch, c("log_date"), c("status_code"), requests, size, no, no),
        rows(resource, "Query2", batch, c("resource_path"), zero, requests, size, no, path_hosts),
        rows(hour, "Query3", batch, c("log_date"), c("log_hour"), total, no, errors, error_hosts),
        rows(
            done.stats, "stats", zero, F.lit("lines"), zero, c("total_records"), no,
            c("malformed_records"), no,
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def run_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job for one query of one batch."""
    files = _log_files(spark, sf_dir)
    return run(spark, files, scratch_dir(spark), query="Query3", batch=2).results["Query3"]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: hourly errors from raw lines."""
    return op.hourly_errors(_valid(spark, FLAGSHIP_DIR))


# Text preparation ---------------------------------------------------------


def _on_workers(query: Query) -> Query:
    """Lets Python workers import from this folder, wherever the driver was started."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        here = os.path.dirname(os.path.abspath(__file__))
        spark.sparkContext.environment.setdefault("PYTHONPATH", here)
        return query(spark, sf_dir)

    return run


def _text_module(name: str):
    """A module that may have been left out of this installation."""
    try:
        return importlib.import_module(name) if importlib.util.find_spec(name) else None
    except ModuleNotFoundError as error:
        if error.name and error.name.startswith("logweir.llm"):
            return None
        raise


def text_queries() -> dict[str, Query]:
    """Queries of the text operators and their pipeline, where those are installed."""
    found: dict[str, Query] = {}
    if operators := _text_module("logweir.llm.queries"):
        found |= operators.queries()
    if pipeline := _text_module("corpus_pipeline"):
        found["pipeline"] = pipeline.run
    return {name: _on_workers(query) for name, query in found.items()}


def text_oracle_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    if operators := _text_module("logweir.llm.queries"):
        found |= operators.oracle_sql()
    if (pipeline := _text_module("corpus_pipeline")) and pipeline.ORACLE_SQL:
        found["pipeline"] = pipeline.ORACLE_SQL
    return found


def queries() -> dict[str, Query]:
    return log_queries() | text_queries()


def oracle_sql() -> dict[str, str]:
    return log_oracle_sql() | text_oracle_sql()


def _as_longs(query: Query) -> Query:
    """Exact totals as longs, where they fit; an error where not."""

    def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = query(spark, sf_dir)
        exact = [name for name, kind in frame.dtypes if kind == "decimal(38,0)"]
        return frame.withColumns({name: F.col(name).cast("bigint") for name in exact})

    return run_query


def log_queries() -> dict[str, Query]:
    return {name: _as_longs(query) for name, query in _log_queries().items()}


def _log_queries() -> dict[str, Query]:
    return {
        "scan_tagged_lines": scan_tagged_lines,
        "batch_tag_file": batch_tag_file,
        "batch_tag_path": batch_tag_path,
        "batch_tag_line": batch_tag_line,
        "batch_fixed": batch_fixed,
        "batch_select": batch_select,
        "parse_fields": parse_fields,
        "valid_logs": valid_logs,
        "match_prefix": match_prefix,
        "malformed_lines": malformed_lines,
        "bytes_normalize": bytes_normalize,
        "numeric_coerce": numeric_coerce,
        "error_logs": lambda s, d: op.error_logs(valid_logs(s, d)),
        "q1_daily_traffic": _over_valid(op.daily_traffic),
        "resource_traffic": _over_valid(op.resource_traffic),
        "distinct_hosts_collect_set": _over_valid(op.distinct_hosts),
        "q2_top_resources": _over_valid(op.top_resources),
        "q2_top_resources_rescan": _over_valid(lambda v: op.top_resources(v, rescan=True)),
        "q2_top_resources_pruned": _over_valid(
            lambda v: op.top_resources(v, rescan=True, prune=True)
        ),
        "q2_top_resources_batch_tie": _over_valid(lambda v: op.top_resources(v, tie="batch")),
        "q2_top_resources_large_k": _over_valid(
            lambda v: op.top_resources(v, k=1_000_000, rescan=True)
        ),
        "hosts_over_runs": hosts_over_runs,
        "totals_beyond_long_daily": _beyond_long(op.daily_traffic),
        "totals_beyond_long_resources": _beyond_long(op.resource_traffic),
        "totals_beyond_long_tsv": totals_beyond_long_tsv,
        "q3_hourly_errors": _over_valid(op.hourly_errors),
        "q3_hourly_errors_join": _over_valid(op.hourly_errors_by_join),
        "q3_three_way_join": _over_valid(op.hourly_errors_by_two_joins),
        "hourly_totals": _over_valid(op.hourly_totals),
        "error_counts": _over_valid(op.error_counts),
        "distinct_error_host_rows": _over_valid(op.distinct_error_host_rows),
        "distinct_error_hosts": _over_valid(op.distinct_error_hosts),
        "run_stats": run_stats,
        "run_stats_one_batch": run_stats_one_batch,
        "run_stats_while_writing": run_stats_while_writing,
        "batch_metadata": batch_metadata,
        "malformed_summary": malformed_summary,
        "tsv_roundtrip": tsv_roundtrip,
        "orc_roundtrip": _table_roundtrip("orc"),
        "parquet_roundtrip": _table_roundtrip("parquet"),
        "results_tsv_load": _result_roundtrip("Query1", DAILY_TRAFFIC),
        "results_tsv_load_resources": _result_roundtrip("Query2", TOP_RESOURCE),
        "results_tsv_load_errors": _result_roundtrip("Query3", HOURLY_ERRORS),
        "documents_load": documents_load,
        "results_overwrite": results_overwrite,
        "results_append": _results_append("Query1"),
        "results_append_resources": _results_append("Query2"),
        "results_append_errors": _results_append("Query3"),
        "results_after_dead_run": results_after_dead_run,
        "run_metadata": run_metadata,
        "report_run": report_run,
        "report_q1": _preview("Query1"),
        "report_q2": _preview("Query2"),
        "report_q3": _preview("Query3"),
        "path_truncate": path_truncate,
        "run_all": run_all,
        "run_one": run_one,
    }


# Oracles ------------------------------------------------------------------

_FIELDS = (
    "batch_id, host, log_date, log_hour, method, resource_path, protocol, status_code, bytes"
)
_ERROR = "status_code BETWEEN 400 AND 599"
_FILE_BATCH = "CASE WHEN file_name LIKE '%Aug%' THEN 2 ELSE 1 END"


def _q1(source: str = "v") -> str:
    return f"""SELECT batch_id, log_date, status_code, count(*) AS request_count,
 CAST(sum(bytes) AS BIGINT) AS total_bytes FROM {source} GROUP BY batch_id, log_date, status_code"""


def _q2(source: str = "v") -> str:
    return f"""SELECT batch_id, resource_path, count(*) AS request_count,
 CAST(sum(bytes) AS BIGINT) AS total_bytes, count(DISTINCT host) AS distinct_host_count
 FROM {source} GROUP BY batch_id, resource_path"""


def _q3(source: str = "v") -> str:
    return f"""SELECT batch_id, log_date, log_hour,
 count(*) FILTER (WHERE {_ERROR}) AS error_request_count, count(*) AS total_request_count,
 CAST(count(*) FILTER (WHERE {_ERROR}) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS error_rate,
 count(DISTINCT host) FILTER (WHERE {_ERROR}) AS distinct_error_hosts
 FROM {source} GROUP BY batch_id, log_date, log_hour"""


def _top(source: str) -> str:
    return f"{_q2(source)} ORDER BY request_count DESC, resource_path, batch_id LIMIT 20"


def _both_runs(first: str, second: str) -> str:
    return f"""SELECT CAST(1 AS BIGINT) AS run_id, 'Spark' AS pipeline_name, *
 FROM ({first}) UNION ALL SELECT CAST(2 AS BIGINT), 'Spark', * FROM ({second})"""


_HUGE_Q1 = f"""SELECT * REPLACE (CAST(total_bytes AS VARCHAR) AS total_bytes)
 FROM ({_q1().replace("CAST(sum(bytes) AS BIGINT)", "sum(bytes)")})"""
_TOP = f"{_q2()} ORDER BY request_count DESC, resource_path, batch_id LIMIT 20"
_TOP_BATCH_TIE = f"{_q2()} ORDER BY request_count DESC, batch_id, resource_path LIMIT 20"
_COUNTS = """(SELECT (SELECT count(*) FROM raw) AS t, (SELECT count(*) FROM v) AS ok)"""
_COUNTS_OF = """(SELECT (SELECT count(*) FROM raw WHERE {file}) AS t,
 (SELECT count(*) FROM v WHERE batch_id = {batch}) AS ok)"""
_COUNTS_1 = _COUNTS_OF.format(file="file_name NOT LIKE '%Aug%'", batch=1)
_COUNTS_2 = _COUNTS_OF.format(file="file_name LIKE '%Aug%'", batch=2)


def _stats(counts: str, batches: int) -> str:
    return f"""SELECT t AS total_records, t - ok AS malformed_records,
 CAST({batches} AS INT) AS total_batches,
 CAST(t AS DOUBLE) / CAST({batches} AS DOUBLE) AS avg_batch_size FROM {counts}"""


_PCT = "CAST(100 AS DOUBLE) * (t - ok) / t"


def log_oracle_sql() -> dict[str, str]:
    bodies = {
        "scan_tagged_lines": "SELECT file_name, line FROM raw",
        "batch_tag_file": f"SELECT event_id, {_FILE_BATCH} AS batch_id FROM raw",
        "batch_tag_path": f"""SELECT CAST(2 AS INT) AS path_batch_id, {_FILE_BATCH} AS batch_id,
 line FROM raw""",
        "batch_tag_line": """SELECT event_id, CASE WHEN log_date LIKE '%/Aug/%'
 OR resource_path LIKE '%/Aug/%' THEN 2 ELSE 1 END AS batch_id FROM v""",
        "batch_fixed": _q1("(SELECT * REPLACE (CAST(2 AS INT) AS batch_id) FROM v)"),
        "batch_select": f"SELECT {_FIELDS} FROM v WHERE batch_id = 1",
        "parse_fields": f"""SELECT r.event_id, {_FILE_BATCH} AS batch_id, r.line,
 v.event_id IS NOT NULL AS is_valid, coalesce(v.host, '') AS host,
 coalesce(v.log_date, '') AS log_date, coalesce(v.log_hour, -1) AS log_hour,
 coalesce(v.method, '') AS method, coalesce(v.resource_path, '') AS resource_path,
 coalesce(v.protocol, '') AS protocol, coalesce(v.status_code, -1) AS status_code,
 coalesce(v.bytes, -1) AS bytes FROM raw r LEFT JOIN v ON r.event_id = v.event_id""",
        "valid_logs": f"SELECT event_id, {_FIELDS} FROM v",
        "match_prefix": f"SELECT event_id, {_FIELDS} FROM v",
        "malformed_lines": """SELECT event_id, line FROM raw
 WHERE event_id % 50 IN (7, 13, 21, 33) OR event_id % 100 = 47""",
        "bytes_normalize": """SELECT event_id, CASE WHEN regexp_full_match(bytes_text, '[0-9]+')
 THEN try_cast(bytes_text AS BIGINT) ELSE CAST(0 AS BIGINT) END AS bytes
 FROM base WHERE event_id % 100 <> 47""",
        "numeric_coerce": """SELECT event_id,
 coalesce(try_cast(bytes_text AS BIGINT), CAST(0 AS BIGINT)) AS bytes FROM base""",
        "error_logs": f"SELECT event_id, {_FIELDS} FROM v WHERE {_ERROR}",
        "q1_daily_traffic": _q1(),
        "resource_traffic": _q2(),
        "distinct_hosts_collect_set": """SELECT batch_id, resource_path,
 count(DISTINCT host) AS distinct_host_count FROM v GROUP BY batch_id, resource_path""",
        "q2_top_resources": _TOP,
        "q2_top_resources_rescan": _TOP,
        "q2_top_resources_pruned": _TOP,
        "q2_top_resources_batch_tie": _TOP_BATCH_TIE,
        "q3_hourly_errors": _q3(),
        "q3_hourly_errors_join": _q3(),
        "q3_three_way_join": _q3(),
        "hourly_totals": """SELECT batch_id, log_date, log_hour, count(*) AS total_request_count
 FROM v GROUP BY batch_id, log_date, log_hour""",
        "error_counts": f"""SELECT batch_id, log_date, log_hour, count(*) AS error_request_count
 FROM v WHERE {_ERROR} GROUP BY batch_id, log_date, log_hour""",
        "distinct_error_host_rows": f"""SELECT DISTINCT batch_id, log_date, log_hour, host
 FROM v WHERE {_ERROR}""",
        "distinct_error_hosts": f"""SELECT batch_id, log_date, log_hour,
 count(DISTINCT host) AS distinct_error_hosts
 FROM v WHERE {_ERROR} GROUP BY batch_id, log_date, log_hour""",
        "run_stats": _stats(_COUNTS, 2),
        "run_stats_one_batch": _stats(_COUNTS_2, 1),
        "run_stats_while_writing": _stats(_COUNTS, 2),
        "batch_metadata": f"""SELECT CAST(1 AS BIGINT) AS run_id, CAST(1 AS INT) AS batch_id,
 'July 1995' AS batch_label, '/input/logs/NASA_access_log_Jul95' AS source_file,
 t AS record_count FROM {_COUNTS_1}
 UNION ALL SELECT CAST(2 AS BIGINT), CAST(0 AS INT), 'Combined', '/input/logs', t FROM {_COUNTS}""",
        "malformed_summary": f"""SELECT CAST(1 AS BIGINT) AS run_id, CAST(0 AS INT) AS batch_id,
 t - ok AS malformed_count, t AS total_count, {_PCT} AS malformed_pct FROM {_COUNTS}""",
        "tsv_roundtrip": f"SELECT {_FIELDS} FROM v",
        "orc_roundtrip": f"SELECT {_FIELDS} FROM v",
        "parquet_roundtrip": f"SELECT {_FIELDS} FROM v",
        "results_tsv_load": _q1(),
        "results_tsv_load_resources": _TOP,
        "results_tsv_load_errors": _q3(),
        "documents_load": f"""SELECT batch_id, log_date, status_code, request_count,
 CASE WHEN status_code % 2 = 0 THEN total_bytes ELSE total_bytes + 9007199254740993 END
 AS total_bytes FROM ({_q1()})""",
        "results_overwrite": _q1(),
        "results_append": _both_runs(_q1("v_prefix"), _q1()),
        "results_append_resources": _both_runs(f"({_top('v_prefix')})", f"({_top('v')})"),
        "results_append_errors": _both_runs(_q3("v_prefix"), _q3()),
        "results_after_dead_run": f"""SELECT CAST(2 AS BIGINT) AS run_id, 'Query3' AS query,
 count(*) AS n_rows, CAST(2 AS BIGINT) AS given_id
 FROM ({_q3("(SELECT * FROM v WHERE batch_id = 2)")})""",
        "hosts_over_runs": """SELECT resource_path, count(DISTINCT host) AS hosts,
 true AS estimate_is_near, CAST(2 AS BIGINT) AS run_id FROM v GROUP BY resource_path""",
        "run_metadata": f"""SELECT CAST(1 AS BIGINT) AS run_id, CAST(0 AS INT) AS batch_id,
 'Combined' AS batch_label, 'logs' AS source_file, t AS record_count FROM {_COUNTS}
 UNION ALL SELECT CAST(2 AS BIGINT), CAST(2 AS INT), 'August 1995',
 'logs [batch 2 by file_name]', t FROM {_COUNTS_2}""",
        "q2_top_resources_large_k": _q2(),
        "totals_beyond_long_daily": _HUGE_Q1,
        "totals_beyond_long_tsv": _HUGE_Q1,
        "totals_beyond_long_resources": f"""SELECT * REPLACE (CAST(total_bytes AS VARCHAR)
 AS total_bytes) FROM ({_q2().replace("CAST(sum(bytes) AS BIGINT)", "sum(bytes)")})""",
        "report_run": f"""SELECT CAST(2 AS BIGINT) AS run_id, 'Spark' AS pipeline_name,
 'All' AS query_name, CAST(0 AS INT) AS batch_id, CAST(0 AS INT) AS batch_size,
 CAST(t AS DOUBLE) / 2 AS avg_batch_size, t AS records_processed,
 t - ok AS malformed_record_count, t - ok AS malformed_count, t AS total_count,
 {_PCT} AS malformed_pct FROM {_COUNTS}""",
        "report_q1": f"""SELECT log_date, status_code, request_count, total_bytes
 FROM ({_q1()}) ORDER BY log_date, status_code, batch_id LIMIT 10""",
        "report_q2": f"""SELECT resource_path, request_count, total_bytes, distinct_host_count
 FROM ({_q2()}) ORDER BY request_count DESC, resource_path, batch_id LIMIT 10""",
        "report_q3": f"""SELECT log_date, log_hour, error_request_count, total_request_count,
 error_rate * CAST(100 AS DOUBLE) AS error_percent, distinct_error_hosts
 FROM ({_q3()}) ORDER BY log_date, log_hour, batch_id LIMIT 10""",
        "path_truncate": """SELECT event_id, CASE WHEN length('/' || host || resource_path) > 39
 THEN substr('/' || host || resource_path, 1, 36) || '...'
 ELSE '/' || host || resource_path END AS path FROM v""",
        "run_one": _q3("(SELECT * FROM v WHERE batch_id = 2)"),
        "run_all": f"""SELECT 'Query1' AS result, batch_id, log_date AS item,
 status_code AS detail, request_count AS requests, total_bytes AS bytes,
 CAST(0 AS BIGINT) AS errors, CAST(0 AS BIGINT) AS hosts FROM ({_q1()})
 UNION ALL SELECT 'Query2', batch_id, resource_path, CAST(0 AS INT), request_count, total_bytes,
 CAST(0 AS BIGINT), distinct_host_count FROM ({_TOP})
 UNION ALL SELECT 'Query3', batch_id, log_date, log_hour, total_request_count, CAST(0 AS BIGINT),
 error_request_count, distinct_error_hosts FROM ({_q3()})
 UNION ALL SELECT 'stats', CAST(0 AS INT), 'lines', CAST(0 AS INT), t, CAST(0 AS BIGINT), t - ok,
 CAST(0 AS BIGINT) FROM {_COUNTS}""",
    }
    return {
        key: fixtures.oracle(
            body,
            "prefix" if key == "match_prefix" else "full",
            huge=key.startswith("totals_beyond_long"),
        )
        for key, body in bodies.items()
    }

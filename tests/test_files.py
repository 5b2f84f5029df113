import gzip
from collections import Counter
from decimal import Decimal

import pytest
from helpers import PLAIN, lines_frame, parse

from logweir.operators import clean_logs, daily_traffic, select_batch, tag_batch
from logweir.schemas import DAILY_TRAFFIC, TOP_RESOURCE, VALID_LOGS
from logweir.scratch import remove_scratch, scratch_dir
from logweir.sinks import write_table, write_tsv
from logweir.sources import coerce_numbers, read_documents, read_raw_logs, read_table, read_tsv

AUGUST = PLAIN.replace("Jul", "Aug")


def _files(folder, **contents):
    folder.mkdir(exist_ok=True)
    for name, data in contents.items():
        (folder / name).write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(folder)


def test_scan_names_and_line_ends(spark, tmp_path):
    path = _files(
        tmp_path / "logs",
        access_log_Jul95="a\nb\r\nc\rd\n\n\ne",
        access_log_Aug95="f\n",
        empty_log="",
        _hidden="x\n",
    )
    rows = read_raw_logs(spark, path).collect()
    assert sorted((r.file_name, r.line) for r in rows) == [
        ("access_log_Aug95", "f"),
        *[("access_log_Jul95", text) for text in ["", "", "a", "b", "c", "d", "e"]],
    ]
    assert all(r.file_path.endswith("/logs/" + r.file_name) for r in rows)


def test_scan_of_several_paths_and_invalid_utf8(spark, tmp_path):
    bad = PLAIN.encode().replace(b"h - -", b"\xffh - -")
    one = _files(tmp_path / "one", access_log_Jul95=bad + b"\n")
    two = _files(tmp_path / "two", access_log_Aug95=AUGUST)
    got = clean_logs(tag_batch(read_raw_logs(spark, [one, two]))).collect()
    assert {(r.batch_id, r.host) for r in got} == {(1, "�h"), (2, "h")}


def test_gzip_is_spread(spark, tmp_path):
    packed = gzip.compress("\n".join([PLAIN] * 500).encode())
    path = _files(tmp_path / "logs", **{"access_log_Aug95.gz": packed})
    lines = read_raw_logs(spark, path, partitions=6)
    assert lines.rdd.getNumPartitions() == 6
    valid = clean_logs(tag_batch(lines))
    assert (valid.count(), valid.first().batch_id) == (500, 2)


def test_path_rule_sees_directories(spark, tmp_path):
    path = _files(tmp_path / "Augdir", access_log_Jul95=PLAIN)
    lines = read_raw_logs(spark, path)
    assert clean_logs(tag_batch(lines)).first().batch_id == 1
    assert clean_logs(tag_batch(lines, "path")).first().batch_id == 2


def test_batch_selection_opens_only_its_files(spark, tmp_path):
    path = _files(tmp_path / "logs", access_log_Jul95=PLAIN, access_log_Aug95=AUGUST)
    chosen = select_batch(tag_batch(read_raw_logs(spark, path)), 2)
    plan = chosen._jdf.queryExecution().executedPlan()
    assert plan.execute().count() == 1
    assert plan.collectLeaves().head().metrics().apply("numFiles").value() == 1


def _odd_logs(spark):
    paths = ['"q"', "\\", "#x", "'", "a,b", "a\u0001b", "a b", "/é", "NULL", "\\N", '""']
    lines = [PLAIN.replace("/a", p) for p in paths]
    frame = clean_logs(tag_batch(lines_frame(spark, lines)))
    return frame, sorted((1, *parse(line)) for line in lines)


def test_tsv_round_trip_is_exact(spark, tmp_path):
    frame, rows = _odd_logs(spark)
    path = str(tmp_path / "tsv")
    for _ in range(2):  # the second write replaces the first
        write_tsv(frame, path)
    assert sorted(map(tuple, read_tsv(spark, path, VALID_LOGS).collect())) == rows


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_table_round_trip_is_exact(spark, tmp_path, fmt):
    frame, rows = _odd_logs(spark)
    path = str(tmp_path / fmt)
    for _ in range(2):
        write_table(frame, path, fmt)
    back = read_table(spark, path, fmt)
    assert back.columns == VALID_LOGS.names
    assert sorted(map(tuple, back.collect())) == rows


def test_tsv_writes_null_as_empty(spark, tmp_path):
    path = str(tmp_path / "nulls")
    rows = [(1, None, 3, None, 0.5), (None, "", 2, "x", None)]
    frame = spark.createDataFrame(rows, "a int, b string, c int, d string, e double")
    write_tsv(frame, path)
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert lines == ["\t\t2\tx\t", "1\t\t3\t\t0.5"]


def test_tsv_arity_blank_lines_and_numbers(spark, tmp_path):
    good, blank = "1\td\t200\t5\t7", ["", "   ", "\t\t\t\t"]
    rows = [good, "1\td\t200\t5", good + "\t9", *blank, "1\td\t\t\t"]
    path = _files(tmp_path / "rows", part="\n".join(rows[:-1]))
    exact = [tuple(r) for r in read_tsv(spark, path, DAILY_TRAFFIC).collect()]
    assert exact == [(1, "d", 200, 5, 7)]
    at_least = read_tsv(spark, path, DAILY_TRAFFIC, arity="at_least").collect()
    assert [tuple(r) for r in at_least] == [(1, "d", 200, 5, 7)] * 2

    bad = _files(tmp_path / "bad", part=rows[-1])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_tsv(spark, bad, DAILY_TRAFFIC, empty="error").collect()
    assert tuple(read_tsv(spark, bad, DAILY_TRAFFIC).first()) == (1, "d", None, None, None)
    words = _files(tmp_path / "words", part="1\td\t200\tx\t7")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_tsv(spark, words, DAILY_TRAFFIC).collect()
    lenient = read_tsv(spark, bad, DAILY_TRAFFIC, numbers="lenient").first()
    assert tuple(lenient) == (1, "d", 0, 0, 0)
    with pytest.raises(ValueError):
        read_tsv(spark, bad, DAILY_TRAFFIC, arity="some")
    with pytest.raises(ValueError):
        read_tsv(spark, bad, DAILY_TRAFFIC, numbers="some")


def test_documents_take_any_number(spark):
    documents = spark.createDataFrame(
        [(1, "/a", 2.9, "5"), (2, "/b", None, "x")],
        "batch_id int, resource_path string, request_count double, total_bytes string",
    )
    got = coerce_numbers(documents, TOP_RESOURCE)
    assert [f.dataType for f in got.schema] == [f.dataType for f in TOP_RESOURCE]
    assert [tuple(r) for r in got.collect()] == [(1, "/a", 2, 0, 0), (2, "/b", 0, 0, 0)]


def test_tsv_reads_its_own_nulls(spark, tmp_path):
    rows = [(1, "d", 200, 3, None), (1, "d", None, None, 2**70)]
    frame = spark.createDataFrame(
        [(b, d, s, n, None if t is None else Decimal(t)) for b, d, s, n, t in rows], DAILY_TRAFFIC
    )
    write_tsv(frame, str(tmp_path / "t"))
    back = read_tsv(spark, str(tmp_path / "t"), DAILY_TRAFFIC)
    assert Counter(map(tuple, back.collect())) == Counter(rows)


DOCUMENTS = {
    # text of the count and of the total: what they are read as
    ("5", "7"): (5, 7),
    ("5.9", "7.9"): (5, 7),
    ("-5.9", "-7.9"): (-5, -7),
    ("9007199254740993", "9007199254740993"): (2**53 + 1, 2**53 + 1),
    ("9007199254740993.5", "9223372036854775808"): (2**53 + 1, 2**63),
    ("9223372036854775807", "9223372036854775807"): (2**63 - 1, 2**63 - 1),
    ("9223372036854775808", "18446744073709551614"): (2**63 - 1, 2**64 - 2),
    ("-9223372036854775809", "1e3"): (-(2**63), 1000),
    ("1e300", "1e300"): (2**63 - 1, 0),
    ("-1e300", "0.1e1"): (-(2**63), 1),
    ("2.5e0", "2.5e0"): (2, 2),
    ("99999999999999999999999999999999999999.5", "1"): (2**63 - 1, 1),
    ('"5"', '"x"'): (0, 0),
    ("null", "true"): (0, 0),
    ("[1]", '{"a": 1}'): (0, 0),
}


def test_documents_are_read_exactly(spark, tmp_path):
    lines, wanted = [], []
    for i, ((count, total), (n, t)) in enumerate(DOCUMENTS.items()):
        lines.append(
            f'{{"batch_id": {i}, "log_date": "d\\"{i}", "status_code": 4294967296, '
            f'"request_count": {count}, "total_bytes": {total}}}'
        )
        wanted.append((i, f'd"{i}', 2**31 - 1, n, t))
    path = _files(tmp_path / "documents", part="\n".join([*lines, '{"batch_id": 99}', "junk"]))
    got = sorted(map(tuple, read_documents(spark, path, DAILY_TRAFFIC).collect()), key=str)
    wanted += [(99, None, 0, 0, 0), (0, None, 0, 0, 0)]
    assert got == sorted(wanted, key=str)
    frame = read_documents(spark, path, DAILY_TRAFFIC)
    assert [f.dataType for f in frame.schema] == [f.dataType for f in DAILY_TRAFFIC]


def test_loose_columns_never_overflow(spark):
    schema = "batch_id bigint, log_date string, status_code double, request_count float, total_bytes decimal(38,2)"
    rows = [
        (2**40, "a", 1e30, 2.9, Decimal("12345678901234567890.99")),
        (-(2**40), "b", float("nan"), float("inf"), Decimal("-1.99")),
        (None, None, -1e30, float("-inf"), None),
    ]
    got = coerce_numbers(spark.createDataFrame(rows, schema), DAILY_TRAFFIC).collect()
    assert [tuple(r) for r in got] == [
        (2**31 - 1, "a", 2**31 - 1, 2, 12345678901234567890),
        (-(2**31), "b", 0, 2**63 - 1, -1),
        (0, None, -(2**31), -(2**63), 0),
    ]


def test_empty_directory(spark, tmp_path):
    tagged = tag_batch(read_raw_logs(spark, _files(tmp_path / "none")))
    assert daily_traffic(clean_logs(tagged)).isEmpty()


class _Session:
    def __init__(self, **settings):
        self.conf = {key.replace("_", "."): value for key, value in settings.items()}


def test_scratch_dir():
    shared = _Session(spark_master="yarn", spark_checkpoint_dir="hdfs:///shared/")
    assert scratch_dir(shared).startswith("hdfs:///shared/logweir-")
    assert scratch_dir(shared) != scratch_dir(shared)
    local = _Session(spark_master="local[2]")
    assert scratch_dir(local) != scratch_dir(local)
    assert scratch_dir(local).startswith("/tmp/logweir/logweir-")
    with pytest.raises(RuntimeError):
        scratch_dir(_Session(spark_master="yarn"))


def test_scratch_is_removed(spark, tmp_path):
    shared = _Session(spark_master="yarn", spark_checkpoint_dir=f"file://{tmp_path}")
    path = scratch_dir(shared)
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    assert remove_scratch(path) and not any(tmp_path.iterdir())
    assert not remove_scratch("hdfs:///shared/logweir-1") and not remove_scratch("/home")

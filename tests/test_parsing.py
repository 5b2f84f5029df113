import re

import pytest
from helpers import PLAIN, lines_frame, parse
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logweir.functions import (
    coerce_double,
    coerce_long,
    error_rate,
    is_error,
    normalize_bytes,
    percentage,
    shorten_path,
    truncate,
)
from logweir.operators import clean_logs, malformed_lines, parse_access_log, select_batch, tag_batch
from logweir.schemas import VALID_LOGS

LATE = PLAIN.replace("6245", "6245 tail")
EDGES = [
    PLAIN,
    PLAIN.replace("h - -", "h - bob"),
    PLAIN.replace("/a", "/a b"),
    PLAIN.replace("/a", '"/a"'),
    PLAIN.replace("/a", "\\a\\"),
    PLAIN.replace("/a", "#a"),
    PLAIN.replace("/a", "/$1\\2"),
    PLAIN.replace("6245", "-"),
    PLAIN.replace("6245", "12x"),
    PLAIN.replace("6245", "9" * 20),
    PLAIN.replace("6245", str(2**63 - 1)),
    PLAIN.replace("6245", str(2**63)),
    PLAIN.replace("6245", "0007"),
    PLAIN.replace("6245", "+7"),
    PLAIN.replace("6245", "7\u0001"),
    PLAIN.replace("6245", "٧"),
    PLAIN.replace(":00:00:01", ":99:00:01"),
    PLAIN.replace("Jul", "Xyz"),
    PLAIN.replace("Jul", "X_9"),
    PLAIN.replace("200", "399"),
    PLAIN.replace("200", "600"),
    PLAIN.replace("200", "20"),
    PLAIN.replace("/a", "/a\u0001b"),
    PLAIN.replace(" HTTP/1.0", ""),
    PLAIN.replace("h - -", "�h - -"),
    PLAIN.replace("h - -", "h   - -"),
    PLAIN.replace("-0400", "- 04 00"),
    PLAIN.replace("-0400", ""),
    PLAIN + " ",
    " " + PLAIN,
    PLAIN + "\u0085tail",
    PLAIN + " x y",
    LATE,
    "",
    "junk",
    "a\tb\tc\td\te\tf\tg\th",
]


@pytest.mark.parametrize("match", ["full", "prefix"])
def test_edge_lines(spark, match):
    tagged = tag_batch(lines_frame(spark, EDGES))
    got = {
        row.id: tuple(row[2:]) for row in clean_logs(tagged, match=match, keep=["id"]).collect()
    }
    wanted = {i: parse(line, match) for i, line in enumerate(EDGES)}
    assert got == {i: fields for i, fields in wanted.items() if fields}
    rejected = malformed_lines(tagged, match=match, keep=["id"])
    assert {r.id: r.line for r in rejected.collect()} == {
        i: EDGES[i] for i, fields in wanted.items() if not fields
    }


def test_known_edges():
    assert parse(PLAIN) == ("h", "01/Jul/1995", 0, "GET", "/a", "HTTP/1.0", 200, 6245)
    assert parse(LATE) is None and parse(LATE, "prefix")[-1] == 6245


def test_null_and_multi_line_strings_are_malformed(spark):
    eight = "\n".join("abcdefgh")
    lines = [None, eight, PLAIN + "\n", PLAIN.replace("-0400", "\n")]
    tagged = tag_batch(lines_frame(spark, lines))
    assert clean_logs(tagged).isEmpty()
    assert malformed_lines(tagged).count() == 4
    parsed = parse_access_log(tagged).collect()
    assert all(row.is_valid is False and row.host is None for row in parsed)


def test_parse_keeps_every_line(spark):
    parsed = parse_access_log(tag_batch(lines_frame(spark, EDGES)), keep=["id"])
    assert parsed.columns == ["id", "batch_id", "line", "is_valid", *VALID_LOGS.names[1:]]
    for row in parsed.collect():
        fields = parse(EDGES[row.id])
        assert row.is_valid == (fields is not None)
        assert tuple(row[4:]) == (fields or (None,) * 8)


word = st.text(st.sampled_from('ab/-"[]#\\$1 \té '), max_size=4)
line = st.tuples(*[word] * 4).map(
    lambda w: f'{w[0]}h - - [01/Jul/1995:00:00:01 {w[1]}] "GET /{w[2]} HTTP/1.0" 404 1{w[3]}'
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=st.lists(line, min_size=100, max_size=200))
def test_random_lines_parse_as_in_python(spark, lines):
    tagged = tag_batch(lines_frame(spark, lines))
    for match in ("full", "prefix"):
        got = clean_logs(tagged, match=match, keep=["id"]).collect()
        wanted = {i: parse(text, match) for i, text in enumerate(lines)}
        assert {r.id: tuple(r[2:]) for r in got} == {i: f for i, f in wanted.items() if f}


def test_schema_of_valid_logs(spark):
    got = clean_logs(tag_batch(lines_frame(spark, [PLAIN])))
    assert [(f.name, f.dataType) for f in got.schema] == [
        (f.name, f.dataType) for f in VALID_LOGS
    ]


def test_batch_rules(spark):
    rows = [
        ("access_log_Jul95", "file:/logs/access_log_Jul95", "x /Aug/ y"),
        ("access_log_Jul95", "file:/Augdir/access_log_Jul95", "x"),
        ("access_log_Aug95", "file:/logs/access_log_Aug95", "x"),
        ("access_log_aug95", "file:/logs/access_log_aug95", "Aug"),
    ]
    lines = spark.createDataFrame(rows, "file_name string, file_path string, line string")
    tags = {
        rule: [r.batch_id for r in tag_batch(lines, rule).collect()]
        for rule in ("file_name", "path", "line", 2)
    }
    assert tags == {
        "file_name": [1, 1, 2, 1],
        "path": [1, 2, 2, 1],
        "line": [2, 1, 1, 1],
        2: [2, 2, 2, 2],
    }


def test_bad_options(spark):
    tagged = tag_batch(lines_frame(spark, [PLAIN]))
    with pytest.raises(ValueError):
        clean_logs(tagged, match="some")
    with pytest.raises(ValueError):
        select_batch(tagged, 3)
    with pytest.raises(ValueError):
        tag_batch(tagged, "month")
    with pytest.raises(ValueError):
        tag_batch(tagged, "path")


def _column(spark, values, kind, expression):
    frame = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in frame.select(expression(F.col("x"))).collect()]


def test_scalar_functions(spark):
    statuses = [399, 400, 599, 600]
    assert _column(spark, statuses, "int", is_error) == [False, True, True, False]
    texts = ["12", "-", "12x", "", "007", "9" * 20, "1\n"]
    assert _column(spark, texts, "string", normalize_bytes) == [12, 0, 0, 0, 7, None, 0]
    texts = ["3.7", "-3.7", "12", "x", None, "9" * 20, "1e3", "NaN"]
    assert _column(spark, texts, "string", coerce_long) == [3, -3, 12, 0, 0, 0, 1000, 0]
    assert _column(spark, ["0.5", "x", None], "string", coerce_double) == [0.5, 0.0, 0.0]
    numbers = [2.9, -2.9, 1e30, -1e30]
    assert _column(spark, numbers, "double", truncate) == [2, -2, 2**63 - 1, -(2**63)]
    assert _column(spark, [0, 4], "bigint", lambda t: error_rate(F.lit(1), t)) == [0.0, 0.25]
    assert _column(spark, [0, 4], "bigint", lambda t: percentage(F.lit(1), t)) == [0.0, 25.0]
    paths = ["p" * 39, "p" * 40]
    assert _column(spark, paths, "string", shorten_path) == ["p" * 39, "p" * 36 + "..."]


def test_one_regex_per_line(spark):
    plan = clean_logs(tag_batch(lines_frame(spark, [PLAIN])))._jdf.queryExecution()
    assert len(re.findall("regexp_replace", plan.executedPlan().toString())) == 1

"""Log lines derived from the ``events`` table, for tests and the driver.

One SQL text serves Spark and DuckDB. The oracle reads the columns that the
lines are made of, so it checks the parser without using its regex.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STAMP_DAY = (
    "CASE WHEN event_id % 2 = 1 THEN ts + INTERVAL 213 {days} ELSE ts + INTERVAL 182 {days} END"
)
_DIALECTS = {
    "spark": {
        "stamp": f"date_format({_STAMP_DAY.format(days='DAYS')}, 'dd/MMM/yyyy:HH:mm:ss')",
        "text": "STRING",
    },
    "duckdb": {
        "stamp": f"strftime({_STAMP_DAY.format(days='DAY')}, '%d/%b/%Y:%H:%M:%S')",
        "text": "VARCHAR",
    },
}

_BASE = """
SELECT event_id,
 CASE WHEN event_id % 2 = 1 THEN 'access_log_Aug95' ELSE 'access_log_Jul95' END AS file_name,
 concat('host', user_id, '.example.net') AS host,
 {stamp} AS stamp,
 concat(CASE WHEN event_id % 50 = 44 THEN '/Aug/' ELSE '/' END,
        event_type, '/', event_id % 97, '.html') AS path,
 CASE WHEN event_id % 200 = 51 THEN '399' WHEN event_id % 200 = 52 THEN '400'
      WHEN event_id % 200 = 53 THEN '599' WHEN event_id % 200 = 54 THEN '600'
      WHEN event_type = 'error'
        THEN CASE event_id % 3 WHEN 0 THEN '404' WHEN 1 THEN '500' ELSE '403' END
      WHEN event_id % 11 = 0 THEN '304' ELSE '200' END AS status,
 CASE {huge} WHEN event_id % 50 = 41 THEN '12x'
      WHEN event_id % 100 = 47 THEN '99999999999999999999'
      WHEN event_type = 'error' OR event_id % 11 = 0 THEN '-'
      ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS {text}) END AS bytes_text
FROM events
"""

_RAW = """
SELECT event_id, file_name, CASE event_id % 50
 WHEN 7 THEN concat(host, ' - - [', stamp, ' -0400] "GET ', path, '" ', status, ' ', bytes_text)
 WHEN 13 THEN 'not an access log line'
 WHEN 21 THEN ''
 WHEN 33 THEN concat(host, ' - - [', stamp, ' -0400] "GET ', path, ' HTTP/1.0" ',
                     status, ' ', bytes_text, ' "-" "agent"')
 ELSE concat(host, ' - - [', stamp, ' -0400] "GET ', path, ' HTTP/1.0" ',
             status, ' ', bytes_text) END AS line
FROM base
"""

_VALID = """
SELECT event_id, CASE WHEN file_name LIKE '%Aug%' THEN 2 ELSE 1 END AS batch_id, host,
 substr(stamp, 1, 11) AS log_date, CAST(substr(stamp, 13, 2) AS INT) AS log_hour,
 'GET' AS method, path AS resource_path, 'HTTP/1.0' AS protocol,
 CAST(status AS INT) AS status_code,
 CASE WHEN regexp_full_match(bytes_text, '[0-9]+')
      THEN try_cast(bytes_text AS BIGINT) ELSE CAST(0 AS BIGINT) END AS bytes
FROM base
WHERE event_id % 50 NOT IN {malformed} AND event_id % 100 <> 47
"""

#: The files the lines belong to.
LOG_FILES = ("access_log_Jul95", "access_log_Aug95")


#: Every fifth line claims as many bytes as a long can hold.
_HUGE = "WHEN event_id % 5 = 0 THEN '9223372036854775807'"


def _base(dialect: str, huge: bool = False) -> str:
    return _BASE.format(**_DIALECTS[dialect], huge=_HUGE if huge else "")


def raw_lines(spark: SparkSession, sf_dir: str, huge: bool = False) -> DataFrame:
    """``event_id``, ``file_name``, ``line`` and the parts the line is made of."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    base = spark.sql(_base("spark", huge).replace("FROM events", "FROM {events}"), events=events)
    return spark.sql(_RAW.replace("FROM base", "FROM {base}"), base=base)


def bytes_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    base = spark.sql(_base("spark").replace("FROM events", "FROM {events}"), events=events)
    return base.select("event_id", "bytes_text")


def write_log_files(raw: DataFrame, path: str) -> None:
    """Write the lines as text files whose names carry their batch."""
    for name in LOG_FILES:
        (
            raw.where(F.col("file_name") == name)
            .select(F.col("line").alias("value"))
            .write.mode("append")
            .option("mapreduce.output.basename", name)
            .text(path)
        )


def oracle(body: str, match: str = "full", huge: bool = False) -> str:
    """``body`` over the CTEs ``base``, ``raw`` and ``v`` (valid logs) for DuckDB.

    ``v_prefix`` are the logs that are valid when fields may follow.
    """
    prefix = _VALID.format(malformed="(7, 13, 21)")
    valid = _VALID.format(malformed="(7, 13, 21, 33)") if match == "full" else prefix
    return (
        f"WITH base AS ({_base('duckdb', huge)}), raw AS ({_RAW}), v AS ({valid}), "
        f"v_prefix AS ({prefix})\n{body}"
    )

"""Every registered query against its SQL on DuckDB: schema and values."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module

SCALES = os.environ.get("LOGWEIR_SCALES", "sf0.01").split(",")
DATA = "/root/testdata"
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
}


def _duck(scale):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{DATA}/{scale}/events.parquet'")
    return db


def test_every_query_has_an_oracle():
    assert entry_module.log_queries().keys() == entry_module.log_oracle_sql().keys()


@pytest.mark.parametrize("scale", SCALES)
@pytest.mark.parametrize("key", sorted(entry_module.log_queries()))
def test_query_equals_sql(spark, key, scale):
    wanted = _duck(scale).sql(entry_module.log_oracle_sql()[key])
    got = entry_module.log_queries()[key](spark, f"{DATA}/{scale}")

    wanted_types = {n: TYPES[str(t)] for n, t in zip(wanted.columns, wanted.types)}
    assert dict(got.dtypes) == wanted_types

    columns = sorted(wanted_types)
    order = [wanted.columns.index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in order) for row in wanted.fetchall())
    actual = Counter(tuple(row) for row in got.select(*columns).collect())
    assert actual == expected
    assert actual


def test_entry(spark):
    assert entry_module.entry(spark).count() == 762

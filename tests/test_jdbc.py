"""Loading a database once. The database is DuckDB in this process; Spark's own JDBC writer
and connection are stood in for, since no database server may be started."""

import duckdb
import pytest
from helpers import PLAIN, lines_frame
from pyspark.sql.readwriter import DataFrameWriter

from logweir.operators import clean_logs, stats_row, tag_batch
from logweir.plans import query_results
from logweir.schemas import STORE_TABLES
from logweir.sinks import Run, append_run, insert_once, insert_run, jdbc

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "timestamp": "TIMESTAMPTZ", "decimal(38,0)": "DECIMAL(38,0)"}


class Database:
    """What the stand-ins write to; ``lost`` makes the next transaction fail."""

    def __init__(self):
        self.db, self.repeats, self.lost = duckdb.connect(), 2, False

    def write(self, writer, url, table, mode, properties):
        assert (url, mode, properties) == ("jdbc:x", "append", {"user": "u"})
        rows = [tuple(r) for r in writer._df.collect()]
        for _ in range(self.repeats):  # tasks that were run again
            for row in rows:
                marks = ", ".join("?" * len(row))
                self.db.execute(f"INSERT INTO {table} VALUES ({marks})", row)

    def transact(self, spark, url, properties, statements):
        self.db.execute("BEGIN")
        try:
            for i, statement in enumerate(statements):
                if self.lost and i == 2:
                    raise ConnectionError("the driver is lost")
                self.db.execute(statement)
            self.db.execute("COMMIT")
        except ConnectionError:
            self.db.execute("ROLLBACK")
            raise

    def rows(self, table):
        return sorted(self.db.execute(f"SELECT * FROM {table}").fetchall(), key=repr)

    def create(self, frame, table):
        for statement in jdbc.table_statements(table, {n: KINDS[t] for n, t in frame.dtypes}):
            self.db.execute(statement)


@pytest.fixture
def database(monkeypatch):
    made = Database()
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, *a, **b: made.write(self, *a, **b))
    monkeypatch.setattr(jdbc, "transact", made.transact)
    return made


def test_retried_tasks_insert_once(spark, database, tmp_path):
    # Equal rows each count; a quote in the key is no SQL.
    spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "n bigint, t string").write.parquet(str(tmp_path / "f"))
    frame = spark.read.parquet(str(tmp_path / "f"))
    database.create(frame, "target")
    for key, times in (("k'1", 1), ("k'1", 1), ("k2", 2)):
        insert_once(frame, "jdbc:x", "target", {"user": "u"}, key)
        assert database.rows("target") == sorted([(1, "a"), (1, "a"), (2, None)] * times, key=repr)
        assert not database.rows("target_staging")
    assert [k for k, _ in database.rows("logweir_loads")] == ["k'1", "k2"]


def test_lost_driver_leaves_nothing_half_done(spark, database, tmp_path):
    spark.range(5).withColumnRenamed("id", "n").write.parquet(str(tmp_path / "f"))
    frame = spark.read.parquet(str(tmp_path / "f"))
    database.create(frame, "target")
    database.lost = True
    with pytest.raises(ConnectionError):
        insert_once(frame, "jdbc:x", "target", {"user": "u"}, "k")
    assert not database.rows("target") and not database.rows("logweir_loads")
    database.lost = False
    insert_once(frame, "jdbc:x", "target", {"user": "u"}, "k")
    assert database.rows("target") == [(n,) for n in range(5)]
    assert not database.rows("target_staging")


def test_a_run_is_inserted_once(spark, database, tmp_path):
    store = str(tmp_path / "store")
    valid = clean_logs(tag_batch(lines_frame(spark, [PLAIN])))
    append_run(spark, store, Run(3), query_results(valid), stats_row(spark, 2, 1), 5)
    for table, schema in STORE_TABLES.items():
        database.create(spark.createDataFrame([], schema), table)
    for _ in range(2):
        insert_run(spark, store, 3, "jdbc:x", {"user": "u"})
        assert {t: len(database.rows(t)) for t in STORE_TABLES} == dict.fromkeys(STORE_TABLES, 1)
    assert database.rows("query2_results")[0][0] == 3
    with pytest.raises(ValueError, match="no finished run 4"):
        insert_run(spark, store, 4, "jdbc:x", {"user": "u"})

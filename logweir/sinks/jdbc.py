"""The run store's tables in a database."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.schemas import STORE_TABLES
from logweir.sources.tables import finished, read_store

#: Tables that ``insert_once`` needs beside the target: what has been loaded, and for each
#: target one of these names, with LOAD_COLUMNS before the target's own columns.
LOADS_TABLE = "logweir_loads"
STAGING = "_staging"
LOAD_COLUMNS = ("load_key", "load_row")


def append_jdbc(
    frame: DataFrame, url: str, table: str, properties: dict[str, str], connections: int = 8
) -> None:
    """Append ``frame`` to a database table over at most ``connections`` tasks.

    A retried task inserts its rows again unless the database has a key to stop
    it, so this is for results, which are small, and not for ``valid_logs``. Under
    speculation a task may be run twice at once, so that is refused.
    """
    if frame.sparkSession.conf.get("spark.speculation", "false").lower() == "true":
        raise RuntimeError("switch spark.speculation off to write to a database")
    frame.coalesce(connections).write.jdbc(url, table, mode="append", properties=properties)


def load_statements(table: str, columns: Sequence[str], key: str) -> list[str]:
    """One transaction that moves a load from its staging table, once.

    The first statement notes the load, and changes no row if it is noted already; the
    second takes each row of the load once, however often tasks have inserted it, and none
    unless this transaction has noted it; the third empties the staging table of the load.
    """
    quoted = "'" + key.replace("'", "''") + "'"
    names = ", ".join(columns)
    known = f"SELECT 1 FROM {LOADS_TABLE} WHERE load_key = {quoted}"
    mark, row = LOAD_COLUMNS
    return [
        f"INSERT INTO {LOADS_TABLE} (load_key, done) SELECT {quoted}, 0 WHERE NOT EXISTS ({known})",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM (SELECT DISTINCT {row}, {names} "
        f"FROM {table}{STAGING} WHERE {mark} = {quoted}) AS once "
        f"WHERE EXISTS ({known} AND done = 0)",
        f"UPDATE {LOADS_TABLE} SET done = 1 WHERE load_key = {quoted}",
        f"DELETE FROM {table}{STAGING} WHERE {mark} = {quoted}",
    ]


def table_statements(table: str, columns: dict[str, str]) -> list[str]:
    """DDL of the tables that loads need: ``columns`` are the target's, with SQL types."""
    own = ", ".join(f"{name} {kind}" for name, kind in columns.items())
    mark, row = LOAD_COLUMNS
    return [
        f"CREATE TABLE IF NOT EXISTS {LOADS_TABLE} (load_key VARCHAR(200) PRIMARY KEY, done INTEGER)",
        f"CREATE TABLE IF NOT EXISTS {table} ({own})",
        f"CREATE TABLE IF NOT EXISTS {table}{STAGING} ({mark} VARCHAR(200), {row} BIGINT, {own})",
    ]


def transact(
    spark: SparkSession, url: str, properties: dict[str, str], statements: Sequence[str]
) -> None:
    """Run statements in one transaction, over a connection of the driver's JVM."""
    options = spark._jvm.java.util.Properties()
    for name, value in properties.items():
        options.setProperty(name, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, options)
    try:
        connection.setAutoCommit(False)
        for statement in statements:
            connection.createStatement().execute(statement)
        connection.commit()
    finally:
        connection.close()


def insert_once(
    frame: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    key: str,
    connections: int = 8,
) -> None:
    """Insert ``frame`` under the name ``key``: all of its rows once, or none if the key
    has been loaded before.

    Rows go to a staging table with the key and their place in the frame. A task that is
    run again, or twice at once, repeats a place and is taken once. The frame must be read
    from storage, so that places stay. If the driver is lost in between, the same call
    again completes the load. Rows that are equal as a whole each count.
    """
    mark, row = LOAD_COLUMNS
    placed = frame.withColumn(row, F.monotonically_increasing_id()).withColumn(mark, F.lit(key))
    staged = placed.select(mark, row, *frame.columns)
    staged.coalesce(connections).write.jdbc(
        url, f"{table}{STAGING}", mode="append", properties=properties
    )
    transact(frame.sparkSession, url, properties, load_statements(table, frame.columns, key))


def insert_run(
    spark: SparkSession, store: str, run_id: int, url: str, properties: dict[str, str]
) -> None:
    """A finished run's rows of all store tables, each table once, ``runs`` last.

    A run that has been compacted must have been inserted before: it has no attempt of its
    own any more.
    """
    run = finished(spark, store, run_id)
    if run is None:
        raise ValueError(f"no finished run {run_id} in {store}")
    for table in STORE_TABLES:
        if table in run.tables:
            rows = read_store(spark, store, table, run_id)
            insert_once(rows, url, table, properties, f"{run_id}/{run.attempt}/{table}")

"""Small files and folder names on whatever file system a path is on.

Spark has no public call for these; the Hadoop classes that Spark itself goes through do.
Only names and a few bytes are handled here, never rows.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _at(spark, path)
    return files.exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, one listing; of no folder, none."""
    files, at = _at(spark, path)
    try:
        return [status.getPath().getName() for status in files.listStatus(at)]
    except Py4JJavaError as error:
        if _is(error, "FileNotFoundException"):
            return []
        raise


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist; False if it does.

    Of two that do so at once, one gets False where the file system creates files
    exclusively (HDFS, local disks). Where it does not, the file is one of the two, and
    reading it back tells which: the other gets False too.
    """
    files, at = _at(spark, path)
    try:
        out = files.create(at, False)
    except Py4JJavaError as error:
        if _is(error, "FileAlreadyExistsException"):
            return False
        raise
    out.write(text.encode())
    out.close()
    return read(spark, path) == text


def read(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if there is none."""
    files, at = _at(spark, path)
    try:
        stream = files.open(at)
    except Py4JJavaError as error:
        if _is(error, "FileNotFoundException"):
            return None
        raise
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all in it, if it is there."""
    files, at = _at(spark, path)
    files.delete(at, True)


def _is(error: Py4JJavaError, name: str) -> bool:
    return error.java_exception.getClass().getSimpleName() == name

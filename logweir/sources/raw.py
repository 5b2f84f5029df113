"""Raw log files as a DataFrame of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_raw_logs(
    spark: SparkSession, path: str | list[str], partitions: int | None = None
) -> DataFrame:
    """Lines of the text files under ``path`` as ``(file_name, file_path, line)``.

    LF, CR and CRLF all end a line. Uncompressed files are split, so a single
    huge file is read by many tasks. A gzip file is not splittable: pass
    ``partitions`` to spread its lines before they are parsed.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("value").alias("line"),
    )
    return lines if partitions is None else lines.repartition(partitions)

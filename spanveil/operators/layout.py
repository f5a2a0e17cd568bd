"""Rewriting of a table so that lookups by day and trace read few files."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import file_system

FILE_BYTES = 256 * 1024 * 1024


def cluster(df: DataFrame, files: int) -> DataFrame:
    """Order rows by day and trace over a number of files.

    Time, span and input partition continue the key, so a trace with many rows, or
    many copies of one row, is spread over several files.
    """
    keys = ["date", "trace_id", *(c for c in ("start_time_unix_nano", "time_unix_nano", "span_id")
                                  if c in df.columns)]
    placed = df.withColumn("_origin", F.spark_partition_id())
    return placed.repartitionByRange(files, *keys, "_origin").drop("_origin").sortWithinPartitions(*keys)


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = FILE_BYTES) -> int:
    """Write a clustered copy, partitioned by day; returns the number of files aimed at.

    Parquet keeps the least and greatest trace id of each row group, so a query for one trace
    skips the rest.
    """
    fs, path = file_system(spark, source)
    files = max(1, -(-fs.getContentSummary(path).getLength() // file_bytes))
    cluster(spark.read.parquet(source), files).write.partitionBy("date").parquet(target)
    return files

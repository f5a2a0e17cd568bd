"""Reading of raw and redacted tables, in batch and as streams."""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TABLE_KINDS, PipelineConfig
from ..schemas import BY_KIND


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, so that any storage Spark can read works."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def day_folders(spark: SparkSession, path: str) -> dict[dt.date, str]:
    """The ``date=`` folders of a table; the one of rows without a date is left out."""
    if not path_exists(spark, path):
        return {}
    fs, root = file_system(spark, path)
    days = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if not status.isDirectory() or not name.startswith("date="):
            continue
        try:
            day = dt.date.fromisoformat(name.removeprefix("date="))
        except ValueError:
            continue
        days[day] = status.getPath().toString()
    return days


def has_data_files(spark: SparkSession, path: str) -> bool:
    """True if files lie directly in the folder, not in one folder per day."""
    if not path_exists(spark, path):
        return False
    fs, root = file_system(spark, path)
    return any(s.isFile() and s.getPath().getName()[0] not in "_." for s in fs.listStatus(root))


def table_days(spark: SparkSession, path: str) -> set[dt.date]:
    """The days of a table, from its folders if it is partitioned, else from its rows."""
    if not has_data_files(spark, path):
        return set(day_folders(spark, path))
    days = spark.read.parquet(path).select("date").where("date is not null").distinct()
    return {row.date for row in days.toLocalIterator()}


def read_raw(spark: SparkSession, config: PipelineConfig, kind: str) -> DataFrame:
    return spark.read.schema(BY_KIND[kind]).parquet(config.raw_path(kind))


def stream_raw(spark: SparkSession, config: PipelineConfig, kind: str) -> DataFrame:
    reader = spark.readStream.schema(BY_KIND[kind])
    if config.max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", config.max_bytes_per_trigger)
    return reader.parquet(config.raw_path(kind))


#: Tasks of row work for each split of the input; a split is at most ``spark.sql.files.maxPartitionBytes``.
TASKS_PER_SPLIT = 8


def spread(df: DataFrame) -> DataFrame:
    """Spread an input evenly over tasks before expensive row work.

    The number of splits does not tell how the rows lie in them: a row group is read by one task however
    many splits its file has, so one task may read all of a large file. Hence rows are always dealt
    out, those of each split to several tasks, which keeps a task's share bounded as the input grows.
    The filter keeps every row; the optimizer moves no other filter below it, where few tasks would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df.repartition(max(cores, TASKS_PER_SPLIT * splits)).where(F.spark_partition_id() >= 0)


@dataclass(frozen=True)
class SourceState:
    kind: str
    path: str
    rows: int | None  # None: the table is missing


def check_sources(spark: SparkSession, config: PipelineConfig) -> list[SourceState]:
    """Row count of each raw table. A missing table is reported; any other error is raised."""
    states = []
    for kind in TABLE_KINDS:
        path = config.raw_path(kind)
        try:
            rows = read_raw(spark, config, kind).count()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = None
        states.append(SourceState(kind, path, rows))
    return states

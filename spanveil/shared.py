"""The folder that all executors share for small intermediate tables and checkpoints."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """A new path below the folder named in ``spark.checkpoint.dir``."""
    base = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="spanveil-")
        spark.conf.set(_SETTING, base)
    return f"{base.rstrip('/')}/spanveil-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The result survives the loss of executors, and Spark knows its true size, so it
    broadcasts the table only if it is small.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

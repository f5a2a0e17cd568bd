"""Names, comments and properties of the redacted tables in the catalog."""
from __future__ import annotations

from pyspark.sql import SparkSession

from ..config import TABLE_KINDS, PipelineConfig
from ..schemas import BY_KIND
from ..sources.tables import path_exists
from ..streaming.pipeline import redacted_path

_COMMENTS = {
    "spans": "Spans without personal data",
    "logs": "Logs without personal data",
    "annotations": "Annotations, passed through without masking",
}
_PROPERTIES = {"spans": {"quality": "gold"}}


def publish_tables(spark: SparkSession, config: PipelineConfig) -> list[str]:
    """Create the target schema and a named view of the current version of each redacted table.

    The views read the folders through the log of the stream, so readers never see files of
    unfinished batches.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {config.target_schema} LOCATION '{config.target_path}'")
    published = []
    for kind in TABLE_KINDS:
        path = redacted_path(spark, config, kind)
        if not path_exists(spark, path):
            continue
        name = f"{config.target_schema}.{config.redacted_name(kind)}"
        properties = ", ".join(f"'{k}' = '{v}'" for k, v in _PROPERTIES.get(kind, {}).items())
        spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT '{_COMMENTS[kind]}' "
                  + (f"TBLPROPERTIES ({properties}) " if properties else "")
                  + f"AS SELECT * FROM parquet.`{path}`")
        published.append(name)
    return published


def create_raw_table(spark: SparkSession, config: PipelineConfig, kind: str) -> str:
    """Name a raw folder as a table that is partitioned by day, for expiry and SQL users."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {config.source_schema} "
              f"LOCATION '{config.source_root}/{config.source_schema}'")
    name = f"{config.source_schema}.{config.raw_name(kind)}"
    schema = BY_KIND[kind]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitioned = " PARTITIONED BY (date)" if "date" in schema.names else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{partitioned} "
              f"LOCATION '{config.raw_path(kind)}'")
    if partitioned:
        spark.catalog.recoverPartitions(name)
    return name

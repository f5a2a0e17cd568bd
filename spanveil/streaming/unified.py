"""The trace view as a table that is kept up to date: only trace-days that new rows touch are computed again.

The table lies in folders by day and bucket of the trace. A micro-batch of redacted rows names the trace-days
that it touches; these are computed from the redacted tables, and the folders that hold them are written
anew. A manifest says which folders make up the table. It is written last, so readers see all of a
batch or nothing, and a batch that is run again gives the same rows.
"""
from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from ..config import PipelineConfig
from ..plans.trace_view import VIEW_COLUMNS, trace_unified
from ..shared import stored
from ..sources.tables import file_system, path_exists
from .pipeline import current_version, read_redacted, redacted_path

BUCKETS = 64
_KEYS = ("trace_id", "date")
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"
_COLUMNS = (*VIEW_COLUMNS, "part")

Folder = tuple[dt.date | None, int]


@dataclass(frozen=True)
class Manifest:
    """The folders of the table: for each day and bucket, the generation that holds its rows."""

    number: int
    buckets: int
    schema: StructType
    folders: dict[Folder, str]

    def text(self) -> str:
        return json.dumps({"number": self.number, "buckets": self.buckets, "schema": self.schema.jsonValue(), "folders": [
            [day and day.isoformat(), bucket, generation] for (day, bucket), generation in self.folders.items()]})

    @classmethod
    def parse(cls, text: str) -> Manifest:
        data = json.loads(text)
        return cls(data["number"], data["buckets"], StructType.fromJson(data["schema"]), {
            (day and dt.date.fromisoformat(day), bucket): generation for day, bucket, generation in data["folders"]})


@dataclass(frozen=True)
class BatchReport:
    kind: str
    trace_days: int
    spans_read: int
    folders: tuple[Folder, ...]


def _base(spark: SparkSession, config: PipelineConfig) -> str:
    version = current_version(spark, config)
    if version is None:
        raise ValueError(f"nothing has been redacted to {config.target_path} yet")
    return f"{config.target_path}/v{version}/{config.unified_name}"


def _manifests(spark: SparkSession, base: str) -> list[tuple[int, str]]:
    if not path_exists(spark, f"{base}/_manifests"):
        return []
    fs, root = file_system(spark, f"{base}/_manifests")
    found = [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(root)]
    return sorted((int(m[1]), path) for name, path in found if (m := re.fullmatch(r"([0-9]+)\.json", name)))


def _read_manifest(spark: SparkSession, path: str) -> Manifest | None:
    """A manifest, or None if its writer died before the end."""
    fs, place = file_system(spark, path)
    stream = fs.open(place)
    try:
        text = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
    try:
        return Manifest.parse(text)
    except ValueError:
        return None


def manifest(spark: SparkSession, base: str) -> Manifest | None:
    """The newest manifest that is complete."""
    for _, path in reversed(_manifests(spark, base)):
        if (found := _read_manifest(spark, path)) is not None:
            return found
    return None


def _commit(spark: SparkSession, base: str, new: Manifest) -> None:
    """Write a manifest under a number that no other writer has taken; else the batch fails and is run again."""
    fs, place = file_system(spark, f"{base}/_manifests/{new.number:012d}.json")
    out = fs.create(place, False)
    try:
        out.write(bytearray(new.text().encode()))
    finally:
        out.close()


def _bucket(buckets: int, trace: str = "trace_id") -> Column:
    return F.pmod(F.xxhash64(trace), F.lit(buckets)).cast("int")


def _paths(base: str, found: Manifest, folders) -> list[str]:
    return [f"{base}/generation={found.folders[f]}/date={f[0] or _NO_DATE}/bucket={f[1]}" for f in folders if f in found.folders]


def _table(spark: SparkSession, base: str, found: Manifest, folders=None) -> DataFrame:
    """The rows of some folders of the table, or of all."""
    schema = StructType([*(f for f in found.schema.fields if f.name != "date"), StructField("generation", StringType()),
                         StructField("date", DateType()), StructField("bucket", IntegerType())])
    paths = _paths(base, found, found.folders if folders is None else folders)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def read_unified(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """The maintained view, as of the last batch."""
    base = _base(spark, config)
    found = manifest(spark, base)
    if found is None:
        raise ValueError(f"the view of {config.target_path} has not been maintained yet")
    return _table(spark, base, found).select(*_COLUMNS)


def _of(rows: DataFrame, touched: DataFrame, how: str) -> DataFrame:
    """Rows whose trace-day is touched (left_semi) or not (left_anti); null keys are a group too."""
    keys = touched.select(*(F.col(k).alias(f"touched_{k}") for k in _KEYS))
    return rows.join(keys, [rows[k].eqNullSafe(keys[f"touched_{k}"]) for k in _KEYS], how)


def _on_days(days: set) -> Column:
    known = F.col("date").isin([d for d in days if d is not None])
    return known | F.col("date").isNull() if None in days else known


def _touched(session: SparkSession, base: str, found: Manifest | None, kind: str, batch: DataFrame) -> DataFrame:
    """The trace-days that rows of a batch belong to; for annotations, those of the table with their target."""
    if kind == "spans":
        return batch.select(*_KEYS).distinct()
    targets = stored(batch.select(F.col("target_id").alias("trace_id")).where("trace_id is not null").distinct())
    if found is None:
        return session.createDataFrame([], "trace_id string, date date")
    buckets = {r[0] for r in targets.select(_bucket(found.buckets)).distinct().collect()}
    rows = _table(session, base, found, [f for f in found.folders if f[1] in buckets])
    return rows.select(*_KEYS).join(targets, "trace_id", "left_semi").distinct()


def _apply(config: PipelineConfig, base: str, kind: str, batch: DataFrame, buckets: int) -> BatchReport | None:
    session = batch.sparkSession
    found = manifest(session, base)
    buckets = buckets if found is None else found.buckets
    touched = stored(_touched(session, base, found, kind, batch))
    folders = [tuple(r) for r in touched.select("date", _bucket(buckets).alias("bucket")).distinct().collect()]
    if not folders:
        return None
    spans = stored(_of(read_redacted(session, config, "spans").where(_on_days({day for day, _ in folders})), touched, "left_semi"))
    annotations = read_redacted(session, config, "annotations").join(
        touched.select(F.col("trace_id").alias("target_id")).distinct(), "target_id", "left_semi")
    view = trace_unified(spans, annotations).select(*_COLUMNS)
    rows = view
    if found is not None:
        rows = _of(_table(session, base, found, folders).select(*_COLUMNS), touched, "left_anti").unionByName(view)
    generation = uuid.uuid4().hex
    rows.withColumn("bucket", _bucket(buckets)).hint("rebalance", "date", "bucket").write.partitionBy("date", "bucket").parquet(
        f"{base}/generation={generation}")
    number = max((n for n, _ in _manifests(session, base)), default=0) + 1
    _commit(session, base, Manifest(number, buckets, view.schema, {
        **({} if found is None else found.folders), **dict.fromkeys(folders, generation)}))
    return BatchReport(kind, touched.count(), spans.count(), tuple(folders))


def maintain_view(spark: SparkSession, config: PipelineConfig, buckets: int = BUCKETS) -> list[BatchReport]:
    """Bring the maintained view up to date with the redacted tables, and say what was computed.

    Each redacted row is read once as new, through a checkpoint of its own, so the cost of a run is that of the
    trace-days with new rows and of the folders that hold them. ``buckets`` per day counts for the first run
    of a version of the target. One writer at a time: a second one fails when it commits.
    """
    base = _base(spark, config)
    reports: list[BatchReport] = []
    for kind in ("spans", "annotations"):
        path = redacted_path(spark, config, kind)
        if not path_exists(spark, path):
            continue

        def apply(batch: DataFrame, _: int, kind: str = kind) -> None:
            report = _apply(config, base, kind, batch, buckets)
            if report is not None:
                reports.append(report)

        stream = spark.readStream.schema(read_redacted(spark, config, kind).schema).parquet(path)
        query = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", f"{base}/_checkpoints/{kind}")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    return reports


def vacuum_view(spark: SparkSession, config: PipelineConfig, keep: int = 2) -> int:
    """Delete the folders that the last ``keep`` manifests don't name, and older manifests; returns how many folders went."""
    base = _base(spark, config)
    numbered = _manifests(spark, base)
    kept = [m for _, path in numbered[-max(1, keep):] if (m := _read_manifest(spark, path)) is not None]
    if not kept:
        return 0
    named = {path for m in kept for path in _paths("", m, m.folders)}
    fs, root = file_system(spark, base)
    gone = 0
    for generation in (s for s in fs.listStatus(root) if s.getPath().getName().startswith("generation=")):
        for day in (s for s in fs.listStatus(generation.getPath()) if s.isDirectory()):
            for bucket in (s for s in fs.listStatus(day.getPath()) if s.isDirectory()):
                if f"/{generation.getPath().getName()}/{day.getPath().getName()}/{bucket.getPath().getName()}" not in named:
                    gone += fs.delete(bucket.getPath(), True)
    for _, path in numbered[:-max(1, keep)]:
        fs.delete(file_system(spark, path)[1], False)
    return gone


def publish_unified(spark: SparkSession, config: PipelineConfig) -> str:
    """Name the maintained view in the catalog, with its columns, for all sessions; returns the name.

    The view stands over an external table that lists the folders of the last manifest, so filters on the day
    reach the folders. Replacing the view is one step, and the table of the manifest before stays for queries
    that still run.
    """
    base = _base(spark, config)
    found = manifest(spark, base)
    if found is None:
        raise ValueError(f"the view of {config.target_path} has not been maintained yet")
    schema, name = config.target_schema, config.unified_name
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{config.target_path}'")
    table = f"{name}_days_{found.number}"
    if not spark.catalog.tableExists(f"{schema}.{table}"):
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields if f.name != "date"]
        spark.sql(f"CREATE TABLE {schema}.{table} ({', '.join(columns)}, date date, bucket int) USING parquet "
                  f"PARTITIONED BY (date, bucket) LOCATION '{base}/_published/{found.number}'")
        folders = list(found.folders)
        for i in range(0, len(folders), 500):
            parts = " ".join(
                f"PARTITION (date={'null' if day is None else f'DATE{chr(39)}{day}{chr(39)}'}, bucket={bucket}) LOCATION '{path}'"
                for (day, bucket), path in zip(folders[i:i + 500], _paths(base, found, folders[i:i + 500])))
            spark.sql(f"ALTER TABLE {schema}.{table} ADD IF NOT EXISTS {parts}")
    listed = ", ".join(f"`{c}`" for c in _COLUMNS)
    spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} ({listed}) COMMENT 'One row per trace and day, with its spans and annotations' "
              f"AS SELECT {listed} FROM {schema}.{table}")
    older = sorted(int(m[1]) for t in spark.catalog.listTables(schema) if (m := re.fullmatch(rf"{name}_days_([0-9]+)", t.name)))
    for number in [n for n in older if n < found.number][:-1]:
        spark.sql(f"DROP TABLE {schema}.{name}_days_{number}")
    return f"{schema}.{name}"

"""The redaction pipeline: raw tables in, redacted tables out, each row once.

Each version of the target is a folder with the redacted tables and their checkpoints. A full
refresh fills a new version while the old one stays readable.
"""
from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..config import TABLE_KINDS, PipelineConfig
from ..operators.redact import REDACTORS
from ..plans.trace_view import trace_unified
from ..schemas import BY_KIND
from ..sources.tables import file_system, path_exists, stream_raw, table_days

_READY = "_READY"
_PROGRESS_KEPT = "spark.sql.streaming.numRecentProgressUpdates"


@dataclass(frozen=True)
class RunReport:
    version: int
    rows: dict[str, int]
    missing: tuple[str, ...]


def _version_path(config: PipelineConfig, version: int) -> str:
    return f"{config.target_path}/v{version}"


def _versions(spark: SparkSession, config: PipelineConfig) -> list[int]:
    if not path_exists(spark, config.target_path):
        return []
    fs, root = file_system(spark, config.target_path)
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    return sorted(int(n[1:]) for n in names if re.fullmatch(r"v[0-9]+", n))


def current_version(spark: SparkSession, config: PipelineConfig) -> int | None:
    """The newest version that is complete."""
    ready = [v for v in _versions(spark, config)
             if path_exists(spark, f"{_version_path(config, v)}/{_READY}")]
    return ready[-1] if ready else None


#: Rounds of the digest of a salt; more make each run with a salt start later.
_SALT_ROUNDS = 300_000


def _mark_ready(spark: SparkSession, config: PipelineConfig, version: int) -> None:
    fs, marker = file_system(spark, f"{_version_path(config, version)}/{_READY}")
    fs.create(marker, True).close()


def _policy_mark(config: PipelineConfig) -> str:
    """A file name that stands for the policy and the fields.

    It lies beside the data, so the salt goes in by a slow digest: its guesses are as slow to test.
    """
    policy = config.policy
    salt = policy.salt and hashlib.pbkdf2_hmac("sha256", policy.salt.encode(), b"spanveil policy", _SALT_ROUNDS).hex()
    model = policy.model and f"{policy.model.__module__}.{policy.model.__qualname__}"
    settings = (sorted(policy.categories), list(policy.custom_patterns.items()), policy.mode, policy.mask_character, salt,
                sorted(policy.allowlisted_keys), policy.events_as, model, sorted((k, tuple(v)) for k, v in config.fields.items()),
                *([sorted(policy.allowlisted_paths)] if policy.allowlisted_paths else []))
    return f"_POLICY-{hashlib.sha256(repr(settings).encode()).hexdigest()}"


def _check_policy(spark: SparkSession, config: PipelineConfig, version: int) -> None:
    """Note the policy in a new version; refuse another one later."""
    base, mark = _version_path(config, version), _policy_mark(config)
    fs, root = file_system(spark, base)
    noted = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    if mark in noted:
        return
    if any(name.startswith("_POLICY-") for name in noted):
        raise ValueError("the policy or the fields differ from those of the rows already redacted; call full_refresh")
    fs, marker = file_system(spark, f"{base}/{mark}")
    fs.create(marker, True).close()


def redacted_path(spark: SparkSession, config: PipelineConfig, kind: str) -> str:
    version = current_version(spark, config)
    if version is None:
        raise ValueError(f"nothing has been redacted to {config.target_path} yet")
    return f"{_version_path(config, version)}/{config.redacted_name(kind)}"


def redact_kind(df: DataFrame, config: PipelineConfig, kind: str,
                where: Column | None = None) -> DataFrame:
    return REDACTORS[kind](df, config.policy, config.fields[kind], where)


def read_redacted(spark: SparkSession, config: PipelineConfig, kind: str) -> DataFrame:
    path = redacted_path(spark, config, kind)
    schema = redact_kind(spark.createDataFrame([], BY_KIND[kind]), config, kind).schema
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _with_row_id(spark: SparkSession, config: PipelineConfig, kind: str) -> DataFrame:
    df = read_redacted(spark, config, kind)
    if not path_exists(spark, redacted_path(spark, config, kind)):
        return df.withColumn("row_id", F.lit(0).cast("long"))
    return df.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("row_id"))


def _writer(spark: SparkSession, config: PipelineConfig, kind: str, version: int,
            where: Column | None) -> DataStreamWriter:
    base, name = _version_path(config, version), config.redacted_name(kind)
    redacted = redact_kind(stream_raw(spark, config, kind), config, kind, where)
    writer = (redacted.writeStream.format("parquet").outputMode("append")
              .option("path", f"{base}/{name}")
              .option("checkpointLocation", f"{base}/_checkpoints/{name}"))
    return writer.partitionBy("date") if "date" in redacted.columns else writer


def _present(spark: SparkSession, config: PipelineConfig) -> list[str]:
    return [k for k in TABLE_KINDS if path_exists(spark, config.raw_path(k))]


def _process(spark: SparkSession, config: PipelineConfig, version: int,
             where: dict[str, Column]) -> RunReport:
    present = _present(spark, config)
    queries: dict[str, StreamingQuery] = {}
    kept = spark.conf.get(_PROGRESS_KEPT)
    spark.conf.set(_PROGRESS_KEPT, "1000000")  # the report adds up all batches of a backlog
    try:
        for kind in present:
            queries[kind] = _writer(spark, config, kind, version, where.get(kind)).trigger(
                availableNow=True).start()
        for query in queries.values():
            query.awaitTermination()
    finally:
        for query in queries.values():
            if query.isActive:
                query.stop()
        spark.conf.set(_PROGRESS_KEPT, kept)
    rows = {kind: sum(p.numInputRows for p in query.recentProgress)
            for kind, query in queries.items()}
    return RunReport(version, rows, tuple(k for k in TABLE_KINDS if k not in present))


def run(spark: SparkSession, config: PipelineConfig,
        where: dict[str, Column] | None = None) -> RunReport | dict[str, StreamingQuery]:
    """Redact what is new.

    Triggered mode processes all new files, builds the trace view and returns a report.
    Continuous mode returns the running queries. ``where`` keeps only some rows of a table.
    """
    version = current_version(spark, config)
    first = version is None
    if first:  # go on with a first run that failed; its checkpoints know what is done
        version = max(_versions(spark, config), default=1)
    _check_policy(spark, config, version)
    if config.mode == "continuous":
        _mark_ready(spark, config, version)
        return {kind: _writer(spark, config, kind, version, (where or {}).get(kind)).trigger(
            processingTime=config.trigger_interval).start() for kind in _present(spark, config)}
    report = _process(spark, config, version, where or {})
    if first:
        _mark_ready(spark, config, version)
    publish_view(spark, config)
    return report


def full_refresh(spark: SparkSession, config: PipelineConfig, allow_loss: bool = False,
                 where: dict[str, Column] | None = None) -> RunReport:
    """Redact everything again into a new version, for example after a change of the policy.

    Days whose raw rows have expired cannot be redacted again. They are refused unless
    ``allow_loss`` is set.
    """
    old = current_version(spark, config)
    if old is not None and not allow_loss:
        for kind in _present(spark, config):
            if "date" not in BY_KIND[kind].names:
                continue
            lost = (table_days(spark, redacted_path(spark, config, kind))
                    - table_days(spark, config.raw_path(kind)))
            if lost:
                raise ValueError(f"raw {kind} no longer hold {len(lost)} redacted days, the first of "
                                 f"them {min(lost)}; a full refresh would lose them")
    version = max(_versions(spark, config), default=0) + 1
    _check_policy(spark, config, version)
    report = _process(spark, config, version, where or {})
    _mark_ready(spark, config, version)
    publish_view(spark, config)
    return report


def trace_view(spark: SparkSession, config: PipelineConfig, now: bool = True,
               where: Column | None = None) -> DataFrame:
    """The unified view of the current version, of all traces or those that ``where`` chooses.

    Give ``where`` on trace_id and date, so that whole traces are chosen.
    """
    if now:
        spans = read_redacted(spark, config, "spans")
        return trace_unified(spans if where is None else spans.where(where),
                             read_redacted(spark, config, "annotations"))
    if where is not None:
        raise ValueError("filter the view itself if it is sized when read")
    return trace_unified(_with_row_id(spark, config, "spans"),
                         _with_row_id(spark, config, "annotations"), now=False, row_id="row_id")


def publish_view(spark: SparkSession, config: PipelineConfig) -> None:
    """Name the unified view for SQL users of this session; nothing is read before they query it."""
    trace_view(spark, config, now=False).createOrReplaceTempView(config.unified_name)

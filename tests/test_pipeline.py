import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from spanveil import PipelineConfig, Policy
from spanveil.operators.layout import compact
from spanveil.operators.retention import expire, expire_table, keep, plan_expiry
from spanveil.plans.catalog import create_raw_table, publish_tables
from spanveil.sources.samples import annotations_from_labels, logs_from_documents, spans_from_events
from spanveil.sources.tables import check_sources
from spanveil.streaming.pipeline import (current_version, full_refresh, read_redacted, redact_kind,
                                         redacted_path, run, trace_view)


@pytest.fixture
def config(tmp_path):
    return PipelineConfig(source_root=str(tmp_path / "lake"), source_schema="raw",
                          target_root=str(tmp_path / "lake"), target_schema="clean",
                          table_prefix="app", retention_days=10)


def write(df, path, mode="append"):
    df.repartition("date").write.mode(mode).partitionBy("date").parquet(path)


@pytest.fixture
def filled(config, table):
    write(spans_from_events(table("events")), config.raw_path("spans"))
    write(logs_from_documents(table("documents")), config.raw_path("logs"))
    return config


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_missing_table_is_reported(spark, filled):
    states = {s.kind: s.rows for s in check_sources(spark, filled)}
    assert states == {"spans": 1000, "logs": 200, "annotations": None}


def test_triggered_runs_read_only_what_is_new(spark, filled, table):
    report = run(spark, filled)
    assert report.rows == {"spans": 1000, "logs": 200} and report.missing == ("annotations",)
    assert run(spark, filled).rows == {"spans": 0, "logs": 0}

    late = spans_from_events(table("events").where("event_id < 10").withColumn(
        "event_id", F.col("event_id") + 100000))
    write(late, filled.raw_path("spans"))
    annotations_from_labels(table("labels")).write.parquet(filled.raw_path("annotations"))
    report = run(spark, filled)
    assert report.rows["spans"] == 10 and report.rows["annotations"] > 0

    for kind in ("spans", "logs", "annotations"):
        batch = redact_kind(spark.read.parquet(filled.raw_path(kind)), filled, kind)
        assert rows(read_redacted(spark, filled, kind)) == rows(batch)
    view = spark.table(filled.unified_name)
    assert rows(view) == rows(trace_view(spark, filled))
    assert rows(view.where("trace_id = '7'")) == rows(trace_view(spark, filled, where=F.col("trace_id") == "7"))
    assert view.agg(F.sum(F.size("spans"))).first()[0] == 1010
    assert view.columns[:6] == ["trace_id", "date", "request_time_nano",
                                "execution_duration_nano", "spans", "annotations"]


def test_expiry_between_runs_keeps_redacted_rows(spark, filled):
    run(spark, filled)
    as_of = dt.date(2024, 1, 20)
    redacted = {k: read_redacted(spark, filled, k) for k in ("spans", "logs")}
    dropped = expire(spark, filled, as_of, redacted=redacted)
    assert dropped["spans"][0] == dt.date(2024, 1, 1)
    assert dropped["spans"][-1] == dt.date(2024, 1, 9)  # the cutoff day itself stays
    assert run(spark, filled).rows == {"spans": 0, "logs": 0}
    assert read_redacted(spark, filled, "spans").count() == 1000
    with pytest.raises(ValueError, match="lose"):
        full_refresh(spark, filled)
    report = full_refresh(spark, filled, allow_loss=True)
    left = spark.read.parquet(filled.raw_path("spans")).count()
    assert report.rows["spans"] == left == read_redacted(spark, filled, "spans").count() < 1000


def test_expiry_refuses_unredacted_rows(spark, filled):
    empty = {k: read_none(spark, filled, k) for k in ("spans", "logs")}
    with pytest.raises(ValueError, match="not redacted"):
        expire(spark, filled, dt.date(2024, 1, 20), redacted=empty)


def read_none(spark, config, kind):
    return spark.read.parquet(config.raw_path(kind)).where("false")


def test_table_without_day_folders(spark, config, table):
    logs_from_documents(table("documents")).write.parquet(config.raw_path("logs"))
    with pytest.raises(ValueError, match="not partitioned"):
        expire(spark, config, dt.date(2024, 1, 20))
    assert run(spark, config).rows == {"logs": 200}
    assert full_refresh(spark, config).rows == {"logs": 200}


def test_full_refresh_applies_a_new_policy(spark, filled):
    run(spark, filled)
    assert current_version(spark, filled) == 1
    changed = PipelineConfig(**{**filled.__dict__, "policy": Policy(categories=())})
    full_refresh(spark, changed)
    assert current_version(spark, changed) == 2
    text = read_redacted(spark, changed, "spans").select(F.max("attributes")).first()[0]
    assert "[" not in text.replace("[\"first\"", "")
    assert run(spark, changed).rows == {"spans": 0, "logs": 0}
    with pytest.raises(ValueError, match="full_refresh"):
        run(spark, filled)


def test_interrupted_refresh_is_not_used(spark, filled):
    run(spark, filled)
    pathlib.Path(f"{filled.target_path}/v2").mkdir()
    assert current_version(spark, filled) == 1
    assert full_refresh(spark, filled).version == 3


def test_continuous_mode(spark, filled, table):
    config = PipelineConfig(**{**filled.__dict__, "mode": "continuous",
                               "trigger_interval": "0 seconds"})
    queries = run(spark, config)
    try:
        queries["spans"].processAllAvailable()
        write(spans_from_events(table("events").where("event_id < 5")), filled.raw_path("spans"))
        queries["spans"].processAllAvailable()
    finally:
        for query in queries.values():
            query.stop()
    assert read_redacted(spark, config, "spans").count() == 1005


def test_a_backlog_is_read_in_steps(spark, filled):
    config = PipelineConfig(**{**filled.__dict__, "max_bytes_per_trigger": 30_000})
    assert run(spark, config).rows == {"spans": 1000, "logs": 200}
    log = pathlib.Path(f"{filled.target_path}/v1/_checkpoints/redacted_spans/commits")
    assert len([f for f in log.iterdir() if f.name.isdigit()]) > 3
    assert read_redacted(spark, config, "spans").count() == 1000


def test_rows_can_be_filtered_before_masking(spark, filled):
    run(spark, filled, where={"spans": F.col("name") == "click"})
    names = read_redacted(spark, filled, "spans").select("name").distinct().collect()
    assert [r.name for r in names] == ["click"]


def test_published_tables(spark, filled):
    run(spark, filled)
    assert publish_tables(spark, filled) == ["clean.redacted_spans", "clean.redacted_logs"]
    assert spark.table("clean.redacted_spans").count() == 1000
    described = {r.col_name: r.data_type for r in spark.sql(
        "DESCRIBE TABLE EXTENDED clean.redacted_spans").collect()}
    assert described["Comment"] == "Spans without personal data"


def test_expiry_of_a_catalog_table(spark, filled):
    name = create_raw_table(spark, filled, "logs")
    before = spark.table(name).count()
    dropped = expire_table(spark, name, 10, dt.date(2024, 1, 20))
    assert dropped[0] == dt.date(2024, 1, 1) and dropped[-1] == dt.date(2024, 1, 9)
    assert spark.table(name).where("date < '2024-01-10'").count() == 0
    assert 0 < spark.table(name).count() < before


@pytest.mark.parametrize("off", ["", "0", "none", "NEVER", None])
def test_retention_off(spark, table, off):
    spans = spans_from_events(table("events"))
    assert plan_expiry(spans, off, dt.date(2030, 1, 1)).count() == 0
    assert keep(spans, off, dt.date(2030, 1, 1)).count() == 1000


def test_rows_without_a_date_stay(spark):
    df = spark.sql("select explode(array(date'2024-01-09', date'2024-01-10', null)) as date")
    left = keep(df, 10, dt.date(2024, 1, 20))
    assert {r.date for r in left.collect()} == {dt.date(2024, 1, 10), None}


def test_compaction_keeps_rows_and_orders_them(spark, filled, tmp_path):
    run(spark, filled)
    source, target = redacted_path(spark, filled, "spans"), str(tmp_path / "clustered")
    assert compact(spark, source, target, file_bytes=20_000) > 1
    copy = spark.read.schema(read_redacted(spark, filled, "spans").schema).parquet(target)
    assert rows(copy) == rows(read_redacted(spark, filled, "spans"))
    files = copy.groupBy(F.input_file_name().alias("file"), "date").agg(
        F.min("trace_id").alias("low"), F.max("trace_id").alias("high"))
    by_date = {}
    for r in files.orderBy("date", "low").collect():
        by_date.setdefault(r.date, []).append((r.low, r.high))
    assert all(a[1] <= b[0] for spans in by_date.values() for a, b in zip(spans, spans[1:]))

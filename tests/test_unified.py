"""The maintained trace view: equal to the view of all rows, and computed for touched trace-days only."""
import pytest
from pyspark.sql import functions as F

from spanveil import PipelineConfig
from spanveil.sources.samples import annotations_from_labels, spans_from_events
from spanveil.streaming import unified
from spanveil.streaming.pipeline import full_refresh, run, trace_view


@pytest.fixture
def config(tmp_path):
    return PipelineConfig(source_root=str(tmp_path / "lake"), source_schema="raw", target_root=str(tmp_path / "lake"),
                          target_schema=f"clean_{tmp_path.name}", table_prefix="app")


def write(df, path):
    (df.write.mode("append").partitionBy("date") if "date" in df.columns else df.write.mode("append")).parquet(path)


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_only_touched_trace_days_are_computed(spark, config, table):
    spans = spans_from_events(table("events"))
    first = spans.where("cast(span_id as int) % 5 <> 0")
    write(first, config.raw_path("spans"))
    run(spark, config)
    with pytest.raises(ValueError):
        unified.read_unified(spark, config)
    (report,) = unified.maintain_view(spark, config, buckets=8)
    assert report.spans_read == first.count() and report.trace_days == first.select("trace_id", "date").distinct().count()
    assert rows(unified.read_unified(spark, config)) == rows(trace_view(spark, config))
    assert unified.maintain_view(spark, config) == []

    late = spans.where("cast(span_id as int) % 5 = 0").orderBy("start_time_unix_nano").limit(30)
    late = late.unionByName(late.limit(1).withColumn("date", F.lit(None).cast("date")).withColumn("trace_id", F.lit(None).cast("string")))
    write(late, config.raw_path("spans"))
    run(spark, config)
    (report,) = unified.maintain_view(spark, config)
    keys = late.select("trace_id", "date").distinct()
    both = first.unionByName(late)
    same = [both[k].eqNullSafe(keys[k]) for k in ("trace_id", "date")]
    assert report.trace_days == keys.count() and report.spans_read == both.join(keys, same, "left_semi").count() < both.count()
    assert {day for day, _ in report.folders} == {r.date for r in keys.collect()}
    assert rows(unified.read_unified(spark, config)) == rows(trace_view(spark, config))

    write(annotations_from_labels(table("labels")), config.raw_path("annotations"))
    run(spark, config)
    (report,) = unified.maintain_view(spark, config)
    assert report.kind == "annotations" and 0 < report.spans_read < both.count()
    assert rows(unified.read_unified(spark, config)) == rows(trace_view(spark, config))

    name = unified.publish_unified(spark, config)
    assert rows(spark.newSession().table(name)) == rows(trace_view(spark, config))
    assert spark.table(name).columns == ["trace_id", "date", "request_time_nano", "execution_duration_nano", "spans", "annotations", "part"]
    day = late.agg(F.max("date")).first()[0]
    scan = spark.table(name).where(F.col("date") == day)
    assert scan.count() == trace_view(spark, config).where(F.col("date") == day).count()
    assert len(scan.inputFiles()) >= 1 and "PartitionFilters: [isnotnull(date" in scan._jdf.queryExecution().toString()
    assert unified.vacuum_view(spark, config, keep=1) >= 1
    assert rows(spark.newSession().table(name)) == rows(unified.read_unified(spark, config)) == rows(trace_view(spark, config))


def test_a_batch_that_died_before_its_commit_is_run_again(spark, config, table, monkeypatch):
    write(spans_from_events(table("events")), config.raw_path("spans"))
    run(spark, config)
    commit = unified._commit

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(unified, "_commit", dies)
    with pytest.raises(Exception):
        unified.maintain_view(spark, config)
    monkeypatch.setattr(unified, "_commit", commit)
    unified.maintain_view(spark, config)
    assert rows(unified.read_unified(spark, config)) == rows(trace_view(spark, config))
    # a manifest that was cut off is passed over; two writers can't take one number
    base = unified._base(spark, config)
    fs, place = unified.file_system(spark, f"{base}/_manifests/{9:012d}.json")
    fs.create(place, False).close()
    found = unified.manifest(spark, base)
    assert found.number == 1
    with pytest.raises(Exception):
        unified._commit(spark, base, found)
    full_refresh(spark, config)
    with pytest.raises(ValueError):
        unified.read_unified(spark, config)
    unified.maintain_view(spark, config)
    assert rows(unified.read_unified(spark, config)) == rows(trace_view(spark, config))

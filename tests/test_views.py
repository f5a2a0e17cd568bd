import collections

import pytest
from pyspark.sql import functions as F

from spanveil import Policy
from spanveil.operators.compare import raw_vs_redacted, unredacted_rows
from spanveil.operators.layout import cluster
from spanveil.operators.redact import redact_spans
from spanveil.plans.trace_view import annotations_by_target, trace_unified, trace_unified_tags
from spanveil.sources.samples import annotations_from_labels, spans_from_events, tags_from_labels


@pytest.fixture(scope="module")
def skewed(spark, table, tmp_path_factory):
    """A third of all spans belong to one trace and day, and some of them are exact copies."""
    events = table("events")
    hot = events.limit(400).withColumn("user_id", F.lit(1).cast("long")).withColumn(
        "ts", F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"))
    copies = hot.limit(1).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(100)))).drop("copy")
    path = str(tmp_path_factory.mktemp("skewed") / "spans")
    redact_spans(spans_from_events(events.union(hot).union(copies)), Policy()).repartition(16).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def annotations(spark, table):
    base = annotations_from_labels(table("labels"))
    many = spark.range(50).select(F.lit(1).cast("long").alias("doc_id"), F.col("id").cast("int").alias("quality"),
                                  F.lit(0).alias("toxic"))
    orphan = spark.range(3).select(F.lit(None).cast("long").alias("doc_id"), F.lit(1).alias("quality"),
                                   F.lit(1).alias("toxic"))
    return base.union(annotations_from_labels(many)).union(annotations_from_labels(orphan))


def brute_force(spans, annotations):
    attached = collections.defaultdict(list)
    for a in annotations.collect():
        if a.target_id is not None:
            attached[a.target_id].append(a.annotation_id)
    traces = collections.defaultdict(list)
    for s in spans.collect():
        traces[s.trace_id, s.date].append(s)
    return {key: (min(s.start_time_unix_nano for s in rows),
                  max(s.end_time_unix_nano for s in rows) - min(s.start_time_unix_nano for s in rows),
                  sorted(s.span_id for s in rows), sorted(attached[key[0]]))
            for key, rows in traces.items()}


def gathered(view):
    result = {}
    for r in view.collect():
        key = (r.trace_id, r.date)
        old = result.get(key, (r.request_time_nano, r.execution_duration_nano, [], []))
        assert old[:2] == (r.request_time_nano, r.execution_duration_nano)
        assert r.annotations is None or r.annotations
        result[key] = (*old[:2], old[2] + [s.span_id for s in r.spans],
                       old[3] + [a.annotation_id for a in r.annotations or []])
    return {k: (a, b, sorted(c), sorted(d)) for k, (a, b, c, d) in result.items()}


@pytest.mark.parametrize("max_list", [10_000, 20, 1])
def test_unified_view(skewed, annotations, max_list):
    assert gathered(trace_unified(skewed, annotations, max_list)) == brute_force(skewed, annotations)


@pytest.mark.parametrize("max_list", [10_000, 20, 1])
def test_unified_view_sized_when_read(skewed, annotations, max_list):
    spans = skewed.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("row_id"))
    rated = annotations.withColumn("row_id", F.xxhash64("annotation_id", F.rand(7)))
    view = trace_unified(spans, rated, max_list, now=False, row_id="row_id")
    assert gathered(view) == brute_force(skewed, annotations)
    assert view.agg(F.max(F.size("spans"))).first()[0] <= max(3 * max_list, 10)
    plan = view.where("trace_id = '7' and date = '2024-01-05'")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and "parent_span_id" in line]
    assert scans and all("EqualTo(trace_id,7)" in line for line in scans)


def test_lists_are_bounded(skewed, annotations):
    view = trace_unified(skewed, annotations, max_list=50)
    longest, parts = view.agg(F.max(F.size("spans")), F.max("part")).first()
    assert longest <= 100 and parts >= 8
    assert view.agg(F.max(F.size("annotations"))).first()[0] <= 100


def test_lists_are_sorted(skewed, annotations):
    for r in trace_unified(skewed, annotations).collect():
        order = [(s.start_time_unix_nano, s.span_id) for s in r.spans]
        assert order == sorted(order)


def test_empty_tables(skewed, annotations):
    assert trace_unified(skewed.where("false"), annotations).count() == 0
    view = trace_unified(skewed, annotations.where("false"))
    assert view.where("annotations is not null").count() == 0


def test_null_trace_is_a_group(skewed, annotations):
    nulls = skewed.withColumn("trace_id", F.lit(None).cast("string"))
    for max_list in (10_000, 30):
        view = trace_unified(nulls, annotations, max_list)
        assert view.agg(F.sum(F.size("spans"))).first()[0] == skewed.count()
        assert view.groupBy("date").agg(F.count_distinct("request_time_nano").alias("n")).where("n > 1").isEmpty()


def test_annotation_lists(annotations):
    for max_list in (10_000, 10):
        lists = annotations_by_target(annotations, max_list)
        assert lists.agg(F.sum(F.size("annotations"))).first()[0] == annotations.count()
    assert lists.agg(F.max(F.size("annotations"))).first()[0] < 40


def test_view_filter_reaches_the_scan(skewed, annotations):
    plan = trace_unified(skewed, annotations).where("trace_id = '7'")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and "record" not in line and "start_time" in line]
    assert scans and all("EqualTo(trace_id,7)" in line for line in scans)


@pytest.mark.parametrize("max_list", [10_000, 7])
def test_tags_view_equals_the_plain_join(skewed, table, max_list):
    tags = tags_from_labels(table("labels"))
    view = trace_unified_tags(skewed, tags, max_list).select(
        "trace_id", "date", "request_time", "execution_duration", "tags", "assessments",
        F.explode("spans.span_id").alias("span_id"))
    bounds = skewed.groupBy("trace_id", "date").agg(
        F.timestamp_micros(F.expr("min(start_time_unix_nano) div 1000")).alias("request_time"),
        F.timestamp_micros(F.expr("max(end_time_unix_nano) div 1000")).alias("last"))
    plain = skewed.select("trace_id", "date", "span_id").join(
        tags, skewed["trace_id"] == tags["target_id"], "left").join(bounds, ["trace_id", "date"]).select(
        "trace_id", "date", "request_time", (F.col("last") - F.col("request_time")).alias("execution_duration"),
        "tags", "assessments", "span_id")
    assert view.exceptAll(plain).isEmpty() and plain.exceptAll(view).isEmpty()


def test_comparison_with_copies(skewed):
    raw = skewed.withColumn("attributes", F.concat(F.lit("raw "), "attributes"))
    counted = raw_vs_redacted(raw, skewed, where=F.col("attributes").isNotNull())
    plain = raw.where("attributes is not null").alias("a").join(skewed.alias("b"), ["trace_id", "span_id"]).select(
        "trace_id", "span_id", F.col("a.attributes").alias("raw"), F.col("b.attributes").alias("redacted"))
    pairs = {tuple(r)[:4]: r[4] for r in plain.groupBy(*plain.columns).count().collect()}
    assert pairs == {(r.trace_id, r.span_id, r.raw, r.redacted): r.raw_rows * r.redacted_rows for r in counted.collect()}
    first = raw_vs_redacted(raw, skewed, where=F.col("attributes").isNotNull(), limit=4).collect()
    assert [r.asDict() for r in first] == [
        r.asDict() for r in counted.orderBy("trace_id", "span_id", "raw", "redacted").limit(4).collect()]


def test_unredacted_rows(skewed):
    done = skewed.where("record_id != 'rec-3'")
    left = unredacted_rows(skewed, done)
    assert {r.record_id for r in left.collect()} == {"rec-3"}
    assert left.count() == skewed.where("record_id = 'rec-3'").count()


def test_a_hot_trace_is_clustered_into_several_files(skewed):
    sizes = cluster(skewed.where("trace_id = '1'"), 8).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 6

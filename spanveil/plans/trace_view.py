"""One row per trace and day, with its spans and the annotations attached to the trace."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nested import has_variant
from ..operators.split import oversized, spread

# The fields of a listed span and of a listed annotation, and the view's columns.
SPAN_FIELDS = ("span_id", "parent_span_id", "name", "kind", "start_time_unix_nano",
               "end_time_unix_nano", "status", "attributes", "events")
ANNOTATION_FIELDS = ("annotation_id", "annotation_type", "name", "value", "comment",
                     "created_at", "created_by")
VIEW_COLUMNS = ("trace_id", "date", "request_time_nano", "execution_duration_nano", "spans",
                "annotations")
MAX_LIST = 10_000


def _orderable(df: DataFrame, name: str, as_text: tuple[str, ...] = ()) -> Column:
    """A VARIANT has no order, so it is listed as text."""
    data_type = df.schema[name].dataType
    if isinstance(data_type, T.VariantType) or name in as_text:
        return F.col(name).cast("string").alias(name)
    if has_variant(data_type):
        return F.to_json(name).alias(name)
    return F.col(name)


def _sorted_item(df: DataFrame, order: tuple[str, str], fields: tuple[str, ...],
                 as_text: tuple[str, ...] = ()) -> Column:
    return F.struct(F.struct(*order).alias("position"),
                    F.struct(*(_orderable(df, f, as_text) for f in fields)).alias("item"))


def _span_item(spans: DataFrame) -> Column:
    return _sorted_item(spans, ("start_time_unix_nano", "span_id"), SPAN_FIELDS)


def _annotation_item(annotations: DataFrame) -> Column:
    return _sorted_item(annotations, ("created_at", "annotation_id"), ANNOTATION_FIELDS, ("value",))


def _listed(items: str) -> Column:
    return F.sort_array(F.collect_list(items))["item"]


def _part(number: Column, parts: str) -> Column:
    return F.coalesce(F.pmod(number, F.col(parts)), F.lit(0)).cast("int")


def annotations_by_target(annotations: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """The annotations of each target as sorted lists of bounded length."""
    rows = annotations.select("target_id", _annotation_item(annotations).alias("annotation"),
                              spread("annotation_id", "created_at").alias("spread"))
    parts = oversized(annotations.groupBy("target_id").agg(F.count("*").alias("n")), max_list)
    if parts is None:
        rows = rows.withColumn("part", F.lit(0))
    else:
        same = rows["target_id"].eqNullSafe(parts["target_id"])  # null is a group too
        rows = rows.join(parts, same, "left").select(
            rows["target_id"], "annotation", _part(F.col("spread"), "parts").alias("part"))
    return rows.groupBy("target_id", "part").agg(_listed("annotation").alias("annotations"))


def trace_unified(spans: DataFrame, annotations: DataFrame, max_list: int = MAX_LIST,
                  now: bool = True, row_id: str | None = None) -> DataFrame:
    """The unified trace view, plus the number of the part.

    Nearly all traces have one row, with part 0. A trace-day with more than ``max_list`` spans
    or annotations is spread over several rows with one part of the lists each, so that
    no list grows without bound; every span and annotation is in exactly one of them, and all of
    them carry the times of the whole trace.

    Spans and annotations meet in one grouping instead of a join of finished lists. With ``now``,
    for reading all traces, large trace-days are found first by a scan of the key and time columns,
    and the wide span rows are shuffled once. Without it nothing runs before the view is read; it needs
    ``row_id``, a column that tells equal rows apart, and shuffles the spans that it reads twice.
    Filters on trace and day then reach the scan of the wide span rows, but not the one that finds
    large trace-days. For a lookup, better filter ``spans`` before the call.
    """
    if not now and row_id is None:
        raise ValueError("a view that is sized when read needs a row_id")
    keys = ["trace_id", "date"]
    days = spans.groupBy(*keys).agg(
        F.min("start_time_unix_nano").alias("first_start"),
        F.max("end_time_unix_nano").alias("last_end"),
        F.count("*").alias("n"))
    large_days = oversized(days, max_list, now)
    large_targets = oversized(
        annotations.groupBy("target_id").agg(F.count("*").alias("n")), max_list, now)

    span_rows = spans.select(
        *keys, F.col("start_time_unix_nano").alias("first_start"),
        F.col("end_time_unix_nano").alias("last_end"), _span_item(spans).alias("span"),
        *([] if large_days is None else
          [spread(*(c for c in ("record_id", "span_id", "start_time_unix_nano")
                    if c in spans.columns), row_id=row_id).alias("spread")]))
    if large_days is None:
        span_rows = span_rows.withColumn("part", F.lit(0))
    else:
        bounds = large_days.select(*(F.col(k).alias(f"large_{k}") for k in keys), "parts",
                                   F.col("first_start").alias("day_start"),
                                   F.col("last_end").alias("day_end"))
        # Null keys form a group of their own, so they must meet their bounds too.
        matched = [F.col(k).eqNullSafe(F.col(f"large_{k}")) for k in keys]
        span_rows = span_rows.join(bounds, matched, "left").select(
            *keys,
            F.when(F.col("parts").isNull(), F.col("first_start")).otherwise(
                F.col("day_start")).alias("first_start"),
            F.when(F.col("parts").isNull(), F.col("last_end")).otherwise(
                F.col("day_end")).alias("last_end"),
            "span", _part(F.col("spread"), "parts").alias("part"))

    annotation_rows = annotations.where(F.col("target_id").isNotNull()).select(
        "target_id", _annotation_item(annotations).alias("annotation"),
        *([] if large_targets is None else
          [spread("annotation_id", "created_at", row_id=row_id).alias("spread")]))
    if large_targets is None:
        annotation_rows = annotation_rows.withColumn("part", F.lit(0))
    else:
        annotation_rows = annotation_rows.join(
            large_targets.select("target_id", "parts"), "target_id", "left").withColumn(
            "part", _part(F.col("spread"), "parts"))
    annotation_rows = annotation_rows.join(
        days, annotation_rows["target_id"] == days["trace_id"]).select(
        *keys, "first_start", "last_end", "annotation", "part")

    rows = span_rows.unionByName(annotation_rows, allowMissingColumns=True)
    if not now:
        # Else the join above and the grouping would share a shuffle by trace and day, with all
        # parts of a large trace in one task.
        rows = rows.repartition(*keys, "part")
    grouped = rows.groupBy(*keys, "part").agg(
        F.min("first_start").alias("request_time_nano"),
        (F.max("last_end") - F.min("first_start")).alias("execution_duration_nano"),
        _listed("span").alias("spans"),
        _listed("annotation").alias("annotations"))
    return grouped.withColumn(
        "annotations", F.when(F.size("annotations") > 0, F.col("annotations"))).select(
        *VIEW_COLUMNS, "part")


def trace_unified_tags(spans: DataFrame, annotations: DataFrame,
                       max_list: int = MAX_LIST) -> DataFrame:
    """The earlier form of the view: timestamps, and one row per distinct (tags, assessments).

    It joins spans to raw annotations, so n equal annotations list every span n times.
    Equal annotations are counted before the join and the finished list is repeated, which
    gives the same rows without building all pairs. Lists longer than ``max_list`` continue
    in further parts.
    """
    keys = ["trace_id", "date"]
    sizes = spans.groupBy(*keys).agg(
        F.min("start_time_unix_nano").alias("first_start"),
        F.max("end_time_unix_nano").alias("last_end"), F.count("*").alias("n"))
    large = oversized(sizes, max_list)
    rows = spans.select(*keys, "start_time_unix_nano", "end_time_unix_nano",
                        _timed_span_item(spans).alias("span"),
                        spread("span_id", "start_time_unix_nano").alias("spread"))
    if large is None:
        rows = rows.drop("spread").select(
            "*", F.lit(0).alias("part"), F.lit(None).cast("long").alias("day_start"),
            F.lit(None).cast("long").alias("day_end"))
    else:
        bounds = large.select(*keys, "parts", F.col("first_start").alias("day_start"),
                              F.col("last_end").alias("day_end"))
        rows = rows.join(bounds, [rows[k].eqNullSafe(bounds[k]) for k in keys], "left").select(
            *(rows[k] for k in keys), "start_time_unix_nano", "end_time_unix_nano", "span",
            _part(F.col("spread"), "parts").alias("part"), "day_start", "day_end")
    traces = rows.groupBy(*keys, "part").agg(
        F.coalesce(F.min("day_start"), F.min("start_time_unix_nano")).alias("first_start"),
        F.coalesce(F.max("day_end"), F.max("end_time_unix_nano")).alias("last_end"),
        F.sort_array(F.collect_list("span")).alias("items"))

    counted = annotations.groupBy("target_id", "tags", "assessments").agg(
        F.count("*").alias("copies"))
    joined = traces.join(counted, traces["trace_id"] == counted["target_id"], "left")

    # How many copies of the list one output row holds, and how many rows that takes.
    copies = F.coalesce(F.col("copies"), F.lit(1))
    per_row = F.greatest(F.lit(1), F.floor(F.lit(max_list) / F.size("items"))).cast("long")
    started = joined.withColumn("per_row", per_row).withColumn(
        "copy_start", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1, F.col("per_row"))))
    repeated = F.least(F.col("per_row"), copies - F.col("copy_start")).cast("int")
    start, end = _timestamp("first_start"), _timestamp("last_end")
    return started.select(
        *keys, start.alias("request_time"), (end - start).alias("execution_duration"),
        F.sort_array(F.flatten(F.array_repeat("items", repeated)))["item"].alias("spans"),
        "tags", "assessments", "part", "copy_start")


def _timestamp(nanos: str) -> Column:
    return F.timestamp_micros(F.call_function("div", F.col(nanos), F.lit(1000)))


def _timed_span_item(spans: DataFrame) -> Column:
    fields = [_timestamp(f).alias(f.removesuffix("_unix_nano")) if f.endswith("_unix_nano")
              else _orderable(spans, f) for f in SPAN_FIELDS]
    return F.struct(F.struct("start_time_unix_nano", "span_id").alias("position"),
                    F.struct(*fields).alias("item"))

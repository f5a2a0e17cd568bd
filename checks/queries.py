"""One query per operator; each reads the whole tables of a folder."""
from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanveil import PipelineConfig, Policy
from spanveil.config import CATEGORIES
from spanveil.functions.masking import mask_text
from spanveil.functions.model import model_column
from spanveil.functions.names import mask_listed_names
from spanveil.functions.nested import mask_json_text
from spanveil.functions.tagger import learn_names
from spanveil.operators.compare import raw_vs_redacted, unredacted_rows
from spanveil.operators.layout import cluster
from spanveil.operators.quality import coverage, leak_scan, recall
from spanveil.operators.redact import redact_annotations, redact_logs, redact_spans
from spanveil.operators.retention import expire, expire_table, keep, plan_expiry
from spanveil.plans.catalog import create_raw_table, publish_tables
from spanveil.plans.masked_view import masked_spans_view
from spanveil.plans.trace_view import annotations_by_target, trace_unified, trace_unified_tags
from spanveil.shared import shared_folder
from spanveil.sources.prompts import prompts_to_spans, read_prompts
from spanveil.sources.samples import (annotations_from_labels, logs_from_documents,
                                      notes_from_orders, spans_from_events, tags_from_labels)
from spanveil.sources.tables import check_sources, spread
from spanveil.streaming.pipeline import full_refresh, read_redacted, run
from spanveil.streaming.unified import maintain_view, publish_unified

DEFAULT = Policy()
EVERYTHING = Policy(CATEGORIES, {"employee_id": r"EMP-\d{6}"})
SALT = "a secret of the user"
AS_OF = dt.date(2024, 1, 25)
RETENTION = 10
SECRET = r'(?:api_key|token|secret|password) ?[=:] ?"?[0-9a-zA-Z]{16,}"?'

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # the tables hold times without a zone
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))


def _spans(spark, folder):
    return spans_from_events(_table(spark, folder, "events"))


def _logs(spark, folder):
    return logs_from_documents(_table(spark, folder, "documents"))


def _annotations(spark, folder):
    return annotations_from_labels(_table(spark, folder, "labels"))


def _notes(spark, folder):
    return notes_from_orders(_table(spark, folder, "orders"))


# --- text

def _documents(policy: Policy) -> Query:
    def query(spark, folder):
        return _table(spark, folder, "documents").select(
            "doc_id", "source", mask_text(F.col("text"), policy).alias("text"))
    return query


def _pages(policy: Policy) -> Query:
    def query(spark, folder):
        return _table(spark, folder, "pages").select(
            "page_id", mask_text(F.col("url"), policy).alias("url"),
            mask_text(F.col("html"), policy).alias("html"))
    return query


def _masked_notes(policy: Policy) -> Query:
    def query(spark, folder):
        return _notes(spark, folder).select("note_id", mask_text(F.col("text"), policy).alias("text"))
    return query


def hits_by_source(spark, folder):
    """Masked documents and replaced values per source."""
    masked = mask_text(F.col("text"), DEFAULT)
    changed = _table(spark, folder, "documents").select("source", "text", masked.alias("masked"))
    return changed.groupBy("source").agg(
        F.count("*").alias("documents"), F.count_if(F.col("masked") != F.col("text")).alias("masked_documents"),
        F.sum(F.regexp_count("masked", F.lit(r"\[(?:EMAIL|PHONE|SSN|CREDIT_CARD|ADDRESS|NAME)\]"))).alias("values"))


def listed_names(spark, folder):
    """The list is made of the customers' names in the notes themselves."""
    notes = _notes(spark, folder)
    listed = notes.where(F.col("note_kind") == 1).select("name")
    policy = Policy(categories=())
    return mask_listed_names(notes.select("note_id", "text"), "text", listed, policy, "note_id")


def listed_names_joined(spark, folder):
    notes = _notes(spark, folder)
    listed = notes.where(F.col("note_kind") == 1).select("name")
    return mask_listed_names(notes.select("note_id", "text"), "text", listed,
                             Policy(categories=()), slice_names=100)


def listed_names_any_length(spark, folder):
    """Names of four and five words with small particles; some rows have no key."""
    number = F.col("c_custkey")
    letters = F.concat(F.lit("K"), F.translate(number.cast("string"), "0123456789", "abcdefghij"))
    name = F.when(number % 2 == 0, F.concat(F.lit("Anna van der "), letters)).otherwise(
        F.concat(F.lit("Maria del Carmen "), letters, F.lit(" Garcia")))
    people = _table(spark, folder, "customer").select(number.alias("id"), name.alias("name"))
    texts = people.select(F.when(F.col("id") % 5 != 0, F.col("id")).alias("note_id"), F.concat(
        F.lit("Case "), "id", F.lit(": spoke with "), "name", F.lit("'s agent and maria del carmen, not Anna van Dam.")).alias("text"))
    return mask_listed_names(texts, "text", people.where("id % 3 <> 0").select("name"), Policy(categories=()))


def _digit_model():
    """A stand-in for a user's model."""
    return lambda texts: texts.str.replace(r"[0-9]+", "#", regex=True)


def masked_by_model(spark, folder):
    return _table(spark, folder, "documents").select(
        "doc_id", model_column(F.col("text"), _digit_model).alias("text"))


# --- nested values

def leaf_mask_attributes(spark, folder):
    return redact_spans(_spans(spark, folder), EVERYTHING).select("span_id", "attributes")


def allowlisted_paths(spark, folder):
    policy = Policy(CATEGORIES, allowlisted_paths=('"app.user"', "nested.client", "nested.none[*].x"))
    return redact_spans(_spans(spark, folder), policy).select("span_id", "attributes")


def allowlisted_keys(spark, folder):
    policy = Policy(CATEGORIES, allowlisted_keys=("app.user", "service.name"))
    return redact_spans(_spans(spark, folder), policy).select("span_id", "attributes")


def mask_events(spark, folder):
    return redact_spans(_spans(spark, folder), DEFAULT).select("span_id", "events")


def mask_events_cast(spark, folder):
    return redact_spans(_spans(spark, folder), Policy(events_as="cast")).select("span_id", "events")


def mask_resource(spark, folder):
    return redact_spans(_spans(spark, folder), DEFAULT).select(
        "span_id", F.col("resource").isNull().alias("no_resource"),
        F.col("resource.attributes").alias("resource_attributes"),
        F.col("resource.dropped_attributes_count").alias("resource_dropped"))


def mask_resource_variant(spark, folder):
    """A resource that arrives as one VARIANT."""
    spans = _spans(spark, folder).withColumn("resource", F.parse_json(F.to_json("resource")))
    return redact_spans(spans, DEFAULT).select(
        "span_id", F.col("resource").isNull().alias("no_resource"),
        F.col("resource.attributes").alias("resource_attributes"),
        F.col("resource.dropped_attributes_count").alias("resource_dropped"))


def mask_json_strings(spark, folder):
    """Attributes that arrive as JSON text instead of VARIANT."""
    text = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.concat(
        F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@mail.example.com")).alias("mail"),
        F.struct(F.concat(F.lit("line one\n+1 (555) 010-"), F.lpad(
            (F.col("c_custkey") % 10000).cast("string"), 4, "0")).alias("note")).alias("nested")))
    return _table(spark, folder, "customer").select("c_custkey", text.alias("json")).select(
        "c_custkey", mask_json_text(F.col("json"), DEFAULT).alias("json"))


# --- tables

def _flat(df: DataFrame) -> DataFrame:
    """Struct and array columns as plain ones, so that results compare by value."""
    columns: list[Column] = []
    for name in df.columns:
        if name == "resource":
            columns += [F.col("resource.attributes").alias("resource_attributes"),
                        F.col("resource.dropped_attributes_count").alias("resource_dropped")]
        elif name == "status":
            columns.append(F.col("status.code").alias("status_code"))
        elif name in ("links", "instrumentation_scope"):
            columns.append(F.to_json(name).alias(name))
        elif name == "time":
            columns.append(F.unix_micros("time").alias("time_micros"))
        else:
            columns.append(F.col(name))
    return df.select(*columns)


def redacted_spans(spark, folder):
    return _flat(redact_spans(_spans(spark, folder), DEFAULT))


def redacted_logs(spark, folder):
    return _flat(redact_logs(_logs(spark, folder), DEFAULT))


def _annotation_values(df: DataFrame) -> DataFrame:
    return df.select(
        "target_id", "annotation_id", "annotation_type", "name",
        F.col("value").cast("string").alias("value"), "comment",
        F.unix_micros("created_at").alias("created_micros"), "created_by")


def redacted_annotations(spark, folder):
    return _annotation_values(redact_annotations(_annotations(spark, folder), DEFAULT))


def unmasked_spans(spark, folder):
    """An empty list of categories: only the casts."""
    return _flat(redact_spans(_spans(spark, folder), Policy(categories=())))


def more_fields(spark, folder):
    """Further columns may be masked, such as the status or a comment."""
    fields = ("created_by", "comment", "value")
    policy = Policy((), {"rater": "rater", "label": "toxic"})
    return redact_annotations(_annotations(spark, folder), policy, fields).select(
        "annotation_id", "name", "comment", "created_by", "value")


def trace_filter(spark, folder):
    return redact_spans(_spans(spark, folder), DEFAULT, where=F.col("name") == "error").select(
        "span_id", "name", "attributes")


def redacted_view(spark, folder):
    return _flat(masked_spans_view(_spans(spark, folder), DEFAULT))


# --- views

def _span_text(span: Column) -> Column:
    parts = ("span_id", "parent_span_id", "name", "kind", "attributes", "events")
    return F.concat_ws("|", *(F.coalesce(span[p], F.lit("-")) for p in parts))


def trace_view(spark, folder):
    return _view_text(trace_unified(redact_spans(_spans(spark, folder), DEFAULT), _annotations(spark, folder)))


def _view_text(view: DataFrame) -> DataFrame:
    return view.select(
        "trace_id", "date", "request_time_nano", "execution_duration_nano",
        F.array_join(F.transform("spans", _span_text), ";").alias("spans"),
        F.array_join(F.transform("annotations", lambda a: F.concat_ws(
            "|", a["annotation_id"], a["name"], a["value"], a["comment"], a["created_by"])), ";").alias("annotations"),
        "part")


def trace_view_maintained(spark, folder):
    """The view kept up to date over two arrivals of spans, annotations with the second, read by its name in another session."""
    config = PipelineConfig(source_root=shared_folder(spark), source_schema="raw", target_root=shared_folder(spark),
                            target_schema=f"clean_{uuid.uuid4().hex}", table_prefix="app")
    spans = _spans(spark, folder)
    early = F.crc32("span_id") < 3_000_000_000
    _write(spans.where(early), config.raw_path("spans"))
    run(spark, config)
    maintain_view(spark, config, buckets=2)
    _write(spans.where(~early), config.raw_path("spans"))
    _annotations(spark, folder).write.parquet(config.raw_path("annotations"))
    run(spark, config)
    maintain_view(spark, config)
    return _view_text(spark.newSession().table(publish_unified(spark, config)))


def trace_view_parts(spark, folder):
    """Long lists in several parts: nothing is lost and all parts carry the times of the trace."""
    view = trace_unified(redact_spans(_spans(spark, folder), DEFAULT), _annotations(spark, folder),
                         max_list=2)
    each = view.select("trace_id", "date", "request_time_nano", "execution_duration_nano",
                       F.size("spans").alias("spans"),
                       F.coalesce(F.size("annotations"), F.lit(0)).alias("annotations"))
    return each.groupBy("trace_id", "date", "request_time_nano", "execution_duration_nano").agg(
        F.sum("spans").alias("spans"), F.sum(F.greatest("annotations", F.lit(0))).alias("annotations"))


def trace_view_tags(spark, folder):
    view = trace_unified_tags(redact_spans(_spans(spark, folder), DEFAULT),
                              tags_from_labels(_table(spark, folder, "labels")))
    return view.select(
        "trace_id", "date", F.unix_micros("request_time").alias("request_micros"),
        F.round(F.expr("extract(DAY FROM execution_duration) * 86400000000L"
                       " + extract(HOUR FROM execution_duration) * 3600000000L"
                       " + extract(MINUTE FROM execution_duration) * 60000000L"
                       " + extract(SECOND FROM execution_duration) * 1000000")).cast("long").alias(
            "duration_micros"),
        F.array_join(F.transform("spans", lambda s: s["span_id"]), ";").alias("spans"),
        "tags", "assessments")


def target_annotations(spark, folder):
    lists = annotations_by_target(_annotations(spark, folder))
    return lists.select("target_id", "part", F.array_join(F.transform(
        "annotations", lambda a: F.concat_ws("=", a["name"], a["value"])), ",").alias("annotations"))


# --- retention

def retention_keep(spark, folder):
    return keep(_spans(spark, folder), RETENTION, AS_OF).select("record_id", "date")


def retention_plan(spark, folder):
    return plan_expiry(_spans(spark, folder), RETENTION, AS_OF)


# --- checks

def compare_all(spark, folder):
    raw = _spans(spark, folder)
    return raw_vs_redacted(raw, redact_spans(raw, DEFAULT), where=F.col("attributes").isNotNull())


def compare_sample(spark, folder):
    raw = _spans(spark, folder)
    return raw_vs_redacted(raw, redact_spans(raw, DEFAULT), limit=5,
                           where=(F.col("name") == "error") & F.col("attributes").isNotNull())


def rows_not_redacted(spark, folder):
    raw = _spans(spark, folder)
    done = redact_spans(raw, DEFAULT, where=F.col("date") < "2024-01-20")
    return unredacted_rows(raw, done).select("record_id", "date")


def coverage_by_day(spark, folder):
    policy = Policy(("email", "phone", "ip_address", "credit_card"))
    return coverage(_logs(spark, folder), "body", policy, "logs")


def leaks(spark, folder):
    """Redacted for the default categories, scanned for all pattern categories."""
    return leak_scan(redact_logs(_logs(spark, folder), DEFAULT), Policy(("email", "phone", "credit_card", "ip_address", "ssn")), "logs")


def recall_by_category(spark, folder):
    """Every known value of the notes against the masked notes."""
    notes = _notes(spark, folder)
    known = ("email", "phone", "ssn", "credit_card", "date_of_birth", "ip_address", "address",
             "name", "account", "employee")
    truth = notes.select("note_id", "text", F.inline(F.array(*(F.struct(
        F.lit(k).alias("category"), F.col(k).alias("value"),
        F.lit(k not in ("account", "employee")).alias("sensitive")) for k in known)))).where(
        F.contains("text", "value")).drop("text")
    masked = notes.select("note_id", mask_text(F.col("text"), Policy(CATEGORIES)).alias("text"))
    return recall(truth, masked, "note_id", "text")


def names_without_cues(spark, folder):
    """Names that the tagger, learned from the notes, finds in the notes without their cue words."""
    notes = _notes(spark, folder)
    bare = notes.withColumn("bare", F.regexp_replace("text", r"\b(?:customer|for|Dr\.) (?=\p{Lu})", ""))
    masked = bare.select("note_id", model_column(F.col("bare"), learn_names(notes, "text")).alias("text"))
    truth = bare.select("note_id", "bare", F.inline(F.array(*(F.struct(
        F.lit(k).alias("category"), F.col(k).alias("value"), F.lit(k == "name").alias("sensitive"))
        for k in ("name", "address", "email", "account", "employee"))))).where(F.contains("bare", "value")).drop("bare")
    return recall(truth, masked, "note_id", "text")


# --- sources, streams, layout

def _conversation_records(spark, folder):
    """All turns: those of the assistant as responses to the turn before, others as prompts; either may lack the other."""
    turns = _table(spark, folder, "conversations")
    answer = F.coalesce(F.col("role") == "assistant", F.lit(False))
    questions = turns.where(~answer).select("conv_id", "turn", F.col("text").alias("prompt"))
    answers = turns.where(answer).select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    return questions.join(answers, ["conv_id", "turn"], "full")


def prompt_spans(spark, folder):
    records = _conversation_records(spark, folder).withColumn("line_number", F.col("turn").cast("int"))
    key = F.concat_ws("/", "conv_id", "turn")
    spans = prompts_to_spans(records, key, F.timestamp_seconds(F.lit(1704067200)))
    return redact_spans(spans, Policy(("email", "phone", "ssn", "credit_card"))).select(
        "trace_id", "span_id", "name", "date", "attributes",
        F.col("resource.attributes").alias("resource_attributes"))


def prompt_lines(spark, folder):
    """Records written as JSON lines and read back: each line with its number, from 1, in the order of its file."""
    path = shared_folder(spark)
    records = _conversation_records(spark, folder).repartition(3, "conv_id").sortWithinPartitions("conv_id", "turn")
    records.select(F.to_json(F.struct("prompt", "response", F.struct("conv_id", "turn").alias("own")), {"ignoreNullFields": "false"})
                   .alias("value")).write.text(path)
    own = spark.read.schema("prompt string, response string, own struct<conv_id: long, turn: long>").json(path).select(
        "own.*", "prompt", "response", F.col("_metadata.file_path").alias("file"))
    # the order of a file is that of the records that were written to it
    place = F.row_number().over(Window.partitionBy("file").orderBy("conv_id", "turn"))
    lines = read_prompts(spark, path)
    numbered = own.withColumn("line_number", place).join(
        lines.select("file", "line_number", F.col("prompt").alias("read_prompt"), F.col("response").alias("read_response")),
        ["file", "line_number"], "full")
    return numbered.select("conv_id", "turn", F.col("read_prompt").alias("prompt"), F.col("read_response").alias("response"))


def _filled_config(spark, folder, first: Column | None = None, **settings) -> PipelineConfig:
    """Raw tables written to the shared folder, by day; ``first`` chooses the logs that arrive first."""
    root = shared_folder(spark)
    config = PipelineConfig(**{"source_root": root, "source_schema": "raw", "target_root": root,
                               "target_schema": "clean", "table_prefix": "app", **settings})
    logs = _logs(spark, folder)
    _write(logs if first is None else logs.where(first), config.raw_path("logs"))
    _write(_spans(spark, folder), config.raw_path("spans"))
    _annotations(spark, folder).write.parquet(config.raw_path("annotations"))
    return config


def _write(df: DataFrame, path: str) -> None:
    # A day may hold any share of the rows, so a writer per day would not do. Each task writes a file for each of
    # its days, so the even parts that the rows were dealt to are joined, to one for each core.
    cores = df.sparkSession.sparkContext.defaultParallelism
    df.coalesce(cores).write.mode("append").partitionBy("date").parquet(path)


def stream_incremental(spark, folder):
    """Two runs over a growing table; each row is redacted once."""
    config = _filled_config(spark, folder, F.col("date") < "2024-01-15")
    run(spark, config)
    _write(_logs(spark, folder).where(F.col("date") >= "2024-01-15"), config.raw_path("logs"))
    run(spark, config)
    return read_redacted(spark, config, "logs").select("record_id", "date", "body", "attributes")


def stream_spans(spark, folder):
    """The spans as the pipeline wrote them."""
    config = _filled_config(spark, folder)
    run(spark, config)
    return _flat(read_redacted(spark, config, "spans"))


def stream_annotations(spark, folder):
    config = _filled_config(spark, folder)
    run(spark, config)
    return _annotation_values(read_redacted(spark, config, "annotations"))


def expire_spans(spark, folder):
    """Raw spans per day that are left after expiry."""
    config = _filled_config(spark, folder, retention_days=RETENTION)
    expire(spark, config, dt.date(2024, 1, 20))
    return spark.read.parquet(config.raw_path("spans")).groupBy("date").agg(F.count("*").alias("rows"))


def stream_full_refresh(spark, folder):
    """A new policy applied to everything."""
    config = _filled_config(spark, folder)
    run(spark, config)
    changed = PipelineConfig(**{**config.__dict__, "policy": Policy(("ip_address",), mode="remove")})
    full_refresh(spark, changed)
    return read_redacted(spark, changed, "logs").select("record_id", "date", "body", "attributes")


def stream_after_expiry(spark, folder):
    """Raw days that expire after a run stay in the redacted table."""
    config = _filled_config(spark, folder, retention_days=RETENTION)
    run(spark, config)
    expire(spark, config, dt.date(2024, 1, 20))
    run(spark, config)
    raw = spark.read.parquet(config.raw_path("logs")).groupBy("date").agg(F.count("*").alias("raw_rows"))
    redacted = read_redacted(spark, config, "logs").groupBy("date").agg(F.count("*").alias("redacted_rows"))
    return redacted.join(raw, "date", "left").select(
        "date", F.coalesce("raw_rows", F.lit(0)).alias("raw_rows"), "redacted_rows")


def published_tables(spark, folder):
    """The redacted logs by their name in the catalog."""
    config = _filled_config(spark, folder, target_schema=f"clean_{uuid.uuid4().hex}")
    run(spark, config)
    publish_tables(spark, config)
    logs = spark.table(f"{config.target_schema}.redacted_logs")
    return logs.groupBy("date", "service_name").agg(F.count("*").alias("rows"))


def expire_catalog_table(spark, folder):
    """Days left in a raw table after its old partitions are dropped."""
    config = _filled_config(spark, folder, source_schema=f"raw_{uuid.uuid4().hex}")
    name = create_raw_table(spark, config, "logs")
    expire_table(spark, name, RETENTION, dt.date(2024, 1, 20))
    return spark.table(name).groupBy("date").agg(F.count("*").alias("rows"))


def source_counts(spark, folder):
    config = _filled_config(spark, folder)
    return spark.createDataFrame([(s.kind, s.rows) for s in check_sources(spark, config)],
                                 "kind string, rows long")


def clustered_layout(spark, folder):
    """Rows per day after clustering; days do not interleave over the ordered partitions."""
    clustered = cluster(_spans(spark, folder), 16).withColumn("part", F.spark_partition_id())
    return clustered.groupBy("date").agg(
        F.count("*").alias("rows"), F.count_distinct("trace_id").alias("traces"),
        (F.max("part") - F.min("part") + 1 == F.count_distinct("part")).alias("adjacent"))


QUERIES: dict[str, Query] = {
    "hits_by_source": hits_by_source,
    **{f"mask_{c}": _documents(Policy((n,))) for c, n in (
        ("email", "email"), ("phone", "phone"), ("ip", "ip_address"), ("card", "credit_card"))},
    "mask_pages": _pages(Policy(("email", "phone", "ip_address"))),
    "mask_all_default": _documents(DEFAULT),
    "mask_none": _documents(Policy(categories=())),
    "custom_patterns": _documents(Policy(("email",), {"secret": SECRET})),
    **{f"notes_{n}": _masked_notes(Policy((n,))) for n in CATEGORIES},
    "notes_all": _masked_notes(EVERYTHING),
    "mode_hash": _masked_notes(Policy(CATEGORIES, mode="hash", salt=SALT)),
    "mode_remove": _masked_notes(Policy(CATEGORIES, mode="remove")),
    "mask_character": _masked_notes(Policy(CATEGORIES, mask_character="*")),
    "listed_names": listed_names,
    "listed_names_joined": listed_names_joined,
    "listed_names_any_length": listed_names_any_length,
    "masked_by_model": masked_by_model,
    "leaf_mask_attributes": leaf_mask_attributes,
    "allowlisted_keys": allowlisted_keys,
    "allowlisted_paths": allowlisted_paths,
    "mask_events": mask_events,
    "mask_events_cast": mask_events_cast,
    "mask_resource": mask_resource,
    "mask_resource_variant": mask_resource_variant,
    "mask_json_strings": mask_json_strings,
    "redacted_spans": redacted_spans,
    "redacted_logs": redacted_logs,
    "redacted_annotations": redacted_annotations,
    "unmasked_spans": unmasked_spans,
    "more_fields": more_fields,
    "trace_filter": trace_filter,
    "redacted_view": redacted_view,
    "trace_unified": trace_view,
    "trace_unified_maintained": trace_view_maintained,
    "trace_unified_parts": trace_view_parts,
    "trace_unified_tags": trace_view_tags,
    "annotations_by_target": target_annotations,
    "retention_keep": retention_keep,
    "retention_plan": retention_plan,
    "raw_vs_redacted": compare_all,
    "raw_vs_redacted_sample": compare_sample,
    "unredacted_rows": rows_not_redacted,
    "coverage": coverage_by_day,
    "leak_scan": leaks,
    "recall_by_category": recall_by_category,
    "names_without_cues": names_without_cues,
    "prompt_spans": prompt_spans,
    "prompt_lines": prompt_lines,
    "stream_incremental": stream_incremental,
    "stream_spans": stream_spans,
    "stream_annotations": stream_annotations,
    "expire_spans": expire_spans,
    "stream_full_refresh": stream_full_refresh,
    "stream_after_expiry": stream_after_expiry,
    "published_tables": published_tables,
    "expire_table": expire_catalog_table,
    "source_counts": source_counts,
    "clustered_layout": clustered_layout,
}

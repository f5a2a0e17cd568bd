"""Column names and types of the raw tables."""
from pyspark.sql import types as T

_ATTRIBUTES = T.VariantType()

RESOURCE = T.StructType([
    T.StructField("attributes", _ATTRIBUTES),
    T.StructField("dropped_attributes_count", T.IntegerType()),
])
SCOPE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("attributes", _ATTRIBUTES),
    T.StructField("dropped_attributes_count", T.IntegerType()),
])
STATUS = T.StructType([
    T.StructField("message", T.StringType()),
    T.StructField("code", T.StringType()),
])
EVENT = T.StructType([
    T.StructField("time_unix_nano", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("attributes", _ATTRIBUTES),
    T.StructField("dropped_attributes_count", T.IntegerType()),
])
LINK = T.StructType([
    T.StructField("trace_id", T.StringType()),
    T.StructField("span_id", T.StringType()),
    T.StructField("attributes", _ATTRIBUTES),
])

# Column names and order of the raw tables.
SPANS = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("time", T.TimestampType()),
    T.StructField("date", T.DateType()),
    T.StructField("service_name", T.StringType()),
    T.StructField("trace_id", T.StringType()),
    T.StructField("span_id", T.StringType()),
    T.StructField("trace_state", T.StringType()),
    T.StructField("parent_span_id", T.StringType()),
    T.StructField("flags", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("start_time_unix_nano", T.LongType()),
    T.StructField("end_time_unix_nano", T.LongType()),
    T.StructField("attributes", _ATTRIBUTES),
    T.StructField("dropped_attributes_count", T.IntegerType()),
    T.StructField("events", T.ArrayType(EVENT)),
    T.StructField("dropped_events_count", T.IntegerType()),
    T.StructField("links", T.ArrayType(LINK)),
    T.StructField("dropped_links_count", T.IntegerType()),
    T.StructField("status", STATUS),
    T.StructField("resource", RESOURCE),
    T.StructField("resource_schema_url", T.StringType()),
    T.StructField("instrumentation_scope", SCOPE),
    T.StructField("span_schema_url", T.StringType()),
])
LOGS = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("time", T.TimestampType()),
    T.StructField("date", T.DateType()),
    T.StructField("service_name", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("trace_id", T.StringType()),
    T.StructField("span_id", T.StringType()),
    T.StructField("time_unix_nano", T.LongType()),
    T.StructField("observed_time_unix_nano", T.LongType()),
    T.StructField("severity_number", T.IntegerType()),
    T.StructField("severity_text", T.StringType()),
    T.StructField("body", _ATTRIBUTES),
    T.StructField("attributes", _ATTRIBUTES),
    T.StructField("dropped_attributes_count", T.IntegerType()),
    T.StructField("flags", T.IntegerType()),
    T.StructField("resource", RESOURCE),
    T.StructField("resource_schema_url", T.StringType()),
    T.StructField("instrumentation_scope", SCOPE),
    T.StructField("log_schema_url", T.StringType()),
])
ANNOTATIONS = T.StructType([
    T.StructField("target_id", T.StringType()),
    T.StructField("annotation_id", T.StringType()),
    T.StructField("annotation_type", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("value", T.VariantType()),
    T.StructField("comment", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("created_by", T.StringType()),
])

BY_KIND = {"spans": SPANS, "logs": LOGS, "annotations": ANNOTATIONS}

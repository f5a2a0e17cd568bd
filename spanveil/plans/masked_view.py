"""Masking at read time: no copy of the data, the rules apply on every query."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_FIELDS, Policy
from ..operators.redact import redact

# The columns of the view.
VIEW_COLUMNS = ("trace_id", "span_id", "parent_span_id", "name", "kind",
                "start_time_unix_nano", "end_time_unix_nano", "status", "date", "service_name",
                "time", "instrumentation_scope", "links", "attributes", "events", "resource")


def masked_spans_view(spans: DataFrame, policy: Policy) -> DataFrame:
    """Raw spans with masked attributes, events and resource.

    Lazy: a query that does not select a masked column does not pay for its mask, and filters
    on the other columns reach the scan. Unlike in the pipeline a null resource becomes a
    struct of nulls.
    """
    masked = redact(spans.select(*VIEW_COLUMNS), DEFAULT_FIELDS["spans"], policy)
    return masked.withColumn("resource", F.struct(
        F.col("resource.attributes").alias("attributes"),
        F.col("resource.dropped_attributes_count").alias("dropped_attributes_count")))

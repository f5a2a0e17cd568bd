"""Prompt and response records as spans, for checking a deployment with known content."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import SPANS

# Span name, purpose, and the attributes of the resource.
SPAN_NAME = "pii-test-interaction"
PURPOSE = "pii-redaction-validation"
LINE_KEY, PURPOSE_KEY = "test.line_number", "test.purpose"


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """Read JSON lines {prompt, response} with the file and the 1-based line number in it.

    Files are read in blocks by many tasks. A line number is the position in the block plus
    the lines of all earlier blocks of the file. Both are taken in one query, so they rest on
    the same blocks; lines move once, by block.
    """
    lines = spark.read.schema("prompt string, response string").json(path).select(
        "prompt", "response", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"))
    in_block = Window.partitionBy("file", "block").orderBy("position")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("lines")).select(
        "file", "block", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before"))
    numbered = lines.withColumn("in_block", F.row_number().over(in_block))
    return numbered.join(blocks, ["file", "block"]).select(
        "prompt", "response", "file",
        (F.col("before") + F.col("in_block")).cast("int").alias("line_number"))


def prompts_to_spans(records: DataFrame, key: Column, time: Column, service: str = "generator",
                     deployment: str = "redaction-demo", input_key: str = "span.inputs",
                     output_key: str = "span.outputs") -> DataFrame:
    """One trace with one root span per record; ``key`` names a record, and ids come from it.

    ``records`` has prompt, response and line_number. Prompt and response are JSON documents
    held as strings inside the attributes.
    """
    trace_id = F.substring(F.sha2(key.cast("string"), 256), 1, 32)
    nanos = F.unix_micros(time) * 1000
    attributes = F.to_json(F.struct(
        F.to_json(F.struct("prompt"), {"ignoreNullFields": "false"}).alias(input_key),
        F.to_json(F.struct("response"), {"ignoreNullFields": "false"}).alias(output_key),
        F.col("line_number").alias(LINE_KEY), F.lit(PURPOSE).alias(PURPOSE_KEY)))
    resource = F.to_json(F.struct(F.lit(deployment).alias("deployment"),
                                  F.lit(service).alias("service.name")))
    known = {
        "record_id": F.concat(trace_id, F.lit("-0")), "time": time, "date": F.to_date(time),
        "service_name": F.lit(service), "trace_id": trace_id,
        "span_id": F.substring(trace_id, 1, 16), "flags": F.lit(1), "name": F.lit(SPAN_NAME),
        "kind": F.lit("INTERNAL"), "start_time_unix_nano": nanos, "end_time_unix_nano": nanos,
        "attributes": F.parse_json(attributes),
        "resource": F.struct(F.parse_json(resource).alias("attributes"),
                             F.lit(0).alias("dropped_attributes_count")),
    }
    return records.select(*(known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                            for f in SPANS.fields))

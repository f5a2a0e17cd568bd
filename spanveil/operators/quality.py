"""Coverage, leak scan and recall of the masking."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Policy
from ..functions.detectors import detectors
from ..functions.masking import any_hit, apply_detector, may_match
from ..functions.nested import has_variant


def _text_columns(df: DataFrame) -> list[tuple[str, Column]]:
    """Every column that can hold text, as text."""
    found = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType) or isinstance(f.dataType, T.VariantType):
            found.append((f.name, F.col(f"`{f.name}`").cast("string")))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            found.append((f.name, F.to_json(f"`{f.name}`")))
    return found


def coverage(df: DataFrame, column: str, policy: Policy, table: str,
             by: str = "date") -> DataFrame:
    """Per day and category: rows, rows with a hit, and matches that the policy replaces.

    A category counts in the text that the earlier ones leave, as in masking, so nothing is
    counted twice.
    """
    found = detectors(policy)
    staged = df.select(F.col(by).alias("by"),
                       _as_text(df, column).alias("text"))
    for i, detector in enumerate(found):
        # The text before a category is needed for both its count and its mask, and only texts with
        # a hit are masked; hence the projections.
        earlier = [F.col(f"hits_{j}") for j in range(i)]
        count = F.regexp_count("text", F.lit(detector.pattern))
        if detector.needs:
            count = F.when(may_match(F.col("text"), detector), count).otherwise(0)
        staged = staged.select("by", "text", *earlier, count.alias(f"hits_{i}"))
        staged = staged.select("by", *earlier, f"hits_{i}", F.when(
            F.col(f"hits_{i}") > 0, apply_detector(F.col("text"), detector, policy)).otherwise(
            F.col("text")).alias("text"))
    sums = [F.count("*").alias("rows")]
    for i in range(len(found)):
        sums += [F.count_if(F.col(f"hits_{i}") > 0).alias(f"rows_{i}"),
                 F.coalesce(F.sum(f"hits_{i}"), F.lit(0)).alias(f"matches_{i}")]
    per_category = F.array(*(F.struct(
        F.lit(d.name).alias("category"), F.col(f"rows_{i}").alias("rows_with_hit"),
        F.col(f"matches_{i}").alias("matches")) for i, d in enumerate(found)))
    return staged.groupBy("by").agg(*sums).select(
        F.lit(table).alias("table_name"), F.col("by").alias(by), "rows",
        F.inline(per_category))


def _as_text(df: DataFrame, column: str) -> Column:
    data_type = df.schema[column].dataType
    if isinstance(data_type, (T.StructType, T.ArrayType)) and has_variant(data_type):
        return F.to_json(column)
    return F.col(column).cast("string")


def leak_scan(df: DataFrame, policy: Policy, table: str) -> DataFrame:
    """Rows in which a detector still finds something, for every column that can hold text.

    One scan, and one result row per column and category; zero means no leak. Nearly all values of
    a redacted table are clean, so categories are only told apart where there is a hit.
    """
    found, texts = detectors(policy), _text_columns(df)
    staged = df.select(*(text.alias(f"t{i}") for i, (_, text) in enumerate(texts)))

    def found_in(i: int, name: str) -> Column:
        cells = F.array(*(F.struct(F.lit(name).alias("column_name"), F.lit(d.name).alias("category"),
                                   F.col(f"t{i}").rlike(d.pattern).alias("hit")) for d in found))
        none = F.array().cast("array<struct<column_name: string, category: string, hit: boolean>>")
        return F.when(any_hit(F.col(f"t{i}"), policy),
                      F.filter(cells, lambda cell: cell["hit"])).otherwise(none)

    hits = staged.select(F.inline(F.flatten(F.array(
        *(found_in(i, name) for i, (name, _) in enumerate(texts)))))).groupBy(
        "column_name", "category").agg(F.count("*").alias("hits"))
    grid = df.sparkSession.range(1).select(F.inline(F.array(*(
        F.struct(F.lit(name).alias("column_name"), F.lit(d.name).alias("category"))
        for name, _ in texts for d in found))))
    return grid.join(hits, ["column_name", "category"], "left").select(
        F.lit(table).alias("table_name"), "column_name", "category",
        F.coalesce("hits", F.lit(0)).cast("long").alias("rows_with_hit"))


def recall(truth: DataFrame, redacted: DataFrame, key: str, text: str) -> DataFrame:
    """How many known values are gone from the redacted text.

    ``truth`` has the columns (key, category, value, sensitive). Sensitive values
    should be gone (recall), others should still be there (precision). A value whose record is
    not in the redacted table counts as missing, and neither as masked nor as kept.
    """
    # Equal rows are counted first, so copies of a record do not multiply in the join.
    weighted = truth.groupBy(key, "category", "value", "sensitive").agg(F.count("*").alias("n"))
    texts = redacted.select(key, F.col(text).alias("masked_text"), F.lit(True).alias("found")).distinct()
    joined = weighted.join(texts, key, "left")
    kept = F.contains("masked_text", "value")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    counted = joined.groupBy("category").agg(
        total(F.col("sensitive")).alias("sensitive_values"),
        total(F.col("sensitive") & ~kept).alias("masked_values"),
        total(~F.col("sensitive")).alias("harmless_values"),
        total(~F.col("sensitive") & kept).alias("kept_values"),
        total(F.col("found").isNull()).alias("missing_values"))
    return counted.select(
        "*", F.round(F.try_divide("masked_values", "sensitive_values"), 4).alias("recall"),
        F.round(F.try_divide("kept_values", "harmless_values"), 4).alias("kept_share"))

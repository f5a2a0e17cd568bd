"""Comparison of raw and redacted tables."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nested import has_variant

KEYS = ("trace_id", "span_id")


def _text(df: DataFrame, field: str) -> Column:
    data_type: T.DataType = df.schema
    for part in field.split("."):
        data_type = data_type[part].dataType
    if has_variant(data_type) and not isinstance(data_type, T.VariantType):
        return F.to_json(field)
    return F.col(field).cast("string")


def raw_vs_redacted(raw: DataFrame, redacted: DataFrame, field: str = "attributes",
                    where: Column | None = None, limit: int | None = None) -> DataFrame:
    """Raw next to redacted text of the rows with the same trace and span id.

    Equal rows are counted before the join, so copies of a row do not multiply: a result row
    stands for ``raw_rows`` times ``redacted_rows`` pairs. ``limit`` gives the first pairs
    by key and text.
    """
    if where is not None:
        raw = raw.where(where)

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*KEYS, _text(df, field).alias(name)).groupBy(*KEYS, name).agg(
            F.count("*").alias(f"{name}_rows"))

    if limit is None:
        return side(raw, "raw").join(side(redacted, "redacted"), list(KEYS))

    # Only the first keys that occur on both sides are needed, so find these on narrow rows
    # and read the texts of their rows alone.
    keys = raw.select(*KEYS).distinct().join(redacted.select(*KEYS), list(KEYS), "left_semi")
    first = F.broadcast(keys.orderBy(*KEYS).limit(limit))  # at most ``limit`` rows

    def smallest(df: DataFrame, name: str) -> DataFrame:
        order = Window.partitionBy(*KEYS).orderBy(name)
        return side(df.join(first, list(KEYS)), name).withColumn(
            "rank", F.row_number().over(order)).where(F.col("rank") <= limit).drop("rank")

    return smallest(raw, "raw").join(smallest(redacted, "redacted"), list(KEYS)).orderBy(
        *KEYS, "raw", "redacted").limit(limit)


def unredacted_rows(raw: DataFrame, redacted: DataFrame, key: str = "record_id") -> DataFrame:
    """Raw rows without a redacted counterpart, that is, not yet safe to delete."""
    return raw.join(redacted.select(key).distinct(), key, "left_anti")

"""Splitting of groups that are too large for one row or one task."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import stored


def oversized(sizes: DataFrame, max_rows: int, now: bool = True) -> DataFrame | None:
    """Of a table of groups with a count ``n``, those that need several parts; None if none does.

    ``now`` finds them at once, so the many plans without a large group need no join for them, and
    others join a table of known size. Otherwise they are found whenever the plan runs.
    """
    if max_rows < 1:
        raise ValueError("max_rows must be at least 1")
    parts = sizes.where(F.col("n") > max_rows).withColumn(
        "parts", F.ceil(F.col("n") / max_rows).cast("long"))
    if not now:
        return parts
    parts = stored(parts)
    return None if parts.isEmpty() else parts


def spread(*columns: str, row_id: str | None = None) -> Column:
    """A number that spreads the rows of one group, exact copies included.

    Copies of one row differ in their row id if there is one, else in the input partition they come
    from. Both stay the same if a task is run again. A row id lets filters reach the scan.
    """
    return F.xxhash64(*columns, F.spark_partition_id() if row_id is None else F.col(row_id))

"""Hook for a user's own masking model, run in batches by an Arrow UDF."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Bytes of text that a model sees at once, unless one text is longer.
_SLICE_BYTES = 1 << 20


def model_column(text: Column, factory: Callable[[], Callable]) -> Column:
    """Run the model over a text column. ``factory`` loads it, once per Python task.

    A batch has a bounded number of rows, not of bytes. It stays in Arrow, and the model sees slices of it, so
    that copies in Python's own form are small however long the texts are.
    """
    def slices(batch: pa.Array) -> Iterator[pa.Array]:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(batch):
            before = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, before + _SLICE_BYTES, "right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        mask = factory()
        for batch in batches:
            for part in slices(batch):
                values = pd.Series(part.to_pylist(), dtype=object)
                result = pd.Series([None] * len(values), dtype=object)
                present = values.notna()
                if present.any():
                    result[present] = mask(values[present]).to_numpy()
                yield pa.Array.from_pandas(result, type=pa.string())

    # A filter on the result must not run the model a second time below the projection.
    return run.asNondeterministic()(text)


def apply_model(df: DataFrame, fields: dict[str, bool], factory: Callable[[], Callable]) -> DataFrame:
    """Run the model over string fields (``column`` or ``column.field``); True marks a JSON field.

    A model may break JSON. Its output is then kept as one JSON string, which is still valid
    and holds nothing that the model removed.
    """
    names = {field: f"_model_{i}" for i, field in enumerate(fields)}
    staged = df.select("*", *(model_column(F.col(f), factory).alias(n) for f, n in names.items()))

    def result(field: str) -> Column:
        text, present = F.col(names[field]), F.col(field).isNotNull()
        if not fields[field]:
            return F.when(present, text)
        quoted = F.to_json(F.array(text))
        return F.when(present, F.when(F.try_parse_json(text).isNotNull(), text).otherwise(
            quoted.substr(F.lit(2), F.length(quoted) - 2)))

    def column(name: str) -> Column:
        if name in fields:
            return result(name).alias(name)
        whole = F.col(name)
        for field in (f for f in fields if f.startswith(f"{name}.")):
            whole = whole.withField(field.split(".")[1], result(field))
        return whole.alias(name)

    return staged.select(*(column(name) for name in df.columns))

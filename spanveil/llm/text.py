"""Helpers that the text operators share: words, hashes, tables in the shared folder, Arrow batches."""
from __future__ import annotations

import gc
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import StructField, StructType

#: A-Z become a-z; ASCII that is neither letter nor digit separates words; other bytes stay.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
                    for c in range(256))
_BATCH_BYTES = 4_000_000


def raw(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def words(text: str | None) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters, A-Z in lower case; null has none."""
    return raw(text).translate(_WORD_BYTES).split()


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64-bit values evenly; each seed gives an order of its own."""
    x = values + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shared_path(spark: SparkSession) -> str:
    """A new path in the folder that all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, *parts: str) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends there."""
    path = shared_path(df.sparkSession)
    df.write.partitionBy(*parts).parquet(path) if parts else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files behind a table of ``written``, once nothing reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cleared(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of tables that are no longer referenced; it does so when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def slices(batch: pa.RecordBatch, column: str):
    """Parts of a batch with a bounded number of text bytes, one row at least."""
    at = batch.schema.get_field_index(column)
    start, size = 0, 0
    lengths = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    for i, n in enumerate(lengths):
        if i > start and size + n > _BATCH_BYTES:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += int(n)
    if batch.num_rows > start:
        yield batch.slice(start)


def map_texts(df: DataFrame, text: str, make: Callable[[], Callable[[list], dict[str, list]]],
              fields: list[StructField], keep: list[str] | None = None) -> DataFrame:
    """Add or replace columns computed from a text column.

    ``make`` runs once in each task and returns a function from a list of texts to a
    dictionary of column values. ``keep`` names the input columns that stay (all, if not
    given); a new column takes the place of an input column of the same name.
    """
    new = {f.name: f for f in fields}
    columns = [c for c in (df.columns if keep is None else keep)]
    order = [new.pop(c) if c in new else df.schema[c] for c in columns] + list(new.values())
    schema = StructType(order)
    made = {f.name: to_arrow_type(f.dataType) for f in fields}
    arrow = to_arrow_schema(schema)
    source = df.select(*dict.fromkeys([*(c for c in columns if c not in made), text]))

    def run(batches):
        work = make()
        for batch in batches:
            for part in slices(batch, text):
                out = work(part.column(part.schema.get_field_index(text)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], made[f.name]) if f.name in made
                     else part.column(part.schema.get_field_index(f.name)).cast(f.type) for f in arrow], schema=arrow)

    return source.mapInArrow(run, schema)


def free_name(name: str, columns: list[str]) -> str:
    """A column name like ``name`` that is not among ``columns``, whatever the case."""
    taken = {c.lower() for c in columns}
    while f"{name}_".lower() in taken:
        name += "_"
    return f"{name}_"


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, at_most: int, folds: int, held_out: int) -> DataFrame:
    """Texts and labels to learn from: at most ``at_most`` labelled documents, chosen by a hash of the id.

    Rows with crc32(doc_id) mod ``folds`` = ``held_out`` are never taken, nor rows whose id
    or label is null. An id that is labelled more than once has its largest label.
    """
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
              .where(fold(F.col("doc_id"), folds) != held_out)
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def fold(doc_id, folds: int):
    """The fold of a document: crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds

"""Models see slices of bounded size."""
from pyspark.sql import functions as F

from spanveil.functions.model import model_column


def test_a_model_sees_slices_of_bounded_size(spark):
    def factory():
        return lambda texts: texts.map(lambda t: f"{t[:1]}{len(t)} {texts.str.len().sum()}")

    rows = [(i, None if i % 10 == 3 else str(i % 10) * (300_000 if i % 10 else 3_000_000)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, t string").coalesce(1)
    found = {r.id: r.m for r in df.select("id", model_column(F.col("t"), factory).alias("m")).collect()}
    for i, text in rows:
        if text is None:
            assert found[i] is None
        else:
            own, seen = found[i].split()
            assert own == f"{text[0]}{len(text)}" and int(seen) <= max(1 << 20, len(text))

"""Changes of matches with one search for each text."""
import re

import pytest
from pyspark.sql import functions as F

from spanveil import Policy
from spanveil.functions.masking import bind, mask_text, replace_each


@pytest.mark.parametrize("text", ["", "a1b22c", "7", "x", "1￿2", "￿", "55 $1 \\ 6", None])
def test_each_match_is_changed_and_no_text_splits_at_the_pattern(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(
        bind(F.col("t"), lambda t: replace_each(t, "[0-9]+", lambda m: F.concat(F.lit("<"), m, F.lit("$0>")))).alias("x"))
    expected = None if text is None else "".join(
        p if not p.isdigit() else f"<{p}$0>" for p in re.split("([0-9]+)", text))
    assert df.first().x == expected


def test_hash_mode_takes_texts_apart_at_a_single_character(spark):
    df = spark.range(1).select(F.col("id").cast("string").alias("t")).select(
        mask_text(F.col("t"), Policy(("phone",), mode="hash", salt="s")))
    assert "￿, -1" in df._jdf.queryExecution().analyzed().toString()

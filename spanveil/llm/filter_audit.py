"""How five filters act together: what each removes in each order, and its Shapley value.

The documents are read once into counts per part and set of failed filters; all the rest is
computed from the removals of the 32 coalitions of filters.
"""
from __future__ import annotations

import hashlib
from fractions import Fraction
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField

from spanveil.llm.text import map_texts, raw, written

FILTERS = "ABCDE"
_N = len(FILTERS)
_ALL = 2**_N - 1
_CAPITALS, _SYMBOLS, _FOLLOWING = bytes(range(65, 91)), b"#$%&*|", bytes(range(128, 192))


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Each document's part (its source), ``failed`` (bit i: filter i), ``good`` and ``toxic``.

    A null text is empty, a null source the empty string. Filter E compares SHA-256 hashes of
    the texts of the whole table: a document fails if a smaller doc_id has the same text. Rows
    with the same id aren't smaller than each other, and rows without an id are no copies and
    make none. An id that is labelled more than once has its largest labels.
    """
    def make():
        def work(texts):
            out = {"own": [], "hash": []}
            for text in map(raw, texts):
                out["own"].append(_own_failures(text))
                out["hash"].append(hashlib.sha256(text).digest())
            return out

        return work

    named = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "text")
    fields = [StructField("own", IntegerType(), False), StructField("hash", BinaryType(), False)]
    # the short rows are written once, so that texts are read once
    rows = written(map_texts(named, "text", make, fields, ["doc_id", "part"]))
    # ids of the first documents of all texts; the id in the key spreads the copies of one text
    first = (rows.where("doc_id is not null").groupBy("hash").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("first", F.lit(True)))
    marks = (labels.where("doc_id is not null").groupBy("doc_id")
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return (rows.join(first, ["doc_id", "hash"], "left").join(marks, "doc_id", "left")
            .select("part", (F.col("own") + copy.cast("int") * 2**(_N - 1)).alias("failed"),
                    F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))


def _own_failures(text: bytes) -> int:
    """The filters that a text fails by itself, all but E. Its bytes suffice: the tested characters are ASCII."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _FOLLOWING))
    return ((len(words) < 50) + 2 * (100 * len(set(words)) < 65 * len(words)) + 4 * (100 * capitals > 5 * points)
            + 8 * (len(text.translate(None, _SYMBOLS)) < len(text)))


def shapley_weights(n: int = _N) -> list[list[Fraction]]:
    """For each player, the factor of each coalition's value in its Shapley value.

    The values of the players are the least squares fit of additive values to those of all
    coalitions, weighted by the Shapley kernel, under the constraint that they add up to the
    value of all. With a Lagrange multiplier for the constraint, the normal equations are linear
    in the values of the coalitions; they are solved once, in rationals.
    """
    coalitions = range(2**n)
    kernel = [Fraction(0) if s in (0, 2**n - 1) else
              Fraction(n - 1, comb(n, s.bit_count()) * s.bit_count() * (n - s.bit_count())) for s in coalitions]
    has = [[s >> i & 1 for s in coalitions] for i in range(n)]
    left = [[sum((kernel[s] * has[i][s] * has[j][s] for s in coalitions), Fraction(0)) for j in range(n)] + [Fraction(1)]
            for i in range(n)] + [[Fraction(1)] * n + [Fraction(0)]]
    right = [[kernel[s] * has[i][s] for s in coalitions] for i in range(n)]
    right.append([Fraction(int(s == 2**n - 1)) for s in coalitions])
    return _solved(left, right)[:n]


def _solved(left: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """Gauss-Jordan elimination, exact."""
    rows = [a + b for a, b in zip(left, right)]
    size = len(rows)
    for i in range(size):
        at = next(k for k in range(i, size) if rows[k][i])
        rows[i], rows[at] = rows[at], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for k in range(size):
            if k != i and rows[k][i]:
                rows[k] = [x - rows[k][i] * y for x, y in zip(rows[k], rows[i])]
    return [row[size:] for row in rows]


def audit(failed: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the result of ``failures``.

    ``kept`` documents are left after the step and ``removed`` ones go there; ``redundant`` ones
    fail the filter but went before; ``unique_fails`` fail no other; ``good_lost`` and ``toxic_lost``
    count labels among the removed; ``shapley`` is the filter's ``removed``, summed over all orders.
    A part's rows are there whatever its filters do. An empty table has an empty result.
    """
    counts = failed.groupBy("part", "failed").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    # at most one entry per set of failed filters
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))

    def removed_by_all(value: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(_ALL)), lambda s: F.aggregate(
            "cells", F.lit(0).cast("long"),
            lambda total, c: total + F.when(c["failed"].bitwiseAND(s) != 0, c[value]).otherwise(F.lit(0).cast("long"))))

    weights = [[int(w * factorial(_N)) for w in row] for row in shapley_weights()]
    shares = F.array(*[sum((F.col("v")[s] * w for s, w in enumerate(row) if w), F.lit(0).cast("long")) for row in weights])
    total = F.aggregate("cells", F.lit(0).cast("long"), lambda t, c: t + c["n"])
    tables = (parts.select("part", total.alias("total"), removed_by_all("n").alias("v"), removed_by_all("good").alias("good"),
                           removed_by_all("toxic").alias("toxic"))
              .withColumn("shares", shares))
    steps = (tables.select("*", F.explode(F.lit(_orders(FILTERS))).alias("filter_order"))
             .select("*", F.explode(F.sequence(F.lit(1), F.lit(_N))).alias("step")))
    at = F.instr(F.lit(FILTERS), F.substring("filter_order", F.col("step"), F.lit(1)))
    before = F.aggregate(F.slice(F.split("filter_order", ""), F.lit(1), F.col("step") - 1), F.lit(0),
                         lambda s, x: s + _power(F.instr(F.lit(FILTERS), x) - 1))
    bit = _power(F.col("at") - 1)
    removed = F.col("v")[F.col("after")] - F.col("v")[F.col("before")]
    return (steps.withColumns({"at": at, "before": before}).withColumns({"bit": bit, "after": F.col("before") + bit})
            .select("part", "filter_order", "step", (F.col("total") - F.col("v")[F.col("after")]).alias("kept"), removed.alias("removed"),
                    (F.col("v")[F.col("bit")] - removed).alias("redundant"),
                    (F.col("v")[_ALL] - F.col("v")[F.lit(_ALL) - F.col("bit")]).alias("unique_fails"),
                    (F.col("good")[F.col("after")] - F.col("good")[F.col("before")]).alias("good_lost"),
                    (F.col("toxic")[F.col("after")] - F.col("toxic")[F.col("before")]).alias("toxic_lost"),
                    F.col("shares")[F.col("at") - 1].alias("shapley")))


def _power(i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(2**k) for k in range(_N)]), i + 1)


def _orders(letters: str) -> list[str]:
    return [a + rest for a in letters for rest in _orders(letters.replace(a, ""))] if letters else [""]

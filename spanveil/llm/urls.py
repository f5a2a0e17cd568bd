"""Verdicts on URLs: rules first, then names taken apart into words and judged by naive Bayes."""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from spanveil.llm.text import written

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rules on host and path: (verdict, host, path). Fixed values.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
LONGEST_WORD = 20
BUCKETS = 1 << 16


def lowered(column: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(column, _UPPER, _UPPER.lower())


def parse(pages: DataFrame) -> DataFrame:
    """Adds ``host`` and ``path``; a null URL or one without ``://`` has empty ones."""
    url = F.coalesce("url", F.lit(""))
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": lowered(host), "path": path})


def fitting_rule(rules=RULES) -> Column:
    """The longest rule that fits host and path, as a struct of its text and verdict, or null."""
    found = []
    for verdict, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        found.append(F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*found)


def word_counts(pages: DataFrame) -> DataFrame:
    """How often each word of up to 20 letters stands in the visible text of all pages."""
    visible = F.regexp_replace("html", r"(?is)<(script|style)\b[^>]*>.*?</\1>|<[^>]*>", " ")
    word = F.explode(F.split(lowered(visible), r"[\x00-\x40\x5b-\x60\x7b-\x7f]+")).alias("word")
    return (pages.where("html is not null").select(word)
            .where(F.length("word").between(1, LONGEST_WORD)).groupBy("word").agg(F.count("*").alias("n")))


def best_words(name: str, known: dict[tuple[int, int], float], unknown: float) -> list[str]:
    """The most probable words that a name is made of.

    ``known`` has the log-probability of the word at (start, length). Any other piece costs
    ``unknown`` and, for each letter, the chance of one letter in 27. Ties go to the
    longer last word.
    """
    letter = -math.log(27)
    best, back = [0.0], [0]
    for end in range(1, len(name) + 1):
        options = []
        for start in range(max(0, end - LONGEST_WORD), end):
            p = known.get((start, end - start), unknown + letter * (end - start))
            options.append((best[start] + p, -start))
        p, start = max(options)
        best.append(p)
        back.append(-start)
    out, end = [], len(name)
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def segment(names: DataFrame, counts: DataFrame) -> DataFrame:
    """Columns ``name`` and ``words``: the most probable words of each distinct name.

    Each substring of a name meets the counts in a join on the word, so the dictionary is
    whole and never sent to tasks. An empty dictionary leaves names as they are, in
    pieces of 20 letters at most.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("total"))
    start = F.explode(F.sequence(F.lit(1), F.length("name"))).alias("start")
    size = F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("name") - F.col("start") + 1))).alias("size")
    pieces = (names.where(F.length("name") > 0).select("name").distinct().select("name", start).select("name", "start", size)
              .withColumn("word", F.substr("name", F.col("start"), F.col("size"))))
    found = (pieces.join(counts, "word", "left").groupBy("name")
             .agg(F.collect_list(F.when(F.col("n").isNotNull(), F.struct(F.col("start") - 1, "size", "n"))).alias("found")))

    @pandas_udf("array<string>")
    def split(name: pd.Series, found: pd.Series, total: pd.Series) -> pd.Series:
        out = []
        for text, rows, n in zip(name, found, total):
            every = max(float(n), 1.0)
            known = {(r[0], r[1]): math.log(r[2] / every) for r in map(_values, rows)}
            out.append(best_words(text, known, -math.log(every) - 1.0))
        return pd.Series(out)

    return found.join(F.broadcast(total)).select("name", split("name", "found", "total").alias("words"))


def _values(row) -> tuple:
    return tuple(row.values()) if isinstance(row, dict) else tuple(row)


def _tokens(words: Column) -> Column:
    """Words of the host (marked) and of the path; a number in the path counts by its digits."""
    path = F.transform(F.filter(F.split(lowered(F.col("path")), r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"), lambda t: t != ""),
                       lambda t: F.when(t.rlike("^[0-9]+$"), F.concat(F.lit("p#"), F.length(t).cast("string")))
                       .otherwise(F.concat(F.lit("p:"), t)))
    return F.concat(F.transform(words, lambda t: F.concat(F.lit("h:"), t)), path)


def judge(pages: DataFrame, counts: DataFrame, rules=RULES, buckets: int = BUCKETS) -> DataFrame:
    """Adds host, path, rule, ``words`` of the host, ``score`` (of block, 0 to 1) and verdict.

    ``counts`` are those of ``word_counts``. A rule's verdict holds; it also labels the page for naive Bayes, whose token counts come
    from all such pages. Tokens fall in a fixed number of buckets, so the model has a fixed
    size. Pages without a rule are blocked if block is likelier. Without any labelled page the
    score is 0.5 and the verdict allow. Rows are taken one by one, also with null ids;
    an empty table has an empty result.
    """
    parsed = parse(pages).withColumn("found_rule", fitting_rule(rules))
    labels = F.filter(F.split("host", r"[.:@]"), lambda t: t != "")
    hosts = parsed.select("host").distinct().select("host", F.posexplode(labels).alias("at", "name"))
    split = hosts.join(segment(hosts.select("name"), counts), "name", "left")
    hosts = written(split.groupBy("host").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(
        "at", F.coalesce("words", F.array("name")).alias("words")))), lambda x: x["words"])).alias("words")))
    judged = (parsed.join(hosts, "host", "left")
              .withColumn("words", F.coalesce("words", F.array().cast("array<string>"))))
    judged = judged.withColumn("features", F.transform(_tokens(F.col("words")),
                                                       lambda t: F.pmod(F.xxhash64(t), F.lit(buckets)).cast("int")))
    weights, prior = _fit(judged, buckets)

    @pandas_udf("double")
    def score(features: pd.Series) -> pd.Series:
        odds = np.array([prior + weights[np.asarray(f, np.int64)].sum() for f in features])
        return pd.Series(1 / (1 + np.exp(-np.clip(odds, -500, 500))))

    return (judged.withColumn("score", score("features"))
            .withColumn("rule", F.col("found_rule.rule"))
            .withColumn("verdict", F.coalesce("found_rule.verdict", F.when(F.col("score") > 0.5, "block").otherwise("allow")))
            .drop("features", "found_rule"))


def _fit(judged: DataFrame, buckets: int) -> tuple[np.ndarray, float]:
    """Log-ratios of the smoothed token shares in block and allow, and of the classes."""
    known = judged.where("found_rule is not null").select(
        (F.col("found_rule.verdict") == "block").cast("int").alias("block"), "features")
    tokens = (known.select("block", F.explode(F.concat("features", F.array(F.lit(-1)))).alias("bucket"))
              .groupBy("bucket").agg(F.sum("block").alias("block"), F.sum(1 - F.col("block")).alias("allow")))
    table = np.zeros((buckets + 1, 2))
    for bucket, block, allow in tokens.collect():
        table[bucket] = block, allow
    tokens, classes = table[:-1] + 1.0, table[-1] + 1.0
    ratio = np.log(tokens[:, 0] / tokens[:, 0].sum()) - np.log(tokens[:, 1] / tokens[:, 1].sum())
    return ratio, float(np.log(classes[0] / classes[1]))

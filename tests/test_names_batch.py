"""Names of many texts at once, and the sample that the tagger learns from."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from spanveil import Policy
from spanveil.functions.tagger import BUCKETS, LABELS, _features, best_path, best_paths, mask_all, mask_names, silver


def test_names_of_many_texts_at_once_are_those_of_each():
    rng = np.random.default_rng(5)
    weights = (rng.integers(-6, 7, (BUCKETS, LABELS)) / 4).astype(np.float32)
    moves = (rng.integers(-4, 5, (LABELS, LABELS)) / 4).astype(np.float32)
    words = ["Anna", "van", "O'Brien", "J", ".", ",", "12", "[NAME]", "(", "İz", "ß", "Bo", "K's"]
    texts = ["", " ", *(" ".join(rng.choice(words, rng.integers(1, 30))) for _ in range(400))]
    together = mask_all(pd.Series(texts), weights, moves, Policy()).tolist()
    assert together == [mask_names(t, weights, moves, Policy()) for t in texts]
    parts = [t.split() for t in texts if t.strip()]
    scores = [weights[_features(p)].sum(1) for p in parts]
    paths = best_paths(np.concatenate(scores), np.array([len(p) for p in parts]), moves)
    assert paths.tolist() == [x for s in scores for x in best_path(s, moves).tolist()]


def test_the_sample_is_that_of_the_smallest_hashes_on_any_size(spark):
    texts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.concat(F.lit("Dr. Anna Kor"), F.translate(
        F.col("id").cast("string"), "0123456789", "abcdefghij"))).otherwise(F.concat(F.lit("no one "), "id")).alias("t"))
    every = sorted((r.lot, r.t) for r in texts.unionAll(texts).distinct().select("t", F.xxhash64("t").alias("lot")).collect())
    for most in (8, 400):
        named = [lot for lot, t in every if t.startswith("Dr.")][:most - most // 4]
        others = [lot for lot, t in every if not t.startswith("Dr.")][:most // 4]
        assert sorted(r.lot for r in silver(texts.unionAll(texts), "t", most).collect()) == sorted(named + others)

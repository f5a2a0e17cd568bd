import hashlib
import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spanveil import Policy
from spanveil.functions.model import model_column
from spanveil.functions.tagger import BUCKETS, LABELS, best_path, learn_names, name_spans
from spanveil.operators.quality import recall
from spanveil.sources.samples import notes_from_orders

CUE = r"\b(?:customer|for|Dr\.) (?=\p{Lu})"


def test_best_path_against_all_paths():
    rng = np.random.default_rng(3)
    for n in range(6):
        for _ in range(30):
            scores, moves = rng.integers(-4, 5, (n, LABELS)).astype(float), rng.integers(-3, 4, (LABELS, LABELS)).astype(float)
            allowed = [p for p in itertools.product(range(LABELS), repeat=n)
                       if all((a, b) != (0, 2) for a, b in zip((0, *p), p))]
            worth = [sum(scores[i, b] for i, b in enumerate(p)) + sum(moves[a, b] for a, b in zip((0, *p), p)) for p in allowed]
            found = tuple(best_path(scores, moves).tolist())
            assert found in allowed and worth[allowed.index(found)] == max(worth)


def test_names_are_spans_of_whole_words():
    weights, moves = np.zeros((BUCKETS, LABELS)), np.zeros((LABELS, LABELS))
    moves[:, 1], moves[1, 2], moves[2, 2] = 1, 2, 2
    assert name_spans("Ana Ruiz 12 [EMAIL] Bo", weights, moves) == [(0, 8), (20, 22)]
    assert name_spans("no capital here", weights, moves) == [] == name_spans("", weights, moves)


@pytest.fixture(scope="module")
def notes(table):
    return notes_from_orders(table("orders"))


def test_recall_without_cues_on_names_never_seen(notes):
    """Names with a word that no training text holds, in notes whose cue words are gone."""
    unseen = F.col("name").rlike("Hiro|Fontaine")
    model = learn_names(notes.where(~unseen), "text")
    bare = notes.where(unseen).select("*", F.regexp_replace("text", CUE, "").alias("bare"))
    masked = bare.select("note_id", model_column(F.col("bare"), model).alias("text"))
    truth = bare.select("note_id", F.inline(F.array(*(F.struct(
        F.lit(c).alias("category"), F.col(c).alias("value"), F.lit(c == "name").alias("sensitive"))
        for c in ("name", "address", "employee")))), "bare").where(F.contains("bare", "value")).drop("bare")
    rows = {r.category: r for r in recall(truth, masked, "note_id", "text").collect()}
    assert rows["name"]["recall"] >= 0.95
    assert rows["address"]["kept_share"] >= 0.95 and rows["employee"]["kept_share"] >= 0.95


def test_same_texts_same_model_in_any_order(spark, notes):
    texts = notes.select("text").limit(200)
    one = learn_names(texts, "text", most=100, epochs=2)
    other = learn_names(texts.orderBy(F.desc("text")).repartition(5).union(texts), "text", most=100, epochs=2)
    assert one.__qualname__ == other.__qualname__ != learn_names(texts, "text", most=50, epochs=2).__qualname__


def test_nothing_to_learn_changes_nothing(spark):
    for rows in ([], [(None,), ("",)], [("no names here",), ("nor Here",)]):
        mask = learn_names(spark.createDataFrame(rows, "t string"), "t", epochs=1)()
        assert mask(pd.Series(["Ana Ruiz wrote", ""])).tolist() == ["Ana Ruiz wrote", ""]


def test_modes_long_texts_and_masking_twice(spark, notes):
    for policy, mark in ((Policy(), "[NAME]"), (Policy(mode="remove"), ""),
                         (Policy(mode="hash", salt="s"), None)):
        mask = learn_names(notes, "text", policy, most=400)()
        text = "Profile of Carla Dawson, DOB: 01/02/1950."
        if mark is None:
            letters = hashlib.sha256(b"scarla dawson").hexdigest().translate(str.maketrans("0123456789abcdef", "abcdefghijklmnop"))
            mark = f"[NAME:{letters[:20]}]"
        once = mask(pd.Series([text, "x" * 1_000_000, text * 2000]))
        assert once[0] == text.replace("Carla Dawson", mark)
        assert once[1] == "x" * 1_000_000 and "Carla Dawson" not in once[2]
        assert mask(once)[0] == once[0]

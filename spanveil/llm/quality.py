"""Quality of texts: support vectors over n-gram indicators that are scaled by naive Bayes log-count ratios."""
from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField

from spanveil.llm.text import labelled_sample, map_texts, mixed, raw

#: Labelled documents to learn from, at most.
SAMPLE = 8_000
#: Buckets for n-grams of words, and as many again for n-grams of word shapes.
BUCKETS = 1 << 17
FOLDS, HELD_OUT = 5, 0
_LONGEST = 40
_RUN = re.compile(r"(.)\1+", re.DOTALL)


@dataclass(frozen=True)
class Model:
    """Weight of each bucket, and the logistic curve from a margin to a probability."""
    weights: np.ndarray
    bias: float
    slope: float
    shift: float


class _Words(dict):
    """Hashes of a word and of its shape: kinds of letters, runs taken together."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit, self.older = limit, {}

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) >= self.limit:
            # words that aren't used again until the next such change go
            self.older = self.copy()
            self.clear()
        if (pair := self.older.get(word)) is not None:
            self[word] = pair
            return pair
        kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
        shape = _RUN.sub(r"\1\1", kinds)
        pair = self[word] = (xxhash.xxh3_64_intdigest(raw(word.lower())), xxhash.xxh3_64_intdigest(raw(shape)))
        return pair


def features(text: str | None, cache: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams in a text: one and two words, and one to four word shapes.

    A word equal to the one before it has another shape. Words of more than ``_LONGEST`` characters,
    as in texts without white space, count as several. An empty text has none.
    """
    tokens = (text or "").split()
    if not tokens:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if max(map(len, tokens)) > _LONGEST:
        tokens = [t[i:i + _LONGEST] for t in tokens for i in range(0, len(t), _LONGEST)]
    word, shape = (np.fromiter(column, np.uint64, len(tokens)) for column in zip(*map(cache.__getitem__, tokens)))
    shape[1:] += np.uint64(77) * (word[1:] == word[:-1])
    out = []
    for values, most, seed in ((word, 2, 1), (shape, 4, 9)):
        grams, gram = [mixed(values, seed)], values
        for n in range(1, most):
            gram = mixed(gram[:len(values) - n], seed + n) * np.uint64(31) + values[n:]
            grams.append(mixed(gram, seed + n))
        out.append(np.unique((np.concatenate(grams) % np.uint64(BUCKETS)).astype(np.int64)))
    return out[0], out[1] + BUCKETS


def _vector(text: str | None, cache: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their values: words and shapes have unit length each."""
    parts = features(text, cache)
    return np.concatenate(parts), np.concatenate([np.full(len(p), 1 / math.sqrt(max(len(p), 1))) for p in parts])


class Rows:
    """Vectors of texts: flat buckets of words and of shapes, each kind scaled to unit length.

    ``ratio`` multiplies the values of each bucket; until it is set, they are as they are. Only
    the buckets are kept, 4 bytes each.
    """

    def __init__(self, words: pa.ListArray, shapes: pa.ListArray):
        self.parts = [(p.offsets.to_numpy(), p.values.to_numpy()) for p in (words, shapes)]
        self.scales = [1 / np.sqrt(np.maximum(np.diff(offsets), 1)) for offsets, _ in self.parts]
        self.ratio: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.scales[0])

    def buckets(self, i: int) -> np.ndarray:
        return np.concatenate([values[offsets[i]:offsets[i + 1]] for offsets, values in self.parts])

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        at = self.buckets(i)
        values = np.repeat([scale[i] for scale in self.scales], [offsets[i + 1] - offsets[i] for offsets, _ in self.parts])
        return at, values if self.ratio is None else values * self.ratio[at]


def dual_coordinate_descent(rows, signs: np.ndarray, size: int, cost: float = 1.0, rounds: int = 20, seed: int = 7,
                            numbers: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear support vector machine with hinge loss, from all rows or those with some numbers.

    Each step solves the dual problem of one row, whose multiplier stays in [0, cost].
    Both classes count the same: the cost of a row is divided by the share of its class.
    """
    weights, bias = np.zeros(size), 0.0
    numbers = np.arange(len(rows)) if numbers is None else numbers
    alpha = np.zeros(len(numbers))
    norms = np.array([v @ v + 1.0 for _, v in (rows[i] for i in numbers)])
    upper = cost * len(numbers) / (2 * np.where(signs > 0, max((signs > 0).sum(), 1), max((signs < 0).sum(), 1)))
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        most = 0.0
        for i in order.permutation(len(numbers)).tolist():
            at, values = rows[numbers[i]]
            gradient = signs[i] * (weights[at] @ values + bias) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), upper[i])
            step = (new - alpha[i]) * signs[i]
            if step:
                weights[at] += step * values
                bias += step
                alpha[i] = new
                most = max(most, abs(step))
        if most < 1e-3:
            break
    return weights, bias


def _logistic(margins: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve that fits margins to labels, by Newton's method on smoothed targets."""
    n1, n0 = positive.sum(), (~positive).sum()
    target = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    at = np.array([1.0, 0.0])
    x = np.stack([margins, np.ones_like(margins)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * (at - [1.0, 0.0]))
        at = at - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(at[0]), float(at[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the labelled documents outside the held-out fold, ``sample`` of them at most.

    A fifth of these are kept for the curve from margin to probability. Without labels of both
    classes, the model gives every text the smoothed share of label 1.
    """
    def make():
        cache = _Words()

        def work(texts):
            found = [features(t, cache) for t in texts]
            return {"word_buckets": [a for a, _ in found], "shape_buckets": [b for _, b in found]}

        return work

    kind = ArrayType(IntegerType(), False)
    chosen = labelled_sample(docs, labels, "quality", sample, FOLDS, HELD_OUT)
    table = map_texts(chosen, "text", make, [StructField("word_buckets", kind), StructField("shape_buckets", kind)],
                      ["doc_id", "label"]).toArrow()
    table = table.take(np.argsort(table["doc_id"].to_numpy(), kind="stable")).combine_chunks()
    positive = table["label"].to_numpy() == 1
    rows = Rows(*[table[c].chunk(0) if len(table) else pa.array([], table[c].type) for c in ("word_buckets", "shape_buckets")])
    del table
    size = 2 * BUCKETS
    if positive.all() or not positive.any():
        share = (positive.sum() + 1) / (len(positive) + 2)
        return Model(np.zeros(size), 0.0, 1.0, math.log(share / (1 - share)))
    counts = np.ones((2, size))
    for i, y in enumerate(positive):
        counts[int(y), rows.buckets(i)] += 1
    rows.ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    curve = np.arange(len(rows)) % 5 == 4
    if not (positive[curve].any() and (~positive[curve]).any() and positive[~curve].any() and (~positive[~curve]).any()):
        curve[:] = False
    fitted = np.flatnonzero(~curve)
    weights, bias = dual_coordinate_descent(rows, np.where(positive[fitted], 1.0, -1.0), size, numbers=fitted)
    judged = np.flatnonzero(curve) if curve.any() else fitted
    margins = np.array([weights[at] @ values + bias for at, values in (rows[i] for i in judged)])
    model = Model(weights * rows.ratio, bias, *_logistic(margins, positive[judged]))
    del rows
    pa.default_memory_pool().release_unused()
    return model


def score_quality(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Adds ``score``: the probability of label 1, from the text alone. Null counts as empty.

    Each row is scored by itself over its whole text, whatever its id. The model has a fixed
    size and goes to each task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        cache, m = _Words(), shared.value

        def score(text):
            at, values = _vector(text, cache)
            z = m.slope * (m.weights[at] @ values + m.bias) + m.shift
            return 1 / (1 + math.exp(-min(max(z, -500.0), 500.0)))

        return lambda texts: {"score": [score(t) for t in texts]}

    return map_texts(docs, "text", make, [StructField("score", DoubleType(), False)], keep)

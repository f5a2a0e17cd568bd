"""Names without a cue: a linear-chain tagger that learns from the names that cues give away.

The name pattern finds names after a title, a label and the like. Its matches are the labels of
a sample of texts, and an averaged perceptron learns from them what names and their
surroundings look like. Half of the training drops the cue and the words of the names
themselves, so that the tagger does not need them. Each epoch is a Spark job: shards of the
sample correct the same weights, and the sums of their corrections give the next ones.
"""
from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Policy
from ..shared import stored
from .detectors import BUILT_IN, Detector
from .masking import token

#: Hashed features, and labels: other, first word of a name, further word.
BUCKETS, LABELS = 1 << 16, 3
_PARTS = re.compile(r"\[[A-Z_]+(?::[a-p]{20})?\]|[^\W\d_]+(?:['’-][^\W\d_]+)*|\d+|[^\s\w]|_")
_NAME = next(d for d in BUILT_IN if d.name == "name")
# A further word follows a word of the same name; nothing else is ruled out.
_RULED_OUT = np.array([[0, 0, -np.inf], [0, 0, 0], [0, 0, 0]])


def _shape(word: str) -> str:
    if not word:
        return "none"
    if not word[0].isalpha():
        return "digits" if word[0].isdigit() else word[0]
    if word.islower():
        return "small"
    return "letter" if len(word) == 1 else "capitals" if word.isupper() else "capital"


@lru_cache(maxsize=1 << 16)
def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % BUCKETS


def _features(words: list[str], known: list[bool] | None = None) -> np.ndarray:
    """The buckets of each word's features, one row a word; ``known`` is false where the word itself stays out."""
    low, shapes = [w.lower() for w in words], [_shape(w) for w in words]
    rows = []
    for i, own in enumerate(known or [True] * len(words)):
        before, after = (low[i - 1] if i else ""), (low[i + 1] if i + 1 < len(low) else "")
        left, right = (shapes[i - 1] if i else "none"), (shapes[i + 1] if i + 1 < len(low) else "none")
        second = shapes[i + 2] if i + 2 < len(low) else "none"
        rows.append([_bucket(f) for f in (
            f"shape {shapes[i]}", f"around {left} {shapes[i]} {right}", f"ahead {shapes[i]} {right} {second}",
            f"before {before} {shapes[i]}", f"after {after} {shapes[i]}",
            f"word {low[i]}" if own else "", f"end {low[i][-3:]} {shapes[i]}" if own else "")])
    return np.array(rows, np.int64).reshape(-1, 7)


def best_path(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The labels with the largest sum of scores (a row a word) and moves; ties go to the smaller label.

    The first word moves from label 0. No words give no labels.
    """
    moves = moves + _RULED_OUT
    back = np.zeros(scores.shape, np.int64)
    total = np.empty(0)
    for i, row in enumerate(scores):
        ways = (total[:, None] + moves) if i else moves[:1]
        back[i] = ways.argmax(0)
        total = ways.max(0) + row
    path = np.zeros(len(scores), np.int64)
    for i in range(len(scores) - 1, -1, -1):
        path[i] = total.argmax() if i == len(scores) - 1 else back[i + 1][path[i + 1]]
    return path


def _labelled(pieces: list[str], matches: list[str]) -> list[tuple[list[str], np.ndarray, list[bool] | None]]:
    """Words and labels of a text, as it is and without the cues and the words of the names."""
    words, labels, first = [], [], []
    for piece, match in zip(pieces, [*matches, ""]):
        words += (outside := _PARTS.findall(piece))
        labels += [0] * len(outside)
        inside = _PARTS.findall(match)
        first.append(len(words))
        words += inside
        labels += [1, *[2] * (len(inside) - 1)][:len(inside)]
    cues = set()
    for at in first[:-1]:
        while at and words[at - 1] in ".:=":
            at -= 1
            cues.add(at)
        if at and labels[at - 1] == 0:
            cues.add(at - 1)
    rest = [i for i in range(len(words)) if i not in cues]
    bare = ([words[i] for i in rest], np.array([labels[i] for i in rest], np.int64), [labels[i] == 0 for i in rest])
    return [(words, np.array(labels, np.int64), None), *([bare] if matches else [])]


def _correct(texts: pd.DataFrame, weights: np.ndarray, moves: np.ndarray) -> pd.DataFrame:
    """One pass over a shard: the corrections of each weight (``change``), and these times the steps before them (``late``)."""
    size = BUCKETS * LABELS
    change, late = np.zeros(size + LABELS * LABELS, np.int64), np.zeros(size + LABELS * LABELS, np.int64)
    weights, moves, step = weights.astype(np.float64), moves.astype(np.float64), 0
    for pieces, matches in zip(texts["pieces"], texts["matches"]):
        for words, right, known in _labelled(list(pieces), list(matches)):
            features = _features(words, known)
            found = best_path(weights[features].sum(1), moves)
            for labels, sign in ((right, 1), (found, -1)):
                wrong = right != found
                at = np.concatenate(((features[wrong] * LABELS + labels[wrong][:, None]).ravel(),
                                     size + np.concatenate(([0], labels[:-1]))[:len(labels)] * LABELS + labels))
                np.add.at(change, at, sign)
                np.add.at(late, at, sign * step)
                np.add.at(weights.reshape(-1), at[at < size], sign)
                np.add.at(moves.reshape(-1), at[at >= size] - size, sign)
            step += 1
    at = np.flatnonzero((change != 0) | (late != 0))
    return pd.DataFrame({"at": np.append(at, -1), "change": np.append(change[at], step), "late": np.append(late[at], 0)})


def _pass(shared) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def correct(texts: pd.DataFrame) -> pd.DataFrame:
        weights = shared.value
        return _correct(texts.sort_values("lot"), weights[:BUCKETS * LABELS].reshape(-1, LABELS),
                        weights[BUCKETS * LABELS:].reshape(LABELS, LABELS))
    return correct


#: The share of all hashes that is searched for a sample first.
_SHARE = 1 / 256


def silver(df: DataFrame, column: str, most: int) -> DataFrame:
    """pieces, matches, lot: a sample of ``most`` different texts, up to a quarter of them without a name.

    Which texts depends on their hashes alone. Null and empty texts take no part.
    """
    texts = df.select(F.col(column).cast("string").alias("text")).where(F.length("text") > 0).withColumn("lot", F.xxhash64("text"))
    # A small share of the hashes nearly always fills the sample of a large table. Else all texts are searched.
    few = stored(texts.where(F.col("lot") < int(2 ** 64 * _SHARE) - 2 ** 63))

    def first(named: bool, n: int) -> DataFrame:
        for some in (few, texts):
            found = stored(some.where(F.col("text").rlike(_NAME.pattern) == named).distinct().orderBy("lot", "text").limit(n))
            if found.count() == n:
                break
        return found

    without = most // 4
    sample = first(True, most - without).unionByName(first(False, without)).withColumn(
        "matches", F.regexp_extract_all("text", F.lit(_NAME.pattern), F.lit(0)))
    return sample.select(F.split("text", _NAME.pattern, -1).alias("pieces"), "matches", "lot")


def learn_names(df: DataFrame, column: str, policy: Policy = Policy(), most: int = 4000, epochs: int = 4,
                shards: int = 8) -> Callable[[], Callable[[pd.Series], pd.Series]]:
    """A model for ``Policy(model=...)`` that replaces names, learned from the names that cues give away in ``column``.

    It learns from at most ``most`` different texts, chosen by a hash; ``shards`` of them are read side by side
    in each of the ``epochs``. The same texts give the same model. Without any name to learn from, or on an
    empty table, it changes nothing. What ``policy`` says of the mode, the character and the salt holds.
    """
    sample = stored(silver(df, column, most).withColumn("shard", F.pmod("lot", F.lit(shards))))
    spark, size = df.sparkSession, BUCKETS * LABELS
    start, total = np.zeros(size + LABELS * LABELS), np.zeros(size + LABELS * LABELS)
    for _ in range(epochs):
        correct = _pass(spark.sparkContext.broadcast(start.astype(np.float32)))
        # Sums of whole numbers do not depend on their order, and there is at most one row for each weight.
        rows = (sample.repartition(shards, "shard").groupBy("shard").applyInPandas(correct, "at long, change long, late long")
                .groupBy("at").agg(F.sum("change").alias("change"), F.sum("late").alias("late"), F.count("*").alias("n")).toPandas())
        steps = rows.loc[rows["at"] == -1]
        if steps.empty or not steps["change"].iloc[0]:
            break
        passes, n = int(steps["n"].iloc[0]), int(steps["change"].iloc[0])
        rows = rows.loc[rows["at"] >= 0]
        at, change, late = (rows[c].to_numpy() for c in ("at", "change", "late"))
        # The mean over the steps of an epoch: a correction counts for the steps that follow it.
        mean = start.copy()
        mean[at] += (change - late * passes / n) / passes
        total += mean
        start[at] += change / passes
    return _loader(total.astype(np.float32), policy)


def _loader(weights: np.ndarray, policy: Policy) -> Callable[[], Callable[[pd.Series], pd.Series]]:
    at = np.flatnonzero(weights)  # few of the weights are used
    values, size, count = weights[at], BUCKETS * LABELS, len(weights)

    def load():
        full = np.zeros(count, np.float32)
        full[at] = values
        own, moves = full[:size].reshape(-1, LABELS), full[size:].reshape(LABELS, LABELS)
        return lambda texts: mask_all(texts, own, moves, policy)

    # Runs tell models apart by this name.
    digest = hashlib.sha256(at.tobytes() + values.tobytes()).hexdigest()[:16]
    load.__name__ = load.__qualname__ = f"names_{digest}"
    return load


#: Words of several texts that are scored side by side, unless one text has more.
_WORDS_AT_ONCE = 1 << 17


def _batch_features(words: list[str], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``_features`` gives for the words of each text, one below the other; ``starts`` has the first word of each text.

    Each different feature is hashed once. Also returned: whether a word may be in a name, and whether it starts with a capital.
    """
    word, different = pd.factorize(np.array(words, object))
    low, lows = pd.factorize(np.array([w.lower() for w in different], object))
    shape, shapes = pd.factorize(np.array(["none", *map(_shape, different)], object))
    end, ends = pd.factorize(np.array([w.lower()[-3:] for w in different], object))
    low, end, own = low[word], end[word], shape[1:][word]  # of each word; shape 0 is "none"
    lows, count = np.append(lows, ""), len(shapes)
    first = np.zeros(len(words), bool)
    first[starts] = True
    last = np.append(first[1:], True)
    left, right = np.append(0, own[:-1]), np.append(own[1:], 0)
    before, after = np.append(len(lows) - 1, low[:-1]), np.append(low[1:], len(lows) - 1)
    left[first], before[first], right[last], after[last] = 0, len(lows) - 1, 0, len(lows) - 1
    second = np.append(right[1:], 0)
    second[last] = 0

    def buckets(codes: np.ndarray, text: Callable[[int], str]) -> np.ndarray:
        number, codes = pd.factorize(codes)
        return np.array([_bucket(text(c)) for c in codes.tolist()], np.int64)[number]

    names, low_names, end_names = list(shapes), list(lows), list(ends)
    features = np.stack((
        buckets(own, lambda c: f"shape {names[c]}"),
        buckets((left * count + own) * count + right, lambda c: f"around {names[c // count // count]} {names[c // count % count]} {names[c % count]}"),
        buckets((own * count + right) * count + second, lambda c: f"ahead {names[c // count // count]} {names[c // count % count]} {names[c % count]}"),
        buckets(before * count + own, lambda c: f"before {low_names[c // count]} {names[c % count]}"),
        buckets(after * count + own, lambda c: f"after {low_names[c // count]} {names[c % count]}"),
        buckets(low, lambda c: f"word {low_names[c]}"),
        buckets(end * count + own, lambda c: f"end {end_names[c // count]} {names[c % count]}")), axis=1)
    letters = np.array([w[0].isalpha() or w == "." for w in different], bool)[word]
    capitals = np.array([w[0].isupper() for w in different], bool)[word]
    return features, letters, capitals


def best_paths(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """What ``best_path`` gives for each text; the scores of a text's words follow those of the text before."""
    moves = moves + _RULED_OUT
    order = np.argsort(-lengths, kind="stable")  # texts with a word at some place come first
    starts, sorted_lengths = (np.cumsum(lengths) - lengths)[order], lengths[order]
    # How many texts have a word at each place.
    present = np.searchsorted(-sorted_lengths, -np.arange(lengths.max(initial=0)), "left").tolist()
    back, path = np.zeros(scores.shape, np.int8), np.zeros(len(scores), np.int64)
    total = np.empty((len(lengths), LABELS))
    for i, n in enumerate(present):
        at = starts[:n] + i
        if i:
            ways = total[:n, :, None] + moves
            back[at] = ways.argmax(1)
            total[:n] = ways.max(1) + scores[at]
        else:
            total[:n] = moves[0] + scores[at]
    label = total.argmax(1)
    for i in range(len(present) - 1, -1, -1):
        at = starts[:present[i]] + i
        path[at] = label[:present[i]]
        label[:present[i]] = back[at, path[at]]
    return path


def _batch_spans(texts: list[str], words: list[list[str]], weights: np.ndarray, moves: np.ndarray) -> list[list[tuple[int, int]]]:
    """Start and end of each name of each text; ``words`` has the parts of each text, one at least."""
    lengths = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(lengths)
    features, letters, capitals = _batch_features([w for parts in words for w in parts], ends - lengths)
    scores = weights[features].sum(1)
    scores[~letters, 1:] = -np.inf
    path = best_paths(scores, lengths, moves)
    # A text without any capital has no name.
    named = np.add.reduceat(path > 0, ends - lengths).astype(bool) & np.add.reduceat(capitals, ends - lengths).astype(bool)
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    for t in np.flatnonzero(named).tolist():
        spans = found[t]
        for word, label in zip(_PARTS.finditer(texts[t]), path[ends[t] - lengths[t]:ends[t]].tolist()):
            if label == 1:
                spans.append(word.span())
            elif label == 2:
                spans[-1] = (spans[-1][0], word.end())
    return found


def name_spans(text: str, weights: np.ndarray, moves: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each name. Tokens of an earlier masking are never part of one."""
    words = _PARTS.findall(text)
    return _batch_spans([text], [words], weights, moves)[0] if words else []


def _masked(text: str, spans: list[tuple[int, int]], policy: Policy) -> str:
    parts, end = [], 0
    for start, stop in spans:
        parts += [text[end:start], _replacement(text[start:stop], _NAME, policy)]
        end = stop
    return "".join([*parts, text[end:]])


def mask_names(text: str, weights: np.ndarray, moves: np.ndarray, policy: Policy) -> str:
    """The text with each name replaced as the policy says."""
    return _masked(text, name_spans(text, weights, moves), policy)


def mask_all(texts: pd.Series, weights: np.ndarray, moves: np.ndarray, policy: Policy) -> pd.Series:
    """``mask_names`` of each text; the words of many texts are scored together."""
    masked, some, words, size = texts.tolist(), [], [], 0

    def finish() -> None:
        for i, spans in zip(some, _batch_spans([masked[i] for i in some], words, weights, moves) if some else ()):
            masked[i] = _masked(masked[i], spans, policy)

    for i, text in enumerate(masked):
        if parts := _PARTS.findall(text):
            if some and size + len(parts) > _WORDS_AT_ONCE:
                finish()
                some, words, size = [], [], 0
            some.append(i)
            words.append(parts)
            size += len(parts)
    finish()
    return pd.Series(masked, index=texts.index, dtype=object)


def _replacement(value: str, detector: Detector, policy: Policy) -> str:
    if policy.mode != "hash":
        return token(detector, policy)
    digest = hashlib.sha256((policy.salt + value.lower()).encode()).hexdigest()
    return f"[{detector.name.upper()}:{digest.translate(str.maketrans('0123456789abcdef', 'abcdefghijklmnop'))[:20]}]"

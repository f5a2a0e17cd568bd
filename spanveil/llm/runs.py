"""Stretches of words that repeat with a short period, found on a grammar of the words.

Re-Pair turns a sequence into a grammar; runs that cross the border inside a rule's expansion
are computed once a rule and translated to all places where the rule stands. Each run of the
text crosses the border of the smallest rule around it, so none is missed.
"""
from __future__ import annotations

import hashlib
import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from spanveil.llm.text import map_texts, raw

LEAST_LENGTH = 6
LEAST_PERIODS = 4
#: Pairs of a rule and a period that are tested at a time.
_TESTS = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]


class Grammar:
    """Rules of two symbols each; symbols below ``first`` are word ids, rule k is symbol first + k.

    Re-Pair: the most frequent pair of neighbouring symbols becomes a rule, again and again while
    one occurs twice. What is left is joined in pairs, level by level, so that one symbol, ``root``,
    stands for the whole sequence.
    """

    def __init__(self, ids: list[int], first: int):
        self.first, self.rules = first, []
        symbols = _re_pair(list(ids), self.rules, first)
        known: dict[tuple[int, int], int] = {}
        while len(symbols) > 1:
            joined = []
            for i in range(0, len(symbols) - 1, 2):
                pair = (symbols[i], symbols[i + 1])
                if pair not in known:
                    known[pair] = first + len(self.rules)
                    self.rules.append(pair)
                joined.append(known[pair])
            symbols = joined + symbols[len(joined) * 2:]
        self.root = symbols[0]

    def places(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """For each rule: start of its first occurrence, lengths of its two sides, starts of all occurrences."""
        first, n = self.first, len(self.rules)
        size = [0] * n
        for k, (a, b) in enumerate(self.rules):
            size[k] = (1 if a < first else size[a - first]) + (1 if b < first else size[b - first])
        left = np.array([1 if a < first else size[a - first] for a, _ in self.rules], np.int64)
        # a rule is used only in later rules, so its places are known when its turn comes
        found: list[list[np.ndarray]] = [[] for _ in range(n)]
        if n:
            found[self.root - first].append(np.zeros(1, np.int64))
        starts: list[np.ndarray] = [np.empty(0, np.int64)] * n
        for k in range(n - 1, -1, -1):
            at = found[k][0] if len(found[k]) == 1 else np.concatenate(found[k])
            found[k], starts[k] = [], at
            a, b = self.rules[k]
            if a >= first:
                found[a - first].append(at)
            if b >= first:
                found[b - first].append(at + left[k])
        return np.array([s.min() for s in starts], np.int64), left, np.array(size, np.int64) - left, starts


def _re_pair(symbols: list[int], rules: list[tuple[int, int]], first: int) -> list[int]:
    """Replace the most frequent pair until none occurs twice; adds to ``rules`` and returns what is left.

    Occurrences in a row of equal symbols don't overlap. Pairs of equal count go by size.
    """
    n = len(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    places: dict[tuple[int, int], set[int]] = {}
    last = None
    for i in range(n - 1):
        pair = (symbols[i], symbols[i + 1])
        if pair == last:  # the second of three equal symbols
            last = None
            continue
        places.setdefault(pair, set()).add(i)
        last = pair if pair[0] == pair[1] else None
    queue = [(-len(at), pair) for pair, at in places.items() if len(at) > 1]
    heapq.heapify(queue)

    def gone(i: int, pair: tuple[int, int]) -> None:
        if pair in places:
            places[pair].discard(i)

    while queue:
        count, pair = heapq.heappop(queue)
        at = places.get(pair, ())
        if len(at) < 2:
            continue
        if -count != len(at):
            heapq.heappush(queue, (-len(at), pair))
            continue
        del places[pair]
        new = first + len(rules)
        rules.append(pair)
        grown = set()
        for i in sorted(at):
            j = after[i]
            if symbols[i] != pair[0] or j >= n or symbols[j] != pair[1]:
                continue
            p, q = before[i], after[j]
            if p >= 0:
                gone(p, (symbols[p], pair[0]))
            if q < n:
                gone(j, (pair[1], symbols[q]))
            symbols[i], symbols[j] = new, -1
            after[i] = q
            if q < n:
                before[q] = i
            if p >= 0:
                x = (symbols[p], new)
                # in a row of equal symbols, a pair that overlaps the one before it doesn't count
                if x[0] != new or before[p] < 0 or before[p] not in places.get(x, ()):
                    places.setdefault(x, set()).add(p)
                    grown.add(x)
            if q < n:
                x = (new, symbols[q])
                places.setdefault(x, set()).add(i)
                grown.add(x)
        for x in grown:
            if len(places[x]) > 1:
                heapq.heappush(queue, (-len(places[x]), x))
    return [s for s in symbols if s >= 0]


def grammar_runs(ids: np.ndarray) -> list[Run]:
    """All runs (start, end, period) of a sequence of small integers, by start and period."""
    if len(ids) < LEAST_LENGTH:
        return []
    grammar = Grammar(ids.tolist(), int(ids.max()) + 1)
    at, left, right, starts = grammar.places()
    powers = np.empty(len(ids) + 1, np.uint64)
    powers[0], powers[1:] = 1, _BASE
    powers = np.multiply.accumulate(powers)
    sums = np.concatenate(([np.uint64(0)], np.cumsum((ids.astype(np.uint64) + np.uint64(1)) * powers[:-1], dtype=np.uint64)))
    intervals: dict[int, list[np.ndarray]] = {}
    for k, side, periods in _squares(sums, powers, at, left, right):
        start, end = int(at[k]), int(at[k] + left[k] + right[k])
        for s, e, q in _crossing(ids[start:end], int(left[k]), side, periods):
            intervals.setdefault(q, []).append(np.stack((starts[k] + s, starts[k] + e), axis=1))
    return sorted((s, e, q) for q, parts in intervals.items() for s, e in _merged(np.concatenate(parts), q))


def _squares(sums, powers, at, left, right):
    """Rules with a side of the border (-1 or 1) and ascending periods q: two equal words of length q meet the border there.

    A run of four periods or more that crosses the border has two of them on one side of it. Equality
    is tested by hashes of all pairs of a rule and a period at once; what passes is compared word by
    word later.
    """
    for side, size in ((-1, left), (1, right)):
        most = np.minimum(size // 2, (left + right) // LEAST_PERIODS)
        most[left + right < LEAST_LENGTH] = 0
        todo = np.flatnonzero(most)
        ends = np.cumsum(most[todo])
        begin = 0
        while begin < len(todo):
            done = ends[begin - 1] if begin else 0
            until = max(begin + 1, int(np.searchsorted(ends, done + _TESTS, "right")))
            n = most[todo[begin:until]]
            rule = np.repeat(todo[begin:until], n)
            q = np.arange(1, len(rule) + 1) - np.repeat(np.cumsum(n) - n, n)
            border = at[rule] + left[rule]
            low, high = np.minimum(border, border + 2 * side * q), np.maximum(border, border + 2 * side * q)
            middle = low + q
            fits = np.flatnonzero((sums[middle] - sums[low]) * powers[q] == sums[high] - sums[middle])
            rule, q = rule[fits], q[fits]
            cuts = np.flatnonzero(np.diff(rule)) + 1
            for r, periods in zip(np.split(rule, cuts), np.split(q, cuts)):
                if len(r):
                    yield int(r[0]), side, periods
            begin = until


def _crossing(ids: np.ndarray, border: int, side: int, periods: np.ndarray) -> list[Run]:
    """Runs within ``ids`` that cross the border and have two periods on one side of it."""
    runs: list[Run] = []
    back = ids[::-1]
    n = len(ids)
    while len(periods):
        q = int(periods[0])
        # the words next to the border on this side, and those one period further
        near, far = (border, border + q) if side > 0 else (border - q, border)
        start, end = near - _same(back[n - near:], back[n - far:]), far + _same(ids[far:], ids[near:])
        if end - start < 2 * q:
            periods = periods[1:]
            continue
        # squares that lie inside this run are repeats of it
        periods = periods[(border + 2 * periods > end) if side > 0 else (border - 2 * periods < start)]
        if start < border < end and end - start >= max(LEAST_LENGTH, LEAST_PERIODS * q):
            runs.append((start, end, q))
    return runs


def _same(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix, read in parts of doubling length."""
    n, at, step = min(len(a), len(b)), 0, 32
    while at < n:
        differ = np.flatnonzero(a[at:min(n, at + step)] != b[at:min(n, at + step)])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, step * 2
    return n


def _merged(intervals: np.ndarray, q: int) -> list[tuple[int, int]]:
    """Maximal intervals; those of one period that share that many words are one."""
    intervals = intervals[np.lexsort((intervals[:, 1], intervals[:, 0]))]
    reach = np.maximum.accumulate(intervals[:, 1])
    new = np.concatenate(([True], intervals[1:, 0] > reach[:-1] - q))
    return list(zip(intervals[new, 0].tolist(), reach[np.concatenate((new[1:], [True]))].tolist()))


def distances(words: list) -> np.ndarray:
    """How far back each word stood before; a large number for the first of its kind."""
    last: dict = {}
    out = np.empty(len(words), np.int64)
    known = last.get
    far = -(1 << 40)
    back = []
    for i, word in enumerate(words):
        back.append(i - known(word, far))
        last[word] = i
    out[:] = back
    return out


def candidates(back: np.ndarray) -> list[tuple[int, int]]:
    """Stretches [start, end) that hold all runs; no run has words outside of them or in two of them.

    After the first q words of a run with period q, every word stood at most q words before, for 3 q
    words or more. Such stretches are looked for by powers of two at least q, and begin that much earlier.
    """
    found = []
    k = 0
    while not k or LEAST_PERIODS * (2**(k - 1) + 1) <= len(back):
        least = LEAST_LENGTH - 1 if not k else (LEAST_PERIODS - 1) * (2**(k - 1) + 1)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (back <= 2**k).view(np.int8), [0]))))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= least
        found.append(np.stack((np.maximum(starts[long] - 2**k, 0), ends[long]), axis=1))
        k += 1
    return _merged(np.concatenate(found), 1) if sum(map(len, found)) else []


def word_runs(words: list) -> list[Run]:
    """All runs (start, end, period) of a list of words, by start and period."""
    found = []
    for start, end in candidates(distances(words)):
        numbers: dict = {}
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in words[start:end]], np.int64)
        found += [(start + s, start + e, q) for s, e, q in grammar_runs(ids)]
    return found


_RUNS = ArrayType(StructType([StructField("start", LongType(), False), StructField("length", LongType(), False),
                              StructField("period", LongType(), False)]), False)


def find_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``runs``, stretches of at least four periods and six words, and ``collapsed``, the text without their repeats.

    Words stand between ASCII white space. A run (start, length, period) is a stretch of words with
    that smallest period, which neither neighbour continues; runs are ordered by start and period.
    ``collapsed`` has a run's first period only, and one space between words. A null or empty text
    has no runs and an empty ``collapsed``. Each row is judged by itself, whatever its id; texts are
    read whole. Only words that can lie in a run go into a grammar. Input columns called like the
    new ones are replaced; ``keep`` names the input columns of the result (all, if not given).
    """
    def work(texts):
        out = {"runs": [], "collapsed": []}
        for value in texts:
            words = raw(value).split()
            runs = word_runs(words)
            out["runs"].append([{"start": s, "length": e - s, "period": q} for s, e, q in runs])
            out["collapsed"].append(b" ".join(_collapsed(words, runs) if runs else words))
        return out

    return map_texts(docs, text, lambda: work, [StructField("runs", _RUNS, False), StructField("collapsed", StringType(), False)], keep)


def _collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    out, at = [], 0
    for start, end, period in runs:
        out += words[at:max(at, start + period)]
        at = max(at, end)
    return out + words[at:]


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one and hashes, from the result of ``find_runs``."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """Ids and texts, of which every tenth, by a hash of the id, ends in a repeated passage.

    With h = crc32 of the id as text and g = h / 10, words from a = g % n on repeat the first
    1 + (n - a) / (3 + g % 8) of them, if h % 10 = 0 and there are n > 0 words. Other texts, and
    those without id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    rows = docs.select("doc_id", "text", F.struct((F.expr("0L") + F.floor(h / 10)).alias("g"), F.when(h % 10 == 0, words).alias("words")).alias("parts"))
    g, n = F.col("parts.g"), F.size("parts.words")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    words = F.col("parts.words")
    repeated = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.transform(
        F.sequence(F.lit(0).cast("long"), n - a - 1), lambda i: F.get(words, (a + i % p).cast("int"))))
    return rows.select("doc_id", F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))

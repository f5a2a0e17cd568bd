"""Run detection against a search of all periods."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from spanveil.llm import runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(words):
    """All runs, by comparing the words with themselves moved by each period."""
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and not any(
                    all(words[x] == words[x + r] for x in range(i, j + q - r)) for r in range(1, q)):
                out.append((i, j + q, q))
            i = j + 1
    return sorted(out)


def sequences(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        letters = rng.choice([1, 2, 3, 5])
        out = []
        for _ in range(rng.randint(0, 5)):
            part = [rng.randrange(letters) for _ in range(rng.randint(1, 9))]
            for _ in range(rng.randint(0, 2)):
                part = part * rng.randint(1, 7) + [rng.randrange(letters) for _ in range(rng.randint(0, 3))]
            out += part[:150]
        yield out


def test_runs_of_many_sequences():
    for words in sequences(5, 600):
        want = plain(words)
        assert runs.word_runs(words) == want
        if words:
            assert runs.grammar_runs(np.array(words)) == want


def test_grammar_spells_the_sequence():
    for ids in sequences(6, 200):
        if len(ids) < 2:
            continue
        grammar = runs.Grammar(ids, max(ids) + 1)

        def spelled(symbol):
            return [symbol] if symbol < grammar.first else [y for x in grammar.rules[symbol - grammar.first] for y in spelled(x)]

        assert spelled(grammar.root) == ids
        at, left, right, starts = grammar.places()
        for k in range(len(grammar.rules)):
            text = spelled(grammar.first + k)
            assert len(text) == left[k] + right[k] and all(ids[s:s + len(text)] == text for s in starts[k])


@pytest.mark.parametrize("words, want", [
    (["a"] * 20_000, [(0, 20_000, 1)]), ([str(i % 700) for i in range(14_000)], [(0, 14_000, 700)]),
    ([str(i) for i in range(20_000)], []), (list("abab" * 2), [(0, 8, 2)]), (list("aaaaa"), []), (list("abcabcabcab"), [])])
def test_long_and_short_runs(words, want):
    assert runs.word_runs(words) == want


def test_neighbouring_and_nested_runs_both_count():
    words = list("abcabcabcabc") + list("aaaaaab") * 4
    assert runs.word_runs(words) == plain(words)


def test_query_columns(spark):
    texts = [None, "", " \n\t", "one", "a b " * 9, "go go " * 8, "x\x0by " * 12 + "end", "the same words again and " * 30,
             "\U0001f600 é " * 40, " ".join(map(str, range(200)))] * 6
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "a " * 7, "x", "y"), (3, "a " * 7, "x", "y"), (3, "a " * 7, "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, best string")
    got = sorted((tuple(r) for r in runs.digest(runs.find_runs(runs.with_repeats(docs), keep=["doc_id"])).collect()), key=str)
    want = []
    for doc_id, text, *_ in rows:
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        found = plain(words)
        best = min(found, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
        kept = [w for i, w in enumerate(words) if not any(s + q <= i < e for s, e, q in found)]
        lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
        want.append((doc_id, len(found), *((best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4),
                     hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_other_columns_stay_and_nothing_gives_nothing(spark):
    docs = spark.createDataFrame([(1, "a " * 8 + "b", "z")], "doc_id long, text string, collapsed string")
    row = runs.find_runs(docs).first()
    assert row["text"] == "a " * 8 + "b" and row["collapsed"] == "a b" and row["runs"] == [(0, 8, 1)]
    assert runs.digest(runs.find_runs(runs.with_repeats(docs.limit(0)))).count() == 0

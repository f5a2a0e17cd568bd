"""Benchmark passages in documents, by a generalised suffix automaton of the test items."""
from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from spanveil.llm.text import dropped, free_name, map_texts, raw, words, written

#: Words of test items in one automaton (about 100 bytes each); more items make more automata.
BLOCK_WORDS = 500_000
WINDOW = 10


class Automaton:
    """All runs of consecutive words of some items.

    A state stands for the runs with the same places of occurrence; ``length`` is that of the
    longest, ``link`` the state of the longest suffix with other places.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.length, self.link = [0], [-1]
        seen: list[set[int]] = [set()]
        whole: list[tuple[int, int]] = []
        self.ids = [item for item, _ in items]
        for number, (_, item) in enumerate(items):
            last = 0
            for word in item:
                last = self._extend(last, word, seen)
                seen[last].add(number)
        self.least = min([window, *(len(item) for _, item in items if item)])
        self.vocabulary = {word for _, item in items for word in item}
        self.short: dict[int, list[tuple[int, int]]] = {}
        for number, (_, item) in enumerate(items):
            if 0 < len(item) < window:
                state = 0
                for word in item:
                    state = self.next[state][word]
                self.short.setdefault(state, []).append((len(item), number))
        #: The state of each state's last ``window`` words, and the items that hold them.
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        for state in reversed(order):
            if self.length[self.link[state]] >= window:
                seen[self.link[state]] |= seen[state]
        self.cut = [-1] * len(self.length)
        for state in order:
            if self.length[state] >= window:
                up = self.link[state]
                self.cut[state] = state if self.length[up] < window else self.cut[up]
        #: The longest suffix of each state, itself included, that is a short item; 0 if none is.
        self.short_up = [0] * len(self.length)
        if self.short:
            for state in order:
                self.short_up[state] = state if state in self.short else self.short_up[self.link[state]]
        self.holders = {s: tuple(seen[s]) for s in set(self.cut) - {-1}}

    def _extend(self, last: int, word: bytes, seen: list[set[int]]) -> int:
        nexts, length, link = self.next, self.length, self.link
        if word in nexts[last]:
            known = nexts[last][word]
            return known if length[known] == length[last] + 1 else self._split(last, word, known, seen)
        state = len(length)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        seen.append(set())
        at = last
        while at >= 0 and word not in nexts[at]:
            nexts[at][word] = state
            at = link[at]
        if at >= 0:
            known = nexts[at][word]
            link[state] = known if length[known] == length[at] + 1 else self._split(at, word, known, seen)
        return state

    def _split(self, at: int, word: bytes, known: int, seen: list[set[int]]) -> int:
        copy = len(self.length)
        self.next.append(dict(self.next[known]))
        self.length.append(self.length[at] + 1)
        self.link.append(self.link[known])
        seen.append(set(seen[known]))
        self.link[known] = copy
        while at >= 0 and self.next[at].get(word) == known:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def scan(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Runs of words [start, end) that are hit, and the numbers of the items found.

        Reads the words once, keeping the state of the longest suffix that some item holds.
        """
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        known = np.fromiter(map(self.vocabulary.__contains__, tokens), bool, len(tokens))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start < self.least:
                continue
            state, matched = 0, 0
            for i in range(start, end):
                word = tokens[i]
                while word not in self.next[state]:
                    state = self.link[state]
                    matched = self.length[state]
                state = self.next[state][word]
                matched += 1
                if matched >= self.window:
                    items.update(self.holders[self.cut[state]])
                    _add(spans, i + 1 - self.window, i + 1)
                at = self.short_up[state]
                while at > 0:
                    for n, number in self.short[at]:
                        if n <= matched:
                            items.add(number)
                            _add(spans, i + 1 - n, i + 1)
                    at = self.short_up[self.link[at]]
        return spans, items


def _add(spans: list[tuple[int, int]], start: int, end: int) -> None:
    while spans and start <= spans[-1][1]:
        before, until = spans.pop()
        start, end = min(start, before), max(end, until)
    spans.append((start, end))


def _blocks(benchmark: DataFrame, block_words: int):
    """Items with words, in blocks of at most ``block_words`` words (one item at least), ordered by id."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), "text").where("text is not null")
    for item, text in rows.orderBy("item_id", "text").toLocalIterator():
        if item_words := words(text):
            if block and size + len(item_words) > block_words:
                yield block
                block, size = [], 0
            block.append((item, item_words))
            size += len(item_words)
    if block:
        yield block


_HITS = [StructField("n_words", LongType(), False),
         StructField("hits", ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])), False),
         StructField("items", ArrayType(StringType()), False)]


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
                  keep: list[str] | None = None) -> DataFrame:
    """Adds ``n_words``, ``hits`` (runs of words inside an occurring window) and ``items`` (their ids).

    A window is ``window`` consecutive words of an item, or a whole shorter item. Null and
    empty texts have no words; items without words never occur; repeated items count once by id,
    and those without id are hit but not named. An automaton holds a bounded number of item words. Larger benchmarks make more
    automata, which read the documents one after the other, each from a table in the shared
    folder that the one before wrote, so the result is the same. Input
    columns called like the new ones are replaced. ``keep`` names the input columns of the
    result (all, if not given).
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_words", "hits", "items")]
    blocks = _blocks(benchmark, block_words)
    block, before = next(blocks, []), None
    while True:
        following = next(blocks, None)
        docs = _scan(docs, block, window, before is not None, keep + ["text"] * (following is not None and "text" not in keep))
        if following is None:
            return docs
        docs = written(docs)
        if before:
            dropped(before[0])
        block, before = following, (docs,)


def _scan(docs: DataFrame, block: list, window: int, more: bool, keep: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)
    hits, items = (free_name(c, docs.columns) for c in ("hits", "items"))
    before = docs.withColumns({hits: F.col("hits"), items: F.col("items")}) if more else docs

    def make():
        automaton = Automaton(shared.value, window)

        def work(texts):
            out = {"n_words": [], "hits": [], "items": []}
            for text in texts:
                tokens = words(text)
                spans, numbers = automaton.scan(tokens) if automaton.vocabulary else ([], ())
                out["n_words"].append(len(tokens))
                out["hits"].append([{"start": s, "end": e} for s, e in spans])
                out["items"].append(sorted({automaton.ids[n] for n in numbers} - {None}))
            return out

        return work

    scanned = map_texts(before, "text", make, _HITS, keep + [hits, items] * more)
    if not more:
        return scanned
    merged = F.sort_array(F.concat(hits, "hits"))
    united = F.aggregate(merged, F.array().cast(_HITS[1].dataType), lambda done, x: F.when(
        (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= x["start"]),
        F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(
            F.try_element_at(done, F.lit(-1))["start"].alias("start"),
            F.greatest(F.try_element_at(done, F.lit(-1))["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(done, F.array(x))))
    return (scanned.withColumn("hits", united)
            .withColumn("items", F.array_sort(F.array_union(items, "items")))
            .drop(hits, items))


def digest(found: DataFrame) -> DataFrame:
    """Numbers and a hash of the items, from the result of ``find_passages``."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: float = 0.5,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without benchmark passages.

    A document with more than the share ``most`` of its words in passages goes. From others,
    the hit words are cut, with what stands between them, and a line break takes their place;
    what is left is read again until it holds no passage. Texts without a hit, and null, stay
    as they are. ``n_chars``, if there, follows the text. Items need no id. The hits of all
    automata are joined before a document is judged or cut, so the result is that of one.
    """
    columns = docs.columns
    blocks = _blocks(benchmark, block_words)
    block = next(blocks, [])
    if next(blocks, None) is None:
        return _cut(docs, block, window, most).select(*columns)
    others = [c for c in columns if c != "text"]
    left = docs.select(F.struct(F.lit(0).alias("no"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(others)]).alias("row"), "text")
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    clean, judged = [], False
    while True:
        found = written(find_passages(left, benchmark, window, block_words, ["row", "text"]))
        clean.append(found.where("size(hits) = 0").select("row", "text"))
        left = found.where("size(hits) > 0")
        if not judged:
            left, judged = left.where(n_hit <= F.col("n_words") * most), True
        if left.isEmpty():
            break
        left = left.select("row", F.udf(_without, StringType())("text", "hits").alias("text"))
    done = clean[0]
    for more in clean[1:]:
        done = done.unionByName(more)
    # as in one pass, the number of characters is counted anew for all rows
    place = {c: F.col(f"row.c{k}").alias(c) for k, c in enumerate(others)} | {"text": F.col("text")}
    if "n_chars" in place:
        place["n_chars"] = F.char_length("text").cast("long").alias("n_chars")
    return done.select(*[place[c] for c in columns])


_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with a line break in place of each run of words [start, end)."""
    data = raw(text)
    places = [m.span() for m in _WORD.finditer(data)]
    out, at = [], 0
    for start, end in spans:
        out += [data[at:places[start][0]], b"\n"]
        at = places[end - 1][1]
    return b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")


def _cut(docs: DataFrame, block: list, window: int, most: float) -> DataFrame:
    stays = free_name("stays", docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def make():
        automaton = Automaton(shared.value, window)

        def clean(text):
            first = True
            while text is not None:
                tokens = words(text)
                spans, _ = automaton.scan(tokens)
                if not spans:
                    break
                if first and sum(e - s for s, e in spans) > most * len(tokens):
                    return text, False
                text, first = _without(text, spans), False
            return text, True

        def work(texts):
            done = [clean(t) for t in texts]
            return {"text": [t for t, _ in done], stays: [k for _, k in done],
                    "n_chars": [None if t is None else len(t) for t, _ in done]}

        return work

    fields = [StructField("text", StringType())]
    if "n_chars" in docs.columns:
        fields.append(StructField("n_chars", LongType()))
    return map_texts(docs, "text", make, [*fields, StructField(stays, BooleanType())]).where(F.col(stays)).drop(stays)

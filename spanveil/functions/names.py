"""Masking of names from a user's list, beyond what cue words find."""
from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ..config import Policy
from ..shared import stored
from .detectors import Detector
from .masking import _digest, token

# No part of a word: white space, digits, ASCII but letters, hyphen and apostrophe, Latin-1 signs, general and CJK punctuation.
_OUTSIDE = (r"\s\d!-&(-,./:-@\[-`{-~¡-©«-´¶-¹»-¿×÷‐-‘‚-⁯"
            r"　-〿＀-＠")
_WORD = re.compile(rf"[^{_OUTSIDE}'’-][^{_OUTSIDE}]*")
_ENDING = re.compile(r"(?:['’][sS]?|-)+$")
_NAME = Detector("name", "", "lower")
#: Names that one broadcast holds, 16 bytes each.
SLICE = 2_000_000
_CACHED = 100_000
_ENTRY = StructType([StructField("hash", LongType()), StructField("first", LongType()), StructField("n", IntegerType()),
                     StructField("small", LongType())])
_PLACES = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))


def _plain(word: str) -> str:
    return unicodedata.normalize("NFC", word).lower().replace("’", "'")


def _hash(words: list[str]) -> int:
    return int.from_bytes(hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _small(words: list[str]) -> int:
    """Bits of the words that begin with a small letter; words beyond the 62nd don't count."""
    return sum(1 << k for k, word in enumerate(words[:62]) if word[0].islower())


@F.pandas_udf(_ENTRY)
def _entry(names: pd.Series) -> pd.DataFrame:
    rows = []
    for name in names:
        words = _WORD.findall(name or "")
        plain = [_plain(w) for w in words]
        small = _small(words)
        # a name that is listed in small letters only is one whose case is unknown
        rows.append((_hash(plain), _hash(plain[:1]), len(words), 0 if all(w[0].islower() for w in words) else small))
    return pd.DataFrame(rows, columns=["hash", "first", "n", "small"])


@dataclass(frozen=True)
class _Names:
    """Hashes of names, sorted, with the words that may begin with a small letter; of first words; and numbers of words."""

    hashes: np.ndarray
    small: np.ndarray
    firsts: np.ndarray
    lengths: frozenset

    def finder(self):
        """A function from texts to the places (start, end) of listed names in each."""
        cache: dict[str, tuple[str, bool]] = {}
        most = max(self.lengths)

        def known(word: str) -> tuple[str, bool]:
            if word not in cache:
                if len(cache) >= _CACHED:
                    cache.clear()
                plain = _plain(word)
                cache[word] = plain, any(self._has(self.firsts, _hash([p])) for p in {plain, _ENDING.sub("", plain)})
            return cache[word]

        def find(texts: list[str | None]) -> list[list[tuple[int, int]]]:
            at, hashes, small = [], [], []
            for number, text in enumerate(texts):
                words = list(_WORD.finditer(text or ""))
                plain = [known(w[0]) for w in words]
                for i, (_, may_start) in enumerate(plain):
                    if not may_start:
                        continue
                    for j in range(i, min(len(words), i + most)):
                        if j > i and not _apart(text, words[j - 1], words[j]):
                            break
                        if j - i + 1 not in self.lengths:
                            continue
                        parts = [p for p, _ in plain[i:j + 1]]
                        stem = _ENDING.sub("", parts[-1])
                        for last, end in {(parts[-1], words[j].end()), (stem, words[j].start() + len(_ENDING.sub("", words[j][0])))}:
                            at.append((number, words[i].start(), end))
                            hashes.append(_hash([*parts[:-1], last]))
                            small.append(_small([w[0] for w in words[i:j + 1]]))
            found: list[list[tuple[int, int]]] = [[] for _ in texts]
            if at:
                wanted = np.array(hashes, np.int64)
                place = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
                fits = (self.hashes[place] == wanted) & (np.array(small, np.int64) & ~self.small[place] == 0)
                for k in np.flatnonzero(fits).tolist():
                    number, start, end = at[k]
                    found[number].append((start, end))
            return found

        return find

    @staticmethod
    def _has(values: np.ndarray, value: int) -> bool:
        place = int(np.searchsorted(values, value))
        return place < len(values) and int(values[place]) == value


def _apart(text: str, one: re.Match, two: re.Match) -> bool:
    """Whether only white space stands between two words, or the full stop of an initial."""
    between = text[one.end():two.start()]
    return between.isspace() or one.end() - one.start() == 1 and between[:1] == "." and not between[1:].strip()


def _places_column(text: Column, names) -> Column:
    @F.pandas_udf(_PLACES)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = names.value.finder()
        for batch in batches:
            yield pd.Series([[{"start": s, "end": e} for s, e in places] for places in find(batch.where(batch.notna(), None).tolist())],
                            index=batch.index, dtype=object)

    return run.asNondeterministic()(text)


@F.pandas_udf(ArrayType(StringType()))
def _pieces(texts: pd.Series, places: pd.Series) -> pd.Series:
    """The text before, in and after each name, in turn; null if there is none."""
    out = []
    for text, found in zip(texts, places):
        united: list[list[int]] = []
        for start, end in sorted((p["start"], p["end"]) for p in (found if found is not None else ())):
            if united and start < united[-1][1]:
                united[-1][1] = max(united[-1][1], end)
            else:
                united.append([start, end])
        cuts = [0, *(x for span in united for x in span), None]
        out.append([text[a:b] for a, b in zip(cuts, cuts[1:])] if united else None)
    return pd.Series(out, index=texts.index, dtype=object)


def mask_listed_names(df: DataFrame, column: str, names: DataFrame, policy: Policy, key: str | None = None,
                      slice_names: int = SLICE) -> DataFrame:
    """Mask every listed name in a text column; ``names`` has one column ``name``.

    A name may have any number of words. Its words stand in the text one after the other, in any
    case, with white space or the full stop of an initial in between. Where the list has a capital, the text
    must have one; words like ``van der`` may be small in a name with capitals. An ending ``'s`` stays. Names
    that overlap become one. Null, empty and repeated names don't matter; null texts stay null.

    There is one way for lists of any length, for batches and streams, without a shuffle of ``df`` and without a key
    of its rows (``key`` is not used): tasks look up hashes of 64 bits. ``slice_names`` of them, 16 bytes each, go to
    the tasks at a time; for longer lists a batch is written to the shared folder between slices.
    """
    listed = stored(names.select(_entry(F.col("name").cast("string")).alias("e")).select("e.*").where("n > 0")
                    .groupBy("hash").agg(F.min("first").alias("first"), F.min("n").alias("n"), F.bit_or("small").alias("small")))
    slices = -(-listed.count() // max(1, slice_names))
    if not slices:
        return df
    found = f"{column}_places"
    while found in df.columns:
        found += "_"
    staged = df
    for k in range(slices):
        part = listed.where(F.pmod("hash", F.lit(slices)) == k).toArrow().sort_by("hash")
        if not len(part):
            continue
        hashes, first, n, small = (part[c].to_numpy() for c in ("hash", "first", "n", "small"))
        shared = df.sparkSession.sparkContext.broadcast(_Names(hashes, small, np.unique(first), frozenset(n.tolist())))
        places = _places_column(F.col(column), shared)
        staged = staged.withColumn(found, F.concat(found, places) if found in staged.columns else places)
        if slices > 1 and not df.isStreaming:
            staged = stored(staged)
    replacement = _digest(_NAME, policy) if policy.mode == "hash" else lambda hit: F.lit(token(_NAME, policy))
    pieces = f"{found}_pieces"
    masked = F.when(F.col(pieces).isNull(), F.col(column)).otherwise(F.array_join(
        F.transform(pieces, lambda piece, i: F.when(i % 2 == 1, replacement(piece)).otherwise(piece)), ""))
    cut = staged.withColumn(pieces, _pieces(F.col(column), F.col(found)))
    return cut.select(*(masked.alias(c) if c == column else F.col(c) for c in df.columns))

"""Token sequences of a fixed length, packed by the sum-of-squares rule."""
from __future__ import annotations

import functools
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructField

from spanveil.llm.text import map_texts, written

LENGTH = 2048
END = 0
#: Pieces that one task packs at a time.
SHARD = 20_000
#: Sequences with more free places than this are opened again in the next round.
SLACK = 8
_CHUNKS = 200_000
_MARKS = ".,!?;:*#$%&|"


class _Chunks(dict):
    """Ids of the text between spaces; the tokenizer never joins two such parts.

    Letters below U+0130 have small forms of one letter each, and a mark after one is never joined
    to it, so parts that differ in case or marks have their ids from one entry. Other parts go to
    the tokenizer as they are. Once ``_CHUNKS`` entries are there, they become the older ones, and
    those that aren't used again until the next such change go.
    """

    def __init__(self, tokenizer):
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.letters = ByteLevel(add_prefix_space=False, use_regex=False)
        self.older: dict[str, bytes] = {}

    def word(self, core: str) -> list[int]:
        """Ids of small letters that normalisation leaves alone and that are one word: only the model is needed."""
        spelled = core if core.isascii() else self.letters.pre_tokenize_str(core)[0][0]
        return [token.id for token in self.model.tokenize(spelled)]

    def __missing__(self, chunk: str) -> bytes:
        value = self.older.get(chunk)
        if value is None:
            core = chunk.rstrip(_MARKS)
            if core.isalpha() and (core.isascii() or max(core) < "\u0130"):
                small = core.lower()
                if small == chunk:
                    value = array("I", self.word(chunk)).tobytes()
                else:
                    value = self[small] + self[chunk[len(core):]] if len(core) < len(chunk) else self[small]
            else:
                value = array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        if len(self) >= _CHUNKS:
            self.older = self.copy()
            self.clear()
        self[chunk] = value
        return value


@functools.cache
def _encoder(vocabulary: str):
    """A function from a text to its ids as bytes; each process keeps one for a tokenizer file."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    if not splits_at_spaces(tokenizer) or _Chunks(tokenizer).word("étion") != tokenizer.encode("étion", add_special_tokens=False).ids:
        return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    cache = _Chunks(tokenizer)
    return lambda text: b"".join(map(cache.__getitem__, text.replace("\n", " ").split(" ")))


def splits_at_spaces(tokenizer) -> bool:
    """Whether a tokenizer drops white space, case and all that could join parts of a text."""
    def ids(text):
        return tokenizer.encode(text, add_special_tokens=False).ids

    return ids("Ab cd\nab., 12 É") == [i for part in "ab cd ab ., 12 é".split(" ") for i in ids(part)]


def tokenize(docs: DataFrame, vocabulary: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """Pieces of each document: doc_id, piece, start, length and ``ids`` (unsigned 32-bit, little-endian).

    A document is its token ids and then ``end``, so a null or empty text is one piece of one
    id. Only documents of more than ``length`` ids are cut. ``vocabulary`` is the path of a
    tokenizer file on every machine. Rows are taken one by one, also those with equal or null
    ids.
    """
    fields = [StructField("cut", ArrayType(BinaryType(), False), False)]

    def make():
        ids, last, size = _encoder(vocabulary), np.array([end], "<u4").tobytes(), 4 * length

        def work(texts):
            out = []
            for text in texts:
                data = ids(text or "") + last
                out.append([data[i:i + size] for i in range(0, len(data), size)])
            return {"cut": out}

        return work

    cut = map_texts(docs.select("doc_id", "text"), "text", make, fields, keep=["doc_id"])
    return (cut.select("doc_id", F.posexplode("cut").alias("piece", "ids"))
            .select("doc_id", "piece", (F.col("piece").cast("long") * length).alias("start"),
                    (F.octet_length("ids") / 4).cast("long").alias("length"), "ids"))


def sum_of_squares(sizes: np.ndarray, length: int) -> np.ndarray:
    """The bin of each size, by the sum-of-squares rule; large sizes come first.

    A size goes where the sum of squared counts of open bins per gap becomes smallest; of equal
    changes, into the smallest gap. A bin is opened only for a size that fits no open one.
    """
    counts = np.zeros(length + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(length + 1)]
    bins = np.empty(len(sizes), np.int64)
    opened = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        here = counts[size:length]
        gap = -1
        if here.any():
            # squares grow by 2 n + 1 where a bin comes to n others, and by 1 - 2 n where one leaves n; full bins don't count
            after = 2 * counts[:length - size] + 2
            after[0] = 1
            change = np.where(here > 0, after - 2 * here, np.iinfo(np.int64).max)
            gap = size + int(change.argmin())
        if gap < 0:
            to, gap = opened, length
            opened += 1
        else:
            to = open_bins[gap].pop()
            counts[gap] -= 1
        bins[i] = to
        if gap > size:
            open_bins[gap - size].append(to)
            counts[gap - size] += 1
    return bins


def _pack_shard(shard: pd.DataFrame, length: int) -> pd.DataFrame:
    shard = shard.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
    shard["bin"] = sum_of_squares(shard["length"].to_numpy(), length)
    grouped = shard.groupby("bin")["length"]
    shard["offset"] = grouped.cumsum() - shard["length"]
    shard["free"] = length - grouped.transform("sum")
    return shard


def place(pieces: DataFrame, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """Where each piece goes: row, sequence_id and offset, from row (unique) and length.

    Pieces are dealt out by a hash of the row to shards of about ``shard`` pieces, and each task
    packs one shard. The pieces of sequences with more than a few free places are dealt out
    again, to fewer shards, as long as that at least halves their number. Pieces of full
    length are sequences of their own. An empty table has an empty result.
    """
    done = pieces.where(F.col("length") == length).select(
        "row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    todo = pieces.where(F.col("length") < length).select("row", "length")
    n, turn = todo.count(), 0
    while n:
        shards = -(-n // shard)
        packed = written(
            todo.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(shards)))
            .groupBy("shard").applyInPandas(lambda part: _pack_shard(part, length),
                                            "row long, length long, shard long, bin long, offset long, free long"))
        again = packed.where(F.col("free") > SLACK)
        left = again.count() if shards > 1 else 0
        last = left > n // 2 or not left
        kept = packed if last else packed.where(F.col("free") <= SLACK)
        number = F.lit(turn * 2**48) + F.col("shard") * shard * 4 + F.col("bin")
        done = done.unionByName(kept.select("row", number.alias("sequence_id"), "offset"))
        todo, n, turn = again.select("row", "length"), 0 if last else left, turn + 1
    return done


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, end: int = END, keep_ids: bool = True) -> DataFrame:
    """Documents as pieces of token sequences of at most ``length`` ids.

    Returns doc_id, piece, start, length, ids_crc32, ``ids`` (if kept), sequence_id and offset.
    The pieces of a sequence fill it without gaps. See ``tokenize`` for the pieces and ``place``
    for the packing. Pieces are written to the shared folder once.
    """
    pieces = tokenize(docs, vocabulary, length, end).withColumn("ids_crc32", F.crc32("ids"))
    pieces = written((pieces if keep_ids else pieces.drop("ids")).withColumn("row", F.monotonically_increasing_id()))
    return pieces.join(place(pieces.select("row", "length"), length), "row").drop("row")

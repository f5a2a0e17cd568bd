"""Near duplicates: all pairs of texts whose word shingles have a Jaccard similarity of 0.75 or more.

Orders of all shingles filter the pairs: two similar sets share one of the first shingles of
each, whatever the order. Shingles that many texts share come last in every order, so the
filters hardly see them.

Similar sets share more than one such shingle: ``least_shared`` tells how many.

1. Texts with the same set become one representative.
2. The first shingle under several orders groups representatives. Each is compared with the
   member of its group whose groups are largest, the most central one, so groups of near copies join up in as many comparisons as members.
3. The exact join looks for pairs between what has not joined up yet. Members of one group
   are compared block by block inside tasks, which pass on no more links than join components
   up. Others are compared if they share enough prefix shingles under one order and under another.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructField, StructType

from spanveil.llm.text import cleared, dropped, map_texts, mixed, raw, slices, written

WORDS = 5
PERCENT = 75
#: Orders whose first shingle groups texts in step 2.
FIRSTS = 6
#: Counters for shingle frequencies, and bits to remember which texts a join needs: fixed sizes.
COUNTERS = 1 << 22
BITS = 1 << 24
_COUNTER_PARTS = 64
#: Texts in a block.
BLOCK = 256


_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[str | None], size: int = WORDS) -> list[np.ndarray]:
    """For each text the distinct 64-bit hashes of its runs of ``size`` words, sorted.

    A text with fewer words has one run of all of them, and a text without words none.
    """
    out, at = [], 0
    while at < len(texts):
        tokens: list[bytes] = []
        ends = []
        while at < len(texts) and len(tokens) < 50_000:
            tokens += raw(texts[at]).lower().split()
            ends.append(len(tokens))
            at += 1
        each = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
        grams = _rolled(each, size) if len(each) >= size else each[:0]
        start = 0
        for end in ends:
            if end - start >= size:
                found = grams[start:end - size + 1].copy()
                found.sort()
                new = np.ones(len(found), bool)
                np.not_equal(found[1:], found[:-1], out=new[1:])
                out.append(found[new])
            else:
                out.append(_rolled(each[start:end], end - start) if end > start else each[:0])
            start = end
    return out


def _rolled(each: np.ndarray, size: int) -> np.ndarray:
    n = len(each) - size + 1
    gram = each[:n] + np.uint64(size)
    for k in range(1, size):
        gram *= _ODD
        gram += each[k:k + n]
    return mixed(gram)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """So many shingles come first that a similar set must share one of them."""
    return n - (percent * n + 99) // 100 + 1


def _part(count, over: int, under: int):
    """``count * over / under``, rounded up, in whole numbers."""
    return F.floor((count * over + (under - 1)) / F.lit(under)).cast("long")


def _least_common(a, b, percent: int):
    """So many shingles at least do similar sets of sizes ``a`` and ``b`` share: t / (1 + t) * (a + b)."""
    return _part(a + b, percent, 100 + percent)


def short_prefix(n, percent: int = PERCENT):
    """So many shingles come first that a similar set of the same size or a larger one has one of them in its prefix."""
    return n - _least_common(n, n, percent) + 1


def least_shared(one: str, other: str, percent: int = PERCENT):
    """So many shingles at least are in the prefixes of both of two similar sets, under any order.

    Shared shingles up to the end of the prefix that ends first are in both prefixes, and of
    that set fewer than t * size come later.
    """
    a, b = F.col(one), F.col(other)
    return F.greatest(_least_common(a, b, percent) - _part(F.greatest(a, b), percent, 100) + 1, F.lit(1))


def least_shared_short(small: str, large: str, percent: int = PERCENT):
    """The same for the short prefix of the smaller set and the prefix of the larger one."""
    a, b = F.col(small), F.col(large)
    later = F.greatest(_least_common(a, a, percent), _part(b, percent, 100))
    return F.greatest(_least_common(a, b, percent) - later + 1, F.lit(1))


def _in_reach(small: str, large: str, percent: int):
    """A shared shingle at places ``small.at`` and ``large.at`` of an order leaves room for enough others before and after it."""
    a, b, i, j = (F.col(f"{side}.{c}") for c in ("n", "at") for side in (small, large))
    return F.least(i, j) + 1 + F.least(a - i, b - j) - 1 >= _least_common(a, b, percent)


def ordered(tokens: np.ndarray, order: int, common: np.ndarray) -> np.ndarray:
    """Keys of shingles under an order; those in common buckets come last."""
    keys = mixed(tokens, 100 + order) >> np.uint64(1)
    bucket = (tokens % np.uint64(COUNTERS)).astype(np.int64)
    return keys | (((common[bucket >> 3] >> (bucket & 7)) & 1).astype(np.uint64) << np.uint64(63))


def prefix(tokens: np.ndarray, order: int, common: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first shingles under an order, in this order."""
    keys = ordered(tokens, order, common)
    n = prefix_length(len(tokens), percent)
    first = np.argpartition(keys, n - 1)[:n] if n < len(tokens) else np.arange(len(tokens))
    return tokens[first[np.argsort(keys[first])]]


def _common(docs: DataFrame) -> np.ndarray:
    """Bits of the buckets that hold more texts than chance explains, from counts over all texts.

    Counts are summed in Spark by parts of the table of counters; only the sum, whose size is
    fixed, comes to the driver. The choice changes the order of shingles, never the result.
    """
    width = COUNTERS // _COUNTER_PARTS

    def count(batches):
        counts = np.zeros(COUNTERS, np.int32)
        for batch in batches:
            for part in slices(batch, "text"):
                found = shingle_sets(part.column(0).to_pylist())
                buckets = (np.concatenate(found) % np.uint64(COUNTERS)).astype(np.int64)
                counts += np.bincount(buckets, minlength=COUNTERS).astype(np.int32)
        if counts.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(_COUNTER_PARTS), pa.int32()), pa.array(
                [counts[p * width:(p + 1) * width].tobytes() for p in range(_COUNTER_PARTS)], pa.binary())], ["part", "counts"])

    def add(frame):
        total = np.zeros(width, np.int64)
        for data in frame["counts"]:
            total += np.frombuffer(data, np.int64 if len(data) == 8 * width else np.int32)
        frame = frame.head(1).copy()
        frame["counts"] = [total.tobytes()]
        return frame

    schema = "part int, counts binary"
    rows = docs.select("text").mapInArrow(count, schema).groupBy("part").applyInPandas(add, schema).collect()
    counts = np.zeros(COUNTERS, np.int64)
    for part, data in rows:
        counts[part * width:(part + 1) * width] = np.frombuffer(data, np.int64)
    usual = counts.mean()
    return np.packbits(counts > usual + 5 * np.sqrt(usual) + 10, bitorder="little")


_LONGS = ArrayType(LongType(), False)


def _signed(tokens: np.ndarray) -> np.ndarray:
    return tokens.view(np.int64)


def firsts(tokens: np.ndarray, common: np.ndarray) -> list[int]:
    """The first shingle under each order.

    A text whose prefix reaches into common shingles is mostly made of them. It may be one of
    very many copies, whose shingles are common for that reason, so here they don't come last.
    """
    if not len(tokens):
        return []
    n_rare = (ordered(tokens, 0, common) >> np.uint64(63) == 0).sum()
    at_end = common if n_rare >= prefix_length(len(tokens)) else np.zeros_like(common)
    return [int(_signed(tokens)[ordered(tokens, k, at_end).argmin()]) for k in range(FIRSTS)]


def _features(docs: DataFrame, common, keep: list[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, n, s1, s2 (two hashes of the set) and the first shingle under each order."""
    def make():
        bits = common.value

        def work(texts):
            out = {"n": [], "s1": [], "s2": [], "firsts": []}
            for tokens in shingle_sets(texts):
                out["n"].append(len(tokens))
                out["s1"].append(int(_signed(mixed(tokens, 51)).sum()) if len(tokens) else 0)
                out["s2"].append(int(_signed(np.bitwise_xor.reduce(mixed(tokens, 52), keepdims=True))[0]) if len(tokens) else 0)
                out["firsts"].append(firsts(tokens, bits))
            return out

        return work

    fields = [StructField(c, LongType(), False) for c in ("n", "s1", "s2")] + [StructField("firsts", _LONGS, False)]
    return map_texts(docs, "text", make, fields, list(keep))


def _prefixes(docs: DataFrame, common, order: int) -> DataFrame:
    def make():
        bits = common.value
        return lambda texts: {"tokens": [_signed(prefix(s, order, bits)) for s in shingle_sets(texts)]}

    return map_texts(docs, "text", make, [StructField("tokens", _LONGS, False)], ["doc_id"])


def _bit(doc_id):
    return F.pmod(F.xxhash64(doc_id), F.lit(BITS))


def _bit_map(ids: DataFrame) -> np.ndarray:
    """One bit for the hash of each id: a fixed size, whatever the number of ids."""
    words = (ids.select(_bit("doc_id").alias("bit")).groupBy(F.expr("bit div 32").cast("int").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))").alias("bits"))).toArrow()
    table = np.zeros(BITS // 32, np.uint32)
    table[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return table


def _in_map(at: np.ndarray, bits: np.ndarray) -> pa.Array:
    return pa.array(((bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1).astype(bool))


def _sets(docs: DataFrame, ids: DataFrame, common) -> DataFrame:
    """The sets of the texts named in ``ids`` (and of a few more), with their prefix under order 1.

    A bit map of a fixed size, one bit for the hash of an id, tells tasks which texts to
    read; so texts themselves are not shuffled. The joins that follow use the ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_bit_map(ids))

    def pick(batches):
        bits, at_end = shared.value, common.value
        for batch in batches:
            needed = _in_map(batch.column(2).to_numpy(), bits)
            for part in slices(batch.filter(needed), "text"):
                found = shingle_sets(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([_signed(s) for s in found], pa.list_(pa.int64())),
                     pa.array([_signed(prefix(s, 1, at_end)) for s in found], pa.list_(pa.int64()))], ["doc_id", "tokens", "second"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", _bit("doc_id").alias("bit")).mapInArrow(
        pick, f"doc_id {kind}, tokens array<bigint>, second array<bigint>")


def _told_apart(docs: DataFrame, shared) -> DataFrame:
    """``docs`` with ``repeats``: whether the bit map of repeated ids has the bit of their id. Null ids don't repeat."""
    def tell(batches):
        for batch in batches:
            yield batch.set_column(batch.num_columns - 1, "repeats", _in_map(batch.column("repeats").to_numpy(), shared.value))

    schema = StructType([*docs.schema.fields, StructField("repeats", BooleanType())])
    rows = docs.where("doc_id is not null").withColumn("repeats", _bit("doc_id"))
    return rows.mapInArrow(tell, schema).unionByName(docs.where("doc_id is null").withColumn("repeats", F.lit(False)))


#: Names a set under a repeated id; a row whose id stands in no other row goes by the id.
_OWN = ("doc_id", "n", "s1", "s2")


def _repeated(features: DataFrame):
    """The bit map of ids that stand in several rows, broadcast, or None."""
    again = written(features.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id"))
    return None if again.isEmpty() else features.sparkSession.sparkContext.broadcast(_bit_map(again))


def _one_text_each(docs: DataFrame, shared, common) -> DataFrame:
    """``docs`` under unique names: a row for each set of a repeated id, and all rows of other ids, which are not shuffled."""
    told = _told_apart(docs, shared)
    several = (_features(told.where("repeats"), common, ["doc_id", "text"]).groupBy(*_OWN).agg(F.min("text").alias("text"))
               .select(F.xxhash64(*_OWN).alias("doc_id"), "text"))
    return told.where("not repeats").select("doc_id", "text").unionByName(written(several))


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, with sizes na, nb) that are similar: they must share enough of the prefix under order 1, then the sets are compared."""
    def side(c, what):
        return sets.select(F.col("doc_id").alias(c), F.col(what).alias(f"{what}_{c}"))

    both = pairs.join(side("a", "second"), "a").join(side("b", "second"), "b")
    close = written(both.where(F.size(F.array_intersect("second_a", "second_b")) >= least_shared("na", "nb", percent)).select("a", "b"))
    both = close.join(side("a", "tokens"), "a").join(side("b", "tokens"), "b")
    shared = F.size(F.array_intersect("tokens_a", "tokens_b")).cast("long")
    similar = written(both.where(shared * 100 >= (F.size("tokens_a") + F.size("tokens_b") - shared) * percent).select("a", "b"))
    cleared(pairs.sparkSession)
    return similar


def _joining(table: pa.Table, percent: int) -> pa.Table:
    """Similar pairs between two blocks that join up different components, as few as that takes."""
    name, component, block = (table[c].to_numpy() for c in ("rep", "component", "block"))
    low = block.min()
    tokens = [np.sort(t.values.to_numpy()) for t in table["tokens"].combine_chunks()]
    left = np.flatnonzero(block == low)
    right = np.flatnonzero(block != low) if (block != low).any() else left
    owner = np.repeat(np.arange(len(right)), [len(tokens[i]) for i in right])
    pool = np.concatenate([tokens[i] for i in right])
    order = np.argsort(pool, kind="stable")
    pool, owner = pool[order], owner[order]
    sizes = np.array([len(tokens[i]) for i in right])
    parent = {c: c for c in np.unique(component).tolist()}

    def top(c):
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    links = []
    for i in left.tolist():
        start, end = np.searchsorted(pool, tokens[i], "left"), np.searchsorted(pool, tokens[i], "right")
        many = end - start
        at = np.repeat(start - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
        shared = np.bincount(owner[at], minlength=len(right))
        similar = shared * 100 >= (len(tokens[i]) + sizes - shared) * percent
        for j in right[similar].tolist():
            one, other = top(int(component[i])), top(int(component[j]))
            if one != other:
                parent[max(one, other)] = min(one, other)
                links.append((int(name[i]), int(name[j])))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})


def _within(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members (rep, component) of the same cluster, enough to join up all that similar pairs join.

    Members of a cluster with several components form blocks of about a fixed size, dealt by
    hashes: those of a large component its own, the others common ones. Each pair of blocks is
    one group; blocks of one and the same component don't meet.
    """
    members = written(members)
    sizes = written(members.groupBy("cluster", "component").agg(F.count("*").alias("size")))
    small = sizes.where(F.col("size") < BLOCK).groupBy("cluster").agg(F.sum("size").alias("others"))
    dealt = sizes.join(small, "cluster", "left").withColumn("own", F.when(F.col("size") >= BLOCK, F.col("component")))
    turn = F.when(F.col("own").isNull(), F.pmod(F.xxhash64("component"), F.ceil(F.col("others") / BLOCK))).otherwise(
        F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / BLOCK)))
    blocks = written(members.join(dealt, ["cluster", "component"])
                     .select("cluster", "rep", "component", F.xxhash64("own", turn).alias("block")))
    sums = blocks.groupBy("cluster", "block").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    other = sums.select("cluster", *[F.col(c).alias(f"{c}_2") for c in ("block", "low", "high")])
    meet = (sums.join(other, "cluster").where("block <= block_2 and not (low = high and low_2 = high_2 and low = low_2)")
            .select("cluster", "block", "block_2"))
    sides = meet.select("cluster", "block", "block_2", F.explode(F.array_distinct(F.array("block", "block_2"))).alias("side"))
    rows = (sides.join(blocks.withColumnRenamed("block", "side"), ["cluster", "side"])
            .join(sets.select(F.col("doc_id").alias("rep"), "tokens"), "rep")
            .select("cluster", F.col("block").alias("one"), F.col("block_2").alias("two"), F.col("side").alias("block"), "rep", "component", "tokens"))
    found = written(rows.groupBy("cluster", "one", "two").applyInArrow(lambda table: _joining(table, percent), "a long, b long"))
    cleared(members.sparkSession)
    return found


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of the graph of undirected links (a, b).

    Each round a node takes the smallest label among its own and its neighbours', and then
    the label of that label. A round ends in a written table; rounds stop when nothing changes.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                     .select("node", F.least("low", "node").alias("component")))
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near")))
        better = (labels.join(near, F.col("node") == F.col("a"), "left")
                  .select("node", F.col("component").alias("old"), F.least("component", "near").alias("component")))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        after = written(better.join(jump, "component", "left")
                        .select("node", "old", F.least("component", "next").alias("component")))
        if after.where("component <> old").isEmpty():
            return after.select("node", "component")
        labels = after.select("node", "component")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, ``n_shingles`` and ``component_id`` of each document.

    Two documents link if their sets of shingles are similar; ``component_id`` is the smallest id
    that links reach. Null and empty texts have no shingles and link with nothing. Rows with a
    null id take no part and have a null component. Rows that share an id are reported one by
    one, each by its own text; components that no links join can then have the same smallest id. Sets are compared by 64-bit hashes of shingles.
    """
    found, _ = _grouped(docs, percent)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _grouped(docs: DataFrame, percent: int):
    """doc_id, ``node`` (the name of its set under a repeated id, or its id), n, component (its smallest
    node) and component_id of each row; and the bit map of repeated ids."""
    docs = docs.select("doc_id", "text")
    linked = docs.where("doc_id is not null")
    common = docs.sparkSession.sparkContext.broadcast(_common(linked))
    features = written(_features(docs, common))
    repeated = _repeated(features)
    node = F.col("doc_id")
    if repeated is not None:
        features = _told_apart(features, repeated)
        node = F.when(F.col("repeats"), F.xxhash64(*_OWN)).otherwise(node)
        linked = _one_text_each(linked, repeated, common)
    real = features.where("n > 0 and doc_id is not null").withColumn("node", node)
    first_of = [f"first_{k}" for k in range(FIRSTS)]
    same = real.groupBy("n", "s1", "s2").agg(F.min("node").alias("rep"), F.min("doc_id").alias("low"),
                                             *[F.min(F.col("firsts")[k]).alias(c) for k, c in enumerate(first_of)])
    reps = written(same.withColumn("firsts", F.array(*first_of)).drop(*first_of))
    members = written(real.join(reps.select("n", "s1", "s2", "rep"), ["n", "s1", "s2"]).select("doc_id", "node", "rep", "n"))

    first = reps.select("rep", "n", F.posexplode("firsts").alias("k", "token"))
    sizes = first.groupBy("k", "token").agg(F.count("*").alias("size")).where("size > 1")
    first = written(first.join(sizes, ["k", "token"]))
    central = first.groupBy("rep").agg(F.sum(F.log("size")).alias("centre"))
    first = first.join(central, "rep")
    member = F.struct(F.round("centre", 6).alias("centre"), F.xxhash64("rep").alias("turn"), "rep", "n")
    heads = first.groupBy("k", "token").agg(F.max(member).alias("head"))
    grouped = written(first.join(heads, ["k", "token"]).select("rep", "n", "head").distinct())
    stars = (grouped.where(_sizes("n", "head.n", percent) & (F.col("rep") != F.col("head.rep")))
             .select(F.array_sort(F.array(F.struct("rep", "n"), F.struct("head.rep", "head.n"))).alias("pair")).select(*_pair("pair")).distinct())
    sets = written(_sets(linked, grouped.select(F.col("rep").alias("doc_id")).distinct(), common))
    joined = components(_similar(stars, sets, percent))
    clusters = grouped.groupBy("rep").agg(F.max("head")["rep"].alias("cluster"))
    known = written(_named(reps.select("rep", "n"), joined).join(clusters, "rep", "left")
                    .select("rep", "n", "component", F.coalesce("cluster", "rep").alias("cluster")))
    mixed_up = known.groupBy("cluster").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    inner = _within(known.join(mixed_up.select("cluster"), "cluster").select("cluster", "rep", "component"), sets, percent)
    dropped(sets)
    known = written(_bridged(known, inner))

    cleared(docs.sparkSession)
    pairs = (_sharing(linked, known, common, percent).groupBy("a", "b", "na", "nb").agg(F.count("*").alias("shared"))
             .where(F.col("shared") >= least_shared_short("na", "nb", percent)))
    pairs = written(pairs)
    sets = written(_sets(linked, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), common))
    late = _similar(pairs, sets, percent)
    dropped(sets)
    whole = _bridged(known, late).select("rep", "component", F.col("component").alias("component_id"))
    if repeated is not None:
        whole = written(whole)
        lows = whole.join(reps.select("rep", "low"), "rep").groupBy("component").agg(F.min("low").alias("low"))
        whole = whole.join(lows, "component").select("rep", "component", F.col("low").alias("component_id"))
    found = members.join(whole, "rep").select("doc_id", "node", "n", "component", "component_id")
    nothing = [F.lit(None).cast(found.schema[c].dataType).alias(c) for c in ("node", "component")]
    rest = features.where("n = 0 or doc_id is null").select("doc_id", nothing[0], "n", nothing[1], F.col("doc_id").alias("component_id"))
    return found.unionByName(rest), repeated


def _sharing(docs: DataFrame, known: DataFrame, common, percent: int) -> DataFrame:
    """A row (a, b, na, nb) for each shingle in the short prefix of ``a`` and the prefix of ``b`` under order 0.

    ``a`` is the smaller set. Pairs have joined up neither as a component nor as a cluster, and
    the places of the shingle leave room for enough others. The short prefix is what keeps
    apart texts that share one long passage: most of them share less than it takes.
    """
    tokens = written(_prefixes(docs, common, 0).join(known, F.col("doc_id") == F.col("rep"))
                     .select(F.posexplode("tokens").alias("at", "token"), "rep", "n", "cluster")
                     .select("token", "at", (F.col("at") < short_prefix(F.col("n"), percent)).alias("short"), "rep", "cluster"))
    wanted = (tokens.groupBy("token").agg(F.min("cluster").alias("low"), F.max("cluster").alias("high"), F.bool_or("short").alias("wanted"))
              .where("low <> high and wanted").select("token"))
    split = written(tokens.join(wanted, "token").select("token", "at", "short", "rep"))
    dropped(tokens)
    split = written(split.join(known, "rep"))
    cleared(docs.sparkSession)
    left, right = split.where("short").alias("l"), split.alias("r")
    later = (F.col("l.n") < F.col("r.n")) | ((F.col("l.n") == F.col("r.n")) & (F.col("l.rep") < F.col("r.rep")))
    return (left.join(right, (F.col("l.token") == F.col("r.token")) & later
                      & (F.col("l.component") != F.col("r.component")) & (F.col("l.cluster") != F.col("r.cluster"))
                      & _sizes("l.n", "r.n", percent) & _in_reach("l", "r", percent))
            .select(F.col("l.rep").alias("a"), F.col("r.rep").alias("b"), F.col("l.n").alias("na"), F.col("r.n").alias("nb")))


def _pair(column: str):
    """The two members of a sorted pair, with the sizes of their sets."""
    return [F.col(column)[k][c].alias(name) for k, c, name in ((0, "rep", "a"), (1, "rep", "b"), (0, "n", "na"), (1, "n", "nb"))]


def _named(reps: DataFrame, joined: DataFrame) -> DataFrame:
    """Representatives with their component; those without links are their own."""
    return (reps.join(joined.withColumnRenamed("node", "rep"), "rep", "left")
            .withColumn("component", F.coalesce("component", "rep")))


def _bridged(known: DataFrame, links: DataFrame) -> DataFrame:
    """``known`` with the components that links between representatives join up."""
    names = known.select("rep", "component")
    bridges = (links.join(names.toDF("a", "ca"), "a").join(names.toDF("b", "cb"), "b")
               .select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    final = components(bridges).toDF("component", "final")
    return known.join(final, "component", "left").withColumn("component", F.coalesce("final", "component")).drop("final")


def _sizes(one: str, other: str, percent: int):
    """Sets of such sizes can be similar."""
    return F.least(one, other) * 100 >= F.greatest(one, other) * percent


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents without near duplicates: of each component the one with the smallest id.

    Of rows that share this id, one stays. Documents without an id or without words stay.
    """
    found, repeated = _grouped(docs, percent)
    if repeated is None:
        gone = found.where("doc_id <> component_id").select("doc_id")
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    found = written(found)
    heads = (found.where("node is not null").groupBy("component").agg(F.min(F.struct("doc_id", "node")).alias("head"))
             .select(F.col("head.node").alias("node")))
    told = _told_apart(docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text"), repeated)
    gone = _told_apart(found.where("doc_id <> component_id").select("doc_id"), repeated).where("not repeats").select("doc_id")
    single = told.where("not repeats").join(gone, "doc_id", "left_anti").select("row.*")
    none = docs.sparkSession.sparkContext.broadcast(np.zeros(COUNTERS // 8, np.uint8))
    several = _features(told.where("repeats"), none, ["row", "doc_id", "text"]).withColumn("node", F.xxhash64(*_OWN))
    kept = (several.where("n > 0").join(heads, "node", "left_semi").groupBy("node").agg(F.min_by("row", "text").alias("row")).select("row.*"))
    return single.unionByName(kept).unionByName(several.where("n = 0").select("row.*"))

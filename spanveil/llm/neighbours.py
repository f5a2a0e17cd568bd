"""Approximate nearest neighbours by inner product: NN-descent builds a graph, queries walk it greedily.

Graph and queries live in Spark tables; each round of either is a few joins and ends in a
written table. Nodes are distinct vectors. To find large inner products by a graph of near
points, each vector gets one more component that brings all to the same length. Vectors whose
lengths differ by more than a factor of four are in different classes, each with its own scale
and its own part of the graph, and every query searches all classes.
"""
from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanveil.llm.text import cleared, written

#: Neighbours that a node keeps while the graph is built, and for each of them the nodes that point to it in the search.
DEGREE, BACK = 20, 3
ROUNDS = 10
#: Rounds end when a smaller share of all neighbours is new.
SETTLED = 0.02
#: Nodes from which each query starts besides its own, the nodes it remembers, and those it follows in a round.
ENTRIES, BEAM, STEP = 256, 512, 96
#: Entries of all classes together, where there are many.
ALL_ENTRIES = 4096
#: Nodes that one task joins at a time, offers for a node that it passes on, and vectors in a row of the finished graph.
BUCKET, OFFERS, CHUNK = 1024, 10, 8
#: Random orders in which consecutive nodes are the first neighbours.
TABLES, BLOCK, PLANES = 4, 24, 14

_STATE = "id long, vec binary, ids binary, sims binary, fresh binary"
_OFFER = "id long, ids binary, sims binary"


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part; rows that share an id all do.

    Null ids, null or zero vectors, vectors with a null or non-finite component, and vectors with
    another number of components than most take no part.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = (embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~bad)
            .where(F.exists("embedding", lambda x: x != 0)).select("vec_id", "embedding"))
    size = good.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return good.where(F.size("embedding") == (size[0][0] if size else 0))


def _rows(column, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def _matrix(column, width: int) -> np.ndarray:
    """The vectors of a binary column without nulls, not copied if they are in one piece."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty((0, width), np.float32)
    _, starts, data = column.buffers()
    return np.frombuffer(data, np.float32, len(column) * width, int(np.frombuffer(starts, "i4")[column.offset])).reshape(-1, width)


def _flat(table: pa.Table, names: dict[str, str]) -> tuple[np.ndarray, ...]:
    """The row of each entry of binary columns, and their entries one after the other."""
    lists = {c: _rows(table[c], kind) for c, kind in names.items()}
    sizes = [len(x) for x in next(iter(lists.values()))]
    empty = {c: np.empty(0, kind) for c, kind in names.items()}
    return np.repeat(np.arange(len(sizes)), sizes), *[np.concatenate([empty[c], *lists[c]]) for c in names]


def _best(target, other, sim, old, most):
    """The ``most`` best entries of each target, without repeats; of these the old one stays."""
    order = np.lexsort((-old.astype(np.int8), other, target))
    target, other, sim, old = target[order], other[order], sim[order], old[order]
    new = np.ones(len(target), bool)
    new[1:] = (target[1:] != target[:-1]) | (other[1:] != other[:-1])
    target, other, sim, old = target[new], other[new], sim[new], old[new]
    order = np.lexsort((other, -sim, target))
    target, other, sim, old = target[order], other[order], sim[order], old[order]
    starts = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1]))) if len(target) else np.empty(0, int)
    rank = np.arange(len(target)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(target)]))))
    kept = rank < most
    return target[kept], other[kept], sim[kept], old[kept]


def _by_target(target, *columns):
    starts = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1]))) if len(target) else np.empty(0, int)
    ends = np.concatenate((starts[1:], [len(target)]))
    return target[starts], [[c[s:e].tobytes() for s, e in zip(starts.tolist(), ends.tolist())] for c in columns]


def _offers(target, other, sim, most=OFFERS) -> pa.Table:
    target, other, sim, _ = _best(target, other, sim, np.zeros(len(target), bool), most)
    ids, (others, sims) = _by_target(target, other, sim.astype(np.float32))
    return pa.table({"id": ids, "ids": pa.array(others, pa.binary()), "sims": pa.array(sims, pa.binary())})


def _block_offers(batches, width: int):
    """Offers among consecutive nodes of the same class."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, level = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        x = _matrix(batch.column(1), width)
        parts = []
        for start in range(0, len(ids), BLOCK):
            part = slice(max(0, min(start, len(ids) - BLOCK)), start + BLOCK)
            sims = x[part] @ x[part].T
            a, b = np.nonzero((level[part][:, None] == level[part]) & ~np.eye(len(sims), dtype=bool))
            parts.append((ids[part][a], ids[part][b], sims[a, b]))
        yield from _offers(*map(np.concatenate, zip(*parts)), most=DEGREE).to_batches()


def _join_offers(table: pa.Table, width: int) -> pa.Table:
    """Offers among the nodes around each node: pairs of which one is new to it, better than what either has."""
    u, v = table["u"].to_numpy(), table["v"].to_numpy()
    order = np.lexsort((v, u))
    fresh, worst = table["fresh"].to_numpy(zero_copy_only=False)[order], table["worst"].to_numpy()[order]
    u, v = u[order], v[order]
    x = _matrix(table["vec"], width)[order]
    same = np.zeros(len(u), bool)
    same[1:] = (u[1:] == u[:-1]) & (v[1:] == v[:-1])
    starts = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1])))
    parts = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32))]
    for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(u)]):
        sims = x[s:e] @ x[s:e].T
        use = fresh[s:e, None] | fresh[None, s:e]
        use &= ~(same[s:e, None] | same[None, s:e]) & (sims > worst[s:e, None])
        np.fill_diagonal(use, False)
        a, b = np.nonzero(use)
        parts.append((v[s + a], v[s + b], sims[a, b]))
    return _offers(*map(np.concatenate, zip(*parts)))


def _merge(table: pa.Table, degree: int) -> pa.Table:
    """States with the offers for them: the best neighbours of both."""
    table = table.filter(pc.is_valid(table["id"]))
    ids = table["id"].to_numpy()
    own = table["vec"].is_valid().to_numpy()
    row, other, sim = _flat(table, {"ids": "i8", "sims": "f4"})
    old = own[row]
    target, other, sim, old = _best(ids[row], other, sim, old, degree)
    found, lists = _by_target(target, other, sim, (~old).astype(np.uint8))
    lists = dict(zip(found.tolist(), zip(*lists)))
    states = table.filter(table["vec"].is_valid())
    merged = [lists.get(i, (b"", b"", b"")) for i in states["id"].to_pylist()]
    return pa.table({"id": states["id"], "vec": states["vec"].cast(pa.binary()),
                     **{c: pa.array([m[k] for m in merged], pa.binary()) for k, c in enumerate(("ids", "sims", "fresh"))}})


def _bucketed(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(max(1, -(-n // BUCKET)))))


def _merged(state: DataFrame, offers: DataFrame, n: int, degree: int) -> DataFrame:
    both = state.select("id", "vec", "ids", "sims").unionByName(offers, allowMissingColumns=True)
    return written(_bucketed(both, "id", n).groupBy("bucket").applyInArrow(
        lambda table: _merge(table, degree), _STATE))


def _lot(u, v) -> np.ndarray:
    """A fixed pseudo-random number for each edge."""
    x = u.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + v.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(27))) >> np.uint64(1)).astype(np.int64)


def _edges(state: DataFrame, most: int) -> DataFrame:
    """u, v, fresh: v is a neighbour of u, or u one of v's; at most ``most`` of the latter for a node, new ones first.

    Each batch sends no more than that for a node, so a node to which very many point is not
    sorted whole in one task.
    """
    def explode(batches):
        for batch in batches:
            table = pa.table({"ids": batch.column(1), "fresh": batch.column(2)})
            row, other, fresh = _flat(table, {"ids": "i8", "fresh": "u1"})
            ids, lot = batch.column(0).to_numpy()[row], _lot(batch.column(0).to_numpy()[row], other)
            order = np.lexsort((ids, lot, fresh == 0, other))
            new = np.ones(len(order), bool)
            new[1:] = other[order][1:] != other[order][:-1]
            starts = np.flatnonzero(new)
            rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
            back = order[rank < most]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate((ids, other[back]))), pa.array(np.concatenate((other, ids[back]))),
                pa.array(np.concatenate((fresh, fresh[back])) == 1), pa.array(np.concatenate((lot, lot[back]))),
                pa.array(np.repeat([False, True], [len(ids), len(back)]))], ["u", "v", "fresh", "lot", "back"])

    edges = state.select("id", "ids", "fresh").mapInArrow(explode, "u long, v long, fresh boolean, lot long, back boolean")
    turn = Window.partitionBy("u", "back").orderBy(F.desc("fresh"), "lot", "v")
    return edges.withColumn("turn", F.row_number().over(turn)).where(~F.col("back") | (F.col("turn") <= most)).drop("turn", "lot", "back")


def _with_vectors(edges: DataFrame, state: DataFrame, degree: int) -> DataFrame:
    def worst(batches):
        for batch in batches:
            sims = _rows(batch.column(2), "f4")
            low = np.array([s[-1] if len(s) >= degree else -np.inf for s in sims], np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(low)], ["v", "vec", "worst"])

    nodes = state.select("id", "vec", "sims").mapInArrow(worst, "v long, vec binary, worst float")
    return edges.join(nodes, "v")


def build_graph(nodes: DataFrame, width: int, n: int, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """The neighbours of each node, by NN-descent: id, vec, ids, sims, fresh (binary arrays, best first).

    Nodes (id, vec, level) start with neighbours of their class (level) from random orders, and
    so meet no others. In each round all nodes around a
    node, in either direction, meet and offer themselves to each other, unless both were there
    before. Rounds end when few neighbours are new.
    """
    state = written(nodes.select("id", "vec", *[F.lit(b"").alias(c) for c in ("ids", "sims", "fresh")]))
    planes = np.random.default_rng(11).standard_normal((TABLES, PLANES + 1, width)).astype(np.float32)
    offers = None
    for t in range(TABLES):
        def keyed(batches, at=planes[t]):
            for batch in batches:
                x = _matrix(batch.column(1), width)
                y = x @ at.T
                code = (y[:, :PLANES] > 0) @ (1 << np.arange(PLANES)) + 1 / (1 + np.exp(-y[:, PLANES].astype(np.float64)))
                yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(3)], pa.array(code)], ["id", "vec", "level", "code"])

        rows = nodes.select("id", "vec", "level").mapInArrow(keyed, "id long, vec binary, level int, code double")
        rows = rows.repartitionByRange(max(1, -(-n // BUCKET)), "level", "code", "id").sortWithinPartitions("level", "code", "id")
        found = rows.select("id", "vec", "level").mapInArrow(lambda batches: _block_offers(batches, width), _OFFER)
        offers = found if offers is None else offers.unionByName(found)
    state = _merged(state, offers, n, degree)
    for _ in range(rounds):
        edges = _edges(state, degree)
        busy = edges.withColumn("any", F.max("fresh").over(Window.partitionBy("u"))).where("any").drop("any")
        rows = _bucketed(_with_vectors(busy, state, degree), "u", n)
        offers = rows.groupBy("bucket").applyInArrow(lambda table: _join_offers(table, width), _OFFER)
        state = _merged(state, offers, n, degree)
        cleared(nodes.sparkSession)
        new = state.select(F.sum(F.octet_length(F.translate(F.hex("fresh"), "0", "")))).first()[0] or 0
        if new < SETTLED * n * degree:
            break
    return state


def _adjacency(state: DataFrame, width: int, n: int, degree: int) -> DataFrame:
    """id, ids and vecs: the neighbours of a node in both directions, with their vectors, in rows of at most ``CHUNK``."""
    def gather(table: pa.Table) -> pa.Table:
        u, v = table["u"].to_numpy(), table["v"].to_numpy()
        order = np.lexsort((v, u))
        order = order[np.concatenate(([True], (u[order][1:] != u[order][:-1]) | (v[order][1:] != v[order][:-1])))]
        x, u, v = _matrix(table["vec"], width)[order], u[order], v[order]
        starts = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1])))
        rank = np.arange(len(u)) - np.repeat(starts, np.diff(np.append(starts, len(u))))
        starts = np.flatnonzero(rank % CHUNK == 0)
        parts = list(zip(starts.tolist(), [*starts[1:].tolist(), len(u)]))
        return pa.table({"id": u[starts], "ids": pa.array([v[s:e].tobytes() for s, e in parts], pa.binary()),
                         "vecs": pa.array([x[s:e].tobytes() for s, e in parts], pa.binary())})

    rows = _bucketed(_with_vectors(_edges(state, BACK * degree), state, degree), "u", n)
    return rows.groupBy("bucket").applyInArrow(gather, "id long, ids binary, vecs binary")


def _frontier(ids, seen, step):
    """Places of the best nodes in a beam that were not followed yet."""
    return np.flatnonzero(seen == 0)[:step]


def _walk(seeds: DataFrame, graph: str, entries: dict[int, tuple[np.ndarray, np.ndarray]], width: int, n: int, beam: int, step: int) -> DataFrame:
    """The beam of each seed (id, vec, own, level): id, ids, sims.

    A seed is a query in one class (level), with its own node if it is of that class, else -1.
    ``graph`` names the table of neighbours, bucketed by id.
    """
    spark = seeds.sparkSession
    shared = spark.sparkContext.broadcast(entries)

    def begin(batches):
        for batch in batches:
            out = []
            for vec, own, level in zip(*[batch.column(k).to_pylist() for k in range(1, 4)]):
                at, vecs = shared.value[level]
                q = np.frombuffer(vec, np.float32)
                sims = vecs @ _asked(q)
                if own >= 0:
                    at, sims = np.append(at, own), np.append(sims, np.float32(_asked(q) @ q))
                _, at, sims, _ = _best(np.zeros(len(at), np.int64), at, sims, np.zeros(len(at), bool), beam)
                out.append((at.tobytes(), sims.tobytes(), bytes(len(at))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array([x[k] for x in out], pa.binary()) for k in range(3)]],
                                             ["id", "vec", "ids", "sims", "fresh"])

    def ask(batches):
        for batch in batches:
            node, query, vec, worst = [], [], [], []
            for q, v, ids, sims, seen in zip(*[batch.column(k).to_pylist() for k in range(5)]):
                ids, sims = np.frombuffer(ids, "i8"), np.frombuffer(sims, "f4")
                at = ids[_frontier(ids, np.frombuffer(seen, "u1"), step)]
                node.append(at)
                query += [q] * len(at)
                vec += [v] * len(at)
                worst += [float(sims[-1]) if len(sims) >= beam else float("-inf")] * len(at)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *node])), pa.array(query, pa.int64()),
                                              pa.array(vec, pa.binary()), pa.array(worst, pa.float32())], ["node", "query", "vec", "worst"])

    def score(batches):
        for batch in batches:
            out = []
            for vec, worst, ids, vecs in zip(*[batch.column(k).to_pylist() for k in range(1, 5)]):
                sims = np.frombuffer(vecs, np.float32).reshape(-1, width) @ _asked(np.frombuffer(vec, np.float32))
                better = sims > worst
                out.append((np.frombuffer(ids, "i8")[better].tobytes(), sims[better].tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([x[k] for x in out], pa.binary()) for k in range(2)]], ["id", "ids", "sims"])

    def merge(table: pa.Table) -> pa.Table:
        own = table.filter(table["vec"].is_valid())
        seen = {}
        for q, ids, flags in zip(own["id"].to_pylist(), own["ids"].to_pylist(), own["fresh"].to_pylist()):
            flags = np.frombuffer(flags, "u1").copy()
            flags[_frontier(None, flags, step)] = 1
            seen[q] = flags
        row, other, sim = _flat(table, {"ids": "i8", "sims": "f4"})
        mine = table["vec"].is_valid().to_numpy()
        old = np.zeros(len(row), bool)
        old[mine[row]] = np.concatenate([np.empty(0, "u1"), *[seen[q] for q in own["id"].to_pylist()]]) == 1
        target, other, sim, old = _best(table["id"].to_numpy()[row], other, sim, old, beam)
        found, lists = _by_target(target, other, sim, old.astype(np.uint8))
        lists = dict(zip(found.tolist(), zip(*lists)))
        merged = [lists[q] for q in own["id"].to_pylist()]
        return pa.table({"id": own["id"], "vec": own["vec"].cast(pa.binary()),
                         **{c: pa.array([m[k] for m in merged], pa.binary()) for k, c in enumerate(("ids", "sims", "fresh"))}})

    state = written(seeds.select("id", "vec", "own", "level").mapInArrow(begin, _STATE))
    done = None
    while True:
        unseen = F.hex("fresh").rlike("^(..)*00")
        settled = state.where(~unseen).select("id", "ids", "sims")
        done = settled if done is None else done.unionByName(settled)
        state = state.where(unseen)
        if state.isEmpty():
            return done
        asked = state.mapInArrow(ask, "node long, query long, vec binary, worst float")
        near = asked.join(spark.table(graph), F.col("node") == F.col("id")).select("query", "vec", "worst", "ids", "vecs")
        offers = near.mapInArrow(score, _OFFER).where(F.octet_length("ids") > 0)
        both = state.unionByName(offers, allowMissingColumns=True)
        state = written(_bucketed(both, "id", n // 4).groupBy("bucket").applyInArrow(merge, _STATE))
        cleared(spark)


def _asked(q: np.ndarray) -> np.ndarray:
    """A node's vector as a query: without the component that was added."""
    q = q.copy()
    q[-1] = 0
    return q


def _length(x: np.ndarray) -> np.ndarray:
    """The binary logarithm of the length of each row; no square overflows or vanishes."""
    most = np.abs(x).max(1)
    return np.log2(most) + np.log2(np.sqrt(((x / most[:, None]) ** 2).sum(1)))


def _classed(reps: DataFrame, size: int) -> DataFrame:
    """Nodes (id, vec, level): vectors divided by the longest of their class, with the component that evens their lengths.

    The classes are a factor of four wide, and the median length is in the middle of one. With a
    scale far above the lengths, near points would have small distances, not large products.
    """
    def lengths(batches):
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), np.float64).reshape(-1, size)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(_length(x))], ["id", "embedding", "log"])

    logs = reps.select("id", "embedding").mapInArrow(lengths, f"id long, embedding {reps.schema['embedding'].dataType.simpleString()}, log double")
    middle = logs.agg(F.percentile_approx("log", 0.5, 1000)).first()[0]
    logs = logs.withColumn("level", F.floor((F.col("log") - middle) / 2 + 0.5).cast("int"))
    longest = dict(logs.groupBy("level").agg(F.max("log")).collect())

    def scaled(batches):
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), np.float64).reshape(-1, size)
            half = np.exp2(np.array([longest[c] / 2 for c in batch.column(3).to_pylist()]))[:, None]
            x = x / half / half
            extra = np.sqrt(np.maximum(1 - (x * x).sum(1, keepdims=True), 0))
            rows = np.concatenate((x, extra), 1).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary()), batch.column(3)], ["id", "vec", "level"])

    return written(logs.mapInArrow(scaled, "id long, vec binary, level int"))


def search(embeddings: DataFrame, every: int, k: int, degree: int = DEGREE, beam: int = BEAM, step: int = STEP) -> DataFrame:
    """The ``k`` nearest vectors found for each row whose vec_id is divisible by ``every``.

    Returns query_id, rank, vec_id and score, the inner product in double precision. All rows but
    the query's own are candidates, also those that share its id; a repeated row is asked for
    each time. Ties go to the smaller id. Equal vectors are one node of the graph, of
    which the k + 1 smallest ids matter. See ``usable`` for rows that take no part. Classes of lengths
    are searched one by one, those of up to 256 different vectors as a whole, unless there are
    more than 16 classes. An empty table gives an empty result.
    """
    spark = embeddings.sparkSession
    rows = written(usable(embeddings).withColumn("row", F.monotonically_increasing_id()))
    reps = written(rows.groupBy("embedding").agg(F.min("row").alias("id")))
    n, size = reps.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = size + 1
    turn = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id", "row"))
    members = written(rows.withColumn("at", turn).where(F.col("at") <= k + 1).join(reps, "embedding").select("id", "vec_id", "row"))
    asked = written(rows.where(F.col("vec_id") % every == 0).join(reps, "embedding").select("id", "vec_id", "row"))

    nodes = _classed(reps, size)
    levels = [r[0] for r in nodes.select("level").distinct().orderBy("level").collect()]
    name = f"llm_graph_{uuid.uuid4().hex}"
    try:
        state = build_graph(nodes, width, n, degree)
        parts = max(8, min(1024, -(-n // BUCKET)))
        _adjacency(state, width, n, degree).repartition(parts, "id").write.bucketBy(parts, "id").sortBy("id").saveAsTable(name)
        turn = F.row_number().over(Window.partitionBy("level").orderBy(F.xxhash64("id"), "id"))
        first = nodes.withColumn("at", turn).where(F.col("at") <= min(ENTRIES, max(4, ALL_ENTRIES // len(levels)))).collect()
        entries = {level: (np.array([r["id"] for r in first if r["level"] == level], np.int64),
                           np.array([np.frombuffer(r["vec"], np.float32) for r in first if r["level"] == level])) for level in levels}
        seeds = (nodes.join(asked.select(F.col("id").alias("node")).distinct(), F.col("id") == F.col("node")).select(
            "node", "vec", F.col("level").alias("home"), F.explode(F.array(*map(F.lit, levels))).alias("level"))
            .withColumn("own", F.when(F.col("home") == F.col("level"), F.col("node")).otherwise(-1).cast("long"))
            .withColumn("id", F.monotonically_increasing_id()))
        seeds = written(seeds)
        found = _walk(seeds, name, entries, width, n * len(levels), beam, step)
        found = written(found.join(seeds.select("id", "node"), "id").select(F.col("node").alias("id"), "ids", "sims"))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return _exact(found, reps, members, asked, k, width)


def _exact(found: DataFrame, reps: DataFrame, members: DataFrame, asked: DataFrame, k: int, width: int) -> DataFrame:
    """Exact scores of the best nodes of each beam, and the rows behind them.

    All nodes of a beam have an exact score but those whose rounded score is so low that they
    can't be among the best k + 1.
    """
    margin = 4 * width * np.finfo(np.float32).eps

    def best(batches):
        for batch in batches:
            out = []
            for ids, sims in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                ids, sims = np.frombuffer(ids, "i8"), np.frombuffer(sims, "f4")
                out.append(ids[sims >= sims[min(k, len(sims) - 1)] - margin])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), [len(x) for x in out])),
                                              pa.array(np.concatenate([np.empty(0, np.int64), *out]))], ["query", "node"])

    pairs = found.select("id", "ids", "sims").mapInArrow(best, "query long, node long")
    dot = F.aggregate(F.zip_with("q", "x", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, y: s + y)
    scored = (pairs.join(reps.select(F.col("id").alias("query"), F.col("embedding").alias("q")), "query")
              .join(reps.select(F.col("id").alias("node"), F.col("embedding").alias("x")), "node")
              .select("query", "node", dot.alias("score")))
    rows = scored.join(members.withColumnRenamed("id", "node"), "node")
    turn = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row"))
    lists = (rows.withColumn("turn", turn).where(F.col("turn") <= k + 1).groupBy("query")
             .agg(F.sort_array(F.collect_list(F.struct("turn", "vec_id", "score", "row"))).alias("list")))
    out = asked.select(F.col("id").alias("query"), F.col("vec_id").alias("query_id"), F.col("row").alias("mine")).join(lists, "query")
    others = F.slice(F.filter("list", lambda x: x["row"] != F.col("mine")), 1, k)
    return (out.select("query_id", F.posexplode(others).alias("place", "other"))
            .select("query_id", (F.col("place") + 1).alias("rank"), F.col("other.vec_id").alias("vec_id"), F.col("other.score").alias("score")))

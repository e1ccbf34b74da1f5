"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

Equal vectors are one node that lists its smallest ids, so a vector shared by very many rows is one
point of the graph.  The first graph comes from a few orders of the nodes along random hyperplanes,
cut into short blocks.  Each round then joins every node with its neighbours and the nodes it is a
neighbour of, compares the vectors met there, and gives each its nearest; rounds end when few lists
change.  A query starts from the nearest of a bounded sample of nodes, and from its own if it is in
the index, and walks along links to ever nearer nodes, a few nodes at a time, so that what it meets
depends on the beam and on the links of a node and not on the size of the index.

The graph works on half-precision copies of the vectors, scaled by one power of two for all so that
none overflows; scores are computed from the originals.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rideflow.llm.common import arrow_batches
from rideflow.sources import materialize

_BLOCK = 128
#: Query vectors are broadcast up to so many bytes.
_MOST_BROADCAST = 32 << 20
_LISTS = "node long, ids binary, dists binary, fresh binary"


# ---- nodes ------------------------------------------------------------------------------------


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector array<double>) of the rows that take part: an id, and a vector of the usual
    length that is not null or zero and has no null or non-finite component.  Rows that share an id
    are one row, that of the smallest vector."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = (
        vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector"))
        .filter(~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
        .filter(F.exists("vector", lambda x: x != 0))
    )
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if length is None:
        return rows
    return rows.filter(F.size("vector") == length.n).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def distinct_nodes(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: node (its smallest id), vector, members (its k + 1 smallest ids)."""
    # Negative zero equals zero.
    key = F.transform("vector", lambda x: x + F.lit(0.0))
    order = Window.partitionBy("key").orderBy("vec_id")
    first = rows.withColumn("key", key).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k + 1)
    return first.groupBy("key").agg(
        F.min("vec_id").alias("node"), F.sort_array(F.collect_list("vec_id")).alias("members")
    ).select("node", F.col("key").alias("vector"), "members")


def _scale(nodes: DataFrame) -> float:
    """The power of two that brings the largest component to between 128 and 256."""
    most = nodes.agg(F.max(F.array_max(F.transform("vector", F.abs)))).first()[0]
    return 2.0 ** (8 - math.frexp(most)[1]) if most else 1.0


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _halves(column: pa.Array) -> np.ndarray:
    """A binary column of half-precision vectors as a float32 matrix."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.float16).reshape(len(column), -1).astype(np.float32)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of two stacks of matrices."""
    out = (x * x).sum(-1)[..., :, None] + (y * y).sum(-1)[..., None, :] - 2.0 * (x @ np.swapaxes(y, -1, -2))
    return np.maximum(out, 0.0)


def _lists(node: np.ndarray, other: np.ndarray, dist: np.ndarray, k: int, fresh: np.ndarray) -> Iterator[tuple]:
    """The k nearest distinct others of each node: (node, ids, dists, fresh flags).

    Of an entry that occurs several times the one that is not fresh counts."""
    order = np.lexsort((fresh, other, node))
    node, other, dist, fresh = node[order], other[order], dist[order], fresh[order]
    one = np.r_[True, (np.diff(node) != 0) | (np.diff(other) != 0)] if len(node) else np.zeros(0, bool)
    node, other, dist, fresh = node[one], other[one], dist[one], fresh[one]
    order = np.lexsort((other, dist, node))
    node, other, dist, fresh = node[order], other[order], dist[order], fresh[order]
    cuts = np.r_[np.flatnonzero(np.diff(node, prepend=node[:1] - 1)), len(node)] if len(node) else np.zeros(1, int)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        b = min(b, a + k)
        yield int(node[a]), other[a:b].tobytes(), dist[a:b].astype(np.float32).tobytes(), fresh[a:b].astype(np.uint8).tobytes()


def _list_batch(rows) -> pa.RecordBatch:
    n, i, d, f = zip(*rows) if rows else ([],) * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(n, pa.int64()), pa.array(i, pa.binary()), pa.array(d, pa.binary()), pa.array(f, pa.binary())],
        names=["node", "ids", "dists", "fresh"],
    )


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids = batch.column("ids").to_pylist()
    n = np.array([len(x) // 8 for x in ids], np.int64)
    node = np.repeat(np.asarray(batch.column("node")), n)
    return (
        node,
        np.frombuffer(b"".join(ids), np.int64),
        np.frombuffer(b"".join(batch.column("dists").to_pylist()), np.float32),
        np.frombuffer(b"".join(batch.column("fresh").to_pylist()), np.uint8),
    )


def _merge_lists(k: int):
    """The k nearest of all lists of each node in a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_flat(b) for b in batches if b.num_rows]
        if parts:
            node, other, dist, fresh = (np.concatenate(p) for p in zip(*parts))
            yield _list_batch(list(_lists(node, other, dist, k, fresh)))

    return run


# ---- the first graph --------------------------------------------------------------------------


def _order_keys(n_orders: int, n_bits: int, scale: float, seed: int):
    """For each order: signs against some hyperplanes, then the place along a line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector")).astype(np.float64) * scale
            rng = np.random.default_rng(seed)
            half = [v.tobytes() for v in x.astype(np.float16)]
            for t in range(n_orders):
                planes = rng.standard_normal((x.shape[1], n_bits + 1))
                along = x @ planes
                code = (along[:, :n_bits] > 0) @ (1 << np.arange(n_bits, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array(code.astype(np.int64)), pa.array(along[:, n_bits]),
                     batch.column("node"), pa.array(half, pa.binary())],
                    names=["turn", "code", "along", "node", "half"],
                )

    return run


def _block_lists(k: int):
    """Nearest others of each node among its block of neighbours in the order; blocks overlap by half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t, n, x = np.asarray(batch.column("turn")), np.asarray(batch.column("node")), _halves(batch.column("half"))
            if tail is not None:
                t, n, x = (np.concatenate(p) for p in zip(tail, (t, n, x)))
            found = []
            for a in range(0, max(len(n) - _BLOCK // 2, 1), _BLOCK // 2):
                nn, xx, tt = n[a : a + _BLOCK], x[a : a + _BLOCK], t[a : a + _BLOCK]
                d = _distances(xx, xx)
                d[tt[:, None] != tt[None, :]] = np.inf
                np.fill_diagonal(d, np.inf)
                near = np.argsort(d, axis=1)[:, :k]
                dist = np.take_along_axis(d, near, 1)
                ok = np.isfinite(dist)
                found.append((np.repeat(nn, ok.sum(1)), nn[near][ok], dist[ok]))
            if found:
                a, b, c = (np.concatenate(p) for p in zip(*found))
                yield _list_batch(list(_lists(a, b, c, k, np.ones(len(a), np.uint8))))
            tail = tuple(p[-(_BLOCK // 2) :] for p in (t, n, x))

    return run


# ---- rounds -----------------------------------------------------------------------------------


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each link twice: in the list of its owner, and turned round."""
    for batch in batches:
        node, other, dist, fresh = _flat(batch)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[node, other]), pa.array(np.r_[other, node]), pa.array(np.r_[dist, dist]),
             pa.array(np.r_[fresh, fresh].astype(bool)), pa.array(np.r_[np.zeros(len(node), bool), np.ones(len(node), bool)])],
            names=["owner", "member", "dist", "fresh", "turned"],
        )


def _compare_groups(k: int, most: int):
    """Pairs met at an owner, at least one of them by a fresh link: each member's nearest such others
    that beat the last of its list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                members = row["members"]
                ids = np.array([m["member"] for m in members], np.int64)
                x = np.frombuffer(b"".join(m["half"] for m in members), np.float16).reshape(len(ids), -1).astype(np.float32)
                fresh = np.array([m["fresh"] for m in members], bool)
                radius = np.array([m["radius"] for m in members], np.float32)
                d = _distances(x, x)
                d[~(fresh[:, None] | fresh[None, :])] = np.inf
                d[ids[:, None] == ids[None, :]] = np.inf
                d[d >= radius[:, None]] = np.inf
                near = np.argsort(d, axis=1)[:, :most]
                dist = np.take_along_axis(d, near, 1)
                ok = np.isfinite(dist)
                if ok.any():
                    found.append((np.repeat(ids, ok.sum(1)), ids[near][ok], dist[ok]))
            if found:
                a, b, c = (np.concatenate(p) for p in zip(*found))
                yield _list_batch(list(_lists(a, b, c, k, np.ones(len(a), np.uint8))))

    return run


def _radii(k: int):
    """The distance beyond which a candidate is of no use to the node: the last of a full list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dists = [np.frombuffer(d, np.float32) for d in batch.column("dists").to_pylist()]
            far = [float(d[-1]) if len(d) >= k else float("inf") for d in dists]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(far, pa.float32())], names=["node", "radius"])

    return run


def _aged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        old = [bytes(len(f)) for f in batch.column("fresh").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("node", "ids", "dists")] + [pa.array(old, pa.binary())], names=batch.schema.names)


_EDGES = "owner long, member long, dist float, fresh boolean, turned boolean"


def neighbour_graph(
    nodes: DataFrame, *, k: int = 40, n_orders: int = 4, max_rounds: int = 8, settled: float = 0.01, seed: int = 7
) -> DataFrame:
    """Lists (node, ids, dists, fresh) of about the k nearest nodes of every node.

    Rounds end when fewer than ``settled`` of all entries are new.  A node is compared, at each owner,
    within the owner's list and the k nearest of those whose lists hold the owner.
    """
    spark = nodes.sparkSession
    n = nodes.count()
    bits = max((n // (2 * _BLOCK)).bit_length(), 0)
    with arrow_batches(spark, 4000):
        keyed = nodes.select("node", "vector").mapInArrow(
            _order_keys(n_orders, bits, _scale(nodes), seed), "turn int, code long, along double, node long, half binary"
        )
        keyed = materialize(keyed, label="nn-orders")
        halves = keyed.filter("turn = 0").select(F.col("node").alias("at"), "half")
        ordered = keyed.repartitionByRange("turn", "code", "along", "node").sortWithinPartitions("turn", "code", "along", "node")
        lists = ordered.mapInArrow(_block_lists(k), _LISTS).repartition("node").mapInArrow(_merge_lists(k), _LISTS)
        graph = materialize(lists, label="nn-graph")
    for _ in range(max_rounds):
        with arrow_batches(spark, 500):
            links = graph.mapInArrow(_edges, _EDGES)
            nearest = Window.partitionBy("owner", "turned").orderBy("dist", "member")
            links = links.withColumn("nth", F.row_number().over(nearest)).filter(F.col("nth") <= k)
            links = links.groupBy("owner", "member").agg(F.max("fresh").alias("fresh"))
            radii = graph.mapInArrow(_radii(k), "node long, radius float")
            vectors = halves.join(radii, F.col("at") == F.col("node"), "left").select(
                "at", "half", F.coalesce("radius", F.lit(float("inf")).cast("float")).alias("radius")
            )
            groups = (
                links.join(vectors, F.col("member") == F.col("at"))
                .groupBy("owner")
                .agg(F.collect_list(F.struct("member", "fresh", "radius", "half")).alias("members"))
                .filter(F.exists("members", lambda m: m["fresh"]))
            )
            better = groups.mapInArrow(_compare_groups(k, k // 2), _LISTS)
            merged = graph.mapInArrow(_aged, _LISTS).unionByName(better).repartition("node").mapInArrow(_merge_lists(k), _LISTS)
            graph = materialize(merged, label="nn-graph")
            new = graph.agg(
                F.sum(F.octet_length("fresh")).alias("all"),
                F.sum(F.length(F.regexp_replace(F.hex("fresh"), "00", ""))).alias("fresh"),
            ).first()
        if not new["all"] or new.fresh / 2 <= settled * new["all"]:
            break
    return graph


# ---- search -----------------------------------------------------------------------------------


def _score(x: str, y: str) -> Column:
    square = F.zip_with(x, y, lambda a, b: (a - b) * (a - b))
    return F.sqrt(F.aggregate(square, F.lit(0.0), lambda s, v: s + v))


def search_links(graph: DataFrame, *, degree: int = 40) -> DataFrame:
    """(from, to): every node's list and the ``degree`` nearest of the nodes whose lists hold it.

    A node that is in very many lists thus keeps few links.  What loses the link back to it is still
    met through the lists that hold it; in no list are only nodes that are far from all others.
    """
    nearest = Window.partitionBy("owner", "turned").orderBy("dist", "member")
    links = graph.mapInArrow(_edges, _EDGES).withColumn("nth", F.row_number().over(nearest))
    return links.filter(~F.col("turned") | (F.col("nth") <= degree)).select(F.col("owner").alias("from"), F.col("member").alias("to")).distinct()


def greedy_search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, *, beam: int = 200, width: int = 16, entries: int = 512) -> DataFrame:
    """(query, node, score) of the ``beam`` nearest nodes found for each of ``queries`` (query, vector, own).

    Starts at the ``beam`` nearest of at most ``entries`` nodes (a sample by hash) and at ``own`` if it
    is not null; each round follows the links of the ``width`` nearest unvisited nodes of the beam and
    keeps the nearest.  It ends when every node of every beam was visited.
    """
    links = materialize(search_links(graph), label="nn-links")
    queries = materialize(queries, label="nn-queries")
    # The walk measures in single precision; what it ends with is measured on the originals.
    scale = _scale(nodes)
    single = F.transform("vector", lambda x: (x * F.lit(scale)).cast("float"))
    places = materialize(nodes.select("node", single.alias("there")), label="nn-places")
    asked = materialize(queries.select("query", single.alias("here")), label="nn-asked")
    size = asked.agg(F.sum(4 * F.size("here"))).first()[0] or 0
    if size <= _MOST_BROADCAST:
        # Then only pairs of ids move; beyond that their vectors do.
        asked = F.broadcast(asked)

    def scored(pairs: DataFrame) -> DataFrame:
        """(query, node) with their distance."""
        return pairs.join(places, "node").join(asked, "query").select("query", "node", _score("here", "there").alias("score"))

    nearest = Window.partitionBy("query").orderBy("score", "node")
    ahead_first = Window.partitionBy("query").orderBy("visited", "score", "node")

    def best(rows: DataFrame) -> DataFrame:
        """The beam, with the nodes that are next to be visited."""
        one = rows.groupBy("query", "node").agg(F.min("score").alias("score"), F.max("visited").alias("visited"))
        kept = one.withColumn("nth", F.row_number().over(nearest)).filter(F.col("nth") <= beam).drop("nth")
        turn = F.row_number().over(ahead_first)
        return materialize(kept.withColumn("next", ~F.col("visited") & (turn <= width)), label="nn-beam")

    # At most ``entries`` ids, a constant of the plan: every query meets all of them.
    sample = nodes.select("node").orderBy(F.xxhash64("node"), "node").limit(entries).collect()
    ids = F.array(*[F.lit(r.node) for r in sample]).cast("array<bigint>")
    starts = queries.select("query", F.explode(ids).alias("node"))
    own = queries.filter(F.col("own").isNotNull()).select("query", F.col("own").alias("node"))
    reached = best(scored(starts.unionByName(own)).withColumn("visited", F.lit(False)))
    while True:
        ahead = reached.filter("next").select("query", F.col("node").alias("from"))
        if ahead.isEmpty():
            exact = reached.select("query", "node").join(nodes.select("node", F.col("vector").alias("there")), "node")
            exact = exact.join(queries.select("query", F.col("vector").alias("here")), "query")
            return exact.select("query", "node", _score("here", "there").alias("score"))
        met = ahead.join(links, "from").select("query", F.col("to").alias("node")).distinct()
        met = met.join(reached.select("query", "node"), ["query", "node"], "left_anti")
        new = scored(met).withColumn("visited", F.lit(False))
        seen = reached.select("query", "node", "score", (F.col("visited") | F.col("next")).alias("visited"))
        reached = best(seen.unionByName(new))


def nearest_neighbours(vectors: DataFrame, is_query: Column, *, k: int = 10, beam: int = 200, **graph) -> DataFrame:
    """The ``k`` nearest rows found for each row of ``vectors`` (vec_id, embedding) that ``is_query``
    holds for: query_id, rank from 1, vec_id, score (Euclidean, in double precision on the originals).

    A row is no candidate of its own; all others are, queries too.  Nearest first, ties to the smaller
    vec_id; all candidates if there are fewer than k.  Vectors that are null or zero, that hold a null
    or non-finite component, or whose length is not the most common one take no part, nor do rows
    without an id; rows that share an id are one.  No usable vector: no rows.
    """
    rows = materialize(usable_vectors(vectors.select("vec_id", "embedding")), label="nn-rows")
    nodes = materialize(distinct_nodes(rows, k), label="nn-nodes")
    lists = neighbour_graph(nodes, **graph)
    key = F.transform("vector", lambda x: x + F.lit(0.0))
    queries = rows.filter(is_query).select("vec_id", key.alias("vector"))
    queries = queries.join(nodes.select(F.col("node").alias("own"), F.col("vector")), "vector")
    found = greedy_search(queries.select(F.col("vec_id").alias("query"), "vector", "own"), nodes, lists, beam=max(beam, 2 * k))
    each = found.join(nodes.select("node", "members"), "node").select("query", "score", F.explode("members").alias("vec_id"))
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    return (
        each.filter(F.col("query") != F.col("vec_id"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(F.col("query").alias("query_id"), "rank", "vec_id", "score")
    )

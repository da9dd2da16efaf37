"""Exact top-k inner products by best-first search in M-trees (operator 6).

Vector components become integers ``floor(scale * x)``.  With ``M`` the largest
squared norm, a vector gets one more coordinate ``sqrt(M - |x|^2)``, which turns
the largest inner product with a query into the smallest Euclidean distance, so
that a metric tree applies.

Vectors are dealt by the hash of their id into shards of bounded expected size;
a task loads one shard into an M-tree of paged nodes.  Every entry keeps its
covering radius and its distance to the parent's routing object.  A search
takes nodes by their least possible distance.  Before a distance is computed,
``|d(query, parent) - d(entry, parent)| - radius`` bounds it from below by the
triangle inequality; entries beyond the k-th best so far are passed over.
Bounds carry a slack for rounding, scores are exact integers, and entries that
may tie are always examined, so the result equals that of brute force.

Every query is sent to every shard and follows the shard's vectors there, in sorted
order: a task builds each tree once, then answers one batch of queries after
another, and the driver sees no vector.  The tops of the shards meet in a ranking by query.  Equal vectors are one entry that keeps the smallest
``k + 1`` ids of its shard, since no query can use more of them.

Defined results: rows whose id is null, and vectors that are null, empty or hold
a null or non-finite component, take no part; only vectors of one length are
compared; rows repeated with one id and vector count once; a row is never its
own candidate (by id); an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import written

TOP = 10
SCALE = 1024
PAGE = 256
FANOUT = 32
SHARD_ROWS = 16_384


class Node:
    """A page: routing objects with child pages, or vectors; with distances to the parent's routing object."""

    __slots__ = ("members", "to_parent", "radii", "children")

    def __init__(self, members, to_parent, radii=None, children=None):
        self.members, self.to_parent, self.radii, self.children = members, to_parent, radii, children


def _distances(points: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((points - p) ** 2).sum(axis=1), 0.0))


def build(points: np.ndarray, members: np.ndarray, parent: np.ndarray | None, rng: np.random.Generator,
          page: int = PAGE, fanout: int = FANOUT) -> Node:
    """Bulk-load the distinct ``points[members]``: sampled routing objects, each with the members nearest to it."""
    to_parent = _distances(points[members], parent) if parent is not None else None
    if len(members) <= page:
        return Node(members, to_parent)
    pivots = members[np.sort(rng.choice(len(members), min(fanout, -(-len(members) // page) + 1), replace=False))]
    near = np.empty(len(members), np.int64)
    far = np.full(len(members), np.inf)
    for i, p in enumerate(pivots):
        d = _distances(points[members], points[p])
        closer = d < far
        near[closer], far[closer] = i, d[closer]
    children, radii = [], []
    for i, p in enumerate(pivots):
        own = members[near == i]
        children.append(build(points, own, points[p], rng, page, fanout))
        radii.append(far[near == i].max())
    return Node(pivots, _distances(points[pivots], parent) if parent is not None else None, np.array(radii), children)


class Tree:
    """M-tree over integer vectors; several ids may share a vector."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top: int = TOP, page: int = PAGE, fanout: int = FANOUT):
        self.top = top
        distinct, inverse = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, inverse.reshape(-1)))
        ids, inverse = ids[order], inverse.reshape(-1)[order]
        first = np.searchsorted(inverse, np.arange(len(distinct)))
        place = np.arange(len(ids)) - first[inverse]
        keep = place <= top
        self.ids, self.of = ids[keep], inverse[keep]
        self.first = np.searchsorted(self.of, np.arange(len(distinct) + 1))
        largest = int(np.abs(distinct).max()) if distinct.size else 0
        limit = max(1, distinct.shape[1]) * largest * largest
        self.exact = distinct.astype(np.float64) if limit < 1 << 52 else distinct if limit < 1 << 62 else distinct.astype(object)
        plain = distinct.astype(np.float64)
        norms = (plain ** 2).sum(axis=1)
        self.most = float(norms.max())
        self.points = np.hstack([plain, np.sqrt(np.maximum(self.most - norms, 0.0))[:, None]])
        self.slack = 1e-6 * (1.0 + math.sqrt(self.most))
        self.root = build(self.points, np.arange(len(distinct)), None, np.random.default_rng(6), page, fanout)
        self.computed = 0

    def search(self, query_id: int, query: np.ndarray) -> list[tuple[int, int]]:
        """The ``top`` best ``(score, id)``, ties to the smaller id, without ``query_id``."""
        q = np.append(query.astype(np.float64), 0.0)
        exact = query.astype(self.exact.dtype)
        size = float((q ** 2).sum()) + self.most
        slack = self.slack + 1e-6 * math.sqrt(size)
        best: list[tuple[int, int]] = []
        reach = math.inf
        heap: list[tuple[float, int, Node, float | None]] = [(0.0, 0, self.root, None)]
        pushed = 0
        while heap:
            bound, _, node, to_query = heapq.heappop(heap)
            if bound > reach:
                break
            members = node.members
            radii = node.radii if node.radii is not None else 0.0
            chosen = np.arange(len(members))
            if to_query is not None and reach < math.inf:
                chosen = np.flatnonzero(np.abs(to_query - node.to_parent) - radii <= reach)
                members = members[chosen]
                if not len(members):
                    continue
            self.computed += len(members)
            scores = self.exact[members] @ exact
            distances = np.sqrt(np.maximum(size - 2.0 * scores.astype(np.float64), 0.0))
            if node.children is None:
                near = np.flatnonzero(distances <= reach)
                if len(near) > self.top + 1:  # one of them may be the query itself
                    enough = np.partition(distances[near], self.top)[self.top]
                    near = near[distances[near] <= enough + slack]
                new = [(-int(scores[e]), int(i)) for e in near
                       for i in self.ids[self.first[members[e]]:self.first[members[e] + 1]] if i != query_id]
                if new:
                    best = sorted(best + new)[:self.top]
                    if len(best) == self.top:
                        reach = math.sqrt(max(size + 2.0 * best[-1][0], 0.0)) + slack
            else:
                least = np.maximum(distances - node.radii[chosen] - slack, 0.0)
                for i in np.flatnonzero(least <= reach):
                    pushed += 1
                    heapq.heappush(heap, (float(least[i]), pushed, node.children[chosen[i]], float(distances[i])))
        return [(-s, i) for s, i in best]


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id, v, dim`` of the rows that take part; v holds ``floor(scale * x)``."""
    x = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    x = x.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & F.forall(
        "x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf))))
    return x.select("vec_id", F.transform("x", lambda c: F.floor(c * F.lit(float(scale)))).alias("v"),
                    F.size("x").alias("dim")).distinct()


def _answering(top: int, page: int, fanout: int):
    """A task's work: shard by shard, the tree of its vectors, which come first, and the answers to the queries that follow.

    Held are one shard's tree and one batch of queries, however many shards and queries a task gets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, parts, tree = None, [], [], None
        for b in batches:
            keys = np.stack([b.column(i).to_numpy() for i in range(3)])  # dim, shard, asks
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            out = []
            for low, high in zip([0, *edges.tolist()], [*edges.tolist(), b.num_rows]):
                if low == high:
                    continue
                dim, here, asks = (int(k) for k in keys[:, low])
                some = b.column(3).slice(low, high - low).to_numpy()
                flat = np.asarray(b.column(4).slice(low, high - low).flatten(), np.int64).reshape(high - low, dim)
                if (dim, here) != shard:
                    shard, ids, parts, tree = (dim, here), [], [], None
                if not asks:
                    ids.append(some), parts.append(flat)
                    continue
                if tree is None:
                    if not ids:
                        continue  # queries of a dimension whose vectors all fell into other shards
                    tree, ids, parts = Tree(np.concatenate(ids), np.concatenate(parts), top, page, fanout), [], []
                out += [(int(q), i, s) for q, v in zip(some, flat) for s, i in tree.search(int(q), v)]
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    return run


def search(vectors: DataFrame, queries: DataFrame, top: int = TOP, shard_rows: int = SHARD_ROWS,
           page: int = PAGE, fanout: int = FANOUT) -> DataFrame:
    """``query_id, rank, vec_id, score``; both inputs from :func:`integer_vectors`, written.

    Every shard's tree is built once; each query is sent to every shard and meets it there, behind its vectors.
    """
    shards = max(1, math.ceil(vectors.count() / shard_rows))
    dealt = vectors.select("dim", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"), F.lit(0).alias("asks"), "vec_id", "v")
    sent = queries.select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
                          F.lit(1).alias("asks"), "vec_id", "v")
    met = dealt.unionByName(sent).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "asks")
    found = met.mapInArrow(_answering(top, page, fanout), "query_id long, vec_id long, score long")
    return found.distinct().selectExpr(
        "query_id", "cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank",
        "vec_id", "score").where(F.col("rank") <= top)


def query(spark, sf_dir: str) -> DataFrame:
    """op6: the ten largest integer inner products of every vector whose id is divisible by 100."""
    vectors = written(integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), "mtree-vectors")
    return search(vectors, vectors.where("vec_id % 100 = 0"))


_VALID = ("embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL "
          "OR isnan(x) OR isinf(x))) = 0")
#: Brute force.
ORACLE = f"""
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND {_VALID}),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, (row_number() OVER w)::INT AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= {TOP}
"""

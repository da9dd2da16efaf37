"""M-tree search against brute force, on ties, repeated vectors and odd rows."""

import math

import numpy as np
import pytest

from ledgerline.llm import mtree as M


def brute(rows, query, top):
    scores = sorted((-int(np.dot(v.astype(object), query[1].astype(object))), i) for i, v in rows if i != query[0])
    return [(-s, i) for s, i in scores[:top]]


@pytest.mark.parametrize(("n", "dim", "spread"), [(1, 3, 5), (40, 2, 2), (700, 4, 3), (900, 16, 600), (500, 8, 10 ** 9)])
def test_tree(n, dim, spread):
    rng = np.random.default_rng(n)
    v = rng.integers(-spread, spread + 1, (n, dim))
    v[: n // 3] = v[0]
    ids = rng.permutation(n) * 10
    tree = M.Tree(ids, v, top=10, page=8, fanout=4)
    for q in range(0, n, max(1, n // 40)):
        assert tree.search(int(ids[q]), v[q]) == brute(list(zip(ids.tolist(), v)), (ids[q], v[q]), 10)


def test_bounds_save_work():
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 900, (40, 8))
    v = np.floor(np.vstack([c + rng.normal(0, 5, (100, 8)) for c in centres])).astype(np.int64)
    v = np.floor(v * (4000 / np.linalg.norm(v, axis=1))[:, None]).astype(np.int64)
    tree = M.Tree(np.arange(len(v)), v, page=32, fanout=8)
    for q in range(0, len(v), 100):
        assert tree.search(q, v[q]) == brute(list(enumerate(v)), (q, v[q]), 10)
    assert tree.computed < 0.4 * 40 * len(v)


def test_query(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 6)]) for i in range(260)]
    rows += [(300 + i, rows[7][1]) for i in range(30)] + [rows[7], rows[100]]
    rows += [(400, None), (401, []), (402, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (403, [math.nan] * 6), (404, [math.inf] * 6),
             (None, [9.0] * 6), (500, [1.0, 2.0]), (600, [2.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, dim int, shard int")
    vectors = M.integer_vectors(df)
    clean = {(r["vec_id"], tuple(r["v"])) for r in vectors.collect()}
    assert len(clean) == 292 and all(i not in (None, 400, 401, 402, 403, 404) for i, _ in clean)
    for rows_a_batch in (10_000, 7):  # a shard's vectors and its queries over many batches
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_a_batch)
        got = {}
        found = M.search(vectors, vectors.where("vec_id % 100 = 0"), shard_rows=60, page=16, fanout=4)
        assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
        for r in found.collect():
            got.setdefault(r["query_id"], {})[r["rank"]] = (r["score"], r["vec_id"])
        want = {}
        for i, v in clean:
            if i % 100 == 0:
                own = [(j, np.array(w)) for j, w in clean if len(w) == len(v)]
                want[i] = dict(enumerate(brute(own, (i, np.array(v)), 10), 1))
        assert got == {i: w for i, w in want.items() if w}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    empty = M.integer_vectors(df.where("vec_id < 0"))
    assert M.search(empty, empty).count() == 0

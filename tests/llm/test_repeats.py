"""Repeated byte strings against brute force, in one shard and through Spark with hot names."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import repeats as R
from ledgerline.llm.bwt import repeated_starts


def slow(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i + 1:i + 1 + length] = True
        edge = np.diff(gone.astype(int))
        out.append((len(t), int(gone.sum()), int((edge == 1).sum()),
                    hashlib.sha256(bytes(b for b, g in zip(t, gone[1:]) if not g)).hexdigest()))
    return out


def test_expansion():
    rnd = random.Random(1)
    for _ in range(150):
        letters, length = b"abcde"[:rnd.choice([1, 2, 3, 5])], rnd.choice([1, 2, 3, 8, 20])
        texts = [bytes(rnd.choice(letters) for _ in range(rnd.randrange(60))) for _ in range(rnd.randrange(1, 8))]
        texts.append(texts[0][5:40] + b"zz" + texts[-1])
        seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
        want = [[i for i in range(len(t) - length + 1) if seen[t[i:i + length]] > 1] for t in texts]
        assert [x.tolist() for x in repeated_starts(texts, length)] == want
    assert repeated_starts([], 5) == [] and [len(x) for x in repeated_starts([b"", b"ab"], 5)] == [0, 0]


@pytest.mark.parametrize("level", [1, 2, 3])
def test_equal_windows_share_a_name(level):
    rnd = np.random.default_rng(2)
    shared = rnd.integers(97, 123, 260)
    a, b = (np.concatenate([rnd.integers(97, 123, n), shared, rnd.integers(97, 123, 90)]).astype(np.uint8) for n in (11, 300))
    x, y = R.names(a, level)[0], R.names(b, level)[0]
    assert (x[11:72] == y[300:361]).all() and len(x) == len(a) - 199


def test_pieces_cover_every_window(monkeypatch):
    monkeypatch.setattr(R, "SEGMENT", 333)
    data = bytes(random.Random(3).choice(b"abc") for _ in range(2000)) + b"z" * 3000
    for level in (1, 2, 3):
        spans = [(s, n) for _, _, s, n, _ in R.pieces(data, 0, len(data) - 199, level)]
        assert [w for s, n in spans for w in range(s, s + n)] == list(range(len(data) - 199))


@pytest.mark.parametrize("params", [{}, {"hot_bytes": 600, "shard_bytes": 3000}, {"length": 37, "probe": 8}])
def test_against_brute_force(spark, odd, params):
    rnd = random.Random(9)
    line = "a common line that many texts begin with and that is itself shorter than two hundred bytes " * 2
    rows = [(100 + i, line[:150] + "".join(rnd.choice("abcdefgh ") for _ in range(300))) for i in range(40)]
    docs = odd.unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    texts = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    want = sorted((i or -1, *x) for (i, _), x in zip(texts, slow([t for _, t in texts], params.get("length", 200))))
    got = R.remove_repeats(docs, **params).collect()
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want
    assert all(sum(s["high"] - s["low"] for s in r["removed"]) == r["n_removed"] for r in got)


def test_equal_rows_stay_linear(spark, monkeypatch):
    """Pieces fetched and spans joined back are in proportion to equal rows, not to their square."""
    rnd = random.Random(3)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(3000))
    near = text[:1500] + "#" + text[1500:]
    sizes = {}
    real = R._with_lists

    def counted(docs, spans, how="inner"):
        out = real(docs, spans, how)
        sizes.setdefault(spark.conf.get("n"), []).append(out.selectExpr("sum(size(spans))").first()[0] or 0)
        return out

    monkeypatch.setattr(R, "_with_lists", counted)
    for n in (50, 100, 200):
        spark.conf.set("n", str(n))
        docs = spark.createDataFrame([(None, text)] * n + [(1, near)], "doc_id long, text string").repartition(4)
        got = R.remove_repeats(docs)
        assert {r["n_removed"] for r in got.where("doc_id is null").collect()} == {3000}
    spans = [sizes[str(n)] for n in (50, 100, 200)]
    assert all(len(x) == 2 for x in spans)
    for a, b in zip(spans, spans[1:]):
        assert b[1] <= 2.1 * a[1] and b[0] <= 2.1 * a[0]


def test_texts_under_one_id_are_told_apart(spark):
    """Two texts whose 32-bit hashes are equal keep their own spans under one (null) id."""
    from pyspark.sql import functions as F
    base = "".join(random.Random(5).choice("abcdefgh ") for _ in range(260))
    tail = F.concat(F.lit("z" * 210), F.col("id").cast("string"), F.lit("y" * 40))
    seen = spark.range(150_000).select("id", tail.alias("text")).withColumn("h", F.hash("text"))
    pair = seen.groupBy("h").agg(F.collect_list("text").alias("x")).where("size(x) > 1").first()["x"][:2]
    docs = spark.createDataFrame([(None, pair[0]), (None, pair[1] + base), (7, base)], "doc_id long, text string")
    want = sorted((i or -1, *x) for i, x in zip((None, None, 7), slow([t["text"].encode() for t in docs.collect()], 200)))
    got = R.remove_repeats(docs).collect()
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want
    assert R.remove_repeats(docs).columns[0] == "doc_id" and pair[0] != pair[1]


def test_hot_keys_join_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(R, "_limit", lambda rows: 3)
    rnd = random.Random(6)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(400))
    rows = [(i, "".join(rnd.choice("ijklmno ") for _ in range(90)) + passage) for i in range(30)] + [(40, passage), (41, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(i, *x) for (i, _), x in zip(rows, slow([t.encode() for _, t in rows], 200))]
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in R.remove_repeats(docs).collect())
    assert got == want


def test_empty(nothing):
    assert R.remove_repeats(nothing).count() == 0

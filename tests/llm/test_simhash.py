"""SimHash: fingerprints bit by bit, components against all pairs, hot keys against the usual path."""

import random

import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import simhash as S


def slow(text, n=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def grouped(values, most=2):
    """Smallest member reachable over values at most ``most`` bits apart."""
    values, root = sorted(set(values)), {}
    for v in values:
        root.setdefault(v, v)
        todo = [v]
        while todo:
            x = todo.pop()
            for y in values:
                if bin(x ^ y).count("1") <= most and root.get(y, y + 1) > root[v] and y not in root:
                    root[y] = root[v]
                    todo.append(y)
    return root


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint(odd):
    for r in odd.select("text").collect():
        assert S.fingerprint(r["text"]) == slow(r["text"])


def test_components_match_all_pairs(odd):
    rows = odd.collect()
    fps = [slow(r["text"]) for r in rows]
    root = grouped(fps)
    best = {}
    for r, f in zip(rows, fps):
        if r["doc_id"] is not None:
            best[root[f]] = min(best.get(root[f], 1 << 60), r["doc_id"])
    got = S.near_duplicates(odd).collect()
    want = sorted(((r["doc_id"] or -1), signed(f), best.get(root[f], -1)) for r, f in zip(rows, fps))
    assert sorted((r["doc_id"] or -1, r["fp"], -1 if r["component_id"] is None else r["component_id"]) for r in got) == want


def test_hot_keys_lose_no_link(spark):
    rnd = random.Random(3)
    fps = set()
    for _ in range(6):
        base = rnd.getrandbits(64)
        for _ in range(40):
            x = base
            for b in rnd.sample(range(64), rnd.randrange(0, 5)):
                x ^= 1 << b
            fps.add(x)
    root = grouped(fps)
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    for limit in (2, 64):
        pairs = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in S.links(df, pair_limit=limit).collect()]
        assert all(bin(a ^ b).count("1") <= 2 for a, b in pairs)
        own = {x: x for x in fps}

        def top(x, own=own):
            while own[x] != x:
                x = own[x]
            return x

        for a, b in pairs:
            a, b = sorted((top(a), top(b)))
            own[b] = a
        assert {x: top(x) for x in fps} == root
        if limit == 64:
            want = {(a, b) for a in fps for b in fps if a != b and bin(a ^ b).count("1") <= 2 and signed(a) < signed(b)}
            assert set(pairs) == want


def test_keep_one(odd, nothing):
    got = S.keep_one(odd.withColumn("extra", F.lit(1)))
    assert got.columns == [*odd.columns, "extra"]
    ids = [r["doc_id"] for r in got.collect()]
    assert len(ids) == len(set(ids)) and 11 in ids and 6 in ids and 8 not in ids and 7 not in ids
    assert S.keep_one(nothing).count() == 0 and S.near_duplicates(nothing).count() == 0

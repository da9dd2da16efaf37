"""Sharding: the filled table against a plain turn-by-turn claim, balance, and few moves."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import sharding as S


def claimed(names, size):
    orders = [[(o + j * s) % size for j in range(size)] for o, s in (S.preference(n, size) for n in names)]
    table = {}
    while len(table) < size:
        for i, order in enumerate(orders):
            slot = next((x for x in order if x not in table), None)
            if slot is not None:
                table[slot] = i
    return [table[x] for x in range(size)]


@pytest.mark.parametrize(("shards", "size"), [(1, 7), (3, 7), (7, 7), (5, 101), (12, 509)])
def test_table_equals_turns(shards, size):
    names = S.shard_names(shards)
    assert S.fill_table(names, size) == claimed(names, size)


def test_even_and_stable():
    names = S.shard_names(16)
    full, less = S.fill_table(names, 4099), S.fill_table(names[:-1], 4099)
    counts = Counter(full)
    assert max(counts.values()) - min(counts.values()) <= 1
    kept = sum(a == b for a, b in zip(full, less) if a != 15)
    assert kept >= 0.8 * sum(a != 15 for a in full)


def test_rejects_bad_tables():
    for names, size in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            S.fill_table(names, size)


def test_place(odd, nothing):
    names = S.shard_names(4)
    df = odd.withColumn("slot", F.lit("mine"))
    rows = S.place(df, ["doc_id"], names, 101).collect()
    owner = S.fill_table(names, 101)
    assert len(rows) == odd.count() and all(r["shard"] == owner[r["slot"]] for r in rows)
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert S.place(nothing, ["doc_id"], names, 101).count() == 0


def test_no_shuffle(odd):
    plan = S.place(odd, ["doc_id"], S.shard_names(4), 101)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan

"""Prefix trie against a plain trie, on odd conversations, hot keys and conversations of many blocks."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from ledgerline.llm import prefix_trie as T

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, block long, depth long, ka string, base string"


def plain(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    members, built = defaultdict(list), {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = convs.get(base, [])[:h] + own[h:]
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        own = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += own
            leaves[p[:d]] += not children[p]
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(
        ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())


def conversations(seed: int, n: int) -> list[tuple]:
    rnd = random.Random(seed)
    texts = ["", None, "hello there", "hello  there", "a\tb c ", "x", "long " * 50, "é ü"]
    out = []
    for c in rnd.sample(range(-45, 8 * n), n):
        for t in range(rnd.choice([0, 1, 1, 2, 3, 5, 9])):
            out.append((c, rnd.choice([t, t, t, None, 7]), rnd.choice(["user", "assistant", None]), rnd.choice(texts)))
    out += [(400, t, "user", f"turn {t % 3}") for t in range(300)] + [(401, t, "user", f"turn {t % 3}") for t in range(250)]
    out += [(600 + c, t, "user", "same words here") for c in range(60) for t in range(4)]
    out += [(700, None, None, None)] * 40 + [(None, 1, "user", "no conversation")] * 5
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_plain_trie(spark, tmp_path, monkeypatch, seed):
    if seed == 2:
        monkeypatch.setattr(T, "WIDE", 1)  # no parent is met by broadcast but the widest
    rows = conversations(seed, 70)
    path = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame([(*r, 5, 6, "k", "b") for r in rows], SCHEMA).repartition(4).write.parquet(path)
    got = T.query(spark, str(tmp_path))
    assert got.columns == COLUMNS and all(t == "bigint" for _, t in got.dtypes[:-1])
    order = lambda r: (r[1], r[0], r[7])
    want = sorted(plain(rows), key=order)
    assert sorted(map(tuple, got.collect()), key=order) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert sorted(con.execute(T.ORACLE).fetchall(), key=order) == want


def test_a_long_conversation_lies_in_many_blocks(spark):
    turns = spark.createDataFrame([(9, 1, "user", "same")] * 4000 + [(8, 1, "user", "same")] * 10, "conv_id long, turn long, role string, text string")
    placed = T.ordered(turns)
    assert placed.where("conv_id = 9").select("block").distinct().count() > 2  # equal rows too are spread
    spans = {r["block"]: r for r in T.blocks(placed).where("conv_id = 9").collect()}
    assert all(r["total"] == 4000 and r["first"] == min(spans) for r in spans.values()) and spans[min(spans)]["before"] == 0


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert T.query(spark, str(tmp_path)).count() == 0

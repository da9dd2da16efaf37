"""Packing: ids against the public tokenizer, exact round trip, gapless sequences, few sequences."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import packing as P
from ledgerline.llm import tokens

ODD = ["", " ", " a", "a ", "a  b", "\n x", "a \n b", "x\0 y", "tab\t x  y\n\n\nz", "it's  'll <|endoftext|> q", "é　 ü", "\x85 a \x1c b", "<|endoftext|>", "<|endoftext|> a", "a <|endoftext|>",
       "a <|endoftext|> q", "x<|endoftext|>y<|endoftext|><|endoftext|> <|endoftext|>  z", "<|endoftext| <|endoftext", "<|<|endoftext|>|>"]


@pytest.fixture(scope="module")
def public():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_are_the_public_tokenizers(public, odd):
    words = tokens.load(limit=50)  # a tiny cache turns over
    for text in ODD + [r["text"] or "" for r in odd.select("text").collect()]:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == public(text)


def test_cut():
    assert P.cut(1) == [(0, 1)] and P.cut(2048) == [(0, 2048)] and P.cut(2049) == [(0, 1), (1, 2048)]
    assert P.cut(5000) == [(0, 904), (904, 2048), (2952, 2048)]


def test_plan_fills_without_overlap_and_well():
    rnd = random.Random(2)
    for capacity in (7, 64, 2048):
        counts = Counter(min(capacity, int(rnd.paretovariate(0.8) * capacity / 40) + 1) for _ in range(3000))
        ranks, used = defaultdict(set), defaultdict(list)
        for length, rank, many, first, offset in P.plan(counts, capacity):
            for i in range(many):
                ranks[length].add(rank + i)
                used[first + i].append((offset, length))
        assert {k: len(v) for k, v in ranks.items()} == dict(counts)
        assert all(v == set(range(len(v))) for v in ranks.values())
        for places in used.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(used) <= -(-sum(k * v for k, v in counts.items()) // capacity) * 1.02 + 1


def test_best_fit_equals_one_by_one():
    counts = {9: 3, 7: 4, 5: 6, 4: 5, 3: 9, 1: 2}
    bins = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fit = [i for i, left in enumerate(bins) if left >= length]
            if fit:
                bins[min(fit, key=lambda i: bins[i])] -= length
            else:
                bins.append(12 - length)
    runs = P.plan(counts, 12)
    assert max(r[3] + r[2] for r in runs) == len(bins)


def test_pack(odd, nothing, public):
    rows = P.place(P.numbered(P.pieces(odd, capacity=64)), capacity=64, shard_rows=5).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for r in odd.where("doc_id is not null and doc_id <> 11").collect():
        ids = [*public(r["text"] or ""), 0]
        own = sorted(by_doc[r["doc_id"]], key=lambda p: p["piece"])
        assert [p["piece"] for p in own] == list(range(len(own))) and sum(p["length"] for p in own) == len(ids)
        assert all(p["length"] == 64 for p in own[1:])
        for p in own:
            part = np.array(ids[p["start"]:p["start"] + p["length"]], "<u4")
            assert zlib.crc32(part.tobytes()) == p["ids_crc32"]
    assert len(by_doc[11]) % 2 == 0 and len(by_doc[None]) >= 2
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 64
    assert P.pack(nothing).count() == 0


def test_equal_rows_are_spread(spark):
    docs = spark.createDataFrame([(None, "one two three")] * 600, "doc_id long, text string")
    x, histogram = P.ranked(P.numbered(P.pieces(docs)), shard_rows=50)
    assert sorted(r["rank"] for r in x.collect()) == list(range(600)) and sum(histogram.values()) == 600
    shard = P.F.pmod(P.F.xxhash64("doc_id", "piece", "ids_crc32", P.ROW), P.F.lit(12))
    assert x.groupBy(shard).count().agg({"count": "max"}).first()[0] < 120

"""Decontamination against exact containment of every item in every document."""

import random

import numpy as np

from ledgerline.llm import decontaminate as D


def exact(docs, items, threshold=0.8):
    return sorted(((d, i, round(len(s & D.shingle_set(D.split_words(t))) / len(s), 9)) for d, t in docs for i, s in
                  ((i, D.shingle_set(D.split_words(x))) for i, x in items)
                  if s and len(s & D.shingle_set(D.split_words(t))) / len(s) >= threshold), key=str)


def planted():
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(900)]
    say = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(say(rnd.choice([5, 6, 9, 14, 30, 55, 120, 300])))) for i in range(60)]
    items += [(60, "one"), (61, ""), (62, None), (63, "two words"), (64, items[3][1])]
    docs = []
    for i, text in items[:60]:
        words = text.split()
        docs.append((len(docs), " ".join(say(rnd.randrange(0, 4000)) + [w.upper() for w in words] + say(rnd.randrange(0, 50)))))
        words[rnd.randrange(len(words))] = "changed"
        docs.append((len(docs), " ".join(say(200) + words + say(200))))
        docs.append((len(docs), " ".join(say(300) + text.split()[:len(words) // 2] + say(300))))
    docs += [(1000, "One"), (1001, "two \n words"), (1002, "two words more"), (1003, ""), (1004, None), (None, items[5][1])]
    return docs, items


def test_matches_exact(spark):
    docs, items = planted()
    dd = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    ii = spark.createDataFrame(items, "item_id long, text string")
    want = exact(docs, items)
    for blocks in (D.BLOCK_BYTES, 3000):
        got = D.matches(dd, ii, block_bytes=blocks).collect()
        assert sorted(((r["doc_id"], r["item_id"], round(r["containment"], 9)) for r in got), key=str) == sorted(want, key=str)


def test_segments_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(D, "SEGMENT", 50)
    docs, items = planted()
    index = D.build_index(items)
    for d, text in docs[:40]:
        words = D.split_words(text)
        hashes = [D.shingle_hashes(part) for part in D.segments(words, index.longest)]
        found = {index.ids[i] for _, i in D.candidates(index, hashes)}
        assert {i for x, i, _ in exact([(d, text)], items)} <= found


def test_decontaminate(spark, odd, nothing):
    items = spark.createDataFrame([(1, odd.where("doc_id = 11").first()["text"]), (2, None)], "item_id long, text string")
    got = D.decontaminate(odd, items)
    assert got.columns == odd.columns
    ids = [r["doc_id"] for r in got.collect()]
    assert not {2, 3, 11} & set(ids) and ids.count(None) == 2 and {1, 6, 7, 14, 16} <= set(ids)
    assert D.decontaminate(nothing, items).count() == 0
    assert D.decontaminate(odd, items.where("item_id > 5")).count() == odd.count()


def test_batches_without_words():
    index = D.build_index(planted()[1])
    assert D.candidates(index, []) == set()
    assert D.candidates(index, [np.empty(0, np.uint64)] * 3) == set()

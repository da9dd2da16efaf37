"""Byte-level BPE against the tiktoken library; exact round trips, offsets and split characters."""

import base64
import hashlib
import random

import public_tokenizers as public
import pytest
import tiktoken

from ledgerline.llm import bpe as B

TEXTS = ["", " ", "a", "a  b", "\n x \r\n", "it's  'll <|endoftext|> q", "naïve café ß　 ü", "日本語のテキスト 你好", "🙂🙃 👩‍👩‍👧 x", "x\0 y",
         "\x85 a \x1c b\x1f", "١٢٣ ४५६ Ⅷ", "a b" * 300, "x" * 3000, "tab\t y\n\n\nz  ", "é ​ ﻿ \U0010ffff"]


@pytest.fixture(scope="module")
def reference():
    with open(public.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def fuzz(n: int) -> list[str]:
    rnd = random.Random(4)
    letters = "ab z'ſsltd  \t\n\r\x0b\xa0　 .,!?-_09Åéßжд語🙂́\0"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randrange(60))) for _ in range(n)]


def test_ids_are_tiktokens(spark, odd, reference):
    texts = TEXTS + fuzz(400)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: list(r["ids"]) for r in B.encode(docs).collect()}
    assert got == {i: reference.encode_ordinary(t) for i, t in enumerate(texts)}
    rows = sorted((r["doc_id"] or -1, r["text"] or "") for r in odd.collect())
    mine = sorted((r["doc_id"] or -1, list(r["ids"])) for r in B.encode(odd).collect())
    assert mine == sorted((i, reference.encode_ordinary(t)) for i, t in rows)


def test_round_trip_keeps_other_columns(spark, odd, monkeypatch):
    monkeypatch.setattr(B, "SLICE_CHARS", 50)  # many slices a batch
    docs = odd.unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"),
                           allowMissingColumns=True)
    coded = B.encode(docs).selectExpr("doc_id", "ids", "1 as c1", "'x' as table")
    back = B.decode(coded)
    assert back.columns == ["doc_id", "c1", "table", "bytes", "text"]
    rows = back.collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in rows) == sorted((r["doc_id"] or -1, r["text"] or "") for r in docs.collect())
    assert all(bytes(r["bytes"]) == r["text"].encode() and r["c1"] == 1 and r["table"] == "x" for r in rows)


def test_split_characters(spark, reference):
    ids = reference.encode_ordinary("🙂")
    assert len(ids) > 1
    rows = [(1, ids), (2, ids[:1]), (3, ids[1:] + ids), (4, []), (5, None)]
    got = {r["k"]: r for r in B.decode(spark.createDataFrame(rows, "k int, ids array<int>")).collect()}
    assert got[1]["text"] == "🙂" and got[4]["text"] == got[5]["text"] == ""
    assert got[2]["text"] == "�" and bytes(got[2]["bytes"]) == reference.decode_bytes(ids[:1])
    assert got[3]["text"].endswith("🙂") and bytes(got[3]["bytes"]) == reference.decode_bytes(ids[1:] + ids)
    for bad in ([50256], [-1]):
        with pytest.raises(Exception, match="outside the vocabulary"):
            B.decode(spark.createDataFrame([(1, bad)], "k int, ids array<int>")).collect()


def test_offsets(spark, reference):
    texts = TEXTS + fuzz(60)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in B.encode(docs, offsets=True).collect():
        text, at, done = texts[r["doc_id"]], 0, 0
        assert len(r["ids"]) == len(r["ends"]) == len(r["char_starts"]) == len(r["char_ends"])
        for i, end, a, z in zip(r["ids"], r["ends"], r["char_starts"], r["char_ends"]):
            piece = text.encode()[at:end]
            assert piece == reference.decode_single_token_bytes(i)
            assert piece in text[a:z].encode() and a <= done <= z  # a split character is covered whole
            at, done = end, z
        assert at == len(text.encode())


def test_table_and_merges(reference):
    table = B.byte_table()
    assert len(set(table)) == 256 and all(c.isprintable() and not c.isspace() for c in table)
    assert B.token_bytes(B.description()).to_pylist() == [reference.decode_single_token_bytes(i) for i in range(50256)]


def test_query(spark, reference, tmp_path):
    rows = [(1, "a b"), (1, "a b"), (2, None), (None, "é 🙂")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i or -1, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = B.query(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == sorted(want)


def test_empty(nothing):
    assert B.encode(nothing).count() == 0 and B.decode(B.encode(nothing)).count() == 0

"""Periodic runs against brute force on sequences, and the query against a plain statement of it."""

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest

from ledgerline.llm import runs as R


def slow(s, min_words=6, times=4):
    """Every maximal stretch of every period, kept under its smallest period."""
    n, found = len(s), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_words, times * q):
                found.setdefault((i, length), q)
            i = max(j, i + 1)
            while j == i and i + q < n and s[i] != s[i + q]:
                i = j = i + 1
    return sorted((a, length, q) for (a, length), q in found.items())


def plain(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = slow(words)
    gone = {i for a, length, q in runs for i in range(a + q, a + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (-1 if doc_id is None else doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{a},{length},{q}\n" for a, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("limits", [(6, 4), (1, 2), (2, 2), (9, 3), (20, 5)])
def test_against_brute_force(limits):
    rnd = random.Random(sum(limits))
    for _ in range(400):
        s = []
        while len(s) < rnd.randrange(1, 90):
            unit = [rnd.randrange(rnd.choice([1, 2, 3, 9])) for _ in range(rnd.randrange(1, 8))]
            s += (unit * rnd.randrange(1, 12))[:rnd.randrange(1, 60)]
        assert R.find(np.array(s, np.int64), *limits) == slow(s, *limits), s


def test_many_different_words_pack_few_a_number():
    s = np.arange(40_000)
    s[1000:1400] = np.tile(np.arange(20), 20)
    s[39_990:] = 5
    assert R.find(s) == [(1000, 400, 20), (39_990, 10, 1)]


def test_hard_documents_stay_fast():
    fibonacci = [0], [1]
    while len(fibonacci[1]) < 20_000:
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    rnd = random.Random(5)
    line = list(range(10, 20))
    lines = [x for _ in range(1500) for x in (rnd.randrange(100, 10_000), *line)]
    for s in ([0] * 20_000, [0, 1] * 10_000, fibonacci[1], lines, (line * 700)[3:] + lines):
        t = time.time()
        R.find(np.array(s, np.int64))
        assert time.time() - t < 15


def test_words_of_slices(monkeypatch):
    monkeypatch.setattr(R, "SLICE", 7)
    for text in ("", "  ", "ab", "aaaaaaaaaaaaaaaaaaaa b", " one two\tthree\x0b one  two\n" * 5, "\x85 \x1c x y"):
        s, words = R.word_numbers(text.encode())
        assert [words[i].decode() for i in s] == re.findall(r"[^\x20\x09-\x0D]+", text)


def rows():
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(12)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    out = [(i, say(rnd.randrange(120))) for i in range(150)]
    out += [(1000 + i, say(9) + (" " + say(rnd.randrange(1, 5))) * rnd.randrange(3, 9) + "  tail\n x") for i in range(40)]
    return out


def test_query(spark, odd, tmp_path):
    docs = odd.unionByName(spark.createDataFrame(rows(), "doc_id long, text string"), allowMissingColumns=True)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = R.query(spark, str(tmp_path))
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
                                "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"}
    key = lambda r: (r[0], r[1], *r[6:])
    mine = sorted(((-1 if r[0] is None else r[0], *r[1:]) for r in got.collect()), key=key)
    assert mine == sorted((plain(r["doc_id"], r["text"]) for r in docs.collect()), key=key)
    assert any(r[1] for r in mine) and any(r[0] > 0 and zlib.crc32(str(r[0]).encode()) % 10 == 0 and r[1] for r in mine)


def test_outputs(spark, nothing):
    docs = spark.createDataFrame([(1, "x " + "a b " * 5 + "c"), (2, None)], "k long, body string")
    got = {r["doc_id"]: r for r in R.find_runs(docs, id_col="k", text_col="body").collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(1, 10, 2)] and got[1]["collapsed"] == "x a b c" and got[1]["n_words"] == 12
    assert got[2]["runs"] == [] and got[2]["collapsed"] == "" and R.find_runs(nothing).count() == 0

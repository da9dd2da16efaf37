"""Kneser-Ney: probabilities against a plain statement, thresholds, and odd rows."""

import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerline.llm import common, kneser_ney, ngrams
from ledgerline.llm import quality as Q


def discounts(counts):
    n = [sum(1 for c in counts if c == i) for i in range(5)]
    if not all(n[1:]):
        return [0, 0.5, 1.0, 1.5]
    y = n[1] / (n[1] + 2 * n[2])
    return [0] + [min(max(i - (i + 1) * y * n[i + 1] / n[i] if i < 4 else 0, 0.1), i - 0.1) for i in (1, 2, 3)]


class Plain:
    """Interpolated modified Kneser-Ney of order 3 over token lists."""

    def __init__(self, texts):
        tri = Counter()
        for t in texts:
            p = [Q.START, Q.START, *t, Q.END]
            tri.update(zip(p, p[1:], p[2:]))
        self.levels = []
        bi = Counter((v, w) for _, v, w in tri)
        uni = Counter((w,) for _, w in bi)
        for counts in (uni, bi, tri):
            d = discounts(list(counts.values()))
            total, lost = Counter(), defaultdict(float)
            for g, c in counts.items():
                total[g[:-1]] += c
                lost[g[:-1]] += d[min(c, 3)]
            self.levels.append((counts, d, total, lost))
        self.floor = 1 / (len(uni) + 1)

    def p(self, g):
        low = self.p(g[1:]) if len(g) > 1 else self.floor
        counts, d, total, lost = self.levels[len(g) - 1]
        if not total[g[:-1]]:
            return low
        c = counts.get(g, 0)
        return (c - d[min(c, 3)]) / total[g[:-1]] + lost[g[:-1]] / total[g[:-1]] * low

    def log10(self, t):
        p = [Q.START, Q.START, *t, Q.END]
        return -sum(math.log10(self.p(g)) for g in zip(p, p[1:], p[2:])) / (len(t) + 1)


def test_probabilities(spark):
    rnd = random.Random(5)
    say = lambda n: [rnd.choice("abcdefgh"[:rnd.choice((2, 8))]) for _ in range(n)]
    for size in (30, 2):
        train = [say(rnd.randrange(1, 25)) for _ in range(size)]
        tests = [(i, " ".join([*say(8), "new"][:rnd.randrange(1, 10)])) for i in range(25)]
        model = Q.train(spark.createDataFrame([("en", t) for t in train], "lang string, words array<string>"))
        plain = Plain(train)
        got = Q.score(spark.createDataFrame([(i, t, "en") for i, t in tests], "doc_id long, text string, lang string"), model)
        got = {r["doc_id"]: r["log10_perplexity"] for r in got.collect()}
        for i, t in tests:
            assert abs(got[i] - plain.log10(t.split())) < 1e-9
        context = (train[0] + [Q.START, Q.START])[:2]
        assert abs(sum(plain.p((*context, w)) for (w,) in plain.levels[0][0]) + plain.p((*context, "new")) - 1) < 1e-9


def test_threshold_is_the_quantile(spark):
    rnd = random.Random(1)
    values = [(lang, rnd.uniform(1, 4)) for lang in ("en", "de", None) for _ in range(400)]
    limits = {r["lang"]: r["threshold"] for r in Q.thresholds(
        spark.createDataFrame(values, "lang string, log10_perplexity double"), 0.9).collect()}
    for lang in ("en", "de", None):
        own = sorted(v for x, v in values if x == lang)
        assert own[359] <= limits[lang] <= own[359] + 1 / Q.STEPS + 1e-9


def corpus(spark, odd):
    rnd = random.Random(8)
    good = [" ".join(rnd.choice(["the", "cat", "sat", "on", "a", "mat", "and", "ran"]) for _ in range(60)) for _ in range(120)]
    junk = [" ".join("".join(rnd.choice("QXZJK!#") for _ in range(6)) for _ in range(60)) for _ in range(20)]
    rows = [(100 + i, t, "en") for i, t in enumerate(good)] + [(400 + i, t, "en") for i, t in enumerate(junk)]
    docs = odd.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string"), allowMissingColumns=True)
    labels = [(100 + i, 1, 0) for i in range(110)] + [(400, 0, 0), (100, 0, 0), (101, 1, 1), (None, 1, 0), (102, None, None)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_keeps_good_and_drops_junk(spark, odd):
    docs, labels = corpus(spark, odd)
    ids = [r["doc_id"] for r in Q.keep_good(docs, labels).collect()]
    assert not [i for i in ids if (i or 0) >= 400]
    assert sum(1 for i in range(100, 220) if i in ids) >= 118
    assert {6, 7, 8} <= set(ids)  # without words: kept
    assert set(r["doc_id"] for r in odd.where("lang is null").collect()) <= set(ids)  # no trusted text in the language
    assert ids.count(11) in (0, 2)


def test_without_labels_or_rows(spark, odd, nothing):
    docs, labels = corpus(spark, odd)
    assert Q.keep_good(docs, labels.where("doc_id < 0")).count() == docs.count()
    assert Q.keep_good(nothing, labels).count() == 0
    assert Q.keep_good(docs, labels).columns == docs.columns


def test_contradicting_labels_are_not_trusted(spark, odd):
    _, labels = corpus(spark, odd)
    trusted = {r["doc_id"] for r in Q.trusted_ids(labels).collect()}
    assert trusted == set(range(103, 210))


def test_query_keeps_rows_of_one_id_apart(spark, odd, tmp_path):
    docs, labels = corpus(spark, odd)
    good, junk = "the cat sat on a mat and ran " * 6, "QXZJ KKQ! #ZQX JJXQ " * 15
    more = [(i, t, "en") for i in (None, 900) for t in (good, junk, good + "the", junk)]
    docs = docs.select("doc_id", "text", "lang").unionAll(spark.createDataFrame(more, "doc_id long, text string, lang string"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = Q.query(spark, str(tmp_path)).collect()
    assert len(rows) == docs.count()
    for i in (None, 900):
        own = sorted((r["keep"], round(r["perplexity"], 6)) for r in rows
                     if r["doc_id"] == i and r["lang"] == "en" and r["perplexity"])
        assert [k for k, _ in own][:2] == [False, False] and all(k for k, _ in own[2:]) and len(set(own)) >= 3
        assert own[0] == own[1]


def test_every_trusted_document_counts(spark):
    """All trusted text, whole, trains the model or sets the threshold: many documents, some of them long."""
    rnd = random.Random(4)
    texts = {i: [rnd.choice(["ab", "cd", "ef", "gh", f"x{i}"]) for _ in range(rnd.randrange(3, 9))] for i in range(320)}
    for i in range(5):
        texts[i] = [rnd.choice(["ab", "cd", "long"]) for _ in range(21_000)]
    other = {1000 + i: ["ab", "x3", f"x{i}", "cd", "long", "new"] for i in range(12)}
    docs = spark.createDataFrame([(i, " ".join(t), "en") for i, t in (texts | other).items()], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in texts], "doc_id long, quality int, toxic int")
    draw = {r[0]: r[1] for r in docs.select("doc_id", F.expr("pmod(xxhash64(doc_id, 'train'), 1000000)")).collect()}
    read = {i for i in texts if draw[i] < 500_000}
    assert len(read) > 130 and {0, 1, 2, 3, 4} & read
    model = Plain([texts[i] for i in read])
    want = {i: model.log10(t) for i, t in (texts | other).items()}
    rows = Q.classify(docs, labels).collect()
    assert len(rows) == len(want)
    for r in rows:
        assert abs(r["log10_perplexity"] - want[r["doc_id"]]) < 1e-9
    own = sorted(want[i] for i in set(texts) - read)
    at = own[math.ceil(len(own) * Q.QUANTILE) - 1]
    assert all(at <= r["threshold"] <= at + 1 / Q.STEPS + 1e-9 for r in rows)


def test_training_and_scoring_by_parts(spark, monkeypatch):
    """Any number of parts, turns and buckets gives the same model; marks are no words of a text."""
    for name, value in (("BUCKET", 300), ("PART_WORDS", 400), ("TURN_BYTES", 1000), ("COMMON", 7), ("GROUP_BYTES", 500)):
        monkeypatch.setattr(kneser_ney, name, value)
    rnd = random.Random(6)
    say = lambda: [rnd.choice(["ab", "cd", "ef", "gh", "\x02", "\x03", f"x{rnd.randrange(60)}"]) for _ in range(rnd.randrange(1, 30))]
    train = [(lang, say()) for lang in ("en", None, "de") for _ in range(70)]
    model = Q.train(spark.createDataFrame(train, "lang string, words array<string>"))
    assert model.buckets > 20 and len(model.grams) > 4
    tests = [(i, " \t".join(say()) + " ", rnd.choice(["en", None, "de", "fr"])) for i in range(150)]
    got = Q.score(spark.createDataFrame(tests, "doc_id long, text string, lang string"), model)
    got = {r["doc_id"]: r["log10_perplexity"] for r in got.collect()}
    plain = {lang: Plain([[f"word {w}" for w in t] for x, t in train if x == lang]) for lang in ("en", None, "de")}
    assert set(got) == {i for i, _, lang in tests if lang != "fr"}
    for i, t, lang in tests:
        if lang != "fr":
            assert abs(got[i] - plain[lang].log10([f"word {w}" for w in t.split()])) < 1e-9
    model.scratch.drop()


def test_what_is_written_for_the_models_goes(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(common, "shared_dir", lambda _: f"file:{tmp_path}")
    docs = spark.createDataFrame([(i, f"the cat {i} sat", "en") for i in range(60)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    assert Q.decisions(docs, labels).where("perplexity is not null").count() == 60
    left = {re.sub("llm-|-[0-9a-f]{12}$", "", x) for x in os.listdir(tmp_path) if not x.startswith(".")}
    assert left == {"trusted", "train-ids", "perplexity"}


def test_hashes_are_those_of_spark(spark):
    rnd = random.Random(2)
    words = [rnd.choice("aé€😀") * rnd.randrange(1, 200) + str(i) for i in range(300)]
    x = ngrams.hashed(pa.array([w.encode() for w in words]))
    assert len(set(x.tolist())) == 300
    assert x[5:9].tolist() == ngrams.hashed(pa.array([w.encode() for w in words]).slice(5, 4)).tolist()
    rows = spark.createDataFrame([(i, int(v), int(v) ^ i) for i, v in enumerate(x.view(np.int64))], "i long, a long, b long")
    want = {r["i"]: (r["a"], r["b"], r["h"]) for r in rows.select("*", F.xxhash64("a", "b").alias("h")).collect()}
    for a, b, h in want.values():
        a, b = (np.array([v], np.int64).view(np.uint64) for v in (a, b))
        assert ngrams.xxhash(b, ngrams.xxhash(a, ngrams.SEED)).view(np.int64)[0] == h

"""The pipeline against brute force on whole small tables, and every stage on odd rows."""

import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F
from test_decontaminate import exact
from test_line_dedup import plain as plain_lines
from test_quality import Plain
from test_simhash import grouped
from test_simhash import slow as slow_fingerprint

import corpus_pipeline as C
from ledgerline.llm import decontaminate, packing, quality, simhash, tokens

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    previous = docs
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, previous, SF).cache()
        assert out.columns == columns, name
        assert {r[0] for r in out.select("doc_id").collect()} <= {r[0] for r in previous.select("doc_id").collect()}
        if name == "line_dedup":
            assert out.count() == previous.count()
            assert out.agg(F.sum("n_chars")).first()[0] == out.agg(F.sum(F.length("text"))).first()[0]
        if name == "simhash":
            left = simhash.near_duplicates(out).groupBy("component_id").count()
            assert left.where("count > 1").count() == 0
        if name == "decontamination":
            assert decontaminate.matches(out, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
            assert out.count() < previous.count()
        previous = out
    pieces = C.STAGES[-1][1](spark, previous, SF)
    got = {r[0] for r in pieces.select("doc_id").collect()}
    assert got == {r[0] for r in previous.select("doc_id").collect()}
    rows = C.run(spark, SF).select("doc_id", "piece", "ids_crc32").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, pieces.select("doc_id", "piece", "ids_crc32").collect()))


def test_odd_rows_and_empty_tables(spark, odd, nothing):
    for docs in (odd, nothing):
        for name, stage in C.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.count() <= docs.count(), name
        assert C.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_packing_output_columns(odd):
    assert packing.pack(odd).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def plain_quality(spark, docs, labels):
    """Ids kept by a plain statement of the classifier; only the hash draws come from Spark."""
    lang = {r["doc_id"]: r["lang"] for r in docs}
    words = {r["doc_id"]: split_plain(r["text"]) for r in docs}
    marks = {}
    for r in labels:
        marks.setdefault(r["doc_id"], []).append(r["quality"] == 1 and not r["toxic"])
    good = {i for i, ok in marks.items() if all(ok) and i in lang}
    draws = {r[0]: r[1] for r in spark.createDataFrame([(i,) for i in lang], "doc_id long").select(
        "doc_id", F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1_000_000))).collect()}
    count = Counter(lang[i] for i in good)
    chosen = {i for i in good if draws[i] < min(500_000, 1_000_000 * quality.TRAIN_DOCS / count[lang[i]])}
    kept = set(lang)
    for tongue in set(lang.values()):
        train = [words[i] for i in chosen if lang[i] == tongue and 0 < len(words[i]) <= quality.TRAIN_WORDS]
        if not train:
            continue
        model = Plain(train)
        score = {i: model.log10(words[i]) for i in lang if lang[i] == tongue and words[i]}
        cells = sorted(math.ceil(score[i] * quality.STEPS) for i in good - chosen if i in score)
        if cells:
            limit = next(c for k, c in enumerate(cells, 1) if k >= len(cells) * quality.QUANTILE) / quality.STEPS
            kept -= {i for i, s in score.items() if s > limit}
    return kept


def split_plain(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    kept = plain_quality(spark, docs, spark.read.parquet(f"{SF}/labels.parquet").collect())
    assert 0.5 * len(docs) < len(kept) < len(docs)
    texts = {r["doc_id"]: r["text"] for r in docs if r["doc_id"] in kept}
    cut = plain_lines(list(texts.items()))
    texts = {i: cut[i, t] if t else t for i, t in texts.items()}
    fps = {i: slow_fingerprint(t) for i, t in texts.items()}
    root = grouped(fps.values())
    first = {}
    for i in sorted(texts):
        first.setdefault(root[fps[i]], i)
    texts = {i: texts[i] for i in first.values()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, _, _ in exact(list(texts.items()), items)}
    words = tokens.load()
    want = []
    for i, t in texts.items():
        if i not in bad:
            raw = words.encode(t or "") + b"\0\0\0\0"
            want += [(i, k, s, n, zlib.crc32(raw[4 * s:4 * (s + n)])) for k, (s, n) in enumerate(packing.cut(len(raw) // 4))]
    got = C.run(spark, SF).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == sorted(want)

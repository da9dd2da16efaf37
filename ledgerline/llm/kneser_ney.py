"""Interpolated modified Kneser-Ney models of order 3, one a language: training and scores over any number of n-grams.

log10 p of a word after two others is a sum over what the model knows: the language's floor, what a known word adds to
it, the back-off weight of the word before, what a known pair adds to these, the back-off weight of the pair
before, and what a known triple adds.  So a model is a table of a value for every known word, pair and triple,
and a text's score is the sum of the values of its own.  Values are whole numbers, so no order of rows matters.
Most pairs go on in one way, seen once; their back-off weight is that of such a pair, which the pair's own value holds already,
so the table has a second value only for the others.

Training goes by parts, the triples whose middle word falls to one: all triples and pairs of a context lie in one part.  In a part
they lie in buckets by the hash of a pair; no task holds more than a bucket.  Only sums of a language, and the values of the
``COMMON`` most frequent words (a bounded list), reach the driver and all tasks.

Scoring goes by parts of the buckets and of the documents.  A task over documents sends the keys of their pairs and
triples to the buckets, the task of a bucket answers with a sum a document: no more than 16 bytes an n-gram are
shuffled, and what a turn has shuffled goes before the next.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import ngrams as N
from ledgerline.llm.common import Scratch

UNIT = 10**10  # log10 probabilities are summed in these parts of one
COMMON = 200_000  # words sent to every task
BUCKET = 250_000  # n-grams
PART_WORDS, PARTS = 500_000, 8  # least words of a training part, and most parts
TURN_BYTES, KEY_PARTS, TURNS = 4_000_000, 3, 6  # least text of a scoring turn, most parts of the keys and turns a part
WORDS, COUNTED, PAIRS, TRIPLES, ASKED, TOLD = range(6)  # kinds of GRAMS rows
GROUP_BYTES = 16_000_000  # text of a group of texts, whose sums are added up by one task
HELD = 500_000  # sums held by a task
GRAMS = "bucket int, kind int, a binary, b binary, c binary, d binary"
SUMS = ("c1", "c2", "c3", "c4", "c5")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    full = [(*r, *[None] * (6 - len(r))) for r in rows]
    return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*full), kinds)], names=["bucket", "kind", "a", "b", "c", "d"])


def _groups(to: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``value, begin, end`` of the runs of a sorted array."""
    begin = N.starts(to)
    yield from zip(to[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(to)])


def _tabled(keys: np.ndarray, values: np.ndarray, buckets: int, kind: int, by: np.ndarray | None = None) -> list[tuple]:
    """Rows of distinct keys and whole values, by bucket of the key, or of ``by``."""
    to = N.mod(keys if by is None else by, buckets)
    order = np.lexsort((keys, to))
    keys, values, to = keys[order], values[order], to[order]
    return [(b, kind, N.stored(np.diff(keys[i:j], prepend=np.uint64(0)), values[i:j])) for b, i, j in _groups(to)]


def _opened(blob) -> tuple[np.ndarray, np.ndarray]:
    gaps, values = N.read(blob)
    return np.cumsum(gaps.view(np.uint64), dtype=np.uint64), values


def _whole(x: np.ndarray) -> np.ndarray:
    return np.rint(x * UNIT).astype(np.int64)


# ------------------------------------------------------------------ training

def _triples(part: int, parts: int, buckets: int):
    """A task's work: the triples of ``lang, words`` rows that fall to a part, by bucket of their last two words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = np.nan_to_num(pc.list_value_length(b.column(1)).to_numpy(zero_copy_only=False)).astype(np.int64)
            for start, rows in N.chunks(n, N.CHUNK_BYTES // 8):
                own = b.slice(start, rows)
                x, first, kinds = N.marked(own.column(1).flatten(), n[start:start + rows], own.column(0))
                inside = np.ones(len(x), bool)
                for k in (1, 2):
                    inside[first[1:] - k] = False
                at = np.flatnonzero(inside)
                if parts > 1:
                    at = at[N.mod(x[at + 1], parts) == part]
                lang = kinds[np.searchsorted(first, at, "right") - 1]
                pair = N.xxhash(x[at + 2], N.xxhash(x[at + 1], N.SEED))
                to = N.mod(pair, buckets)
                order = np.lexsort((lang, to))
                u, v, w, lang, to = (y[order] for y in (x[at], x[at + 1], x[at + 2], lang, to))
                out = [(q, COUNTED, *(y[i:j].tobytes() for y in (u, v, w, lang))) for q, i, j in _groups(to)]
                if out:
                    yield _rows(out)

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket's distinct triples with their counts, and its pairs with the number of words before them."""
    got, bucket = [], None
    for b in batches:
        for i in range(b.num_rows):
            bucket = b.column(0)[i].as_py()
            got.append([np.frombuffer(b.column(k)[i].as_buffer(), "<u8") for k in (2, 3, 4, 5)])
    if not got:
        return
    u, v, w, lang = (np.concatenate(x) for x in zip(*got))
    del got
    order = np.lexsort((u, w, v))
    u, v, w, lang = u[order], v[order], w[order], lang[order]
    first = N.starts(v, w, u)
    count = np.diff(first, append=len(u))
    u, v, w, lang = u[first], v[first], w[first], lang[first]
    pair = N.starts(v, w)
    langs, code = np.unique(lang[pair], return_inverse=True)
    yield _rows([(bucket, COUNTED, N.stored(u, count, v[pair], w[pair], np.diff(pair, append=len(u)), code.astype(np.int64), langs))])


def _parts(b: pa.RecordBatch) -> Iterator[tuple]:
    """``bucket, u, c, v, w, n, code, langs`` of the counted rows of a batch."""
    for i in range(b.num_rows):
        u, c, v, w, n, code, langs = N.read(b.column(2)[i].as_buffer())
        yield (b.column(0)[i].as_py(), u.view(np.uint64), c, v.view(np.uint64), w.view(np.uint64), n, code, langs)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``kind, l, x`` and sums: 0, a word: words before it; as a context: pairs in all, and kinds of pair met once, twice, oftener.
    1 and 2, a language: pairs, and triples, met once to four times."""
    for b in batches:
        for _, _, c, v, w, n, code, langs in _parts(b):
            own = langs[code]
            order = np.argsort(w)
            at = N.starts(w[order])
            zero = np.zeros(len(at), np.int64)
            yield _sums(0, own[order][at], w[order][at], np.diff(at, append=len(w)), zero, zero, zero, zero)
            at = N.starts(v)
            zero = np.zeros(len(at), np.int64)
            yield _sums(0, own[at], v[at], zero, *(np.add.reduceat(y.astype(np.int64), at) for y in (n, n == 1, n == 2, n > 2)))
            for kind, many, of in ((1, n, code), (2, c, np.repeat(code, n))):
                met = [np.bincount(of[many == k], minlength=len(langs)).astype(np.int64) for k in (1, 2, 3, 4)]
                yield _sums(kind, langs, langs, *met, np.zeros(len(langs), np.int64))


def _sums(kind: int, lang: np.ndarray, x: np.ndarray, *sums: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.full(len(x), kind, np.int32)), *(pa.array(y.view(np.int64)) for y in (lang, x, *sums))],
                           names=["kind", "l", "x", *SUMS])


def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """What is taken off a count of one, of two, of more, by the numbers of things counted once to four times."""
    if not (n1 > 0 and n2 > 0 and n3 > 0 and n4 > 0):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    usual = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.1), i - 0.1) for i, d in enumerate(usual, 1))


def _rare(common):
    """A task's work: ``bucket, x`` of the words of counted buckets that are not in the common list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bucket, _, _, v, w, _, _, _ in _parts(b):
                x = np.unique(np.concatenate([v, w]))
                x = x[~N.place(common.value[0], x)[1]]
                yield pa.record_batch([pa.array(np.full(len(x), bucket, np.int32)), pa.array(x.view(np.int64))], names=["bucket", "x"])

    return run


def _priced(common, off: dict[int, tuple], buckets: int, local: int):
    """A bucket's work: what its pairs add, by bucket of the model, and its triples with their pair's probability, by bucket of their first two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, mine = common.value[:4], []
        for b in batches:
            rare = np.flatnonzero(b.column(1).to_numpy() == WORDS)
            if len(rare):
                mine.append([b.column(k).take(pa.array(rare)).to_numpy(zero_copy_only=False) for k in (6, 7, 8, 9)])
            counted = b.filter(pc.equal(b.column(1), COUNTED))
            if not counted.num_rows:
                continue
            if mine is not None:
                own = [np.concatenate(x) for x in zip(*mine)] if mine else [x[:0] for x in known]
                x = own[0].astype(np.int64).view(np.uint64)
                order = np.argsort(x)
                own, mine = [x[order], *(y[order] for y in own[1:])], None

            def told(x: np.ndarray, k: int) -> np.ndarray:
                """A value of words: 1 probability, 2 back-off weight, 3 total."""
                at, hit = N.place(own[0], x)
                at2, _ = N.place(known[0], x)
                return np.where(hit, own[k][at] if len(own[0]) else 0.0, known[k][at2] if len(known[0]) else 0.0)

            for _, u, c, v, w, n, code, langs in _parts(counted):
                taken = np.array([off[int(x)] for x in langs])  # language, order (pair, triple), count
                usual = np.log10(taken[code, 1, 0])  # back-off weight of a pair met once
                usual[w == N.xxhash(N.END, langs.view(np.uint64))[code]] = 0  # a closing mark has none
                less = taken[code, 0, np.minimum(n, 3) - 1]
                low, gamma = told(w, 1), told(v, 2)
                p = (n - less) / told(v, 3) + gamma * low
                key = N.xxhash(w, N.xxhash(v, N.SEED))
                out = _tabled(key, _whole(np.log10(p) - np.log10(gamma) - np.log10(low)) + _whole(usual), buckets, PAIRS)
                pair = np.repeat(np.arange(len(n)), n)
                first = N.xxhash(v[pair], N.xxhash(u, N.SEED))
                key, p, less = N.xxhash(w[pair], first), p[pair], taken[code[pair], 1, np.minimum(c, 3) - 1]
                mark = N.xxhash(N.START, langs.view(np.uint64))[code[pair]]
                held = _whole(np.where((u == mark) & (v[pair] == mark), 0, np.log10(taken[code[pair], 1, 0])))  # two marks are no known pair
                to = N.mod(first, local)
                order = np.lexsort((first, to))
                first, key, c, less, p, held, to = (y[order] for y in (first, key, c, less, p, held, to))
                out += [(q, TRIPLES, N.stored(*(y[i:j] for y in (first, key, c, less, p, held)))) for q, i, j in _groups(to)]
                yield _rows(out)

    return run


def _modelled(buckets: int):
    """A bucket's work: what its triples add, and the back-off weights of their first two words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = []
        for b in batches:
            kind = b.column(1).to_numpy()
            yield b.filter(pa.array(kind != TRIPLES))
            got += [N.read(b.column(2)[i].as_buffer()) for i in np.flatnonzero(kind == TRIPLES).tolist()]
        if got:
            first, key, c, less, p, held = (np.concatenate(x) for x in zip(*got))
            del got
            order = np.argsort(first)
            first, key, c, less, p = first[order], key[order], c[order], less[order].view(np.float64), p[order].view(np.float64)
            at = N.starts(first)
            total = np.add.reduceat(c, at)
            gamma = np.add.reduceat(less, at) / total
            context = np.repeat(np.arange(len(at)), np.diff(at, append=len(first)))
            more = np.log10((c - less) / total[context] + gamma[context] * p) - np.log10(gamma[context]) - np.log10(p)
            weight = _whole(np.log10(gamma)) - held[order][at]
            own = weight != 0
            yield _rows(_tabled(key.view(np.uint64), _whole(more), buckets, TRIPLES, first.view(np.uint64)) +
                        (_tabled(first[at][own].view(np.uint64), weight[own], buckets, PAIRS) if own.any() else []))

    return run


def _singles(buckets: int):
    """A task's work: what words add, and their back-off weights, ``key, value`` rows of a bucket or some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield _rows(_tabled(*N.summed(b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()), buckets, PAIRS))

    return run


def slices(n: int, unit: int, most: int) -> int:
    return max(1, min(most, math.ceil(n / unit)))


class Model:
    """``grams``: tables of keys and values by bucket; ``common``: sorted keys of frequent words and their values; ``floor``: by language hash."""

    def __init__(self, scratch: Scratch, grams: list[DataFrame], common: tuple, floor: dict[int, int], buckets: int):
        self.scratch, self.grams, self.common, self.floor, self.buckets = scratch, grams, common, floor, buckets


def train(texts: DataFrame) -> Model:
    """Model of ``lang, words`` rows."""
    spark, scratch, texts = texts.sparkSession, Scratch(), texts.select("lang", "words")
    tokens = texts.agg(F.sum(F.size("words"))).first()[0] or 0
    parts = slices(tokens, PART_WORDS, PARTS)
    local = max(1, math.ceil(2 * tokens / BUCKET / parts))
    buckets = local * parts
    counted, said = [], []
    for i in range(parts):
        rows = texts.mapInArrow(_triples(i, parts, local), GRAMS).repartitionById(local, "bucket").mapInArrow(_counted, GRAMS)
        counted.append(scratch.written(rows.select("bucket", "kind", "a"), "kn-counts"))
        said.append(scratch.written(counted[-1].mapInArrow(_words, "kind int, l long, x long, " + ", ".join(f"{c} long" for c in SUMS))
                                    .groupBy("kind", "l", "x").agg(*[F.sum(c).alias(c) for c in SUMS]), "kn-said"))
    words = scratch.written(reduce(DataFrame.unionAll, said).groupBy("kind", "l", "x").agg(*[F.sum(c).alias(c) for c in SUMS]), "kn-words")
    scratch.drop(*said)

    met = words.where("kind = 0 and c1 > 0").groupBy("l").agg(
        F.count(F.lit(1)).alias("types"), F.sum("c1").alias("total"),
        *[F.sum(F.when(F.col("c1") == i, 1).otherwise(0)).alias(f"c{i}") for i in (1, 2, 3, 4)]).collect()
    stats = {(r["kind"], r["l"]): discounts(*[r[c] for c in SUMS[:4]]) for r in words.where("kind > 0").collect()}
    off, floor, per_lang = {}, {}, []
    for r in met:
        lang, own = r["l"], [r[c] for c in SUMS[:4]]
        d1, d2 = discounts(*own), stats[1, lang]
        p0 = sum(a * b for a, b in zip(d1, (*own[:2], r["types"] - own[0] - own[1]))) / r["total"] / (r["types"] + 1)
        off[lang], floor[lang] = (d2, stats[2, lang]), round(math.log10(p0) * UNIT)
        per_lang.append((lang, *map(float, (*d1, *d2, r["total"], p0))))
    consts = spark.createDataFrame(per_lang, "l long, a1 double, a2 double, a3 double, b1 double, b2 double, b3 double, n double, p0 double")
    values = words.where("kind = 0").join(F.broadcast(consts), "l").selectExpr(
        "x", "c1 + c2 as weight", "p0", "cast(c2 as double) as t",
        "case when c1 > 0 then (c1 - case when c1 = 1 then a1 when c1 = 2 then a2 else a3 end) / n + p0 end as p",
        "case when c2 > 0 then (b1 * c3 + b2 * c4 + b3 * c5) / c2 end as g").selectExpr(
        "x", "weight", "p", "g", "t", f"coalesce(round((log10(p) - log10(p0)) * {UNIT}), 0) + coalesce(round(log10(g) * {UNIT}), 0) as value")
    values = scratch.written(values.withColumn("value", F.col("value").cast("long")), "kn-values")
    scratch.drop(words)
    top = values.orderBy(F.desc("weight"), "x").limit(COMMON).select("x", "p", "g", "t", "value", "weight").toArrow()
    least = pc.min(top.column(5)).as_py() or 0
    top = [top.column(k).combine_chunks().to_numpy(zero_copy_only=False) for k in range(5)]
    top[0] = top[0].astype(np.int64).view(np.uint64)
    order = np.argsort(top[0])
    top = [x[order] for x in top]
    common = spark.sparkContext.broadcast(tuple(top))

    grams = []
    for part in counted:
        rare = part.mapInArrow(_rare(common), "bucket int, x long").join(values.where(F.col("weight") <= least).select("x", "p", "g", "t"), "x") \
            .select("bucket", F.lit(WORDS).alias("kind"), *[F.lit(None).cast("binary").alias(c) for c in "abcd"], "x", "p", "g", "t")
        rows = part.select("bucket", "kind", "a", *[F.lit(None).cast("binary").alias(c) for c in "bcd"], F.lit(None).cast("long").alias("x"),
                           *[F.lit(None).cast("double").alias(c) for c in "pgt"])
        rows = rare.unionAll(rows).repartitionById(local, "bucket").sortWithinPartitions("kind") \
            .mapInArrow(_priced(common, off, buckets, local), GRAMS)
        rows = rows.repartitionById(local, F.col("bucket") % local).mapInArrow(_modelled(buckets), GRAMS)
        grams.append(scratch.written(rows.select("bucket", "kind", "a"), "kn-grams"))
        scratch.drop(part)
    key = F.xxhash64("x")
    rows = values.where(F.col("weight") <= least).select(key.alias("key"), "value").repartitionById(local, F.pmod(key, F.lit(local)).cast("int"))
    grams.append(scratch.written(rows.mapInArrow(_singles(buckets), GRAMS).select("bucket", "kind", "a"), "kn-grams"))
    scratch.drop(values)
    common.destroy()
    one = N.xxhash(top[0], N.SEED)
    order = np.argsort(one)
    return Model(scratch, grams, (one[order], top[4].astype(np.int64)[order]), floor, buckets)


# ------------------------------------------------------------------ scoring

def _asked(sent, floor: dict[int, int], part: int, parts: int, buckets: int):
    """A task's work: the pairs and triples of ``g, lang, text`` rows to the buckets of their pairs that fall to a part.

    Frequent words are looked up here; other words go like pairs.  In part 0 a text's own row says what its language's floor and
    its frequent words give, and the number of its triples.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for b in batches:
            sizes = np.nan_to_num(pc.binary_length(b.column(2)).to_numpy(zero_copy_only=False)).astype(np.int64)
            for start, rows in N.chunks(sizes, N.CHUNK_BYTES):
                out = ask(b.slice(start, rows), table)
                if out:
                    yield _rows(out)

    def ask(b: pa.RecordBatch, table: tuple) -> list[tuple]:
        words, n = N.split(b.column(2))
        full = n > 0
        if not full.any():
            return []
        n, b = n[full], b.filter(pa.array(full))
        g = b.column(0).to_numpy()
        x, first, kinds = N.marked(words, n, b.column(1))
        low = [floor.get(int(k)) for k in kinds.view(np.int64)]
        known = np.array([y is not None for y in low])  # without a model of the language: no score
        low = np.array([y or 0 for y in low], np.int64)
        text = np.repeat(np.arange(len(n)), n + 3)
        one = N.xxhash(x, N.SEED)
        two = N.xxhash(x[1:], one[:-1])
        three = np.zeros(len(two), np.uint64)
        three[:-1] = N.xxhash(x[2:], two[:-1])
        three[:-1][text[:-2] != text[2:]] = 0
        later = np.ones(len(x), bool)
        later[first[:-1]] = False  # the first mark is neither a word nor a context
        at, hit = N.place(table[0], one[later])
        value = np.where(hit, table[1][at], 0) if len(table[0]) else np.zeros(len(at), np.int64)
        out = []
        if part == 0:
            sums = low * (n + 1) + np.add.reduceat(value, np.cumsum(n + 2) - (n + 2))
            to = int(N.mod(g[:1], -(-buckets // parts))[0]) * parts  # any bucket of the part
            out.append((to, TOLD, g[known].tobytes(), sums[known].tobytes(), (n + 1)[known].tobytes()))
        rest = later.copy()
        rest[later] = ~hit
        rest &= known[text]
        inside = (text[:-1] == text[1:]) & known[text[:-1]]
        pair = np.concatenate([two[inside], one[rest]])
        triple = np.concatenate([three[inside], np.zeros(int(rest.sum()), np.uint64)])
        owner = np.concatenate([text[:-1][inside], text[rest]])
        to = N.mod(pair, buckets)
        if parts > 1:
            mine = to % parts == part
            pair, triple, owner, to = (y[mine] for y in (pair, triple, owner, to))
        group = to * len(n) + owner
        order = np.argsort(group)
        pair, triple, group = pair[order], triple[order], group[order]
        runs = N.starts(group)
        ends = np.append(runs, len(group))
        to, owner = np.divmod(group[runs], len(n))
        counts, g = np.diff(ends).astype("<u4"), g[owner]
        for q, i, j in _groups(to):
            out.append((q, ASKED, pair[ends[i]:ends[j]].tobytes(), triple[ends[i]:ends[j]].tobytes(), g[i:j].tobytes(), counts[i:j].tobytes()))
        return out

    return run


def _answered(groups: int):
    """A bucket's work: sums of what is asked of it, by group of texts; its tables come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, told, held = {PAIRS: [], TRIPLES: []}, [], 0
        for b in batches:
            for i in range(b.num_rows):
                kind = b.column(1)[i].as_py()
                if kind in (PAIRS, TRIPLES):
                    tables[kind].append(_opened(b.column(2)[i].as_buffer()))
                    continue
                for k, got in tables.items():
                    if isinstance(got, list):
                        tables[k] = N.summed(*map(np.concatenate, zip(*got))) if got else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                if kind == TOLD:
                    told.append([np.frombuffer(b.column(k)[i].as_buffer(), "<i8") for k in (2, 3, 4)])
                else:
                    value = 0
                    for k, column in ((PAIRS, 2), (TRIPLES, 3)):
                        keys, values = tables[k]
                        at, hit = N.place(keys, np.frombuffer(b.column(column)[i].as_buffer(), "<u8"))
                        value = value + (np.where(hit, values[at], 0) if len(keys) else np.zeros(len(at), np.int64))
                    g = np.frombuffer(b.column(4)[i].as_buffer(), "<i8")
                    counts = np.frombuffer(b.column(5)[i].as_buffer(), "<u4").astype(np.int64)
                    told.append([g, np.add.reduceat(value, np.cumsum(counts) - counts), np.zeros(len(g), np.int64)])
                held += len(told[-1][0])
                if held > HELD:
                    yield _rows(_dealt(told, groups))
                    told, held = [], 0
        if held:
            yield _rows(_dealt(told, groups))

    return run


def _by_text(told: list) -> tuple[np.ndarray, ...]:
    """Texts ``g``, and the sums ``s`` and ``n`` of each."""
    g, s, n = (np.concatenate(x) for x in zip(*told))
    order = np.argsort(g)
    g, s, n = g[order], s[order], n[order]
    first = N.starts(g)
    return g[first], np.add.reduceat(s, first), np.add.reduceat(n, first)


def _dealt(told: list, groups: int) -> list[tuple]:
    g, s, n = _by_text(told)
    to = N.mod(g, groups)
    order = np.argsort(to, kind="stable")
    g, s, n, to = g[order], s[order], n[order], to[order]
    return [(q, TOLD, g[i:j].tobytes(), s[i:j].tobytes(), n[i:j].tobytes()) for q, i, j in _groups(to)]


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A group's work: ``g, s, n`` of its texts."""
    told = []
    for b in batches:
        told += [[np.frombuffer(b.column(k)[i].as_buffer(), "<i8") for k in (2, 3, 4)] for i in range(b.num_rows)]
        if sum(len(x[0]) for x in told) > HELD:
            told = [_by_text(told)]
    if told:
        yield pa.record_batch([pa.array(x) for x in _by_text(told)], names=["g", "s", "n"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, k, lang, log10_perplexity`` of every distinct (id, text) with words whose language has a model."""
    docs = docs.select("doc_id", "text", "lang")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(model.buckets, slices(size, TURN_BYTES, KEY_PARTS))
    turns = slices(size, TURN_BYTES * parts, TURNS)
    groups = slices(size, GROUP_BYTES * turns, 1 << 30)
    common = docs.sparkSession.sparkContext.broadcast(model.common)
    texts = docs.select(F.xxhash64("doc_id", "text", "lang").alias("g"), "lang", "text")
    tables = reduce(DataFrame.unionAll, model.grams).select("bucket", "kind", "a", *[F.lit(None).cast("binary").alias(c) for c in "bcd"])
    sums = []
    for part, turn in ((p, t) for p in range(parts) for t in range(turns)):
        own = texts.where(F.pmod("g", F.lit(turns)) == turn) if turns > 1 else texts
        asked = own.mapInArrow(_asked(common, model.floor, part, parts, model.buckets), GRAMS)
        rows = (tables.where(F.col("bucket") % parts == part) if parts > 1 else tables).unionAll(asked)
        rows = rows.repartitionById(-(-model.buckets // parts), F.floor(F.col("bucket") / parts).cast("int")).sortWithinPartitions("kind")
        told = rows.mapInArrow(_answered(groups), GRAMS).repartitionById(groups, "bucket").mapInArrow(_totals, "g long, s long, n long")
        sums.append(model.scratch.written(told, "kn-sums"))
    common.destroy()
    total = reduce(DataFrame.unionAll, sums).groupBy("g").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    ids = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("k"), "lang", F.xxhash64("doc_id", "text", "lang").alias("own")).distinct()
    return ids.join(total, F.col("own") == F.col("g")).select(
        "doc_id", "k", "lang", (-F.col("s") / F.col("n") / UNIT).alias("log10_perplexity"))

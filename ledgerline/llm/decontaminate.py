"""Benchmark decontamination by size-partitioned MinHash containment search (operator 8).

Sets are the five-word shingles of a text (ASCII lower case; a text of fewer
words is one shingle, a text without words none).  A document is contaminated
by an item when it holds at least ``threshold`` of the item's distinct shingles.

Search.  Plain MinHash misses short items in long documents, whose Jaccard
similarity is near zero.  Items are therefore partitioned by size (8, 16, 32,
... shingles), and for every partition the document is cut into windows of two
blocks of that size, so that item and window are of like size: a contained
item has a Jaccard similarity of at least about 0.19 with some window.  Each
partition indexes its items under every one of ``functions`` minima (bands of
one row), and a window equal in any of them makes a candidate: an item right at
the threshold is missed with a probability of (1 - 0.19) ** 64, about 1e-6.
Block minima of the smallest size are computed once and merged upwards.

Verification.  A candidate's exact shingles are looked up in the whole
document, compared as bytes; the result holds nothing unverified.

Scale.  Items are the query set: blocks of at most ``block_bytes`` of text are
collected and sent to the tasks, one pass over the documents for each block, so
the broadcast is bounded whatever the size of the benchmark.  Documents are
never shuffled, and very long ones are read in segments that overlap by the
longest item.

Defined results: null and empty texts match nothing; an item of fewer than five
words matches only documents made of exactly these words; repeated rows are
reported as often as they occur; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerline.llm.common import packed, unpacked, written

SHINGLE = 5
THRESHOLD = 0.8
FUNCTIONS = 64
BASE = 8
BLOCK_BYTES = 8 << 20
BATCH = 1 << 17
SEGMENT = 1 << 20
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes], k: int = SHINGLE) -> set[bytes]:
    if len(words) < k:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[i:] for i in range(k)))))


def shingle_hashes(words: list[bytes], k: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the shingles in order, mixed from the hashes of their words."""
    import xxhash

    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = max(len(h) - k + 1, min(len(h), 1))
    out = np.zeros(n, np.uint64)
    for i in range(min(k, len(h))):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def hash_functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(8)
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


class Partition(NamedTuple):
    """Items of one size class: for each hash function the sorted minima, their items and a 16-bit filter."""

    level: int
    minima: list[np.ndarray]
    items: list[np.ndarray]
    filters: np.ndarray


class Index(NamedTuple):
    partitions: list[Partition]
    ids: list
    sets: list[set[bytes]]
    longest: int


def build_index(items: list[tuple], functions: int = FUNCTIONS, k: int = SHINGLE) -> Index:
    """Index of ``(item_id, text)`` rows; items without words are left out."""
    a, b = hash_functions(functions)
    ids, sets, longest, classes = [], [], 0, {}
    for item_id, text in items:
        words = split_words(text)
        if not words:
            continue
        own = np.unique(shingle_hashes(words, k))
        level = max(0, math.ceil(math.log2(max(len(own), 1) / BASE)))
        signature = (own[None, :] * a[:, None] + b[:, None]).min(axis=1)
        classes.setdefault(level, []).append((len(ids), signature))
        ids.append(item_id)
        sets.append(shingle_set(words, k))
        longest = max(longest, len(words))
    partitions = []
    for level, members in sorted(classes.items()):
        which = np.array([m for m, _ in members])
        signatures = np.stack([s for _, s in members])
        order = [np.argsort(signatures[:, j], kind="stable") for j in range(functions)]
        minima = [signatures[o, j] for j, o in enumerate(order)]
        filters = np.zeros((functions, 1 << 16), bool)
        for j, m in enumerate(minima):
            filters[j, (m >> np.uint64(48)).astype(np.int64)] = True
        partitions.append(Partition(level, minima, [which[o] for o in order], filters))
    return Index(partitions, ids, sets, longest)


def candidates(index: Index, hashes: list[np.ndarray], functions: int = FUNCTIONS) -> set[tuple[int, int]]:
    """``(place in hashes, item)`` pairs with an equal minimum in a window of the item's size class."""
    if not hashes:  # no rows or words since the last flush
        return set()
    a, b = hash_functions(functions)
    blocks = np.array([-(-len(h) // BASE) for h in hashes], np.int64)
    flat = np.full(int(blocks.sum()) * BASE, NONE, np.uint64)
    at = 0
    for h, n in zip(hashes, blocks):
        flat[at:at + len(h)] = h
        if len(h):
            flat[at + len(h):at + n * BASE] = h[-1]  # padding repeats a shingle of the same text
        at += int(n) * BASE
    lanes = np.ascontiguousarray(flat.reshape(-1, BASE).T)
    top = max((p.level for p in index.partitions), default=-1)
    owners, merges = [np.repeat(np.arange(len(hashes)), blocks)], []
    for _ in range(top):
        starts = np.concatenate(([0], np.cumsum(blocks)[:-1]))
        nxt = (blocks + 1) // 2
        owner = np.repeat(np.arange(len(hashes)), nxt)
        inside = np.arange(int(nxt.sum())) - np.repeat(np.concatenate(([0], np.cumsum(nxt)[:-1])), nxt)
        left = starts[owner] + 2 * inside
        merges.append((left, np.minimum(left + 1, starts[owner] + blocks[owner] - 1)))
        owners.append(owner)
        blocks = nxt
    found: set[tuple[int, int]] = set()
    by_level = {p.level: p for p in index.partitions}
    for j in range(functions):
        low = np.minimum.reduce(lanes * a[j] + b[j], axis=0)
        for level in range(top + 1):
            if level:
                left, right = merges[level - 1]
                low = np.minimum(low[left], low[right])
            if level in by_level and len(low):
                p = by_level[level]
                window = low.copy()
                window[:-1] = np.minimum(low[:-1], low[1:])  # may reach into the next text: verification decides
                window_at = np.flatnonzero(p.filters[j][(window >> np.uint64(48)).astype(np.int64)])
                if len(window_at):
                    values = window[window_at]
                    lo, hi = np.searchsorted(p.minima[j], values, "left"), np.searchsorted(p.minima[j], values, "right")
                    for w, x, y in zip(window_at[hi > lo], lo[hi > lo], hi[hi > lo]):
                        found.update((int(owners[level][w]), int(i)) for i in p.items[j][x:y])
    return found


def segments(words: list[bytes], overlap: int) -> Iterator[list[bytes]]:
    if len(words) <= SEGMENT:
        yield words
        return
    for start in range(0, len(words), SEGMENT):
        yield words[start:start + SEGMENT + overlap]


def matches(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, functions: int = FUNCTIONS,
            shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text",
            item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared, containment`` of every contaminated document and item."""
    query = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
    cols = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = (f"doc_id {cols.schema[0].dataType.simpleString()}, item_id {query.schema[0].dataType.simpleString()}, "
              "n_shingles long, n_shared long, containment double")
    ids_type = to_arrow_type(query.schema[0].dataType)
    total = query.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, math.ceil(total / block_bytes))
    spark = docs.sparkSession
    parts = []
    for block in range(n_blocks):
        rows = query.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).collect()
        index = spark.sparkContext.broadcast(build_index([tuple(r) for r in rows], functions, shingle))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            ix = index.value

            def flush(waiting, doc_ids):
                pairs = candidates(ix, [h for _, _, h in waiting], functions) if ix.partitions else ()
                wanted: dict[int, set[int]] = {}
                texts = {}
                for place, item in pairs:
                    row, words, _ = waiting[place]
                    wanted.setdefault(row, set()).add(item)
                    texts[row] = words
                out = []
                for row, its in wanted.items():
                    need = set().union(*(ix.sets[i] for i in its))
                    words = texts[row]
                    if len(words) < shingle:
                        have = need & shingle_set(words, shingle)
                    else:
                        have = need.intersection(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
                    for i in its:
                        n, shared = len(ix.sets[i]), len(ix.sets[i] & have)
                        if shared / n >= threshold:
                            out.append((row, ix.ids[i], n, shared, shared / n))
                columns = list(zip(*sorted(out, key=lambda r: (r[0], r[2])))) or [()] * 5
                return pa.record_batch([doc_ids.take(pa.array(columns[0], pa.int64())), pa.array(columns[1], ids_type),
                                        pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64()),
                                        pa.array(columns[4], pa.float64())],
                                       names=["doc_id", "item_id", "n_shingles", "n_shared", "containment"])

            for batch in batches:
                waiting, size = [], 0
                for row in range(batch.num_rows):
                    words = split_words(batch.column(1)[row].as_py())
                    for part in segments(words, ix.longest):
                        h = shingle_hashes(part, shingle)
                        waiting.append((row, words, h))
                        size += len(h)
                    if size >= BATCH:
                        yield flush(waiting, batch.column(0))
                        waiting, size = [], 0
                yield flush(waiting, batch.column(0))

        parts.append(cols.mapInArrow(run, schema))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, **params) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns pass unchanged."""
    bad = written(matches(docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key")),
                          items, id_col="key", **params).select("doc_id").distinct(), "contaminated")
    rows = packed(docs).withColumn("key", F.xxhash64(F.col("doc_id"), F.col("row.text")))
    return rows.join(bad.select(F.col("doc_id").alias("key")).hint("shuffle_hash"), "key", "left_anti").select(*unpacked(docs.columns))


def query(spark, sf_dir: str) -> DataFrame:
    """op8: every document and benchmark item it contains."""
    return matches(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_WORDS = ("regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x20\\x09-\\x0D]+')")
_SET = (f"CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')] ELSE list_distinct("
        f"list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))) END")

#: Exact shingle containment of every item in every document, by one join on the shingle.
ORACLE = f"""
WITH d AS (SELECT doc_id, unnest({_SET}) AS s FROM (SELECT doc_id, {_WORDS.format(t='text')} AS w FROM documents)),
b AS (SELECT item_id, {_SET} AS ss FROM (SELECT item_id, {_WORDS.format(t='text')} AS w FROM benchmark)),
i AS (SELECT item_id, unnest(ss) AS s, len(ss) AS n FROM b),
m AS (SELECT doc_id, item_id, any_value(n)::BIGINT AS n_shingles, count(*) AS n_shared FROM d JOIN i USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment FROM m
WHERE n_shared / n_shingles >= {THRESHOLD}
"""

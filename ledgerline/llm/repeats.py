"""Removal of byte strings that occur more than once, by sharded suffix sorting (operator 5).

Every text is its UTF-8 bytes.  A byte goes when some ``length``-byte string that
covers it also starts anywhere else, in the same text or another; strings are
judged on the input, so all occurrences go.

Dealing out.  A window of ``length`` bytes is named by the least hash of the
``PROBE``-byte strings in it, so equal windows have equal names wherever they
stand.  Consecutive windows of one name form a piece (a window's name changes
about every 85 bytes).  Names that occur once in the corpus cannot hold a
repeated window and are dropped (unless the piece may repeat inside itself).  Equal pieces of a name collapse to one with a
count before any text moves, and so do the pieces of equal rows.  A name with one distinct piece that has copies is
settled: the whole piece repeats, and no other piece can share a window with it.
The remaining distinct pieces are dealt to shards
of about ``shard_bytes`` by name, so that all windows that could be equal meet in
one shard, and every shard runs the interval expansion of
:mod:`ledgerline.llm.bwt`.  What it finds returns to all copies of a piece by a join.
Names and pieces of more than a thousandth of all rows, fewer than two thousand, are joined by broadcast, so their
rows are not gathered.

Hot names.  A name whose distinct pieces exceed ``hot_bytes`` (a common line
followed by ever different text) is named again by the pair of least hashes in
the window's halves, and if it is still hot, by the hash of the whole window,
whose pieces are a single string.  So no shard gathers an unbounded group,
and no window is dropped.

Defined results: null text counts as empty; texts shorter than ``length`` lose
nothing; rows repeated with the same id and text are copies of each other like
any other rows; a null id is kept; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.bwt import repeated_starts
from ledgerline.llm.common import written

LENGTH = 200
PROBE = 32
SHARD_BYTES = 2 << 20
HOT_BYTES = 4 << 20
PIECE_WINDOWS = 1024
SEGMENT = 1 << 20
LEVELS = 3
_MIX = 0x9E3779B97F4A7C15


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def rolling(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of every ``length``-byte string, by doubling."""
    power, span, out, done = _MIX, 1, None, 0
    h = data.astype(np.uint64) + np.uint64(1)
    total = len(data) - length + 1
    left = length
    while left:
        if left & 1:  # append the next `span` bytes
            part = h[done:done + total]
            out = part.copy() if out is None else out * np.uint64(power) + part
            done += span
        left >>= 1
        if left:
            h = h[:-span] * np.uint64(power) + h[span:]
            power, span = power * power & 0xFFFFFFFFFFFFFFFF, 2 * span
    return _mixed(out)


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    total, span = len(values) - width + 1, 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[:total], values[width - span:width - span + total])


def names(data: np.ndarray, level: int, length: int = LENGTH, probe: int = PROBE) -> tuple[np.ndarray, np.ndarray]:
    """Name of the window at every place, and the probe hashes."""
    probe = min(probe, max(1, length // 4))
    probes = rolling(data, probe)
    if level >= LEVELS:
        return rolling(data, length), probes
    if level == 1:
        return least(probes, length - probe + 1), probes
    half = length // 2
    lows = least(probes, half - probe + 1)
    total = len(data) - length + 1
    return _mixed(lows[:total] * np.uint64(_MIX) + lows[length - half:length - half + total]), probes


def pieces(data: bytes, first: int, last: int, level: int, length: int = LENGTH,
           probe: int = PROBE) -> Iterator[tuple[int, int, int, int, int]]:
    """``(name, piece hash, start, windows, weight)`` over the windows that start in ``first .. last - 1``.

    The weight is 2 where two windows inside the piece may be equal, else 1.
    Equal windows hold their least probe at the same place in each, so the
    piece holds that probe twice; only the first level looks for it.
    """
    import xxhash

    for at in range(first, last, SEGMENT):
        stop = min(last, at + SEGMENT)
        part = data[at:stop + length - 1]
        name, probes = names(np.frombuffer(part, np.uint8), level, length, probe)
        spare = len(probes) - len(name)
        edges = np.flatnonzero(name[1:] != name[:-1]) + 1
        lows, highs = np.concatenate(([0], edges)).tolist(), np.concatenate((edges, [len(name)])).tolist()
        signed = name.view(np.int64)
        for low, high in zip(lows, highs):
            for s in range(low, high, PIECE_WINDOWS):
                n = min(high - s, PIECE_WINDOWS)
                twice = n > 1 and (level > 1 or np.count_nonzero(probes[s:s + n + spare] == name[s]) > 1)
                yield (int(signed[s]), xxhash.xxh64_intdigest(part[s:s + n + length - 1]) - (1 << 63), at + s, n,
                       2 if twice else 1)


def _bytes(text) -> bytes:
    return (text.as_py() or "").encode("utf-8", "surrogatepass")


_PIECES = "doc_id {id}, t long, name long, piece long, start long, n long, weight long"


def _arrow(columns: dict) -> pa.RecordBatch:
    return pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns.values()],
                           names=list(columns))


def _cutter(level: int, length: int, probe: int):
    """Pieces of whole texts (first level) or of the windows listed in ``spans``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, out = [], []
            for i in range(b.num_rows):
                data = _bytes(b.column(2)[i])
                spans = [(0, len(data) - length + 1)] if level == 1 else \
                    [(s["start"], s["n"]) for s in b.column(3)[i].as_py()]
                for start, n in spans:
                    for p in pieces(data, start, start + n, level, length, probe):
                        rows.append(i)
                        out.append(p)
            columns = list(zip(*out)) or [()] * 5
            at = pa.array(rows, pa.int64())
            yield _arrow({"doc_id": b.column(0).take(at), "t": b.column(1).take(at), "name": columns[0],
                          "piece": columns[1], "start": columns[2], "n": columns[3], "weight": columns[4]})

    return run


def _fetch(length: int):
    """Bytes of the pieces listed in ``spans``; of equal rows, which meet in one task, the first gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = set()
        for b in batches:
            out = []
            for i in range(b.num_rows):
                key = (b.column(0)[i].as_py(), b.column(1)[i].as_py())
                if key in given:
                    continue
                given.add(key)
                data = _bytes(b.column(2)[i])
                out += [(s["name"], s["piece"], s["copies"], data[s["start"]:s["start"] + s["n"] + length - 1])
                        for s in b.column(3)[i].as_py()]
            name, piece, copies, text = list(zip(*out)) or [()] * 4
            yield _arrow({"name": name, "piece": piece, "copies": copies, "bytes": pa.array(text, pa.binary())})

    return run


def _expander(length: int):
    """A task's work: one shard's interval expansion; covered byte ranges of every piece."""

    def run(table):
        rows = {(n, p): (c, t) for n, p, c, t in zip(*(table.column(k).to_pylist() for k in ("name", "piece", "copies", "bytes")))}
        starts = repeated_starts([t for _, t in rows.values()], length)
        out = []
        for (name, piece), (copies, text), at in zip(rows, rows.values(), starts):
            if copies > 1:
                out.append((name, piece, 0, len(text)))
            elif len(at):
                edges = np.flatnonzero(np.diff(at) > 1)
                lows, highs = at[np.concatenate(([0], edges + 1))], at[np.concatenate((edges, [len(at) - 1]))]
                out += [(name, piece, int(a), int(z) + length) for a, z in zip(lows, highs)]
        columns = list(zip(*out)) or [()] * 4
        return pa.table({k: pa.array(c, pa.int64()) for k, c in zip(("name", "piece", "low", "high"), columns)})

    return run


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed bytes, removed runs and the hash of what is left, from the covered ranges in ``spans``."""
    for b in batches:
        out = []
        for i in range(b.num_rows):
            data = _bytes(b.column(2)[i])
            runs: list[list[int]] = []
            for low, high in sorted((s["low"], s["high"]) for s in b.column(3)[i].as_py() or ()):
                if runs and low <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], high)
                else:
                    runs.append([low, high])
            kept, at = hashlib.sha256(), 0
            for low, high in runs:
                kept.update(data[at:low])
                at = high
            kept.update(data[at:])
            out.append((len(data), sum(z - a for a, z in runs), len(runs), kept.hexdigest(), runs))
        size, gone, n, digest, runs = list(zip(*out)) or [()] * 5
        spans = pa.array([[{"low": a, "high": z} for a, z in r] for r in runs],
                         pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())])))
        yield _arrow({"doc_id": b.column(0), "n_bytes": size, "n_removed": gone, "n_spans": n,
                      "kept_sha256": pa.array(digest, pa.string()), "removed": spans})


def _with_lists(docs: DataFrame, spans: DataFrame, how: str = "inner") -> DataFrame:
    """``doc_id, t, text, spans``: the rows of ``docs`` with the list of ``span`` of their (doc_id, t)."""
    lists = spans.groupBy("doc_id", "t").agg(F.collect_list("span").alias("spans"))
    same = F.expr("d.doc_id <=> s.doc_id and d.t = s.t")
    return docs.alias("d").join(lists.alias("s").hint("shuffle_hash"), same, how).select("d.doc_id", "d.t", "d.text", "spans")


def shared_pieces(docs: DataFrame, length: int = LENGTH, probe: int = PROBE,
                  hot_bytes: int = HOT_BYTES) -> tuple[DataFrame, DataFrame]:
    """Occurrences ``doc_id, t, name, piece, start, n`` of pieces whose name occurs again, and the distinct pieces."""
    schema = _PIECES.format(id=docs.schema["doc_id"].dataType.simpleString())
    long_enough = docs.where(F.octet_length("text") >= length)
    source = long_enough.withColumn("spans", F.lit(None).cast("array<struct<start:long,n:long>>"))
    found, distinct = [], []
    for level in range(1, LEVELS + 1):
        # the cutter's rows are read three times; the texts are cut once
        rows = written(source.mapInArrow(_cutter(level, length, probe), schema), f"repeats-cut-{level}")
        names = written(rows.groupBy("name").agg(F.sum("weight").alias("c")).where("c > 1"), f"repeats-names-{level}")
        spots = _met(rows, names, ["name"], F.col("c") > _limit(rows), "left_semi")
        # equal rows have equal pieces: one spot with a count, so that no list grows with their number
        spots = written(spots.groupBy("doc_id", "t", "name", "piece", "start", "n").agg(F.count(F.lit(1)).alias("c")), f"repeats-spots-{level}")
        one = written(spots.groupBy("name", "piece", "n").agg(
            F.sum("c").alias("copies"), F.min(F.struct("doc_id", "t", "start")).alias("at")), f"repeats-pieces-{level}")
        sizes = one.groupBy("name").agg(F.sum(F.col("n") + (length - 1)).alias("b"))
        hot = written(sizes.where(F.col("b") > hot_bytes).select("name"), f"repeats-hot-{level}")
        if level == LEVELS or hot.isEmpty():
            found.append(spots)
            distinct.append(one)
            break
        found.append(spots.join(hot, "name", "left_anti"))
        distinct.append(one.join(hot, "name", "left_anti"))
        crowded = spots.join(hot, "name", "left_semi").select("doc_id", "t", F.struct("start", "n").alias("span"))
        source = _with_lists(long_enough, crowded)
    for f, d in zip(found[1:], distinct[1:]):
        found[0], distinct[0] = found[0].unionByName(f), distinct[0].unionByName(d)
    return found[0], distinct[0]


def _limit(rows: DataFrame) -> int:
    """A count that fewer than two thousand keys of ``rows`` exceed (a row weighs two at most)."""
    return max(1000, rows.count() // 1000)


def _met(rows: DataFrame, side: DataFrame, keys: list[str], hot, how: str) -> DataFrame:
    """``rows`` joined to ``side``; rows of the keys that ``hot`` marks on ``side`` (see ``_limit``) stay where they are."""
    few = side.where(hot)
    crowd = F.broadcast(few.select(*keys).distinct())
    rest = rows.join(crowd, keys, "left_anti")
    return rows.join(F.broadcast(few), keys, how).unionByName(rest.join(side.where(~hot).hint("merge"), keys, how))


def remove_repeats(docs: DataFrame, length: int = LENGTH, probe: int = PROBE, shard_bytes: int = SHARD_BYTES,
                   hot_bytes: int = HOT_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed`` (byte ranges)."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))
    spots, distinct = shared_pieces(docs, length, probe, hot_bytes)
    # a name with one distinct piece, of which there are copies: nothing else can share a window with it, all of it goes
    alone = distinct.groupBy("name").agg(F.count(F.lit(1)).alias("k"), F.min(F.struct("piece", "n", "copies")).alias("p")) \
        .where("k = 1 and p.copies > 1").select("name", "p.*")
    rest = written(distinct.join(alone.select("name"), "name", "left_anti"), "repeats-compared")
    size = rest.agg(F.sum(F.col("n") + (length - 1))).first()[0] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    wanted = rest.select("at.doc_id", "at.t", F.struct(F.col("at.start").alias("start"), "n", "name", "piece", "copies").alias("span"))
    texts = _with_lists(docs, wanted).mapInArrow(_fetch(length), "name long, piece long, copies long, bytes binary")
    covered = texts.withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(shards))).groupBy("shard") \
        .applyInArrow(_expander(length), "name long, piece long, low long, high long")
    whole = alone.select("name", "piece", F.lit(0).cast("long").alias("low"), (F.col("n") + (length - 1)).alias("high"))
    many = distinct.select("name", "piece", "copies")
    covered = written(covered.unionByName(whole).join(many, ["name", "piece"]), "repeats-covered")
    ranges = _met(spots, covered, ["name", "piece"], F.col("copies") > _limit(spots), "inner").select("doc_id", "t", F.struct(
        (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high")).alias("span"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _with_lists(docs, ranges, "left").mapInArrow(
        _digest, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                 "removed array<struct<low:long,high:long>>")


def query(spark, sf_dir: str) -> DataFrame:
    """op5: every document's size, removed bytes and runs, and the hash of what is left."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("removed")

"""Best-fit packing planned on the length histogram (operator 3).

1. Every document becomes its token ids and a closing id 0.  Longer ones than a
   sequence are cut into full pieces; the first piece takes the remainder.
2. The histogram of piece lengths (at most ``capacity`` numbers) is all that the
   driver sees.  Best fit, longest first, runs on its counts: a step places as
   many equal pieces as there are sequences with the tightest sufficient room.
   The plan is a list of runs: pieces of one length, consecutive in rank, each
   in the next of consecutive sequences, all at the same place.  The number of
   runs depends on the distinct lengths, not on the documents.
3. Each piece takes a rank within its length: lengths are salted into shards of
   bounded expected size, ranked inside a shard and shifted by the shard's
   offset.  The rank is joined to the run that covers it.

Texts are never shuffled; the shuffled rows are a few numbers a piece.  The text of the vocabulary's special
token inside a document is that token's one id, as in the tokenizers library.

Defined results: null text counts as empty, and an empty document is the single
id 0; repeated rows are packed as often as they occur; a null id is kept; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import tokens
from ledgerline.llm.common import written

CAPACITY = 2048
SHARD_ROWS = 20_000
ROW = "_row"
PIECE = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document of ``n`` ids."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds the token ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokens.load(vocabulary)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            at, nth, start, length, crc, ids = [], [], [], [], [], []
            for row in range(batch.num_rows):
                raw = words.encode(texts[row].as_py() or "") + b"\0\0\0\0"
                for k, (s, n) in enumerate(cut(len(raw) // 4, capacity)):
                    part = raw[4 * s:4 * (s + n)]
                    at.append(row), nth.append(k), start.append(s), length.append(n), crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [doc_ids.take(pa.array(at, pa.int64())), pa.array(nth, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.record_batch(columns, names=names)

    cols = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = PIECE.format(id=cols.schema[0].dataType.simpleString()) + (", ids array<int>" if with_ids else "")
    return cols.mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best fit over counts: runs ``(length, first rank, pieces, first sequence, offset)``."""
    room: dict[int, list[tuple[int, int]]] = {}  # free ids -> runs of sequences (first, how many)
    rooms: list[int] = []  # its keys, ascending
    runs: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def free(size: int, first: int, many: int) -> None:
        if size and many:
            if size not in room:
                room[size] = []
                bisect.insort(rooms, size)
            room[size].append((first, many))

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} ids does not fit a sequence of {capacity}")
        rank, left = 0, counts[length]
        while left and (k := bisect.bisect_left(rooms, length)) < len(rooms):
            size = rooms[k]
            first, many = room[size].pop()
            if not room[size]:
                del room[size], rooms[k]
            used = min(left, many)
            runs.append((length, rank, used, first, capacity - size))
            free(size, first + used, many - used)
            free(size - length, first, used)
            rank, left = rank + used, left - used
        if left:
            each = capacity // length
            full, rest = divmod(left, each)
            for j in range(each if full else 0):
                runs.append((length, rank, full, opened, j * length))
                rank += full
            free(capacity - each * length, opened, full)
            opened += full
            for j in range(rest):
                runs.append((length, rank, 1, opened, j * length))
                rank += 1
            if rest:
                free(capacity - rest * length, opened, 1)
                opened += 1
    return runs


def ranked(parts: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """``parts`` with ``rank`` (from 0) within their length, and the histogram of lengths."""
    histogram = {r[0]: r[1] for r in parts.groupBy("length").agg(F.count(F.lit(1))).collect()}
    shards = max(1, math.ceil(sum(histogram.values()) / shard_rows))
    x = parts.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", ROW), F.lit(shards)))
    sizes = x.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.selectExpr("length as l", "shard as s",
                              "sum(n) over (partition by length order by shard) - n as before")
    x = x.selectExpr("*", "row_number() over (partition by length, shard order by doc_id, piece, start, ids_crc32, " + ROW + ") - 1 as own")
    x = x.join(before, (x["length"] == before["l"]) & (x["shard"] == before["s"]))
    return x.withColumn("rank", F.col("own") + F.col("before")).drop("shard", "own", "before", "l", "s"), histogram


def numbered(parts: DataFrame) -> DataFrame:
    """``parts`` written with a number per row, which tells equal rows apart wherever they are read again."""
    return written(parts.withColumn(ROW, F.monotonically_increasing_id()), "packing-pieces")


def place(parts: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``parts`` (``numbered``, with ``doc_id, piece, start, length, ids_crc32``) with ``sequence_id`` and ``offset``."""
    spark = parts.sparkSession
    x, histogram = ranked(parts, shard_rows)
    runs = spark.createDataFrame(plan(histogram, capacity),
                                 "l long, first_rank long, many long, first_sequence long, offset long")
    x = x.join(F.broadcast(runs), F.expr("length = l and rank >= first_rank and rank < first_rank + many"))
    return x.withColumn("sequence_id", F.expr("first_sequence + rank - first_rank")) \
        .drop("l", "first_rank", "many", "first_sequence", "rank") \
        .select(*[c for c in parts.columns if c != ROW], "sequence_id", "offset")


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of every document with their sequence and place."""
    return place(numbered(pieces(docs, capacity, vocabulary, id_col, text_col, with_ids)), capacity)


def query(spark, sf_dir: str) -> DataFrame:
    """op3: every document packed into sequences of 2048 ids."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""SimHash near-duplicates through deletion-variant signatures (operator 10).

A document's fingerprint is the bitwise majority of the 64-bit hashes of its
word shingles.  Fingerprints at most ``2`` bits apart are linked, and a
component is everything reachable over links.

Search.  The 64 bits are cut into two segments.  Of at most two differing bits,
one segment holds at most one, so that segment agrees exactly or agrees once
one bit is deleted.  Every distinct fingerprint is indexed under its 2 segment
values and under its 64 segment values with one bit deleted; equal index keys
give candidate pairs, and the bit distance of the whole fingerprints decides.
Deleted-bit keys join only a 0 to a 1 in the deleted place: pairs that agree
there meet under the exact segment value.

Hot keys.  Copies collapse first: the index holds distinct fingerprints.  A key
held by more than ``pair_limit`` fingerprints emits no pairs.  Its fingerprints
are indexed again by the whole fingerprint with one or two bits deleted, where
equal keys prove the distance and hold at most 4 fingerprints; every link of a
hot key is found there, and the work stays in proportion to the fingerprints.

Defined results: null text counts as empty; a text without words has
fingerprint 0 and is linked like any other; repeated rows are copies of each
other; a null id takes part but cannot be the smallest id unless the
component has no other (then the component id is null).  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import components, packed, row_key, unpacked, written

SEGMENT = 32
BLOCK = 1 << 15


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of one text, as an unsigned integer."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    h64 = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, BLOCK):
        part = words[start:min(n, start + BLOCK) + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        h = np.array([h64(g, seed) for g in grams], dtype="<u8")
        ones += _bit_sums(h)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _bit_sums(h: np.ndarray) -> np.ndarray:
    """How many of the values have each bit, lowest bit first."""
    out = np.zeros(64, np.int64)
    lanes = np.uint64(0x0101010101010101)
    for start in range(0, len(h), 255):
        block = h[start:start + 255]
        for k in range(8):  # eight byte-wide counters at once: bits k, k + 8, ...
            total = int(np.add.reduce((block >> np.uint64(k)) & lanes))
            out[k::8] += np.frombuffer(total.to_bytes(8, "little"), np.uint8)
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (fp as a signed long with the same 64 bits) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle, seed) for t in b.column(1)], dtype=np.uint64)
            yield pa.record_batch([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    cols = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return cols.mapInArrow(run, f"doc_id {cols.schema[0].dataType.simpleString()}, fp long")


def index_keys(fps: DataFrame) -> DataFrame:
    """``fp, key, bit`` for the 2 exact and 64 one-deletion signatures of each fingerprint.

    The key holds the signature's number above bit 32 and its value below.
    Numbers 0..63 delete that bit and keep the rest of its segment; 64 and 65
    are the whole segments.  ``bit`` is the deleted bit (null for exact ones).
    """
    x = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(65))).alias("slot"))
    seg = F.expr(f"case when slot < 64 then slot div {SEGMENT} else slot - 64 end")
    x = x.withColumn("seg", seg)
    x = x.withColumn("value", F.expr(f"shiftrightunsigned(fp, cast({SEGMENT} * seg as int)) & 4294967295L"))
    x = x.withColumn("bit", F.expr(f"case when slot < 64 then shiftright(value, slot % {SEGMENT}) & 1L end"))
    rest = F.expr(f"case when slot < 64 then value - bit * shiftleft(1L, slot % {SEGMENT}) else value end")
    return x.select("fp", (F.shiftleft(F.col("slot").cast("long"), 32) + rest).alias("key"), "bit")


def links(fps: DataFrame, max_bits: int = 2, pair_limit: int = 64) -> DataFrame:
    """Pairs ``a, b`` whose closure joins every two fingerprints at most ``max_bits`` apart.

    Every pair is verified.  Under keys that are not hot all links are returned;
    under hot keys those to the least fingerprint of each equal deletion variant,
    which joins the same fingerprints.
    """
    if max_bits != 2:
        raise ValueError("two segments with one deleted bit find distances of at most 2 bits")
    counts = written(index_keys(fps).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-shared")
    shared = written(index_keys(fps).join(counts.hint("merge"), "key"), "simhash-near")
    near = shared.where(f"n <= {pair_limit}")
    a, b = near.alias("a"), near.alias("b")
    order = F.expr("(a.bit = 0 and b.bit = 1) or (a.bit is null and b.bit is null and a.fp < b.fp)")
    close = F.expr(f"bit_count(a.fp ^ b.fp) <= {max_bits}")
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & order & close).select(
        F.least("a.fp", "b.fp").alias("a"), F.greatest("a.fp", "b.fp").alias("b"))
    # hot keys: whole fingerprints with two bits deleted; equal variants differ in those bits only
    crowd = shared.where(f"n > {pair_limit}").select("fp").distinct()
    masks = F.expr("flatten(transform(sequence(0, 62), i -> "
                   "transform(sequence(i + 1, 63), j -> shiftleft(1L, i) | shiftleft(1L, j))))")
    variants = crowd.select("fp", F.explode(masks).alias("mask")).select("fp", "mask", F.expr("fp & ~mask").alias("rest"))
    stars = variants.groupBy("mask", "rest").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("near")) \
        .where("size(near) > 1").select("a", F.explode("near").alias("b")).where("a <> b")
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42, pair_limit: int = 64,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, root, component_id``: one row per input row.

    ``component_id`` is the smallest reachable id, ``root`` the component's smallest fingerprint.
    """
    fp = written(fingerprints(docs, shingle, seed, id_col, text_col), "simhash-fp")
    classes = written(fp.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    comp = components(links(classes.select("fp"), max_bits, pair_limit), "simhash-components")
    rooted = classes.join(comp, classes.fp == comp.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "root", "component_id")
    return fp.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """One row of every component: the smallest id, then the smallest row key; all columns pass unchanged.

    Null ids are chosen only where the component has no other.  Of rows with
    the chosen id and text, one stays.
    """
    rows = packed(docs).withColumn("key", F.struct("doc_id", F.xxhash64(F.col("doc_id"), F.col("row.text")).alias("k")))
    found = near_duplicates(docs.select(F.struct("doc_id", row_key().alias("k")).alias("key"), "text"),
                            id_col="key", **params)
    order = F.struct(F.col("doc_id.doc_id").isNull(), F.col("doc_id.doc_id"), F.col("doc_id.k"))
    kept = found.groupBy("root").agg(F.min_by("doc_id", order).alias("pick"), F.min(order).alias("first"))
    counts = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    kept = written(kept.join(counts, F.expr("pick <=> doc_id")).select("pick", "n"), "simhash-kept").alias("k")
    same = F.expr("d.key.doc_id <=> k.pick.doc_id and d.key.k = k.pick.k")
    once = rows.alias("d").join(kept.where("n = 1").hint("shuffle_hash"), same, "left_semi").select(*unpacked(docs.columns))
    repeated = kept.where("n > 1").select("pick").alias("k")
    if repeated.isEmpty():
        return once
    again = rows.alias("d").join(repeated, same, "left_semi").groupBy("key").agg(
        F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")).select(*unpacked(docs.columns))
    return once.unionAll(again)


def query(spark, sf_dir: str) -> DataFrame:
    """op10: every document's fingerprint and component."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

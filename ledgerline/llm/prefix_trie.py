"""Prefix trie of conversations by collapse of whole sequences (operator 11).

1. ``ordered`` gives every turn its place in the order of (conversation, turn),
   by range partitions on the whole sort key, so a conversation of any length covers
   as many partitions as it needs.  A *block* is what one partition holds of a
   conversation; texts stay behind, a turn goes on as a 128-bit digest and its words.
2. ``keyed`` names the first d turns of a conversation by the sum of the hashes of
   (place, turn): running sums inside blocks, shifted by the sums of earlier blocks.
   All but one block of a conversation begin a partition, so there are fewer
   shifts than partitions, and they are broadcast.
3. Conversations equal as a whole collapse to one weighted sequence, named by
   its smallest id; the ids themselves are the end list of the node where it ends.
4. A sequence whose key is a proper prefix of another conversation is taken out
   by an anti-join; the others are the leaves.
5. The prefixes of the distinct sequences, with their weights, are grouped by key: a
   group is a node.  A sum over the nodes below a node needs each of them once.  A node is
   owned by the sequence of the smallest id through it; what a sequence owns is
   its part from some depth on, and sums of these parts are sums over subtrees.

Hot keys (the root, a common first turn, a copy of which there are many) are
only grouped, with partial sums first, or meet a side of one row a partition.
Parents of more than a thousandth of all nodes, fewer than two thousand, are joined
by broadcast, all others by their key.

Defined results: turns of equal order are ordered by role and text; null turn is
first; null role and text are empty; a null conversation id names no conversation,
its rows take no part; equal rows are turns of their own; a conversation may be
empty (the root counts it); an empty table gives no nodes; long texts leave the
first step as a digest; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
SHARED = 20  # the query's rebuilt conversations begin with turns of the conversation at the last multiple of this
WIDE = 1000
_PARTS = ["k1", "k2", "k3", "k4", "cw"]
NODE = ["depth", "ka", "kb"]


def ordered(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """``conv_id, block, place, words, ha, hb``: ``place`` ascends in the order of the turns, ``block`` is its partition."""
    x = turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # equal rows differ by their place in the files, so a third of all rows may be equal and still be spread
    x = x.where("conv_id is not null").withColumn("salt", F.monotonically_increasing_id())
    key = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), F.asc("salt")]
    n = max(2, int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    x = x.repartitionByRange(n, *key).sortWithinPartitions(*key)
    return written(x.select("conv_id", F.monotonically_increasing_id().alias("place"),
                            F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
                            F.xxhash64("role", "text").alias("ha"), F.xxhash64("text", F.lit(1), "role").alias("hb"))
                   .withColumn("block", F.shiftright("place", 33)), "trie-turns")


def blocks(turns: DataFrame) -> DataFrame:
    """``conv_id, block, low, before, total, first``: the first place of every block, and turns before it and in all."""
    own = Window.partitionBy("conv_id")
    spans = turns.groupBy("conv_id", "block").agg(F.min("place").alias("low"), F.count(F.lit(1)).alias("n"))
    return spans.select("conv_id", "block", "low", (F.sum("n").over(own.orderBy("block")) - F.col("n")).alias("before"),
                        F.sum("n").over(own).alias("total"), F.min("block").over(own).alias("first"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The query's conversations: the first turns of a shared one, then a conversation's own.

    Returns ``conv_id, block, depth, words, ha, hb`` and all conversations ``conv_id, block, length`` (``block`` is its first).
    """
    spans = blocks(turns)
    base = spans.where("block = first").select(F.col("conv_id").alias("base"), F.col("total").alias("held"))
    spans = spans.withColumn("base", F.expr(f"conv_id - conv_id % {SHARED}")) \
        .withColumn("h", F.expr("cast(crc32(cast(conv_id as string)) % 4 as int)")) \
        .join(base, "base", "left").withColumn("taken", F.expr("least(h, coalesce(held, 0))"))
    spans = written(spans.withColumn("length", F.expr("taken + greatest(total - h, 0)")), "trie-blocks")
    placed = turns.join(spans, ["conv_id", "block"]).withColumn("at", F.expr("place - low + before"))
    own = placed.where("at >= h").select("conv_id", "block", F.expr("at - h + taken + 1").alias("depth"), "words", "ha", "hb")
    heads = placed.where("at < 3").select(F.col("conv_id").alias("base"), "at", "words", "ha", "hb")
    convs = spans.where("block = first")
    shared = convs.select("conv_id", "block", "h", "base").join(heads, "base").where("at < h") \
        .select("conv_id", "block", F.expr("at + 1").alias("depth"), "words", "ha", "hb")
    return own.unionByName(shared), convs.select("conv_id", "block", "length")


def keyed(turns: DataFrame) -> DataFrame:
    """``conv_id, block, depth, words, cw, ka, kb, pa, pb``: words and key of the first ``depth`` turns, and the key of one less."""
    a, b = F.xxhash64("depth", "ha", "hb"), F.xxhash64(F.lit(7), "hb", "depth", "ha")
    x = turns.select("conv_id", "block", "depth", "words", F.shiftrightunsigned(a, 32).alias("k1"), a.bitwiseAND(0xFFFFFFFF).alias("k2"),
                     F.shiftrightunsigned(b, 32).alias("k3"), b.bitwiseAND(0xFFFFFFFF).alias("k4"), F.col("words").alias("cw"))
    # sums of what lies in earlier blocks: only conversations of several blocks, fewer than there are partitions
    several = x.groupBy("conv_id").agg(F.min("block").alias("a"), F.max("block").alias("z")).where("a < z").select("conv_id")
    sums = x.join(F.broadcast(several), "conv_id", "left_semi").groupBy("conv_id", "block").agg(*[F.sum(c).alias(c) for c in _PARTS])
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = sums.select("conv_id", "block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"s_{c}") for c in _PARTS])
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    x = x.select("conv_id", "block", "depth", "words", *_PARTS[:4], *[F.sum(c).over(inside).alias(f"r_{c}") for c in _PARTS])
    x = x.join(F.broadcast(shift), ["conv_id", "block"], "left")
    now = [F.col(f"r_{c}") + F.coalesce(f"s_{c}", F.lit(0)) for c in _PARTS]
    was = [t - F.col(c) for t, c in zip(now, _PARTS[:4])]
    first, key = F.col("depth") == 1, lambda t: (F.xxhash64(*t), F.xxhash64(F.lit(3), *reversed(t)))  # noqa: E731
    (ka, kb), (pa, pb) = key(now[:4]), key(was)
    return x.select("conv_id", "block", "depth", "words", now[4].alias("cw"), ka.alias("ka"), kb.alias("kb"),
                    F.when(first, 0).otherwise(pa).alias("pa"), F.when(first, 0).otherwise(pb).alias("pb"))


def prefix_trie(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and end lists of the trie of all conversations.

    ``turns`` has ``conv_id, block, depth`` (from 1, without gaps) ``, words, ha, hb`` (a digest of the turn), where
    ``block`` ascends with ``depth`` and a block is what one task may hold; ``convs`` has ``conv_id, block`` (its first)
    ``, length`` of every conversation, the empty ones too.

    Nodes: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_words, ka, kb``, where ``saved_words``
    sums (conversations - 1) x (words of the last turn) over a subtree.  Ends: ``depth, ka, kb, conv_id``, one row for every
    conversation, at the node where it ends.
    """
    # the last turn of a conversation lies in its last block; a join by conversation alone would meet all its turns
    tops = turns.groupBy("conv_id", "block").agg(F.max("depth").alias("top"))
    ends_at = tops.join(convs.select("conv_id", "length"), "conv_id").where("top = length") \
        .select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "length")
    x = keyed(turns).join(ends_at, F.expr("conv_id = c and block = b"), "left").withColumn("last", F.expr("depth <=> length"))
    x = written(x.drop("c", "b", "length"), "trie-prefixes")
    at_root = [F.lit(0).cast("long").alias(c) for c in NODE]
    ends = written(x.where("last").select("conv_id", *NODE, "cw")
                   .unionByName(convs.where("length = 0").select("conv_id", *at_root, F.lit(0).cast("long").alias("cw"))), "trie-ends")

    # whole sequences, and those that no other one extends
    whole = ends.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.min("cw").alias("all_words"))
    proper = x.where("not last").select(*NODE).unionByName(x.where("depth = 1").select(*at_root)).distinct()
    leaves = whole.join(proper, NODE, "left_anti").select(*NODE, F.lit(1).alias("leaf"))
    whole = written(whole.join(leaves, NODE, "left").select("conv_id", "weight", "all_words", F.coalesce("leaf", F.lit(0)).alias("leaf")),
                    "trie-sequences")

    # the prefixes of the distinct sequences, met block by block; the root has a row of its own for each
    kept = whole.join(x.select("conv_id", "block").distinct(), "conv_id")
    rows = x.join(kept, ["conv_id", "block"]).select("conv_id", "block", *NODE, "pa", "pb", "weight", "leaf",
                                                     F.expr("all_words - cw + words").alias("rest"))
    root = whole.select("conv_id", F.lit(-1).cast("long").alias("block"), *at_root, F.lit(0).cast("long").alias("pa"),
                        F.lit(0).cast("long").alias("pb"), "weight", "leaf", F.col("all_words").alias("rest"))
    rows = written(rows.unionByName(root), "trie-rows")
    nodes = rows.groupBy(*NODE).agg(
        F.min(F.struct("conv_id", "rest", "pa", "pb")).alias("owner"), F.sum("weight").alias("n_convs"),
        F.sum("leaf").alias("n_leaves"), F.sum(F.col("weight") * F.col("rest")).alias("all_rest"))
    nodes = written(nodes.select("owner.*", *NODE, "n_convs", "n_leaves", "all_rest"), "trie-nodes")

    # what a sequence owns begins at a depth and goes on to its end; above that depth all of it counts
    owned = written(nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "rest", "pa", "pb")).alias("own"))
                    .select("conv_id", F.col("own.depth").alias("own_depth"), F.col("own.rest").alias("own_rest"), "own.pa", "own.pb"), "trie-owned")
    by_block = rows.select("conv_id", "block").distinct().join(owned.select("conv_id", "own_depth", "own_rest"), "conv_id")
    once = rows.join(by_block, ["conv_id", "block"]).groupBy(*NODE) \
        .agg(F.sum(F.expr("if(depth >= own_depth, rest, own_rest)")).alias("once"))

    # the parent of a node has the same owner, but for the first node that a sequence owns
    children = written(nodes.where("depth > 0").groupBy(F.expr("depth - 1").alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb"))
                       .agg(F.count(F.lit(1)).alias("n_children")), "trie-children")
    named = nodes.select(*NODE, F.col("conv_id").alias("parent"))
    firsts = owned.where("own_depth > 0").select("conv_id", F.expr("own_depth - 1").alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb"))
    limit = max(1, nodes.count() // WIDE)  # fewer than 2 * WIDE parents have more children
    wide = named.join(children.where(F.col("n_children") > limit), NODE).drop("n_children")
    parents = firsts.join(F.broadcast(wide), NODE).unionByName(
        firsts.join(F.broadcast(wide.drop("parent")), NODE, "left_anti").join(named.hint("merge"), NODE))
    parents = parents.select("conv_id", F.expr("depth + 1").alias("depth"), "parent")
    out = nodes.join(once, NODE).join(children, NODE, "left").join(parents, ["conv_id", "depth"], "left")
    return out.select("conv_id", "depth", F.expr("if(depth = 0, null, coalesce(parent, conv_id))").alias("parent_conv_id"), "n_convs",
                      F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
                      F.expr("all_rest - once").alias("saved_words"), "ka", "kb"), ends.drop("cw")


def end_hashes(ends: DataFrame) -> DataFrame:
    """``depth, ka, kb, ends_sha256``: SHA-256 of a node's ids in ascending order, joined by commas.

    The ids of a node pass one task in order (the hash is sequential) and are never held together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []
        for b in batches:
            for *key, conv in zip(*(c.to_pylist() for c in b.columns)):
                if key != node:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(str(conv).encode())
                else:
                    state.update(f",{conv}".encode())
            yield _batch(out)
            out = []
        if node:
            yield _batch([(*node, state.hexdigest())])

    x = ends.select(*NODE, "conv_id").repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")
    return x.mapInArrow(run, "depth long, ka long, kb long, ends_sha256 string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    return pa.record_batch([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
                           names=["depth", "ka", "kb", "ends_sha256"])


def query(spark, sf_dir: str) -> DataFrame:
    """op11: every node of the trie of the rebuilt conversations."""
    turns, convs = rebuilt(ordered(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    nodes, ends = prefix_trie(turns, convs)
    out = nodes.join(end_hashes(ends), NODE, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved_words").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


#: DuckDB: the same nodes from lists of whole prefixes.  CRC-32 has no function there and is taken bit by bit.
ORACLE = r"""
WITH turns AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc AS (
  SELECT conv_id, own, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END))) % 4 AS h
  FROM turns),
built AS (
  SELECT c.conv_id, coalesce(list_slice(b.own, 1, c.h), []) || list_slice(c.own, c.h + 1, len(c.own)) AS s
  FROM crc c LEFT JOIN turns b ON b.conv_id = c.base),
member AS (SELECT conv_id, d, list_slice(s, 1, d) AS p, d = len(s) AS ends FROM built, unnest(range(0, len(s) + 1)) u(d)),
node AS (
  SELECT d, p, min(conv_id) AS conv_id, count(*) AS n_convs,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(p[d].text, '[^ 	-]+')) END AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM member GROUP BY d, p),
child AS (SELECT d - 1 AS d, list_slice(p, 1, d - 1) AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY 1, 2),
below AS (
  SELECT a AS d, list_slice(n.p, 1, a) AS p, sum(n.saved) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
  FROM node n LEFT JOIN child c ON c.d = n.d AND c.p = n.p, unnest(range(0, n.d + 1)) u(a) GROUP BY 1, 2)
SELECT n.conv_id, n.d AS depth, f.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, b.leaves AS n_leaves,
  b.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM node n JOIN below b ON b.d = n.d AND b.p = n.p LEFT JOIN child c ON c.d = n.d AND c.p = n.p
LEFT JOIN node f ON f.d = n.d - 1 AND f.p = list_slice(n.p, 1, n.d - 1)
"""

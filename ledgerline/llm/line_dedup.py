"""Removal of repeated multi-line chunks with content-defined boundaries (operator 4).

Lines (split at ``\\n``) are hashed; a cyclic rolling hash over the last
``window`` line hashes marks lines.  A chunk ends after a marked line, unless one
of the ``min_lines - 1`` lines before it is marked too or fewer than
``min_lines`` lines would stand before or after it in the text.  So every chunk
has ``min_lines`` lines (a shorter text is no chunk), and whether it ends at a
line depends on ``window + min_lines - 1`` lines alone: text inserted or deleted
elsewhere does not move it.

Chunks whose hash occurs more than once are candidates.  Candidates are compared
byte by byte, as grouping keys, and every occurrence but the first of equal bytes
is removed with its lines.  First is the smallest (doc_id, row hash, place in the
text); null ids come first.  Where a shared passage begins or ends inside a
chunk, the boundary chunk as a whole is not repeated; so a removed chunk is
extended over the lines of the ``REACH`` chunks next to it on either side, as long
as they equal the lines next to its first occurrence.  (Copies of a passage can
disagree on ``window + min_lines - 2`` places at its head and ``min_lines - 1`` at its
end, that is on one boundary; so two chunks hold all lines between the passage's
end and the first boundary in common.)  A removed line always has an equal line
at an earlier place, so one copy of everything stays.

Plan.  Chunk hashes (no text) are counted with partial aggregation; repeated ones
carry a byte for every line next to them, so that a join with the first of
a hash tells how far an occurrence may extend.  Only rows with candidates carry text into
the comparison, which settles chunks and extensions by their bytes; the removal
lists return to the documents by a hash join on the row key.  Everything is
built-in functions.

Defined results: null and empty texts pass unchanged; rows repeated with the
same id and text count as one document and all keep the same lines; ties between
rows of one id go to the smaller row hash; a text that loses every line becomes
empty; a very long text is one array of lines in its row, worked through in
linear time; an empty table gives an empty result; all other columns pass
unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import packed, row_key, unpacked, written

WINDOW = 2
DIVISOR = 3
MIN_LINES = 2
REACH = 2
HASH_BITS = 60


def line_hash(line: Column) -> Column:
    """60-bit hash of a line (leading hex digits of its MD5)."""
    return F.conv(F.substring(F.md5(line), 1, HASH_BITS // 4), 16, 10).cast("long")


def _rotated(c: Column, n: int) -> Column:
    kept = F.lit((1 << HASH_BITS) - 1)
    return c if n == 0 else F.shiftleft(c, n).bitwiseOR(F.shiftright(c, HASH_BITS - n)).bitwiseAND(kept)


def chunk_bounds(hashes: Column, window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES) -> Column:
    """1-based numbers of the last line of every chunk, from an array of line hashes."""

    def marked(i: Column) -> Column:
        rolled = F.element_at(hashes, i)
        for back in range(1, window):
            line = F.when(i > back, F.element_at(hashes, F.greatest(i - back, F.lit(1)))).otherwise(F.lit(0).cast("long"))
            rolled = rolled.bitwiseXOR(_rotated(line, back))
        return rolled % divisor == 0

    def ends(i: Column) -> Column:
        inner = (i >= min_lines) & (i <= F.size(hashes) - min_lines) & marked(i)
        for back in range(1, min_lines):
            inner = inner & ~((i > back) & marked(F.greatest(i - back, F.lit(1))))
        return (i == F.size(hashes)) | inner

    return F.filter(F.sequence(F.lit(1), F.size(hashes)), ends)


def _agreeing(a: str, b: str) -> str:
    """SQL for the number of leading elements in which two arrays without nulls agree."""
    return f"cast(coalesce(nullif(array_position(zip_with({a}, {b}, (x, y) -> x <=> y), false), 0) - 1, size({a})) as int)"


def chunks(docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES) -> DataFrame:
    """``doc_id, k, first, n, hash, before, after`` of every chunk of at least ``min_lines`` lines.

    ``before`` and ``after`` are 7-bit hashes of the lines of the ``REACH`` chunks on either side.  They bound how much
    text an occurrence brings to the comparison; a chance match brings a line more and decides nothing.
    The outer form of ``inline`` keeps the optimizer from inferring a filter on
    its input, which would compute the chunks a second time, once a line.
    """
    x = docs.where("text is not null and text <> ''").select("doc_id", row_key().alias("k"), "text")
    x = x.select("doc_id", "k", F.transform(F.split("text", "\n", -1), line_hash).alias("h"))
    x = x.select("doc_id", "k", "h", chunk_bounds(F.col("h"), window, divisor, min_lines).alias("b"))
    x = x.select("doc_id", "k", "h", F.expr("concat(array(0), b)").alias("b"))
    # four boundaries of a chunk: where the first within reach begins, its own, and where the last within reach ends
    x = x.select("doc_id", "k", "h", F.expr(
        "filter(transform(slice(b, 2, size(b) - 1), (e, i) -> struct("
        f"b[greatest(i - {REACH}, 0)] as p, b[i] as s, e as e, b[least(i + 1 + {REACH}, size(b) - 1)] as q)), c -> c.e - c.s >= {min_lines})").alias("parts"))
    near = "transform(slice(h, {0} + 1, {1} - {0}), v -> cast(v & 127 as tinyint))"
    return x.select("doc_id", "k", F.expr(
        "transform(parts, c -> struct(c.s + 1 as first, c.e - c.s as n, xxhash64(slice(h, c.s + 1, c.e - c.s)) as hash, "
        f"{near.format('c.p', 'c.s')} as before, {near.format('c.e', 'c.q')} as after))")
        .alias("parts")).select("doc_id", "k", F.inline_outer("parts")).where("n is not null")


def repeated_chunks(docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR,
                    min_lines: int = MIN_LINES) -> DataFrame:
    """``doc_id, k, first, n, up, down`` of every chunk to remove, with the lines before and after it that go too.

    ``k`` is the row's key.
    """
    spots = written(chunks(docs, window, divisor, min_lines), "line-chunks")
    shared = spots.groupBy("hash").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("hash")
    spots = written(spots.join(shared, "hash", "left_semi"), "line-shared")
    first = spots.groupBy("hash").agg(F.min(F.struct("doc_id", "k", "first", "before", "after")).alias("head")) \
        .select("hash", F.reverse("head.before").alias("hb"), F.col("head.after").alias("ha"))
    lists = spots.join(first, "hash").select(
        "doc_id", "k", "first", "n", "hash", F.expr(_agreeing("reverse(before)", "hb")).alias("up"),
        F.expr(_agreeing("after", "ha")).alias("down")).groupBy("doc_id", "k") \
        .agg(F.collect_set(F.struct("first", "n", "hash", "up", "down")).alias("parts"))
    texts = docs.where("text is not null and text <> ''").select("doc_id", row_key().alias("k"), "text").alias("t")
    same = F.expr("t.doc_id <=> l.doc_id and t.k = l.k")
    x = texts.join(lists.alias("l").hint("shuffle_hash"), same).select("t.doc_id", "t.k", "text", "parts")
    x = x.select("doc_id", "k", F.split("text", "\n", -1).alias("lines"), "parts")
    # several uses of `lines` in the function keep the optimizer from moving the split into it (once a chunk)
    x = written(x.select("doc_id", "k", F.inline_outer(F.expr(
        "transform(parts, p -> struct(p.first as first, p.n as n, p.hash as hash, "
        "array_join(slice(lines, p.first, p.n), '\n') as bytes, "
        "reverse(slice(lines, p.first - p.up, p.up)) as before, slice(lines, p.first + p.n, p.down) as after))"))),
        "line-candidates")
    heads = x.groupBy("hash", "bytes").agg(F.min(F.struct("doc_id", "k", "first", "before", "after")).alias("head"))
    later = x.join(heads, ["hash", "bytes"]).where("not (struct(doc_id, k, first) <=> struct(head.doc_id, head.k, head.first))")
    return later.select("doc_id", "k", "first", "n", F.expr(_agreeing("before", "head.before")).alias("up"),
                        F.expr(_agreeing("after", "head.after")).alias("down")).distinct()


def dedup_lines(docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES,
                counts: bool = False, length_col: str | None = None) -> DataFrame:
    """``docs`` with repeated chunks cut out of ``text``.

    ``length_col`` names a column to set to the new length of texts that lost lines.  With ``counts``, the columns
    ``chunks_removed`` and ``lines_removed`` (of chunks and extensions) are appended (replacing columns of these names).
    """
    gone = written(repeated_chunks(docs.select("doc_id", "text"), window, divisor, min_lines).groupBy("doc_id", "k")
                   .agg(F.sort_array(F.collect_list(F.struct("first", "n", "up", "down"))).alias("cut")), "line-removals")
    rows = packed(docs).withColumn("k", F.xxhash64(F.col("doc_id"), F.col("row.text"))).alias("d")
    x = rows.join(gone.alias("g").hint("shuffle_hash"), F.expr("d.doc_id <=> g.doc_id and d.k = g.k"), "left") \
        .select("row", "cut")
    x = x.withColumn("lines", F.when(F.col("cut").isNotNull(), F.split("row.text", "\n", -1)))
    # between two cuts stays what none of the cuts within reach covers; an extension never passes REACH more chunks
    x = x.select("row", "cut", F.size("lines").alias("had"), F.expr(
        "flatten(zip_with("
        f"concat(array(1), transform(cut, (c, i) -> array_max(transform(slice(cut, greatest(i + 1 - {REACH}, 1), "
        f"least(i, {REACH}) + 1), d -> d.first + d.n + d.down)))), "
        f"concat(transform(cut, (c, i) -> array_min(transform(slice(cut, i + 1, {REACH} + 1), d -> d.first - d.up))), "
        "array(size(lines) + 1)), "
        "(a, b) -> slice(lines, a, greatest(b - a, 0))))").alias("rest"))
    text = F.when(F.col("cut").isNull(), F.col("row.text")).otherwise(F.array_join("rest", "\n"))
    columns = [c for c in docs.columns if not (counts and c in ("chunks_removed", "lines_removed"))]
    more = [F.when(F.col("cut").isNull(), 0).otherwise(F.size("cut")).alias("chunks_removed"),
            F.when(F.col("cut").isNull(), 0).otherwise(F.col("had") - F.size("rest")).alias("lines_removed")] if counts else []
    replaced = {"text": text}
    if length_col in docs.columns:
        same = F.col("row").getField(length_col)
        replaced[length_col] = F.when(F.col("cut").isNull(), same).otherwise(
            F.length(text).cast(docs.schema[length_col].dataType))
    return x.select(*unpacked(columns, replaced), *more)


def query(spark, sf_dir: str) -> DataFrame:
    """op4: every document's remaining text, with the chunks and lines removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs, counts=True)


#: The same rule in DuckDB: chunks numbered by a running count of boundaries, compared by their text, and extended
#: line by line over the chunks next to them.
_NOT_AFTER_MARK = " ".join(f"AND NOT coalesce(lag(marked, {back}) OVER w, false)" for back in range(1, MIN_LINES))
ORACLE = f"""
WITH lines AS (
  SELECT doc_id, i, line, ('0x' || substr(md5(line), 1, 15))::BIGINT AS h
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM documents WHERE text IS NOT NULL AND text <> '')),
prior AS (
  SELECT *, coalesce(lag(h) OVER w, 0) AS p, count(*) OVER (PARTITION BY doc_id) AS size FROM lines
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
marks AS (
  SELECT *, xor(h, (((p & {(1 << 59) - 1}) << 1) | (p >> 59))) % {DIVISOR} = 0 AS marked FROM prior),
cuts AS (
  SELECT *, i = size OR (i >= {MIN_LINES} AND i <= size - {MIN_LINES} AND marked {_NOT_AFTER_MARK}) AS ends FROM marks
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM cuts),
parts AS (
  SELECT doc_id, c, min(i) AS first, max(i) AS last, string_agg(line, chr(10) ORDER BY i) AS bytes
  FROM numbered GROUP BY doc_id, c HAVING count(*) >= {MIN_LINES}),
heads AS (
  SELECT doc_id, c, first, last, first_value(doc_id) OVER w AS head_doc, first_value(c) OVER w AS head_c,
         first_value(first) OVER w AS head_first, first_value(last) OVER w AS head_last FROM parts
  WINDOW w AS (PARTITION BY bytes ORDER BY doc_id, c)),
gone AS (SELECT * FROM heads WHERE doc_id <> head_doc OR c <> head_c),
below AS (
  SELECT l.doc_id, l.i, bool_and(coalesce(l.line = m.line, false)) OVER (PARTITION BY g.doc_id, g.c ORDER BY l.i) AS same
  FROM gone g JOIN numbered l ON l.doc_id = g.doc_id AND l.c > g.c AND l.c <= g.c + {REACH}
  LEFT JOIN numbered m ON m.doc_id = g.head_doc AND m.i = g.head_last + l.i - g.last AND m.c <= g.head_c + {REACH}),
above AS (
  SELECT l.doc_id, l.i, bool_and(coalesce(l.line = m.line, false)) OVER (PARTITION BY g.doc_id, g.c ORDER BY l.i DESC) AS same
  FROM gone g JOIN numbered l ON l.doc_id = g.doc_id AND l.c < g.c AND l.c >= g.c - {REACH}
  LEFT JOIN numbered m ON m.doc_id = g.head_doc AND m.i = g.head_first + l.i - g.first AND m.c >= g.head_c - {REACH}),
dropped AS (
  SELECT doc_id, i FROM numbered JOIN gone USING (doc_id, c)
  UNION SELECT doc_id, i FROM below WHERE same
  UNION SELECT doc_id, i FROM above WHERE same),
rest AS (
  SELECT p.doc_id, coalesce(string_agg(p.line, chr(10) ORDER BY p.i) FILTER (d.i IS NULL), '') AS text, count(d.i) AS lines_removed
  FROM numbered p LEFT JOIN dropped d ON d.doc_id = p.doc_id AND d.i = p.i GROUP BY p.doc_id),
counted AS (SELECT doc_id, count(*) AS chunks_removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(r.text, d.text) AS text, coalesce(c.chunks_removed, 0)::INT AS chunks_removed,
       coalesce(r.lines_removed, 0)::INT AS lines_removed
FROM documents d LEFT JOIN rest r USING (doc_id) LEFT JOIN counted c USING (doc_id)
"""

"""Line dedup against a plain Python statement of the same rule."""

import hashlib

from pyspark.sql import functions as F

from ledgerline.llm import line_dedup as L


def lines_hash(line):
    return int(hashlib.md5(line.encode()).hexdigest()[:15], 16)


def chunked(text):
    """First and one-past-last line of every chunk."""
    lines = text.split("\n")
    h = [lines_hash(x) for x in lines]
    marked = []
    for i in range(len(lines)):
        p = h[i - 1] if i else 0
        marked.append((h[i] ^ (((p << 1) | (p >> 59)) & ((1 << 60) - 1))) % L.DIVISOR == 0)
    out, first = [], 0
    for i in range(len(lines)):
        room = i + 1 >= L.MIN_LINES and len(lines) - i - 1 >= L.MIN_LINES
        alone = not any(marked[max(i - L.MIN_LINES + 1, 0):i])
        if i == len(lines) - 1 or (room and marked[i] and alone):
            out.append((first, i + 1))
            first = i + 1
    return out


def plain(rows):
    """Text by (id, text) for rows in the order of first occurrence by id (null first)."""
    heads, out = {}, {}
    for i, t in sorted({(i, t) for i, t in rows if t}, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines, spans, gone = t.split("\n"), chunked(t), set()
        for c, (a, b) in enumerate(spans):
            if b - a < L.MIN_LINES:
                continue
            around = (lines[spans[max(c - L.REACH, 0)][0]:a][::-1], lines[b:spans[min(c + L.REACH, len(spans) - 1)][1]])
            if tuple(lines[a:b]) not in heads:
                heads[tuple(lines[a:b])] = around
                continue
            up, down = (next((k for k, (x, y) in enumerate(zip(p, q)) if x != y), min(len(p), len(q)))
                        for p, q in zip(around, heads[tuple(lines[a:b])]))
            gone |= set(range(a - up, b + down))
        out[i, t] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_against_plain(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = plain(rows)
    got = L.dedup_lines(odd.withColumn("before", F.col("text")), counts=True).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["text"] == (want[r["doc_id"], r["before"]] if r["before"] else r["before"])
        assert (r["key"], r["n"], r["row"]) == ("key", 1, "r")
    assert any(r["lines_removed"] > 2 for r in got)


def test_insertion_does_not_move_chunks(spark):
    body = "\n".join(f"line {i} of a long shared block" for i in range(60))
    docs = spark.createDataFrame([(1, body), (2, "a new first line\n" + body), (3, "other\nlines")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in L.dedup_lines(docs, counts=True).collect()}
    assert got[2]["lines_removed"] == 60 and got[2]["text"] == "a new first line"
    assert got[1]["lines_removed"] == got[3]["lines_removed"] == 0


def test_passage_between_other_lines(spark):
    shared = [f"shared line {i} of a passage" for i in range(20)]
    rows = [(d, "\n".join([f"own {d} {i}" for i in range(d + 3)] + shared + [f"end {d} {i}" for i in range(5)])) for d in range(6)]
    got = {r["doc_id"]: r for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), counts=True).collect()}
    assert got[0]["lines_removed"] == 0
    for d, t in rows[1:]:
        assert got[d]["text"].split("\n") == [x for x in t.split("\n") if x not in shared]


def test_chunks_have_min_lines(spark):
    text = "\n".join(["same"] * 30 + [f"line {i}" for i in range(200)] + ["same"] * 30)
    parts = L.chunks(spark.createDataFrame([(1, text), (2, "one line")], "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in parts} == {1} and sum(r["n"] for r in parts) == 260
    assert len(parts) > 20 and min(r["n"] for r in parts) >= L.MIN_LINES
    assert {(r["first"] - 1, r["first"] - 1 + r["n"]) for r in parts} == set(chunked(text))


def test_one_copy_of_every_line_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    before = {line for r in docs.collect() for line in (r["text"] or "").split("\n")}
    after = {line for r in L.dedup_lines(docs).collect() for line in (r["text"] or "").split("\n")}
    assert before - after <= {""}


def test_length_column_and_empty(odd, nothing):
    for r in L.dedup_lines(odd, length_col="n_chars").collect():
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))
    assert L.dedup_lines(nothing).count() == 0 and L.dedup_lines(nothing).columns == nothing.columns

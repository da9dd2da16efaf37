"""URL filters against a plain evaluation of every entry for every capture."""

import random

from pyspark.sql import functions as F

from ledgerline.llm import url_filter as U

ENTRY = "list_name string, kind string, pattern string, at long, action string"


def plain(captures, entries):
    latest = {}
    out = []
    for page, url, at in captures:
        best, latest = None, {}
        if url and at is not None and "://" in url:
            rest = url.split("://", 1)[1]
            host = rest.split("/")[0].split("?")[0].split("#")[0].split("@")[-1].split(":")[0].lower()
            path = [s for s in "/".join(rest.split("?")[0].split("#")[0].split("/")[1:]).split("/") if s]
            labels = host.split(".")
            could = {("host", host)} | {("domain", ".".join(labels[i:])) for i in range(max(1, len(labels) - 1))}
            could |= {("path", "/".join([host, *path[:i]])) for i in range(1, len(path) + 1)}
            for name, kind, pattern, when, action in entries:
                if host and None not in (name, kind, pattern, when, action) and (kind, pattern) in could and when <= at:
                    now = latest.get((name, kind, pattern), (-1, False))
                    latest[name, kind, pattern] = max(now, (when, action == "remove"))
            active = [(U.KINDS[k], len(p), n == "allow", k, p, n, when) for (n, k, p), (when, gone) in latest.items() if not gone]
            best = max(active, default=None)
        out.append((page, True if best is None else best[2], *(best[5:2:-1] if best else (None, None, None)), best[6] if best else None))
    return [(p, k, n, kind, pattern, since) for p, k, n, pattern, kind, since in out]


def world(seed):
    rnd = random.Random(seed)
    hosts = ["a.example.com", "b.example.com", "example.com", "x.y.other.org", "localhost"]
    patterns = [("host", h) for h in hosts] + [("domain", d) for d in ("example.com", "other.org", "y.other.org", "com")] + \
        [("path", f"{h}/{p}") for h in hosts for p in ("en", "en/news", "de")]
    entries = [(rnd.choice(["block", "allow"]), *rnd.choice(patterns), rnd.randrange(0, 1000), rnd.choice(["add", "remove"]))
               for _ in range(120)]
    entries += [("block", "host", "a.example.com", rnd.randrange(1000), "add") for _ in range(60)]
    entries += [(None, "host", "example.com", 1, "add"), ("block", None, "example.com", 1, "add"),
                ("block", "host", None, 1, "add"), ("block", "host", "example.com", None, "add"), ("block", "host", "localhost", 2, None)]
    captures = [(i, f"http{'s' * (i % 2)}://{rnd.choice(['', 'me@'])}{rnd.choice(hosts).upper()}{rnd.choice(['', ':80'])}"
                 f"{rnd.choice(['', '/', '/en', '/en/news/1?q=/de#x', '//en', '/de/', '/enx'])}", rnd.randrange(-5, 1100))
                for i in range(200)]
    captures += [(500, None, 5), (501, "not a url", 5), (502, "", 5), (503, "http://example.com/en", None), (504, "mailto:a@b", 9),
                 (505, "http://" + "a.example.com/" + "en/" * 5000, 900), captures[0], captures[0]]
    return captures, entries


def test_every_capture_against_every_entry(spark):
    for seed, bucket, spans in ((1, 100, 64), (2, 7, 5), (3, U.DAY, 2)):
        captures, entries = world(seed)
        df = spark.createDataFrame([(*c, "mine", True) for c in captures], "page_id long, url string, fetched long, kind string, row boolean")
        got = U.evaluate(df, spark.createDataFrame(entries, ENTRY), bucket, spans=spans).collect()
        want = plain(captures, entries)
        assert sorted(((r["page_id"], r["keep"], r["list_name"], r["kind"], r["pattern"], r["since"]) for r in got), key=str) \
            == sorted(want, key=str)
        assert all(r["row"] is True for r in got)


def test_far_moments_add_a_row_each(spark, monkeypatch):
    """An entry that holds for years and a capture of the year 9999 are one row each among the moments."""
    sizes = []
    real = U.written

    def counted(df, name):
        out = real(df, name)
        if name == "url-moments":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(U, "written", counted)
    year = 365 * U.DAY
    entries = [("block", "host", f"h{i}.org", 0, "add") for i in range(5)] + [("block", "host", "h0.org", 10 * year, "remove")]
    captures = [(1, "http://h0.org/a", 5 * year), (2, "http://h1.org/a", 3)]
    far = [(3, "http://h2.org/", 8000 * year), (4, "http://h0.org/", 10 * year), (5, "http://h0.org/", -(1 << 61))]
    ee = spark.createDataFrame(entries, ENTRY)
    schema = "page_id long, url string, fetched long"
    assert U.evaluate(spark.createDataFrame(captures, schema), ee).where("not keep").count() == 2
    got = {r["page_id"]: r["keep"] for r in U.evaluate(spark.createDataFrame(captures + far, schema), ee).collect()}
    assert got == {1: False, 2: False, 3: False, 4: True, 5: True}
    assert sizes[1] - sizes[0] == len(far)  # no row more than the captures themselves


def test_empty_lists_and_tables(spark):
    captures, entries = world(1)
    df = spark.createDataFrame(captures, "page_id long, url string, fetched long")
    ee = spark.createDataFrame(entries, ENTRY)
    assert U.evaluate(df, ee.where("at < -5")).where("not keep").count() == 0
    assert U.evaluate(df.where("page_id < 0"), ee).count() == 0


def test_intervals_do_not_overlap(spark):
    _, entries = world(4)
    x = U.intervals(spark.createDataFrame(entries, ENTRY), 50)
    a, b = x.alias("a"), x.alias("b")
    same = F.expr("a.list_name = b.list_name and a.kind = b.kind and a.pattern = b.pattern and a.since < b.since and a.until > b.since")
    assert a.join(b, same).count() == 0 and x.where("since >= until").count() == 0

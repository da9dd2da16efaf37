"""URL filters that were active when a page was fetched (operator 7).

List entries are dated actions: ``list_name`` (block or allow), ``kind``
(domain, host, path), ``pattern``, ``at`` and ``action`` (add, remove).  The
entries of one pattern in order of time become validity intervals: an addition
holds until the pattern's next entry.  Every capture is then evaluated as of
its own fetch time against the intervals that hold at that moment; a later
change of a list never touches an earlier capture.

Matching.  ``host`` is the URL's host, ``domain`` the host or any parent of at
least two labels, ``path`` the host with leading path segments; only depths
that a list uses are tried.  Of the active entries that match, the most
specific decides (path before host before domain, then the longer pattern, then
allow before block); without a match the capture is kept.

Plan.  The patterns that captures ask for and the intervals are laid out together
by (list, kind, pattern) in order of time, and each question takes the last interval
that began before it: one row an interval and one a question, however long the
interval holds and however far off a fetch time is.  So that one pattern with a
large share of the rows is not one task, time is cut at ``SPANS`` quantiles of all its
moments; a question without an interval in its own span takes the last one of the
spans before.  Questions of equal pattern and time are asked once.  Successors
of entries are found inside spans first and then between spans, likewise.

Defined results: a null or hostless URL matches nothing and is kept, as is a
capture without a fetch time; entries lacking a list, kind, pattern, time or
action are ignored; of entries of one pattern and time, removal wins; repeated
captures are evaluated each; an empty list keeps everything; an empty table
gives an empty result; other columns of the captures pass unchanged, but for those
named like the result's own (``keep, list_name, kind, pattern, since``), which it replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import written

DAY = 86_400_000_000  # microseconds
FOREVER = (1 << 62)
SPANS = 64
KINDS = {"domain": 1, "host": 2, "path": 3}


def url_host(url: Column) -> Column:
    """Lower-case host, empty without one."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def url_segments(url: Column) -> Column:
    """Non-empty path segments."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/", -1), lambda s: s != "")


def intervals(entries: DataFrame, bucket: int = DAY) -> DataFrame:
    """``list_name, kind, pattern, since, until`` (until excluded) of every addition."""
    key = ["list_name", "kind", "pattern"]
    x = entries.select(*key, F.col("at").cast("long").alias("at"), "action").dropna()
    x = x.groupBy(*key, "at").agg(F.max(F.col("action") == "remove").alias("gone"))
    x = x.withColumn("span", F.expr(f"floor(at / {bucket})"))
    x = x.selectExpr("*", "lead(at) over (partition by list_name, kind, pattern, span order by at) as following")
    firsts = x.groupBy(*key, "span").agg(F.min("at").alias("first"))
    firsts = firsts.selectExpr(*[f"{k} as f_{k}" for k in key], "span as f_span",
                               "lead(first) over (partition by list_name, kind, pattern order by span) as next_first")
    same = F.expr("list_name = f_list_name and kind = f_kind and pattern = f_pattern and span = f_span")
    return x.where("not gone").join(firsts, same).select(
        *key, F.col("at").alias("since"), F.coalesce("following", "next_first", F.lit(FOREVER)).alias("until"))


def capture_keys(captures: DataFrame, depth: int) -> DataFrame:
    """``row, kind, pattern, at`` for every pattern that could match a capture (columns ``row, url, at``)."""
    x = captures.where("url is not null and at is not null").select(
        "row", "at", url_host(F.col("url")).alias("host"), url_segments(F.col("url")).alias("path"))
    x = x.where("host <> ''").withColumn("labels", F.split("host", r"\.", -1))
    domains = F.expr("transform(sequence(1, greatest(size(labels) - 1, 1)), "
                     "i -> array_join(slice(labels, i, greatest(size(labels), 1)), '.'))")
    paths = F.expr(f"transform(sequence(0, least(size(path), {int(depth)})), "
                   "i -> concat_ws('/', array(host), slice(path, 1, least(i, size(path)))))")
    x = x.select("row", "at", "host", domains.alias("domains"), paths.alias("paths"))
    x = x.select("row", "at", F.concat(
        F.transform("domains", lambda d: F.struct(F.lit("domain").alias("kind"), d.alias("pattern"))),
        F.array(F.struct(F.lit("host").alias("kind"), F.col("host").alias("pattern"))),
        F.transform(F.filter("paths", lambda p: F.contains(p, F.lit("/"))),
                    lambda p: F.struct(F.lit("path").alias("kind"), p.alias("pattern")))).alias("keys"))
    return x.select("row", "at", F.inline_outer("keys"))


def as_of(asked: DataFrame, lists: DataFrame, spans: int = SPANS) -> DataFrame:
    """``kind, pattern, at, list_name, since``: the intervals of ``lists`` that hold at the distinct moments asked for."""
    key = ["list_name", "kind", "pattern"]
    asked = asked.join(lists.select(*key).distinct(), ["kind", "pattern"])
    both = lists.select(*key, F.col("since").alias("at"), F.struct("since", "until").alias("held"))
    both = both.unionByName(asked.select(*key, "at", F.lit(None).cast("struct<since:bigint,until:bigint>").alias("held")))
    both = written(both, "url-moments")
    cuts = both.agg(F.percentile_approx("at", [i / spans for i in range(1, spans)], 10_000)).first()[0] or []
    edges = ", ".join(f"{c}L" for c in sorted(set(cuts))) or "0L"
    both = both.withColumn("span", F.expr(f"size(filter(array({edges}), e -> e <= at))"))
    # at one moment an interval comes before the question: it holds from its first moment on
    inside = Window.partitionBy(*key, "span").orderBy("at", F.col("held").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    x = both.withColumn("hit", F.last("held", ignorenulls=True).over(inside)).where("held is null")
    earlier = Window.partitionBy(*key).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.groupBy(*key, "span").agg(F.max("held").alias("newest")) \
        .select(*key, "span", F.last("newest", ignorenulls=True).over(earlier).alias("before"))
    x = x.join(carried, [*key, "span"]).withColumn("h", F.coalesce("hit", "before"))
    return x.where("at < h.until").select("kind", "pattern", "at", "list_name", "h.since")


def evaluate(captures: DataFrame, entries: DataFrame, bucket: int = DAY, url_col: str = "url",
             at_col: str = "fetched", spans: int = SPANS) -> DataFrame:
    """``captures`` with ``keep`` and the deciding entry: ``list_name, kind, pattern, since`` (null if none).

    ``at_col`` and the entries' ``at`` are microseconds.  Rows of captures are
    told apart by all their columns; equal rows get equal decisions.
    """
    rows = captures.select(F.struct(*[F.col(f"`{c}`") for c in captures.columns]).alias("r")) \
        .withColumn("row", F.md5(F.to_json("r", {"ignoreNullFields": "false"})))
    lists = written(intervals(entries, bucket), "url-intervals")
    depth = lists.agg(F.max(F.when(F.col("kind") == "path", F.size(F.split("pattern", "/", -1)) - 1))).first()[0]
    at = rows.select("row", F.col("r").getField(url_col).alias("url"), F.col("r").getField(at_col).cast("long").alias("at"))
    keys = capture_keys(at.distinct(), depth or 0)
    held = as_of(keys.select("kind", "pattern", "at").distinct(), lists, spans).alias("l")
    met = keys.alias("k").join(held, F.expr("k.kind = l.kind and k.pattern = l.pattern and k.at = l.at"))
    rank = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])[F.col("l.kind")]
    best = met.groupBy("k.row").agg(F.max(F.struct(
        rank.alias("rank"), F.length("l.pattern").alias("size"), (F.col("list_name") == "allow").alias("allow"),
        F.col("l.kind").alias("kind"), F.col("l.pattern").alias("pattern"), "list_name", "since")).alias("best"))
    out = rows.alias("c").join(best.alias("b"), F.expr("c.row = b.row"), "left")
    mine = ("keep", "list_name", "kind", "pattern", "since")
    return out.select(*[F.col("r").getField(c).alias(c) for c in captures.columns if c not in mine],
                      F.coalesce(F.col("best.allow"), F.lit(True)).alias("keep"),
                      *[F.col("best").getField(c).alias(c) for c in mine[1:]])


def listed(pages: DataFrame, events: DataFrame) -> DataFrame:
    """Dated list entries derived from the tables: an event acts on the page its user id names."""
    e = events.select(F.col("user_id").alias("page_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
                      F.floor("value").alias("v"), "event_type")
    x = pages.select("page_id", "url").join(e, "page_id").select(
        "at", "v", "event_type", url_host(F.col("url")).alias("host"), url_segments(F.col("url")).alias("path"))
    kind = F.expr("case v % 3 when 0 then 'domain' when 1 then 'host' else 'path' end")
    pattern = F.expr("case v % 3 when 0 then substring_index(host, '.', -2) when 1 then host "
                     "else concat(host, '/', coalesce(get(path, 0), '')) end")
    return x.select(F.expr("case when v % 5 = 0 then 'allow' else 'block' end").alias("list_name"), kind.alias("kind"),
                    pattern.alias("pattern"), "at",
                    F.when(F.col("event_type").isin("error", "view"), "remove").otherwise("add").alias("action"))


def query(spark, sf_dir: str) -> DataFrame:
    """op7: every page, fetched at a time derived from its id, against the entries active then.

    ``since`` is -1 without a deciding entry.
    """
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    low, high = events.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))),
                           F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
    captures = pages.withColumn("fetched", F.lit(low) + (F.col("page_id") * 7919 * 1_000_000) % F.lit(max(high - low, 1)))
    return evaluate(captures, listed(pages, events)).withColumn("since", F.coalesce("since", F.lit(-1)))


#: The latest entry at or before the fetch time, for every pattern that could match.
ORACLE = r"""
WITH span AS (SELECT min(epoch_us(ts)) AS low, greatest(max(epoch_us(ts)) - min(epoch_us(ts)), 1) AS width FROM events),
p AS (SELECT page_id, url, low + (page_id * 7919 * 1000000) % width AS fetched,
             lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)) AS host,
             list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/'),
                         lambda s: s <> '') AS path
      FROM pages, span),
e AS (SELECT CASE WHEN floor(value)::BIGINT % 5 = 0 THEN 'allow' ELSE 'block' END AS list_name,
             CASE floor(value)::BIGINT % 3 WHEN 0 THEN 'domain' WHEN 1 THEN 'host' ELSE 'path' END AS kind,
             CASE floor(value)::BIGINT % 3 WHEN 0 THEN regexp_extract(host, '([^.]*\.)?[^.]*$') WHEN 1 THEN host
                  ELSE host || '/' || coalesce(path[1], '') END AS pattern,
             epoch_us(ts) AS moment, event_type IN ('error', 'view') AS gone
      FROM events JOIN p ON p.page_id = user_id),
t AS (SELECT list_name, kind, pattern, moment, max(gone) AS gone FROM e GROUP BY ALL),
k AS (SELECT page_id, fetched, 'host' AS kind, host AS pattern FROM p
      UNION ALL
      SELECT page_id, fetched, 'domain', array_to_string(string_split(host, '.')[i:], '.')
      FROM p, unnest(range(1, greatest(len(string_split(host, '.')), 2))) AS r(i)
      UNION ALL
      SELECT page_id, fetched, 'path', host || '/' || array_to_string(path[1:i], '/')
      FROM p, unnest(range(1, len(path) + 1)) AS r(i)),
m AS (SELECT page_id, list_name, kind, pattern, max(moment) AS since, arg_max(gone, moment) AS gone
      FROM k JOIN t USING (kind, pattern) WHERE t.moment <= k.fetched GROUP BY ALL),
best AS (SELECT page_id, max(row(CASE kind WHEN 'path' THEN 3 WHEN 'host' THEN 2 ELSE 1 END, length(pattern),
                                 list_name = 'allow', kind, pattern, list_name, since)) AS b
         FROM m WHERE NOT gone GROUP BY page_id)
SELECT p.page_id, p.url, p.fetched, coalesce(b[3], true) AS keep, b[6] AS list_name, b[4] AS kind, b[5] AS pattern,
       coalesce(b[7], -1) AS since
FROM p LEFT JOIN best USING (page_id)
"""

"""Table registry: raw parquet tables plus the warehouse tables derived from them.

``load(spark, sf_dir)`` registers every raw table as a temp view (lazy
parquet scans, so filters and column pruning reach the files).  The adapter
views that model the warehouse are registered on top of them, and those asked for are
*staged*: computed once per application and set of input files, and written as parquet
under the shared ``spark.checkpoint.dir``; the written table is registered under
the view's name.  The write also cuts lineage, so a lost executor never
re-runs the derivation of an earlier layer.

A query asks (``needs_of`` its statement) for the calendar, for the rates if it
uses them, and for a relation that takes the whole history to derive and that
it reads more than once.  Every other view is read as the plan that it is: a job's
days, accounts and columns then reach the scans of the raw tables, and what
the job does not read is neither shuffled nor written.  ``load`` without a list
stages the whole warehouse, for a session that runs many jobs over many months.

Staged dated facts are partitioned by month and sorted by day inside a file.  ``dated``
scans them for a span of days: only the files of its months are read, and the
day reaches the scan as a pushed filter.  A month is dealt to tasks by ranges of
(day, account), so neither a month nor a day has to fit one task.

``load(..., stage=False)`` registers plain views only (no writes).
"""

from __future__ import annotations

import os
import re
import time
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import busi_date_of
from ..session import scratch_path
from . import adapters

LOADED = "ledgerline.loaded"  # a setting of the session: which data set its views show
MONTH = "p_month"
CALENDAR = ("calendar_base", "calendar")  # what decides the run's dates: staged for every query
RATES = "rate_segment"
#: Derived from the whole history, whatever a job's month: staged for a statement that reads it more than once.
WHOLE_HISTORY = "crm_broker_investor_rela"
_staged: dict[tuple, dict[str, tuple]] = {}  # application and data set -> staged view -> its path and schema
_shown: dict[str, set[str]] = {}  # registration -> the views that its session reads as staged tables
STAGE_SECONDS: dict[str, float] = {}
VIEW_SECONDS: dict[str, float] = {}


def _files(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of a table's files, so that changed input is another data set."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


def _month(date_col: str):
    return F.substring(F.regexp_replace(date_col, "-", ""), 1, 6)


def needs_of(sql: str | None) -> tuple[str, ...]:
    """The views to stage for a query, by its statement."""
    text = adapters.with_clause(sql or "")
    heads = (rf"(?m)^(WITH )?{WHOLE_HISTORY} AS \(", rf"\b{WHOLE_HISTORY}\b")
    reads = len(re.findall(heads[1], text)) - len(re.findall(heads[0], text))
    return (*CALENDAR, *([RATES] if re.search(r"\brate_param\b", text) else []), *([WHOLE_HISTORY] if reads > 1 else []))


def load(spark: SparkSession, sf_dir: str, stage: bool = True, only: Iterable[str] | None = None) -> SparkSession:
    """Register the tables of ``sf_dir``; ``only`` names the views to stage (all, unless given)."""
    t0 = time.time()
    inputs = {t: os.path.join(sf_dir, f"{t}.parquet") for t in adapters.RAW_TABLES}
    data = (sf_dir, tuple(_files(spark, p) for p in inputs.values()))
    app = (spark.sparkContext.applicationId, data)
    loaded = spark.conf.get(LOADED, None)
    fresh = not (loaded and loaded.split(" ", 2)[1:] == [str(hash(data)), sf_dir])
    wanted = set() if not stage else {"calendar_base", *adapters.VIEWS, RATES} if only is None else set(only)
    if fresh:
        loaded = f"{uuid.uuid4().hex} {hash(data)} {sf_dir}"
    shown = _shown.setdefault(loaded, set())
    if not fresh and wanted <= shown:
        return spark
    # Staged tables are reused by later sessions of the same application.
    done = _staged.setdefault(app, {})
    if fresh:
        for t, path in inputs.items():
            spark.read.parquet(path).createOrReplaceTempView(t)
        for name in adapters.FACTS:
            spark.catalog.dropTempView(f"{name}__months")

    def staged(name: str, make) -> DataFrame:
        if name not in done:
            df = make()
            path = scratch_path(spark, f"warehouse/{uuid.uuid4().hex[:12]}/{name}")
            if name in adapters.FACTS:
                day, spread = adapters.FACTS[name]
                df = df.withColumn(MONTH, _month(day))
                df.repartitionByRange(day, spread).sortWithinPartitions(MONTH, day) \
                    .write.mode("overwrite").partitionBy(MONTH).parquet(path)
            else:
                df.write.mode("overwrite").parquet(path)
            done[name] = path, df.schema
        path, schema = done[name]
        return spark.read.schema(schema).parquet(path)

    def build(name: str) -> DataFrame:
        t = time.time()
        body = adapters.spark_body(name)
        df = staged(name, lambda: spark.sql(body)) if name in wanted else spark.sql(body)
        VIEW_SECONDS[name] = time.time() - t
        return df

    def register(name: str, df: DataFrame) -> None:
        if MONTH in df.columns:
            df.createOrReplaceTempView(f"{name}__months")
        df.drop(MONTH).createOrReplaceTempView(name)
        if name in wanted:
            shown.add(name)

    # Level by level: every view of a level only reads raw tables or views of
    # earlier levels, so a level's writes run as concurrent jobs.
    changed: set[str] = set()
    for level in adapters.view_levels():
        # besides the views to stage, those that read a view registered anew
        names = [n for n in level if n not in shown and (fresh or n in wanted or changed & set(adapters.reads(n)))]
        if names:
            with ThreadPoolExecutor(max_workers=min(8, len(names))) as pool:
                frames = list(pool.map(build, names))
            for name, df in zip(names, frames):
                register(name, df)
            changed.update(names)
    if fresh or (RATES in wanted and RATES not in shown):
        from ..operators.rates import rate_dim, rate_segments
        resolve = lambda: rate_segments(rate_dim(spark))  # noqa: E731 - a parameter table, resolved once
        register(RATES, staged(RATES, resolve) if RATES in wanted else resolve())
    spark.conf.set(LOADED, loaded)
    STAGE_SECONDS[sf_dir] = time.time() - t0
    return spark


def dated(spark: SparkSession, name: str, first: str | None, last: str | None) -> DataFrame:
    """Rows of a dated fact from day ``first`` to day ``last`` (in the spelling of its date column, both inclusive).

    Of a staged fact the months become a filter on the partition column, so other months' files are not listed or read.
    Of any other fact the days filter the view, and so the rows of the raw tables under it.
    Without a first or last day (a month without trading) there are no rows.
    """
    day = adapters.FACTS[name][0]
    months = name in _shown.get(spark.conf.get(LOADED, None), ())
    t = spark.table(f"{name}__months" if months else name)
    if first is None or last is None:
        return t.drop(MONTH).limit(0)
    if not months:
        return t.filter(F.col(day).between(first, last))
    lo, hi = (d.replace("-", "")[:6] for d in (first, last))
    return t.filter(F.col(MONTH).between(lo, hi) & F.col(day).between(first, last)).drop(MONTH)


def session_key(spark: SparkSession) -> tuple:
    """What a memoised plan depends on: the registered data set and the business date."""
    return spark.conf.get(LOADED, None), busi_date_of(spark)


_blocks: dict[tuple, DataFrame] = {}


def block(fn):
    """Memoise a DataFrame builder ``fn(spark, *args)`` per session and data set.

    Composite plans reuse a block several times; building it once keeps one
    analysed sub-plan, so analysis stays cheap and Spark can reuse its
    exchanges instead of recomputing the block.
    """
    def wrapper(spark: SparkSession, *args, **kwargs):
        frozen = tuple(tuple(v) if isinstance(v, list) else v for v in args)
        frozen += tuple((k, tuple(v) if isinstance(v, list) else v) for k, v in sorted(kwargs.items()))
        key = (*session_key(spark), fn.__module__, fn.__name__, frozen)
        df = _blocks.get(key)
        if df is None:
            df = _blocks[key] = fn(spark, *args, **kwargs)
        return df
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


_written: dict[tuple, DataFrame] = {}


def forget() -> None:
    """Drop the memoised blocks and written job tables, so that the next call builds them again."""
    _blocks.clear()
    _written.clear()


def written(spark: SparkSession, name: str, build) -> DataFrame:
    """Write ``build()`` once per session and data set under the shared
    checkpoint folder and return the table read back.

    Used where a later job reads an earlier job's output table: the write
    cuts lineage (a lost executor never recomputes the earlier job) and the
    later plan starts from a plain parquet scan.
    """
    key = (*session_key(spark), name)
    df = _written.get(key)
    if df is None:
        path = scratch_path(spark, f"jobs/{uuid.uuid4().hex[:12]}/{name}")
        build().write.mode("overwrite").parquet(path)
        df = _written[key] = spark.read.parquet(path)
    return df

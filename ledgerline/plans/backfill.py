"""Back-fill of the daily department jobs over a list of dates.

The original loops over dates, skips closed days, and runs the reallocation
(114) and its posting (300) for each.  Here the days that are listed, trade and are not
done yet become one job per month, which writes a partition per day; the posting of
a month replaces that month's partition and is run once, as of the month's last day, because
every earlier one would be replaced by it.

Steps that are done are rows of a written ledger, (job, busi_date).  A step is
recorded after its partitions are written, and writing them again gives the
same partitions, so a run that was broken off is started again and goes on where it stopped.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sink import read_table, write_table
from ..params import P, busi_date_of, run_params, set_busi_date
from ..session import scratch_path
from . import jobs, posting_jobs
from .ledger import rnd, rounded
from .registry import query

STEPS = "job string, busi_date string"
DAILY, POSTED = "t_00114_data", "t_00300"


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def steps_done(spark, folder: str) -> DataFrame:
    """The ledger of finished steps."""
    path = f"{folder}/steps"
    return spark.read.schema(STEPS).parquet(path) if _exists(spark, path) else spark.createDataFrame([], STEPS)


def _done(spark, folder: str, job: str, days: Iterable[str]) -> None:
    spark.createDataFrame([(job, d) for d in days], STEPS).coalesce(1).write.mode("append").parquet(f"{folder}/steps")


def trading_days(spark, days: Iterable[str]) -> list[str]:
    """Which of the listed days trade, by the calendar (at most one row per listed day comes back)."""
    listed = spark.createDataFrame([(d,) for d in sorted(set(days))], "busi_date string")
    trade = spark.table("calendar").filter("trade_flag = '1'").select("busi_date")
    return sorted(r[0] for r in listed.join(trade, "busi_date").collect())


def backfill(spark, days: Iterable[str], folder: str) -> dict[str, DataFrame]:
    """Bring the daily reallocation and its monthly posting up to date for ``days`` (yyyymmdd); closed days are skipped.

    ``folder`` lies where driver and executors share files; it holds the two tables and the ledger of steps.
    Returns the tables, partitioned by ``busi_date`` and ``month_id``.
    """
    trade = trading_days(spark, days)
    finished = {(r[0], r[1]) for r in steps_done(spark, folder).filter(F.col("busi_date").isin(trade)).collect()}
    schemas = {}
    before = busi_date_of(spark)
    try:
        for month in sorted({d[:6] for d in trade}):
            own = [d for d in trade if d.startswith(month)]
            pending = [d for d in own if (DAILY, d) not in finished]
            set_busi_date(spark, own[-1])
            facts = jobs.reallocated(spark, jobs.dept_daily_between(spark, own[0], own[-1]))
            schemas[DAILY] = facts.schema
            if pending:
                write_table(facts.filter(F.col("busi_date").isin(pending)), f"{folder}/{DAILY}", facts.schema, "overwrite", ["busi_date"])
                _done(spark, folder, DAILY, pending)
            written = read_table(spark, f"{folder}/{DAILY}", facts.schema)
            posted = posting_jobs.post(spark, "post_dept", written.filter(F.col("busi_date").between(f"{month}01", f"{month}31")))
            schemas[POSTED] = posted.schema
            # a day added to a month posts the month again
            if pending or (POSTED, own[-1]) not in finished:
                write_table(posted, f"{folder}/{POSTED}", posted.schema, "overwrite", ["month_id"])
                _done(spark, folder, POSTED, [own[-1]])
    finally:
        set_busi_date(spark, before)
    return {k: read_table(spark, f"{folder}/{k}", s).select(*s.names) for k, s in schemas.items() if _exists(spark, f"{folder}/{k}")}


def listed_days(first: str, last: str) -> list[str]:
    """Every natural day from ``first`` to ``last``."""
    import datetime as dt
    a, z = (dt.datetime.strptime(x, "%Y%m%d").date() for x in (first, last))
    return [(a + dt.timedelta(days=i)).strftime("%Y%m%d") for i in range((z - a).days + 1)]


_SUMS = ["allocat_end_rights", "allocat_remain_transfee", "allocat_done_amount", "allocat_done_money"]


@query("backfill_dept", f"""
SELECT t.n_busi_date AS busi_date, count(*) AS n_rows, {rnd('sum(t.rights * r.rights_rate)', 4)} AS allocat_end_rights,
  {rnd('sum(t.remain_transfee * r.fund_rate)', 4)} AS allocat_remain_transfee,
  {rnd('sum(t.done_amount * r.done_rate)', 4)} AS allocat_done_amount, {rnd('sum(t.done_money * r.done_rate)', 4)} AS allocat_done_money
FROM rpt_06008 t JOIN calendar c ON c.busi_date = t.n_busi_date AND c.trade_flag = '1'
JOIN t00114 a ON t.fund_account_id = a.fund_account_id AND t.n_busi_date BETWEEN a.begin_date AND a.end_date
JOIN fund_account b ON a.fund_account_id = b.fund_account_id
JOIN t00114 r ON t.fund_account_id = r.fund_account_id
WHERE t.n_busi_date BETWEEN '{P.prev_month_start}' AND '{P.busi_date}' GROUP BY t.n_busi_date""")
def backfill_dept(spark):
    """The daily reallocation back-filled over all days of two months; totals of each day's partition."""
    p = run_params(spark)
    folder = scratch_path(spark, f"backfill/{uuid.uuid4().hex[:12]}")
    out = backfill(spark, listed_days(p.prev_month_start, p.busi_date), folder)[DAILY]
    return rounded(out.groupBy("busi_date").agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(c).alias(c) for c in _SUMS]), default=4)

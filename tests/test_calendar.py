"""Calendar operators against plain Python date arithmetic on every day."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import calendar as C
from ledgerline.params import params_of
from ledgerline.sources.adapters import CLOSED_DAYS

SF = "/root/testdata/sf0.001"


def is_trade_day(d: dt.date) -> bool:
    return d.weekday() < 5 and d.strftime("%m%d") not in CLOSED_DAYS


def roll_back(d: dt.date) -> dt.date:
    while not is_trade_day(d):
        d -= dt.timedelta(days=1)
    return d


@pytest.fixture(scope="module")
def cal(spark):
    from ledgerline.sources import tables
    tables.load(spark, SF)
    return spark.table("calendar")


def span(cal):
    r = cal.agg(F.min("cal_date").alias("lo"), F.max("cal_date").alias("hi")).first()
    return r.lo, r.hi


def _py_nth(d: dt.date, n: int, lo: dt.date, hi: dt.date):
    d = roll_back(d)
    if d < lo:
        return None
    step = 1 if n > 0 else -1
    while n:
        d += dt.timedelta(days=step)
        if d < lo or d > hi:
            return None
        if is_trade_day(d):
            n -= step
    return d.strftime("%Y%m%d")


def test_nature_date_and_flags(cal):
    rows = cal.select("busi_date", "trade_flag", "nature_date").collect()
    lo, hi = span(cal)
    assert len(rows) == (hi - lo).days + 1 and lo < dt.date(1995, 1, 1) and lo.day == 1
    for r in rows:
        d = dt.datetime.strptime(r.busi_date, "%Y%m%d").date()
        assert (r.trade_flag == "1") == is_trade_day(d)
        rb = roll_back(d)
        assert r.nature_date == (rb.strftime("%Y%m%d") if rb >= lo else None)


@pytest.mark.parametrize("n", [-3, -1, 0, 1, 2, 5])
def test_nth_trading_day(spark, cal, n):
    days = cal.select(F.col("busi_date").alias("d"))
    got = {r.d: r.nth_trade_day for r in C.nth_trading_day(days, cal, "d", n).collect()}
    lo, hi = span(cal)
    for s, v in got.items():
        d = dt.datetime.strptime(s, "%Y%m%d").date()
        assert v == _py_nth(d, n, lo, hi), (s, n)


def test_period_bounds(cal):
    r = C.period_bounds(cal, month="199706").collect()[0]
    assert (r.begin_date, r.end_date, r.total_days) == ("19970603", "19970627", 19)  # both ends of the month are closed
    r = C.period_bounds(cal, begin_date="19970607", end_date="19970608").collect()[0]
    assert (r.begin_date, r.end_date, r.total_days) == (None, None, 0)
    r = C.period_bounds(cal, year="1996", trading=False).collect()[0]
    assert (r.begin_date, r.end_date, r.total_days) == ("19960101", "19961231", 366)


def test_month_helpers(spark):
    df = spark.createDataFrame([("199701", "20240229"), ("199612", "20240531"), ("199703", "20230101")], "m string, d string")
    out = df.select(C.month_shift("m", -1).alias("prev"), C.month_shift("m", 1).alias("next"),
                    F.date_format(C.prev_month_end(C.ymd_to_date("d")), "yyyyMMdd").alias("pme"),
                    C.date_to_ymd(C.prev_year_same_day(C.ymd_to_date("d"))).alias("py")).collect()
    assert [tuple(r) for r in out] == [("199612", "199702", "20240131", "20230228"),
                                       ("199611", "199701", "20240430", "20230531"),
                                       ("199702", "199704", "20221231", "20220101")]


def test_run_params_follow_the_calendar(cal):
    p = params_of(cal, "19970630")  # the month's first and last weekday are closed
    assert (p.first_trade_day, p.last_trade_day, p.trade_days) == ("19970603", "19970627", 19)
    assert (p.interest_begin, p.interest_end, p.month_id) == ("19970521", "19970620", "199706")
    assert p.last_trade_dash == "1997-06-27" and p.prev_month_end_dash == "1997-05-31"
    p = params_of(cal, "19970323")  # 21 Feb 1997 is a Friday; busi_date on a Sunday
    assert p.last_trade_day == "19970321" and p.interest_begin == "19970221"
    shut = cal.withColumn("trade_flag", F.lit("0")).withColumn("nature_date", F.lit(None).cast("string"))
    p = params_of(shut, "19970630")
    assert (p.first_trade_day, p.last_trade_day, p.trade_days, p.interest_begin, p.last_trade_dash) == (None, None, 0, None, None)
    moved = cal.withColumn("trade_flag", F.when(F.col("busi_date") == "19970603", "0").otherwise(F.col("trade_flag")))
    assert params_of(moved, "19970630").first_trade_day == "19970604"  # no rule but the table's

"""Business-calendar queries, applied per row of the order
history so that the work grows with the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calendar as cal_ops
from ..params import P, run_params
from .registry import query

ORDER_DAYS = "SELECT o_orderkey, replace(cast(cast(o_orderdate AS DATE) AS VARCHAR), '-', '') AS d FROM orders"


def _orders(spark):
    return spark.table("orders").select(
        "o_orderkey", F.date_format(F.col("o_orderdate").cast("date"), "yyyyMMdd").alias("d"))


@query("cal_period_bounds", f"""
WITH m AS (SELECT DISTINCT substr(d, 1, 6) AS busi_month FROM ({ORDER_DAYS}) o)
SELECT m.busi_month,
       min(CASE WHEN c.trade_flag = '1' THEN c.busi_date END) AS first_trade_day,
       max(CASE WHEN c.trade_flag = '1' THEN c.busi_date END) AS last_trade_day,
       count(CASE WHEN c.trade_flag = '1' THEN 1 END) AS trade_days,
       min(c.busi_date) AS first_day, max(c.busi_date) AS last_day, count(*) AS n_days
FROM m JOIN calendar c ON substr(c.busi_date, 1, 6) = m.busi_month
GROUP BY m.busi_month""")
def cal_period_bounds(spark):
    """Period bounds for every month that has orders."""
    months = _orders(spark).select(F.substring("d", 1, 6).alias("busi_month")).distinct()
    return months.join(cal_ops.month_bounds(spark.table("calendar")), "busi_month")


@query("cal_run_period", f"""
SELECT min(busi_date) AS begin_date, max(busi_date) AS end_date, count(*) AS total_days
FROM calendar WHERE trade_flag = '1' AND busi_date LIKE '{P.month_id}%' AND busi_date <= '{P.busi_date}'""")
def cal_run_period(spark):
    """The run-month trading period up to the business date."""
    p = run_params(spark)
    return cal_ops.period_bounds(spark.table("calendar"), month=p.month_id, end_date=p.busi_date)


@query("cal_nth_trading_day", f"""
WITH o AS (SELECT o_orderkey, d, CAST(o_orderkey % 7 AS INTEGER) - 3 AS n FROM ({ORDER_DAYS}) x),
td AS (SELECT busi_date, row_number() OVER (ORDER BY busi_date) AS k FROM calendar WHERE trade_flag = '1'),
b AS (SELECT o.*, (SELECT count(*) FROM calendar t WHERE t.trade_flag = '1' AND t.busi_date <= o.d) AS k0,
             c.busi_date IS NOT NULL AS in_cal
      FROM o LEFT JOIN calendar c ON c.busi_date = o.d)
SELECT b.o_orderkey, b.d, b.n, td.busi_date AS nth_trade_day
FROM b LEFT JOIN td ON b.in_cal AND b.k0 > 0 AND td.k = b.k0 + b.n""")
def cal_nth_trading_day(spark):
    """N-th trading day after / before each order date (n in -3..3)."""
    o = _orders(spark).withColumn("n", (F.col("o_orderkey") % 7).cast("int") - 3)
    return cal_ops.nth_trading_day(o, spark.table("calendar"), "d", "n").select(
        "o_orderkey", "d", "n", "nth_trade_day")


@query("cal_is_trading", f"""
SELECT o.o_orderkey, o.d, c.trade_flag = '1' AS is_trade_day
FROM ({ORDER_DAYS}) o LEFT JOIN calendar c ON c.busi_date = o.d""")
def cal_is_trading(spark):
    """D3: is the order date a trading day."""
    x = cal_ops.calendar_attrs(_orders(spark), spark.table("calendar"), "d")
    return x.select("o_orderkey", "d", (F.col("trade_flag") == "1").alias("is_trade_day"))


@query("cal_roll_back", f"""
SELECT o.o_orderkey, o.d, c.nature_date AS trade_date
FROM ({ORDER_DAYS}) o LEFT JOIN calendar c ON c.busi_date = o.d""")
def cal_roll_back(spark):
    """Last trading day on or before the order date."""
    x = cal_ops.calendar_attrs(_orders(spark), spark.table("calendar"), "d")
    return x.select("o_orderkey", "d", F.col("nature_date").alias("trade_date"))


@query("cal_month_shift", f"""
SELECT o_orderkey, substr(d, 1, 6) AS busi_month,
       strftime(strptime(substr(d, 1, 6) || '01', '%Y%m%d') + INTERVAL 1 MONTH, '%Y%m') AS next_month,
       strftime(strptime(substr(d, 1, 6) || '01', '%Y%m%d') - INTERVAL 13 MONTH, '%Y%m') AS month_minus_13
FROM ({ORDER_DAYS}) o""")
def cal_month_shift(spark):
    """``yyyymm`` +/- n months."""
    o = _orders(spark).select("o_orderkey", F.substring("d", 1, 6).alias("busi_month"))
    return o.select("o_orderkey", "busi_month", cal_ops.month_shift("busi_month", 1).alias("next_month"),
                    cal_ops.month_shift("busi_month", -13).alias("month_minus_13"))


@query("cal_prev_month_end", f"""
SELECT o_orderkey, d, strftime(last_day(strptime(d, '%Y%m%d') - INTERVAL 1 MONTH), '%Y-%m-%d') AS prev_month_end
FROM ({ORDER_DAYS}) o""")
def cal_prev_month_end(spark):
    """Last day of the previous month, dash form."""
    o = _orders(spark)
    return o.select("o_orderkey", "d", F.date_format(cal_ops.prev_month_end(cal_ops.ymd_to_date("d")),
                                                     "yyyy-MM-dd").alias("prev_month_end"))


@query("cal_iso_week", f"""
SELECT o_orderkey, d, CAST(weekofyear(strptime(d, '%Y%m%d')) AS INTEGER) AS iso_week FROM ({ORDER_DAYS}) o""")
def cal_iso_week(spark):
    """ISO week number."""
    return _orders(spark).select("o_orderkey", "d", F.weekofyear(cal_ops.ymd_to_date("d")).alias("iso_week"))


@query("cal_week_bounds", f"""
SELECT o_orderkey, d, strftime(date_trunc('week', strptime(d, '%Y%m%d')), '%Y%m%d') AS monday,
       strftime(date_trunc('week', strptime(d, '%Y%m%d')) + INTERVAL 6 DAY, '%Y%m%d') AS sunday
FROM ({ORDER_DAYS}) o""")
def cal_week_bounds(spark):
    """Monday and Sunday of the week."""
    mon, sun = cal_ops.week_bounds(cal_ops.ymd_to_date("d"))
    return _orders(spark).select("o_orderkey", "d", cal_ops.date_to_ymd(mon).alias("monday"),
                                 cal_ops.date_to_ymd(sun).alias("sunday"))


@query("cal_quarter", f"""
SELECT o_orderkey, d, CAST(quarter(strptime(d, '%Y%m%d')) AS VARCHAR) AS quarter,
       CAST(quarter(strptime(substr(d, 1, 6) || '01', '%Y%m%d')) AS VARCHAR) AS month_quarter
FROM ({ORDER_DAYS}) o""")
def cal_quarter(spark):
    """Quarter of a date or of a month."""
    o = _orders(spark)
    return o.select("o_orderkey", "d", F.quarter(cal_ops.ymd_to_date("d")).cast("string").alias("quarter"),
                    F.quarter(cal_ops.ymd_to_date(F.concat(F.substring("d", 1, 6), F.lit("01"))))
                    .cast("string").alias("month_quarter"))


@query("cal_prev_year", f"""
SELECT o_orderkey, d,
       CASE WHEN substr(d, 5, 4) = '0229' THEN CAST(CAST(substr(d, 1, 4) AS INTEGER) - 1 AS VARCHAR) || '0228'
            ELSE CAST(CAST(substr(d, 1, 4) AS INTEGER) - 1 AS VARCHAR) || substr(d, 5, 4) END AS prev_year_day,
       (CAST(substr(d, 1, 4) AS INTEGER) % 4 = 0 AND CAST(substr(d, 1, 4) AS INTEGER) % 100 <> 0)
         OR CAST(substr(d, 1, 4) AS INTEGER) % 400 = 0 AS leap_year
FROM ({ORDER_DAYS}) o""")
def cal_prev_year(spark):
    """Same day last year (29 Feb -> 28 Feb) and the leap-year test."""
    o = _orders(spark)
    dt = cal_ops.ymd_to_date("d")
    return o.select("o_orderkey", "d", cal_ops.date_to_ymd(cal_ops.prev_year_same_day(dt)).alias("prev_year_day"),
                    cal_ops.is_leap_year(F.year(dt)).alias("leap_year"))


@query("cal_date_series", f"""
SELECT t.fund_account_id, t.begin_date, t.end_date, c.busi_date
FROM t00114 t JOIN calendar c
  ON c.busi_date BETWEEN greatest(t.begin_date, '{P.month_start}') AND least(t.end_date, '{P.month_end}')""")
def cal_date_series(spark):
    """Every date between two dates (rule windows clipped to the month)."""
    p = run_params(spark)
    t = spark.table("t00114").select("fund_account_id", "begin_date", "end_date")
    b = cal_ops.ymd_to_date(F.greatest("begin_date", F.lit(p.month_start)))
    e = cal_ops.ymd_to_date(F.least("end_date", F.lit(p.month_end)))
    x = t.select("fund_account_id", "begin_date", "end_date", cal_ops.date_series(b, e).alias("day"))
    return x.select("fund_account_id", "begin_date", "end_date", cal_ops.date_to_ymd(F.col("day")).alias("busi_date"))

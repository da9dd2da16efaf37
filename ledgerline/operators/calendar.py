"""Business-calendar operators as DataFrame joins against the ``calendar`` view.

The calendar is a bounded dimension (one row per natural day, ~366 per
year), below Spark's broadcast threshold; every operator here is a per-row or per-group
lookup that runs inside the fact's own partitions with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def with_trade_ordinal(cal: DataFrame) -> DataFrame:
    """Add ``trade_ord``: number of trading days on or before each day.

    A closed day carries the ordinal of the previous trading day, which is
    exactly the "roll back to a trading day" rule.  One ordered window over
    the bounded calendar.
    """
    w = Window.orderBy("busi_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cal.withColumn("trade_ord", F.sum(F.when(F.col("trade_flag") == "1", 1).otherwise(0)).over(w))


def nth_trading_day(df: DataFrame, cal: DataFrame, date_col: str, n, out: str = "nth_trade_day") -> DataFrame:
    """n-th trading day after (n > 0) / before (n < 0) ``date_col`` (``yyyymmdd``).

    A closed start day is first rolled back to the previous trading day;
    ``n = 0`` returns that day.  ``n`` is an int or a column.  Days outside the
    calendar give NULL.
    """
    n = F.lit(n) if isinstance(n, int) else (F.col(n) if isinstance(n, str) else n)
    c = with_trade_ordinal(cal)
    ords = c.select(F.col("busi_date").alias("__d"), F.col("trade_ord").alias("__ord"))
    trade = (c.filter(F.col("trade_flag") == "1")
             .select(F.col("trade_ord").alias("__tord"), F.col("busi_date").alias(out)))
    x = df.join(ords, F.col(date_col) == F.col("__d"), "left")
    x = x.withColumn("__target", F.when(F.col("__ord") > 0, F.col("__ord") + n))
    return x.join(trade, F.col("__target") == F.col("__tord"), "left").drop("__d", "__ord", "__target", "__tord")


def calendar_attrs(df: DataFrame, cal: DataFrame, date_col: str) -> DataFrame:
    """Attach ``trade_flag`` and ``nature_date`` (last trading day on or before)."""
    c = cal.select(F.col("busi_date").alias("__d"), "trade_flag", "nature_date")
    return df.join(c, F.col(date_col) == F.col("__d"), "left").drop("__d")


def period_bounds(cal: DataFrame, begin_date=None, end_date=None, begin_month=None, end_month=None,
                  year=None, month=None, trading: bool = True) -> DataFrame:
    """One row ``(begin_date, end_date, total_days)`` of a calendar period.

    Any mix of date range, month range, year, month and trading-only; an
    empty period gives ``(NULL, NULL, 0)``.
    """
    d = F.col("busi_date")
    # every bound is a range of days: yyyymmdd strings order like dates
    lows = [x for x in (begin_date, begin_month, year, month) if x]
    highs = [x + "99999999"[len(x):] for x in (end_date, end_month, year, month) if x]
    inside = d.between(max(lows, default=""), min(highs, default="99999999"))
    c = cal.filter(inside & (F.col("trade_flag") == "1") if trading else inside)
    return c.agg(F.min(d).alias("begin_date"), F.max(d).alias("end_date"), F.count(d).alias("total_days"))


def month_bounds(cal: DataFrame) -> DataFrame:
    """Per month: first/last/count of trading days and of natural days."""
    t = F.col("trade_flag") == "1"
    d = F.col("busi_date")
    return (cal.groupBy(F.substring(d, 1, 6).alias("busi_month"))
            .agg(F.min(F.when(t, d)).alias("first_trade_day"), F.max(F.when(t, d)).alias("last_trade_day"),
                 F.count(F.when(t, d)).alias("trade_days"), F.min(d).alias("first_day"),
                 F.max(d).alias("last_day"), F.count(d).alias("n_days")))


def ymd_to_date(c) -> Column:
    return F.to_date(F.col(c) if isinstance(c, str) else c, "yyyyMMdd")


def date_to_ymd(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def month_shift(yyyymm, n: int) -> Column:
    """``yyyymm`` +/- n months."""
    d = F.to_date(F.concat(F.col(yyyymm) if isinstance(yyyymm, str) else yyyymm, F.lit("01")), "yyyyMMdd")
    return F.date_format(F.add_months(d, n), "yyyyMM")


def prev_month_end(d: Column) -> Column:
    """Last day of the previous month (``add_months`` alone does not snap to month end)."""
    return F.last_day(F.add_months(d, -1))


def week_bounds(d: Column) -> tuple[Column, Column]:
    monday = F.to_date(F.date_trunc("week", d))
    return monday, F.date_add(monday, 6)


def prev_year_same_day(d: Column) -> Column:
    """Same day last year; 29 Feb maps to 28 Feb."""
    return F.add_months(d, -12)


def is_leap_year(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def date_series(begin: Column, end: Column) -> Column:
    """All dates from ``begin`` to ``end`` inclusive (empty if begin > end)."""
    return F.explode(F.when(begin <= end, F.sequence(begin, end, F.expr("INTERVAL 1 DAY")))
                     .otherwise(F.array().cast("array<date>")))

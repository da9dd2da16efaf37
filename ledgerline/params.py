"""Run parameters of a business date.

What follows from the date alone (month bounds, the interest window's natural
days) is date arithmetic.  What depends on which days trade (first and last
trading day, their number, the day the interest window rolls back to) comes
from the ``calendar`` table and from nothing else: ``run_params`` reads one row
of it, once per business date, and the oracles take it from ``run_param``, a
statement of its own over the same table.

The business date of a session is its setting ``ledgerline.busi_date``; a session
without one takes ``LEDGERLINE_BUSI_DATE`` (yyyymmdd) of the process.  A session may
run any number of dates, one after the other (``set_busi_date``).
"""

from __future__ import annotations

import datetime as _dt
import os
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: the month that the adapter views model, unless the process names another date
BUSI_DATE = os.environ.get("LEDGERLINE_BUSI_DATE", "19970630")
CONF = "ledgerline.busi_date"


def _d(s: str) -> _dt.date:
    s = s.replace("-", "")
    return _dt.date(int(s[:4]), int(s[4:6]), int(s[6:8]))


def _ymd(d: _dt.date) -> str:
    return d.strftime("%Y%m%d")


def dashed(s: str | None) -> str | None:
    return s and f"{s[:4]}-{s[4:6]}-{s[6:]}"


def month_end(d: _dt.date) -> _dt.date:
    nxt = (d.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)
    return nxt - _dt.timedelta(days=1)


@dataclass(frozen=True)
class RunDates:
    """What date arithmetic gives."""

    busi_date: str            # yyyymmdd
    month_id: str             # yyyymm
    month_start: str          # yyyymmdd
    month_end: str            # natural month end, yyyymmdd
    prev_month_start: str
    prev_month_end: str
    interest_begin_nat: str   # 21st of previous month (natural day)
    interest_end: str         # 20th of this month

    @classmethod
    def of(cls, busi_date: str) -> "RunDates":
        b = _d(busi_date)
        ms = b.replace(day=1)
        pme = ms - _dt.timedelta(days=1)
        return cls(_ymd(b), b.strftime("%Y%m"), _ymd(ms), _ymd(month_end(b)), _ymd(pme.replace(day=1)), _ymd(pme),
                   _ymd(pme.replace(day=21)), _ymd(b.replace(day=20)))

    @property
    def prev_month_id(self) -> str:
        return self.prev_month_start[:6]

    @property
    def month_start_dash(self) -> str:
        return dashed(self.month_start)

    @property
    def month_end_dash(self) -> str:
        return dashed(self.month_end)

    @property
    def prev_month_start_dash(self) -> str:
        return dashed(self.prev_month_start)

    @property
    def prev_month_end_dash(self) -> str:
        return dashed(self.prev_month_end)


@dataclass(frozen=True)
class RunParams:
    """The dates of a run and what the calendar says of them (None and 0 where no day trades)."""

    dates: RunDates
    first_trade_day: str | None   # first trading day of the month (<= busi_date)
    last_trade_day: str | None    # last trading day of the month up to busi_date
    trade_days: int
    interest_begin: str | None    # 21st of previous month rolled back to a trading day

    def __getattr__(self, name: str):
        return getattr(object.__getattribute__(self, "dates"), name)

    @property
    def first_trade_dash(self) -> str | None:
        return dashed(self.first_trade_day)

    @property
    def last_trade_dash(self) -> str | None:
        return dashed(self.last_trade_day)


def params_of(calendar, busi_date: str) -> RunParams:
    """Read the parameters of ``busi_date`` off a calendar (``busi_date, trade_flag, nature_date``): one row."""
    d = RunDates.of(busi_date)
    day = F.col("busi_date")
    trades = F.when((F.col("trade_flag") == "1") & day.between(d.month_start, d.busi_date), day)
    r = calendar.filter(day.between(d.interest_begin_nat, d.busi_date)).agg(
        F.min(trades), F.max(trades), F.count(trades), F.max(F.when(day == d.interest_begin_nat, F.col("nature_date")))).first()
    return RunParams(d, r[0], r[1], r[2], r[3])


def busi_date_of(spark: SparkSession) -> str:
    return spark.conf.get(CONF, None) or BUSI_DATE


def set_busi_date(spark: SparkSession, busi_date: str | None) -> None:
    """Business date of everything that the session builds from now on (None: the process's)."""
    if busi_date is None:
        spark.conf.unset(CONF)
    else:
        RunDates.of(busi_date)
        spark.conf.set(CONF, busi_date)


_params: dict[tuple, RunParams] = {}


def run_params(spark: SparkSession) -> RunParams:
    """Parameters of the session's business date, from its ``calendar`` (kept per registered data set and date)."""
    from .sources.tables import session_key
    key = session_key(spark)
    if key not in _params:
        _params[key] = params_of(spark.table("calendar"), busi_date_of(spark))
    return _params[key]


def run_param_sql(busi_date: str) -> str:
    """The calendar's parameters once more, as a statement for the oracles."""
    d = RunDates.of(busi_date)
    month = f"trade_flag = '1' AND busi_date BETWEEN '{d.month_start}' AND '{d.busi_date}'"
    dash = "substr({0}, 1, 4) || '-' || substr({0}, 5, 2) || '-' || substr({0}, 7, 2)".format
    first, last = (f"(SELECT {f}(busi_date) FROM calendar WHERE {month})" for f in ("min", "max"))
    return f"""
SELECT {first} AS first_trade_day, {last} AS last_trade_day, {dash(first)} AS first_trade_dash, {dash(last)} AS last_trade_dash,
  (SELECT count(*) FROM calendar WHERE {month}) AS trade_days,
  (SELECT max(busi_date) FROM calendar WHERE trade_flag = '1' AND busi_date <= '{d.interest_begin_nat}') AS interest_begin"""


class _OracleParams:
    """Parameters in oracle statements: literals of the date, and scalar subqueries for what the calendar decides."""

    def __getattr__(self, name: str) -> str:
        if name in ("first_trade_day", "last_trade_day", "first_trade_dash", "last_trade_dash", "trade_days", "interest_begin"):
            return f"(SELECT {name} FROM run_param)"
        return getattr(_DATES, name)


_DATES = RunDates.of(BUSI_DATE)
#: for the text of oracle statements; plans use ``run_params(spark)``
P = _OracleParams()

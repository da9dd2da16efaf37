"""Adapter views: the broker warehouse modelled over the TPC-H-style test tables.

Every view is one SQL statement that Spark SQL and DuckDB both accept, so the
same text registers a Spark temp view and becomes a CTE of the DuckDB oracle.
The views only *derive* data from the given tables (no fixed sample inputs
except the short parameter lists at the bottom), so their size grows with the
scale factor.

Conventions (match the warehouse being modelled):
* dates are strings, ``yyyymmdd`` or dash form ``yyyy-mm-dd``;
* amounts are DOUBLE, rounded with plain IEEE double arithmetic
  (``floor(x * 10^n + 0.5) / 10^n``; sums over integer micro-units), so both
  engines compute bit-identical inputs;
* ids: account ``00000042`` (zero padded customer key), branch ``B07``
  (nation key), OA branch ``O3`` (region key), broker ``ZD000005`` /
  ``ST000006`` (supplier key, ``ZD`` staff for every fifth supplier).
"""

from __future__ import annotations

import re
from functools import cache

from ..params import BUSI_DATE, run_param_sql
from .dictionary import dictionary_sql

# ---------------------------------------------------------------- macros

def ACCT(x: str) -> str:
    return f"lpad(cast({x} as string), 8, '0')"


def BR(x: str) -> str:
    return f"concat('B', lpad(cast({x} as string), 2, '0'))"


def OA(x: str) -> str:
    return f"concat('O', cast({x} as string))"


def BROKER(x: str) -> str:
    return (f"concat(CASE WHEN {x} % 5 = 0 THEN 'ZD' ELSE 'ST' END, "
            f"lpad(cast({x} as string), 6, '0'))")


def DASH(ts: str) -> str:
    return f"cast(cast({ts} as date) as string)"


def YMD(ts: str) -> str:
    return f"replace(cast(cast({ts} as date) as string), '-', '')"


def R(x: str, n: int) -> str:
    """Round a DOUBLE expression to ``n`` digits with plain IEEE double
    arithmetic: both engines compute bit-identical values."""
    return f"(floor(({x}) * {10 ** n} + 0.5) / {10 ** n})"


def SUMR(x: str, n: int) -> str:
    """Sum of a DOUBLE expression rounded to ``n`` digits.  Rows are summed
    in integer micro-units, so the sum is exact and order independent."""
    return f"(floor(sum(floor(({x}) * 1000000 + 0.5)) / {10 ** (6 - n)} + 0.5) / {10 ** n})"


def RELA(x: str) -> str:
    return (f"CASE ({x}) % 5 WHEN 0 THEN '301' WHEN 1 THEN '001' "
            f"WHEN 2 THEN '002' WHEN 3 THEN '003' ELSE '009' END")


# Business calendar span: from two months before the first date of the dated
# tables to the end of the month after the last one, one row per natural day.
_FIRST = ("least((SELECT min(cast(o_orderdate as date)) FROM orders), "
          "(SELECT min(cast(l_shipdate as date)) FROM lineitem))")
_LAST = ("greatest((SELECT max(cast(o_orderdate as date)) FROM orders), "
         "(SELECT max(cast(l_shipdate as date)) FROM lineitem))")

# Exchange rebate columns (fixed values: the sixteen exchange fee columns of
# the rebate source table, in source order).
REBATE_COLUMNS = [
    "ret_fee_amt_tx", "ret_fee_amt_czce", "ret_fee_amt_dce", "ret_fee_amt_shfe",
    "ret_fee_amt_shfe1", "ret_fee_amt_cffex", "ret_fee_amt_cffex2021",
    "ret_fee_amt_cffex202206", "ret_fee_amt_dce1", "ret_fee_amt_dce2",
    "ret_fee_amt_dce11a", "ret_fee_amt_dce31", "ret_fee_amt_dce32",
    "ret_fee_amt_dce33", "ret_fee_amt_gfex", "ret_fee_amt_gfex2",
]

_LINE = ("lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
         "JOIN customer cu ON cu.c_custkey = o.o_custkey")


def _rebate_cols() -> str:
    out = []
    for k, c in enumerate(REBATE_COLUMNS):
        out.append(
            f"CASE WHEN l.l_suppkey % 16 = {k} THEN "
            f"{R('l.l_extendedprice * l.l_discount * 0.1', 4)} "
            f"ELSE 0 END AS {c}")
    return ",\n  ".join(out)


_IV_MEASURES = [  # (column, base, factor) for the monthly investor value
    ("soft_amt", "disc", "0.01"), ("subsistence_fee_amt", "disc", "0.2"),
    ("exchangeret_amt", "tax", "0.1"), ("calint_amt", "price", "0.0003"),
    ("oth_amt", "tax", "0.02"), ("broker_amt", "disc", "0.05"),
    ("broker_eret_amt", "tax", "0.03"), ("broker_int_amt", "price", "0.0001"),
    ("staff_amt", "disc", "0.04"), ("staff_eret_amt", "tax", "0.02"),
    ("staff_int_amt", "price", "0.00008"), ("i_oth_amt", "disc", "0.005"),
]


def _iv_cols() -> str:
    base = {
        "disc": "l.l_extendedprice * l.l_discount",
        "tax": "l.l_extendedprice * l.l_tax",
        "price": "l.l_extendedprice",
    }
    return ",\n  ".join(
        f"{SUMR(f'{base[b]} * {f}', 2)} AS {c}" for c, b, f in _IV_MEASURES)


# ---------------------------------------------------------------- views
# name -> SQL.  ``calendar`` has a per-dialect body (date series syntax).

#: Closed weekdays of every year (fixed values, month and day): the exchange's holidays of the model.  June 2 and
#: 30 close the first and the last weekday of the run month.
CLOSED_DAYS = ("0101", "0102", "0501", "0602", "0630", "1001", "1002", "1003")


def _trades(weekday_test: str) -> str:
    closed = ", ".join(f"'{d}'" for d in CLOSED_DAYS)
    return (f"CASE WHEN {weekday_test} AND substr(replace(cast(cal_date as string), '-', ''), 5, 4) NOT IN ({closed}) "
            "THEN '1' ELSE '0' END AS trade_flag")


CALENDAR_SPARK = f"""
SELECT replace(cast(cal_date as string), '-', '') AS busi_date, cal_date,
       {_trades('weekday(cal_date) < 5')},
       '1' AS market_no
FROM (SELECT explode(sequence(add_months(trunc(lo, 'MM'), -2), last_day(add_months(hi, 1)), INTERVAL 1 DAY)) AS cal_date
      FROM (SELECT {_FIRST} AS lo, {_LAST} AS hi) b) s
"""

CALENDAR_DUCK = f"""
SELECT replace(cast(cal_date as string), '-', '') AS busi_date, cal_date,
       {_trades('isodow(cal_date) <= 5')},
       '1' AS market_no
FROM (SELECT cast(unnest(generate_series(date_trunc('month', lo) - INTERVAL 2 MONTH,
                                         last_day(cast(hi + INTERVAL 1 MONTH as date)), INTERVAL 1 DAY)) as date) AS cal_date
      FROM (SELECT {_FIRST} AS lo, {_LAST} AS hi) b) s
"""

# The calendar with nature date = last trading day on or before each day.
# One ordered window over a bounded dimension (about 366 rows per year).
CALENDAR_NATURE = """
SELECT busi_date, cal_date, trade_flag, market_no,
       max(CASE WHEN trade_flag = '1' THEN busi_date END)
         OVER (ORDER BY busi_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nature_date
FROM calendar_base
"""

VIEWS: dict[str, str] = {
    "calendar": CALENDAR_NATURE,
    "date_nature": "SELECT busi_date AS n_busi_date, nature_date AS busi_date FROM calendar",
    "fund_account": f"""
SELECT {ACCT('c_custkey')} AS fund_account_id, {BR('c_nationkey')} AS branch_id,
       c_name AS client_name,
       CASE WHEN c_custkey % 10 = 0 THEN '3' ELSE '0' END AS isactive,
       CASE WHEN c_custkey % 10 = 0
            THEN replace(cast(DATE '1997-05-20' + cast(c_custkey % 60 as int) as string), '-', '')
       END AS close_date
FROM customer""",
    "branch": f"SELECT {BR('n_nationkey')} AS branch_id, n_name AS branch_name FROM nation",
    "dc_org": f"""
SELECT {BR('n_nationkey')} AS department_id,
       CASE WHEN n_nationkey % 7 = 0 THEN concat('SWHY', n_name) ELSE n_name END AS department_nam
FROM nation""",
    "mdp_dept00": f"SELECT {BR('n_nationkey')} AS chdeptcode FROM nation WHERE n_nationkey % 6 <> 5",
    "branch_oa_rela": f"""
SELECT {BR('n.n_nationkey')} AS ctp_branch_id, {OA('n.n_regionkey')} AS oa_branch_id,
       r.r_name AS oa_branch_name
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "oa_branch": f"""
SELECT {OA('r_regionkey')} AS departmentid,
       CASE WHEN r_regionkey % 2 = 0 THEN concat('SWHY', r_name) ELSE r_name END AS shortname
FROM region""",
    "dc_investor": f"""
SELECT {ACCT('c_custkey')} AS investor_id, {BR('c_nationkey')} AS orig_department_id,
       c_name AS investor_nam
FROM customer""",
    "crm_broker": f"""
SELECT {BROKER('s_suppkey')} AS broker_id, s_name AS broker_nam,
       {BR('s_nationkey')} AS department_id
FROM supplier""",
    # Every (customer, supplier) pair that ever traded is a relationship,
    # valid from the first order for a pair-dependent number of days.
    "crm_broker_investor_rela": f"""
SELECT {BROKER('p.l_suppkey')} AS broker_id, {ACCT('p.o_custkey')} AS investor_id,
       {RELA('p.o_custkey + p.l_suppkey')} AS broker_rela_typ,
       cast(p.first_dt as string) AS st_dt,
       cast(p.first_dt + cast((p.o_custkey * 7 + p.l_suppkey) % 1500 as int) as string) AS end_dt,
       CASE WHEN (p.o_custkey + p.l_suppkey) % 11 = 0 THEN 'X' ELSE 'A' END AS rela_sts,
       CASE WHEN (p.o_custkey + p.l_suppkey) % 4 = 0 THEN '2' ELSE '0' END AS approve_sts,
       CASE WHEN (p.o_custkey + p.l_suppkey) % 3 = 0 THEN NULL
            ELSE cast((p.o_custkey + p.l_suppkey) % 10 + 1 as double) / 10 END AS data_pct
FROM (SELECT o.o_custkey, l.l_suppkey, min(cast(o.o_orderdate as date)) AS first_dt
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      GROUP BY o.o_custkey, l.l_suppkey) p""",
    # Daily settlement: orders of a customer on a trading day (weekend
    # orders roll back to Friday).
    "client_sett": f"""
SELECT c.nature_date AS busi_date, {ACCT('o.o_custkey')} AS fund_account_id,
       {SUMR("o.o_totalprice", 2)} AS rights,
       {SUMR("o.o_totalprice * 0.9", 2)} AS yes_rights,
       CASE WHEN o.o_custkey % 4 = 0 THEN NULL
            ELSE {SUMR("o.o_totalprice * 0.3", 2)} END AS impawn_money,
       CASE WHEN o.o_custkey % 9 = 0 THEN NULL
            ELSE {SUMR("o.o_totalprice * 0.25", 2)} END AS market_margin,
       {SUMR("o.o_totalprice * 0.01", 2)} AS hold_profit,
       {SUMR("o.o_totalprice * 0.02", 2)} AS close_profit,
       {SUMR("o.o_totalprice * 0.001", 2)} AS transfee,
       {SUMR("o.o_totalprice * 0.0002", 2)} AS delivery_transfee,
       {SUMR("o.o_totalprice * 0.0001", 2)} AS strikefee,
       {SUMR("o.o_totalprice * 0.0006", 2)} AS market_transfee,
       {SUMR("o.o_totalprice * 0.00012", 2)} AS market_delivery_transfee,
       {SUMR("o.o_totalprice * 0.00006", 2)} AS market_strikefee
FROM orders o JOIN calendar c ON c.busi_date = {YMD('o.o_orderdate')}
WHERE c.nature_date IS NOT NULL
GROUP BY c.nature_date, o.o_custkey""",
    "hold_balance": f"""
SELECT c.nature_date AS busi_date, {BR('cu.c_nationkey')} AS branch_id,
       {ACCT('o.o_custkey')} AS fund_account_id,
       l.l_quantity AS done_amt, l.l_extendedprice AS done_sum
FROM {_LINE} JOIN calendar c ON c.busi_date = {YMD('l.l_shipdate')}
WHERE c.nature_date IS NOT NULL""",
    "exchange_retfee2": f"""
SELECT {DASH('l.l_shipdate')} AS tx_dt, {ACCT('o.o_custkey')} AS investor_id,
       {BR('cu.c_nationkey')} AS orig_department_id,
       {R('l.l_extendedprice * l.l_tax * 0.01', 2)} AS exchange_txfee_amt,
  {_rebate_cols()},
       {R('l.l_extendedprice * 0.001', 4)} AS investor_ret_amt
FROM {_LINE}""",
    "fund_jour": f"""
SELECT replace(cast(DATE '1997-06-01' + cast(extract(day from ts) - 1 as int) as string), '-', '') AS busi_date,
       {ACCT('user_id')} AS fund_account_id,
       CASE WHEN event_type = 'error' THEN '2' ELSE '1' END AS fund_direct,
       CASE event_type WHEN 'purchase' THEN 'A031' WHEN 'click' THEN 'A032' ELSE 'A099' END AS fund_projectid,
       CASE WHEN event_type = 'signup' THEN '3' ELSE '1' END AS fund_type,
       value AS occur_money
FROM events""",
    "adm_cust_01": f"""
SELECT {DASH('l.l_shipdate')} AS tx_dt, {ACCT('o.o_custkey')} AS investor_id,
       {R('l.l_extendedprice * l.l_discount * 0.05', 4)} AS subsistence_fee_amt,
       CASE WHEN l.l_linenumber = 7 THEN NULL
            ELSE {R('l.l_extendedprice * l.l_tax * 0.02', 4)} END AS fd_amt,
       CASE WHEN l.l_returnflag = 'R' THEN {R('l.l_extendedprice * 0.001', 4)} ELSE 0 END AS return_amt,
       CASE WHEN l.l_linestatus = 'F' THEN NULL
            ELSE {R('l.l_extendedprice * 0.0005', 4)} END AS soft_amt
FROM {_LINE}""",
    "adm_investor_value": f"""
SELECT concat(substr({DASH('l.l_shipdate')}, 1, 7), '-01') AS date_dt,
       {ACCT('o.o_custkey')} AS investor_id,
  {_iv_cols()}
FROM {_LINE}
GROUP BY concat(substr({DASH('l.l_shipdate')}, 1, 7), '-01'), o.o_custkey""",
    "adm_brokerdata_detail": f"""
SELECT concat(substr({DASH('l.l_shipdate')}, 1, 7), '-01') AS tx_dt,
       {ACCT('o.o_custkey')} AS investor_id,
       CASE WHEN l.l_suppkey % 7 = 0 THEN 'D' ELSE 'M' END AS rec_freq,
       {BROKER('l.l_suppkey')} AS staff_id,
       {RELA('o.o_custkey + l.l_suppkey')} AS srela_typ,
       {SUMR("l.l_extendedprice * l.l_discount * 0.03", 2)} AS ib_amt,
       CASE WHEN (o.o_custkey + l.l_suppkey) % 4 = 0 THEN NULL
            ELSE {SUMR("l.l_extendedprice * 0.00005", 2)} END AS staff_int_amt
FROM {_LINE}
GROUP BY concat(substr({DASH('l.l_shipdate')}, 1, 7), '-01'), o.o_custkey, l.l_suppkey""",
    # Daily client report by natural day.
    "rpt_06008": f"""
SELECT {YMD('l.l_shipdate')} AS n_busi_date, {BR('cu.c_nationkey')} AS branch_id,
       {ACCT('o.o_custkey')} AS fund_account_id,
       {SUMR("l.l_extendedprice", 2)} AS rights,
       {SUMR("l.l_extendedprice * 0.95", 2)} AS yes_rights,
       {SUMR("l.l_extendedprice * l.l_discount * 0.02", 2)} AS remain_transfee,
       sum(l.l_quantity) AS done_amount,
       {SUMR("l.l_extendedprice", 2)} AS done_money,
       max(c.trade_flag) AS trade_flag
FROM {_LINE} JOIN calendar c ON c.busi_date = {YMD('l.l_shipdate')}
GROUP BY {YMD('l.l_shipdate')}, cu.c_nationkey, o.o_custkey""",
    # ---- business rule tables (derived from customer / supplier attributes)
    # IB collaboration: relationships of machinery clients with IB staff;
    # the service name is the broker's name (matched against the ledger).
    "t00107": f"""
SELECT DISTINCT b.broker_nam AS futu_service_name, r.investor_id AS fund_account_id,
       {OA('cast(substr(r.investor_id, 7, 2) as int) % 5')} AS ib_branch_id,
       concat('IB office ', cast(cast(substr(r.investor_id, 7, 2) as int) % 5 as string)) AS ib_branch_name,
       CASE cast(substr(r.investor_id, 5, 4) as int) % 4 WHEN 0 THEN NULL WHEN 1 THEN 0
            ELSE cast(cast(substr(r.investor_id, 5, 4) as int) % 50 as double) / 100 END AS coope_income_reate
FROM crm_broker_investor_rela r JOIN crm_broker b ON r.broker_id = b.broker_id
JOIN customer c ON c.c_custkey = cast(r.investor_id as bigint)
WHERE c.c_mktsegment = 'MACHINERY' AND r.broker_id LIKE 'ZD%'""",
    "t00110": f"""
SELECT {BROKER('s_suppkey')} AS broker_id, {OA('s_nationkey % 5')} AS broker_branch_id,
       concat('Office ', cast(s_nationkey % 5 as string)) AS broker_branch_name
FROM supplier WHERE s_acctbal > 0""",
    # Department reallocation rules: one rule per automobile client, plus a
    # second (partly expired) rule for every third of them.
    "t00114": f"""
SELECT {ACCT('c_custkey')} AS fund_account_id,
       CASE c_custkey % 3 WHEN 0 THEN '19970101' WHEN 1 THEN '19970610' ELSE '19960101' END AS begin_date,
       CASE c_custkey % 3 WHEN 0 THEN '19991231' WHEN 1 THEN '19970620' ELSE '19970531' END AS end_date,
       cast(c_custkey % 7 + 1 as double) / 10 AS fund_rate,
       cast(c_custkey % 5 + 1 as double) / 10 AS rights_rate,
       cast(c_custkey % 3 + 1 as double) / 10 AS done_rate,
       {OA('c_nationkey % 5')} AS out_oa_branch_id, concat('Out ', cast(c_nationkey % 5 as string)) AS out_oa_branch_name,
       {OA('(c_nationkey + 1) % 5')} AS in_oa_branch_id, concat('In ', cast((c_nationkey + 1) % 5 as string)) AS in_oa_branch_name
FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
UNION ALL
SELECT {ACCT('c_custkey')} AS fund_account_id, '19970615' AS begin_date, '19970625' AS end_date,
       cast(0.05 as double) AS fund_rate, cast(0.05 as double) AS rights_rate, cast(0.05 as double) AS done_rate,
       {OA('(c_nationkey + 2) % 5')} AS out_oa_branch_id, concat('Out ', cast((c_nationkey + 2) % 5 as string)) AS out_oa_branch_name,
       {OA('(c_nationkey + 4) % 5')} AS in_oa_branch_id, concat('In ', cast((c_nationkey + 4) % 5 as string)) AS in_oa_branch_name
FROM customer WHERE c_mktsegment = 'AUTOMOBILE' AND c_custkey % 3 = 0""",
    "t00122": f"""
SELECT '199706' AS busi_month, {ACCT('o.o_custkey')} AS client_id, cu.c_name AS client_name,
       concat('138', lpad(cast(o.o_custkey as string), 8, '0')) AS mobile,
       concat('CT', cast(o.o_orderkey as string)) AS contract_number,
       concat('Advisory ', o.o_orderstatus) AS product_name, o.o_orderpriority AS product_type,
       cast(o.o_orderkey % 5 + 1 as string) AS product_risk_level,
       CASE o.o_custkey % 5 WHEN 0 THEN '3' WHEN 1 THEN '1,2,3' WHEN 2 THEN '2,9' WHEN 3 THEN NULL ELSE '4,1,5' END AS client_risk_level,
       {YMD('o.o_orderdate')} AS contract_begin_date,
       replace(cast(cast(o.o_orderdate as date) + 365 as string), '-', '') AS contract_end_date,
       {YMD('o.o_orderdate')} AS collection_time,
       {R('o.o_totalprice * 0.01', 2)} AS invest_total_service_fee,
       cast(o.o_orderkey % 4 + 2 as double) / 10 AS kernel_total_rate,
       cast(o.o_orderkey % 3 + 1 as double) / 10 AS perfor_total_rate
FROM orders o JOIN customer cu ON cu.c_custkey = o.o_custkey
WHERE o.o_orderpriority = '1-URGENT'""",
    "t00153": f"""
SELECT {ACCT('c_custkey')} AS client_id, c_name AS client_name,
       CASE WHEN c_custkey % 2 = 0 THEN '19970101' ELSE '19970615' END AS begin_date,
       CASE WHEN c_custkey % 3 = 0 THEN '19970610' ELSE '20001231' END AS end_date,
       {BR('c_nationkey')} AS branch_id, {OA('(c_nationkey + 2) % 5')} AS coll_branch_id,
       cast(c_custkey % 4 + 1 as double) / 10 AS remain_rate,
       cast(c_custkey % 3 + 2 as double) / 10 AS jm_rate
FROM customer WHERE c_mktsegment = 'FURNITURE' AND c_acctbal > 0""",
    "t00207": f"""
SELECT {YMD('o.o_orderdate')} AS add_date, {ACCT('o.o_custkey')} AS client_id, cu.c_name AS client_name,
       {YMD('o.o_orderdate')} AS open_date, {BR('cu.c_nationkey')} AS branch_id,
       concat('NATION_', cast(cu.c_nationkey as string)) AS branch_name,
       {BROKER('o.o_orderkey % 100')} AS introductor_id, concat('Introducer ', cast(o.o_orderkey % 100 as string)) AS introductor,
       {YMD('o.o_orderdate')} AS trade_begin_date, cast(o.o_orderkey % 9 + 1 as double) AS trade_orders,
       {R('o.o_totalprice * 0.02', 2)} AS premium_abs,
       {R('o.o_totalprice * 1.5', 2)} AS actual_notional_principal,
       {R('o.o_totalprice * 0.003', 2)} AS sale_income,
       {R('o.o_totalprice * 0.001', 2)} AS colla_pricing,
       {R('o.o_totalprice * 0.004', 2)} AS total_income
FROM orders o JOIN customer cu ON cu.c_custkey = o.o_custkey
WHERE o.o_orderpriority = '2-HIGH'""",
    # Consulting allocations per (month, client, product): kernel split to
    # two OA branches, performance split to two branches x brokers.
    "t00122_1": f"""
SELECT busi_month, client_id, product_name, 'primary' AS alloca_oa_branch_type,
       {OA('cast(client_id as bigint) % 5')} AS alloca_oa_branch_id,
       concat('Branch ', cast(cast(client_id as bigint) % 5 as string)) AS alloca_oa_branch_name, cast(0.6 as double) AS alloca_kernel_rate
FROM (SELECT DISTINCT busi_month, client_id, product_name FROM t00122) k
UNION ALL
SELECT busi_month, client_id, product_name, 'secondary' AS alloca_oa_branch_type,
       {OA('(cast(client_id as bigint) + 1) % 5')} AS alloca_oa_branch_id,
       concat('Branch ', cast((cast(client_id as bigint) + 1) % 5 as string)) AS alloca_oa_branch_name, cast(0.4 as double) AS alloca_kernel_rate
FROM (SELECT DISTINCT busi_month, client_id, product_name FROM t00122) k""",
    "t00122_2": f"""
SELECT busi_month, client_id, product_name, 'primary' AS alloca_oa_branch_type,
       {OA('cast(client_id as bigint) % 5')} AS alloca_oa_branch_id,
       concat('Branch ', cast(cast(client_id as bigint) % 5 as string)) AS alloca_oa_branch_name,
       cast(0.7 as double) AS alloca_perfor_rate, {BROKER('cast(client_id as bigint) % 97')} AS broker_id,
       concat('Broker ', cast(cast(client_id as bigint) % 97 as string)) AS broker_name, cast(0.5 as double) AS broker_perfor_rate
FROM (SELECT DISTINCT busi_month, client_id, product_name FROM t00122) k
UNION ALL
SELECT busi_month, client_id, product_name, 'primary' AS alloca_oa_branch_type,
       {OA('cast(client_id as bigint) % 5')} AS alloca_oa_branch_id,
       concat('Branch ', cast(cast(client_id as bigint) % 5 as string)) AS alloca_oa_branch_name,
       cast(0.3 as double) AS alloca_perfor_rate, {BROKER('cast(client_id as bigint) % 89')} AS broker_id,
       concat('Broker ', cast(cast(client_id as bigint) % 89 as string)) AS broker_name, cast(0.25 as double) AS broker_perfor_rate
FROM (SELECT DISTINCT busi_month, client_id, product_name FROM t00122) k""",
    # Asset-management product rights per shipment day, by part brand and
    # the supplier's region office (some offices unmatched).
    "t00203": f"""
SELECT {YMD('l.l_shipdate')} AS busi_date, p.p_brand AS product_name,
       CASE WHEN s.s_suppkey % 9 = 0 THEN 'UNMAPPED'
            WHEN n.n_regionkey % 2 = 0 THEN concat('SWHY', r.r_name) ELSE r.r_name END AS broker_branch,
       {R('l.l_extendedprice * 0.1', 2)} AS broker_rights
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    # Rule windows per CTP branch for the other-product job.
    "t00305": f"""
SELECT concat('R', lpad(cast(n_nationkey as string), 2, '0')) AS pk_id, 'OP02' AS adjust_proj_id,
       'Branch rule product' AS adjust_proj, {BR('n_nationkey')} AS src_branch_id, n_name AS src_branch_name,
       {OA('(n_regionkey + 1) % 5')} AS branch_id, concat('Branch ', cast((n_regionkey + 1) % 5 as string)) AS branch_name,
       concat('AS', cast(n_nationkey % 3 as string)) AS assignee_id, concat('Assignee ', cast(n_nationkey % 3 as string)) AS assignee,
       concat('0', cast(n_nationkey % 6 + 1 as string)) AS index_id, 'rule index' AS index_name,
       cast(n_nationkey % 4 + 1 as double) / 10 AS adjust_rate,
       replace(cast(DATE '1997-05-25' + cast(n_nationkey % 12 as int) as string), '-', '') AS begin_date,
       replace(cast(DATE '1997-06-12' + cast(n_nationkey % 25 as int) as string), '-', '') AS end_date
FROM nation""",
    # Other products: monthly branch totals and their sharing rules.
    "t00308": f"""
SELECT substr(r.n_busi_date, 1, 6) AS month_id, 'OP01' AS adjust_proj_id, 'Other product' AS adjust_proj,
       r.branch_id AS src_branch_id, b.branch_name AS src_branch_name,
       {SUMR("r.rights / 30", 2)} AS avg_rights,
       {SUMR("r.rights * 0.5", 2)} AS end_rights,
       {SUMR("r.yes_rights * 0.4", 2)} AS begin_rights,
       sum(r.done_amount) AS done_amount, {SUMR("r.done_money", 2)} AS done_money,
       {SUMR("r.remain_transfee", 2)} AS remain_transfee
FROM rpt_06008 r JOIN branch b ON r.branch_id = b.branch_id
GROUP BY substr(r.n_busi_date, 1, 6), r.branch_id, b.branch_name""",
    "t00309": f"""
SELECT k.month_id, k.adjust_proj_id, k.src_branch_id, {OA('cast(substr(k.src_branch_id, 2, 2) as int) % 5')} AS branch_id,
       concat('Branch ', cast(cast(substr(k.src_branch_id, 2, 2) as int) % 5 as string)) AS branch_name,
       'AS1' AS assignee_id, 'Assignee 1' AS assignee, cast(0.6 as double) AS rights_rate, cast(0.5 as double) AS done_rate, cast(0.3 as double) AS income_rate
FROM (SELECT DISTINCT month_id, adjust_proj_id, src_branch_id FROM t00308) k
WHERE cast(substr(k.src_branch_id, 2, 2) as int) % 4 <> 0
UNION ALL
SELECT k.month_id, k.adjust_proj_id, k.src_branch_id, {OA('(cast(substr(k.src_branch_id, 2, 2) as int) + 2) % 5')} AS branch_id,
       concat('Branch ', cast((cast(substr(k.src_branch_id, 2, 2) as int) + 2) % 5 as string)) AS branch_name,
       'AS2' AS assignee_id, 'Assignee 2' AS assignee, cast(0.4 as double) AS rights_rate, cast(0.5 as double) AS done_rate, cast(0.7 as double) AS income_rate
FROM (SELECT DISTINCT month_id, adjust_proj_id, src_branch_id FROM t00308) k
WHERE cast(substr(k.src_branch_id, 2, 2) as int) % 4 <> 0""",
    # ---- parameter tables (fixed values: short literal lists)
    # fee types: 1001 interest, 1002 risk fund, 1003 protection fund,
    # 1004 VAT, 1005 VAT + surtax, 1006 surtax.  Two periods split at
    # 1997-06-15; region O4 has no rate (default-0 path).
    "rate_param": """
SELECT fee_type, branch_id, begin_date, end_date, cast(para_value as double) AS para_value FROM (VALUES
  ('1001', 'O0,O1,O2', '19950101', '19970614', 0.0035),
  ('1001', 'O0,O1,O2', '19970615', '20011231', 0.0030),
  ('1001', 'O3', '19950101', '20011231', 0.0040),
  ('1002', 'O0,O1,O2', '19950101', '19970614', 0.05),
  ('1002', 'O0,O1,O2', '19970615', '20011231', 0.06),
  ('1002', 'O3', '19950101', '20011231', 0.04),
  ('1003', 'O0,O1,O2', '19950101', '19970614', 0.0002),
  ('1003', 'O0,O1,O2', '19970615', '20011231', 0.00025),
  ('1003', 'O3', '19950101', '20011231', 0.0003),
  ('1004', 'O0,O1,O2', '19950101', '19970614', 0.06),
  ('1004', 'O0,O1,O2', '19970615', '20011231', 0.09),
  ('1004', 'O3', '19950101', '20011231', 0.13),
  ('1005', 'O0,O1,O2', '19950101', '19970614', 0.066),
  ('1005', 'O0,O1,O2', '19970615', '20011231', 0.072),
  ('1005', 'O3', '19950101', '20011231', 0.0672),
  ('1006', 'O0,O1,O2', '19950101', '19970614', 0.12),
  ('1006', 'O0,O1,O2', '19970615', '20011231', 0.07),
  ('1006', 'O3', '19950101', '20011231', 0.1)
) AS t(fee_type, branch_id, begin_date, end_date, para_value)""",
    # company-wide rates of the posting jobs: no branch; 1005 has two rows
    # valid at once, 1006 an expired one
    "run_rate": """
SELECT fee_type, branch_id, begin_date, end_date, cast(para_value as double) AS para_value FROM (VALUES
  ('1002', 'O0,O1,O2,O3,O4', '19950101', '20011231', 0.06),
  ('1004', 'O0,O1,O2,O3,O4', '19950101', '20011231', 0.09),
  ('1005', 'O0,O1,O2', '19950101', '20011231', 0.072),
  ('1005', 'O3,O4', '19970601', '20011231', 0.0672),
  ('1006', 'O0,O1,O2,O3,O4', '19950101', '19970614', 0.12),
  ('1006', 'O0,O1,O2,O3,O4', '19970615', '20011231', 0.07)
) AS t(fee_type, branch_id, begin_date, end_date, para_value)""",
    "acount_func_rela": """
SELECT func_id, func_name, traceability_dept_id, traceability_dept, account_code, account_name FROM (VALUES
  ('P_IB_COLLAB', 'IB collaboration', 'T01', 'IB department', '6011', 'interest income'),
  ('P_IB_COLLAB', 'IB collaboration', 'T01', 'IB department', '6021', 'fee income'),
  ('P_IB_COLLAB', 'IB collaboration', 'T01', 'IB department', '6111', 'investment income'),
  ('P_IB_COLLAB', 'IB collaboration', 'T01', 'IB department', '6403', 'taxes and surcharges'),
  ('P_IB_COLLAB', 'IB collaboration', 'T01', 'IB department', '6999', 'unmapped'),
  ('P_IB_OFFICE', 'IB office', 'T02', 'Brokerage', '6011', 'interest income'),
  ('P_IB_OFFICE', 'IB office', 'T02', 'Brokerage', '6021', 'fee income'),
  ('P_IB_OFFICE', 'IB office', 'T02', 'Brokerage', '6111', 'investment income'),
  ('P_IB_OFFICE', 'IB office', 'T02', 'Brokerage', '6403', 'taxes and surcharges'),
  ('P_OTC', 'OTC options', 'T03', 'Derivatives', '6051', 'other business income'),
  ('P_OTC', 'OTC options', 'T03', 'Derivatives', '6403', 'taxes and surcharges'),
  ('P_OTC', 'OTC options', 'T03', 'Derivatives', '6999', 'unmapped'),
  ('P_SPECIAL', 'Special clients', 'T04', 'Wealth', '6021', 'fee income'),
  ('P_SPECIAL', 'Special clients', 'T04', 'Wealth', '6111', 'investment income'),
  ('P_SPECIAL', 'Special clients', 'T04', 'Wealth', '6403', 'taxes and surcharges'),
  ('P_SPECIAL', 'Special clients', 'T04', 'Wealth', '660199', 'other costs'),
  ('P_INSURANCE', 'Insurance fund', 'T05', 'Finance', '640201', 'protection fund'),
  ('P_INSURANCE', 'Insurance fund', 'T05', 'Finance', '640202', 'protection fund adj'),
  ('P_CONSULTING', 'Consulting', 'T06', 'Research', '6021', 'fee income'),
  ('P_CONSULTING', 'Consulting', 'T06', 'Research', '6403', 'taxes and surcharges'),
  ('P_DEPT', 'Department adjustments', 'T07', 'Operations', '6021', 'fee income'),
  ('P_DEPT', 'Department adjustments', 'T07', 'Operations', '6403', 'taxes and surcharges'),
  ('P_DEPT', 'Department adjustments', 'T07', 'Operations', '660199', 'other costs')
) AS t(func_id, func_name, traceability_dept_id, traceability_dept, account_code, account_name)""",
    "proj_index_rela": """
SELECT adjust_proj_id, adjust_proj, src_branch_id, src_branch_name, index_id, index_name FROM (VALUES
  ('A01', 'Department reallocation', 'SRC', 'source', '01', 'average rights'),
  ('A01', 'Department reallocation', 'SRC', 'source', '02', 'closing rights'),
  ('A01', 'Department reallocation', 'SRC', 'source', '03', 'opening rights'),
  ('A01', 'Department reallocation', 'SRC', 'source', '04', 'turnover lots'),
  ('A01', 'Department reallocation', 'SRC', 'source', '05', 'turnover money'),
  ('A01', 'Department reallocation', 'SRC', 'source', '06', 'retained fee'),
  ('A02', 'IB office', 'SRC', 'source', '01', 'average rights'),
  ('A02', 'IB office', 'SRC', 'source', '02', 'closing rights'),
  ('A02', 'IB office', 'SRC', 'source', '03', 'opening rights'),
  ('A02', 'IB office', 'SRC', 'source', '06', 'retained fee'),
  ('A03', 'IB collaboration', 'SRC', 'source', '01', 'average rights'),
  ('A03', 'IB collaboration', 'SRC', 'source', '03', 'opening rights'),
  ('A03', 'IB collaboration', 'SRC', 'source', '05', 'turnover money')
) AS t(adjust_proj_id, adjust_proj, src_branch_id, src_branch_name, index_id, index_name)
UNION ALL
SELECT DISTINCT concat('JOB_ASSET_PRODUCT_01_', substr(p_brand, 7, 2)) AS adjust_proj_id, p_brand AS adjust_proj,
       'AM' AS src_branch_id, 'Asset management' AS src_branch_name, '01' AS index_id, 'product rights' AS index_name
FROM part WHERE p_size > 5""",
    "dictionary": dictionary_sql(),
}

#: Dated fact tables: their date column (either spelling) and a column that spreads the rows of a day.
FACTS = {"client_sett": ("busi_date", "fund_account_id"), "hold_balance": ("busi_date", "fund_account_id"),
         "exchange_retfee2": ("tx_dt", "investor_id"), "fund_jour": ("busi_date", "fund_account_id"),
         "adm_cust_01": ("tx_dt", "investor_id"), "adm_investor_value": ("date_dt", "investor_id"),
         "adm_brokerdata_detail": ("tx_dt", "investor_id"), "rpt_06008": ("n_busi_date", "fund_account_id"),
         "t00207": ("add_date", "client_id"), "t00203": ("busi_date", "product_name")}

RAW_TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
              "lineitem", "events"]


def _deps(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b{re.escape(n)}\b", sql)]


def _oracle_bodies() -> dict[str, str]:
    """Statements of the oracles' views: the calendar in DuckDB's words, and the run parameters it decides."""
    return dict(VIEWS, calendar_base=CALENDAR_DUCK, run_param=run_param_sql(BUSI_DATE))


def needed_views(sql: str) -> list[str]:
    """Adapter views a statement uses, transitively, in definition order."""
    bodies = _oracle_bodies()
    names = list(bodies)
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in _deps(bodies[n], names):
            if d != n:
                visit(d)
        seen.append(n)

    for n in _deps(sql, names):
        visit(n)
    return seen


def with_clause(sql: str) -> str:
    """Prefix ``sql`` with the CTEs of every adapter view it reads (DuckDB)."""
    views = needed_views(sql)
    if not views:
        return sql
    bodies = _oracle_bodies()
    ctes = ",\n".join(f"{v} AS ({bodies[v].strip()})" for v in views)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


#: For Spark, the fact that is dated by the calendar meets it first: a span of days keeps few lines, and only those meet their orders.
_DATED_LINE = f"{_LINE} JOIN calendar c ON c.busi_date = {YMD('l.l_shipdate')}"
_LINE_DATED = _DATED_LINE.replace("lineitem l JOIN", f"lineitem l JOIN calendar c ON c.busi_date = {YMD('l.l_shipdate')} JOIN", 1) \
    .removesuffix(f" JOIN calendar c ON c.busi_date = {YMD('l.l_shipdate')}")


def spark_body(name: str) -> str:
    """The statement of an adapter view for Spark: the oracle's, but for the calendar's series and the order of joins."""
    return CALENDAR_SPARK if name == "calendar_base" else VIEWS[name].replace(_DATED_LINE, _LINE_DATED)


@cache
def reads(name: str) -> tuple[str, ...]:
    """The adapter views that a view's statement names."""
    return tuple(d for d in _deps(spark_body(name), [*VIEWS, "calendar_base"]) if d != name)


def view_levels() -> list[list[str]]:
    """Adapter view names grouped so each group only reads earlier groups."""
    names = [*VIEWS, "calendar_base"]
    deps = {n: reads(n) for n in names}
    level: dict[str, int] = {}

    def lv(n: str) -> int:
        if n not in level:
            level[n] = 1 + max((lv(d) for d in deps[n]), default=-1)
        return level[n]

    for n in names:
        lv(n)
    out: list[list[str]] = [[] for _ in range(max(level.values()) + 1)]
    for n in names:
        out[level[n]].append(n)
    return out

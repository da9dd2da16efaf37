"""Downstream adjustment jobs.

Jobs that read the ledger read it as the written ``client_revenue`` table
(``ledger_table``), exactly as the monthly run hands it over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..params import P, run_params
from ..sources.dictionary import code_map
from ..sources.tables import block, dated
from .basic import EXCLUDED
from .ledger import LEDGER_SQL, ledger_table, rnd, rounded, rounded_sql
from .registry import query

M0, ME, LT, FT = P.month_start, P.month_end, P.last_trade_day, P.first_trade_day
LEDGER = f"({LEDGER_SQL})"

# ----------------------------------------------------------- B19 / J12 dept reallocation

DEPT_COLS = ["end_rights", "remain_transfee", "done_amount", "done_money", "fund_rate", "rights_rate",
             "done_rate", "allocat_end_rights", "allocat_remain_transfee", "allocat_done_amount",
             "allocat_done_money"]


@block
def dept_daily_between(spark, first: str, last: str) -> DataFrame:
    """Client day facts of every trading day from ``first`` to ``last`` x rules valid that day.

    One job covers any number of days (the original runs once per day).
    """
    cal = spark.table("calendar").filter((F.col("trade_flag") == "1") & F.col("busi_date").between(first, last))
    t = dated(spark, "rpt_06008", first, last).join(cal.select(F.col("busi_date").alias("n_busi_date")), "n_busi_date")
    a = spark.table("t00114")
    b = spark.table("fund_account").select("fund_account_id", "client_name")
    # Key + date-in-validity join
    return (t.join(a.select("fund_account_id", "begin_date", "end_date"),
                   (t.fund_account_id == a.fund_account_id) & t.n_busi_date.between(a.begin_date, a.end_date))
            .drop(a.fund_account_id).join(b, "fund_account_id")
            .select(F.col("n_busi_date").alias("busi_date"), "fund_account_id", "client_name",
                    F.col("rights").alias("end_rights"), "remain_transfee", "done_amount", "done_money"))


def dept_daily_df(spark) -> DataFrame:
    p = run_params(spark)
    return dept_daily_between(spark, p.month_start, p.busi_date)


DEPT_DAILY_SQL = f"""(SELECT t.n_busi_date AS busi_date, t.fund_account_id, b.client_name, t.rights AS end_rights,
  t.remain_transfee, t.done_amount, t.done_money
FROM rpt_06008 t
JOIN calendar c ON c.busi_date = t.n_busi_date AND c.trade_flag = '1'
JOIN t00114 a ON t.fund_account_id = a.fund_account_id AND t.n_busi_date BETWEEN a.begin_date AND a.end_date
JOIN fund_account b ON a.fund_account_id = b.fund_account_id
WHERE t.n_busi_date BETWEEN '{M0}' AND {LT})"""


def dept_reallocation_df(spark) -> DataFrame:
    """B19 for the run month up to the business date."""
    return reallocated(spark, dept_daily_df(spark))


def reallocated(spark, days: DataFrame, dated_rules: bool = False) -> DataFrame:
    """Day facts re-joined to *all* rules of the account (J12, undated, as written).

    ``dated_rules`` keeps only the rules that hold on the fact's own day (V19).
    """
    a = spark.table("t00114")
    j = days.join(a, "fund_account_id")
    if dated_rules:
        j = j.filter(F.col("busi_date").between(F.col("begin_date"), F.col("end_date")))
    return j.select("busi_date", "fund_account_id", "client_name", "end_rights", "remain_transfee", "done_amount",
                    "done_money", "fund_rate", "rights_rate", "done_rate", "out_oa_branch_id",
                    "out_oa_branch_name", "in_oa_branch_id", "in_oa_branch_name",
                    (F.col("end_rights") * F.col("rights_rate")).alias("allocat_end_rights"),
                    (F.col("remain_transfee") * F.col("fund_rate")).alias("allocat_remain_transfee"),
                    (F.col("done_amount") * F.col("done_rate")).alias("allocat_done_amount"),
                    (F.col("done_money") * F.col("done_rate")).alias("allocat_done_money"))


DEPT_SQL = f"""(SELECT t.busi_date, t.fund_account_id, t.client_name, t.end_rights, t.remain_transfee, t.done_amount,
  t.done_money, a.fund_rate, a.rights_rate, a.done_rate, a.out_oa_branch_id, a.out_oa_branch_name,
  a.in_oa_branch_id, a.in_oa_branch_name,
  t.end_rights * a.rights_rate AS allocat_end_rights, t.remain_transfee * a.fund_rate AS allocat_remain_transfee,
  t.done_amount * a.done_rate AS allocat_done_amount, t.done_money * a.done_rate AS allocat_done_money
FROM {DEPT_DAILY_SQL} t JOIN t00114 a ON t.fund_account_id = a.fund_account_id)"""

_DEPT_KEYS = ("busi_date", "fund_account_id", "client_name", "out_oa_branch_id", "out_oa_branch_name",
              "in_oa_branch_id", "in_oa_branch_name")


@query("dept_reallocation", rounded_sql(DEPT_COLS, f"{DEPT_SQL} d", {c: 4 for c in DEPT_COLS}, keys=_DEPT_KEYS))
def dept_reallocation(spark):
    """Daily department reallocation for every trading day of the month."""
    return rounded(dept_reallocation_df(spark), default=4)


@query("rule_rejoin", f"""
SELECT t.fund_account_id, t.busi_date, count(*) AS n_rules
FROM {DEPT_DAILY_SQL} t JOIN t00114 a ON t.fund_account_id = a.fund_account_id
GROUP BY t.fund_account_id, t.busi_date""")
def rule_rejoin(spark):
    """Rejoin to the rule table without the date bound (fan-out per rule)."""
    t = dept_daily_df(spark)
    a = spark.table("t00114").select("fund_account_id")
    return t.join(a, "fund_account_id").groupBy("fund_account_id", "busi_date").agg(F.count(F.lit(1)).alias("n_rules"))


# ----------------------------------------------------------- B20 consulting

_CONS_KEYS = ["busi_month", "client_id", "product_name"]


@block
def consulting_kernel_df(spark) -> DataFrame:
    p = run_params(spark)
    t = spark.table("t00122").filter(F.col("busi_month") == p.month_id)
    t = t.withColumn("risk_labels", code_map(spark.table("dictionary"), "report.wh_risk_level"))
    a = spark.table("t00122_1")
    j = t.join(a, _CONS_KEYS, "left")
    return j.select(F.col("busi_month").alias("month_id"), "client_id", "client_name", "mobile", "contract_number",
                    "product_name", "product_type", "product_risk_level", "client_risk_level",
                    fn.multi_code_label("client_risk_level", "risk_labels")
                    .alias("client_risk_level_name"),
                    "contract_begin_date", "contract_end_date", "collection_time", "invest_total_service_fee",
                    "kernel_total_rate", "alloca_oa_branch_type", "alloca_oa_branch_id", "alloca_oa_branch_name",
                    "alloca_kernel_rate",
                    (F.col("invest_total_service_fee") * F.col("kernel_total_rate") * F.col("alloca_kernel_rate"))
                    .alias("alloca_income"))


LABEL_SQL = """(SELECT s.contract_number, string_agg(d.label, ',' ORDER BY s.pos) AS labels
  FROM (SELECT contract_number, unnest(string_split(client_risk_level, ',')) AS code,
               generate_subscripts(string_split(client_risk_level, ','), 1) AS pos
        FROM t00122 WHERE client_risk_level IS NOT NULL) s
  JOIN dictionary d ON d.grp = 'report.wh_risk_level' AND d.code = s.code
  GROUP BY s.contract_number)"""

#: the same in Spark's words, for the reconciliation
LABEL_SPARK = """(SELECT s.contract_number, listagg(d.label, ',') WITHIN GROUP (ORDER BY s.pos) AS labels
  FROM (SELECT t.contract_number, e.code, e.pos FROM t00122 t LATERAL VIEW posexplode(split(t.client_risk_level, ',')) e AS pos, code) s
  JOIN dictionary d ON d.grp = 'report.wh_risk_level' AND d.code = s.code
  GROUP BY s.contract_number)"""

CONS_KERNEL_SQL = f"""(SELECT t.busi_month AS month_id, t.client_id, t.client_name, t.mobile, t.contract_number,
  t.product_name, t.product_type, t.product_risk_level, t.client_risk_level,
  CASE WHEN t.client_risk_level IS NULL THEN NULL ELSE coalesce(l.labels, '') END AS client_risk_level_name,
  t.contract_begin_date, t.contract_end_date, t.collection_time, t.invest_total_service_fee, t.kernel_total_rate,
  a.alloca_oa_branch_type, a.alloca_oa_branch_id, a.alloca_oa_branch_name, a.alloca_kernel_rate,
  t.invest_total_service_fee * t.kernel_total_rate * a.alloca_kernel_rate AS alloca_income
FROM t00122 t LEFT JOIN t00122_1 a ON t.busi_month = a.busi_month AND t.client_id = a.client_id
  AND t.product_name = a.product_name
LEFT JOIN {LABEL_SQL} l ON t.contract_number = l.contract_number
WHERE t.busi_month = '{P.month_id}')"""


@query("consulting_kernel_split", f"""
SELECT * EXCLUDE (alloca_income), {rnd('alloca_income', 4)} AS alloca_income FROM {CONS_KERNEL_SQL} c""")
def consulting_kernel_split(spark):
    """Consulting fee x kernel rate x department rate, with risk labels."""
    return consulting_kernel_df(spark).withColumn("alloca_income", fn.money("alloca_income", 4))


CONS_BONUS_SQL = f"""(SELECT t.busi_month AS month_id, t.client_id, t.client_name, t.mobile, t.contract_number, t.product_name,
  t.product_type, t.product_risk_level, t.client_risk_level, t.contract_begin_date, t.contract_end_date,
  t.collection_time, t.invest_total_service_fee, t.perfor_total_rate, a.alloca_oa_branch_type, a.alloca_oa_branch_id, a.alloca_oa_branch_name,
  a.alloca_perfor_rate, a.broker_id, a.broker_name, a.broker_perfor_rate,
  t.invest_total_service_fee * t.perfor_total_rate * a.alloca_perfor_rate * a.broker_perfor_rate AS broker_income
FROM t00122 t LEFT JOIN t00122_2 a ON t.busi_month = a.busi_month AND t.client_id = a.client_id
  AND t.product_name = a.product_name
WHERE t.busi_month = '{P.month_id}')"""


@query("consulting_bonus_split", f"""
SELECT * EXCLUDE (broker_income), {rnd('broker_income', 4)} AS broker_income FROM {CONS_BONUS_SQL} b""")
def consulting_bonus_split(spark):
    """Consulting fee x performance rate x department rate x person rate."""
    return consulting_bonus_df(spark).withColumn("broker_income", fn.money("broker_income", 4))


def consulting_bonus_df(spark) -> DataFrame:
    p = run_params(spark)
    t = spark.table("t00122").filter(F.col("busi_month") == p.month_id)
    j = t.join(spark.table("t00122_2"), _CONS_KEYS, "left")
    inc = (F.col("invest_total_service_fee") * F.col("perfor_total_rate") * F.col("alloca_perfor_rate")
           * F.col("broker_perfor_rate"))
    return j.select(F.col("busi_month").alias("month_id"), "client_id", "client_name", "mobile", "contract_number",
                    "product_name", "product_type", "product_risk_level", "client_risk_level", "contract_begin_date",
                    "contract_end_date", "collection_time", "invest_total_service_fee", "perfor_total_rate", "alloca_oa_branch_type", "alloca_oa_branch_id",
                    "alloca_oa_branch_name", "alloca_perfor_rate", "broker_id", "broker_name", "broker_perfor_rate",
                    inc.alias("broker_income"))


# ----------------------------------------------------------- B21 insurance fund base

@block
def insurance_base_df(spark) -> DataFrame:
    return insurance_base_of(spark, ledger_table(spark))


def insurance_base_of(spark, ledger: DataFrame) -> DataFrame:
    p = run_params(spark)
    t = ledger.filter((F.col("month_id") == p.month_id) & (F.col("is_main") == 1))
    excluded = spark.table("branch").filter(EXCLUDED).select("branch_id")
    t = t.filter(F.col("branch_id").isNotNull()).join(excluded, "branch_id", "left_anti")
    x = spark.table("branch_oa_rela").select(F.col("ctp_branch_id").alias("branch_id"), "oa_branch_id")
    return (t.join(x, "branch_id")
            .groupBy("month_id", F.col("branch_id").alias("ctp_branch_id"), "oa_branch_id")
            .agg(F.sum("done_money").alias("done_money"), F.sum("secu_fee").alias("bzjj")).na.fill(0))


INSURANCE_SQL = f"""(SELECT t.month_id, t.branch_id AS ctp_branch_id, x.oa_branch_id,
  coalesce(sum(t.done_money), 0) AS done_money, coalesce(sum(t.secu_fee), 0) AS bzjj
FROM {LEDGER} t JOIN branch_oa_rela x ON t.branch_id = x.ctp_branch_id
WHERE t.month_id = '{P.month_id}' AND t.is_main = 1 AND t.branch_id IS NOT NULL
  AND t.branch_id NOT IN (SELECT branch_id FROM branch WHERE {EXCLUDED})
GROUP BY t.month_id, t.branch_id, x.oa_branch_id)"""


@query("insurance_fund_base", rounded_sql(["done_money", "bzjj"], f"{INSURANCE_SQL} i", {"bzjj": 4},
                                          keys=("month_id", "ctp_branch_id", "oa_branch_id")))
def insurance_fund_base(spark):
    """Protection-fund base by branch over main rows, excluded branches removed."""
    return rounded(insurance_base_df(spark), {"bzjj": 4})


# ----------------------------------------------------------- B22 special clients

@block
def special_client_df(spark) -> DataFrame:
    p = run_params(spark)
    from .ledger import SPECIAL_REBATE_SPEC, exchange_rebate_df
    rules = spark.table("t00153")
    # the rules' clients reduce the rebates before anything is summed
    reb = exchange_rebate_df(spark, SPECIAL_REBATE_SPEC, rules.select("client_id")) \
        .select("fund_account_id", "busi_date", "market_reduct")
    cash = (dated(spark, "fund_jour", p.first_trade_day, p.last_trade_day)
            .filter((F.col("fund_type") == "3") & (F.col("fund_direct") == "1") & F.col("busi_date").between(p.first_trade_day, p.last_trade_day))
            .groupBy("fund_account_id", "busi_date").agg(F.sum("occur_money").alias("occur_money")))
    r_dates = rules.select(F.col("client_id").alias("fund_account_id"), "begin_date", "end_date")
    t3 = (reb.join(cash, ["fund_account_id", "busi_date"], "left")
          .join(r_dates, "fund_account_id")
          .filter(F.col("busi_date").between(F.col("begin_date"), F.col("end_date")))
          .groupBy("busi_date", "fund_account_id")
          .agg(F.sum(F.col("market_reduct") - F.coalesce(F.col("occur_money"), F.lit(0))).alias("market_ret_reduce")))
    t4 = (dated(spark, "rpt_06008", p.first_trade_day, p.last_trade_day)
          .join(r_dates, "fund_account_id")
          .filter(F.col("n_busi_date").between(F.col("begin_date"), F.col("end_date")))
          .groupBy(F.col("n_busi_date").alias("busi_date"), "fund_account_id")
          .agg(F.sum("remain_transfee").alias("remain_transfee")))
    j = (t3.join(t4, ["busi_date", "fund_account_id"], "left")
         .join(rules.withColumnRenamed("client_id", "fund_account_id"), "fund_account_id"))
    return (j.groupBy(F.substring("busi_date", 1, 6).alias("month_id"), F.col("fund_account_id").alias("client_id"),
                      "client_name", F.col("branch_id").alias("department"),
                      F.col("coll_branch_id").alias("allocation_dept"),
                      F.col("remain_rate").alias("remain_transfee_rate"), F.col("jm_rate").alias("jian_mian_rate"))
            .agg(F.sum("remain_transfee").alias("remain_transfee_total"),
                 F.sum("market_ret_reduce").alias("jian_mian_total"),
                 F.sum(F.col("remain_transfee") * F.col("remain_rate")).alias("remain_transfee_money"),
                 F.sum(F.col("market_ret_reduce") * F.col("jm_rate")).alias("jian_mian_money")))


def _special_sql() -> str:
    from .ledger import SPECIAL_REBATE_SPEC, exchange_rebate_sql
    return f"""(SELECT substr(t.busi_date, 1, 6) AS month_id, a.client_id, a.client_name, a.branch_id AS department,
  a.coll_branch_id AS allocation_dept, a.remain_rate AS remain_transfee_rate, a.jm_rate AS jian_mian_rate,
  sum(t1.remain_transfee) AS remain_transfee_total, sum(t.market_ret_reduce) AS jian_mian_total,
  sum(t1.remain_transfee * a.remain_rate) AS remain_transfee_money,
  sum(t.market_ret_reduce * a.jm_rate) AS jian_mian_money
FROM (SELECT t.busi_date, t.fund_account_id, sum(t.market_reduct - coalesce(t1.occur_money, 0)) AS market_ret_reduce
      FROM {exchange_rebate_sql(SPECIAL_REBATE_SPEC)} t
      LEFT JOIN (SELECT fund_account_id, busi_date, sum(occur_money) AS occur_money FROM fund_jour
                 WHERE fund_type = '3' AND fund_direct = '1' AND busi_date BETWEEN {FT} AND {LT}
                 GROUP BY fund_account_id, busi_date) t1
        ON t.busi_date = t1.busi_date AND t.fund_account_id = t1.fund_account_id
      JOIN t00153 a ON t.fund_account_id = a.client_id
      WHERE t.busi_date BETWEEN a.begin_date AND a.end_date
      GROUP BY t.busi_date, t.fund_account_id) t
LEFT JOIN (SELECT t.n_busi_date AS busi_date, t.fund_account_id, sum(t.remain_transfee) AS remain_transfee
           FROM rpt_06008 t JOIN t00153 a ON t.fund_account_id = a.client_id
           WHERE t.n_busi_date BETWEEN {FT} AND {LT} AND t.n_busi_date BETWEEN a.begin_date AND a.end_date
           GROUP BY t.n_busi_date, t.fund_account_id) t1
  ON t.busi_date = t1.busi_date AND t.fund_account_id = t1.fund_account_id
JOIN t00153 a ON t.fund_account_id = a.client_id
GROUP BY substr(t.busi_date, 1, 6), a.client_id, a.client_name, a.branch_id, a.coll_branch_id, a.remain_rate, a.jm_rate)"""


SPECIAL_SQL = _special_sql()
SPECIAL_VALS = ["remain_transfee_total", "jian_mian_total", "remain_transfee_money", "jian_mian_money"]
SPECIAL_KEYS = ("month_id", "client_id", "client_name", "department", "allocation_dept", "remain_transfee_rate",
                "jian_mian_rate")


@query("special_client_revenue", rounded_sql(SPECIAL_VALS, f"{SPECIAL_SQL} s", {c: 4 for c in SPECIAL_VALS},
                                             keys=SPECIAL_KEYS))
def special_client_revenue(spark):
    """Special-client rebate net of company-adjust cash and retained fee, x rule rates.

    Returns both months of the rebate window (V12); writers keep only the run month.
    """
    return rounded(special_client_df(spark), default=4)


# ----------------------------------------------------------- B23 IB collaboration

@block
def ib_collab_df(spark) -> DataFrame:
    return ib_collab_of(spark, ledger_table(spark))


def ib_collab_of(spark, ledger: DataFrame) -> DataFrame:
    p = run_params(spark)
    t = ledger.filter(F.col("month_id") == p.month_id)
    a = spark.table("t00107")
    j = t.join(a, (t.oa_broker_name == a.futu_service_name) & (t.fund_account_id == a.fund_account_id))
    return j.select(t.month_id, "ib_branch_id", "ib_branch_name", t.fund_account_id, "client_name",
                    F.col("oa_broker_id").alias("broker_id"), F.col("oa_broker_name").alias("broker_name"),
                    F.col("branch_id").alias("ctp_branch_id"), F.col("branch_name").alias("ctp_branch_name"),
                    F.col("yes_rights").alias("begin_rights"), "end_rights", "avg_rights", "remain_transfee",
                    (F.coalesce("ib_rebate", F.lit(0)) + F.coalesce("ib_ret", F.lit(0)))
                    .alias("ibxt_income"),
                    fn.safe_divide("ib_interest", "coope_income_reate").alias("interest_clear_income"),
                    fn.safe_divide("ib_ret", "coope_income_reate").alias("market_reduct_income"),
                    F.col("coope_income_reate").alias("ibxt_income_reate"),
                    F.col("ib_interest").alias("ibxt_interest_clear_income"),
                    F.col("ib_ret").alias("ibxt_market_reduct_income"))


def _safe(x):
    return f"CASE WHEN {x} = 0 OR {x} IS NULL THEN 1 ELSE {x} END"


IB_COLLAB_SQL = f"""(SELECT t.month_id, a.ib_branch_id, a.ib_branch_name, t.fund_account_id, t.client_name,
  t.oa_broker_id AS broker_id, t.oa_broker_name AS broker_name, t.branch_id AS ctp_branch_id,
  t.branch_name AS ctp_branch_name, t.yes_rights AS begin_rights, t.end_rights, t.avg_rights, t.remain_transfee,
  coalesce(t.ib_rebate, 0) + coalesce(t.ib_ret, 0) AS ibxt_income,
  t.ib_interest / {_safe('a.coope_income_reate')} AS interest_clear_income,
  t.ib_ret / {_safe('a.coope_income_reate')} AS market_reduct_income,
  a.coope_income_reate AS ibxt_income_reate, t.ib_interest AS ibxt_interest_clear_income,
  t.ib_ret AS ibxt_market_reduct_income
FROM {LEDGER} t JOIN t00107 a ON t.oa_broker_name = a.futu_service_name AND t.fund_account_id = a.fund_account_id
WHERE t.month_id = '{P.month_id}')"""
IB_COLLAB_VALS = ["begin_rights", "end_rights", "avg_rights", "remain_transfee", "ibxt_income",
                  "interest_clear_income", "market_reduct_income", "ibxt_income_reate",
                  "ibxt_interest_clear_income", "ibxt_market_reduct_income"]
IB_COLLAB_KEYS = ("month_id", "ib_branch_id", "ib_branch_name", "fund_account_id", "client_name", "broker_id",
                  "broker_name", "ctp_branch_id", "ctp_branch_name")


@query("ib_collab_income", rounded_sql(IB_COLLAB_VALS, f"{IB_COLLAB_SQL} i", {c: 4 for c in IB_COLLAB_VALS},
                                       keys=IB_COLLAB_KEYS))
def ib_collab_income(spark):
    """IB-collaboration income grossed up by the cooperation rate (guarded division)."""
    return rounded(ib_collab_df(spark), default=4)


# ----------------------------------------------------------- B24 IB office

@block
def ib_office_df(spark) -> DataFrame:
    return ib_office_of(spark, ledger_table(spark))


def ib_office_of(spark, ledger: DataFrame) -> DataFrame:
    p = run_params(spark)
    t = ledger.filter(F.col("month_id") == p.month_id)
    rel = spark.table("crm_broker_investor_rela")
    # the left join is followed by null-rejecting filters on the relation: inner
    a = (rel.filter(F.col("broker_id").startswith("ZD") & (F.col("rela_sts") == "A") & (F.col("approve_sts") == "0"))
         .select(F.col("broker_id").alias("a_broker_id"), F.col("investor_id").alias("a_investor_id"),
                 fn.relation_label("broker_rela_typ").alias("a_rela_type"), "data_pct"))
    b = spark.table("t00110")
    j = (t.join(a, (t.oa_broker_id == a.a_broker_id) & (t.fund_account_id == a.a_investor_id)
                & (t.rela_type == a.a_rela_type))
         .join(b, t.oa_broker_id == b.broker_id))
    share = F.coalesce(F.col("data_pct"), F.lit(1.0))
    brand = F.when(F.substring("branch_name", 1, 4) == "SWHY", F.lit(0.45)).otherwise(F.lit(1.0))
    interest = F.coalesce("net_interest_reduce", F.lit(0)) - F.coalesce("csperson_interest", F.lit(0))
    rebate = F.coalesce("market_ret_reduce", F.lit(0)) - F.coalesce("csperson_ret", F.lit(0))
    fee = F.coalesce("clear_remain_transfee", F.lit(0)) - F.coalesce("csperson_rebate", F.lit(0))
    return j.select(F.lit(p.month_id).alias("month_id"), F.lit("").alias("ib_branch_id"),
                    F.lit("").alias("ib_branch_name"), "fund_account_id", "client_name",
                    F.col("oa_broker_id").alias("broker_id"), F.col("oa_broker_name").alias("broker_name"),
                    F.col("broker_branch_id").alias("oa_branch_id"), F.col("broker_branch_name").alias("oa_branch_name"),
                    F.col("branch_id").alias("ctp_branch_id"),
                    F.col("yes_rights").alias("begin_rights"), "end_rights", "avg_rights",
                    F.col("clear_remain_transfee").alias("remain_transfee"),
                    (interest * share * brand + rebate * share * brand + fee * share * brand).alias("ibzd_income"),
                    interest.alias("interest_clear_income"), rebate.alias("market_reduct_income"),
                    fee.alias("clear_remain_transfee"), share.alias("ibzd_income_reate"),
                    (interest * share * brand).alias("ibzd_interest_clear_income"),
                    (rebate * share * brand).alias("ibzd_market_reduct_income"),
                    (fee * share * brand).alias("ibzd_clear_remain_transfee"), "done_amount", "done_money")


def _ib_office_sql() -> str:
    share = "coalesce(a.data_pct, 1.0)"
    brand = "CASE WHEN substr(t.branch_name, 1, 4) = 'SWHY' THEN 0.45 ELSE 1.0 END"
    i = "(coalesce(t.net_interest_reduce, 0) - coalesce(t.csperson_interest, 0))"
    r = "(coalesce(t.market_ret_reduce, 0) - coalesce(t.csperson_ret, 0))"
    f = "(coalesce(t.clear_remain_transfee, 0) - coalesce(t.csperson_rebate, 0))"
    return f"""(SELECT '{P.month_id}' AS month_id, '' AS ib_branch_id, '' AS ib_branch_name, t.fund_account_id,
  t.client_name, t.oa_broker_id AS broker_id, t.oa_broker_name AS broker_name, b.broker_branch_id AS oa_branch_id,
  b.broker_branch_name AS oa_branch_name, t.branch_id AS ctp_branch_id, t.yes_rights AS begin_rights, t.end_rights,
  t.avg_rights, t.clear_remain_transfee AS remain_transfee,
  {i} * {share} * {brand} + {r} * {share} * {brand} + {f} * {share} * {brand} AS ibzd_income,
  {i} AS interest_clear_income, {r} AS market_reduct_income, {f} AS clear_remain_transfee,
  {share} AS ibzd_income_reate, {i} * {share} * {brand} AS ibzd_interest_clear_income,
  {r} * {share} * {brand} AS ibzd_market_reduct_income, {f} * {share} * {brand} AS ibzd_clear_remain_transfee,
  t.done_amount, t.done_money
FROM {LEDGER} t
JOIN crm_broker_investor_rela a ON t.oa_broker_id = a.broker_id AND t.fund_account_id = a.investor_id
  AND t.rela_type = CASE a.broker_rela_typ WHEN '301' THEN '居间关系' WHEN '001' THEN '开发关系'
                         WHEN '002' THEN '服务关系' WHEN '003' THEN '维护关系' ELSE '-' END
JOIN t00110 b ON t.oa_broker_id = b.broker_id
WHERE t.month_id = '{P.month_id}' AND a.broker_id LIKE 'ZD%' AND a.rela_sts = 'A' AND a.approve_sts = '0')"""


IB_OFFICE_SQL = _ib_office_sql()
IB_OFFICE_VALS = ["begin_rights", "end_rights", "avg_rights", "remain_transfee", "ibzd_income",
                  "interest_clear_income", "market_reduct_income", "clear_remain_transfee", "ibzd_income_reate",
                  "ibzd_interest_clear_income", "ibzd_market_reduct_income", "ibzd_clear_remain_transfee",
                  "done_amount", "done_money"]
IB_OFFICE_KEYS = ("month_id", "ib_branch_id", "ib_branch_name", "fund_account_id", "client_name", "broker_id",
                  "broker_name", "oa_branch_id", "oa_branch_name", "ctp_branch_id")


@query("ib_office_income", rounded_sql(IB_OFFICE_VALS, f"{IB_OFFICE_SQL} i", {c: 4 for c in IB_OFFICE_VALS},
                                       keys=IB_OFFICE_KEYS))
def ib_office_income(spark):
    """IB-office income: net amounts x share x 0.45 brand factor (named columns, V5)."""
    return rounded(ib_office_df(spark), default=4)


# ----------------------------------------------------------- B25 OTC month copy

OTC_COLS = ["add_date", "client_id", "client_name", "open_date", "branch_id", "branch_name", "introductor_id",
            "introductor", "trade_begin_date", "trade_orders", "premium_abs", "actual_notional_principal",
            "sale_income", "colla_pricing", "total_income"]


@block
def otc_month_df(spark) -> DataFrame:
    p = run_params(spark)
    t = dated(spark, "t00207", p.month_start, p.month_end)
    return t.select(F.lit(p.month_id).alias("month_id"), *OTC_COLS)


OTC_SQL = f"(SELECT '{P.month_id}' AS month_id, {', '.join(OTC_COLS)} FROM t00207 WHERE add_date BETWEEN '{M0}' AND '{ME}')"


@query("otc_month_copy", f"SELECT * FROM {OTC_SQL} o")
def otc_month_copy(spark):
    """OTC option ledger copied into the month."""
    return otc_month_df(spark)

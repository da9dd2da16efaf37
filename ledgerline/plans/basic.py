"""Single-operator queries: sources, projections, filters, joins, aggregates,
windows, set operations and scalar functions (SURVEY section 2.1-2.7)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .. import functions as fn
from ..operators.ranking import row_number_by
from ..operators.rates import lookup_rates, resolved_rates, run_date_rates, with_oa_branch
from ..operators.schema import align_to_schema
from ..params import P, run_params
from ..sources.dictionary import code_map
from ..sources.tables import dated
from .registry import query

M0, M1 = P.month_start, P.month_end            # yyyymmdd
D0, D1 = P.month_start_dash, P.month_end_dash  # yyyy-mm-dd
PD0, PD1 = P.prev_month_start_dash, P.prev_month_end_dash

# ---------------------------------------------------------------- sources


@query("scan_table", "SELECT * FROM fund_account")
def scan_table(spark):
    """Scan a named table."""
    return spark.table("fund_account")


@query("scan_projected", "SELECT busi_date, fund_account_id, rights FROM client_sett")
def scan_projected(spark):
    """Scan with a column list (only these columns are read)."""
    return spark.table("client_sett").select("busi_date", "fund_account_id", "rights")


@query("scan_date_window", f"""
SELECT busi_date, fund_account_id, rights, impawn_money, market_margin FROM client_sett
WHERE busi_date BETWEEN '{M0}' AND {P.last_trade_day}""")
def scan_date_window(spark):
    """S3: business-date window applied at the scan."""
    p = run_params(spark)
    return (dated(spark, "client_sett", p.month_start, p.last_trade_day)
            .select("busi_date", "fund_account_id", "rights", "impawn_money", "market_margin"))


SQL_PREDICATE = f"busi_date BETWEEN '{M0}' AND '{M1}' AND done_amt > 10"


@query("scan_sql_predicate", f"SELECT * FROM hold_balance WHERE {SQL_PREDICATE}")
def scan_sql_predicate(spark):
    """``SELECT *`` with a textual predicate."""
    return spark.sql(f"SELECT * FROM hold_balance WHERE {SQL_PREDICATE}")


@query("calendar_dim", "SELECT busi_date, trade_flag, nature_date, market_no FROM calendar")
def calendar_dim(spark):
    """The trading calendar (bounded dimension)."""
    return spark.table("calendar").select("busi_date", "trade_flag", "nature_date", "market_no")


# ---------------------------------------------------------------- projections


@query("project_rename", f"""
SELECT '{P.month_id}' AS month_id, client_id, client_name, branch_id, branch_name,
       introductor_id AS broker_id, introductor AS broker_name,
       premium_abs AS premium, actual_notional_principal AS notional,
       total_income AS income
FROM t00207 WHERE add_date BETWEEN '{M0}' AND '{M1}'""")
def project_rename(spark):
    """Month copy of the OTC ledger with renamed columns (job 208)."""
    p = run_params(spark)
    return (dated(spark, "t00207", p.month_start, p.month_end)
            .select(F.lit(p.month_id).alias("month_id"), "client_id", "client_name",
                    "branch_id", "branch_name",
                    F.col("introductor_id").alias("broker_id"),
                    F.col("introductor").alias("broker_name"),
                    F.col("premium_abs").alias("premium"),
                    F.col("actual_notional_principal").alias("notional"),
                    F.col("total_income").alias("income")))


@query("project_constants", f"""
SELECT '{P.month_id}' AS month_id, fund_account_id, rights, 'admin' AS op_user,
       '{P.busi_date}' AS run_date, '' AS remark, CAST(NULL AS VARCHAR) AS detail,
       CAST(NULL AS DOUBLE) AS adjust_rate
FROM client_sett WHERE busi_date BETWEEN '{M0}' AND '{M1}'""")
def project_constants(spark):
    """Constant columns, including typed NULLs (a bare NULL is ``void``)."""
    p = run_params(spark)
    return (dated(spark, "client_sett", p.month_start, p.month_end)
            .select(F.lit(p.month_id).alias("month_id"), "fund_account_id", "rights",
                    F.lit("admin").alias("op_user"), F.lit(p.busi_date).alias("run_date"),
                    F.lit("").alias("remark"), F.lit(None).cast("string").alias("detail"),
                    F.lit(None).cast("double").alias("adjust_rate")))


TARGET_SETT = StructType([
    StructField("month_id", StringType()), StructField("busi_date", StringType()),
    StructField("fund_account_id", StringType()), StructField("rights", DoubleType()),
    StructField("yes_rights", DoubleType()), StructField("total_profit", DoubleType()),
])


@query("align_schema", f"""
SELECT '{P.month_id}' AS month_id, busi_date, fund_account_id, rights, yes_rights,
       CAST(NULL AS DOUBLE) AS total_profit
FROM client_sett WHERE busi_date BETWEEN '{M0}' AND '{M1}'""")
def align_schema(spark):
    """Fill / drop / reorder to a target schema, partition literal set."""
    p = run_params(spark)
    src = (dated(spark, "client_sett", p.month_start, p.month_end)
           .select(F.col("YES_RIGHTS"), "rights", "fund_account_id", "busi_date", "transfee"))
    return align_to_schema(src, TARGET_SETT, {"month_id": p.month_id})


# ---------------------------------------------------------------- filters


@query("filter_month", f"""
SELECT * FROM t00207 WHERE add_date >= '{M0}' AND add_date <= '{M1}'""")
def filter_month(spark):
    """month from a date prefix, written as a range so it prunes."""
    p = run_params(spark)
    return dated(spark, "t00207", p.month_start, p.month_end)


@query("filter_date_range", f"""
SELECT * FROM exchange_retfee2 WHERE tx_dt BETWEEN '{D0}' AND '{D1}'""")
def filter_date_range(spark):
    """inclusive date-string range."""
    p = run_params(spark)
    return dated(spark, "exchange_retfee2", p.month_start_dash, p.month_end_dash)


@query("filter_two_month", f"""
SELECT * FROM exchange_retfee2
WHERE tx_dt BETWEEN '{PD0}' AND '{PD1}' OR tx_dt BETWEEN '{D0}' AND '{D1}'""")
def filter_two_month(spark):
    """previous month OR current month."""
    p = run_params(spark)
    c = F.col("tx_dt")
    return dated(spark, "exchange_retfee2", p.prev_month_start_dash, p.month_end_dash).filter(
        c.between(p.prev_month_start_dash, p.prev_month_end_dash) | c.between(p.month_start_dash, p.month_end_dash))


@query("filter_in_list", """
SELECT * FROM fund_jour WHERE fund_projectid IN ('A031', 'A032')""")
def filter_in_list(spark):
    """IN list."""
    return spark.table("fund_jour").filter(F.col("fund_projectid").isin("A031", "A032"))


@query("filter_like_prefix", """
SELECT * FROM crm_broker WHERE broker_id LIKE 'ZD%'""")
def filter_like_prefix(spark):
    """LIKE prefix."""
    return spark.table("crm_broker").filter(F.col("broker_id").startswith("ZD"))


EXCLUDED = "branch_id LIKE 'B2%' AND branch_id <> 'B24'"


@query("anti_join_excluded_branches", f"""
SELECT * FROM fund_account f
WHERE f.branch_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM branch b WHERE {EXCLUDED.replace('branch_id', 'b.branch_id')}
                  AND b.branch_id = f.branch_id)""")
def anti_join_excluded_branches(spark):
    """NOT IN a set read from another table, as a left-anti join.

    The excluded set is never collected to the driver.
    """
    excluded = spark.table("branch").filter(EXCLUDED).select("branch_id")
    return (spark.table("fund_account").filter(F.col("branch_id").isNotNull())
            .join(excluded, "branch_id", "left_anti"))


@query("filter_interval_overlap", f"""
SELECT * FROM crm_broker_investor_rela
WHERE replace(end_dt, '-', '') >= '{M0}' AND replace(st_dt, '-', '') <= '{M1}'""")
def filter_interval_overlap(spark):
    """validity interval overlaps the month."""
    p = run_params(spark)
    r = spark.table("crm_broker_investor_rela")
    # same order as the compact form, and pushable to the scan
    return r.filter((F.col("end_dt") >= p.month_start_dash) & (F.col("st_dt") <= p.month_end_dash))


@query("filter_closed_accounts", f"""
SELECT * FROM fund_account
WHERE isactive = '3'
  AND (close_date BETWEEN '{M0}' AND {P.last_trade_day} OR close_date >= '{M1}')""")
def filter_closed_accounts(spark):
    """F8: closed within [month start, last trade day] or on/after month end."""
    p = run_params(spark)
    c = F.col("close_date")
    return (spark.table("fund_account")
            .filter((F.col("isactive") == "3") & (c.between(p.month_start, p.last_trade_day) | (c >= p.month_end))))


@query("filter_id_prefix", f"""
SELECT * FROM (SELECT concat(fund_account_id, busi_date, '-', cast(rights AS VARCHAR)) AS pk_id,
                      fund_account_id, busi_date, rights FROM client_sett) t
WHERE substring(pk_id, 1, 14) = concat(fund_account_id, '{P.month_id}')""")
def filter_id_prefix(spark):
    """prefix equality on a composite id."""
    p = run_params(spark)
    t = spark.table("client_sett").select(
        F.concat("fund_account_id", "busi_date", F.lit("-"), F.col("rights").cast("string")).alias("pk_id"),
        "fund_account_id", "busi_date", "rights")
    return t.filter(F.substring("pk_id", 1, 14) == F.concat("fund_account_id", F.lit(p.month_id)))


# ---------------------------------------------------------------- joins


@query("join_inner_chain", """
SELECT a.broker_id, a.investor_id, a.broker_rela_typ, b.broker_nam, d.department_id, d.department_nam
FROM crm_broker_investor_rela a
JOIN crm_broker b ON a.broker_id = b.broker_id
JOIN mdp_dept00 f ON b.department_id = f.chdeptcode
JOIN dc_investor c ON a.investor_id = c.investor_id
JOIN dc_org d ON c.orig_department_id = d.department_id""")
def join_inner_chain(spark):
    """Four-way inner equi-join chain (dims broadcast, fact not shuffled)."""
    a = spark.table("crm_broker_investor_rela")
    b = spark.table("crm_broker")
    f = spark.table("mdp_dept00")
    c = spark.table("dc_investor")
    d = spark.table("dc_org")
    return (a.join(b, "broker_id")
            .join(f, b.department_id == f.chdeptcode)
            .join(c, "investor_id")
            .join(d, c.orig_department_id == d.department_id)
            .select("broker_id", "investor_id", "broker_rela_typ", "broker_nam",
                    d.department_id, "department_nam"))


@query("join_left", """
SELECT f.fund_account_id, f.branch_id, i.ib_branch_id, i.coope_income_reate
FROM fund_account f LEFT JOIN t00107 i ON f.fund_account_id = i.fund_account_id""")
def join_left(spark):
    """Left equi-join."""
    return (spark.table("fund_account")
            .join(spark.table("t00107"), "fund_account_id", "left")
            .select("fund_account_id", "branch_id", "ib_branch_id", "coope_income_reate"))


@query("join_multi_key", """
SELECT d.tx_dt, d.investor_id, d.staff_id, d.srela_typ, d.ib_amt, r.st_dt, r.data_pct
FROM adm_brokerdata_detail d
JOIN crm_broker_investor_rela r
  ON d.investor_id = r.investor_id AND d.staff_id = r.broker_id AND d.srela_typ = r.broker_rela_typ""")
def join_multi_key(spark):
    """Three-key equi-join."""
    d = spark.table("adm_brokerdata_detail")
    r = spark.table("crm_broker_investor_rela").withColumnRenamed("broker_id", "staff_id") \
        .withColumnRenamed("broker_rela_typ", "srela_typ")
    return (d.join(r, ["investor_id", "staff_id", "srela_typ"])
            .select("tx_dt", "investor_id", "staff_id", "srela_typ", "ib_amt", "st_dt", "data_pct"))


RATE_LOOKUP_SQL = f"""
SELECT t.fund_account_id, t.busi_date, x.oa_branch_id, c.para_value AS vat, d.para_value AS surtax,
       e.para_value AS risk
FROM (SELECT investor_id AS fund_account_id, replace(tx_dt, '-', '') AS busi_date
      FROM exchange_retfee2 WHERE tx_dt BETWEEN '{PD0}' AND '{D1}'
      GROUP BY investor_id, replace(tx_dt, '-', '')) t
LEFT JOIN fund_account t2 ON t.fund_account_id = t2.fund_account_id
JOIN branch_oa_rela x ON t2.branch_id = x.ctp_branch_id
LEFT JOIN rate_param c ON instr(c.branch_id, x.oa_branch_id) > 0 AND c.fee_type = '1004'
     AND t.busi_date BETWEEN c.begin_date AND c.end_date
LEFT JOIN rate_param d ON instr(d.branch_id, x.oa_branch_id) > 0 AND d.fee_type = '1005'
     AND t.busi_date BETWEEN d.begin_date AND d.end_date
LEFT JOIN rate_param e ON instr(e.branch_id, x.oa_branch_id) > 0 AND e.fee_type = '1002'
     AND t.busi_date BETWEEN e.begin_date AND e.end_date"""


@query("rate_lookup_asof", RATE_LOOKUP_SQL)
def rate_lookup_asof(spark):
    """Effective-dated rate lookup by OA branch containment and date."""
    p = run_params(spark)
    t = (dated(spark, "exchange_retfee2", p.prev_month_start_dash, p.month_end_dash)
         .select(F.col("investor_id").alias("fund_account_id"),
                 fn.compact_date("tx_dt").alias("busi_date")).distinct())
    fa = spark.table("fund_account").select("fund_account_id", "branch_id")
    t = t.join(fa, "fund_account_id", "left")
    t = with_oa_branch(t, spark, "branch_id")
    t = lookup_rates(t, resolved_rates(spark), "oa_branch_id", "busi_date",
                     {"vat": "1004", "surtax": "1005", "risk": "1002"})
    return t.select("fund_account_id", "busi_date", "oa_branch_id", "vat", "surtax", "risk")


@query("rate_as_of_run_date", f"""
SELECT o.client_id, o.total_income, o.branch_id, b.para_value AS risk, c.para_value AS vat, e.para_value AS surtax
FROM t00207 o
CROSS JOIN run_rate b CROSS JOIN run_rate c CROSS JOIN run_rate e
WHERE o.add_date BETWEEN '{M0}' AND '{M1}'
  AND b.fee_type = '1002' AND b.begin_date <= '{P.busi_date}' AND b.end_date >= '{P.busi_date}'
  AND c.fee_type = '1004' AND c.begin_date <= '{P.busi_date}' AND c.end_date >= '{P.busi_date}'
  AND e.fee_type = '1005' AND e.begin_date <= '{P.busi_date}' AND e.end_date >= '{P.busi_date}'""")
def rate_as_of_run_date(spark):
    """Rates valid at the run date, inner and without a branch; two valid rates (1005) make two rows."""
    p = run_params(spark)
    o = (dated(spark, "t00207", p.month_start, p.month_end)
         .select("client_id", "total_income", "branch_id"))
    return run_date_rates(o, spark.table("run_rate"), p.busi_date, {"risk": "1002", "vat": "1004", "surtax": "1005"})


@query("cross_join_account_map", f"""
SELECT o.client_id, o.total_income, a.account_code, a.account_name
FROM t00207 o JOIN acount_func_rela a ON a.func_id = 'P_OTC'
WHERE o.add_date BETWEEN '{M0}' AND '{M1}'""")
def cross_join_account_map(spark):
    """Facts x account map of one job (broadcast of a bounded map)."""
    p = run_params(spark)
    o = (dated(spark, "t00207", p.month_start, p.month_end)
         .select("client_id", "total_income", F.lit("P_OTC").alias("func_id")))
    a = spark.table("acount_func_rela").select("func_id", "account_code", "account_name")
    # equi-join on the job id: each fact row fans out to the job's few accounts
    return o.join(a, "func_id").select("client_id", "total_income", "account_code",
                                                      "account_name")


@query("join_valid_at", f"""
SELECT r.n_busi_date, r.fund_account_id, r.rights, t.out_oa_branch_id, t.in_oa_branch_id, t.rights_rate
FROM rpt_06008 r JOIN t00114 t
  ON r.fund_account_id = t.fund_account_id AND r.n_busi_date BETWEEN t.begin_date AND t.end_date
WHERE r.n_busi_date BETWEEN '{M0}' AND '{M1}'""")
def join_valid_at(spark):
    """Key + date-in-validity join (hash join with a range residual)."""
    p = run_params(spark)
    r = dated(spark, "rpt_06008", p.month_start, p.month_end)
    t = spark.table("t00114")
    return (r.join(t, (r.fund_account_id == t.fund_account_id)
                   & r.n_busi_date.between(t.begin_date, t.end_date))
            .select("n_busi_date", r.fund_account_id, "rights", "out_oa_branch_id",
                    "in_oa_branch_id", "rights_rate"))


@query("join_decoded_key", f"""
SELECT s.fund_account_id, s.rela_type, r.broker_id, r.data_pct
FROM (SELECT DISTINCT investor_id AS fund_account_id,
             CASE broker_rela_typ WHEN '301' THEN '居间关系' WHEN '001' THEN '开发关系'
                  WHEN '002' THEN '服务关系' WHEN '003' THEN '维护关系' ELSE '-' END AS rela_type
      FROM crm_broker_investor_rela) s
JOIN (SELECT broker_id, investor_id, data_pct,
             CASE broker_rela_typ WHEN '301' THEN '居间关系' WHEN '001' THEN '开发关系'
                  WHEN '002' THEN '服务关系' WHEN '003' THEN '维护关系' ELSE '-' END AS lbl
      FROM crm_broker_investor_rela WHERE broker_id LIKE 'ZD%') r
  ON s.fund_account_id = r.investor_id AND s.rela_type = r.lbl""")
def join_decoded_key(spark):
    """Join on a decoded code (decode first, then equi-join on the label)."""
    rel = spark.table("crm_broker_investor_rela")
    s = rel.select(F.col("investor_id").alias("fund_account_id"),
                   fn.relation_label("broker_rela_typ").alias("rela_type")).distinct()
    r = rel.filter(F.col("broker_id").startswith("ZD")).select(
        "broker_id", "investor_id", "data_pct", fn.relation_label("broker_rela_typ").alias("lbl"))
    return (s.join(r, (s.fund_account_id == r.investor_id) & (s.rela_type == r.lbl))
            .select("fund_account_id", "rela_type", "broker_id", "data_pct"))


@query("join_left_null_rejecting", """
SELECT r.broker_id, r.investor_id, o.broker_branch_id, o.broker_branch_name
FROM crm_broker_investor_rela r LEFT JOIN t00110 o ON r.broker_id = o.broker_id
WHERE o.broker_branch_id <> 'O9'""")
def join_left_null_rejecting(spark):
    """Left join followed by a filter that rejects the unmatched rows (Catalyst makes it inner)."""
    r = spark.table("crm_broker_investor_rela")
    o = spark.table("t00110")
    return (r.join(o, "broker_id", "left").filter(F.col("broker_branch_id") != "O9")
            .select("broker_id", "investor_id", "broker_branch_id", "broker_branch_name"))


@query("natural_day_expand", f"""
SELECT b.n_busi_date, t.fund_account_id, t.rights
FROM client_sett t JOIN date_nature b ON t.busi_date = b.busi_date
WHERE b.n_busi_date BETWEEN {P.interest_begin} AND '{P.interest_end}'""")
def natural_day_expand(spark):
    """Trade-day balances repeated for every natural day mapped to them."""
    p = run_params(spark)
    cal = spark.table("date_nature").filter(F.col("n_busi_date").between(p.interest_begin, p.interest_end))
    t = dated(spark, "client_sett", p.interest_begin, p.interest_end)
    return (t.join(cal, "busi_date")
            .select("n_busi_date", "fund_account_id", "rights"))


@query("master_left_facts", f"""
SELECT f.fund_account_id, s.rights, h.done_amt
FROM fund_account f
LEFT JOIN (SELECT fund_account_id, sum(rights) AS rights FROM client_sett
           WHERE busi_date BETWEEN '{M0}' AND '{M1}' GROUP BY fund_account_id) s
  ON f.fund_account_id = s.fund_account_id
LEFT JOIN (SELECT fund_account_id, sum(done_amt) AS done_amt FROM hold_balance
           WHERE busi_date BETWEEN '{M0}' AND '{M1}' GROUP BY fund_account_id) h
  ON f.fund_account_id = h.fund_account_id""")
def master_left_facts(spark):
    """Account master left-joined to pre-aggregated facts."""
    p = run_params(spark)
    s = (dated(spark, "client_sett", p.month_start, p.month_end)
         .groupBy("fund_account_id").agg(F.sum("rights").alias("rights")))
    h = (dated(spark, "hold_balance", p.month_start, p.month_end)
         .groupBy("fund_account_id").agg(F.sum("done_amt").alias("done_amt")))
    return (spark.table("fund_account").select("fund_account_id")
            .join(s, "fund_account_id", "left").join(h, "fund_account_id", "left"))


# ---------------------------------------------------------------- aggregates


@query("agg_group_sum", f"""
SELECT busi_date, branch_id, fund_account_id, sum(done_amt) AS done_amount,
       cast(round(cast(sum(done_sum) as decimal(38,10)), 2) as double) AS done_money
FROM hold_balance WHERE busi_date BETWEEN '{M0}' AND {P.last_trade_day}
GROUP BY busi_date, branch_id, fund_account_id""")
def agg_group_sum(spark):
    """A1: group-by sum (partial aggregation before the shuffle)."""
    p = run_params(spark)
    return (dated(spark, "hold_balance", p.month_start, p.last_trade_day)
            .groupBy("busi_date", "branch_id", "fund_account_id")
            .agg(F.sum("done_amt").alias("done_amount"),
                 fn.money(F.sum("done_sum"), 2).alias("done_money")))


CASH_SQL = f"""
SELECT fund_account_id,
       sum(CASE WHEN fund_projectid = 'A031' THEN occur_money ELSE 0 END) AS rebate_paid,
       sum(CASE WHEN fund_projectid = 'A032' THEN occur_money ELSE 0 END) AS interest_paid
FROM fund_jour
WHERE busi_date BETWEEN {P.first_trade_day} AND {P.last_trade_day} AND fund_direct = '1'
  AND fund_projectid IN ('A031', 'A032')
GROUP BY fund_account_id"""


@query("agg_conditional_sum", f"""
SELECT fund_account_id, cast(round(cast(rebate_paid as decimal(38,10)), 2) as double) AS rebate_paid, cast(round(cast(interest_paid as decimal(38,10)), 2) as double) AS interest_paid
FROM ({CASH_SQL}) t""")
def agg_conditional_sum(spark):
    """A2: conditional sums in one pass."""
    from .ledger import cash_by_project_df
    c = cash_by_project_df(spark)
    return c.select("fund_account_id", fn.money("rebate_paid", 2).alias("rebate_paid"),
                    fn.money("interest_paid", 2).alias("interest_paid"))


@query("agg_sum_of_rounded", f"""
SELECT investor_id AS fund_account_id,
       cast(round(cast(sum(cast(round(cast(ret_fee_amt_czce + ret_fee_amt_dce as decimal(38,10)), 4) as double)) as decimal(38,10)), 4) as double) AS reduct_4,
       cast(round(cast(sum(cast(round(cast(exchange_txfee_amt as decimal(38,10)), 2) as double)) as decimal(38,10)), 2) as double) AS txfee_2
FROM exchange_retfee2 WHERE tx_dt BETWEEN '{D0}' AND '{D1}'
GROUP BY investor_id""")
def agg_sum_of_rounded(spark):
    """A3: sum of per-row rounded values."""
    p = run_params(spark)
    e = dated(spark, "exchange_retfee2", p.month_start_dash, p.month_end_dash)
    return (e.groupBy(F.col("investor_id").alias("fund_account_id"))
            .agg(fn.money(F.sum(fn.money(F.col("ret_fee_amt_czce") + F.col("ret_fee_amt_dce"), 4)), 4)
                 .alias("reduct_4"),
                 fn.money(F.sum(fn.money("exchange_txfee_amt", 2)), 2).alias("txfee_2")))


@query("agg_rounded_sum", f"""
SELECT investor_id AS fund_account_id, cast(round(cast(sum(subsistence_fee_amt) as decimal(38,10)), 2) as double) AS fee,
       cast(round(cast(sum(return_amt) as decimal(38,10)), 0) as double) AS ret0
FROM adm_cust_01 WHERE tx_dt BETWEEN '{D0}' AND '{D1}' GROUP BY investor_id""")
def agg_rounded_sum(spark):
    """A4: round after sum (2 digits, and 0 digits)."""
    p = run_params(spark)
    return (dated(spark, "adm_cust_01", p.month_start_dash, p.month_end_dash)
            .groupBy(F.col("investor_id").alias("fund_account_id"))
            .agg(fn.money(F.sum("subsistence_fee_amt"), 2).alias("fee"),
                 fn.money(F.sum("return_amt"), 0).alias("ret0")))


@query("agg_expression", f"""
SELECT busi_date, fund_account_id,
       cast(round(cast(sum(rights) - sum(CASE WHEN impawn_money > market_margin THEN impawn_money ELSE market_margin END) as decimal(38,10)), 2) as double) AS interest_base,
       cast(round(cast(sum(rights) / 365 as decimal(38,10)), 4) as double) AS daily_rights
FROM client_sett WHERE busi_date BETWEEN '{M0}' AND '{M1}' GROUP BY busi_date, fund_account_id""")
def agg_expression(spark):
    """A5: expressions over aggregates (sum - sum, sum / 365)."""
    p = run_params(spark)
    return (dated(spark, "client_sett", p.month_start, p.month_end)
            .groupBy("busi_date", "fund_account_id")
            .agg(fn.money(F.sum("rights") - F.sum(fn.case_max("impawn_money", "market_margin")), 2)
                 .alias("interest_base"),
                 fn.money(F.sum("rights") / 365, 4).alias("daily_rights")))


@query("agg_calendar_bounds", """
SELECT min(busi_date) AS first_day, max(busi_date) AS last_day, count(DISTINCT busi_date) AS n_days
FROM client_sett""")
def agg_calendar_bounds(spark):
    """Global min / max / distinct count (over the settlement dates)."""
    return spark.table("client_sett").agg(
        F.min("busi_date").alias("first_day"), F.max("busi_date").alias("last_day"),
        F.countDistinct("busi_date").alias("n_days"))


@query("agg_derived_keys", f"""
SELECT '{P.month_id}' AS month_id, substr(busi_date, 1, 6) AS busi_month,
       CASE fund_projectid WHEN 'A031' THEN 'rebate' WHEN 'A032' THEN 'interest' ELSE 'other' END AS kind,
       CAST(NULL AS VARCHAR) AS detail, cast(round(cast(sum(occur_money) as decimal(38,10)), 2) as double) AS amount
FROM fund_jour
GROUP BY substr(busi_date, 1, 6),
         CASE fund_projectid WHEN 'A031' THEN 'rebate' WHEN 'A032' THEN 'interest' ELSE 'other' END""")
def agg_derived_keys(spark):
    """Grouping on literal, computed, NULL and decoded keys."""
    p = run_params(spark)
    kind = fn.decode("fund_projectid", {"A031": "rebate", "A032": "interest"}, "other")
    return (spark.table("fund_jour")
            .groupBy(F.lit(p.month_id).alias("month_id"),
                     F.substring("busi_date", 1, 6).alias("busi_month"), kind.alias("kind"),
                     F.lit(None).cast("string").alias("detail"))
            .agg(fn.money(F.sum("occur_money"), 2).alias("amount")))


@query("agg_fillna_zero", f"""
SELECT f.fund_account_id, coalesce(cast(round(cast(s.rights as decimal(38,10)), 2) as double), 0) AS rights,
       coalesce(cast(round(cast(s.margin as decimal(38,10)), 2) as double), 0) AS margin, f.close_date
FROM fund_account f LEFT JOIN (
  SELECT fund_account_id, sum(rights) AS rights, sum(market_margin) AS margin FROM client_sett
  WHERE busi_date BETWEEN '{M0}' AND '{M1}' GROUP BY fund_account_id) s
ON f.fund_account_id = s.fund_account_id""")
def agg_fillna_zero(spark):
    """A10: zero-fill after aggregation touches numeric columns only."""
    p = run_params(spark)
    s = (dated(spark, "client_sett", p.month_start, p.month_end)
         .groupBy("fund_account_id")
         .agg(fn.money(F.sum("rights"), 2).alias("rights"), fn.money(F.sum("market_margin"), 2).alias("margin")))
    return (spark.table("fund_account").select("fund_account_id", "close_date")
            .join(s, "fund_account_id", "left").na.fill(0)
            .select("fund_account_id", "rights", "margin", "close_date"))


# ---------------------------------------------------------------- windows / sets


@query("main_row_flag", f"""
SELECT investor_id AS fund_account_id, broker_id, broker_rela_typ,
       CAST(row_number() OVER (PARTITION BY investor_id ORDER BY broker_id, broker_rela_typ) AS INTEGER) AS is_main
FROM crm_broker_investor_rela
WHERE replace(end_dt, '-', '') >= '{M0}' AND replace(st_dt, '-', '') <= '{M1}'""")
def main_row_flag(spark):
    """Deterministic main-row flag per account."""
    p = run_params(spark)
    r = spark.table("crm_broker_investor_rela").filter((F.col("end_dt") >= p.month_start_dash) & (F.col("st_dt") <= p.month_end_dash))
    r = r.select(F.col("investor_id").alias("fund_account_id"), "broker_id", "broker_rela_typ")
    # exact row_number() over (partition by account ...), safe for a hot account
    return row_number_by(r, ["fund_account_id"], ["broker_id", "broker_rela_typ"], "is_main")


@query("union_populations", f"""
SELECT fund_account_id, branch_id, 'active' AS population FROM fund_account WHERE isactive = '0'
UNION ALL
SELECT fund_account_id, branch_id, 'closed' AS population FROM fund_account
WHERE isactive = '3' AND (close_date BETWEEN '{M0}' AND {P.last_trade_day} OR close_date >= '{M1}')""")
def union_populations(spark):
    """UNION ALL of two disjoint populations."""
    p = run_params(spark)
    fa = spark.table("fund_account")
    a = fa.filter(F.col("isactive") == "0").select("fund_account_id", "branch_id",
                                                   F.lit("active").alias("population"))
    c = fa.filter((F.col("isactive") == "3")
                  & (F.col("close_date").between(p.month_start, p.last_trade_day) | (F.col("close_date") >= p.month_end)))
    c = c.select("fund_account_id", "branch_id", F.lit("closed").alias("population"))
    return a.unionByName(c)


# ---------------------------------------------------------------- scalar functions


@query("fn_date_compact", f"""
SELECT tx_dt, replace(tx_dt, '-', '') AS busi_date FROM adm_cust_01 WHERE tx_dt BETWEEN '{D0}' AND '{D1}'""")
def fn_date_compact(spark):
    """Strip dashes from a date string."""
    p = run_params(spark)
    return (dated(spark, "adm_cust_01", p.month_start_dash, p.month_end_dash)
            .select("tx_dt", fn.compact_date("tx_dt").alias("busi_date")))


@query("fn_substr", """
SELECT contract_number, substr(collection_time, 1, 6) AS month_id, substr(product_name, 1, 4) AS brand,
       substr(concat(contract_number, client_id, mobile), 1, 20) AS job_id
FROM t00122""")
def fn_substr(spark):
    """Substring prefixes (month, 4-char brand, 20-char id)."""
    return spark.table("t00122").select(
        "contract_number", F.substring("collection_time", 1, 6).alias("month_id"),
        F.substring("product_name", 1, 4).alias("brand"),
        F.substring(F.concat("contract_number", "client_id", "mobile"), 1, 20).alias("job_id"))


@query("fn_concat", f"""
SELECT client_id, concat('{P.month_id}', client_name) AS project FROM t00207
WHERE add_date BETWEEN '{M0}' AND '{M1}'""")
def fn_concat(spark):
    """Literal + column concatenation."""
    p = run_params(spark)
    return (dated(spark, "t00207", p.month_start, p.month_end)
            .select("client_id", F.concat(F.lit(p.month_id), "client_name").alias("project")))


@query("fn_coalesce", f"""
SELECT v.investor_id, d.staff_id, coalesce(d.ib_amt, v.staff_amt) AS staff_amt,
       coalesce(d.staff_int_amt, v.staff_int_amt) AS staff_int_amt, coalesce(d.staff_id, '-') AS oa_broker_id
FROM adm_investor_value v LEFT JOIN adm_brokerdata_detail d
  ON v.date_dt = d.tx_dt AND v.investor_id = d.investor_id AND d.rec_freq = 'M'
WHERE v.date_dt = '{D0}'""")
def fn_coalesce(spark):
    """One- and two-column NULL defaults (detail over header)."""
    p = run_params(spark)
    v = dated(spark, "adm_investor_value", p.month_start_dash, p.month_start_dash)
    d = dated(spark, "adm_brokerdata_detail", p.month_start_dash, p.month_start_dash).filter(F.col("rec_freq") == "M")
    j = v.alias("v").join(d.alias("d"), (F.col("v.date_dt") == F.col("d.tx_dt"))
                          & (F.col("v.investor_id") == F.col("d.investor_id")), "left")
    return j.select(F.col("v.investor_id"), F.col("d.staff_id"),
                    F.coalesce("d.ib_amt", "v.staff_amt").alias("staff_amt"),
                    F.coalesce("d.staff_int_amt", "v.staff_int_amt").alias("staff_int_amt"),
                    F.coalesce("d.staff_id", F.lit("-")).alias("oa_broker_id"))


@query("fn_decode", """
SELECT broker_id, investor_id, broker_rela_typ,
       CASE broker_rela_typ WHEN '301' THEN '居间关系' WHEN '001' THEN '开发关系'
            WHEN '002' THEN '服务关系' WHEN '003' THEN '维护关系' ELSE '-' END AS rela_type
FROM crm_broker_investor_rela""")
def fn_decode(spark):
    """CASE decode of relation codes with an else value."""
    return spark.table("crm_broker_investor_rela").select(
        "broker_id", "investor_id", "broker_rela_typ", fn.relation_label("broker_rela_typ").alias("rela_type"))


@query("fn_round_cast", f"""
SELECT busi_date, fund_account_id, cast(round(cast(rights * 0.3333 as decimal(38,10)), 0) as double) AS r0, cast(round(cast(rights * 0.3333 as decimal(38,10)), 2) as double) AS r2,
       cast(round(cast(rights * 0.3333 as decimal(38,10)), 4) as double) AS r4,
       CAST(round(CAST(rights * 0.3333 AS DECIMAL(16,4)), 2) AS DOUBLE) AS r_dec
FROM client_sett WHERE busi_date BETWEEN '{M0}' AND '{M1}'""")
def fn_round_cast(spark):
    """HALF_UP round to 0, 2, 4 digits; cast decimal(16,4) before rounding."""
    p = run_params(spark)
    x = F.col("rights") * 0.3333
    return (dated(spark, "client_sett", p.month_start, p.month_end)
            .select("busi_date", "fund_account_id", fn.money(x, 0).alias("r0"), fn.money(x, 2).alias("r2"),
                    fn.money(x, 4).alias("r4"),
                    F.round(x.cast("decimal(16,4)"), 2).cast("double").alias("r_dec")))


@query("fn_safe_divide", """
SELECT fund_account_id, coope_income_reate,
       cast(round(cast(100 / CASE WHEN coope_income_reate IS NULL OR coope_income_reate = 0 THEN 1
                        ELSE coope_income_reate END as decimal(38,10)), 4) as double) AS grossed_up
FROM t00107""")
def fn_safe_divide(spark):
    """zero/NULL-guarded division (ANSI mode raises on x/0)."""
    return spark.table("t00107").select(
        "fund_account_id", "coope_income_reate",
        fn.money(fn.safe_divide(F.lit(100), "coope_income_reate"), 4).alias("grossed_up"))


@query("fn_case_max", """
SELECT busi_date, fund_account_id, impawn_money, market_margin,
       CASE WHEN impawn_money > market_margin THEN impawn_money ELSE market_margin END AS margin_base
FROM client_sett""")
def fn_case_max(spark):
    """Bigger-of with the CASE null rule (not ``greatest``)."""
    return spark.table("client_sett").select(
        "busi_date", "fund_account_id", "impawn_money", "market_margin",
        fn.case_max("impawn_money", "market_margin").alias("margin_base"))


@query("multi_code_label", """
SELECT t.contract_number, t.client_risk_level,
       CASE WHEN t.client_risk_level IS NULL THEN NULL ELSE coalesce(l.labels, '') END AS client_risk_label
FROM t00122 t LEFT JOIN (
  SELECT s.contract_number, string_agg(d.label, ',' ORDER BY s.pos) AS labels
  FROM (SELECT contract_number, unnest(string_split(client_risk_level, ',')) AS code,
               generate_subscripts(string_split(client_risk_level, ','), 1) AS pos
        FROM t00122 WHERE client_risk_level IS NOT NULL) s
  JOIN dictionary d ON d.grp = 'report.wh_risk_level' AND d.code = s.code
  GROUP BY s.contract_number) l
ON t.contract_number = l.contract_number""")
def multi_code_label(spark):
    """Comma-separated codes -> labels, unknown codes dropped, NULL kept."""
    t = spark.table("t00122").withColumn("labels", code_map(spark.table("dictionary"), "report.wh_risk_level"))
    return t.select("contract_number", "client_risk_level",
                    fn.multi_code_label("client_risk_level", "labels").alias("client_risk_label"))


@query("dictionary_lookup", """
SELECT t.contract_number, t.product_risk_level, g.label AS product_risk_label,
       t.client_risk_level, r.label AS client_first_risk_label
FROM t00122 t
LEFT JOIN dictionary g ON g.grp = 'report.rpt_risk_grade' AND g.code = t.product_risk_level
LEFT JOIN dictionary r ON r.grp = 'report.wh_risk_level' AND r.code = string_split(t.client_risk_level, ',')[1]""")
def dictionary_lookup(spark):
    """Two groups of the dictionary table, one map each; unknown codes and NULL give NULL."""
    d = spark.table("dictionary")
    t = spark.table("t00122").withColumns({"grades": code_map(d, "report.rpt_risk_grade"),
                                           "levels": code_map(d, "report.wh_risk_level")})
    return t.select("contract_number", "product_risk_level",
                    F.col("grades")[F.col("product_risk_level")].alias("product_risk_label"), "client_risk_level",
                    F.col("levels")[F.split("client_risk_level", ",")[0]].alias("client_first_risk_label"))

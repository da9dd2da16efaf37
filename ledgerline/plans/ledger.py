"""The monthly client revenue ledger.

Each building block is a lazy DataFrame builder at its natural grain
(account, account x day, or broker x relation x account).  The ledger joins
them once: all account-grain blocks are aggregated by ``fund_account_id``
(so they arrive hash-partitioned on the same key and join without further
exchanges), then meet the relationship spine in one join, instead of the
original chain of ten MERGE statements.

Every block has a DuckDB statement of the same semantics; the SQL fragments
below compose into the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators.merge import merge_update
from ..operators.ranking import row_number_by
from ..operators.rates import lookup_rates, resolved_rates, with_oa_branch
from ..params import P, run_params
from ..sources.adapters import REBATE_COLUMNS
from ..sources.tables import block, dated
from .registry import query

M0, ME, FT, LT = P.month_start, P.month_end, P.first_trade_day, P.last_trade_day
D0, D1 = P.month_start_dash, P.month_end_dash
# the month's trading window [first trade day, last trade day up to busi_date]
FT_DASH, LT_DASH = P.first_trade_dash, P.last_trade_dash
PD0, PD1 = P.prev_month_start_dash, P.prev_month_end_dash


def rnd(x: str, n: int = 2) -> str:
    """SQL twin of ``functions.money``."""
    return f"cast(round(cast({x} as decimal(38,10)), {n}) as double)"


# ----------------------------------------------------------- rate helpers

TAX3 = {"vat": "1004", "surtax": "1005", "risk": "1002"}


def rated(df: DataFrame, spark, date_col: str, fee_types=None, acct_col: str = "fund_account_id") -> DataFrame:
    """Facts -> account branch (left) -> OA branch (inner) -> dated rates (left)."""
    fa = spark.table("fund_account").select(F.col("fund_account_id").alias("__fa"),
                                            F.col("branch_id").alias("__branch"))
    x = df.join(fa, F.col(acct_col) == F.col("__fa"), "left").drop("__fa")
    x = with_oa_branch(x, spark, "__branch").drop("__branch", "oa_branch_name")
    return lookup_rates(x, resolved_rates(spark), "oa_branch_id", date_col, fee_types or TAX3)


def rated_sql(src: str, date_expr: str, fee_types=None, acct: str = "t.fund_account_id") -> str:
    """FROM-clause twin of ``rated``: ``src`` is aliased ``t``, rates ``r_<name>``."""
    out = [f"{src} t LEFT JOIN fund_account t2 ON {acct} = t2.fund_account_id",
           "JOIN branch_oa_rela x ON t2.branch_id = x.ctp_branch_id"]
    for name, ft in (fee_types or TAX3).items():
        out.append(f"LEFT JOIN rate_param r_{name} ON instr(r_{name}.branch_id, x.oa_branch_id) > 0 "
                   f"AND r_{name}.fee_type = '{ft}' AND {date_expr} BETWEEN r_{name}.begin_date AND r_{name}.end_date")
    return "\n".join(out)


def split_sql(amount: str, name: str, v="r_vat.para_value", s="r_surtax.para_value",
              r="r_risk.para_value") -> str:
    return (f"sum({amount}) AS {name}, sum({amount} / (1 + coalesce({v}, 0))) AS {name}_after_tax, "
            f"sum({amount} * coalesce({s}, 0)) AS {name}_add_tax, "
            f"sum({amount} * coalesce({r}, 0)) AS {name}_risk_fund")


def split_aggs(amount, name: str, v="vat", s="surtax", r="risk"):
    amount = F.col(amount) if isinstance(amount, str) else amount
    return [F.sum(amount).alias(name),
            F.sum(amount / (F.lit(1) + F.coalesce(F.col(v), F.lit(0)))).alias(f"{name}_after_tax"),
            F.sum(amount * F.coalesce(F.col(s), F.lit(0))).alias(f"{name}_add_tax"),
            F.sum(amount * F.coalesce(F.col(r), F.lit(0))).alias(f"{name}_risk_fund")]


def rounded(df: DataFrame, digits: dict | None = None, default: int = 2) -> DataFrame:
    """Round every double column (HALF_UP via decimal) for stable output."""
    digits = digits or {}
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "double":
            out.append(fn.money(f.name, digits.get(f.name, default)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(out)


def rounded_sql(cols: list[str], src: str, digits: dict | None = None, keys: tuple = ("fund_account_id",)) -> str:
    digits = digits or {}
    sel = list(keys) + [f"{rnd(c, digits.get(c, 2))} AS {c}" for c in cols]
    return f"SELECT {', '.join(sel)} FROM {src}"


# ----------------------------------------------------------- B3 exchange rebate

# Measure spec (fixed values): (column, side, digits); side "cur" counts rows
# dated on/after the month start, "prev" rows on/before the previous month end,
# "prev_cut" additionally only before 2022-05-01.  The ledger spec sums
# ``market_reduct`` from these columns; job 156 uses its own list.
LEDGER_REBATE_SPEC = [
    ("ret_fee_amt_tx", "cur"), ("ret_fee_amt_czce", "prev"), ("ret_fee_amt_dce", "prev"),
    ("ret_fee_amt_cffex", "prev"), ("ret_fee_amt_cffex2021", "prev"), ("ret_fee_amt_dce1", "prev"),
    ("ret_fee_amt_dce2", "prev"), ("ret_fee_amt_dce31", "prev"), ("ret_fee_amt_dce32", "prev"),
    ("ret_fee_amt_dce33", "prev"), ("ret_fee_amt_dce11a", "prev"), ("ret_fee_amt_gfex", "prev"),
    ("ret_fee_amt_gfex2", "prev"), ("ret_fee_amt_cffex202206", "prev"),
]
SPECIAL_REBATE_SPEC = [
    ("ret_fee_amt_tx", "cur"), ("ret_fee_amt_shfe", "cur"), ("ret_fee_amt_shfe1", "prev_cut"),
    ("ret_fee_amt_czce", "prev"), ("ret_fee_amt_dce", "prev"), ("ret_fee_amt_cffex", "prev"),
    ("ret_fee_amt_cffex2021", "prev"), ("ret_fee_amt_dce1", "prev"), ("ret_fee_amt_dce2", "prev"),
    ("ret_fee_amt_dce31", "prev"), ("ret_fee_amt_dce32", "prev"), ("ret_fee_amt_dce33", "prev"),
]
assert all(c in REBATE_COLUMNS for c, _ in LEDGER_REBATE_SPEC + SPECIAL_REBATE_SPEC)
CUTOFF_DASH = "2022-05-01"


def _side(p, side: str):
    t = F.col("a.tx_dt")
    now, before = t >= p.month_start_dash, t <= p.prev_month_end_dash
    return {"cur": now, "prev": before, "prev_cut": before & (t < CUTOFF_DASH)}[side]


def _side_sql(side: str) -> str:
    return {"cur": f"a.tx_dt >= '{D0}'", "prev": f"a.tx_dt <= '{PD1}'",
            "prev_cut": f"a.tx_dt <= '{PD1}' AND a.tx_dt < '{CUTOFF_DASH}'"}[side]


@block
def exchange_rebate_df(spark, spec=LEDGER_REBATE_SPEC, only: DataFrame | None = None) -> DataFrame:
    """Rebate income per (account, day) over the previous and current month.

    Every value is rounded per row (4 digits, tx fee 2) before summing; one
    aggregate replaces the original two-level re-aggregation.
    """
    p = run_params(spark)
    days = dated(spark, "exchange_retfee2", p.prev_month_start_dash, p.month_end_dash).alias("a")
    if only is not None:  # the accounts that the caller will keep: a semi-join under the aggregate
        days = days.join(only, F.col("a.investor_id") == F.col(only.columns[0]), "left_semi")
    aggs = [F.sum(fn.money(F.when(_side(p, s), F.col(f"a.{c}")).otherwise(0), 4, 4)).alias(c) for c, s in spec]
    aggs += [F.sum(fn.money(F.when(_side(p, "cur"), F.col("a.exchange_txfee_amt")).otherwise(0), 2, 4))
             .alias("exchange_txfee_amt"),
             F.sum(fn.money(F.when(_side(p, "cur"), F.col("a.investor_ret_amt")).otherwise(0), 4, 4))
             .alias("investor_ret_amt")]
    # facts are summed before they meet the masters, whose keys are unique
    g = days.groupBy(F.col("a.investor_id").alias("fund_account_id"), F.col("a.orig_department_id").alias("__dept"),
                     fn.compact_date("a.tx_dt").alias("busi_date")).agg(*aggs)
    org = spark.table("dc_org").select(F.col("department_id").alias("__dept"))
    inv = spark.table("dc_investor").select(F.col("investor_id").alias("fund_account_id"))
    g = g.join(org, "__dept").join(inv, "fund_account_id")
    # an account belongs to one department, so its rows of a day are one or, after a change, few
    sums = [c for c, _ in spec] + ["exchange_txfee_amt", "investor_ret_amt"]
    g = g.groupBy("fund_account_id", "busi_date").agg(*[F.sum(c).alias(c) for c in sums]).na.fill(0)
    reduct = None
    for c, _ in spec:
        reduct = F.col(c) if reduct is None else reduct + F.col(c)
    return g.select("fund_account_id", "busi_date", "exchange_txfee_amt", "investor_ret_amt",
                    reduct.alias("market_reduct"))


def exchange_rebate_sql(spec=LEDGER_REBATE_SPEC) -> str:
    cols = ",\n  ".join(
        f"coalesce(sum({rnd(f'CASE WHEN {_side_sql(s)} THEN a.{c} ELSE 0 END', 4)}), 0) AS {c}" for c, s in spec)
    reduct = " + ".join(c for c, _ in spec)
    return f"""(SELECT fund_account_id, busi_date, exchange_txfee_amt, investor_ret_amt, {reduct} AS market_reduct
FROM (SELECT a.investor_id AS fund_account_id, replace(a.tx_dt, '-', '') AS busi_date,
  {cols},
  coalesce(sum({rnd(f"CASE WHEN {_side_sql('cur')} THEN a.exchange_txfee_amt ELSE 0 END", 2)}), 0) AS exchange_txfee_amt,
  coalesce(sum({rnd(f"CASE WHEN {_side_sql('cur')} THEN a.investor_ret_amt ELSE 0 END", 4)}), 0) AS investor_ret_amt
FROM exchange_retfee2 a JOIN dc_org b ON a.orig_department_id = b.department_id
JOIN dc_investor ff ON a.investor_id = ff.investor_id
WHERE a.tx_dt BETWEEN '{PD0}' AND '{PD1}' OR a.tx_dt BETWEEN '{D0}' AND '{D1}'
GROUP BY a.investor_id, replace(a.tx_dt, '-', '')) g)"""


@query("exchange_rebate", f"""
SELECT fund_account_id, busi_date, {rnd('market_reduct', 4)} AS market_reduct,
       {rnd('exchange_txfee_amt', 2)} AS exchange_txfee_amt, {rnd('investor_ret_amt', 4)} AS investor_ret_amt
FROM {exchange_rebate_sql()} r""")
def exchange_rebate(spark):
    """Exchange rebate income with the one-month settlement lag."""
    return rounded(exchange_rebate_df(spark), {"market_reduct": 4, "investor_ret_amt": 4})


# ----------------------------------------------------------- B4 cash by project

@block
def cash_daily_df(spark) -> DataFrame:
    """Client cash paid per (account, day): A031 rebate, A032 interest."""
    p = run_params(spark)
    j = dated(spark, "fund_jour", p.first_trade_day, p.last_trade_day).filter(
        (F.col("fund_direct") == "1") & F.col("busi_date").between(p.first_trade_day, p.last_trade_day)
        & F.col("fund_projectid").isin("A031", "A032"))
    return (j.groupBy("fund_account_id", "busi_date")
            .agg(F.sum(F.when(F.col("fund_projectid") == "A031", F.col("occur_money")).otherwise(0))
                 .alias("rebate_paid"),
                 F.sum(F.when(F.col("fund_projectid") == "A032", F.col("occur_money")).otherwise(0))
                 .alias("interest_paid")))


CASH_DAILY_SQL = f"""(SELECT fund_account_id, busi_date,
  sum(CASE WHEN fund_projectid = 'A031' THEN occur_money ELSE 0 END) AS rebate_paid,
  sum(CASE WHEN fund_projectid = 'A032' THEN occur_money ELSE 0 END) AS interest_paid
FROM fund_jour WHERE fund_direct = '1' AND busi_date BETWEEN {FT} AND {LT}
  AND fund_projectid IN ('A031', 'A032')
GROUP BY fund_account_id, busi_date)"""


@block
def cash_by_project_df(spark) -> DataFrame:
    return (cash_daily_df(spark).groupBy("fund_account_id")
            .agg(F.sum("rebate_paid").alias("rebate_paid"), F.sum("interest_paid").alias("interest_paid")))


@query("cash_by_project", f"""
SELECT fund_account_id, {rnd('sum(rebate_paid)')} AS rebate_paid, {rnd('sum(interest_paid)')} AS interest_paid
FROM {CASH_DAILY_SQL} c GROUP BY fund_account_id""")
def cash_by_project(spark):
    """Cash movements by project code."""
    return rounded(cash_by_project_df(spark))


# ----------------------------------------------------------- B5 net rebate

NET_REBATE_COLS = ["market_ret_reduce", "market_ret_reduce_after_tax", "market_ret_add_tax", "market_ret_risk_fund"]


@block
def net_rebate_df(spark) -> DataFrame:
    """Rebate income minus client rebate paid, each with its tax split."""
    inc = (rated(exchange_rebate_df(spark), spark, "busi_date")
           .groupBy("fund_account_id").agg(*split_aggs("market_reduct", "mr")).na.fill(0))
    paid = (rated(cash_daily_df(spark), spark, "busi_date")
            .groupBy("fund_account_id").agg(*split_aggs("rebate_paid", "om")).na.fill(0))
    j = inc.join(paid, "fund_account_id", "left")

    def net(a, b):
        return F.col(a) - F.coalesce(F.col(b), F.lit(0))

    return j.select("fund_account_id", net("mr", "om").alias("market_ret_reduce"),
                    net("mr_after_tax", "om_after_tax").alias("market_ret_reduce_after_tax"),
                    net("mr_add_tax", "om_add_tax").alias("market_ret_add_tax"),
                    net("mr_risk_fund", "om_risk_fund").alias("market_ret_risk_fund"))


NET_REBATE_SQL = f"""(SELECT t.fund_account_id,
  t.mr - coalesce(t1.om, 0) AS market_ret_reduce,
  t.mr_after_tax - coalesce(t1.om_after_tax, 0) AS market_ret_reduce_after_tax,
  t.mr_add_tax - coalesce(t1.om_add_tax, 0) AS market_ret_add_tax,
  t.mr_risk_fund - coalesce(t1.om_risk_fund, 0) AS market_ret_risk_fund
FROM (SELECT t.fund_account_id, {split_sql('t.market_reduct', 'mr')}
      FROM {rated_sql(exchange_rebate_sql(), 't.busi_date')} GROUP BY t.fund_account_id) t
LEFT JOIN (SELECT t.fund_account_id, {split_sql('t.rebate_paid', 'om')}
      FROM {rated_sql(CASH_DAILY_SQL, 't.busi_date')} GROUP BY t.fund_account_id) t1
ON t.fund_account_id = t1.fund_account_id)"""


@query("net_rebate", rounded_sql(NET_REBATE_COLS, f"{NET_REBATE_SQL} n"))
def net_rebate(spark):
    """Net exchange rebate = income - client rebate paid, tax split each."""
    return rounded(net_rebate_df(spark))


# ----------------------------------------------------------- B6/B7 interest

@block
def interest_daily_df(spark) -> DataFrame:
    """Per natural day: interest base and accrued income at the annual rate / 365.

    The base of a trading day (rights minus the bigger of pledge and margin,
    with the CASE null rule) repeats for every natural day that maps to it.
    """
    p = run_params(spark)
    s = dated(spark, "client_sett", p.interest_begin, p.interest_end)
    fa = spark.table("fund_account").select(F.col("fund_account_id").alias("__fa"), "branch_id")
    s = s.join(fa, F.col("fund_account_id") == F.col("__fa"), "left").drop("__fa")
    s = with_oa_branch(s, spark, "branch_id")
    base = (s.groupBy("busi_date", "fund_account_id", "oa_branch_id")
            .agg((F.sum("rights") - F.sum(fn.case_max("impawn_money", "market_margin"))).alias("interest_base"))
            .na.fill(0))
    nat = spark.table("date_nature").filter(F.col("n_busi_date").between(p.interest_begin_nat, p.interest_end))
    x = base.join(nat, "busi_date")
    x = lookup_rates(x, resolved_rates(spark), "oa_branch_id", "busi_date", {"rate": "1001"})
    return (x.groupBy(F.col("n_busi_date").alias("busi_date"), "fund_account_id")
            .agg(F.sum("interest_base").alias("interest_base"),
                 (F.sum(F.col("interest_base") * F.coalesce(F.col("rate"), F.lit(0))) / 365).alias("interest_income"))
            .na.fill(0))


INTEREST_DAILY_SQL = f"""(SELECT b.n_busi_date AS busi_date, t.fund_account_id,
  sum(t.interest_base) AS interest_base,
  sum(t.interest_base * coalesce(c.para_value, 0)) / 365 AS interest_income
FROM (SELECT t.busi_date, t.fund_account_id, x.oa_branch_id,
             coalesce(sum(t.rights) - sum(CASE WHEN t.impawn_money > t.market_margin THEN t.impawn_money
                                               ELSE t.market_margin END), 0) AS interest_base
      FROM client_sett t LEFT JOIN fund_account t2 ON t.fund_account_id = t2.fund_account_id
      JOIN branch_oa_rela x ON t2.branch_id = x.ctp_branch_id
      WHERE t.busi_date BETWEEN {P.interest_begin} AND '{P.interest_end}'
      GROUP BY t.busi_date, t.fund_account_id, x.oa_branch_id) t
JOIN date_nature b ON t.busi_date = b.busi_date
LEFT JOIN rate_param c ON instr(c.branch_id, t.oa_branch_id) > 0 AND c.fee_type = '1001'
     AND t.busi_date BETWEEN c.begin_date AND c.end_date
WHERE b.n_busi_date BETWEEN '{P.interest_begin_nat}' AND '{P.interest_end}'
GROUP BY b.n_busi_date, t.fund_account_id)"""


@query("interest_accrual", f"""
SELECT busi_date, fund_account_id, {rnd('interest_base', 2)} AS interest_base,
       {rnd('interest_income', 4)} AS interest_income FROM {INTEREST_DAILY_SQL} i""")
def interest_accrual(spark):
    """Interest accrual per natural day of the 21st..20th window."""
    return rounded(interest_daily_df(spark), {"interest_income": 4})


INTEREST_TOTAL_COLS = ["accrued_interest", "accrued_interest_after_tax", "accrued_interest_add_tax",
                       "accrued_interest_risk_fund", "avg_open_pre_nature"]


@block
def interest_totals_df(spark) -> DataFrame:
    x = rated(interest_daily_df(spark), spark, "busi_date")
    return (x.groupBy("fund_account_id")
            .agg(*split_aggs("interest_income", "accrued_interest"),
                 F.sum("interest_base").alias("avg_open_pre_nature"))
            .na.fill(0))


INTEREST_TOTALS_SQL = f"""(SELECT t.fund_account_id, {split_sql('t.interest_income', 'accrued_interest')},
  sum(t.interest_base) AS avg_open_pre_nature
FROM {rated_sql(INTEREST_DAILY_SQL, 't.busi_date')} GROUP BY t.fund_account_id)"""


@query("interest_totals", rounded_sql(INTEREST_TOTAL_COLS, f"{INTEREST_TOTALS_SQL} i"))
def interest_totals(spark):
    """Interest totals with tax split; natural-day average base."""
    return rounded(interest_totals_df(spark))


# ----------------------------------------------------------- B8 investor value

IV_COLS = ["transfee_reward_soft", "remain_transfee", "market_ret", "remain_transfee_after_tax",
           "remain_transfee_add_tax", "remain_risk_fund", "interest_base", "client_interest_settlement",
           "client_interest_after_tax", "client_interest_add_tax", "client_interest_risk_fund",
           "other_income", "other_income_after_tax", "other_income_add_tax", "other_income_risk_fund",
           "market_ret_client", "transfee_reward_client", "totla_client_ret"]
CLIENT_COLS = ["client_interest_settlement", "client_interest_after_tax", "client_interest_add_tax",
               "client_interest_risk_fund", "market_ret_client"]


@block
def investor_value_df(spark) -> DataFrame:
    """Investor monthly value; client interest / rebate start at 0 and are
    MERGE-updated from the client cash paid in the month."""
    p = run_params(spark)
    v = dated(spark, "adm_investor_value", p.month_start_dash, p.month_start_dash)
    inv = spark.table("dc_investor").select(F.col("investor_id").alias("__inv"), "orig_department_id")
    v = v.join(inv, F.col("investor_id") == F.col("__inv")).drop("__inv")
    v = with_oa_branch(v, spark, "orig_department_id").withColumn("__d", fn.compact_date("date_dt"))
    v = lookup_rates(v, resolved_rates(spark), "oa_branch_id", "__d", TAX3)
    vat, sur, risk = (F.coalesce(F.col(c), F.lit(0)) for c in ("vat", "surtax", "risk"))
    s = F.col("subsistence_fee_amt")
    o = F.col("oth_amt")
    zero = F.lit(0.0)
    iv = (v.groupBy(F.col("investor_id").alias("fund_account_id"))
          .agg(fn.money(F.sum("soft_amt")).alias("transfee_reward_soft"),
               fn.money(F.sum(s)).alias("remain_transfee"),
               fn.money(F.sum("exchangeret_amt")).alias("market_ret"),
               fn.money(F.sum(s / (1 + vat))).alias("remain_transfee_after_tax"),
               fn.money(F.sum(s * sur)).alias("remain_transfee_add_tax"),
               F.round(F.sum(s * risk).cast("decimal(16,4)"), 2).cast("double").alias("remain_risk_fund"),
               fn.money(F.sum("calint_amt")).alias("interest_base"),
               zero.alias("client_interest_settlement"), zero.alias("client_interest_after_tax"),
               zero.alias("client_interest_add_tax"), zero.alias("client_interest_risk_fund"),
               fn.money(F.sum(o)).alias("other_income"),
               fn.money(F.sum(o / (1 + vat))).alias("other_income_after_tax"),
               fn.money(F.sum(o * sur)).alias("other_income_add_tax"),
               fn.money(F.sum(o * risk), 0).alias("other_income_risk_fund"),
               zero.alias("market_ret_client"), zero.alias("transfee_reward_client"))
          .na.fill(0))
    paid = (rated(cash_daily_df(spark), spark, "busi_date").groupBy("fund_account_id")
            .agg(*split_aggs("interest_paid", "client_interest"), F.sum("rebate_paid").alias("market_ret_client"))
            .withColumnRenamed("client_interest", "client_interest_settlement")
            .na.fill(0))
    iv = merge_update(iv, paid, ["fund_account_id"], CLIENT_COLS)
    return iv.withColumn("totla_client_ret", F.col("client_interest_settlement") + F.col("market_ret_client")
                         + F.col("transfee_reward_client"))


def _cr(x):
    return f"coalesce({x}, 0)"


INVESTOR_VALUE_SQL = f"""(SELECT v.*, v.client_interest_settlement + v.market_ret_client + v.transfee_reward_client AS totla_client_ret
FROM (SELECT iv.fund_account_id, iv.transfee_reward_soft, iv.remain_transfee, iv.market_ret,
  iv.remain_transfee_after_tax, iv.remain_transfee_add_tax, iv.remain_risk_fund, iv.interest_base,
  coalesce(p.client_interest_settlement, iv.client_interest_settlement) AS client_interest_settlement,
  coalesce(p.client_interest_after_tax, iv.client_interest_after_tax) AS client_interest_after_tax,
  coalesce(p.client_interest_add_tax, iv.client_interest_add_tax) AS client_interest_add_tax,
  coalesce(p.client_interest_risk_fund, iv.client_interest_risk_fund) AS client_interest_risk_fund,
  iv.other_income, iv.other_income_after_tax, iv.other_income_add_tax, iv.other_income_risk_fund,
  coalesce(p.market_ret_client, iv.market_ret_client) AS market_ret_client, iv.transfee_reward_client
FROM (SELECT t.investor_id AS fund_account_id,
   {_cr(rnd('sum(t.soft_amt)'))} AS transfee_reward_soft,
   {_cr(rnd('sum(t.subsistence_fee_amt)'))} AS remain_transfee,
   {_cr(rnd('sum(t.exchangeret_amt)'))} AS market_ret,
   {_cr(rnd('sum(t.subsistence_fee_amt / (1 + coalesce(r_vat.para_value, 0)))'))} AS remain_transfee_after_tax,
   {_cr(rnd('sum(t.subsistence_fee_amt * coalesce(r_surtax.para_value, 0))'))} AS remain_transfee_add_tax,
   {_cr('cast(round(cast(sum(t.subsistence_fee_amt * coalesce(r_risk.para_value, 0)) as decimal(16,4)), 2) as double)')} AS remain_risk_fund,
   {_cr(rnd('sum(t.calint_amt)'))} AS interest_base,
   0.0 AS client_interest_settlement, 0.0 AS client_interest_after_tax, 0.0 AS client_interest_add_tax,
   0.0 AS client_interest_risk_fund,
   {_cr(rnd('sum(t.oth_amt)'))} AS other_income,
   {_cr(rnd('sum(t.oth_amt / (1 + coalesce(r_vat.para_value, 0)))'))} AS other_income_after_tax,
   {_cr(rnd('sum(t.oth_amt * coalesce(r_surtax.para_value, 0))'))} AS other_income_add_tax,
   {_cr(rnd('sum(t.oth_amt * coalesce(r_risk.para_value, 0))', 0))} AS other_income_risk_fund,
   0.0 AS market_ret_client, 0.0 AS transfee_reward_client
  FROM adm_investor_value t JOIN dc_investor b ON t.investor_id = b.investor_id
  JOIN branch_oa_rela x ON b.orig_department_id = x.ctp_branch_id
  LEFT JOIN rate_param r_vat ON instr(r_vat.branch_id, x.oa_branch_id) > 0 AND r_vat.fee_type = '1004'
       AND replace(t.date_dt, '-', '') BETWEEN r_vat.begin_date AND r_vat.end_date
  LEFT JOIN rate_param r_surtax ON instr(r_surtax.branch_id, x.oa_branch_id) > 0 AND r_surtax.fee_type = '1005'
       AND replace(t.date_dt, '-', '') BETWEEN r_surtax.begin_date AND r_surtax.end_date
  LEFT JOIN rate_param r_risk ON instr(r_risk.branch_id, x.oa_branch_id) > 0 AND r_risk.fee_type = '1002'
       AND replace(t.date_dt, '-', '') BETWEEN r_risk.begin_date AND r_risk.end_date
  WHERE t.date_dt = '{D0}'
  GROUP BY t.investor_id) iv
LEFT JOIN (SELECT t.fund_account_id,
   coalesce(sum(t.interest_paid), 0) AS client_interest_settlement,
   coalesce(sum(t.interest_paid / (1 + coalesce(r_vat.para_value, 0))), 0) AS client_interest_after_tax,
   coalesce(sum(t.interest_paid * coalesce(r_surtax.para_value, 0)), 0) AS client_interest_add_tax,
   coalesce(sum(t.interest_paid * coalesce(r_risk.para_value, 0)), 0) AS client_interest_risk_fund,
   coalesce(sum(t.rebate_paid), 0) AS market_ret_client
  FROM {rated_sql(CASH_DAILY_SQL, 't.busi_date')} GROUP BY t.fund_account_id) p
ON iv.fund_account_id = p.fund_account_id) v)"""


@query("investor_month_value", rounded_sql(IV_COLS, f"{INVESTOR_VALUE_SQL} v", {"other_income_risk_fund": 0}))
def investor_month_value(spark):
    """Investor monthly value with tax split, client columns MERGE-updated."""
    return rounded(investor_value_df(spark), {"other_income_risk_fund": 0}).select("fund_account_id", *IV_COLS)


# ----------------------------------------------------------- B9 net interest

NET_INTEREST_COLS = ["net_interest_reduce", "net_interest_reduce_after_tax", "interest_add_tax", "interest_risk_fund"]


@block
def net_interest_df(spark) -> DataFrame:
    """Accrued interest minus client interest paid (subtrahend NULL -> 0), zero-filled."""
    return net_interest_of(spark, interest_totals_df(spark), investor_value_df(spark))


def net_interest_cols():
    """Net interest from the columns of the interest totals and the investor value of one account."""
    pairs = zip(NET_INTEREST_COLS, INTEREST_TOTAL_COLS, CLIENT_COLS)
    return [F.coalesce(F.col(a) - F.coalesce(F.col(b), F.lit(0)), F.lit(0.0)).alias(out) for out, a, b in pairs]


def net_interest_of(spark, totals: DataFrame, value: DataFrame) -> DataFrame:
    x = spark.table("fund_account").select("fund_account_id")
    v = value.select("fund_account_id", *CLIENT_COLS[:4])
    j = x.join(totals, "fund_account_id", "left").join(v, "fund_account_id", "left")
    return j.select("fund_account_id", *net_interest_cols())


NET_INTEREST_SQL = f"""(SELECT x.fund_account_id,
  coalesce(t.accrued_interest - coalesce(v.client_interest_settlement, 0), 0) AS net_interest_reduce,
  coalesce(t.accrued_interest_after_tax - coalesce(v.client_interest_after_tax, 0), 0) AS net_interest_reduce_after_tax,
  coalesce(t.accrued_interest_add_tax - coalesce(v.client_interest_add_tax, 0), 0) AS interest_add_tax,
  coalesce(t.accrued_interest_risk_fund - coalesce(v.client_interest_risk_fund, 0), 0) AS interest_risk_fund
FROM fund_account x LEFT JOIN {INTEREST_TOTALS_SQL} t ON x.fund_account_id = t.fund_account_id
LEFT JOIN {INVESTOR_VALUE_SQL} v ON x.fund_account_id = v.fund_account_id)"""


@query("net_interest", rounded_sql(NET_INTEREST_COLS, f"{NET_INTEREST_SQL} n"))
def net_interest(spark):
    """Net interest, four variants."""
    return rounded(net_interest_df(spark))


# ----------------------------------------------------------- B10 broker measures

BROKER_BASES = ["csperson_rebate", "csperson_ret", "csperson_interest", "ib_rebate", "ib_ret",
                "ib_interest", "staff_remain_comm", "staff_ret", "staff_interest", "other_pay"]
TAX_SUFFIXES = ("", "_after_tax", "_add_tax", "_risk_fund")


def tax_col(base: str, suffix: str) -> str:
    """Column of a base's tax variant; the target's own spelling differs for one base."""
    if base == "csperson_rebate" and suffix in ("_add_tax", "_risk_fund"):
        base = "csperson_remain"
    return base + suffix


BROKER_COLS = [tax_col(b, s) for b in BROKER_BASES for s in TAX_SUFFIXES]
BROKER_TAX = {"vat": "1004", "surtax": "1006", "risk": "1002"}
BROKER_KEYS = ("oa_broker_id", "rela_type", "fund_account_id")


@block
def broker_measures_df(spark) -> DataFrame:
    """(broker, relation, account) measures: 10 bases x tax split (surtax 1006).

    Header amounts repeat for every detail row of an account (left join).
    """
    p = run_params(spark)
    v = dated(spark, "adm_investor_value", p.month_start_dash, p.month_start_dash).alias("a")
    inv = spark.table("dc_investor").select(F.col("investor_id").alias("__inv"), "orig_department_id")
    org = spark.table("dc_org").select("department_id")
    det = dated(spark, "adm_brokerdata_detail", p.month_start_dash, p.month_start_dash).filter(F.col("rec_freq") == "M").alias("a2")
    x = (v.join(inv, F.col("a.investor_id") == F.col("__inv"))
         .join(org, F.col("orig_department_id") == F.col("department_id"))
         .join(det, (F.col("a.date_dt") == F.col("a2.tx_dt")) & (F.col("a.investor_id") == F.col("a2.investor_id")),
               "left"))
    x = with_oa_branch(x, spark, "orig_department_id").withColumn("__d", fn.compact_date("a.date_dt"))
    x = lookup_rates(x, resolved_rates(spark), "oa_branch_id", "__d", BROKER_TAX)
    zd = F.col("a2.staff_id").like("ZD%")
    bases = {
        "csperson_rebate": F.col("a.broker_amt"), "csperson_ret": F.col("a.broker_eret_amt"),
        "csperson_interest": F.col("a.broker_int_amt"),
        "ib_rebate": F.when(zd, F.col("a.broker_amt")).otherwise(0),
        "ib_ret": F.when(zd, F.col("a.broker_eret_amt")).otherwise(0),
        "ib_interest": F.when(zd, F.col("a.broker_int_amt")).otherwise(0),
        "staff_remain_comm": F.coalesce(F.col("a2.ib_amt"), F.col("a.staff_amt")),
        "staff_ret": F.col("a.staff_eret_amt"),
        "staff_interest": F.coalesce(F.col("a2.staff_int_amt"), F.col("a.staff_int_amt")),
        "other_pay": F.col("a.i_oth_amt"),
    }
    aggs = []
    for name, amt in bases.items():
        vat, sur, risk = (F.coalesce(F.col(c), F.lit(0)) for c in ("vat", "surtax", "risk"))
        aggs += [fn.money(F.sum(amt)).alias(name),
                 fn.money(F.sum(amt / (1 + vat))).alias(tax_col(name, "_after_tax")),
                 fn.money(F.sum(amt * sur)).alias(tax_col(name, "_add_tax")),
                 fn.money(F.sum(amt * risk)).alias(tax_col(name, "_risk_fund"))]
    return (x.groupBy(F.coalesce(F.col("a2.staff_id"), F.lit("-")).alias("oa_broker_id"),
                      fn.relation_label(F.col("a2.srela_typ")).alias("rela_type"),
                      F.col("a.investor_id").alias("fund_account_id"))
            .agg(*aggs).na.fill(0))


def _broker_sql() -> str:
    zd = "a2.staff_id LIKE 'ZD%'"
    bases = {
        "csperson_rebate": "a.broker_amt", "csperson_ret": "a.broker_eret_amt", "csperson_interest": "a.broker_int_amt",
        "ib_rebate": f"CASE WHEN {zd} THEN a.broker_amt ELSE 0 END",
        "ib_ret": f"CASE WHEN {zd} THEN a.broker_eret_amt ELSE 0 END",
        "ib_interest": f"CASE WHEN {zd} THEN a.broker_int_amt ELSE 0 END",
        "staff_remain_comm": "coalesce(a2.ib_amt, a.staff_amt)", "staff_ret": "a.staff_eret_amt",
        "staff_interest": "coalesce(a2.staff_int_amt, a.staff_int_amt)", "other_pay": "a.i_oth_amt",
    }
    aggs = []
    for n, e in bases.items():
        aggs += [f"{_cr(rnd(f'sum({e})'))} AS {n}",
                 f"{_cr(rnd(f'sum(({e}) / (1 + coalesce(r_vat.para_value, 0)))'))} AS {tax_col(n, '_after_tax')}",
                 f"{_cr(rnd(f'sum(({e}) * coalesce(r_surtax.para_value, 0))'))} AS {tax_col(n, '_add_tax')}",
                 f"{_cr(rnd(f'sum(({e}) * coalesce(r_risk.para_value, 0))'))} AS {tax_col(n, '_risk_fund')}"]
    d = "replace(a.date_dt, '-', '')"
    joins = "\n".join(
        f"LEFT JOIN rate_param r_{k} ON instr(r_{k}.branch_id, x.oa_branch_id) > 0 AND r_{k}.fee_type = '{ft}' "
        f"AND {d} BETWEEN r_{k}.begin_date AND r_{k}.end_date" for k, ft in BROKER_TAX.items())
    return f"""(SELECT coalesce(a2.staff_id, '-') AS oa_broker_id,
  CASE a2.srela_typ WHEN '301' THEN '居间关系' WHEN '001' THEN '开发关系' WHEN '002' THEN '服务关系'
       WHEN '003' THEN '维护关系' ELSE '-' END AS rela_type,
  a.investor_id AS fund_account_id,
  {', '.join(aggs)}
FROM adm_investor_value a JOIN dc_investor b ON a.investor_id = b.investor_id
JOIN dc_org c ON b.orig_department_id = c.department_id
LEFT JOIN adm_brokerdata_detail a2 ON a.date_dt = a2.tx_dt AND a.investor_id = a2.investor_id AND a2.rec_freq = 'M'
JOIN branch_oa_rela x ON b.orig_department_id = x.ctp_branch_id
{joins}
WHERE a.date_dt = '{D0}'
GROUP BY coalesce(a2.staff_id, '-'),
  CASE a2.srela_typ WHEN '301' THEN '居间关系' WHEN '001' THEN '开发关系' WHEN '002' THEN '服务关系'
       WHEN '003' THEN '维护关系' ELSE '-' END, a.investor_id)"""


BROKER_SQL = _broker_sql()


@query("broker_measures", f"SELECT * FROM {BROKER_SQL} b")
def broker_measures(spark):
    """Broker-relationship measures (40 columns)."""
    return broker_measures_df(spark)


# ----------------------------------------------------------- B11 spine

SPINE_COLS = ["month_id", "branch_id", "branch_name", "oa_broker_id", "oa_broker_name", "rela_type",
              "csperson_name", "fund_account_id", "client_name", "is_main"]


@block
def ledger_spine_df(spark) -> DataFrame:
    """Valid relationships x broker x department x investor x org, active and
    recently closed accounts, with a deterministic main-row flag."""
    p = run_params(spark)
    # dash-form strings order like the compact form: compare them directly so
    # the validity predicate reaches the parquet scan
    a = spark.table("crm_broker_investor_rela").alias("a").filter(
        (F.col("end_dt") >= p.month_start_dash) & (F.col("st_dt") <= p.month_end_dash) & (F.col("rela_sts") == "A"))
    b = spark.table("crm_broker").alias("b")
    f = spark.table("mdp_dept00").alias("f")
    c = spark.table("dc_investor").alias("c")
    d = spark.table("dc_org").alias("d")
    x = spark.table("fund_account").select("fund_account_id", "isactive", "close_date").alias("x")
    j = (a.join(b, F.col("a.broker_id") == F.col("b.broker_id"))
         .join(f, F.col("b.department_id") == F.col("f.chdeptcode"))
         .join(c, F.col("a.investor_id") == F.col("c.investor_id"))
         .join(d, F.col("c.orig_department_id") == F.col("d.department_id"))
         .join(x, F.col("a.investor_id") == F.col("x.fund_account_id"), "left"))
    active = F.col("x.isactive") == "0"
    closed = (F.col("x.isactive") == "3") & (F.col("x.close_date").between(p.month_start, p.last_trade_day) | (F.col("x.close_date") >= p.month_end))
    sel = [F.lit(p.month_id).alias("month_id"), F.col("d.department_id").alias("branch_id"),
           F.col("d.department_nam").alias("branch_name"),
           F.coalesce(F.col("a.broker_id"), F.lit("-")).alias("oa_broker_id"),
           F.coalesce(F.col("b.broker_nam"), F.lit("-")).alias("oa_broker_name"),
           fn.relation_label(F.col("a.broker_rela_typ")).alias("rela_type"),
           F.lit("").alias("csperson_name"), F.col("a.investor_id").alias("fund_account_id"),
           F.col("c.investor_nam").alias("client_name")]
    # the two populations are disjoint; one filter replaces the UNION ALL
    s = j.filter(active | closed).select(*sel)
    # skew-safe row_number() over (partition by account order by broker, relation, branch)
    return row_number_by(s, ["fund_account_id"], ["oa_broker_id", "rela_type", "branch_id"], "is_main")


SPINE_SQL = f"""(SELECT s.*, CAST(row_number() OVER (PARTITION BY fund_account_id
                 ORDER BY oa_broker_id, rela_type, branch_id) AS INTEGER) AS is_main
FROM (SELECT '{P.month_id}' AS month_id, d.department_id AS branch_id, d.department_nam AS branch_name,
        coalesce(a.broker_id, '-') AS oa_broker_id, coalesce(b.broker_nam, '-') AS oa_broker_name,
        CASE a.broker_rela_typ WHEN '301' THEN '居间关系' WHEN '001' THEN '开发关系' WHEN '002' THEN '服务关系'
             WHEN '003' THEN '维护关系' ELSE '-' END AS rela_type,
        '' AS csperson_name, a.investor_id AS fund_account_id, c.investor_nam AS client_name
      FROM crm_broker_investor_rela a JOIN crm_broker b ON a.broker_id = b.broker_id
      JOIN mdp_dept00 f ON b.department_id = f.chdeptcode
      JOIN dc_investor c ON a.investor_id = c.investor_id
      JOIN dc_org d ON c.orig_department_id = d.department_id
      LEFT JOIN fund_account x ON a.investor_id = x.fund_account_id
      WHERE replace(a.end_dt, '-', '') >= '{M0}' AND replace(a.st_dt, '-', '') <= '{ME}' AND a.rela_sts = 'A'
        AND (x.isactive = '0' OR (x.isactive = '3' AND (x.close_date BETWEEN '{M0}' AND {LT}
                                                         OR x.close_date >= '{ME}')))) s)"""


@query("ledger_spine", f"SELECT * FROM {SPINE_SQL} s")
def ledger_spine(spark):
    """The ledger spine."""
    return ledger_spine_df(spark)


# ----------------------------------------------------------- A7 / B12 balances

BALANCE_COLS = ["yes_rights", "end_rights", "avg_rights", "total_profit", "transfee", "market_transfee"]


@block
def period_balances_df(spark) -> DataFrame:
    """Opening (first trade day), closing (last trade day) and average
    (sum / trade days, guarded) balances plus profit and fee sums."""
    p = run_params(spark)
    s = dated(spark, "client_sett", p.first_trade_day, p.last_trade_day)
    td = p.trade_days
    return (s.groupBy("fund_account_id")
            .agg(F.sum(F.when(F.col("busi_date") == p.first_trade_day, F.col("yes_rights")).otherwise(0)).alias("yes_rights"),
                 F.sum(F.when(F.col("busi_date") == p.last_trade_day, F.col("rights")).otherwise(0)).alias("end_rights"),
                 F.sum(F.when(F.lit(td) > 0, F.col("rights") / F.lit(max(td, 1))).otherwise(0)).alias("avg_rights"),
                 F.sum(F.col("hold_profit") + F.col("close_profit")).alias("total_profit"),
                 F.sum(F.col("transfee") + F.col("delivery_transfee") + F.col("strikefee")).alias("transfee"),
                 F.sum(F.col("market_transfee") + F.col("market_delivery_transfee") + F.col("market_strikefee"))
                 .alias("market_transfee"))
            .na.fill(0))


BALANCES_SQL = f"""(SELECT fund_account_id,
  coalesce(sum(CASE WHEN busi_date = {FT} THEN yes_rights ELSE 0 END), 0) AS yes_rights,
  coalesce(sum(CASE WHEN busi_date = {LT} THEN rights ELSE 0 END), 0) AS end_rights,
  coalesce(sum(CASE WHEN {P.trade_days} > 0 THEN rights / greatest({P.trade_days}, 1) ELSE 0 END), 0) AS avg_rights,
  coalesce(sum(hold_profit + close_profit), 0) AS total_profit,
  coalesce(sum(transfee + delivery_transfee + strikefee), 0) AS transfee,
  coalesce(sum(market_transfee + market_delivery_transfee + market_strikefee), 0) AS market_transfee
FROM client_sett WHERE busi_date BETWEEN {FT} AND {LT} GROUP BY fund_account_id)"""


@query("period_balances", rounded_sql(BALANCE_COLS, f"{BALANCES_SQL} b"))
def period_balances(spark):
    """Opening / closing / average balance for the month."""
    return rounded(period_balances_df(spark))


def _spine_with_zero(spark, cols) -> DataFrame:
    s = ledger_spine_df(spark)
    return s.select(*s.columns, *[F.lit(0.0).alias(c) for c in cols])


@query("ledger_balances", rounded_sql(BALANCE_COLS, f"""(SELECT s.*, {', '.join(f'coalesce(b.{c}, 0.0) AS {c}' for c in BALANCE_COLS)}
FROM {SPINE_SQL} s LEFT JOIN {BALANCES_SQL} b ON s.fund_account_id = b.fund_account_id) x""",
                                    keys=tuple(SPINE_COLS)))
def ledger_balances(spark):
    """Period balances MERGE-updated onto the spine."""
    t = _spine_with_zero(spark, BALANCE_COLS)
    return rounded(merge_update(t, period_balances_df(spark), ["fund_account_id"], BALANCE_COLS))


# ----------------------------------------------------------- B1 merge-update

MERGE_COND = "b.end_rights > 100000 AND a.rela_type <> '-'"


@query("merge_update", f"""
SELECT {', '.join('s.' + c for c in SPINE_COLS)}, {', '.join(f'coalesce(b.{c}, 0.0) AS {c}' for c in BALANCE_COLS)}
FROM {SPINE_SQL} s LEFT JOIN (SELECT fund_account_id, {', '.join(rnd(c) + ' AS ' + c for c in BALANCE_COLS)}
                              FROM {BALANCES_SQL} q) b ON s.fund_account_id = b.fund_account_id""")
def merge_update_q(spark):
    """B1: MERGE-update (matched rows take coalesce(source, target))."""
    t = _spine_with_zero(spark, BALANCE_COLS)
    return merge_update(t, rounded(period_balances_df(spark)), ["fund_account_id"], BALANCE_COLS)


@query("merge_update_conditional", f"""
SELECT {', '.join('a.' + c for c in SPINE_COLS)},
  {', '.join(f"CASE WHEN b.fund_account_id IS NOT NULL AND {MERGE_COND} THEN coalesce(b.{c}, 0.0) ELSE 0.0 END AS {c}" for c in BALANCE_COLS)}
FROM {SPINE_SQL} a LEFT JOIN (SELECT fund_account_id, {', '.join(rnd(c) + ' AS ' + c for c in BALANCE_COLS)}
                              FROM {BALANCES_SQL} q) b ON a.fund_account_id = b.fund_account_id""")
def merge_update_conditional(spark):
    """B1: MERGE-update limited by a textual condition over target and source."""
    t = _spine_with_zero(spark, BALANCE_COLS)
    return merge_update(t, rounded(period_balances_df(spark)), ["fund_account_id"], BALANCE_COLS,
                        condition=MERGE_COND)


# ----------------------------------------------------------- B13 turnover

TURNOVER_COLS = ["done_money", "done_amount", "secu_fee"]


@block
def turnover_df(spark) -> DataFrame:
    p = run_params(spark)
    h = dated(spark, "hold_balance", p.first_trade_day, p.last_trade_day)
    h = with_oa_branch(h, spark, "branch_id")
    h = lookup_rates(h, resolved_rates(spark), "oa_branch_id", "busi_date", {"rate": "1003"})
    return (h.groupBy("fund_account_id")
            .agg(F.sum("done_sum").alias("done_money"), F.sum("done_amt").alias("done_amount"),
                 F.sum(F.col("done_sum") * F.coalesce(F.col("rate"), F.lit(0))).alias("secu_fee"))
            .na.fill(0))


TURNOVER_SQL = f"""(SELECT t.fund_account_id, sum(t.done_sum) AS done_money, sum(t.done_amt) AS done_amount,
  sum(t.done_sum * coalesce(c.para_value, 0)) AS secu_fee
FROM hold_balance t JOIN branch_oa_rela x ON t.branch_id = x.ctp_branch_id
LEFT JOIN rate_param c ON instr(c.branch_id, x.oa_branch_id) > 0 AND c.fee_type = '1003'
     AND t.busi_date BETWEEN c.begin_date AND c.end_date
WHERE t.busi_date BETWEEN {FT} AND {LT}
GROUP BY t.fund_account_id)"""


@query("turnover_fee", rounded_sql(TURNOVER_COLS, f"{TURNOVER_SQL} t", {"secu_fee": 4}))
def turnover_fee(spark):
    """Turnover lots / money and protection-fund fee (money x rate 1003)."""
    return rounded(turnover_df(spark), {"secu_fee": 4})


# ----------------------------------------------------------- B14 income totals

INCOME_COLS = ["total_income", "total_income_after_tax", "total_income_add_tax", "total_income_risk_fund"]


@block
def income_totals_df(spark) -> DataFrame:
    return income_totals_of(spark, investor_value_df(spark), net_rebate_df(spark), net_interest_df(spark))


_INCOME_PARTS = [("remain_transfee", "market_ret_reduce", "net_interest_reduce"),
                 ("remain_transfee_after_tax", "market_ret_reduce_after_tax", "net_interest_reduce_after_tax"),
                 ("remain_transfee_add_tax", "market_ret_add_tax", "interest_add_tax"),
                 ("remain_risk_fund", "market_ret_risk_fund", "interest_risk_fund")]


def income_cols():
    """Income from an account's retained fee, net rebate and net interest; an absent part counts as 0."""
    return [sum((F.coalesce(F.col(c), F.lit(0.0)) for c in parts[1:]), F.coalesce(F.col(parts[0]), F.lit(0.0))).alias(out)
            for out, parts in zip(INCOME_COLS, _INCOME_PARTS)]


def income_totals_of(spark, value: DataFrame, rebate: DataFrame, interest: DataFrame) -> DataFrame:
    x = spark.table("fund_account").select("fund_account_id")
    v = value.select("fund_account_id", *[p[0] for p in _INCOME_PARTS])
    j = x.join(v, "fund_account_id", "left").join(rebate, "fund_account_id", "left").join(interest, "fund_account_id", "left")
    return j.select("fund_account_id", *income_cols())


INCOME_SQL = f"""(SELECT x.fund_account_id,
  coalesce(v.remain_transfee, 0) + coalesce(r.market_ret_reduce, 0) + coalesce(n.net_interest_reduce, 0) AS total_income,
  coalesce(v.remain_transfee_after_tax, 0) + coalesce(r.market_ret_reduce_after_tax, 0)
    + coalesce(n.net_interest_reduce_after_tax, 0) AS total_income_after_tax,
  coalesce(v.remain_transfee_add_tax, 0) + coalesce(r.market_ret_add_tax, 0) + coalesce(n.interest_add_tax, 0) AS total_income_add_tax,
  coalesce(v.remain_risk_fund, 0) + coalesce(r.market_ret_risk_fund, 0) + coalesce(n.interest_risk_fund, 0) AS total_income_risk_fund
FROM fund_account x LEFT JOIN {INVESTOR_VALUE_SQL} v ON x.fund_account_id = v.fund_account_id
LEFT JOIN {NET_REBATE_SQL} r ON x.fund_account_id = r.fund_account_id
LEFT JOIN {NET_INTEREST_SQL} n ON x.fund_account_id = n.fund_account_id)"""


@query("income_totals", rounded_sql(INCOME_COLS, f"{INCOME_SQL} i"))
def income_totals(spark):
    """Brokerage income = retained fee + net rebate + net interest (4 variants)."""
    return rounded(income_totals_df(spark))


# ----------------------------------------------------------- B15 expense totals

_GROUPS = {"total_csper_expend": ["csperson_rebate", "csperson_ret", "csperson_interest"],
           "total_ib_expend": ["ib_rebate", "ib_ret", "ib_interest"],
           "total_staff_expend": ["staff_remain_comm", "staff_ret", "staff_interest", "other_pay"]}
#: the 52 expense columns in the order of the target
EXPENSE_COLS = [c for total, parts in _GROUPS.items()
                for c in [tax_col(b, s) for b in parts for s in TAX_SUFFIXES] + [total + s for s in TAX_SUFFIXES]]


@block
def expense_totals_df(spark) -> DataFrame:
    """Every base measure with its tax variants and the three roll-ups: one projection of B10."""
    totals = [sum((F.col(tax_col(b, s)) for b in parts[1:]), F.col(tax_col(parts[0], s))).alias(total + s)
              for total, parts in _GROUPS.items() for s in TAX_SUFFIXES]
    return broker_measures_df(spark).select("*", *totals).select(*BROKER_KEYS, *EXPENSE_COLS)


EXPENSE_SQL = f"""(SELECT b.*,
  csperson_rebate + csperson_ret + csperson_interest AS total_csper_expend,
  csperson_rebate_after_tax + csperson_ret_after_tax + csperson_interest_after_tax AS total_csper_expend_after_tax,
  csperson_remain_add_tax + csperson_ret_add_tax + csperson_interest_add_tax AS total_csper_expend_add_tax,
  csperson_remain_risk_fund + csperson_ret_risk_fund + csperson_interest_risk_fund AS total_csper_expend_risk_fund,
  ib_rebate + ib_ret + ib_interest AS total_ib_expend,
  ib_rebate_after_tax + ib_ret_after_tax + ib_interest_after_tax AS total_ib_expend_after_tax,
  ib_rebate_add_tax + ib_ret_add_tax + ib_interest_add_tax AS total_ib_expend_add_tax,
  ib_rebate_risk_fund + ib_ret_risk_fund + ib_interest_risk_fund AS total_ib_expend_risk_fund,
  staff_remain_comm + staff_ret + staff_interest + other_pay AS total_staff_expend,
  staff_remain_comm_after_tax + staff_ret_after_tax + staff_interest_after_tax + other_pay_after_tax
    AS total_staff_expend_after_tax,
  staff_remain_comm_add_tax + staff_ret_add_tax + staff_interest_add_tax + other_pay_add_tax
    AS total_staff_expend_add_tax,
  staff_remain_comm_risk_fund + staff_ret_risk_fund + staff_interest_risk_fund + other_pay_risk_fund
    AS total_staff_expend_risk_fund
FROM {BROKER_SQL} b)"""


@query("expense_totals", rounded_sql(EXPENSE_COLS, f"{EXPENSE_SQL} e", keys=BROKER_KEYS))
def expense_totals(spark):
    """Broker, IB and staff expense roll-ups on (broker, relation, account)."""
    return rounded(expense_totals_df(spark))


# ----------------------------------------------------------- B17 retained fee

@block
def clear_remain_df(spark) -> DataFrame:
    """Net retained fee: per row subsistence - fd - return - coalesce(soft, 0)
    (NULL when any of the first three is NULL), summed per account."""
    p = run_params(spark)
    c = dated(spark, "adm_cust_01", p.first_trade_dash, p.last_trade_dash)
    e = F.col("subsistence_fee_amt") - F.col("fd_amt") - F.col("return_amt") - F.coalesce(F.col("soft_amt"), F.lit(0))
    return c.groupBy(F.col("investor_id").alias("fund_account_id")).agg(F.sum(e).alias("clear_remain_transfee"))


CLEAR_SQL = f"""(SELECT investor_id AS fund_account_id,
  sum(subsistence_fee_amt - fd_amt - return_amt - coalesce(soft_amt, 0)) AS clear_remain_transfee
FROM adm_cust_01 WHERE tx_dt BETWEEN {FT_DASH} AND {LT_DASH} GROUP BY investor_id)"""


@query("clear_remain_fee", rounded_sql(["clear_remain_transfee"], f"{CLEAR_SQL} c"))
def clear_remain_fee(spark):
    """Net retained fee per account."""
    return rounded(clear_remain_df(spark))


# ----------------------------------------------------------- B16 / B18 ledger

ACCOUNT_COLS = (BALANCE_COLS + TURNOVER_COLS + IV_COLS + NET_REBATE_COLS + ["avg_open_pre_nature", "accrued_interest"]
                + NET_INTEREST_COLS + INCOME_COLS + ["clear_remain_transfee"])
LEDGER_DIGITS = {"secu_fee": 4, "other_income_risk_fund": 0}
LEDGER_COLS = SPINE_COLS + ACCOUNT_COLS + EXPENSE_COLS + ["net_contribution"]


def net_contribution_col():
    z = [F.coalesce(F.col(c), F.lit(0.0)) for c in
         ("total_income", "other_income", "transfee_reward_soft", "secu_fee", "totla_client_ret",
          "total_csper_expend", "total_ib_expend", "total_staff_expend")]
    return z[0] + z[1] - z[2] - z[3] - z[4] - z[5] - z[6] - z[7]


def bucketed(spark, name: str, df: DataFrame, buckets: int) -> DataFrame:
    """Write an account-grain block as a table of ``buckets`` buckets by account, sorted inside, in the shared folder."""
    import uuid

    from ..session import scratch_path
    table = f"ledger_{name}_{uuid.uuid4().hex[:12]}"
    df.write.bucketBy(buckets, "fund_account_id").sortBy("fund_account_id") \
        .option("path", scratch_path(spark, f"ledger/{table}")).format("parquet").saveAsTable(table)
    return spark.table(table)


def client_revenue_ledger_df(spark) -> DataFrame:
    """The full ledger at (account, broker, relation) grain.

    Stage barrier: the spine and every measure block (each far smaller than
    the facts it aggregates) are written as their own jobs, concurrently, into
    tables bucketed by account.  The ledger is one plan over them: blocks of the same
    buckets join without an exchange, and net interest, income and net
    contribution are projections of the joined row.  Each job keeps a small
    plan, and a lost executor never recomputes a finished block.
    """
    from concurrent.futures import ThreadPoolExecutor

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # every account of the spine is in the account master, so account-grain blocks may meet it directly
    items = [("spine", ledger_spine_df(spark)), ("balances", period_balances_df(spark)),
             ("turnover", turnover_df(spark)), ("value", investor_value_df(spark)),
             ("rebate", net_rebate_df(spark)), ("interest", interest_totals_df(spark)),
             ("clear", clear_remain_df(spark)), ("broker", expense_totals_df(spark))]
    with ThreadPoolExecutor(max_workers=len(items)) as pool:
        w = dict(zip([n for n, _ in items], pool.map(lambda i: bucketed(spark, *i, buckets), items)))
    j = w["spine"]
    for b in (w["balances"], w["turnover"], w["value"].select("fund_account_id", *IV_COLS), w["rebate"],
              w["interest"].select("fund_account_id", *INTEREST_TOTAL_COLS), w["clear"]):
        j = j.join(b, "fund_account_id", "left")
    j = j.join(w["broker"], list(BROKER_KEYS), "left")
    j = j.select("*", *net_interest_cols()).select("*", *income_cols())
    # a row without a block keeps NULL; only the net contribution is null-safe
    return j.select(*SPINE_COLS, *ACCOUNT_COLS, *EXPENSE_COLS, net_contribution_col().alias("net_contribution"))


def _ledger_sql() -> str:
    blocks = [("b", BALANCES_SQL, BALANCE_COLS), ("t", TURNOVER_SQL, TURNOVER_COLS),
              ("v", INVESTOR_VALUE_SQL, IV_COLS), ("r", NET_REBATE_SQL, NET_REBATE_COLS),
              ("it", INTEREST_TOTALS_SQL, ["avg_open_pre_nature", "accrued_interest"]),
              ("n", NET_INTEREST_SQL, NET_INTEREST_COLS), ("i", INCOME_SQL, INCOME_COLS),
              ("c", CLEAR_SQL, ["clear_remain_transfee"])]
    joins = "\n".join(f"LEFT JOIN {sql} {al} ON s.fund_account_id = {al}.fund_account_id"
                      for al, sql, _ in blocks)
    acc = ", ".join(f"{al}.{c}" for al, _, cols in blocks for c in cols)
    return f"""SELECT l.*, coalesce(total_income, 0) + coalesce(other_income, 0) - coalesce(transfee_reward_soft, 0)
    - coalesce(secu_fee, 0) - coalesce(totla_client_ret, 0) - coalesce(total_csper_expend, 0)
    - coalesce(total_ib_expend, 0) - coalesce(total_staff_expend, 0) AS net_contribution
FROM (SELECT {', '.join('s.' + c for c in SPINE_COLS)}, {acc}, {', '.join('e.' + c for c in EXPENSE_COLS)}
FROM {SPINE_SQL} s
{joins}
LEFT JOIN {EXPENSE_SQL} e ON s.oa_broker_id = e.oa_broker_id AND s.rela_type = e.rela_type
  AND s.fund_account_id = e.fund_account_id) l"""


LEDGER_SQL = _ledger_sql()
_LEDGER_VALUES = ACCOUNT_COLS + EXPENSE_COLS + ["net_contribution"]


@query("client_revenue_ledger", rounded_sql(_LEDGER_VALUES, f"({LEDGER_SQL}) l", LEDGER_DIGITS, keys=tuple(SPINE_COLS)))
def client_revenue_ledger(spark):
    """B18 (flagship): the monthly client revenue ledger, rounded for comparison."""
    return rounded(client_revenue_ledger_df(spark), LEDGER_DIGITS)


def ledger_table(spark) -> DataFrame:
    """The ledger as the written table downstream jobs read (staged once)."""
    from ..sources.tables import written
    return written(spark, "client_revenue", lambda: client_revenue_ledger_df(spark))


@query("net_contribution", f"""
SELECT oa_broker_id, rela_type, fund_account_id, is_main, {rnd('net_contribution')} AS net_contribution
FROM ({LEDGER_SQL}) l""")
def net_contribution(spark):
    """Net contribution per ledger row (NULL-safe arithmetic), from the written ledger."""
    return ledger_table(spark).select("oa_broker_id", "rela_type", "fund_account_id", "is_main",
                                      fn.money("net_contribution").alias("net_contribution"))


# ----------------------------------------------------------- B2 tax split

@query("tax_split", f"""
SELECT t.fund_account_id, t.busi_date, {rnd('t.market_reduct', 4)} AS amount,
  {rnd('t.market_reduct / (1 + coalesce(r_vat.para_value, 0))', 4)} AS amount_after_tax,
  {rnd('t.market_reduct * coalesce(r_surtax.para_value, 0)', 4)} AS amount_add_tax,
  {rnd('t.market_reduct * coalesce(r_risk.para_value, 0)', 4)} AS amount_risk_fund
FROM {rated_sql(exchange_rebate_sql(), 't.busi_date')}""")
def tax_split_q(spark):
    """B2: amount -> after VAT, surtax part, risk-fund part (missing rate = 0), per row."""
    from ..operators.rates import tax_split
    x = rated(exchange_rebate_df(spark), spark, "busi_date")
    after, add, risk = tax_split(F.col("market_reduct"), F.col("vat"), F.col("surtax"), F.col("risk"))
    return x.select("fund_account_id", "busi_date", fn.money("market_reduct", 4).alias("amount"),
                    fn.money(after, 4).alias("amount_after_tax"), fn.money(add, 4).alias("amount_add_tax"),
                    fn.money(risk, 4).alias("amount_risk_fund"))

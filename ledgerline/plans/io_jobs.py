"""Sinks, scoped replace, reconciliation and the month pipeline
(SURVEY K1-K3, S4, B31, B32).

Sink queries write to a fresh folder under the shared checkpoint folder and
return the table read back, so the check sees what was actually written.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from .. import functions as fn
from ..operators.reconcile import reconcile
from ..operators.sink import declare_table, insert_into, read_table, replace_partitions, write_table
from ..params import BUSI_DATE, P, busi_date_of, run_param_sql, run_params
from ..session import scratch_path
from ..sources.tables import dated
from . import jobs, ledger, metric_jobs, posting_jobs
from .ledger import rnd
from .registry import query

M0, ME = P.month_start, P.month_end
PM0, PM1, PREV_MONTH = P.prev_month_start, P.prev_month_end, P.prev_month_id

SETT_SCHEMA = StructType([
    StructField("busi_date", StringType()), StructField("fund_account_id", StringType()),
    StructField("rights", DoubleType()), StructField("month_id", StringType()),
])


def _fresh(spark, name: str) -> str:
    return scratch_path(spark, f"sinks/{uuid.uuid4().hex[:12]}/{name}")


def _month_rows(spark, lo: str, hi: str) -> DataFrame:
    return dated(spark, "client_sett", lo, hi) \
        .select("busi_date", "fund_account_id", "rights")


# ----------------------------------------------------------- K1 / K4 partition overwrite

@query("sink_partition_overwrite", f"""
SELECT busi_date, fund_account_id, rights, '{PREV_MONTH}' AS month_id FROM client_sett
WHERE busi_date BETWEEN '{PM0}' AND '{PM1}'
UNION ALL
SELECT busi_date, fund_account_id, rights * 2 AS rights, '{P.month_id}' AS month_id FROM client_sett
WHERE busi_date BETWEEN '{M0}' AND '{ME}'""")
def sink_partition_overwrite(spark):
    """K1: write two months partitioned by month, then overwrite only the run
    month (dynamic partition overwrite); the previous month survives."""
    p = run_params(spark)
    path = _fresh(spark, "client_month")
    prev = _month_rows(spark, p.prev_month_start, p.prev_month_end)
    cur = _month_rows(spark, p.month_start, p.month_end)
    write_table(prev, path, SETT_SCHEMA, "overwrite", ["month_id"], {"month_id": p.prev_month_id})
    write_table(cur, path, SETT_SCHEMA, "overwrite", ["month_id"], {"month_id": p.month_id})
    # recomputed run month replaces its partition only
    redo = cur.withColumn("rights", F.col("rights") * 2)
    write_table(redo, path, SETT_SCHEMA, "overwrite", ["month_id"], {"month_id": p.month_id})
    return read_table(spark, path, SETT_SCHEMA).select("busi_date", "fund_account_id", "rights", "month_id")


# ----------------------------------------------------------- K2 append

@query("sink_append", f"""
SELECT busi_date, fund_account_id, rights, '{P.month_id}' AS month_id FROM client_sett
WHERE busi_date BETWEEN '{M0}' AND '{ME}'
UNION ALL
SELECT busi_date, fund_account_id, rights, '{P.month_id}' AS month_id FROM client_sett
WHERE busi_date BETWEEN '{M0}' AND '{ME}'""")
def sink_append(spark):
    """K2: append mode adds rows to what is there."""
    p = run_params(spark)
    path = _fresh(spark, "client_append")
    cur = _month_rows(spark, p.month_start, p.month_end)
    write_table(cur, path, SETT_SCHEMA, "overwrite", ["month_id"], {"month_id": p.month_id})
    write_table(cur, path, SETT_SCHEMA, "append", ["month_id"], {"month_id": p.month_id})
    return read_table(spark, path, SETT_SCHEMA)


# ----------------------------------------------------------- K3 scoped replace

ADJ_COLS = ["month_id", "adjust_proj_id", "adjust_proj", "src_branch_id", "src_branch_name", "branch_id",
            "branch_name", "index_id", "index_name", "adjust_value"]


ADJ_SCOPE = ["month_id", "adjust_proj_id"]
ADJ_SCHEMA = StructType([StructField(c, DoubleType() if c == "adjust_value" else StringType()) for c in ADJ_COLS])


def _adj_sql(key: str) -> str:
    from .registry import REGISTRY
    return f"(SELECT {', '.join(ADJ_COLS)} FROM ({REGISTRY[key][1]}) q)"


@query("scoped_replace", f"""
SELECT * FROM {_adj_sql('metric_adjust_ib_office')} a
UNION ALL SELECT * FROM {_adj_sql('metric_adjust_dept')} b
UNION ALL SELECT * FROM {_adj_sql('metric_adjust_ib_collab')} c""")
def scoped_replace_q(spark):
    """K3: several jobs share one adjustment table; each replaces only its
    (month, project) partitions.  The stale department rows are replaced, the IB
    office rows are kept, the IB collaboration rows are added."""
    dept = metric_jobs.metric_adjust_dept(spark).select(ADJ_COLS)
    office = metric_jobs.metric_adjust_ib_office(spark).select(ADJ_COLS)
    collab = metric_jobs.metric_adjust_ib_collab(spark).select(ADJ_COLS)
    path = _fresh(spark, "adjust")
    stale = dept.withColumn("adjust_value", F.col("adjust_value") * 2)
    write_table(stale.unionByName(office), path, ADJ_SCHEMA, "overwrite", ADJ_SCOPE)
    for rows, project in ((dept, "A01"), (collab, "A03")):
        replace_partitions(rows, path, ADJ_SCHEMA, _projects(spark, f"adjust_proj_id = '{project}'"))
    return read_table(spark, path, ADJ_SCHEMA).select(*ADJ_COLS)


# ----------------------------------------------------------- B32 month run

class Job:
    """A step of the month run: its output table, the run's tables it reads, and how to build it from them."""

    def __init__(self, name: str, build, reads: tuple[str, ...] = (), scopes=None):
        self.name, self.build, self.reads, self.scopes = name, build, reads, scopes


def _projects(spark, where: str) -> DataFrame:
    p = run_params(spark)
    return spark.table("proj_index_rela").where(where).select(F.lit(p.month_id).alias("month_id"), "adjust_proj_id").distinct()


def _posting(name: str, key: str, source: str) -> Job:
    return Job(name, lambda s, t: posting_jobs.post(s, key, t[source]), (source,))


#: All 22 jobs in order.  The reallocation job covers every trading day of the month.
MONTH_JOBS = [
    Job("client_revenue", lambda s, t: ledger.client_revenue_ledger_df(s)),
    Job("t_00123", lambda s, t: jobs.consulting_kernel_df(s)),
    Job("t_00124", lambda s, t: jobs.consulting_bonus_df(s)),
    _posting("t_00166", "post_consulting", "t_00123"),
    Job("t_00128_data", lambda s, t: jobs.insurance_base_of(s, t["client_revenue"]), ("client_revenue",)),
    _posting("t_00165", "post_insurance", "t_00128_data"),
    Job("t_00114_data", lambda s, t: jobs.dept_reallocation_df(s)),
    _posting("t_00300", "post_dept", "t_00114_data"),
    Job("t_00156", lambda s, t: jobs.special_client_df(s)),
    _posting("t_00164", "post_special", "t_00156"),
    Job("t_00208", lambda s, t: jobs.otc_month_df(s)),
    _posting("t_00161", "post_otc", "t_00208"),
    Job("t_00125", lambda s, t: jobs.ib_collab_of(s, t["client_revenue"]), ("client_revenue",)),
    _posting("t_00158", "post_ib_collab", "t_00125"),
    Job("t_00140", lambda s, t: jobs.ib_office_of(s, t["client_revenue"]), ("client_revenue",)),
    _posting("t_00160", "post_ib_office", "t_00140"),
    Job("t_00305", lambda s, t: metric_jobs.other_product_df(s)),
    # the adjustment jobs share one table and replace their (month, project) rows in it
    Job("t_00301", lambda s, t: metric_jobs.adjust_dept_of(s, t["t_00114_data"]), ("t_00114_data",),
        lambda s: _projects(s, "adjust_proj_id = 'A01'")),
    Job("t_00302", lambda s, t: metric_jobs.adjust_ib_office_of(s, t["t_00140"]), ("t_00140",),
        lambda s: _projects(s, "adjust_proj_id = 'A02'")),
    Job("t_00303", lambda s, t: metric_jobs.adjust_ib_collab_of(s, t["t_00125"]), ("t_00125",),
        lambda s: _projects(s, "adjust_proj_id = 'A03'")),
    Job("t_00304", lambda s, t: metric_jobs.asset_product_adjust(s), (),
        lambda s: _projects(s, f"substring(adjust_proj_id, 1, 20) = '{metric_jobs.ASSET_PREFIX}'")),
    Job("t_00306", lambda s, t: metric_jobs.passthrough_of(s, t["t_00305"]), ("t_00305",),
        lambda s: s.table("t00308").select("month_id", "adjust_proj_id").where(F.col("month_id") == run_params(s).month_id).distinct()),
]
POSTED = ["t_00166", "t_00165", "t_00300", "t_00164", "t_00161", "t_00158", "t_00160"]
_POST_TEXT = ["month_id", "func_id", "traceability_dept_id", "traceability_dept", "undertake_dept_id", "undertake_dept", "account_code",
              "account_name", "allocated_date", "allocated_project", "allocated_peoject_detail", "allocated_user"]
#: Declared schemas of the ledger and of the posting tables; what a plan makes is aligned to them by name.
TARGETS = {"client_revenue": StructType([
    StructField(c, IntegerType() if c == "is_main" else StringType() if c in ledger.SPINE_COLS else DoubleType())
    for c in ledger.LEDGER_COLS])}
TARGETS |= {name: StructType([*[StructField(c, StringType()) for c in _POST_TEXT], StructField("allocated_money", DoubleType())])
            for name in POSTED}


def run_month(spark, adjustments: DataFrame | None = None, only: tuple[str, ...] | None = None,
              tables: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Run the jobs in order; every output is written into a fresh folder of the shared checkpoint folder.

    A job gets the tables it declares, as read back, and no others; nothing of
    an earlier run is reused.  The ledger and the postings go into declared targets, partitioned by month.
    The adjustment jobs replace their (month, project) partitions of one table in place;
    ``adjustments`` is that table before the run.  ``only`` re-runs
    some jobs on the given ``tables``.
    """
    run = uuid.uuid4().hex[:12]
    out = dict(tables or {})
    adjust = scratch_path(spark, f"month/{run}/adjustments")
    before = spark.createDataFrame([], ADJ_SCHEMA) if adjustments is None else adjustments
    write_table(before, adjust, ADJ_SCHEMA, "overwrite", ADJ_SCOPE)

    def save(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"month/{run}/{name}")
        if name in TARGETS:
            table = declare_table(spark, f"{name}_{run}", path, TARGETS[name], ["month_id"])
            insert_into(df, table)
            return spark.table(table).select(*df.columns)
        write_table(df, path, df.schema)
        return read_table(spark, path, df.schema)

    for job in MONTH_JOBS:
        if only and job.name not in only:
            continue
        out[job.name] = save(job.build(spark, {name: out[name] for name in job.reads}), job.name)
        if job.scopes:
            replace_partitions(out[job.name].select(ADJ_COLS), adjust, ADJ_SCHEMA, job.scopes(spark))
    out["adjustments"] = read_table(spark, adjust, ADJ_SCHEMA).select(*ADJ_COLS)
    return out


def _pipeline_sql() -> str:
    """Postings by job and account, adjustments by project and index; each from its job's own statement."""
    from .registry import REGISTRY
    posts = [f"SELECT func_id AS job, account_code AS code, allocated_money AS value FROM ({sql()}) p"
             for sql in posting_jobs.POST_SQL.values()]
    metrics = [f"SELECT adjust_proj_id AS job, index_id AS code, adjust_value AS value FROM {_adj_sql(k)} m"
               for k in ("metric_adjust_dept", "metric_adjust_ib_office", "metric_adjust_ib_collab",
                         "asset_product_adjust", "metric_passthrough")]
    bonus = (f"SELECT 't_00124' AS job, alloca_oa_branch_id AS code, broker_income AS value "
             f"FROM ({REGISTRY['consulting_bonus_split'][1]}) b")
    return f"""SELECT job, code, {rnd('sum(value)')} AS value, count(*) AS n_rows
FROM ({' UNION ALL '.join([*posts, *metrics, bonus])}) x GROUP BY job, code"""


@query("month_pipeline", _pipeline_sql())
def month_pipeline(spark):
    """The month run in order; result = totals per job and account, project and index, and bonus branch."""
    out = run_month(spark)
    rows = [out[k].select(F.col("func_id").alias("job"), F.col("account_code").alias("code"),
                          F.col("allocated_money").alias("value")) for k in POSTED]
    rows.append(out["adjustments"].select(F.col("adjust_proj_id").alias("job"), F.col("index_id").alias("code"),
                                          F.col("adjust_value").alias("value")))
    rows.append(out["t_00124"].select(F.lit("t_00124").alias("job"), F.col("alloca_oa_branch_id").alias("code"),
                                      fn.money("broker_income", 4).alias("value")))
    total = reduce(DataFrame.unionByName, rows)
    return total.groupBy("job", "code").agg(fn.money(F.sum("value")).alias("value"), F.count(F.lit(1)).alias("n_rows"))


# ----------------------------------------------------------- S4 / B31 reconciliation

#: Pairs (written table, query whose statement gives it a second time, predicates); columns come from the schema.
RECON_PAIRS = [
    ("ledger_vs_balances", "client_revenue", "period_balances", "is_main = 1", "end_rights IS NOT NULL"),
    ("ledger_vs_turnover", "client_revenue", "turnover_fee", "is_main = 1", "done_money >= 0"),
    ("ledger_vs_expense", "client_revenue", "expense_totals", "oa_broker_id <> '-'", "oa_broker_id <> '-'"),
    ("t_00123", "t_00123", "consulting_kernel_split", None, None),
    ("t_00124", "t_00124", "consulting_bonus_split", None, None),
    ("t_00128_data", "t_00128_data", "insurance_fund_base", None, None),
    ("t_00114_data", "t_00114_data", "dept_reallocation", None, None),
    ("t_00156", "t_00156", "special_client_revenue", None, None),
    ("t_00208", "t_00208", "otc_month_copy", None, None),
    ("t_00125", "t_00125", "ib_collab_income", None, None),
    ("t_00140", "t_00140", "ib_office_income", None, None),
    ("t_00305", "t_00305", "metric_unpivot", None, None),
    ("t_00158", "t_00158", "post_ib_collab", None, None),
    ("t_00160", "t_00160", "post_ib_office", None, None),
    ("t_00161", "t_00161", "post_otc", None, None),
    ("t_00164", "t_00164", "post_special", None, None),
    ("t_00165", "t_00165", "post_insurance", None, None),
    ("t_00166", "t_00166", "post_consulting", None, None),
    ("t_00300", "t_00300", "post_dept", None, None),
    ("t_00301", "t_00301", "metric_adjust_dept", None, None),
    ("t_00302", "t_00302", "metric_adjust_ib_office", None, None),
    ("t_00303", "t_00303", "metric_adjust_ib_collab", None, None),
    ("t_00304", "t_00304", "asset_product_adjust", None, None),
    ("t_00306", "t_00306", "metric_passthrough", None, None),
]


def stated(spark, key: str) -> DataFrame:
    """What a query's SQL statement gives in Spark: the second side of a reconciliation, beside the plan that was run.

    The statements carry the process's business date.  The ledger inside them is computed from its own statement, once.
    """
    from ..sources.tables import written
    from .registry import REGISTRY
    if busi_date_of(spark) != BUSI_DATE:
        raise ValueError("the statements are those of the process's business date")
    spark.sql(run_param_sql(BUSI_DATE)).createOrReplaceTempView("run_param")
    text = _spark_words(REGISTRY[key][1])
    ledger_text = _spark_words(jobs.LEDGER)
    if ledger_text in text:
        written(spark, "stated_ledger", lambda: spark.sql(ledger_text[1:-1])).createOrReplaceTempView("stated_ledger")
        text = text.replace(ledger_text, "stated_ledger")
    return spark.sql(text)


def _spark_words(sql: str) -> str:
    """The few words that Spark spells otherwise."""
    return sql.replace(jobs.LABEL_SQL, jobs.LABEL_SPARK).replace("AS VARCHAR)", "AS STRING)").replace("* EXCLUDE (", "* EXCEPT (")


def reconcile_pairs(spark, left: dict[str, DataFrame], pairs=None) -> DataFrame:
    """One row per pair and numeric column of the right side, a query's statement run by Spark; any list of pairs."""
    parts = [reconcile(left[table], stated(spark, key), pair, lp, rp) for pair, table, key, lp, rp in pairs or RECON_PAIRS]
    return reduce(DataFrame.unionByName, parts)


#: Numeric columns of the right tables, written out for the oracle (fixed values).
RECON_COLUMNS = {
    "ledger_vs_balances": "yes_rights end_rights avg_rights total_profit transfee market_transfee",
    "ledger_vs_turnover": "done_money done_amount secu_fee",
    "ledger_vs_expense": " ".join(ledger.EXPENSE_COLS),
    "t_00123": "invest_total_service_fee kernel_total_rate alloca_kernel_rate alloca_income",
    "t_00124": "invest_total_service_fee perfor_total_rate alloca_perfor_rate broker_perfor_rate broker_income",
    "t_00128_data": "done_money bzjj",
    "t_00114_data": " ".join(jobs.DEPT_COLS),
    "t_00156": " ".join(("remain_transfee_rate", "jian_mian_rate", *jobs.SPECIAL_VALS)),
    "t_00208": "trade_orders premium_abs actual_notional_principal sale_income colla_pricing total_income",
    "t_00125": " ".join(jobs.IB_COLLAB_VALS),
    "t_00140": " ".join(jobs.IB_OFFICE_VALS),
    "t_00305": "index_value adjust_value",
    **{f"t_{n}": "adjust_value" for n in ("00301", "00302", "00303", "00304", "00306")},
}
_LEFT_SQL = {"client_revenue": "led", "t_00123": jobs.CONS_KERNEL_SQL, "t_00124": jobs.CONS_BONUS_SQL,
             "t_00128_data": jobs.INSURANCE_SQL,
             "t_00114_data": jobs.DEPT_SQL, "t_00156": jobs.SPECIAL_SQL, "t_00208": jobs.OTC_SQL,
             "t_00125": jobs.IB_COLLAB_SQL, "t_00140": jobs.IB_OFFICE_SQL, "t_00305": metric_jobs.OTHER_SQL}


def _recon_sql(pairs) -> str:
    """One sum scan per side and pair; where no second statement is at hand the query's own is the left side."""
    from .registry import REGISTRY
    ctes = [f"led AS MATERIALIZED ({ledger.LEDGER_SQL})"]
    parts = []
    for i, (pair, table, key, lp, rp) in enumerate(pairs):
        cols = RECON_COLUMNS.get(pair, "allocated_money").split()
        sums = ", ".join(f"coalesce(cast(sum(cast({c} as decimal(28,6))) as double), 0.0) AS {c}" for c in cols)
        left = _LEFT_SQL.get(table, f"({REGISTRY[key][1]})")
        ctes.append(f"l{i} AS (SELECT {sums} FROM {left} q {'WHERE ' + lp if lp else ''})")
        ctes.append(f"r{i} AS (SELECT {sums} FROM ({REGISTRY[key][1]}) r {'WHERE ' + rp if rp else ''})")
        parts += [f"SELECT '{pair}' AS pair, '{c}' AS column_name, l.{c} AS l_sum, r.{c} AS r_sum FROM l{i} l, r{i} r"
                  for c in cols]
    body = "\nUNION ALL\n".join(parts)
    return f"""WITH {', '.join(ctes)}
SELECT pair, column_name, {rnd('l_sum')} AS left_sum, {rnd('r_sum')} AS right_sum,
  abs(l_sum - r_sum) >= 0.1 AS mismatch
FROM ({body}) x"""


def _rounded_sums(out: DataFrame) -> DataFrame:
    return out.select("pair", "column_name", fn.money("left_sum").alias("left_sum"),
                      fn.money("right_sum").alias("right_sum"), "mismatch")


@query("reconcile_numeric_sums", _recon_sql(RECON_PAIRS[:3]))
def reconcile_numeric_sums(spark):
    """B31 (+ S4): the written ledger against the blocks it was merged from, by the sums of all numeric columns."""
    return _rounded_sums(reconcile_pairs(spark, {"client_revenue": ledger.ledger_table(spark)}, RECON_PAIRS[:3]))


@query("reconcile_month_run", _recon_sql(RECON_PAIRS[3:]))
def reconcile_month_run(spark):
    """Every other written table of a month run against the query that states it a second time."""
    return _rounded_sums(reconcile_pairs(spark, run_month(spark), RECON_PAIRS[3:]))

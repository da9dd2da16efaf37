"""Invariants of the ledger and the metric jobs."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_ledger_rows_equal_spine_rows(spark):
    from ledgerline.plans import ledger
    from ledgerline.sources import tables
    tables.load(spark, SF)
    spine = ledger.ledger_spine_df(spark)
    led = ledger.client_revenue_ledger_df(spark)
    assert led.count() == spine.count()
    # one main row per account
    mains = led.filter("is_main = 1").groupBy("fund_account_id").count().filter("count > 1").count()
    assert mains == 0


def test_merge_keeps_sums(spark):
    from ledgerline.plans import ledger
    from ledgerline.sources import tables
    tables.load(spark, SF)
    bal = ledger.ledger_balances(spark).filter("is_main = 1")
    src = ledger.period_balances(spark)
    spine_acc = ledger.ledger_spine_df(spark).select("fund_account_id").distinct()
    a = bal.agg(F.sum("end_rights")).collect()[0][0]
    b = src.join(spine_acc, "fund_account_id").agg(F.sum("end_rights")).collect()[0][0] or 0.0
    assert abs(a - b) < 0.01


def test_long_metrics_sum_to_wide(spark):
    from ledgerline.plans import metric_jobs
    from ledgerline.sources import tables
    tables.load(spark, SF)
    long = metric_jobs.other_product_df(spark).filter("index_id = '05' AND assignee_id = 'AS1'")
    wide = (spark.table("t00308").filter("month_id = '199706'")
            .join(spark.table("t00309").filter("assignee_id = 'AS1'").select("month_id", "src_branch_id"),
                  ["month_id", "src_branch_id"]))
    a = long.agg(F.sum("index_value")).collect()[0][0] or 0.0
    b = wide.agg(F.sum("done_money")).collect()[0][0] or 0.0
    assert abs(a - b) < 0.01


def test_month_run_uses_its_own_tables(spark):
    """A second run after a changed rate changes the postings; a re-run without rows clears its project."""
    from ledgerline.plans import io_jobs
    from ledgerline.sources import tables
    tables.load(spark, SF)
    assert len(io_jobs.MONTH_JOBS) == 22
    first = io_jobs.run_month(spark)
    total = lambda t: t["t_00161"].filter("account_code = '6403'").agg(F.sum("allocated_money")).first()[0]
    rates = spark.table("run_rate")
    spark.table("run_rate").withColumn("para_value", F.col("para_value") * 2).createOrReplaceTempView("run_rate")
    try:
        second = io_jobs.run_month(spark, only=("t_00161",), tables=first)
    finally:
        rates.createOrReplaceTempView("run_rate")
    assert abs(total(second) - 2 * total(first)) < 0.5 and total(first) > 0
    adjust = first["adjustments"]
    assert adjust.filter("adjust_proj_id = 'A03'").count() > 0
    empty = dict(first, t_00125=first["t_00125"].limit(0))
    again = io_jobs.run_month(spark, adjustments=adjust, only=("t_00303",), tables=empty)["adjustments"]
    assert again.filter("adjust_proj_id = 'A03'").count() == 0
    assert again.count() == adjust.filter("adjust_proj_id <> 'A03'").count()


def test_reconciliation_finds_a_fault_in_every_job(spark):
    """The statements agree with a month run, and with none of its tables after a fault in each job's values."""
    from pyspark.sql.types import NumericType

    from ledgerline.plans import io_jobs
    from ledgerline.sources import tables
    tables.load(spark, SF)
    run = io_jobs.run_month(spark)
    assert {job.name for job in io_jobs.MONTH_JOBS} <= {p[1] for p in io_jobs.RECON_PAIRS}
    # the ledger holds the blocks of accounts with a relationship only: its pairs show what it leaves out
    ledger, pairs = io_jobs.RECON_PAIRS[:3], io_jobs.RECON_PAIRS[3:]
    filled = {p[0] for p in pairs if run[p[1]].count()}
    good = io_jobs.reconcile_pairs(spark, run, pairs).collect()
    assert [r for r in good if r["mismatch"]] == [] and len(filled) > 15

    def faulty(t):
        numbers = [f.name for f in t.schema if isinstance(f.dataType, NumericType) and f.name != "is_main"]
        return t.select(*[(F.coalesce(F.col(c), F.lit(0)) + 1).alias(c) if c in numbers else c for c in t.columns])

    wrong = {k: faulty(t) for k, t in run.items()}
    bad = io_jobs.reconcile_pairs(spark, wrong, pairs).collect()
    assert {r["pair"] for r in bad if r["mismatch"]} == filled
    sums = lambda t: {(r["pair"], r["column_name"]): r["left_sum"] for r in io_jobs.reconcile_pairs(spark, t, ledger).collect()}
    before, after = sums(run), sums(wrong)
    assert all(abs(after[k] - before[k]) >= 0.1 for k in before)


def test_other_business_dates_match_their_oracles():
    """Two further months, one ending on a closed day, in processes of their own."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for date in ("19970531", "19960930"):
        out = subprocess.run([sys.executable, "tools/check_oracle.py", SF, "client_revenue_ledger", "cal_run_period", "post_otc",
                              "metric_unpivot"], cwd=root, env=os.environ | {"LEDGERLINE_BUSI_DATE": date},
                             capture_output=True, text=True, timeout=600)
        assert out.returncode == 0, out.stdout[-800:] + out.stderr[-800:]

"""Months: partitions read by dated scans, several business dates in a session, back-fill."""

import pytest
from pyspark.sql import functions as F

from ledgerline.params import CONF, run_params, set_busi_date
from ledgerline.plans import backfill as B
from ledgerline.plans import basic, jobs, ledger, posting_jobs
from ledgerline.sources import adapters, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def mart(spark):
    return tables.load(spark, SF)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dated_scans_read_one_month(mart):
    for df in (basic.scan_date_window(mart), basic.filter_month(mart), basic.filter_date_range(mart), basic.filter_two_month(mart)):
        assert "PartitionFilters: [isnotnull(p_month" in plan_of(df) and "PushedFilters: [" in plan_of(df)
        assert "p_month" not in df.columns
    files = [r[0] for r in basic.scan_date_window(mart).select(F.input_file_name()).distinct().collect()]
    assert files and all("p_month=199706" in f for f in files)
    assert len(mart.table("client_sett").inputFiles()) > len(files) and "p_month" not in mart.table("client_sett").columns


def test_dated_equals_a_plain_filter(mart):
    for name, (day, _) in adapters.FACTS.items():
        lo, hi = ("1996-11-20", "1997-02-03") if name in ("exchange_retfee2", "adm_cust_01", "adm_investor_value", "adm_brokerdata_detail") \
            else ("19961120", "19970203")
        got, want = tables.dated(mart, name, lo, hi), mart.table(name).filter(F.col(day).between(lo, hi))
        assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == want.count()
    assert tables.dated(mart, "client_sett", None, None).count() == 0


def test_changed_input_is_another_data_set(spark, tmp_path):
    import shutil
    from pathlib import Path
    for t in adapters.RAW_TABLES:
        shutil.copy(f"{SF}/{t}.parquet", tmp_path)
    tables.load(spark, str(tmp_path), stage=False)
    before = spark.table("branch").count()
    n = spark.read.parquet(f"{SF}/nation.parquet").toPandas().iloc[:7]
    Path(tmp_path, "nation.parquet").unlink()
    n.to_parquet(f"{tmp_path}/nation.parquet")
    tables.load(spark, str(tmp_path), stage=False)
    assert before == 25 and spark.table("branch").count() == 7
    tables.load(spark, SF)


def test_several_dates_in_a_session(mart):
    try:
        seen = {}
        for date in ("19970630", "19970531", "19960930"):
            set_busi_date(mart, date)
            p = run_params(mart)
            got = ledger.period_balances(mart)
            days = mart.table("calendar").filter(f"trade_flag = '1' and busi_date between '{date[:6]}01' and '{date}'")
            assert p.trade_days == days.count()
            want = mart.table("client_sett").join(days.select("busi_date"), "busi_date").groupBy("fund_account_id") \
                .agg(F.sum("rights").alias("r")).agg(F.sum("r"), F.count("r")).first()
            assert abs(got.agg(F.sum("avg_rights")).first()[0] * p.trade_days - want[0]) < 0.02 * p.trade_days * want[1]
            assert got.count() == want[1]
            seen[date] = want[0]
        assert len(set(seen.values())) == 3
    finally:
        mart.conf.unset(CONF)


def test_backfill_resumes(mart, tmp_path, monkeypatch):
    folder = str(tmp_path / "fill")
    days = B.listed_days("19970415", "19970630")
    real, calls = B.write_table, []

    def breaking(df, path, *rest):
        calls.append(path.rsplit("/", 1)[1])
        if len(calls) == 4:
            raise OSError("executor lost")
        return real(df, path, *rest)

    monkeypatch.setattr(B, "write_table", breaking)
    with pytest.raises(OSError):
        B.backfill(mart, days, folder)
    assert calls == [B.DAILY, B.POSTED, B.DAILY, B.POSTED]  # April whole, May's posting missing
    out = B.backfill(mart, days, folder)
    assert calls[4:] == [B.POSTED, B.DAILY, B.POSTED]  # May's days are not done twice
    steps = B.steps_done(mart, folder)
    assert steps.count() == steps.distinct().count()
    done = {r[0] for r in steps.filter(F.col("job") == B.DAILY).select("busi_date").collect()}
    assert done == set(B.trading_days(mart, days)) and "19970602" not in done and "19970630" not in done and "19970608" not in done
    assert B.backfill(mart, days, folder)[B.DAILY].count() == out[B.DAILY].count() and len(calls) == 7  # nothing left to do
    # the run month's tables are those of the month run
    month = out[B.DAILY].filter("busi_date >= '19970601'")
    want = jobs.dept_reallocation_df(mart).select(*month.columns)
    assert month.exceptAll(want).count() == 0 and month.count() == want.count() > 0
    posted = out[B.POSTED].filter("month_id = '199706'").groupBy("account_code").agg(F.sum("allocated_money").alias("m"))
    rest = posting_jobs.post(mart, "post_dept").groupBy("account_code").agg(F.sum("allocated_money").alias("m"))
    assert sorted((r[0], round(r[1], 2)) for r in posted.collect()) == sorted((r[0], round(r[1], 2)) for r in rest.collect())
    assert run_params(mart).busi_date == "19970630"


def test_rules_by_date(mart):
    """All rules of an account as written; only those that hold on the day with ``dated_rules``."""
    days = jobs.dept_daily_df(mart)
    written, dated = jobs.reallocated(mart, days), jobs.reallocated(mart, days, dated_rules=True)
    assert dated.count() <= written.count()
    rules = mart.table("t00114").select("fund_account_id", "begin_date", "end_date")
    want = days.join(rules, "fund_account_id").filter("busi_date between begin_date and end_date").count()
    assert dated.count() == want

"""A query stages what its statement asks for, and reads the same rows as from a warehouse staged whole."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.plans.registry import load_all
from ledgerline.session import scratch_path
from ledgerline.sources import adapters, tables


def day(k: int) -> dt.datetime:
    return dt.datetime(1997, 4, 20) + dt.timedelta(days=k)


@pytest.fixture
def small(spark, tmp_path):
    rnd = random.Random(3)
    segments = ["MACHINERY", "AUTOMOBILE", "FURNITURE", "BUILDING"]
    rows = {
        "region": ("r_regionkey int, r_name string", [(i, f"R{i}") for i in range(5)]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(i, f"N{i}", i % 5) for i in range(10)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                     [(i, f"C{i}", i % 10, float(i), segments[i % 4]) for i in range(40)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(i, f"S{i}", i % 10, 1.0) for i in range(10)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                 [(i, f"P{i}", f"Brand#{11 + i % 3}", "T", i, 1.0) for i in range(9)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
                   [(i, rnd.randrange(40), "O", 1000.0 + i, day(rnd.randrange(80)), rnd.choice(["1-URGENT", "2-HIGH"])) for i in range(300)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
                     [(rnd.randrange(300), i % 9, rnd.randrange(10), i % 7 + 1, 2.0, 100.0 + i, 0.05, 0.02, "R", "O", day(rnd.randrange(100)))
                      for i in range(900)]),
        "events": ("event_id long, ts timestamp, user_id long, event_type string, value double, props string",
                   [(i, day(i % 60), i % 40, rnd.choice(["purchase", "click", "signup"]), 5.0, "") for i in range(200)]),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def staged_folders(spark) -> set[str]:
    return set(glob.glob(f"{scratch_path(spark, 'warehouse').removeprefix('file:')}/*/*"))


def test_a_query_stages_what_its_statement_asks_for(spark, small):
    queries = load_all()
    for name, more in (("calendar_dim", set()), ("cal_date_series", set()), ("post_otc", set()), ("net_interest", {"rate_segment"}),
                       ("ib_collab_income", {"crm_broker_investor_rela"})):
        before = staged_folders(spark)
        queries[name][0](spark, small).count()
        new = {p.rsplit("/", 1)[1] for p in staged_folders(spark) - before}
        assert new == more | ({"calendar_base", "calendar"} if name == "calendar_dim" else set()), name


def test_rows_do_not_depend_on_what_is_staged(spark, small):
    queries = load_all()
    names = ["net_interest", "turnover_fee", "exchange_rebate", "ib_collab_income", "consulting_bonus_split", "agg_by_account_code",
             "metric_unpivot", "asset_product_adjust", "scan_sql_predicate", "special_client_revenue"]
    lazy = {n: sorted(map(str, queries[n][0](spark, small).collect())) for n in names}
    plain = {n: sorted(map(str, spark.table(n).collect())) for n in adapters.VIEWS}
    tables.load(spark, small)
    tables.forget()
    assert any(lazy.values()) and all(plain[n] for n in adapters.FACTS)
    for n in names:
        assert sorted(map(str, queries[n][0](spark, small).collect())) == lazy[n], n
    for n in adapters.VIEWS:
        assert sorted(map(str, spark.table(n).collect())) == plain[n], n


def test_the_calendar_meets_the_lines_first(spark, small):
    tables.load(spark, small, only=tables.CALENDAR)
    for name in ("hold_balance", "rpt_06008"):
        assert adapters.spark_body(name) != adapters.VIEWS[name]
        a, b = spark.sql(adapters.spark_body(name)), spark.sql(adapters.VIEWS[name])
        assert a.count() and a.exceptAll(b).count() == 0 and a.count() == b.count()
    assert spark.table("hold_balance").filter(F.col("busi_date").between("19970602", "19970603")).count() == \
        tables.dated(spark, "hold_balance", "19970602", "19970603").count()

"""Edge fixtures: NULLs, duplicates, empty inputs and boundary values."""

import pytest
from pyspark.sql import functions as F

from ledgerline import functions as fn
from ledgerline.operators.merge import merge_update
from ledgerline.operators.rates import expand_rates
from ledgerline.operators.reconcile import reconcile
from ledgerline.operators.sink import scoped_replace
from ledgerline.sources.dictionary import code_map, dictionary_sql


def test_merge_update_rules(spark):
    t = spark.createDataFrame([("a", 1.0, 10.0), ("b", 2.0, 20.0), ("c", 3.0, 30.0)], "k string, x double, y double")
    s = spark.createDataFrame([("a", None, 11.0), ("b", 5.0, None), ("z", 9.0, 9.0)], "k string, x double, y double")
    got = {r.k: (r.x, r.y) for r in merge_update(t, s, ["k"], ["x", "y"]).collect()}
    assert got == {"a": (1.0, 11.0), "b": (5.0, 20.0), "c": (3.0, 30.0)}
    got = {r.k: (r.x, r.y) for r in merge_update(t, s, ["k"], ["x", "y"], null_overwrites=True).collect()}
    assert got == {"a": (None, 11.0), "b": (5.0, None), "c": (3.0, 30.0)}
    got = {r.k: (r.x, r.y) for r in merge_update(t, s, ["k"], ["x", "y"], condition="b.y > 10").collect()}
    assert got == {"a": (1.0, 11.0), "b": (2.0, 20.0), "c": (3.0, 30.0)}


def test_merge_update_duplicate_source_fails(spark):
    t = spark.createDataFrame([("a", 1.0)], "k string, x double")
    s = spark.createDataFrame([("a", 2.0), ("a", 3.0)], "k string, x double")
    with pytest.raises(Exception, match="duplicate"):
        merge_update(t, s, ["k"], ["x"]).collect()


def test_rate_containment_and_membership(spark):
    rates = spark.createDataFrame([("1004", "O1,O2", "20000101", "20001231", 0.1),
                                   ("1004", "O12", "20000101", "20001231", 0.2)],
                                  "fee_type string, branch_id string, begin_date string, end_date string, para_value double")
    oa = spark.createDataFrame([("O1",), ("O12",), ("",)], "oa string")
    sub = sorted((r.oa_branch_id, r.para_value) for r in expand_rates(rates, oa).collect())
    assert sub == [("O1", 0.1), ("O1", 0.2), ("O12", 0.2)]  # 'O1' is contained in 'O12'
    mem = sorted((r.oa_branch_id, r.para_value) for r in expand_rates(rates, oa, "member").collect())
    assert mem == [("O1", 0.1), ("O12", 0.2)]


def test_multi_code_label(spark):
    df = spark.createDataFrame([("3",), ("1,2,3",), ("2,9",), (None,)], "c string")
    levels = spark.sql(dictionary_sql())
    df = df.withColumn("labels", code_map(levels, "report.wh_risk_level"))
    out = [r.l for r in df.select(fn.multi_code_label("c", "labels").alias("l")).collect()]
    assert out == ["C4", "C2,C3,C4", "C3", None]


def test_dictionary_groups(spark):
    levels = spark.sql(dictionary_sql()).unionAll(spark.sql("select 'own', '1', 'one' union all select 'own', '2', ''"))
    df = spark.createDataFrame([("1,2",), ("5",), ("",), (None,)], "c string")
    df = df.withColumns({g: code_map(levels, n) for g, n in (("own", "own"), ("risk", "report.wh_risk_level"), ("none", "absent"))})
    got = df.select(*[fn.multi_code_label("c", g).alias(g) for g in ("own", "risk", "none")]).collect()
    assert [r.own for r in got] == ["one", "", "", None]
    assert [r.risk for r in got] == ["C2,C3", "专业投资者", "", None]
    assert [r.none for r in got] == ["", "", "", None]
    twice = levels.unionAll(spark.sql("select 'own', '1', 'another'"))
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        df.select("c", code_map(twice, "own").alias("m")).collect()


def test_safe_divide_and_case_max(spark):
    df = spark.createDataFrame([(0.0, 1.0, None), (None, None, 2.0), (0.5, 3.0, 1.0)], "r double, a double, b double")
    out = df.select(fn.safe_divide(F.lit(10.0), "r").alias("q"), fn.case_max("a", "b").alias("m")).collect()
    assert [(x.q, x.m) for x in out] == [(10.0, None), (10.0, 2.0), (20.0, 3.0)]


def test_round_half_up(spark):
    df = spark.createDataFrame([(0.125,), (2.5,), (1.005,), (-0.125,)], "x double")
    out = [tuple(r) for r in df.select(fn.money("x", 2), fn.money("x", 0)).collect()]
    assert out == [(0.13, 0.0), (2.5, 3.0), (1.01, 1.0), (-0.13, -0.0)]


def test_reconcile_tolerance(spark):
    a = spark.createDataFrame([(1.0, 5.0, None)], "x double, y double, z double")
    b = spark.createDataFrame([(1.09, 5.11, None)], "x double, y double, z double")
    got = {r.column_name: r.mismatch for r in reconcile(a, b, "p").collect()}
    assert got == {"x": False, "y": True, "z": False}
    with pytest.raises(ValueError, match="lacks"):
        reconcile(a.drop("y"), b, "p")


def test_scoped_replace(spark):
    t = spark.createDataFrame([("05", "A", 1.0), ("06", "A", 2.0), ("06", "B", 3.0)], "m string, p string, v double")
    n = spark.createDataFrame([("06", "A", 9.0)], "m string, p string, v double")
    scope = spark.createDataFrame([("06", "A")], "m string, p string")
    got = sorted(tuple(r) for r in scoped_replace(t, n, scope).collect())
    assert got == [("05", "A", 1.0), ("06", "A", 9.0), ("06", "B", 3.0)]
    # a re-run without rows clears its scope; NULL keys are scopes like any other
    got = sorted(tuple(r) for r in scoped_replace(t, n.limit(0), scope).collect())
    assert got == [("05", "A", 1.0), ("06", "B", 3.0)]
    nulls = t.unionByName(spark.createDataFrame([("06", None, 4.0)], "m string, p string, v double"))
    got = [tuple(r) for r in scoped_replace(nulls, n.limit(0), nulls.filter("p is null").select("m", "p")).collect()]
    assert sorted(got) == [("05", "A", 1.0), ("06", "A", 2.0), ("06", "B", 3.0)]


def test_closed_account_rule(spark):
    from ledgerline.params import run_params
    from ledgerline.sources import tables
    P = run_params(tables.load(spark, "/root/testdata/sf0.001"))
    df = spark.createDataFrame([("19970531",), ("19970601",), ("19970630",), ("19970701",), (None,)], "close_date string")
    c = F.col("close_date")
    keep = [r.close_date for r in df.filter(c.between(P.month_start, P.last_trade_day) | (c >= P.month_end)).collect()]
    assert keep == ["19970601", "19970630", "19970701"]


def test_row_number_hot_group(spark):
    """One group holding most rows is numbered exactly like a window would."""
    from pyspark.sql import Window

    from ledgerline.operators.ranking import row_number_by
    rows = [("hot", i) for i in range(3000)] + [(f"g{i % 7}", i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, k int")
    got = row_number_by(df, ["g"], ["k"], "rn", spread=True, partitions=16)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("k")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # the hot group really is spread over several range partitions
    spread = (df.repartitionByRange(16, "g", "k").withColumn("p", F.spark_partition_id())
              .filter("g = 'hot'").select("p").distinct().count())
    assert spread > 4


def test_row_number_keeps_null_groups(spark):
    from ledgerline.operators.ranking import row_number_by
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 1)], "g string, k int")
    want = [("a", 1, 1), (None, 1, 1), (None, 2, 2)]
    for spread in (False, True):
        got = row_number_by(df, ["g"], ["k"], "rn", spread=spread).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


_RATES = "fee_type string, branch_id string, begin_date string, end_date string, para_value double"


def test_rate_lookup_any_date_fee_and_overlap(spark):
    from ledgerline.operators.rates import lookup_rates, rate_segments
    rates = spark.createDataFrame([("1004", "O1", "20000101", "20301231", 0.06), ("1007", "O1", "20000101", "20301231", 0.5),
                                   ("1005", "O1", "20000101", "20301231", None), ("1002", "O1", "20000101", "20301231", 0.1),
                                   ("1002", "O1", "20150101", "20151231", 0.2)], _RATES)
    dim = rate_segments(expand_rates(rates, spark.createDataFrame([("O1",), ("O2",)], "oa string")))
    facts = spark.createDataFrame([("O1", "20150601"), ("O2", "20150601"), ("O1", "19990101")], "oa string, d string")
    got = lookup_rates(facts, dim, "oa", "d", {"vat": "1004", "other": "1007"}).collect()
    assert sorted(map(tuple, got), key=str) == sorted([("O1", "20150601", 0.06, 0.5), ("O2", "20150601", None, None),
                                                       ("O1", "19990101", None, None)], key=str)
    assert lookup_rates(facts, dim, "oa", "d", {"nil": "1005"}, how="inner").collect()[0].nil is None
    assert sorted(r.risk for r in lookup_rates(facts, dim, "oa", "d", {"risk": "1002"}, how="inner").collect()) == [0.1, 0.2]
    second = rate_segments(expand_rates(rates.withColumn("para_value", F.lit(0.99)), spark.createDataFrame([("O1",)], "oa string")))
    assert lookup_rates(facts, second, "oa", "d", {"vat": "1004"}, how="inner").collect()[0].vat == 0.99


def test_run_date_rates_split_and_branch(spark):
    from ledgerline.operators.rates import run_date_rates
    rates = spark.createDataFrame([("1004", "O1,O2", "20000101", "20001231", 0.1), ("1004", "O3", "20000101", "20001231", 0.2),
                                   ("1004", "O1", "19990101", "19991231", 0.9)], _RATES)
    facts = spark.createDataFrame([("O1", 1), ("O3", 2), ("", 3)], "oa string, k int")
    plain = run_date_rates(facts, rates, "20000615", {"vat": "1004"}).collect()
    assert sorted((r.k, r.vat) for r in plain) == [(k, v) for k in (1, 2, 3) for v in (0.1, 0.2)]
    by_branch = run_date_rates(facts, rates, "20000615", {"vat": "1004"}, oa_col="oa").collect()
    assert sorted((r.k, r.vat) for r in by_branch) == [(1, 0.1), (2, 0.2)]
    assert run_date_rates(facts, rates, "20000615", {"vat": "1004", "no": "1009"}).count() == 0


def test_checkpoint_folder_is_required_on_a_cluster(spark, monkeypatch):
    from ledgerline import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_calendar_covers_the_data(spark):
    from ledgerline.sources import tables
    sf = "/root/testdata/sf0.01"
    tables.load(spark, sf, stage=False)
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    want = orders.agg(F.sum("o_totalprice")).first()[0]
    got = spark.table("client_sett").agg(F.sum("rights")).first()[0]
    assert abs(want - got) < 0.01 * orders.count()

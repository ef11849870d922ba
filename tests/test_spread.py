"""Places, ranks and percentiles of large groups: several tasks, the same values as a window gives."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelith.functions.stats import average_rank
from panelith.operators import evaluate, order, preprocess, radar
from panelith.sources import panel_table, store


@pytest.fixture(scope="module")
def one_date(spark):
    """One date of 4,000 rows, a third of them one value, beside a small date and one without values."""
    r = random.Random(2)
    rows = [("20240102", f"c{i:05d}", 7.0 if i % 3 == 0 else r.choice([float(r.randint(0, 50)), r.gauss(0, 100)]), r.gauss(0, 1), abs(r.gauss(100, 50)), f"i{i % 7}") for i in range(4000)]
    rows += [("20240103", f"c{i:05d}", float(i % 4), r.gauss(0, 1), 10.0 + i, "i1") for i in range(15)]
    rows += [("20240104", "c00001", None, None, 5.0, "i1"), ("20240104", "c00002", None, 1.0, None, None), (None, "c00003", 3.0, 1.0, 2.0, "i2")]
    return store.stored(spark.createDataFrame(rows, "trade_date string, ts_code string, f double, y double, total_mv double, sw_l1_name string").repartition(6))


def same(a, b, keys):
    """Rows equal one by one, doubles to nine digits."""
    assert sorted(a.columns) == sorted(b.columns)
    rows = [{tuple(r[k] for k in keys): r for r in x.collect()} for x in (a, b)]
    assert rows[0].keys() == rows[1].keys() and len(rows[0]) == a.count() == b.count()
    for k, r in rows[0].items():
        for c in a.columns:
            assert r[c] == (pytest.approx(rows[1][k][c], abs=1e-9) if isinstance(r[c], float) else rows[1][k][c]), (k, c)


def test_places_and_mean_ranks(one_date):
    some = one_date.filter("f is not null")
    key = ["trade_date", "ts_code"]
    w = Window.partitionBy("trade_date")
    want = some.withColumn("p", F.row_number().over(w.orderBy("f", "ts_code")).cast("long")).withColumn("n", F.count("f").over(w))
    same(order.places(some, ["trade_date"], [F.col("f").asc(), F.col("ts_code").asc()], "p", {"n": F.count("f")}, spread=True), want, key)
    want = some.withColumn("r", average_rank(F.col("f"), ["trade_date"], "f"))
    for most in (100, 10_000):  # with and without values that count as heavy
        same(order.mean_ranks(some, "f", ["trade_date"], "r", most, spread=True), want, key)


def test_no_task_holds_a_date(one_date):
    placed = order.places(one_date.repartition(4), ["trade_date"], [F.col("f").asc(), F.col("ts_code").asc()], "p", spread=True)
    held = one_date.filter("f is not null").repartitionByRange(8, "trade_date", "f", "ts_code").groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert held < 1500 and placed.count() == one_date.count()
    k = 16
    s = one_date.filter("trade_date = '20240102'").agg(F.percentile_approx("f", [i / k for i in range(1, k)], 20 * k).alias("s"))
    rows = one_date.filter("trade_date = '20240102'").crossJoin(s).select("f", order._bucket("f", "s", k).alias("b"))
    most = rows.groupBy("b").agg(F.countDistinct("f").alias("n")).agg(F.max("n")).first()[0]
    assert most < 1000  # distinct values of a bucket, which is what a task orders
    bad = rows.crossJoin(s).filter(F.col("b") != F.size(F.filter("s", lambda v: v <= F.col("f")))).count()
    assert bad == 0


def test_percentiles(one_date):
    ps = {"a": 0.0, "b": 0.01, "c": 0.5, "d": 0.77, "e": 1.0}
    want = one_date.filter("f is not null").groupBy("trade_date").agg(*[F.percentile("f", F.lit(p)).alias(k) for k, p in ps.items()])
    for most in (1, 50, 3000):
        same(order.percentiles(one_date, "f", ps, ["trade_date"], most), want, ["trade_date"])
    whole = order.percentiles(one_date, "f", ps, [], 10).first()
    assert tuple(whole) == tuple(one_date.agg(*[F.percentile("f", F.lit(p)) for p in ps.values()]).first())
    assert order.percentiles(one_date.limit(0), "f", ps, ["trade_date"], 10).count() == 0


def test_facts_of_many_groups_are_salted(spark, monkeypatch):
    monkeypatch.setattr(order, "BROADCAST_ROWS", 10)
    df = spark.range(1000).selectExpr("if(id % 3 = 0, null, id % 50) as g", "id")
    got = order.grouped(df, ["g"], {"n": F.count("*")}, True)
    same(got, order.grouped(df, ["g"], {"n": F.count("*")}, False), ["id"])


@pytest.mark.parametrize("neutralize", ["none", "size", "industry_size"])
def test_preprocessing_of_large_dates(one_date, neutralize):
    df = one_date.filter("trade_date is not null")
    a, b = (preprocess.preprocess(df, "f", neutralize=neutralize, most=most, spread=spread) for most, spread in ((100, True), (10_000, False)))
    same(a, b, ["trade_date", "ts_code"])
    same(preprocess.winsorize_percentile(df, "f", "w", most=100), preprocess.winsorize_percentile(df, "f", "w"), ["trade_date", "ts_code"])
    same(preprocess.zscore(df, "f", "z", legacy=True, most=100), df.withColumn("z", preprocess.standardized("f", ["trade_date"], True)), ["trade_date", "ts_code"])


def test_evaluation_of_large_dates(one_date):
    df = one_date.filter("trade_date is not null")
    forms = [{"most": 100, "spread": True}, {"spread": False}]
    a, b = (evaluate.quantiles(df, "f", **f) for f in forms)
    same(a, b, ["trade_date", "ts_code"])
    a, b = (evaluate.rank_ic(df, "f", "y", **f) for f in forms)
    same(a, b, ["trade_date"])
    a, b = (evaluate.size_bucket_ic(df, "f", "y", **f) for f in forms)
    same(a, b, ["trade_date", "size_bucket"])
    a, b = (evaluate.distribution(df, "f", ["trade_date"], **f) for f in forms)
    same(a, b, ["trade_date"])
    two = df.filter("trade_date < '20240104'").unionByName(df.filter("trade_date = '20240102'").withColumn("trade_date", F.lit("20240105")).withColumn("f", F.col("f") + F.col("y")))
    a, b = (evaluate.autocorrelation(two, "f", 2, **f) for f in forms)
    same(a, b, ["trade_date", "lag"])


def test_radar_of_large_dates(one_date):
    df = one_date.filter("trade_date is not null").select(
        "trade_date", "ts_code", "sw_l1_name", "total_mv", F.lit(False).alias("is_suspended"), F.col("f").alias("pct_chg"), F.abs("y").alias("close"), F.abs("y").alias("pb"), F.abs("f").alias("dv_ratio"),
        F.col("y").alias("turnover_rate"), F.lit(2.0).alias("up_limit"), F.lit(0.1).alias("down_limit"), F.col("total_mv").alias("amount"),
    )
    forms = [{"most": 100, "spread": True}, {"spread": False}]
    a, b = (radar.breadth(df, **f) for f in forms)
    same(a, b, ["trade_date"])
    a, b = (radar.style_buckets(df, **f) for f in forms)
    same(a, b, ["trade_date", "factor_name", "bucket_name"])
    a, b = (radar.industry_strength(df, **f) for f in forms)
    same(a, b, ["trade_date", "sw_l1_name"])


# --- the stored panel -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def stored_panel(spark):
    rows = spark.range(3000).selectExpr("format_string('c%03d', id % 50) as ts_code", "date_format(date_add(date'2019-12-01', cast(id / 50 as int) * 20), 'yyyyMMdd') as trade_date", "cast(id as double) as close")
    t = panel_table.PanelTable(spark, "panel_test", store.scratch(spark))
    t.write(rows, 4)
    return t, rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_panel_windows_by_code_shuffle_nothing(stored_panel):
    t, rows = stored_panel
    assert t.exists() and t.read().exceptAll(rows.select(t.read().columns)).count() == 0 and t.read().count() == rows.count()
    w = Window.partitionBy("ts_code").orderBy("trade_date")
    back = t.read().withColumn("r", F.col("close") / F.lag("close").over(w)).withColumn("s", F.sum("close").over(w))
    assert "Exchange" not in plan(back) and "Exchange" in plan(rows.withColumn("r", F.lag("close").over(w)))
    sums = t.read().groupBy("ts_code").agg(F.sum("close").alias("s")).join(t.read().select("ts_code", "trade_date"), "ts_code")
    assert "hashpartitioning" not in plan(sums)


def test_stored_panel_reads_the_years_of_a_range(stored_panel):
    t, rows = stored_panel
    part = t.read("20200601", "20210215")
    text = plan(part)
    assert "PartitionFilters: [isnotnull(panel_year" in text and "panel_year#" in text.split("PartitionFilters:")[1].split("]")[0]
    assert {f.split("panel_year=")[1][:4] for f in part.inputFiles()} >= {"2020", "2021"}
    assert sorted(map(tuple, part.select("ts_code", "trade_date").collect())) == sorted(map(tuple, rows.filter("trade_date between '20200601' and '20210215'").select("ts_code", "trade_date").collect()))
    last = t.last_dates("20201231", 3).select("trade_date").distinct().collect()
    want = rows.filter("trade_date <= '20201231'").select("trade_date").distinct().orderBy(F.desc("trade_date")).limit(3).collect()
    assert sorted(last) == sorted(want)
    assert t.last_dates("19000101", 3).count() == 0


def test_stored_panel_years_are_replaced(spark):
    rows = spark.createDataFrame([("a", "20200102", 1.0), ("b", "20200102", 2.0), ("a", "20210104", 3.0)], "ts_code string, trade_date string, close double")
    t = panel_table.PanelTable(spark, "panel_years", store.scratch(spark))
    t.write(rows, 2)
    t.replace_years(rows.filter("trade_date like '2020%'").withColumn("close", F.col("close") * 10).filter("ts_code = 'a'"))
    assert sorted(map(tuple, t.read().select("ts_code", "trade_date", "close").collect())) == [("a", "20200102", 10.0), ("a", "20210104", 3.0)]
    w = Window.partitionBy("ts_code").orderBy("trade_date")
    assert "Exchange" not in plan(t.read().withColumn("r", F.lag("close").over(w)))


def test_panel_is_built_once(spark, tmp_path):
    spark.range(3).selectExpr("'a' as ts_code", "'20200102' as trade_date", "id").write.parquet(f"{tmp_path}/src.parquet")
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(f"{tmp_path}/src.parquet")

    first = panel_table.built(spark, "once", [f"{tmp_path}/src.parquet"], build)
    again = panel_table.built(spark, "once", [f"{tmp_path}/src.parquet"], build)
    assert len(calls) == 1 and first.name == again.name and again.read().count() == 3
    spark.range(1).selectExpr("'b' as ts_code", "'20200103' as trade_date", "id").write.mode("append").parquet(f"{tmp_path}/src.parquet")
    assert panel_table.built(spark, "once", [f"{tmp_path}/src.parquet"], build).read().count() == 4 and len(calls) == 2


def test_lines_meet_once_where_the_panel_is_built(spark):
    from panelith.sources import adapters

    plan = adapters.supplier_months(spark, "/root/testdata/sf0.001", 3)._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len([line for line in wide if "REPARTITION_BY_NUM" in line]) == 1, plan
    assert len(wide) == 3 and sum("(ts_code" in line for line in wide) == 2, plan  # besides the lines: suppliers, and volumes by month

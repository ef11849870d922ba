"""Panel, quality, sample, preprocessing and store operators on small frames with known values."""

import pytest
from pyspark.sql import functions as F

from panelith.functions import factors, stats
from panelith.operators import panel, preprocess, quality, sample
from panelith.sources import schemas, store


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_conform_adds_casts_and_clears_nan(spark):
    df = frame(spark, [(1, float("nan"), "x")], "ts_code int, open double, extra string")
    out = schemas.conform(df, schemas.TABLES["daily"])
    r = out.first()
    assert r.ts_code == "1" and r.open is None and r.close is None and r.extra == "x"
    with pytest.raises(ValueError):
        schemas.require(df, ["nope"])


def test_store_upserts(spark, tmp_path):
    s = store.Store(spark, f"file://{tmp_path}")
    with pytest.raises(FileNotFoundError):
        s.read("daily")
    day = lambda c, v: frame(spark, [(c, v)], "ts_code string, open double")
    s.upsert_partition("daily", day("a", 1.0), "trade_date", "20240506")
    s.upsert_partition("daily", day("a", 12.0), "trade_date", "20240506")
    s.upsert_partition("daily", day("b", 2.0), "trade_date", "20240507")
    assert sorted((r.trade_date, r.open) for r in s.read("daily").collect()) == [("20240506", 12.0), ("20240507", 2.0)]
    s.upsert_partition("daily", day("b", 2.0).limit(0), "trade_date", "20240507")
    assert [r.trade_date for r in s.read("daily").collect()] == ["20240506"]
    cal = frame(spark, [("20240101", "0"), ("20240102", "1")], "cal_date string, is_open string")
    s.upsert("trade_cal", cal, ["cal_date"])
    s.upsert("trade_cal", cal.limit(0), ["cal_date"])
    s.upsert("trade_cal", frame(spark, [("20240101", "1")], "cal_date string, is_open string"), ["cal_date"])
    assert {(r.cal_date, r.is_open) for r in s.read("trade_cal").collect()} == {("20240101", "1"), ("20240102", "1")}


def test_history_load_resumes(spark, tmp_path):
    s = store.Store(spark, f"file://{tmp_path}")
    dates = frame(spark, [("20240506",), ("20240507",)], "trade_date string")

    one = frame(spark, [("20240506", "a", 1.0)], "trade_date string, ts_code string, open double")
    both = one.unionByName(one.withColumn("trade_date", F.lit("20240507")))
    assert s.load_history({"daily": one}, dates).first()[1:] == (1, 0, 1)
    assert s.load_history({"daily": both}, dates).first()[1:] == (1, 1, 0)
    assert s.load_history({"daily": both}, dates).first()[1:] == (0, 2, 0)
    s.drop_partitions("daily", [{"trade_date": "20240506"}])
    assert s.load_history({"daily": both}, dates).first()[1:] == (1, 1, 0)
    assert s.load_history({"daily": both}, dates, force=True).first()[1:] == (2, 0, 0)
    assert s.read("daily").count() == 2


def test_swap_cut_short_is_put_right(spark, tmp_path):
    s = store.Store(spark, f"file://{tmp_path}")
    s.write("t", frame(spark, [(1,)], "x int"))
    (tmp_path / "t").rename(tmp_path / "t.old")
    assert [r.x for r in s.read("t").collect()] == [1]
    s.write("t", frame(spark, [(2,)], "x int"))
    assert [r.x for r in s.read("t").collect()] == [2] and not (tmp_path / "t.old").exists()


def test_upsert_touches_the_partitions_of_the_batch_alone(spark, tmp_path):
    s = store.Store(spark, f"file://{tmp_path}")
    s.upsert("v", frame(spark, [("a", 1, 1.0), ("a", 2, 1.0), ("b", 1, 1.0)], "f string, k int, v double"), ["f", "k"], ["f"])
    before = {p.name for p in (tmp_path / "v" / "f=b").iterdir()}
    s.upsert("v", frame(spark, [("a", 2, 5.0), ("c", 1, 7.0)], "f string, k int, v double"), ["f", "k"], ["f"])
    assert {p.name for p in (tmp_path / "v" / "f=b").iterdir()} == before
    assert sorted(tuple(r) for r in s.read("v").select("f", "k", "v").collect()) == [("a", 1, 1.0), ("a", 2, 5.0), ("b", 1, 1.0), ("c", 1, 7.0)]


def test_years_back():
    assert store.years_back("20240301", 3) == ("20210301", "20240301") and store.years_back("20240229", 1) == ("20230301", "20240229") and store.years_back("20240229", 4) == ("20200229", "20240229")


def test_month_chunks(spark):
    got = store.month_chunks(spark, "20260515", "20260702").orderBy("start").collect()
    assert [tuple(r) for r in got] == [("20260515", "20260531"), ("20260601", "20260630"), ("20260701", "20260702")]


def test_range_rules(spark):
    df = frame(spark, [("20240506",)], "trade_date string")
    with pytest.raises(ValueError, match="together"):
        panel.in_range(df, "20240506", None)
    with pytest.raises(ValueError):
        panel.in_range(df, "2024-05-06", "20240507")
    assert panel.schema_changed(df, ["trade_date", "x"]) and not panel.schema_changed(df, ["trade_date"])


def test_listing_filter(spark):
    df = frame(spark, [("20140618", "20200727"), ("20200803", "20200727"), ("20140618", None), ("20140618", "")], "trade_date string, list_date string")
    assert sorted((r.trade_date, r.list_date) for r in panel.listed_only(df).fillna("none").collect()) == [("20140618", ""), ("20140618", "none"), ("20200803", "20200727")]


@pytest.mark.parametrize("narrow", [True, False])
def test_interval_membership(spark, narrow):
    p = frame(spark, [("20191231", "a"), ("20200101", "a"), ("20100101", "a"), ("20240101", "a")], "trade_date string, ts_code string")
    h = frame(spark, [("a", "old", "20150101", "20200101", "N"), ("a", "new", "20200101", None, "Y")], "ts_code string, l1_name string, in_date string, out_date string, is_new string")
    j = panel.with_fallback(panel.interval_join(p, h, ["l1_name"], narrow), panel.first_membership(h, ["l1_name"]), ["l1_name"])
    assert {r.trade_date: r.member_l1_name for r in j.collect()} == {"20191231": "old", "20200101": "new", "20100101": "old", "20240101": "new"}


def test_quality_checks(spark):
    d = frame(spark, [("20240506", "a", 1.0, 2.0, 0.5, 1.5), ("20240506", "a", 1.0, 2.0, 0.5, 1.5), ("20240507", "b", 5.0, 1.0, 2.0, 1.5)], "trade_date string, ts_code string, open double, high double, low double, close double")
    assert quality.duplicate_keys(d, "daily").first()[1:3] == ("FAIL", 1)
    assert quality.ohlc_sanity(d).first()[1:3] == ("FAIL", 1)
    due = frame(spark, [("20240506",), ("20240508",)], "trade_date string")
    r = quality.date_coverage(d, due, "daily").first()
    assert r.status == "FAIL" and r.detail.endswith("20240508")
    master = frame(spark, [("a", "20200101"), ("b", "20250101")], "ts_code string, list_date string")
    none = d.limit(0)
    assert [x.n_bad for x in quality.two_way_coverage(d, none, master).collect()] == [1, 0]
    assert quality.industry_match(d.limit(0).withColumn("sw_l1_name", F.lit("x"))).first().status == "WARN"


def test_sample_masks_and_labels(spark):
    rows = [(f"2024010{i}", "300001", 10.0 + i, 10.0 + i, 1.0, 5000.0, 9e9, None, None, i == 4, "主板", "ST x" if i == 9 else "x", "20200101") for i in range(1, 10)]
    p = frame(spark, rows, "trade_date string, ts_code string, open double, close double, adj_factor double, amount double, total_mv double, up_limit double, down_limit double, is_suspended boolean, market string, name string, list_date string")
    s, skipped = sample.build_sample(p, sample.SampleConfig(horizons=(1,), min_cross_section=0))
    got = {r.trade_date: r.forward_1d for r in s.collect()}
    assert got["20240101"] == pytest.approx(13 / 12 - 1) and got["20240102"] is None and got["20240103"] is None
    assert got["20240107"] is None and skipped.count() == 0


def test_as_of_members(spark):
    df = frame(spark, [("2024-01-01", "A"), ("2024-01-02", "A"), ("2024-01-02", "B"), ("2024-01-03", "A"), ("2024-01-04", "C")], "trade_date string, ts_code string")
    m = frame(spark, [("2024-01-02", "A"), ("2024-01-02", "B"), ("2024-01-04", "C")], "trade_date string, ts_code string")
    assert sorted(map(tuple, sample.as_of_members(df, m).collect())) == [("2024-01-02", "A"), ("2024-01-02", "B"), ("2024-01-03", "A"), ("2024-01-04", "C")]
    assert sample.exact_members(df, m).count() == 3


def test_momentum_and_registry(spark):
    df = frame(spark, [(f"2024010{i}", "a", v, 1.0) for i, v in enumerate((10.0, 11.0, 12.0, 15.0), 1)], "trade_date string, ts_code string, close double, adj_factor double").withColumn("adj_close", F.col("close"))
    got = [r.m for r in df.select("trade_date", factors.momentum(2).alias("m")).orderBy("trade_date").collect()]
    assert got[0] is None and got[3] == pytest.approx(15 / 11 - 1)
    assert factors.run_registry(df).count() == 12
    with pytest.raises(ValueError, match="duplicate"):
        factors.validate([factors.REGISTRY[0]] * 2, df.columns)
    with pytest.raises(ValueError, match="direction"):
        factors.validate([factors.FactorSpec("x", "builtin:momentum_return", {}, "sideways")], df.columns)
    with pytest.raises(ValueError, match="fields"):
        factors.validate([factors.FactorSpec("x", "builtin:momentum_return", fields=("nope",))], df.columns)


def test_neutralized_residuals(spark):
    import random

    rng = random.Random(1)
    rows = [("d", f"{i:03d}", rng.uniform(1e3, 1e6), "AB"[i % 2], rng.gauss(0, 1)) for i in range(40)]
    df = frame(spark, rows, "trade_date string, ts_code string, total_mv double, sw_l1_name string, f double")
    out = preprocess.preprocess(df, "f").withColumn("lnmv", F.ln("total_mv"))
    r = out.agg(F.avg("factor_processed").alias("m"), F.stddev_pop("factor_processed").alias("s"), F.corr("factor_neutral", "lnmv").alias("c")).first()
    assert abs(r.m) < 1e-12 and r.s == pytest.approx(1) and abs(r.c) < 1e-10
    by = out.groupBy("sw_l1_name").agg(F.avg("factor_neutral").alias("m")).collect()
    assert all(abs(x.m) < 1e-12 for x in by)
    again = preprocess.preprocess(df.repartition(7), "f").select("ts_code", "factor_processed")
    pairs = out.select("ts_code", F.col("factor_processed").alias("x")).join(again, "ts_code")
    assert pairs.agg(F.max(F.abs(F.col("x") - F.col("factor_processed")))).first()[0] < 1e-12
    flat = preprocess.preprocess(df.withColumn("f", F.lit(1.0)), "f", neutralize="none")
    assert {x.factor_processed for x in flat.collect()} == {0.0}
    none = preprocess.preprocess(df.withColumn("f", F.lit(None).cast("double")), "f", neutralize="none")
    assert {x.factor_processed for x in none.collect()} == {None}


@pytest.mark.parametrize("q", [3, 5, 10])
def test_buckets_match_quantile_cuts(spark, q):
    import pandas as pd

    for n in (q, q + 1, 12, 37, 100):
        df = spark.range(1, n + 1).select(F.col("id"), stats.bucket(F.col("id"), F.lit(n), q).alias("b"))
        want = pd.qcut(pd.Series(range(1, n + 1)), q, labels=False) + 1
        assert [r.b for r in df.orderBy("id").collect()] == want.tolist()


def test_partitions_get_one_file_and_not_one_of_each_task(spark, tmp_path):
    s = store.Store(spark, str(tmp_path))
    rows = spark.range(400).select((F.col("id") % 5).cast("string").alias("trade_date"), F.col("id").alias("x")).repartition(8)
    s.write_partitions("t", rows, ["trade_date"])
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == 5
    s.write_partitions("t", rows.filter("trade_date = '3'").withColumn("x", -F.col("x")), ["trade_date"])  # others stay
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == 5
    assert s.read("t").groupBy("trade_date").agg(F.count("*"), F.sum("x")).orderBy("trade_date").collect() == [(str(k), 80, sum(range(k, 400, 5)) * (-1 if k == 3 else 1)) for k in range(5)]

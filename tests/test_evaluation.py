"""Evaluation, comparison, radar and news operators on small frames with known values, and the registered queries' contract."""

import pytest
from pyspark.sql import functions as F

from panelith.operators import compare, evaluate, news, order, radar
from panelith.plans import frames, legacy, queries


@pytest.fixture(scope="module")
def two_days(spark):
    rows = []
    for d, sign in (("2024-01-02", 1), ("2024-01-03", -1)):
        rows += [(d, f"{i:02d}", float(i), float(sign * i), "Tech" if i >= 5 else "Bank", 10.0 * (i + 1)) for i in range(10)]
    return spark.createDataFrame(rows, "trade_date string, ts_code string, f double, y double, sw_l1_name string, total_mv double").withColumn("trade_date", F.to_date("trade_date"))


def test_buckets_spread_and_compounding(two_days):
    u = evaluate.quantiles(two_days, "f")
    assert [r.quantile for r in u.filter("trade_date = '2024-01-02'").orderBy("ts_code").collect()] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    ls = evaluate.long_short(evaluate.wide(evaluate.quantile_daily(u, "y")), step=1).orderBy("trade_date").collect()
    assert [r.spread for r in ls] == [8.0, -8.0] and [r.cum_spread for r in ls] == [8.0, -64.0]


def test_ic_autocorrelation_exposure(two_days):
    assert [r.rank_ic for r in evaluate.rank_ic(two_days, "f", "y").orderBy("trade_date").collect()] == pytest.approx([1, -1])
    decay = evaluate.autocorrelation_decay(evaluate.autocorrelation(two_days, "f")).collect()
    assert [(r.lag, r.mean_autocorr) for r in decay] == [(1, pytest.approx(1))]
    e = {r.industry: (r.mean_exposure, r.normalized_exposure) for r in evaluate.industry_exposure(two_days, "f").collect()}
    assert e["Tech"] == (7.0, pytest.approx(4.9497, abs=1e-4)) and e["Bank"] == (2.0, pytest.approx(1.4142, abs=1e-4))


def test_rebalanced_compounding(spark):
    df = spark.createDataFrame([(i, 0.1) for i in range(6)], "trade_date int, r double")
    got = [x.c for x in evaluate.rebalanced(df, "r", "c", 5).orderBy("trade_date").collect()]
    assert got == pytest.approx([0.1] * 5 + [0.21])


def test_ic_decay_deals_rows_in_proportion(spark, monkeypatch):
    """Twice the rows are dealt over twice the tasks, once, with the values that other numbers of tasks give."""
    monkeypatch.setattr(order, "TASK_ROWS", 100)
    for n, tasks in ((50, 4), (100, 8)):  # 4 dates, 2 horizons
        rows = [(f"2024010{d}", f"c{i}", float(i * 7 % 11), float(i * (d + 2) % 13), float(i * 5 % 17)) for d in range(4) for i in range(n)]
        d = evaluate.ic_decay(spark.createDataFrame(rows, "trade_date string, ts_code string, f double, forward_1d double, forward_2d double"), "f", (1, 2))
        plan = d._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("RepartitionByExpression") + plan.count("REPARTITION_BY_NUM") == 1 and f", {tasks})" in plan, plan
        got = {r.horizon: r.mean_ic for r in d.collect()}
        with monkeypatch.context() as m:
            m.setattr(order, "TASK_ROWS", 1 << 20)
            assert {r.horizon: r.mean_ic for r in evaluate.ic_decay(d.sparkSession.createDataFrame(rows, "trade_date string, ts_code string, f double, forward_1d double, forward_2d double"), "f", (1, 2), spread=True).collect()} == pytest.approx(got)


def test_ic_decay_and_half_life(spark):
    rows = [(d, f"{i:02d}", float(i), float(i), float(-i)) for d in (1, 2) for i in range(12)]
    df = spark.createDataFrame(rows, "trade_date int, ts_code string, f double, forward_1d double, forward_2d double")
    d = evaluate.ic_decay(df, "f", (1, 2))
    assert {r.horizon: r.mean_ic for r in d.collect()} == pytest.approx({1: 1.0, 2: -1.0})
    assert evaluate.half_life(d, "horizon", "mean_ic", True).first().half_life is None


def test_turnover_bounds_and_backtest(two_days):
    u = evaluate.quantiles(two_days, "f")
    assert {r.turnover for r in evaluate.turnover(u).collect()} == {0.0}
    b = evaluate.top_backtest(u, "y", step=1, cost=0.001).orderBy("trade_date").collect()
    assert [r.turnover for r in b] == [1.0, 0.0] and b[0].cost == pytest.approx(0.002) and all(r.drawdown <= 0 for r in b)


def test_streak_split_monotonicity(spark):
    s = spark.createDataFrame([(i, v) for i, v in enumerate((1.0, -1.0, -2.0, None, -1.0, 2.0, -1.0))], "trade_date int, x double")
    assert evaluate.negative_streak(s, "x").first()[0] == 3
    parts = evaluate.split_periods(s.select("trade_date"))
    assert parts.filter("period = 'in_sample'").count() == 5
    assert evaluate.split_periods(s.select("trade_date").limit(1)).first().period == "out_of_sample"
    q = spark.createDataFrame([(k, 1.0) for k in range(1, 6)], "quantile int, mean_return double")
    assert evaluate.monotonicity(q).first()[0] == "increasing"


def test_noise_depends_on_keys_alone(two_days):
    a = compare.noise_factors(two_days, "f", 2)
    b = compare.noise_factors(two_days.repartition(5), "f", 2)
    key = lambda df: {(r.baseline_name, r.run_id, r.trade_date, r.ts_code): r.f for r in df.collect()}
    assert key(a) == key(b)
    shuffled = a.filter("baseline_name = 'random_by_date_shuffle' and run_id = 0")
    assert sorted(r.f for r in shuffled.collect()) == sorted(r.f for r in two_days.collect())


GATE = dict(coverage_pct=0.9, n_valid_dates=100, n_samples=5000, all_null=False, constant=False, rank_ic_mean=0.05, spread_mean=0.01, top_return=0.01, monotonicity="increasing", mean_turnover=0.3, max_drawdown=-0.1, is_rank_ic=0.05, oos_rank_ic=0.02, is_spread=0.01, oos_spread=0.01, stronger_than_noise=True, not_worse_than_simple=True, single_year=False)


@pytest.mark.parametrize(
    ("change", "status"),
    [({}, "active"), ({"coverage_pct": 0.1}, "invalid"), ({"all_null": True}, "invalid"), ({"n_valid_dates": 59}, "invalid"), ({"rank_ic_mean": -0.1}, "rejected"), ({"max_drawdown": -0.6}, "rejected"), ({"single_year": True}, "watch"), ({"oos_rank_ic": -0.1}, "watch"), ({"oos_rank_ic": -0.1, "stronger_than_noise": False}, "rejected"), ({"not_worse_than_simple": False}, "watch")],
)
def test_gate(spark, change, status):
    row = GATE | change
    r = compare.gate(spark.createDataFrame([tuple(row.values())], list(row))).first()
    assert r.status == status and (status == "active") == (not r.reasons) or status == "watch"


def test_comparison_direction(spark):
    b = spark.createDataFrame([("noise", -0.5, 0.1), ("noise", -0.1, 0.3)], "group string, max_drawdown double, rank_ic_mean double")
    c = spark.createDataFrame([(-0.3, 0.2)], "max_drawdown double, rank_ic_mean double")
    now = {r.metric: r.percentile for r in compare.compare(c, b, ["max_drawdown", "rank_ic_mean"]).collect()}
    assert now == {"max_drawdown": 0.5, "rank_ic_mean": 0.5}
    shallow = spark.createDataFrame([(-0.05, 0.2)], "max_drawdown double, rank_ic_mean double")
    get = lambda **k: {r.metric: r.percentile for r in compare.compare(shallow, b, ["max_drawdown"], **k).collect()}["max_drawdown"]
    assert get() == 1.0 and get(compat=True) == 0.0


def test_radar(spark):
    rows = [("1", "a", 10.0, 2.0, 100.0, 5.0, "X", False), ("1", "b", 8.0, -1.0, 50.0, 3.0, "X", False), ("1", "c", 9.0, 9.0, 70.0, 4.0, "Y", True)]
    p = spark.createDataFrame(rows, "trade_date string, ts_code string, close double, pct_chg double, amount double, total_mv double, sw_l1_name string, is_suspended boolean").withColumns({"up_limit": F.lit(10.0), "down_limit": F.lit(1.0), "pb": F.lit(1.0), "dv_ratio": F.lit(1.0), "turnover_rate": F.lit(1.0)})
    t = radar.temperature(radar.breadth(p)).first()
    assert (t.stock_count, t.up_count, t.up_limit_count, t.amount_total) == (2, 1, 1, 150.0) and t.score == 50 + 10 - 10 + 10
    assert {r.sw_l1_name for r in radar.industry_strength(p).collect()} == {"X"}
    s = {(r.factor_name, r.bucket_name): r.mean_return for r in radar.style_buckets(p).collect()}
    assert s["size", "large_cap"] == 2.0 and s["size", "small_cap"] == -1.0 and s["price", "low_price"] == -1.0


def test_news(spark):
    rows = [(1, " -Chips boom: ", "chip\n orders", "Mock", ["tech"]), (2, "chips BOOM", "again", "mock", None), (3, "rates", "cut", "cctv", [" "]), (4, "  ", "no title", "x", None), (5, "sports", "none", None, None)]
    raw = spark.createDataFrame(rows, "id int, title string, content string, source string, tags array<string>")
    d = news.digest(raw, ["chip", "rates"], "id").first()
    assert tuple(d) == (5, 4, 3, 2)
    r = news.rank(news.categorize(news.relevant(news.dedup(news.clean(raw), "id"), ["chip", "rates"]), {"macro": ["rates"], "tech": ["chip"]}, {"cctv": 1.2}), {"chip": 2.0}, {"macro": 1.6, "tech": 1.4})
    assert {x.id: (x.category, x.score) for x in r.collect()} == {1: ("tech", 2.8), 3: ("macro", 1.92)}


def test_registry_contract(spark):
    import __spark_entry__ as entry

    names, sql = set(entry.queries()), set(entry.oracle_sql())
    assert sql <= names and len(names) > 100
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["b00_panel_full", "d10_sample", "f10_full_chain", "g16_top_backtest", "k05_rank"])
def test_against_duckdb(spark, name):
    import duckdb

    from panelith import registry

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("region", "nation", "supplier", "lineitem", "documents", "events"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    got = registry.queries()[name](spark, sf).toPandas()
    want = con.execute(registry.oracle_sql()[name]).df()
    assert len(got) == len(want) and sorted(got.columns) == sorted(want.columns)
    keys = [k for k in ("trade_date", "ts_code", "doc_id") if k in got.columns]
    rows = [{tuple(str(r[k])[:10] for k in keys): r for r in x.to_dict("records")} for x in (got, want)]
    assert len(rows[0]) == len(got) and rows[0].keys() == rows[1].keys()
    for key, r in rows[0].items():
        for c in got.columns:
            a, b = r[c], rows[1][key][c]
            number = isinstance(a, float) or isinstance(b, float)
            assert (a != a and b != b) or (a is None and b is None) or (a == pytest.approx(b, abs=2e-6) if number else c in keys or a == b), (key, c, a, b)


def test_a_period_is_a_set_of_dates_and_no_more_rows(spark, monkeypatch):
    from panelith.plans import queries

    kept, real = [], queries.store.stored
    monkeypatch.setattr(queries.store, "stored", lambda df: kept.append(real(df)) or kept[-1])
    rows = spark.sql("SELECT 'k' AS k, date_add(date'2000-01-01', d) AS trade_date, format_string('%03d', c) AS ts_code, CAST(pmod(c * 7 + d, 40) AS DOUBLE) AS f, CAST(c AS DOUBLE) AS y FROM (SELECT explode(sequence(0, 3)) AS d) CROSS JOIN (SELECT explode(sequence(1, 40)) AS c)")
    got = queries.evaluate_batch(rows, ["k"]).first()
    assert got["n_valid_dates"] == 4 and got["n_samples"] == 160
    assert max(f.count() for f in kept) == 160


def test_older_evaluation_deals_its_horizons_over_many_tasks(spark, monkeypatch):
    rows = spark.range(4000).select(
        F.expr("date_add(date'2024-01-01', cast(id % 20 as int))").alias("trade_date"), F.expr("cast(id div 20 as string)").alias("ts_code"), F.expr("cast(hash(id) % 1000 as double)").alias("mom"),
        F.expr("100.0D + id % 97").alias("total_mv"), F.expr("concat('i', id % 3)").alias("sw_l1_name"), F.lit(True).alias("universe"), F.lit("x").alias("unused"), *[F.expr(f"hash(id, {h}) % 100 / 1000.0D").alias(f"forward_{h}d") for h in (1, 5)],
    )
    dealt, ranked, measured, kept = [], evaluate.rank_ic, order.largest, []
    monkeypatch.setattr(order, "TASK_ROWS", 1000)
    monkeypatch.setattr(legacy.evaluate, "rank_ic", lambda df, *a, **k: (dealt.append(df.rdd.getNumPartitions()), ranked(df, *a, **k))[1])
    monkeypatch.setattr(order, "largest", lambda df, by: (kept.append(df.columns), measured(df, by))[1])
    out = legacy.evaluation(rows, "mom", (1, 5))
    assert dealt == [8]  # 2 horizons of 4,000 rows
    assert [c for c in kept if "trade_date" in c and "unused" in c] == [] and sum("mom" in c for c in kept) == 1  # dates are measured once
    assert out.filter("frame = 'ic'").select("key").distinct().count() == 20


def test_stored_results_prepare_the_rows_once(spark, monkeypatch):
    made, usable = [], frames.usable
    monkeypatch.setattr(frames, "usable", lambda *a: (made.append(1), usable(*a))[1])
    assert queries.QUERIES["a22_result_store"](spark, "/root/testdata/sf0.01").count() > 0
    assert len(made) == 1

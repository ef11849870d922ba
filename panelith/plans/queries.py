"""Registered queries of the panel operators: a Spark frame and, beside it, DuckDB SQL that computes the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import factors
from ..functions import stats as S
from ..operators import by_date, compare, evaluate, news, order, panel, preprocess, quality, radar, sample
from ..sources import adapters, schemas, store
from . import batch_oracle as B
from . import frames, legacy
from . import oracle as O
from .frames import FACTOR, LABEL, rounded

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, ctes: str | None = None, select: str = "", doubles: str = ""):
    """Registers a function, and the SQL ``select`` over ``ctes`` with ``doubles`` rounded as the frame's are."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if ctes is not None:
            cut = ", ".join(f"round({d}, 6) + 0.0 AS {d}" for d in doubles.split())
            inner = f"SELECT * REPLACE ({cut}) FROM ({select})" if cut else select
            SQL[name] = f"WITH {ctes.strip()}\n{inner}" if ctes else inner
        return f

    return add


P, FL, SA, BASE, EV = O.PANEL, f"{O.PANEL},{O.FLAGS}", f"{O.PANEL},{O.FLAGS},{O.SAMPLE}", O.BASE, O.EVAL
IC, QD = f"{EV},{O.IC}", f"{EV},{O.DAILY_Q}"


def _ic(spark, sf_dir):
    return evaluate.rank_ic(frames.usable(spark, sf_dir), FACTOR, LABEL)


def _qd(spark, sf_dir):
    return evaluate.quantile_daily(frames.usable(spark, sf_dir), LABEL)


def _qw(spark, sf_dir):
    return evaluate.wide(_qd(spark, sf_dir))


# --- A: sources and stores ------------------------------------------------------------------------


@query("a02_conform", "", "SELECT CAST(s_suppkey AS VARCHAR) AS ts_code, CAST(NULL AS VARCHAR) AS symbol, s_name AS name, CAST(NULL AS VARCHAR) AS area, s_acctbal AS extra FROM supplier", "extra")
def _(spark, sf):
    raw = adapters.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ts_code"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("extra"))
    return schemas.conform(raw, schemas.TABLES["stock_basic"]).select("ts_code", "symbol", "name", "area", "extra")


@query("a03_schema_evolution", "", "SELECT CAST(s_suppkey AS VARCHAR) AS key, s_name AS name, CAST(NULL AS VARCHAR) AS market FROM supplier UNION ALL SELECT n_name, CAST(NULL AS VARCHAR), 'new' FROM nation")
def _(spark, sf):
    old = adapters.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return schemas.evolve(old, adapters.table(spark, sf, "nation").select(F.col("n_name").alias("key"), F.lit("new").alias("market")))


@query("a05_partition_roundtrip", P, "SELECT trade_date, count(*) AS n, sum(vol) AS vol FROM panel GROUP BY trade_date", "vol")
def _(spark, sf):
    s = store.Store(spark, store.scratch(spark))
    s.write_partitions("daily_panel", frames.panel(spark, sf).select("trade_date", "ts_code", "vol"), ["trade_date"])
    return s.read("daily_panel").groupBy("trade_date").agg(F.count("*").alias("n"), F.sum("vol").alias("vol"))


@query("a06_two_level_partitions", f"{P},{O.WEIGHTS}", "SELECT index_code, trade_date, count(*) AS n FROM weights GROUP BY ALL")
def _(spark, sf):
    s = store.Store(spark, store.scratch(spark))
    s.write_partitions("index_weight", adapters.index_weights(frames.panel(spark, sf)).drop("day"), ["index_code", "trade_date"])
    return s.read("index_weight").groupBy("index_code", "trade_date").agg(F.count("*").alias("n"))


def _halves(spark, sf):
    p = frames.panel(spark, sf).select("trade_date", "ts_code", "month_no", "vol")
    return p.filter("month_no <= 60"), p.filter("month_no >= 50").withColumn("vol", F.col("vol") + 1)


@query("a09_upsert_by_key", P, "SELECT trade_date, ts_code, CASE WHEN month_no >= 50 THEN vol + 1 ELSE vol END AS vol FROM panel", "vol")
def _(spark, sf):
    old, new = _halves(spark, sf)
    return store.upserted(old, new, ["trade_date", "ts_code"]).select("trade_date", "ts_code", "vol")


@query("a10_upsert_partitions", P, "SELECT trade_date, ts_code, CASE WHEN month_no >= 50 THEN vol + 1 ELSE vol END AS vol FROM panel WHERE month_no <> 3", "vol")
def _(spark, sf):
    s = store.Store(spark, store.scratch(spark))
    old, new = _halves(spark, sf)
    s.write_partitions("daily", old.drop("month_no"), ["trade_date"])
    s.write_partitions("daily", new.drop("month_no"), ["trade_date"])
    s.upsert_partition("daily", old.limit(0).drop("trade_date", "month_no"), "trade_date", "19950401")
    return s.read("daily").select("trade_date", "ts_code", "vol")


@query("a11_upsert_two_keys", f"{P},{O.WEIGHTS}", "SELECT index_code, con_code, trade_date, CASE WHEN substr(trade_date, 1, 4) = '1996' THEN weight * 2 ELSE weight END AS weight FROM weights UNION ALL SELECT 'ALT', con_code, trade_date, weight FROM weights", "weight")
def _(spark, sf):
    w = adapters.index_weights(frames.panel(spark, sf)).drop("day")
    both = w.unionByName(w.withColumn("index_code", F.lit("ALT")))
    return store.upserted(both, w.filter("substring(trade_date, 1, 4) = '1996'").withColumn("weight", F.col("weight") * 2), ["index_code", "trade_date"])


@query("a12_ledger_latest", f"{O.CALENDAR},{O.LOG}", "SELECT endpoint, trade_date, CASE WHEN status = 'failed' THEN 'retried' ELSE status END AS status FROM log")
def _(spark, sf):
    log = adapters.ingest_log(spark, sf).withColumn("finished_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    again = log.filter("status = 'failed'").withColumn("status", F.lit("retried")).withColumn("finished_at", F.lit("2024-01-02 00:00:00").cast("timestamp"))
    return store.latest(log.unionByName(again), ["endpoint", "trade_date"], "finished_at").select("endpoint", "trade_date", "status")


@query("a14_load_plan", f"{O.CALENDAR},{O.LOG}", "SELECT c.cal_date AS trade_date, l.endpoint FROM cal c JOIN log l ON l.trade_date = c.cal_date WHERE is_open = '1' AND status <> 'success'")
def _(spark, sf):
    dates = quality.expected_dates(adapters.calendar(spark, sf))
    return store.load_plan(dates, quality.ENDPOINTS, adapters.ingest_log(spark, sf).filter("status = 'success'"))


@query("a13_loaded_partitions", f"{P},{O.CALENDAR},{O.LOG}", "SELECT trade_date FROM log WHERE endpoint = 'daily' AND status = 'success' AND trade_date IN (SELECT trade_date FROM panel WHERE month_no % 5 <> 0)")
def _(spark, sf):
    s = store.Store(spark, store.scratch(spark))
    s.write_partitions("daily", frames.panel(spark, sf).filter("month_no % 5 <> 0").select("trade_date", "ts_code", "close"), ["trade_date"])
    s.record(adapters.ingest_log(spark, sf).withColumn("finished_at", F.lit("2024-01-01 00:00:00").cast("timestamp")))
    return s.loaded("daily")


@query("a14_history_load", P, "SELECT 'daily' AS endpoint, count(*) FILTER (month_no >= 20 AND month_no % 5 <> 0) AS rows, count(DISTINCT trade_date) FILTER (month_no < 20 AND month_no % 5 <> 0) AS skipped, count(DISTINCT trade_date) FILTER (month_no % 5 = 0) AS failed FROM panel UNION ALL SELECT 'daily_basic', count(*), 0, 0 FROM panel")
def _(spark, sf):
    s = store.Store(spark, store.scratch(spark))
    p = frames.panel(spark, sf).select("trade_date", "ts_code", "close", "month_no")
    dates, landed = p.select("trade_date"), p.filter("month_no % 5 <> 0").drop("month_no")
    s.load_history({"daily": landed}, p.filter("month_no < 20 AND month_no % 5 <> 0").select("trade_date"))
    return s.load_history({"daily": landed, "daily_basic": p.drop("month_no")}, dates)


@query(
    "a14_file_load",
    P,
    "SELECT trade_date, CASE WHEN month_no % 11 IN (5, 6, 7) THEN 'failed' ELSE 'success' END AS status, CASE WHEN month_no % 11 IN (5, 6, 7) THEN 0 ELSE count(*) END AS row_count,"
    " CASE month_no % 11 WHEN 5 THEN count(*) || ' rows do not parse' WHEN 6 THEN '1 rows of another date: 19000101' WHEN 7 THEN 'no landed file, or an empty one' END AS reason FROM panel GROUP BY trade_date, month_no",
)
def _(spark, sf):
    root = store.scratch(spark)
    names = schemas.TABLES["daily"].fieldNames()
    p = schemas.conform(frames.panel(spark, sf).select("month_no", *adapters.daily(frames.panel(spark, sf)).columns), schemas.TABLES["daily"])
    least = F.min("ts_code").over(Window.partitionBy("trade_date")) == F.col("ts_code")
    bad, other = F.col("month_no") % 11 == 5, (F.col("month_no") % 11 == 6) & least
    rows = p.filter("month_no % 11 <> 7").withColumn("day", F.col("trade_date"))
    rows = rows.withColumn("open", F.when(bad, "n/a").otherwise(F.col("open").cast("string"))).withColumn("trade_date", F.when(other, "19000101").otherwise(F.col("trade_date")))
    rows.select("day", *names).repartition("day").write.partitionBy("day").option("header", "true").csv(f"{root}/landing/daily")
    s = store.Store(spark, f"{root}/store")
    s.load_files(f"{root}/landing", ["daily"], p.select("trade_date"))
    s.load_files(f"{root}/landing", ["daily"], p.select("trade_date"))  # only what failed is tried again
    stored = s.read("daily").groupBy("trade_date").agg(F.count("*").alias("n"))
    lines = s.ledger().join(stored, "trade_date", "left").select("trade_date", "status", F.coalesce("n", F.lit(0)).alias("row_count"), "error_message")
    return lines.select("trade_date", "status", "row_count", F.regexp_replace("error_message", ", one is: [\\s\\S]*", "").alias("reason"))


@query("a15_index_load_plan", f"{P},{O.CALENDAR},{O.WEIGHTS}", "SELECT cal_date AS trade_date, 'TOP' AS endpoint FROM cal WHERE is_open = '1' AND cal_date NOT IN (SELECT trade_date FROM weights)")
def _(spark, sf):
    done = adapters.index_weights(frames.panel(spark, sf)).select("trade_date", F.col("index_code").alias("endpoint"))
    return store.load_plan(quality.expected_dates(adapters.calendar(spark, sf)), ["TOP"], done)


@query("a16_last_open_dates", O.CALENDAR, "SELECT cal_date AS trade_date FROM cal WHERE is_open = '1' ORDER BY 1 DESC LIMIT 12")
def _(spark, sf):
    return store.last_open_dates(adapters.calendar(spark, sf), 12)


@query(
    "a17_month_chunks",
    P,
    "SELECT strftime(greatest(m, DATE '1995-03-15'), '%Y%m%d') AS start, strftime(least(last_day(m), DATE '1998-07-20'), '%Y%m%d') AS \"end\", (SELECT count(*) FROM panel WHERE day BETWEEN greatest(m, DATE '1995-03-15') AND least(last_day(m), DATE '1998-07-20')) AS n_rows FROM (SELECT CAST(unnest(generate_series(DATE '1995-03-01', DATE '1998-07-20', INTERVAL 1 MONTH)) AS DATE) AS m)",
)
def _(spark, sf):
    rows = frames.panel(spark, sf).groupBy(F.substring("trade_date", 1, 6).alias("m"), F.col("trade_date").alias("d")).agg(F.count("*").alias("k"))
    c = store.month_chunks(spark, "19950315", "19980720").withColumn("m", F.substring("start", 1, 6)).join(rows, "m", "left")
    return c.groupBy("start", "end").agg(F.coalesce(F.sum(F.when(F.col("d").between(F.col("start"), F.col("end")), F.col("k"))), F.lit(0)).alias("n_rows"))


@query("a18_merge_extracts", "", "SELECT key, name, CASE WHEN key <= 60 THEN 'L' ELSE 'P' END AS list_status FROM (SELECT s_suppkey AS key, s_name AS name FROM supplier)")
def _(spark, sf):
    s = adapters.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return store.merge_extracts([s.filter("key <= 60").withColumn("list_status", F.lit("L")), s.filter("key > 40").withColumn("list_status", F.lit("P"))], ["key"])


@query("a19_chunk_summary", f"{O.CALENDAR},{O.LOG}", "SELECT substr(trade_date, 1, 6) AS month, count(DISTINCT trade_date) AS n_dates, count(*) FILTER (status = 'success') AS n_success, count(*) FILTER (status = 'failed') AS n_failed FROM log GROUP BY 1")
def _(spark, sf):
    return store.chunk_summary(adapters.ingest_log(spark, sf))


def _values(spark, sf):
    p = frames.panel(spark, sf)
    return store.to_long(p, ["pb", "dv_ratio", "turnover_rate"])


@query("a20_factor_store", P, "SELECT trade_date, ts_code, factor_id, factor_value FROM (UNPIVOT (SELECT trade_date, ts_code, pb + CASE WHEN month_no > 70 THEN 1 ELSE 0 END AS pb, dv_ratio FROM panel) ON pb, dv_ratio INTO NAME factor_id VALUE factor_value) WHERE trade_date BETWEEN '19960101' AND '20011231'", "factor_value")
def _(spark, sf):
    s = store.Store(spark, store.scratch(spark))
    p = frames.panel(spark, sf)
    s.upsert("factor_values", store.to_long(p, ["pb", "dv_ratio", "turnover_rate"]), ["trade_date", "ts_code", "factor_id"], ["factor_id"])
    s.upsert("factor_values", store.to_long(p.filter("month_no > 70").withColumn("pb", F.col("pb") + 1), ["pb"]), ["trade_date", "ts_code", "factor_id"], ["factor_id"])
    return s.read("factor_values").filter(F.col("factor_id").isin("pb", "dv_ratio") & F.col("trade_date").between("19960101", "20011231")).select("trade_date", "ts_code", "factor_id", "factor_value")


@query(
    "a22_result_store",
    QD + f",{O.IC}",
    "SELECT 'evaluation_metrics' AS result, 'second' AS run_id, 'rank_ic_mean' AS key, avg(rank_ic) AS value FROM ric UNION ALL SELECT 'evaluation_metrics', 'first', 'rank_ic_mean', avg(rank_ic) FROM ric UNION ALL SELECT 'evaluation_metrics', 'second', 'n_dates', CAST(count(*) AS DOUBLE) FROM ric UNION ALL SELECT 'evaluation_metrics', 'first', 'n_dates', -1.0"
    " UNION ALL SELECT 'evaluation_quantiles', 'first', CAST(quantile AS VARCHAR), avg(avg_return) FROM qd GROUP BY quantile"
    " UNION ALL SELECT 'evaluation_period_metrics', 'first', CAST(year(trade_date) AS VARCHAR) || ':rank_ic_mean', avg(rank_ic) FROM ric GROUP BY year(trade_date)"
    " UNION ALL SELECT 'evaluation_runs', 'first', 'rows', CAST(count(*) AS DOUBLE) FROM u UNION ALL SELECT 'evaluation_runs', 'second', 'rows', CAST(count(*) AS DOUBLE) FROM u",
    "value",
)
def _(spark, sf):
    s = store.Store(spark, store.scratch(spark))
    u = store.stored(frames.usable(spark, sf).select("trade_date", "ts_code", FACTOR, LABEL, "quantile"))  # many results use it
    ic, tag = store.stored(evaluate.rank_ic(u, FACTOR, LABEL)), [F.lit("m5").alias("factor_id"), F.lit("first").alias("run_id")]
    metrics = ic.agg(F.avg("rank_ic").alias("rank_ic_mean"), F.count("*").cast("double").alias("n_dates")).select(*tag, "*").unpivot(["factor_id", "run_id"], ["rank_ic_mean", "n_dates"], "metric", "value")
    buckets = evaluate.quantile_daily(u, LABEL).groupBy("quantile").agg(F.avg("avg_return").alias("value")).select(*tag, "quantile", "value")
    years = ic.groupBy(F.year("trade_date").cast("string").alias("period")).agg(F.avg("rank_ic").alias("value")).select(*tag, "period", F.lit("rank_ic_mean").alias("metric"), "value")
    runs = u.agg(F.count("*").cast("double").alias("value")).select(*tag, "value")
    s.write_evaluation({"evaluation_runs": runs, "evaluation_metrics": metrics, "evaluation_quantiles": buckets, "evaluation_period_metrics": years})
    s.write_evaluation({"evaluation_runs": runs.withColumn("run_id", F.lit("second")), "evaluation_metrics": metrics.withColumn("run_id", F.lit("second"))})
    s.write_evaluation({"evaluation_metrics": metrics.filter("metric = 'n_dates'").withColumn("value", F.lit(-1.0))})  # a run written again
    keys = {"evaluation_runs": F.lit("rows"), "evaluation_metrics": F.col("metric"), "evaluation_quantiles": F.col("quantile").cast("string"), "evaluation_period_metrics": F.concat_ws(":", "period", "metric")}
    return reduce(DataFrame.unionByName, [s.read(t).select(F.lit(t).alias("result"), "run_id", k.alias("key"), "value") for t, k in keys.items()])


@query("a24_wide_to_long", P, "UNPIVOT (SELECT trade_date, ts_code, pb, dv_ratio, turnover_rate FROM panel) ON pb, dv_ratio, turnover_rate INTO NAME factor_id VALUE factor_value", "factor_value")
def _(spark, sf):
    return _values(spark, sf)


@query("a25_long_to_wide", P, "SELECT trade_date, ts_code, pb, dv_ratio, turnover_rate FROM panel", "pb dv_ratio turnover_rate")
def _(spark, sf):
    return store.to_wide(_values(spark, sf), ["pb", "dv_ratio", "turnover_rate"])


@query("a26_optional_columns", P, "SELECT trade_date, ts_code, pb FROM panel", "pb")
def _(spark, sf):
    p = frames.panel(spark, sf)
    return p.select(*schemas.require(p, ["trade_date", "ts_code"], ["pb", "not_there"]))


@query("a27_coverage", P, "SELECT min(trade_date) AS min_date, max(trade_date) AS max_date, count(*) AS n_rows FROM panel")
def _(spark, sf):
    return store.coverage(frames.panel(spark, sf))


@query("a28_scan_date", P, "SELECT ts_code, close, pct_chg FROM panel WHERE trade_date = '19970301'", "close pct_chg")
def _(spark, sf):
    return frames.panel_store(spark, sf).read("19970301", "19970301").select("ts_code", "close", "pct_chg")


@query("a29_scan_window", P, "SELECT trade_date, ts_code, close FROM panel WHERE trade_date IN (SELECT DISTINCT trade_date FROM panel WHERE trade_date <= '19970315' ORDER BY 1 DESC LIMIT 6)", "close")
def _(spark, sf):
    return frames.panel_store(spark, sf).last_dates("19970315", 6).select("trade_date", "ts_code", "close")


# --- B: panel -------------------------------------------------------------------------------------


def _master(p):
    return p.select("ts_code", "name", "market", "list_date").distinct()


def _limits(p):
    return p.select("ts_code", "trade_date", "up_limit", "down_limit")


BASIC = f"{P},{O.DAILY},{O.BASIC}"


@query("b01_star_join", BASIC, "SELECT d.trade_date, d.ts_code, d.close, m.market, b.turnover_rate, p.up_limit FROM daily d LEFT JOIN (SELECT DISTINCT ts_code, market FROM panel) m USING (ts_code) LEFT JOIN basic b USING (trade_date, ts_code) LEFT JOIN panel p USING (trade_date, ts_code)", "close turnover_rate up_limit")
def _(spark, sf):
    p = frames.panel(spark, sf)
    return panel.star_join(adapters.daily(p), _master(p), [adapters.daily_basic(p), _limits(p)]).select("trade_date", "ts_code", "close", "market", "turnover_rate", "up_limit")


@query("b02_interval_join", f"{P},{O.MEMBERS}", "SELECT p.trade_date, p.ts_code, m.l1_name AS h_l1_name, m.in_date FROM panel p LEFT JOIN members m ON p.ts_code = m.ts_code AND p.trade_date >= m.in_date AND (m.out_date IS NULL OR m.out_date = '' OR p.trade_date < m.out_date)")
def _(spark, sf):
    p = frames.panel(spark, sf)
    return panel.interval_join(p.select("trade_date", "ts_code"), adapters.memberships(p), ["l1_name"]).select("trade_date", "ts_code", "h_l1_name", "in_date")


@query("b03_first_membership", f"{P},{O.MEMBERS}", "SELECT ts_code, min(in_date) AS first_in_date, arg_min(l1_name, in_date) AS first_l1_name FROM members GROUP BY ts_code")
def _(spark, sf):
    return panel.first_membership(adapters.memberships(frames.panel(spark, sf)), ["l1_name"])


MEMBER = f"""{P},{O.MEMBERS},
firsts AS (SELECT ts_code, min(in_date) AS fd, arg_min(l1_name, in_date) AS fl FROM members GROUP BY ts_code),
joined AS (SELECT p.*, m.l1_name, m.in_date, m.out_date, m.is_new, coalesce(m.l1_name, CASE WHEN p.trade_date < fd THEN fl END) AS member_l1_name
    FROM panel p LEFT JOIN members m ON p.ts_code = m.ts_code AND p.trade_date >= m.in_date AND (m.out_date = '' OR p.trade_date < m.out_date) LEFT JOIN firsts f ON p.ts_code = f.ts_code)"""


@query("b04_membership_fallback", MEMBER, "SELECT trade_date, ts_code, member_l1_name, in_date FROM joined")
def _(spark, sf):
    p = frames.panel(spark, sf)
    h = adapters.memberships(p)
    j = panel.with_fallback(panel.interval_join(p.select("trade_date", "ts_code"), h, ["l1_name"]), panel.first_membership(h, ["l1_name"]), ["l1_name"])
    return j.select("trade_date", "ts_code", "member_l1_name", "in_date")


@query("b05_suspension_flags", P, "SELECT trade_date, ts_code, 'R,S' AS suspend_types, true AS is_suspended FROM panel WHERE is_suspended")
def _(spark, sf):
    return panel.suspension_flags(adapters.suspensions(frames.panel(spark, sf)))


@query("b06_listed_only", P, "SELECT trade_date, ts_code FROM panel WHERE key % 3 = 0 OR key % 3 = 1 OR trade_date >= '19970101'")
def _(spark, sf):
    p = frames.panel(spark, sf)
    listed = p.withColumn("list_date", F.when(F.col("key") % 3 == 0, F.lit(None).cast("string")).when(F.col("key") % 3 == 1, "").otherwise("19970101"))
    return panel.listed_only(listed).select("trade_date", "ts_code")


@query("b07_one_per_key", MEMBER, "SELECT trade_date, ts_code, member_l1_name, in_date FROM joined QUALIFY row_number() OVER (PARTITION BY trade_date, ts_code ORDER BY CASE WHEN is_new = 'Y' THEN 0 ELSE 1 END, in_date DESC NULLS LAST, out_date DESC NULLS LAST, member_l1_name) = 1")
def _(spark, sf):
    p = frames.panel(spark, sf)
    h = adapters.memberships(p)
    j = panel.with_fallback(panel.interval_join(p.select("trade_date", "ts_code"), h, ["l1_name"]), panel.first_membership(h, ["l1_name"]), ["l1_name"])
    return panel.one_per_key(j, ["member_l1_name"]).select("trade_date", "ts_code", "member_l1_name", "in_date")


BUILT = f"""{MEMBER},{O.DAILY.strip()},{O.BASIC.strip()},
built AS (SELECT trade_date, ts_code, member_l1_name, is_suspended, is_new FROM joined WHERE list_date <= trade_date
    QUALIFY row_number() OVER (PARTITION BY trade_date, ts_code ORDER BY CASE WHEN is_new = 'Y' THEN 0 ELSE 1 END, in_date DESC NULLS LAST, out_date DESC NULLS LAST, member_l1_name) = 1)"""
BUILT_SELECT = "SELECT d.trade_date, d.ts_code, d.close, d.high, market, b.turnover_rate, p.up_limit, p.adj_factor, u.is_suspended, u.member_l1_name FROM built u JOIN daily d USING (trade_date, ts_code) LEFT JOIN basic b USING (trade_date, ts_code) JOIN panel p USING (trade_date, ts_code)"


def _built(spark, sf, start=None, end=None):
    p = frames.panel(spark, sf)
    facts = [p.select("ts_code", "trade_date", "adj_factor"), adapters.daily_basic(p), _limits(p)]
    return panel.build_panel(adapters.daily(p), _master(p), facts, adapters.suspensions(p), adapters.memberships(p), ["l1_name"], start, end)


_COLS = ["trade_date", "ts_code", "close", "high", "market", "turnover_rate", "up_limit", "adj_factor", "is_suspended", "member_l1_name"]


@query("b08_panel_range", BUILT, BUILT_SELECT + " WHERE d.trade_date BETWEEN '19970101' AND '19971231'", "close high turnover_rate up_limit adj_factor")
def _(spark, sf):
    return _built(spark, sf, "19970101", "19971231").select(_COLS)


@query("b00_panel_full", BUILT, BUILT_SELECT, "close high turnover_rate up_limit adj_factor")
def _(spark, sf):
    return _built(spark, sf).select(_COLS)


@query("b09_range_rebuild", P, "SELECT trade_date, count(*) AS n FROM panel WHERE trade_date <> '19970301' GROUP BY trade_date")
def _(spark, sf):
    s = store.Store(spark, store.scratch(spark))
    p = frames.panel(spark, sf).select("trade_date", "ts_code", "close")
    s.write("daily_panel", p, ["trade_date"])
    s.replace_range("daily_panel", p.filter("trade_date between '19970101' and '19970601' and trade_date <> '19970301'"), "19970101", "19970601")
    return s.read("daily_panel").groupBy("trade_date").agg(F.count("*").alias("n"))


@query(
    "b10_schema_drift",
    P,
    "SELECT 'same columns' AS build, count(*) FILTER (trade_date BETWEEN '19970101' AND '19970601') AS n_range, false AS whole, count(*) AS n_rows, sum(close) + count(*) FILTER (trade_date BETWEEN '19970101' AND '19970601') AS close, 4 AS n_columns FROM panel"
    " UNION ALL SELECT 'fewer columns', count(*) FILTER (trade_date BETWEEN '19970101' AND '19970601'), true, count(*), sum(close) + 2 * count(*), 3 FROM panel",
    "close",
)
def _(spark, sf):
    s = store.Store(spark, store.scratch(spark))
    p = frames.panel(spark, sf).select("trade_date", "ts_code", "close", "pb")
    s.write("daily_panel", p, ["trade_date"])
    out = []
    for build, columns, more in (("same columns", p.columns, 1), ("fewer columns", ["trade_date", "ts_code", "close"], 2)):
        made = lambda start, end: panel.in_range(p, start, end).withColumn("close", F.col("close") + more).select(columns)  # noqa: B023, E731
        n, whole = s.rebuild_range("daily_panel", made, "19970101", "19970601")
        now = s.read("daily_panel").agg(F.count("*").alias("n_rows"), F.sum("close").alias("close"), F.lit(len(s.columns("daily_panel"))).alias("n_columns"))
        out.append(store.stored(now.select(F.lit(build).alias("build"), F.lit(n).cast("long").alias("n_range"), F.lit(whole).alias("whole"), "n_rows", "close", "n_columns")))
    return reduce(DataFrame.unionByName, out)


# --- C: quality -----------------------------------------------------------------------------------


@query("c01_expected_dates", O.CALENDAR, "SELECT cal_date AS trade_date FROM cal WHERE is_open = '1' AND cal_date BETWEEN '19960101' AND '20001231'")
def _(spark, sf):
    return quality.expected_dates(adapters.calendar(spark, sf), "19960101", "20001231")


@query("c02_ingest_status", f"{O.CALENDAR},{O.LOG}", "SELECT endpoint, count(DISTINCT trade_date) FILTER (status = 'success') AS success_dates, count(*) FILTER (status = 'failed') AS failed_count, count(*) FILTER (status = 'failed' AND trade_date IN (SELECT cal_date FROM cal WHERE is_open = '1')) AS missing_count, CASE WHEN count(*) FILTER (status = 'failed') > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM log GROUP BY endpoint")
def _(spark, sf):
    return quality.ingest_status(adapters.ingest_log(spark, sf), quality.expected_dates(adapters.calendar(spark, sf)))


_TWICE = f"""{BASIC}, dd AS (SELECT * FROM daily UNION ALL SELECT * FROM daily WHERE CAST(ts_code AS INT) % 10 = 0),
dt AS (SELECT 'daily' AS t, trade_date, ts_code FROM dd UNION ALL SELECT 'daily_basic', trade_date, ts_code FROM basic UNION ALL SELECT 'daily_panel', trade_date, ts_code FROM panel),
tw AS (SELECT t, count(*) FILTER (k > 1) AS n_bad FROM (SELECT t, count(*) AS k FROM dt GROUP BY t, trade_date, ts_code) GROUP BY t)"""


def _twice(d):
    return d.unionByName(d.filter("cast(ts_code as int) % 10 = 0"))


@query("c03_duplicate_keys", _TWICE, "SELECT 'duplicate_keys:' || t AS check_name, CASE WHEN n_bad > 0 THEN 'FAIL' ELSE 'PASS' END AS status, n_bad, '' AS detail FROM tw")
def _(spark, sf):
    p = frames.panel(spark, sf)
    tables = {"daily": _twice(adapters.daily(p)), "daily_basic": adapters.daily_basic(p), "daily_panel": p}
    return reduce(DataFrame.unionByName, [quality.duplicate_keys(t, name) for name, t in tables.items()])


@query("c04_date_coverage", f"{P},{O.CALENDAR},{O.WEIGHTS}", "SELECT 'date_coverage:index_weight' AS check_name, CASE WHEN k > 0 THEN 'FAIL' ELSE 'PASS' END AS status, k AS n_bad, concat_ws(' ', lo, hi, CAST(n AS VARCHAR), coalesce(dates, '')) AS detail FROM (SELECT min(trade_date) AS lo, max(trade_date) AS hi, count(DISTINCT trade_date) AS n FROM weights), (SELECT count(*) AS k, array_to_string(list(cal_date ORDER BY cal_date)[1:20], ',') AS dates FROM cal WHERE is_open = '1' AND cal_date NOT IN (SELECT trade_date FROM weights))")
def _(spark, sf):
    return quality.date_coverage(adapters.index_weights(frames.panel(spark, sf)), quality.expected_dates(adapters.calendar(spark, sf)), "index_weight")


_FIELDS = {"daily": ("open", "high", "low", "close", "amount"), "daily_basic": ("turnover_rate", "total_mv"), "daily_panel": ("open", "high", "low", "close", "amount", "adj_factor", "turnover_rate", "total_mv")}
_FROM = {"daily": "dd", "daily_basic": "basic", "daily_panel": "panel"}
_MISS = "mr AS (" + " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{f}' AS field, count(*) AS n_rows, avg(CASE WHEN {f} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_rate FROM {_FROM[t]}" for t, own in _FIELDS.items() for f in own) + ")"


@query("c05_missing_rates", f"{_TWICE}, {_MISS}", "SELECT *, CASE WHEN missing_rate > 0.05 THEN 'WARN' ELSE 'PASS' END AS status FROM mr", "missing_rate")
def _(spark, sf):
    p = frames.panel(spark, sf)
    tables = {"daily": _twice(adapters.daily(p)), "daily_basic": adapters.daily_basic(p), "daily_panel": p}
    return quality.missing_rates(tables, {t: [f for f in quality.REPORT_FIELDS if f in df.columns] for t, df in tables.items()})


@query("c06_ohlc_sanity", f"{P},{O.DAILY}", "SELECT 'ohlc_sanity:daily' AS check_name, CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS status, count(*) AS n_bad, '' AS detail FROM daily WHERE open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR high < low OR open < low OR open > high OR close < low OR close > high")
def _(spark, sf):
    return quality.ohlc_sanity(adapters.daily(frames.panel(spark, sf)))


@query("c07_two_way_coverage", BASIC, "SELECT 'missing_in_daily_basic' AS check_name, CASE WHEN count(*) > 0 THEN 'WARN' ELSE 'PASS' END AS status, count(*) AS n_bad, '' AS detail FROM daily d ANTI JOIN basic b ON d.ts_code = b.ts_code AND d.trade_date = b.trade_date UNION ALL SELECT 'missing_in_daily', CASE WHEN count(*) > 0 THEN 'WARN' ELSE 'PASS' END, count(*), '' FROM basic b ANTI JOIN daily d ON d.ts_code = b.ts_code AND d.trade_date = b.trade_date")
def _(spark, sf):
    p = frames.panel(spark, sf)
    return quality.two_way_coverage(adapters.daily(p), adapters.daily_basic(p), _master(p))


@query("c08_industry_match", P, "SELECT 'industry_match' AS check_name, CASE WHEN avg(CASE WHEN key % 9 <> 0 THEN 1.0 ELSE 0.0 END) < 0.9 THEN 'WARN' ELSE 'PASS' END AS status, count(*) FILTER (key % 9 = 0) AS n_bad, CAST(round(avg(CASE WHEN key % 9 <> 0 THEN 1.0 ELSE 0.0 END), 4) AS VARCHAR) AS detail FROM panel")
def _(spark, sf):
    p = frames.panel(spark, sf).withColumn("sw_l1_name", F.when(F.col("key") % 9 != 0, F.col("sw_l1_name")))
    return quality.industry_match(p, "19950101")


#: The seven checks in SQL, every status computed; the panel lacks an industry where key % 9 = 0, dates are expected from 1996 on.
_SEVEN = f"""{_TWICE}, {_MISS}, {O.CALENDAR}, {O.LOG},
ex AS (SELECT cal_date AS trade_date FROM cal WHERE is_open = '1' AND cal_date >= '19960101'),
ends AS (SELECT endpoint, count(*) FILTER (status = 'failed') AS failed, (SELECT count(*) FROM ex WHERE trade_date NOT IN (SELECT trade_date FROM log l WHERE l.endpoint = g.endpoint AND l.status = 'success')) AS gaps FROM log g GROUP BY endpoint),
lack AS (SELECT t, (SELECT count(*) FROM ex WHERE trade_date NOT IN (SELECT trade_date FROM dt WHERE dt.t = x.t AND month(strptime(trade_date, '%Y%m%d')) <> (CASE WHEN x.t = 'daily_basic' THEN 3 ELSE 0 END))) AS n FROM (SELECT DISTINCT t FROM dt) x),
bs AS (SELECT * FROM basic WHERE month(strptime(trade_date, '%Y%m%d')) <> 3),
mr2 AS (SELECT 'daily_basic' AS table_name, f AS field, avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) AS missing_rate FROM (SELECT 'turnover_rate' AS f, turnover_rate AS v FROM bs UNION ALL SELECT 'total_mv', total_mv FROM bs) GROUP BY f
    UNION ALL SELECT table_name, field, missing_rate FROM mr WHERE table_name <> 'daily_basic'),
only_d AS (SELECT count(*) AS n FROM dd ANTI JOIN bs USING (trade_date, ts_code)), only_b AS (SELECT count(*) AS n FROM bs ANTI JOIN dd USING (trade_date, ts_code)),
checks AS (
    SELECT 1 AS place, 'ingest_status' AS check_name, CASE WHEN count(*) > 0 THEN 'WARN' ELSE 'PASS' END AS status, count(*) AS n_bad, coalesce(string_agg(endpoint, ',' ORDER BY endpoint), '') AS detail FROM ends WHERE failed > 0 OR gaps > 0
    UNION ALL SELECT 2, 'duplicate_keys', CASE WHEN sum(n_bad) > 0 THEN 'FAIL' ELSE 'PASS' END, sum(n_bad)::BIGINT, string_agg(t || '=' || n_bad, ',' ORDER BY t) FROM tw
    UNION ALL SELECT 3, 'date_coverage', CASE WHEN sum(n) > 0 THEN 'FAIL' ELSE 'PASS' END, sum(n)::BIGINT, string_agg(t || '=' || n, ',' ORDER BY t) FROM lack
    UNION ALL SELECT 4, 'missing_rates', CASE WHEN count(*) > 0 THEN 'WARN' ELSE 'PASS' END, count(*), coalesce(string_agg(table_name || '.' || field, ',' ORDER BY table_name, field), '') FROM mr2 WHERE missing_rate > 0.05
    UNION ALL SELECT 5, 'ohlc_sanity', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, count(*), 'daily_panel' FROM panel WHERE open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR high < low OR open < low OR open > high OR close < low OR close > high
    UNION ALL SELECT 6, 'basic_coverage', CASE WHEN d.n + b.n > 0 THEN 'WARN' ELSE 'PASS' END, d.n + b.n, 'daily=' || d.n || ',daily_basic=' || b.n FROM only_d d, only_b b
    UNION ALL SELECT 7, 'industry_match', CASE WHEN avg(CASE WHEN key % 9 <> 0 THEN 1.0 ELSE 0.0 END) < 0.95 THEN 'WARN' ELSE 'PASS' END, count(*) FILTER (key % 9 = 0), count(*) FILTER (key % 9 <> 0) || '/' || count(*) FROM panel)"""


def _report(spark, sf):
    p = frames.panel(spark, sf)
    tables = {
        "daily": _twice(adapters.daily(p)),
        "daily_basic": adapters.daily_basic(p).filter("substring(trade_date, 5, 2) <> '03'"),
        "daily_panel": p.withColumn("sw_l1_name", F.when(F.col("key") % 9 != 0, F.col("sw_l1_name"))),
    }
    expected = quality.expected_dates(adapters.calendar(spark, sf), "19960101", "99991231")
    return quality.report(tables, adapters.ingest_log(spark, sf), expected, _master(p))


@query("c09_quality_report", _SEVEN, "SELECT * FROM checks")
def _(spark, sf):
    return _report(spark, sf)


@query("c09_quality_summary", _SEVEN, "SELECT status, count(*) AS n_checks FROM checks GROUP BY status")
def _(spark, sf):
    return _report(spark, sf).groupBy("status").agg(F.count("*").alias("n_checks"))


# --- D: sample ------------------------------------------------------------------------------------


@query("d01_flags", FL, "SELECT trade_date, ts_code, adj_close, listed_trade_days, is_main_board, is_st, is_limit_up_at_open, is_limit_down_at_open FROM flagged", "adj_close")
def _(spark, sf):
    f = sample.flags(frames.panel(spark, sf)).withColumn("listed_trade_days", F.col("listed_trade_days").cast("long"))
    return f.select("trade_date", "ts_code", "adj_close", "listed_trade_days", "is_main_board", "is_st", "is_limit_up_at_open", "is_limit_down_at_open")


@query("d07_eligibility", FL, "SELECT trade_date, ts_code, passes_base_filters, can_buy, can_sell, is_tradable FROM flagged")
def _(spark, sf):
    return sample.masked(sample.flags(frames.panel(spark, sf)), sample.SampleConfig()).select("trade_date", "ts_code", "passes_base_filters", "can_buy", "can_sell", "is_tradable")


@query("d06_date_filter_first", FL + ", cut0 AS (SELECT *, " + O.forward(1) + " AS forward_1d FROM flagged WHERE trade_date BETWEEN '19960101' AND '19991231' WINDOW w AS (PARTITION BY ts_code ORDER BY trade_date))", "SELECT trade_date, ts_code, forward_1d FROM (SELECT *, sum(CASE WHEN is_tradable THEN 1 ELSE 0 END) OVER (PARTITION BY trade_date) AS k FROM cut0) WHERE k >= 30", "forward_1d")
def _(spark, sf):
    s, _ = sample.build_sample(frames.panel(spark, sf), sample.SampleConfig(start="19960101", end="19991231", horizons=(1,)))
    return s.select("trade_date", "ts_code", "forward_1d")


@query("d09_forward_returns", SA, "SELECT trade_date, ts_code, forward_1d, forward_3d, forward_5d FROM labelled", "forward_1d forward_3d forward_5d")
def _(spark, sf):
    c = sample.SampleConfig()
    return sample.forward_returns(sample.masked(sample.flags(frames.panel(spark, sf)), c), c.horizons).select("trade_date", "ts_code", "forward_1d", "forward_3d", "forward_5d")


@query("d10_sample", SA, "SELECT trade_date, ts_code, is_tradable, tradable_count, forward_5d FROM sample", "forward_5d")
def _(spark, sf):
    return frames.research_sample(spark, sf).select("trade_date", "ts_code", "is_tradable", "tradable_count", "forward_5d")


@query("d10_skipped_dates", SA, "SELECT DISTINCT trade_date FROM counted WHERE tradable_count < 30")
def _(spark, sf):
    return sample.build_sample(frames.panel(spark, sf))[1]


LEGACY = f"""{P},
leg AS (SELECT *, close * adj_factor AS adj_close, coalesce(open >= up_limit, false) AS up FROM panel WHERE close IS NOT NULL AND total_mv > 0),
lw AS (SELECT *, coalesce(lead(up, 1) OVER w, false) AS next_open_is_limit_up, {O.forward(1, False)} AS forward_1d, {O.forward(5, False)} AS forward_5d, row_number() OVER w AS listed_rows, adj_close / lag(adj_close, 5) OVER w - 1 AS mom
    FROM leg WINDOW w AS (PARTITION BY ts_code ORDER BY trade_date)),
lu AS (SELECT *, NOT is_suspended AND listed_rows >= 6 AND mom IS NOT NULL AND forward_5d IS NOT NULL AS universe FROM lw)"""


def _legacy(spark, sf):
    d = sample.forward_returns(sample.legacy_panel(frames.panel(spark, sf)), (1, 5), tradable=None)
    return sample.legacy_universe(d.withColumn("mom", factors.momentum(5)), "mom", "forward_5d", 6)


@query("d11_legacy_panel", LEGACY, "SELECT trade_date, ts_code, adj_close, next_open_is_limit_up, forward_1d, forward_5d, CAST(listed_rows AS INTEGER) AS listed_rows, universe FROM lu", "adj_close forward_1d forward_5d")
def _(spark, sf):
    return _legacy(spark, sf).select("trade_date", "ts_code", "adj_close", "next_open_is_limit_up", "forward_1d", "forward_5d", "listed_rows", "universe")


def _members(spark, sf):
    return adapters.index_weights(frames.panel(spark, sf)).select("trade_date", F.col("con_code").alias("ts_code"))


@query("d15_as_of_members", f"{P},{O.WEIGHTS}", "SELECT p.trade_date, p.ts_code FROM panel p JOIN weights w ON w.ts_code = p.ts_code AND w.trade_date = (SELECT max(trade_date) FROM weights x WHERE x.trade_date <= p.trade_date)")
def _(spark, sf):
    return sample.as_of_members(frames.panel(spark, sf), _members(spark, sf)).select("trade_date", "ts_code")


@query("d16_exact_members", f"{P},{O.WEIGHTS}", "SELECT trade_date, ts_code FROM weights")
def _(spark, sf):
    return sample.exact_members(frames.panel(spark, sf), _members(spark, sf)).select("trade_date", "ts_code")


# --- E: factors -----------------------------------------------------------------------------------

_W = "WINDOW w AS (PARTITION BY ts_code ORDER BY trade_date)"


def _flagged(spark, sf):
    return sample.flags(frames.panel(spark, sf))


@query("e01_momentum", FL, f"SELECT trade_date, ts_code, adj_close / lag(adj_close, 20) OVER w - 1 AS momentum FROM flagged {_W}", "momentum")
def _(spark, sf):
    return _flagged(spark, sf).select("trade_date", "ts_code", factors.momentum(20).alias("momentum"))


@query("e03_volatility", FL + f", r AS (SELECT *, adj_close / lag(adj_close) OVER w - 1 AS ret_1 FROM flagged {_W})", "SELECT trade_date, ts_code, CASE WHEN count(ret_1) OVER v >= 20 THEN stddev_samp(ret_1) OVER v END AS volatility FROM r WINDOW v AS (PARTITION BY ts_code ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)", "volatility")
def _(spark, sf):
    return _flagged(spark, sf).withColumn("ret_1", factors.returns()).select("trade_date", "ts_code", factors.rolling_volatility(20).alias("volatility"))


@query("e04_legacy_momentum", FL, f"SELECT * FROM (SELECT trade_date, ts_code, adj_close / lag(adj_close, 3) OVER w - 1 AS mom FROM flagged {_W}) WHERE mom IS NOT NULL", "mom")
def _(spark, sf):
    return _flagged(spark, sf).select("trade_date", "ts_code", factors.momentum(3).alias("mom")).filter("mom is not null")


REG = FL + f""", r AS (SELECT *, adj_close / lag(adj_close) OVER w - 1 AS ret_1 FROM flagged {_W}),
reg AS (SELECT trade_date, ts_code, adj_close / lag(adj_close, 20) OVER w - 1 AS m20, adj_close / lag(adj_close, 5) OVER w - 1 AS r5, CASE WHEN count(ret_1) OVER v >= 20 THEN stddev_samp(ret_1) OVER v END AS v20
    FROM r WINDOW w AS (PARTITION BY ts_code ORDER BY trade_date), v AS (PARTITION BY ts_code ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
long AS (SELECT trade_date, ts_code, 'momentum_20d_v1' AS factor_id, m20 AS factor_value, 1 AS direction FROM reg UNION ALL SELECT trade_date, ts_code, 'reversal_5d_v1', r5, -1 FROM reg UNION ALL SELECT trade_date, ts_code, 'volatility_20d_v1', v20, -1 FROM reg)"""


@query("e05_registry_batch", REG, "SELECT * FROM long", "factor_value")
def _(spark, sf):
    return factors.run_registry(_flagged(spark, sf))


@query("e06_plugin", FL, f"SELECT trade_date, ts_code, close / lag(close, 2) OVER w AS mine FROM flagged {_W}", "mine")
def _(spark, sf):
    made = factors.run_plugin(_flagged(spark, sf), lambda df, k: F.try_divide(F.col("close"), F.lag("close", k).over(factors.by_code())), "mine", k=2)
    return made.select("trade_date", "ts_code", "mine")


@query("e06_plugin_by_code", FL, f"SELECT trade_date, ts_code, adj_close / lag(adj_close, 5) OVER w - 1 AS mine FROM flagged {_W}", "mine")
def _(spark, sf):
    rows = _flagged(spark, sf).select("trade_date", "ts_code", "adj_close")
    return factors.run_code_plugin(rows, factors.numpy_momentum, "mine", window=5).select("trade_date", "ts_code", "mine")


@query("e06_plugin_by_row", FL, "SELECT trade_date, ts_code, (high - low) / nullif(pre_close, 0) AS mine FROM flagged", "mine")
def _(spark, sf):
    rows = _flagged(spark, sf).select("trade_date", "ts_code", "high", "low", "pre_close")

    def amplitude(batch):
        import pyarrow.compute as pc

        base = pc.if_else(pc.equal(batch["pre_close"], 0.0), None, batch["pre_close"])
        return pc.divide(pc.subtract(batch["high"], batch["low"]), base)

    return factors.run_row_plugin(rows, amplitude, "mine").select("trade_date", "ts_code", "mine")


def _roll(x: str, n: int) -> str:
    return f"CASE WHEN count({x}) OVER v{n} >= {n} THEN avg({x}) OVER v{n} END"


TECH = FL + f""", r AS (SELECT *, adj_close / lag(adj_close) OVER w - 1 AS ret_1, (high - low) / pre_close AS ampl FROM flagged {_W}),
r2 AS (SELECT *, abs(ret_1) / amount AS illiq FROM r)"""


@query(
    "e07_technical_baselines",
    TECH,
    f"SELECT trade_date, ts_code, adj_close / lag(adj_close, 1) OVER w - 1 AS reversal_1d, adj_close / lag(adj_close, 3) OVER w - 1 AS reversal_3d, adj_close / lag(adj_close, 5) OVER w - 1 AS reversal_5d, adj_close / lag(adj_close, 20) OVER w - 1 AS momentum_20d, CASE WHEN count(ret_1) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) >= 20 THEN stddev_samp(ret_1) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) END AS volatility_20d, adj_close / lag(adj_close, 60) OVER w - 1 AS momentum_60d, {_roll('turnover_rate', 5)} AS turnover_5d, {_roll('turnover_rate', 20)} AS turnover_20d, {_roll('vol', 5)} / {_roll('vol', 20)} AS volume_ratio_5_20, {_roll('amount', 5)} / {_roll('amount', 20)} AS amount_ratio_5_20, {_roll('ampl', 20)} AS amplitude_20d, {_roll('illiq', 20)} * 1000 AS illiquidity_20d FROM r2 WINDOW w AS (PARTITION BY ts_code ORDER BY trade_date), v5 AS (PARTITION BY ts_code ORDER BY trade_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), v20 AS (PARTITION BY ts_code ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)",
    "reversal_1d reversal_3d reversal_5d momentum_20d volatility_20d momentum_60d turnover_5d turnover_20d volume_ratio_5_20 amount_ratio_5_20 amplitude_20d illiquidity_20d",
)
def _(spark, sf):
    names = list(factors.TECHNICAL)
    wide = store.to_wide(factors.compute(_flagged(spark, sf), {k: factors.TECHNICAL[k][0]() for k in names}), names)
    return wide.withColumn("illiquidity_20d", F.col("illiquidity_20d") * 1000)


# --- F: preprocessing -----------------------------------------------------------------------------

CHAIN = f"{SA}, mom AS (SELECT *, {O.MOMENTUM} AS m5 FROM sample), {O.chain('m5', 'mom')}"


@query("f01_attach", SA, "SELECT p.trade_date, p.ts_code, p.pb AS factor_value, s.total_mv, s.sw_l1_name FROM panel p LEFT JOIN sample s USING (trade_date, ts_code)", "factor_value total_mv")
def _(spark, sf):
    v = frames.panel(spark, sf).select("trade_date", "ts_code", F.col("pb").alias("factor_value"))
    return preprocess.attach(v, frames.research_sample(spark, sf))


@query("f02_validity", REG, "SELECT factor_id, count(factor_value) = 0 AS all_null, count(DISTINCT factor_value) = 1 AS \"constant\" FROM long GROUP BY factor_id")
def _(spark, sf):
    return preprocess.validity(factors.run_registry(_flagged(spark, sf)), "factor_value", ["factor_id"])


@query("f03_winsorize_mad", CHAIN, "SELECT trade_date, ts_code, factor_winsorized FROM f3b", "factor_winsorized")
def _(spark, sf):
    s = frames.research_sample(spark, sf).withColumn("m5", factors.momentum(5))
    return preprocess.winsorize_mad(s, "m5", "factor_winsorized", most=frames.FEW).select("trade_date", "ts_code", "factor_winsorized")


@query("f04_zscore", CHAIN, "SELECT trade_date, ts_code, factor_zscore FROM f4", "factor_zscore")
def _(spark, sf):
    return frames.processed(spark, sf, "none").select("trade_date", "ts_code", "factor_zscore")


@query("f05_zscore_legacy", f"{SA}, mom AS (SELECT *, {O.MOMENTUM} AS m5 FROM sample)", "SELECT trade_date, ts_code, CASE WHEN coalesce(stddev_pop(m5) OVER w, 0) <= 1e-12 THEN 0.0 ELSE (m5 - avg(m5) OVER w) / stddev_pop(m5) OVER w END AS z FROM mom WINDOW w AS (PARTITION BY trade_date)", "z")
def _(spark, sf):
    s = frames.research_sample(spark, sf).withColumn("m5", factors.momentum(5))
    return s.select("trade_date", "ts_code", preprocess.standardized("m5", ["trade_date"], legacy=True).alias("z"))


@query("f06_neutralize_size", f"{SA}, mom AS (SELECT *, {O.MOMENTUM} AS m5 FROM sample), {O.chain('m5', 'mom', neutral='size')}", "SELECT trade_date, ts_code, factor_neutral, factor_processed FROM processed", "factor_neutral factor_processed")
def _(spark, sf):
    return frames.processed(spark, sf, "size").select("trade_date", "ts_code", "factor_neutral", "factor_processed")


@query("f07_neutralize_industry_size", CHAIN, "SELECT trade_date, ts_code, factor_neutral FROM processed", "factor_neutral")
def _(spark, sf):
    return frames.processed(spark, sf).select("trade_date", "ts_code", "factor_neutral")


@query("f10_full_chain", CHAIN, "SELECT trade_date, ts_code, factor_raw, factor_winsorized, factor_zscore, factor_neutral, factor_processed FROM processed", "factor_raw factor_winsorized factor_zscore factor_neutral factor_processed")
def _(spark, sf):
    return frames.processed(spark, sf).select("trade_date", "ts_code", "factor_raw", "factor_winsorized", "factor_zscore", "factor_neutral", "factor_processed")


@query("f11_winsorize_percentile", P, "SELECT trade_date, ts_code, least(greatest(pb, quantile_cont(pb, 0.01) OVER w), quantile_cont(pb, 0.99) OVER w) AS pb_w FROM panel WINDOW w AS (PARTITION BY trade_date)", "pb_w")
def _(spark, sf):
    return preprocess.winsorize_percentile(frames.panel(spark, sf), "pb", "pb_w", most=frames.FEW).select("trade_date", "ts_code", "pb_w")


# --- G: evaluation --------------------------------------------------------------------------------


@query("g01_direction", REG, "SELECT trade_date, ts_code, factor_id, factor_value * direction AS factor_value_for_eval FROM long", "factor_value_for_eval")
def _(spark, sf):
    r = factors.run_registry(_flagged(spark, sf))
    return r.select("trade_date", "ts_code", "factor_id", (F.col("factor_value") * F.col("direction")).alias("factor_value_for_eval"))


@query("g02_coverage", EV, "SELECT avg(CASE WHEN f IS NOT NULL AND y IS NOT NULL THEN 1.0 ELSE 0.0 END) AS coverage_pct, count(*) AS n_total_rows, count(*) FILTER (f IS NOT NULL AND y IS NOT NULL) AS n_forward_return_samples FROM rows0", "coverage_pct")
def _(spark, sf):
    return evaluate.coverage(frames.factor_rows(spark, sf), FACTOR, LABEL)


@query("g03_usable_rows", EV, "SELECT trade_date, ts_code, f, n_valid FROM u0", "f")
def _(spark, sf):
    return evaluate.usable(frames.factor_rows(spark, sf), FACTOR, LABEL)[0].select("trade_date", "ts_code", "f", "n_valid")


@query("g03_thin_dates", EV, "SELECT DISTINCT trade_date FROM valid WHERE n_valid < 40")
def _(spark, sf):
    return evaluate.usable(frames.factor_rows(spark, sf), FACTOR, LABEL, 40)[1]


@query("g04_quantiles", EV, "SELECT trade_date, ts_code, quantile FROM u")
def _(spark, sf):
    rows, _ = evaluate.usable(frames.factor_rows(spark, sf), FACTOR, LABEL, most=frames.FEW)
    return evaluate.quantiles(rows, FACTOR, most=frames.FEW).select("trade_date", "ts_code", "quantile")


@query("g05_rank_ic", IC, "SELECT * FROM ric", "rank_ic")
def _(spark, sf):
    return evaluate.rank_ic(frames.usable(spark, sf), FACTOR, LABEL, most=frames.FEW)


@query("g06_pearson_ic", EV, f"SELECT trade_date, {O.corr('f', 'y')} AS ic, count(*) AS n_stocks FROM u GROUP BY trade_date HAVING count(*) >= 10", "ic")
def _(spark, sf):
    return evaluate.pearson_ic(frames.usable(spark, sf), FACTOR, LABEL)


STATS = "SELECT avg(rank_ic) AS mean, stddev_pop(rank_ic) AS std, avg(rank_ic) / nullif(stddev_pop(rank_ic), 0) AS ir, " + O.t_stat("rank_ic") + " AS t_stat, avg(CASE WHEN rank_ic > 0 THEN 1.0 ELSE 0.0 END) AS win_rate, avg(CASE WHEN rank_ic < 0 THEN 1.0 ELSE 0.0 END) AS negative_pct, avg(CASE WHEN rank_ic < -s THEN 1.0 ELSE 0.0 END) AS extreme_negative_pct, skewness(rank_ic) AS skew, kurtosis(rank_ic) AS kurtosis, count(rank_ic) AS n_days, arg_max(roll, trade_date) AS rolling_mean_latest FROM (SELECT *, stddev_pop(rank_ic) OVER () AS s, CASE WHEN count(*) OVER w >= 20 THEN avg(rank_ic) OVER w END AS roll FROM ric WINDOW w AS (ORDER BY trade_date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW))"


@query("g07_ic_stats", IC, STATS, "mean std ir t_stat win_rate negative_pct extreme_negative_pct skew kurtosis rolling_mean_latest")
def _(spark, sf):
    return evaluate.ic_stats(_ic(spark, sf))


@query("g08_ic_summary", IC, "SELECT avg(rank_ic) AS mean_ic, stddev_pop(rank_ic) AS std_ic, avg(CASE WHEN rank_ic > 0 THEN 1.0 ELSE 0.0 END) AS win_rate, count(*) AS n_days FROM ric", "mean_ic std_ic win_rate")
def _(spark, sf):
    return evaluate.ic_stats(_ic(spark, sf)).select(F.col("mean").alias("mean_ic"), F.col("std").alias("std_ic"), "win_rate", "n_days")


@query("g09_quantile_daily", QD, "SELECT * FROM qw", "q1 q2 q3 q4 q5")
def _(spark, sf):
    return _qw(spark, sf)


QSUM = "SELECT quantile, avg(avg_return) AS mean_return, stddev_samp(avg_return) AS std_return, count(*) AS count, avg(CASE WHEN avg_return > 0 THEN 1.0 ELSE 0.0 END) AS hit_rate FROM qd GROUP BY quantile"


@query("g09_quantile_summary", QD, QSUM, "mean_return std_return hit_rate")
def _(spark, sf):
    return evaluate.quantile_summary(_qd(spark, sf))


@query("g10_spread_stats", QD, f"SELECT avg(q5 - q1) AS spread_mean, {O.t_stat('q5 - q1')} AS spread_t, " + ", ".join(f"{O.t_stat(f'q{k + 1} - q{k}')} AS t_q{k + 1}_q{k}" for k in range(1, 5)) + " FROM qw", "spread_mean spread_t t_q2_q1 t_q3_q2 t_q4_q3 t_q5_q4")
def _(spark, sf):
    return evaluate.spread_stats(_qw(spark, sf))


@query("g11_monotonicity", QD, f"SELECT CASE WHEN min(d) >= 0 THEN 'increasing' WHEN max(d) <= 0 THEN 'decreasing' ELSE 'mixed' END AS monotonicity FROM (SELECT mean_return - lag(mean_return) OVER (ORDER BY quantile) AS d FROM ({QSUM}))")
def _(spark, sf):
    return evaluate.monotonicity(evaluate.quantile_summary(_qd(spark, sf)))


LS = QD + """,
ls0 AS (SELECT trade_date, q5 - q1 AS spread, row_number() OVER (ORDER BY trade_date) - 1 AS i FROM qw),
ls AS (SELECT trade_date, spread, product(CASE WHEN i % 5 = 0 THEN 1 + coalesce(spread, 0) ELSE 1 END) OVER (ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS cum_spread FROM ls0),
lsd AS (SELECT *, (1 + cum_spread) / max(1 + cum_spread) OVER (ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS dd FROM ls)"""


@query("g12_long_short", LS, "SELECT trade_date, spread, cum_spread FROM ls", "spread cum_spread")
def _(spark, sf):
    return evaluate.long_short(_qw(spark, sf))


@query("g13_rebalanced", QD + ", s0 AS (SELECT trade_date, q5, row_number() OVER (ORDER BY trade_date) - 1 AS i FROM qw)", "SELECT trade_date, q5, product(CASE WHEN i % 3 = 0 THEN 1 + coalesce(q5, 0) ELSE 1 END) OVER (ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS cum_q5 FROM s0", "q5 cum_q5")
def _(spark, sf):
    return evaluate.rebalanced(_qw(spark, sf).select("trade_date", "q5"), "q5", "cum_q5", 3)


def _annual(ret: str, dd: str, last: str) -> str:
    return f"avg({ret}) AS mean_return, avg({ret}) * 252 AS annual_return, stddev_pop({ret}) * sqrt(252.0) AS annual_volatility, avg({ret}) * 252 / nullif(stddev_pop({ret}) * sqrt(252.0), 0) AS sharpe, CASE WHEN min({dd}) < 0 THEN avg({ret}) * 252 / abs(min({dd})) END AS calmar, min({dd}) AS max_drawdown, {last} AS cum_return, avg(CASE WHEN {ret} IS NULL THEN NULL WHEN {ret} > 0 THEN 1.0 ELSE 0.0 END) AS win_rate"


ANNUAL = "mean_return annual_return annual_volatility sharpe calmar max_drawdown cum_return win_rate"


@query("g14_annualized_long_short", LS, f"SELECT {_annual('spread', 'dd', 'arg_max(cum_spread, trade_date)')} FROM lsd", ANNUAL)
def _(spark, sf):
    return evaluate.annualized(evaluate.long_short(_qw(spark, sf)), "spread", 1 + F.col("cum_spread"))


@query("g15_long_short_legacy", LS, "SELECT avg(spread) * 252 / (stddev_samp(spread) * sqrt(252.0)) AS sharpe, CASE WHEN min(dd) < 0 THEN avg(spread) * 252 / abs(min(dd)) END AS calmar, avg(spread) * 252 AS annual_return, stddev_samp(spread) * sqrt(252.0) AS annual_vol, min(dd) AS max_dd FROM lsd", "sharpe calmar annual_return annual_vol max_dd")
def _(spark, sf):
    return evaluate.long_short_legacy(evaluate.long_short(_qw(spark, sf)))


def _bt(cost: str = "0.0", source: str = "u", gross: str = "avg(y)") -> str:
    w = "(ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""
t0 AS (SELECT *, dense_rank() OVER (ORDER BY trade_date) - 1 AS d FROM {source} WHERE quantile = 5 AND y IS NOT NULL),
t1 AS (SELECT *, d // 5 AS r FROM t0 WHERE d % 5 = 0),
t2 AS (SELECT *, coalesce(lag(r) OVER (PARTITION BY ts_code ORDER BY r) = r - 1, false) AS kept FROM t1),
t3 AS (SELECT trade_date, count(*) AS n_holdings, {gross} AS gross_return, 1 - sum(CASE WHEN kept THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) AS turnover FROM t2 GROUP BY trade_date),
t4 AS (SELECT *, 2 * turnover * {cost} AS cost, gross_return - 2 * turnover * {cost} AS net_return FROM t3),
t5 AS (SELECT *, product(1 + gross_return) OVER {w} AS gross_equity, product(1 + net_return) OVER {w} AS net_equity FROM t4),
bt AS (SELECT *, net_equity / max(net_equity) OVER {w} - 1 AS drawdown FROM t5)"""


BT_COLS = "gross_return turnover cost net_return gross_equity net_equity drawdown"


@query("g16_top_backtest", f"{EV},{_bt()}", "SELECT * FROM bt", BT_COLS)
def _(spark, sf):
    return evaluate.top_backtest(frames.usable(spark, sf), LABEL)


@query("g17_top_summary", f"{EV},{_bt()}", f"SELECT {_annual('net_return', 'drawdown', 'arg_max(net_equity, trade_date) - 1')}, avg(turnover) AS mean_turnover, count(*) AS n_rebalances FROM bt", ANNUAL + " mean_turnover")
def _(spark, sf):
    return evaluate.top_summary(evaluate.top_backtest(frames.usable(spark, sf), LABEL))


TURN = EV + """,
d0 AS (SELECT *, dense_rank() OVER (ORDER BY trade_date) AS d FROM u),
d1 AS (SELECT *, coalesce(lag(quantile) OVER w = quantile AND lag(d) OVER w = d - 1, false) AS kept FROM d0 WINDOW w AS (PARTITION BY ts_code ORDER BY d)),
turn AS (SELECT trade_date, quantile, 1 - sum(CASE WHEN kept THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) AS turnover FROM d1 WHERE d > 1 GROUP BY trade_date, quantile)"""


@query("g18_turnover", TURN, "SELECT * FROM turn", "turnover")
def _(spark, sf):
    return evaluate.turnover(frames.usable(spark, sf))


@query("g18_turnover_summary", TURN, "SELECT avg(turnover) AS mean_turnover, stddev_pop(turnover) AS turnover_std FROM turn", "mean_turnover turnover_std")
def _(spark, sf):
    return evaluate.turnover_summary(evaluate.turnover(frames.usable(spark, sf)))


AUTO = EV + f""",
a0 AS (SELECT trade_date, ts_code, f, dense_rank() OVER (ORDER BY trade_date) AS d FROM u),
a1 AS (SELECT a.trade_date, l.lag, a.f, b.f AS p FROM a0 a, (SELECT unnest(range(1, 6)) AS lag) l, a0 b WHERE b.ts_code = a.ts_code AND b.d = a.d - l.lag),
a2 AS (SELECT trade_date, lag, {O.avg_rank('f', 'trade_date, lag')} AS x, {O.avg_rank('p', 'trade_date, lag')} AS z FROM a1),
ac AS (SELECT CAST(lag AS INTEGER) AS lag, trade_date, {O.corr('x', 'z')} AS autocorr, count(*) AS n_overlap FROM a2 GROUP BY trade_date, lag HAVING count(*) >= 10)"""


@query("g19_autocorrelation_decay", AUTO, "SELECT lag, avg(autocorr) AS mean_autocorr FROM ac GROUP BY lag", "mean_autocorr")
def _(spark, sf):
    return evaluate.autocorrelation_decay(evaluate.autocorrelation(frames.usable(spark, sf), FACTOR))


@query("g19_autocorrelation_large_dates", AUTO, "SELECT * FROM ac", "autocorr")
def _(spark, sf):
    return evaluate.autocorrelation(frames.usable(spark, sf), FACTOR, most=frames.FEW)


@query("g20_autocorrelation_lag1", AUTO, "SELECT * FROM ac WHERE lag = 1", "autocorr")
def _(spark, sf):
    return evaluate.autocorrelation(frames.usable(spark, sf), FACTOR, 1)


@query("g21_industry_exposure", EV, "SELECT sw_l1_name AS industry, avg(factor_raw) AS mean_exposure, stddev_pop(factor_raw) AS std_exposure, count(*) AS n_stocks, CASE WHEN stddev_pop(factor_raw) > 0 THEN avg(factor_raw) / stddev_pop(factor_raw) ELSE 0.0 END AS normalized_exposure FROM u GROUP BY 1", "mean_exposure std_exposure normalized_exposure")
def _(spark, sf):
    return evaluate.industry_exposure(frames.usable(spark, sf), "factor_raw")


@query("g22_distribution", EV, "SELECT count(factor_raw) AS count, avg(factor_raw) AS mean, stddev_pop(factor_raw) AS std, skewness(factor_raw) AS skew, kurtosis(factor_raw) AS kurtosis, quantile_cont(factor_raw, 0.01) AS p01, quantile_cont(factor_raw, 0.5) AS p50, quantile_cont(factor_raw, 0.99) AS p99 FROM rows0", "mean std skew kurtosis p01 p50 p99")
def _(spark, sf):
    return evaluate.distribution(frames.factor_rows(spark, sf), "factor_raw", most=frames.FEW)


SIZE = EV + f""",
s0 AS (SELECT *, count(*) OVER (PARTITION BY trade_date) AS k FROM u WHERE total_mv > 0),
s1 AS (SELECT *, {O.bucket('row_number() OVER (PARTITION BY trade_date ORDER BY total_mv, ts_code)', 'k', 3)} AS size_bucket FROM s0 WHERE k >= 9),
s2 AS (SELECT size_bucket, trade_date, {O.avg_rank('f', 'size_bucket, trade_date')} AS x, {O.avg_rank('y', 'size_bucket, trade_date')} AS z FROM s1)"""


@query("g23_size_bucket_ic", SIZE, f"SELECT size_bucket, trade_date, {O.corr('x', 'z')} AS rank_ic, count(*) AS n_stocks FROM s2 GROUP BY ALL HAVING count(*) >= 10", "rank_ic")
def _(spark, sf):
    return evaluate.size_bucket_ic(frames.usable(spark, sf), FACTOR, LABEL, most=frames.FEW)


YEARS = f"{QD},{O.IC}, yr AS (SELECT CAST(year(r.trade_date) AS INTEGER) AS year, count(*) AS n_days, avg(rank_ic) AS rank_ic_mean, avg(CASE WHEN rank_ic > 0 THEN 1.0 ELSE 0.0 END) AS rank_ic_win_rate, avg(q5) AS top_return_mean, product(coalesce(1 + q5, 1)) - 1 AS top_return_cum FROM ric r LEFT JOIN qw USING (trade_date) GROUP BY 1)"


def _years(spark, sf):
    u = frames.usable(spark, sf)
    return evaluate.yearly(evaluate.rank_ic(u, FACTOR, LABEL), evaluate.quantile_daily(u, LABEL))


@query("g24_yearly", YEARS, "SELECT * FROM yr", "rank_ic_mean rank_ic_win_rate top_return_mean top_return_cum")
def _(spark, sf):
    return _years(spark, sf)


@query("g25_single_year_concentration", YEARS, "SELECT count(*) FILTER (top_return_mean > 0) AS positive_years, count(*) AS total_years, count(*) FILTER (top_return_mean > 0) <= 1 AND count(*) > 1 AS has_single_year_concentration FROM yr")
def _(spark, sf):
    return evaluate.concentration(_years(spark, sf))


@query("g26_negative_streak", IC, "SELECT CAST(coalesce(max(k), 0) AS BIGINT) AS negative_streak_max FROM (SELECT count(*) AS k FROM (SELECT rank_ic < 0 AS neg, row_number() OVER (ORDER BY trade_date) - row_number() OVER (PARTITION BY rank_ic < 0 ORDER BY trade_date) AS g FROM ric) WHERE neg GROUP BY g)")
def _(spark, sf):
    return evaluate.negative_streak(_ic(spark, sf), "rank_ic")


@query("g27_autocorr_half_life", AUTO + ", dk AS (SELECT lag, avg(autocorr) AS a FROM ac GROUP BY lag)", "SELECT min(lag) FILTER (abs(a) <= (SELECT abs(a) / 2 FROM dk WHERE lag = 1)) AS half_life FROM dk")
def _(spark, sf):
    return evaluate.half_life(evaluate.autocorrelation_decay(evaluate.autocorrelation(frames.usable(spark, sf), FACTOR)), "lag", "mean_autocorr", False)


HOR = EV + f""",
h0 AS (SELECT trade_date, ts_code, f, 1 AS horizon, forward_1d AS l FROM rows0 UNION ALL SELECT trade_date, ts_code, f, 3, forward_3d FROM rows0 UNION ALL SELECT trade_date, ts_code, f, 5, y FROM rows0),
h1 AS (SELECT * FROM h0 WHERE f IS NOT NULL AND l IS NOT NULL),
h2 AS (SELECT horizon, trade_date, {O.avg_rank('f', 'horizon, trade_date')} AS x, {O.avg_rank('l', 'horizon, trade_date')} AS z FROM h1),
h3 AS (SELECT horizon, trade_date, {O.corr('x', 'z')} AS ic FROM h2 GROUP BY ALL HAVING count(*) >= 10),
decay AS (SELECT horizon, avg(ic) AS mean_ic, stddev_pop(ic) AS std_ic, avg(ic) / nullif(stddev_pop(ic), 0) AS ic_ir FROM h3 GROUP BY horizon)"""


def _decay(spark, sf):
    return evaluate.ic_decay(frames.factor_rows(spark, sf).withColumnRenamed(LABEL, "forward_5d"), FACTOR, (1, 3, 5))


HORIZONS = range(1, 21)
ALL_HOR = LEGACY + f""",
ha AS (SELECT trade_date, ts_code, round(mom, 6) AS f, {", ".join(f'{O.forward(h, False)} AS "{h}"' for h in HORIZONS)} FROM lu WINDOW w AS (PARTITION BY ts_code ORDER BY trade_date)),
h1 AS (SELECT trade_date, f, CAST(horizon AS INTEGER) AS horizon, l FROM (UNPIVOT ha ON {", ".join(f'"{h}"' for h in HORIZONS)} INTO NAME horizon VALUE l) WHERE f IS NOT NULL),
h2 AS (SELECT horizon, trade_date, {O.avg_rank('f', 'horizon, trade_date')} AS x, {O.avg_rank('l', 'horizon, trade_date')} AS z FROM h1),
h3 AS (SELECT horizon, trade_date, {O.corr('x', 'z')} AS ic FROM h2 GROUP BY ALL HAVING count(*) >= 10),
decay AS (SELECT horizon, avg(ic) AS mean_ic, stddev_pop(ic) AS std_ic, avg(ic) / nullif(stddev_pop(ic), 0) AS ic_ir FROM h3 GROUP BY horizon)"""


def _all_horizons(spark, sf):
    d = sample.forward_returns(sample.legacy_panel(frames.panel(spark, sf)), HORIZONS, tradable=None)
    return d.withColumn(FACTOR, F.round(factors.momentum(5), 6))


@query("d13_legacy_returns", ALL_HOR, "SELECT trade_date, ts_code, " + ", ".join(f'"{h}" AS forward_{h}d' for h in HORIZONS) + " FROM ha", " ".join(f"forward_{h}d" for h in HORIZONS))
def _(spark, sf):
    return _all_horizons(spark, sf).select("trade_date", "ts_code", *[f"forward_{h}d" for h in HORIZONS])


@query("g28_ic_decay", ALL_HOR, "SELECT * FROM decay", "mean_ic std_ic ic_ir")
def _(spark, sf):
    return evaluate.ic_decay(_all_horizons(spark, sf), FACTOR, HORIZONS)


@query("g29_ic_half_life", ALL_HOR, "SELECT min(horizon) FILTER (abs(mean_ic) < (SELECT abs(mean_ic) / 2 FROM decay WHERE horizon = 1)) AS half_life FROM decay")
def _(spark, sf):
    return evaluate.half_life(evaluate.ic_decay(_all_horizons(spark, sf), FACTOR, HORIZONS), "horizon", "mean_ic", True)


REGR = EV + f""",
g0 AS (SELECT trade_date, regr_slope(y, f) AS factor_return, {O.corr('f', 'y')} AS r, count(*) AS n_stocks FROM u GROUP BY trade_date HAVING count(*) >= 10),
g1 AS (SELECT trade_date, factor_return, n_stocks, r * sqrt((n_stocks - 2) / (1 - r * r)) AS t_value FROM g0)"""


@query("g30_regression_t", REGR, "SELECT * FROM g1", "factor_return t_value")
def _(spark, sf):
    return evaluate.regression_t(frames.usable(spark, sf), FACTOR, LABEL)


@query("g30_regression_summary", REGR, f"SELECT count(*) AS n_periods, avg(factor_return) AS mean_factor_return, {O.t_stat('factor_return')} AS return_t_stat, avg(abs(t_value)) AS mean_abs_t, avg(CASE WHEN abs(t_value) > 2 THEN 1.0 ELSE 0.0 END) AS pct_abs_t_gt_2 FROM g1", "mean_factor_return return_t_stat mean_abs_t pct_abs_t_gt_2")
def _(spark, sf):
    return evaluate.regression_summary(evaluate.regression_t(frames.usable(spark, sf), FACTOR, LABEL))


_MONTHS = [f"m{m:02d}" for m in range(1, 13)]


@query("g31_monthly_matrix", IC, "SELECT CAST(year(trade_date) AS INTEGER) AS year, " + ", ".join(f"avg(rank_ic) FILTER (month(trade_date) = {k}) AS m{k:02d}" for k in range(1, 13)) + " FROM ric GROUP BY 1", " ".join(_MONTHS))
def _(spark, sf):
    return evaluate.monthly_matrix(_ic(spark, sf))


@query("g32_ic_by_index", f"{EV},{O.WEIGHTS}, iu AS (SELECT u.* FROM u JOIN weights w ON w.day = u.trade_date AND w.ts_code = u.ts_code)", f"SELECT 'TOP' AS index_code, trade_date, {O.corr('x', 'z')} AS rank_ic, count(*) AS n_stocks FROM (SELECT trade_date, {O.avg_rank('f', 'trade_date')} AS x, {O.avg_rank('y', 'trade_date')} AS z FROM iu) GROUP BY trade_date HAVING count(*) >= 10", "rank_ic")
def _(spark, sf):
    m = adapters.index_weights(frames.panel(spark, sf)).select("index_code", F.col("day").alias("trade_date"), F.col("con_code").alias("ts_code"))
    u = frames.usable(spark, sf).join(m, ["trade_date", "ts_code"])
    return evaluate.rank_ic(u, FACTOR, LABEL, ["index_code"])


@query("g33_split_periods", EV + ", dd AS (SELECT trade_date, row_number() OVER (ORDER BY trade_date) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT trade_date FROM u))", "SELECT CASE WHEN n >= 2 AND i < greatest(1, least(n - 1, CAST(floor(n * 0.75) AS BIGINT))) THEN 'in_sample' ELSE 'out_of_sample' END AS period, count(*) AS n_dates, min(trade_date) AS first_date FROM dd GROUP BY 1")
def _(spark, sf):
    s = evaluate.split_periods(frames.usable(spark, sf))
    return s.groupBy("period").agg(F.countDistinct("trade_date").alias("n_dates"), F.min("trade_date").alias("first_date"))


def _costed(spark, sf, cost=0.001):
    return evaluate.top_backtest(frames.usable(spark, sf), LABEL, cost=cost)


@query("g36_costed_backtest", f"{EV},{_bt('0.001')}", "SELECT count(*) AS n_periods, avg(n_holdings) AS mean_holdings, arg_max(net_equity, trade_date) AS net_equity, power(arg_max(net_equity, trade_date), 50.4 / count(*)) - 1 AS annual_return, stddev_samp(net_return) * sqrt(50.4) AS annual_volatility, (power(arg_max(net_equity, trade_date), 50.4 / count(*)) - 1) / (stddev_samp(net_return) * sqrt(50.4)) AS sharpe, CASE WHEN min(drawdown) < 0 THEN (power(arg_max(net_equity, trade_date), 50.4 / count(*)) - 1) / abs(min(drawdown)) END AS calmar, min(drawdown) AS max_drawdown, avg(turnover) AS mean_turnover, avg(cost) AS mean_cost FROM bt", "mean_holdings net_equity annual_return annual_volatility sharpe calmar max_drawdown mean_turnover mean_cost")
def _(spark, sf):
    return evaluate.geometric_summary(_costed(spark, sf))


@query("g38_weighted_backtest", f"{EV},{_bt('0.001', gross='sum(y * total_mv) / sum(total_mv)')}", "SELECT * FROM bt", BT_COLS)
def _(spark, sf):
    return evaluate.top_backtest(frames.usable(spark, sf), LABEL, cost=0.001, weight="total_mv")


@query("g39_cost_scenarios", f"{EV},{_bt()}", "SELECT c AS cost_rate, product(1 + gross_return - 2 * turnover * c) AS net_equity FROM bt, (SELECT unnest([0.0, 0.001, 0.003]) AS c) GROUP BY c", "cost_rate net_equity")
def _(spark, sf):
    b = evaluate.top_backtest(frames.usable(spark, sf), LABEL)
    rates = F.explode(F.array(F.lit(0.0), F.lit(0.001), F.lit(0.003)))
    return b.withColumn("cost_rate", rates).groupBy("cost_rate").agg(F.product(1 + F.col("gross_return") - 2 * F.col("turnover") * F.col("cost_rate")).alias("net_equity"))


@query("g40_spaced_ir", IC + ", n0 AS (SELECT *, row_number() OVER (ORDER BY trade_date) - 1 AS i, count(*) OVER () AS n FROM ric)", "SELECT avg(rank_ic) FILTER (i % 5 = 0) / nullif(stddev_pop(rank_ic) FILTER (i % 5 = 0), 0) AS spaced_ir, count(*) FILTER (i % 5 = 0) AS n_spaced, avg(rank_ic) FILTER (i < n // 2) AS first_half, avg(rank_ic) FILTER (i >= n // 2) AS second_half FROM n0", "spaced_ir first_half second_half")
def _(spark, sf):
    return evaluate.spaced_ir(_ic(spark, sf))


@query("g41_neutralization_comparison", EV + f", rv AS (SELECT trade_date, ts_code, round(factor_raw, 6) AS v, y, 'raw' AS factor_id FROM u UNION ALL SELECT trade_date, ts_code, f, y, 'processed' FROM u), rr AS (SELECT factor_id, trade_date, {O.avg_rank('v', 'factor_id, trade_date')} AS x, {O.avg_rank('y', 'factor_id, trade_date')} AS z FROM rv)", f"SELECT factor_id, avg(ic) AS mean, stddev_pop(ic) AS std FROM (SELECT factor_id, trade_date, {O.corr('x', 'z')} AS ic FROM rr GROUP BY ALL) GROUP BY factor_id", "mean std")
def _(spark, sf):
    u = frames.usable(spark, sf).select("trade_date", "ts_code", LABEL, F.round("factor_raw", 6).alias("raw"), F.col(FACTOR).alias("processed"))
    long = u.unpivot(["trade_date", "ts_code", LABEL], ["raw", "processed"], "factor_id", "v")
    return evaluate.ic_stats(evaluate.rank_ic(long, "v", LABEL, ["factor_id"]), keys=["factor_id"]).select("factor_id", "mean", "std")


@query("g42_cumulative_ic", IC, "SELECT trade_date, sum(rank_ic) OVER (ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_ic, CASE WHEN count(*) OVER v >= 5 THEN avg(rank_ic) OVER v END AS rolling_20 FROM ric WINDOW v AS (ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)", "cum_ic rolling_20")
def _(spark, sf):
    return evaluate.rolling_series(_ic(spark, sf))


@query("g43_multi_horizon_stats", HOR, f"SELECT horizon, avg(ic) AS mean, stddev_pop(ic) AS std, {O.t_stat('ic')} AS t_stat, count(*) AS n_days FROM h3 GROUP BY horizon", "mean std t_stat")
def _(spark, sf):
    r = frames.factor_rows(spark, sf).withColumnRenamed(LABEL, "forward_5d")
    long = r.unpivot(["trade_date", "ts_code", FACTOR], ["forward_1d", "forward_3d", "forward_5d"], "h", "l").withColumn("horizon", F.regexp_extract("h", r"(\d)", 1).cast("int"))
    return evaluate.ic_stats(evaluate.rank_ic(long, FACTOR, "l", ["horizon"]), keys=["horizon"]).select("horizon", "mean", "std", "t_stat", "n_days")


# --- I: comparison and gate -----------------------------------------------------------------------


def _batch(spark, sf):
    """Registered factors with direction, labels and periods full, in_sample, out_of_sample; one job for all."""
    s = frames.research_sample(spark, sf)
    long = factors.run_registry(s).join(s.select("trade_date", "ts_code", "day", "total_mv", "sw_l1_name", F.col("forward_5d").alias(LABEL)), ["trade_date", "ts_code"])
    p = preprocess.preprocess(long, "factor_value", ["factor_id", "day"])
    return p.select("factor_id", F.col("day").alias("trade_date"), "ts_code", "total_mv", "sw_l1_name", F.col("factor_value").alias("factor_raw"), F.round(F.col("factor_processed") * F.col("direction"), 6).alias(FACTOR), LABEL)


def evaluate_batch(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The gate's metrics for each key: full sample, in and out of sample, from one long frame.

    The frame, and its usable rows with buckets and ranks, are written once; dates are measured once.  A period is a set
    of dates, so what belongs to a date is computed once and then counts in the whole and in its part.
    """
    rows = store.stored(rows)
    spread = order.spread_out(rows, [*keys, "trade_date"], order.ONE_TASK, None)
    ok = evaluate.usable(rows.select(*keys, "trade_date", "ts_code", FACTOR, LABEL), FACTOR, LABEL, keys=keys, spread=spread)[0].drop("n_valid")
    u = store.stored(evaluate.ranked(evaluate.quantiles(ok, FACTOR, keys=keys, spread=spread), FACTOR, LABEL, keys, spread=spread))
    by = [*keys, "period"]
    ic = store.stored(evaluate.ic_of_ranks(u, keys))
    fd = store.stored(evaluate.quantile_daily(u, LABEL, keys))
    turn = evaluate.turnover(u.select(*keys, "trade_date", "ts_code", "quantile"), keys)
    cov = evaluate.coverage(rows, FACTOR, LABEL, keys).select(*keys, "coverage_pct", F.col("n_forward_return_samples").alias("n_samples"))
    return _metrics(cov.join(preprocess.validity(rows, FACTOR, keys), keys, "left"), ic, fd, turn, keys)


def _metrics(facts: DataFrame, ic: DataFrame, fd: DataFrame, turn: DataFrame, keys: list[str]) -> DataFrame:
    """The gate's metrics from series by date: rank ICs, mean labels and turnover of buckets; ``facts`` has a row for each key."""
    by = [*keys, "period"]
    parts = store.stored(evaluate.split_periods(ic.select(*keys, "trade_date"), keys=keys).withColumn("period", F.explode(F.array(F.lit("full"), F.col("period")))))
    spreads = evaluate.spread_stats(evaluate.wide(fd, keys=keys).join(parts, [*keys, "trade_date"]), keys=by).select(*by, "spread_mean")
    means = ic.join(parts, [*keys, "trade_date"]).groupBy(*by).agg(F.avg("rank_ic").alias("ic")).join(spreads, by)
    wide = means.groupBy(*keys).agg(*[F.max(F.when(F.col("period") == p, F.col(c))).alias(n) for p, c, n in (("full", "ic", "rank_ic_mean"), ("full", "spread_mean", "spread_mean"), ("in_sample", "ic", "is_rank_ic"), ("in_sample", "spread_mean", "is_spread"), ("out_of_sample", "ic", "oos_rank_ic"), ("out_of_sample", "spread_mean", "oos_spread"))])
    top = evaluate.annualized(store.stored(evaluate.top_returns(fd, keys=keys)), "net_return", F.col("net_equity"), keys).select(*keys, F.col("mean_return").alias("top_return"), "sharpe", "max_drawdown")
    turned = evaluate.turnover_summary(turn, keys).select(*keys, "mean_turnover")
    mono = evaluate.monotonicity(evaluate.quantile_summary(fd, keys), keys)
    years = evaluate.concentration(evaluate.yearly(ic, fd, keys=keys), keys).select(*keys, F.col("has_single_year_concentration").alias("single_year"))
    dates = ic.groupBy(*keys).agg(F.countDistinct("trade_date").alias("n_valid_dates"))
    return reduce(lambda a, b: a.join(b, keys, "left"), [facts, dates, wide, top, turned, mono, years])


@query("g34_evaluation_batch", B.factors({"registered": B.REGISTERED}) + "," + B.batch("long0", ["factor_id"]), "SELECT * FROM metrics", B.METRIC_DOUBLES)
def _(spark, sf):
    return evaluate_batch(_batch(spark, sf), ["factor_id"])


def _melt(frame: str, key: str, source: str, metrics: str, where: str = "") -> str:
    """SQL for one frame: its metrics are columns or ``name=expression``, parted by ``;``."""
    pairs = [m.strip().split("=", 1) if "=" in m else (m.strip(), m.strip()) for m in metrics.split(";")]
    names, values = ", ".join(f"'{n}'" for n, _ in pairs), ", ".join(f"CAST({v} AS DOUBLE)" for _, v in pairs)
    return f"SELECT '{frame}' AS frame, CAST({key} AS VARCHAR) AS key, unnest([{names}]) AS metric, unnest([{values}]) AS value FROM {source} {where}"


_LONG_H = ", ".join(f"{O.forward(h, False)} AS forward_{h}d" for h in range(1, 21))
_RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_OLD = (
    f"""{P},
leg AS (SELECT *, close * adj_factor AS adj_close FROM panel WHERE close IS NOT NULL AND total_mv > 0),
lw AS (SELECT *, {_LONG_H}, row_number() OVER w AS listed_rows, adj_close / lag(adj_close, 5) OVER w - 1 AS mom FROM leg WINDOW w AS (PARTITION BY ts_code ORDER BY trade_date)),
lu AS (SELECT *, NOT is_suspended AND listed_rows >= 6 AND mom IS NOT NULL AND forward_5d IS NOT NULL AS universe FROM lw),"""
    + O.chain("mom", "lu")
    + f""",
z1 AS (SELECT *, CASE WHEN factor_zscore IS NOT NULL AND total_mv > 0 THEN factor_zscore END AS sy, CASE WHEN factor_zscore IS NOT NULL AND total_mv > 0 THEN ln(total_mv) END AS sx FROM f7),
z2 AS (SELECT * EXCLUDE (trade_date), day AS trade_date, round(factor_neutral, 6) AS f, CASE WHEN count(sy) OVER w >= 5 THEN sy - (avg(sy) OVER w + coalesce(covar_pop(sy, sx) OVER w / nullif(var_pop(sx) OVER w, 0), 0) * (sx - avg(sx) OVER w)) END AS factor_size FROM z1 WINDOW w AS (PARTITION BY day)),
z3 AS (SELECT *, CASE WHEN f IS NOT NULL THEN {O.bucket("row_number() OVER (PARTITION BY trade_date ORDER BY f NULLS LAST, ts_code)", "count(f) OVER (PARTITION BY trade_date)", 5)} END AS quantile FROM z2),
u AS (SELECT * EXCLUDE (x, y), forward_5d AS y FROM z3 WHERE universe),
stages AS ({" UNION ALL ".join(f"SELECT '{k}' AS version, {'factor_winsorized' if c == 'factor_raw' else c} AS x FROM u" for k, c in legacy.STAGES.items())}),
dist AS (SELECT version, count(x) AS n, avg(x) AS mean, stddev_samp(x) AS std, skewness(x) AS skew, quantile_cont(x, 0.01) AS p01, quantile_cont(x, 0.99) AS p99 FROM stages WHERE x IS NOT NULL GROUP BY version),
hz AS ({" UNION ALL ".join(f"SELECT trade_date, f, {h} AS horizon, forward_{h}d AS y FROM u WHERE f IS NOT NULL AND forward_{h}d IS NOT NULL" for h in range(1, 21))}),
hic AS (SELECT horizon, trade_date, {O.corr("fr", "yr")} AS rank_ic, count(*) AS n_stocks FROM (SELECT horizon, trade_date, {O.avg_rank("f", "horizon, trade_date")} AS fr, {O.avg_rank("y", "horizon, trade_date")} AS yr FROM hz) GROUP BY horizon, trade_date HAVING count(*) >= 10),
ric AS (SELECT trade_date, rank_ic, n_stocks FROM hic WHERE horizon = 5),
decay AS (SELECT horizon, avg(rank_ic) AS mean_ic, stddev_pop(rank_ic) AS std_ic FROM hic GROUP BY horizon),
{O.DAILY_Q.strip().replace("FROM u GROUP BY", "FROM u WHERE quantile IS NOT NULL GROUP BY")},
qs AS ({QSUM}),
ls0 AS (SELECT trade_date, q5 - q1 AS spread, row_number() OVER (ORDER BY trade_date) - 1 AS i FROM qw),
ls AS (SELECT trade_date, spread, product(CASE WHEN i % 5 = 0 THEN 1 + coalesce(spread, 0) ELSE 1 END) OVER (ORDER BY trade_date {_RUN}) - 1 AS cum_spread FROM ls0),
lsd AS (SELECT *, (1 + cum_spread) / max(1 + cum_spread) OVER (ORDER BY trade_date {_RUN}) - 1 AS dd FROM ls),
g0 AS (SELECT trade_date, regr_slope(y, f) AS factor_return, {O.corr("f", "y")} AS r, count(*) AS n_stocks FROM u WHERE f IS NOT NULL GROUP BY trade_date HAVING count(*) >= 10),
g1 AS (SELECT factor_return, r * sqrt((n_stocks - 2) / (1 - r * r)) AS t_value FROM g0),
a0 AS (SELECT trade_date, ts_code, f, dense_rank() OVER (ORDER BY trade_date) AS d FROM u),
a1 AS (SELECT a.trade_date, l.lag, a.f, b.f AS p FROM a0 a, (SELECT unnest(range(1, 6)) AS lag) l, a0 b WHERE b.ts_code = a.ts_code AND b.d = a.d - l.lag AND a.f IS NOT NULL AND b.f IS NOT NULL),
a2 AS (SELECT trade_date, lag, {O.avg_rank("f", "trade_date, lag")} AS x, {O.avg_rank("p", "trade_date, lag")} AS z FROM a1),
ac AS (SELECT lag, avg(c) AS mean_autocorr FROM (SELECT lag, trade_date, {O.corr("x", "z")} AS c FROM a2 GROUP BY trade_date, lag HAVING count(*) >= 10) GROUP BY lag),
v0 AS (SELECT *, dense_rank() OVER (ORDER BY trade_date) AS d FROM z3 WHERE quantile IS NOT NULL AND trade_date IN (SELECT trade_date FROM u WHERE quantile IS NOT NULL)),
v1 AS (SELECT *, coalesce(lag(quantile) OVER w = quantile AND lag(d) OVER w = d - 1, false) AS kept FROM v0 WINDOW w AS (PARTITION BY ts_code ORDER BY d)),
turn AS (SELECT trade_date, quantile, 1 - sum(CASE WHEN kept THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) AS turnover FROM v1 WHERE d > 1 GROUP BY trade_date, quantile),
yr AS (SELECT year(r.trade_date) AS year, count(*) AS n_days, avg(rank_ic) AS mean_ic, avg(CASE WHEN rank_ic > 0 THEN 1.0 ELSE 0.0 END) AS win_rate, avg(q5) AS mean_return_q5, product(coalesce(1 + q5, 1)) - 1 AS cum_return_q5 FROM ric r LEFT JOIN qw USING (trade_date) GROUP BY 1),"""
    + _bt("0.001")
    + """,
geo AS (SELECT count(*) AS n_periods, avg(n_holdings) AS mean_holdings, arg_max(net_equity, trade_date) AS net_equity, stddev_samp(net_return) * sqrt(50.4) AS vol, min(drawdown) AS max_drawdown, avg(turnover) AS mean_turnover, avg(cost) AS mean_cost FROM bt),
geo2 AS (SELECT *, CASE WHEN net_equity > 0 THEN pow(net_equity, 50.4 / n_periods) - 1 END AS annual_return FROM geo)"""
)
_FRAMES = " UNION ALL ".join(
    (
        _melt("sample", "''", "(SELECT count(DISTINCT ts_code) AS n_stocks, count(DISTINCT trade_date) AS n_dates, count(*) AS n_valid_rows FROM u)", "n_stocks; n_dates; n_valid_rows"),
        _melt("distribution", "version", "dist", "count=n; mean; std; skew; p01; p99"),
        _melt("ic", "trade_date", "ric", "rank_ic; n_stocks"),
        _melt("ic_summary", "''", f"(SELECT avg(rank_ic) AS mean, stddev_pop(rank_ic) AS std, avg(rank_ic) / nullif(stddev_pop(rank_ic), 0) AS ir, {O.t_stat('rank_ic')} AS t_stat, avg(CASE WHEN rank_ic > 0 THEN 1.0 ELSE 0.0 END) AS win_rate, count(*) AS n_days FROM ric)", "mean; std; ir; t_stat; win_rate; n_days"),
        _melt("ic_decay", "horizon", "decay", "mean_ic; std_ic; ic_ir=mean_ic / nullif(std_ic, 0)"),
        _melt("half_life", "''", "(SELECT min(horizon) FILTER (abs(mean_ic) < (SELECT abs(mean_ic) / 2 FROM decay WHERE horizon = 1)) AS half_life FROM decay)", "half_life"),
        _melt("monthly_ic", "k", "(SELECT strftime(trade_date, '%Y-%m') AS k, avg(rank_ic) AS mean_ic FROM ric GROUP BY 1)", "mean_ic"),
        _melt("quantile_daily", "trade_date || ' ' || quantile", "qd", "avg_return"),
        _melt("quantile_summary", "quantile", "qs", "mean_return; std_return; count; hit_rate"),
        _melt("is_monotonic", "''", "(SELECT CASE WHEN min(d) >= 0 THEN 1 WHEN max(d) <= 0 THEN 0 END AS m FROM (SELECT mean_return - lag(mean_return) OVER (ORDER BY quantile) AS d FROM qs))", "is_monotonic=m"),
        _melt("yearly_perf", "year", "yr", "n_days; mean_ic; win_rate; mean_return_q5; cum_return_q5"),
        _melt("long_short", "trade_date", "ls", "spread; cum_spread"),
        _melt("long_short_metrics", "''", "(SELECT avg(spread) * 252 AS ar, stddev_samp(spread) * sqrt(252.0) AS av, min(dd) AS md FROM lsd)", "sharpe=ar / av; calmar=CASE WHEN md < 0 THEN ar / abs(md) END; annual_return=ar; annual_vol=av; max_dd=md"),
        _melt("regression_summary", "''", f"(SELECT count(*) AS n_periods, avg(factor_return) AS m, {O.t_stat('factor_return')} AS t, avg(abs(t_value)) AS a, avg(CASE WHEN abs(t_value) > 2 THEN 1.0 ELSE 0.0 END) AS p FROM g1)", "n_periods; mean_factor_return=m; return_t_stat=t; mean_abs_t=a; pct_abs_t_gt_2=p"),
        _melt("autocorr", "lag", "ac", "mean_autocorr"),
        _melt("turnover", "q", "(SELECT coalesce(CAST(quantile AS VARCHAR), '') AS q, avg(turnover) AS t FROM turn GROUP BY GROUPING SETS ((quantile), ()))", "avg_turnover=t"),
        _melt("backtest", "trade_date", "bt", "n_holdings; gross_return; turnover; cost; net_return; net_equity; drawdown"),
        _melt("backtest_summary", "''", "geo2", "n_periods; mean_holdings; net_equity; annual_return; annual_volatility=vol; sharpe=CASE WHEN vol > 0 THEN annual_return / vol END; calmar=CASE WHEN max_drawdown < 0 THEN annual_return / abs(max_drawdown) END; max_drawdown; mean_turnover; mean_cost"),
    )
)


@query("g35_legacy_evaluation", _OLD, _FRAMES, "value")
def _(spark, sf):
    d = sample.forward_returns(sample.legacy_panel(frames.panel(spark, sf)), HORIZONS, tradable=None)
    d = sample.legacy_universe(d.withColumn("mom", factors.momentum(5)), "mom", "forward_5d", 6)
    return legacy.evaluation(d.withColumn("trade_date", F.to_date("trade_date", "yyyyMMdd")), "mom", HORIZONS)


@query("g35_legacy_raw_ic", LEGACY + f""",
lq0 AS (SELECT CAST(strptime(trade_date, '%Y%m%d') AS DATE) AS trade_date, ts_code, round(mom, 6) AS f, forward_5d AS y FROM lu WHERE universe),
lric AS (SELECT trade_date, {O.corr('fr', 'yr')} AS rank_ic FROM (SELECT trade_date, {O.avg_rank('f', 'trade_date')} AS fr, {O.avg_rank('y', 'trade_date')} AS yr FROM lq0) GROUP BY trade_date HAVING count(*) >= 10)""", "SELECT avg(rank_ic) AS mean_ic, stddev_pop(rank_ic) AS std_ic, count(*) AS n_days FROM lric", "mean_ic std_ic")
def _(spark, sf):
    d = _legacy(spark, sf).filter("universe").select(F.to_date("trade_date", "yyyyMMdd").alias("trade_date"), "ts_code", F.round("mom", 6).alias(FACTOR), F.col("forward_5d").alias(LABEL))
    return evaluate.ic_stats(evaluate.rank_ic(d, FACTOR, LABEL)).select(F.col("mean").alias("mean_ic"), F.col("std").alias("std_ic"), "n_days")


_CARD = {
    "mean_ic": ("g07_ic_stats", "mean", "> 0", "Weak"),
    "ic_ir": ("g07_ic_stats", "ir", None, None),
    "ic_win_rate": ("g07_ic_stats", "win_rate", "> 0.5", "Weak"),
    "pct_abs_t_gt_2": ("g30_regression_summary", "pct_abs_t_gt_2", "> 0.3", "Weak"),
    "mean_spread": ("g14_annualized_long_short", "mean_return", "> 0", "Weak"),
    "cum_spread": ("g14_annualized_long_short", "cum_return", "> 0", "Weak"),
    "ls_sharpe": ("g14_annualized_long_short", "sharpe", "> 0.5", "Review"),
    "mean_turnover": ("g18_turnover_summary", "mean_turnover", None, None),
}


def _judged(metric: str) -> str:
    """One line of the scorecard over the SQL of the query that its number comes from."""
    name, column, good, bad = _CARD[metric]
    verdict = f"CASE WHEN {column} {good} THEN 'Pass' ELSE '{bad}' END" if good else "'-'"
    return f"SELECT '{metric}' AS metric, CAST({column} AS DOUBLE) AS value, {verdict} AS judgement FROM ({SQL[name]})"


@query("g37_scorecard", "", " UNION ALL ".join(_judged(m) for m in _CARD), "value")
def _(spark, sf):
    u = store.stored(frames.usable(spark, sf))
    ic = evaluate.ic_stats(evaluate.rank_ic(u, FACTOR, LABEL)).select(F.col("mean").alias("mean_ic"), F.col("ir").alias("ic_ir"), F.col("win_rate").alias("ic_win_rate"))
    ls = evaluate.annualized(evaluate.long_short(evaluate.wide(evaluate.quantile_daily(u, LABEL))), "spread", 1 + F.col("cum_spread")).select(F.col("mean_return").alias("mean_spread"), F.col("cum_return").alias("cum_spread"), F.col("sharpe").alias("ls_sharpe"))
    rg = evaluate.regression_summary(evaluate.regression_t(u, FACTOR, LABEL)).select("pct_abs_t_gt_2")
    tn = evaluate.turnover_summary(evaluate.turnover(u)).select("mean_turnover")
    one = [d.withColumn("_k", F.lit(1)) for d in (ic, ls, rg, tn)]
    return compare.scorecard(reduce(lambda a, b: a.join(b, "_k"), one))


def _noise(spark, sf, repeats=3, names=("*",)):
    rows = frames.factor_rows(spark, sf).filter(F.col(FACTOR).isNotNull()).select(*names)
    return compare.noise_factors(rows, FACTOR, repeats)


NOISE = BASE + "," + B.noise("rows0")


@query(
    "a23_factor_library",
    B.factors({"registered": B.REGISTERED}) + "," + B.batch("long0", ["factor_id"]),
    "SELECT factor_id, 'second' AS run_id, rank_ic_mean, mean_turnover, monotonicity, n_samples FROM metrics WHERE factor_id <> 'reversal_5d_v1' UNION ALL SELECT factor_id, 'first', rank_ic_mean - 1, mean_turnover, monotonicity, n_samples FROM metrics WHERE factor_id = 'reversal_5d_v1'",
    "rank_ic_mean mean_turnover",
)
def _(spark, sf):
    m = store.stored(evaluate_batch(_batch(spark, sf), ["factor_id"]).select("factor_id", "rank_ic_mean", "mean_turnover", "monotonicity", "n_samples"))
    first = m.withColumn("rank_ic_mean", F.col("rank_ic_mean") - 1).withColumn("run_id", F.lit("first")).withColumn("evaluated_at", F.lit("2024-01-01 00:00:00"))
    second = m.filter("factor_id <> 'reversal_5d_v1'").withColumn("run_id", F.lit("second")).withColumn("evaluated_at", F.lit("2024-02-01 00:00:00"))
    return store.library(first.unionByName(second)).drop("evaluated_at")


@query(
    "a17_years_back",
    P,
    "SELECT strftime(d - INTERVAL 3 YEAR, '%Y%m%d') AS start, strftime(d, '%Y%m%d') AS \"end\", (SELECT count(*) FROM panel WHERE day BETWEEN d - INTERVAL 3 YEAR AND d) AS n_rows FROM (SELECT max(day) AS d FROM panel)",
)
def _(spark, sf):
    t = frames.panel_store(spark, sf)
    start, end = store.years_back(t.read().agg(F.max("trade_date")).first()[0], 3)
    return t.read(start, end).agg(F.lit(start).alias("start"), F.lit(end).alias("end"), F.count("*").alias("n_rows"))


@query("i01_noise_factors", NOISE, "SELECT baseline_name, run_id, trade_date, ts_code, f FROM nn", "f")
def _(spark, sf):
    return _noise(spark, sf).select("baseline_name", "run_id", "trade_date", "ts_code", FACTOR)


@query("i02_noise_metrics", NOISE + "," + B.batch("nn", ["baseline_name", "run_id"]), "SELECT baseline_name, run_id, rank_ic_mean, top_return AS top_quantile_return, sharpe AS top_quantile_sharpe, max_drawdown, mean_turnover, oos_rank_ic AS oos_rank_ic_mean FROM metrics", "rank_ic_mean top_quantile_return top_quantile_sharpe max_drawdown mean_turnover oos_rank_ic_mean")
def _(spark, sf):
    m = evaluate_batch(_noise(spark, sf, names=("trade_date", "ts_code", FACTOR, LABEL)), ["baseline_name", "run_id"])
    return m.select("baseline_name", "run_id", "rank_ic_mean", F.col("top_return").alias("top_quantile_return"), F.col("sharpe").alias("top_quantile_sharpe"), "max_drawdown", "mean_turnover", F.col("oos_rank_ic").alias("oos_rank_ic_mean"))


@query(
    "i03_comparison",
    P + ", b AS (SELECT ts_code, avg(pct_chg) AS rank_ic_mean, min(pct_chg) AS max_drawdown, avg(turnover_rate) AS mean_turnover, CASE WHEN ts_code < '300050' THEN 'noise' ELSE 'simple_technical' END AS grp FROM panel GROUP BY ts_code), l AS (SELECT grp, 'rank_ic_mean' AS metric, rank_ic_mean AS b, 10.0 AS c, 1 AS s FROM b UNION ALL SELECT grp, 'max_drawdown', max_drawdown, -30.0, 1 FROM b UNION ALL SELECT grp, 'mean_turnover', mean_turnover, 1.0, -1 FROM b)",
    'SELECT grp AS "group", metric, max(c) AS candidate, median(b) AS baseline_median, avg(CASE WHEN b * s <= c * s THEN 1.0 ELSE 0.0 END) AS percentile FROM l GROUP BY ALL',
    "candidate baseline_median percentile",
)
def _(spark, sf):
    p = frames.panel(spark, sf)
    b = p.groupBy("ts_code").agg(F.avg("pct_chg").alias("rank_ic_mean"), F.min("pct_chg").alias("max_drawdown"), F.avg("turnover_rate").alias("mean_turnover")).withColumn("group", F.when(F.col("ts_code") < "300050", "noise").otherwise("simple_technical"))
    c = spark.range(1).select(F.lit(10.0).alias("rank_ic_mean"), F.lit(-30.0).alias("max_drawdown"), F.lit(1.0).alias("mean_turnover"))
    return compare.compare(c, b, ["rank_ic_mean", "max_drawdown", "mean_turnover"])


def _metrics_of_long(s: DataFrame, repeats: int) -> DataFrame:
    """The metrics of ``_compared`` from one long frame, for dates of any size."""
    own = s.select("trade_date", "ts_code", "day", "total_mv", "sw_l1_name", F.col("forward_5d").alias(LABEL))
    registered = factors.run_registry(s).withColumn("group", F.lit("candidate"))
    signs = F.create_map(*[F.lit(x) for k, (_, d) in factors.TECHNICAL.items() for x in (k, factors.DIRECTIONS[d])])
    technical = factors.compute(s, {k: f() for k, (f, _) in factors.TECHNICAL.items()}).withColumn("direction", signs[F.col("factor_id")]).withColumn("group", F.lit("simple_technical"))
    long = registered.unionByName(technical).join(own, ["trade_date", "ts_code"])
    p = preprocess.preprocess(long, "factor_value", ["group", "factor_id", "day"])
    p = store.stored(p.select("group", "factor_id", F.lit(0).alias("run_id"), F.col("day").alias("trade_date"), "ts_code", F.round(F.col("factor_processed") * F.col("direction"), 6).alias(FACTOR), LABEL))
    noise = None
    for k, name in enumerate(compare.NOISE):
        one = compare.noise_factors(p.filter("group = 'candidate'").filter(F.col(FACTOR).isNotNull()).drop("run_id"), FACTOR, repeats, names=[name], keys=["factor_id"])
        one = one.withColumn("group", F.lit("noise")).withColumn("run_id", F.col("run_id") + 100 * k).drop("baseline_name")
        noise = one if noise is None else noise.unionByName(one)
    return evaluate_batch(p.unionByName(noise), ["group", "factor_id", "run_id"])


def _metrics_of_dates(s: DataFrame, repeats: int, rows: int) -> DataFrame:
    """The metrics of ``_compared`` for samples whose dates fit a task each, a column for each factor."""
    factors.validate(factors.REGISTRY, s.columns)
    own = {("candidate", x.factor_id): (c, x.direction) for x, c in zip(factors.REGISTRY, factors.registered().values(), strict=True)}
    own |= {("simple_technical", k): (f(), d) for k, (f, d) in factors.TECHNICAL.items()}
    made = {str(c): c for c, _ in own.values()}  # what is both registered and technical is computed once
    at = {x: f"v{i}" for i, x in enumerate(made)}
    signals = {(g, k, 0): by_date.Signal(at[str(c)], factors.DIRECTIONS[d]) for (g, k), (c, d) in own.items()}
    for x in factors.REGISTRY:
        of = signals["candidate", x.factor_id, 0]
        signals |= {("noise", x.factor_id, run + 100 * k): by_date.Signal(of.column, of.sign, name, run) for k, name in enumerate(compare.NOISE) for run in range(repeats)}
    names = [dict(zip(("group", "factor_id", "run_id"), x, strict=True)) for x in signals]
    signals = list(signals.values())
    wide = s.withColumn("ret_1", factors.returns()).select("day", "ts_code", "total_mv", "sw_l1_name", F.col("forward_5d").alias(LABEL), *[c.alias(at[x]) for x, c in made.items()])
    facts = store.stored(by_date.date_facts(wide, signals, LABEL, rows))
    ic, fd = (store.stored(x) for x in by_date.series(facts))
    turn = by_date.turnover(fd, by_date.kept_names(facts, len(signals), rows))
    return by_date.frame_of(names, _metrics(by_date.coverage(facts), ic, fd.drop("n"), turn, ["k"]))


def _compared(spark, sf, repeats=3):
    """(metrics of the registered factors, their comparison with noise runs of their own and the technical baselines), from one batch."""
    s = frames.research_sample(spark, sf, apart=True)
    size = frames.panel(spark, sf).groupBy("trade_date").agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    m = store.stored(_metrics_of_long(s, repeats) if (size.most or 0) > order.ONE_TASK else _metrics_of_dates(s, repeats, size.rows or 0))
    named = m.select("*", F.col("top_return").alias("top_quantile_return"), F.col("sharpe").alias("top_quantile_sharpe"), F.col("oos_rank_ic").alias("oos_rank_ic_mean"))
    of = [x.factor_id for x in factors.REGISTRY]
    simple = named.filter("group = 'simple_technical'").withColumn("factor_id", F.explode(F.array(*[F.lit(x) for x in of])))
    candidate = named.filter("group = 'candidate'").drop("group", "run_id")
    return candidate, compare.compare(candidate, named.filter("group = 'noise'").unionByName(simple), keys=["factor_id"])


@query("i03_evaluated_comparison", B.compared(), "SELECT * FROM compared", "candidate baseline_median percentile")
def _(spark, sf):
    return _compared(spark, sf)[1]


@query("i04_gate", B.gate(), "SELECT * FROM gated")
def _(spark, sf):
    candidate, compared = _compared(spark, sf)
    m = candidate.join(compare.comparison_flags(compared, ["factor_id"]), "factor_id", "left")
    return compare.gate(m).select("factor_id", "status", F.array_join("reasons", "; ").alias("reasons"), "stronger_than_noise", "not_worse_than_simple")


# --- J: radar -------------------------------------------------------------------------------------

BREADTH = P + """,
b0 AS (SELECT trade_date, count(*) FILTER (NOT is_suspended) AS stock_count, avg(pct_chg) FILTER (NOT is_suspended) AS average_return, median(pct_chg) FILTER (NOT is_suspended) AS median_return, stddev_pop(pct_chg) FILTER (NOT is_suspended) AS return_std,
    count(*) FILTER (NOT is_suspended AND pct_chg > 0) AS up_count, count(*) FILTER (NOT is_suspended AND pct_chg < 0) AS down_count, count(*) FILTER (NOT is_suspended AND close >= up_limit) AS up_limit_count, count(*) FILTER (NOT is_suspended AND close <= down_limit) AS down_limit_count,
    coalesce(sum(amount) FILTER (NOT is_suspended), 0) AS amount_total, sum(amount) AS total FROM panel GROUP BY trade_date),
br AS (SELECT * EXCLUDE (total), up_count / CAST(greatest(up_count + down_count, 1) AS DOUBLE) AS breadth_ratio, amount_total / avg(total) OVER (ORDER BY trade_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS amount_ratio_5d FROM b0)"""
BR_COLS = "average_return median_return return_std amount_total breadth_ratio amount_ratio_5d"


@query("j01_breadth", BREADTH, "SELECT * FROM br WHERE stock_count > 0", BR_COLS)
def _(spark, sf):
    return radar.breadth(frames.panel(spark, sf), most=frames.FEW)


def _bands(x: str, bands) -> str:
    above, below = bands
    return f"CASE WHEN {x} IS NULL THEN 0 " + " ".join(f"WHEN {x} >= {b} THEN {p}" for b, p in above) + " " + " ".join(f"WHEN {x} <= {b} THEN {p}" for b, p in below) + " ELSE 0 END"


@query(
    "j02_temperature",
    BREADTH,
    "SELECT trade_date, CAST(score AS INTEGER) AS score, CASE WHEN score >= 65 THEN 'risk_on' WHEN score <= 35 THEN 'risk_off' ELSE 'neutral' END AS state FROM (SELECT trade_date, greatest(0, least(100, 50 + "
    + " + ".join(_bands(x, b) for x, b in (("average_return", radar.RETURN_BANDS), ("amount_ratio_5d", radar.AMOUNT_BANDS), ("breadth_ratio", radar.BREADTH_BANDS), ("(up_limit_count - down_limit_count)", radar.LIMIT_BANDS), ("return_std", radar.SPREAD_BANDS)))
    + ")) AS score FROM br WHERE stock_count > 0)",
)
def _(spark, sf):
    return radar.temperature(radar.breadth(frames.panel(spark, sf))).select("trade_date", "score", "state")


STYLE = P + ", sl AS (" + " UNION ALL ".join(f"SELECT trade_date, ts_code, pct_chg, '{s}' AS factor_name, {f} AS x, {f if side == 'low' else '-' + f} AS o, '{t}' AS top, '{b}' AS bottom FROM panel WHERE NOT is_suspended AND {f} IS NOT NULL AND pct_chg IS NOT NULL" for s, f, side, t, b in radar.STYLES) + """),
sr AS (SELECT *, row_number() OVER (PARTITION BY trade_date, factor_name ORDER BY o, ts_code) AS i, count(*) OVER (PARTITION BY trade_date, factor_name) AS n FROM sl),
sz AS (SELECT *, greatest(CAST(floor(n * 0.2) AS BIGINT), 1) AS z FROM sr),
sb AS (SELECT *, top AS bucket_name FROM sz WHERE i <= z UNION ALL SELECT *, bottom FROM sz WHERE i > n - z)"""


@query("j03_style_buckets", STYLE, "SELECT trade_date, factor_name, bucket_name, avg(pct_chg) AS mean_return, median(pct_chg) AS median_return, count(*) AS stock_count FROM sb GROUP BY ALL", "mean_return median_return")
def _(spark, sf):
    return radar.style_buckets(frames.panel(spark, sf), most=frames.FEW).drop("place")


INDUSTRY = P + """,
i0 AS (SELECT trade_date, sw_l1_name, avg(pct_chg) AS mean_return, median(pct_chg) AS median_return, sum(amount) AS total_amount, count(ts_code) AS stock_count, avg(CASE WHEN pct_chg > 0 THEN 1.0 ELSE 0.0 END) AS advancer_ratio FROM panel WHERE NOT is_suspended AND sw_l1_name IS NOT NULL GROUP BY ALL),
i1 AS (SELECT trade_date, sw_l1_name, a / avg(a) OVER (PARTITION BY sw_l1_name ORDER BY trade_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS amount_ratio_5d FROM (SELECT trade_date, sw_l1_name, sum(amount) AS a FROM panel WHERE sw_l1_name IS NOT NULL GROUP BY ALL)),
ind AS (SELECT i0.*, round(amount_ratio_5d, 9) AS amount_ratio_5d FROM i0 LEFT JOIN i1 USING (trade_date, sw_l1_name))"""
IND_COLS = "mean_return median_return total_amount advancer_ratio amount_ratio_5d"


def _strength(spark, sf):
    return radar.industry_strength(frames.panel(spark, sf)).withColumn("amount_ratio_5d", F.round("amount_ratio_5d", 9))


@query("j04_industry_strength", INDUSTRY, "SELECT * FROM ind", IND_COLS)
def _(spark, sf):
    return _strength(spark, sf)


@query("j06_industry_leaders", INDUSTRY, "SELECT trade_date, 'top' AS list, CAST(row_number() OVER (PARTITION BY trade_date ORDER BY mean_return DESC, total_amount DESC, sw_l1_name) AS INTEGER) AS place, sw_l1_name, mean_return FROM ind QUALIFY place <= 2 UNION ALL SELECT trade_date, 'bottom', CAST(row_number() OVER (PARTITION BY trade_date ORDER BY mean_return, total_amount DESC, sw_l1_name) AS INTEGER) AS place, sw_l1_name, mean_return FROM ind QUALIFY place <= 2 UNION ALL SELECT trade_date, 'volume', CAST(row_number() OVER (PARTITION BY trade_date ORDER BY amount_ratio_5d DESC NULLS LAST, total_amount DESC, sw_l1_name) AS INTEGER) AS place, sw_l1_name, mean_return FROM ind QUALIFY place <= 2", "mean_return")
def _(spark, sf):
    return radar.industry_leaders(_strength(spark, sf), n=2).select("trade_date", "list", "place", "sw_l1_name", "mean_return")


@query("j07_industry_breadth", INDUSTRY, "SELECT trade_date, count(*) AS industry_count, avg(CASE WHEN mean_return > 0 THEN 1.0 ELSE 0.0 END) AS positive_ratio, avg(CASE WHEN mean_return < 0 THEN 1.0 ELSE 0.0 END) AS negative_ratio, median(mean_return) AS median_return FROM ind GROUP BY trade_date", "positive_ratio negative_ratio median_return")
def _(spark, sf):
    return radar.industry_breadth(_strength(spark, sf))


# --- K: news --------------------------------------------------------------------------------------

WORDS = {"thble": 2.5, "thtion": 1.8, "thing": 2.0, "attion": 1.5, "erble": 1.3, "nicht": 1.2}
RULES = {"macro": ["nicht", "attion"], "technology": ["thble"], "sectors": ["erble"]}
CATEGORY = {"macro": 1.6, "technology": 1.4, "sectors": 1.2}
SOURCES = {"src1": 1.1, "src2": 1.2}


def _news(spark, sf):
    d = adapters.table(spark, sf, "documents")
    title = F.substring_index(F.coalesce("text", F.lit("")), "\n", 1)
    return d.select("doc_id", title.alias("title"), F.col("text").alias("content"), "source", F.array("lang").alias("tags"))


_EDGE = "E' -:：,，。；;'"
NEWS = f"""
n0 AS (SELECT doc_id, split_part(coalesce(text, ''), chr(10), 1) AS t, text, source, lang FROM documents),
n1 AS (SELECT doc_id, trim(regexp_replace(t, '\\s+', ' ', 'g'), {_EDGE}) AS title, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'), {_EDGE}) AS content, lower(source) AS source, lower(lang) AS tag FROM n0),
clean AS (SELECT * FROM n1 WHERE title <> ''),
ded AS (SELECT * FROM clean QUALIFY row_number() OVER (PARTITION BY lower(title), source ORDER BY doc_id) = 1),
hay AS (SELECT *, lower(concat_ws(' ', title, content, tag)) AS h FROM ded),
rel AS (SELECT *, {" || ".join(f"(CASE WHEN contains(h, '{k}') THEN ['{k}'] ELSE [] END)" for k in WORDS)} AS matched FROM hay),
cat AS (SELECT *, CASE WHEN contains(h, 'nicht') OR contains(h, 'attion') THEN 'macro' WHEN contains(h, 'thble') THEN 'technology' WHEN contains(h, 'erble') THEN 'sectors' ELSE 'other' END AS category, CASE source WHEN 'src1' THEN 1.1 WHEN 'src2' THEN 1.2 ELSE 1.0 END AS source_weight FROM rel WHERE len(matched) > 0)"""


@query("k01_clean", NEWS, "SELECT doc_id, title, source, length(content) AS n FROM clean")
def _(spark, sf):
    return news.clean(_news(spark, sf)).select("doc_id", "title", "source", F.length("content").cast("long").alias("n"))


@query("k02_dedup", NEWS, "SELECT doc_id, title, source FROM ded")
def _(spark, sf):
    return news.dedup(news.clean(_news(spark, sf)), "doc_id").select("doc_id", "title", "source")


def _relevant(spark, sf):
    return news.relevant(news.dedup(news.clean(_news(spark, sf)), "doc_id"), list(WORDS))


@query("k03_relevant", NEWS, "SELECT doc_id, array_to_string(matched, ',') AS matched FROM rel WHERE len(matched) > 0")
def _(spark, sf):
    return _relevant(spark, sf).select("doc_id", F.array_join("matched_keywords", ",").alias("matched"))


@query(
    "k03_many_keywords",
    NEWS + ", kw AS (SELECT DISTINCT lower(w) AS w FROM (SELECT unnest(regexp_split_to_array(coalesce(text, ''), '[\\x09-\\x0D\\x20]+')) AS w FROM benchmark) WHERE w <> '')",
    "SELECT doc_id, count(*) AS n_keywords, min(w) AS least, max(w) AS greatest FROM hay JOIN kw ON contains(h, w) GROUP BY doc_id",
)
def _(spark, sf):
    words = F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), "[\\x09-\\x0D\\x20]+"))
    keywords = [r[0] for r in adapters.table(spark, sf, "benchmark").select(words.alias("w")).filter("w <> ''").distinct().collect()]  # the list of keywords
    m = news.relevant(news.dedup(news.clean(_news(spark, sf)), "doc_id"), keywords)
    return m.select("doc_id", F.size("matched_keywords").cast("long").alias("n_keywords"), F.array_min("matched_keywords").alias("least"), F.array_max("matched_keywords").alias("greatest"))


@query("k04_categorize", NEWS, "SELECT doc_id, category, CAST(source_weight AS DOUBLE) AS source_weight FROM cat", "source_weight")
def _(spark, sf):
    return news.categorize(_relevant(spark, sf), RULES, SOURCES).select("doc_id", "category", "source_weight")


_SUM = " + ".join(f"CASE WHEN list_contains(matched, '{k}') THEN {v} ELSE 0 END" for k, v in WORDS.items())


@query("k05_rank", NEWS, f"SELECT doc_id, round(CAST(({_SUM}) AS DOUBLE) * CASE category WHEN 'macro' THEN 1.6 WHEN 'technology' THEN 1.4 WHEN 'sectors' THEN 1.2 ELSE 1.0 END * source_weight, 4) AS score FROM cat", "score")
def _(spark, sf):
    return news.rank(news.categorize(_relevant(spark, sf), RULES, SOURCES), WORDS, CATEGORY).select("doc_id", "score")


@query("k06_digest", NEWS, "SELECT (SELECT count(*) FROM documents) AS total_raw, (SELECT count(*) FROM clean) AS total_clean, (SELECT count(*) FROM ded) AS total_deduped, (SELECT count(*) FROM cat) AS total_relevant")
def _(spark, sf):
    return news.digest(_news(spark, sf), list(WORDS), "doc_id")


# --- users by day ---------------------------------------------------------------------------------


@query(
    "u01_user_days",
    "",
    "SELECT ts_code, trade_date, floor(sum(v) / 10000.0 / sum(n) * 10000.0 + 0.5) / 10000.0 AS close, sum(v) / 10000.0 AS amount, CAST(sum(n) AS BIGINT) AS vol, first(event_type ORDER BY n DESC, event_type) AS sw_l1_name FROM (SELECT user_id AS ts_code, CAST(ts AS DATE) AS trade_date, event_type, count(*) AS n, sum(CAST(floor(value * 10000 + 0.5) AS BIGINT)) AS v FROM events GROUP BY ALL) GROUP BY ts_code, trade_date",
    "close amount",
)
def _(spark, sf):
    return adapters.user_days(spark, sf)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank IC by date of five-period momentum, on small data with a low bar for the cross-section."""
    s, _ = sample.build_sample(frames.panel(spark, sf_dir), sample.SampleConfig(require_main_board=False, exclude_st=False, min_cross_section=5, horizons=(1,)))
    u = s.withColumn("m5", factors.momentum(5))
    return evaluate.rank_ic(u, "m5", "forward_1d", least=5)

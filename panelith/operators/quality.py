"""Data-quality checks.  Each gives one row: check_name, status (PASS, WARN, FAIL), n_bad, detail; details list at most 20 items."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import ratio
from ..sources.store import stored
from .order import BROADCAST_ROWS
from .panel import KEY, in_range

ENDPOINTS = ("daily", "adj_factor", "daily_basic", "suspend_d", "stk_limit")
#: The fields whose missing rate is checked, by table, and the thresholds.
KEY_FIELDS = {"daily": ("open", "close", "pct_chg", "amount"), "daily_basic": ("turnover_rate", "total_mv"), "daily_panel": ("adj_factor", "sw_l1_name")}
#: The tables and fields of the whole report; a table is checked for those of the fields that it has.
REPORT_TABLES = ("daily", "daily_basic", "daily_panel")
REPORT_FIELDS = ("open", "high", "low", "close", "amount", "adj_factor", "turnover_rate", "total_mv")
MISSING_WARN, MATCH_BEFORE, MATCH_SINCE, MATCH_SPLIT = 0.05, 0.90, 0.95, "20170101"


def _result(df: DataFrame, name: str, bad: Column, status: str, detail: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), F.when(bad > 0, status).otherwise("PASS").alias("status"), bad.cast("long").alias("n_bad"), detail.alias("detail"))


def _listed(c: str) -> Column:
    return F.array_join(F.slice(F.array_sort(F.collect_list(c)), 1, 20), ",")


def expected_dates(calendar: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Open dates of the range."""
    return in_range(calendar.filter("is_open = '1'").select(F.col("cal_date").alias("trade_date")), start, end).distinct()


def ingest_status(log: DataFrame, expected: DataFrame, endpoints: Sequence[str] = ENDPOINTS) -> DataFrame:
    """By endpoint: success_dates, failed_count (all dates), missing_count (expected dates without success), status."""
    ends = log.sparkSession.createDataFrame([(e,) for e in endpoints], "endpoint string")
    seen = log.groupBy("endpoint").agg(F.countDistinct(F.when(F.col("status") == "success", F.col("trade_date"))).alias("success_dates"), F.count(F.when(F.col("status") == "failed", 1)).alias("failed_count"))
    due = expected.select("trade_date", F.explode(F.array(*[F.lit(e) for e in endpoints])).alias("endpoint"))
    missing = due.join(log.filter("status = 'success'").select("endpoint", "trade_date").distinct(), ["endpoint", "trade_date"], "left_anti").groupBy("endpoint").agg(F.count("*").alias("missing_count"))
    out = ends.join(seen, "endpoint", "left").join(missing, "endpoint", "left").fillna(0)
    return out.withColumn("status", F.when((F.col("failed_count") > 0) | (F.col("missing_count") > 0), "WARN").otherwise("PASS"))


def duplicate_keys(df: DataFrame, table: str) -> DataFrame:
    groups = df.groupBy(*KEY).count().filter("count > 1")
    return _result(groups.agg(F.count("*").alias("n")), f"duplicate_keys:{table}", F.col("n"), "FAIL", F.lit(""))


def date_coverage(df: DataFrame, expected: DataFrame, table: str) -> DataFrame:
    """Bounds and number of dates, expected ones that lack; FAIL if any lacks."""
    have = df.agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"), F.countDistinct("trade_date").alias("n"))
    lack = expected.join(df.select("trade_date").distinct(), "trade_date", "left_anti").agg(F.count("*").alias("bad"), _listed("trade_date").alias("dates"))
    both = have.withColumn("k", F.lit(1)).join(lack.withColumn("k", F.lit(1)), "k")
    return _result(both, f"date_coverage:{table}", F.col("bad"), "FAIL", F.concat_ws(" ", "lo", "hi", F.col("n").cast("string"), "dates"))


def missing_rates(tables: dict[str, DataFrame], fields: dict[str, Sequence[str]] = KEY_FIELDS, warn: float = MISSING_WARN) -> DataFrame:
    """table, field, n_rows, missing_rate, status: one pass over each table; empty tables are left out."""
    parts = []
    for name, df in tables.items():
        names = list(fields.get(name, ()))
        wide = df.agg(F.count("*").alias("n_rows"), *[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in names])
        parts.append(wide.unpivot("n_rows", names, "field", "missing_rate").withColumn("table_name", F.lit(name)))
    out = reduce(DataFrame.unionByName, parts).filter("n_rows > 0")
    return out.select("table_name", "field", "n_rows", "missing_rate", F.when(F.col("missing_rate") > warn, "WARN").otherwise("PASS").alias("status"))


def ohlc_errors(df: DataFrame) -> DataFrame:
    """Rows with a missing price, high below low, or open or close outside [low, high]."""
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    return df.filter(o.isNull() | h.isNull() | lo.isNull() | c.isNull() | (h < lo) | (o < lo) | (o > h) | (c < lo) | (c > h))


def ohlc_sanity(df: DataFrame, table: str = "daily") -> DataFrame:
    return _result(ohlc_errors(df).agg(F.count("*").alias("n")), f"ohlc_sanity:{table}", F.col("n"), "FAIL", F.lit(""))


def two_way_coverage(prices: DataFrame, basics: DataFrame, master: DataFrame | None = None) -> DataFrame:
    """Keys of each table that the other lacks, among codes of the master on or after their listing; WARN if any."""

    def only(a: DataFrame, b: DataFrame) -> DataFrame:
        left = a.select(*KEY).distinct().join(b.select(*KEY).distinct(), KEY, "left_anti")
        if master is not None:
            left = left.join(master.select("ts_code", "list_date").distinct(), "ts_code").filter("list_date is null or list_date = '' or trade_date >= list_date")
        return left.agg(F.count("*").alias("n"))

    first = _result(only(prices, basics), "missing_in_daily_basic", F.col("n"), "WARN", F.lit(""))
    return first.unionByName(_result(only(basics, prices), "missing_in_daily", F.col("n"), "WARN", F.lit("")))


def industry_match(panel: DataFrame, start: str | None = None, column: str = "sw_l1_name") -> DataFrame:
    """Share of rows with an industry; the bar is lower for ranges that begin before 2017; no rows count as 0."""
    bar = MATCH_BEFORE if start is not None and start < MATCH_SPLIT else MATCH_SINCE
    r = panel.agg(F.coalesce(F.avg(F.col(column).isNotNull().cast("double")), F.lit(0.0)).alias("rate"), F.count(F.when(F.col(column).isNull(), 1)).alias("bad"))
    return r.select(F.lit("industry_match").alias("check_name"), F.when(F.col("rate") < bar, "WARN").otherwise("PASS").alias("status"), F.col("bad").alias("n_bad"), F.round("rate", 4).cast("string").alias("detail"))


def summary(checks: Sequence[DataFrame]) -> DataFrame:
    """Number of checks by status."""
    return reduce(DataFrame.unionByName, checks).groupBy("status").agg(F.count("*").alias("n_checks"))


# --- the whole report -----------------------------------------------------------------------------


def _facts_by_date(tables: Mapping[str, DataFrame], master: DataFrame | None, start: str | None, end: str | None, industry: str) -> DataFrame:
    """One row a date with everything that the checks count, from one scan of each table and one shuffle by key."""
    prices = "daily_panel" if "daily_panel" in tables else "daily"
    parts, one = [], F.lit(1).cast("long")
    for name in REPORT_TABLES:
        if name not in tables:
            continue
        df = in_range(tables[name], start, end)
        o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
        wrong = o.isNull() | h.isNull() | lo.isNull() | c.isNull() | (h < lo) | (o < lo) | (o > h) | (c < lo) | (c > h)
        facts = {f"n_{name}": one}
        facts |= {f"miss_{name}_{f}": F.col(f).isNull().cast("long") for f in REPORT_FIELDS if f in df.columns}
        if name == prices and {"open", "high", "low", "close"} <= set(df.columns):
            facts["ohlc"] = F.coalesce(wrong, F.lit(False)).cast("long")
        if name == "daily_panel" and industry in df.columns:
            facts["unmatched"] = F.col(industry).isNull().cast("long")
        parts.append(df.select(*KEY, *[v.alias(k) for k, v in facts.items()]))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = [c for c in every.columns if c not in KEY]
    by_key = every.groupBy(*KEY).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    inside = F.lit(True)
    if master is not None:
        listed = master.groupBy("ts_code").agg(F.min(F.coalesce("list_date", F.lit(""))).alias("_listed"))
        small = listed.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        by_key = by_key.join(F.broadcast(listed) if small else listed, "ts_code", "left")
        inside = F.coalesce(F.col("trade_date") >= F.col("_listed"), F.lit(False))
    extra = []
    if {"n_daily", "n_daily_basic"} <= set(names):
        extra = [F.sum(F.when(inside & (F.col(b) == 0), F.col(a)).otherwise(0)).alias(f"only_{a[2:]}") for a, b in (("n_daily", "n_daily_basic"), ("n_daily_basic", "n_daily"))]
    twice = [F.count(F.when(F.col(c) > 1, 1)).alias(f"twice_{c[2:]}") for c in names if c.startswith("n_")]
    return by_key.groupBy("trade_date").agg(*[F.sum(c).alias(c) for c in names], *twice, *extra)


def _numbers(values: Mapping[str, Column]) -> Column:
    return F.concat_ws(",", *[F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in values.items()])


def _added(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


CHECKS = ("ingest_status", "duplicate_keys", "date_coverage", "missing_rates", "ohlc_sanity", "basic_coverage", "industry_match")


def report(
    tables: Mapping[str, DataFrame], log: DataFrame | None = None, expected: DataFrame | None = None, master: DataFrame | None = None, start: str | None = None, end: str | None = None, industry: str = "sw_l1_name"
) -> DataFrame:
    """All seven checks: place, check_name, status, n_bad, detail.

    ``tables`` holds at least one of daily, daily_basic and daily_panel.  Each is scanned once; rows meet once, by key;
    the checks themselves run over a table of one row a date.  A check whose table or columns are missing is a WARN;
    without expected dates nothing can be missing.
    """
    there = [t for t in REPORT_TABLES if t in tables]
    if not there:
        raise ValueError(f"none of the tables to check: {REPORT_TABLES}")
    dates = stored(_facts_by_date(tables, master, start, end, industry))
    zero = F.lit(0).cast("long")
    total = lambda c: F.coalesce(F.sum(c), zero)
    rows = {t: total(f"n_{t}") for t in there}
    graded = lambda bad, status: F.when(bad > 0, status).otherwise("PASS")
    absent = (F.lit("WARN"), zero, F.lit(""))
    found: dict[str, tuple[Column, Column, Column]] = {}

    again = {t: total(f"twice_{t}") for t in there}
    found["duplicate_keys"] = (graded(_added(list(again.values())), "FAIL"), _added(list(again.values())), _numbers(again))
    rates = {f"{t}.{f}": ratio(total(f"miss_{t}_{f}").cast("double"), rows[t]) for t in there for f in REPORT_FIELDS if f"miss_{t}_{f}" in dates.columns}
    over = F.array_compact(F.array(*[F.when(r > MISSING_WARN, F.lit(k)) for k, r in rates.items()], F.lit(None).cast("string")))
    checkable = F.lit(bool(rates)) & (_added(list(rows.values())) > 0)
    found["missing_rates"] = (F.when(checkable & (F.size(over) == 0), "PASS").otherwise("WARN"), F.size(over).cast("long"), F.concat_ws(",", over))
    prices = "daily_panel" if "daily_panel" in tables else "daily"
    found["ohlc_sanity"] = (graded(total("ohlc"), "FAIL"), total("ohlc"), F.lit(prices)) if "ohlc" in dates.columns else absent
    if "only_daily" in dates.columns:
        only = {"daily": total("only_daily"), "daily_basic": total("only_daily_basic")}
        found["basic_coverage"] = (graded(_added(list(only.values())), "WARN"), _added(list(only.values())), _numbers(only))
    else:
        found["basic_coverage"] = absent
    if "unmatched" in dates.columns:
        bar = MATCH_BEFORE if start is not None and start < MATCH_SPLIT else MATCH_SINCE
        matched = rows["daily_panel"] - total("unmatched")
        share = F.coalesce(ratio(matched.cast("double"), rows["daily_panel"]), F.lit(0.0))
        found["industry_match"] = (F.when(share < bar, "WARN").otherwise("PASS"), total("unmatched"), F.concat_ws("/", matched.cast("string"), rows["daily_panel"].cast("string")))
    else:
        found["industry_match"] = absent
    named = lambda name, c: F.struct(F.lit(name).alias("check_name"), c[0].alias("status"), c[1].cast("long").alias("n_bad"), c[2].alias("detail"))
    parts = [dates.agg(F.explode(F.array(*[named(k, c) for k, c in found.items()])).alias("c"))]

    due = expected if expected is not None else dates.select("trade_date").limit(0)
    due = due.select("trade_date").distinct().join(dates.select("trade_date", *[f"n_{t}" for t in there]), "trade_date", "left")
    lack = {t: F.count(F.when(F.coalesce(F.col(f"n_{t}"), zero) == 0, 1)) for t in there}
    parts.append(due.agg(named("date_coverage", (graded(_added(list(lack.values())), "FAIL"), _added(list(lack.values())), _numbers(lack))).alias("c")))
    if log is not None and expected is not None:
        bad = F.count(F.when(F.col("status") == "WARN", 1))
        ends = F.array_join(F.array_sort(F.collect_list(F.when(F.col("status") == "WARN", F.col("endpoint")))), ",")
        parts.append(ingest_status(log, expected).agg(named("ingest_status", (graded(bad, "WARN"), bad, ends)).alias("c")))
    else:
        parts.append(dates.agg(F.count("*")).select(named("ingest_status", absent if log is None else (F.lit("PASS"), zero, F.lit(""))).alias("c")))
    place = F.array_position(F.array(*[F.lit(c) for c in CHECKS]), F.col("check_name")).cast("int").alias("place")
    return reduce(DataFrame.unionByName, parts).select("c.*").select(place, "check_name", "status", "n_bad", "detail")

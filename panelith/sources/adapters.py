"""Panels derived from relational tables: suppliers by month, users by day, and their companion tables.

All sums run over integers (cents, percents), so values do not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import cut

FIRST_YEAR = 1995


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(x: str):
    return F.floor(F.col(x) * 100 + 0.5).cast("long")


def month_index(date: str):
    return (F.year(date) - FIRST_YEAR) * 12 + F.month(date) - 1


def supplier_months(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """The wide panel: one row for each supplier (ts_code) and month (trade_date, text yyyyMMdd; day, a date).

    Lines meet once, dealt by code over ``parts`` tasks (spark.sql.shuffle.partitions, if left out): few lines share a
    code and month, so sums before the shuffle would only sort all lines without making them fewer.  Aggregates, prices
    before and the join with suppliers stay in these tasks; volumes by month are a small table of their own.
    """
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    code = lambda key: F.format_string("3%05d", key).alias("ts_code")
    lines = table(spark, sf_dir, "lineitem")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    who = table(spark, sf_dir, "supplier").join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    li = lines.filter("l_suppkey is not null").select(code("l_suppkey"), "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", _cents("l_discount").alias("discount"), _cents("l_tax").alias("tax"))
    li = li.repartition(parts, "ts_code").withColumn("day", F.trunc("l_shipdate", "MM")).withColumn("unit", F.col("l_extendedprice") / F.col("l_quantity"))
    order = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    g = li.groupBy("ts_code", "day").agg(
        cut(F.min_by("unit", order), 4).alias("open"),
        cut(F.max("unit"), 4).alias("high"),
        cut(F.min("unit"), 4).alias("low"),
        cut(F.sum(_cents("l_extendedprice")) / 100.0 / F.sum(F.col("l_quantity").cast("long")), 4).alias("close"),
        F.sum(F.col("l_quantity").cast("long")).cast("double").alias("vol"),
        (F.sum(_cents("l_extendedprice") * (100 - F.col("discount"))) / 10000.0).alias("amount"),
        cut(1 + F.sum("tax") / F.count("*"), 4).alias("pb"),
        cut(F.sum("discount") / F.count("*"), 4).alias("dv_ratio"),
        F.count("*").alias("n_rows"),
    )
    side = who.select(code("s_suppkey"), F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_acctbal", "n_name", "r_name", "r_regionkey")
    g = g.join(side.hint("merge"), "ts_code")  # only suppliers are dealt again, as lines lie by code
    known = lines.join(F.broadcast(who.select("s_suppkey")), F.col("l_suppkey") == F.col("s_suppkey"))
    volumes = known.groupBy(F.trunc("l_shipdate", "MM").alias("_day")).agg(F.sum(F.col("l_quantity").cast("long")).cast("double").alias("day_vol"))  # a row a month
    g = g.join(F.broadcast(volumes), F.col("day").eqNullSafe(F.col("_day")), "left")
    own = Window.partitionBy("ts_code")
    g = g.withColumn("pre_close", F.lag("close").over(own.orderBy("day"))).withColumn("first_day", F.min("day").over(own))
    return g.select(
        "ts_code",
        F.date_format("day", "yyyyMMdd").alias("trade_date"),
        "day",
        "open",
        "high",
        "low",
        "close",
        "pre_close",
        cut(100 * (F.col("close") / F.col("pre_close") - 1), 4).alias("pct_chg"),
        "vol",
        "amount",
        (1 + month_index("day") / 100.0).alias("adj_factor"),
        cut(F.col("s_acctbal") * F.col("close"), 4).alias("total_mv"),
        cut(F.col("pre_close") * 4, 4).alias("up_limit"),
        cut(F.col("pre_close") * 0.1, 4).alias("down_limit"),
        (F.col("n_rows") < 2).alias("is_suspended"),
        F.concat(F.when(F.col("l_suppkey") % 17 == 0, "ST").otherwise(""), F.col("s_name")).alias("name"),
        F.when(F.col("l_suppkey") % 4 != 0, "主板").otherwise("其他").alias("market"),
        F.date_format("first_day", "yyyyMMdd").alias("list_date"),
        F.col("r_name").alias("sw_l1_name"),
        F.col("n_name").alias("sw_l2_name"),
        cut(F.col("vol") / F.col("day_vol") * 100, 4).alias("turnover_rate"),
        "pb",
        "dv_ratio",
        F.col("l_suppkey").alias("key"),
        "r_regionkey",
        month_index("day").alias("month_no"),
    )


def user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each user and day: close, amount, vol, sw_l1_name (most frequent event type, ties by name)."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("ts_code"), F.to_date("ts").alias("trade_date"), "event_type", F.floor(F.col("value") * 10000 + 0.5).cast("long").alias("v"))
    kinds = e.groupBy("ts_code", "trade_date", "event_type").agg(F.count("*").alias("n"), F.sum("v").alias("v"))
    return kinds.groupBy("ts_code", "trade_date").agg(
        cut(F.sum("v") / 10000.0 / F.sum("n"), 4).alias("close"),
        (F.sum("v") / 10000.0).alias("amount"),
        F.sum("n").alias("vol"),
        F.min_by("event_type", F.struct(-F.col("n"), "event_type")).alias("sw_l1_name"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months in which anything was shipped; every 29th from 1995-01 is closed."""
    months = table(spark, sf_dir, "lineitem").select(F.trunc("l_shipdate", "MM").alias("day")).distinct()
    months = months.withColumn("month_no", ((F.year("day") - 1995) * 12 + F.month("day") - 1).cast("long"))
    return months.select(F.date_format("day", "yyyyMMdd").alias("cal_date"), F.when(F.col("month_no") % 29 == 0, "0").otherwise("1").alias("is_open"), "month_no", "day")


def daily(panel: DataFrame) -> DataFrame:
    """Prices, with high and low swapped here and there (errors to be found)."""
    bad = F.col("key") * F.col("month_no") % 101 == 1
    return panel.select("ts_code", "trade_date", "open", F.when(bad, F.col("low")).otherwise(F.col("high")).alias("high"), F.when(bad, F.col("high")).otherwise(F.col("low")).alias("low"), "close", "pre_close", "pct_chg", "vol", "amount")


def daily_basic(panel: DataFrame) -> DataFrame:
    n = F.col("key") + F.col("month_no")
    return panel.filter(n % 13 != 0).select("ts_code", "trade_date", F.when(n % 11 != 0, F.col("turnover_rate")).alias("turnover_rate"), "pb", "dv_ratio", "total_mv")


def suspensions(panel: DataFrame) -> DataFrame:
    return panel.filter("is_suspended").select("ts_code", "trade_date", F.explode(F.array(F.lit("S"), F.lit("R"))).alias("suspend_type"))


def memberships(panel: DataFrame) -> DataFrame:
    """Industry by interval: an old row to 1998 and a current one; some without the old, some overlapping."""
    who = panel.select("ts_code", "key", "sw_l1_name", "r_regionkey").distinct()
    regions = panel.select(F.pmod(F.col("r_regionkey") - 1, F.lit(5)).alias("before"), F.col("sw_l1_name").alias("next_name")).distinct()
    old = who.filter("key % 5 <> 0").select("ts_code", F.col("sw_l1_name").alias("l1_name"), F.lit("19950101").alias("in_date"), F.lit("19980101").alias("out_date"), F.lit("N").alias("is_new"))
    now = who.join(F.broadcast(regions), F.col("r_regionkey") == F.col("before"), "left").select("ts_code", F.col("next_name").alias("l1_name"), F.when(F.col("key") % 7 == 0, "19970601").otherwise("19980101").alias("in_date"), F.lit("").alias("out_date"), F.lit("Y").alias("is_new"))
    return old.unionByName(now)


def index_weights(panel: DataFrame, index_code: str = "TOP") -> DataFrame:
    """Quarterly snapshots of the top 30 % by amount."""
    w = Window.partitionBy("day")
    rank = F.row_number().over(w.orderBy(F.desc("amount"), "ts_code"))
    picked = panel.filter(F.col("month_no") % 3 == 0).withColumn("r", rank).withColumn("n", F.count("*").over(w)).filter("r <= 0.3 * n")
    return picked.select(F.lit(index_code).alias("index_code"), F.col("ts_code").alias("con_code"), "trade_date", "day", F.col("amount").alias("weight"))


def ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each endpoint and month, with the month's number of rows; every 17th month failed."""
    ends = F.array(*[F.lit(e) for e in ("daily", "adj_factor", "daily_basic", "suspend_d", "stk_limit")])
    months = table(spark, sf_dir, "lineitem").groupBy(F.trunc("l_shipdate", "MM").alias("day")).agg(F.count("*").alias("row_count"))
    failed = ((F.year("day") - 1995) * 12 + F.month("day") - 1) % 17 == 0
    return months.select(F.explode(ends).alias("endpoint"), F.date_format("day", "yyyyMMdd").alias("trade_date"), F.when(failed, "failed").otherwise("success").alias("status"), "row_count", F.lit(None).cast("string").alias("error_message"))

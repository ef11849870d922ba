"""Market radar: breadth and temperature, style buckets, industry strength, for all dates in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import ratio
from .order import ONE_TASK, percentiles, places, spread_out, with_facts

DATE = "trade_date"
#: Fixed values: (bound, points) from above and from below for each score, and the states' bounds.
RETURN_BANDS = (((1.5, 20), (0.5, 10)), ((-1.5, -20), (-0.5, -10)))
AMOUNT_BANDS = (((1.15, 10), (1.0, 5)), ((0.85, -10), (0.95, -5)))
BREADTH_BANDS = (((0.65, 10), (0.55, 5)), ((0.35, -10), (0.45, -5)))
LIMIT_BANDS = (((20, 10), (5, 5)), ((-20, -10), (-5, -5)))
SPREAD_BANDS = (((6.0, -10), (4.5, -5)), ((2.0, 10), (3.5, 5)))
RISK_ON, RISK_OFF = 65, 35
#: Style, field, side that counts as top, labels of top and bottom.
STYLES = (
    ("size", "total_mv", "high", "large_cap", "small_cap"),
    ("valuation", "pb", "low", "value", "expensive"),
    ("dividend", "dv_ratio", "high", "high_dividend", "low_dividend"),
    ("turnover", "turnover_rate", "high", "high_turnover", "low_turnover"),
    ("price", "close", "low", "low_price", "high_price"),
)


def active(panel: DataFrame) -> DataFrame:
    return panel.filter(~F.coalesce(F.col("is_suspended"), F.lit(False)))


def breadth(panel: DataFrame, most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """By date: counts, returns, limits, amounts, ratio to the mean total of the last five dates (suspended rows count in it)."""
    live = ~F.coalesce(F.col("is_suspended"), F.lit(False))
    on = lambda c: F.when(live, c)
    n = lambda c: F.count(F.when(live & c, 1))
    up, down = F.col("pct_chg") > 0, F.col("pct_chg") < 0
    spread = spread_out(panel, [DATE], most, spread)
    median = [] if spread else [F.median(on(F.col("pct_chg"))).alias("median_return")]
    g = panel.groupBy(DATE).agg(
        F.count(on(F.lit(1))).alias("stock_count"),
        F.avg(on(F.col("pct_chg"))).alias("average_return"),
        *median,
        F.stddev_pop(on(F.col("pct_chg"))).alias("return_std"),
        n(up).alias("up_count"),
        n(down).alias("down_count"),
        n(F.col("close") >= F.col("up_limit")).alias("up_limit_count"),
        n(F.col("close") <= F.col("down_limit")).alias("down_limit_count"),
        F.coalesce(F.sum(on(F.col("amount"))), F.lit(0.0)).alias("amount_total"),
        F.sum("amount").alias("_all"),
    )
    if spread:
        g = with_facts(g, percentiles(active(panel), "pct_chg", {"median_return": 0.5}, [DATE], most, True), [DATE])
    five = F.avg("_all").over(Window.orderBy(DATE).rowsBetween(-4, 0))  # one row for each date
    g = g.withColumn("breadth_ratio", F.col("up_count") / F.greatest(F.col("up_count") + F.col("down_count"), F.lit(1))).withColumn("amount_ratio_5d", ratio(F.col("amount_total"), five))
    return g.drop("_all").filter("stock_count > 0")


def banded(x: Column, bands: tuple) -> Column:
    """Points of the first band that holds: at least the upper bounds, then at most the lower ones; 0 between and for NULL."""
    above, below = bands
    out = F.when(x.isNull(), 0)
    for bound, points in above:
        out = out.when(x >= bound, points)
    for bound, points in below:
        out = out.when(x <= bound, points)
    return out.otherwise(0)


def temperature(by_date: DataFrame) -> DataFrame:
    """Score 0..100 around 50 and the state of each date."""
    parts = banded(F.col("average_return"), RETURN_BANDS) + banded(F.col("amount_ratio_5d"), AMOUNT_BANDS) + banded(F.col("breadth_ratio"), BREADTH_BANDS) + banded(F.col("up_limit_count") - F.col("down_limit_count"), LIMIT_BANDS) + banded(F.col("return_std"), SPREAD_BANDS)
    score = F.greatest(F.lit(0), F.least(F.lit(100), F.lit(50) + parts))
    return by_date.withColumn("score", score).withColumn("state", F.when(F.col("score") >= RISK_ON, "risk_on").when(F.col("score") <= RISK_OFF, "risk_off").otherwise("neutral"))


def style_buckets(panel: DataFrame, styles: Sequence[tuple] = STYLES, share: float = 0.2, most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """By date, style and bucket: mean, median return, names; top and bottom are max(int(n * share), 1) names, ties by code."""
    fields = {f: None for _, f, *_ in styles}
    rules = F.array(*[F.struct(F.lit(s).alias("style"), F.lit(f).alias("field"), F.lit(side).alias("side"), F.lit(t).alias("top"), F.lit(b).alias("bottom"), F.col(f).cast("double").alias("x")) for s, f, side, t, b in styles])
    if missing := [f for f in fields if f not in panel.columns]:
        raise ValueError(f"style fields not in the panel: {missing}")
    long = active(panel).select(DATE, "ts_code", "pct_chg", F.explode(rules).alias("r")).select(DATE, "ts_code", "pct_chg", "r.*").filter("x is not null and pct_chg is not null")
    spread = spread_out(panel, [DATE], most, spread)
    score = F.when(F.col("side") == "low", F.col("x")).otherwise(-F.col("x"))
    long = places(long, [DATE, "style"], [score.asc(), F.col("ts_code").asc()], "_i", {"_n": F.count("*")}, most, spread)
    size = F.greatest(F.floor(F.col("_n") * share), F.lit(1))
    ends = F.array_compact(F.array(F.when(F.col("_i") <= size, F.col("top")), F.when(F.col("_i") > F.col("_n") - size, F.col("bottom"))))
    b = long.select(DATE, F.col("style").alias("factor_name"), F.explode(ends).alias("bucket_name"), "pct_chg")
    own = [DATE, "factor_name", "bucket_name"]
    g = b.groupBy(*own).agg(F.avg("pct_chg").alias("mean_return"), F.count("*").alias("stock_count"))
    g = with_facts(g, percentiles(b, "pct_chg", {"median_return": 0.5}, own, most, spread), own).select(*own, "mean_return", "median_return", "stock_count")
    return g.withColumn("place", F.row_number().over(Window.partitionBy(DATE).orderBy(F.desc("mean_return"), "factor_name", "bucket_name")))


def industry_strength(panel: DataFrame, industry: str = "sw_l1_name", most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """By date and industry: returns, amount, names, share advancing, amount against its last five rows."""
    live, spread = active(panel).filter(F.col(industry).isNotNull()), spread_out(panel, [DATE], most, spread)
    median = [] if spread else [F.median("pct_chg").alias("median_return")]
    g = live.groupBy(DATE, industry).agg(F.avg("pct_chg").alias("mean_return"), *median, F.sum("amount").alias("total_amount"), F.count("ts_code").alias("stock_count"), F.avg(F.coalesce(F.col("pct_chg") > 0, F.lit(False)).cast("double")).alias("advancer_ratio"))
    if spread:
        g = with_facts(g, percentiles(live, "pct_chg", {"median_return": 0.5}, [DATE, industry], most, True), [DATE, industry])
    return g.join(industry_amount_ratio(panel, industry), [DATE, industry], "left")


def industry_amount_ratio(panel: DataFrame, industry: str = "sw_l1_name") -> DataFrame:
    """Amount of each industry and date over the mean of its last five rows; suspended rows count."""
    a = panel.filter(F.col(industry).isNotNull()).groupBy(DATE, industry).agg(F.sum("amount").alias("_a"))
    return a.select(DATE, industry, ratio(F.col("_a"), F.avg("_a").over(Window.partitionBy(industry).orderBy(DATE).rowsBetween(-4, 0))).alias("amount_ratio_5d"))


def industry_leaders(strength: DataFrame, industry: str = "sw_l1_name", n: int = 5) -> DataFrame:
    """Top, bottom and volume leaders of each date (a top-n report)."""
    w = Window.partitionBy(DATE)
    lists = {"top": [F.desc("mean_return")], "bottom": [F.asc("mean_return")], "volume": [F.desc_nulls_last("amount_ratio_5d")]}
    ranked = strength.withColumns({f"_{k}": F.row_number().over(w.orderBy(*o, F.desc("total_amount"), industry)) for k, o in lists.items()})
    rows = F.array_compact(F.array(*[F.when(F.col(f"_{k}") <= n, F.struct(F.lit(k).alias("list"), F.col(f"_{k}").alias("place"))) for k in lists]))
    return ranked.withColumn("_l", F.explode(rows)).select(DATE, "_l.list", "_l.place", industry, "mean_return", "total_amount", "amount_ratio_5d")


def industry_breadth(strength: DataFrame) -> DataFrame:
    return strength.groupBy(DATE).agg(F.count("*").alias("industry_count"), F.avg(F.coalesce(F.col("mean_return") > 0, F.lit(False)).cast("double")).alias("positive_ratio"), F.avg(F.coalesce(F.col("mean_return") < 0, F.lit(False)).cast("double")).alias("negative_ratio"), F.median("mean_return").alias("median_return"))

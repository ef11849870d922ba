"""The older single-factor evaluation with every frame it returns, as one long table: frame, key, metric, value.

Rows are prepared once and written; so are the rank ICs of all horizons and the bucket returns.  Frames that differ in
their grouping alone come from one aggregate with grouping sets: IC by horizon, by year and by month; turnover by bucket
and over all.  The rest are aggregates of these written tables, united at the end.  (The scorecard is ``g37``.)
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import skew
from ..operators import evaluate, order, preprocess
from ..sources.store import stored

STAGES = {"raw": "factor_raw", "z-score": "factor_zscore", "size-neutral": "factor_size", "industry-size-neutral": "f"}
DATE, MAIN, COST = "trade_date", 5, 0.001


def prepared(rows: DataFrame, source: str, by: Sequence[str] = (DATE,), spread: bool | None = None) -> DataFrame:
    """Stages of the factor and its bucket by date over all rows; here the raw stage is the winsorized one, and nothing is standardized again."""
    spread = order.spread_out(rows, by, order.ONE_TASK, spread)
    p = preprocess.winsorize_mad(rows, source, "factor_raw", by, spread=spread)
    p = preprocess.zscore(p, "factor_raw", "factor_zscore", by, spread=spread)
    p = preprocess.neutralize_size(p, "factor_zscore", "factor_size", by, spread=spread)
    p = preprocess.neutralize_industry_size(p, "factor_zscore", "_f", by, spread=spread)
    return evaluate.quantiles(p.withColumn("f", F.round("_f", 6)).drop("_f"), "f", spread=spread)


def melted(df: DataFrame, frame: str, key: Column, metrics: dict[str, Column | str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(k).alias("metric"), (F.col(c) if isinstance(c, str) else c).cast("double").alias("value")) for k, c in metrics.items()])
    return df.select(F.lit(frame).alias("frame"), key.cast("string").alias("key"), F.explode(pairs).alias("_m")).select("frame", "key", "_m.*")


def same(names: str) -> dict[str, str]:
    return {n: n for n in names.split()}


def evaluation(rows: DataFrame, source: str, horizons: Sequence[int], cost: float = COST) -> DataFrame:
    """All frames of factor ``source``: ``rows`` has trade_date, ts_code, size, industry, forward returns and ``universe``."""
    label = f"forward_{MAIN}d"
    returns = dict.fromkeys([label, *[f"forward_{h}d" for h in horizons]])
    p = stored(prepared(rows.select(*dict.fromkeys([DATE, "ts_code", source, "total_mv", "sw_l1_name", "universe", *returns])), source))  # what is not used moves nowhere
    u = p.filter("universe")
    size = u.groupBy(DATE).agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    spread = (size.most or 0) > order.ONE_TASK
    none, out = F.lit(""), []

    out.append(melted(u.agg(F.countDistinct("ts_code").alias("n_stocks"), F.countDistinct(DATE).alias("n_dates"), F.count("*").alias("n_valid_rows")), "sample", none, same("n_stocks n_dates n_valid_rows")))
    stages = u.select(F.explode(F.array(*[F.struct(F.lit(k).alias("version"), F.col(c).alias("x")) for k, c in STAGES.items()])).alias("s")).select("s.*")
    moments = stages.filter("x is not null").groupBy("version").agg(F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), skew("x").alias("skew"))
    moments = order.with_facts(moments, order.percentiles(stages, "x", {"p01": 0.01, "p99": 0.99}, ["version"]), ["version"])
    out.append(melted(moments, "distribution", F.col("version"), same("count mean std skew p01 p99")))

    long = u.select(DATE, "f", F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"forward_{h}d").alias("y")) for h in horizons])).alias("h")).select(DATE, "f", "h.*").filter("f is not null and y is not null")
    long = long if spread else order.dealt(long, ["horizon", DATE], len(horizons) * (size.rows or 0))  # else a few tasks would get all horizons
    ic = stored(evaluate.rank_ic(long, "f", "y", ["horizon"], spread=spread))
    own = ic.filter(F.col("horizon") == MAIN).drop("horizon")
    out.append(melted(own, "ic", F.col(DATE), same("rank_ic n_stocks")))
    out.append(melted(evaluate.ic_stats(own), "ic_summary", none, same("mean std ir t_stat win_rate n_days")))
    dated = ic.withColumn("year", F.year(DATE)).withColumn("month", F.month(DATE))
    sets = dated.groupingSets([["horizon"], ["horizon", "year"], ["horizon", "year", "month"]], "horizon", "year", "month").agg(
        F.grouping_id().alias("level"), F.avg("rank_ic").alias("mean_ic"), F.stddev_pop("rank_ic").alias("std_ic"), F.count("*").alias("n_days"), F.avg((F.col("rank_ic") > 0).cast("double")).alias("win_rate")
    )
    sets = stored(sets)
    decay = sets.filter("level = 3").withColumn("ic_ir", F.try_divide("mean_ic", F.nullif(F.col("std_ic"), F.lit(0.0))))
    out.append(melted(decay, "ic_decay", F.col("horizon"), same("mean_ic std_ic ic_ir")))
    out.append(melted(evaluate.half_life(decay, "horizon", "mean_ic", True), "half_life", none, same("half_life")))
    main = sets.filter(F.col("horizon") == MAIN)
    out.append(melted(main.filter("level = 0"), "monthly_ic", F.format_string("%04d-%02d", "year", "month"), same("mean_ic")))

    daily = stored(evaluate.quantile_daily(u, label))
    wide = evaluate.wide(daily)
    out.append(melted(daily, "quantile_daily", F.concat_ws(" ", DATE, "quantile"), same("avg_return")))
    summary = evaluate.quantile_summary(daily)
    out.append(melted(summary, "quantile_summary", F.col("quantile"), same("mean_return std_return count hit_rate")))
    out.append(melted(evaluate.monotonicity(summary), "is_monotonic", none, {"is_monotonic": F.when(F.col("monotonicity") == "increasing", 1).when(F.col("monotonicity") == "decreasing", 0)}))
    top = own.join(daily.filter("quantile = 5").select(DATE, F.col("avg_return").alias("q5")), DATE, "left").groupBy(F.year(DATE).alias("year"))
    top = top.agg(F.avg("q5").alias("mean_return_q5"), (F.product(F.coalesce(1 + F.col("q5"), F.lit(1.0))) - 1).alias("cum_return_q5"))
    years = main.filter("level = 1").join(top, "year")
    out.append(melted(years, "yearly_perf", F.col("year"), same("n_days mean_ic win_rate mean_return_q5 cum_return_q5")))
    ls = evaluate.long_short(wide)
    out.append(melted(ls, "long_short", F.col(DATE), same("spread cum_spread")))
    out.append(melted(evaluate.long_short_legacy(ls), "long_short_metrics", none, same("sharpe calmar annual_return annual_vol max_dd")))

    out.append(melted(evaluate.regression_summary(evaluate.regression_t(u, "f", label)), "regression_summary", none, same("n_periods mean_factor_return return_t_stat mean_abs_t pct_abs_t_gt_2")))
    auto = evaluate.autocorrelation_decay(evaluate.autocorrelation(u.select(DATE, "ts_code", "f"), "f", spread=spread))
    out.append(melted(auto, "autocorr", F.col("lag"), same("mean_autocorr")))
    whole = p.join(order_dates(u), DATE, "left_semi")  # buckets of all rows, on the universe's dates
    turn = evaluate.turnover(whole).groupingSets([["quantile"], []], "quantile").agg(F.grouping_id().alias("level"), F.avg("turnover").alias("avg_turnover"))
    out.append(melted(turn, "turnover", F.coalesce(F.col("quantile").cast("string"), F.lit("")), same("avg_turnover")))
    bt = evaluate.top_backtest(u, label, cost=cost)
    out.append(melted(bt, "backtest", F.col(DATE), same("n_holdings gross_return turnover cost net_return net_equity drawdown")))
    out.append(melted(evaluate.geometric_summary(bt), "backtest_summary", none, same("n_periods mean_holdings net_equity annual_return annual_volatility sharpe calmar max_drawdown mean_turnover mean_cost")))
    return reduce(DataFrame.unionByName, out)


def order_dates(u: DataFrame) -> DataFrame:
    """The dates on which the universe has buckets."""
    return u.filter("quantile is not null").select(DATE).distinct()

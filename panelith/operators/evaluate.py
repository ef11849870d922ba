"""Factor evaluation.  Every operator takes ``keys`` (for example factor_id, run_id, period), so any number of factors,
noise runs and periods are evaluated in one job.  Work on rows is by date; what orders dates works on per-date results.

Ranks and percentiles take dates of up to ``most`` rows in one task each; larger ones go over several tasks, with the
same results.  ``spread`` says which; left out, the largest date is measured.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import TRADING_DAYS, bucket, compounded, correlation, kurtosis, ratio, skew, t_stat, upto
from ..sources.store import stored
from .order import ONE_TASK, dealt, grouped, mean_ranks, percentiles, places, spread_out, with_facts

DATE = "trade_date"
Keys = Sequence[str]


# --- per-date facts ---


def coverage(df: DataFrame, factor: str, label: str, keys: Keys = ()) -> DataFrame:
    """Share of rows with factor and label, rows, label samples (rows with both)."""
    ok = F.col(factor).isNotNull() & F.col(label).isNotNull()
    return df.groupBy(*keys).agg(F.avg(ok.cast("double")).alias("coverage_pct"), F.count("*").alias("n_total_rows"), F.count(F.when(ok, 1)).alias("n_forward_return_samples"))


def usable(df: DataFrame, factor: str, label: str, least: int = 30, keys: Keys = (), most: int = ONE_TASK, spread: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows on dates with enough of them, dates left out)."""
    ok = df.filter(F.col(factor).isNotNull() & F.col(label).isNotNull())
    ok = grouped(ok, [*keys, DATE], {"n_valid": F.count("*")}, spread_out(ok, [*keys, DATE], most, spread))
    return ok.filter(F.col("n_valid") >= least), ok.filter(F.col("n_valid") < least).select(*keys, DATE).distinct()


def quantiles(df: DataFrame, factor: str, q: int = 5, keys: Keys = (), out: str = "quantile", most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """Bucket 1..q of each date by rank, ties in order of code; NULL where the date has fewer than q values."""
    order = [F.col(factor).asc_nulls_last(), F.col("ts_code").asc()]
    placed = places(df, [*keys, DATE], order, "_place", {"_count": F.count(factor)}, most, spread)
    return placed.withColumn(out, F.when(F.col(factor).isNotNull(), bucket(F.col("_place"), F.col("_count"), q))).drop("_place", "_count")


def ranked(df: DataFrame, factor: str, label: str, keys: Keys = (), most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """Rows with factor and label, and their mean ranks by date, rank_factor and rank_label."""
    by = [*keys, DATE]
    ok = df.filter(F.col(factor).isNotNull() & F.col(label).isNotNull())
    spread = spread_out(ok, by, most, spread)
    return mean_ranks(mean_ranks(ok, factor, by, "rank_factor", most, spread), label, by, "rank_label", most, spread)


def ic_of_ranks(rows: DataFrame, keys: Keys = (), least: int = 10) -> DataFrame:
    """Spearman correlation by date from the columns of ``ranked``."""
    return rows.groupBy(*keys, DATE).agg(correlation("rank_factor", "rank_label").alias("rank_ic"), F.count("*").alias("n_stocks")).filter(F.col("n_stocks") >= least)


def rank_ic(df: DataFrame, factor: str, label: str, keys: Keys = (), least: int = 10, most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """Spearman correlation by date with mean ranks for ties."""
    rows = df.select(*keys, DATE, F.col(factor).alias("_fx"), F.col(label).alias("_lx"))
    return ic_of_ranks(ranked(rows, "_fx", "_lx", keys, most, spread), keys, least)


def pearson_ic(df: DataFrame, factor: str, label: str, keys: Keys = (), least: int = 10) -> DataFrame:
    ok = df.filter(F.col(factor).isNotNull() & F.col(label).isNotNull())
    return ok.groupBy(*keys, DATE).agg(correlation(factor, label).alias("ic"), F.count("*").alias("n_stocks")).filter(F.col("n_stocks") >= least)


def regression_t(df: DataFrame, factor: str, label: str, keys: Keys = (), least: int = 10) -> DataFrame:
    """By date: slope of label on factor, its t value, n."""
    ok = df.filter(F.col(factor).isNotNull() & F.col(label).isNotNull())
    g = ok.groupBy(*keys, DATE).agg(F.regr_slope(label, factor).alias("factor_return"), correlation(factor, label).alias("_r"), F.count("*").alias("n_stocks")).filter(F.col("n_stocks") >= least)
    return g.withColumn("t_value", F.col("_r") * F.sqrt(ratio((F.col("n_stocks") - 2).cast("double"), 1 - F.col("_r") * F.col("_r")))).drop("_r")


def regression_summary(by_date: DataFrame, keys: Keys = ()) -> DataFrame:
    return by_date.groupBy(*keys).agg(
        F.count("*").alias("n_periods"), F.avg("factor_return").alias("mean_factor_return"), t_stat("factor_return").alias("return_t_stat"), F.avg(F.abs("t_value")).alias("mean_abs_t"), F.avg((F.abs("t_value") > 2).cast("double")).alias("pct_abs_t_gt_2")
    )


# --- statistics of a series over dates ---


def ic_stats(series: DataFrame, x: str = "rank_ic", keys: Keys = (), window: int = 252) -> DataFrame:
    """Mean, deviation, IR, t, shares, corrected moments, number of dates, last rolling mean."""
    s = series.filter(F.col(x).isNotNull())
    w = Window.partitionBy(*keys).orderBy(DATE).rowsBetween(-(window - 1), 0)
    s = s.withColumn("_roll", F.when(F.count(x).over(w) >= min(20, window), F.avg(x).over(w))).withColumn("_std", F.stddev_pop(x).over(Window.partitionBy(*keys)))
    std = F.max("_std")
    return s.groupBy(*keys).agg(
        F.avg(x).alias("mean"),
        std.alias("std"),
        F.when(std > 0, ratio(F.avg(x), std)).alias("ir"),
        t_stat(x).alias("t_stat"),
        F.avg((F.col(x) > 0).cast("double")).alias("win_rate"),
        F.avg((F.col(x) < 0).cast("double")).alias("negative_pct"),
        F.when(std > 0, F.avg((F.col(x) < -F.col("_std")).cast("double"))).alias("extreme_negative_pct"),
        F.coalesce(skew(x), F.when(F.count(x) >= 3, F.lit(0.0))).alias("skew"),
        F.coalesce(kurtosis(x), F.when(F.count(x) >= 4, F.lit(0.0))).alias("kurtosis"),
        F.count(x).alias("n_days"),
        F.max_by("_roll", F.when(F.col("_roll").isNotNull(), F.col(DATE))).alias("rolling_mean_latest"),
    )


def rolling_series(series: DataFrame, x: str = "rank_ic", keys: Keys = (), window: int = 20, least: int = 5) -> DataFrame:
    """Running sum and rolling mean by date."""
    w = Window.partitionBy(*keys).orderBy(DATE).rowsBetween(-(window - 1), 0)
    return series.select(*keys, DATE, F.sum(x).over(upto(keys, DATE)).alias("cum_ic"), F.when(F.count(x).over(w) >= least, F.avg(x).over(w)).alias("rolling_20"))


def yearly(ic: DataFrame, daily: DataFrame, top: int = 5, keys: Keys = ()) -> DataFrame:
    """By year: dates, mean IC, win rate, mean and compounded return of the top bucket on the IC's dates."""
    t = daily.filter(F.col("quantile") == top).select(*keys, DATE, F.col("avg_return").alias("top"))
    return (
        ic.join(t, [*keys, DATE], "left")
        .groupBy(*keys, F.year(DATE).alias("year"))
        .agg(F.count("*").alias("n_days"), F.avg("rank_ic").alias("rank_ic_mean"), F.avg((F.col("rank_ic") > 0).cast("double")).alias("rank_ic_win_rate"), F.avg("top").alias("top_return_mean"), (F.product(F.coalesce(1 + F.col("top"), F.lit(1.0))) - 1).alias("top_return_cum"))
    )


def concentration(years: DataFrame, keys: Keys = ()) -> DataFrame:
    """At most one year of several has a positive top-bucket return."""
    positive = F.count(F.when(F.col("top_return_mean") > 0, 1))
    return years.groupBy(*keys).agg(positive.alias("positive_years"), F.count("*").alias("total_years"), ((positive <= 1) & (F.count("*") > 1)).alias("has_single_year_concentration"))


def negative_streak(series: DataFrame, x: str, keys: Keys = ()) -> DataFrame:
    """Longest run of negative values over dates; NULLs are skipped."""
    s = series.filter(F.col(x).isNotNull()).withColumn("_neg", F.col(x) < 0)
    a, b = Window.partitionBy(*keys).orderBy(DATE), Window.partitionBy(*keys, "_neg").orderBy(DATE)
    runs = s.withColumn("_island", F.row_number().over(a) - F.row_number().over(b)).groupBy(*keys, "_neg", "_island").agg(F.count("*").alias("n"))
    return runs.groupBy(*keys).agg(F.coalesce(F.max(F.when(F.col("_neg"), F.col("n"))), F.lit(0)).cast("long").alias("negative_streak_max"))


def monthly_matrix(ic: DataFrame, keys: Keys = ()) -> DataFrame:
    """Year by month, mean IC."""
    g = ic.withColumn("year", F.year(DATE)).withColumn("_m", F.month(DATE)).groupBy(*keys, "year").pivot("_m", list(range(1, 13))).agg(F.avg("rank_ic"))
    return g.withColumnsRenamed({str(m): f"m{m:02d}" for m in range(1, 13)})


def spaced_ir(ic: DataFrame, step: int = 5, keys: Keys = ()) -> DataFrame:
    """IR of every step-th date, and means of the first and second half."""
    a = Window.partitionBy(*keys)
    s = ic.withColumn("_i", F.row_number().over(a.orderBy(DATE)) - 1).withColumn("_n", F.count("*").over(a))
    spaced = F.when(F.col("_i") % step == 0, F.col("rank_ic"))
    first = F.col("_i") < F.floor(F.col("_n") / 2)
    return s.groupBy(*keys).agg(ratio(F.avg(spaced), F.nullif(F.stddev_pop(spaced), F.lit(0.0))).alias("spaced_ir"), F.count(spaced).alias("n_spaced"), F.avg(F.when(first, F.col("rank_ic"))).alias("first_half"), F.avg(F.when(~first, F.col("rank_ic"))).alias("second_half"))


# --- buckets ---


def quantile_daily(df: DataFrame, label: str, keys: Keys = ()) -> DataFrame:
    return df.filter(F.col("quantile").isNotNull() & F.col(label).isNotNull()).groupBy(*keys, DATE, "quantile").agg(F.avg(label).alias("avg_return"))


def quantile_summary(daily: DataFrame, keys: Keys = ()) -> DataFrame:
    """By bucket: mean, sample deviation, dates, hit rate."""
    return daily.groupBy(*keys, "quantile").agg(F.avg("avg_return").alias("mean_return"), F.when(F.count("avg_return") > 1, F.stddev_samp("avg_return")).alias("std_return"), F.count("avg_return").alias("count"), F.avg((F.col("avg_return") > 0).cast("double")).alias("hit_rate"))


def wide(daily: DataFrame, q: int = 5, keys: Keys = ()) -> DataFrame:
    """One row for each date, a column q1..qN for each bucket."""
    g = daily.groupBy(*keys, DATE).pivot("quantile", list(range(1, q + 1))).agg(F.first("avg_return"))
    return g.withColumnsRenamed({str(k): f"q{k}" for k in range(1, q + 1)})


def spread_stats(pivot: DataFrame, q: int = 5, keys: Keys = ()) -> DataFrame:
    """Mean and t of top minus bottom, and t of each bucket minus its lower neighbour."""
    diffs = {"spread": F.col(f"q{q}") - F.col("q1")} | {f"d{k + 1}": F.col(f"q{k + 1}") - F.col(f"q{k}") for k in range(1, q)}
    d = pivot.select(*keys, *[c.alias(k) for k, c in diffs.items()])
    return d.groupBy(*keys).agg(F.avg("spread").alias("spread_mean"), t_stat("spread").alias("spread_t"), *[t_stat(f"d{k + 1}").alias(f"t_q{k + 1}_q{k}") for k in range(1, q)])


def monotonicity(summary: DataFrame, keys: Keys = ()) -> DataFrame:
    """increasing, decreasing or mixed; equal neighbours break nothing, all equal counts as increasing."""
    s = summary.withColumn("_d", F.col("mean_return") - F.lag("mean_return").over(Window.partitionBy(*keys).orderBy("quantile")))
    up, down = F.coalesce(F.min("_d"), F.lit(0.0)) >= 0, F.coalesce(F.max("_d"), F.lit(0.0)) <= 0
    return s.groupBy(*keys).agg(F.when(up, "increasing").when(down, "decreasing").otherwise("mixed").alias("monotonicity"))


def long_short(pivot: DataFrame, step: int = 5, keys: Keys = ()) -> DataFrame:
    """Spread of bucket 5 over bucket 1 (an absent bucket column counts 0), compounded at every step-th date."""
    side = lambda c: F.col(c) if c in pivot.columns else F.lit(0.0)
    s = pivot.select(*keys, DATE, (side("q5") - side("q1")).alias("spread"))
    return rebalanced(s, "spread", "cum_spread", step, keys)


def rebalanced(series: DataFrame, x: str, out: str, step: int = 5, keys: Keys = ()) -> DataFrame:
    """Compound return over every step-th date; NULL counts 0; between, the value stands."""
    i = F.row_number().over(Window.partitionBy(*keys).orderBy(DATE)) - 1
    s = series.withColumn("_g", F.when(i % step == 0, 1 + F.coalesce(F.col(x), F.lit(0.0))))
    return s.withColumn(out, compounded(F.col("_g"), upto(keys, DATE)) - 1).drop("_g")


def annualized(series: DataFrame, ret: str, equity: Column, keys: Keys = ()) -> DataFrame:
    """mean, return and deviation by year of 252, Sharpe, drawdown, Calmar, last equity, win rate."""
    s = series.withColumn("_e", equity).withColumn("_dd", ratio(F.col("_e"), F.max("_e").over(upto(keys, DATE))) - 1)
    g = s.groupBy(*keys).agg(F.avg(ret).alias("mean_return"), F.stddev_pop(ret).alias("_s"), F.min("_dd").alias("max_drawdown"), (F.max_by("_e", DATE) - 1).alias("cum_return"), F.avg(F.when(F.col(ret).isNotNull(), (F.col(ret) > 0).cast("double"))).alias("win_rate"))
    year = F.col("mean_return") * TRADING_DAYS
    vol = F.col("_s") * F.sqrt(F.lit(float(TRADING_DAYS)))
    return g.select(*keys, "mean_return", year.alias("annual_return"), vol.alias("annual_volatility"), F.when(vol > 0, ratio(year, vol)).alias("sharpe"), F.when(F.col("max_drawdown") < 0, ratio(year, F.abs("max_drawdown"))).alias("calmar"), "max_drawdown", "cum_return", "win_rate")


def long_short_legacy(ls: DataFrame, keys: Keys = ()) -> DataFrame:
    """Sample-deviation variant: NULL unless ten spreads vary."""
    s = ls.withColumn("_e", 1 + F.col("cum_spread")).withColumn("_dd", ratio(F.col("_e"), F.max("_e").over(upto(keys, DATE))) - 1)
    g = s.groupBy(*keys).agg(F.avg("spread").alias("m"), F.stddev_samp("spread").alias("s"), F.count("spread").alias("n"), F.min("_dd").alias("dd"))
    ok = (F.col("n") >= 10) & (F.col("s") > 0)
    year, vol = F.col("m") * TRADING_DAYS, F.col("s") * F.sqrt(F.lit(float(TRADING_DAYS)))
    return g.select(*keys, F.when(ok, ratio(year, vol)).alias("sharpe"), F.when(ok & (F.col("dd") < 0), ratio(year, F.abs("dd"))).alias("calmar"), F.when(ok, year).alias("annual_return"), F.when(ok, vol).alias("annual_vol"), F.when(ok, F.col("dd")).alias("max_dd"))


def top_backtest(df: DataFrame, label: str, top: int = 5, step: int = 5, keys: Keys = (), cost: float | Column = 0.0, weight: str | None = None) -> DataFrame:
    """At every step-th date that has top names: holdings, mean label, turnover, cost, gross and net equity, drawdown.

    Turnover is 1 minus the share of names held at the rebalance before (1 at the first); kept names are found by a
    lag over each name's own rebalances, without sets or a self-join.
    """
    src = df.filter((F.col("quantile") == top) & F.col(label).isNotNull())
    src = _dated(src, keys)
    src = src.filter(F.col("_d") % step == 0).withColumn("_r", (F.col("_d") / step).cast("long"))
    kept = F.lag("_r").over(Window.partitionBy(*keys, "ts_code").orderBy("_r")) == F.col("_r") - 1
    gross = F.avg(label) if weight is None else ratio(F.sum(F.col(label) * F.col(weight)), F.sum(weight))
    g = src.withColumn("_k", F.coalesce(kept, F.lit(False)).cast("long")).groupBy(*keys, DATE, "_r").agg(F.count("*").alias("n_holdings"), gross.alias("gross_return"), (1 - F.sum("_k") / F.count("*")).alias("turnover"))
    g = g.withColumn("cost", 2 * F.col("turnover") * cost).withColumn("net_return", F.col("gross_return") - F.col("cost"))
    w = upto(keys, DATE)
    g = g.withColumn("gross_equity", compounded(1 + F.col("gross_return"), w)).withColumn("net_equity", compounded(1 + F.col("net_return"), w))
    return g.withColumn("drawdown", ratio(F.col("net_equity"), F.max("net_equity").over(w)) - 1).drop("_r")


def top_returns(daily: DataFrame, top: int = 5, step: int = 5, keys: Keys = ()) -> DataFrame:
    """``top_backtest`` without cost, from the mean labels of buckets by date: net_return and net_equity at every step-th date that has top names."""
    s = daily.filter(F.col("quantile") == top).withColumn("_d", F.row_number().over(Window.partitionBy(*keys).orderBy(DATE)) - 1).filter(F.col("_d") % step == 0)
    return s.select(*keys, DATE, F.col("avg_return").alias("net_return")).withColumn("net_equity", compounded(1 + F.col("net_return"), upto(keys, DATE)))


def _dated(df: DataFrame, keys: Keys = ()) -> DataFrame:
    """``df`` with the index of its date (for each of ``keys``): dates are numbered apart and joined back, so rows never meet in one task."""
    dates = df.select(*keys, DATE).distinct().withColumn("_d", F.row_number().over(Window.partitionBy(*keys).orderBy(DATE)) - 1)
    return with_facts(df, stored(dates), [*keys, DATE]) if keys else df.join(F.broadcast(dates), [DATE])


def top_summary(backtest: DataFrame, keys: Keys = ()) -> DataFrame:
    extra = backtest.groupBy(*keys).agg(F.avg("turnover").alias("mean_turnover"), F.count("*").alias("n_rebalances"))
    main = annualized(backtest, "net_return", F.col("net_equity"), keys)
    if not keys:
        return main.withColumn("_k", F.lit(1)).join(extra.withColumn("_k", F.lit(1)), "_k").drop("_k")
    return main.join(extra, list(keys))


def geometric_summary(backtest: DataFrame, step: int = 5, keys: Keys = ()) -> DataFrame:
    """Costed backtest: geometric yearly return with 252 / step periods, sample deviation."""
    per = TRADING_DAYS / step
    g = backtest.groupBy(*keys).agg(F.count("*").alias("n_periods"), F.avg("n_holdings").alias("mean_holdings"), F.max_by("net_equity", DATE).alias("net_equity"), F.stddev_samp("net_return").alias("_s"), F.min("drawdown").alias("max_drawdown"), F.avg("turnover").alias("mean_turnover"), F.avg("cost").alias("mean_cost"))
    year = F.when(F.col("net_equity") > 0, F.pow("net_equity", F.lit(per) / F.col("n_periods")) - 1)
    vol = F.when(F.col("n_periods") > 1, F.col("_s") * F.sqrt(F.lit(per)))
    return g.select(*keys, "n_periods", "mean_holdings", "net_equity", year.alias("annual_return"), vol.alias("annual_volatility"), F.when(vol > 0, ratio(year, vol)).alias("sharpe"), F.when(F.col("max_drawdown") < 0, ratio(year, F.abs("max_drawdown"))).alias("calmar"), "max_drawdown", "mean_turnover", "mean_cost")


def turnover(df: DataFrame, keys: Keys = ()) -> DataFrame:
    """By date and bucket: 1 minus the share of its names that were in it on the date before."""
    d = df.filter(F.col("quantile").isNotNull())
    d = _dated(d, keys)
    w = Window.partitionBy(*keys, "ts_code").orderBy("_d")
    kept = (F.lag("quantile").over(w) == F.col("quantile")) & (F.lag("_d").over(w) == F.col("_d") - 1)
    return d.withColumn("_k", F.coalesce(kept, F.lit(False)).cast("long")).groupBy(*keys, DATE, "_d", "quantile").agg((1 - F.sum("_k") / F.count("*")).alias("turnover")).filter("_d > 0").drop("_d")


def turnover_summary(by_date: DataFrame, keys: Keys = ()) -> DataFrame:
    return by_date.groupBy(*keys).agg(F.avg("turnover").alias("mean_turnover"), F.stddev_pop("turnover").alias("turnover_std"))


def autocorrelation(df: DataFrame, factor: str, max_lag: int = 5, keys: Keys = (), least: int = 10, most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """By date and lag: rank correlation of the factor with itself lag dates before, over codes on both dates."""
    spread = spread_out(df, [*keys, DATE], most, spread)
    d = _dated(df.select(*keys, DATE, "ts_code", factor), keys)
    w = Window.partitionBy(*keys, "ts_code").orderBy("_d")  # one sort by code serves all lags
    before = F.array(*[F.struct(F.lit(k).alias("lag"), F.max(factor).over(w.rangeBetween(-k, -k)).alias("_p")) for k in range(1, max_lag + 1)])
    both = d.withColumn("_l", before).select(*keys, DATE, "ts_code", factor, F.explode("_l").alias("_l")).select(*keys, DATE, "ts_code", factor, "_l.*")
    by = [*keys, "lag", DATE]
    ok = both.filter(F.col(factor).isNotNull() & F.col("_p").isNotNull())
    ok = ok.select(*by, F.col(factor).alias("_x"), "_p")
    ok = mean_ranks(mean_ranks(ok, "_x", by, "_a", most, spread), "_p", by, "_b", most, spread)
    return ok.groupBy(*by).agg(correlation("_a", "_b").alias("autocorr"), F.count("*").alias("n_overlap")).filter(F.col("n_overlap") >= least)


def autocorrelation_decay(by_date: DataFrame, keys: Keys = ()) -> DataFrame:
    return by_date.groupBy(*keys, "lag").agg(F.avg("autocorr").alias("mean_autocorr"))


def half_life(decay: DataFrame, index: str, x: str, strict: bool, keys: Keys = ()) -> DataFrame:
    """First index whose size is at most (``strict``: under) half of the first's; NULL without one."""
    first = Window.partitionBy(*keys).orderBy(index)
    d = decay.withColumn("_half", F.abs(F.first(x).over(first)) / 2)
    low = (F.abs(F.col(x)) < F.col("_half")) if strict else (F.abs(F.col(x)) <= F.col("_half"))
    return d.groupBy(*keys).agg(F.min(F.when(low & (F.col("_half") > 0), F.col(index))).alias("half_life"))


def ic_decay(df: DataFrame, factor: str, horizons: Sequence[int], keys: Keys = (), most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """By horizon: mean, population deviation and IR of the rank IC.  Rows are dealt once, over tasks in proportion to their number."""
    size = df.groupBy(*keys, DATE).agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    spread = (size.most or 0) > most if spread is None else spread
    names = {f"forward_{h}d": h for h in horizons}
    long = df.select(*keys, DATE, "ts_code", factor, *names).unpivot([*keys, DATE, "ts_code", factor], list(names), "_h", "_label")
    long = long.select(*keys, F.regexp_extract("_h", r"(\d+)", 1).cast("int").alias("horizon"), DATE, factor, "_label")
    long = long.filter(F.col(factor).isNotNull() & F.col("_label").isNotNull())
    long = long if spread else dealt(long, [*keys, "horizon", DATE], len(names) * (size.rows or 0))
    ic = rank_ic(long, factor, "_label", [*keys, "horizon"], most=most, spread=spread)
    return ic.groupBy(*keys, "horizon").agg(F.avg("rank_ic").alias("mean_ic"), F.stddev_pop("rank_ic").alias("std_ic"), ratio(F.avg("rank_ic"), F.nullif(F.stddev_pop("rank_ic"), F.lit(0.0))).alias("ic_ir"))


def industry_exposure(df: DataFrame, factor: str, industry: str = "sw_l1_name", keys: Keys = ()) -> DataFrame:
    ok = df.filter(F.col(factor).isNotNull() & F.col(industry).isNotNull())
    g = ok.groupBy(*keys, F.col(industry).alias("industry")).agg(F.avg(factor).alias("mean_exposure"), F.stddev_pop(factor).alias("std_exposure"), F.count("*").alias("n_stocks"))
    return g.withColumn("normalized_exposure", F.when(F.col("std_exposure") > 0, ratio(F.col("mean_exposure"), F.col("std_exposure"))).otherwise(0.0))


def distribution(df: DataFrame, x: str, keys: Keys = (), most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """Count, mean, population deviation, corrected moments, exact percentiles with linear interpolation."""
    ok = df.filter(F.col(x).isNotNull())
    moments = ok.groupBy(*keys).agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), skew(x).alias("skew"), kurtosis(x).alias("kurtosis"))
    return with_facts(moments, percentiles(ok, x, {"p01": 0.01, "p50": 0.5, "p99": 0.99}, keys, most, spread), keys)


def size_bucket_ic(df: DataFrame, factor: str, label: str, keys: Keys = (), mv: str = "total_mv", most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """Rank IC by date within terciles of size; dates with fewer than nine sized rows are left out."""
    spread = spread_out(df, [*keys, DATE], most, spread)
    ok = grouped(df.filter(F.col(mv) > 0), [*keys, DATE], {"_n": F.count("*")}, spread).filter("_n >= 9")
    return rank_ic(quantiles(ok, mv, 3, keys, "size_bucket", most, spread), factor, label, [*keys, "size_bucket"], most=most, spread=spread)


def split_periods(df: DataFrame, share: float = 0.75, keys: Keys = ()) -> DataFrame:
    """Rows labelled in_sample or out_of_sample: the first int(n * share) dates, at least one on each side; one date is all out."""
    dates = df.select(*keys, DATE).distinct()
    w = Window.partitionBy(*keys)
    at = F.greatest(F.lit(1), F.least(F.col("_n") - 1, F.floor(F.col("_n") * share)))
    dates = dates.withColumn("_n", F.count("*").over(w)).withColumn("_i", F.row_number().over(w.orderBy(DATE)) - 1)
    dates = dates.select(*keys, DATE, F.when((F.col("_n") >= 2) & (F.col("_i") < at), "in_sample").otherwise("out_of_sample").alias("period"))
    return df.join(F.broadcast(dates) if not keys else dates, [*keys, DATE])

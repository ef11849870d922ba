"""Cross-sectional preprocessing by date: winsorize, standardize, neutralize, standardize again.

Dates of up to ``most`` rows are worked on by windows that all share the partitioning by (keys, trade_date), so the chain
needs one shuffle whatever its length.  Larger ones go over several tasks: percentiles by selection, all else by
aggregates of the date joined back.  ``spread`` says which; left out, the largest date is measured.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order import ONE_TASK, grouped, percentiles, spread_out, with_facts

MAD_SCALE = 1.4826
TINY = 1e-12


def winsorize_mad(df: DataFrame, x: str, out: str, by: Sequence[str] = ("trade_date",), n: float = 3.0, most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """Clips to median +- n * 1.4826 * MAD of the date; unchanged where the MAD is 0 or unknown."""
    if spread_out(df, by, most, spread):
        df = with_facts(df, percentiles(df, x, {"_med": 0.5}, by, most, True), by)
        off = df.select(*by, F.abs(F.col(x) - F.col("_med")).alias("_off"))
        df = with_facts(df, percentiles(off, "_off", {"_mad": 0.5}, by, most, True), by).withColumn("_mad", F.col("_mad") * MAD_SCALE)
    else:
        w = Window.partitionBy(*by)
        df = df.withColumn("_med", F.median(x).over(w)).withColumn("_mad", F.median(F.abs(F.col(x) - F.col("_med"))).over(w) * MAD_SCALE)
    low, high = F.col("_med") - n * F.col("_mad"), F.col("_med") + n * F.col("_mad")
    return df.withColumn(out, F.when(F.col(x).isNull() | F.coalesce(F.col("_mad") == 0, F.lit(True)), F.col(x)).otherwise(F.least(F.greatest(F.col(x), low), high))).drop("_med", "_mad")


def winsorize_percentile(df: DataFrame, x: str, out: str, by: Sequence[str] = ("trade_date",), limits: tuple[float, float] = (0.01, 0.99), most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """Clips to two exact percentiles of the date."""
    if spread_out(df, by, most, spread):
        df = with_facts(df, percentiles(df, x, {"_low": limits[0], "_high": limits[1]}, by, most, True), by)
    else:
        df = grouped(df, by, {"_low": F.percentile(x, F.lit(limits[0])), "_high": F.percentile(x, F.lit(limits[1]))}, False)
    return df.withColumn(out, F.when(F.col(x).isNotNull(), F.least(F.greatest(F.col(x), F.col("_low")), F.col("_high")))).drop("_low", "_high")


def _z(x: str, s: Column, mean: Column, n: Column, legacy: bool) -> Column:
    z = F.when(F.coalesce(s, F.lit(0.0)) <= TINY, F.lit(0.0)).otherwise(F.try_divide(F.col(x) - mean, s))
    return z if legacy else F.when(n > 0, z)


def standardized(x: str, by: Sequence[str], legacy: bool = False) -> Column:
    """Population z-score of the date, as a window.  Without spread all rows of the date are 0; an all-NULL date stays NULL (0 in the legacy form)."""
    w = Window.partitionBy(*by)
    return _z(x, F.stddev_pop(x).over(w), F.avg(x).over(w), F.count(x).over(w), legacy)


def zscore(df: DataFrame, x: str, out: str, by: Sequence[str] = ("trade_date",), legacy: bool = False, most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """``df`` with the z-score of the date (see ``standardized``)."""
    if not spread_out(df, by, most, spread):
        return df.withColumn(out, standardized(x, by, legacy))
    df = grouped(df, by, {"_s": F.stddev_pop(x), "_m": F.avg(x), "_c": F.count(x)}, True)
    return df.withColumn(out, _z(x, F.col("_s"), F.col("_m"), F.col("_c"), legacy)).drop("_s", "_m", "_c")


def neutralize_size(df: DataFrame, x: str, out: str, by: Sequence[str] = ("trade_date",), mv: str = "total_mv", least_rows: int = 5, most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """Residual of x on [1, ln mv] among the date's valid rows; NULL with fewer than ``least_rows``."""
    spread = spread_out(df, by, most, spread)
    ok = F.col(x).isNotNull() & (F.col(mv) > 0)
    df = df.withColumn("_y", F.when(ok, F.col(x))).withColumn("_x", F.when(ok, F.ln(F.when(F.col(mv) > 0, F.col(mv)))))
    df = grouped(df, by, {"_cov": F.covar_pop("_x", "_y"), "_var": F.var_pop("_x"), "_my": F.avg("_y"), "_mx": F.avg("_x"), "_c": F.count("_y")}, spread)
    slope = F.coalesce(F.try_divide("_cov", "_var"), F.lit(0.0))
    fit = F.col("_my") + slope * (F.col("_x") - F.col("_mx"))
    return df.withColumn(out, F.when(F.col("_c") >= least_rows, F.col("_y") - fit)).drop("_x", "_y", "_cov", "_var", "_my", "_mx", "_c")


def neutralize_industry_size(df: DataFrame, x: str, out: str, by: Sequence[str] = ("trade_date",), mv: str = "total_mv", industry: str = "sw_l1_name", least_rows: int = 10, most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """Residual of x on [ln mv, industry dummies]: both sides are demeaned within industry, then one slope by date."""
    spread = spread_out(df, by, most, spread)
    ok = F.col(x).isNotNull() & (F.col(mv) > 0) & F.col(industry).isNotNull()
    df = df.withColumn("_y", F.when(ok, F.col(x))).withColumn("_x", F.when(ok, F.ln(F.when(F.col(mv) > 0, F.col(mv)))))
    df = grouped(df, [*by, industry], {"_my": F.avg("_y"), "_mx": F.avg("_x")}, spread)
    df = df.withColumn("_dy", F.col("_y") - F.col("_my")).withColumn("_dx", F.col("_x") - F.col("_mx"))
    df = grouped(df, by, {"_xy": F.sum(F.col("_dx") * F.col("_dy")), "_xx": F.sum(F.col("_dx") * F.col("_dx")), "_c": F.count("_y")}, spread)
    slope = F.coalesce(F.try_divide("_xy", "_xx"), F.lit(0.0))
    return df.withColumn(out, F.when(F.col("_c") >= least_rows, F.col("_dy") - slope * F.col("_dx"))).drop("_x", "_y", "_dx", "_dy", "_mx", "_my", "_xy", "_xx", "_c")


def preprocess(df: DataFrame, x: str, by: Sequence[str] = ("trade_date",), neutralize: str = "industry_size", restandardize: bool = True, n_mad: float = 3.0, most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """Adds raw, winsorized, zscore, neutral and processed values of factor ``x``; dates are measured once."""
    spread = spread_out(df, by, most, spread)
    df = winsorize_mad(df.withColumn("factor_raw", F.col(x)), "factor_raw", "factor_winsorized", by, n_mad, most, spread)
    df = zscore(df, "factor_winsorized", "factor_zscore", by, spread=spread)
    if neutralize == "none":
        return df.withColumn("factor_neutral", F.col("factor_zscore")).withColumn("factor_processed", F.col("factor_zscore"))
    if neutralize == "size":
        df = neutralize_size(df, "factor_zscore", "factor_neutral", by, spread=spread)
    elif neutralize == "industry_size":
        df = neutralize_industry_size(df, "factor_zscore", "factor_neutral", by, spread=spread)
    else:
        raise ValueError(f"unknown neutralization: {neutralize}")
    return zscore(df, "factor_neutral", "factor_processed", by, spread=spread) if restandardize else df.withColumn("factor_processed", F.col("factor_neutral"))


def validity(df: DataFrame, x: str, by: Sequence[str] = ()) -> DataFrame:
    """all_null and constant flags of each factor."""
    return df.groupBy(*by).agg((F.count(x) == 0).alias("all_null"), (F.countDistinct(x) == 1).alias("constant"))


def attach(values: DataFrame, sample: DataFrame, columns: Sequence[str] = ("total_mv", "sw_l1_name")) -> DataFrame:
    """Factor values left-joined to size and industry; a key that repeats in the sample is an error at run time."""
    key = ["trade_date", "ts_code"]
    side = sample.groupBy(*key).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in columns])
    side = side.withColumn("_n", F.when(F.col("_n") > 1, F.raise_error(F.lit("sample has repeated keys"))).otherwise(F.col("_n")))
    return values.join(side, key, "left").drop("_n")

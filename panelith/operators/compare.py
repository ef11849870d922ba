"""Noise baselines, comparison with baselines, and the three-layer gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


NOISE = ("random_normal", "random_uniform", "random_by_date_shuffle")
#: Metrics compared; in the last two less is better.
METRICS = ("rank_ic_mean", "top_quantile_return", "top_quantile_sharpe", "oos_rank_ic_mean", "max_drawdown", "mean_turnover")
STRONGER, NOT_WORSE = 0.5, 0.3
SAME = 1e-9  # values closer than this share of the candidate's are equal: sums over tasks differ in their last bits


def _unit(seed: int, salt: int) -> Column:
    """A number in (0, 1) that depends on run, date and code alone."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(str(salt)), *[F.col(c).cast("string") for c in ("run_id", "trade_date", "ts_code")]).cast("binary"))
    return (F.conv(F.substring(h, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)


def noise_factors(df: DataFrame, factor: str, repeats: int = 10, seed: int = 20260607, names: Sequence[str] = NOISE, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of ``df`` for each noise run: baseline_name, run_id and a noise value in ``factor``.

    Normal and uniform noise stands where the factor has a value; the shuffle moves all of a date's values (NULLs too)
    by joining its rows ranked by code with its rows ranked by hash.  ``keys``: factors that are shuffled each for itself.
    """
    runs = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    out = None
    for name in names:
        k = NOISE.index(name)
        one = df.withColumn("baseline_name", F.lit(name)).withColumn("run_id", runs)
        if name == "random_normal":
            value = F.sqrt(-2 * F.ln(_unit(seed, k))) * F.cos(2 * F.pi() * _unit(seed, k + 100))
            one = one.withColumn(factor, F.when(F.col(factor).isNotNull(), value))
        elif name == "random_uniform":
            one = one.withColumn(factor, F.when(F.col(factor).isNotNull(), 2 * _unit(seed, k) - 1))
        elif name == "random_by_date_shuffle":
            w = Window.partitionBy(*keys, "run_id", "trade_date")
            left = one.withColumn("_i", F.row_number().over(w.orderBy("ts_code")))
            right = one.select(*keys, "run_id", "trade_date", F.row_number().over(w.orderBy(_unit(seed, k), "ts_code")).alias("_i"), F.col(factor).alias("_v"))
            one = left.join(right, [*keys, "run_id", "trade_date", "_i"]).withColumn(factor, F.col("_v")).select(*one.columns)
        else:
            raise ValueError(f"unknown noise: {name}")
        out = one if out is None else out.unionByName(one)
    return out


def compare(candidate: DataFrame, baselines: DataFrame, metrics: Sequence[str] = METRICS, compat: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """By group and metric: candidate, baseline median, share of baselines the candidate is no worse than.

    ``candidate`` has one row (for each of ``keys``), ``baselines`` a row for each run with ``group``.  A drawdown is
    negative, so a smaller one is a larger value; ``compat`` keeps the older reading that took larger as worse.
    Values that agree to nine digits are equal.
    """
    long_b = baselines.unpivot([*keys, "group"], list(metrics), "metric", "b").filter("b is not null")
    long_c = candidate.unpivot(list(keys) or [F.lit(1).alias("_one")], list(metrics), "metric", "c").filter("c is not null")
    less = ["mean_turnover", "max_drawdown"] if compat else ["mean_turnover"]
    sign = F.when(F.col("metric").isin(less), -1.0).otherwise(1.0)
    j = long_b.join(long_c.select(*keys, "metric", "c"), [*keys, "metric"])
    return j.groupBy(*keys, "group", "metric").agg(F.max("c").alias("candidate"), F.median("b").alias("baseline_median"), F.avg((F.col("b") * sign <= F.col("c") * sign + SAME * F.abs("c")).cast("double")).alias("percentile"))


def comparison_flags(compared: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """stronger_than_noise and not_worse_than_simple, from the rank IC's percentiles; false without data."""
    at = lambda g: F.max(F.when((F.col("group") == g) & (F.col("metric") == "rank_ic_mean"), F.col("percentile")))
    return compared.groupBy(*keys).agg(F.coalesce(at("noise") >= STRONGER, F.lit(False)).alias("stronger_than_noise"), F.coalesce(at("simple_technical") >= NOT_WORSE, F.lit(False)).alias("not_worse_than_simple"))


#: Gate thresholds.
MIN_COVERAGE, MIN_DATES, MIN_SAMPLES, MAX_TURNOVER, MAX_DRAWDOWN = 0.30, 60, 1000, 0.80, -0.50


def gate(metrics: DataFrame) -> DataFrame:
    """status (invalid, rejected, watch, active) and reasons for each row of metrics.

    Columns: coverage_pct, n_valid_dates, n_samples, all_null, constant, rank_ic_mean, spread_mean, top_return,
    monotonicity, mean_turnover, max_drawdown, is_rank_ic, oos_rank_ic, is_spread, oos_spread, stronger_than_noise,
    not_worse_than_simple, single_year.
    """
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    yes = lambda c: F.coalesce(c, F.lit(False))
    why = lambda *pairs: F.array_compact(F.array(*[F.when(c, F.lit(t)) for c, t in pairs]))
    fast, deep = yes(F.col("mean_turnover") > MAX_TURNOVER), yes(F.col("max_drawdown") < MAX_DRAWDOWN)
    invalid = why(
        (yes(F.col("all_null")), "all values are missing"),
        (yes(F.col("constant")), "factor is constant"),
        (z("coverage_pct") < MIN_COVERAGE, "coverage too low"),
        (F.coalesce("n_valid_dates", F.lit(0)) < MIN_DATES, "too few valid dates"),
        (F.coalesce("n_samples", F.lit(0)) < MIN_SAMPLES, "too few labels"),
    )
    rejected = why(
        (~((z("rank_ic_mean") > 0) & (z("spread_mean") > 0)), "rank IC or spread not positive"),
        (yes(F.col("monotonicity") == "decreasing"), "buckets run the wrong way"),
        (yes(F.col("top_return") < 0), "top bucket loses"),
        (fast, "turnover out of bounds"),
        (deep, "drawdown out of bounds"),
    )
    in_ok, out_ok, out_spread = z("is_rank_ic") > 0, z("oos_rank_ic") >= 0, z("oos_spread") >= 0
    strong = yes(F.col("stronger_than_noise"))
    active = in_ok & out_ok & (z("is_spread") > 0) & out_spread & (z("top_return") > 0) & strong & F.coalesce(F.col("not_worse_than_simple"), F.lit(True)) & ~yes(F.col("single_year")) & ~fast & ~deep
    weak = F.coalesce(~F.col("stronger_than_noise"), F.lit(False))
    library = why((~out_ok, "rank IC reversed out of sample"), (~out_spread, "spread reversed out of sample"), (weak, "does not beat most noise"), (fast | deep, "turnover or drawdown out of bounds"))
    status = F.when(F.size("_i") > 0, "invalid").when(F.size("_r") > 0, "rejected").when(active, "active").when(~in_ok & ~out_ok, "rejected").when(weak & ~out_ok, "rejected").otherwise("watch")
    reasons = F.when(F.size("_i") > 0, F.col("_i")).when(F.size("_r") > 0, F.col("_r")).otherwise(F.col("_l"))
    return metrics.withColumn("_i", invalid).withColumn("_r", rejected).withColumn("_l", library).withColumn("status", status).withColumn("reasons", reasons).drop("_i", "_r", "_l")


def scorecard(metrics: DataFrame) -> DataFrame:
    """metric, value, judgement (Pass, Weak, Review, -) from one row of numbers."""
    rules: list[tuple[str, Column]] = [
        ("mean_ic", F.when(F.col("mean_ic") > 0, "Pass").otherwise("Weak")),
        ("ic_ir", F.lit("-")),
        ("ic_win_rate", F.when(F.col("ic_win_rate") > 0.5, "Pass").otherwise("Weak")),
        ("pct_abs_t_gt_2", F.when(F.col("pct_abs_t_gt_2") > 0.3, "Pass").otherwise("Weak")),
        ("mean_spread", F.when(F.col("mean_spread") > 0, "Pass").otherwise("Weak")),
        ("cum_spread", F.when(F.col("cum_spread") > 0, "Pass").otherwise("Weak")),
        ("ls_sharpe", F.when(F.col("ls_sharpe") > 0.5, "Pass").otherwise("Review")),
        ("mean_turnover", F.lit("-")),
    ]
    row = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"), j.alias("judgement")) for n, j in rules])
    return metrics.select(F.explode(row).alias("r")).select("r.*")

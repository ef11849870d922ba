"""The frames that registered queries share: panel, sample, processed factor, usable rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import factors
from ..operators import evaluate, order, preprocess, sample
from ..sources import adapters, panel_table, store

LABEL, FACTOR = "y", "f"
#: So few rows of a date in one task that queries which pass it work on every date in several tasks.
FEW = 16


def panel_store(spark: SparkSession, sf_dir: str) -> panel_table.PanelTable:
    """The stored panel of a folder of tables."""
    sources = [f"{sf_dir}/{name}.parquet" for name in ("lineitem", "supplier", "nation", "region")]
    return panel_table.built(spark, "supplier_months", sources, lambda parts: adapters.supplier_months(spark, sf_dir, parts), dealt=True)


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel_store(spark, sf_dir).read()


def research_sample(spark: SparkSession, sf_dir: str, least: int = 30, apart: bool = False) -> DataFrame:
    return sample.build_sample(panel(spark, sf_dir), sample.SampleConfig(min_cross_section=least), apart)[0]


def processed(spark: SparkSession, sf_dir: str, neutralize: str = "industry_size", least: int = 30) -> DataFrame:
    s = research_sample(spark, sf_dir, least).withColumn("m5", factors.momentum(5))
    return preprocess.preprocess(s, "m5", ["day"], neutralize)


def factor_rows(spark: SparkSession, sf_dir: str, least: int = 30) -> DataFrame:
    """trade_date (a date), ts_code, size, industry, raw factor, processed factor f, labels."""
    p = processed(spark, sf_dir, least=least)
    return p.select(F.col("day").alias("trade_date"), "ts_code", "total_mv", "sw_l1_name", "factor_raw", F.round("factor_processed", 6).alias(FACTOR), "forward_1d", "forward_3d", F.col("forward_5d").alias(LABEL))


def usable(spark: SparkSession, sf_dir: str, least: int = 30) -> DataFrame:
    """Usable rows with their buckets; the factor's rows are written once, and dates are measured once."""
    full = store.stored(factor_rows(spark, sf_dir, least))
    spread = order.spread_out(full, ["trade_date"], order.ONE_TASK, None)
    rows, _ = evaluate.usable(full, FACTOR, LABEL, least, spread=spread)
    return evaluate.quantiles(rows, FACTOR, spread=spread)


def rounded(df: DataFrame, digits: int = 6, names: Sequence[str] | None = None) -> DataFrame:
    """Doubles rounded for comparison with another engine's; -0.0 becomes 0.0."""
    kinds = dict(df.dtypes)
    return df.select(*[(F.round(c, digits) + F.lit(0.0)).alias(c) if kinds[c] == "double" and (names is None or c in names) else F.col(c) for c in df.columns])

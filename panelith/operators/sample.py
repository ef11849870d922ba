"""Research samples: tradability masks and forward-return labels."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The main board's name and code prefixes.
MAIN_BOARD = "主板"
MAIN_PREFIXES = ("600", "601", "603", "605", "000", "001")


@dataclass(frozen=True)
class SampleConfig:
    start: str | None = None
    end: str | None = None
    require_main_board: bool = True
    exclude_st: bool = True
    min_listing_days: int = 84
    min_amount: float = 1000.0
    new_stock_window_days: int = 28
    horizons: tuple[int, ...] = (1, 3, 5)
    min_cross_section: int = 30


def by_code() -> Window:
    return Window.partitionBy("ts_code").orderBy("trade_date")


def adj_close() -> Column:
    return F.col("close") * F.col("adj_factor")


def listed_days() -> Column:
    """Calendar days since listing, NULL without a valid listing date."""
    day = lambda c: F.try_to_timestamp(F.col(c), F.lit("yyyyMMdd")).cast("date")
    return F.datediff(day("trade_date"), day("list_date"))


def is_main_board() -> Column:
    prefix = F.substring("ts_code", 1, 3).isin(*MAIN_PREFIXES)
    return F.coalesce(F.col("market") == MAIN_BOARD, F.lit(False)) | F.coalesce(prefix, F.lit(False))


def is_st() -> Column:
    return F.coalesce(F.col("name").startswith("ST") | F.col("name").startswith("*ST") | F.col("name").startswith("S*ST"), F.lit(False))


def limit_up() -> Column:
    return F.coalesce(F.col("open") >= F.col("up_limit"), F.lit(False))


def limit_down() -> Column:
    return F.coalesce(F.col("open") <= F.col("down_limit"), F.lit(False))


def flags(panel: DataFrame) -> DataFrame:
    """The panel with adjusted close and all elementary flags."""
    return panel.withColumns({"adj_close": adj_close(), "listed_trade_days": listed_days(), "is_main_board": is_main_board(), "is_st": is_st(), "is_limit_up_at_open": limit_up(), "is_limit_down_at_open": limit_down()})


def eligible(config: SampleConfig) -> Column:
    """Base eligibility; three-valued where the listing date is unknown."""
    ok = ~F.coalesce(F.col("is_suspended"), F.lit(False)) & (F.col("total_mv") > 0) & (F.col("amount") >= config.min_amount) & (F.col("listed_trade_days") >= config.min_listing_days) & (F.col("listed_trade_days") > config.new_stock_window_days)
    if config.require_main_board:
        ok = ok & F.col("is_main_board")
    if config.exclude_st:
        ok = ok & ~F.col("is_st")
    return ok


def masked(flagged: DataFrame, config: SampleConfig) -> DataFrame:
    base = eligible(config)
    up, down = F.col("is_limit_up_at_open"), F.col("is_limit_down_at_open")
    return flagged.withColumns({"passes_base_filters": base, "can_buy": base & ~up, "can_sell": base & ~down, "is_tradable": base & ~up & ~down})


def forward_returns(df: DataFrame, horizons: Sequence[int], tradable: str | None = "is_tradable", price: str = "adj_close") -> DataFrame:
    """forward_{h}d: return from row t+1 to row t+h+1 of a code; with ``tradable``, NULL unless both rows are tradable."""
    w = by_code()
    out = {}
    for h in horizons:
        value = F.try_divide(F.lead(price, h + 1).over(w), F.lead(price, 1).over(w)) - 1
        if tradable:
            value = F.when(F.lead(tradable, 1).over(w) & F.lead(tradable, h + 1).over(w), value)
        out[f"forward_{h}d"] = value
    return df.withColumns(out)


def build_sample(panel: DataFrame, config: SampleConfig = SampleConfig(), apart: bool = False) -> tuple[DataFrame, DataFrame]:
    """(sample, skipped dates): masks and labels; dates with too few tradable rows are left out whole.

    ``apart``: tradable rows are counted apart, a row a date, and the counts broadcast, so that rows stay where they lie by code.
    """
    df = flags(panel)
    if config.start:
        df = df.filter(F.col("trade_date") >= config.start)
    if config.end:
        df = df.filter(F.col("trade_date") <= config.end)
    df = masked(df, config)
    tradable = F.sum(F.when(F.col("is_tradable"), 1).otherwise(0))
    if apart:
        counts = df.groupBy(F.col("trade_date").alias("_date")).agg(tradable.alias("tradable_count"))
        df = forward_returns(df, config.horizons)
        df = df.join(F.broadcast(counts), F.col("trade_date").eqNullSafe(F.col("_date"))).drop("_date")
    else:
        df = forward_returns(df, config.horizons).withColumn("tradable_count", tradable.over(Window.partitionBy("trade_date")))
    thin = F.col("tradable_count") < config.min_cross_section
    return df.filter(~thin), df.filter(thin).select("trade_date").distinct()


def legacy_panel(panel: DataFrame, start: str | None = None) -> DataFrame:
    """Rows with a close and a positive market value; unknown suspension is none; next row's limit-up flag."""
    df = panel.filter(F.col("close").isNotNull() & (F.col("total_mv") > 0))
    if start:
        df = df.filter(F.col("trade_date") >= start)
    df = df.withColumn("is_suspended", F.coalesce("is_suspended", F.lit(False))).withColumn("adj_close", adj_close()).withColumn("open_is_limit_up", limit_up())
    return df.withColumn("next_open_is_limit_up", F.coalesce(F.lead("open_is_limit_up", 1).over(by_code()), F.lit(False)))


def legacy_universe(df: DataFrame, factor: str, label: str, min_listing_days: int) -> DataFrame:
    """Ordinal listed days and the universe mask of the legacy evaluation."""
    df = df.withColumn("listed_rows", F.row_number().over(by_code()))
    return df.withColumn("universe", F.col("adj_close").isNotNull() & ~F.col("is_suspended") & (F.col("total_mv") > 0) & (F.col("listed_rows") >= min_listing_days) & F.col(factor).isNotNull() & F.col(label).isNotNull())


def as_of_members(df: DataFrame, members: DataFrame, date: str = "trade_date") -> DataFrame:
    """Rows whose code belongs to the latest snapshot on or before their date; nothing before the first snapshot.

    Dates find their snapshot by a running maximum over the union of both date lists (no join of all pairs).
    """
    snaps = members.select(F.col(date)).distinct()
    dates = df.select(date).distinct().withColumn("snapshot", F.lit(None).cast(df.schema[date].dataType)).unionByName(snaps.withColumn("snapshot", F.col(date)))
    dates = dates.groupBy(date).agg(F.max("snapshot").alias("snapshot"))
    # One row for each date: an ordered global window over dates, never over rows.
    dates = dates.withColumn("snapshot", F.max("snapshot").over(Window.orderBy(date).rowsBetween(Window.unboundedPreceding, 0))).filter("snapshot is not null")
    m = members.select(F.col(date).alias("snapshot"), "ts_code").distinct()
    return df.join(F.broadcast(dates), date).join(m, ["snapshot", "ts_code"], "left_semi").select(df.columns)


def exact_members(df: DataFrame, members: DataFrame, date: str = "trade_date") -> DataFrame:
    """Rows whose code and date are in the snapshots themselves."""
    return df.join(members.select(date, "ts_code").distinct(), [date, "ts_code"], "left_semi")

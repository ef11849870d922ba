"""Table schemas and conforming frames to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(text: str, doubles: str = "") -> T.StructType:
    number = set(doubles.split())
    return T.StructType([T.StructField(c, T.DoubleType() if c in number else T.StringType()) for c in text.split()])


#: The columns of each source table; numbers are doubles, all else is text (dates as yyyyMMdd).
TABLES: dict[str, T.StructType] = {
    "trade_cal": _schema("exchange cal_date is_open pretrade_date"),
    "stock_basic": _schema("ts_code symbol name area industry market list_date list_status delist_date act_name act_ent_type"),
    "daily": _schema("ts_code trade_date open high low close pre_close change pct_chg vol amount", "open high low close pre_close change pct_chg vol amount"),
    "adj_factor": _schema("ts_code trade_date adj_factor", "adj_factor"),
    "daily_basic": _schema(
        "ts_code trade_date close turnover_rate turnover_rate_f volume_ratio pe pe_ttm pb ps ps_ttm dv_ratio dv_ttm total_share float_share free_share total_mv circ_mv",
        "close turnover_rate turnover_rate_f volume_ratio pe pe_ttm pb ps ps_ttm dv_ratio dv_ttm total_share float_share free_share total_mv circ_mv",
    ),
    "suspend_d": _schema("ts_code trade_date suspend_type suspend_timing"),
    "stk_limit": _schema("ts_code trade_date up_limit down_limit", "up_limit down_limit"),
    "index_classify": _schema("index_code industry_name level industry_code src"),
    "index_member_all": _schema("l1_code l1_name l2_code l2_name l3_code l3_name ts_code con_code con_name in_date out_date is_new"),
    "index_weight": _schema("index_code con_code trade_date weight", "weight"),
}
LEDGER = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("endpoint", "trade_date", "status")]
    + [T.StructField("row_count", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in ("raw_path", "error_message")]
    + [T.StructField(c, T.TimestampType()) for c in ("started_at", "finished_at")]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Missing columns become NULL, known ones take the schema's type, NaN becomes NULL; further columns stay."""
    have = dict(df.dtypes)

    def column(f: T.StructField):
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f.name)
        if have[f.name] in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        return c.cast(f.dataType).alias(f.name)

    return df.select(*[column(f) for f in schema], *[c for c in df.columns if c not in schema.fieldNames()])


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both with the columns of both; what one lacks is NULL; a type that differs becomes text."""
    a, b = dict(old.dtypes), dict(new.dtypes)
    clash = [c for c in a if c in b and a[c] != b[c]]
    text = lambda df: df.withColumns({c: F.col(c).cast("string") for c in clash}) if clash else df
    return text(old).unionByName(text(new), allowMissingColumns=True)


def require(df: DataFrame, needed: Sequence[str], optional: Sequence[str] = ()) -> list[str]:
    """The needed columns (missing ones are an error) and those optional ones that are there."""
    if missing := [c for c in needed if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return [*needed, *[c for c in optional if c in df.columns]]

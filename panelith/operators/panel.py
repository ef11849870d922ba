"""Panel construction: star joins, interval membership with fallback, suspension flags, one row for each key, range rebuild."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["trade_date", "ts_code"]


def star_join(prices: DataFrame, master: DataFrame | None, facts: Sequence[DataFrame]) -> DataFrame:
    """Prices left-joined to the master by code and to each daily table by date and code; clashing columns keep the left side's."""
    out = prices if master is None else prices.join(_new(master, prices, ["ts_code"]), "ts_code", "left")
    for fact in facts:
        out = out.join(_new(fact, out, KEY), KEY, "left")
    return out


def _new(right: DataFrame, left: DataFrame, keys: list[str]) -> DataFrame:
    return right.select(*keys, *[c for c in right.columns if c not in left.columns])


def suspension_flags(events: DataFrame) -> DataFrame:
    """One row for each key; its distinct types in order, joined by commas."""
    return events.groupBy(*KEY).agg(F.concat_ws(",", F.sort_array(F.collect_set("suspend_type"))).alias("suspend_types")).withColumn("is_suspended", F.lit(True))


def interval_join(panel: DataFrame, history: DataFrame, columns: Sequence[str], narrow: bool = True) -> DataFrame:
    """Left join to the membership rows whose half-open interval holds the date.

    The equi key is the code; ``narrow`` adds the year to it by listing the years an interval covers, which keeps the
    rows that meet by code few when codes have long histories.  Neither form joins all pairs.
    """
    h = history.select(F.col("ts_code").alias("h_code"), *[F.col(c).alias(f"h_{c}") for c in columns], "in_date", "out_date", "is_new")
    holds = (F.col("trade_date") >= F.col("in_date")) & (F.coalesce(F.col("out_date"), F.lit("")).isin("") | (F.col("trade_date") < F.col("out_date")))
    if not narrow:
        return panel.join(h, (F.col("ts_code") == F.col("h_code")) & holds, "left")
    span = panel.select(F.substring("trade_date", 1, 4).cast("int").alias("y")).agg(F.min("y").alias("first"), F.max("y").alias("last")).first()
    first, last = F.lit(span["first"] or 0), F.lit(span["last"] or 0)  # intervals matter inside the panel's years only
    year = lambda c: F.expr(f"try_cast(substring({c}, 1, 4) AS int)")
    begin, end = F.greatest(first, F.coalesce(year("in_date"), first)), F.least(last, F.coalesce(year("out_date"), last))
    h = h.withColumn("h_year", F.explode(F.when(begin <= end, F.sequence(begin, end)).otherwise(F.array().cast("array<int>"))))
    return panel.join(h, (F.col("ts_code") == F.col("h_code")) & (F.substring("trade_date", 1, 4).cast("int") == F.col("h_year")) & holds, "left").drop("h_year")


def first_membership(history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each code the earliest value of each column that is not NULL."""
    first = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("in_date"))).alias(f"first_{c}") for c in columns]
    return history.groupBy("ts_code").agg(F.min("in_date").alias("first_in_date"), *first)


def with_fallback(joined: DataFrame, first: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact membership, else the earliest one when the date precedes it."""
    j = joined.join(first, "ts_code", "left")
    early = F.col("trade_date") < F.col("first_in_date")
    return j.select("*", *[F.coalesce(F.col(f"h_{c}"), F.when(early, F.col(f"first_{c}"))).alias(f"member_{c}") for c in columns]).drop(*[f"h_{c}" for c in columns], *[f"first_{c}" for c in columns], "first_in_date", "h_code")


def listed_only(panel: DataFrame) -> DataFrame:
    """Drops rows before their listing; rows without a listing date stay."""
    return panel.filter(F.col("list_date").isNull() | (F.col("list_date") == "") | (F.col("list_date") <= F.col("trade_date")))


def one_per_key(panel: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The preferred row of each key: current membership first, then the latest start, then the latest end."""
    order: list[Column] = [F.when(F.col("is_new") == "Y", 0).otherwise(1), F.desc_nulls_last("in_date"), F.desc_nulls_last("out_date"), *[F.col(c) for c in tiebreak]]
    return panel.withColumn("_pick", F.row_number().over(Window.partitionBy(*KEY).orderBy(*order))).filter("_pick = 1").drop("_pick")


def check_range(start: str | None, end: str | None) -> None:
    """Both ends or none, as yyyyMMdd, in order."""
    if (start is None) != (end is None):
        raise ValueError("start and end must be provided together")
    for value in (start, end):
        if value is not None and not re.fullmatch(r"\d{8}", value):
            raise ValueError(f"not a yyyyMMdd date: {value}")
    if start is not None and start > end:
        raise ValueError("start is after end")


def in_range(df: DataFrame, start: str | None, end: str | None, column: str = "trade_date") -> DataFrame:
    check_range(start, end)
    return df if start is None else df.filter(F.col(column).between(start, end))


def build_panel(
    prices: DataFrame, master: DataFrame, facts: Sequence[DataFrame], suspensions: DataFrame, history: DataFrame, columns: Sequence[str] = ("l1_name",), start: str | None = None, end: str | None = None
) -> DataFrame:
    """The whole wide panel for a date range (or all dates): joins, membership with fallback, listing filter, one row for each key."""
    base = star_join(in_range(prices, start, end), master, [in_range(f, start, end) for f in facts] + [suspension_flags(in_range(suspensions, start, end))])
    base = listed_only(base.withColumn("is_suspended", F.coalesce("is_suspended", F.lit(False))))
    joined = with_fallback(interval_join(base, history, columns), first_membership(history, columns), columns)
    return one_per_key(joined, [f"member_{c}" for c in columns]).drop("in_date", "out_date", "is_new")


def schema_changed(new: DataFrame, stored_columns: Sequence[str]) -> bool:
    """Whether a stored panel must be rebuilt whole because its columns differ."""
    return set(new.columns) != set(stored_columns)

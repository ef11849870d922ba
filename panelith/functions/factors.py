"""Factor builders: column expressions over one window by code, a registry, and the plug-in surface."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIRECTIONS = {"positive": 1, "negative": -1}


def by_code() -> Window:
    return Window.partitionBy("ts_code").orderBy("trade_date")


def last(n: int):
    return by_code().rowsBetween(-(n - 1), 0)


def momentum(window: int, price: str = "adj_close") -> Column:
    return F.try_divide(F.col(price), F.lag(price, window).over(by_code())) - 1


def returns(price: str = "adj_close") -> Column:
    return momentum(1, price)


def full(x: Column, n: int, value: Column) -> Column:
    """``value`` where the last n rows all have ``x``."""
    return F.when(F.count(x).over(last(n)) >= n, value)


def rolling_volatility(window: int, ret: str = "ret_1") -> Column:
    """Sample deviation of the last returns, NULL until there are ``window`` of them."""
    return full(F.col(ret), window, F.stddev_samp(ret).over(last(window)))


def rolling_mean(x: Column, n: int) -> Column:
    return full(x, n, F.avg(x).over(last(n)))


#: The simple technical baselines; amounts, amplitudes and returns come from the panel's own columns.
TECHNICAL: dict[str, tuple[Callable[[], Column], str]] = {
    "reversal_1d": (lambda: momentum(1), "negative"),
    "reversal_3d": (lambda: momentum(3), "negative"),
    "reversal_5d": (lambda: momentum(5), "negative"),
    "momentum_20d": (lambda: momentum(20), "positive"),
    "momentum_60d": (lambda: momentum(60), "positive"),
    "volatility_20d": (lambda: rolling_volatility(20), "negative"),
    "turnover_5d": (lambda: rolling_mean(F.col("turnover_rate"), 5), "negative"),
    "turnover_20d": (lambda: rolling_mean(F.col("turnover_rate"), 20), "negative"),
    "volume_ratio_5_20": (lambda: F.try_divide(rolling_mean(F.col("vol"), 5), rolling_mean(F.col("vol"), 20)), "negative"),
    "amount_ratio_5_20": (lambda: F.try_divide(rolling_mean(F.col("amount"), 5), rolling_mean(F.col("amount"), 20)), "negative"),
    "amplitude_20d": (lambda: rolling_mean(F.try_divide(F.col("high") - F.col("low"), F.col("pre_close")), 20), "negative"),
    "illiquidity_20d": (lambda: rolling_mean(F.try_divide(F.abs("ret_1"), F.col("amount")), 20), "positive"),
}


@dataclass(frozen=True)
class FactorSpec:
    factor_id: str
    implementation: str
    params: dict = field(default_factory=dict)
    direction: str = "positive"
    fields: tuple[str, ...] = ("close", "adj_factor")


BUILTIN: dict[str, Callable[..., Column]] = {"momentum_return": momentum, "short_term_return": momentum, "rolling_volatility": rolling_volatility}

#: The registered factors.
REGISTRY = (
    FactorSpec("momentum_20d_v1", "builtin:momentum_return", {"window": 20}, "positive"),
    FactorSpec("reversal_5d_v1", "builtin:short_term_return", {"window": 5}, "negative"),
    FactorSpec("volatility_20d_v1", "builtin:rolling_volatility", {"window": 20}, "negative"),
)


def validate(registry: Iterable[FactorSpec], known_fields: Sequence[str]) -> None:
    """Rejects repeated ids, unknown directions, implementations and input fields."""
    seen: set[str] = set()
    for spec in registry:
        if spec.factor_id in seen:
            raise ValueError(f"duplicate factor_id: {spec.factor_id}")
        seen.add(spec.factor_id)
        if spec.direction not in DIRECTIONS:
            raise ValueError(f"{spec.factor_id}: unknown direction {spec.direction}")
        if spec.implementation.removeprefix("builtin:") not in BUILTIN:
            raise ValueError(f"{spec.factor_id}: unknown implementation {spec.implementation}")
        if missing := set(spec.fields) - set(known_fields):
            raise ValueError(f"{spec.factor_id}: unknown fields {sorted(missing)}")


def registered(registry: Sequence[FactorSpec] = REGISTRY) -> dict[str, Column]:
    """The column of each registered factor."""
    return {s.factor_id: BUILTIN[s.implementation.removeprefix("builtin:")](**s.params) for s in registry}


def compute(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """All factors in one pass over one sort by code, long: trade_date, ts_code, factor_id, factor_value."""
    wide = df.withColumn("ret_1", returns()).select("trade_date", "ts_code", *[c.alias(k) for k, c in columns.items()])
    return wide.unpivot(["trade_date", "ts_code"], list(columns), "factor_id", "factor_value")


def run_registry(df: DataFrame, registry: Sequence[FactorSpec] = REGISTRY) -> DataFrame:
    """Every registered factor as one long result, with the sign of its direction."""
    validate(registry, df.columns)
    signs = F.create_map(*[F.lit(x) for s in registry for x in (s.factor_id, DIRECTIONS[s.direction])])
    long = compute(df, registered(registry))
    return long.withColumn("direction", signs[F.col("factor_id")])


def run_plugin(df: DataFrame, factor: Callable[..., DataFrame | Column], name: str, **kwargs) -> DataFrame:
    """A user's factor: a function of the frame that returns a frame with column ``name``, or a function that returns a column."""
    made = factor(df, **kwargs)
    out = df.withColumn(name, made) if isinstance(made, Column) else made
    if name not in out.columns:
        raise ValueError(f"plug-in gave no column {name}")
    return out


def checked_values(made, rows: int, name: str, where: str) -> pa.Array:
    """A plug-in's values as doubles; another number of them, or anything but numbers, is an error.  NaN becomes NULL."""
    values = made.combine_chunks() if isinstance(made, pa.ChunkedArray) else made if isinstance(made, pa.Array) else pa.array(made, from_pandas=True)
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks() if values.num_chunks else pa.array([], pa.float64())
    if len(values) != rows:
        raise ValueError(f"plug-in {name} gave {len(values)} values for {rows} rows {where}")
    kind = values.type
    if not (pa.types.is_integer(kind) or pa.types.is_floating(kind) or pa.types.is_null(kind) or pa.types.is_decimal(kind)):
        raise ValueError(f"plug-in {name} gave {kind} values {where}, not numbers")
    values = values.cast(pa.float64())
    return pc.if_else(pc.fill_null(pc.is_nan(values), False), pa.scalar(None, pa.float64()), values)


def _with_factor(df: DataFrame, name: str) -> T.StructType:
    if name in df.columns:
        raise ValueError(f"the frame has a column {name} already")
    return T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])


def run_code_plugin(df: DataFrame, factor: Callable[..., pa.Array | np.ndarray], name: str, **kwargs) -> DataFrame:
    """A user's factor over the history of a code: ``factor(table, **kwargs)`` gets the rows of one code as an Arrow table
    in order of date and returns a value for each.  ``df`` comes back with column ``name``; a code's history is one task's.
    """
    schema = _with_factor(df, name)
    at = df.columns.index("ts_code")

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("trade_date")
        values = checked_values(factor(table, **kwargs), table.num_rows, name, f"of code {table.column(at)[0].as_py()}")
        return table.append_column(name, values)

    return df.groupBy("ts_code").applyInArrow(work, schema)


def run_row_plugin(df: DataFrame, factor: Callable[..., pa.Array | np.ndarray], name: str, **kwargs) -> DataFrame:
    """A user's factor of single rows: ``factor(batch, **kwargs)`` gets an Arrow batch and returns a value for each row; nothing is shuffled."""
    schema = _with_factor(df, name)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = checked_values(factor(batch, **kwargs), batch.num_rows, name, "of a batch")
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])

    return df.mapInArrow(work, schema)


def numpy_momentum(table: pa.Table, window: int, price: str = "adj_close") -> np.ndarray:
    """Momentum in numpy, as a plug-in by code would write it."""
    x = table.column(price).to_numpy().astype(float)
    out = np.full(len(x), np.nan)
    if len(x) > window:
        base = np.where(x[:-window] == 0, np.nan, x[:-window])
        out[window:] = x[window:] / base - 1
    return out

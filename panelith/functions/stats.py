"""Formulas shared by the operators: buckets, ranks, safe correlation and moments, compounding."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

TRADING_DAYS = 252


def cut(x: Column, digits: int) -> Column:
    """``x`` rounded half up by plain double arithmetic, so that any engine gives the same bits."""
    scale = float(10**digits)
    return F.floor(x * scale + F.lit(0.5)) / F.lit(scale)


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL where b is 0."""
    return F.try_divide(a, b)


def bucket(place: Column, n: Column, q: int) -> Column:
    """Bucket 1..q of a row with the given place (from 1) among n: linear-interpolated quantile edges, right-closed."""
    out: Column = F.lit(1)
    for p in np.linspace(0, 1, q + 1)[1:-1]:
        out = out + (place > F.lit(1.0) + F.lit(float(p * 100 / 100)) * (n - 1)).cast("int")
    return F.when(n >= q, out)


def average_rank(x: Column, by: Sequence[str], name: str) -> Column:
    """Rank of ``x`` (column ``name``) within ``by``, ties share their mean rank."""
    w = Window.partitionBy(*by)
    same = Window.partitionBy(*by, name)
    return F.rank().over(w.orderBy(x)) + (F.count(F.lit(1)).over(same) - 1) / F.lit(2.0)


def correlation(x: str, y: str) -> Column:
    """Pearson correlation, NULL where either side is constant."""
    return ratio(F.covar_pop(x, y), F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0)))


def skew(x: str) -> Column:
    """Bias-corrected skewness; needs three values."""
    n = F.count(x)
    return F.when(n >= 3, F.sqrt((n * (n - 1)).cast("double")) / F.when(n >= 3, n - 2) * F.skewness(x))


def kurtosis(x: str) -> Column:
    """Bias-corrected excess kurtosis; needs four values."""
    n = F.count(x)
    return F.when(n >= 4, (n - 1) / F.when(n >= 4, (n - 2) * (n - 3)).cast("double") * ((n + 1) * F.kurtosis(x) + 6))


def t_stat(x: str) -> Column:
    """Mean over its standard error, with the population deviation."""
    s = F.stddev_pop(x)
    return F.when(s > 0, ratio(F.avg(x), s / F.sqrt(F.count(x).cast("double"))))


def upto(by: Sequence[str], order: str) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def compounded(growth: Column, window: WindowSpec) -> Column:
    """Running product of growth factors; NULL growth counts as 1."""
    return F.product(F.coalesce(growth, F.lit(1.0))).over(window)

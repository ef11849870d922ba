"""Every registered query of the panel operators and its DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import queries as q

flagship = q.flagship


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(q.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(q.SQL)

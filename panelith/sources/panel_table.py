"""A stored panel: partitioned by year, bucketed by code, sorted by code and date within a bucket.

A date range reads its years alone, whatever else is stored.  Windows, joins and aggregates by code read whole buckets
and shuffle nothing.  Years and not dates are the partitions, as a bucket of one date would be a file of a few rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import Store, scratch

YEAR = "panel_year"
BUCKET_ROWS, SMALL_ROWS, MOST_BUCKETS = 1_000_000, 50_000, 8192  # source rows a bucket at most, and at least while tasks are idle


class PanelTable:
    """A catalog table over files at ``path``; ``path`` must be a folder that all nodes reach."""

    def __init__(self, spark: SparkSession, name: str, path: str) -> None:
        self.spark, self.name, self.path = spark, name, path

    def exists(self) -> bool:
        """Whether the table was written whole: in the catalog, and its files end with the writer's mark."""
        fs, p = Store(self.spark, self.path)._fs(f"{self.path}/_SUCCESS")
        return self.spark.catalog.tableExists(self.name) and fs.exists(p)

    def write(self, panel: DataFrame, buckets: int, dealt: bool = False) -> DataFrame:
        """Replaces the table; one file for each year and bucket.  ``dealt``: rows lie by code in ``buckets`` tasks already."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        rows = panel.withColumn(YEAR, F.substring("trade_date", 1, 4))
        rows = rows if dealt else rows.repartition(buckets, "ts_code")
        rows.write.mode("overwrite").partitionBy(YEAR).bucketBy(buckets, "ts_code").sortBy("ts_code", "trade_date").option("path", self.path).saveAsTable(self.name)
        return self.read()

    def read(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """Rows of [start, end] (yyyyMMdd), or all; the years are pruned before any file is opened."""
        df = self.spark.table(self.name)
        if start is not None:
            df = df.filter(F.col(YEAR) >= start[:4]).filter(F.col("trade_date") >= start)
        if end is not None:
            df = df.filter(F.col(YEAR) <= end[:4]).filter(F.col("trade_date") <= end)
        return df.drop(YEAR)

    def replace_years(self, panel: DataFrame) -> None:
        """The years that ``panel`` has rows of become its rows; the others stay.  Columns must be those stored."""
        stored = self.spark.table(self.name)
        rows = panel.withColumn(YEAR, F.substring("trade_date", 1, 4)).select(stored.columns)
        conf = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(conf)
        self.spark.conf.set(conf, "dynamic")
        try:
            rows.write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(conf, before)

    def last_dates(self, date: str, n: int) -> DataFrame:
        """Rows of the last ``n`` distinct dates up to ``date``; only the years of these dates are read."""
        dates = [r[0] for r in self.read(end=date).select("trade_date").distinct().orderBy(F.desc("trade_date")).limit(n).collect()]  # n names
        return self.read(min(dates), max(dates)) if dates else self.read(end=date).limit(0)


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """A digest of the names, sizes and times of the files behind ``paths``."""
    found = []
    for path in paths:
        fs, p = Store(spark, path)._fs(path)
        found += [f"{s.getPath()} {s.getLen()} {s.getModificationTime()}" for s in (fs.globStatus(p) or [])]
        found += [f"{s.getPath()} {s.getLen()} {s.getModificationTime()}" for s in (fs.listStatus(p) if fs.exists(p) else [])]
    return hashlib.sha256("\n".join(found).encode()).hexdigest()[:16]


def built(spark: SparkSession, kind: str, sources: Sequence[str], build: Callable[..., DataFrame], dealt: bool = False) -> PanelTable:
    """The stored panel ``kind`` of the given source files: built by the first query that needs it, read by the others.

    Where the source files or the shared folder change, it is built again.  ``dealt``: ``build`` takes the number of
    buckets and deals its rows over them itself.
    """
    name = f"{kind}_{fingerprint(spark, sources)}"
    known = spark.catalog.tableExists(name)
    path = f"{scratch(spark)}" if not known else spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first().data_type
    table = PanelTable(spark, name, path)
    if not table.exists():
        rows = spark.read.parquet(sources[0]).count()
        buckets = max(1, min(MOST_BUCKETS, max(-(-rows // BUCKET_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))))
        table.write(build(buckets) if dealt else build(), buckets, dealt)
    return table

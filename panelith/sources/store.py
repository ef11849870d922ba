"""Partitioned Parquet stores: overwrite, upserts by key or partition, an append-only ledger, resumable loads.

An upsert rewrites only the partitions it touches.  Results that read the store they replace are written to a staging
folder first.  A whole table is swapped by renaming: the old one steps aside, the new one takes its place, then the old
one goes.  Only writers rename: where a driver is lost in between, readers take the old one where it stands, and the next
writer puts it back.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from . import landed
from .schemas import LEDGER, TABLES, conform


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share: under spark.checkpoint.dir; where that is unset, a temporary one in local runs only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/store-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back, for frames that many results use."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Store:
    """Tables below one folder, each a folder of Parquet, perhaps partitioned."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _there(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _rename(self, old: str, new: str) -> None:
        fs, p = self._fs(old)
        if not fs.rename(p, self._fs(new)[1]):
            raise OSError(f"could not rename {old} to {new}")

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def _standing(self, table: str) -> str:
        """Where the table's files are: aside while a swap is under way or was cut short."""
        path = self.path(table)
        return f"{path}.old" if not self._there(path) and self._there(f"{path}.old") else path

    def exists(self, table: str) -> bool:
        return self._there(self._standing(table))

    def read(self, table: str) -> DataFrame:
        """The table; a missing one is an error.  Partition values stay text."""
        path = self._standing(table)
        if not self._there(path):
            raise FileNotFoundError(path)
        conf = "spark.sql.sources.partitionColumnTypeInference.enabled"
        before = self.spark.conf.get(conf)
        self.spark.conf.set(conf, "false")
        try:
            return self.spark.read.option("mergeSchema", "true").parquet(path)
        finally:
            self.spark.conf.set(conf, before)

    def write(self, table: str, df: DataFrame, by: Sequence[str] = ()) -> None:
        """Replaces the whole table: staged, then swapped in by renaming; at no moment are both gone."""
        path = self.path(table)
        staged, old = f"{path}.staged-{uuid.uuid4().hex}", f"{path}.old"
        (df.write.partitionBy(*by) if by else df.write).parquet(staged)
        if not self._there(path) and self._there(old):  # a swap was cut short
            self._rename(old, path)
        if self._there(path):
            self._delete(old)
            self._rename(path, old)
        fs, to = self._fs(path)
        fs.mkdirs(to.getParent())
        self._rename(staged, path)
        self._delete(old)

    def write_partitions(self, table: str, df: DataFrame, by: Sequence[str]) -> None:
        """Overwrites the partitions that ``df`` has rows for; others stay.

        Rows of a partition meet first, so that it gets one file and not one of each task; a large one goes over several tasks.
        """
        df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(self.path(table))

    def drop_partitions(self, table: str, values: Sequence[dict[str, str]]) -> None:
        for v in values:
            self._delete("/".join([self.path(table), *[f"{k}={x}" for k, x in v.items()]]))

    def upsert_partition(self, table: str, df: DataFrame, column: str, value: str) -> None:
        """One partition becomes the batch; an empty batch still deletes it."""
        if df.isEmpty():
            self.drop_partitions(table, [{column: value}])
        else:
            self.write_partitions(table, df.withColumn(column, F.lit(value)), [column])

    def replace_range(self, table: str, df: DataFrame, start: str, end: str, column: str = "trade_date") -> int:
        """Partitions of [start, end] become those of ``df``; partitions in range that it lacks go.  Returns its row count."""
        if self.exists(table):
            old = self.read(table).select(column).distinct().filter(F.col(column).between(start, end))
            gone = old.join(df.select(column).distinct(), column, "left_anti").collect()  # partition names only
            self.drop_partitions(table, [{column: r[0]} for r in gone])
        self.write_partitions(table, df, [column])
        return self.read(table).filter(F.col(column).between(start, end)).count()

    def columns(self, table: str) -> set[str]:
        """All columns that the footers of the stored files name, and the partition column."""
        return set(self.read(table).columns)

    def rebuild_range(self, table: str, build: Callable[[str | None, str | None], DataFrame], start: str, end: str, column: str = "trade_date") -> tuple[int, bool]:
        """``build(start, end)`` replaces the stored range; where its columns are not those stored, ``build(None, None)`` replaces the whole table.

        Returns the number of stored rows in the range, and whether all was rebuilt.
        """
        part = build(start, end)
        whole = self.exists(table) and set(part.columns) != self.columns(table)
        if whole:
            self.write(table, build(None, None), [column])
        elif self.exists(table):
            return self.replace_range(table, part, start, end, column), False
        else:
            self.write(table, part, [column])
        return self.read(table).filter(F.col(column).between(start, end)).count(), whole

    def upsert(self, table: str, batch: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> None:
        """Rows of the batch replace stored rows with their keys; an empty batch changes nothing.

        With ``by`` (part of the keys) only the partitions of the batch are read and rewritten.
        """
        if not self.exists(table):
            self.write(table, batch, by)
        elif not batch.isEmpty():
            stored = self.read(table)
            if not by:
                self.write(table, upserted(stored, batch, keys))
                return
            for c in by:
                batch = batch.withColumn(c, F.col(c).cast("string"))
            touched = stored.join(F.broadcast(batch.select(*by).distinct()), list(by), "left_semi")
            staged = f"{self.path(table)}.staged-{uuid.uuid4().hex}"
            upserted(touched, batch, keys).write.parquet(staged)
            self.write_partitions(table, self.spark.read.parquet(staged), by)
            self._delete(staged)

    # --- ledger ---

    def record(self, rows: DataFrame) -> None:
        conform(rows, LEDGER).write.mode("append").parquet(self.path("ingest_status"))

    def ledger(self) -> DataFrame:
        try:
            return latest(self.spark.read.schema(LEDGER).parquet(self.path("ingest_status")), ["endpoint", "trade_date"], "finished_at")
        except AnalysisException:
            return self.spark.createDataFrame([], LEDGER)

    def loaded(self, endpoint: str) -> DataFrame:
        """trade_date of partitions that the ledger calls done and whose folder is there."""
        fs, p = self._fs(self.path(endpoint))
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        there = self.spark.createDataFrame([(n.split("=", 1)[1],) for n in names if n.startswith("trade_date=")], "trade_date string")
        return self.ledger().filter((F.col("endpoint") == endpoint) & (F.col("status") == "success")).select("trade_date").join(there, "trade_date", "left_semi")

    def load_history(self, frames: dict[str, DataFrame], dates: DataFrame, force: bool = False) -> DataFrame:
        """Loads each endpoint's open partitions from its landed rows (with trade_date), all dates of an endpoint in one job.

        A partition that has no landed rows is recorded as failed and stops no other; one whose ledger says success but
        whose folder is gone is loaded again.  Returns endpoint, rows, skipped, failed.
        """
        days = dates.select("trade_date").distinct()
        lines, skipped = [], []
        for name, frame in frames.items():
            own, done = self._due(name, days, force)
            self.write_partitions(name, frame.join(F.broadcast(own), "trade_date", "left_semi"), ["trade_date"])
            count = self.read(name).select("trade_date").join(F.broadcast(own), "trade_date", "left_semi").groupBy("trade_date").agg(F.count("*").alias("row_count"))
            found = own.join(count, "trade_date", "left").select("trade_date", F.when(F.col("row_count").isNull(), "no landed rows").alias("error"), "row_count")
            lines.append(found.select(F.lit(name).alias("endpoint"), "*"))
            skipped.append(done.select(F.lit(name).alias("endpoint")))
        return self._record_load(lines, skipped, list(frames))

    def load_files(self, landing: str, endpoints: Sequence[str], dates: DataFrame, force: bool = False, kind: str = "csv") -> DataFrame:
        """Loads open partitions from landed files: ``landing``/endpoint/day=yyyyMMdd/ holds the files of one.

        A file that is cut short, unreadable, of the wrong columns or with values that are none of their types, or with
        rows of another date, makes its own partition fail, with the reason in the ledger; nothing of that partition is
        written, what was stored of it stays, and all other partitions load.  All files of an endpoint are read in one
        job, once.  ``kind`` is csv (with a header, perhaps compressed) or parquet.  Returns endpoint, rows, skipped, failed.
        """
        days = dates.select("trade_date").distinct()
        lines, skipped = [], []
        for name in endpoints:
            own, done = self._due(name, days, force)
            files = landed.files(self.spark, f"{landing}/{name}", kind).join(F.broadcast(own), "trade_date", "left_semi")
            rows = stored(landed.rows(self.spark, f"{landing}/{name}", TABLES[name], kind).join(F.broadcast(own), "trade_date", "left_semi"))  # parsed once, all columns
            judged = stored(landed.judged(files, rows))
            by_date = judged.groupBy("trade_date").agg(F.min_by("error", F.when(F.col("error").isNotNull(), F.col("path"))).alias("error"), F.sum("n_rows").alias("row_count"))
            found = stored(own.join(by_date, "trade_date", "left").select("trade_date", F.coalesce("error", F.when(F.col("row_count").isNull(), "no landed file, or an empty one")).alias("error"), "row_count"))
            good = found.filter("error is null").select("trade_date")
            if not good.isEmpty():
                self.write_partitions(name, rows.join(F.broadcast(good), "trade_date", "left_semi").select(*TABLES[name].fieldNames()), ["trade_date"])
            lines.append(found.select(F.lit(name).alias("endpoint"), "*"))
            skipped.append(done.select(F.lit(name).alias("endpoint")))
        return self._record_load(lines, skipped, endpoints)

    def _due(self, endpoint: str, days: DataFrame, force: bool) -> tuple[DataFrame, DataFrame]:
        """(dates to load, dates to skip), written before the load changes what they follow from."""
        done = days.join(self.loaded(endpoint), "trade_date", "left_semi") if not force else days.limit(0)
        done = stored(done)
        return stored(days.join(done, "trade_date", "left_anti")), done

    def _record_load(self, lines: Sequence[DataFrame], skipped: Sequence[DataFrame], endpoints: Sequence[str]) -> DataFrame:
        """Writes the ledger's lines (endpoint, trade_date, error, row_count) once; endpoint, rows, skipped, failed."""
        now = F.current_timestamp()
        path = F.concat(F.lit(f"{self.root}/"), "endpoint")
        bad = F.col("error").isNotNull()
        status = F.when(bad, "failed").otherwise("success").alias("status")
        due = stored(reduce(DataFrame.unionByName, lines).withColumn("row_count", F.when(bad, 0).otherwise(F.coalesce("row_count", F.lit(0))).cast("long")))
        self.record(due.select("endpoint", "trade_date", status, "row_count", path.alias("raw_path"), F.col("error").alias("error_message"), now.alias("started_at"), now.alias("finished_at")))
        sums = due.groupBy("endpoint").agg(F.sum("row_count").alias("rows"), F.count(F.when(bad, 1)).alias("failed"))
        over = reduce(DataFrame.unionByName, skipped).groupBy("endpoint").agg(F.count("*").alias("skipped"))
        names = self.spark.createDataFrame([(e,) for e in endpoints], "endpoint string")
        return names.join(sums, "endpoint", "left").join(over, "endpoint", "left").select("endpoint", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "skipped", "failed")])

    # --- evaluation results ---

    def write_evaluation(self, results: dict[str, DataFrame]) -> None:
        """Upserts result frames by their keys (RESULTS); other runs and factors stay."""
        for table, df in results.items():
            self.upsert(table, df, RESULTS[table], ["factor_id"])


#: The evaluation result tables and their keys.
RESULTS = {
    "evaluation_runs": ("factor_id", "run_id"),
    "evaluation_metrics": ("factor_id", "run_id", "metric"),
    "evaluation_quantiles": ("factor_id", "run_id", "quantile"),
    "evaluation_period_metrics": ("factor_id", "run_id", "period", "metric"),
}


def upserted(stored: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows without the batch's keys, and the batch."""
    return stored.join(batch.select(*keys).distinct(), list(keys), "left_anti").unionByName(batch, allowMissingColumns=True)


def latest(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row of each key: a grouped maximum, so a key with many rows is combined before it moves."""
    rest = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.coalesce(F.col(order).cast("string"), F.lit("")), *[F.col(c).cast("string") for c in rest])).alias("_r"))
    return g.select(*keys, "_r.*").select(df.columns)


def merge_extracts(parts: Sequence[DataFrame], keys: Sequence[str] | None = None) -> DataFrame:
    """Union of extracts; with keys the first extract's row of each key stays, without them repeated rows go."""
    tagged = [p.withColumn("_from", F.lit(i)) for i, p in enumerate(parts)]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    if keys is None:
        return out.drop("_from").dropDuplicates()
    rest = [c for c in out.columns if c not in (*keys, "_from")]
    w = Window.partitionBy(*keys).orderBy("_from", *rest)
    return out.withColumn("_i", F.row_number().over(w)).filter("_i = 1").drop("_i", "_from")


def load_plan(dates: DataFrame, endpoints: Sequence[str], done: DataFrame) -> DataFrame:
    """trade_date and endpoint still to load."""
    due = dates.select("trade_date", F.explode(F.array(*[F.lit(e) for e in endpoints])).alias("endpoint"))
    return due.join(done.select("trade_date", "endpoint").distinct(), ["trade_date", "endpoint"], "left_anti")


def last_open_dates(calendar: DataFrame, n: int) -> DataFrame:
    """The last n open dates (the count is the feature); fewer are an error."""
    dates = calendar.filter("is_open = '1'").select(F.col("cal_date").alias("trade_date")).distinct().orderBy(F.desc("trade_date")).limit(n)
    if dates.count() < n:
        raise ValueError(f"fewer than {n} open dates")
    return dates


def years_back(end: str, years: int) -> tuple[str, str]:
    """(start, end) of the range from the same day ``years`` years before; from 29 February where that day is missing, 365 * years days."""
    last = datetime.strptime(end, "%Y%m%d")
    try:
        first = last.replace(year=last.year - years)
    except ValueError:
        first = last - timedelta(days=365 * years)
    return first.strftime("%Y%m%d"), end


def month_chunks(spark: SparkSession, start: str, end: str) -> DataFrame:
    """start and end (yyyyMMdd) of each calendar month's share of a range."""
    one = spark.range(1).select(F.to_date(F.lit(start), "yyyyMMdd").alias("a"), F.to_date(F.lit(end), "yyyyMMdd").alias("b"))
    m = one.select("a", "b", F.explode(F.sequence(F.trunc("a", "MM"), F.col("b"), F.expr("interval 1 month"))).alias("m"))
    return m.select(F.date_format(F.greatest("m", "a"), "yyyyMMdd").alias("start"), F.date_format(F.least(F.last_day("m"), "b"), "yyyyMMdd").alias("end"))


def chunk_summary(log: DataFrame) -> DataFrame:
    """By month: dates, rows, failed and succeeded partitions."""
    return log.groupBy(F.substring("trade_date", 1, 6).alias("month")).agg(F.countDistinct("trade_date").alias("n_dates"), F.count(F.when(F.col("status") == "success", 1)).alias("n_success"), F.count(F.when(F.col("status") == "failed", 1)).alias("n_failed"))


def to_long(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("trade_date", "ts_code")) -> DataFrame:
    if missing := [c for c in (*keys, *columns) if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*keys, *columns).unpivot(list(keys), list(columns), "factor_id", "factor_value")


def to_wide(df: DataFrame, ids: Sequence[str], value: str = "factor_value", keys: Sequence[str] = ("trade_date", "ts_code")) -> DataFrame:
    return df.groupBy(*keys).pivot("factor_id", list(ids)).agg(F.first(value))


def coverage(panel: DataFrame) -> DataFrame:
    return panel.agg(F.min("trade_date").alias("min_date"), F.max("trade_date").alias("max_date"), F.count("*").alias("n_rows"))


def scan_window(panel: DataFrame, date: str, days: int) -> DataFrame:
    """Rows of the last ``days`` distinct dates up to ``date``."""
    dates = panel.select("trade_date").filter(F.col("trade_date") <= date).distinct().orderBy(F.desc("trade_date")).limit(days)
    return panel.join(F.broadcast(dates), "trade_date", "left_semi")


def library(summaries: DataFrame) -> DataFrame:
    """The latest summary of each factor."""
    return latest(summaries, ["factor_id"], "evaluated_at")

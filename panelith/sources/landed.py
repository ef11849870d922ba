"""Landed files, one folder a partition: which are there, their rows, and which of them must not be loaded.

Rows are read in one job whatever the files hold: what does not parse is kept apart by the reader, and a file that breaks
off ends there.  Whether a file was read whole is then judged by file: by its own record of its length where the format
has one (a Parquet footer, the end of a compressed stream), and by the rows that did not parse.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT, FILE, OWN_DATE = "_corrupt_record", "_file", "_own_date"
MESSAGE = 200  # characters of a ledger message
_DATE = r"/[^/=]+=([^/]+)/[^/]+$"  # the folder of a partition, whatever its key is called


def files(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """path, trade_date, length, declared rows (null where the format does not say) and a reason why it cannot be read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    plain = found.select("path", F.regexp_extract("path", _DATE, 1).alias("trade_date"), "length")
    checked = found if kind == "parquet" else found.filter("path like '%.gz'")

    def inspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, error = None, None
                try:
                    data = content.as_buffer()
                    if path.endswith(".parquet"):
                        rows = pq.ParquetFile(pa.BufferReader(data)).metadata.num_rows
                    else:
                        with gzip.open(io.BytesIO(data)) as stream:
                            while stream.read(1 << 20):
                                pass
                except (OSError, EOFError, pa.ArrowException, ValueError) as e:
                    error = f"{type(e).__name__}: {e}"[:MESSAGE]
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([rows], pa.int64()), pa.array([error], pa.string())], names=["path", "declared", "broken"])

    seen = checked.select("path", "content").mapInArrow(inspect, "path string, declared long, broken string")
    return plain.join(seen, "path", "left")


def rows(spark: SparkSession, folder: str, schema: T.StructType, kind: str) -> DataFrame:
    """The rows of all files in the columns of ``schema``; ``trade_date`` is the folder's, with the file, the text that did not parse and the row's own date beside it."""
    reader = spark.read.option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true")
    if kind == "csv":
        full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        df = reader.schema(full).option("header", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(folder)
    elif kind == "parquet":
        df = reader.schema(schema).parquet(folder).withColumn(CORRUPT, F.lit(None).cast("string"))
    else:
        raise ValueError(f"unknown kind of files: {kind}")
    file = F.col("_metadata.file_path")
    df = df.select(*schema.fieldNames(), CORRUPT, file.alias(FILE))
    date = F.regexp_extract(FILE, _DATE, 1)
    return df.withColumn(OWN_DATE, F.col("trade_date")).withColumn("trade_date", date)


def judged(found: DataFrame, read: DataFrame) -> DataFrame:
    """path, trade_date, n_rows, error of each file."""
    other = F.col(OWN_DATE).isNotNull() & (F.col(OWN_DATE) != F.col("trade_date"))
    sums = read.groupBy(FILE).agg(
        F.count("*").alias("n_rows"), F.count(CORRUPT).alias("n_bad"), F.min(CORRUPT).alias("bad"), F.count(F.when(other, 1)).alias("n_other"), F.min(F.when(other, F.col(OWN_DATE))).alias("other")
    )
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")  # noqa: E731  (file:/x and file:///x are one)
    both = found.withColumn("_p", plain("path")).join(sums.withColumn("_f", plain(FILE)), F.col("_p") == F.col("_f"), "left")
    error = (
        F.when(F.col("broken").isNotNull(), F.col("broken"))
        .when(F.col("n_rows").isNull(), "unreadable file")
        .when(F.col("n_bad") > 0, F.concat(F.col("n_bad").cast("string"), F.lit(" rows do not parse, one is: "), F.substring("bad", 1, MESSAGE)))
        .when(F.col("n_other") > 0, F.concat(F.col("n_other").cast("string"), F.lit(" rows of another date: "), F.col("other")))
        .when(F.col("declared") != F.col("n_rows"), F.concat(F.lit("rows read: "), F.col("n_rows").cast("string"), F.lit(", declared: "), F.col("declared").cast("string")))
    )
    return both.select("path", "trade_date", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), error.alias("error"))

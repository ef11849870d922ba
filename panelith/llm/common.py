"""Helpers shared by the training-data operators: tables, durable intermediates, word hashing."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A token everywhere: a run of anything but ASCII white space.
SPACES = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"

PACKAGE = Path(__file__).resolve().parents[1]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; where it is unset, a temporary one in local runs only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def durable(df: DataFrame, name: str = "step", by: list[str] | None = None) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it back: lineage ends, and lost executors cost nothing."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    writer = df.write
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, unless their PYTHONPATH has it."""
    root = str(PACKAGE.parent)
    if root in os.environ.get("PYTHONPATH", "").split(":") or getattr(spark.sparkContext, "_llm_shipped", False):
        return
    out = Path(tempfile.mkdtemp(prefix="spark-", dir="/tmp"), f"{PACKAGE.name}.zip")
    with zipfile.ZipFile(out, "w") as z:
        for p in PACKAGE.rglob("*.py"):
            z.write(p, p.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(out))
    spark.sparkContext._llm_shipped = True


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it is (then Spark shuffles)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def passed_through(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``df`` with its batches passed through ``work``, which keeps the columns' places; their names may be any, dots and doubles included."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(work, plain.schema).toDF(*df.columns)


def plainly(docs: DataFrame, needed: Sequence[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` over ``docs`` with all columns but the ``needed`` ones renamed, so that none clashes with its own; then the columns as they were."""
    names = [c if c in needed else f"further_{i}" for i, c in enumerate(docs.columns)]
    return work(docs.toDF(*names)).select(names).toDF(*docs.columns)


# --- word hashing ---------------------------------------------------------------------------------

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20_011).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PERIOD = 1 << 12
_POWER = np.multiply.accumulate(np.full(_PERIOD, 0x9E3779B97F4A7C15, np.uint64))
PIECE = 1 << 20


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (shift, xor, multiply)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(data: np.ndarray, offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Cuts the bytes into pieces of about ``size`` that split no word; a long word makes its piece longer."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + size)
        while end < n:
            window = np.flatnonzero(_IS_SPACE[data[end : end + 65_536]])
            k = np.searchsorted(offsets, end)
            bound = int(offsets[k]) if k < len(offsets) else n
            stop = min(end + int(window[0]) if len(window) else n, bound)
            if stop <= end + 65_536 or stop == bound and not len(window):
                if len(window) or bound <= end + 65_536:
                    end = stop
                    break
            end += 65_536
        end = min(end, n)
        yield at, end
        at = end


def release() -> None:
    """Gives a task's freed memory back to the system: workers live on, and the next stage's memory adds to theirs."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def by_bytes(batches: Iterator[pa.RecordBatch], at: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts (column ``at``) come to about ``limit`` bytes, so that a task's memory is bounded."""
    for batch in batches:
        _, offsets = utf8(batch.column(at))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
            yield batch.slice(a, b - a)
            a = b
    release()


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte of each word; no word crosses a document's border."""
    solid = ~_IS_SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hash_spans(lowered: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans that are disjoint and in order."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    inside = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(np.cumsum(size) - size, size)
    values = _BYTE[lowered[np.repeat(start, size) + inside]]
    values *= _POWER[inside & (_PERIOD - 1)] + (inside >> 12).astype(np.uint64)
    h = np.add.reduceat(values, np.cumsum(size) - size)
    return mix64(h + size.astype(np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased) of a string column, and where each document's words begin (one more entry than rows).

    The hashes are 64 bits: among 10^8 distinct words two meet with a chance of 3 in 10^4.
    """
    data, offsets = utf8(column)
    hashes, firsts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, b in pieces(data, offsets):
        part = _LOWER[data[a:b]]
        inner = offsets[np.searchsorted(offsets, a, "right") : np.searchsorted(offsets, b)] - a
        start, end = word_bounds(part, inner)
        hashes.append(hash_spans(part, start, end))
        firsts.append(start + a)
    first = np.concatenate(firsts)
    return np.concatenate(hashes), np.searchsorted(first, offsets).astype(np.int64)

"""Target-distribution importance resampling: hashed n-gram features, gains by bucket, a draw of the highest noisy scores.

Words come from the tokenizers library's pre-tokenisation: an untrained regex Split over the ASCII-lowered text gives
each word with its offsets.  A feature is a window of 1 to ``longest`` consecutive words, given as an offset pair (the
first word's start, the last word's end), its words joined by one space; the CRC-32 of a window continues that of the
window one word shorter.  A feature's bucket is its CRC-32 modulo ``buckets``.

Each text is cut into words once: its histogram (buckets and how often) is written, and both the table of gains and the
weights come from that.  Histograms are summed in each task before they are shuffled, so at most ``buckets`` rows a task
move, and ``buckets`` rows in all reach the driver.  The draw ranks the scores by sorted ranges (``numbered``), so no
task sees all documents.

Defined cases: a null or empty text has no features, weight 0 and is never drawn while ``least_words`` is above 0; rows
that repeat score alike and rank next to each other; a null doc_id hashes as the empty string and ties behind all
others; an empty target or an empty table gives gains from the other one alone; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelith.operators.order import numbered

from .common import by_bytes, durable, ship, utf8

# Fixed value: a word, in the syntax of the tokenizers library and of SQL alike.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGEST, BUCKETS, LEAST_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, 2024
PIECE = 1 << 20

_PARTING = np.ones(128, bool)
_PARTING[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = False


def splitter():
    """The regex Split: its matches are kept, all else is removed."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return Split(Regex(WORDS), behavior="removed", invert=True)


def offsets(lowered: str, split) -> Iterator[list[tuple[str, tuple[int, int]]]]:
    """Lists of (word, (start, end)), offsets in characters of the list's piece; a long text comes in pieces that part no word."""
    if len(lowered) <= PIECE:
        yield split.pre_tokenize_str(lowered)
        return
    at = 0
    while at < len(lowered):
        end = min(len(lowered), at + PIECE)
        while end < len(lowered) and not ((c := ord(lowered[end])) < 128 and _PARTING[c]):
            end += 1
        yield [(word, (at + a, at + b)) for word, (a, b) in split.pre_tokenize_str(lowered[at:end])]
        at = end


def windows(lowered: str, spans: list[tuple[int, int]], longest: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, crc) of each run of 1 to ``longest`` words, as a pair of offsets."""
    parts = [lowered[a:b].encode() for a, b in spans]
    for i, (start, _) in enumerate(spans):
        crc = 0
        for j in range(i, min(len(spans), i + longest)):
            crc = zlib.crc32(b" " + parts[j] if j > i else parts[j], crc)
            yield start, spans[j][1], crc


class Buckets:
    """Histograms of texts; keeps the buckets of recent words."""

    def __init__(self, longest: int, buckets: int) -> None:
        self.longest, self.buckets, self.split, self.known = longest, buckets, splitter(), {}

    def word(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            found = zlib.crc32(word.encode()) % self.buckets
            if len(self.known) > 200_000:
                self.known.clear()
            if len(word) <= 64:
                self.known[word] = found
        return found

    def histogram(self, lowered: str) -> tuple[int, dict[int, int]]:
        """(number of words, features by bucket) of a lowered text."""
        parts = offsets(lowered, self.split)
        total: dict[int, int] = {}
        if self.longest > 1:
            spans = [pair for part in parts for _, pair in part]
            return len(spans), Counter(crc % self.buckets for _, _, crc in windows(lowered, spans, self.longest))
        n = 0
        for part in parts:  # windows of one word need no joining: equal ones are counted first
            for word, times in Counter([lowered[a:b] for _, (a, b) in part]).items():
                b = self.word(word)
                n += times
                total[b] = total.get(b, 0) + times
        return n, total


HISTOGRAM = "n_words long, n_features long, buckets binary, counts binary"  # the binaries hold 32-bit integers


def histograms(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """Each row of ``texts`` (one key column, then text) with its number of words and features, and its histogram."""
    ship(texts.sparkSession)
    key = texts.columns[0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Buckets(longest, buckets)
        for batch in by_bytes(batches, 1):
            rows = [made.histogram(t or "") for t in pc.ascii_lower(batch.column(1)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n for n, _ in rows], pa.int64()),
                    pa.array([sum(h.values()) for _, h in rows], pa.int64()),
                    pa.array([np.fromiter(h, np.int32, len(h)).tobytes() for _, h in rows], pa.binary()),
                    pa.array([np.fromiter(h.values(), np.int32, len(h)).tobytes() for _, h in rows], pa.binary()),
                ],
                names=[key, "n_words", "n_features", "buckets", "counts"],
            )

    return texts.mapInArrow(work, f"`{key}` {texts.dtypes[0][1]}, {HISTOGRAM}")


def _integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit integers of a binary column, and where each row's begin (one more entry than rows)."""
    data, ends = utf8(column)
    return np.frombuffer(data.tobytes(), np.int32), ends // 4


def summed(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows; each task sums its own first, ``buckets`` rows reach the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_integers(batch.column(0))[0], _integers(batch.column(1))[0], buckets).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in found.select("buckets", "counts").mapInArrow(work, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of how much likelier the target's model makes each bucket), with one added everywhere."""
    n, all_s, all_t = len(source), float(source.sum()) + len(source), float(target.sum()) + len(target)
    pairs = zip(source.tolist(), target.tolist(), strict=True)
    return np.fromiter((math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in pairs), np.int64, n)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """floor(-1000 ln(-ln u)), u uniform by the hash of seed and doc_id: Gumbel noise, the same in every run."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(found: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of each histogram."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (bucket, ends), (times, _) = _integers(batch.column("buckets")), _integers(batch.column("counts"))
            total = np.concatenate([[0], np.cumsum(gain[bucket] * times, dtype=np.int64)])
            weight = total[ends[1:]] - total[ends[:-1]]
            score = weight + np.fromiter((noise(d, seed) for d in batch.column("doc_id").to_pylist()), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), batch.column("n_features"), pa.array(weight), pa.array(score)], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return found.mapInArrow(work, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(
    docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of each row of ``docs``; rank is null for rows that are not drawn.

    ``target`` needs the column text.  Drawn are floor(percent * N / 100) of the N rows with at least ``least_words``
    words: those of highest score (weight plus Gumbel noise, so a draw without replacement by importance weight).
    """
    found = durable(histograms(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), longest, buckets), "importance")
    gain = gains(summed(found, buckets), summed(histograms(target.select(F.lit(0).alias("key"), "text"), longest, buckets), buckets))
    scored = scores(found, gain, seed)
    fit: Column = F.col("n_words") >= least_words
    ranked = numbered(scored.withColumn("_fit", fit), [F.desc("_fit"), F.desc("score"), F.asc_nulls_last("doc_id")], "rank")
    drawn = percent * ranked.filter("_fit").count() // 100
    return ranked.select("doc_id", "n_features", "weight", "score", F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))


def drawn(docs: DataFrame, target: DataFrame, **options: int) -> DataFrame:
    """The rows of ``docs`` whose doc_id is drawn, with their rank (``draw_rank``); doc_ids must be distinct to draw row by row."""
    ranks = resample(docs, target, **options).filter("rank is not null").select(F.col("doc_id").alias("_id"), F.col("rank").alias("draw_rank"))
    return docs.join(ranks, F.col("doc_id") == F.col("_id")).drop("_id")

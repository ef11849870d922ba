"""Periodic run detection: seeds on diagonals, extended to maximal repetitions.

A run is a stretch of words with smallest period q and at least max(24, 3 q) words that no neighbour extends.  On the
diagonal of lag q (a word against the word q places on) it is a stretch of equal words of at least max(24 - q, 2 q).

Seeds: the k-grams of words, k = 16, then 32, 64 and so on.  k is the least overlap that a run with a period of the
class is sure to have: periods up to 16 overlap themselves by 16 words, those from k / 2 + 1 to k by k + 2.  As k is no
less than the period, the next occurrence of a k-gram inside its run lies exactly one smallest period on (two shorter
periods would make a common divisor a period).  So each occurrence pairs with the next one of its document alone: pairs
are as many as words, a word that fills a text gives no more, and nothing is lost.  A k-gram is looked at only where
both of its halves occur again.

Extension: pairs of a document are taken by lag and place; a table by lag holds how far its diagonal is covered, and a
pair below that is skipped.  A stretch is extended both ways by comparing words in doubling strides.

Words are numbered exactly (no hashes); k-grams are 64-bit hashes, and every seed is compared word by word.  Should two
k-grams of one document share a hash (about one chance in 10^13 for a text of 10^6 words), a seed of a run could hide.

A text is worked on in one task, in memory of some 250 bytes a word; a batch holds about 4 MB of texts.

Defined cases: a null or empty text has no words, no runs and the digests of empty strings; a null doc_id is periodic
nowhere (its words stand as they are); repeated rows give a row each; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, by_bytes, mix64, passed_through, ship

SEED, LEAST_WORDS, LEAST_PERIODS = 16, 24, 3
RESULT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"

_words = re.compile(WORD).findall


# --- runs of one sequence of documents ------------------------------------------------------------


def _longer(h: np.ndarray, step: int) -> np.ndarray:
    """Hashes of twice as long grams from those of ``step`` words: one fewer by ``step``."""
    return mix64(h[:-step] * np.uint64(0x9E3779B97F4A7C15) + mix64(h[step:] + np.uint64(0x632BE59BD9B4E019)))


def seed_pairs(ids: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, lags) of k-grams and their next occurrence in the same document, class by class of k."""
    with np.errstate(over="ignore"):
        h, k = mix64(ids.astype(np.uint64) + np.uint64(1)), 1
        while k < SEED:
            if len(h) <= k:
                return
            h, k = _longer(h, k), 2 * k
        n = len(h)
        at = np.flatnonzero(doc[:n] == doc[k - 1 : k - 1 + n])
        while len(at):
            key = h[at] ^ mix64(doc[at].astype(np.uint64) + np.uint64(0x51ED27))
            order = np.argsort(key, kind="stable")  # places stay in order within a key
            same = key[order[1:]] == key[order[:-1]]
            a, b = at[order[:-1][same]], at[order[1:][same]]
            lag = b - a
            fits = (lag <= k) & ((lag > k // 2) | (k == SEED))
            yield a[fits], lag[fits]
            again = np.zeros(len(h), bool)
            again[a] = again[b] = True
            if len(h) <= k:
                return
            h = _longer(h, k)
            n = len(h)
            at = np.flatnonzero(again[:n] & again[k : k + n])
            at = at[doc[at] == doc[at + 2 * k - 1]]
            k *= 2


def _stretch(ids: np.ndarray, at: int, lag: int, low: int, high: int) -> tuple[int, int]:
    """First and past-the-end place of the equal words around ``at`` on the diagonal of ``lag``, within [low, high)."""
    end, step = at, 64
    while end < high - lag:
        to = min(end + step, high - lag)
        bad = np.flatnonzero(ids[end:to] != ids[end + lag : to + lag])
        if len(bad):
            end += int(bad[0])
            break
        end, step = to, step * 2
    start, step = at, 64
    while start > low:
        to = max(start - step, low)
        bad = np.flatnonzero(ids[to:start] != ids[to + lag : start + lag])
        if len(bad):
            start = to + int(bad[-1]) + 1
            break
        start, step = to, step * 2
    return start, end


def find_runs(ids: np.ndarray, firsts: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (start, length, period), sorted by start and period, by number of document; ``firsts`` are the documents' first places and the end."""
    doc = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    found: dict[int, list[tuple[int, int, int]]] = {}
    for at, lag in seed_pairs(ids, doc):
        order = np.lexsort((at, lag, doc[at]))
        at, lag = at[order], lag[order]
        head = np.ones(len(at), bool)  # a place right behind another on the same diagonal belongs to its stretch
        head[1:] = (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1]) | (doc[at[1:]] != doc[at[:-1]])
        own, covered = -1, {}
        for i, q in zip(at[head].tolist(), lag[head].tolist(), strict=True):
            d = int(doc[i])
            if d != own:
                own, covered = d, {}
            if i < covered.get(q, 0):
                continue
            low = int(firsts[d])
            start, end = _stretch(ids, i, q, low, int(firsts[d + 1]))
            if end > i:
                covered[q] = end
                length = end - start + q
                if length >= max(LEAST_WORDS, LEAST_PERIODS * q):
                    found.setdefault(d, []).append((start - low, length, q))
    for runs in found.values():
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


# --- texts ----------------------------------------------------------------------------------------

Source = Callable[[int | None, int], np.ndarray | None]


def made_periodic(doc_id: int | None, n: int) -> np.ndarray | None:
    """Of which original word each word is a copy, for the tenth of documents that are made periodic; None for the others."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _columns(texts: list[str | None], doc_ids: list[int | None], source: Source | None) -> Iterator[tuple[list[str], list[tuple[int, int, int]]]]:
    """(words, runs) of each text."""
    number: dict[str, int] = {}
    every, ids = [], []
    for text, doc_id in zip(texts, doc_ids, strict=True):
        words = _words(text or "")
        own = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
        at = source(doc_id, len(words)) if source else None
        if at is not None:
            own, words = own[at], [words[i] for i in at.tolist()]
        every.append(words)
        ids.append(own)
    firsts = np.concatenate([[0], np.cumsum([len(w) for w in every])]).astype(np.int64)
    found = find_runs(np.concatenate(ids) if ids else np.zeros(0, np.int64), firsts)
    for k, words in enumerate(every):
        yield words, found.get(k, [])


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def runs(docs: DataFrame, source: Source | None = None) -> DataFrame:
    """doc_id, start, length, period of every run of every text of ``docs``; ``source`` may rearrange a text's words first."""
    ship(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1):
            ids = batch.column(0).to_pylist()
            rows = [(d, *r) for d, (_, own) in zip(ids, _columns(batch.column(1).to_pylist(), ids, source), strict=True) for r in own]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "period"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, start long, length long, period long")


def without_runs(docs: DataFrame, source: Source | None = None) -> DataFrame:
    """The rows of ``docs``, their texts with each run cut to its first period, words joined by one space; other columns as they were."""
    ship(docs.sparkSession)
    at, own = docs.columns.index("text"), docs.columns.index("doc_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, at):
            texts = [" ".join(collapsed(*r)) for r in _columns(batch.column(at).to_pylist(), batch.column(own).to_pylist(), source)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return passed_through(docs, work)


def summary(docs: DataFrame, source: Source | None = None) -> DataFrame:
    """By document: number of runs, the run of greatest length / period (ties: least start, then period), digests of all runs and of the collapsed text."""
    ship(docs.sparkSession)
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1):
            ids, rows = batch.column(0).to_pylist(), []
            for doc_id, (words, own) in zip(ids, _columns(batch.column(1).to_pylist(), ids, source), strict=True):
                best = None
                for r in own:  # by start and period: the first of equal exponents stays; integers decide
                    if best is None or r[1] * best[2] > best[1] * r[2]:
                        best = r
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in own)
                digests = (hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(" ".join(collapsed(words, own)).encode()).hexdigest())
                rows.append((doc_id, len(own), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *digests))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, RESULT)

"""Quality classifier by Bradley-Terry pairwise ranking.

A pair prefers a labelled good document to a labelled bad one; the chance that a document with features x beats one
with features y is the logistic function of w (x - y).  w maximises the likelihood of the pairs (with a ridge), so only
differences of features count and no intercept is learnt.  A document's margin is w x.

The threshold is a quantile of margins: of all labelled training documents the share of bad ones lies below it.  It is
read from the exact order of their margins (``numbered``; the mean of the two neighbours at that place), whatever their
number.  The score is the logistic function of margin minus threshold, so 0.5 is the threshold.

Features are shares of a whole text: kinds of characters, capitals, signs inside and behind words, words that repeat the
one before, distinct words and distinct runs of four words, lengths of words and lines.  They are measured on bytes and
word hashes in Arrow batches, a slice of some 4 MB at a time; a text is never cut.  Shares shrink towards 0 in short texts.

The weights are fitted on at most ``most_good`` + ``most_bad`` labelled training documents, taken by the order of a hash
of doc_id, each bad one against ``rivals`` good ones and each good one against ``rivals`` bad ones.  Everything else,
threshold included, covers all rows.

Defined cases: a null text counts as empty; an empty text has all shares 0 and is scored like any other; without labelled
training rows of both classes every score is 0.5; a doc_id with several labels takes the highest; repeated rows score
alike; a null doc_id is scored and never learnt from; an empty table gives an empty result; columns other than doc_id
and text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelith.operators.order import numbered

from .common import _IS_SPACE, by_bytes, durable, mix64, passed_through, ship, small, utf8, word_bounds, word_hashes

GOOD_ROWS, BAD_ROWS, RIVALS, RIDGE, HELD_OUT, RUN = 4000, 4000, 4, 1e-3, (3, 1), 4
PRIOR = 5  # words that every text counts as having besides its own, so that shares of a short text say little

_KIND = np.full(256, 3, np.uint8)  # 0 small letter, 1 capital, 2 digit, 3 other sign, 4 . , ; : and quotes, 5 white space, 6 beyond ASCII
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 6
for _c in ".,;:?'\"-()":
    _KIND[ord(_c)] = 4
_KIND[_IS_SPACE] = 5

FEATURES = (
    "capital_share", "digit_share", "sign_share", "stop_share", "beyond_share", "space_share",
    "upper_words", "signed_words", "bare_signs", "long_words", "short_words", "word_length",
    "repeats", "distinct_words", "distinct_runs", "commonest_word", "lines", "equal_lines", "log_words", "empty",
)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _distinct(keys: np.ndarray, group: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, most frequent key's count) of each group."""
    if not len(keys):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.lexsort((keys, group))
    k, g = keys[order], group[order]
    first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (g[1:] != g[:-1])]))
    times = np.diff(np.append(first, len(k)))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, g[first], times)
    return np.bincount(g[first], minlength=n), most


def features(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text."""
    data, offsets = utf8(column)
    n = len(offsets) - 1
    kind = _KIND[data]
    of_kind = np.stack([_sums(kind == k, offsets) for k in range(7)], 1).astype(float)
    size = offsets[1:] - offsets[:-1] + 6.0 * PRIOR
    letters = of_kind[:, 0] + of_kind[:, 1] + of_kind[:, 6] + 5.0 * PRIOR
    start, end = word_bounds(data, offsets)
    firsts = np.searchsorted(start, offsets).astype(np.int64)
    doc = np.repeat(np.arange(n), np.diff(firsts))
    words = np.maximum(np.diff(firsts), 1).astype(float)
    spans = np.stack([start, end], 1).ravel()
    within = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[spans])[::2] if len(spans) else np.zeros(0, np.int64)
    small_in, capital_in, sign_in = within(kind == 0), within(kind == 1), within(kind == 3)
    length = end - start
    by_doc = lambda mask: np.bincount(doc, weights=mask, minlength=n)
    h, at = word_hashes(column)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    distinct, most = _distinct(h, doc, n)
    runs = np.zeros(n)
    if len(h) >= RUN:
        joined = h[: len(h) - RUN + 1].copy()
        for k in range(1, RUN):
            joined = mix64(joined + np.uint64(k)) + h[k : len(h) - RUN + 1 + k]
        whole = doc[: len(joined)] == doc[RUN - 1 :]
        runs = _distinct(joined[whole], doc[: len(joined)][whole], n)[0]
    breaks = np.flatnonzero(data == 10)
    ends = np.unique(np.concatenate([breaks, offsets[1:] - 1]))
    ends = ends[ends >= 0]
    line_doc = np.searchsorted(offsets, ends, "right") - 1
    lines = np.bincount(line_doc, minlength=n).astype(float) if len(ends) else np.zeros(n)
    line_word = np.searchsorted(start, np.concatenate([[0], ends + 1]))
    prefix = np.concatenate([[np.uint64(0)], np.cumsum(mix64(h), dtype=np.uint64)])
    line_key = prefix[line_word[1:]] - prefix[line_word[:-1]] if len(ends) else np.zeros(0, np.uint64)
    own_lines, _ = _distinct(line_key, line_doc, n)
    some = np.diff(at).astype(float)
    per = lambda x: x / (some + PRIOR)
    mean = lambda x: np.where(some > 0, x / words, 0.0)
    out = np.stack(
        [
            of_kind[:, 1] / letters, of_kind[:, 2] / size, of_kind[:, 3] / size, of_kind[:, 4] / size, of_kind[:, 6] / size, of_kind[:, 5] / size,
            per(by_doc((capital_in > 1) & (small_in == 0))), per(by_doc(sign_in > 0)), per(by_doc((sign_in > 0) & (sign_in == length))), per(by_doc(length > 20)), per(by_doc(length < 3)), mean(by_doc(length)) / 10,
            per(by_doc(again)), mean(distinct), np.where(some >= RUN, runs / np.maximum(words - RUN + 1, 1), 1.0), per(most), lines / size * 10, (lines - own_lines) / (lines + PRIOR), np.log1p(some) / 10, (some == 0).astype(float),
        ],
        1,
    )
    shares = [0, 2, 6, 7, 8, 12, 17]
    return np.concatenate([out, np.sqrt(out[:, shares]), np.square(out[:, [13, 14]])], 1)


def held_out(folds: int = HELD_OUT[0], left: int = HELD_OUT[1]) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == left, F.lit(False))


def pairs(good: int, bad: int, rivals: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of good, places of bad) of the preference pairs: each document meets ``rivals`` of the other class."""
    step = np.arange(rivals)
    a = np.concatenate([np.repeat(np.arange(good), rivals), (np.arange(bad)[:, None] * rivals + step).ravel() % good])
    b = np.concatenate([(np.arange(good)[:, None] * rivals + step).ravel() % bad, np.repeat(np.arange(bad), rivals)])
    return np.unique(np.stack([a, b], 1), axis=0).T


def bradley_terry(better: np.ndarray, worse: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights that maximise the mean log likelihood of the pairs less a ridge (Newton steps with halving)."""
    x = better - worse
    w = np.zeros(x.shape[1])
    loss = lambda w: np.logaddexp(0, -x @ w).mean() + ridge / 2 * w @ w
    now = loss(w)
    for _ in range(60):
        p = 1 / (1 + np.exp(np.clip(x @ w, -500, 500)))
        gradient = ridge * w - x.T @ p / len(x)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(x) + ridge * np.eye(len(w)), gradient)
        size = 1.0
        while (after := loss(w - size * step)) > now and size > 1e-6:
            size /= 2
        if now - after < 1e-10:
            break
        w, now = w - size * step, after
    return w


class Ranker:
    """Weights over standardised features, and a threshold."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, weights: np.ndarray, threshold: float = 0.0) -> None:
        self.centre, self.scale, self.weights, self.threshold = centre, scale, weights, threshold

    def margins(self, column: pa.Array) -> np.ndarray:
        return np.clip((features(column) - self.centre) / self.scale, -8, 8) @ self.weights


def _margins(rows: DataFrame, ranker: Ranker) -> DataFrame:
    """``rows`` with ``margin`` in place of their last column (text)."""
    *keys, _ = rows.dtypes
    names, at = [*[k for k, _ in keys], "margin"], len(keys)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, at):
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(ranker.margins(batch.column(at)))], names=names)

    return rows.mapInArrow(work, ", ".join([*[f"{k} {t}" for k, t in keys], "margin double"]))


def fit(docs: DataFrame, labels: DataFrame, most_good: int = GOOD_ROWS, most_bad: int = BAD_ROWS, rivals: int = RIVALS) -> Ranker:
    """The ranker learnt from the training rows of ``labels``; without both classes one whose margins are all 0."""
    ship(docs.sparkSession)
    labelled = labels.filter("doc_id is not null and quality is not null").filter(~held_out()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    training = durable(labelled, "preference-labels")
    order = [F.xxhash64("doc_id", F.lit(13)), F.col("doc_id")]
    sample = training.filter("quality = 1").orderBy(*order).limit(most_good).unionByName(training.filter("quality = 0").orderBy(*order).limit(most_bad))
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("quality", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(features(batch.column(1))), pa.list_(pa.float64()))], names=["quality", "x"])

    got = rows.mapInArrow(measure, "quality int, x array<double>").toPandas()  # at most the sample's rows, a few dozen numbers each
    got = got.assign(key=got["x"].map(tuple)).sort_values("key") if len(got) else got  # the same pairs in every run
    good, bad = ([np.array(x) for x in got["x"][got["quality"] == q]] for q in (1, 0))
    width = len(features(pa.array([""]))[0])
    if not good or not bad:
        return Ranker(np.zeros(width), np.ones(width), np.zeros(width))
    rng = np.random.default_rng(13)
    good, bad = rng.permutation(np.stack(good)), rng.permutation(np.stack(bad))
    centre = (good.mean(0) + bad.mean(0)) / 2
    scale = np.sqrt((good.var(0) + bad.var(0)) / 2 + 1e-6)
    a, b = pairs(len(good), len(bad), rivals)
    standard = lambda x: np.clip((x - centre) / scale, -8, 8)
    ranker = Ranker(centre, scale, bradley_terry(standard(good)[a], standard(bad)[b]))
    whole = training.select(F.col("doc_id").alias("_id"), F.col("quality").cast("long").alias("quality"))
    rows = docs.select("doc_id", "text").join(small(whole, 1_000_000), F.col("doc_id") == F.col("_id")).select("quality", F.xxhash64("doc_id").alias("apart"), "text")
    ranked = numbered(_margins(rows, ranker), ["margin", "quality", "apart"])  # copies have equal margins: their ids part them
    below, n = ranked.agg(F.count(F.when(F.col("quality") == 0, 1)), F.count("*")).first()
    ranker.threshold = float(ranked.filter(F.col("place").isin(below, min(below + 1, n))).agg(F.avg("margin")).first()[0])
    return ranker


def score(docs: DataFrame, labels: DataFrame, most_good: int = GOOD_ROWS, most_bad: int = BAD_ROWS, rivals: int = RIVALS) -> DataFrame:
    """doc_id, score of each row of ``docs``."""
    ranker = fit(docs, labels, most_good, most_bad, rivals)
    m = _margins(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ranker)
    return m.select("doc_id", (1 / (1 + F.exp(F.lit(ranker.threshold) - F.col("margin")))).alias("score"))


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a score of 0.5 or more, columns as they were; no row leaves its task."""
    ranker, at = fit(docs, labels), docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, at):
            yield batch.filter(pa.array(ranker.margins(batch.column(at)) >= ranker.threshold))

    return passed_through(docs, work)

"""Toxicity: noisy-channel restoring of disguised words, then a score of the restored text.

Channel: a writer may put a digit or sign for a letter (leetspeak), part letters by spaces or signs, and repeat letters.
A word (or run of single letters and signs) becomes a lattice of what it may stand for, each way with a channel cost,
and Viterbi decoding finds the best reading under a character trigram model, whose counts cover the plain words of all
documents.  Every word is decoded whose lattice has more than one way: one that holds a sign of LEET, a separator, or a
letter twice in a row.  A word or run without any letter is a number or punctuation and stays as it is.  A '!' at an edge
may be an i or punctuation: the word is decoded with it and without it, and the reading of least cost counts.

Score: features of a restored word are the word and its first 4, 5 and 6 bytes (hashed).  Weights are the log odds of a
feature in toxic against clean documents, from one part of the training sample; the two highest weights among a
document's distinct words enter a logistic model that is fitted on the other part.

The classifier is fitted on at most ``most_toxic`` + ``most_clean`` labelled training rows, taken by the order of a hash
of doc_id; of near copies among them (equal least 4-word shingle) the one of least doc_id counts.  It has weights for
the ``most_features`` features that occur in most of the toxic ones.  Everything else covers all documents.

Defined cases: null text is empty, an empty text has the score of a text without any signal; without labelled rows of
both classes every score is 0; repeated rows are scored alike; an empty table gives an empty result; columns other than
doc_id and text are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import _LOWER, by_bytes, durable, hash_spans, passed_through, pieces, ship, utf8
from .jaccard import shingle_sets

# What a sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "€": "e"}
SEPARATORS = " .-_*'~/"
TOXIC_ROWS, CLEAN_ROWS, FOLDS, HELD_OUT = 4000, 8000, 10, 5
LEAST_DOCS, LEAST_WEIGHT, FEATURES = 5, 2.0, 1 << 16

_SIGNS = re.escape("".join(LEET))
_LETTER = r"[^\W\d_]"
_WAYS = re.compile(rf"({_LETTER})\1|[{_SIGNS}{re.escape(SEPARATORS)}]")
_HAS_LETTER = re.compile(_LETTER)
_ONE = rf"(?:{_LETTER}|[{_SIGNS}])"
_SPACED = re.compile(rf"(?<![^\W_]){_ONE}(?: +{_ONE}){{2,}}(?![^\W_])")
_EDGE = "\"'()[]{}<>.,;:!?#%&*=-_~/\\^`"
_EDGE_ONLY = "".join(c for c in _EDGE if c not in LEET)
FRONT_SIGN = 2.5  # cost of a sign in front of a word that stands for nothing; behind a word it is punctuation, free

# --- character model ------------------------------------------------------------------------------

SYMBOLS = 28  # 0: border, 1 to 26: a to z, 27: any other letter
_CODE = np.full(256, 0, np.int32)
_CODE[97:123] = np.arange(1, 27)
_CODE[128:] = 27
for _c in "0123456789@$!|+":
    _CODE[ord(_c)] = 255


def trigram_counts(column: pa.Array) -> np.ndarray:
    """Counts of three symbols in a row; texts are parted by borders, digits and signs that may be letters count nowhere."""
    data, offsets = utf8(column)
    total = np.zeros(SYMBOLS**3, np.int64)
    for a, b in pieces(data, offsets):
        c = np.concatenate([[0], _CODE[_LOWER[data[a:b]]], [0]])
        c = np.insert(c, np.unique(offsets[(offsets > a) & (offsets < b)] - a + 1), 0)
        good = (c[:-2] < SYMBOLS) & (c[1:-1] < SYMBOLS) & (c[2:] < SYMBOLS) & ~((c[:-2] == c[1:-1]) & (c[1:-1] == c[2:]))
        total += np.bincount((c[:-2] * SYMBOLS**2 + c[1:-1] * SYMBOLS + c[2:])[good], minlength=SYMBOLS**3)
    return total


def language_model(docs: DataFrame) -> np.ndarray:
    """-log10 of P(third symbol | two before), smoothed by shorter histories; counts over all documents."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            total += trigram_counts(batch.column(0))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["gram", "n"])

    rows = docs.select("text").mapInArrow(count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()  # at most SYMBOLS ** 3 rows
    three = np.zeros(SYMBOLS**3)
    for r in rows:
        three[r.gram] = r.n
    three = three.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 1) / (one.sum() + SYMBOLS)
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    p3 = (three + 5 * p2[None]) / (three.sum(2, keepdims=True) + 5)
    return -np.log10(p3)


def _symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """Ways (text, channel cost) of each run of one character, in order."""
    out, k, n = [], 0, len(word)
    while k < n:
        c, j = word[k], k + 1
        while j < n and word[j] == c:
            j += 1
        run = j - k
        if c.isalpha():
            out.append([(c, 0.0)] if run == 1 else [(c * 2, 0.1), (c, 0.9)] if run == 2 else [(c, 0.4), (c * 2, 0.6), (c * run, 3.0)])
        elif c in LEET:
            ways = [(x, 0.5) for x in LEET[c]] + [(x * 2, 0.8) for x in LEET[c] if run > 1] + [(" ", 2.5)]
            out.append(ways)
        elif c in SEPARATORS:
            out.append([("", 0.3), (" ", 0.6)])
        else:
            out.append([(" ", 0.0)])
        k = j
    return out


def reading(word: str, model: list[float]) -> tuple[float, str]:
    """(cost, text) of the reading of least cost: channel plus character model (flat); states are the last two symbols."""
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}  # a text is a chain: (all before, last piece)
    for ways in lattice(word.lower()):
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, text) in states.items():
            for emitted, channel in ways:
                x, y, total = a, b, cost + channel
                for c in emitted:
                    s = _symbol(c)
                    total += model[(x * SYMBOLS + y) * SYMBOLS + s]
                    x, y = y, s
                if total < after.get((x, y), (np.inf,))[0]:
                    after[x, y] = (total, (text, emitted))
        states = after
    ends = {state: cost + model[(state[0] * SYMBOLS + state[1]) * SYMBOLS] for state, (cost, _) in states.items()}
    best = min(ends, key=lambda state: (ends[state], state))
    pieces_, chain = [], states[best][1]
    while chain is not None:
        chain, piece = chain
        pieces_.append(piece)
    return ends[best], "".join(reversed(pieces_))


def decode(word: str, model: np.ndarray) -> str:
    return reading(word, model.ravel().tolist())[1]


class Restorer:
    """Restores texts; keeps the readings of recent words."""

    def __init__(self, model: np.ndarray) -> None:
        self.model, self.known, self.readings = model.ravel().tolist(), {}, {}

    def reading(self, core: str) -> tuple[float, str]:
        found = self.readings.get(core)
        if found is None:
            found = reading(core, self.model)
            if len(self.readings) > 200_000:
                self.readings.clear()
            if len(core) <= 64:
                self.readings[core] = found
        return found

    def decoded(self, word: str) -> str:
        """The word as read, or itself where there is one way to read it."""
        core = word.strip(_EDGE_ONLY + " ")
        bare = core.strip(_EDGE + " ")
        if not _HAS_LETTER.search(bare):
            return word
        if bare == core:
            return self.reading(core)[1] if _WAYS.search(core.lower()) else word
        front, behind = core[: core.index(bare)], core[core.index(bare) + len(bare) :]
        forms = [(FRONT_SIGN * (a != front), a + bare + b) for a in {"", front} for b in {"", behind}]
        best = min((cost + self.reading(form)[0], form) for cost, form in forms)[1]
        return self.reading(best)[1] if _WAYS.search(best.lower()) else word

    def word(self, word: str) -> str:
        found = self.known.get(word)
        if found is None:
            found = self.decoded(word)
            if len(self.known) > 200_000:
                self.known.clear()
            if len(word) <= 64:
                self.known[word] = found
        return found

    def text(self, text: str) -> str:
        spread = _SPACED.sub(lambda m: self.word(m[0]), text)
        words = spread.split()
        get, word = self.known.get, self.word
        read = [get(w) or word(w) for w in words]
        return " ".join(read) if read != words else spread

    def column(self, column: pa.Array) -> pa.Array:
        """All texts restored; only those that hold something suspicious are touched."""
        odd = suspicious(column)
        if not odd.any():
            return column
        texts = column.to_pylist()
        for k in np.flatnonzero(odd).tolist():
            texts[k] = self.text(texts[k])
        return pa.array(texts, pa.string())


_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_IS_SIGN = np.zeros(256, bool)
_IS_SIGN[[ord(c) for c in LEET if ord(c) < 128] + [ord(c) for c in SEPARATORS if c != " "]] = True


def suspicious(column: pa.Array) -> np.ndarray:
    """Which texts may hold a word to decode (a few too many: it looks at bytes, and across the borders of texts)."""
    data, offsets = utf8(column)
    out = np.zeros(len(offsets) - 1, bool)
    for a in range(0, len(data), 1 << 20):
        d = _LOWER[data[a : a + (1 << 20) + 3]]
        letter, space = _IS_LETTER[d], d == 32
        hit = _IS_SIGN[d] | (d > 127)
        hit[:-1] |= letter[:-1] & (d[:-1] == d[1:])
        hit[:-2] |= space[:-2] & letter[1:-1] & space[2:]
        at = np.flatnonzero(hit) + a
        out[np.clip(np.searchsorted(offsets, at, "right") - 1, 0, len(out) - 1)] = True
    return out


# --- features and weights -------------------------------------------------------------------------

_PART = np.ones(256, bool)
_PART[:128] = [chr(i).isalnum() for i in range(128)]


def word_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, features) of each word: the word and its first 4, 5 and 6 bytes, 0 where it is no longer than that."""
    data, offsets = utf8(column)
    docs, features = [np.zeros(0, np.int64)], [np.zeros((0, 4), np.uint64)]
    for a, b in pieces(data, offsets):
        d = _LOWER[data[a:b]]
        solid = _PART[d]
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        inner = offsets[(offsets > a) & (offsets < b)] - a
        first[inner], last[inner - 1] = solid[inner], solid[inner - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        rows = np.zeros((len(start), 4), np.uint64)
        rows[:, 0] = hash_spans(d, start, end)
        for j, n in enumerate((4, 5, 6), 1):
            long = end - start > n
            rows[long, j] = hash_spans(d, start[long], start[long] + n) ^ np.uint64(j)
        docs.append(np.searchsorted(offsets, start + a, "right") - 1)
        features.append(rows)
    return np.concatenate(docs), np.concatenate(features)


class Weights:
    """Sorted feature hashes and their weights, with a bitmap that rules most words out."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.weights = keys[order], weights[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def find(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, key place) of the features that have a weight."""
        rows, cols = np.nonzero(self.maybe[(features & np.uint64((1 << 20) - 1)).astype(np.int64)])
        f = features[rows, cols]
        at = np.minimum(np.searchsorted(self.keys, f), max(0, len(self.keys) - 1))
        good = (self.keys[at] == f) if len(self.keys) else np.zeros(len(f), bool)
        return rows[good], at[good]

    def signals(self, column: pa.Array) -> np.ndarray:
        """Highest and second highest weight among each text's distinct words (0 where there is none)."""
        doc, features = word_features(column)
        rows, at = self.find(features)
        out = np.zeros((len(column), 2))
        if len(rows):
            word = np.full(len(doc), -np.inf)
            np.maximum.at(word, rows, self.weights[at])
            hit = np.unique(rows)
            d, w, h = doc[hit], word[hit], features[hit, 0]
            order = np.lexsort((h, -w, d))
            d, w, h = d[order], w[order], h[order]
            fresh = np.concatenate([[True], (d[1:] != d[:-1]) | (h[1:] != h[:-1])])
            d, w = d[fresh], w[fresh]
            first = np.concatenate([[True], d[1:] != d[:-1]])
            out[d[first], 0] = w[first]
            second = np.concatenate([[False], first[:-1]]) & ~first
            out[d[second], 1] = w[second]
        return out


def held_out(folds: int = HELD_OUT) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps; x has a column of ones."""
    beta = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * w[:, None]).T @ x + ridge * np.eye(x.shape[1]), x.T @ (y - p) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, model: np.ndarray, most_toxic: int = TOXIC_ROWS, most_clean: int = CLEAN_ROWS, most_features: int = FEATURES) -> tuple[Weights, np.ndarray]:
    """Feature weights and the logistic model on top of them."""
    spark = docs.sparkSession
    ship(spark)
    training = labels.filter("doc_id is not null and toxic is not null").filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r.toxic: r["count"] for r in training.groupBy("toxic").count().collect()}
    order = F.xxhash64("doc_id", F.lit(11))
    sample = training.filter("toxic = 1").orderBy(order, "doc_id").limit(most_toxic).unionByName(training.filter("toxic = 0").orderBy(order, "doc_id").limit(most_clean))
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", "text")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 2):
            sets = shingle_sets(batch.column(2), 4)
            least = np.fromiter((int(s[0].view(np.int64)) if len(s) else 0 for s in sets), np.int64, len(sets))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(least)], names=["doc_id", "toxic", "text", "least"])

    one = Window.partitionBy("least").orderBy("doc_id", "toxic", "text")
    rows = rows.mapInArrow(mark, "doc_id long, toxic int, text string, least long").withColumn("rank", F.row_number().over(one)).filter("rank = 1")
    rows = durable(rows.select("doc_id", "toxic", "text", (F.pmod(F.xxhash64("least"), F.lit(FOLDS)) < 3).alias("check")), "toxic-sample")

    def restored(batch: pa.RecordBatch, restorer: Restorer) -> pa.Array:
        return restorer.column(batch.column("text"))

    def toxic_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in by_bytes(batches, 2):
            doc, features = word_features(restored(batch, restorer))
            pairs = np.unique(np.stack([np.repeat(doc.astype(np.uint64), 4), features.ravel()], 1), axis=0)
            keys, n = np.unique(pairs[pairs[:, 1] != 0, 1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

    learn = rows.filter("not check")
    positive = learn.filter("toxic = 1").mapInArrow(toxic_features, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_DOCS)
    positive = positive.orderBy(F.desc("n"), "key").limit(most_features).toPandas()
    keys = positive["key"].to_numpy(np.int64).view(np.uint64)
    index = Weights(keys, positive["n"].to_numpy(float))

    def clean_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        total = np.zeros(len(index.keys), np.int64)
        for batch in by_bytes(batches, 2):
            doc, features = word_features(restored(batch, restorer))
            r, at = index.find(features)
            total += np.bincount(np.unique(np.stack([doc[r], at], 1), axis=0)[:, 1], minlength=len(total)) if len(r) else 0
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["place", "n"])

    sizes = {(r.toxic, r.check): r["count"] for r in rows.groupBy("toxic", "check").count().collect()}
    if not counts.get(0) or not counts.get(1) or not len(keys):
        return Weights(np.zeros(0, np.uint64), np.zeros(0)), np.array([-30.0, 0.0, 0.0])
    negative = np.zeros(len(keys))
    for r in learn.filter("toxic = 0").mapInArrow(clean_counts, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():  # at most FEATURES rows
        negative[r.place] = r.n
    p, n = sizes.get((1, False), 0), sizes.get((0, False), 0)
    odds = np.log((index.weights + 0.5) / (p + 1)) - np.log((negative + 0.5) / (n + 1))
    weights = Weights(index.keys[odds >= LEAST_WEIGHT], odds[odds >= LEAST_WEIGHT])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in by_bytes(batches, 2):
            s = weights.signals(restored(batch, restorer))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(s[:, 0]), pa.array(s[:, 1])], names=["toxic", "a", "b"])

    checks = rows.filter("check")
    got = checks.mapInArrow(measure, "toxic int, a double, b double").toPandas()  # at most the sample's rows
    if got["toxic"].nunique() < 2:
        return weights, np.array([-5.0, 1.0, 0.0])
    x = np.column_stack([np.ones(len(got)), got["a"], got["b"]])
    beta = _logistic(x, got["toxic"].to_numpy(float))
    share = got["toxic"].mean()
    beta[0] += np.log(counts[1] / counts[0]) - np.log(share / (1 - share))
    return weights, beta


def score(docs: DataFrame, labels: DataFrame, most_toxic: int = TOXIC_ROWS, most_clean: int = CLEAN_ROWS, most_features: int = FEATURES) -> DataFrame:
    """doc_id, score of each row of ``docs``."""
    ship(docs.sparkSession)
    model = language_model(docs)
    weights, beta = fit(docs, labels, model, most_toxic, most_clean, most_features)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in by_bytes(batches, 1):
            s = weights.signals(restorer.column(batch.column(1).fill_null("")))
            z = beta[0] + s @ beta[1:]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, score double")


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic (score under 0.5), columns as they were; no row leaves its task."""
    ship(docs.sparkSession)
    model = language_model(docs)
    weights, beta = fit(docs, labels, model)
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in by_bytes(batches, at):
            s = weights.signals(restorer.column(batch.column(at).fill_null("")))
            yield batch.filter(pa.array(beta[0] + s @ beta[1:] < 0))

    return passed_through(docs, work)

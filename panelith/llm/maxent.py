"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax.

Words lie at the leaves of a tree of classes in which each node has FAN children; a word's first two classes follow
from its last bytes, the further ones from its hash.  P(word | history) is the product of a softmax at each node on the
word's path, times the word's add-one share of its leaf, where unknown words have one more place; so the whole is a
proper distribution.  Each softmax has hashed features of the history (the word before, the two words before, the
skips two and three words back) joined with the node, so n-gram evidence reaches down to the leaf.  Rare history words
stand for their last bytes.  The tree gets deeper with the vocabulary (LEAF_WORDS words to a leaf) and the tables
longer with the cube root of the training tokens (each task sends its copy); DEPTH and MOST_ROWS bound what a task must hold.

Words are numbered once: texts become chunks of up to CHUNK_BYTES, each with its own dictionary.  Dictionaries, not
tokens, are shuffled to sum the counts over all training documents, and the sums return to each chunk.  Chunks and sums
lie in buckets, so they meet without a shuffle; chunk numbers are dealt so that buckets fill evenly.  Training
runs in ROUNDS; in a round each task updates its copy of the weights over its share of the minibatches (AdaGrad), and
the rows that changed are averaged in slices, each by how often the copies used it.  Each training token takes part in
one update.  Scoring is numpy by minibatch.

Counts, and with them all columns but ``score``, do not depend on how rows lie in tasks; ``score`` does, as copies are
trained apart: the same rows in other partitions give slightly other weights.

Defined cases: null text is empty; an empty text is one end token; a null doc_id stays null and is trained on; without
training documents all words are unknown; repeated rows count and are scored each for itself; an empty table gives an
empty result; further columns are ignored.  Words are 64-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import _LOWER, by_bytes, durable, hash_spans, mix64, pieces, release, shared_dir, ship, utf8, word_bounds

FAN, DEPTH, LEAF_WORDS = 16, 4, 2048
SHAPES = (FAN - 1) * FAN  # first two classes; a first class of 0 is the end token's own
ROWS_A_ROOT, LEAST_ROWS, MOST_ROWS = 72, 4096, 1 << 18
CHUNK_BYTES, BATCH, ROUNDS, RATE, OFTEN, FOLDS, FOLD = 16 << 20, 32_768, 2, 0.2, 200, 7, 2
END = 1  # the end token's "hash"
FIRST_FREE = 1 << 40  # chunk numbers from here on are dealt by hash

_CHUNK = "chunk long, doc_ids binary, nulls binary, held binary, lens binary, ids binary, words binary, shapes binary, counts binary"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == FOLD


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, shape, document offsets) of all words of a column."""
    data, offsets = utf8(column)
    hashes, shapes, firsts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
    for a, b in pieces(data, offsets):
        d = _LOWER[data[a:b]]
        start, end = word_bounds(d, offsets[(offsets > a) & (offsets < b)] - a)
        hashes.append(hash_spans(d, start, end))
        tail = d[end - 1].astype(np.uint32) * 31 + d[np.maximum(end - 2, start)]
        shapes.append(((tail * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(SHAPES)).astype(np.uint8))
        firsts.append(start + a)
    return np.concatenate(hashes), np.concatenate(shapes), np.searchsorted(np.concatenate(firsts), offsets).astype(np.int64)


def _chunk(number: int, doc_ids: pa.Array, held: np.ndarray, column: pa.Array) -> pa.RecordBatch:
    h, shape, at = tokens(column)
    n = len(doc_ids)
    lens = np.diff(at) + 1
    ends = np.cumsum(lens) - 1
    words, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    ids = np.zeros(len(h) + n, np.int32)
    inside = np.ones(len(ids), bool)
    inside[ends] = False
    ids[inside] = inverse + 1
    train = np.repeat(~held, lens)
    counts = np.bincount(ids[train], minlength=len(words) + 1)
    row = {"doc_ids": doc_ids.fill_null(0).to_numpy().astype("<i8"), "nulls": doc_ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8), "held": held.astype(np.uint8), "lens": lens.astype("<i4"), "ids": ids.astype("<i4"), "words": np.concatenate([np.array([END], np.uint64), words]), "shapes": np.concatenate([np.zeros(1, np.uint8), shape[first]]), "counts": counts.astype("<i4")}
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *(pa.array([v.tobytes()], pa.binary()) for v in row.values())], names=["chunk", *row])


def chunks(docs: DataFrame, name: str) -> DataFrame:
    """Documents as chunks of word numbers, with each chunk's dictionary and training counts."""
    ship(docs.sparkSession)
    even, buckets = _even_numbers(docs.sparkSession), _buckets(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, step = TaskContext.get().partitionId(), 0, buckets * 9 // 2
        held: list[pa.RecordBatch] = []
        size = 0

        def chunk() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            known = part < step and part + seq * step < len(even)
            return _chunk(even[part + seq * step] if known else FIRST_FREE + (part << 20) + seq, rows.column(0), rows.column(1).to_numpy(zero_copy_only=False).astype(bool), rows.column(2))

        for batch in by_bytes(batches, 2, CHUNK_BYTES):
            n = int(utf8(batch.column(2))[1][-1])
            if held and size + n > CHUNK_BYTES:
                yield chunk()
                seq, size = seq + 1, 0
            held.append(batch)
            size += n
        if held:
            yield chunk()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(), F.lit(False)).alias("held"), "text")
    return _bucketed(rows.mapInArrow(work, _CHUNK), name)


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _even_numbers(spark: SparkSession, rounds: int = 16) -> list[int]:
    """About ``rounds`` numbers for each bucket, those of all buckets in turn; further chunks are many, and evenly dealt by hash."""
    n = _buckets(spark)
    of: list[list[int]] = [[] for _ in range(n)]
    for r in spark.range(n * rounds * 2).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("b")).collect():
        of[r.b].append(r.id)
    return [own[k] for k in range(min(map(len, of))) for own in of]


def _bucketed(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder as a table in buckets by chunk, so that tables joined by chunk are not shuffled."""
    spark = df.sparkSession
    df.write.option("path", f"{shared_dir(spark)}/{name}").bucketBy(_buckets(spark), "chunk").saveAsTable(name)
    return spark.table(name)


def leaves(words: np.ndarray, shapes: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """The leaf of each word of a chunk's dictionary, whose first entry is the end token (leaf 0)."""
    deep = (mix64(words * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).view(np.int64) % FAN ** (DEPTH - 2)
    out = (shapes.astype(np.int64) + FAN) * FAN ** (DEPTH - 2) + deep
    out[0] = 0
    return out // FAN ** (DEPTH - depth)


class Model:
    """What tasks need besides the weights: totals, and words and tokens of each leaf."""

    def __init__(self, leaf_words: np.ndarray, leaf_tokens: np.ndarray) -> None:
        self.n, self.v = int(leaf_tokens.sum()), int(leaf_words.sum())
        self.depth = next((d for d in range(1, DEPTH) if FAN**d * LEAF_WORDS >= self.v), DEPTH)
        merge = lambda x, d: x.reshape(FAN**d, -1).sum(1).astype(float)
        self.words, self.tokens = merge(leaf_words, self.depth), merge(leaf_tokens, self.depth)
        self.rows = int(np.clip(ROWS_A_ROOT * self.n ** (1 / 3), LEAST_ROWS, MOST_ROWS))
        self.bias = []
        for d in range(1, self.depth + 1):
            t = merge(leaf_tokens, d).reshape(-1, FAN)
            self.bias.append(np.log((t + 1) / (t.sum(1, keepdims=True) + FAN)).astype(np.float32))

    @property
    def shape(self) -> tuple[int, int, int]:
        return self.depth, self.rows, FAN

    def dictionary(self, words: np.ndarray, shapes: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leaf, history code and log10 P(word | leaf) of each word of a chunk."""
        leaf = leaves(words, shapes, self.depth)
        code = np.where(totals >= OFTEN, words, shapes.astype(np.uint64) + np.uint64(2))
        code[0] = END
        inside = np.log10((totals + 1) / (self.tokens[leaf] + self.words[leaf] + 1))
        inside[0] = 0.0
        return leaf, code, inside


def histories(codes: np.ndarray, place: np.ndarray, a: int, b: int) -> np.ndarray:
    """Hashes of the history features of tokens a to b; ``place`` is a token's number in its document, which no history crosses."""
    back, own = [], place[a:b]
    for k in (1, 2, 3):
        c = np.zeros(b - a, np.uint64)
        first = max(0, k - a)
        c[first:] = codes[a + first - k : b - k] if b > k else codes[:0]
        c[own < k] = k
        back.append(mix64(c * np.uint64(0x9E3779B97F4A7C15)))
    one, two, three = back
    return np.stack([one, mix64(one * np.uint64(3) + two), mix64(two + np.uint64(17)), mix64(three + np.uint64(23))])


def _rows(history: np.ndarray, node: np.ndarray, rows: int) -> np.ndarray:
    """Weight rows (feature, token) of the histories at a node."""
    h = history + node.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return ((h * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(32)) * np.uint64(rows) >> np.uint64(32)).view(np.int64)


def _logits(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Logits (child, token), less the largest of each token.  One row a child: sums over children then run along memory."""
    z = weights.take(rows[0], 0)
    for k in range(1, len(rows)):
        z += weights.take(rows[k], 0)
    z += bias.take(node, 0)
    z = np.ascontiguousarray(z.T)
    z -= z.max(0)
    return z


def _levels(history: np.ndarray, leaf: np.ndarray, model: Model) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(level, tokens that pass it, their weight rows, node and child) down the tree; the end token has one level."""
    some = np.arange(len(leaf))
    for d in range(model.depth):
        if d == 1:
            some = np.flatnonzero(leaf >= FAN ** (model.depth - 1))
        own = leaf[some] // FAN ** (model.depth - 1 - d)
        node = own // FAN
        yield d, some, _rows(history[:, some] if d else history, node, model.rows), node, own % FAN


def update(weights: np.ndarray, squares: np.ndarray, used: np.ndarray, model: Model, history: np.ndarray, leaf: np.ndarray, rate: float = RATE) -> None:
    """One AdaGrad step on a minibatch at every level; only the rows of its features change."""
    for d, _, rows, node, y in _levels(history, leaf, model):
        if not len(y):
            continue
        p = np.exp(_logits(weights[d], model.bias[d], rows, node))
        p /= p.sum(0)
        p[y, np.arange(len(y))] -= 1
        flat = rows.ravel()
        times = np.bincount(flat, minlength=weights.shape[1])
        touched = np.flatnonzero(times)
        of = np.empty(weights.shape[1], np.int64)
        of[touched] = np.arange(len(touched))
        flat = of[flat]
        g = np.empty((FAN, len(touched)), np.float32)
        for own, total in zip(p, g, strict=True):  # a child at a time stays in the cache
            total[:] = np.bincount(flat, np.tile(own.astype(np.float64), len(rows)), len(touched))
        g = np.ascontiguousarray(g.T)
        used[d, touched] += times[touched]
        s = squares[d, touched] + g * g
        squares[d, touched] = s
        weights[d, touched] -= rate * g / np.sqrt(s + 1)


def log_shares(weights: np.ndarray, model: Model, history: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """log10 P(leaf | history) of each token."""
    out = np.zeros(len(leaf))
    for d, some, rows, node, y in _levels(history, leaf, model):
        z = _logits(weights[d], model.bias[d], rows, node)
        out[some] += z[y, np.arange(len(y))] - np.log(np.exp(z).sum(0))
    return out / np.log(10)


def _read(batch: pa.RecordBatch) -> Iterator[dict]:
    kinds = {"doc_ids": "<i8", "nulls": np.uint8, "held": np.uint8, "lens": "<i4", "ids": "<i4", "words": np.uint64, "shapes": np.uint8, "totals": "<i8", "ones": np.uint8}
    for k in range(batch.num_rows):
        yield {c: np.frombuffer(batch.column(c)[k].as_buffer(), t) for c, t in kinds.items() if c in batch.schema.names}


def _tokens_of(row: dict, model: Model, train: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Leaf, history code and place of a chunk's tokens (train: those of training documents), and log10 P(word | leaf) of its words."""
    leaf, code, inside = model.dictionary(row["words"], row["shapes"], row["totals"])
    ids, lens = row["ids"], row["lens"].astype(np.int64)
    if train:
        keep = row["held"] == 0
        ids, lens = ids[np.repeat(keep, lens)], lens[keep]
    place = np.arange(len(ids), dtype=np.int32) - np.repeat((np.cumsum(lens) - lens).astype(np.int32), lens)
    return leaf.astype(np.int32)[ids], code[ids], place, inside


def _model(rows: DataFrame) -> Model:
    """Words and tokens of the leaves of the deepest tree; each word counts where its entry stands for it."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_words, n_tokens = np.zeros(FAN**DEPTH, np.int64), np.zeros(FAN**DEPTH, np.int64)
        for batch in batches:
            for row in _read(batch):
                own = (row["ones"] > 0) & (row["totals"] > 0)
                leaf = leaves(row["words"], row["shapes"])[own]
                n_words += np.bincount(leaf, minlength=len(n_words))
                n_tokens += np.bincount(leaf, row["totals"][own], len(n_words)).astype(np.int64)
        some = np.flatnonzero(n_words)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n_words[some]), pa.array(n_tokens[some])], names=["leaf", "words", "tokens"])

    found = rows.select("words", "shapes", "totals", "ones").mapInArrow(sizes, "leaf int, words long, tokens long").groupBy("leaf").agg(F.sum("words").alias("words"), F.sum("tokens").alias("tokens")).toPandas()  # at most FAN ** DEPTH rows
    words, tokens_ = np.zeros(FAN**DEPTH, np.int64), np.zeros(FAN**DEPTH, np.int64)
    words[found["leaf"]], tokens_[found["leaf"]] = found["words"], found["tokens"]
    return Model(words, tokens_)


def learn(rows: DataFrame, model: Model, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (level, row, child) after ``rounds`` of updates in the tasks and averaging in slices."""
    spark = rows.sparkSession
    weights = np.zeros(model.shape, np.float32)
    every, slices = model.depth * model.rows, _buckets(spark)
    cut = np.linspace(0, every, slices + 1).astype(int)
    schema = "slice int, at binary, used binary, change binary"
    names = ["slice", "at", "used", "change"]
    for r in range(rounds):
        shared = spark.sparkContext.broadcast(weights)

        def work(batches: Iterator[pa.RecordBatch], r=r, shared=shared) -> Iterator[pa.RecordBatch]:
            own, squares, used = shared.value.copy(), np.zeros(model.shape, np.float32), np.zeros(model.shape[:2], np.int32)
            for batch in batches:
                for row in _read(batch):
                    leaf, code, place, _ = _tokens_of(row, model, True)
                    for k, a in enumerate(range(0, len(leaf), BATCH)):
                        if k % rounds == r:
                            b = min(a + BATCH, len(leaf))
                            update(own, squares, used, model, histories(code, place, a, b), leaf[a:b])
                    del leaf, code, place  # before the next chunk's
            del squares
            moved, start, used = own.reshape(every, FAN), shared.value.reshape(every, FAN), used.ravel()
            for k in range(slices):  # no second table of all changes
                at = np.flatnonzero(used[cut[k] : cut[k + 1]]) + cut[k]
                if len(at):
                    change = (moved[at] - start[at]).astype("<f2")
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (at.astype("<i4"), used[at].astype("<f4"), change))], names=names)
                    del change
            del own, moved, used
            release()

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for batch in batches:
                for k, at, used, change in zip(*(batch.column(i) for i in range(4)), strict=True):
                    k = k.as_py()
                    total, moved = sums.setdefault(k, (np.zeros(cut[k + 1] - cut[k]), np.zeros((cut[k + 1] - cut[k], FAN), np.float32)))
                    at, used = np.frombuffer(at.as_buffer(), "<i4") - cut[k], np.frombuffer(used.as_buffer(), "<f4")
                    total[at] += used
                    moved[at] += np.frombuffer(change.as_buffer(), "<f2").reshape(-1, FAN) * used[:, None]
            for k, (total, moved) in sums.items():
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in ((at + cut[k]).astype("<i4"), total[at].astype("<f4"), (moved[at] / total[at, None]).astype("<f4")))], names=names)

        changes = rows.select("held", "lens", "ids", "words", "shapes", "totals").mapInArrow(work, schema).repartition(slices, "slice").mapInArrow(add, schema).toPandas()  # the weights in slices
        weights = weights.copy()
        for s in changes.itertuples():
            weights.reshape(every, FAN)[np.frombuffer(s.at, "<i4")] += np.frombuffer(s.change, "<f4").reshape(-1, FAN)
        shared.unpersist()
    return weights


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of ``docs``."""
    spark = docs.sparkSession
    own = [f"lm_{kind}_{uuid.uuid4().hex}" for kind in ("chunks", "totals")]
    made = chunks(docs, own[0])

    def dictionary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                words, shapes, counts = (np.frombuffer(batch.column(c)[k].as_buffer(), t) for c, t in (("words", np.int64), ("shapes", np.uint8), ("counts", "<i4")))
                n = len(words)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, batch.column("chunk")[k].as_py())), pa.array(np.arange(n, dtype=np.int32)), pa.array(words), pa.array(shapes.astype(np.int32)), pa.array(counts)], names=["chunk", "place", "word", "shape", "c"])

    entries = made.select("chunk", "words", "shapes", "counts").mapInArrow(dictionary, "chunk long, place int, word long, shape int, c int")
    same = Window.partitionBy("word")
    entries = entries.withColumn("total", F.sum("c").over(same)).withColumn("one", (F.row_number().over(same.orderBy("chunk")) == 1).cast("int"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Totals of each chunk in order of place, and which entries stand for their word; rows come sorted by chunk and place."""
        chunk, parts = None, []

        def out():
            total, one = (np.concatenate(x) for x in zip(*parts, strict=True))
            return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([total.astype("<i8").tobytes()], pa.binary()), pa.array([one.astype(np.uint8).tobytes()], pa.binary())], names=["chunk", "totals", "ones"])

        for batch in batches:
            c, t, o = (batch.column(k).to_numpy() for k in range(3))
            cuts = [0, *(np.flatnonzero(c[1:] != c[:-1]) + 1).tolist(), len(c)] if len(c) else []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if c[a] != chunk and parts:
                    yield out()
                    parts = []
                chunk = int(c[a])
                parts.append((t[a:b], o[a:b]))
        if parts:
            yield out()

    totals = entries.select("chunk", "place", "total", "one").repartition(_buckets(spark), "chunk").sortWithinPartitions("chunk", "place").select("chunk", "total", "one").mapInArrow(gather, "chunk long, totals binary, ones binary")
    sums = _bucketed(totals, own[1])
    rows = made.drop("counts").join(sums.hint("shuffle_hash"), "chunk")
    model = _model(rows)
    weights = spark.sparkContext.broadcast(learn(rows, model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _read(batch):
                leaf, code, place, inside = _tokens_of(row, model, False)
                logs = inside[row["ids"]]
                for a in range(0, len(leaf), BATCH):
                    b = min(a + BATCH, len(leaf))
                    logs[a:b] += log_shares(weights.value, model, histories(code, place, a, b), leaf[a:b])
                count = row["totals"]
                base = np.log10((count + 1) / (model.n + model.v + 1))
                start = np.cumsum(row["lens"], dtype=np.int64) - row["lens"]
                n = len(start)
                sums_of = lambda x, start=start: np.add.reduceat(x, start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], mask=row["nulls"] > 0), pa.array(row["held"] > 0), pa.array(row["lens"].astype(np.int64)), pa.array(sums_of((count > 0).astype(np.int64)[row["ids"]])), pa.array(np.full(n, model.n, np.int64)), pa.array(sums_of(base[row["ids"]])), pa.array(sums_of(logs))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )
                del leaf, code, place, inside, logs, count, base  # before the next chunk's
        release()

    scored = durable(rows.select("doc_ids", "nulls", "held", "lens", "ids", "words", "shapes", "totals").mapInArrow(work, SCORED), "lm-scores")
    for name in own:
        spark.sql(f"DROP TABLE {name}")
    return scored

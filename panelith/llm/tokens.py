"""Token-ID output: ids of all documents in Re-Pair compressed blocks, written as Parquet and read back.

File format: a Parquet table with a row for each block of about a million ids.  Blocks follow ascending doc_id in order
of ``part`` and ``seq``.  A block holds its documents' ids and lengths (little-endian int64 / int32; the first
``null_ids`` documents have a null id), the grammar
(``left`` and ``right`` of each rule, ``sizes``: how many ids it expands to, ``levels``: first symbol of each round) and
``codes``, the compressed sequence.  ``ends`` has, for each document, where its codes end: no rule spans two documents,
so a document, or a run of ids within it, is decoded alone (``decode_range``).

Re-Pair: each round counts all adjacent pairs of the block exactly, makes rules of the most frequent ones (RULES at most,
those left over wait for the next round) and replaces them from left to right; rounds go on until no pair occurs LEAST
times.  Pairs with a symbol that occurs less often than that cannot, and are passed over.

Encoding: where the tokenizer's own file says that it drops white space and letter case and takes words one by one, a
text's ids are those of its words in turn.  Of each run of rows (STEP_BYTES) the distinct words, told apart by 64-bit
hashes, are encoded once, JOINED at a time, and their ids are copied to all places by numpy; a worker remembers up to
MOST_WORDS words for its later runs of rows.  Any other tokenizer
encodes whole texts.

Defined cases: a null or empty text has just the end id; a null doc_id comes first and stays null; repeated doc_ids stay,
in order of text; a text longer than a block makes a longer block; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _LOWER, by_bytes, hash_spans, pieces, release, ship, small, utf8, word_bounds

END_ID, BLOCK_IDS, STEP_BYTES, JOINED = 2, 1 << 20, 4 << 20, 512
MOST_WORDS = 1 << 20  # chunks that a Python worker remembers, some 40 MB; a longer step is remembered whole
FIRST_RULE, RULES, LEAST, PAIR_BITS = 1 << 17, 1024, 24, 19

BLOCK_SCHEMA = "part int, seq int, first_doc_id long, null_ids int, n_ids long, doc_ids binary, lens binary, left binary, right binary, sizes binary, levels binary, codes binary, ends binary"
_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("first_doc_id", pa.int64()), ("null_ids", pa.int32()), ("n_ids", pa.int64())] + [(c, pa.binary()) for c in ("doc_ids", "lens", "left", "right", "sizes", "levels", "codes", "ends")])


# --- grammar --------------------------------------------------------------------------------------


def frequent_pairs(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Values that occur LEAST times, how often each does, the places that may hold one, and the number of each place's value (-1: none).

    Exact: values are counted in 2^PAIR_BITS buckets, and a bucket that is too small holds no frequent value; values
    that share a bucket are told apart by sorting.
    """
    bucket = (pair.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PAIR_BITS)).view(np.int64)
    count = np.bincount(bucket, minlength=1 << PAIR_BITS)
    place = np.flatnonzero((count >= LEAST)[bucket])
    pair, bucket = pair[place], bucket[place]
    value = np.zeros(1 << PAIR_BITS, np.int64)
    value[bucket] = pair
    shared = np.zeros(1 << PAIR_BITS, bool)
    shared[bucket[value[bucket] != pair]] = True
    alone = np.flatnonzero((count >= LEAST) & ~shared)
    mixed = np.flatnonzero(shared[bucket])
    values, inverse, counts = np.unique(pair[mixed], return_inverse=True, return_counts=True)
    more = np.flatnonzero(counts >= LEAST)
    number = np.full(1 << PAIR_BITS, -1, np.int64)
    number[alone] = np.arange(len(alone))
    number = number[bucket]
    of_more = np.full(len(values), -1, np.int64)
    of_more[more] = np.arange(len(more)) + len(alone)
    number[mixed] = of_more[inverse]
    return np.concatenate([value[alone], values[more]]), np.concatenate([count[alone], counts[more]]), place, number


def repair(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, left, right, levels) of a sequence of ids below FIRST_RULE; END_ID never enters a rule."""
    seq = ids.astype(np.int32)
    left, right, levels = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], []
    top = FIRST_RULE
    while len(seq) > 1:
        often = np.bincount(seq) >= LEAST
        often[END_ID : END_ID + 1] = False
        ok = often[seq]
        both = np.flatnonzero(ok[:-1] & ok[1:])
        pairs, found, place, number = frequent_pairs(seq[both].astype(np.int64) << 32 | seq[both + 1])
        best = np.arange(len(pairs))
        if len(best) > RULES:
            best = np.argpartition(-found, RULES)[:RULES]
        if not len(best):
            break
        rule = np.full(len(pairs) + 1, -1, np.int32)
        rule[best] = np.arange(len(best), dtype=np.int32)
        made = rule[number]
        some = np.flatnonzero(made >= 0)
        at, made = both[place[some]], made[some]
        fresh = np.ones(len(at), bool)
        fresh[1:] = np.diff(at) > 1
        begin = np.maximum.accumulate(np.where(fresh, at, 0))
        take = (at - begin) & 1 == 0
        at = at[take]
        left.append((pairs[best] >> 32).astype(np.int32))
        right.append((pairs[best] & 0xFFFFFFFF).astype(np.int32))
        levels.append(top)
        seq[at] = top + made[take]
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq = seq[stay]
        top += len(best)
    return seq, np.concatenate(left), np.concatenate(right), np.asarray(levels, np.int32)


def expansion_sizes(left: np.ndarray, right: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """How many ids each rule stands for."""
    sizes = np.ones(len(left), np.int32)
    ends = [*levels[1:].tolist(), FIRST_RULE + len(left)][: len(levels)]
    one = lambda s: np.where(s >= FIRST_RULE, sizes[np.maximum(s - FIRST_RULE, 0)], 1) if len(sizes) else np.ones(len(s), np.int32)
    for a, b in zip(levels.tolist(), ends, strict=True):
        k = slice(a - FIRST_RULE, b - FIRST_RULE)
        sizes[k] = one(left[k]) + one(right[k])
    return sizes


def expand(codes: np.ndarray, left: np.ndarray, right: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The ids that ``codes`` stand for: undoes the rounds, the last first."""
    seq = codes
    for level in levels[::-1].tolist():
        at = np.flatnonzero(seq >= level)
        if not len(at):
            continue
        rules = seq[at] - FIRST_RULE
        out = np.empty(len(seq) + len(at), np.int32)
        shift = np.zeros(len(seq) + 1, np.int32)
        shift[at + 1] = 1
        place = np.arange(len(seq), dtype=np.int32) + np.cumsum(shift[:-1], dtype=np.int32)
        out[place] = seq
        out[place[at]] = left[rules]
        out[place[at] + 1] = right[rules]
        seq = out
    return seq


class Block:
    """A block as it was read: decodes whole, one document, or a run of ids within a document."""

    def __init__(self, row: dict) -> None:
        of = lambda c, t: np.frombuffer(row[c], t)
        self.doc_ids, self.lens, self.ends = of("doc_ids", "<i8"), of("lens", "<i4"), of("ends", "<i4")
        self.left, self.right, self.levels = of("left", "<i4"), of("right", "<i4"), of("levels", "<i4")
        self.sizes, self.codes = of("sizes", "<i4"), of("codes", "<i4")

    def ids(self) -> np.ndarray:
        return expand(self.codes, self.left, self.right, self.levels)

    def decode_range(self, doc: int, a: int, b: int) -> np.ndarray:
        """Ids a to b of the block's document number ``doc``, expanding only the codes that they need."""
        codes = self.codes[self.ends[doc - 1] if doc else 0 : self.ends[doc]]
        size = np.where(codes >= FIRST_RULE, self.sizes[np.maximum(codes - FIRST_RULE, 0)] if len(self.sizes) else 1, 1)
        stop = np.cumsum(size)
        i, j = np.searchsorted(stop, a, "right"), np.searchsorted(stop, b, "left") + 1
        skip = a - (stop[i - 1] if i else 0)
        return expand(codes[i:j], self.left, self.right, self.levels)[skip : skip + b - a]


# --- encoding -------------------------------------------------------------------------------------

_TOKENIZERS: dict = {}

# The settings of a tokenizer (as in its file) whose ids of a text are those of the text's words in turn.
_DROPS_SPACE = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_WORD_END = "</w>"


def tokenizer(path: str):
    """(tokenizers-library tokenizer, which ids end a piece or None), once for each Python worker.

    The second is given only for a tokenizer that takes words one by one: it drops white space and letter case, its
    pieces are those of _PIECES, and the last id of each piece is marked.
    """
    if path not in _TOKENIZERS:
        import json

        from tokenizers import Tokenizer

        model, ends = Tokenizer.from_file(path), None
        with open(path) as f:
            own = json.load(f)
        first = ((own.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        by_piece = (own.get("normalizer") or {}).get("normalizers") == _DROPS_SPACE and first.get("pattern") == {"Regex": _PIECES} and first.get("behavior") == "Removed"
        if by_piece and own["model"].get("end_of_word_suffix") == _WORD_END:
            ends = np.zeros(max(model.get_vocab().values()) + 1, bool)
            ends[[i for t, i in model.get_vocab().items() if t.endswith(_WORD_END)]] = True
        _TOKENIZERS[path] = model, ends
    return _TOKENIZERS[path]


def _encode_joined(model, ends: np.ndarray, chunks: list[str], one: bool) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids of each chunk) of chunks that are encoded joined by spaces.  one: each is a single piece for the tokenizer."""
    ids, lens = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for k in range(0, len(chunks), JOINED * 16):
        groups = [chunks[j : j + JOINED] for j in range(k, min(len(chunks), k + JOINED * 16), JOINED)]
        texts = [" ".join(g) for g in groups]
        for some, text, e in zip(groups, texts, (model.encode_batch_fast if one else model.encode_batch)(texts, add_special_tokens=False), strict=True):
            own = np.asarray(e.ids, np.int32)
            n = np.diff(np.flatnonzero(ends[own]), prepend=-1) if one else ()
            if len(n) != len(some):  # not single pieces: by the offsets of the ids
                e = model.encode(text, add_special_tokens=False) if one else e
                n = np.diff(np.searchsorted(np.asarray([a for a, _ in e.offsets], np.int64), np.cumsum([0, *(len(w) + 1 for w in some)])))
            ids.append(own)
            lens.append(n)
    return np.concatenate(ids), np.concatenate(lens)


_ALPHA = np.zeros(256, bool)
_ALPHA[[*range(65, 91), *range(97, 123)]] = True
_STOP = np.zeros(256, bool)
_STOP[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_STOP[ord("'")] = False


def _chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of the chunks of a column's bytes: words, with the signs behind a last letter as a chunk of its own.

    Letter case counts for nothing, as the tokenizer ignores it.  Where special tokens may be about, case counts and
    words stay whole.
    """
    special = b"<|" in data.tobytes()
    lower = np.arange(256, dtype=np.uint8) if special else _LOWER
    starts, ends, hashes = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, np.uint64)]
    for a, b in pieces(data, offsets):
        d = data[a:b]
        start, end = word_bounds(d, offsets[(offsets > a) & (offsets < b)] - a)
        if not special:
            cut = np.flatnonzero(_STOP[d[end - 1]])
            at = end[cut] - 1
            while True:
                more = np.flatnonzero((at > start[cut]) & _STOP[d[at - 1]])
                if not len(more):
                    break
                at[more] -= 1
            good = (at > start[cut]) & _ALPHA[d[at - 1]]
            cut, at = cut[good], at[good]
            whole = end[cut]
            end[cut] = at
            start, end = np.insert(start, cut + 1, at), np.insert(end, cut + 1, whole)
        starts.append((start + a).astype(np.int32))
        ends.append((end + a).astype(np.int32))
        hashes.append(hash_spans(lower[d], start, end))
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


class Known:
    """The ids of the chunks that this Python worker has encoded so far, by hash: later steps and tasks take them from here."""

    def __init__(self) -> None:
        self.words, self.at, self.lens, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def places(self, words: np.ndarray) -> np.ndarray:
        """Where each of ``words`` stands, -1 for those not known."""
        at = np.searchsorted(self.words, words)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == words, at, -1) if len(self.words) else np.full(len(words), -1)

    def add(self, words: np.ndarray, ids: np.ndarray, lens: np.ndarray) -> None:
        order = np.argsort(words)
        to = np.searchsorted(self.words, words[order])
        at = (np.cumsum(lens) - lens + len(self.ids)).astype(np.int32)
        self.words, self.at, self.lens = np.insert(self.words, to, words[order]), np.insert(self.at, to, at[order]), np.insert(self.lens, to, lens[order].astype(np.int32))
        self.ids = np.concatenate([self.ids, ids])


_KNOWN: dict[str, Known] = {}


def encode_column(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids of each text) of a string column, without end ids; each distinct chunk is encoded once.

    A tokenizer that does not take words one by one encodes whole texts.
    """
    model, ends = tokenizer(path)
    if ends is None:
        made = [np.asarray(e.ids, np.int32) for e in model.encode_batch_fast(column.fill_null("").to_pylist(), add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.int32), *made]), np.fromiter(map(len, made), np.int64, len(made))
    data, offsets = utf8(column)
    start, end, h = _chunks(data, offsets)
    coded = pa.array(h).dictionary_encode()
    which, words = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    first = np.empty(len(words), np.int64)
    first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
    del h, coded
    known = _KNOWN.setdefault(path, Known())
    fresh = np.flatnonzero(known.places(words) < 0)
    if len(known.words) + len(fresh) > MOST_WORDS:  # begin anew: the same ids, encoded again
        known = _KNOWN[path] = Known()
        fresh = np.arange(len(words))
    first = first[fresh]
    raw = data.tobytes()
    some = [raw[a:b].decode() for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
    del raw, first
    single = np.fromiter((w.isalpha() for w in some), bool, len(some))
    for one in (True, False):
        k = np.flatnonzero(single == one)
        known.add(words[fresh[k]], *_encode_joined(model, ends, [some[i] for i in k.tolist()], one))
    del some
    own = known.places(words)
    flat, at, lens = known.ids, known.at[own], known.lens[own]
    n = lens[which]
    stop = np.cumsum(n, dtype=np.int32)
    place = np.repeat(at[which] - (stop - n), n)
    place += np.arange(len(place), dtype=np.int32)
    return flat[place], np.diff(np.concatenate([[0], stop])[np.searchsorted(start, offsets)])


def _block(part: int, seq: int, doc_ids: pa.Array, lens: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    codes, left, right, levels = repair(ids)
    sizes = expansion_sizes(left, right, levels)
    known = doc_ids.fill_null(0).to_numpy()
    row = {"doc_ids": np.asarray(known, "<i8"), "lens": np.asarray(lens, "<i4"), "left": left, "right": right, "sizes": sizes, "levels": levels, "codes": codes}
    own = np.where(codes >= FIRST_RULE, sizes[np.maximum(codes - FIRST_RULE, 0)], 1) if len(sizes) else np.ones(len(codes), np.int32)
    row["ends"] = np.searchsorted(np.cumsum(own), np.cumsum(row["lens"])) + 1
    made = {k: [v.astype("<i8" if k == "doc_ids" else "<i4").tobytes()] for k, v in row.items()}
    first = None if doc_ids.null_count else int(known[0])
    return pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "first_doc_id": [first], "null_ids": [doc_ids.null_count], "n_ids": [len(ids)]} | made, schema=_ARROW)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Encodes ``docs`` in ascending doc_id order and writes the blocks to ``path``."""
    ship(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size = 0

        def block() -> pa.RecordBatch:
            doc_ids, lens, ids = zip(*held, strict=True)
            held.clear()
            return _block(part, seq, pa.concat_arrays(doc_ids), np.concatenate(lens), np.concatenate(ids))

        for step in by_bytes(batches, 1, STEP_BYTES):
            ids, lens = encode_column(step.column(1), tokenizer_path)
            ids = np.insert(ids, np.cumsum(lens), end_id)
            lens = lens + 1
            stop = np.cumsum(lens)
            k = 0
            while k < len(lens):  # a block takes documents until it has block_ids
                before = int(stop[k - 1]) if k else 0
                j = min(len(lens), int(np.searchsorted(stop, before + block_ids - size)) + 1)
                held.append((step.column(0)[k:j], lens[k:j], ids[before : stop[j - 1]].copy()))
                size += int(stop[j - 1]) - before
                k = j
                if size >= block_ids:
                    yield block()
                    seq, size = seq + 1, 0
            del ids
        if held:
            yield block()
        release()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(encode, BLOCK_SCHEMA).write.parquet(path)


def read_tokens(spark, path: str) -> DataFrame:
    """Blocks as they lie in the files."""
    return spark.read.schema(BLOCK_SCHEMA).parquet(path)


def document_digests(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, part, seq of each document, from the files at ``path``."""
    ship(spark)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                raw = memoryview(block.ids().astype("<u4").tobytes())
                end = np.cumsum(block.lens, dtype=np.int64)
                begin = end - block.lens
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
                n = len(end)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["seq"], np.int32)), pa.array(block.doc_ids, mask=np.arange(n) < row["null_ids"]), pa.array(begin), pa.array(block.lens.astype(np.int64)), pa.array(crc, pa.int64())],
                    names=["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    blocks = read_tokens(spark, path)
    heads = blocks.select("part", "seq", "n_ids")
    in_part = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    over_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = heads.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    parts = parts.select("part", (F.sum("ids").over(over_parts) - F.col("ids")).alias("part_start"))
    starts = heads.withColumn("in_part", F.sum("n_ids").over(in_part) - F.col("n_ids")).join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("in_part")).alias("block_start"))
    rows = blocks.mapInArrow(decode, "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return rows.join(small(starts, 200_000), ["part", "seq"]).select("doc_id", (F.col("block_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "part", "seq")

"""Benchmark decontamination by spaced-seed hashing, with DataFrame functions only.

A spaced seed is a fixed mask over neighbouring tokens whose gaps are ignored, so a substituted word in a gap costs
nothing.  The benchmark's seeds are hashed and keyed by their longest token (the anchor).  Documents are exploded to
tokens; tokens that are no anchor end there, inside the scan.  Around an anchor the seed's hash is taken from the
document and looked up; a hit fixes how item and document lie against each other.  Each such way is kept once, however
many seeds hit it, and the whole item is compared there once, word by word: matches count +1, substitutions -2, and the
best stretch scores.  So work is linear in the length of an item.

A pair is reported when the best stretch reaches LEAST, or when FRACTION of the item's words match in place.  An item
of fewer words than a mask spans is one seed without gaps and is found where all of its words match.

Benchmark seeds and texts are broadcast in blocks of about BLOCK_BYTES of text (summed first), so the corpus is never
shuffled for the search; only ways are (ids and numbers, pre-aggregated), and then the texts that have one, once.

Defined cases: null or empty text holds nothing; items of fewer than ``min_words`` words (default 0: all are searched)
are left out; repeated documents or items give a pair each id; empty tables give an empty result; further columns are
ignored.  Tokens are runs of letters and digits, lower-cased; a Chinese or Japanese character is a token of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, small

# The masks, as offsets of the tokens that count.
MASKS = ((0, 1, 3, 4, 6), (0, 1, 2, 5, 6), (0, 2, 3, 6, 7))
LEAST, FRACTION, SUBSTITUTION, BLOCK_BYTES = 10, 0.7, -2, 4 << 20
ROW = ("doc_id", "text_hash")  # rows of equal id and text are one: they hold the same items
_ALONE = "[\\u3040-\\u30ff\\u3400-\\u4dbf\\u4e00-\\u9fff]"


def tokens(text: str = "text") -> Column:
    t = F.coalesce(F.col(text), F.lit(""))
    t = F.when(t.rlike(_ALONE), F.regexp_replace(t, _ALONE, " $0 ")).otherwise(t)
    return F.split(F.lower(t), "[^\\p{L}\\p{N}]+")


def _seed_hash(words: str, at: Column, mask: tuple[int, ...]) -> Column:
    return F.xxhash64(*[F.get(F.col(words), at + k) for k in mask])


def _items(benchmark: DataFrame, min_words: int) -> DataFrame:
    """item_id, key (a hash of the words), words of each item."""
    items = benchmark.select("item_id", F.filter(tokens(), lambda w: w != "").alias("words")).filter(F.size("words") >= max(1, min_words))
    return items.select("item_id", F.xxhash64(F.array_join("words", " ")).alias("key"), "words")


def seeds(texts: DataFrame, masks: dict[int, tuple[int, ...]], spaced: int) -> DataFrame:
    """key, place, mask, hash, anchor, off: each seed of each text with its longest token and that token's offset.

    The first ``spaced`` masks are for texts that are long enough; the others, by number of words, for short ones.
    """
    span = max(masks[m][-1] for m in range(spaced)) + 1
    per = []
    for m, mask in masks.items():
        last = F.size("words") - mask[-1] - 1
        own = texts.filter(F.size("words") >= span) if m < spaced else texts.filter(F.size("words") == len(mask))
        one = own.select("key", "words", F.explode(F.sequence(F.lit(0), last)).alias("place"))
        longest = F.array_max(F.array(*[F.struct(F.length(F.get("words", F.col("place") + k)).alias("n"), F.get("words", F.col("place") + k).alias("w"), F.lit(k).alias("off")) for k in mask]))
        per.append(one.select("key", "place", F.lit(m).alias("mask"), _seed_hash("words", F.col("place"), mask).alias("hash"), longest["w"].alias("anchor"), longest["off"].alias("off")))
    out = per[0]
    for p in per[1:]:
        out = out.unionByName(p)
    return out


def _search(docs: DataFrame, items: DataFrame, spaced: tuple) -> DataFrame:
    span = max(mask[-1] for mask in spaced) + 1
    short = [r.n for r in items.select(F.size("words").alias("n")).filter(F.col("n") < span).distinct().collect()]  # fewer than ``span`` rows
    masks = dict(enumerate(spaced)) | {len(spaced) + n: tuple(range(n)) for n in sorted(short)}
    texts = items.groupBy("key").agg(F.first("words").alias("words"))
    found = seeds(texts, masks, len(spaced))
    anchors = found.groupBy("anchor").agg(F.collect_set(F.struct("mask", "off")).alias("ways"))
    hits = found.groupBy("hash", "mask").agg(F.collect_list(F.struct("key", "place")).alias("items"))
    rows = docs.select(*ROW, tokens().alias("t")).select(*ROW, "t", F.posexplode("t").alias("pos", "token"))
    rows = rows.join(F.broadcast(anchors), F.col("token") == F.col("anchor")).select(*ROW, "t", "pos", F.explode("ways").alias("w"))
    rows = rows.select(*ROW, "t", F.col("w.mask").alias("m"), (F.col("pos") - F.col("w.off")).alias("begin")).filter("begin >= 0")
    hashed = F.lit(None).cast("long")
    for m, mask in masks.items():
        hashed = F.when(F.col("m") == m, _seed_hash("t", F.col("begin"), mask)).otherwise(hashed)
    rows = rows.select(*ROW, "m", "begin", hashed.alias("h")).join(F.broadcast(hits), (F.col("h") == F.col("hash")) & (F.col("m") == F.col("mask")))
    rows = rows.select(*ROW, "begin", F.explode("items").alias("i")).select(*ROW, F.col("i.key").alias("key"), (F.col("begin") - F.col("i.place")).alias("shift"))
    ways = durable(rows.distinct(), "benchmark-ways")  # a way an item may lie against a text, however many of its seeds hit
    asked = ways.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("x"), "key", "shift")
    there = small(asked.select("d", "x").distinct(), 500_000)
    own = (F.col("doc_id").eqNullSafe(F.col("d"))) & (F.col("text_hash") == F.col("x"))
    texts_hit = docs.join(there, own, "left_semi").groupBy(*ROW).agg(F.first("text").alias("text")).select(*ROW, tokens().alias("t"))
    rows = texts_hit.join(asked, own).join(F.broadcast(texts), "key")
    first = F.greatest(F.col("shift"), F.lit(0))
    rows = rows.select(*ROW, "key", "shift", "words", F.slice("t", first + 1, F.greatest(F.size("words") + F.col("shift") - first, F.lit(0))).alias("part"))
    zero = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"), F.lit(0).alias("same"))
    lying = F.when(F.col("shift") < 0, F.slice("words", 1 - F.col("shift"), F.size("words"))).otherwise(F.col("words"))  # words before the text's start match nothing
    alike = F.zip_with(lying, "part", lambda w, t: F.coalesce(w == t, F.lit(False)))

    def step(s: Column, same: Column) -> Column:
        run = F.greatest(F.lit(0), s["run"] + F.when(same, 1).otherwise(SUBSTITUTION))
        return F.struct(run.alias("run"), F.greatest(s["best"], run).alias("best"), (s["same"] + same.cast("int")).alias("same"))

    rows = rows.withColumn("v", F.aggregate(alike, zero, step)).select(*ROW, "key", F.size("words").alias("item_words"), F.col("v.best").alias("best"), F.col("v.same").alias("same"))
    enough = F.when(F.col("item_words") < span, F.col("same") == F.col("item_words")).otherwise((F.col("best") >= LEAST) | (F.col("same") >= FRACTION * F.col("item_words")))
    return rows.filter(enough).groupBy(*ROW, "key").agg(F.max("item_words").alias("item_words"), F.max("same").alias("matched_words"), F.max("best").alias("best_stretch"))


def _found(docs: DataFrame, benchmark: DataFrame, masks: tuple, min_words: int, block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, key and measures of each text and item found in it; the items)."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-size // block_bytes))
    items, out = _items(benchmark, min_words), None
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    for b in range(blocks):
        part = _search(rows, items if blocks == 1 else items.filter(F.pmod("key", F.lit(blocks)) == b), masks)
        out = part if out is None else out.unionByName(part)
    return out, items


def contaminated(docs: DataFrame, benchmark: DataFrame, masks: tuple = MASKS, min_words: int = 0, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, item_words, matched_words, best_stretch of each pair of a document and an item found in it."""
    found, items = _found(docs, benchmark, masks, min_words, block_bytes)
    named = small(items.select(F.col("key").alias("k"), "item_id").distinct(), 500_000)
    pairs = found.join(named, F.col("key") == F.col("k")).select("doc_id", "item_id", "item_words", "matched_words", "best_stretch")
    return pairs.groupBy("doc_id", "item_id").agg(F.max("item_words").alias("item_words"), F.max("matched_words").alias("matched_words"), F.max("best_stretch").alias("best_stretch"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found, columns as they were, whatever their names.

    A row is known by its doc_id (null is one like any other) and the hash of its text, so rows that share a doc_id are
    judged each by its own text.
    """
    found, _ = _found(docs.select("doc_id", "text"), benchmark, MASKS, 0, BLOCK_BYTES)
    bad = durable(found.select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct(), "contaminated")
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    doc_id, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    same = doc_id.eqNullSafe(F.col("bad_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("bad_hash"))
    return plain.join(small(bad, 500_000), same, "left_anti").toDF(*docs.columns)

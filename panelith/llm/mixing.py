"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source repeats whole while its target allows and gives the rest as a random part.  Its documents are dealt by
hash into blocks of about a thousand; the blocks drawn for the mix are the units.  A binary tree over the output
shards splits the number of units of every source exactly: a node draws how many of each source go left from the
multivariate hypergeometric law, so each shard's make-up is what a full shuffle would have given.  A shard then takes
disjoint runs of each source's permuted units and orders its rows by hash locally: ``write`` lays the mix out in a folder
for each shard, whose files hold runs of rows in that order.

The only global tables are per source (target, quotas) and per block; nothing per document leaves its task except to
be shuffled by block.  The block that crosses a source's target is cut by a running sum inside that block alone: a
random run of its documents, then its smallest others to fill the gap.

A row is known by a 64-bit hash of its doc_id, source and text; rows that agree in all three share their draws evenly.
The sources (their sizes, targets and quotas) go to the driver: one short row for each.

Defined cases: null text has size 0; a null source is a source of its own, last in order; documents of size 0 go
along with their block; repeated rows count each for itself; a null doc_id is a value like any other; an empty table
gives an empty result; further columns are ignored by ``draw`` and kept by ``mixed``; the same input gives the same
draws (all randomness is a hash of row, block and ``seed``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, durable, small

BLOCK_DOCS, REPEATS, FILE_WORDS = 1024, 3, 1 << 24


def row_key() -> Column:
    """A hash of doc_id, source and text that tells a null from any value."""
    return F.xxhash64("doc_id", F.col("source").isNull(), "source", F.col("text").isNull(), "text", F.col("doc_id").isNull())


def size_column(text: str = "text"):
    """Words of a text: white-space-separated pieces that are not empty."""
    parts = F.split(F.coalesce(F.col(text), F.lit("")), SPACES)
    edge = lambda k: (F.element_at(parts, k) == "").cast("int")
    return F.when(F.coalesce(F.col(text), F.lit("")) == "", 0).otherwise(F.greatest(F.lit(0), F.size(parts) - edge(1) - F.when(F.size(parts) > 1, edge(-1)).otherwise(0))).cast("long")


def targets(sizes: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """source, n, source_size, target: weights 1, 2, 3, 1, ... by source order share all words, at most ``repeats`` times a source's own.

    Sharing the excess again and again ends at one level t with target = least of cap and t * weight; t follows from
    running sums over the sources by cap / weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    s = s.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double")).withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
    whole = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("total", F.sum("source_size").over(whole).cast("double")).withColumn("weights", F.sum("weight").over(whole))
    s = s.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    s = s.withColumn("level", F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level")))
    s = s.withColumn("level", F.min_by("level", F.when(F.col("level").isNotNull(), F.col("cap") / F.col("weight"))).over(whole))
    return s.select("source", "n", "source_size", F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def split_tree(units: list[int], shards: int, seed: int) -> list[list[int]]:
    """For each shard how many units of each source it takes: exact in sum, drawn node by node."""
    rng = np.random.default_rng(seed)
    out: list[list[int]] = []

    def node(have: np.ndarray, k: int) -> None:
        if k == 1:
            out.append(have.tolist())
            return
        go = int(have.sum()) * (k // 2) // k
        left = rng.multivariate_hypergeometric(have, go, method="marginals") if go else np.zeros_like(have)
        node(left, k // 2)
        node(have - left, k - k // 2)

    node(np.asarray(units, np.int64), shards)
    return out


def draw(docs: DataFrame, shards: int = 16, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(plan, units).  plan: doc_id, source, key, size, source_size, target, shards (an entry for each time the mix takes the row), taken.

    units: source, epoch, block, shard.
    """
    spark = docs.sparkSession
    sizes = durable(docs.select("doc_id", "source", row_key().alias("key"), size_column().alias("size")), "mix-sizes")
    goal = durable(targets(sizes), "mix-targets")
    per = goal.withColumn("blocks", F.ceil(F.col("n") / BLOCK_DOCS)).withColumn("name", F.to_json(F.struct("source"))).drop("source", "n")
    sizes = sizes.withColumn("name", F.to_json(F.struct("source"))).join(small(per, 200_000), "name").withColumn("block", F.pmod(F.xxhash64("key", F.lit(seed)), F.col("blocks")))
    shuffled = Window.partitionBy("name").orderBy(F.xxhash64("block", F.lit(seed + 1)), "block")
    blocks = sizes.groupBy("name", "block").agg(F.sum("size").alias("words"), F.first("target").alias("target"), F.first("source_size").alias("source_size"))
    blocks = blocks.withColumn("full", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1)).withColumn("left", F.col("target") - F.col("full") * F.col("source_size"))
    blocks = blocks.withColumn("start", F.sum("words").over(shuffled.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words"))
    blocks = durable(blocks.withColumn("part", F.when(F.col("start") + F.col("words") <= F.col("left"), 2).when(F.col("start") < F.col("left"), 1).otherwise(0)).select("name", "block", "full", "left", "start", "part"), "mix-blocks")
    units = blocks.select("name", "block", F.explode(F.sequence(F.lit(1), F.col("full") + F.when(F.col("part") > 0, 1).otherwise(0))).alias("epoch")).filter(F.col("epoch") >= 1)
    units = units.join(blocks.select("name", "block", "full", "part"), ["name", "block"]).filter((F.col("epoch") <= F.col("full")) | (F.col("part") > 0))
    turn = Window.partitionBy("name").orderBy(F.xxhash64("epoch", "block", F.lit(seed + 2)), "epoch", "block")
    units = units.select("name", "block", "epoch", (F.col("epoch") > F.col("full")).alias("last"), (F.row_number().over(turn) - 1).alias("place"))
    counts = {r.name: r["count"] for r in units.groupBy("name").count().collect()}
    names = sorted(counts)
    ends = np.cumsum(np.asarray(split_tree([counts[s] for s in names], shards, seed), np.int64).reshape(shards, len(names)), axis=0)
    quota = spark.createDataFrame([(s, ends[:, i].tolist()) for i, s in enumerate(names)], "name string, ends array<long>")
    units = durable(units.join(small(quota, 200_000), "name").withColumn("shard", F.expr("size(filter(ends, e -> e <= place))")).select("name", "epoch", "block", "last", "shard"), "mix-units")
    taken = units.groupBy("name", "block").agg(F.collect_list(F.when(~F.col("last"), F.col("shard"))).alias("always"), F.max(F.when(F.col("last"), F.col("shard"))).alias("once"))
    rows = sizes.join(blocks.select("name", "block", "left", "start", "part"), ["name", "block"]).join(taken, ["name", "block"], "left")
    block = Window.partitionBy("name", "block")
    inside = block.orderBy(F.xxhash64("key", F.lit(seed + 3)), "key").rowsBetween(Window.unboundedPreceding, 0)
    cut = rows.filter("part = 1").withColumn("upto", F.col("start") + F.sum("size").over(inside))
    cut = cut.withColumn("fits", F.col("upto") <= F.col("left")).withColumn("gap", F.col("left") - F.coalesce(F.max(F.when(F.col("fits"), F.col("upto"))).over(block), F.col("start")))
    rising = Window.partitionBy("name", "block", "fits").orderBy("size", F.xxhash64("key", F.lit(seed + 4)), "key").rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumn("chosen", F.col("fits") | (F.sum("size").over(rising) - F.col("size") / 2 <= F.col("gap"))).drop("upto", "fits", "gap")
    rows = rows.filter("part <> 1").withColumn("chosen", F.col("part") == 2).unionByName(cut)
    shard_list = F.concat(F.coalesce("always", F.array().cast("array<int>")), F.when(F.col("chosen") & F.col("once").isNotNull(), F.array("once")).otherwise(F.array().cast("array<int>")))
    plan = rows.withColumn("shards", shard_list).select("doc_id", "source", "key", "size", "source_size", "target", "shards", (F.size("shards") * F.col("size")).cast("long").alias("taken"))
    return plan, units


def _rows(docs: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """mix_key, mix_row, mix_words, mix_shard, mix_order and ``row`` (a whole row of ``docs``), each as often as drawn."""
    times = plan.groupBy("key").agg(F.flatten(F.collect_list("shards")).alias("drawn"), F.count("*").alias("rows"), F.first("size").alias("mix_words"))
    times = durable(times.filter("size(drawn) > 0"), "mix-times")
    rows = docs.select(row_key().alias("mix_key"), F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"))
    again = Window.partitionBy("mix_key").orderBy(F.lit(1))
    rows = rows.withColumn("mix_row", F.lit(0) if times.filter("rows > 1").isEmpty() else F.row_number().over(again) - 1)
    rows = rows.join(small(times, 500_000), F.col("mix_key") == F.col("key"))
    rows = rows.withColumn("mix_shard", F.explode(F.expr("filter(drawn, (s, i) -> pmod(i, rows) = mix_row)")))
    return rows.select("mix_key", "mix_row", "mix_words", "mix_shard", F.xxhash64("mix_key", "mix_row", "mix_shard", F.lit(seed)).alias("mix_order"), "row")


def _shuffled(rows: DataFrame, words: int, shards: int) -> DataFrame:
    """``rows`` dealt to tasks by shard and run of its order, about FILE_WORDS words each, and sorted."""
    parts = max(1, -(-words // (shards * FILE_WORDS)))
    run = (F.shiftright("mix_order", 40) + (1 << 23)) * parts
    return rows.withColumn("mix_run", F.shiftright(run, 24).cast("int")).repartition("mix_shard", "mix_run").sortWithinPartitions("mix_shard", "mix_order").drop("mix_run")


def _words(plan: DataFrame) -> int:
    return plan.agg(F.coalesce(F.sum("taken"), F.lit(0)).alias("n")).first().n


def mixed(docs: DataFrame, shards: int = 16, seed: int = 7) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as drawn, with mix_shard and mix_order, shuffled: sorted by both in every task."""
    plan = durable(draw(docs, shards, seed)[0], "mix-plan")
    rows = _shuffled(_rows(docs, plan, seed), _words(plan), shards)
    return rows.select(*(F.col("row")[c].alias(c) for c in docs.columns if c not in ("mix_shard", "mix_order")), "mix_shard", "mix_order")


def write(docs: DataFrame, path: str, shards: int = 16, seed: int = 7) -> DataFrame:
    """Writes the mix to ``path``, a folder for each shard, and returns what it holds of each row of ``docs``.

    doc_id, size, source_size, target, taken (words of the row in the files, read back), shards (one entry for each time).
    """
    plan = durable(draw(docs, shards, seed)[0], "mix-plan")
    rows = _shuffled(_rows(docs, plan, seed), _words(plan), shards)
    rows = rows.select(*(F.col("row")[c].alias(c) for c in docs.columns if not c.startswith("mix_")), "mix_key", "mix_row", "mix_words", "mix_order", "mix_shard")
    rows.write.partitionBy("mix_shard").parquet(path)
    found = docs.sparkSession.read.schema("mix_key long, mix_row int, mix_words long, mix_shard int").parquet(path)
    found = found.groupBy("mix_key", "mix_row").agg(F.sum("mix_words").alias("taken"), F.sort_array(F.collect_list("mix_shard")).alias("shards"))
    every = plan.withColumn("mix_row", F.lit(0))
    if not plan.groupBy("key").count().filter("count > 1").isEmpty():
        every = plan.withColumn("mix_row", F.row_number().over(Window.partitionBy("key").orderBy(F.lit(1))) - 1)
    every = every.select("doc_id", "key", "mix_row", "size", "source_size", "target")
    joined = every.join(found, (F.col("key") == F.col("mix_key")) & (every["mix_row"] == found["mix_row"]), "left")
    return joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.coalesce("shards", F.array().cast("array<int>")).alias("shards"))

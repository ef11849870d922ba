"""Resharding by minimum-cost flow: from old shard sizes to new capacities with the fewest bytes moved.

Rows are gathered into blocks by a hash of their text, inside their old shard, so that equal texts lie in one block.
A block heavier than a fiftieth of a new shard is cut further by another hash of the text.  A text whose copies are
heavier than that (a group may hold a third of all rows) is a block of its own; it is cut by doc_id into pieces, for
the tasks, but all pieces go to one shard unless they outweigh a whole one: only then are equal texts parted.
The flow network has one node for each old and new shard; a byte that stays costs nothing, one that moves
costs 1.  The flow is solved on the driver, whose tables have at most old * blocks + 100 * new rows whatever the input.
Blocks then follow the flow, largest first, and rows get gapless slots: block offsets plus a rank inside the block.
``reshard`` gives this layout, ``rewrite`` carries it out.  Rows take their places as whole rows, in one shuffle, and
are never joined by doc_id, so repeated and null doc_ids are rows like any other.

Defined cases: null text counts 0 bytes (plus the row overhead); an empty table gives an empty result; repeated rows
each get a slot of their own; a row without an old shard is new and always moves; equal texts in different old shards
are moved each for itself; ``reshard`` ignores further columns, ``rewrite`` keeps them.  A shard may exceed its capacity
by less than a block.  ``docs`` is read twice and must give the same rows each time.
"""

from __future__ import annotations

from collections import defaultdict, deque

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from .common import durable

OVERHEAD, HEAVY, PARTS = 8, 50, 512
PLACE = ("shard", "slot", "old_shard")


def min_cost_flow(supply: list[int], capacity: list[int]) -> dict[tuple[int, int], int]:
    """Flow of bytes (old, new) that empties ``supply`` into ``capacity``; staying (old == new) costs 0, moving 1.

    Successive shortest paths on the residual network; needs sum(capacity) >= sum(supply).
    """
    old, new = len(supply), len(capacity)
    source, sink = old + new, old + new + 1
    room: dict[tuple[int, int], int] = {}
    cost: dict[tuple[int, int], int] = {}
    edges: dict[int, list[int]] = defaultdict(list)

    def edge(a: int, b: int, most: int, each: int) -> None:
        room[a, b], room[b, a], cost[a, b], cost[b, a] = most, 0, each, -each
        edges[a].append(b)
        edges[b].append(a)

    for i, s in enumerate(supply):
        edge(source, i, s, 0)
        for j in range(new):
            edge(i, old + j, s, int(i != j))
    for j, c in enumerate(capacity):
        edge(old + j, sink, c, 0)
    while True:
        best, via, queue = {source: 0}, {}, deque([source])
        while queue:
            a = queue.popleft()
            for b in edges[a]:
                if room[a, b] > 0 and best[a] + cost[a, b] < best.get(b, 1 << 60):
                    best[b], via[b] = best[a] + cost[a, b], a
                    queue.append(b)
        if sink not in best:
            break
        path, at = [], sink
        while at != source:
            path.append((via[at], at))
            at = via[at]
        amount = min(room[e] for e in path)
        for a, b in path:
            room[a, b] -= amount
            room[b, a] += amount
    return {(i, j): room[old + j, i] for i in range(old) for j in range(new) if room[old + j, i]}


def place_blocks(blocks: list[tuple], capacity: list[int], old: int) -> list[tuple]:
    """(block key, shard) for (key, old shard, bytes): blocks follow the flow, the largest first, into what is left of it."""
    supply = [0] * old
    for _, i, size in blocks:
        supply[i] += size
    shards = len(capacity)
    left: dict[int, dict[int, int]] = defaultdict(dict)
    for (i, j), amount in min_cost_flow(supply, capacity).items():
        left[i][j] = amount
    room, out = list(capacity), []
    for key, i, size in sorted(blocks, key=lambda b: (-b[2], b[0])):
        ways = left[i] or {0: 0}
        j = max(ways, key=lambda j: (ways[j], j == i, -j))
        if room[j] < size:  # what blocks cannot cut evenly goes where most room is
            j = max(range(shards), key=lambda k: (room[k] >= size and k in ways, room[k], -k))
        if j in ways:
            ways[j] -= size
        room[j] -= size
        out.append((key, j))
    return out


def _rows(docs: DataFrame, old_shards: int, blocks: int, old_shard: Column | str | None) -> DataFrame:
    """Each row of ``docs`` (whole, in ``row``) with its size, hashes, old shard (``home``: -1 for none) and block."""
    b = F.coalesce("text", F.lit("")).cast("binary")
    old = F.pmod(F.crc32(b), F.lit(old_shards)) if old_shard is None else F.col(old_shard) if isinstance(old_shard, str) else old_shard
    return docs.select(
        "doc_id",
        (F.octet_length(b) + OVERHEAD).cast("long").alias("size"),
        F.crc32(b).alias("text_crc32"),
        old.cast("int").alias("old_shard"),
        F.coalesce(old.cast("int"), F.lit(-1)).alias("home"),
        F.xxhash64(b).alias("same"),
        F.pmod(F.xxhash64(b), F.lit(blocks)).cast("int").alias("block"),
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
    )


KEY = ["home", "block", "cut"]


def _cut(rows: DataFrame, cuts: list[tuple], heavy: list[tuple]) -> DataFrame:
    """``rows`` with their cut: of a heavy text a piece by doc_id, under the text's own block number; of a heavy block a part by text."""
    spark = rows.sparkSession
    many = spark.createDataFrame(cuts, "home int, block int, cuts long")
    own = spark.createDataFrame(heavy, "home int, same long, own int, pieces long")
    rows = rows.join(F.broadcast(own), ["home", "same"], "left").join(F.broadcast(many), ["home", "block"], "left")
    by_text, by_row = (F.pmod(F.xxhash64(*c, F.lit(3)), F.coalesce(n, F.lit(1))).cast("int") for c, n in ((("same",), "cuts"), (("doc_id", "text_crc32"), "pieces")))
    return rows.withColumn("cut", F.when(F.col("own").isNotNull(), by_row).otherwise(by_text)).withColumn("block", F.coalesce("own", "block")).drop("cuts", "own", "pieces")


def _plan(rows: DataFrame, shards: int, blocks: int, capacities: list[int] | None) -> tuple[list[tuple], list[tuple], list[tuple]]:
    """Cuts of heavy blocks, heavy texts, and for each block (home, block, cut, shard, part, first slot); a part is a run of a shard's slots."""
    sums = rows.groupBy("home", "block").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    total = sum(r.size for r in sums)
    if capacities is None:
        capacities = [total * (j + 1) // shards - total * j // shards for j in range(shards)]
    if len(capacities) != shards or sum(capacities) < total:
        raise ValueError(f"{shards} capacities of {total} bytes at least are needed, not {capacities}")
    if min((r.home for r in sums), default=0) < -1:
        raise ValueError("old shards are numbered from 0")
    limit = max(1, total // (shards * HEAVY))
    texts = rows.groupBy("home", "same").agg(F.sum("size").alias("size"), F.count("*").alias("n")).filter((F.col("size") > limit) & (F.col("n") > 1))
    texts = texts.orderBy("home", "same").collect()  # fewer than shards * HEAVY rows
    heavy = [(r.home, r.same, blocks + k, min(-(-r.size // limit), r.n)) for k, r in enumerate(texts)]
    cuts = [(r.home, r.block, min(-(-r.size // limit), r.n)) for r in sums if r.size > limit and r.n > 1]
    table = _cut(rows, cuts, heavy).groupBy(*KEY).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    of = {tuple(r[k] for k in KEY): r for r in table}
    whole = {blocks + k for k, r in enumerate(texts) if r.size <= max(capacities)}
    groups: dict[tuple, list[tuple]] = defaultdict(list)
    for k in sorted(of):
        groups[k[:2] if k[1] in whole else k].append(k)
    new = max([shards, *(r.home + 1 for r in sums)])  # stands for no old shard, and is no new one
    placed = place_blocks([(g, g[0] if g[0] >= 0 else new, sum(of[k].size for k in keys)) for g, keys in groups.items()], capacities, new + 1)
    filled, written, lines = [0] * shards, [0] * shards, []
    for k, j in sorted((k, j) for g, j in placed for k in groups[g]):
        lines.append((*k, j, written[j] * PARTS // max(1, total), filled[j]))
        filled[j] += of[k].n
        written[j] += of[k].size
    return cuts, heavy, lines


def _placed(rows: DataFrame, cuts: list[tuple], heavy: list[tuple], lines: list[tuple], order: list) -> DataFrame:
    """``rows`` with shard and slot; the rows of a part are shuffled to one task, where they lie by slot."""
    plan = rows.sparkSession.createDataFrame(lines, "home int, block int, cut int, shard int, part int, base long")
    rank = Window.partitionBy("shard", "part", *KEY).orderBy(*order)
    rows = _cut(rows, cuts, heavy).join(F.broadcast(plan), KEY).repartition("shard", "part")
    return rows.withColumn("slot", F.col("base") + F.row_number().over(rank) - 1)


def reshard(docs: DataFrame, shards: int, old_shards: int = 16, blocks: int = 256, old_shard: Column | str | None = None, capacities: list[int] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, old_shard, shard, slot, moved for each row: the new layout of ``docs``.

    ``old_shard`` says where a row lies now (default: a hash of its text over ``old_shards``); ``capacities`` are the
    bytes of each new shard (default: equal ones).
    """
    rows = durable(_rows(docs, old_shards, blocks, old_shard).drop("row"), "reshard-rows")
    cuts, heavy, lines = _plan(rows, shards, blocks, capacities)
    return _placed(rows, cuts, heavy, lines, ["doc_id", "text_crc32", "size"]).select("doc_id", "size", "text_crc32", "old_shard", "shard", "slot", (~F.col("shard").eqNullSafe(F.col("old_shard"))).alias("moved"))


def rewrite(docs: DataFrame, path: str, shards: int, old_shards: int = 16, blocks: int = 256, old_shard: Column | str | None = None, capacities: list[int] | None = None, every: bool = False) -> list[int]:
    """Writes the files of every shard that gains or loses rows under ``path``, and returns these shards.

    A shard has a folder, whose files hold runs of slots in order, with all columns of ``docs`` but those of an earlier
    place (PLACE), and slot and old_shard.  ``path`` must not exist: nothing is overwritten, and the files of other
    shards stay valid where they are (``read_store`` puts both together).  ``every``: writes other shards too, for
    ``docs`` that do not lie in shard files yet.
    """
    rows = _rows(docs, old_shards, blocks, old_shard)
    cuts, heavy, lines = _plan(durable(rows.drop("row"), "reshard-rows"), shards, blocks, capacities)
    touched = sorted({s for home, _, _, shard, *_ in lines if home != shard for s in (home, shard) if s >= 0})
    if not every:
        lines = [x for x in lines if x[3] in touched]
    placed = _placed(rows, cuts, heavy, lines, ["doc_id", "text_crc32", "size", F.xxhash64("row")])
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in PLACE]
    placed.select(*kept, "slot", "old_shard", "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return touched


def read_store(spark: SparkSession, schema: StructType, path: str, before: str | None = None, touched: list[int] | None = None) -> DataFrame:
    """The store that ``rewrite`` wrote of documents of this schema; with the untouched shards of the store ``before``."""
    schema = StructType([f for f in schema.fields if f.name not in PLACE]).add("slot", LongType()).add("old_shard", IntegerType()).add("shard", IntegerType())
    found = spark.read.schema(schema).parquet(path)
    if before is None:
        return found
    return found.unionByName(spark.read.schema(schema).parquet(before).filter(~F.col("shard").isin(touched or [])))

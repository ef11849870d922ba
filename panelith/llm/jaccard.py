"""N-gram Jaccard join by size-aware heavy and light sets, returned as connected components.

Equal sets are one set from the start.  The rest follows their size:

* Light sets (fewer than x shingles) enumerate the fixed-size subsets that a partner of each possible size must share;
  two sets link if and only if they meet in such a subset, so nothing is verified and groups are joined as stars.
* Heavy sets, and light ones near the border, are brought together by parts: linked sets differ in at most H shingles, so
  of H + 1 + SPARE parts (shingles dealt by hash) some part that is not empty is the same in both.  H follows from the
  size class.  Large sets use fewer and larger parts, of which so many are given out that a linked pair shares none of
  them with a chance under e^-CERTAIN, less than that of a hash collision.  Parts of few sets are counted by pair, and a
  pair goes on that shares as many as a linked pair of its sizes must (``least_shared``); parts of more than FEW_SETS sets
  are joined as stars, never as pairs.  Connected components of both are families.  Each family is joined in tasks of
  bounded blocks: the inverted lists of all its shingles are scanned for exact intersection sizes, and only a spanning
  forest of the links leaves a task.

  Shingles that very many documents share (a bounded list) stay out of the parts that hold others too, so that a common
  passage does not tie unlike documents together.  The list steers cost alone: ``part_keys`` says why no link hangs on
  what is in it; the chance to miss a pair stays under e^-31.

The border x has the least total cost over the sizes found in the table.

A family larger than a block is cut by size class, and a class into blocks that meet pairwise, and those of the next
class, in separate tasks, so memory stays bounded; the work grows with the square of a class of one family in blocks.

Defined cases: null or empty text has the empty set, links with nothing and is its own component; fewer words than a
shingle count as one shingle; equal texts and repeated rows fall together; rows with a null doc_id link like others and
take the smallest id of their group (null where it has none); ``one_of_each`` keeps a group's row of smallest doc_id,
nulls last, then by a hash of the text; an empty table gives an empty result; further columns are ignored.  Shingles are
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_bytes, durable, mix64, plainly, ship, small, word_hashes
from .graph import components

SPARE, CERTAIN, EMPTY, LIST_COST, BLOCK_SETS, BLOCK_SHINGLES = 3, 36, 1 / 8, 4, 1024, 1 << 20
FEW_SETS, UNLIKELY, EMPTY_ANEW = 32, 31, 1 / 4  # rows of a part that is counted by pair; e^-UNLIKELY is the chance to miss a pair
POPULAR, POPULAR_LOCAL = 1 << 17, 3
_SLOT = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct k-word shingles of each text."""
    h, at = word_hashes(column)
    n = np.diff(at)
    total = len(h)
    grams = np.zeros(max(0, total - k + 1), np.uint64)
    for j in range(k):
        grams += h[j : j + len(grams)] * _SLOT[j % 64]
    grams = mix64(grams)
    out = []
    for a, m in zip(at[:-1].tolist(), n.tolist(), strict=True):
        if m >= k:
            s = np.sort(grams[a : a + m - k + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif m:
            out.append(mix64(np.array([(h[a : a + m] * _SLOT[:m]).sum() + np.uint64(m)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(s: np.ndarray) -> int:
    """64-bit fingerprint of a set."""
    if not len(s):
        return 0
    total = (mix64(s * np.uint64(0x9E3779B97F4A7C15)).sum() + np.uint64(len(s))).reshape(1)
    return int(mix64(total).view(np.int64)[0])


def least_common(n: int, m: int, percent: int) -> int:
    """The smallest intersection with which sets of sizes n and m link."""
    return -(-percent * (n + m) // (100 + percent))


def partners(n: int, percent: int) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def subset_count(n: int, percent: int) -> int:
    """How many fixed-size subsets a set of size n enumerates."""
    return sum(comb(n, c) for m in partners(n, percent) if (c := least_common(n, m, percent)) <= min(n, m) and not (n == m == c))


def size_bounds(percent: int) -> np.ndarray:
    """Least sizes of the size classes; linked sets lie in one class or in neighbouring ones."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] * 100 // percent, out[-1] * 11 // 10) + 1)
    return np.asarray(out, np.int64)


def most_differing(bounds: np.ndarray, percent: int) -> np.ndarray:
    """H for each join of classes c - 1 and c: the most shingles in which linked sets of these sizes differ."""
    return 2 * (bounds[1:] - 1) * (100 - percent) // (100 + percent)


def part_plan(most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parts, parts given out) for each H.

    A part stays untouched by H differing shingles with chance e^-x if there are H / x parts; the larger x, the more
    shingles a part holds and the fewer unlike sets share it.  The largest x is taken for which enough parts can be
    given out; where none is, all of H + 1 + SPARE parts are, and the pigeonhole principle makes sure.
    """
    parts, given = most + 1 + SPARE, most + 1 + SPARE
    for x in (1.0, 1.25, 1.5, 2.0, 2.5, 3.0):
        need = int(np.ceil(CERTAIN / -np.log1p(-np.exp(-x))))
        fits = np.ceil(most / x) >= need
        parts, given = np.where(fits, np.ceil(most / x).astype(np.int64), parts), np.where(fits, need, given)
    return parts, given


def part_count(n: int, percent: int) -> int:
    """How many parts a set of size n gives out."""
    bounds = size_bounds(percent)
    k = int(np.searchsorted(bounds, n, "right")) - 1
    return int(part_plan(most_differing(bounds, percent))[1][k : k + 2].sum())


def border(sizes: dict[int, int], percent: int) -> int:
    """The x of least cost: sets below it enumerate subsets, sets from it on share parts and scan lists."""
    best, costs = 1, {1: sum(c * part_count(n, percent) * LIST_COST for n, c in sizes.items())}
    for x in range(2, 25):
        gone = x - 1
        costs[x] = costs[x - 1] + sizes.get(gone, 0) * (subset_count(gone, percent) - part_count(gone, percent) * LIST_COST)
        if costs[x] <= costs[best]:
            best = x
    return best


def part_keys(sets: list[np.ndarray], percent: int, bounds: np.ndarray, popular: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, set number) of the parts of each set, for the joins with its own class and its two neighbours.

    A part's key is a hash of its shingles without the popular ones, or of all of them where only those are in it.
    Parts of the latter kind are given out unless the others are enough: linked sets of which each gives all parts have
    more than SPARE parts alike, so a set with at most SPARE such parts can do without them; and of a set with R other
    shingles at least R - H are in both, which leave an untouched part without any with chance EMPTY at most if there are
    log(1 / EMPTY) to a part.  Either rule can be left to one side alone: what holds for one set holds for the pair.

    A set with too few deals its shingles ``dealings`` times instead, each time anew, and gives what parts hold, popular
    shingles only if need be; a part without any shingle would tie all sets that miss it.  Joins of sets so small that
    parts often hold none give out all, as only the pigeonhole principle makes sure there.
    """
    most = most_differing(bounds, percent)
    all_parts, all_given = part_plan(most)
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    kind = np.searchsorted(bounds, n, "right") - 1
    values, whose = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    rare = np.ones(len(values), bool)
    if len(popular):
        rare = popular[np.minimum(np.searchsorted(popular, values), len(popular) - 1)] != values
    n_rare = np.bincount(whose[rare], minlength=len(sets))
    values = mix64(values * np.uint64(0xC2B2AE3D27D4EB4F))
    keys, owners = [], []
    times = dealings(bounds, percent)
    for step in (0, 1):
        join = kind + step
        parts, given, again = all_parts[join], all_given[join], times[join]
        anew, bare = np.ones(len(sets), bool), n_rare - most[join] < -np.log(EMPTY_ANEW) * parts
        for deal in range(max(1, int(again.max(initial=0)))):
            if deal:
                anew = ~enough & (again > deal)
                if not anew.any():
                    break
            mine = anew[whose]
            some_values, some_whose, some_rare = (values, whose, rare) if not deal else (mix64(values[mine] + np.uint64(deal)), whose[mine], rare[mine])
            low, high = (some_values & np.uint64(0xFFFFFFFF)).astype(float), (some_values >> np.uint64(32)).astype(float)
            given_now = np.where(anew, given, 0)
            base = np.cumsum(given_now) - given_now
            total = int(given_now.sum())
            part = (some_values % parts[some_whose].astype(np.uint64)).astype(np.int64)
            out = part < given_now[some_whose]
            content = []
            for some in (out & some_rare, out):
                place = (base[some_whose[some]] + part[some]) if some.any() else np.zeros(0, np.int64)
                count = np.bincount(place, minlength=total)
                a, b = (np.bincount(place, x[some], total).astype(np.uint64) for x in (low, high))
                content.append((count, a + (b << np.uint64(32)) + count.astype(np.uint64)))
            (count, content_rare), (count_all, content_all) = content
            owner = np.repeat(np.arange(len(sets)), given_now)
            number = np.arange(total) - np.repeat(base, given_now)
            if not deal:
                empty = np.bincount(owner[count == 0], minlength=len(sets))
                enough = np.where(parts == given, empty <= SPARE, n_rare - most[join] >= -np.log(EMPTY) * parts)
            give = (count > 0) | (~enough & ((again == 0) | bare))[owner] & ((count_all > 0) | (again == 0)[owner])
            salt = ((np.repeat(join, given_now).astype(np.uint64) << np.uint64(40)) + (np.uint64(deal) << np.uint64(32)) + number.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            keys.append(mix64(mix64(np.where(count > 0, content_rare, content_all)) ^ salt)[give])
            owners.append(owner[give])
    return np.concatenate(keys), np.concatenate(owners)


def _untouched(parts: np.ndarray, differing: np.ndarray, empty: float) -> np.ndarray:
    """The least chance of a part to be left alone by ``differing`` shingles and to hold another, as it does with chance 1 - ``empty``."""
    return (1 - 1 / parts) ** differing * (1 - empty)


def dealings(bounds: np.ndarray, percent: int) -> np.ndarray:
    """How often a set whose parts are not enough deals its shingles, by join, that no part alike has a chance under e^-UNLIKELY; 0 where sets are too small."""
    most = most_differing(bounds, percent)
    parts, given = part_plan(most)
    least = np.concatenate([[0], bounds[:-2]])  # the smallest set of a join
    times = np.ceil(UNLIKELY / (-np.log1p(-_untouched(parts, most, EMPTY_ANEW)) * given)).astype(np.int64)
    return np.where(least - most >= -np.log(EMPTY_ANEW) * parts, times, 0)


def least_shared(n: np.ndarray, m: np.ndarray, percent: int, bounds: np.ndarray) -> np.ndarray:
    """How many keys of ``part_keys`` linked sets of sizes n and m share at least; where such sizes cannot link, more than there are.

    The sets differ in d shingles at most, which follows from n and m.  Where all parts are given out, all but d are alike,
    of which SPARE may be held back.  Otherwise each stays untouched and is given with some chance, and that ``a`` or fewer
    do has (by Chernoff's bound, as one part touched makes the others less likely to be) a chance under e^-UNLIKELY.
    Sets of one class meet in two joins.
    """
    all_parts, all_given = part_plan(most_differing(bounds, percent))
    times = dealings(bounds, percent)
    d = (n + m) * (100 - percent) // (100 + percent)
    kinds = [np.searchsorted(bounds, x, "right") - 1 for x in (n, m)]
    high = np.maximum(*kinds)

    def likely(given: np.ndarray, p: np.ndarray) -> np.ndarray:
        sure = np.ones(len(given), np.int64)
        for a in range(1, 64):
            share = np.minimum(a / given, p)
            sure += given * (share * np.log(share / p) + (1 - share) * np.log((1 - share) / (1 - p))) >= UNLIKELY
        return sure

    def in_join(join: np.ndarray) -> np.ndarray:
        parts, given = all_parts[join], all_given[join]
        once = np.where(parts == given, np.maximum(1, parts - d - SPARE), likely(given, _untouched(parts, d, EMPTY)))
        anew = likely(given * np.maximum(1, times[join]), _untouched(parts, d, EMPTY_ANEW))
        return np.where(times[join] > 0, np.minimum(once, anew), once)

    least = in_join(high) + np.where(kinds[0] == kinds[1], in_join(high + 1), 0)
    return np.where(100 * np.minimum(n, m) >= percent * np.maximum(n, m), least, np.iinfo(np.int64).max)


def _subset_keys(s: np.ndarray, percent: int, below: int) -> tuple[list[int], list[int]]:
    """(keys, partner sizes) of the fixed-size subsets of a light set, for partners of sizes under ``below``."""
    n, keys, sizes = len(s), [], []
    values = [int(v) for v in mix64(s * np.uint64(0xC2B2AE3D27D4EB4F))]
    whole, mask = sum(values), (1 << 64) - 1
    for m in partners(n, percent):
        c = least_common(n, m, percent)
        if m >= below or c > min(n, m) or n == m == c:
            continue
        salt = (min(n, m) << 20 | max(n, m)) * 0x9E3779B97F4A7C15
        for dropped in combinations(values, n - c):
            keys.append((whole - sum(dropped)) * 0xD6E8FEB86659FD93 + salt & mask)
            sizes.append(m)
    return keys, sizes


def _table(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


class _Forest:
    """Union-find over the sets of one task."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, a: int) -> int:
        while self.up[a] != a:
            self.up[a] = a = self.up[self.up[a]]
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def forest_of_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets``: inverted lists of all shared shingles are scanned, so sizes are exact."""
    n = len(sets)
    if n < 2:
        return []
    sizes = np.fromiter(map(len, sets), np.int64, n)
    owner = np.repeat(np.arange(n), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    v, who = values[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
    length = np.diff(np.append(first, len(v)))
    lists = np.repeat(np.arange(len(first)), length)
    of = np.empty(len(v), np.int64)
    of[order] = lists
    starts = np.concatenate([[0], np.cumsum(sizes)])
    forest, out = _Forest(n), []
    for a in range(1, n):
        mine = of[starts[a] : starts[a + 1]]
        mine = mine[length[mine] > 1]
        if not len(mine):
            continue
        size = length[mine]
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        common = np.bincount(who[np.repeat(first[mine], size) + inside], minlength=n)[:a]
        for b in np.flatnonzero(common * (100 + percent) >= percent * (sizes[a] + sizes[:a])).tolist():
            if common[b] and forest.join(a, b):
                out.append((a, b))
    return out


def _linked(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, h (a hash of the text), n, root (a set of its component, null for the empty set) for each row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "h", "n", "sid", "shingle", "times"]
        for batch in by_bytes(batches, 2):
            sets = shingle_sets(batch.column(2), words)
            n = len(sets)
            none = pa.nulls(n, pa.int64())
            sids = np.fromiter(map(set_id, sets), np.int64, n)
            yield _table(names, batch.column(0), batch.column(1), np.fromiter(map(len, sets), np.int64, n), sids, none, none)
            _, first = np.unique(sids, return_index=True)
            every = np.sort(np.concatenate([*(sets[i] for i in first.tolist()), np.zeros(0, np.uint64)]))
            start = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, int)
            times = np.diff(np.append(start, len(every)))
            often = times >= POPULAR_LOCAL
            none = pa.nulls(int(often.sum()), pa.int64())
            yield _table(names, none, none, none, none, every[start[often]].view(np.int64), times[often].astype(np.int64))

    found = durable(texts.mapInArrow(measure, "doc_id long, h long, n long, sid long, shingle long, times long"), "jaccard-sets")
    sets = found.filter("n is not null").select("doc_id", "h", "n", "sid")
    popular = found.filter("shingle is not null").groupBy("shingle").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "shingle").limit(POPULAR).select("shingle").toPandas()
    common = spark.sparkContext.broadcast(np.sort(popular["shingle"].to_numpy(np.int64).view(np.uint64)))
    distinct = sets.filter("n > 0").groupBy("sid", "n").agg(F.min(_first()).alias("row"))
    x = border({r.n: r["count"] for r in distinct.filter("n < 32").groupBy("n").count().collect()}, percent)
    bounds = size_bounds(percent)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "sid", "n", "m"]
        seen: set[int] = set()
        for batch in by_bytes(batches, 2):
            keys, owners, sizes, asked, heavy, heavy_sid = [], [], [], [], [], []
            for s in shingle_sets(batch.column(2), words):
                n, sid = len(s), set_id(s)
                if not n or sid in seen:  # copies of a set post once
                    continue
                if len(seen) < 200_000:
                    seen.add(sid)
                if n < x:
                    some, partner = _subset_keys(s, percent, x)
                    keys += some
                    asked += partner
                    owners += [sid] * len(some)
                    sizes += [n] * len(some)
                if 100 * n >= percent * x:
                    heavy.append(s)
                    heavy_sid.append(sid)
            if heavy:
                key, owner = part_keys(heavy, percent, bounds, common.value)
                size = np.fromiter(map(len, heavy), np.int32, len(heavy))
                yield _table(names, key.view(np.int64), np.asarray(heavy_sid, np.int64)[owner], size[owner], np.zeros(len(key), np.int32))
            if keys:
                yield _table(names, mix64(np.asarray(keys, np.uint64)).view(np.int64), np.asarray(owners, np.int64), np.asarray(sizes, np.int32), np.asarray(asked, np.int32))

    rows = texts.mapInArrow(post, "key long, sid long, n int, m int")
    group = Window.partitionBy("key")
    near = rows.select("*", F.min("sid").over(group).alias("low"), F.max("sid").over(group).alias("high"), F.min("n").over(group).alias("n0"), F.max("n").over(group).alias("n1"), F.count("*").over(group).alias("rows"))
    near = near.filter("low < high and (m = 0 or sid <> low and (n = m or n0 < n1))").select("key", "sid", "n", "low", (F.col("m") > 0).alias("light"), (F.col("rows") > FEW_SETS).alias("many"))
    near = durable(near, "jaccard-near")
    star = near.filter("sid <> low").select(F.col("sid").alias("a"), F.col("low").alias("b"), "light", "many").distinct()
    groups = near.filter("not light and not many").groupBy("key").agg(F.sort_array(F.collect_set(F.struct("sid", "n"))).alias("s"))
    pair = "explode(flatten(transform(s, (x, i) -> transform(slice(s, i + 2, size(s)), y -> struct(x.sid AS a, y.sid AS b, x.n AS n, y.n AS m))))) AS pair"
    pairs = groups.select(F.expr(pair)).select("pair.*").groupBy("a", "b", "n", "m").agg(F.count("*").alias("shared"))

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, m, shared = (batch.column(c).to_numpy() for c in range(5))
            keep = shared >= least_shared(n.astype(np.int64), m.astype(np.int64), percent, bounds)
            yield _table(["a", "b"], a[keep], b[keep])

    ties = star.filter("many and not light").select("a", "b").unionByName(pairs.mapInArrow(alike, "a long, b long"))
    families = durable(components(ties), "jaccard-families")

    members = distinct.join(families.withColumnRenamed("node", "sid"), "sid").select(F.col("row.doc_id").alias("d"), F.col("row.h").alias("e"), "sid", "n", F.col("root").alias("family"))
    members = durable(members, "jaccard-members")
    # A family that fits a block is one task.  A larger one is parted by size class, as links do not go beyond the next one, and classes into blocks.
    totals = members.groupBy("family").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    large = (F.col("sets") > BLOCK_SETS) | (F.col("shingles") > BLOCK_SHINGLES)
    kind = F.size(F.filter(F.array(*[F.lit(int(v)) for v in bounds]), lambda v: v <= F.col("n")))
    members = members.join(totals.select("family", large.alias("large")), "family").withColumn("kind", F.when(F.col("large"), kind).otherwise(0)).drop("large")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    rising = Window.partitionBy("family").orderBy("kind")
    kinds = members.groupBy("family", "kind").agg(blocks)
    for name, at in (("below", F.lag), ("above", F.lead)):
        kinds = kinds.withColumn(name, F.when(F.abs(at("kind").over(rising) - F.col("kind")) == 1, at("blocks").over(rising)).otherwise(0))
    members = members.join(kinds, ["family", "kind"]).withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    full = texts.join(small(members, 400_000), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("e")))

    def upto(n: str):
        return F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))

    def task(c, i, c2, j):
        return F.struct(c.alias("c"), i.alias("i"), c2.alias("c2"), j.alias("j"))

    k, own = F.col("kind"), F.col("block")
    tasks = F.concat(
        F.transform(upto("blocks"), lambda j: task(k, F.least(own, j), k, F.greatest(own, j))),
        F.transform(upto("above"), lambda j: task(k, own, k + 1, j)),
        F.transform(upto("below"), lambda j: task(k - 1, j, k, own)),
    )
    where = ["family", "c", "i", "c2", "j"]
    full = full.select("family", "sid", "text", F.explode(tasks).alias("t")).select("family", "t.*", "sid", "text")
    full = full.repartition(*where).sortWithinPartitions(*where, "sid")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, held = None, [], []

        def links():
            made = forest_of_links(held, percent)
            return _table(["a", "b"], np.asarray([ids[a] for a, _ in made], np.int64), np.asarray([ids[b] for _, b in made], np.int64))

        for batch in by_bytes(batches, 6):
            *place, sid = (batch.column(c).to_pylist() for c in range(6))
            for now, own, s in zip(zip(*place, strict=True), sid, shingle_sets(batch.column(6), words), strict=True):
                if set_id(s) != own or (now == key and ids and ids[-1] == own):  # a repeated row
                    continue
                if now != key:
                    if len(held) > 1:
                        yield links()
                    key, ids, held = now, [], []
                ids.append(own)
                held.append(s)
        if len(held) > 1:
            yield links()

    links = full.mapInArrow(verify, "a long, b long").unionByName(star.filter("light").select("a", "b"))
    roots = components(links).withColumnRenamed("node", "sid")
    return sets.join(roots, "sid", "left").select("doc_id", "h", "n", F.when(F.col("n") > 0, F.coalesce("root", "sid")).alias("root"))


def _first() -> Column:
    """Orders a group's rows: the first one by this stands for the group."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs``; sets link at ``percent`` % of their union or more."""
    linked = _linked(docs, k, percent)
    least = linked.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return linked.join(least, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each component, columns as they were, whatever their names."""
    return plainly(docs, ("doc_id", "text"), lambda plain: _one_of_each(plain, k, percent))


def _one_of_each(docs: DataFrame, k: int, percent: int) -> DataFrame:
    linked = _linked(docs, k, percent).filter("root is not null")
    best = linked.groupBy("root").agg(F.min(_first()).alias("best"))
    rows = linked.join(best, "root").groupBy("doc_id", "h").agg(F.max(_first() == F.col("best")).alias("first"), F.count("*").alias("times"))
    rows = durable(rows.filter(~F.col("first") | (F.col("times") > 1)).select(F.col("doc_id").alias("jaccard_doc"), F.col("h").alias("jaccard_h"), "first"), "jaccard-rows")
    same = F.col("doc_id").eqNullSafe(F.col("jaccard_doc")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("jaccard_h"))
    stay = docs.join(small(rows.filter("not first"), 500_000), same, "left_anti")
    again = rows.filter("first")
    if not again.isEmpty():
        once = small(again, 500_000)
        twice = stay.join(once, same, "left_semi").dropDuplicates(["doc_id", "text"])
        stay = stay.join(once, same, "left_anti").unionByName(twice)
    return stay.select(docs.columns)

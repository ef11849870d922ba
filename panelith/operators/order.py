"""Places, ranks and exact percentiles within groups, for groups of any size.

A group (a date, say) of up to ``most`` rows is ordered by a window in one task.  Where any group is larger, the work is
spread over tasks and gives the same values:

* places and ranks: rows are sorted in ranges, each range is counted, and the counts before it give its offset;
* percentiles: approximate quantiles (a mergeable sketch) split each group into buckets, buckets are counted, and only
  the few buckets that hold a wanted place are looked into.  What is selected is exact, whatever the splitters are.

No task holds more than a range or the distinct values of a bucket; a value that fills a third of a group is one of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import average_rank, upto
from ..sources.store import stored

PARTITION_BITS = 33  # of monotonically_increasing_id: below them the row within a partition
ONE_TASK = 1_000_000  # rows of a group that one task may order
TASK_ROWS, MOST_TASKS = 250_000, 8192  # rows that ``dealt`` gives a task on the average
BROADCAST_ROWS = 200_000
SALTS, SPLITTERS = 32, 1024


def largest(df: DataFrame, by: Sequence[str]) -> int:
    """Rows of the largest group; each task counts its own first."""
    return df.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def dealt(df: DataFrame, by: Sequence[str], rows: int) -> DataFrame:
    """``df`` dealt by group over as many tasks as ``rows`` rows need; left to the planner, a task would get what a setting says."""
    return df.repartition(max(1, min(MOST_TASKS, -(-rows // TASK_ROWS))), *by)


def spread_out(df: DataFrame, by: Sequence[str], most: int, spread: bool | None) -> bool:
    """Whether groups go over several tasks: as told, or measured."""
    return largest(df, by) > most if spread is None else spread


def grouped(df: DataFrame, by: Sequence[str], facts: Mapping[str, Column], spread: bool) -> DataFrame:
    """``df`` with aggregates of its row's group: by a window, or, spread out, by a table of groups joined back."""
    if not spread:
        w = Window.partitionBy(*by)
        return df.withColumns({k: c.over(w) for k, c in facts.items()})
    df = stored(df)
    return with_facts(df, df.groupBy(*by).agg(*[c.alias(k) for k, c in facts.items()]), by)


def with_facts(df: DataFrame, facts: DataFrame, by: Sequence[str]) -> DataFrame:
    """``df`` with the columns of ``facts`` (at most one row a group, nulls are groups); rows of a large group never meet.

    A short table is broadcast.  A long one is repeated for each of a few salts, which part the rows of a large group.
    """
    own = [c for c in facts.columns if c not in by]
    if not by:
        return df.crossJoin(F.broadcast(facts))  # one row
    side = facts.select(*[F.col(c).alias(f"_by_{c}") for c in by], *own)
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    if side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        out = df.join(F.broadcast(side), same, "left")
    else:
        side = side.withColumn("_side_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        out = salted.join(side, [*same, F.col("_salt") == F.col("_side_salt")], "left").drop("_salt", "_side_salt")
    return out.drop(*[f"_by_{c}" for c in by])


# --- places and ranks -----------------------------------------------------------------------------


def numbered(df: DataFrame, order: Sequence[str | Column], out: str = "place") -> DataFrame:
    """``df`` with the place (from 1) of each row in ``order``; which of rows that tie in all of ``order`` comes first is open.

    The sorted ranges are written once, as places must not change when a range is computed again.
    """
    rows = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", PARTITION_BITS)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a partition
    offsets = counts.select("_part", before.alias("_before"))
    placed = rows.join(F.broadcast(offsets), part == F.col("_part"))
    return placed.withColumn(out, F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << PARTITION_BITS) - 1)) + 1).drop("_id", "_part", "_before")


def places(df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str, counts: Mapping[str, Column] | None = None, most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """``df`` with the place (from 1) of each row within its group, and with aggregates ``counts`` of its group."""
    counts = dict(counts or {})
    if not spread_out(df, by, most, spread):
        w = Window.partitionBy(*by)
        return df.withColumn(out, F.row_number().over(w.orderBy(*order)).cast("long")).withColumns({k: c.over(w) for k, c in counts.items()})
    rows = numbered(df, [*[F.col(c).asc() for c in by], *order], "_at")
    facts = rows.groupBy(*by).agg(F.min("_at").alias("_first"), *[c.alias(k) for k, c in counts.items()])
    return with_facts(rows, facts, by).withColumn(out, F.col("_at") - F.col("_first") + 1).drop("_at", "_first")


def mean_ranks(df: DataFrame, x: str, by: Sequence[str], out: str, most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """``df`` with the rank of ``x`` within its group; ties share their mean rank.  ``x`` must not be null."""
    if not spread_out(df, by, most, spread):
        return df.withColumn(out, average_rank(F.col(x), by, x))
    columns = df.columns
    apart = F.xxhash64(*[F.col(f"`{c}`") for c in columns])  # spreads the rows of one value over ranges
    rows = places(df, by, [F.col(x).asc(), apart.asc()], "_own", spread=True)
    ties = stored(rows.groupBy(*by, x).agg(F.count("*").alias("_n"), ((F.min("_own") + F.max("_own")) / F.lit(2.0)).alias("_tied")).filter("_n > 1"))
    heavy, light = ties.filter(F.col("_n") > most), ties.filter(F.col("_n") <= most)  # heavy ones: at most rows / most
    keys = [*by, x]
    marked = with_facts(rows, heavy.select(*keys, "_tied"), keys)
    done = marked.filter("_tied is not null").select(*columns, F.col("_tied").alias(out))
    side = light.select(*[F.col(c).alias(f"_by_{c}") for c in keys], F.col("_tied").alias("_light"))
    rest = marked.filter("_tied is null").join(side, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in keys], "left")
    return done.unionByName(rest.select(*columns, F.coalesce("_light", F.col("_own").cast("double")).alias(out)))


# --- percentiles ----------------------------------------------------------------------------------


def _bucket(x: str, splitters: str, size: int) -> Column:
    """How many of the sorted ``splitters`` are at most ``x``: a binary search in steps that halve."""
    steps, step = [], 1
    while step <= size:
        steps, step = [step, *steps], step * 2
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: at + F.when(F.get(F.col(splitters), at + s - 1) <= F.col(x), s).otherwise(F.lit(0)))


def percentiles(df: DataFrame, x: str, ps: Mapping[str, float], by: Sequence[str] = (), most: int = ONE_TASK, spread: bool | None = None) -> DataFrame:
    """Exact percentiles of each group with linear interpolation, a column for each entry of ``ps``; nulls of ``x`` count nowhere.

    Groups without a value are missing from the result.
    """
    by = list(by)
    ok = df.filter(F.col(x).isNotNull()).select(*by, F.col(x).cast("double").alias("_x"))
    if spread is not False:
        ok = stored(ok)  # looked at three times
        size = largest(ok, by)
    if not spread and (spread is False or size <= most):
        return ok.groupBy(*by).agg(*[F.percentile("_x", F.lit(p)).alias(k) for k, p in ps.items()])
    k = min(SPLITTERS, -(-4 * size // max(1, most)))
    sizes = stored(ok.groupBy(*by).agg(F.count("*").alias("_n"), F.percentile_approx("_x", [i / k for i in range(1, k)], 20 * k).alias("_s")))
    rows = with_facts(ok, sizes.select(*by, "_s"), by).select(*by, "_x", _bucket("_x", "_s", k).alias("_b"))
    inside = rows.groupBy(*by, "_b").agg(F.count("*").alias("_c"))
    inside = inside.withColumn("_upto", F.sum("_c").over(Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)))  # at most k rows a group
    ends = F.array_distinct(F.flatten(F.array(*[F.array(f(p * (F.col("_n") - 1)) + 1) for p in map(float, ps.values()) for f in (F.floor, F.ceil)])))
    wanted = with_facts(inside, sizes.select(*by, ends.alias("_ends")), by).withColumn("_place", F.explode("_ends"))
    wanted = stored(wanted.filter((F.col("_place") <= F.col("_upto")) & (F.col("_place") > F.col("_upto") - F.col("_c"))).select(*by, "_b", (F.col("_place") - F.col("_upto") + F.col("_c")).alias("_in"), "_place"))
    keys = [*by, "_b"]
    asked = wanted.groupBy(*keys).agg(F.collect_list(F.struct("_in", "_place")).alias("_asked"))  # two places a percentile at most
    near = with_facts(rows, asked.select(*keys, F.lit(True).alias("_hit")), keys).filter("_hit").groupBy(*keys, "_x").agg(F.count("*").alias("_c"))
    near = near.withColumn("_upto", F.sum("_c").over(upto(keys, "_x")))
    here = F.explode(F.filter("_asked", lambda a: (a["_in"] <= F.col("_upto")) & (a["_in"] > F.col("_upto") - F.col("_c"))))
    values = with_facts(near, asked, keys).select(*by, "_x", here.alias("_a")).select(*by, "_x", "_a._place")
    values = with_facts(values, sizes.select(*by, "_n"), by)
    out = []
    for name, p in ps.items():
        at = F.lit(float(p)) * (F.col("_n") - 1)
        low, high = F.floor(at), F.ceil(at)
        a, b, n = F.max(F.when(F.col("_place") == low + 1, F.col("_x"))), F.max(F.when(F.col("_place") == high + 1, F.col("_x"))), F.max("_n")
        at = F.lit(float(p)) * (n - 1)
        out.append(F.when(a == b, a).otherwise((F.ceil(at) - at) * a + (at - F.floor(at)) * b).alias(name))
    return values.groupBy(*by).agg(*out)

"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

HOT, HOT_KEYS = 1024, 400_000
FEW_EDGES = 1 << 20  # so many edges may meet in one task, whatever their nodes


def _with_least(edges: DataFrame, least: DataFrame, hot: int) -> DataFrame:
    """``edges`` with ``m``, the least neighbour of ``a``, from ``least`` (a, m, n: how many edges).

    Nodes of more than ``hot`` edges (star centres) are so few that they are broadcast, and their edges stay where they
    are; only the edges of other nodes are shuffled, so no task gets more than ``hot`` rows of one key.
    """
    centres = least.filter(F.col("n") > hot).select(F.col("a").alias("c"), "m")
    both = edges.join(F.broadcast(centres), F.col("a") == F.col("c"), "left")
    others = both.filter("c is null").select("a", "b").join(least.filter(F.col("n") <= hot).select("a", "m"), "a")
    return both.filter("c is not null").select("a", "b", "m").unionByName(others.select("a", "b", "m"))


def _stars_by_window(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges that may all meet in one task: three shuffles, no broadcast.

    The driver holds a thread, for a minute, for each shuffle and each broadcast that it starts.
    """
    own = Window.partitionBy("a")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = both.select("a", "b", F.least("a", F.min("b").over(own)).alias("m")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _small_star(large.select("a", "b", F.min("b").over(own).alias("m")))


def _stars_by_join(edges: DataFrame, hot: int) -> DataFrame:
    """The same, where a node may have more edges than a task should get."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
    large = _with_least(both, least, hot).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    return _small_star(_with_least(large, least, hot))


def _small_star(edges: DataFrame) -> DataFrame:
    every = edges.select(F.explode(F.array(F.struct(F.col("a"), F.col("m")), F.struct(F.col("b").alias("a"), F.col("m")))).alias("e"))
    return every.select("e.a", F.col("e.m").alias("b")).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node it reaches) for every node of the edges (a, b), given as longs.

    Both steps give each edge the least neighbour of a node, by a window or by a grouped minimum and a join; rows never grow
    beyond twice the edges.
    """
    edges = durable(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if seen == now:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = now
        hot = max(HOT, 2 * now.n // HOT_KEYS)  # 2 n ends of edges, so at most HOT_KEYS nodes have more
        edges = durable(_stars_by_window(edges) if now.n <= FEW_EDGES else _stars_by_join(edges, hot), "edges")

"""Exact deduplication by distributed MSD radix partitioning.

Documents are split by successive runs of bytes (digits): first 64 bytes, then 1 KB, 16 KB and so on.  After each
digit the documents that stand alone leave; those whose text has ended inside the digit are equal byte for byte,
as all of their digits were equal.  Digits grow sixteenfold, so a text of n bytes takes about log16(n) rounds, and
only the remaining bytes of documents that still share a group are written between rounds.  No digest decides.

A group that holds a third of all rows is counted with map-side partial sums; documents find their group by a join
with the group table, which is broadcast while it is small and shuffled (AQE splits its hot keys) beyond.

Defined cases: a null text equals the empty text; of rows that agree in doc_id and text exactly one is kept; a
null doc_id is below all others; an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, small

FIRST, GROWTH, BROADCAST_BYTES = 64, 16, 16 << 20


def radix_groups(docs: DataFrame, text: Column | None = None, first: int = FIRST, growth: int = GROWTH) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of ``docs``."""
    text = F.coalesce(F.col("text") if text is None else text, F.lit("")).cast("binary")
    rest = docs.select("doc_id", text.alias("rest")).select("doc_id", F.lit(0).cast("long").alias("grp"), "rest", F.sha2("rest", 256).alias("text_sha256"))
    done: list[DataFrame] = []
    width = first
    while True:
        digit = F.expr(f"substring(rest, 1, {width})")
        groups = rest.select("grp", digit.alias("digit"), "doc_id").groupBy("grp", "digit").agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
        shared = durable(groups.filter("group_size > 1").withColumn("next", F.monotonically_increasing_id()), "radix-groups")
        sided = shared.withColumnsRenamed({"grp": "g", "digit": "d"})
        joined = rest.withColumn("digit", digit).join(small(sided, max(1, BROADCAST_BYTES // (width + 64))), (F.col("grp") == F.col("g")) & (F.col("digit") == F.col("d")), "left")
        done.append(
            joined.filter(F.col("next").isNull()).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
        )
        ended = F.octet_length("digit") < width
        again = Window.partitionBy("next", "doc_id").orderBy(F.lit(1))
        done.append(
            joined.filter(F.col("next").isNotNull() & ended)
            .select("doc_id", "keep_id", "group_size", "next", "text_sha256")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.row_number().over(again) == 1))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
        )
        more = joined.filter(F.col("next").isNotNull() & ~ended).select("doc_id", F.col("next").alias("grp"), F.expr(f"substring(rest, {width + 1})").alias("rest"), "text_sha256")
        rest = durable(more, "radix-rest")
        if rest.isEmpty():
            break
        width *= growth
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out

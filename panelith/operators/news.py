"""News pipeline: clean, deduplicate, filter by keywords, categorize, rank, count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keywords import FEW, found

#: Fixed value: characters stripped from both ends.
EDGE = " -:：,，。；;"


def clean_text(x: Column) -> Column:
    """White space collapsed, punctuation stripped from both ends."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), "[\\s\\u001c-\\u001f\\u0085\\u00a0\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+", " "), F.lit(EDGE))


def clean(items: DataFrame) -> DataFrame:
    """Title, content (the summary stands in for a missing one), source and tags cleaned; rows without a title go."""
    body = F.col("content") if "summary" not in items.columns else F.coalesce("content", "summary")
    source = F.lower(clean_text(F.when(F.coalesce(F.col("source"), F.lit("")) == "", "unknown").otherwise(F.col("source"))))
    tags = F.transform(F.filter(F.coalesce(F.col("tags"), F.array().cast("array<string>")), lambda t: t.isNotNull() & (F.trim(t) != "")), lambda t: F.lower(clean_text(t)))
    return items.withColumns({"title": clean_text(F.col("title")), "content": clean_text(body), "source": source, "tags": tags}).filter("title <> ''")


def dedup(items: DataFrame, order: str) -> DataFrame:
    """The first row, by ``order``, of each title (any case) and source."""
    w = Window.partitionBy(F.lower("title"), "source").orderBy(order)
    return items.withColumn("_i", F.row_number().over(w)).filter("_i = 1").drop("_i")


def haystack() -> Column:
    return F.lower(F.concat_ws(" ", "title", "content", F.array_join("tags", " ")))


def _named(places: str, words: Sequence[str]) -> Column:
    """The words at ``places``."""
    return F.transform(places, lambda i: F.get(F.lit(list(words)) if words else F.array().cast("array<string>"), i))


def relevant(items: DataFrame, keywords: Sequence[str], few: int = FEW) -> DataFrame:
    """Rows with a keyword in title, content or tags, and which; no keywords let all rows pass with none matched."""
    words = [k.strip().lower() for k in keywords if k.strip()]
    out = items.withColumn("_text", haystack()).withColumn("_at", found(F.col("_text"), words, few))
    out = out.filter(F.size("_at") > 0) if words else out
    return out.withColumn("matched_keywords", _named("_at", words)).drop("_text", "_at")


def categorize(items: DataFrame, rules: Mapping[str, Sequence[str]], source_weights: Mapping[str, float], few: int = FEW) -> DataFrame:
    """The first rule with a hit, else other; the source's weight, else 1.  The words of all rules are looked for together."""
    words = [w.lower() for own in rules.values() for w in own]
    owner = [name for name, own in rules.items() for _ in own]
    first = F.array_min("_at")  # words stand in the order of their rules
    category = F.coalesce(F.get(F.lit(owner), first), F.lit("other")) if words else F.lit("other")
    out = items.withColumn("_text", haystack()).withColumn("_at", found(F.col("_text"), words, few)).withColumn("category", category).drop("_text", "_at")
    return out.withColumn("source_weight", _weight(F.col("source"), source_weights))


def _weight(x: Column, weights: Mapping[str, float]) -> Column:
    if not weights:
        return F.lit(1.0)
    table = F.create_map(*[F.lit(v) for k, w in weights.items() for v in (k.lower(), float(w))])
    return F.coalesce(F.try_element_at(table, x), F.lit(1.0))


def rank(items: DataFrame, keyword_weights: Mapping[str, float], category_weights: Mapping[str, float]) -> DataFrame:
    """Score: keyword weights added, times category and source weight, to four digits."""
    words = F.aggregate(F.transform("matched_keywords", lambda k: _weight(k, keyword_weights)), F.lit(0.0), lambda a, b: a + b)
    return items.withColumn("score", F.bround(words * _weight(F.col("category"), category_weights) * F.col("source_weight"), 4))


def digest(raw: DataFrame, keywords: Sequence[str], order: str) -> DataFrame:
    """Counts raw, clean, deduplicated and relevant, in one pass over flagged rows."""
    c = clean(raw.withColumn("_raw", F.lit(1)))
    first = F.row_number().over(Window.partitionBy(F.lower("title"), "source").orderBy(order)) == 1
    hit = F.size(found(F.col("_text"), [k.lower() for k in keywords])) > 0
    flagged = c.withColumn("_first", first).withColumn("_text", haystack()).withColumn("_hit", hit if keywords else F.lit(True))
    counts = flagged.agg(F.count("*").alias("total_clean"), F.count(F.when(F.col("_first"), 1)).alias("total_deduped"), F.count(F.when(F.col("_first") & F.col("_hit"), 1)).alias("total_relevant"))
    return raw.agg(F.count("*").alias("total_raw")).withColumn("_k", F.lit(1)).join(counts.withColumn("_k", F.lit(1)), "_k").drop("_k")

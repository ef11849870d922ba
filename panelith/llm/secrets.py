"""Secret scan: base patterns plus character Markov models compared by log-likelihood ratio.

All DataFrame functions.  A pattern's spans come from the pieces between its matches and the matches themselves
(``split`` and ``regexp_extract_all``), numbered and summed by a window over the matches of one text.

Two first-order Markov models over the 67 token characters are learned from labelled samples: random strings (the
values in base matches) and ordinary identifiers (tokens of MIN_TOKEN or more letters, '_' and '-' without a digit).
A token of that length with a digit and a letter that touches no base span is reported as ``markov`` when its mean
log-likelihood ratio passes THRESHOLD.  Bigrams are counted over all samples of all documents.

Defined cases: null text is empty; texts without a span give zeros and the digest of ''; repeated rows are scanned
each for itself; an empty table gives an empty result; further columns are ignored; offsets count code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

# The base patterns.
_KEYWORD = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN = _KEYWORD + "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")

MIN_TOKEN, THRESHOLD, ALPHA = 20, 0.0, 0.5
#: A longest run of token characters, or of lower-case hex digits; only runs long enough can matter, and a shorter one holds no match.
TOKEN, LONG_HEX, LONG_ACCESS = f"[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}", "[0-9a-f]{32,}", "AKIA[A-Z0-9]{12,}"
CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"


def _found(text: str, pattern: str, kind: str, values: bool = False) -> Column:
    """Array of (kind, gap before, match, value) of the leftmost non-overlapping matches."""
    p = F.lit(pattern)
    matches = F.regexp_extract_all(text, p, F.lit(0))
    zipped = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)).alias("gap"), matches.alias("hit"), (F.regexp_extract_all(text, p, F.lit(2)) if values else matches).alias("value"))
    rows = F.transform(zipped, lambda z: F.struct(F.lit(kind).alias("kind"), F.length(z["gap"]).alias("gap"), z["hit"].alias("hit"), z["value"].alias("value")))
    return F.when(F.col(text).rlike(pattern), rows).otherwise(F.array().cast("array<struct<kind:string,gap:int,hit:string,value:string>>"))


def spans(docs: DataFrame) -> DataFrame:
    """row, doc_id, kind, start, stop, value: base spans and token candidates; one row with a null kind for a text without any."""
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # The keyword pattern keeps its short values, as they take part in the leftmost rule; in the others a run is taken whole, so its least length can stand in the pattern.
    kinds = F.concat(_found("text", ASSIGN, "assign", True), _found("text", LONG_ACCESS, "access"), _found("text", LONG_HEX, "hex"), _found("text", TOKEN, "markov"))
    rows = texts.select("row", "doc_id", F.posexplode_outer(kinds).alias("place", "s")).select("row", "doc_id", "place", "s.*").repartition("row")
    order = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap") + F.length("hit")).over(order)
    rows = rows.withColumn("stop", stop).withColumn("start", F.col("stop") - F.length("hit"))
    good = F.col("kind").isNull() | (F.col("kind") != "assign") | (F.length("value") >= 8)
    return rows.withColumn("kind", F.when(good, F.col("kind"))).select("row", "doc_id", "kind", "start", "stop", "value")


def _codes(value: str) -> Column:
    """Places (from 1) in CHARS of the characters of a token, other characters left out."""
    places = [CHARS.find(chr(i)) + 1 for i in range(128)]
    index = F.array(*[F.lit(i) for i in places])
    known = F.split(F.regexp_replace(value, "[^A-Za-z0-9+/_=-]", ""), "")
    return F.transform(F.filter(known, lambda c: c != ""), lambda c: F.get(index, F.ascii(c)))


def train(found: DataFrame, alpha: float = ALPHA) -> list[float]:
    """Log-likelihood ratio (random over ordinary) of each bigram, row by row of a 68 x 68 table; counts over all samples."""
    random = F.col("kind").isin("assign", "access", "hex")
    ordinary = (F.col("kind") == "markov") & ~F.col("value").rlike("[0-9+/=]")
    samples = found.filter(random | ordinary).select(random.alias("random"), _codes("value").alias("c")).filter(F.size("c") > 1)
    pairs = samples.select("random", F.explode(F.zip_with(F.slice("c", F.lit(1), F.size("c") - 1), F.slice("c", F.lit(2), F.size("c") - 1), lambda a, b: a * 68 + b)).alias("pair"))
    counts = pairs.groupBy("random", "pair").count().collect()  # at most 2 * 67 * 67 rows
    n = {True: [0] * (68 * 68), False: [0] * (68 * 68)}
    for r in counts:
        n[r.random][r.pair] = r["count"]
    out = [0.0] * (68 * 68)
    for a in range(1, 68):
        row = {k: sum(v[a * 68 : a * 68 + 68]) + 67 * alpha for k, v in n.items()}
        for b in range(1, 68):
            out[a * 68 + b] = math.log((n[True][a * 68 + b] + alpha) / row[True]) - math.log((n[False][a * 68 + b] + alpha) / row[False])
    return out


def score(value: str, ratio: list[float]) -> Column:
    """Mean log-likelihood ratio of a token's bigrams."""
    table = F.array(*[F.lit(round(x, 6)) for x in ratio])
    c = _codes(value)
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("last"))
    total = F.aggregate(c, start, lambda s, x: F.struct((s["sum"] + F.get(table, s["last"] * 68 + x)).alias("sum"), x.alias("last")), lambda s: s["sum"])
    return total / F.greatest(F.lit(1), F.length(value) - 1)


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov for each row of ``docs``."""
    found = durable(spans(docs), "secret-spans")
    ratio = train(found)
    base = F.col("kind").isin("assign", "access", "hex")
    odd = (F.col("kind") == "markov") & F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    by_start = Window.partitionBy("row").orderBy("start", "stop")
    before, after = by_start.rowsBetween(Window.unboundedPreceding, -1), by_start.rowsBetween(1, Window.unboundedFollowing)
    marked = found.withColumn("odd", F.when(odd, score("value", ratio)) > threshold).filter(F.col("kind").isNull() | base | F.col("odd") | (F.col("kind") == "markov"))
    marked = marked.withColumn("base_stop", F.max(F.when(base, F.col("stop"))).over(before)).withColumn("base_start", F.min(F.when(base, F.col("start"))).over(after))
    free = ~F.coalesce(F.col("base_stop") > F.col("start"), F.lit(False)) & ~F.coalesce(F.col("base_start") < F.col("stop"), F.lit(False))
    keep = base | (F.coalesce(F.col("odd"), F.lit(False)) & free)
    rank = F.when(F.col("kind") == "assign", 0).when(F.col("kind") == "access", 1).when(F.col("kind") == "hex", 2).otherwise(3)
    entry = F.struct(F.col("start"), rank.alias("rank"), F.concat_ws(":", "kind", "start", "stop").alias("span"))
    per = marked.groupBy("row", "doc_id").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS[:3]],
        F.count(F.when((F.col("kind") == "markov") & keep, 1)).alias("n_markov"),
        F.array_sort(F.collect_list(F.when(base, entry))).alias("base"),
        F.array_sort(F.collect_list(F.when(keep, entry))).alias("every"),
    )
    joined = lambda c: F.array_join(F.transform(c, lambda e: e["span"]), ",")
    return per.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined("base"), 256).alias("base_sha256"), joined("every").alias("spans"), "n_markov")

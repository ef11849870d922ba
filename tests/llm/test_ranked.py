"""Periodic runs, importance resampling and quality ranking: against brute force, in odd cases, on held-out labels."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from panelith.llm import importance, periodic, preference
from panelith.llm.queries import op11_periodic_runs, op12_importance_resampling, op13_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def all_runs(x):
    """Every run, by trying every period at every place."""
    found, n = set(), len(x)
    for q in range(1, n // 3 + 1):
        s = 0
        while s < n - q:
            e = s
            while e < n - q and x[e] == x[e + q]:
                e += 1
            length = e - s + q
            if e > s and length >= max(24, 3 * q):
                part = x[s : s + length]
                if not any(all(part[i] == part[i + p] for i in range(length - p)) for p in range(1, q)):
                    found.add((s, length, q))
            s = max(e, s + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def sequence(r):
    """Repeated blocks over few symbols, blocks that hold copies of their own parts, cut at odd places."""
    symbols, out = r.choice([1, 2, 3, 50]), []
    for _ in range(r.randint(0, 6)):
        block = [r.randrange(symbols) for _ in range(r.randint(1, 60))]
        if r.random() < 0.4:
            block = block + block[: r.randint(0, len(block))] + [r.randrange(60)]
        if r.random() < 0.3:
            block = [*block, 77, *block, 78]
        times = r.choice([1, 2, 3, 4, 8])
        out += (block * times)[: len(block) * times - r.randint(0, len(block) // 2)]
    return out


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    r = random.Random(seed)
    for _ in range(20):
        docs = [sequence(r) for _ in range(r.randint(1, 4))]
        firsts = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        found = periodic.find_runs(np.array(sum(docs, []), np.int64), firsts)
        for k, d in enumerate(docs):
            assert found.get(k, []) == all_runs(d)


def test_every_k_gram_of_the_period_twice():
    """A period in which each 2-gram (so also many longer ones) occurs twice: next occurrences alone must still find it."""
    unit = [0, 0, 0, 1, 1, 1, 0, 1]
    blocks = [[b * 50 + i for i in range(20)] for b in (0, 1)]
    x = sum((blocks[u] for u in unit), [])
    for times in (3, 4):
        found = periodic.find_runs(np.array(x * times, np.int64), np.array([0, len(x) * times]))
        assert found[0] == all_runs(x * times) and (0, len(x) * times, len(x)) in found[0]


def test_long_uniform_text_costs_one_extension():
    n = 300_000
    x = np.zeros(n, np.int64)
    pairs = [len(a) for a, _ in periodic.seed_pairs(x, np.zeros(n, np.int64))]
    assert sum(pairs) <= n  # one pair a place, whatever the number of copies
    assert periodic.find_runs(x, np.array([0, n])) == {0: [(0, n, 1)]}


def expected_summary(doc_id, text):
    words = WORD.findall(text or "")
    at = periodic.made_periodic(doc_id, len(words))
    words = words if at is None else [words[i] for i in at]
    runs = all_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *best, runs and math.floor(1000 * best[1] / best[2]) or None, sha(listed), sha(left))


def test_periodic_rule():
    doc_id = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    g, n = zlib.crc32(str(doc_id).encode()) // 10, 91
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    assert periodic.made_periodic(doc_id, n).tolist() == [i if i < a else a + (i - a) % p for i in range(n)]
    assert periodic.made_periodic(doc_id, 0) is None and periodic.made_periodic(None, 5) is None


def test_summary_equals_brute_force(spark, words):
    r = random.Random(3)
    rows = [(i, " ".join(words[k] for k in sequence(r))) for i in range(150)] + [(None, None), (7, ""), (7, " \n\t"), (10**12, "x " * 200), (3, "a\x0bb " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_runs", "2 as `a.b`", "'z' as period")
    got = sorted(periodic.summary(docs, periodic.made_periodic).collect(), key=str)
    want = [(d, *expected_summary(d, t)) for d, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert len(got) == len(rows)
    flat = {(x.doc_id, x.start, x.length, x.period) for x in periodic.runs(docs, periodic.made_periodic).collect()}
    assert sum(w[1] for w in want) >= len(flat) > 50


def test_without_runs_keeps_columns_and_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumnRenamed("n_chars", "a.b")
    out = periodic.without_runs(docs)
    assert out.schema == docs.schema and out.count() == docs.count()
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[3] == "" and texts[8] == "" and texts[1] == "Same text here, twice over."
    assert periodic.summary(no_docs).count() == 0 and periodic.without_runs(no_docs).count() == 0
    one = spark.createDataFrame([(1, "a " * 40 + "b c")], "doc_id long, text string")
    assert periodic.without_runs(one).first().text == "a b c"


def brute_resample(docs, target, longest, buckets, least, percent):
    def grams(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        return w, [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]

    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (Counter(bucket(g) for x in texts for g in grams(x)[1]) for texts in ([d[1] for d in docs], target))
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (s.total() + buckets) / ((s[b] + 1.0) * (t.total() + buckets)))) for b in range(buckets)}
    rows = []
    for d, text in docs:
        w, f = grams(text)
        weight = sum(gain[bucket(g)] for g in f)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)])
    fit = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = percent * len(fit) // 100
    ranks = {id(r): k + 1 for k, r in enumerate(fit[:drawn])}
    return sorted(((*r[:4], ranks.get(id(r))) for r in rows), key=str)


@pytest.mark.parametrize(("longest", "least", "percent"), [(1, 3, 40), (3, 1, 100), (2, 20, 10)])
def test_resampling_equals_brute_force(spark, words, longest, least, percent):
    r = random.Random(longest)
    docs = [(i, " ".join(r.choice(words).capitalize() + r.choice(["", ",", "-", "É", "\x00"]) for _ in range(r.randint(0, 40)))) for i in range(200)]
    docs += [(None, None), (4, ""), (9, "Ümläut 汉字 ABC"), (9, "Ümläut 汉字 ABC"), (5000, "word " * 30_000)]
    target = [d[1] for d in docs[:20]] + [None, ""]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as weight", "'x' as rank", "3 as `a.b`", "4 as buckets")
    goal = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    got = importance.resample(frame, goal, longest, 500, least, percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == brute_resample(docs, target, longest, 500, least, percent)


def test_offsets_point_at_the_words(monkeypatch):
    monkeypatch.setattr(importance, "PIECE", 7)  # long texts come in pieces
    text = "hello, wörld 9x\x00y  éè-a" * 4
    spans = [(w, a, b) for part in importance.offsets(text, importance.splitter()) for w, (a, b) in part]
    assert spans == [(m[0], *m.span()) for m in re.finditer(importance.WORDS, text)]
    assert all(text[a:b] == w for w, a, b in spans)


def test_drawn_rows_and_empty_tables(spark, odd_docs, no_docs):
    goal = spark.createDataFrame([(1, "same text here")], "item_id int, text string")
    out = importance.drawn(odd_docs.filter("doc_id <> 7"), goal, least_words=1, percent=50)
    assert out.columns == [*odd_docs.columns, "draw_rank"]
    ranks = sorted(r.draw_rank for r in out.collect())
    assert ranks == list(range(1, len(ranks) + 1)) and ranks
    assert importance.resample(no_docs, goal).count() == 0
    assert importance.resample(odd_docs, goal.limit(0)).count() == odd_docs.count()


# --- quality --------------------------------------------------------------------------------------


def spoilt(r, words):
    kind = r.randrange(4)
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in words)
    if kind == 1:
        return " ".join(w + r.choice(["***", "%%%", "###"]) for w in words)
    if kind == 2:
        return " | ".join(words)
    return " ".join(w for w in words[:5] for _ in range(20))


@pytest.fixture()
def labelled(spark, words):
    r = random.Random(9)
    docs, labels = [], []
    for i in range(600):
        own = [r.choice(words) for _ in range(r.randint(15, 80))]
        own[0] = own[0].capitalize()
        good = r.random() < 0.7
        docs.append((i, " ".join(own) + "." if good else spoilt(r, own)))
        labels.append((i, int(good), 0))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_on_held_out_documents(labelled):
    docs, labels = labelled
    got = preference.score(docs, labels).join(labels, "doc_id").select("*", preference.held_out().alias("held")).filter("held").collect()
    assert len(got) > 150 and sum((r.score >= 0.5) == (r.quality == 1) for r in got) >= 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_quality_learns_from_training_labels_alone(labelled, spark):
    docs, labels = labelled
    flipped = labels.withColumn("held", preference.held_out()).selectExpr("doc_id", "if(held, 1 - quality, quality) quality", "toxic")
    a, b = ({r.doc_id: r.score for r in preference.score(docs, x).collect()} for x in (labels, flipped))
    assert a == pytest.approx(b, abs=1e-9)


def test_quality_table_given():
    import duckdb

    rows = duckdb.sql("SELECT d.doc_id, text, quality FROM '/root/testdata/sf0.01/documents.parquet' d JOIN '/root/testdata/sf0.01/labels.parquet' USING (doc_id) ORDER BY 1").fetchall()
    x, y = preference.features(pa.array([r[1] for r in rows])), np.array([r[2] for r in rows])
    held = np.array([zlib.crc32(str(r[0]).encode()) % 3 == 1 for r in rows])
    good, bad = x[~held & (y == 1)], x[~held & (y == 0)]
    centre, scale = (good.mean(0) + bad.mean(0)) / 2, np.sqrt((good.var(0) + bad.var(0)) / 2 + 1e-6)
    z = np.clip((x - centre) / scale, -8, 8)
    a, b = preference.pairs(len(good), len(bad), 4)
    m = z @ preference.bradley_terry(z[~held & (y == 1)][a], z[~held & (y == 0)][b])
    assert m[held & (y == 1)].min() > m[held & (y == 0)].max() - 0.5
    assert (m[held & (y == 1)][:, None] > m[held & (y == 0)]).mean() > 0.99


def test_pairs_meet_everyone():
    for good, bad in ((1, 1), (5, 2), (3, 40), (100, 7)):
        a, b = preference.pairs(good, bad, 4)
        assert set(a) == set(range(good)) and set(b) == set(range(bad)) and len(set(zip(a, b, strict=True))) == len(a) <= 4 * (good + bad)


def test_bradley_terry_finds_the_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3))
    worth = x @ np.array([2.0, -1.0, 0.0])
    a, b = rng.integers(0, 500, (2, 3000))
    a, b = a[a != b], b[a != b]
    win = rng.random(len(a)) < 1 / (1 + np.exp(worth[b] - worth[a]))
    w = preference.bradley_terry(x[np.where(win, a, b)], x[np.where(win, b, a)], 1e-4)
    assert np.allclose(w, [2, -1, 0], atol=0.25)


def test_quality_odd_cases(odd_docs, no_docs, labelled):
    docs, labels = labelled
    both = odd_docs.select("doc_id", "text").unionByName(docs.selectExpr("doc_id + 1000 as doc_id", "text"))
    shifted = labels.selectExpr("doc_id + 1000 as doc_id", "quality", "toxic")
    got = preference.score(both, shifted).collect()
    assert len(got) == both.count() and all(r.score is not None and 0 <= r.score <= 1 for r in got)
    assert {r.score for r in preference.score(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert preference.score(no_docs, labels.limit(0)).count() == 0
    wide = odd_docs.withColumnRenamed("n_chars", "a.b")
    kept = preference.good(wide, labels.limit(0))
    assert kept.schema == wide.schema and kept.count() == wide.count()


def test_features_do_not_depend_on_the_batch(words):
    texts = ["", None, "A", "One two.\nOne two.\n", "x " * 500, "É汉字 !!", "\n\n", *[" ".join(words[i : i + 30]) for i in range(0, 300, 30)]]
    together = preference.features(pa.array(texts))
    assert np.allclose(together, np.concatenate([preference.features(pa.array([t], pa.string())) for t in texts]))
    assert np.isfinite(together).all()


def test_queries_return_their_columns(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for query, columns in (
        (op11_periodic_runs, ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]),
        (op12_importance_resampling, ["doc_id", "n_features", "weight", "score", "rank"]),
        (op13_quality, ["doc_id", "held_out", "score", "predicted"]),
    ):
        out = query(spark, SF)
        assert out.columns == columns and out.count() == n

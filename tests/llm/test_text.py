"""Chat formatting, secret scan, decontamination, Jaccard join, toxicity, language model, pipeline."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from panelith.llm import chat, common, decontaminate, graph, jaccard, maxent, queries, secrets, toxicity

CHAT = "conv_id long, turn int, role string, text string"


# --- chat ---


@pytest.mark.parametrize("t", ["", "plain", "<|end|>", "<\\|end|> <\\\\|end|>", "</s>[INST] ok [/INST]", "[[/INST]<</s>", "a<|turn|>b<|text|>"])
def test_escape_is_reversible_and_safe(t):
    e = chat.escape(t)
    assert chat.unescape(e) == t
    assert not any(c in e for c in chat.CONTROL)


def test_chat(spark):
    rows = [(1, 2, "assistant", "late"), (1, 1, "user", "</s>[INST] ok [/INST]"), (1, None, "system", None), (2, 1, "assistant", "  \n é汉<|end|>"), (2, 1, "assistant", "  \n é汉<|end|>"), (None, 1, None, "x"), (3, 0, "user", "only")]
    rows += [(4, i, ["user", "assistant"][i % 2], f"turn {i} " * 40) for i in range(60)]
    df = spark.createDataFrame(rows, CHAT)
    path = queries.tokenizer_path("byte_bpe_50k.json")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df, path, segment=3000)).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for c, r in got.items():
        turns = sorted(((-1 if t is None else t), role or "", text or "") for k, t, role, text in rows if k == c)
        said = "".join(text for _, role, text in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
        assert r.loss_chars == len(said) and r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert chat.chat(df.limit(0), path).count() == 0


def test_segments_hold_the_ids_of_the_whole_conversation(spark):
    from tokenizers import Tokenizer

    rng = random.Random(11)
    words = ["it's", "  two", "\n", "x", "|>", "<|end|>", "汉字", "é", "1984", "...", "don't ", "\t", "<|turn|>", "assistant"]
    rows = [(c, i, rng.choice(["user", "assistant", "|", "'s", "汉"]), "".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for c in range(3) for i in range(120)]
    df = spark.createDataFrame(rows, CHAT)
    path = queries.tokenizer_path("byte_bpe_50k.json")
    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    got = chat.format_conversations(df, path, segment=500).orderBy("conv_id", "segment").collect()
    assert len(got) > 30
    for c in range(3):
        parts = [r for r in got if r.conv_id == c]
        text = "".join(r.formatted for r in parts)
        whole = model.encode(text, add_special_tokens=False)
        assert [i for r in parts for i in r.token_ids] == whole.ids
        base, offsets, loss = 0, [], []
        for r in parts:
            offsets += [(a + base, b + base) for a, b in zip(r.token_start, r.token_end, strict=True)]
            loss += r.loss
            base += len(r.formatted)
        assert offsets == whole.offsets
        _, spans = chat.render([(role, t) for k, _, role, t in sorted(rows) if k == c])
        assert loss == [any(a < b and a < y and x < b for a, b in spans) for x, y in offsets]
    other = chat.format_conversations(df, queries.tokenizer_path("word_bpe_49k.json"), segment=500)
    assert other.count() == 3


def test_align_matches_a_plain_scan():
    rng = random.Random(1)
    for _ in range(200):
        cuts = sorted(rng.sample(range(60), 12))
        start, end = np.array([0, *cuts]), np.array([*cuts, 60])
        s = sorted(rng.sample(range(61), 6))
        spans = list(zip(s[::2], s[1::2], strict=True))
        want = [any(a < y and x < b for a, b in spans) for x, y in zip(start, end, strict=True)]
        assert chat.align(spans, start, end).tolist() == want


# --- secrets ---

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def base_spans(t):
    out = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return [s for *_, s in sorted(out)]


def test_secrets(spark, odd_docs, no_docs):
    rng = random.Random(2)
    key = lambda n, a: "".join(rng.choice(a) for _ in range(n))
    hexa, b64 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows = [(100 + i, f"é汉 Token : '{key(24, b64)}' then {key(40, hexa)} and AKIA{key(16, b64[:26] + '0123')} some_ordinary_identifier_name and another-long-hyphenated-word") for i in range(60)]
    rows += [(201, "token=token :abcdefghij"), (202, f"AKIA{key(11, b64[:26])} AKIA{key(12, b64[:26])}"), (203, "password=short passwd = 'longenough99' API_KEY:apikey=12345678"), (204, f"see {key(32, b64)} here"), (205, "configuration_value_for_2_workers_in_pool")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    docs = df.unionByName(odd_docs.select("doc_id", "text"))
    for r in secrets.scan(docs).join(docs, "doc_id").collect():
        want = base_spans(r.text or "")
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), r
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex"))
        assert set(want) <= set(r.spans.split(",")) | {""} - ({""} if want else set())
    got = {r.doc_id: r for r in secrets.scan(df).collect()}
    assert got[204].spans == "markov:4:36" and got[205].spans == ""
    assert secrets.scan(no_docs).count() == 0


# --- decontamination ---


def test_decontaminate(spark, odd_docs, no_docs, words):
    rng = random.Random(3)
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, prose(20 + i)) for i in range(30)]
    rows, want = [], set()
    for i in range(200):
        body = prose(120)
        if i % 2 == 0:
            k, item = items[i % 30]
            item = list(item)
            for j in range(4, len(item), 6):  # a substituted word in six
                item[j] = "replaced"
            body[50:50] = item
            want.add((i, k))
        rows.append((i, " ".join(body)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items] + [(90, None), (91, ""), (92, "too short"), (None, "x " * 9)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == want
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench, block_bytes=900).collect()} == want
    kept = decontaminate.clean(odd_docs, bench)
    assert kept.count() == odd_docs.count() and kept.columns == odd_docs.columns
    assert decontaminate.contaminated(no_docs, bench).count() == 0 and decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def brute_contaminated(docs, items):
    """All shifts of all items against all documents, word by word."""
    split = lambda t: [w for w in re.split(r"[\W_]+", re.sub("([\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff])", r" \1 ", t or "").lower()) if w]
    out = set()
    for d, text in docs:
        t = split(text)
        for i, item in items:
            w = split(item)
            for shift in range(-len(w) + 1, len(t)):
                run = best = same = 0
                for k in range(max(0, -shift), min(len(w), len(t) - shift)):
                    hit = w[k] == t[shift + k]
                    run, same = max(0, run + (1 if hit else -2)), same + hit
                    best = max(best, run)
                if same == len(w) if len(w) < 8 else best >= 10 or same >= 0.7 * len(w):
                    out.add((d, i))
                    break
    return out


def test_decontaminate_against_brute_force(spark, words):
    rng = random.Random(31)
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, prose(rng.randint(9, 30))) for i in range(20)] + [(100, ["short", "item", "whole"]), (101, ["alone"]), (102, prose(7)), (103, list("汉字测试文本很长一点"))]
    docs = []
    for i in range(120):
        body, (_, item) = prose(60), rng.choice(items)
        some = list(item)
        for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
            some[rng.randrange(len(some))] = rng.choice(words)
        a = rng.choice([0, 0, 0, len(some) // 3])
        at = rng.randint(0, 60)
        body[at:at] = some[a:]
        docs.append((i, (" " if item[0] != "汉" else "").join(body) if item[0] == "汉" and i % 2 else " ".join(body)))
    text = [(i, ("" if w[0] == "汉" else " ").join(w)) for i, w in items]
    want = brute_contaminated(docs, text)
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(text, "item_id long, text string")).collect()}
    assert got <= want and len(got) >= 0.97 * len(want) and {i for _, i in want} >= {100, 101, 103}
    exact = {(d, i) for d, i in want if dict(text)[i] in dict(docs)[d]}
    assert exact <= got
    longer = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(text, "item_id long, text string"), min_words=8)
    assert {(r.doc_id, r.item_id) for r in longer.collect()} == {(d, i) for d, i in got if i not in (100, 101, 102)}


# --- Jaccard ---


def brute_components(rows, k, percent):
    ids, sets = [], []
    for d, t in rows:
        w = re.findall(common.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        ids.append(d)
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    up = list(range(len(ids)))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for i in range(len(ids)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        least[root(i)] = min(least.get(root(i), d), d)
    return {d: (len(sets[i]), least[root(i)]) for i, d in enumerate(ids)}


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_jaccard_components(spark, words, k, percent):
    rng = random.Random(k)
    texts = []
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.randint(1, 45))]
        for _ in range(rng.randint(1, 6)):
            b = list(base)
            for _ in range(rng.randint(0, 2)):
                b[rng.randrange(len(b))] = rng.choice(words)
            texts.append(" ".join(b[: len(b) - rng.randint(0, 1)]))
    texts += ["", None, "a", "A", "a b c", " ", " ".join(words) * 5]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df, k, percent).collect()}
    assert got == brute_components(rows, k, percent)


def test_jaccard_blocks_and_odd(spark, odd_docs, no_docs, words, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 3)
    rng = random.Random(9)
    base = [rng.choice(words) for _ in range(80)]
    rows = []
    for i in range(20):
        b = list(base)
        b[rng.randrange(80)] = f"new{i}"
        rows.append((i, " ".join(b)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows, 4, 85)
    rows = []
    for size in range(30, 60):  # a family that spans several size classes, each of several blocks
        for i in range(4):
            b = base[:size]
            b[rng.randrange(size)] = f"other{size}x{i}"
            rows.append((1000 + size * 4 + i, " ".join(b)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows, 4, 85)
    kept = jaccard.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 4, 5, 7, 8, 9, None])
    assert jaccard.jaccard_components(no_docs).count() == 0 and jaccard.one_of_each(no_docs).count() == 0


@pytest.mark.parametrize("percent", [80, 85, 100])
def test_linked_sizes_are_in_neighbouring_classes(percent):
    bounds = jaccard.size_bounds(percent)
    most = jaccard.most_differing(bounds, percent)
    for n in range(1, 400):
        for m in jaccard.partners(n, percent):
            k, j = (int(np.searchsorted(bounds, x, "right")) - 1 for x in (n, m))
            assert abs(k - j) <= 1
            common_ = jaccard.least_common(n, m, percent)
            if common_ <= min(n, m):
                assert n + m - 2 * common_ <= most[max(k, j)]


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_share_a_part_whatever_is_popular(percent):
    rng = np.random.default_rng(percent)
    bounds = jaccard.size_bounds(percent)
    plan = jaccard.part_plan(jaccard.most_differing(bounds, percent))
    sizes = [20, 90, 300, 700, 1100, 1700, 2600, 4000, 7000, 13_808, 20_000]
    assert (plan[0] != plan[1])[np.searchsorted(bounds, sizes[-1], "right")] and not (plan[0] != plan[1])[np.searchsorted(bounds, 20, "right")]
    for n in sizes:
        pool = np.unique(rng.integers(1, 2**63, 3 * n, dtype=np.uint64))
        rng.shuffle(pool)
        shared = pool[:n]
        for m in (n, 100 * n // percent):  # both of one size, or one an extension of the other
            common_ = jaccard.least_common(n, m, percent)
            one = np.sort(np.concatenate([shared[:common_], pool[n : n + (n - common_)]]))
            two = np.sort(np.concatenate([shared[:common_], pool[2 * n : 2 * n + (m - common_)]]))
            assert 100 * common_ >= percent * (n + m - common_)
            for share in (0, 0.5, 0.9, 0.99, 1.0):
                for popular in (shared[: int(share * common_)], np.concatenate([shared[: int(share * common_)], pool[n : n + (n - common_)]])):
                    key, owner = jaccard.part_keys([one, two], percent, bounds, np.sort(popular))
                    assert set(key[owner == 0].tolist()) & set(key[owner == 1].tolist()), (n, m, share)


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_share_as_many_parts_as_counted_on(percent):
    rng = np.random.default_rng(percent + 1)
    bounds = jaccard.size_bounds(percent)
    for n in (8, 20, 37, 46, 60, 90, 117, 150, 207, 230, 250, 288, 300, 361, 420, 700, 1700):
        for m in (n, 95 * n // 100, -(-percent * n // 100)):
            common_ = jaccard.least_common(n, m, percent)
            if common_ > m:
                continue
            least = jaccard.least_shared(np.array([n]), np.array([m]), percent, bounds)[0]
            for share in (0, 0.3, 0.6, 0.9, 1.0):
                pool = np.unique(rng.integers(1, 2**63, 3 * n, dtype=np.uint64))
                rng.shuffle(pool)
                one = np.sort(pool[:n])
                two = np.sort(np.concatenate([pool[:common_], pool[n : n + m - common_]]))
                for popular in (pool[: int(share * common_)], np.concatenate([pool[: int(share * common_)], pool[n : n + m - common_]])):
                    key, owner = jaccard.part_keys([one, two], percent, bounds, np.sort(popular))
                    assert len(set(key[owner == 0].tolist()) & set(key[owner == 1].tolist())) >= least, (n, m, share)


def test_unlike_documents_form_no_family(spark, monkeypatch):
    """Neighbours in a chain share half of their words, and most have some popular passages; none links with any other."""
    rng = random.Random(21)
    prose = lambda n: [f"{rng.randrange(10**9):x}" for _ in range(n)]
    passages, refrain = [prose(90) for _ in range(201)], [prose(20) for _ in range(3)]
    rows = [(i, " ".join(passages[i] + passages[i + 1] + [w for r in refrain[: i % 4] for w in r])) for i in range(200)]
    kept = {}
    before = jaccard.durable
    monkeypatch.setattr(jaccard, "durable", lambda df, name="step", by=None: kept.setdefault(name, before(df, name, by)))
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()
    assert all(r.component_id == r.doc_id for r in got) and len(got) == 200
    assert kept["jaccard-members"].count() < 20  # all 200 in one family, each compared with each, if any part alike ties


def test_popular_shingles_cost_no_link(spark):
    rng = random.Random(8)
    prose = lambda n: [f"{rng.randrange(10**9):x}" for _ in range(n)]
    base = prose(1300)
    rows = [(1, " ".join(base))]
    for i in range(20):  # near copies make the base's shingles popular
        b = list(base)
        b[50 * i] = f"other{i}"
        rows.append((i + 2, " ".join(b)))
    rows.append((999, " ".join(base + prose(225))))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(df).collect()}
    assert set(got.values()) == {1} and len(got) == 22


def test_components_with_a_hot_centre(spark, monkeypatch):
    monkeypatch.setattr(graph, "HOT", 3)
    rng = random.Random(1)
    edges = [(500, i) for i in range(60)] + [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(300, 300)]
    up = {}
    root = lambda a: a if up.setdefault(a, a) == a else root(up[a])
    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {a: root(a) for a in up}


def test_star_steps_of_small_tables_shuffle_thrice(spark, monkeypatch):
    """Both forms give the same components; a step over few edges has three shuffles and no broadcast."""
    rng = random.Random(11)
    edges = [(rng.randint(-300, 300), rng.randint(-300, 300)) for _ in range(260)] + [(1000, k) for k in range(2000, 2040)] + [(k, k + 1) for k in range(5000, 5030)]
    df = spark.createDataFrame(edges, "a long, b long")
    steps = []
    durable = graph.durable
    monkeypatch.setattr(graph, "durable", lambda x, name: steps.append(x._jdf.queryExecution().sparkPlan().toString()) or durable(x, name))
    by_window = {tuple(r) for r in graph.components(df).collect()}
    assert len(steps) > 1
    for plan in steps[1:]:
        assert "Join" not in plan and plan.count("Window [") == 2 and plan.count("HashAggregate") == 2, plan
    monkeypatch.setattr(graph, "FEW_EDGES", -1)
    monkeypatch.setattr(graph, "HOT", 8)
    assert by_window == {tuple(r) for r in graph.components(df).collect()}


def test_null_ids_link_and_one_row_stays(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(None, text), (None, text + " end"), (None, text + " end"), (7, " ".join(f"v{i}" for i in range(60))), (None, " ".join(f"v{i}" for i in range(61)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df).collect() if r.n_shingles < 100)
    assert got == [(57, 7), (58, 7)]
    kept = jaccard.one_of_each(df).collect()
    assert len(kept) == 2 and {r.doc_id for r in kept} == {None, 7}


# --- toxicity ---


def test_toxicity(spark, odd_docs, no_docs, words):
    rng = random.Random(4)
    bad = ["vilest", "rotten", "odious", "wretch"]
    rows, labels = [], []
    for i in range(1500):
        w = [rng.choice(words) for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                w[rng.randrange(40)] = rng.choice(bad)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    hidden = [(9000, "some words r0tten and v i l e s t and 0di0us"), (9001, " ".join(words[:30]))]
    docs = spark.createDataFrame(rows + hidden, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(docs, lab).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i in held]) > 0.97
    assert got[9000] > 0.5 > got[9001]
    both = docs.unionByName(odd_docs.select("doc_id", "text"))
    assert toxicity.score(both, lab).count() == both.count()
    kept = toxicity.clean(odd_docs, lab)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert toxicity.score(no_docs, lab).count() == 0
    assert {r.score < 0.5 for r in toxicity.score(odd_docs, lab.limit(0)).collect()} == {True}


def test_viterbi_decoding(spark):
    text = "the idiot moron loser trash stupid worthless clown and some other plain words of the text " * 20
    model = toxicity.language_model(spark.createDataFrame([(text,)], "text string"))
    r = toxicity.Restorer(model)
    for word, want in {"1d10t": "idiot", "m0r0n": "moron", "i.d.i.o.t": "idiot", "tr@sh": "trash", "$tupid": "stupid", "looooser": "loser"}.items():
        assert r.text(word) == want
    assert r.text("you i d i o t") == "you idiot" and r.text("plain words, nothing else!") == "plain words, nothing else!"


@pytest.mark.parametrize("word", ["idiiot", "iddiot", "!diot", "!d!ot", "(!diot)", "idiot!)", "i d 1 o t", "1 d i o t", "i  d  i  o  t", "! d 1 o t", "i d i o t !", "i.-d_1..o*t"])
def test_every_disguise_of_the_lattice_is_decoded(spark, word):
    text = "the idiot moron loser trash stupid worthless clown and some other plain words of the text " * 20
    r = toxicity.Restorer(toxicity.language_model(spark.createDataFrame([(text,)], "text string")))
    for before in ("", "plain words ", "of the "):
        assert re.findall("[a-z]+", r.text(before + word)) == [*before.split(), "idiot"]
        assert toxicity.suspicious(pa.array([before + word])).all()
    assert r.text("morron m 0 r 0 n") == "moron moron"
    for plain in ("in 1984 or 3.14, 1 2 3", "loser! the text!", "the other words"):
        assert r.text(plain) == plain


def test_viterbi_against_all_paths(spark):
    from itertools import product

    text = "the idiot moron loser trash stupid worthless clown and some other plain words of the text " * 20
    model = toxicity.language_model(spark.createDataFrame([(text,)], "text string"))
    flat = model.ravel().tolist()
    rng = random.Random(7)

    def cost(ways):
        total, s = sum(c for _, c in ways), [0, 0, *(toxicity._symbol(c) for t, _ in ways for c in t), 0]
        return total + sum(model[a, b, c] for a, b, c in zip(s, s[1:], s[2:], strict=False))

    for _ in range(150):
        word = "".join(rng.choice("aaabcdeilorst10!@$|. -") for _ in range(rng.randint(1, 9)))
        paths = list(product(*toxicity.lattice(word)))
        found, read = toxicity.reading(word, flat)
        assert found == pytest.approx(min(map(cost, paths)), abs=1e-9)
        assert any("".join(t for t, _ in w) == read and cost(w) == pytest.approx(found, abs=1e-9) for w in paths)
    began = time.process_time()
    toxicity.reading("ab1" * 20_000, flat)
    once = time.process_time() - began
    toxicity.reading("ab1" * 80_000, flat)
    assert time.process_time() - began < 12 * once + 1  # in proportion to the length


def test_signals_against_brute_force():
    rng = random.Random(3)
    vocab = [f"{a}{b}" for a in ("rotten", "vile", "nice", "plain", "odd") for b in ("", "ly", "ness", "est", "x")]
    rows = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 12))) for _ in range(80)] + [None, "", "?!"]
    key = lambda w: int(toxicity.word_features(pa.array([w]))[1][0, 0])
    near = lambda w: [int(f) for f in toxicity.word_features(pa.array([w]))[1][0] if f]
    weighed = {f: rng.uniform(2, 9) for w in ("rottenness", "vile", "oddest") for f in near(w)}
    made = toxicity.Weights(np.array(list(weighed), np.uint64), np.array(list(weighed.values())))
    got = made.signals(pa.array(rows, pa.string()))
    for r, (a, b) in zip(rows, got.tolist(), strict=True):
        best = {key(w): max((weighed[f] for f in near(w) if f in weighed), default=None) for w in (r or "").split() if re.search(r"\w", w)}
        top = sorted((v for v in best.values() if v is not None), reverse=True) + [0, 0]
        assert (a, b) == (top[0], top[1])


# --- language model ---


def test_maxent(spark, odd_docs, no_docs, words):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        w = [rng.choice(words[:50])]
        for _ in range(60):  # the next word follows from the one before, half of the time
            w.append(words[(words.index(w[-1]) * 7 + 3) % 50] if rng.random() < 0.5 else rng.choice(words[:50]))
        rows.append((1000 + i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    toks = lambda t: re.findall(common.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
    everything = [(r.doc_id, r.text) for r in docs.collect()]
    count = Counter()
    for d, t in everything:
        if d is None or zlib.crc32(str(d).encode()) % 7 != 2:
            count.update(toks(t))
    n, v = sum(count.values()), len(count)
    got = maxent.score(docs)
    assert got.count() == len(everything)
    by = {r.doc_id: r for r in got.collect()}
    for d, t in everything:
        w, r = toks(t), by[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(count[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), rel=1e-9)
        assert r.score < 0
    held = [by[d] for d, _ in rows if by[d].held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert maxent.score(no_docs).count() == 0


def _tree_model(rng, n_words, leaf_words):
    words = np.sort(rng.integers(10, 2**63, n_words, dtype=np.uint64))
    words = np.concatenate([np.array([maxent.END], np.uint64), words])
    shapes = np.concatenate([[0], rng.integers(0, maxent.SHAPES, n_words)]).astype(np.uint8)
    totals = np.concatenate([[40], rng.integers(0, 400, n_words)]).astype(np.int64)
    leaf, known = maxent.leaves(words, shapes), totals > 0
    size = maxent.FAN**maxent.DEPTH
    maxent_saved, maxent.LEAF_WORDS = maxent.LEAF_WORDS, leaf_words
    model = maxent.Model(np.bincount(leaf[known], minlength=size), np.bincount(leaf, totals, size).astype(np.int64))
    maxent.LEAF_WORDS = maxent_saved
    return words, shapes, totals, model


@pytest.mark.parametrize(("leaf_words", "depth"), [(1000, 1), (2, 2), (0.1, 3)])
def test_class_softmax_is_a_distribution(leaf_words, depth):
    rng = np.random.default_rng(0)
    words, shapes, totals, m = _tree_model(rng, 200, leaf_words)
    assert m.depth == depth and (m.n, m.v) == (totals.sum(), (totals > 0).sum())
    leaf, _, inside = m.dictionary(words, shapes, totals)
    for c in set(leaf.tolist()):
        known = (10 ** inside[(leaf == c) & (totals > 0)]).sum()
        unknown = 0 if c == 0 else 1 / (m.tokens[c] + m.words[c] + 1)
        assert known + unknown == pytest.approx(1)
    every = np.arange(maxent.FAN**depth)
    every = every[(every == 0) | (every >= maxent.FAN ** (depth - 1))]  # under the first class 0 there is only the end token
    weights = rng.normal(size=m.shape).astype(np.float32)
    for h in rng.integers(0, 2**63, (5, 4), dtype=np.uint64):
        assert (10 ** maxent.log_shares(weights, m, np.repeat(h[:, None], len(every), 1), every)).sum() == pytest.approx(1, abs=1e-4)


def test_log_shares_along_memory():
    """The same values as a softmax token by token, in at most 3/4 of its processor time (half of it when written)."""
    rng = np.random.default_rng(3)
    _, _, _, m = _tree_model(rng, 200, 0.1)
    m.rows, n = 25_000, 32_768
    weights = rng.normal(0, 0.3, m.shape).astype(np.float32)
    history = rng.integers(0, 2**63, (4, n), dtype=np.uint64)
    leaf = rng.integers(maxent.FAN ** (m.depth - 1), maxent.FAN**m.depth, n)

    def plain():
        out = np.zeros(n)
        for d, some, rows, node, y in maxent._levels(history, leaf, m):
            z = sum(weights[d][rows[k]] for k in range(1, 4)) + weights[d][rows[0]] + m.bias[d][node]
            z -= z.max(1, keepdims=True)
            z -= np.log(np.exp(z).sum(1, keepdims=True))
            out[some] += z[np.arange(len(y)), y]
        return out / np.log(10)

    def seconds(f):
        began = time.process_time()
        f()
        return time.process_time() - began

    assert maxent.log_shares(weights, m, history, leaf) == pytest.approx(plain(), abs=1e-5)
    assert min(seconds(lambda: maxent.log_shares(weights, m, history, leaf)) for _ in range(7)) < 0.75 * min(seconds(plain) for _ in range(7))


def test_update_and_score_match_a_plain_version():
    rng = np.random.default_rng(1)
    words, shapes, totals, m = _tree_model(rng, 60, 0.1)
    leaf, code, _ = m.dictionary(words, shapes, totals)
    docs = [rng.integers(1, 61, n).tolist() + [0] for n in (0, 1, 5, 30)]
    ids = np.array([i for d in docs for i in d])
    place = np.array([k for d in docs for k in range(len(d))])
    whole = maxent.histories(code[ids], place, 0, len(ids))
    for a, b in ((0, 3), (2, 20), (17, len(ids))):  # features of a slice do not depend on where it is cut
        assert (maxent.histories(code[ids], place, a, b) == whole[:, a:b]).all()
    starts = set(np.flatnonzero(place == 0).tolist())
    for i in range(len(ids)):  # the features see just the three words before, inside the document
        same = [j for j in range(len(ids)) if all((place[i] >= k) == (place[j] >= k) and (place[i] < k or code[ids[i - k]] == code[ids[j - k]]) for k in (1, 2, 3))]
        assert i in starts or all((whole[:, i] == whole[:, j]).all() for j in same)
    weights, squares, used = np.zeros(m.shape, np.float32), np.zeros(m.shape, np.float32), np.zeros(m.shape[:2], np.int64)
    plain = np.zeros(m.shape)
    plain_squares = np.zeros(m.shape)

    def paths(i):
        for d in range(m.depth if leaf[ids[i]] else 1):
            own = int(leaf[ids[i]]) // maxent.FAN ** (m.depth - 1 - d)
            node, y = divmod(own, maxent.FAN)
            rows = [int(maxent._rows(whole[k : k + 1, i : i + 1], np.array([node]), m.rows)[0, 0]) for k in range(4)]
            z = sum(plain[d][r] for r in rows) + m.bias[d][node]
            p = np.exp(z - z.max())
            yield d, rows, p / p.sum(), y

    for _ in range(3):
        maxent.update(weights, squares, used, m, whole, leaf[ids])
        g = np.zeros(m.shape)
        for i in range(len(ids)):
            for d, rows, p, y in paths(i):
                for r in rows:
                    g[d, r] += p
                    g[d, r, y] -= 1
        plain_squares += g * g
        plain -= maxent.RATE * g / np.sqrt(plain_squares + 1)
    assert np.abs(plain - weights).max() < 1e-3 and used.sum() == 3 * sum(4 for i in range(len(ids)) for _ in paths(i))
    want = [sum(math.log10(p[y]) for *_, p, y in paths(i)) for i in range(len(ids))]
    assert maxent.log_shares(weights, m, whole, leaf[ids]) == pytest.approx(want, abs=1e-3)


# --- shared parts ---


def test_word_hashes_follow_the_pattern():
    rng = random.Random(1)
    rows = ["".join(rng.choice("abAB \n\té") for _ in range(rng.randint(0, 40))) for _ in range(300)] + [None, ""]
    for piece in (1, 7, 50, 1 << 20):
        saved, common.pieces.__defaults__ = common.pieces.__defaults__, (piece,)
        h, at = common.word_hashes(pa.array(rows))
        common.pieces.__defaults__ = saved
        found = [re.findall(common.WORD, (r or "").replace("A", "a").replace("B", "b")) for r in rows]
        assert np.diff(at).tolist() == [len(w) for w in found]
        seen = {}
        for w, k in zip((w for ws in found for w in ws), h.tolist(), strict=True):
            assert seen.setdefault(w, k) == k
        assert len(set(seen.values())) == len(seen)


def test_pipeline_stages(spark, odd_docs):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near-copies", "benchmark", "mixing", "token-ids"]
    sf = "/root/testdata/sf0.001"
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf)
        docs = common.durable(docs, "test")
        if name != "token-ids":
            assert docs.columns == before.columns
        if name == "near-copies":
            assert docs.count() == 8
    empty = odd_docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf)
        assert empty.count() == 0


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline
    from tokenizers import Tokenizer

    sf = "/root/testdata/sf0.001"
    docs = common.table(spark, sf, "documents")
    rows = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    stage = dict(corpus_pipeline.STAGES)
    kept = common.durable(stage["toxicity"](spark, docs, sf), "test")
    scores = {r.doc_id: r.score for r in toxicity.score(docs, common.table(spark, sf, "labels")).collect()}
    assert {d for d, _ in rows(kept)} == {d for d, p in scores.items() if p < 0.5} and 0 < kept.count() <= docs.count()
    once = common.durable(stage["near-copies"](spark, kept, sf), "test")
    of = brute_components(rows(kept), 5, 80)
    assert sorted(d for d, _ in rows(once)) == sorted({c for _, c in of.values()})
    fresh = common.durable(stage["benchmark"](spark, once, sf), "test")
    items = [(r.item_id, r.text) for r in common.table(spark, sf, "benchmark").collect()]
    assert {d for d, _ in rows(once)} - {d for d, _ in rows(fresh)} == {d for d, _ in brute_contaminated(rows(once), items)}
    mix = common.durable(stage["mixing"](spark, fresh, sf), "test")
    text = dict(rows(fresh))
    times = Counter(rows(mix))
    assert all(text[d] == t and n <= 3 for (d, t), n in times.items())
    ids = stage["token-ids"](spark, mix, sf).orderBy("start").collect()
    model, at = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json")), 0
    for r, (d, t) in zip(ids, sorted(rows(mix)), strict=True):
        own = np.array([*model.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, at, len(own), zlib.crc32(own.tobytes()))
        at += len(own)

"""Exact dedup, resharding, mixing, token files."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelith.llm import exact_dedup, mixing, queries, resharding, tokens


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def test_radix_groups(spark, odd_docs, no_docs):
    got = exact_dedup.radix_groups(odd_docs, first=2, growth=4).collect()
    rows = texts(odd_docs)
    count = Counter(t for _, t in rows)
    assert len(got) == len(rows)
    by = {}
    for d, t in rows:
        by.setdefault(t, []).append(d)
    for r in got:
        mine = [t for t in by if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256]
        assert len(mine) == 1
        ids = [d for d in by[mine[0]] if d is not None]
        assert r.group_size == count[mine[0]] and r.keep_id == (max(ids) if ids else None)
    assert sum(r.kept for r in got) == len(by)
    assert exact_dedup.radix_groups(no_docs).count() == 0


def test_radix_groups_split_by_later_bytes(spark):
    base = "a" * 5000
    docs = spark.createDataFrame([(i, base + s) for i, s in enumerate(["", "b", "b", "c", "", "é", "é"])], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.radix_groups(docs).collect()}
    assert got == {0: (4, 2), 4: (4, 2), 1: (2, 2), 2: (2, 2), 3: (3, 1), 5: (6, 2), 6: (6, 2)}


def test_min_cost_flow_moves_least():
    supply, capacity = [100, 0, 50], [60, 60, 30]
    flow = resharding.min_cost_flow(supply, capacity)
    assert [sum(v for (i, _), v in flow.items() if i == k) for k in range(3)] == supply
    assert all(sum(v for (_, j), v in flow.items() if j == k) <= capacity[k] for k in range(3))
    moved = sum(v for (i, j), v in flow.items() if i != j)
    assert moved == (100 - 60) + (50 - 30)


def test_reshard(spark, odd_docs, no_docs):
    got = resharding.reshard(odd_docs, 3, 2, 4).collect()
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len(t.encode()) + 8, zlib.crc32(t.encode())) for _, t in texts(odd_docs))
    for s in range(3):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert resharding.reshard(no_docs, 3).count() == 0


def test_reshard_even_under_a_hot_group(spark):
    docs = spark.createDataFrame([(i, "hot text " * 5 if i % 3 == 0 else f"text number {i} " * 4) for i in range(3000)], "doc_id long, text string")
    sizes = Counter()
    again = {}
    for r in resharding.reshard(docs, 8).collect():
        sizes[r.shard] += r.size
        again[r.doc_id] = (r.shard, r.slot)
    mean = sum(sizes.values()) / 8
    assert max(abs(v - mean) for v in sizes.values()) < 0.02 * mean
    assert again == {r.doc_id: (r.shard, r.slot) for r in resharding.reshard(docs.repartition(7), 8).collect()}


def test_equal_texts_stay_together_and_few_bytes_move(spark):
    rows = [(i, f"text {i % 700} " * (1 + i % 700 % 9) if i % 3 else "a third of all rows") for i in range(4000)] + [(5000 + i, "nearly a shard " * 10) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = resharding.reshard(docs, 8, 6).collect()
    text, total = dict(rows), sum(r.size for r in got)
    shards, weight, size = {}, Counter(), Counter()
    for r in got:
        shards.setdefault(text[r.doc_id], set()).add(r.shard)
        weight[text[r.doc_id]] += r.size
        size[r.shard] += r.size
    assert weight["nearly a shard " * 10] > total / 8 / 50
    for t, s in shards.items():
        assert len(s) == 1 or weight[t] > total / 8
    assert len(shards["a third of all rows"]) > 1 or weight["a third of all rows"] <= total / 8
    assert max(abs(v - total / 8) for v in size.values()) < 0.02 * total / 8
    supply = [sum(r.size for r in got if r.old_shard == i) for i in range(6)]
    flow = resharding.min_cost_flow(supply, [total * (j + 1) // 8 - total * j // 8 for j in range(8)])
    least = sum(v for (i, j), v in flow.items() if i != j)
    assert sum(r.size for r in got if r.moved) <= 1.03 * least


def test_place_blocks_against_brute_force():
    from itertools import product

    rng = np.random.default_rng(4)
    for _ in range(20):
        blocks = [(k, int(rng.integers(0, 2)), int(rng.integers(1, 6))) for k in range(7)]
        room = -(-sum(b[2] for b in blocks) // 2) + 1
        placed = dict(resharding.place_blocks(blocks, [room, room], 2))
        load = Counter()
        for k, _, size in blocks:
            load[placed[k]] += size
        assert max(load.values()) <= room + 5
        moved = sum(size for k, i, size in blocks if placed[k] != i)
        ways = [sum(size for j, (_, i, size) in zip(w, blocks, strict=True) if j != i) for w in product((0, 1), repeat=7) if max(sum(b[2] for j, b in zip(w, blocks, strict=True) if j == s) for s in (0, 1)) <= room]
        assert not ways or moved <= min(ways) + 5  # a block at most


def test_rewrite_keeps_every_row_and_untouched_shards(spark, odd_docs, no_docs, tmp_path):
    docs = odd_docs.unionByName(odd_docs.filter("doc_id is null or doc_id = 1"))
    rows = lambda df: Counter(tuple(r) for r in df.select(odd_docs.columns).collect())
    one, two = f"file://{tmp_path}/one", f"file://{tmp_path}/two"
    resharding.rewrite(docs, one, 3, 2, 4, every=True)
    store = resharding.read_store(spark, docs.schema, one)
    assert rows(store) == rows(docs)
    got = Counter((r.doc_id, r.text_crc32, r.shard, r.slot) for r in resharding.reshard(docs, 3, 2, 4).collect())
    assert got == Counter((r.doc_id, zlib.crc32((r.text or "").encode()), r.shard, r.slot) for r in store.collect())
    size = Counter()
    for r in store.collect():
        size[r.shard] += len((r.text or "").encode()) + 8
    small, _, big = sorted(range(3), key=lambda s: size[s])  # the middle one keeps all it has; the largest moves to a new shard
    room = [0 if s == big else size[s] for s in range(3)] + [size[big]]
    touched = resharding.rewrite(store, two, 4, old_shard="shard", capacities=room)
    assert set(touched) >= {big, 3} and len(touched) < 4
    assert {int(p.name[6:]) for p in (tmp_path / "two").glob("shard=*")} <= set(touched) - {big}
    again = resharding.read_store(spark, docs.schema, two, one, touched)
    assert rows(again) == rows(docs)
    for s in range(4):
        assert sorted(r.slot for r in again.filter(f"shard = {s}").collect()) == list(range(again.filter(f"shard = {s}").count()))
    with pytest.raises(Exception, match="(?i)exist"):
        resharding.rewrite(store, two, 4, old_shard="shard", capacities=room)
    assert resharding.rewrite(no_docs, f"file://{tmp_path}/none", 3) == [] and resharding.read_store(spark, no_docs.schema, f"file://{tmp_path}/none").count() == 0


def test_rows_without_an_old_shard_and_given_capacities(spark):
    docs = spark.createDataFrame([(i, f"text {i:04}", None if i < 100 else i % 2) for i in range(1000)], "doc_id long, text string, at int")
    got = resharding.reshard(docs, 3, old_shard="at", capacities=[9000, 9000, 2000]).collect()
    size = Counter()
    for r in got:
        size[r.shard] += r.size
        assert r.moved == (r.old_shard is None or r.old_shard != r.shard)
    assert len(got) == 1000 and size[2] <= 2200 and max(size.values()) <= 9200
    with pytest.raises(ValueError, match="capacities"):
        resharding.reshard(docs, 3, old_shard="at", capacities=[10, 10, 10])


def test_op10_reads_the_rewritten_files(spark, monkeypatch):
    written = []
    saved = resharding.rewrite
    monkeypatch.setattr(resharding, "rewrite", lambda docs, path, *a, **b: written.append(path) or saved(docs, path, *a, **b))
    got = queries.op10_resharding(spark, "/root/testdata/sf0.001")
    assert written and got.inputFiles() and all(written[0].removeprefix("file:").lstrip("/") in f for f in got.inputFiles())
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got.collect()) == sorted((d, len(t.encode()) + 8, zlib.crc32(t.encode())) for d, t in texts(docs))


def water_fill(size, weight, cap):
    total, open_, target = sum(size.values()), set(size), {}
    while True:
        rest = total - sum(target.values())
        w = sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] / w > cap[s]]
        if not over:
            return target | {s: rest * weight[s] / w for s in open_}
        for s in over:
            target[s] = cap[s]
            open_.discard(s)


def test_mixing_targets_and_draws(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 40)), ["a", "b", None, "tiny"][0 if i % 9 < 5 else 1 if i % 9 < 7 else 2 if i != 8 else 3]) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.draw(docs)[0].collect()
    size = Counter()
    for _, t, s in rows:
        size[s] += len(t.split())
    order = ["a", "b", "tiny", None]
    want = water_fill(size, {s: 1 + i % 3 for i, s in enumerate(order)}, {s: 3 * size[s] for s in size})
    taken = Counter()
    for r in got:
        assert r.taken <= 3 * r.size and r.taken == r.size * len(r.shards)
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= max(20, 0.01 * want[s])
    assert {(r.doc_id, tuple(sorted(r.shards))) for r in got} == {(r.doc_id, tuple(sorted(r.shards))) for r in mixing.draw(docs.repartition(9))[0].collect()}


def test_mixing_odd(spark, odd_docs, no_docs):
    got = mixing.draw(odd_docs)[0]
    assert sorted(r.size for r in got.collect()) == sorted(len(t.split()) for _, t in texts(odd_docs))
    mixed = mixing.mixed(odd_docs)
    assert mixed.count() == sum(len(r.shards) for r in got.collect())
    assert mixing.draw(no_docs)[0].count() == 0 and mixing.mixed(no_docs).count() == 0


def test_mix_files_hold_what_the_tree_gave(spark, tmp_path, odd_docs, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 64)
    rows = [(i if i % 50 else None, f"{i} " + "w " * (i % 30), "abc"[i % 3] if i % 7 else None) for i in range(6000)]
    docs = spark.createDataFrame([*rows, *rows[:5], *rows[:5]], "doc_id long, text string, source string")
    path = f"file://{tmp_path}/mix"
    got = mixing.write(docs, path).collect()
    plan, units = mixing.draw(docs)
    assert len(got) == docs.count() and all(r.taken == r.size * len(r.shards) <= 3 * r.size for r in got)
    assert sum(r.taken for r in got) == sum(r.taken for r in plan.collect())
    files = spark.read.parquet(path)
    size = Counter()
    for r in files.collect():
        size[r.mix_shard] += len(r.text.split())
    assert len(size) == 16 and sum(size.values()) == sum(r.taken for r in got)
    have = Counter((r.name, r.shard) for r in units.collect())
    names = sorted({n for n, _ in have})
    tree = mixing.split_tree([sum(v for (n, _), v in have.items() if n == name) for name in names], 16, 7)
    assert all(have[name, k] == tree[k][j] for k in range(16) for j, name in enumerate(names))
    for f in (tmp_path / "mix").glob("*/*.parquet"):
        order = [r.mix_order for r in spark.read.parquet(f"file://{f}").collect()]
        assert order == sorted(order)
    mixed = mixing.mixed(odd_docs.withColumn("mix_row", F.lit(1)).withColumn("mix_shard", F.lit(99)))
    assert set(mixed.columns) == {*odd_docs.columns, "mix_row", "mix_shard", "mix_order"} and mixed.filter("mix_shard = 99").isEmpty()


def test_split_tree_is_exact():
    out = np.array(mixing.split_tree([100, 7, 0], 5, 1))
    assert out.sum(0).tolist() == [100, 7, 0] and max(out.sum(1)) - min(out.sum(1)) <= 1


def test_repair_round_trip_and_ranges():
    rng = np.random.default_rng(1)
    ids = np.concatenate([np.tile([5, 6, 7, 8], 500), rng.integers(3, 40, 3000), np.full(300, 9), [2]]).astype(np.int32)
    codes, left, right, levels = tokens.repair(ids)
    assert len(codes) < 0.7 * len(ids) and (tokens.expand(codes, left, right, levels) == ids).all()
    sizes = tokens.expansion_sizes(left, right, levels)
    assert np.where(codes >= tokens.FIRST_RULE, sizes[np.maximum(codes - tokens.FIRST_RULE, 0)], 1).sum() == len(ids)
    for few in ([], [2], [4, 2, 2], [7]):
        c, a, b, lv = tokens.repair(np.array(few, np.int32))
        assert tokens.expand(c, a, b, lv).tolist() == few and len(tokens.expansion_sizes(a, b, lv)) == 0


def test_repair_leaves_no_frequent_pair_without_a_rule():
    rng = np.random.default_rng(3)
    common = np.repeat(np.arange(3, 703), 200)
    rng.shuffle(common)
    rare = np.concatenate([np.concatenate([np.arange(5000, 5040), [2]]) for _ in range(100)])  # outside the 512 most frequent
    ids = np.concatenate([common, rare, np.full(3000, 9)]).astype(np.int32)
    codes, left, right, levels = tokens.repair(ids)
    assert (tokens.expand(codes, left, right, levels) == ids).all()
    assert (codes[np.flatnonzero(codes == 2)[1:] - 1] >= tokens.FIRST_RULE).all() and np.diff(np.flatnonzero(codes == 2)).max() == 2
    pairs = Counter(p for p in zip(codes[:-1].tolist(), codes[1:].tolist(), strict=True) if 2 not in p)
    assert all(n < tokens.LEAST for (a, b), n in pairs.items() if a != b)


def test_frequent_pairs_are_exact(monkeypatch):
    pair = np.random.default_rng(5).zipf(1.3, 20_000).clip(max=1 << 40).astype(np.int64)
    want = {p: n for p, n in Counter(pair.tolist()).items() if n >= tokens.LEAST}
    for bits in (1, 5, 19):
        monkeypatch.setattr(tokens, "PAIR_BITS", bits)
        values, found, place, number = tokens.frequent_pairs(pair)
        assert dict(zip(values.tolist(), found.tolist(), strict=True)) == want and len(values) == len(want)
        of = dict(zip(place.tolist(), number.tolist(), strict=True))
        assert all((of.get(k, -1) < 0 and p not in want) or values[of[k]] == p for k, p in enumerate(pair.tolist()))


def test_encoding_by_words_equals_whole_texts():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    model, rng = Tokenizer.from_file(path), np.random.default_rng(2)
    parts = ["Don't", "it's...", "'s", "x'", "ab,c.", "İstanbul", "e\u0301t", "ﬁne", "12a", "汉字", "end?!", "&&&", "a\u00a0b", "\u2028", "\n", " ", "", "<", "|>", "ǅ", "we'LL.", "=\u0338", "a=\u0338", "x\x00y"]
    rows = [" ".join(rng.choice(parts, rng.integers(0, 12)).tolist()) for _ in range(400)] + [None, ""]
    for some in (rows, [*rows, "a<|endoftext|>. <|STARTOFTEXT|>", "<|startoftext|>,"]):
        ids, lens = tokens.encode_column(pa.array(some), path)
        want = [e.ids for e in model.encode_batch([r or "" for r in some], add_special_tokens=False)]
        assert lens.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_token_files(spark, odd_docs, no_docs, tmp_path):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    model = Tokenizer.from_file(path)
    tokens.write_tokens(odd_docs, f"file://{tmp_path}/t", path, block_ids=2000)
    got = tokens.document_digests(spark, f"file://{tmp_path}/t").orderBy("start").collect()
    want = sorted(texts(odd_docs), key=lambda x: (x[0] is not None, x[0], x[1]))
    at = 0
    for r, (d, t) in zip(got, want, strict=True):
        ids = np.array(model.encode(t, add_special_tokens=False).ids + [2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    block = tokens.Block(max((r.asDict() for r in tokens.read_tokens(spark, f"file://{tmp_path}/t").collect()), key=lambda r: r["n_ids"]))
    whole, k = block.ids(), int(np.argmax(block.lens))
    a = int(block.lens[:k].sum())
    assert (block.decode_range(k, 100, 900) == whole[a + 100 : a + 900]).all() and (block.decode_range(k, 0, int(block.lens[k])) == whole[a : a + block.lens[k]]).all()
    other = queries.tokenizer_path("byte_bpe_50k.json")  # keeps white space and case: whole texts are encoded
    tokens.write_tokens(odd_docs, f"file://{tmp_path}/o", other)
    model = Tokenizer.from_file(other)
    for r, (d, t) in zip(tokens.document_digests(spark, f"file://{tmp_path}/o").orderBy("start").collect(), want, strict=True):
        assert (r.doc_id, r.ids_crc32) == (d, zlib.crc32(np.array([*model.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()))
    tokens.write_tokens(no_docs, f"file://{tmp_path}/e", path)
    assert tokens.document_digests(spark, f"file://{tmp_path}/e").count() == 0


def test_a_worker_encodes_a_word_once_whatever_its_steps(monkeypatch):
    import public_tokenizers

    path, seen, real = public_tokenizers.path("word_bpe_49k.json"), [], tokens._encode_joined
    monkeypatch.setattr(tokens, "_KNOWN", {})
    monkeypatch.setattr(tokens, "_encode_joined", lambda model, ends, chunks, one: seen.extend(chunks) or real(model, ends, chunks, one))
    model = tokens.tokenizer(path)[0]
    for text in ["lorem ipsum, dolor", "ipsum Lorem dolor sit ñandú.", "sit amet lorem"]:
        ids, _ = tokens.encode_column(pa.array([text]), path)
        assert ids.tolist() == model.encode(text, add_special_tokens=False).ids
    assert sorted(w.lower() for w in seen) == sorted({w.lower() for w in seen})
    monkeypatch.setattr(tokens, "MOST_WORDS", 3)  # begins anew, with the same ids
    assert tokens.encode_column(pa.array(["lorem ipsum dolor sit amet"]), path)[0].tolist() == model.encode("lorem ipsum dolor sit amet", add_special_tokens=False).ids
    assert len(tokens._KNOWN[path].words) == 5

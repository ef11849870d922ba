"""Decontamination: long items in linear time, rows judged each by id and text, columns of any name."""

import time

from panelith.llm import decontaminate


def text(words, seed, n):
    return " ".join(f"{words[(i * 7 + seed * i * i) % len(words)]}{(i * 13 + seed) % 89}" for i in range(n))


def test_rows_are_judged_by_id_and_text(spark, words):
    item = text(words, 1, 40)
    bench = spark.createDataFrame([(1, item), (1, item), (2, "")], "item_id int, text string")
    rows = [(None, "before " + item + " after"), (None, "clean words only here"), (5, item), (5, text(words, 2, 60)), (6, None), (7, item), (7, item), (8, text(words, 3, 50))]
    docs = spark.createDataFrame([(*r, i, "x", 7, 9) for i, r in enumerate(rows)], "doc_id long, text string, n int, `a.b` string, key int, text_hash int")
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.n for r in kept.collect()) == [1, 3, 4, 7]
    found = {(r.doc_id, r.item_id, r.item_words, r.matched_words) for r in decontaminate.contaminated(docs, bench).collect()}
    assert found == {(None, 1, 40, 40), (5, 1, 40, 40), (7, 1, 40, 40)}
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(rows) and decontaminate.clean(docs.limit(0), bench).count() == 0


def test_an_item_that_begins_before_the_text(spark, words):
    item = text(words, 4, 30)
    tail, head = " ".join(item.split()[12:]), " ".join(item.split()[:18])
    docs = spark.createDataFrame([(1, tail + " and more words follow"), (2, "some words first " + head)], "doc_id long, text string")
    got = {r.doc_id: (r.matched_words, r.best_stretch) for r in decontaminate.contaminated(docs, spark.createDataFrame([(1, item)], "item_id int, text string")).collect()}
    assert got == {1: (18, 18), 2: (18, 18)}


def test_work_grows_with_the_length_of_an_item(spark, words):
    def took(n):
        item = text(words, 5, n)
        docs = spark.createDataFrame([(i, f"word{i} " + item) for i in range(4)], "doc_id long, text string")
        bench = spark.createDataFrame([(1, item)], "item_id int, text string")
        began = time.time()
        rows = decontaminate.contaminated(docs, bench).collect()
        assert [r.matched_words for r in rows] == [n] * 4
        return time.time() - began

    took(500)
    short, long = took(500), took(4000)
    assert long < 8 * short + 15  # eight times the words; quadratic work would be 64 times

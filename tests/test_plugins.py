"""User factors in Arrow, and many keywords in one pass."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from panelith.functions import factors
from panelith.operators import keywords, news


@pytest.fixture(scope="module")
def prices(spark):
    r = random.Random(4)
    rows = [(f"c{c}", f"2024{d:04d}", None if r.random() < 0.05 else 10 + r.random()) for c in range(7) for d in range(40)]
    r.shuffle(rows)
    return spark.createDataFrame(rows, "ts_code string, trade_date string, adj_close double").repartition(5).cache()


def values(df, name):
    return {(r.ts_code, r.trade_date): r[name] for r in df.collect()}


def test_numpy_plugin_equals_built_in_momentum(prices):
    mine = factors.run_code_plugin(prices, factors.numpy_momentum, "mine", window=5)
    assert mine.columns == [*prices.columns, "mine"]
    assert values(mine, "mine") == pytest.approx(values(prices.withColumn("m", factors.momentum(5)), "m"), nan_ok=True)


def test_row_plugin_shuffles_nothing(prices):
    mine = factors.run_row_plugin(prices, lambda batch, k: pc.multiply(batch["adj_close"], k), "mine", k=2.0)
    assert "Exchange" not in mine._jdf.queryExecution().executedPlan().toString().split("InMemory")[0]
    assert values(mine, "mine") == values(prices.withColumn("m", F.col("adj_close") * 2), "m")


@pytest.mark.parametrize(("made", "message"), [(lambda t: np.zeros(t.num_rows + 1), "values for"), (lambda t: pa.array(["x"] * t.num_rows), "not numbers")])
def test_plugin_contract(prices, made, message):
    for run in (factors.run_code_plugin, factors.run_row_plugin):
        with pytest.raises(PythonException, match=message):
            run(prices, made, "mine").collect()
        with pytest.raises(ValueError):
            run(prices, made, "adj_close")


def test_values_of_any_numeric_kind():
    for made in (np.array([1, 2]), pa.array([1.0, None]), pa.chunked_array([[1.0], [float("nan")]]), [1.5, None], pa.array([None, None])):
        out = factors.checked_values(made, 2, "x", "")
        assert out.type == pa.float64() and not np.isnan([v for v in out.to_pylist() if v is not None]).any()


def test_ten_thousand_keywords_in_one_pass(spark):
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcde ") for _ in range(r.randint(1, 6)))
    words = [word() for _ in range(10_000)]
    words[17], words[99] = words[3], "é汉"  # one twice, one beyond ASCII
    texts = [" ".join(word() for _ in range(r.randint(0, 60))) for _ in range(200)] + [None, "", "x é汉 y"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = {x.id: x.at for x in df.select("id", keywords.by_automaton(F.col("t"), words).alias("at")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == ([k for k, w in enumerate(words) if w in t] if t is not None else [])


def test_automaton_equals_instr(spark):
    raw = spark.createDataFrame([(1, "Chips boom", "chip orders", "mock", ["tech"]), (2, "rates", "cut Rates", "cctv", None), (3, "sports", None, "x", None)], "id int, title string, content string, source string, tags array<string>")
    rules = {"macro": ["RATES", "cut"], "tech": ["chip"]}
    for few in (0, 100):
        out = news.categorize(news.relevant(raw, ["chip", "rates", "boom", " "], few), rules, {"cctv": 1.2}, few)
        assert {x.id: (x.matched_keywords, x.category, x.source_weight) for x in out.collect()} == {1: (["chip", "boom"], "tech", 1.0), 2: (["rates"], "macro", 1.2)}
        assert news.relevant(raw, [], few).count() == 3 and news.categorize(raw, {}, {}, few).select("category").distinct().first()[0] == "other"


def test_texts_are_searched_once_for_filter_and_words(spark):
    words = [f"w{i}" for i in range(40)] + ["w7"]  # more than instr takes, one twice
    raw = spark.createDataFrame([(1, "a w7", None, "x", None), (2, "none", None, "x", None)], "id int, title string, content string, source string, tags array<string>")
    out = news.relevant(raw, words)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert [(r.id, r.matched_keywords) for r in out.collect()] == [(1, ["w7", "w7"])]

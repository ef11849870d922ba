import datetime as dt
import hashlib

import numpy as np
import pyarrow as pa
import pytest

from panelith.functions import digest, factors
from panelith.operators import by_date, compare, order
from panelith.plans import frames, queries

SF = "/root/testdata/sf0.01"


def test_no_frame_grows_with_the_number_of_factors_and_runs(spark, monkeypatch):
    kept, real = [], queries.store.stored
    monkeypatch.setattr(queries.store, "stored", lambda df: kept.append(real(df)) or kept[-1])
    assert queries.QUERIES["i03_evaluated_comparison"](spark, SF).count() == 36
    assert max(f.count() for f in kept) < 3 * frames.panel(spark, SF).count()


def test_dates_and_the_long_form_agree(spark):
    s = frames.research_sample(spark, SF)
    key = ["group", "factor_id", "run_id"]
    one, other = ({tuple(r[k] for k in key): r.asDict() for r in m.collect()} for m in (queries._metrics_of_dates(s, 1, s.count()), queries._metrics_of_long(s, 1)))
    assert one.keys() == other.keys() and len(one) == 3 + 12 + 9
    for k, r in one.items():
        for c, v in r.items():
            assert v == (pytest.approx(other[k][c], rel=1e-9, abs=1e-12) if isinstance(v, float) else other[k][c]), (k, c)


def test_large_dates_take_the_long_form(spark, monkeypatch):
    def long(s, repeats):
        raise LookupError(repeats)

    monkeypatch.setattr(queries, "_metrics_of_long", long)
    monkeypatch.setattr(order, "ONE_TASK", 10)
    with pytest.raises(LookupError):
        queries._compared(spark, SF)


def test_names_are_kept_by_the_dates_of_each_signal():
    days = np.array(["2024-01-01", "2024-01-02", "2024-01-03"], "datetime64[D]")
    place = np.array([[0, 1, 2], [0, -1, 1]])
    rows = [("a", 2, b"\x05\x02"), ("b", 0, b"\x01\x00"), ("a", 0, b"\x05\x02"), ("b", 1, b"\x01\x00"), ("b", 2, b"\x02\x03")]  # no row of a on the second date
    table = pa.table({"trade_date": pa.array(days[[d for _, d, _ in rows]], pa.date32()), "ts_code": [c for c, _, _ in rows], "buckets": pa.array([b for *_, b in rows], pa.binary())})
    got = {(r["k"], r["trade_date"], r["quantile"]): r["kept"] for r in by_date.kept_of(table, days, place, 5).to_pylist()}
    assert got == {(0, dt.date(2024, 1, 2), 1): 1, (1, dt.date(2024, 1, 3), 2): 1}


def test_noise_is_that_of_the_long_form(spark):
    rows = spark.sql("SELECT date'2024-01-31' AS trade_date, concat('30000', id) AS ts_code, CAST(id AS DOUBLE) AS f FROM range(8)")
    codes = by_date.Codes.of(pa.chunked_array([[f"30000{i}" for i in range(8)]]))
    for name in compare.NOISE[:2]:
        want = compare.noise_factors(rows, "f", 2, names=[name]).filter("run_id = 1").orderBy("ts_code").collect()
        assert by_date.drawn(name, codes, "2024-01-31", 1, 20260607).tolist() == pytest.approx([r.f for r in want], rel=1e-12)
    want = compare.noise_factors(rows, "f", 1, names=["random_by_date_shuffle"]).orderBy("ts_code").collect()
    u = by_date.drawn("random_by_date_shuffle", codes, "2024-01-31", 0, 20260607)
    assert np.argsort(u).tolist() == [int(r.f) for r in want]


def test_heads_of_md5():
    for size in (0, 1, 30, 55, 56, 80):
        texts = np.random.default_rng(size).integers(0, 256, (9000, size), np.uint8)
        some = (0, 8191, 8192, 8999)
        assert [int(digest.md5_heads(b"|", texts)[i]) for i in some] == [int.from_bytes(hashlib.md5(b"|" + texts[i].tobytes()).digest()[:8], "big") for i in some]


def test_codes_of_any_length():
    names = ["3", "300001", "", "\u4e3b7", "3000010"]
    codes = by_date.Codes.of(pa.chunked_array([names]))
    head = [hashlib.md5(f"9|2|1|2024-01-31|{s}".encode()).hexdigest()[:13] for s in names]
    assert by_date.unit(codes, "2024-01-31", 1, 2, 9).tolist() == [(int(h, 16) + 0.5) / 2**52 for h in head]


def test_rows_are_dealt_once_to_their_dates(spark):
    """The sample and the factors stay where rows lie by code."""
    s = frames.research_sample(spark, SF, apart=True)
    plan = s.withColumn("x", factors.momentum(5))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(ts_code") == 0
    want = frames.research_sample(spark, SF)
    assert s.columns == want.columns and s.count() == want.count() and s.exceptAll(want).isEmpty()


def test_equal_factors_are_computed_once(spark, monkeypatch):
    seen, real = [], by_date.date_facts
    monkeypatch.setattr(by_date, "date_facts", lambda df, signals, *a, **k: (seen.append((df.columns, signals)), real(df, signals, *a, **k))[1])
    s = frames.research_sample(spark, SF)
    assert queries._metrics_of_dates(s, 1, 1000).count() == 24
    columns, signals = seen[0]
    assert len(signals) == 24 and len([c for c in columns if c.startswith("v")]) == 12

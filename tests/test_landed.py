"""Loads of landed files: one bad file fails its own partition, with the reason, and no other; swaps of whole tables."""

import gzip

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from panelith.sources import schemas, store

NAMES = schemas.TABLES["daily"].fieldNames()


def text(date, n=3, **over):
    rows = [{"ts_code": f"c{i}", "trade_date": date, **{c: str(float(i)) for c in NAMES[2:]}} for i in range(n)]
    rows[0] |= over
    return "\n".join([",".join(NAMES), *[",".join(r[c] for c in NAMES) for r in rows]]) + "\n"


@pytest.fixture()
def landing(tmp_path):
    def put(date, content, name="part.csv"):
        folder = tmp_path / "landing" / "daily" / f"day={date}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(content if isinstance(content, bytes) else content.encode())

    return put


def ledger(s):
    return {r.trade_date: (r.status, r.row_count, r.error_message) for r in s.ledger().collect()}


def test_bad_files_fail_their_own_partition(spark, tmp_path, landing):
    landing("20240102", text("20240102"))
    landing("20240103", text("20240103")[:-25])  # cut short in its last row
    landing("20240104", text("20240104", open="n/a"))
    landing("20240105", text("20240105", trade_date="20240199"))
    landing("20240106", "")
    landing("20240108", text("20240108", 2))
    landing("20240108", text("20240108", 4), "more.csv")
    landing("20240109", gzip.compress(text("20240109", 500).encode()), "part.csv.gz")
    landing("20240110", gzip.compress(text("20240110", 500).encode())[:-60], "part.csv.gz")
    dates = spark.createDataFrame([(f"202401{d:02d}",) for d in (2, 3, 4, 5, 6, 7, 8, 9, 10)], "trade_date string")
    s = store.Store(spark, f"file://{tmp_path}/store")
    assert tuple(s.load_files(f"file://{tmp_path}/landing", ["daily"], dates).first()) == ("daily", 3 + 6 + 500, 0, 6)
    lines = ledger(s)
    assert {d for d, v in lines.items() if v[0] == "success"} == {"20240102", "20240108", "20240109"} and lines["20240108"] == ("success", 6, None)
    assert lines["20240103"][2].startswith("1 rows do not parse, one is: c2,20240103")
    assert "n/a" in lines["20240104"][2] and lines["20240105"][2] == "1 rows of another date: 20240199"
    assert lines["20240106"][2] == lines["20240107"][2] == "no landed file, or an empty one" and lines["20240110"][2].startswith("EOFError")
    got = {r.trade_date: r["count"] for r in s.read("daily").groupBy("trade_date").count().collect()}
    assert got == {"20240102": 3, "20240108": 6, "20240109": 500}
    assert s.read("daily").filter("trade_date = '20240102' and ts_code = 'c2'").select("open", "amount").first() == (2.0, 2.0)

    landing("20240104", text("20240104", 5))  # put right: the next load takes it, and skips what is there
    assert tuple(s.load_files(f"file://{tmp_path}/landing", ["daily"], dates).first()) == ("daily", 5, 3, 5)
    assert ledger(s)["20240104"] == ("success", 5, None)


def test_a_broken_file_leaves_what_was_stored(spark, tmp_path, landing):
    dates = spark.createDataFrame([("20240102",)], "trade_date string")
    s = store.Store(spark, f"file://{tmp_path}/store")
    landing("20240102", text("20240102", 4))
    s.load_files(f"file://{tmp_path}/landing", ["daily"], dates)
    landing("20240102", text("20240102", 9)[:-10])
    assert tuple(s.load_files(f"file://{tmp_path}/landing", ["daily"], dates, force=True).first()) == ("daily", 0, 0, 1)
    assert s.read("daily").count() == 4 and ledger(s)["20240102"][0] == "failed"


def test_parquet_files(spark, tmp_path):
    folder = tmp_path / "landing" / "daily"
    for day in ("20240102", "20240103"):
        rows = spark.createDataFrame([("a", day, *[1.0] * 9), ("b", day, *[2.0] * 9)], schemas.TABLES["daily"])
        rows.coalesce(1).write.parquet(str(folder / f"day={day}"))
    broken = next((folder / "day=20240103").glob("*.parquet"))
    broken.write_bytes(broken.read_bytes()[:-100])
    for crc in (folder / "day=20240103").glob(".*.crc"):
        crc.unlink()
    s = store.Store(spark, f"file://{tmp_path}/store")
    dates = spark.createDataFrame([("20240102",), ("20240103",)], "trade_date string")
    assert tuple(s.load_files(f"file://{tmp_path}/landing", ["daily"], dates, kind="parquet").first()) == ("daily", 2, 0, 1)
    assert ledger(s)["20240103"][2].startswith("ArrowInvalid") and s.read("daily").count() == 2
    with pytest.raises(ValueError):
        s.load_files(f"file://{tmp_path}/landing", ["daily"], dates, kind="xml")


def test_readers_rename_nothing(spark, tmp_path):
    s = store.Store(spark, f"file://{tmp_path}")
    frame = lambda x: spark.createDataFrame([(x,)], "x int")
    s.write("t", frame(1))
    (tmp_path / "t").rename(tmp_path / "t.old")  # a writer between its two renames
    assert s.exists("t") and s.read("t").first().x == 1
    assert (tmp_path / "t.old").exists() and not (tmp_path / "t").exists()
    (tmp_path / "t.old").rename(tmp_path / "t")
    s.write("t", frame(2))
    assert s.read("t").first().x == 2 and not (tmp_path / "t.old").exists()
    with pytest.raises((OSError, Py4JJavaError)):
        s._rename(f"file://{tmp_path}/nothing", f"file://{tmp_path}/other")


def test_rebuild_follows_the_stored_columns(spark, tmp_path):
    s = store.Store(spark, f"file://{tmp_path}")
    rows = spark.createDataFrame([(f"2024010{d}", "a", float(d), 1.0) for d in range(1, 6)], "trade_date string, ts_code string, close double, pb double")
    build = lambda columns: lambda a, b: (rows if a is None else rows.filter(F.col("trade_date").between(a, b))).select(columns)
    assert s.rebuild_range("p", build(rows.columns), "20240102", "20240103") == (2, False) and s.read("p").count() == 2
    assert s.rebuild_range("p", build(rows.columns), "20240103", "20240105") == (3, False) and s.read("p").count() == 4
    assert s.rebuild_range("p", build(["trade_date", "ts_code", "close"]), "20240102", "20240102") == (1, True)
    assert s.read("p").count() == 5 and s.columns("p") == {"trade_date", "ts_code", "close"}

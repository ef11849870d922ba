"""Evaluation of many factors and noise runs where a task has the rows of a whole date, a column for each factor.

What a date gives (values, noise, ranks, buckets) is made in numpy from one Arrow table of the date, so a row is dealt
twice, whatever the number of factors and runs: once by date, and once by code, with a byte for each of them, to see which
names stay in their bucket.  Results are those of the long form in ``preprocess``, ``compare`` and ``evaluate``; dates too
large for one task need that form.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.digest import md5_heads
from .compare import NOISE
from .order import dealt
from .preprocess import MAD_SCALE, TINY

#: A row for each date and signal (k), and one for each row of a date that is in any signal's buckets (ts_code, buckets).
FACTS = "trade_date date, k int, n_rows long, n_ok long, n_values long, low double, high double, rank_ic double, returns array<double>, names array<long>, ts_code string, buckets binary"
KINDS = pa.schema(
    [("trade_date", pa.date32()), ("k", pa.int32()), ("n_rows", pa.int64()), ("n_ok", pa.int64()), ("n_values", pa.int64()), ("low", pa.float64()), ("high", pa.float64()), ("rank_ic", pa.float64()), ("returns", pa.list_(pa.float64())), ("names", pa.list_(pa.int64())), ("ts_code", pa.string()), ("buckets", pa.binary())]
)


@dataclass(frozen=True)
class Signal:
    """A column with its direction, or a noise run in the place of its values."""

    column: str
    sign: int = 1
    noise: str | None = None
    run: int = 0


# --- values of a date -----------------------------------------------------------------------------


def winsorized(x: np.ndarray, n: float = 3.0) -> np.ndarray:
    v = x[~np.isnan(x)]
    if not len(v):
        return x
    med = np.median(v)
    mad = np.median(np.abs(v - med)) * MAD_SCALE
    return x if mad == 0 else np.clip(x, med - n * mad, med + n * mad)


def zscored(x: np.ndarray) -> np.ndarray:
    v = x[~np.isnan(x)]
    if not len(v):
        return x
    s = v.std()
    return np.zeros(len(x)) if s <= TINY else (x - v.mean()) / s


def neutralized(x: np.ndarray, mv: np.ndarray, industry: np.ndarray, least_rows: int = 10) -> np.ndarray:
    """Residual on industry (-1 is none) and the log of size."""
    ok = ~np.isnan(x) & (mv > 0) & (industry >= 0)
    out = np.full(len(x), np.nan)
    if np.count_nonzero(ok) < least_rows:
        return out
    g, y, size = industry[ok], x[ok], np.log(mv[ok])
    n = np.maximum(np.bincount(g), 1)
    dy, dx = y - (np.bincount(g, y) / n)[g], size - (np.bincount(g, size) / n)[g]
    xx = np.sum(dx * dx)
    out[ok] = dy - (np.sum(dx * dy) / xx if xx else 0.0) * dx
    return out


def processed(x: np.ndarray, mv: np.ndarray, industry: np.ndarray, sign: int) -> np.ndarray:
    """What ``preprocess`` gives with neutralization by industry and size, signed, to six digits."""
    z = zscored(neutralized(zscored(winsorized(x)), mv, industry)) * sign
    return np.copysign(np.floor(np.abs(z) * 1e6 + 0.5) / 1e6, z) + 0.0


@dataclass(frozen=True)
class Codes:
    """The codes of a date by length: where they stand, and a row of bytes for each."""

    n: int
    sized: Sequence[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(names: pa.ChunkedArray) -> Codes:
        held = names.combine_chunks()
        if not len(held):
            return Codes(0, [])
        _, offsets, data = held.buffers()
        start = np.frombuffer(offsets, np.int32)[held.offset :][: len(held) + 1].astype(int)
        flat, size, start = np.frombuffer(data or b"", np.uint8), np.diff(start), start[:-1]
        at = [(k, np.flatnonzero(size == k)) for k in np.unique(size)]
        return Codes(len(size), [(w, flat[start[w][:, None] + np.arange(k)]) for k, w in at])


def unit(codes: Codes, day: str, run: int, salt: int, seed: int) -> np.ndarray:
    """``compare._unit`` of a run for the codes of a date."""
    out = np.empty(codes.n)
    for at, texts in codes.sized:
        out[at] = (md5_heads(f"{seed}|{salt}|{run}|{day}|".encode(), texts) >> np.uint64(12)).astype(float)
    return (out + 0.5) / float(1 << 52)


def drawn(name: str, codes: Codes, day: str, run: int, seed: int) -> np.ndarray:
    """Noise of a run for the codes of a date; of a shuffle, the numbers that order its values."""
    k = NOISE.index(name)
    if name == "random_normal":
        return np.sqrt(-2 * np.log(unit(codes, day, run, k, seed))) * np.cos(2 * np.pi * unit(codes, day, run, k + 100, seed))
    u = unit(codes, day, run, k, seed)
    return 2 * u - 1 if name == "random_uniform" else u


def mean_rank(x: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ranks of ``x``, which ``order`` sorts; ties share their mean rank."""
    s = x[order]
    new = np.append(True, s[1:] != s[:-1])
    start = np.flatnonzero(new)
    out = np.empty(len(x))
    out[order] = ((start + 1 + np.append(start[1:], len(x))) / 2)[np.cumsum(new) - 1]
    return out


def _correlation(a: np.ndarray, b: np.ndarray) -> float | None:
    a, b = a - a.mean(), b - b.mean()
    spread = a.std() * b.std()
    return float(np.mean(a * b) / spread) if spread else None


class _Usable:
    """The rows of a date that have a factor's value and a label, in order of code, with what all its signals share."""

    def __init__(self, f: np.ndarray, y: np.ndarray, q: int) -> None:
        self.at = np.flatnonzero(~np.isnan(f) & ~np.isnan(y))
        self.y = y[self.at]
        self.ranks = mean_rank(self.y, np.argsort(self.y, kind="stable"))
        n, place = len(self.at), np.arange(1, len(self.at) + 1)
        self.bucket = np.ones(n, np.uint8)  # by place, as functions.stats.bucket
        for p in np.linspace(0, 1, q + 1)[1:-1]:
            self.bucket += place > 1.0 + float(p * 100 / 100) * (n - 1)


def facts_of(table: pa.Table, signals: Sequence[Signal], label: str, least: int, q: int, seed: int) -> pa.Table:
    """``FACTS`` of one date."""
    order = pc.sort_indices(table, [("ts_code", "ascending")])
    day, names = table["day"][0].as_py(), table["ts_code"].take(order)
    number = lambda c: table[c].take(order).to_numpy().astype(float, copy=False)
    y, mv = number(label), number("total_mv")
    industry = pc.fill_null(table["sw_l1_name"].combine_chunks().dictionary_encode().indices.take(order), -1).to_numpy()

    def made(x: tuple[str, int]) -> tuple[np.ndarray, _Usable]:
        f = processed(number(x[0]), mv, industry, x[1])
        return f, _Usable(f, y, q)

    noisy = {x: made(x) for x in dict.fromkeys((s.column, s.sign) for s in signals if s.noise)}  # the others are made when they are looked at
    wanted = np.zeros(len(y), bool)
    for f, _ in noisy.values():
        wanted |= ~np.isnan(f)
    codes = Codes.of(names.filter(pa.array(wanted)))
    buckets = np.zeros((len(y), len(signals)), np.uint8)
    found, draws = [], (None, None)
    for k in sorted(range(len(signals)), key=lambda k: (signals[k].noise or "", signals[k].run)):
        s = signals[k]
        f, u = noisy[x] if (x := (s.column, s.sign)) in noisy else made(x)
        has = ~np.isnan(f)
        if s.noise:
            if draws[0] != (s.noise, s.run):
                noise = np.full(len(y), np.nan)
                noise[wanted] = drawn(s.noise, codes, str(day), s.run, seed)
                draws = ((s.noise, s.run), noise)
            if s.noise == "random_by_date_shuffle":
                f = f.copy()
                f[has] = f[has][np.argsort(draws[1][has], kind="stable")]
            else:
                f = np.where(has, draws[1], np.nan)
        n, own = np.count_nonzero(has), f[has]
        row = {"trade_date": day, "k": k, "n_rows": n if s.noise else len(y), "n_ok": len(u.at), "n_values": n, "low": own.min() if n else None, "high": own.max() if n else None}
        if len(u.at) >= max(least, q):
            v = f[u.at]
            by = np.argsort(v, kind="stable")  # rows lie by code
            b = np.empty(len(v), np.uint8)
            b[by] = u.bucket
            buckets[u.at, k] = b
            count = np.bincount(b, minlength=q + 1)[1:]
            row |= {"rank_ic": _correlation(mean_rank(v, by), u.ranks), "returns": (np.bincount(b, u.y, q + 1)[1:] / count).tolist(), "names": count.tolist()}
        found.append(row)
    facts = pa.Table.from_pylist(found, KINDS)
    held = np.flatnonzero(buckets.any(axis=1))
    flat = pa.Array.from_buffers(pa.binary(), len(held), [None, pa.py_buffer(np.arange(0, (len(held) + 1) * len(signals), len(signals), dtype=np.int32)), pa.py_buffer(buckets[held].tobytes())])
    rest = {"trade_date": pa.array([day] * len(held), pa.date32()), "ts_code": names.take(held), "buckets": flat}
    return pa.concat_tables([facts, pa.table([rest[f.name] if f.name in rest else pa.nulls(len(held), f.type) for f in KINDS], schema=KINDS)])


def date_facts(df: DataFrame, signals: Sequence[Signal], label: str, rows: int, least: int = 30, q: int = 5, seed: int = 20260607) -> DataFrame:
    """``FACTS`` of every date of ``df`` (day, ts_code, total_mv, sw_l1_name, label, columns of the signals), which has ``rows`` rows.  Write them once."""
    columns = list(dict.fromkeys(s.column for s in signals))
    work = lambda table: facts_of(table, signals, label, least, q, seed)
    return dealt(df.select("day", "ts_code", "total_mv", "sw_l1_name", label, *columns), ["day"], rows * len(columns)).groupBy("day").applyInArrow(work, FACTS)


# --- what dates have in common --------------------------------------------------------------------


def kept_of(rows: pa.Table, dates: np.ndarray, place: np.ndarray, q: int) -> pa.Table:
    """By signal, date and bucket: names that were in it on the signal's date before.

    ``rows``: all rows of some codes; ``dates``: all dates in order; ``place[k]``: the place of each date among those of k, or -1.
    """
    code = rows["ts_code"].combine_chunks().dictionary_encode().indices.to_numpy()
    at = np.searchsorted(dates, rows["trade_date"].to_numpy().astype("datetime64[D]"))
    by = np.argsort(code.astype(np.int64) * len(dates) + at, kind="stable")
    code, at = code[by], at[by]
    held = rows["buckets"].combine_chunks()
    wide = np.frombuffer(held.buffers()[2], np.uint8, count=len(held) * len(place), offset=held.offset * len(place)).reshape(len(held), -1)
    out = {"k": [], "at": [], "quantile": [], "kept": []}
    for k in range(len(place)):
        b = wide[:, k][by]
        on = np.flatnonzero(b)
        c, d, g, b = code[on], place[k][at[on]], at[on], b[on]
        stays = np.flatnonzero((c[1:] == c[:-1]) & (d[1:] == d[:-1] + 1) & (b[1:] == b[:-1])) + 1
        n = np.bincount(g[stays] * q + b[stays] - 1, minlength=1)
        cell = np.flatnonzero(n)
        for name, v in (("k", np.full(len(cell), k)), ("at", cell // q), ("quantile", cell % q + 1), ("kept", n[cell])):
            out[name].append(v)
    k, at, quantile, kept = (np.concatenate(out[c]) for c in out)
    return pa.table({"k": pa.array(k, pa.int32()), "trade_date": pa.array(dates[at], pa.date32()), "quantile": pa.array(quantile, pa.int32()), "kept": pa.array(kept, pa.int64())})


def kept_names(facts: DataFrame, signals: int, rows: int, q: int = 5) -> DataFrame:
    """k, trade_date, quantile, kept (where any are).  To the driver come the dates of each signal."""
    dated = facts.filter("returns is not null").select("k", "trade_date").collect()
    dates = np.array(sorted({r.trade_date for r in dated}), "datetime64[D]")
    place = np.full((signals, len(dates)), -1)
    for r in dated:
        place[r.k, np.searchsorted(dates, np.datetime64(r.trade_date))] = 0
    place = np.where(place < 0, -1, np.cumsum(place + 1, axis=1) - 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_rows = [b for b in batches if b.num_rows]
        if all_rows:
            yield from kept_of(pa.Table.from_batches(all_rows), dates, place, q).to_batches()

    held = facts.filter("ts_code is not null").select("trade_date", "ts_code", "buckets")
    found = dealt(held, ["ts_code"], rows).mapInArrow(work, "k int, trade_date date, quantile int, kept long")
    return found.groupBy("k", "trade_date", "quantile").agg(F.sum("kept").alias("kept"))


def coverage(facts: DataFrame) -> DataFrame:
    """coverage_pct, n_samples, all_null and constant of each signal that has rows."""
    g = facts.filter("n_rows > 0").groupBy("k").agg(F.sum("n_rows").alias("_n"), F.sum("n_ok").alias("n_samples"), F.sum("n_values").alias("_v"), F.min("low").alias("_low"), F.max("high").alias("_high"))
    return g.select("k", (F.col("n_samples") / F.col("_n")).alias("coverage_pct"), "n_samples", (F.col("_v") == 0).alias("all_null"), F.coalesce(F.col("_low") == F.col("_high"), F.lit(False)).alias("constant"))


def series(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rank ICs by date, mean label and number of names by date and bucket)."""
    on = facts.filter("returns is not null")
    each = on.select("k", "trade_date", F.posexplode(F.arrays_zip("returns", "names")).alias("_q", "_r"))
    return on.select("k", "trade_date", "rank_ic"), each.select("k", "trade_date", (F.col("_q") + 1).alias("quantile"), F.col("_r.returns").alias("avg_return"), F.col("_r.names").alias("n"))


def turnover(daily: DataFrame, kept: DataFrame) -> DataFrame:
    """By signal, date and bucket: 1 minus the share of its names that were in it on the signal's date before; the first date has none."""
    first = daily.groupBy("k").agg(F.min("trade_date").alias("_first"))
    d = daily.join(F.broadcast(first), "k").filter("trade_date > _first").join(kept, ["k", "trade_date", "quantile"], "left")
    return d.select("k", "trade_date", "quantile", (1 - F.coalesce("kept", F.lit(0)) / F.col("n")).alias("turnover"))


def frame_of(signals: Sequence[Mapping], df: DataFrame) -> DataFrame:
    """``df`` with the columns that name its signals, in place of k."""
    names = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in s.items()]) for s in signals])
    return df.withColumn("_of", names[F.col("k")]).select("_of.*", *[c for c in df.columns if c != "k"])

"""DuckDB SQL for batch evaluations: the gate's metrics by key, noise runs, comparison and gate, as common table expressions."""

from __future__ import annotations

from collections.abc import Sequence

from ..operators import compare
from . import oracle as O

_BY_CODE = "PARTITION BY ts_code ORDER BY trade_date"


def _rolled(x: str, n: int, f: str = "avg") -> str:
    w = f"({_BY_CODE} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) OVER {w} >= {n} THEN {f}({x}) OVER {w} END"


def _momentum(n: int) -> str:
    return f"adj_close / nullif(lag(adj_close, {n}) OVER ({_BY_CODE}), 0) - 1"


REGISTERED = {"momentum_20d_v1": (_momentum(20), 1), "reversal_5d_v1": (_momentum(5), -1), "volatility_20d_v1": (_rolled("ret_1", 20, "stddev_samp"), -1)}
TECHNICAL = {
    "reversal_1d": (_momentum(1), -1),
    "reversal_3d": (_momentum(3), -1),
    "reversal_5d": (_momentum(5), -1),
    "momentum_20d": (_momentum(20), 1),
    "momentum_60d": (_momentum(60), 1),
    "volatility_20d": (_rolled("ret_1", 20, "stddev_samp"), -1),
    "turnover_5d": (_rolled("turnover_rate", 5), -1),
    "turnover_20d": (_rolled("turnover_rate", 20), -1),
    "volume_ratio_5_20": (f"({_rolled('vol', 5)}) / nullif({_rolled('vol', 20)}, 0)", -1),
    "amount_ratio_5_20": (f"({_rolled('amount', 5)}) / nullif({_rolled('amount', 20)}, 0)", -1),
    "amplitude_20d": (_rolled("ampl", 20), -1),
    "illiquidity_20d": (_rolled("illiq", 20), 1),
}


def factors(groups: dict[str, dict[str, tuple[str, int]]]) -> str:
    """CTEs that end in ``long0``: the processed, signed values f of every factor of every group, with labels y."""
    sample = f"{O.PANEL},{O.FLAGS},{O.SAMPLE}"
    parts = [f"SELECT '{g}' AS grp, '{k}' AS factor_id, {sign} AS sign, trade_date, ts_code, day, total_mv, sw_l1_name, forward_5d, {x} AS factor_value FROM s1" for g, own in groups.items() for k, (x, sign) in own.items()]
    return (
        f"{sample},\ns0 AS (SELECT *, adj_close / nullif(lag(adj_close) OVER ({_BY_CODE}), 0) - 1 AS ret_1, (high - low) / nullif(pre_close, 0) AS ampl FROM sample),"
        f"\ns1 AS (SELECT *, abs(ret_1) / nullif(amount, 0) AS illiq FROM s0),\nlong AS ({' UNION ALL '.join(parts)}),"
        + O.chain("factor_value", "long", "grp, factor_id, day")
        + ",\nlong0 AS (SELECT grp, factor_id, day AS trade_date, ts_code, factor_raw, round(factor_processed * sign, 6) AS f, forward_5d AS y FROM processed)"
    )


def unit(salt: int, seed: int = 20260607) -> str:
    """The number in (0, 1) that a noise run has for a date and a code."""
    return f"(CAST('0x' || substr(md5(concat_ws('|', '{seed}', '{salt}', run_id, strftime(trade_date, '%Y-%m-%d'), ts_code)), 1, 13) AS BIGINT) + 0.5) / {1 << 52}.0"


def noise(source: str, repeats: int = 3, keys: Sequence[str] = ()) -> str:
    """CTEs that end in ``nn``: the rows of ``source`` that have f, once for each noise run, with the noise as f."""
    own, by = "".join(f"{k}, " for k in keys), ", ".join([*keys, "run_id", "trade_date"])
    same = " AND ".join(f"a.{k} = b.{k}" for k in [*keys, "run_id", "trade_date", "i"])
    return f"""
nf AS (SELECT {own}trade_date, ts_code, f, y, CAST(unnest(range({repeats})) AS INTEGER) AS run_id FROM {source} WHERE f IS NOT NULL),
na AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY ts_code) AS i FROM nf),
nb AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {unit(2)}, ts_code) AS i FROM nf),
nn AS (SELECT 'random_normal' AS baseline_name, run_id, {own}trade_date, ts_code, sqrt(-2 * ln({unit(0)})) * cos(2 * pi() * ({unit(100)})) AS f, y FROM nf
    UNION ALL SELECT 'random_uniform', run_id, {own}trade_date, ts_code, 2 * ({unit(1)}) - 1, y FROM nf
    UNION ALL SELECT 'random_by_date_shuffle', a.run_id, {"".join(f"a.{k}, " for k in keys)}a.trade_date, a.ts_code, b.f, a.y FROM na a JOIN nb b ON {same})"""


def batch(source: str, keys: Sequence[str]) -> str:
    """CTEs that end in ``metrics``: what a batch evaluation gives for each key of ``source`` (keys, trade_date, ts_code, f, y)."""
    k = ", ".join(keys)
    using = f"USING ({k})"
    place = f"row_number() OVER (PARTITION BY {k}, period, trade_date ORDER BY f, ts_code)"
    pivot = ", ".join(f"max(CASE WHEN quantile = {q} THEN avg_return END) AS q{q}" for q in range(1, 6))
    picked = ", ".join(f"max(CASE WHEN period = '{p}' THEN {c} END) AS {n}" for p, c, n in (("full", "ic", "rank_ic_mean"), ("full", "spread", "spread_mean"), ("in_sample", "ic", "is_rank_ic"), ("in_sample", "spread", "is_spread"), ("out_of_sample", "ic", "oos_rank_ic"), ("out_of_sample", "spread", "oos_spread")))
    return f"""
b0 AS (SELECT *, count(*) OVER (PARTITION BY {k}, trade_date) AS n_valid FROM {source} WHERE f IS NOT NULL AND y IS NOT NULL),
b1 AS (SELECT * FROM b0 WHERE n_valid >= 30),
bd AS (SELECT {k}, trade_date, row_number() OVER (PARTITION BY {k} ORDER BY trade_date) - 1 AS i, count(*) OVER (PARTITION BY {k}) AS n FROM (SELECT DISTINCT {k}, trade_date FROM b1)),
bp AS (SELECT {k}, trade_date, CASE WHEN n >= 2 AND i < greatest(1, least(n - 1, CAST(floor(n * 0.75) AS BIGINT))) THEN 'in_sample' ELSE 'out_of_sample' END AS own FROM bd),
b2 AS (SELECT b1.*, unnest(['full', own]) AS period FROM b1 JOIN bp USING ({k}, trade_date)),
bu AS (SELECT *, {O.bucket(place, f"count(f) OVER (PARTITION BY {k}, period, trade_date)", 5)} AS quantile FROM b2),
bi AS (SELECT {k}, period, trade_date, {O.corr("fr", "yr")} AS rank_ic FROM (SELECT *, {O.avg_rank("f", f"{k}, period, trade_date")} AS fr, {O.avg_rank("y", f"{k}, period, trade_date")} AS yr FROM b2) GROUP BY {k}, period, trade_date HAVING count(*) >= 10),
bq AS (SELECT {k}, period, trade_date, quantile, avg(y) AS avg_return FROM bu GROUP BY {k}, period, trade_date, quantile),
bw AS (SELECT {k}, period, trade_date, {pivot} FROM bq GROUP BY {k}, period, trade_date),
bm AS (SELECT {k}, period, ic, spread FROM (SELECT {k}, period, avg(rank_ic) AS ic FROM bi GROUP BY {k}, period) JOIN (SELECT {k}, period, avg(q5 - q1) AS spread FROM bw GROUP BY {k}, period) USING ({k}, period)),
bwide AS (SELECT {k}, {picked} FROM bm GROUP BY {k}),
bf AS (SELECT * FROM bu WHERE period = 'full'),
t0 AS (SELECT *, dense_rank() OVER (PARTITION BY {k} ORDER BY trade_date) - 1 AS d FROM bf WHERE quantile = 5),
t1 AS (SELECT *, d // 5 AS r FROM t0 WHERE d % 5 = 0),
t2 AS (SELECT *, CASE WHEN lag(r) OVER (PARTITION BY {k}, ts_code ORDER BY r) = r - 1 THEN 1 ELSE 0 END AS kept FROM t1),
t3 AS (SELECT {k}, trade_date, avg(y) AS net FROM t2 GROUP BY {k}, trade_date),
t4 AS (SELECT *, product(1 + net) OVER (PARTITION BY {k} ORDER BY trade_date ROWS UNBOUNDED PRECEDING) AS equity FROM t3),
t5 AS (SELECT *, equity / nullif(max(equity) OVER (PARTITION BY {k} ORDER BY trade_date ROWS UNBOUNDED PRECEDING), 0) - 1 AS drawdown FROM t4),
btop AS (SELECT {k}, avg(net) AS top_return, CASE WHEN stddev_pop(net) > 0 THEN avg(net) * 252 / (stddev_pop(net) * sqrt(252.0)) END AS sharpe, min(drawdown) AS max_drawdown FROM t5 GROUP BY {k}),
v0 AS (SELECT *, dense_rank() OVER (PARTITION BY {k} ORDER BY trade_date) - 1 AS d FROM bf WHERE quantile IS NOT NULL),
v1 AS (SELECT *, CASE WHEN lag(quantile) OVER c = quantile AND lag(d) OVER c = d - 1 THEN 1 ELSE 0 END AS kept FROM v0 WINDOW c AS (PARTITION BY {k}, ts_code ORDER BY d)),
bturn AS (SELECT {k}, avg(turnover) AS mean_turnover FROM (SELECT {k}, d, quantile, 1 - sum(kept) / CAST(count(*) AS DOUBLE) AS turnover FROM v1 GROUP BY {k}, d, quantile) WHERE d > 0 GROUP BY {k}),
m0 AS (SELECT {k}, quantile, avg(avg_return) AS m FROM bq WHERE period = 'full' AND quantile IS NOT NULL GROUP BY {k}, quantile),
m1 AS (SELECT {k}, m - lag(m) OVER (PARTITION BY {k} ORDER BY quantile) AS dm FROM m0),
bmono AS (SELECT {k}, CASE WHEN coalesce(min(dm), 0) >= 0 THEN 'increasing' WHEN coalesce(max(dm), 0) <= 0 THEN 'decreasing' ELSE 'mixed' END AS monotonicity FROM m1 GROUP BY {k}),
y0 AS (SELECT {k}, year(i.trade_date) AS year, avg(q5) AS top FROM bi i LEFT JOIN bw USING ({k}, period, trade_date) WHERE period = 'full' GROUP BY {k}, year(i.trade_date)),
byear AS (SELECT {k}, count(*) FILTER (top > 0) <= 1 AND count(*) > 1 AS single_year FROM y0 GROUP BY {k}),
bdates AS (SELECT {k}, count(DISTINCT trade_date) AS n_valid_dates FROM bf GROUP BY {k}),
bcov AS (SELECT {k}, avg(CASE WHEN f IS NOT NULL AND y IS NOT NULL THEN 1.0 ELSE 0.0 END) AS coverage_pct, count(*) FILTER (f IS NOT NULL AND y IS NOT NULL) AS n_samples, count(f) = 0 AS all_null, count(DISTINCT f) = 1 AS "constant" FROM {source} GROUP BY {k}),
metrics AS (SELECT * FROM bcov LEFT JOIN bdates {using} LEFT JOIN bwide {using} LEFT JOIN btop {using} LEFT JOIN bturn {using} LEFT JOIN bmono {using} LEFT JOIN byear {using})"""


METRIC_DOUBLES = "coverage_pct rank_ic_mean spread_mean is_rank_ic is_spread oos_rank_ic oos_spread top_return sharpe max_drawdown mean_turnover"
_NAMED = {"rank_ic_mean": "rank_ic_mean", "top_quantile_return": "top_return", "top_quantile_sharpe": "sharpe", "oos_rank_ic_mean": "oos_rank_ic", "max_drawdown": "max_drawdown", "mean_turnover": "mean_turnover"}


def compared(repeats: int = 3) -> str:
    """CTEs that end in ``compared`` and ``flagsc``: each registered factor against noise runs of its own and the technical baselines."""
    runs = ", ".join(f"('{n}', {100 * i})" for i, n in enumerate(compare.NOISE))
    values = " UNION ALL ".join(f"SELECT grp, factor_id, '{m}' AS metric, CAST({c} AS DOUBLE) AS v FROM metrics" for m, c in _NAMED.items())
    ids = ", ".join(f"'{x}'" for x in REGISTERED)
    return (
        factors({"candidate": REGISTERED, "simple_technical": TECHNICAL})
        + ",\nown AS (SELECT * FROM long0 WHERE grp = 'candidate'),"
        + noise("own", repeats, ["factor_id"])
        + f""",
every AS (SELECT grp, factor_id, 0 AS run_id, trade_date, ts_code, f, y FROM long0
    UNION ALL SELECT 'noise', factor_id, run_id + o.n, trade_date, ts_code, f, y FROM nn JOIN (VALUES {runs}) o(b, n) ON baseline_name = o.b),"""
        + batch("every", ["grp", "factor_id", "run_id"])
        + f""",
vals AS (SELECT * FROM ({values}) WHERE v IS NOT NULL),
bases AS (SELECT grp, factor_id, metric, v FROM vals WHERE grp = 'noise' UNION ALL SELECT grp, unnest([{ids}]), metric, v FROM vals WHERE grp = 'simple_technical'),
compared AS (SELECT b.factor_id, b.grp AS "group", metric, max(c.v) AS candidate, median(b.v) AS baseline_median, avg(CASE WHEN b.v * s <= c.v * s + {compare.SAME} * abs(c.v) THEN 1.0 ELSE 0.0 END) AS percentile
    FROM (SELECT *, CASE WHEN metric = 'mean_turnover' THEN -1.0 ELSE 1.0 END AS s FROM bases) b JOIN (SELECT * FROM vals WHERE grp = 'candidate') c USING (factor_id, metric) GROUP BY b.factor_id, b.grp, metric),
flagsc AS (SELECT factor_id, coalesce(max(CASE WHEN "group" = 'noise' THEN percentile END) >= {compare.STRONGER}, false) AS stronger_than_noise, coalesce(max(CASE WHEN "group" = 'simple_technical' THEN percentile END) >= {compare.NOT_WORSE}, false) AS not_worse_than_simple
    FROM compared WHERE metric = 'rank_ic_mean' GROUP BY factor_id)"""
    )


def gate() -> str:
    """CTEs that end in ``gated``: status and reasons of each registered factor."""
    why = lambda *pairs: "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{t}' END" for c, t in pairs) + "], lambda x: x IS NOT NULL)"
    z = lambda c: f"coalesce({c}, 0)"
    fast, deep = f"coalesce(mean_turnover > {compare.MAX_TURNOVER}, false)", f"coalesce(max_drawdown < {compare.MAX_DRAWDOWN}, false)"
    invalid = why(
        ("all_null", "all values are missing"),
        ('"constant"', "factor is constant"),
        (f"{z('coverage_pct')} < {compare.MIN_COVERAGE}", "coverage too low"),
        (f"{z('n_valid_dates')} < {compare.MIN_DATES}", "too few valid dates"),
        (f"{z('n_samples')} < {compare.MIN_SAMPLES}", "too few labels"),
    )
    rejected = why(
        (f"NOT ({z('rank_ic_mean')} > 0 AND {z('spread_mean')} > 0)", "rank IC or spread not positive"),
        ("coalesce(monotonicity = 'decreasing', false)", "buckets run the wrong way"),
        ("coalesce(top_return < 0, false)", "top bucket loses"),
        (fast, "turnover out of bounds"),
        (deep, "drawdown out of bounds"),
    )
    in_ok, out_ok, out_spread = f"{z('is_rank_ic')} > 0", f"{z('oos_rank_ic')} >= 0", f"{z('oos_spread')} >= 0"
    active = f"{in_ok} AND {out_ok} AND {z('is_spread')} > 0 AND {out_spread} AND {z('top_return')} > 0 AND stronger_than_noise AND not_worse_than_simple AND NOT coalesce(single_year, false) AND NOT {fast} AND NOT {deep}"
    library = why((f"NOT ({out_ok})", "rank IC reversed out of sample"), (f"NOT ({out_spread})", "spread reversed out of sample"), ("NOT stronger_than_noise", "does not beat most noise"), (f"{fast} OR {deep}", "turnover or drawdown out of bounds"))
    return f"""{compared()},
g0 AS (SELECT m.*, stronger_than_noise, not_worse_than_simple FROM metrics m LEFT JOIN flagsc USING (factor_id) WHERE m.grp = 'candidate'),
g1 AS (SELECT *, {invalid} AS wi, {rejected} AS wr, {library} AS wl FROM g0),
gated AS (SELECT factor_id, CASE WHEN len(wi) > 0 THEN 'invalid' WHEN len(wr) > 0 THEN 'rejected' WHEN {active} THEN 'active' WHEN NOT ({in_ok}) AND NOT ({out_ok}) THEN 'rejected' WHEN NOT stronger_than_noise AND NOT ({out_ok}) THEN 'rejected' ELSE 'watch' END AS status,
    array_to_string(CASE WHEN len(wi) > 0 THEN wi WHEN len(wr) > 0 THEN wr ELSE wl END, '; ') AS reasons, stronger_than_noise, not_worse_than_simple FROM g1)"""

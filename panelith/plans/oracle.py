"""DuckDB SQL for the derived panels and the research sample, as common table expressions that oracles build on."""

from __future__ import annotations


def r4(x: str) -> str:
    return f"(floor(({x}) * 10000.0 + 0.5) / 10000.0)"


def r6(x: str) -> str:
    """What the queries' final rounding does."""
    return f"round({x}, 6)"


PANEL = f"""
li AS (SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS day, l_extendedprice / l_quantity AS unit, *  EXCLUDE (l_suppkey) FROM lineitem),
pa AS (SELECT l_suppkey, day,
    {r4("first(unit ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity)")} AS open,
    {r4("max(unit)")} AS high, {r4("min(unit)")} AS low,
    {r4("CAST(sum(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100.0 / CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE)")} AS close,
    CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS vol,
    CAST(sum(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) * (100 - CAST(floor(l_discount * 100 + 0.5) AS BIGINT))) AS DOUBLE) / 10000.0 AS amount,
    {r4("1 + CAST(sum(CAST(floor(l_tax * 100 + 0.5) AS BIGINT)) AS DOUBLE) / CAST(count(*) AS DOUBLE)")} AS pb,
    {r4("CAST(sum(CAST(floor(l_discount * 100 + 0.5) AS BIGINT)) AS DOUBLE) / CAST(count(*) AS DOUBLE)")} AS dv_ratio,
    count(*) AS n_rows FROM li GROUP BY l_suppkey, day),
pb AS (SELECT pa.*, s_name, s_acctbal, n_name, r_name, r_regionkey, lag(close) OVER (PARTITION BY l_suppkey ORDER BY day) AS pre_close,
    min(day) OVER (PARTITION BY l_suppkey) AS first_day
    FROM pa JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
panel AS (SELECT '3' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS ts_code, strftime(day, '%Y%m%d') AS trade_date, day, open, high, low, close, pre_close,
    {r4("100 * (close / pre_close - 1)")} AS pct_chg, vol, amount, 1 + ((year(day) - 1995) * 12 + month(day) - 1) / 100.0 AS adj_factor,
    {r4("s_acctbal * close")} AS total_mv, {r4("pre_close * 4")} AS up_limit, {r4("pre_close * 0.1")} AS down_limit, n_rows < 2 AS is_suspended,
    CASE WHEN l_suppkey % 17 = 0 THEN 'ST' ELSE '' END || s_name AS name, CASE WHEN l_suppkey % 4 <> 0 THEN '主板' ELSE '其他' END AS market,
    strftime(first_day, '%Y%m%d') AS list_date, r_name AS sw_l1_name, n_name AS sw_l2_name,
    {r4("vol / sum(vol) OVER (PARTITION BY day) * 100")} AS turnover_rate, pb, dv_ratio, l_suppkey AS key, r_regionkey, (year(day) - 1995) * 12 + month(day) - 1 AS month_no
    FROM pb)"""

CALENDAR = """
cal AS (SELECT strftime(day, '%Y%m%d') AS cal_date, CASE WHEN month_no % 29 = 0 THEN '0' ELSE '1' END AS is_open, month_no, day, row_count
    FROM (SELECT day, (year(day) - 1995) * 12 + month(day) - 1 AS month_no, row_count FROM (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS day, count(*) AS row_count FROM lineitem GROUP BY 1)))"""

DAILY = """
daily AS (SELECT ts_code, trade_date, open, CASE WHEN key * month_no % 101 = 1 THEN low ELSE high END AS high, CASE WHEN key * month_no % 101 = 1 THEN high ELSE low END AS low, close, pre_close, pct_chg, vol, amount FROM panel)"""

BASIC = """
basic AS (SELECT ts_code, trade_date, CASE WHEN (key + month_no) % 11 <> 0 THEN turnover_rate END AS turnover_rate, pb, dv_ratio, total_mv FROM panel WHERE (key + month_no) % 13 <> 0)"""

MEMBERS = """
who AS (SELECT DISTINCT ts_code, key, sw_l1_name, r_regionkey FROM panel),
members AS (SELECT ts_code, sw_l1_name AS l1_name, '19950101' AS in_date, '19980101' AS out_date, 'N' AS is_new FROM who WHERE key % 5 <> 0
    UNION ALL SELECT w.ts_code, n.sw_l1_name, CASE WHEN w.key % 7 = 0 THEN '19970601' ELSE '19980101' END, '', 'Y' FROM who w LEFT JOIN (SELECT DISTINCT r_regionkey, sw_l1_name FROM panel) n ON n.r_regionkey = (w.r_regionkey + 1) % 5)"""

WEIGHTS = """
weights AS (SELECT 'TOP' AS index_code, ts_code, ts_code AS con_code, trade_date, day, amount AS weight FROM
    (SELECT *, row_number() OVER (PARTITION BY day ORDER BY amount DESC, ts_code) AS r, count(*) OVER (PARTITION BY day) AS n FROM panel WHERE month_no % 3 = 0) WHERE r <= 0.3 * n)"""

LOG = """
log AS (SELECT endpoint, cal_date AS trade_date, CASE WHEN month_no % 17 = 0 THEN 'failed' ELSE 'success' END AS status, row_count
    FROM cal, (SELECT unnest(['daily', 'adj_factor', 'daily_basic', 'suspend_d', 'stk_limit']) AS endpoint))"""

_OK = "(NOT is_suspended AND total_mv > 0 AND amount >= 1000.0 AND listed_trade_days >= 84 AND listed_trade_days > 28 AND is_main_board AND NOT is_st)"
FLAGS = f"""
flagged0 AS (SELECT *, close * adj_factor AS adj_close, date_diff('day', strptime(list_date, '%Y%m%d')::DATE, strptime(trade_date, '%Y%m%d')::DATE) AS listed_trade_days,
    market = '主板' OR substr(ts_code, 1, 3) IN ('600', '601', '603', '605', '000', '001') AS is_main_board, starts_with(name, 'ST') OR starts_with(name, '*ST') OR starts_with(name, 'S*ST') AS is_st,
    coalesce(open >= up_limit, false) AS is_limit_up_at_open, coalesce(open <= down_limit, false) AS is_limit_down_at_open FROM panel),
flagged AS (SELECT *, {_OK} AS passes_base_filters, {_OK} AND NOT is_limit_up_at_open AS can_buy, {_OK} AND NOT is_limit_down_at_open AS can_sell,
    {_OK} AND NOT is_limit_up_at_open AND NOT is_limit_down_at_open AS is_tradable FROM flagged0)"""


def forward(h: int, tradable: bool = True, price: str = "adj_close") -> str:
    value = f"lead({price}, {h + 1}) OVER w / lead({price}, 1) OVER w - 1"
    return f"CASE WHEN lead(is_tradable, 1) OVER w AND lead(is_tradable, {h + 1}) OVER w THEN {value} END" if tradable else value


SAMPLE = f"""
labelled AS (SELECT *, {", ".join(f"{forward(h)} AS forward_{h}d" for h in (1, 3, 5))} FROM flagged WINDOW w AS (PARTITION BY ts_code ORDER BY trade_date)),
counted AS (SELECT *, CAST(sum(CASE WHEN is_tradable THEN 1 ELSE 0 END) OVER (PARTITION BY trade_date) AS BIGINT) AS tradable_count FROM labelled),
sample AS (SELECT * FROM counted WHERE tradable_count >= 30)"""


def chain(x: str, source: str, by: str = "day", neutral: str = "industry_size") -> str:
    """The preprocessing chain over ``source`` (columns day, ts_code, total_mv, sw_l1_name, x) as CTEs; ends in ``processed``."""
    ok = "factor_zscore IS NOT NULL AND total_mv > 0" + (" AND sw_l1_name IS NOT NULL" if neutral == "industry_size" else "")
    z = lambda c: f"CASE WHEN count({c}) OVER w > 0 THEN CASE WHEN coalesce(stddev_pop({c}) OVER w, 0) <= 1e-12 THEN 0.0 ELSE ({c} - avg({c}) OVER w) / stddev_pop({c}) OVER w END END"
    w = f"WINDOW w AS (PARTITION BY {by})"
    own = f"WINDOW w AS (PARTITION BY {by}), o AS (PARTITION BY {by}, sw_l1_name)"
    fw = f"""
f5 AS (SELECT *, CASE WHEN {ok} THEN factor_zscore END AS y, CASE WHEN {ok} THEN ln(total_mv) END AS x FROM f4),
f6 AS (SELECT *, y - avg(y) OVER o AS dy, x - avg(x) OVER o AS dx FROM f5 {own}),
f7 AS (SELECT *, CASE WHEN count(y) OVER w >= 10 THEN dy - coalesce(sum(dx * dy) OVER w / nullif(sum(dx * dx) OVER w, 0), 0) * dx END AS factor_neutral FROM f6 {w}),"""
    size = f"""
f5 AS (SELECT *, CASE WHEN {ok} THEN factor_zscore END AS y, CASE WHEN {ok} THEN ln(total_mv) END AS x FROM f4),
f7 AS (SELECT *, CASE WHEN count(y) OVER w >= 5 THEN y - (avg(y) OVER w + coalesce(covar_pop(y, x) OVER w / nullif(var_pop(x) OVER w, 0), 0) * (x - avg(x) OVER w)) END AS factor_neutral FROM f5 {w}),"""
    return f"""
f1 AS (SELECT *, {x} AS factor_raw FROM {source}),
f2 AS (SELECT *, median(factor_raw) OVER w AS med FROM f1 {w}),
f3 AS (SELECT *, median(abs(factor_raw - med)) OVER w * 1.4826 AS mad FROM f2 {w}),
f3b AS (SELECT *, CASE WHEN factor_raw IS NULL OR coalesce(mad = 0, true) THEN factor_raw ELSE least(greatest(factor_raw, med - 3.0 * mad), med + 3.0 * mad) END AS factor_winsorized FROM f3),
f4 AS (SELECT *, {z("factor_winsorized")} AS factor_zscore FROM f3b {w}),{fw if neutral == "industry_size" else size}
processed AS (SELECT *, {z("factor_neutral")} AS factor_processed FROM f7 {w})"""


def bucket(place: str, n: str, q: int) -> str:
    from numpy import linspace

    parts = " + ".join(f"CASE WHEN {place} > 1.0 + CAST({float(p * 100 / 100)!r} AS DOUBLE) * ({n} - 1) THEN 1 ELSE 0 END" for p in linspace(0, 1, q + 1)[1:-1])
    return f"CASE WHEN {n} >= {q} THEN 1 + {parts} END"


def corr(x: str, y: str) -> str:
    return f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"


def avg_rank(x: str, by: str) -> str:
    return f"rank() OVER (PARTITION BY {by} ORDER BY {x}) + (count(*) OVER (PARTITION BY {by}, {x}) - 1) / 2.0"


def t_stat(x: str) -> str:
    return f"CASE WHEN stddev_pop({x}) > 0 THEN avg({x}) / (stddev_pop({x}) / sqrt(CAST(count({x}) AS DOUBLE))) END"


#: The evaluated factor: five-period momentum through the whole chain, rounded so that ranks agree, and a label.
MOMENTUM = "adj_close / lag(adj_close, 5) OVER (PARTITION BY ts_code ORDER BY trade_date) - 1"
FACTOR = (
    f"mom AS (SELECT *, {MOMENTUM} AS m5 FROM sample),"
    + chain("m5", "mom")
    + ",\nrows0 AS (SELECT day AS trade_date, ts_code, total_mv, sw_l1_name, factor_raw, round(factor_processed, 6) AS f, forward_1d, forward_3d, forward_5d AS y FROM processed)"
)
USABLE = """
valid AS (SELECT *, count(*) OVER (PARTITION BY trade_date) AS n_valid FROM rows0 WHERE f IS NOT NULL AND y IS NOT NULL),
u0 AS (SELECT * FROM valid WHERE n_valid >= 30),
u AS (SELECT *, """ + bucket("row_number() OVER (PARTITION BY trade_date ORDER BY f, ts_code)", "n_valid", 5) + """ AS quantile FROM u0)"""
IC = f"""
ric AS (SELECT trade_date, {corr("fr", "yr")} AS rank_ic, count(*) AS n_stocks FROM (SELECT trade_date, {avg_rank("f", "trade_date")} AS fr, {avg_rank("y", "trade_date")} AS yr FROM u) GROUP BY trade_date HAVING count(*) >= 10)"""
DAILY_Q = """
qd AS (SELECT trade_date, quantile, avg(y) AS avg_return FROM u GROUP BY trade_date, quantile),
qw AS (SELECT trade_date, """ + ", ".join(f"max(CASE WHEN quantile = {k} THEN avg_return END) AS q{k}" for k in range(1, 6)) + """ FROM qd GROUP BY trade_date)"""
BASE = ",".join([PANEL, FLAGS, SAMPLE, FACTOR])
EVAL = ",".join([BASE, USABLE])


def sql(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"

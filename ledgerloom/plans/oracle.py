"""DuckDB SQL for each registered query, written apart from the plans."""

from __future__ import annotations

_P = ("open", "high", "low", "close")

BARS = """bars AS (
  SELECT user_id AS code, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date, CAST(strftime(ts, '%H%M') AS INTEGER) AS time,
    CASE WHEN event_id % 13 <> 0 THEN value END AS open, CASE WHEN event_id % 29 <> 0 THEN value + (event_id % 3) * 0.5::DOUBLE END AS high,
    value - (event_id % 4) * 0.25::DOUBLE AS low, value + (event_id % 5 - 2) * 0.125::DOUBLE AS close,
    CAST(event_id % 1000 AS DOUBLE) AS volume, CAST(floor(value) * (event_id % 1000) AS DOUBLE) AS amount, event_id AS row_id
  FROM events)"""

ONE_A_KEY = BARS + f""", base AS (
  SELECT date, code, time, {", ".join(f"max({c}) AS {c}" for c in (*_P, "volume", "amount"))}, min(row_id) AS row_id FROM bars GROUP BY date, code, time)"""

ROLLED = BARS + """, rolled AS (
  SELECT code, date,
    first(open ORDER BY time, row_id) FILTER (open IS NOT NULL) AS open, max(high) AS high, min(low) AS low,
    last(close ORDER BY time, row_id) FILTER (close IS NOT NULL) AS close, coalesce(sum(volume), 0) AS volume, coalesce(sum(amount), 0) AS amount,
    min(time) AS open_time, max(time) AS close_time,
    first(time ORDER BY high DESC, time, row_id) FILTER (high IS NOT NULL) AS high_time,
    first(time ORDER BY low, time, row_id) FILTER (low IS NOT NULL) AS low_time, count(*) AS minute_rows
  FROM bars WHERE code IS NOT NULL GROUP BY code, date)"""

_FACTOR = "CASE WHEN code % 17 <> 0 THEN 1 + (code % 8) / 8.0::DOUBLE END"

DAILY = ROLLED + f""", daily AS (
  SELECT code, date, lpad(CAST(code AS VARCHAR), 6, '0') || CASE WHEN code % 2 = 0 THEN '.SZ' ELSE '.SH' END AS symbol, {_FACTOR} AS adjfactor,
    {", ".join(f"({p} + {'CASE WHEN (code + date) % 11 = 0 THEN 0.5::DOUBLE ELSE 0 END' if p == 'close' else '0'}) * ({_FACTOR}) AS daily_adj_{p}" for p in _P)},
    volume / 10000.0::DOUBLE AS daily_volume, amount / 1000000.0::DOUBLE AS daily_amount,
    CASE WHEN volume = 0 THEN CASE WHEN amount > 0 THEN 'inf'::DOUBLE WHEN amount < 0 THEN '-inf'::DOUBLE END ELSE amount / volume END * ({_FACTOR}) AS daily_adj_vwap
  FROM rolled WHERE code % 7 <> 3)"""

COMPARED = DAILY + f""", compared AS (
  SELECT r.*, d.* EXCLUDE (code, date),
    {", ".join(f"r.{p} * adjfactor AS minute_adj_{p}, daily_adj_{p} / adjfactor AS daily_raw_{p}, r.{p} - daily_adj_{p} / adjfactor AS raw_diff_{p}" for p in _P)},
    volume / 10000.0::DOUBLE AS unit_volume, amount / 1000000.0::DOUBLE AS unit_amount,
    CASE WHEN volume = 0 THEN CASE WHEN amount > 0 THEN 'inf'::DOUBLE WHEN amount < 0 THEN '-inf'::DOUBLE END ELSE amount / volume END AS minute_vwap,
    minute_vwap * adjfactor AS minute_adj_vwap, daily_adj_vwap / adjfactor AS daily_raw_vwap
  FROM rolled r LEFT JOIN daily d USING (code, date))"""

_DONE = " AND ".join(f"{c} IS NOT NULL" for c in ("adjfactor", "daily_volume", "daily_amount", "daily_adj_vwap", *(f"daily_adj_{p}" for p in _P)))

MISMATCHES = COMPARED + ", mismatches AS (" + " UNION ALL ".join(
    f"SELECT code, date, '{p}' AS field, CASE WHEN length(CAST({p}_time AS VARCHAR)) < 4 THEN lpad(CAST({p}_time AS VARCHAR), 4, '0') ELSE CAST({p}_time AS VARCHAR) END AS t, "
    f"{p} AS minute_raw, daily_raw_{p} AS daily_raw, raw_diff_{p} AS raw_diff, abs(raw_diff_{p} * adjfactor) AS adjusted_abs_error FROM compared WHERE {_DONE} AND abs(raw_diff_{p}) > 1e-8"
    for p in _P
) + ")"

_MISMATCH_COLUMNS = "code, date, field, t[1:2] || ':' || t[3:4] AS minute_time, round(minute_raw, 6) AS minute_raw, round(daily_raw, 6) AS daily_raw, round(raw_diff, 6) AS raw_diff, round(adjusted_abs_error, 6) AS adjusted_abs_error"

MATRIX = """matrix AS (SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS stock, max(l_extendedprice) AS value FROM lineitem GROUP BY 1, 2),
local AS (SELECT * FROM matrix WHERE date < DATE '2000-01-01'),
incoming AS (SELECT date, stock, CASE WHEN stock % 19 = 0 THEN NULL WHEN stock % 17 = 0 THEN value * 1.001::DOUBLE ELSE value END AS value
             FROM matrix WHERE date >= DATE '1999-06-01' AND stock % 10 <> 3),
cd AS (SELECT DISTINCT date FROM local INTERSECT SELECT DISTINCT date FROM incoming), cs AS (SELECT DISTINCT stock FROM local INTERSECT SELECT DISTINCT stock FROM incoming)"""

CELLS = MATRIX + """, cells AS (
  SELECT g.date, g.stock, l.value AS lv, i.value AS iv FROM (SELECT * FROM cd, cs) g
  LEFT JOIN local l USING (date, stock) LEFT JOIN incoming i USING (date, stock)),
marked AS (SELECT *, NOT ((lv IS NULL AND iv IS NULL) OR coalesce(abs(lv - iv) <= 1e-7::DOUBLE + 1e-7::DOUBLE * abs(iv), false)) AS unequal FROM cells)"""

SNAPSHOTS = """old AS (SELECT c_custkey AS stkcode, CASE WHEN c_custkey % 40 <> 0 THEN c_name END AS compcode FROM customer WHERE c_custkey % 10 <> 7),
new AS (SELECT CASE WHEN c_custkey % 50 = 0 THEN c_custkey + 1000000 ELSE c_custkey END AS stkcode, CASE WHEN c_custkey % 40 <> 0 THEN c_name END AS compcode FROM customer WHERE c_custkey % 25 <> 3),
lost AS (SELECT compcode, min(stkcode) AS old_key FROM old WHERE compcode IS NOT NULL AND stkcode NOT IN (SELECT stkcode FROM new) GROUP BY 1 HAVING count(*) = 1),
added AS (SELECT compcode, min(stkcode) AS new_key FROM new WHERE compcode IS NOT NULL AND stkcode NOT IN (SELECT stkcode FROM old) GROUP BY 1 HAVING count(*) = 1),
changes AS (SELECT compcode, old_key, new_key FROM lost JOIN added USING (compcode))"""

AXES = """cal AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders), win AS (SELECT day FROM cal ORDER BY day DESC LIMIT 1000),
base AS (SELECT c_nationkey AS axis, CAST(o_orderdate AS DATE) AS day, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey),
axes AS (SELECT axis, day FROM base WHERE axis % 3 <> 0 OR day < DATE '2001-07-27' UNION SELECT axis, CAST(day + INTERVAL 3 DAY AS DATE) FROM base WHERE axis % 5 = 0 AND o_orderkey % 97 = 0),
ends AS (SELECT min(day) AS w0, max(day) AS wn FROM win),
spans AS (SELECT axis, max(day) AS last, coalesce(min(day) FILTER (day BETWEEN w0 AND wn), max(day)) AS start,
    count(*) FILTER (day BETWEEN w0 AND wn AND day NOT IN (SELECT day FROM win)) AS extra, count(*) FILTER (day IN (SELECT day FROM win)) AS present FROM axes, ends GROUP BY axis),
judged AS (SELECT axis, start, last, (SELECT count(*) FROM win WHERE win.day BETWEEN start AND last) - present AS missing, extra, (SELECT count(*) FROM win WHERE win.day > last) AS lag FROM spans)"""

_DOC = "sha256(coalesce(text, ''))"

SQL: dict[str, str] = {
    "ohlcv_rollup": f"WITH {ROLLED} SELECT * FROM rolled",
    "extreme_times": f"WITH {ROLLED} SELECT code, date, high, high_time, low, low_time FROM rolled",
    "unmatched_codes": f"WITH {DAILY} SELECT DISTINCT code FROM rolled WHERE code NOT IN (SELECT code FROM daily)",
    "price_comparison": f"WITH {COMPARED} SELECT code, date, symbol, "
    + ", ".join(f"round({x}_{p}, 6) AS {x}_{p}" for x in ("minute_adj", "daily_raw", "raw_diff") for p in _P)
    + ", " + ", ".join(f"round({c}, 6) AS {c}" for c in ("unit_volume", "unit_amount", "minute_vwap", "minute_adj_vwap", "daily_raw_vwap")) + " FROM compared",
    "complete_rows": f"WITH {COMPARED} SELECT code, date, symbol FROM compared WHERE {_DONE}",
    "price_stats": f"""WITH {COMPARED}, done AS (SELECT *, ({_DONE}) AS done, abs(minute_vwap - daily_raw_vwap) AS ve, abs(unit_volume - daily_volume) AS qe, abs(unit_amount - daily_amount) AS ae FROM compared),
whole AS (SELECT date, CAST(sum(minute_rows) AS BIGINT) AS minute_rows, count(*) AS minute_codes, count(symbol) AS matched_codes, count(*) FILTER (symbol IS NULL) AS unmatched_codes, count(*) FILTER (done) AS complete_codes,
  count(*) FILTER (done AND qe <= 1e-8) AS volume_matches, round(max(qe) FILTER (done), 6) AS volume_max_error, count(*) FILTER (done AND ae <= 5.1e-7) AS amount_matches, round(max(ae) FILTER (done), 6) AS amount_max_error,
  count(*) FILTER (done AND ve <= 5.1e-5) AS vwap_matches, round(quantile_cont(ve, 0.5) FILTER (done), 6) AS vwap_median_error, round(max(ve) FILTER (done), 6) AS vwap_max_error FROM done GROUP BY date),
long AS ({" UNION ALL ".join(f"SELECT date, abs({p} * adjfactor - daily_adj_{p}) AS times, abs({p} / adjfactor - daily_adj_{p}) AS over_, raw_diff_{p} AS raw FROM done WHERE done" for p in _P)}),
points AS (SELECT date, count(*) AS price_points, count(*) FILTER (abs(raw) <= 1e-10) AS exact_points, round(quantile_cont(times, 0.5), 6) AS multiply_median, round(quantile_cont(times, 0.99), 6) AS multiply_p99,
  round(quantile_cont(over_, 0.5), 6) AS divide_median, round(quantile_cont(over_, 0.99), 6) AS divide_p99 FROM long GROUP BY date)
SELECT whole.*, coalesce(price_points, 0) AS price_points, coalesce(exact_points, 0) AS exact_points, multiply_median, multiply_p99, divide_median, divide_p99 FROM whole LEFT JOIN points USING (date)""",
    "mismatch_table": f"WITH {MISMATCHES} SELECT {_MISMATCH_COLUMNS} FROM mismatches",
    "mismatch_topk": f"WITH {MISMATCHES}, top AS (SELECT * FROM mismatches m ORDER BY m.adjusted_abs_error DESC, code, date, field LIMIT 20) SELECT {_MISMATCH_COLUMNS} FROM top",
    "symbol_parse": """WITH s AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN c_name WHEN c_custkey % 5 = 1 THEN lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '.S1' ELSE lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '.SZ' END AS symbol FROM customer)
SELECT *, CASE WHEN regexp_full_match(symbol, '[0-9]{6}\\.[A-Za-z]{2}') THEN CAST(symbol[1:6] AS BIGINT) END AS code FROM s""",
    "valid_codes": """WITH t AS (SELECT p_partkey, TRY_CAST(CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey * 1000 AS VARCHAR) WHEN p_partkey % 4 = 1 THEN CAST(p_retailprice AS VARCHAR) WHEN p_partkey % 4 = 2 THEN p_name ELSE CAST(p_partkey AS VARCHAR) END AS DOUBLE) AS x FROM part)
SELECT p_partkey, coalesce(x BETWEEN 0 AND 999999 AND x = round(x), false) AS valid FROM t""",
    "symbol_conflicts": """SELECT CAST(code AS BIGINT) AS code, count(*) AS symbols FROM (SELECT DISTINCT c_custkey % 700 AS code, c_nationkey % 9 = 0 AS sh FROM customer) GROUP BY code HAVING count(*) > 1""",
    "duplicate_minutes": f"WITH {BARS} SELECT date, code, time, count(*) AS rows FROM bars GROUP BY ALL HAVING count(*) > 1",
    "day_validation": f"""WITH {BARS}, f AS (SELECT *, CASE WHEN row_id % 2000 = 0 THEN date - date % 100 + 1 ELSE date END AS file_date FROM bars)
SELECT file_date, count(*) AS rows, count(DISTINCT date) AS days, count(*) - count(DISTINCT (date, code, time)) AS repeats, CAST(max(CASE WHEN date <> file_date THEN 1 ELSE 0 END) AS INTEGER) AS strange FROM f GROUP BY file_date""",
    "bar_end_timestamps": "SELECT event_id AS row_id, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS datetime FROM events",
    "adjusted_prices": f"WITH {BARS} SELECT strptime(CAST(date AS VARCHAR) || lpad(CAST(time AS VARCHAR), 4, '0'), '%Y%m%d%H%M') + INTERVAL 1 MINUTE AS datetime, code, {', '.join(f'{p} * ({_FACTOR}) AS {p}' for p in _P)}, volume, amount, row_id FROM bars WHERE code BETWEEN 0 AND 999999",
    "minute_pivot": f"""WITH {BARS}, a AS (SELECT strptime(CAST(date AS VARCHAR) || lpad(CAST(time AS VARCHAR), 4, '0'), '%Y%m%d%H%M') + INTERVAL 1 MINUTE AS datetime, code, {', '.join(f'{p} * ({_FACTOR}) AS {p}' for p in _P)}, volume, amount FROM bars WHERE code BETWEEN 0 AND 999999)
SELECT datetime, code, {', '.join(f'max({c}) AS {c}' for c in (*_P, 'volume', 'amount'))} FROM a GROUP BY datetime, code""",
    "overlap_report": f"""WITH {CELLS}, r AS (SELECT count(*) FILTER (unequal) AS mismatches, coalesce(max(CASE WHEN unequal AND greatest(abs(lv), abs(iv)) > 0 AND lv IS NOT NULL AND iv IS NOT NULL THEN abs(lv - iv) / greatest(abs(lv), abs(iv)) END), 0) AS max_deviation FROM marked)
SELECT (SELECT count(*) FROM cd) AS dates, (SELECT count(*) FROM cs) AS stocks, mismatches, round(max_deviation, 12) AS max_deviation, round(mismatches / greatest((SELECT count(*) FROM cd) * (SELECT count(*) FROM cs), 1)::DOUBLE, 12) AS share FROM r""",
    "overlap_examples": f"WITH {CELLS} SELECT date, stock, lv AS local, iv AS incoming FROM marked WHERE unequal ORDER BY date, stock LIMIT 8",
    "covers_dates": f"WITH {MATRIX} SELECT DISTINCT date FROM local WHERE date NOT IN (SELECT date FROM incoming)",
    "covers_stocks": f"WITH {MATRIX} SELECT DISTINCT stock FROM local WHERE stock NOT IN (SELECT stock FROM incoming)",
    "overlay_merge": f"WITH {MATRIX} SELECT * FROM local WHERE NOT (date IN (SELECT date FROM incoming) AND stock IN (SELECT stock FROM incoming)) UNION ALL SELECT * FROM incoming",
    "overlay_gaps": f"""WITH {MATRIX}, n AS (SELECT (SELECT count(DISTINCT date) FROM local) AS ld, (SELECT count(DISTINCT date) FROM incoming) AS i, (SELECT count(*) FROM cd) AS bd,
  (SELECT count(DISTINCT stock) FROM local) AS ls, (SELECT count(DISTINCT stock) FROM incoming) AS iss, (SELECT count(*) FROM cs) AS bs)
SELECT (ld + i - bd) * (ls + iss - bs) AS grid, ld * ls + i * iss - bd * bs AS covered, ld * ls + i * iss - bd * bs < (ld + i - bd) * (ls + iss - bs) AS has_gaps FROM n""",
    "ordered_axis_union": """WITH u AS (SELECT s_suppkey AS stock, CASE WHEN s_suppkey % 4 <> 1 THEN 0 ELSE 1 END AS side, CASE WHEN s_suppkey % 4 <> 1 THEN -s_suppkey ELSE s_suppkey END AS pos FROM supplier WHERE s_suppkey % 4 <> 1 OR s_suppkey % 3 <> 1)
SELECT stock, CAST(row_number() OVER (ORDER BY side, pos) - 1 AS INTEGER) AS place FROM u""",
    "axis_classifier": """WITH labels AS (SELECT 'order days' AS axis, 'integer' AS kind, strftime(o_orderdate, '%Y%m%d') AS label FROM orders UNION ALL SELECT 'order text', 'text', strftime(o_orderdate, '%Y%m%d') FROM orders
UNION ALL SELECT 'event times', 'datetime', CAST(ts AS VARCHAR) FROM events UNION ALL SELECT 'parts', 'integer', CAST(p_partkey AS VARCHAR) FROM part UNION ALL SELECT 'far days', 'integer', CAST(p_partkey + 21001200 AS VARCHAR) FROM part)
SELECT axis, bool_and(kind = 'datetime' OR (kind = 'integer' AND TRY_CAST(label AS BIGINT) BETWEEN 19000101 AND 21001231)) AS date_axis, bool_and(kind <> 'datetime' AND regexp_full_match(label, '[0-9]{8}')) AS eight_digits, count(*) AS labels FROM labels GROUP BY axis""",
    "series_snapshot": """WITH l AS (SELECT c_custkey AS v, count(*) AS n FROM customer WHERE c_custkey % 5 <> 0 GROUP BY 1), i AS (SELECT CASE WHEN c_custkey % 9 = 0 THEN c_custkey - 1 ELSE c_custkey END AS v, count(*) AS n FROM customer WHERE c_custkey % 7 <> 0 GROUP BY 1),
r AS (SELECT CAST(0 AS BIGINT) AS nulls, CAST((SELECT sum(n - 1) FROM l) + (SELECT sum(n - 1) FROM i) AS BIGINT) AS repeats, (SELECT count(*) FROM l WHERE v NOT IN (SELECT v FROM i)) AS lost, (SELECT count(*) FROM i WHERE v NOT IN (SELECT v FROM l)) AS added)
SELECT *, CASE WHEN nulls > 0 THEN 'nulls' WHEN repeats > 0 THEN 'repeats' WHEN lost = 0 THEN 'accepted' WHEN added = 0 THEN 'already applied' ELSE 'lost values' END AS verdict FROM r""",
    "table_snapshot": f"""WITH {SNAPSHOTS}, k AS (SELECT (SELECT count(*) FROM changes) AS changed, (SELECT count(*) FROM old WHERE stkcode NOT IN (SELECT stkcode FROM new)) AS l, (SELECT count(*) FROM new WHERE stkcode NOT IN (SELECT stkcode FROM old)) AS a),
r AS (SELECT CAST(0 AS BIGINT) AS nulls, CAST(0 AS BIGINT) AS repeats, changed, l - changed AS lost, a - changed AS added FROM k)
SELECT *, CASE WHEN lost = 0 THEN 'accepted' WHEN added = 0 THEN 'already applied' ELSE 'lost keys' END AS verdict FROM r""",
    "code_changes": f"WITH {SNAPSHOTS} SELECT * FROM changes",
    "reference_window": f"WITH {AXES} SELECT day FROM win",
    "axis_consistency": f"WITH {AXES} SELECT *, CASE WHEN missing > 0 OR extra > 0 OR lag > 5 THEN 'error' WHEN lag > 0 THEN 'warning' ELSE 'ok' END AS level FROM judged",
    "tail_lag": f"WITH {AXES} SELECT axis, lag FROM judged",
    "day_diff_unequal_fields": f"""WITH {BARS}, n AS (SELECT * REPLACE (CASE WHEN row_id % 500 = 0 THEN close + 1 ELSE close END AS close, CASE WHEN row_id % 400 = 0 THEN NULL ELSE open END AS open) FROM bars WHERE row_id % 700 <> 1),
o1 AS (SELECT *, row_number() OVER (PARTITION BY date, code ORDER BY time, row_id) AS k FROM bars), n1 AS (SELECT *, row_number() OVER (PARTITION BY date, code ORDER BY time, row_id) AS k FROM n)
SELECT coalesce(o.date, n.date) AS date, count(o.row_id) AS old_rows, count(n.row_id) AS new_rows, {', '.join(f'count(*) FILTER (o.{c} IS DISTINCT FROM n.{c}) AS {c}_differs' for c in ('time', *_P, 'volume', 'amount'))}
FROM o1 o FULL JOIN n1 n ON o.date = n.date AND o.code = n.code AND o.k = n.k GROUP BY 1""",
    "daily_normalize": """SELECT CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS datetime, o_custkey AS stock_code, o_totalprice AS value FROM orders WHERE o_custkey % 6 <> 0""",
    "daily_bundle": f"WITH {DAILY} SELECT date, symbol, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("adjfactor", *(f"daily_adj_{p}" for p in _P), "daily_volume", "daily_amount", "daily_adj_vwap")) + " FROM daily",
    "archive_caps": """WITH m AS (SELECT page_id % 20 AS archive, CAST(length(html) AS BIGINT) AS f, CAST(length(html) AS BIGINT) // (1 + page_id % 7) AS c FROM pages),
r AS (SELECT archive, count(*) AS members, max(f) AS largest, CAST(sum(f) AS BIGINT) AS total, round(max(CASE WHEN c > 0 THEN f / c::DOUBLE END), 6) AS ratio, max(CASE WHEN c > 0 THEN f / c::DOUBLE END) AS q, count(*) FILTER (c = 0 AND f > 0) AS impossible FROM m GROUP BY archive)
SELECT archive, members, largest, total, ratio, impossible, CASE WHEN members > 20 THEN 'members' WHEN largest > 9000 THEN 'member size' WHEN total > 60000 THEN 'total size' WHEN impossible > 0 THEN 'no compressed bytes' WHEN q > 6 THEN 'ratio' ELSE 'ok' END AS verdict FROM r""",
    "content_digest": f"SELECT doc_id, {_DOC} AS digest FROM documents",
    "group_digest": """SELECT c_nationkey AS "group", sha256(string_agg(c_name || chr(0) || sha256(c_name || c_mktsegment) || chr(10), '' ORDER BY c_name)) AS digest FROM customer GROUP BY 1""",
    "manifest_currency": """SELECT doc_id AS key, doc_id % 4 <> 1 AND doc_id % 9 <> 0 AND doc_id % 11 <> 5 AS current FROM documents""",
    "staged_latest_version": "SELECT o_custkey AS target, max(o_orderkey) AS version, arg_max(o_totalprice, o_orderkey) AS value, arg_max(o_orderstatus, o_orderkey) AS state FROM orders GROUP BY 1",
    "issue_tally": """WITH i AS (SELECT o_custkey % 50 AS source, CASE WHEN o_custkey % 50 < 10 AND o_orderkey % 3 = 0 THEN 'FAIL' WHEN o_custkey % 50 < 30 AND o_orderkey % 2 = 0 THEN 'WARNING' ELSE 'PASS' END AS level FROM orders)
SELECT source, count(*) FILTER (level = 'FAIL') AS fails, count(*) FILTER (level = 'WARNING') AS warnings, CASE WHEN fails > 0 THEN 'FAIL' WHEN warnings > 0 THEN 'WARNING' ELSE 'PASS' END AS status FROM i GROUP BY source""",
    "catalog_duplicates": "WITH f AS (SELECT url, regexp_extract(url, '[^/]*$') AS name FROM pages) SELECT name, count(*) AS files, min(url) AS first_path FROM f GROUP BY name HAVING count(*) > 1",
    "delivery_match": "SELECT c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 'extra' WHEN c_custkey % 5 = 0 THEN 'missing' ELSE 'matched' END AS state FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 5 <> 0",
    "content_changes": f"SELECT doc_id, {_DOC} AS digest FROM documents WHERE doc_id % 4 <> 1 AND doc_id % 9 = 0 AND doc_id % 18 <> 0",
    "conflicting_bars": f"WITH {BARS} SELECT date, code, time FROM (SELECT DISTINCT * EXCLUDE (row_id) FROM bars WHERE code IS NOT NULL) GROUP BY ALL HAVING count(*) > 1",
    "fresh_bars": f"WITH {ONE_A_KEY} SELECT * FROM base WHERE row_id % 3 = 0",
    "changed_bars": f"WITH {ONE_A_KEY} SELECT date, code, time FROM base WHERE row_id % 3 <> 0 AND (row_id % 500 = 0 AND close IS NOT NULL OR row_id % 700 = 0 AND open IS NOT NULL)",
    "unready_days": f"""WITH {BARS}, days AS (SELECT date FROM bars UNION SELECT date + 1000000 FROM bars),
kept AS (SELECT date, max(n) AS most FROM (SELECT date, code, time, count(*) AS n FROM bars WHERE code % 50 <> 3 GROUP BY ALL) GROUP BY date),
state AS (SELECT date, CASE WHEN date % 4 = 1 THEN 'no factors' WHEN most IS NULL THEN 'no bars of listed codes' WHEN most > 1 THEN 'bars repeat' END AS reason FROM days LEFT JOIN kept USING (date))
SELECT date, reason FROM state WHERE reason IS NOT NULL""",
    "universe_prices": f"WITH {BARS} SELECT strptime(CAST(date AS VARCHAR) || lpad(CAST(time AS VARCHAR), 4, '0'), '%Y%m%d%H%M') + INTERVAL 1 MINUTE AS datetime, code, {', '.join(f'{p} * ({_FACTOR}) AS {p}' for p in _P)}, volume, amount, row_id FROM bars WHERE code BETWEEN 0 AND 999999 AND code % 7 <> 3",
}

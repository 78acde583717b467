"""The same queries as plain SQL for an independent engine.

Fixed values: label texts, public column names, limits and dates are those of the output contract.
"""

from __future__ import annotations

# One bill per order line.
_E = """e AS (
  SELECT o_orderpriority AS medical_condition, s_name AS hospital, c_mktsegment AS insurance_provider,
         l_returnflag AS admission_type, CAST(l_shipdate AS DATE) AS discharge_date,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS bill_cents
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"""


def _half_up(total: str, count: str) -> str:
    """Whole cents, for amounts of at least zero."""
    return f"CAST((2 * {total} + {count}) // (2 * {count}) AS BIGINT)"


_TEXT_DATE = "strftime(discharge_date, '%Y-%m-%d') AS discharge_date"
_QUARTER = "CAST(quarter(discharge_date) AS INTEGER) AS quarter"

# Daily averages in cents over all bills.
_D = f"""d AS (
  SELECT medical_condition, hospital, insurance_provider, admission_type, discharge_date,
         CAST(sum(bill_cents) AS BIGINT) AS bill_cents, count(bill_cents) AS bill_count,
         {_half_up("sum(bill_cents)", "count(bill_cents)")} AS average_cents
  FROM e GROUP BY ALL)"""

_C = f"""c AS (
  SELECT *, {_QUARTER}, CASE
      WHEN medical_condition IS NULL OR hospital IS NULL OR insurance_provider IS NULL OR admission_type IS NULL
        THEN 'null_key'
      WHEN greatest(length(medical_condition), length(hospital), length(insurance_provider),
                    length(admission_type)) > 60 THEN 'too_long'
      WHEN average_cents IS NULL THEN 'amount_null'
      WHEN abs(average_cents) >= 10000000 THEN 'amount_range'
      WHEN discharge_date IS NULL THEN 'date_null' END AS reject_reason
  FROM d)"""

_D_COLUMNS = f"""medical_condition, hospital, insurance_provider, admission_type, {_TEXT_DATE},
  bill_cents, bill_count, CAST(average_cents AS DOUBLE) / 100 AS average_bill_amount"""

# Unweighted mean of stored daily averages by quarter, in cents.
_Q = f"""s AS (
  SELECT medical_condition, hospital, insurance_provider, admission_type, discharge_date,
         {_half_up("sum(bill_cents)", "count(bill_cents)")} AS average_cents
  FROM e GROUP BY ALL),
q AS (
  SELECT medical_condition, hospital, insurance_provider, {_QUARTER},
         {_half_up("sum(average_cents)", "count(*)")} AS cents
  FROM s WHERE medical_condition IS NOT NULL AND hospital IS NOT NULL AND insurance_provider IS NOT NULL
  GROUP BY ALL),
p AS (SELECT *, CAST(cents // 1000000 AS INTEGER) AS prediction FROM q),
f AS (
  SELECT prediction, CAST(sum(cents) AS DOUBLE) / CAST(count(*) * 100 AS DOUBLE) AS segment_mean,
         count(*) AS segment_rows
  FROM p GROUP BY prediction)"""

_FIVE = """t AS (
  SELECT quantile_disc(cents, 0.2) / 100.0 AS e1, quantile_disc(cents, 0.4) / 100.0 AS e2,
         quantile_disc(cents, 0.6) / 100.0 AS e3, quantile_disc(cents, 0.8) / 100.0 AS e4 FROM q),
l AS (
  SELECT f.*, CASE WHEN segment_mean < e1 THEN 'Very Low' WHEN segment_mean < e2 THEN 'Low'
      WHEN segment_mean < e3 THEN 'Moderate' WHEN segment_mean < e4 THEN 'High' ELSE 'Very High' END AS bill_cat
  FROM f, t)"""

_THREE = """t AS (
  SELECT quantile_disc(cents, 0.33) / 100.0 AS e1, quantile_disc(cents, 0.66) / 100.0 AS e2 FROM q),
l AS (
  SELECT f.*, CASE WHEN segment_mean < e1 THEN 'Low' WHEN segment_mean < e2 THEN 'Medium' ELSE 'High' END AS bill_cat
  FROM f, t)"""

_LABELLED = """SELECT medical_condition, hospital, insurance_provider, quarter,
  CAST(cents AS DOUBLE) / 100 AS avg_bill_amount, bill_cat FROM p LEFT JOIN l USING (prediction)"""


def _index(column: str) -> str:
    return f"""SELECT {column}, count(*) AS frequency,
  CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS label_index
  FROM q GROUP BY {column}"""


def _weighted(extra: str = "") -> str:
    return f"""SELECT medical_condition, hospital, insurance_provider, {_QUARTER}{extra},
  CAST(sum(bill_cents) AS BIGINT) AS bill_cents, count(bill_cents) AS bill_count,
  CAST({_half_up("sum(bill_cents)", "count(bill_cents)")} AS DOUBLE) / 100 AS avg_bill_amount
  FROM e GROUP BY ALL"""


_E_COLUMNS = f"""medical_condition, hospital, insurance_provider, admission_type, {_TEXT_DATE}, bill_cents"""

# Events as run-ledger rows.
_L = """r AS (
  SELECT event_id AS id, event_type AS stage, ts,
         CASE WHEN event_type = 'purchase' THEN CAST(ts AS DATE) END AS last_loaded FROM events)"""
_L_COLUMNS = """id, stage, CAST(ts AS VARCHAR) AS event_time,
  strftime(last_loaded, '%Y-%m-%d') AS last_loaded"""

# Quarterly averages of the accepted daily averages.
_V = f"""v AS (
  SELECT medical_condition, hospital, insurance_provider, quarter,
    {_half_up("sum(average_cents)", "count(*)")} AS cents
  FROM c WHERE reject_reason IS NULL GROUP BY ALL)"""
_STORED = "SELECT medical_condition, hospital, insurance_provider, quarter, CAST(cents AS DOUBLE) / 100 AS avg_bill_amount"

_REPORT = f"""WITH {_E}, {_D}
SELECT medical_condition AS "Medical Condition", hospital AS "Hospital",
  insurance_provider AS "Insurance Provider", CAST(quarter(discharge_date) AS INTEGER) AS "Quarter",
  strftime(discharge_date, '%Y-%m-%d') AS "Discharge Date", CAST(average_cents AS DOUBLE) / 100 AS "Average Bill Amount"
FROM d"""

ORACLES: dict[str, str] = {
    "scan_encounters": f"WITH {_E} SELECT {_E_COLUMNS} FROM e",
    "scan_encounters_csv": f"WITH {_E} SELECT {_E_COLUMNS} FROM e",
    "quarter_column": f"WITH {_E} SELECT {_TEXT_DATE}, {_QUARTER} FROM e",
    "complete_rows": f"""WITH {_E} SELECT {_E_COLUMNS}, {_QUARTER} FROM e
WHERE bill_cents % 11 <> 0 AND bill_cents % 13 <> 0 AND medical_condition IS NOT NULL
  AND insurance_provider IS NOT NULL AND quarter(discharge_date) IS NOT NULL""",
    "daily_average_bill": f"WITH {_E}, {_D} SELECT {_D_COLUMNS} FROM d",
    "monthly_average_bill": f"""WITH {_E}
SELECT medical_condition, hospital, strftime(date_trunc('month', discharge_date), '%Y-%m-%d') AS discharge_month,
  CAST(sum(bill_cents) AS BIGINT) AS bill_cents, count(bill_cents) AS bill_count,
  CAST({_half_up("sum(bill_cents)", "count(bill_cents)")} AS DOUBLE) / 100 AS average_bill_amount
FROM e GROUP BY ALL""",
    "quarterly_weighted": f"WITH {_E} {_weighted()}",
    "quarterly_weighted_by_year": f"WITH {_E} {_weighted(', CAST(year(discharge_date) AS INTEGER) AS year')}",
    "quarterly_mean_of_means": f"""WITH {_E}, {_Q}
SELECT medical_condition, hospital, insurance_provider, quarter, CAST(cents AS DOUBLE) / 100 AS avg_bill_amount
FROM q""",
    "top_averages": f"""WITH {_E}, w AS ({_weighted()})
SELECT medical_condition, hospital, insurance_provider, quarter, avg_bill_amount FROM w
ORDER BY avg_bill_amount DESC, medical_condition, hospital, insurance_provider, quarter LIMIT 10""",
    "incremental_slice": f"""WITH {_E} SELECT {_E_COLUMNS} FROM e
WHERE e.discharge_date >= DATE '1996-05-08' + INTERVAL 1 MONTH""",
    "incremental_slice_after": f"WITH {_E} SELECT {_E_COLUMNS} FROM e WHERE e.discharge_date > DATE '1996-05-08'",
    "incremental_slice_stored": f"""WITH {_E}, {_D}, {_C} SELECT {_D_COLUMNS}, quarter FROM c
WHERE reject_reason IS NULL AND c.discharge_date > DATE '1996-05-08'""",
    "incremental_late": f"""WITH {_E} SELECT {_E_COLUMNS} FROM e
WHERE e.discharge_date < DATE '1996-05-08' + INTERVAL 1 MONTH""",
    "ledger_last_loaded": f"""WITH {_L}
SELECT strftime(coalesce(max(last_loaded), DATE '2019-05-08'), '%Y-%m-%d') AS last_loaded FROM r""",
    "ledger_latest": f"""WITH {_L} SELECT {_L_COLUMNS} FROM r
QUALIFY row_number() OVER (PARTITION BY stage ORDER BY ts DESC, id DESC) = 1""",
    "ledger_latest_event": f"""WITH {_L} SELECT {_L_COLUMNS} FROM (SELECT * FROM r ORDER BY ts DESC, id DESC LIMIT 1)""",
    "ledger_until_now": f"""WITH {_L} SELECT stage, count(*) AS events FROM r
WHERE CAST(ts AS VARCHAR) <= CAST(current_localtimestamp() AS VARCHAR) GROUP BY stage""",
    "ledger_stages": f"WITH {_L} SELECT DISTINCT stage FROM r",
    "ledger_event_is": f"""WITH {_L}
SELECT coalesce((SELECT stage = 'view' FROM r WHERE id = 2), false) AS event_is""",
    "ledger_upstream_done": f"""WITH {_L}, n AS (
  SELECT stage, row_number() OVER (ORDER BY ts, id) AS n FROM r)
SELECT coalesce(max(CASE WHEN stage = 'purchase' THEN n END) >
  coalesce(max(CASE WHEN stage = 'signup' THEN n END), 0), false) AS upstream_done FROM n""",
    "ledger_needs_rebuild": f"""WITH {_L}, m AS (SELECT max(last_loaded) AS d FROM r)
SELECT d IS NULL OR quarter(d) <> quarter(DATE '2024-07-01') OR year(d) <> year(DATE '2024-07-01')
  AS needs_rebuild FROM m""",
    "load_valid_rows": f"WITH {_E}, {_D}, {_C} SELECT {_D_COLUMNS} FROM c WHERE reject_reason IS NULL",
    "load_appended": f"WITH {_E}, {_D}, {_C} SELECT {_D_COLUMNS} FROM c WHERE reject_reason IS NULL",
    "load_quarantine": f"""WITH {_E}, {_D}, {_C} SELECT {_D_COLUMNS}, reject_reason FROM c
WHERE reject_reason IS NOT NULL""",
    "load_counts": f"""WITH {_E}, {_D}, {_C}
SELECT count(*) AS rows_seen, count(*) - count(reject_reason) AS rows_loaded,
  count(reject_reason) AS rows_rejected FROM c""",
    "stage_row_counts": f"""WITH {_E}, {_D}, w AS ({_weighted()})
SELECT (SELECT count(*) FROM e) AS bills, (SELECT count(*) FROM d) AS days, (SELECT count(*) FROM w) AS groups""",
    "string_index": f"WITH {_E}, {_Q} {_index('hospital')}",
    "feature_columns": f"""WITH {_E}, {_Q}, h AS ({_index('hospital')}), i AS ({_index('insurance_provider')})
SELECT medical_condition, hospital, insurance_provider, quarter, CAST(cents AS DOUBLE) / 100 AS avg_bill_amount,
  h.label_index AS hospital_index, i.label_index AS insurance_index
FROM q JOIN h USING (hospital) JOIN i USING (insurance_provider)""",
    "quantile_edges_exact": f"""WITH {_E}, {_Q}
SELECT 0.2::DOUBLE AS probability, CAST(quantile_disc(cents, 0.2) AS DOUBLE) / 100 AS edge FROM q
UNION ALL SELECT 0.4::DOUBLE, CAST(quantile_disc(cents, 0.4) AS DOUBLE) / 100 FROM q
UNION ALL SELECT 0.6::DOUBLE, CAST(quantile_disc(cents, 0.6) AS DOUBLE) / 100 FROM q
UNION ALL SELECT 0.8::DOUBLE, CAST(quantile_disc(cents, 0.8) AS DOUBLE) / 100 FROM q""",
    "segment_profile": f"WITH {_E}, {_Q} SELECT prediction, segment_mean, segment_rows FROM f",
    "segments_labelled": f"WITH {_E}, {_Q}, {_FIVE} {_LABELLED}",
    "segments_replaced": f"WITH {_E}, {_Q}, {_FIVE} {_LABELLED}",
    "segments_three_labels": f"WITH {_E}, {_Q}, {_THREE} {_LABELLED}",
    "label_counts": f"WITH {_E}, {_Q}, {_FIVE} SELECT bill_cat, count(*) AS segments FROM l GROUP BY bill_cat",
    "kmeans_nearest": f"WITH {_E}, {_Q} SELECT count(*) AS rows_scored, 0::BIGINT AS rows_not_nearest FROM q",
    "quantile_rank_error": "SELECT unnest([0.2, 0.4, 0.6, 0.8])::DOUBLE AS probability, true AS within",
    "segments_table": f"WITH {_E}, {_D}, {_C}, {_V} {_STORED}, true AS labelled FROM v",
    "ledger_stored": f"""WITH {_E}, {_D}, {_C}
SELECT true AS event_is, strftime(max(discharge_date), '%Y-%m-%d') AS last_loaded FROM c WHERE reject_reason IS NULL""",
    "incremental_slice_text": f"WITH {_E} SELECT {_E_COLUMNS} FROM e WHERE e.discharge_date > DATE '1996-05-08'",
    "report_admissions": _REPORT,
    "report_published": _REPORT,
    "report_segments": f"""WITH {_E}, {_Q}, {_FIVE}
SELECT medical_condition AS "Medical Condition", hospital AS "Hospital",
  insurance_provider AS "Insurance Provider", quarter AS "Quarter",
  CAST(cents AS DOUBLE) / 100 AS "Avg Bill Amount", bill_cat AS "Bill Cat"
FROM p LEFT JOIN l USING (prediction)""",
    "report_runs": f"WITH {_L} SELECT {_L_COLUMNS} FROM r",
    "ingest_load": f"""WITH {_E}, {_D}, {_C} SELECT {_D_COLUMNS}, quarter FROM c
WHERE reject_reason IS NULL AND c.discharge_date >= DATE '1996-05-08' + INTERVAL 1 MONTH""",
    "ingest_table": f"WITH {_E}, {_D}, {_C} SELECT {_D_COLUMNS}, quarter FROM c WHERE reject_reason IS NULL",
    "ingest_rejects": f"""WITH {_E.replace("e AS", "o AS", 1)}, e AS (
  SELECT medical_condition, insurance_provider, admission_type,
    CASE WHEN bill_cents % 101 = 0 THEN NULL WHEN bill_cents % 103 = 0 THEN repeat('h', 61) ELSE hospital END AS hospital,
    CASE WHEN bill_cents % 109 = 0 THEN NULL WHEN bill_cents % 113 = 0 THEN DATE '9999-12-31'
      ELSE discharge_date END AS discharge_date,
    CASE WHEN bill_cents % 107 <> 0 THEN bill_cents END AS bill_cents
  FROM o), {_D}, {_C.replace("'date_null' END", "'date_null' WHEN discharge_date > current_date THEN 'date_range' END")}
SELECT {_D_COLUMNS}, quarter, reject_reason FROM c WHERE reject_reason IS NOT NULL""",
    "ingest_unreadable": """WITH o AS (
  SELECT c_name, o_orderpriority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS admitted, p_name, s_name,
    c_mktsegment, l_returnflag, p_type, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey),
t AS (
  SELECT *, CASE WHEN cents % 101 = 0 THEN 'none' ELSE printf('%d.%02d', cents // 100, cents % 100) END AS amount,
    CASE WHEN cents % 103 = 0 THEN '2019-13-40' ELSE day END AS shown
  FROM o WHERE cents % 101 = 0 OR cents % 103 = 0)
SELECT o_orderpriority AS medical_condition, s_name AS hospital, c_mktsegment AS insurance_provider,
  l_returnflag AS admission_type, CASE WHEN cents % 103 <> 0 THEN day END AS discharge_date, count(*) AS bill_count,
  c_name || ',,,,' || o_orderpriority || ',' || admitted || ',' || p_name || ',' || s_name || ',' || c_mktsegment
    || ',' || amount || ',,' || l_returnflag || ',' || shown || ',' || p_type || ',' AS raw_line
FROM t GROUP BY ALL""",
    "stream_segments": f"WITH {_E}, {_D}, {_C}, {_V} {_STORED}, true AS labelled FROM v",
    "segments_stored": f"WITH {_E}, {_D}, {_C}, {_V} {_STORED}, true AS labelled FROM v",
    "quarters_refreshed": f"WITH {_E}, {_D}, {_C}, {_V} {_STORED} FROM v",
    "guarded_rows": f"WITH {_E}, {_D} SELECT {_D_COLUMNS} FROM d",
    "kmeans_any_partitions": f"WITH {_E}, {_Q} SELECT count(*) AS rows_scored, 0::BIGINT AS rows_differing FROM q",
    "quantile_rank_error_stored": "SELECT unnest([0.2, 0.4, 0.6, 0.8])::DOUBLE AS probability, true AS within",
    "report_tables": f"""WITH {_E}, {_D}, {_C}
SELECT 'admissions' AS report, count(*) AS rows FROM c WHERE reject_reason IS NULL
UNION ALL SELECT 'segments', count(*) FROM (
  SELECT DISTINCT medical_condition, hospital, insurance_provider, quarter FROM c WHERE reject_reason IS NULL)
UNION ALL SELECT 'runs', 4""",
    "incremental_stream": f"WITH {_E}, {_D}, {_C} SELECT {_D_COLUMNS}, quarter, reject_reason FROM c",
}

"""DuckDB twins of the batch plans, for the correctness gate.

Each statement is self-contained: it rebuilds the transaction view from the
``events`` table and states the operator in plain SQL (the straightforward
forms: ten window rows per event, a self-window for the exact rule), which is
what the Spark plans must agree with.
"""

from __future__ import annotations

from tripwire.config import COUNTRIES, HIGH_VALUE_THRESHOLD, REASON_HIGH_VALUE, REASON_TRAVEL
from tripwire.plans.catalog import REPORT_HOURS

_CODES = ", ".join(f"'{c}'" for c in COUNTRIES)
_TX = f"""tx AS (
  SELECT format('USER_{{:05d}}', user_id) AS user_id,
         CAST(ts AS TIMESTAMP) AS "timestamp",
         upper(event_type) AS merchant_category,
         round_even(value * 25, 2) AS amount,
         [{_CODES}][((CAST(json_extract(props, '$.k') AS INTEGER) % 10 + 10) % 10) + 1] AS location
  FROM events)"""
_COLS = 'user_id, "timestamp", merchant_category, amount, location'
_HV = f"""hv AS (
  SELECT {_COLS}, '{REASON_HIGH_VALUE}' AS fraud_reason FROM tx WHERE amount > {HIGH_VALUE_THRESHOLD})"""
_WIN = """w AS (
  SELECT *, unnest(generate_series(date_trunc('minute', "timestamp") - INTERVAL 9 MINUTE,
                                   date_trunc('minute', "timestamp"), INTERVAL 1 MINUTE)) AS ws
  FROM tx WHERE "timestamp" IS NOT NULL),
fw AS (SELECT user_id, ws FROM w GROUP BY user_id, ws HAVING min(location) < max(location))"""
_IT = f"""it AS (
  SELECT {_COLS}, '{REASON_TRAVEL}' AS fraud_reason FROM w JOIN fw USING (user_id, ws))"""
_FRAUD = "fraud AS (SELECT * FROM hv UNION ALL SELECT * FROM it)"
_ASOF = '(SELECT max("timestamp") FROM tx)'


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_F = _with(_TX, _HV, _WIN, _IT, _FRAUD)
_LB_REPORT = f'lb AS (SELECT * FROM fraud WHERE "timestamp" >= {_ASOF} - INTERVAL {REPORT_HOURS} HOUR)'
_R = _with(_TX, _HV, _WIN, _IT, _FRAUD, _LB_REPORT)

# compensated double sums and averages over the amounts as they are
_MSUM = "fsum(amount)"
_MAVG = "favg(amount)"
_ISO = """CASE WHEN epoch_us("timestamp") % 1000000 = 0
            THEN strftime("timestamp", '%Y-%m-%dT%H:%M:%S')
            ELSE strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') END"""


def _grouped(key_expr: str, key_name: str, with_max: bool, with_users: bool) -> str:
    extra = ""
    if with_max:
        extra += ", round_even(max(amount), 2) AS max_amount"
    if with_users:
        extra += ", count(DISTINCT user_id) AS unique_users"
    return (_R + f"SELECT {key_expr} AS {key_name}, count(amount) AS fraud_count, "
            f"round_even(coalesce({_MSUM}, 0.0), 2) AS total_amount, "
            f"round_even({_MAVG}, 2) AS avg_amount{extra} "
            f"FROM lb WHERE {key_expr} IS NOT NULL GROUP BY {key_expr}")


def _recent(where: str, order: str, cols: str) -> str:
    rest = [c for c in ['user_id', '"timestamp"', 'merchant_category', 'amount', 'location', 'fraud_reason']
            if c != order]
    return _F + (f"SELECT {cols} FROM fraud {where} ORDER BY {order} DESC, "
                 + ", ".join(f"{c} ASC NULLS FIRST" for c in rest) + " LIMIT 10")


def _recon_totals(validated: str, fraud: str) -> str:
    return f"""v AS (SELECT count(*) AS transaction_count, coalesce({_MSUM}, 0.0) AS total_amount FROM {validated}),
f AS (SELECT count(*) AS fraud_count, coalesce({_MSUM}, 0.0) AS fraud_amount FROM {fraud}),
c AS (SELECT *, transaction_count + fraud_count AS tn, total_amount + fraud_amount AS ta FROM v CROSS JOIN f)"""


_RECON_SELECT = f"""SELECT {_ASOF} AS report_timestamp, tn AS total_transactions,
       transaction_count AS validated_transactions, fraud_count AS fraud_transactions,
       round_even(CASE WHEN tn > 0 THEN fraud_count / tn * 100 ELSE 0.0 END, 2) AS fraud_percentage,
       round_even(total_amount, 2) AS total_amount, round_even(fraud_amount, 2) AS fraud_amount,
       round_even(CASE WHEN ta > 0 THEN fraud_amount / ta * 100 ELSE 0.0 END, 2) AS fraud_amount_percentage
FROM c"""
_LB6 = f'f6 AS (SELECT * FROM fraud WHERE "timestamp" >= {_ASOF} - INTERVAL 6 HOUR)'


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["json_encode"] = _with(_TX) + f"""SELECT '{{"user_id":"' || user_id || '","timestamp":"' || {_ISO}
  || '","merchant_category":"' || merchant_category || '","amount":' || CAST(amount AS VARCHAR)
  || ',"location":"' || location || '"}}' AS value FROM tx"""
    q["json_decode"] = _with(_TX) + f"""SELECT user_id, {_ISO} AS "timestamp", merchant_category, amount, location FROM tx"""
    q["event_time_parse"] = _with(_TX) + f"SELECT {_COLS} FROM tx"
    q["validated_scan"] = q["event_time_parse"]
    q["high_value"] = _with(_TX, _HV) + "SELECT * FROM hv"
    q["window_location_count"] = _with(_TX, _WIN) + """SELECT user_id, ws AS window_start,
  ws + INTERVAL 10 MINUTE AS window_end, count(DISTINCT location) AS location_count
FROM w GROUP BY user_id, ws"""
    q["impossible_windows"] = q["window_location_count"] + " HAVING count(DISTINCT location) > 1"
    q["impossible_travel"] = _with(_TX, _WIN, _IT) + "SELECT * FROM it"
    q["impossible_travel_exact"] = _with(_TX) + f"""SELECT {_COLS}, '{REASON_TRAVEL}' AS fraud_reason FROM (
  SELECT *, min(location) OVER win AS lo, max(location) OVER win AS hi
  FROM tx WHERE user_id IS NOT NULL AND "timestamp" IS NOT NULL AND location IS NOT NULL
  WINDOW win AS (PARTITION BY user_id ORDER BY "timestamp"
                 RANGE BETWEEN INTERVAL 10 MINUTE PRECEDING AND INTERVAL 10 MINUTE FOLLOWING))
WHERE lo < hi"""
    q["fraud_union"] = _F + "SELECT * FROM fraud"
    q["detect_all"] = q["fraud_union"]
    q["fraud_distinct"] = _F + "SELECT DISTINCT * FROM fraud"
    q["validated_anti"] = _F + f"""SELECT {_COLS} FROM tx t WHERE NOT EXISTS (
  SELECT 1 FROM fraud f WHERE f.user_id IS NOT DISTINCT FROM t.user_id
    AND f."timestamp" IS NOT DISTINCT FROM t."timestamp"
    AND f.merchant_category IS NOT DISTINCT FROM t.merchant_category
    AND f.amount IS NOT DISTINCT FROM t.amount AND f.location IS NOT DISTINCT FROM t.location)"""
    q["constraint_violations"] = _F + """SELECT *, array_to_string(list_filter([
    CASE WHEN user_id IS NULL THEN 'user_id IS NULL' END,
    CASE WHEN "timestamp" IS NULL THEN 'timestamp IS NULL' END,
    CASE WHEN merchant_category IS NULL THEN 'merchant_category IS NULL' END,
    CASE WHEN amount IS NULL THEN 'amount IS NULL' END,
    CASE WHEN location IS NULL THEN 'location IS NULL' END,
    CASE WHEN fraud_reason IS NULL THEN 'fraud_reason IS NULL' END,
    CASE WHEN length(user_id) > 50 THEN 'user_id LONGER THAN 50' END,
    CASE WHEN length(merchant_category) > 100 THEN 'merchant_category LONGER THAN 100' END,
    CASE WHEN length(location) > 10 THEN 'location LONGER THAN 10' END,
    CASE WHEN length(fraud_reason) > 255 THEN 'fraud_reason LONGER THAN 255' END], lambda x: x IS NOT NULL), ';')
  AS violation_list FROM fraud"""
    q["validated_totals"] = _with(_TX) + f"SELECT count(*) AS transaction_count, round(coalesce({_MSUM}, 0.0), 4) AS total_amount FROM tx"
    q["fraud_totals"] = _with(_TX, _HV, _WIN, _IT, _FRAUD, _LB6) + f"SELECT count(*) AS fraud_count, round(coalesce({_MSUM}, 0.0), 4) AS fraud_amount FROM f6"
    q["fraud_patterns"] = _with(_TX, _HV, _WIN, _IT, _FRAUD, _LB6) + f"""SELECT merchant_category, count(*) AS fraud_count,
  round({_MSUM}, 4) AS total_fraud_amount, round({_MAVG}, 4) AS avg_fraud_amount, fraud_reason
FROM f6 GROUP BY merchant_category, fraud_reason"""
    q["reconciliation"] = _with(_TX, _HV, _WIN, _IT, _FRAUD, _LB6, _recon_totals("tx", "f6")) + _RECON_SELECT
    q["recon_table_row"] = _with(_TX, _HV, _WIN, _IT, _FRAUD, _LB6, _recon_totals("tx", "f6")) + f"""SELECT {_ASOF} AS report_date,
  tn AS total_transactions, round(ta, 4) AS total_amount, fraud_count, round(fraud_amount, 4) AS fraud_amount FROM c"""
    q["reconciliation_consistent"] = _with(
        _TX, _HV, _WIN, _IT, _FRAUD,
        f'tx6 AS (SELECT {_COLS} FROM tx WHERE "timestamp" >= {_ASOF} - INTERVAL 6 HOUR)',
        f'fe AS (SELECT DISTINCT {_COLS} FROM fraud WHERE "timestamp" >= {_ASOF} - INTERVAL 6 HOUR)',
        f"""clean AS (SELECT * FROM tx6 t WHERE NOT EXISTS (SELECT 1 FROM fe f
  WHERE f.user_id IS NOT DISTINCT FROM t.user_id AND f."timestamp" IS NOT DISTINCT FROM t."timestamp"
    AND f.merchant_category IS NOT DISTINCT FROM t.merchant_category
    AND f.amount IS NOT DISTINCT FROM t.amount AND f.location IS NOT DISTINCT FROM t.location))""",
        _recon_totals("clean", "fe")) + _RECON_SELECT
    q["fraud_lookback"] = _R + "SELECT * FROM lb"
    q["by_category"] = _grouped("merchant_category", "merchant_category", True, True)
    q["by_reason"] = _grouped("fraud_reason", "fraud_reason", False, True)
    q["by_location"] = _grouped("location", "location", False, False)
    q["by_hour"] = _grouped('CAST(hour("timestamp") AS INTEGER)', "hour", False, False)
    q["summary"] = _R + f"""SELECT * FROM (SELECT count(*) AS total_fraud_transactions,
  round_even(coalesce({_MSUM}, 0.0), 2) AS total_fraud_amount,
  round_even({_MAVG}, 2) AS average_fraud_amount,
  round_even(median(amount), 2) AS median_fraud_amount,
  max(amount) AS max_fraud_amount,
  count(DISTINCT user_id) AS unique_users_affected,
  (SELECT merchant_category FROM lb WHERE merchant_category IS NOT NULL GROUP BY 1
     ORDER BY count(*) DESC, 1 ASC LIMIT 1) AS most_common_category,
  (SELECT fraud_reason FROM lb WHERE fraud_reason IS NOT NULL GROUP BY 1
     ORDER BY count(*) DESC, 1 ASC LIMIT 1) AS most_common_reason
FROM lb) WHERE total_fraud_transactions > 0"""
    q["top_categories"] = _R + """SELECT merchant_category, count(*) AS fraud_count FROM lb
WHERE merchant_category IS NOT NULL GROUP BY 1 ORDER BY fraud_count DESC, merchant_category LIMIT 10"""
    q["reason_share"] = _R + """SELECT fraud_reason, fraud_count,
  round_even(fraud_count * 100.0 / sum(fraud_count) OVER (), 1) AS percentage
FROM (SELECT fraud_reason, count(*) AS fraud_count FROM lb WHERE fraud_reason IS NOT NULL GROUP BY 1)"""
    q["timeline_hourly"] = _R + """SELECT date_trunc('hour', "timestamp") AS hour_start, count(*) AS fraud_count
FROM lb WHERE "timestamp" IS NOT NULL GROUP BY 1"""
    _rng = """rng AS (SELECT n, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
                     CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi, sd
  FROM (SELECT count(*) AS n, min(amount) AS mn, max(amount) AS mx, stddev_samp(amount) AS sd
        FROM lb WHERE amount IS NOT NULL) WHERE n > 0)"""
    # every amount is counted against the edges themselves
    q["amount_histogram"] = _with(_TX, _HV, _WIN, _IT, _FRAUD, _LB_REPORT, _rng) + """, edges AS (
  SELECT CAST(b AS INTEGER) AS bin, lo + (b - 1) * ((hi - lo) / 40) AS bin_start,
         CASE WHEN b = 40 THEN hi ELSE lo + b * ((hi - lo) / 40) END AS bin_end
  FROM (SELECT unnest(range(1, 41)) AS b) CROSS JOIN rng)
SELECT bin, bin_start, bin_end, count(amount) AS fraud_count
FROM edges LEFT JOIN lb ON amount >= bin_start AND (amount < bin_end OR (bin = 40 AND amount <= bin_end))
GROUP BY ALL"""
    q["amount_density"] = _with(_TX, _HV, _WIN, _IT, _FRAUD, _LB_REPORT, _rng) + """, par AS (
  SELECT n, lo, hi, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw FROM rng WHERE sd > 0),
grid AS (SELECT CAST(p AS INTEGER) AS point, lo + p * ((hi - lo) / 199) AS x, n, lo, hi, bw
         FROM (SELECT unnest(range(0, 200)) AS p) CROSS JOIN par),
wts AS (SELECT amount, count(*) AS w FROM lb WHERE amount IS NOT NULL GROUP BY amount),
k AS (SELECT point, x, n, lo, hi, bw, sum(w * exp(-0.5 * ((x - amount) / bw) * ((x - amount) / bw))) AS s
      FROM grid CROSS JOIN wts GROUP BY ALL)
SELECT point, CAST(format('{:.8e}', x) AS DOUBLE) AS amount,
       CAST(format('{:.8e}', s / (n * bw * sqrt(2 * pi()))) AS DOUBLE) AS density,
       CAST(format('{:.8e}', s / (n * bw * sqrt(2 * pi())) * n * (hi - lo) / 40) AS DOUBLE) AS expected_count FROM k"""
    q["amount_density_binned"] = _with(_TX, _HV, _WIN, _IT, _FRAUD, _LB_REPORT, _rng) + """, par AS (
  SELECT n, lo, hi, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw FROM rng WHERE sd > 0),
pos AS (SELECT (amount - lo) / bw * 32 AS p FROM lb CROSS JOIN par WHERE amount IS NOT NULL),
wts AS (SELECT c, sum(w) AS w FROM (
  SELECT floor(p) AS c, 1 - (p - floor(p)) AS w FROM pos UNION ALL SELECT floor(p) + 1, p - floor(p) FROM pos) GROUP BY c),
grid AS (SELECT CAST(p AS INTEGER) AS point, p * ((hi - lo) / 199) AS x, n, lo, hi, bw
         FROM (SELECT unnest(range(0, 200)) AS p) CROSS JOIN par),
k AS (SELECT point, x, n, lo, hi, bw,
             coalesce(sum(CASE WHEN abs(x - c * bw / 32) <= 8 * bw THEN w * exp(-0.5 * ((x - c * bw / 32) / bw) * ((x - c * bw / 32) / bw)) END), 0) AS s
      FROM grid CROSS JOIN wts GROUP BY ALL)
SELECT point, CAST(format('{:.8e}', lo + x) AS DOUBLE) AS amount,
       CAST(format('{:.8e}', s / (n * bw * sqrt(2 * pi()))) AS DOUBLE) AS density,
       CAST(format('{:.8e}', s / (n * bw * sqrt(2 * pi())) * n * (hi - lo) / 40) AS DOUBLE) AS expected_count FROM k"""
    q["summary_merged"] = _F + f"""SELECT count(*) AS total_fraud_transactions,
  round(coalesce({_MSUM}, 0.0), 2) AS total_fraud_amount, round({_MAVG}, 2) AS average_fraud_amount,
  max(amount) AS max_fraud_amount,
  (SELECT merchant_category FROM fraud WHERE merchant_category IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    AS most_common_category,
  (SELECT fraud_reason FROM fraud WHERE fraud_reason IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    AS most_common_reason,
  true AS users_within_bound
FROM fraud HAVING count(*) > 0"""
    q["format_report"] = _R + f"""SELECT merchant_category AS "Index",
  CASE WHEN fraud_count > 100 THEN format('{{:,}}', CAST(fraud_count AS BIGINT)) ELSE format('{{:.2f}}', CAST(fraud_count AS DOUBLE)) END AS fraud_count,
  '$' || format('{{:,.2f}}', coalesce(total_amount, 0.0)) AS total_amount,
  '$' || format('{{:,.2f}}', coalesce(avg_amount, 0.0)) AS avg_amount,
  '$' || format('{{:,.2f}}', coalesce(max_amount, 0.0)) AS max_amount,
  CASE WHEN unique_users > 100 THEN format('{{:,}}', CAST(unique_users AS BIGINT)) ELSE format('{{:.2f}}', CAST(unique_users AS DOUBLE)) END AS unique_users
FROM (
  SELECT merchant_category, count(amount) AS fraud_count,
         round_even(coalesce({_MSUM}, 0.0), 2) AS total_amount, round_even({_MAVG}, 2) AS avg_amount,
         round_even(max(amount), 2) AS max_amount, count(DISTINCT user_id) AS unique_users
  FROM lb WHERE merchant_category IS NOT NULL GROUP BY merchant_category
  ORDER BY fraud_count DESC, merchant_category LIMIT 12)"""
    q["adhoc_fraud_count"] = _F + "SELECT count(*) AS fraud_count FROM fraud"
    q["adhoc_count_by_reason"] = _F + "SELECT fraud_reason, count(*) AS fraud_count FROM fraud GROUP BY fraud_reason"
    q["adhoc_recent"] = _recent("", '"timestamp"', 'user_id, "timestamp", amount, location, fraud_reason')
    q["adhoc_high_value_top"] = _recent(f"WHERE fraud_reason = '{REASON_HIGH_VALUE}'", "amount", "*")
    q["adhoc_travel_recent"] = _recent(f"WHERE fraud_reason = '{REASON_TRAVEL}'", '"timestamp"', "*")
    return q


def closed_window_sql(delay_minutes: int = 15) -> dict[str, str]:
    """Batch twins of the streaming keys: only windows the watermark closed
    (window end <= latest event time - delay)."""
    cut = f"({_ASOF} - INTERVAL {delay_minutes} MINUTE)"
    it_closed = f"""itc AS (
  SELECT {_COLS}, '{REASON_TRAVEL}' AS fraud_reason FROM w JOIN fw USING (user_id, ws)
  WHERE ws + INTERVAL 10 MINUTE <= {cut})"""
    base = _with(_TX, _HV, _WIN, it_closed)
    return {
        "window_location_count": _with(_TX, _WIN) + f"""SELECT user_id, ws AS window_start,
  ws + INTERVAL 10 MINUTE AS window_end, count(DISTINCT location) AS location_count
FROM w WHERE ws + INTERVAL 10 MINUTE <= {cut} GROUP BY user_id, ws""",
        "impossible_travel": base + "SELECT * FROM itc",
        "fraud_union": base + "SELECT * FROM hv UNION ALL SELECT * FROM itc",
        "fraud_distinct": base + "SELECT DISTINCT * FROM (SELECT * FROM hv UNION ALL SELECT * FROM itc)",
    }

"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

`CTES` builds the same derived views as `vigil.sources.derived` and the
same marts as `vigil.plans`, as plain SQL over the pre-registered views
(events, orders, customer, ...).  `ORACLE[key]` is a full statement:
the CTEs it needs followed by the final SELECT.  Rounding follows the Spark
side: exact integer arithmetic, half up.
"""

from __future__ import annotations

import re

from vigil.functions.rules import RULE_DESCRIPTIONS
from vigil.sources.derived import (AMOUNT_SCALE, ANOMALY_BY_K, BROKEN_JSON_K,
                                   DEST_MODULUS, EVENT_TYPE_TO_TX_TYPE, LEDGER_BREAK_K,
                                   RATE_BASE, RATE_STEP, SELF_TRANSFER_K, ZONES)


def _case(expr: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {k!r} THEN {v!r}" if isinstance(k, str) else f"WHEN {k} THEN {v!r}"
                     for k, v in mapping.items())
    return f"CASE {expr} {whens} END"


def _initcap(expr: str) -> str:
    return ("array_to_string(list_transform(string_split(" + expr + ", ' '), "
            "lambda w: upper(w[1]) || lower(w[2:])), ' ')")


def describe_sql(expr: str) -> str:
    whens = " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in RULE_DESCRIPTIONS.items())
    return f"CASE {expr} {whens} ELSE {_initcap(f'replace({expr}, chr(95), chr(32))')} END"


def half_up(num: str, den: str, scale_factor: int) -> str:
    """round(num * scale_factor / den) half up, for non-negative integers."""
    return f"((2 * ({num}) * {scale_factor} + ({den})) // (2 * ({den})))"


def pct_sql(part: str, whole: str, scale: int = 2) -> str:
    f = 10 ** scale
    return (f"CAST(CASE WHEN ({whole}) <> 0 THEN {half_up(part, whole, 100 * f)} / {float(f)} END "
            f"AS DECIMAL({9 + scale},{scale}))")


def avg_sql(col: str, scale: int, col_scale: int = 2, precision: int = 22) -> str:
    """Exact avg of a non-negative decimal column, rounded half up once."""
    n = f"count({col})"
    s = f"CAST(round(sum({col}) * {10 ** col_scale}) AS HUGEINT)"
    return ratio_sql(s, n, scale, col_scale, precision)


def ratio_sql(num_int: str, den: str, scale: int, num_scale: int, precision: int = 22) -> str:
    """round((num_int / 10^num_scale) / den, scale) for non-negative integers."""
    f = 10 ** scale
    q = half_up(num_int, f"({den}) * {10 ** num_scale}", f)
    return (f"CAST(CASE WHEN ({den}) > 0 THEN CAST({q} AS DECIMAL(38,0)) / {f}.0 END "
            f"AS DECIMAL({precision},{scale}))")


RULE_CASE = """CASE
    WHEN coalesce(geo_flag, 0) = 1 THEN 'geo_impossible'
    WHEN coalesce(amount >= 500000.0, false) AND NOT coalesce(isnan(amount), false) THEN 'large_amount'
    WHEN coalesce(tx_count_5m, 0) >= 3 THEN 'rapid_fire'
    WHEN coalesce(hour(event_time), 12) IN (0, 1, 2, 3, 4) THEN 'odd_hour'
  END"""

CTES: dict[str, str] = {
    "ev": """SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "tx0": f"""SELECT CAST(event_id AS VARCHAR) AS transaction_id, event_id AS step,
    {_case('event_type', EVENT_TYPE_TO_TX_TYPE)} AS type,
    CAST(CAST(value AS DECIMAL(18,2)) * {AMOUNT_SCALE} AS DOUBLE) AS amount,
    'C' || CAST(user_id AS VARCHAR) AS nameOrig,
    CAST((k + 1) * 10000 AS DOUBLE) AS oldbalanceOrg,
    user_id AS _user, k AS _k,
    CAST(k * 500 AS DOUBLE) AS oldbalanceDest,
    CAST(ts AS TIMESTAMP) AS event_time
  FROM ev""",
    "txk": f"""SELECT transaction_id, step, type, amount, nameOrig, oldbalanceOrg,
    CASE WHEN type = 'CASH-IN' THEN oldbalanceOrg + amount ELSE oldbalanceOrg - amount END
      + CASE WHEN _k = {LEDGER_BREAK_K} THEN 1.0 ELSE 0.0 END AS newbalanceOrig,
    CASE WHEN _k = {SELF_TRANSFER_K} THEN nameOrig
         ELSE 'C' || CAST((_user * 7 + 1) % {DEST_MODULUS} AS VARCHAR) END AS nameDest,
    oldbalanceDest,
    CASE WHEN type = 'TRANSFER' THEN oldbalanceDest + amount ELSE oldbalanceDest END AS newbalanceDest,
    'Z' || CAST(_k % {ZONES} AS VARCHAR) AS location,
    CASE WHEN {_case('_k', ANOMALY_BY_K)} IS NULL THEN 0 ELSE 1 END AS isFraud,
    0 AS isFlaggedFraud,
    {_case('_k', ANOMALY_BY_K)} AS anomaly_type,
    event_time,
    event_time + to_seconds(_k) AS ingestion_time,
    _k
  FROM tx0""",
    "tx": """SELECT * EXCLUDE (_k) FROM txk""",
    "txd": """SELECT *, strftime(event_time, '%Y-%m-%d') AS dt FROM tx""",
    "acct_stats": """SELECT nameOrig, dt, count(*) AS tx_count_5m, sum(amount) AS total_amount_5m,
    max(amount) AS max_amount_5m FROM txd GROUP BY nameOrig, dt""",
    "enriched": """SELECT t.*, s.tx_count_5m, s.total_amount_5m, s.max_amount_5m,
    CAST(t.anomaly_type = 'geo_impossible' AS INTEGER) AS geo_flag
  FROM txd t LEFT JOIN acct_stats s ON t.nameOrig = s.nameOrig AND t.dt IS NOT DISTINCT FROM s.dt""",
    "scored": f"""SELECT *, {RULE_CASE} AS rule_name, ({RULE_CASE}) IS NOT NULL AS is_fraud_detected
  FROM enriched""",
    "serving": """SELECT transaction_id, event_time, type AS tx_type, CAST(amount AS DECIMAL(18,2)) AS amount,
    nameOrig AS origin_account, nameDest AS dest_account, rule_name,
    CAST(tx_count_5m AS BIGINT) AS tx_count_5m,
    CAST(total_amount_5m AS DECIMAL(18,2)) AS total_amount_5m,
    CAST(max_amount_5m AS DECIMAL(18,2)) AS max_amount_5m,
    CAST(coalesce(geo_flag, 0) AS SMALLINT) AS geo_impossible,
    ingestion_time AS detected_at
  FROM scored WHERE is_fraud_detected""",
    "stg_flagged": """SELECT transaction_id, origin_account, dest_account, event_time,
    CAST(event_time AS DATE) AS event_date, detected_at, tx_type, amount, rule_name,
    coalesce(tx_count_5m, 0) AS tx_count_5m,
    coalesce(total_amount_5m, 0) AS total_amount_5m,
    coalesce(max_amount_5m, 0) AS max_amount_5m,
    coalesce(geo_impossible, 0) AS geo_impossible
  FROM serving""",
    "rates": f"""SELECT rate_date,
    CAST({RATE_BASE} + {RATE_STEP} * dayofmonth(rate_date) AS DECIMAL(10,4)) AS usd_lkr_rate,
    'derived:events' AS source_url, CAST(rate_date AS TIMESTAMP) AS loaded_at
  FROM (SELECT DISTINCT CAST(ts AS DATE) AS rate_date FROM events)""",
    "latest_rate": """SELECT usd_lkr_rate, rate_date FROM rates ORDER BY rate_date DESC LIMIT 1""",
}

ORACLE: dict[str, str] = {}


def _needed(sql: str) -> list[str]:
    """CTE names referenced by `sql`, transitively, in definition order."""
    names = list(CTES)
    seen: set[str] = set()

    def visit(text: str):
        for n in names:
            if n not in seen and re.search(rf"\b{n}\b", text):
                seen.add(n)
                visit(CTES[n])
    visit(sql)
    return [n for n in names if n in seen]


def statement(final_select: str) -> str:
    need = _needed(final_select)
    if not need:
        return final_select
    body = ",\n".join(f"{n} AS (\n  {CTES[n]}\n)" for n in need)
    rest = final_select.lstrip()
    if rest[:4].upper() == "WITH":
        return f"WITH {body},\n{rest[4:].lstrip()}"
    return f"WITH {body}\n{final_select}"


def oracle(name: str, final_select: str) -> None:
    ORACLE[name] = statement(final_select)


def ts_sql(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}"


# ---------------------------------------------------------------- scoring core

oracle("flags_by_rule", f"""
SELECT rule_name, {describe_sql('rule_name')} AS rule_description, n_events,
       {pct_sql('n_events', 'total')} AS share_pct
FROM (SELECT rule_name, count(*) AS n_events, sum(count(*)) OVER () AS total
      FROM scored GROUP BY rule_name) g""")

oracle("account_stats", """SELECT * FROM acct_stats""")

oracle("score_transactions", """
SELECT transaction_id, nameOrig, dt, tx_count_5m, total_amount_5m, max_amount_5m, geo_flag,
       rule_name, is_fraud_detected FROM scored""")

oracle("flagged_transactions", f"""
SELECT transaction_id, tx_type, amount, origin_account, dest_account, rule_name, tx_count_5m,
       total_amount_5m, max_amount_5m, geo_impossible, {ts_sql('event_time')}, {ts_sql('detected_at')}
FROM serving""")

oracle("rule_matches", """
SELECT transaction_id, array_to_string(m, ',') AS matched_rules, CAST(len(m) AS INTEGER) AS n_matched
FROM (SELECT transaction_id, list_filter([
        CASE WHEN coalesce(geo_flag, 0) = 1 THEN 'geo_impossible' END,
        CASE WHEN coalesce(amount >= 500000.0, false) AND NOT coalesce(isnan(amount), false)
             THEN 'large_amount' END,
        CASE WHEN coalesce(tx_count_5m, 0) >= 3 THEN 'rapid_fire' END,
        CASE WHEN coalesce(hour(event_time), 12) IN (0, 1, 2, 3, 4) THEN 'odd_hour' END],
        lambda x: x IS NOT NULL) AS m
      FROM enriched) r""")


# ---------------------------------------------------------------- warehouse

CTES.update({
    "loans": """SELECT 'L' || CAST(o_orderkey AS VARCHAR) AS loan_id,
    CAST(18 + o_custkey % 50 AS SMALLINT) AS person_age,
    CAST(greatest(CAST(c_acctbal AS DECIMAL(14,2)) * 10, 0) AS DECIMAL(14,2)) AS person_income,
    CAST(o_totalprice AS DECIMAL(14,2)) AS loan_amnt,
    CAST(CAST(o_orderkey % 2000 AS DECIMAL(6,0)) / 100 AS DECIMAL(6,3)) AS loan_int_rate,
    lower(substring(c_mktsegment, 1, 1)) AS loan_grade,
    o_orderpriority AS loan_intent,
    CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS SMALLINT) AS loan_status,
    CASE WHEN o_orderstatus = 'P' THEN 'Y' ELSE 'N' END AS cb_person_default_on_file
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "stg_loans": """SELECT loan_id, coalesce(person_age, 0) AS person_age,
    coalesce(person_income, 0) AS person_income, coalesce(loan_amnt, 0) AS loan_amnt,
    coalesce(loan_int_rate, 0) AS loan_int_rate, upper(loan_grade) AS loan_grade, loan_intent,
    loan_status, CASE WHEN loan_status = 1 THEN 'Default' ELSE 'Performing' END AS loan_status_label,
    cb_person_default_on_file
  FROM loans""",
    "dim_account": f"""SELECT md5(origin_account) AS account_key, origin_account AS account_id,
    count(*) AS total_flags, CAST(sum(amount) AS DECIMAL(28,2)) AS total_flagged_amount,
    {avg_sql('amount', 6)} AS avg_flagged_amount,
    max(amount) AS max_single_flagged_amount,
    min(event_time) AS first_seen_at, max(event_time) AS last_seen_at,
    mode(rule_name ORDER BY rule_name) AS most_common_rule,
    count(DISTINCT rule_name) AS distinct_rules_triggered
  FROM stg_flagged GROUP BY origin_account""",
    "dim_date": """SELECT CAST(strftime(calendar_date, '%Y%m%d') AS INTEGER) AS date_key,
    calendar_date AS full_date, year(calendar_date) AS year, month(calendar_date) AS month,
    day(calendar_date) AS day, dayofweek(calendar_date) AS day_of_week,
    dayname(calendar_date) AS day_name, monthname(calendar_date) AS month_name,
    quarter(calendar_date) AS quarter, weekofyear(calendar_date) AS week_of_year,
    dayofweek(calendar_date) IN (0, 6) AS is_weekend,
    strftime(calendar_date, '%Y-%m') AS year_month
  FROM (SELECT DISTINCT event_date AS calendar_date FROM stg_flagged) d""",
    "dim_rule": f"""SELECT md5(rule_name) AS rule_key, rule_name, {describe_sql('rule_name')} AS rule_description
  FROM (SELECT DISTINCT rule_name FROM stg_flagged WHERE rule_name IS NOT NULL) r""",
    "fact": """SELECT f.transaction_id, CAST(strftime(f.event_date, '%Y%m%d') AS INTEGER) AS date_key,
    md5(f.origin_account) AS account_key, md5(f.rule_name) AS rule_key,
    f.tx_type, f.rule_name, f.origin_account, f.dest_account, f.amount AS amount_usd,
    CAST(round(f.amount * r.usd_lkr_rate, 2) AS DECIMAL(28,2)) AS amount_lkr,
    f.tx_count_5m, f.total_amount_5m, f.max_amount_5m, f.geo_impossible,
    f.event_time, f.event_date, f.detected_at
  FROM stg_flagged f CROSS JOIN latest_rate r""",
    "mart": f"""SELECT l.loan_grade, l.loan_intent, count(*) AS total_loans,
    CAST(sum(l.loan_status) AS BIGINT) AS total_defaults,
    {pct_sql('sum(l.loan_status)', 'count(*)')} AS default_rate_pct,
    {avg_sql('l.loan_amnt', 2, 2, 18)} AS avg_loan_amnt_usd,
    {ratio_sql('CAST(round(sum(l.loan_amnt) * r.usd_lkr_rate * 1000000) AS HUGEINT)', 'count(l.loan_amnt)', 2, 6, 18)}
      AS avg_loan_amnt_lkr,
    {avg_sql('l.loan_int_rate', 3, 3, 10)} AS avg_interest_rate,
    {avg_sql('l.person_income', 2, 2, 18)} AS avg_person_income,
    r.usd_lkr_rate
  FROM stg_loans l CROSS JOIN latest_rate r
  GROUP BY l.loan_grade, l.loan_intent, r.usd_lkr_rate""",
    "daily": """SELECT d.summary_date,
    CAST(coalesce(a.total_txns, 0) AS BIGINT) AS total_txns,
    CAST(coalesce(a.flagged_count, 0) AS BIGINT) AS flagged_count,
    CAST(coalesce(a.total_amount, 0) AS DECIMAL(20,2)) AS total_amount,
    CAST(coalesce(a.flagged_amount, 0) AS DECIMAL(20,2)) AS flagged_amount,
    a.top_rule
  FROM (SELECT CAST(unnest(generate_series(min(CAST(dt AS DATE)) - 1, max(CAST(dt AS DATE)) + 1,
                INTERVAL 1 DAY)) AS DATE) AS summary_date FROM scored) d
  LEFT JOIN (SELECT CAST(dt AS DATE) AS summary_date, count(*) AS total_txns,
               count(*) FILTER (WHERE is_fraud_detected) AS flagged_count,
               coalesce(sum(amount) FILTER (WHERE NOT isnan(amount)), 0) AS total_amount,
               coalesce(sum(amount) FILTER (WHERE is_fraud_detected AND NOT isnan(amount)), 0)
                 AS flagged_amount,
               mode(rule_name ORDER BY rule_name) FILTER (WHERE is_fraud_detected) AS top_rule
             FROM scored WHERE dt IS NOT NULL GROUP BY 1) a
  ON d.summary_date = a.summary_date""",
})


def _ts_all(cols: str) -> str:
    return ", ".join(ts_sql(c.strip()) for c in cols.split(","))


oracle("stg_flagged", f"""
SELECT * EXCLUDE (event_time, detected_at), {_ts_all('event_time, detected_at')} FROM stg_flagged""")

oracle("stg_rates", f"""SELECT rate_date, usd_lkr_rate, source_url, {ts_sql('loaded_at')} FROM rates""")

oracle("stg_loans", """SELECT * FROM stg_loans""")

oracle("dim_account", f"""
SELECT * EXCLUDE (first_seen_at, last_seen_at), {_ts_all('first_seen_at, last_seen_at')} FROM dim_account""")

oracle("dim_date", """SELECT * FROM dim_date""")

oracle("dim_rule", """SELECT * FROM dim_rule""")

oracle("latest_rate", """SELECT usd_lkr_rate, rate_date FROM latest_rate""")

oracle("fact_fraud_events", f"""
SELECT * EXCLUDE (event_time, detected_at), {_ts_all('event_time, detected_at')} FROM fact""")

oracle("star_view", """
SELECT f.transaction_id, f.date_key, d.year_month, d.is_weekend, f.account_key, a.total_flags,
       a.most_common_rule, f.rule_key, r.rule_description, f.amount_lkr
FROM fact f LEFT JOIN dim_date d ON f.date_key = d.date_key
LEFT JOIN dim_account a ON f.account_key = a.account_key
LEFT JOIN dim_rule r ON f.rule_key = r.rule_key""")

oracle("mart_loan_risk", """SELECT * FROM mart""")

oracle("amount_lkr_asof", """
SELECT s.transaction_id, s.event_date, r.usd_lkr_rate AS rate_asof,
       CAST(round(s.amount * r.usd_lkr_rate, 2) AS DECIMAL(28,2)) AS amount_lkr_asof
FROM stg_flagged s ASOF LEFT JOIN (
  SELECT rate_date, usd_lkr_rate FROM rates WHERE dayofmonth(rate_date) % 3 <> 0
  UNION ALL SELECT DATE '9999-12-31', max(usd_lkr_rate) FROM rates) r ON s.event_date >= r.rate_date""")

oracle("daily_summary", """SELECT * FROM daily""")

oracle("stg_daily_summary", f"""
SELECT summary_date, total_txns, flagged_count, total_amount, flagged_amount, top_rule,
       CASE WHEN total_txns = 0 THEN CAST(0 AS DECIMAL(11,2))
            ELSE {pct_sql('flagged_count', 'total_txns')} END AS fraud_rate_pct
FROM daily""")

oracle("flags_per_day", """
SELECT d.full_date, g.n_flags
FROM (SELECT date_key, count(*) AS n_flags FROM fact GROUP BY date_key) g
LEFT JOIN dim_date d ON g.date_key = d.date_key""")

oracle("top_risk_accounts", """
SELECT account_id, total_flags, total_flagged_amount, most_common_rule, distinct_rules_triggered
FROM dim_account ORDER BY total_flags DESC, total_flagged_amount DESC, account_id ASC NULLS LAST
LIMIT 10""")

oracle("default_rate_by_grade", f"""
SELECT loan_grade, CAST(sum(total_loans) AS BIGINT) AS total_loans,
       CAST(sum(total_defaults) AS BIGINT) AS total_defaults,
       {pct_sql('sum(total_defaults)', 'sum(total_loans)')} AS default_rate_pct
FROM mart GROUP BY loan_grade""")

oracle("rate_trend", """
SELECT rate_date, usd_lkr_rate, lag(usd_lkr_rate) OVER (ORDER BY rate_date) AS prev_rate,
       CAST(usd_lkr_rate - lag(usd_lkr_rate) OVER (ORDER BY rate_date) AS DECIMAL(11,4)) AS rate_change
FROM rates""")

oracle("weekend_vs_weekday", """
SELECT d.year_month, d.is_weekend, CAST(sum(g.n) AS BIGINT) AS n_flags
FROM (SELECT date_key, count(*) AS n FROM fact GROUP BY date_key) g
LEFT JOIN dim_date d ON g.date_key = d.date_key GROUP BY d.year_month, d.is_weekend""")


# ---------------------------------------------------------------- data quality

CTES.update({
    "stg_daily": f"""SELECT *, CASE WHEN total_txns = 0 THEN CAST(0 AS DECIMAL(11,2))
    ELSE {pct_sql('flagged_count', 'total_txns')} END AS fraud_rate_pct FROM daily""",
})

_CHECK_TABLES = {
    "flagged_transactions": "serving", "daily_fraud_summary": "daily", "kaggle_loans": "loans",
    "cbsl_exchange_rates": "rates", "stg_flagged_transactions": "stg_flagged",
    "stg_daily_fraud_summary": "stg_daily", "stg_kaggle_loans": "stg_loans",
    "stg_cbsl_exchange_rates": "rates", "dim_date": "dim_date", "dim_account": "dim_account",
    "dim_rule": "dim_rule", "fact_fraud_events": "fact", "mart_loan_risk": "mart",
    "transactions": "tx",
}


def _check_sql(c) -> str:
    t, col = _CHECK_TABLES[c.table], c.column
    if c.test == "not_null":
        f = f"SELECT count(*) FILTER (WHERE {col} IS NULL) AS f FROM {t}"
    elif c.test == "unique":
        f = (f"SELECT count(*) AS f FROM (SELECT {col} FROM {t} WHERE {col} IS NOT NULL "
             f"GROUP BY {col} HAVING count(*) > 1) d")
    elif c.test == "accepted_values":
        vals = ", ".join(repr(v) for v in c.values)
        f = f"SELECT count(DISTINCT {col}) FILTER (WHERE {col} IS NOT NULL AND {col} NOT IN ({vals})) AS f FROM {t}"
    else:
        p = _CHECK_TABLES[c.to]
        f = (f"SELECT count(*) AS f FROM {t} x WHERE x.{col} IS NOT NULL AND NOT EXISTS "
             f"(SELECT 1 FROM {p} y WHERE y.{c.field} = x.{col})")
    return (f"SELECT '{c.table}' AS table_name, '{c.column}' AS column_name, '{c.test}' AS test_name, "
            f"CAST(f AS BIGINT) AS failures FROM ({f}) q")


def _quality_sql() -> str:
    from vigil.operators.quality import WAREHOUSE_CHECKS
    return "\nUNION ALL\n".join(_check_sql(c) for c in WAREHOUSE_CHECKS)


oracle("quality_suite", _quality_sql())


# ---------------------------------------------------------------- profiles and checks

oracle("type_distribution", f"""
SELECT type, n, {pct_sql('n', 'total')} AS share_pct
FROM (SELECT type, count(*) AS n, sum(count(*)) OVER () AS total FROM tx GROUP BY type) g""")

oracle("amount_profile", """
SELECT g.type, round(g.rows / t.total, 4) AS weight, round(g.amount_mean, 4) AS amount_mean,
       round(g.amount_std, 4) AS amount_std, round(g.amount_min, 4) AS amount_min,
       round(g.amount_max, 4) AS amount_max,
       round(ln(greatest(g.amount_mean, 1.0)), 4) AS log_mean,
       round(greatest(ln(1 + g.amount_std / greatest(g.amount_mean, 1.0)), 0.1), 4) AS log_std
FROM (SELECT type, count(*) AS rows,
             avg(amount) FILTER (WHERE NOT isnan(amount)) AS amount_mean,
             stddev_samp(amount) FILTER (WHERE NOT isnan(amount)) AS amount_std,
             quantile_cont(amount, 0.01) FILTER (WHERE NOT isnan(amount)) AS amount_min,
             quantile_cont(amount, 0.99) FILTER (WHERE NOT isnan(amount)) AS amount_max
      FROM tx GROUP BY type) g,
     (SELECT count(*) AS total FROM tx) t""")

oracle("balance_profile", """
SELECT round(quantile_cont(oldbalanceOrg, 0.05), 4) AS balance_p5,
       round(quantile_cont(oldbalanceOrg, 0.95), 4) AS balance_p95,
       round(avg(oldbalanceOrg), 4) AS balance_mean, round(stddev_samp(oldbalanceOrg), 4) AS balance_std,
       round(ln(greatest(avg(oldbalanceOrg), 1.0)), 4) AS log_mean,
       round(greatest(ln(1 + stddev_samp(oldbalanceOrg) / greatest(avg(oldbalanceOrg), 1.0)), 0.3), 4)
         AS log_std
FROM tx WHERE oldbalanceOrg > 0""")

oracle("ledger_check", """
SELECT * FROM (
  SELECT transaction_id, type, amount,
    round(round(newbalanceOrig, 2) - round(CASE WHEN type = 'CASH-IN' THEN oldbalanceOrg + amount
                                                ELSE oldbalanceOrg - amount END, 2), 2) AS orig_diff,
    round(round(newbalanceDest, 2) - round(CASE WHEN type = 'TRANSFER' THEN oldbalanceDest + amount
                                                ELSE oldbalanceDest END, 2), 2) AS dest_diff
  FROM tx) d
WHERE abs(orig_diff) > 0.005 OR abs(dest_diff) > 0.005""")

oracle("self_transfers", """SELECT transaction_id, nameOrig, amount FROM tx WHERE nameOrig = nameDest""")

oracle("burst_profile", f"""
WITH g AS (
  SELECT *, (epoch_us(event_time) - epoch_us(lag(event_time) OVER w)) / 1e6 AS gap_seconds
  FROM tx WHERE nameOrig IS NOT NULL AND event_time IS NOT NULL
  WINDOW w AS (PARTITION BY nameOrig ORDER BY event_time, transaction_id)),
i AS (
  SELECT *, sum(CASE WHEN gap_seconds IS NULL OR gap_seconds > 3600.0 THEN 1 ELSE 0 END)
            OVER (PARTITION BY nameOrig ORDER BY event_time, transaction_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
  FROM g)
SELECT nameOrig, island, count(*) AS n_events, {ts_sql('min(event_time)').replace(' AS min(event_time)', ' AS burst_start')},
       {ts_sql('max(event_time)').replace(' AS max(event_time)', ' AS burst_end')},
       max(CASE WHEN gap_seconds <= 3600.0 THEN gap_seconds END) AS max_gap_seconds
FROM i GROUP BY nameOrig, island HAVING count(*) >= 3""")

oracle("detection_confusion", """SELECT anomaly_type, rule_name, count(*) AS n FROM scored GROUP BY 1, 2""")

oracle("detection_quality", f"""
SELECT name, labelled, flagged, true_positive,
       {pct_sql('true_positive', 'flagged')} AS precision_pct,
       {pct_sql('true_positive', 'labelled')} AS recall_pct
FROM (SELECT name, CAST(sum(a) AS BIGINT) AS labelled, CAST(sum(p) AS BIGINT) AS flagged,
             CAST(sum(tp) AS BIGINT) AS true_positive
      FROM (SELECT anomaly_type AS name, 1 AS a, 0 AS p,
                   CASE WHEN anomaly_type = rule_name THEN 1 ELSE 0 END AS tp FROM scored
            UNION ALL
            SELECT rule_name AS name, 0 AS a, 1 AS p, 0 AS tp FROM scored) u
      WHERE name IS NOT NULL GROUP BY name) g""")


# ---------------------------------------------------------------- intent operators

oracle("trailing_stats", """
SELECT transaction_id, nameOrig,
  count(amount) OVER w AS trail_count, sum(amount) OVER w AS trail_sum, max(amount) OVER w AS trail_max
FROM tx
WINDOW w AS (PARTITION BY nameOrig ORDER BY event_time
             RANGE BETWEEN INTERVAL 21600 SECONDS PRECEDING AND CURRENT ROW)""")

oracle("relative_amount", """
SELECT transaction_id, nameOrig, amount, prior_count, prior_amount_sum FROM (
  SELECT *, count(amount) OVER w AS prior_count, coalesce(sum(amount) OVER w, 0) AS prior_amount_sum
  FROM tx
  WINDOW w AS (PARTITION BY nameOrig ORDER BY event_time, transaction_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) h
WHERE prior_count > 0 AND amount * prior_count > 10.0 * prior_amount_sum""")

oracle("previous_event", f"""
SELECT transaction_id, lag(location) OVER w AS prev_location,
       strftime(lag(event_time) OVER w, '%Y-%m-%d %H:%M:%S.%f') AS prev_event_time
FROM tx WINDOW w AS (PARTITION BY nameOrig ORDER BY event_time, transaction_id)""")

oracle("impossible_travel", """
SELECT transaction_id, nameOrig, location, prev_location,
       (epoch_us(event_time) - epoch_us(prev_time)) / 1e6 AS gap_seconds
FROM (SELECT *, lag(location) OVER w AS prev_location, lag(event_time) OVER w AS prev_time
      FROM tx WINDOW w AS (PARTITION BY nameOrig ORDER BY event_time, transaction_id)) p
WHERE (epoch_us(event_time) - epoch_us(prev_time)) / 1e6 <= 3600 AND location <> prev_location""")

oracle("dedup_transactions", f"""
SELECT transaction_id, step, amount, {ts_sql('ingestion_time')} FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY ingestion_time, step) AS rn
  FROM (SELECT transaction_id, step, amount, ingestion_time FROM txk
        UNION ALL
        SELECT transaction_id, step + 1000000000, amount, ingestion_time + INTERVAL 1 HOUR
        FROM txk WHERE _k IN (7, 8)) u) r
WHERE rn = 1""")

oracle("window_stats", """
SELECT strftime(make_timestamp(b * 21600000000), '%Y-%m-%d %H:%M:%S.%f') AS window_start,
       strftime(make_timestamp((b + 1) * 21600000000), '%Y-%m-%d %H:%M:%S.%f') AS window_end,
       nameOrig, count(*) AS tx_count, sum(amount) AS total_amount, max(amount) AS max_amount
FROM (SELECT *, epoch_us(event_time) // 21600000000 AS b FROM tx) t
GROUP BY b, nameOrig""")


# ---------------------------------------------------------------- sources and sinks

_wire = ["transaction_id", "step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig",
         "nameDest", "oldbalanceDest", "newbalanceDest", "location", "isFraud", "isFlaggedFraud",
         "anomaly_type"]
_broken = f"coalesce(_k = {BROKEN_JSON_K}, false)"

oracle("parse_transactions", "SELECT " + ", ".join(
    [f"CASE WHEN {_broken} THEN NULL ELSE {c} END AS {c}" for c in _wire]
    + [f"CASE WHEN {_broken} THEN NULL ELSE strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') END AS event_time",
       f"CASE WHEN {_broken} THEN NULL ELSE strftime(ingestion_time, '%Y-%m-%d %H:%M:%S.%f') END "
       "AS ingestion_time",
       f"{_broken} AS is_corrupt"]) + " FROM txk")

oracle("encode_events", "SELECT transaction_id AS key, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, "
       + ", ".join(c for c in _wire if c != "isFlaggedFraud") + " FROM tx")

# a broken message is cut after 40 characters; the others are set aside for an amount of 1e17
oracle("quarantined_events", f"""SELECT transaction_id, CASE WHEN {_broken} THEN 'corrupt' ELSE 'amount' END AS reason,
       CASE WHEN {_broken} THEN 40 END AS message_length
FROM txk WHERE {_broken} OR step % 10 = 0""")

oracle("raw_mirror", f"""
SELECT transaction_id, type AS tx_type, CAST(amount AS DECIMAL(18,2)) AS amount, nameOrig AS origin_account,
  CAST(oldbalanceOrg AS DECIMAL(18,2)) AS old_balance_orig, CAST(newbalanceOrig AS DECIMAL(18,2)) AS new_balance_orig,
  nameDest AS dest_account, CAST(oldbalanceDest AS DECIMAL(18,2)) AS old_balance_dest,
  CAST(newbalanceDest AS DECIMAL(18,2)) AS new_balance_dest, location,
  CAST(coalesce(isFraud, 0) AS SMALLINT) AS is_fraud, anomaly_type,
  {ts_sql('event_time')}, {ts_sql('ingestion_time')}
FROM tx""")

oracle("upsert_loans", """
WITH src AS (
  SELECT loan_id, person_age + 1 AS person_age, person_income, loan_amnt + 200 AS loan_amnt, loan_int_rate,
         loan_grade, loan_intent, loan_status, cb_person_default_on_file
  FROM loans WHERE cb_person_default_on_file = 'Y'
  UNION ALL
  SELECT 'N' || loan_id, person_age + 1, person_income, loan_amnt, loan_int_rate, loan_grade, loan_intent,
         loan_status, cb_person_default_on_file
  FROM loans WHERE cb_person_default_on_file = 'Y')
SELECT coalesce(s.loan_id, t.loan_id) AS loan_id,
  CAST(CASE WHEN t.loan_id IS NOT NULL THEN t.person_age ELSE s.person_age END AS SMALLINT) AS person_age,
  CAST(CASE WHEN s.loan_id IS NOT NULL THEN s.person_income ELSE t.person_income END AS DECIMAL(14,2)) AS person_income,
  CAST(CASE WHEN s.loan_id IS NOT NULL THEN s.loan_amnt ELSE t.loan_amnt END AS DECIMAL(14,2)) AS loan_amnt,
  CAST(CASE WHEN s.loan_id IS NOT NULL THEN s.loan_int_rate ELSE t.loan_int_rate END AS DECIMAL(6,3)) AS loan_int_rate,
  CASE WHEN s.loan_id IS NOT NULL THEN s.loan_grade ELSE t.loan_grade END AS loan_grade,
  CASE WHEN s.loan_id IS NOT NULL THEN s.loan_intent ELSE t.loan_intent END AS loan_intent,
  CAST(CASE WHEN s.loan_id IS NOT NULL THEN s.loan_status ELSE t.loan_status END AS SMALLINT) AS loan_status,
  CASE WHEN t.loan_id IS NOT NULL THEN t.cb_person_default_on_file ELSE s.cb_person_default_on_file END
    AS cb_person_default_on_file
FROM loans t FULL OUTER JOIN src s ON t.loan_id = s.loan_id""")


def _transaction_checks_sql() -> str:
    from vigil.operators.quality import TRANSACTION_CHECKS
    return "\nUNION ALL\n".join(_check_sql(c) for c in TRANSACTION_CHECKS)


oracle("transaction_checks", _transaction_checks_sql())

oracle("loans_csv", """
SELECT loan_id,
  CASE WHEN loan_intent = '5-LOW' THEN NULL ELSE person_age END AS person_age,
  CAST(CAST(person_income AS VARCHAR) AS DOUBLE) AS person_income,
  CAST(CAST(loan_amnt AS VARCHAR) AS DOUBLE) AS loan_amnt,
  CAST(CAST(loan_int_rate AS VARCHAR) AS DOUBLE) AS loan_int_rate,
  loan_grade, loan_intent,
  CASE WHEN cb_person_default_on_file = 'Y' AND loan_intent = '4-NOT SPECIFIED' THEN NULL
       ELSE loan_status END AS loan_status,
  cb_person_default_on_file
FROM loans WHERE NOT (cb_person_default_on_file = 'Y' AND loan_intent = '1-URGENT')""")

oracle("rate_payloads", """
SELECT rate_date,
  CASE WHEN dayofmonth(rate_date) IN (13, 21) THEN CAST(300.0 AS DECIMAL(10,4)) ELSE usd_lkr_rate END
    AS usd_lkr_rate,
  CASE WHEN dayofmonth(rate_date) IN (13, 21) THEN 'fallback' ELSE source_url END AS source_url
FROM rates""")

CTES.update({
    "trail5": """SELECT *, CAST(anomaly_type = 'geo_impossible' AS INTEGER) AS geo_flag,
    count(amount) OVER w AS tx_count_5m, sum(amount) OVER w AS total_amount_5m, max(amount) OVER w AS max_amount_5m
  FROM tx WINDOW w AS (PARTITION BY nameOrig ORDER BY event_time
                       RANGE BETWEEN INTERVAL 300 SECONDS PRECEDING AND CURRENT ROW)""",
})

oracle("score_trailing", f"""
SELECT transaction_id, tx_count_5m, total_amount_5m, max_amount_5m, {RULE_CASE} AS rule_name FROM trail5""")

oracle("sliding_window_stats", """
SELECT strftime(make_timestamp(s * 3600000000), '%Y-%m-%d %H:%M:%S.%f') AS window_start,
       strftime(make_timestamp((s + 6) * 3600000000), '%Y-%m-%d %H:%M:%S.%f') AS window_end,
       nameOrig, count(*) AS tx_count, sum(amount) AS total_amount, max(amount) AS max_amount
FROM (SELECT *, epoch_us(event_time) // 3600000000 - unnest(range(0, 6)) AS s FROM tx) t
GROUP BY s, nameOrig""")


# ---------------------------------------------------------------- written and read back

oracle("lake_days", """SELECT strftime(event_time, '%Y-%m-%d') AS dt, count(*) AS n, sum(amount) AS amount,
       count(rule_name) AS flagged FROM scored GROUP BY 1""")
oracle("flagged_store", "SELECT transaction_id, origin_account, amount, rule_name, tx_count_5m FROM serving")
oracle("rates_upsert", "SELECT rate_date, CAST(usd_lkr_rate + 1 AS DECIMAL(10,4)) AS usd_lkr_rate, source_url FROM rates")
oracle("snapshot", "SELECT type, count(*) AS n, sum(amount + 1) AS amount FROM tx GROUP BY type")
oracle("stream_unique", "SELECT transaction_id, amount FROM tx")
# an event counts those of its account that come before it, by time and then id, within the window
oracle("stream_alerts", """SELECT a.transaction_id, a.nameOrig FROM tx a JOIN tx b ON a.nameOrig = b.nameOrig
  AND b.event_time BETWEEN a.event_time - INTERVAL 6 HOUR AND a.event_time
  AND (b.event_time < a.event_time OR b.transaction_id <= a.transaction_id)
GROUP BY ALL HAVING count(*) >= 3""")


# ---------------------------------------------------------------- the detector, run over files

# messages by delivery: broken ones, those raised beyond the serving table, late ones, the rest scored by batch and account
CTES["msg"] = f"""SELECT *, CAST(step % 2 AS INTEGER) AS batch_id,
    CASE WHEN {_broken} THEN 'corrupt' WHEN step % 10 = 0 THEN 'amount' END AS reason FROM txk"""
CTES["newest"] = """SELECT max(event_time) - INTERVAL 3 DAY AS wm FROM msg WHERE batch_id = 0 AND reason IS NULL"""
CTES["ontime"] = """SELECT * FROM msg, newest WHERE reason IS NULL AND (batch_id = 0 OR event_time >= wm)"""
CTES["latemsg"] = """SELECT *, (epoch_us(wm) - epoch_us(event_time)) / 1e6 AS lag_seconds FROM msg, newest
  WHERE reason IS NULL AND batch_id = 1 AND event_time < wm"""
CTES["detected"] = f"""SELECT *, {RULE_CASE} AS rule_name FROM (
    SELECT *, count(*) OVER w AS tx_count_5m, CAST(anomaly_type = 'geo_impossible' AS INTEGER) AS geo_flag
    FROM ontime WINDOW w AS (PARTITION BY batch_id, nameOrig))"""

oracle("detector_stores", """
SELECT 'lake' AS store, batch_id, strftime(event_time, '%Y-%m-%d') AS detail, count(*) AS n, sum(amount) AS amount,
       CAST(NULL AS DOUBLE) AS largest_lag FROM detected GROUP BY ALL
UNION ALL SELECT 'flagged', batch_id, rule_name, count(*), sum(amount), NULL FROM detected WHERE rule_name IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'late', batch_id, strftime(event_time, '%Y-%m-%d'), count(*), sum(amount), max(lag_seconds) FROM latemsg
  GROUP BY batch_id, strftime(event_time, '%Y-%m-%d')
UNION ALL SELECT 'quarantine', batch_id, reason, count(*), NULL, NULL FROM msg WHERE reason IS NOT NULL GROUP BY batch_id, reason""")
oracle("detector_metrics", """SELECT batch_id, count(*) AS rows, count(rule_name) AS flagged FROM detected GROUP BY batch_id""")

CTES["halves"] = f"""SELECT *, {RULE_CASE} AS rule_name FROM (
    SELECT *, CAST(step % 2 AS INTEGER) AS batch_id, count(*) OVER w AS tx_count_5m, sum(amount) OVER w AS total_amount_5m,
      CAST(anomaly_type = 'geo_impossible' AS INTEGER) AS geo_flag
    FROM tx WINDOW w AS (PARTITION BY step % 2, nameOrig))"""
oracle("replay_lake", """SELECT batch_id, rule_name, count(*) AS n, sum(total_amount_5m) AS total_amount_5m FROM halves GROUP BY batch_id, rule_name""")
oracle("lake_one_day", """SELECT strftime(event_time, '%Y-%m-%d') AS dt, batch_id, rule_name, count(*) AS n, sum(amount) AS amount
FROM halves WHERE CAST(event_time AS DATE) = (SELECT CAST(max(event_time) AS DATE) FROM tx) GROUP BY ALL""")
oracle("drifted_shards", """SELECT CASE WHEN step % 2 = 1 THEN location END AS location, count(*) AS n, sum(amount) AS amount FROM tx GROUP BY 1""")
oracle("seed_profile", """SELECT type, round(count(*) / (SELECT count(*) FROM tx), 9) AS weight, round(avg(amount), 4) AS amount_mean,
  round(quantile_cont(amount, 0.01), 4) AS amount_min, round(quantile_cont(amount, 0.99), 4) AS amount_max FROM tx GROUP BY type""")

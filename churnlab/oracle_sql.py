"""Independent SQL (DuckDB dialect) for the oracle check of each registered query.

The building blocks below restate the fixture, cleaning and feature rules in plain SQL; each
oracle is ``WITH <blocks> SELECT ...``. Nothing here is executed by the library itself.
"""

from __future__ import annotations

CUSTOMER_USAGE = """
li_agg AS (
  SELECT o.o_custkey AS k,
    SUM(CASE WHEN l_discount <= 0.085 AND l_returnflag='N' THEN l_quantity ELSE 0 END) AS day_m,
    SUM(CASE WHEN l_discount <= 0.085 AND l_returnflag='A' THEN l_quantity ELSE 0 END) AS eve_m,
    SUM(CASE WHEN l_discount <= 0.085 AND l_returnflag='R' THEN l_quantity ELSE 0 END) AS night_m,
    SUM(CASE WHEN l_discount >  0.085 THEN l_quantity ELSE 0 END) AS intl_m,
    SUM(CASE WHEN l_discount <= 0.085 AND l_returnflag='N' THEN 1 ELSE 0 END) AS day_c,
    SUM(CASE WHEN l_discount <= 0.085 AND l_returnflag='A' THEN 1 ELSE 0 END) AS eve_c,
    SUM(CASE WHEN l_discount <= 0.085 AND l_returnflag='R' THEN 1 ELSE 0 END) AS night_c,
    SUM(CASE WHEN l_discount >  0.085 THEN 1 ELSE 0 END) AS intl_c
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_custkey),
od_agg AS (
  SELECT o_custkey AS k, MIN(CAST(o_orderdate AS DATE)) AS first_d, MAX(CAST(o_orderdate AS DATE)) AS last_d,
    SUM(CASE WHEN o_orderpriority='1-URGENT' THEN 1 ELSE 0 END) AS urgent,
    SUM(CASE WHEN o_orderpriority='5-LOW' THEN 1 ELSE 0 END) AS low
  FROM orders GROUP BY o_custkey),
customer_usage AS (
  SELECT CAST(c.c_custkey AS BIGINT) AS customer_id, n.n_name AS state,
    CAST(date_diff('day', od.first_d, od.last_d) + 1 AS INTEGER) AS account_length,
    CAST(408 + c.c_custkey % 3 AS INTEGER) AS area_code,
    CASE WHEN c.c_mktsegment='BUILDING' THEN 'Yes' ELSE 'No' END AS international_plan,
    CASE WHEN c.c_acctbal > 6000 THEN 'Yes' ELSE 'No' END AS voice_mail_plan,
    CAST(CASE WHEN c.c_acctbal > 6000 THEN od.low ELSE 0 END AS BIGINT) AS number_vmail_messages,
    CAST(day_m AS DOUBLE) AS total_day_minutes, CAST(day_c AS BIGINT) AS total_day_calls,
    CAST(day_m AS DOUBLE)*0.17 AS total_day_charge,
    CAST(eve_m AS DOUBLE) AS total_eve_minutes, CAST(eve_c AS BIGINT) AS total_eve_calls,
    CAST(eve_m AS DOUBLE)*0.085 AS total_eve_charge,
    CAST(night_m AS DOUBLE) AS total_night_minutes, CAST(night_c AS BIGINT) AS total_night_calls,
    CAST(night_m AS DOUBLE)*0.045 AS total_night_charge,
    CAST(intl_m AS DOUBLE) AS total_intl_minutes, CAST(intl_c AS BIGINT) AS total_intl_calls,
    CAST(intl_m AS DOUBLE)*0.27 AS total_intl_charge,
    CAST(od.urgent AS BIGINT) AS customer_service_calls,
    od.last_d < DATE '2000-08-01' AS churn
  FROM customer c JOIN nation n ON n.n_nationkey=c.c_nationkey JOIN od_agg od ON od.k=c.c_custkey
  JOIN li_agg li ON li.k=c.c_custkey)"""

DIRTY = CUSTOMER_USAGE + """,
dirty_base AS (
  SELECT * REPLACE (
    CASE WHEN customer_id % 41 = 0 THEN NULL ELSE state END AS state,
    CASE WHEN customer_id % 43 = 0 THEN NULL ELSE voice_mail_plan END AS voice_mail_plan,
    CASE WHEN customer_id % 37 = 0 THEN NULL ELSE total_eve_minutes END AS total_eve_minutes)
  FROM customer_usage),
dirty AS (SELECT * FROM dirty_base UNION ALL SELECT * FROM dirty_base WHERE customer_id % 50 = 0)"""

# Cleaned table without one-hot columns: dedup on data columns (smallest id kept), encode plans
# and label. The base fixture holds no NULLs, so imputation is the identity here.
CLEANED = CUSTOMER_USAGE + """,
dedup AS (
  SELECT MIN(customer_id) AS customer_id, state, account_length, area_code, international_plan,
    voice_mail_plan, number_vmail_messages, total_day_minutes, total_day_calls, total_day_charge,
    total_eve_minutes, total_eve_calls, total_eve_charge, total_night_minutes, total_night_calls,
    total_night_charge, total_intl_minutes, total_intl_calls, total_intl_charge,
    customer_service_calls, churn
  FROM customer_usage
  GROUP BY ALL),
cleaned AS (
  SELECT customer_id, state, account_length,
    CASE WHEN international_plan = 'Yes' THEN 1 ELSE 0 END AS international_plan,
    CASE WHEN voice_mail_plan = 'Yes' THEN 1 ELSE 0 END AS voice_mail_plan,
    number_vmail_messages, total_day_minutes, total_day_calls, total_day_charge,
    total_eve_minutes, total_eve_calls, total_eve_charge, total_night_minutes, total_night_calls,
    total_night_charge, total_intl_minutes, total_intl_calls, total_intl_charge,
    customer_service_calls, CASE WHEN churn THEN 1 ELSE 0 END AS churn
  FROM dedup)"""

# Engineered features over ``cleaned`` (charges dropped; statistics fitted on the same frame).
FEATURES = CLEANED + """,
f1 AS (
  SELECT customer_id, state, account_length, international_plan, voice_mail_plan,
    number_vmail_messages, total_day_minutes, total_day_calls, total_eve_minutes, total_eve_calls,
    total_night_minutes, total_night_calls, total_intl_minutes, total_intl_calls,
    customer_service_calls, churn,
    CAST(account_length AS DOUBLE) / 30.0 AS customer_tenure_months,
    COALESCE(total_day_minutes,0)+COALESCE(total_eve_minutes,0)+COALESCE(total_night_minutes,0)
      +COALESCE(total_intl_minutes,0) AS tm_raw,
    CAST(COALESCE(total_day_calls,0)+COALESCE(total_eve_calls,0)+COALESCE(total_night_calls,0)
      +COALESCE(total_intl_calls,0) AS DOUBLE) AS tc_raw
  FROM cleaned),
f2 AS (
  SELECT *, tm_raw / (customer_tenure_months + 1) AS adu_raw, tc_raw / (customer_tenure_months + 1) AS cf_raw,
    total_intl_minutes / (tm_raw + 1) AS intl_usage_rate,
    CASE WHEN customer_service_calls > 3 THEN 1 ELSE 0 END AS high_service_calls,
    CASE WHEN number_vmail_messages > 0 THEN 1 ELSE 0 END AS has_vmail
  FROM f1),
f3 AS (
  SELECT * EXCLUDE (tm_raw, tc_raw, adu_raw, cf_raw),
    GREATEST(COALESCE(tm_raw,0),0) AS total_minutes, GREATEST(COALESCE(tc_raw,0),0) AS total_calls,
    GREATEST(COALESCE(adu_raw,0),0) AS avg_daily_usage, GREATEST(COALESCE(cf_raw,0),0) AS call_frequency
  FROM f2),
fstats AS (SELECT MAX(total_minutes) AS mx, quantile_cont(total_intl_minutes, 0.5) AS md FROM f3),
features AS (
  SELECT f3.*,
    ln(1 + total_minutes) AS log_total_minutes, ln(1 + total_calls) AS log_total_calls,
    ln(1 + avg_daily_usage) AS log_avg_daily_usage, ln(1 + call_frequency) AS log_call_frequency,
    total_minutes / (fstats.mx + 1) * customer_service_calls AS usage_service_interaction,
    CASE WHEN international_plan = 1 AND total_intl_minutes > fstats.md THEN 1 ELSE 0 END AS intl_plan_usage_flag,
    total_day_minutes / (total_minutes + 1) AS day_usage_ratio,
    customer_tenure_months * avg_daily_usage AS tenure_usage_score,
    customer_service_calls / (customer_tenure_months + 1) AS service_calls_per_month
  FROM f3, fstats)"""

STANDIN = "((customer_id * 7919) % 1000) / 1000.0"


def with_blocks(blocks: str, body: str) -> str:
    return f"WITH {blocks.strip()}\n{body.strip()}"

"""Registered queries beyond the first slice (imported lazily by ``registry``).

Naming: ``<operator>_<input>``; inputs are the fixture (``usage``), its cleaned form, its
engineered features, the dirty variant, or the drift / no-drift splits of FIXTURES.md.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from . import oracle_sql as O
from . import schema as S
from .functions import features as FE
from .functions.bins import sql_cut
from .operators import clean as C
from .operators import ordered as W
from .operators import profile as P
from .operators import stats as Q
from .registry import cleaned, features, register, usage
from .session import checkpoint
from .sources import fixture as FX

W_ = O.with_blocks

# Feature lists used by several queries (fixed).
NUM15 = [c for c in S.NUMERIC_INPUTS if c not in S.PLAN_COLS]
NUM17 = S.NUMERIC_INPUTS
DRIFT_FEATURES = ["account_length", "total_day_minutes", "total_eve_minutes", "total_night_minutes",
                  "total_intl_minutes", "customer_service_calls", "total_minutes", "total_calls",
                  "avg_daily_usage", "day_usage_ratio", "intl_usage_rate", "service_calls_per_month"]


def _r(c: str, d: int = 6):
    return F.round(F.col(c), d).alias(c)


def _dirty(spark, sf):
    """Dirty fixture variant, checkpointed once (cleaning reads it in several passes). It keeps
    its repeated rows: the cleaning queries are about them."""
    return checkpoint(FX.dirty_customer_usage(spark, sf))


# ================================================================ fixture variants, cleaning

@register("engineered_features", W_(O.FEATURES, f"""
  SELECT customer_id, {', '.join(f'ROUND({c}, 6) AS {c}' for c in S.ENGINEERED)} FROM features"""))
def q_engineered(spark, sf):
    return features(spark, sf).select(S.ID, *[_r(c) for c in S.ENGINEERED])


_DIRTY_COLS = [c for c in S.RAW_COLUMNS if c != S.ID]


@register("missing_profile_dirty", W_(O.DIRTY, f"""
  , w AS (SELECT COUNT(*) AS rows_, {', '.join(f'COUNT_IF({c} IS NULL) AS {c}' for c in _DIRTY_COLS)} FROM dirty)
  SELECT feature AS "column", CAST(missing AS BIGINT) AS missing, ROUND(missing * 100.0 / rows_, 6) AS missing_pct
  FROM (UNPIVOT w ON {', '.join(_DIRTY_COLS)} INTO NAME feature VALUE missing) WHERE missing > 0"""))
def q_missing_profile(spark, sf):
    return C.missing_profile(_dirty(spark, sf))


@register("duplicate_profile_dirty", W_(O.DIRTY, f"""
  , g AS (SELECT COUNT(*) AS n FROM dirty GROUP BY {', '.join(_DIRTY_COLS)})
  SELECT CAST(SUM(n) AS BIGINT) AS rows, CAST(SUM(n - 1) AS BIGINT) AS duplicates,
         ROUND(SUM(n - 1) * 100.0 / SUM(n), 6) AS duplicate_pct FROM g"""))
def q_duplicate_profile(spark, sf):
    return C.duplicate_profile(_dirty(spark, sf))


@register("missing_ratio_dirty", W_(O.DIRTY, f"""
  SELECT ROUND(({' + '.join(f'COUNT_IF({c} IS NULL)' for c in _DIRTY_COLS)}) / (COUNT(*) * {len(_DIRTY_COLS)}.0), 8)
         AS missing_ratio FROM dirty"""))
def q_missing_ratio(spark, sf):
    return C.missing_ratio(_dirty(spark, sf))


_NUM_DIRTY = [c for c in _DIRTY_COLS if c not in ("state", "international_plan", "voice_mail_plan", "churn")]


def _fill_sql(c):
    if c in S.MINUTE_COLS or c in S.CHARGE_COLS:
        return f"ROUND(COALESCE(dd.{c}, med.{c}), 6) AS {c}"
    typ = "INTEGER" if c == "account_length" else "BIGINT"
    return f"CAST(COALESCE(dd.{c}, med.{c}) AS {typ}) AS {c}"


def _mode_sql(c):
    return (f"(SELECT {c} FROM dd WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1)")


@register("preprocess_dirty", W_(O.DIRTY, f"""
  , dd AS (SELECT MIN(customer_id) AS customer_id, {', '.join(_DIRTY_COLS)} FROM dirty GROUP BY ALL),
  med AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS {c}' for c in _NUM_DIRTY)} FROM dd)
  SELECT dd.customer_id,
    COALESCE(dd.state, {_mode_sql('state')}) AS state,
    {', '.join(_fill_sql(c) for c in _NUM_DIRTY if c != 'area_code')},
    CASE WHEN COALESCE(dd.international_plan, {_mode_sql('international_plan')}) = 'Yes' THEN 1 ELSE 0 END
      AS international_plan,
    CASE WHEN COALESCE(dd.voice_mail_plan, {_mode_sql('voice_mail_plan')}) = 'Yes' THEN 1 ELSE 0 END
      AS voice_mail_plan,
    CASE WHEN dd.churn THEN 1 ELSE 0 END AS churn
  FROM dd, med"""))
def q_preprocess_dirty(spark, sf):
    out = C.preprocess(_dirty(spark, sf), one_hot_state=False)
    num = [c for c in _NUM_DIRTY if c != "area_code"]
    return out.select(S.ID, "state", *[_r(c) for c in num], "international_plan", "voice_mail_plan", "churn")


@register("one_hot_state", W_(O.CLEANED, """
  SELECT customer_id, 'state_' || regexp_replace(lower(state), '[^a-z0-9]', '_', 'g') AS "column", 1 AS value
  FROM cleaned WHERE state > (SELECT MIN(state) FROM cleaned)"""))
def q_one_hot(spark, sf):
    enc = C.one_hot(cleaned(spark, sf), "state")
    cols = [c for c in enc.columns if c.startswith("state_")]
    long = enc.select(S.ID, *cols).unpivot(S.ID, cols, "column", "value")
    return long.where(F.col("value") == 1)


@register("one_hot_vector_state", W_(O.CLEANED, """
  SELECT customer_id, CAST(DENSE_RANK() OVER (ORDER BY state) - 2 AS BIGINT) AS place,
         CAST((SELECT COUNT(DISTINCT state) - 1 FROM cleaned) AS BIGINT) AS size FROM cleaned"""))
def q_one_hot_vector(spark, sf):
    """C8, wide form: the place of the one in each row's vector (-1: none)."""
    enc = C.one_hot_vector(cleaned(spark, sf), "state").withColumn("v", vector_to_array("state_onehot"))
    return enc.select(S.ID, (F.array_position("v", 1.0) - 1).cast("bigint").alias("place"), F.size("v").cast("bigint").alias("size"))


@register("clip_iqr_minutes", W_(O.CLEANED, f"""
  , q AS (SELECT {', '.join(f'quantile_cont({c}, [0.25, 0.75]) AS q_{c}' for c in S.MINUTE_COLS)} FROM cleaned)
  SELECT customer_id, {', '.join(
      f'ROUND(LEAST(GREATEST({c}, q_{c}[1] - 1.5 * (q_{c}[2] - q_{c}[1])), q_{c}[2] + 1.5 * (q_{c}[2] - q_{c}[1])), 6)'
      f' AS {c}' for c in S.MINUTE_COLS)}
  FROM cleaned, q"""))
def q_clip_iqr(spark, sf):
    return C.clip_iqr(cleaned(spark, sf), S.MINUTE_COLS).select(S.ID, *[_r(c) for c in S.MINUTE_COLS])


@register("outlier_summary", W_(O.CLEANED, f"""
  , long AS (UNPIVOT (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in NUM15)} FROM cleaned)
             ON {', '.join(NUM15)} INTO NAME feature VALUE value),
  q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM long GROUP BY feature),
  b AS (SELECT feature, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
  SELECT b.feature, ROUND(lower, 6) AS lower, ROUND(upper, 6) AS upper,
    CAST(COUNT_IF(value < lower OR value > upper) AS BIGINT) AS outliers,
    ROUND(COUNT_IF(value < lower OR value > upper) * 100.0 / COUNT(value), 6) AS outlier_pct
  FROM long JOIN b ON long.feature = b.feature GROUP BY b.feature, lower, upper"""))
def q_outliers(spark, sf):
    return C.outlier_summary(cleaned(spark, sf), NUM15)


_ALIGN = ["total_minutes", "customer_service_calls", "state_zanzibar", "international_plan", "day_usage_ratio"]


@register("align_features", W_(O.FEATURES, """
  SELECT customer_id, ROUND(total_minutes, 6) AS total_minutes, customer_service_calls,
    CAST(0.0 AS DOUBLE) AS state_zanzibar, international_plan, ROUND(day_usage_ratio, 6) AS day_usage_ratio FROM features"""))
def q_align(spark, sf):
    out = C.align_features(features(spark, sf), _ALIGN, keep=[S.ID])
    return out.withColumns({c: F.round(c, 6) for c in ["total_minutes", "day_usage_ratio"]})


def _range_sql(name, lo, hi, integral):
    cond = f"{name} IS NULL OR CAST({name} AS DOUBLE) < {lo} OR CAST({name} AS DOUBLE) > {hi}"
    if integral:
        cond += f" OR CAST({name} AS DOUBLE) <> FLOOR(CAST({name} AS DOUBLE))"
    return f"CASE WHEN {cond} THEN '{name}: must be in [{lo}, {hi}]' END"


def _validate_sql():
    parts = []
    for name, kind, lo, hi in S.REQUEST_FIELDS:
        if kind == "yesno":
            parts.append(f"CASE WHEN {name} IS NULL OR {name} NOT IN ('Yes', 'No') THEN '{name}: must be Yes or No' END")
        else:
            parts.append(_range_sql(name, lo, hi, kind == "int"))
    arr = "list_filter([" + ", ".join(parts) + "], lambda x: x IS NOT NULL)"
    return W_(O.CUSTOMER_USAGE, f"""
  , v AS (SELECT customer_id, {arr} AS r FROM customer_usage)
  SELECT customer_id, len(r) = 0 AS is_valid, CAST(len(r) AS INTEGER) AS n_reasons,
         array_to_string(r, '; ') AS reasons FROM v""")


@register("validate_requests", _validate_sql())
def q_validate(spark, sf):
    v = C.validate_requests(usage(spark, sf))
    return v.select(S.ID, "is_valid", F.size("reject_reasons").alias("n_reasons"),
                    F.concat_ws("; ", "reject_reasons").alias("reasons"))


@register("filter_customers", W_(O.CLEANED, """
  SELECT customer_id, customer_service_calls, international_plan, voice_mail_plan FROM cleaned
  WHERE customer_service_calls BETWEEN 1 AND 4 AND international_plan IN (1) AND voice_mail_plan IN (0, 1)"""))
def q_filter(spark, sf):
    out = C.filter_customers(cleaned(spark, sf), (1, 4), [1], [0, 1])
    return out.select(S.ID, "customer_service_calls", "international_plan", "voice_mail_plan")


@register("risk_indicators", W_(O.CUSTOMER_USAGE, """
  SELECT customer_id, CASE WHEN customer_service_calls >= 4 THEN 1 ELSE 0 END AS high_service_calls_flag,
    CASE WHEN international_plan = 'Yes' THEN 1 ELSE 0 END AS intl_plan_flag,
    CASE WHEN customer_service_calls <= 1 AND voice_mail_plan = 'Yes' THEN 1 ELSE 0 END AS low_risk_flag
  FROM customer_usage"""))
def q_risk_indicators(spark, sf):
    return C.risk_indicators(usage(spark, sf)).select(
        S.ID, "high_service_calls_flag", "intl_plan_flag", "low_risk_flag")


@register("churn_band_standin", W_(O.CUSTOMER_USAGE, f"""
  SELECT customer_id, ROUND({O.STANDIN}, 4) AS churn_probability, {O.STANDIN} > 0.5 AS churn_prediction,
    CASE WHEN {O.STANDIN} > 0.5 THEN 'High' ELSE 'Low' END AS risk_level FROM customer_usage"""))
def q_churn_band(spark, sf):
    u = usage(spark, sf).withColumn("p", FX.standin_score())
    pred, band = C.churn_band("p")
    return u.select(S.ID, F.round("p", 4).alias("churn_probability"), pred.alias("churn_prediction"),
                    band.alias("risk_level"))


# ================================================================ profile aggregates

@register("churn_rate", W_(O.CLEANED, """
  SELECT COUNT(*) AS rows, ROUND(AVG(CAST(churn AS DOUBLE)), 6) AS churn_rate, 20 AS columns FROM cleaned"""))
def q_churn_rate(spark, sf):
    return P.churn_rate(cleaned(spark, sf))


@register("value_counts_state", W_(O.CLEANED, """
  SELECT state, COUNT(*) AS n, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share FROM cleaned GROUP BY state"""))
def q_value_counts(spark, sf):
    return P.value_counts(cleaned(spark, sf), "state", normalize=True)


@register("rate_by_intl_plan", W_(O.CLEANED, """
  SELECT international_plan, COUNT(*) AS n, ROUND(AVG(CAST(churn AS DOUBLE)), 6) AS churn_rate
  FROM cleaned GROUP BY international_plan"""))
def q_rate_by(spark, sf):
    return P.rate_by(cleaned(spark, sf), "international_plan")


@register("crosstab_vmail_churn", W_(O.CLEANED, """
  SELECT voice_mail_plan, ROUND(COUNT_IF(churn = 0) * 100.0 / COUNT(*), 6) AS "0",
         ROUND(COUNT_IF(churn = 1) * 100.0 / COUNT(*), 6) AS "1" FROM cleaned GROUP BY voice_mail_plan"""))
def q_crosstab(spark, sf):
    return P.crosstab(cleaned(spark, sf), "voice_mail_plan", S.LABEL, [0, 1], normalize="index")


@register("count_by_class_service_calls", W_(O.CLEANED, """
  SELECT customer_service_calls, churn, COUNT(*) AS n FROM cleaned GROUP BY ALL"""))
def q_count_by_class(spark, sf):
    return P.count_by_class(cleaned(spark, sf), "customer_service_calls")


@register("rate_by_tenure_month", W_(O.CLEANED, """
  SELECT CAST(FLOOR(account_length / 30) AS BIGINT) AS tenure_month, COUNT(*) AS n,
         ROUND(AVG(CAST(churn AS DOUBLE)), 6) AS churn_rate FROM cleaned GROUP BY 1"""))
def q_tenure(spark, sf):
    return P.rate_by_tenure_month(cleaned(spark, sf))


@register("kpis", W_(O.CLEANED, """
  SELECT COUNT(*) AS customers, ROUND(AVG(CAST(churn AS DOUBLE)), 6) AS churn_rate,
    COUNT_IF(customer_service_calls > 3) AS high_risk_callers, COUNT_IF(international_plan = 1) AS intl_plan_users
  FROM cleaned"""))
def q_kpis(spark, sf):
    return P.kpis(cleaned(spark, sf))


def _segment_sql(expr, edges, labels, name, source, extra_cols="", extra_aggs=""):
    vals = ", ".join(f"({i}, '{lab}')" for i, lab in enumerate(labels))
    return f"""
  SELECT d.{name}, CAST(COALESCE(g.n, 0) AS BIGINT) AS n {extra_cols}
  FROM (VALUES {vals}) d(pos, {name})
  LEFT JOIN (SELECT {sql_cut(expr, edges, labels)} AS seg, COUNT(*) AS n, AVG(CAST(churn AS DOUBLE)) AS churn_rate
             {extra_aggs} FROM {source} GROUP BY 1) g ON g.seg = d.{name}"""


@register("segment_rates", W_(O.CLEANED, _segment_sql(
    "customer_service_calls", P.RISK_CALL_EDGES, P.RISK_CALL_LABELS, "risk_segment", "cleaned",
    ", ROUND(g.churn_rate * 100.0, 6) AS churn_rate_pct")))
def q_segment_rates(spark, sf):
    return P.segment_rates(cleaned(spark, sf))


@register("usage_segments", W_(O.FEATURES, _segment_sql(
    "total_minutes", P.USAGE_EDGES, P.USAGE_LABELS, "usage_segment", "features",
    ", ROUND(g.churn_rate, 6) AS churn_rate")))
def q_usage_segments(spark, sf):
    return P.usage_segments(features(spark, sf))


@register("segment_matrix", W_(O.FEATURES, f"""
  , b AS (SELECT {sql_cut('total_minutes', P.USAGE_EDGES, P.USAGE_LABELS)} AS u,
                 {sql_cut('customer_service_calls', P.SERVICE_EDGES, P.SERVICE_LABELS)} AS s,
                 CAST(churn AS DOUBLE) AS y FROM features)
  SELECT d.usage_segment,
    {', '.join(f"ROUND(AVG(y) FILTER (WHERE s = '{lab}') * 100.0, 6) AS {S.safe_name(lab)}" for lab in P.SERVICE_LABELS)}
  FROM (VALUES {', '.join(f"({i}, '{lab}')" for i, lab in enumerate(P.USAGE_LABELS))}) d(pos, usage_segment)
  LEFT JOIN b ON b.u = d.usage_segment AND b.s IS NOT NULL
  GROUP BY d.usage_segment"""))
def q_segment_matrix(spark, sf):
    return P.segment_matrix(features(spark, sf))


def _standin_usage(spark, sf):
    return cleaned(spark, sf).withColumn("churn_probability", FX.standin_score())


_STANDIN_CLEANED = O.CLEANED + f""",
scored AS (SELECT *, {O.STANDIN} AS churn_probability FROM cleaned)"""


@register("risk_segments_standin", W_(_STANDIN_CLEANED, _segment_sql(
    "churn_probability", P.PROB_EDGES, P.PROB_LABELS, "risk_segment", "scored",
    ", ROUND(g.mp, 4) AS mean_probability, ROUND(g.churn_rate, 4) AS churn_rate",
    ", AVG(churn_probability) AS mp")))
def q_risk_segments(spark, sf):
    return P.risk_segments(_standin_usage(spark, sf))


@register("retention_roi_standin", W_(_STANDIN_CLEANED, """
  , h AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n FROM scored WHERE churn_probability > 0.7 AND churn_probability <= 1.0)
  SELECT CAST(n AS BIGINT) AS high_risk_customers, n * 1200 AS revenue_at_risk, n * 200 AS campaign_cost,
    n * 0.4 * 1200 AS revenue_retained,
    ROUND(CASE WHEN n * 200 = 0 THEN NULL ELSE (n * 0.4 * 1200 - n * 200) / (n * 200) * 100.0 END, 6) AS roi_pct
  FROM h"""))
def q_roi(spark, sf):
    return P.retention_roi(P.risk_segments(_standin_usage(spark, sf)))


def _hist_sql(col, bins, source):
    return f"""
  , mm AS (SELECT MIN({col}) AS lo, MAX({col}) AS hi FROM {source}),
  p AS (SELECT lo, CASE WHEN hi = lo THEN 1.0 / {bins} ELSE (hi - lo) / {bins} END AS w,
               CASE WHEN hi = lo THEN lo - 0.5 ELSE lo END AS lo2 FROM mm),
  b AS (SELECT CAST(LEAST(FLOOR(({col} - p.lo2) / p.w), {bins - 1}) AS INTEGER) AS bin, churn, p.lo2, p.w
        FROM {source}, p WHERE {col} IS NOT NULL)
  SELECT bin, churn, COUNT(*) AS n, ROUND(ANY_VALUE(lo2) + bin * ANY_VALUE(w), 6) AS bin_start,
         ROUND(ANY_VALUE(lo2) + (bin + 1) * ANY_VALUE(w), 6) AS bin_end FROM b GROUP BY bin, churn"""


@register("histogram_day_minutes", W_(O.CLEANED, _hist_sql("total_day_minutes", 30, "cleaned")))
def q_histogram(spark, sf):
    h = P.histogram(cleaned(spark, sf), "total_day_minutes", 30)
    return h.withColumns({"bin_start": F.round("bin_start", 6), "bin_end": F.round("bin_end", 6)})


@register("box_summary_service_calls", W_(O.CLEANED, """
  , q AS (SELECT churn, COUNT(customer_service_calls) AS n,
      quantile_cont(CAST(customer_service_calls AS DOUBLE), 0.25) AS q1,
      quantile_cont(CAST(customer_service_calls AS DOUBLE), 0.5) AS median,
      quantile_cont(CAST(customer_service_calls AS DOUBLE), 0.75) AS q3,
      AVG(CAST(customer_service_calls AS DOUBLE)) AS mean FROM cleaned GROUP BY churn)
  SELECT q.churn, q.n, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3, ROUND(mean, 6) AS mean,
    ROUND(MIN(CASE WHEN c.customer_service_calls >= q1 - 1.5 * (q3 - q1)
                   THEN CAST(c.customer_service_calls AS DOUBLE) END), 6)
      AS lower_whisker,
    ROUND(MAX(CASE WHEN c.customer_service_calls <= q3 + 1.5 * (q3 - q1)
                   THEN CAST(c.customer_service_calls AS DOUBLE) END), 6)
      AS upper_whisker
  FROM q JOIN cleaned c ON c.churn = q.churn GROUP BY ALL"""))
def q_box(spark, sf):
    return P.box_summary(cleaned(spark, sf), "customer_service_calls")


_KDE_COLS = ["account_length", "total_day_minutes", "total_eve_minutes", "total_night_minutes", "total_intl_minutes",
             "customer_service_calls"]


@register("kde_usage", W_(O.CLEANED, f"""
  , long AS (UNPIVOT (SELECT churn AS cls, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _KDE_COLS)} FROM cleaned)
             ON {', '.join(_KDE_COLS)} INTO NAME feature VALUE value),
  st AS (SELECT feature, cls, COUNT(*) AS n, stddev_samp(value) * POW(COUNT(*), -0.2) AS bw,
                MIN(value) AS lo, MAX(value) AS hi FROM long GROUP BY ALL),
  g AS (SELECT feature, cls, n, bw, i, lo + (hi - lo) * i / 99.0 AS x FROM st, range(100) r(i)),
  dv AS (SELECT feature, cls, value, COUNT(*) AS w FROM long GROUP BY ALL)
  SELECT g.feature, g.cls AS churn, CAST(g.i AS INTEGER) AS i, ROUND(g.x, 6) AS x,
    ROUND(SUM(dv.w * EXP(-0.5 * ((g.x - dv.value) / g.bw) * ((g.x - dv.value) / g.bw)))
          / (ANY_VALUE(g.n) * ANY_VALUE(g.bw) * SQRT(2 * PI())), 9) AS density
  FROM g JOIN dv ON dv.feature = g.feature AND dv.cls = g.cls WHERE g.bw > 0 GROUP BY g.feature, g.cls, g.i, g.x"""))
def q_kde(spark, sf):
    return P.kde(cleaned(spark, sf), _KDE_COLS)


@register("value_range_service_calls", W_(O.CLEANED, """
  SELECT MIN(customer_service_calls) AS min_value, MAX(customer_service_calls) AS max_value FROM cleaned"""))
def q_value_range(spark, sf):
    return P.value_range(cleaned(spark, sf), "customer_service_calls")


@register("class_means", W_(O.CLEANED, f"""
  , long AS (UNPIVOT (SELECT churn AS y, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in NUM17)} FROM cleaned)
             ON {', '.join(NUM17)} INTO NAME feature VALUE value)
  SELECT feature, ROUND(AVG(value) FILTER (WHERE y = 1), 6) AS mean_churned,
         ROUND(AVG(value) FILTER (WHERE y = 0), 6) AS mean_retained FROM long GROUP BY feature"""))
def q_class_means(spark, sf):
    return P.class_summary(cleaned(spark, sf), NUM17)


# ================================================================ statistics

_CORR_COLS = NUM17 + [S.LABEL]


def _corr_sql():
    pairs = [(a, b) for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]]
    sel = ", ".join(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS "{a}__{b}"' for a, b in pairs)
    on = ", ".join(f'"{a}__{b}"' for a, b in pairs)
    return W_(O.CLEANED, f"""
  , w AS (SELECT {sel} FROM cleaned)
  SELECT split_part(pair, '__', 1) AS feature_a, split_part(pair, '__', 2) AS feature_b, ROUND(c, 6) AS corr
  FROM (UNPIVOT w ON {on} INTO NAME pair VALUE c)""")


@register("corr_matrix", _corr_sql())
def q_corr(spark, sf):
    return Q.corr_matrix(cleaned(spark, sf), _CORR_COLS)


@register("top_correlated", W_(O.CLEANED, f"""
  , w AS (SELECT {', '.join(f'corr(CAST({c} AS DOUBLE), CAST(churn AS DOUBLE)) AS {c}' for c in NUM17)} FROM cleaned),
  l AS (SELECT feature, c FROM (UNPIVOT w ON {', '.join(NUM17)} INTO NAME feature VALUE c) WHERE c IS NOT NULL)
  SELECT feature, ROUND(c, 6) AS corr, ROUND(ABS(c), 6) AS abs_corr FROM l
  ORDER BY ROUND(ABS(c), 6) DESC, feature LIMIT 10"""))
def q_top_corr(spark, sf):
    return Q.top_correlated(cleaned(spark, sf), NUM17)


@register("welch_t", W_(O.CLEANED, f"""
  , long AS (UNPIVOT (SELECT churn AS y, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in NUM17)} FROM cleaned)
             ON {', '.join(NUM17)} INTO NAME feature VALUE value),
  m AS (SELECT feature, COUNT(value) FILTER (WHERE y = 1) AS n1, COUNT(value) FILTER (WHERE y = 0) AS n0,
          AVG(value) FILTER (WHERE y = 1) AS m1, AVG(value) FILTER (WHERE y = 0) AS m0,
          var_samp(value) FILTER (WHERE y = 1) AS v1, var_samp(value) FILTER (WHERE y = 0) AS v0
        FROM long GROUP BY feature)
  SELECT feature,
    ROUND(CASE WHEN v1 / n1 + v0 / n0 = 0 THEN NULL ELSE (m1 - m0) / SQRT(v1 / n1 + v0 / n0) END, 6) AS t_statistic,
    ROUND(CASE WHEN POW(v1 / n1, 2) / (n1 - 1) + POW(v0 / n0, 2) / (n0 - 1) = 0 THEN NULL
               ELSE POW(v1 / n1 + v0 / n0, 2) / (POW(v1 / n1, 2) / (n1 - 1) + POW(v0 / n0, 2) / (n0 - 1)) END, 6) AS dof,
    ROUND(CASE WHEN SQRT((v1 + v0) / 2) > 0 THEN (m1 - m0) / SQRT((v1 + v0) / 2) ELSE 0.0 END, 6) AS cohens_d
  FROM m"""))
def q_welch(spark, sf):
    return Q.welch_t(cleaned(spark, sf), NUM17, with_p=False)


def _chi2_sql(cols, source_blocks, source):
    return W_(source_blocks, f"""
  , long AS (UNPIVOT (SELECT churn AS y, {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in cols)} FROM {source})
             ON {', '.join(cols)} INTO NAME feature VALUE level),
  cells AS (SELECT feature, level, CAST(COUNT_IF(y = 1) AS DOUBLE) AS n1, CAST(COUNT_IF(y = 0) AS DOUBLE) AS n0
            FROM long GROUP BY ALL),
  m AS (SELECT *, SUM(n1) OVER (PARTITION BY feature) AS t1, SUM(n0) OVER (PARTITION BY feature) AS t0,
               COUNT(*) OVER (PARTITION BY feature) AS r FROM cells),
  e AS (SELECT *, (n1 + n0) * t1 / (t1 + t0) AS e1, (n1 + n0) * t0 / (t1 + t0) AS e0,
               (r - 1) * ((CASE WHEN t1 > 0 THEN 1 ELSE 0 END) + (CASE WHEN t0 > 0 THEN 1 ELSE 0 END) - 1) AS dof,
               LEAST(r, (CASE WHEN t1 > 0 THEN 1 ELSE 0 END) + (CASE WHEN t0 > 0 THEN 1 ELSE 0 END)) AS k
        FROM m),
  a AS (SELECT *, CASE WHEN dof = 1 THEN n1 + LEAST(0.5, ABS(e1 - n1)) * SIGN(e1 - n1) ELSE n1 END AS o1,
               CASE WHEN dof = 1 THEN n0 + LEAST(0.5, ABS(e0 - n0)) * SIGN(e0 - n0) ELSE n0 END AS o0 FROM e),
  g AS (SELECT feature, SUM(CASE WHEN e1 > 0 THEN POW(o1 - e1, 2) / e1 ELSE 0 END
                            + CASE WHEN e0 > 0 THEN POW(o0 - e0, 2) / e0 ELSE 0 END) AS chi2,
               ANY_VALUE(dof) AS dof, ANY_VALUE(t1 + t0) AS n, ANY_VALUE(k) AS k FROM a GROUP BY feature)
  SELECT feature, ROUND(chi2, 6) AS chi2, CAST(dof AS BIGINT) AS dof, CAST(n AS BIGINT) AS n,
         ROUND(SQRT(chi2 / (n * (k - 1))), 6) AS cramers_v FROM g""")


@register("chi2_plans", _chi2_sql(S.PLAN_COLS, O.CLEANED, "cleaned"))
def q_chi2(spark, sf):
    return Q.chi2_independence(cleaned(spark, sf), S.PLAN_COLS, with_p=False)


@register("chi2_state", _chi2_sql(["state"], O.CLEANED, "cleaned"))
def q_chi2_state(spark, sf):
    return Q.chi2_independence(cleaned(spark, sf), ["state"], with_p=False)


def _anova_sql(blocks, source, group_expr):
    return W_(blocks, f"""
  , src AS (SELECT {group_expr} AS grp, CAST(churn AS DOUBLE) AS v FROM {source}),
  g AS (SELECT grp, COUNT(*) AS n, AVG(v) AS m, var_pop(v) AS vp FROM src WHERE grp IS NOT NULL GROUP BY grp),
  s AS (SELECT SUM(n) AS nn, SUM(n * m) / SUM(n) AS gm, COUNT(*) AS k, SUM(n * vp) AS ssw FROM g),
  b AS (SELECT SUM(g.n * POW(g.m - s.gm, 2)) AS ssb FROM g, s)
  SELECT CAST(k AS BIGINT) AS groups, CAST(nn AS BIGINT) AS n, CAST(k - 1 AS BIGINT) AS df_between,
    CAST(nn - k AS BIGINT) AS df_within,
    ROUND(CASE WHEN ssw / (nn - k) = 0 THEN NULL ELSE (ssb / (k - 1)) / (ssw / (nn - k)) END, 6) AS f_statistic
  FROM s, b""")


@register("anova_service_groups", _anova_sql(O.CLEANED, "cleaned",
                                             sql_cut("customer_service_calls", [0, 1, 3, 10], ["Low", "Medium", "High"])))
def q_anova_service(spark, sf):
    return Q.anova_f(Q.service_call_groups(cleaned(spark, sf)), "service_group", S.LABEL, with_p=False)


@register("anova_first_states", _anova_sql(O.CLEANED + """,
  fs AS (SELECT state FROM cleaned GROUP BY state ORDER BY MIN(customer_id) LIMIT 10),
  first_states AS (SELECT c.* FROM cleaned c WHERE c.state IN (SELECT state FROM fs))""", "first_states", "state"))
def q_anova_states(spark, sf):
    return Q.anova_f(Q.first_states(cleaned(spark, sf)), "state", S.LABEL, with_p=False)


# ---------------------------------------------------------------- drift splits (Q8-Q10)

def _drift_split(spark, sf, kind):
    f = features(spark, sf)
    if kind == "drift":
        return f.where(F.col("account_length") >= 1800), f.where(~(F.col("account_length") >= 1800))
    return f.where(F.col(S.ID) < 1200), f.where(~(F.col(S.ID) < 1200))


def _ks_sql(kind):
    cond = "account_length >= 1800" if kind == "drift" else "customer_id < 1200"
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in DRIFT_FEATURES)
    return W_(O.FEATURES, f"""
  , sides AS (SELECT CASE WHEN {cond} THEN 0 ELSE 1 END AS side, {cols} FROM features),
  long AS (UNPIVOT sides ON {', '.join(DRIFT_FEATURES)} INTO NAME feature VALUE value),
  d AS (SELECT feature, value, COUNT_IF(side = 0) AS a, COUNT_IF(side = 1) AS b FROM long GROUP BY ALL),
  c AS (SELECT feature, SUM(a) OVER (PARTITION BY feature ORDER BY value) AS ca,
               SUM(b) OVER (PARTITION BY feature ORDER BY value) AS cb,
               SUM(a) OVER (PARTITION BY feature) AS na, SUM(b) OVER (PARTITION BY feature) AS nb FROM d)
  SELECT feature, ROUND(MAX(ABS(ca / NULLIF(na, 0) - cb / NULLIF(nb, 0))), 6) AS ks_statistic, CAST(ANY_VALUE(na) AS BIGINT) AS n_ref,
         CAST(ANY_VALUE(nb) AS BIGINT) AS n_new FROM c GROUP BY feature""")


@register("ks_drift_split", _ks_sql("drift"))
def q_ks_drift(spark, sf):
    ref, new = _drift_split(spark, sf, "drift")
    return W.ks_2samp(ref, new, DRIFT_FEATURES, with_p=False)


@register("ks_no_drift_split", _ks_sql("none"))
def q_ks_none(spark, sf):
    ref, new = _drift_split(spark, sf, "none")
    return W.ks_2samp(ref, new, DRIFT_FEATURES, with_p=False)


@register("chi2_gof_drift_split", W_(O.FEATURES, """
  , r AS (SELECT AVG(CAST(churn AS DOUBLE)) AS rr FROM features WHERE account_length >= 1800),
  n AS (SELECT COUNT(*) AS nn, AVG(CAST(churn AS DOUBLE)) AS nr FROM features WHERE NOT (account_length >= 1800))
  SELECT CAST(nn AS BIGINT) AS n_new,
    ROUND((CASE WHEN rr * nn > 0 THEN POW(nr * nn - rr * nn, 2) / (rr * nn) ELSE 0 END)
        + (CASE WHEN (1 - rr) * nn > 0 THEN POW((1 - nr) * nn - (1 - rr) * nn, 2) / ((1 - rr) * nn) ELSE 0 END), 6)
      AS chi2_statistic,
    ROUND(rr, 6) AS churn_rate_ref, ROUND(nr, 6) AS churn_rate_new FROM r, n"""))
def q_chi2_gof(spark, sf):
    ref, new = _drift_split(spark, sf, "drift")
    return Q.chi2_gof(ref, new, with_p=False)


# ---------------------------------------------------------------- ordered: AUC, ROC, PR on the stand-in score

_STANDIN_FEATURES = O.FEATURES + f""",
scored AS (SELECT customer_id, churn, {O.STANDIN} AS score FROM features),
t AS (SELECT score, COUNT_IF(churn = 1) AS pos, COUNT_IF(churn <> 1) AS neg FROM scored GROUP BY score)"""


def _scored(spark, sf):
    return features(spark, sf).withColumn("score", FX.standin_score())


@register("roc_auc_standin", W_(_STANDIN_FEATURES, """
  , c AS (SELECT *, SUM(neg) OVER (ORDER BY score) AS cn FROM t)
  SELECT ROUND(SUM(pos * (cn - neg + 0.5 * neg)) / (SUM(pos) * SUM(neg)), 6) AS roc_auc,
         CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives FROM c"""))
def q_auc(spark, sf):
    return W.roc_auc(_scored(spark, sf), "score", S.LABEL).withColumn("roc_auc", F.round("roc_auc", 6))


@register("roc_curve_standin", W_(_STANDIN_FEATURES, """
  , c AS (SELECT score, SUM(pos) OVER (ORDER BY score DESC) AS tps, SUM(neg) OVER (ORDER BY score DESC) AS fps,
                 ROW_NUMBER() OVER (ORDER BY score DESC) AS idx, SUM(pos) OVER () AS P, SUM(neg) OVER () AS N,
                 COUNT(*) OVER () AS K FROM t),
  d AS (SELECT *, LAG(tps) OVER (ORDER BY idx) AS tp0, LEAD(tps) OVER (ORDER BY idx) AS tp2,
               LAG(fps) OVER (ORDER BY idx) AS fp0, LEAD(fps) OVER (ORDER BY idx) AS fp2 FROM c)
  SELECT CAST(0 AS BIGINT) AS point, 0.0 AS fpr, 0.0 AS tpr, CAST('inf' AS DOUBLE) AS threshold
  UNION ALL
  SELECT CAST(idx AS BIGINT), ROUND(fps / N, 6), ROUND(tps / P, 6), score FROM d
  WHERE idx = 1 OR idx = K OR (fp2 - 2 * fps + fp0) <> 0 OR (tp2 - 2 * tps + tp0) <> 0"""))
def q_roc(spark, sf):
    return W.roc_curve(_scored(spark, sf), "score", S.LABEL)


@register("pr_curve_standin", W_(_STANDIN_FEATURES, """
  , c AS (SELECT score, SUM(pos) OVER (ORDER BY score DESC) AS tps, SUM(neg) OVER (ORDER BY score DESC) AS fps,
                 SUM(pos) OVER () AS P, SUM(neg) OVER () AS N FROM t)
  SELECT score AS threshold, ROUND(tps / (tps + fps), 6) AS precision, ROUND(tps / P, 6) AS recall,
         ROUND(P / (P + N), 6) AS base_rate FROM c
  UNION ALL
  SELECT NULL, 1.0, 0.0, ROUND(SUM(pos) / (SUM(pos) + SUM(neg)), 6) FROM t"""))
def q_pr(spark, sf):
    return W.pr_curve(_scored(spark, sf), "score", S.LABEL)


@register("quantiles_exact", W_(O.FEATURES, f"""
  , long AS (UNPIVOT (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in DRIFT_FEATURES)} FROM features)
             ON {', '.join(DRIFT_FEATURES)} INTO NAME feature VALUE value)
  , q AS (SELECT feature, quantile_cont(value, [0.25, 0.5, 0.75, 0.9]) AS qs FROM long GROUP BY feature)
  SELECT feature, CAST(p AS DOUBLE) AS p, ROUND(qs[i], 6) AS value
  FROM q, (VALUES (1, 0.25), (2, 0.5), (3, 0.75), (4, 0.9)) ps(i, p)"""))
def q_quantiles(spark, sf):
    out = W.exact_quantiles(features(spark, sf), DRIFT_FEATURES, [0.25, 0.5, 0.75, 0.9])
    return out.withColumn("value", F.round("value", 6))


# ================================================================ top-k and unions

@register("top_k_welch", W_(O.CLEANED, f"""
  , long AS (UNPIVOT (SELECT churn AS y, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in NUM17)} FROM cleaned)
             ON {', '.join(NUM17)} INTO NAME feature VALUE value),
  m AS (SELECT feature, AVG(value) FILTER (WHERE y = 1) AS m1, AVG(value) FILTER (WHERE y = 0) AS m0,
          var_samp(value) FILTER (WHERE y = 1) AS v1, var_samp(value) FILTER (WHERE y = 0) AS v0,
          COUNT(value) FILTER (WHERE y = 1) AS n1, COUNT(value) FILTER (WHERE y = 0) AS n0 FROM long GROUP BY feature),
  t AS (SELECT feature, ROUND(ABS((m1 - m0) / SQRT(v1 / n1 + v0 / n0)), 6) AS abs_t FROM m WHERE v1 / n1 + v0 / n0 > 0)
  SELECT feature, abs_t FROM t ORDER BY abs_t DESC, feature LIMIT 12"""))
def q_top_k(spark, sf):
    t = Q.welch_t(cleaned(spark, sf), NUM17, with_p=False).where(F.col("t_statistic").isNotNull())
    t = t.select("feature", F.round(F.abs("t_statistic"), 6).alias("abs_t"))
    return P.top_k(t, "abs_t", 12, tiebreak=["feature"])


@register("merge_sources", W_(O.CUSTOMER_USAGE, """
  , pos AS (SELECT *, ROW_NUMBER() OVER (ORDER BY customer_id) AS rn, COUNT(*) OVER () AS total FROM customer_usage)
  SELECT customer_id, state, churn, CASE WHEN rn <= CAST(FLOOR(0.8 * total) AS BIGINT) THEN 'part_80' ELSE 'part_20' END
         AS source FROM pos"""))
def q_merge(spark, sf):
    from .operators.sampling import positional_split
    u = usage(spark, sf).select(S.ID, "state", S.LABEL)
    ref, new = positional_split(u, 0.8)
    return P.merge_sources(ref.withColumn("source", F.lit("part_80")), new.withColumn("source", F.lit("part_20")))


# ================================================================ more projections and profile variants

_KEPT_RAW = [c for c in S.RAW_COLUMNS if "charge" not in c and c != "area_code"]


@register("drop_charges_area_code", W_(O.CUSTOMER_USAGE, f"""
  SELECT {', '.join(_KEPT_RAW)} FROM customer_usage"""))
def q_drop_columns(spark, sf):
    """P1 + P2: drop the columns whose name contains 'charge', then area code if present."""
    return C.drop_if_exists(FE.drop_matching(usage(spark, sf), "charge"), ["area_code", "no_such_column"])


@register("label_yes_no", W_(O.CLEANED, """
  SELECT customer_id, CASE WHEN churn = 1 THEN 'Yes' WHEN churn = 0 THEN 'No' END AS churn_label FROM cleaned"""))
def q_map_values(spark, sf):
    """Label 1/0 mapped to Yes/No (an unmapped value would become NULL)."""
    return C.map_values(cleaned(spark, sf), S.LABEL, {1: "Yes", 0: "No"}, out="churn_label") \
        .select(S.ID, "churn_label")


@register("crosstab_intl_churn_counts", W_(O.CLEANED, """
  SELECT international_plan, COUNT_IF(churn = 0) AS "0", COUNT_IF(churn = 1) AS "1" FROM cleaned
  GROUP BY international_plan"""))
def q_crosstab_counts(spark, sf):
    """A4 (counts): contingency of international plan by label with fixed pivot values."""
    return P.crosstab(cleaned(spark, sf), "international_plan", S.LABEL, [0, 1])


@register("histogram_density_service_calls", W_(O.CLEANED, """
  , mm AS (SELECT MIN(customer_service_calls) AS lo, MAX(customer_service_calls) AS hi FROM cleaned),
  p AS (SELECT CASE WHEN hi = lo THEN lo - 0.5 ELSE lo END AS lo2,
               CASE WHEN hi = lo THEN 1.0 / 10 ELSE (hi - lo) / 10.0 END AS w FROM mm),
  b AS (SELECT CAST(LEAST(FLOOR((customer_service_calls - p.lo2) / p.w), 9) AS INTEGER) AS bin, churn, p.lo2, p.w
        FROM cleaned, p WHERE customer_service_calls IS NOT NULL),
  g AS (SELECT bin, churn, COUNT(*) AS n, ANY_VALUE(lo2) AS lo2, ANY_VALUE(w) AS w FROM b GROUP BY bin, churn)
  SELECT bin, churn, n, ROUND(lo2 + bin * w, 6) AS bin_start, ROUND(lo2 + (bin + 1) * w, 6) AS bin_end,
         ROUND(n / (SUM(n) OVER (PARTITION BY churn) * w), 9) AS density FROM g"""))
def q_hist_density(spark, sf):
    """A14 (density): 10 equal-width bins of service calls per class, counts / (class rows x width)."""
    h = P.histogram(cleaned(spark, sf), "customer_service_calls", 10, density=True)
    return h.withColumns({"bin_start": F.round("bin_start", 6), "bin_end": F.round("bin_end", 6),
                          "density": F.round("density", 9)})


@register("kpis_filtered", W_(O.CLEANED, """
  , f AS (SELECT * FROM cleaned WHERE customer_service_calls BETWEEN 0 AND 5 AND international_plan IN (0, 1)
          AND voice_mail_plan IN (1))
  SELECT COUNT(*) AS customers, ROUND(AVG(CAST(churn AS DOUBLE)), 6) AS churn_rate,
    COUNT_IF(customer_service_calls > 3) AS high_risk_callers, COUNT_IF(international_plan = 1) AS intl_plan_users
  FROM f"""))
def q_kpis_filtered(spark, sf):
    """P10 + A7: the dashboard flow, sidebar filters then the four KPIs."""
    return P.kpis(C.filter_customers(cleaned(spark, sf), (0, 5), [0, 1], [1]))

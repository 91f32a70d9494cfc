"""Registered queries for model metrics, splits, monitoring rules and the stream's batch twin.

Fit-dependent outputs use the deterministic stand-in score of FIXTURES.md, so they have SQL
twins. KS p-values are a finite alternating series (expressible in SQL); the one-degree chi-squared
decision p < 0.05 is the same as statistic > 3.841458820694124.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import oracle_sql as O
from . import schema as S
from .operators import models as MD
from .operators import ordered as W
from .operators import profile as P
from .operators import sampling as SP
from .operators import stats as Q
from .plans import monitoring as M
from .registry import cleaned, features, register
from .registry_more import DRIFT_FEATURES, _drift_split
from .sources import fixture as FX
from .streaming.drift import window_drift
from .streaming.streams import window_counts

W_ = O.with_blocks
CHI2_1DF_05 = 3.841458820694124  # chi-squared critical value, 1 dof, alpha 0.05 (fixed value)


def _standin2(id_col=S.ID):
    """A second stand-in score (the 'champion' / second model)."""
    return ((F.col(id_col) * 104729) % 997) / F.lit(997.0)


STANDIN2 = "CAST((customer_id * 104729) % 997 AS DOUBLE) / 997.0"


def _scored(df, which=1):
    s = FX.standin_score() if which == 1 else _standin2()
    return df.withColumns({"churn_probability": s, "label": F.col(S.LABEL).cast("double")}) \
        .withColumn("churn_prediction", F.col("churn_probability") > 0.5)


_SCORED_SQL = O.FEATURES + f""",
scored AS (SELECT customer_id, churn, account_length, {O.STANDIN} AS p1, {STANDIN2} AS p2 FROM features)"""


def _metrics_sql(pcol, where="TRUE", label_col="churn"):
    return f"""
  SELECT ROUND(AVG(CASE WHEN ({pcol} > 0.5) = ({label_col} = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
    ROUND(COALESCE(COUNT_IF({pcol} > 0.5 AND {label_col} = 1) / NULLIF(COUNT_IF({pcol} > 0.5), 0), 0.0), 6)
      AS precision,
    ROUND(COALESCE(COUNT_IF({pcol} > 0.5 AND {label_col} = 1) / NULLIF(COUNT_IF({label_col} = 1), 0), 0.0), 6)
      AS recall,
    ROUND(COALESCE(2.0 * COUNT_IF({pcol} > 0.5 AND {label_col} = 1)
      / NULLIF(COUNT_IF({pcol} > 0.5) + COUNT_IF({label_col} = 1), 0), 0.0), 6) AS f1_score,
    COUNT(*) AS sample_size FROM scored WHERE {where}"""


def _auc_sql(pcol, where="TRUE"):
    return f"""(SELECT SUM(pos * (cn - neg + 0.5 * neg)) / (SUM(pos) * SUM(neg)) FROM (
      SELECT *, SUM(neg) OVER (ORDER BY s) AS cn FROM (
        SELECT {pcol} AS s, COUNT_IF(churn = 1) AS pos, COUNT_IF(churn <> 1) AS neg FROM scored WHERE {where}
        GROUP BY 1)))"""


@register("class_metrics_standin", W_(_SCORED_SQL, f"""
  , m AS ({_metrics_sql('p1')})
  SELECT accuracy, precision, recall, f1_score, ROUND({_auc_sql('p1')}, 6) AS roc_auc, sample_size FROM m"""))
def q_class_metrics(spark, sf):
    return MD.rounded_metrics(MD.class_metrics(_scored(features(spark, sf))))


@register("confusion_matrix_standin", W_(_SCORED_SQL, """
  SELECT COUNT_IF(churn = 0 AND NOT p1 > 0.5) AS tn, COUNT_IF(churn = 0 AND p1 > 0.5) AS fp,
         COUNT_IF(churn = 1 AND NOT p1 > 0.5) AS fn, COUNT_IF(churn = 1 AND p1 > 0.5) AS tp FROM scored"""))
def q_confusion(spark, sf):
    return MD.confusion_matrix(_scored(features(spark, sf)))


@register("model_comparison_standin", W_(_SCORED_SQL, f"""
  , t AS (SELECT 0 AS position, 'standin_a' AS model, ROUND({_auc_sql('p1')}, 6) AS roc_auc
          UNION ALL SELECT 1, 'standin_b', ROUND({_auc_sql('p2')}, 6))
  SELECT position, model, roc_auc FROM t ORDER BY roc_auc DESC, position LIMIT 1"""))
def q_model_comparison(spark, sf):
    f = features(spark, sf)
    rows = None
    for i, (name, which) in enumerate([("standin_a", 1), ("standin_b", 2)]):
        a = W.roc_auc(_scored(f, which), "churn_probability", "label").select(
            F.lit(i).alias("position"), F.lit(name).alias("model"), F.round("roc_auc", 6).alias("roc_auc"))
        rows = a if rows is None else rows.unionByName(a)
    return MD.model_comparison(rows)[1]


# ---------------------------------------------------------------- splits

_MODKEY = "(customer_id * 7919) % 100003"


@register("stratified_split_modkey", W_(O.CLEANED, f"""
  , r AS (SELECT customer_id, churn, ROW_NUMBER() OVER (PARTITION BY churn ORDER BY {_MODKEY}, customer_id) AS rk,
                 COUNT(*) OVER (PARTITION BY churn) AS n FROM cleaned)
  SELECT customer_id, churn, CASE WHEN rk <= ROUND(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM r"""))
def q_split(spark, sf):
    c = cleaned(spark, sf).select(S.ID, S.LABEL)
    return SP.stratified_split(c, 0.2, order_key=SP.mod_key())


@register("kfold_modkey", W_(O.CLEANED, f"""
  SELECT customer_id, churn,
    CAST((ROW_NUMBER() OVER (PARTITION BY churn ORDER BY {_MODKEY}, customer_id) - 1) % 5 AS INTEGER) AS fold
  FROM cleaned"""))
def q_kfold(spark, sf):
    c = cleaned(spark, sf).select(S.ID, S.LABEL)
    return SP.kfold(c, 5, order_key=SP.mod_key())


@register("positional_split", W_(O.CLEANED, """
  , r AS (SELECT customer_id, ROW_NUMBER() OVER (ORDER BY customer_id) AS rk, COUNT(*) OVER () AS n FROM cleaned)
  SELECT customer_id, CASE WHEN rk <= FLOOR(0.8 * n) THEN 'reference' ELSE 'production' END AS part FROM r"""))
def q_positional(spark, sf):
    c = cleaned(spark, sf).select(S.ID)
    ref, new = SP.positional_split(c, 0.8)
    return ref.withColumn("part", F.lit("reference")).unionByName(new.withColumn("part", F.lit("production")))


# ---------------------------------------------------------------- monitoring rules

def _ks_p_sql(d, n1, n2):
    lam = f"((SQRT({n1} * {n2} / ({n1} + {n2})) + 0.12 + 0.11 / SQRT({n1} * {n2} / ({n1} + {n2}))) * {d})"
    series = (f"(SELECT 2.0 * SUM(CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END * EXP(-2.0 * j * j * {lam} * {lam}))"
              f" FROM range(1, 200) r(j))")
    return f"CASE WHEN {lam} < 0.001 THEN 1.0 ELSE LEAST(1.0, GREATEST(0.0, {series})) END"


def _ks_rows_sql(kind="drift"):
    from .registry_more import _ks_sql
    return _ks_sql(kind)


def _ks_with_p_sql():
    base = _ks_rows_sql("drift")
    return base.replace("  SELECT feature, ROUND(MAX(ABS(ca / NULLIF(na, 0) - cb / NULLIF(nb, 0))), 6) AS ks_statistic",
                        "  , ks AS (SELECT feature, MAX(ABS(ca / NULLIF(na, 0) - cb / NULLIF(nb, 0))) AS ks_statistic") \
        .rstrip() + ")"


_KS_P = _ks_with_p_sql() + f"""
  , ksp AS (SELECT feature, ks_statistic, n_ref, n_new, {_ks_p_sql('ks_statistic', 'n_ref', 'n_new')} AS p_value
            FROM ks)"""


@register("ks_pvalues_drift_split", _KS_P + """
  SELECT feature, ROUND(ks_statistic, 6) AS ks_statistic, n_ref, n_new, ROUND(p_value, 6) AS p_value,
         p_value < 0.05 AS drift_detected FROM ksp""")
def q_ks_p(spark, sf):
    ref, new = _drift_split(spark, sf, "drift")
    return W.ks_2samp(ref, new, DRIFT_FEATURES).withColumn("p_value", F.round("p_value", 6))


_DRIFT_ORDER = ", ".join(f"'{f}'" for f in DRIFT_FEATURES)

_DRIFT_RATE_SQL = _KS_P + f"""
  , dr AS (SELECT COUNT(*) AS features_checked, COUNT_IF(p_value < 0.05) AS features_drifted,
      list(feature ORDER BY list_position([{_DRIFT_ORDER}], feature)) FILTER (WHERE p_value < 0.05) AS drifted
    FROM ksp)"""


@register("drift_rate_drift_split", _DRIFT_RATE_SQL + """
  SELECT features_checked, features_drifted, array_to_string(COALESCE(drifted, []), ',') AS drifted_features,
    array_to_string(COALESCE(drifted[1:5], []), ',') AS first_drifted,
    ROUND(COALESCE(features_drifted / NULLIF(features_checked, 0), 0.0), 6) AS drift_rate FROM dr""")
def q_drift_rate(spark, sf):
    ref, new = _drift_split(spark, sf, "drift")
    d = Q.drift_rate(W.ks_2samp(ref, new, DRIFT_FEATURES), DRIFT_FEATURES)
    return d.select("features_checked", "features_drifted",
                    F.concat_ws(",", "drifted_features").alias("drifted_features"),
                    F.concat_ws(",", P.first_n(F.col("drifted_features"), 5)).alias("first_drifted"),
                    F.round("drift_rate", 6).alias("drift_rate"))


@register("should_retrain_drift_split", _DRIFT_RATE_SQL + f"""
  , auc AS (SELECT {_auc_sql('p1', 'NOT (account_length >= 1800)')} AS roc_auc),
  tg AS (SELECT rr, nr, nn FROM (SELECT AVG(CAST(churn AS DOUBLE)) AS rr FROM scored WHERE account_length >= 1800),
             (SELECT COUNT(*) AS nn, AVG(CAST(churn AS DOUBLE)) AS nr FROM scored WHERE NOT (account_length >= 1800))),
  chi AS (SELECT (CASE WHEN rr * nn > 0 THEN POW(nr * nn - rr * nn, 2) / (rr * nn) ELSE 0 END)
             + (CASE WHEN (1 - rr) * nn > 0 THEN POW((1 - nr) * nn - (1 - rr) * nn, 2) / ((1 - rr) * nn) ELSE 0 END)
             AS x FROM tg),
  rs AS (SELECT list_filter([
      CASE WHEN roc_auc < 0.75 THEN printf('Performance below threshold (ROC-AUC: %.3f)', roc_auc) END,
      CASE WHEN COALESCE(features_drifted / NULLIF(features_checked, 0), 0.0) > 0.3
           THEN printf('High drift rate: %.1f%%', COALESCE(features_drifted / NULLIF(features_checked, 0), 0.0) * 100)
           END,
      CASE WHEN ROUND(x, 6) > {CHI2_1DF_05} THEN 'Target drift detected (concept drift)' END], lambda v: v IS NOT NULL)
      AS r FROM auc, dr, chi)
  SELECT len(r) > 0 AS recommended,
         CASE WHEN len(r) > 0 THEN array_to_string(r, '; ') ELSE 'No retraining needed' END AS reason FROM rs""".replace(
    "  , auc AS", ",\n  scored AS (SELECT customer_id, churn, account_length, " + O.STANDIN + " AS p1 FROM features)\n"
    "  , auc AS"))
def q_should_retrain(spark, sf):
    ref, new = _drift_split(spark, sf, "drift")
    perf = MD.class_metrics(_scored(new))
    drift = Q.drift_rate(W.ks_2samp(ref, new, DRIFT_FEATURES), DRIFT_FEATURES)
    target = Q.chi2_gof(ref, new)
    return M.should_retrain(perf, drift, target)


@register("health_and_severity_drift_split", _DRIFT_RATE_SQL + f""",
  scored AS (SELECT customer_id, churn, account_length, {O.STANDIN} AS p1 FROM features),
  auc AS (SELECT {_auc_sql('p1', 'NOT (account_length >= 1800)')} AS roc_auc)
  SELECT CASE WHEN roc_auc >= 0.85 THEN 'Healthy' WHEN roc_auc >= 0.75 THEN 'Warning' ELSE 'Critical' END AS health,
    CASE WHEN COALESCE(features_drifted / NULLIF(features_checked, 0), 0.0) * 100 > 30 THEN 'Critical'
         WHEN COALESCE(features_drifted / NULLIF(features_checked, 0), 0.0) * 100 > 10 THEN 'Warning'
         ELSE 'Normal' END AS drift_severity FROM auc, dr""")
def q_health(spark, sf):
    ref, new = _drift_split(spark, sf, "drift")
    auc = W.roc_auc(_scored(new), "churn_probability", "label")
    drift = Q.drift_rate(W.ks_2samp(ref, new, DRIFT_FEATURES), DRIFT_FEATURES)
    return M._one(auc, drift).select(M.health_status(F.col("roc_auc")).alias("health"),
                                     M.drift_severity(F.col("drift_rate")).alias("drift_severity"))


@register("validate_training_data", W_(O.CLEANED, """
  , a AS (SELECT COUNT(*) AS n, AVG(CAST(churn AS DOUBLE)) AS cr FROM cleaned),
  r AS (SELECT list_filter([
      CASE WHEN n < 1000 THEN printf('Insufficient samples: %d < 1000', n) END,
      CASE WHEN cr < 0.05 OR cr > 0.5 THEN printf('Unusual churn rate: %.1f%%', cr * 100) END],
      lambda v: v IS NOT NULL) AS issues, n, cr FROM a)
  SELECT n, ROUND(cr, 6) AS churn_rate, CAST(0.0 AS DOUBLE) AS missing_ratio, len(issues) = 0 AS is_valid,
    CASE WHEN len(issues) = 0 THEN 'Data validation passed' ELSE array_to_string(issues, '; ') END AS message
  FROM r"""))
def q_validate_training(spark, sf):
    return M.validate_training_data(cleaned(spark, sf)).withColumn("missing_ratio",
                                                                    F.col("missing_ratio").cast("double"))


@register("champion_challenger_standin", W_(_SCORED_SQL, f"""
  , a AS (SELECT {_auc_sql('p1')} AS new_auc, {_auc_sql('p2')} AS prod_auc)
  SELECT new_auc - prod_auc > 0.01 AS deploy,
    CASE WHEN new_auc - prod_auc > 0.01 THEN printf('New model improves ROC-AUC by %.4f', new_auc - prod_auc)
         WHEN new_auc - prod_auc > 0 THEN printf('Improvement (%.4f) below threshold (0.01)', new_auc - prod_auc)
         ELSE printf('New model performs worse (decline: %.4f)', ABS(new_auc - prod_auc)) END AS reason FROM a"""))
def q_champion(spark, sf):
    f = features(spark, sf)
    a1 = W.roc_auc(_scored(f, 1), "churn_probability", "label").select(F.col("roc_auc").alias("new_auc"))
    a2 = W.roc_auc(_scored(f, 2), "churn_probability", "label").select(F.col("roc_auc").alias("prod_auc"))
    deploy, reason = M.champion_challenger(F.col("new_auc"), F.col("prod_auc"))
    return M._one(a1, a2).select(deploy.alias("deploy"), reason.alias("reason"))


@register("reference_profile_drift_split", W_(O.FEATURES, f"""
  , ref AS (SELECT * FROM features WHERE account_length >= 1800),
  long AS (UNPIVOT (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in DRIFT_FEATURES)} FROM ref)
           ON {', '.join(DRIFT_FEATURES)} INTO NAME feature VALUE value)
  SELECT 'feature' AS kind, feature, value, COUNT(*) AS n FROM long GROUP BY ALL
  UNION ALL SELECT 'target', 'churn', CAST(churn AS DOUBLE), COUNT(*) FROM ref GROUP BY ALL"""))
def q_reference_profile(spark, sf):
    ref, _ = _drift_split(spark, sf, "drift")
    return M.reference_profile(ref, DRIFT_FEATURES)


@register("prediction_drift_standin", W_(_SCORED_SQL, """
  , d AS (SELECT p1 AS value, COUNT_IF(account_length >= 1800) AS a, COUNT_IF(NOT (account_length >= 1800)) AS b
          FROM scored GROUP BY 1),
  c AS (SELECT SUM(a) OVER (ORDER BY value) AS ca, SUM(b) OVER (ORDER BY value) AS cb,
               SUM(a) OVER () AS na, SUM(b) OVER () AS nb FROM d)
  SELECT ROUND(MAX(ABS(ca / NULLIF(na, 0) - cb / NULLIF(nb, 0))), 6) AS ks_statistic,
    (SELECT ROUND(AVG(p1), 6) FROM scored WHERE account_length >= 1800) AS mean_prediction_ref,
    (SELECT ROUND(AVG(p1), 6) FROM scored WHERE NOT (account_length >= 1800)) AS mean_prediction_new FROM c"""))
def q_prediction_drift(spark, sf):
    ref, new = _drift_split(spark, sf, "drift")
    out = M.prediction_drift(_scored(ref), _scored(new))
    return out.select("ks_statistic", F.round("mean_prediction_ref", 6).alias("mean_prediction_ref"),
                      F.round("mean_prediction_new", 6).alias("mean_prediction_new"))


# ---------------------------------------------------------------- monitoring on the stored profile

def _stored(profile):
    """The profile as a cycle finds it: written, and read back."""
    from .session import checkpoint
    return checkpoint(profile)


@register("feature_drift_profile", _KS_P + """
  SELECT feature, ROUND(ks_statistic, 6) AS ks_statistic, n_ref, n_new, ROUND(p_value, 6) AS p_value,
         p_value < 0.05 AS drift_detected FROM ksp""")
def q_feature_drift_profile(spark, sf):
    """M3 on M1: the batch against the stored distinct-value counts."""
    ref, new = _drift_split(spark, sf, "drift")
    profile = _stored(M.reference_profile(ref, DRIFT_FEATURES))
    return M.profile_feature_drift(profile, new, DRIFT_FEATURES)[1].withColumn("p_value", F.round("p_value", 6))


@register("prediction_drift_profile", W_(_SCORED_SQL, f"""
  , d AS (SELECT p1 AS value, COUNT_IF(account_length >= 1800) AS a, COUNT_IF(NOT (account_length >= 1800)) AS b
          FROM scored GROUP BY 1),
  c AS (SELECT SUM(a) OVER (ORDER BY value) AS ca, SUM(b) OVER (ORDER BY value) AS cb,
               SUM(a) OVER () AS na, SUM(b) OVER () AS nb FROM d),
  ks AS (SELECT MAX(ABS(ca / NULLIF(na, 0) - cb / NULLIF(nb, 0))) AS ks_statistic, ANY_VALUE(na) AS n_ref, ANY_VALUE(nb) AS n_new FROM c),
  p AS (SELECT ks_statistic, {_ks_p_sql('ks_statistic', 'n_ref', 'n_new')} AS p_value FROM ks)
  SELECT p_value < 0.05 AS drift_detected, ROUND(p_value, 6) AS p_value, ROUND(ks_statistic, 6) AS ks_statistic,
    (SELECT ROUND(AVG(p1), 6) FROM scored WHERE account_length >= 1800) AS mean_prediction_ref,
    (SELECT ROUND(AVG(p1), 6) FROM scored WHERE NOT (account_length >= 1800)) AS mean_prediction_new FROM p"""))
def q_prediction_drift_profile(spark, sf):
    """M4 on M1: KS, p, flag and both means from the stored score counts and the scored batch."""
    ref, new = _drift_split(spark, sf, "drift")
    profile = _stored(M.reference_profile(_scored(ref), DRIFT_FEATURES, "churn_probability"))
    out = M.profile_prediction_drift(profile, _scored(new))
    return out.withColumns({c: F.round(c, 6) for c in ("p_value", "mean_prediction_ref", "mean_prediction_new")})


@register("target_drift_profile", W_(O.FEATURES, f"""
  , t AS (SELECT AVG(CAST(churn AS DOUBLE)) FILTER (WHERE account_length >= 1800) AS rr,
                 AVG(CAST(churn AS DOUBLE)) FILTER (WHERE NOT (account_length >= 1800)) AS nr,
                 COUNT_IF(NOT (account_length >= 1800)) AS nn FROM features),
  x AS (SELECT *, (CASE WHEN rr * nn > 0 THEN POW(nr * nn - rr * nn, 2) / (rr * nn) ELSE 0 END)
             + (CASE WHEN (1 - rr) * nn > 0 THEN POW((1 - nr) * nn - (1 - rr) * nn, 2) / ((1 - rr) * nn) ELSE 0 END) AS c FROM t)
  SELECT CAST(nn AS BIGINT) AS n_new, ROUND(c, 6) AS chi2_statistic, ROUND(rr, 6) AS churn_rate_ref, ROUND(nr, 6) AS churn_rate_new,
         c > {CHI2_1DF_05} AS drift_detected FROM x"""))
def q_target_drift_profile(spark, sf):
    """M5 on M1: label counts of the batch against the stored label shares."""
    ref, new = _drift_split(spark, sf, "drift")
    return M.profile_target_drift(_stored(M.reference_profile(ref, DRIFT_FEATURES)), new).drop("p_value")


# ---------------------------------------------------------------- training rows, cooldown, selected features

_U2 = [*DRIFT_FEATURES, S.LABEL]


@register("merged_training_rows", W_(O.FEATURES, f"""
  SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _U2)} FROM features WHERE account_length >= 1800
  UNION ALL SELECT {', '.join(f'CAST({c} AS DOUBLE)' for c in _U2)} FROM features WHERE NOT (account_length >= 1800)"""))
def q_merged_training_rows(spark, sf):
    """The selected columns of the reference and of the landed rows."""
    ref, new = _drift_split(spark, sf, "drift")
    return P.merge_training_data(ref, new, DRIFT_FEATURES).select(*[F.col(c).cast("double").alias(c) for c in _U2])


@register("cooldown_gate_orders", """
  SELECT strftime(MAX(CAST(o_orderdate AS DATE)), '%Y-%m-%d') AS last_retrain,
    CAST(FLOOR((epoch(TIMESTAMP '1999-01-03 11:00:00') - epoch(CAST(MAX(CAST(o_orderdate AS DATE)) AS TIMESTAMP))) / 86400) AS INTEGER) AS days_since,
    FLOOR((epoch(TIMESTAMP '1999-01-03 11:00:00') - epoch(CAST(MAX(CAST(o_orderdate AS DATE)) AS TIMESTAMP))) / 86400) >= 30 AS allowed FROM orders""")
def q_cooldown(spark, sf):
    """Whole days since the last record of a history, against a cooldown of 30 days."""
    history = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderdate").cast("date").cast("timestamp").alias("timestamp"))
    now = F.lit("1999-01-03 11:00:00").cast("timestamp")
    return M.cooldown_gate(history, 30, now).withColumn("last_retrain", F.date_format("last_retrain", "yyyy-MM-dd"))


_NEW = sorted(S.ENGINEERED)


@register("selected_engineered", W_(O.FEATURES, f"""
  SELECT customer_id, {', '.join(f'ROUND(CAST({c} AS DOUBLE), 4) AS {c}' for c in _NEW)}, churn FROM features"""))
def q_selected(spark, sf):
    """Padded names stripped, required columns checked, the columns that feature engineering
    adds selected with id and label, and rounded."""
    from .functions.features import engineer_features, new_columns
    from .operators import clean as C
    before = cleaned(spark, sf)
    before = C.normalize_names(before.toDF(*[f" {c} " for c in before.columns]))
    C.require_columns(before, [S.ID, S.LABEL, *S.NUMERIC_INPUTS])
    after = engineer_features(before)
    added = new_columns(before, after)
    chosen = C.select_features_label(after, added, keep=[S.ID])
    return C.round_outputs(chosen.withColumns({c: F.col(c).cast("double") for c in added}), added)


# ---------------------------------------------------------------- events: stream twin and latest record

@register("event_window_counts", """
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR
         AS window_end, event_type, COUNT(*) AS n, ROUND(AVG(value), 6) AS mean_value
  FROM events GROUP BY ALL""")
def q_event_windows(spark, sf):
    return window_counts(spark.read.parquet(f"{sf}/events.parquet"))


_EVENT_FEATURES = ["value", "user_id"]
_EVENT_REFERENCE_END = "2024-01-11 00:00:00"   # the first ten days are the reference


@register("window_drift_events", f"""
  WITH long AS (SELECT ts, 'value' AS feature, CAST(value AS DOUBLE) AS value FROM events WHERE value IS NOT NULL
                UNION ALL SELECT ts, 'user_id', CAST(user_id AS DOUBLE) FROM events WHERE user_id IS NOT NULL),
  ref AS (SELECT feature, value, COUNT(*) AS c FROM long WHERE ts < TIMESTAMP '{_EVENT_REFERENCE_END}' GROUP BY ALL),
  day AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, feature, value, COUNT(*) AS c FROM long
          WHERE ts >= TIMESTAMP '{_EVENT_REFERENCE_END}' GROUP BY ALL),
  grid AS (SELECT w.window_start, v.feature, v.value FROM (SELECT DISTINCT window_start, feature FROM day) w
           JOIN (SELECT feature, value FROM ref UNION SELECT feature, value FROM day) v USING (feature)),
  cum AS (SELECT g.window_start, g.feature,
            SUM(COALESCE(r.c, 0)) OVER o AS ca, SUM(COALESCE(d.c, 0)) OVER o AS cb,
            SUM(COALESCE(r.c, 0)) OVER a AS na, SUM(COALESCE(d.c, 0)) OVER a AS nb
          FROM grid g LEFT JOIN ref r USING (feature, value) LEFT JOIN day d USING (window_start, feature, value)
          WINDOW o AS (PARTITION BY g.window_start, g.feature ORDER BY g.value), a AS (PARTITION BY g.window_start, g.feature)),
  ks AS (SELECT window_start, feature, MAX(ABS(ca / na - cb / nb)) AS d, CAST(MAX(na) AS BIGINT) AS n_ref, CAST(MAX(nb) AS BIGINT) AS n_new
         FROM cum GROUP BY ALL),
  p AS (SELECT *, {_ks_p_sql('d', 'n_ref', 'n_new')} AS p FROM ks)
  SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, feature, ROUND(d, 6) AS ks_statistic, n_ref, n_new,
         ROUND(p, 6) AS p_value, p < 0.05 AS drift_detected FROM p""")
def q_window_drift(spark, sf):
    """X2 + M3: every day after the reference days against their profile."""
    events = spark.read.parquet(f"{sf}/events.parquet").select("ts", *_EVENT_FEATURES)
    early = F.col("ts") < F.lit(_EVENT_REFERENCE_END).cast(events.schema["ts"].dataType)
    profile = W.distinct_counts(events.where(early), _EVENT_FEATURES).withColumn("kind", F.lit("feature"))
    return window_drift(profile, events.where(~early), _EVENT_FEATURES).withColumn("p_value", F.round("p_value", 6))


@register("latest_event", """
  SELECT event_id, ts, user_id, event_type, value, props FROM events ORDER BY ts DESC, event_id DESC LIMIT 1""")
def q_latest_event(spark, sf):
    return P.latest(spark.read.parquet(f"{sf}/events.parquet"), "ts")


# ---------------------------------------------------------------- T22: two models' ROC on one test set

@register("roc_by_model_standin", W_(_SCORED_SQL, """
  , long AS (SELECT 'standin_a' AS model, p1 AS score, churn FROM scored
             UNION ALL SELECT 'standin_b', p2, churn FROM scored),
  t AS (SELECT model, score, COUNT_IF(churn = 1) AS pos, COUNT_IF(churn <> 1) AS neg FROM long GROUP BY ALL),
  c AS (SELECT model, score, SUM(pos) OVER (PARTITION BY model ORDER BY score DESC) AS tps,
               SUM(neg) OVER (PARTITION BY model ORDER BY score DESC) AS fps,
               ROW_NUMBER() OVER (PARTITION BY model ORDER BY score DESC) AS idx,
               SUM(pos) OVER (PARTITION BY model) AS P, SUM(neg) OVER (PARTITION BY model) AS N,
               COUNT(*) OVER (PARTITION BY model) AS K FROM t),
  d AS (SELECT *, LAG(tps) OVER (PARTITION BY model ORDER BY idx) AS tp0,
               LEAD(tps) OVER (PARTITION BY model ORDER BY idx) AS tp2,
               LAG(fps) OVER (PARTITION BY model ORDER BY idx) AS fp0,
               LEAD(fps) OVER (PARTITION BY model ORDER BY idx) AS fp2 FROM c)
  SELECT model, CAST(0 AS BIGINT) AS point, 0.0 AS fpr, 0.0 AS tpr, CAST('inf' AS DOUBLE) AS threshold
  FROM (SELECT DISTINCT model FROM t)
  UNION ALL
  SELECT model, CAST(idx AS BIGINT), ROUND(fps / N, 6), ROUND(tps / P, 6), score FROM d
  WHERE idx = 1 OR idx = K OR (fp2 - 2 * fps + fp0) <> 0 OR (tp2 - 2 * tps + tp0) <> 0"""))
def q_roc_by_model(spark, sf):
    f = features(spark, sf)
    long = _scored(f, 1).select(F.lit("standin_a").alias("model"), "churn_probability", "label").unionByName(
        _scored(f, 2).select(F.lit("standin_b").alias("model"), "churn_probability", "label"))
    return W.roc_curve(long, "churn_probability", "label", keys=["model"])

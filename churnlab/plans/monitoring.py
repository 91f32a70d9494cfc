"""Monitoring, retraining decisions and the cycle that ties them together.

Decisions are column expressions over one-row metric tables, so the same rules run in a batch
job, inside ``foreachBatch`` of a stream, or against an SQL twin. The cycle functions are thin
drivers: every heavy step (profiles, KS, metrics, fits) is a Spark job over whole tables.
"""

from __future__ import annotations

import datetime as _dt
import time
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.frames import side_by_side
from ..operators import models as MD
from ..operators import ordered as W
from ..operators import stats as Q
from ..operators.clean import missing_ratio

# Thresholds of the monitoring and retraining rules.
PERFORMANCE_THRESHOLD = 0.75
DRIFT_ALPHA = 0.05
DRIFT_RATE_TRIGGER = 0.3
MIN_IMPROVEMENT = 0.01
MIN_TRAINING_ROWS = 1000
MAX_MISSING = 0.1
CHURN_RATE_RANGE = (0.05, 0.5)
HEALTHY_AUC, WARNING_AUC = 0.85, 0.75
DRIFT_CRITICAL_PCT, DRIFT_WARNING_PCT = 30, 10


def _one(*rows: DataFrame) -> DataFrame:
    """Place one-row tables side by side (stacked and re-aggregated, no join)."""
    return side_by_side(*rows)


# ---------------------------------------------------------------- M1 reference profile

PROFILE_SCHEMA = "kind string, feature string, value double, n bigint, version string"


def reference_profile(ref: DataFrame, features: list[str], score_col: str | None = None,
                      label: str = S.LABEL) -> DataFrame:
    """M1: long table (kind, feature, value, n) of the reference distributions, written once.

    Feature values and scores as distinct-value counts (what KS needs), label shares as counts.
    """
    cols = list(features) + ([score_col] if score_col else [])
    long = (W.distinct_counts(ref, cols)
            .withColumn("kind", F.when(F.col("feature") == F.lit(score_col or ""), "prediction").otherwise("feature")))
    lab = ref.groupBy(F.col(label).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n")) \
        .withColumns({"feature": F.lit(label), "kind": F.lit("target")})
    return long.unionByName(lab).select("kind", "feature", "value", "n")


def save_profile(profile: DataFrame, path: str, version: str | None = None) -> str:
    """M1: append a version of the profile; the cycle reads the latest one and never the reference rows."""
    version = version or _dt.datetime.now(_dt.timezone.utc).isoformat()
    profile.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version").parquet(path)
    return version


def load_profile(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest version of the stored profile (only its files are read), None where there is none."""
    try:
        stored = spark.read.schema(PROFILE_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    # the partition column alone: an aggregate over folder names
    version = stored.agg(F.max("version")).first()[0]
    return None if version is None else stored.where(F.col("version") == version).drop("version")


def profile_feature_drift(profile: DataFrame, new: DataFrame, features: list[str], alpha: float = DRIFT_ALPHA):
    """M3 on M1: KS of the batch's distinct-value counts against the stored ones; the summary row and the rows."""
    kept = profile.where((F.col("kind") == "feature") & F.col("feature").isin(list(features)))
    held = {r[0] for r in kept.select("feature").distinct().collect()}  # one row per feature
    present = [f for f in features if f in new.columns and f in held]
    kept = kept.where(F.col("feature").isin(present))
    ks = W.ks_counts(W.merged_counts(kept, W.distinct_counts(new, present)), alpha=alpha) if present else _no_ks(new.sparkSession)
    return Q.drift_rate(ks, present), ks


def _no_ks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "feature string, ks_statistic double, n_ref bigint, n_new bigint, p_value double, drift_detected boolean")


def profile_prediction_drift(profile: DataFrame, new_scores: DataFrame, score_col: str = "churn_probability",
                             alpha: float = DRIFT_ALPHA) -> DataFrame:
    """M4 on M1: KS of the batch's scores against the stored score counts, and both means."""
    kept = profile.where(F.col("kind") == "prediction").withColumn("feature", F.lit(score_col))
    ks = W.ks_counts(W.merged_counts(kept, W.distinct_counts(new_scores, [score_col])), alpha=alpha)
    means = _one(kept.agg(F.try_divide(F.sum(F.col("value") * F.col("n")), F.sum("n")).alias("mean_prediction_ref")),
                 new_scores.agg(F.avg(score_col).alias("mean_prediction_new")))
    return _one(ks.select("drift_detected", "p_value", "ks_statistic"), means)


def profile_target_drift(profile: DataFrame, new: DataFrame, label: str = S.LABEL, alpha: float = DRIFT_ALPHA) -> DataFrame:
    """M5 on M1: chi-squared goodness of fit of the batch's labels to the stored label shares."""
    kept = profile.where((F.col("kind") == "target") & F.col("value").isNotNull())
    rate = kept.agg(F.try_divide(F.sum(F.col("value") * F.col("n")), F.sum("n")).alias("ref_rate"))
    return Q.chi2_gof_rate(rate, new, label, alpha=alpha)


# ---------------------------------------------------------------- M2-M6 checks and rules

def evaluate_performance(scored: DataFrame, threshold: float = PERFORMANCE_THRESHOLD) -> DataFrame:
    """M2: class metrics plus ``below_threshold`` (ROC-AUC < threshold)."""
    m = MD.class_metrics(scored)
    return m.withColumn("below_threshold", F.coalesce(F.col("roc_auc") < threshold, F.lit(False)))


def feature_drift(ref: DataFrame, new: DataFrame, features: list[str], alpha: float = DRIFT_ALPHA) -> DataFrame:
    """M3: KS per selected feature present in the new batch, then the drift summary row."""
    present = [f for f in features if f in new.columns and f in ref.columns]
    ks = W.ks_2samp(ref, new, present, alpha=alpha)
    return Q.drift_rate(ks, present), ks


def prediction_drift(ref_scores: DataFrame, new_scores: DataFrame, score_col: str = "churn_probability",
                     alpha: float = DRIFT_ALPHA) -> DataFrame:
    """M4: KS on the score distributions and both means (reported, never a retraining trigger)."""
    ks = W.ks_2samp(ref_scores.select(score_col), new_scores.select(score_col), [score_col], alpha=alpha)
    means = _one(ref_scores.agg(F.avg(score_col).alias("mean_prediction_ref")),
                 new_scores.agg(F.avg(score_col).alias("mean_prediction_new")))
    return _one(ks.select("drift_detected", "p_value", "ks_statistic"), means)


def target_drift(ref: DataFrame, new: DataFrame, label: str = S.LABEL, alpha: float = DRIFT_ALPHA) -> DataFrame:
    """M5: chi-squared goodness of fit of the new label counts to the reference shares."""
    return Q.chi2_gof(ref, new, label, alpha=alpha)


def retrain_reasons(auc: Column, drift_rate: Column, target_drifted: Column,
                    threshold: float = PERFORMANCE_THRESHOLD) -> Column:
    """M6: the list of triggered reasons (performance, feature drift rate, target drift)."""
    return F.array_compact(F.array(
        F.when(auc < threshold, F.format_string("Performance below threshold (ROC-AUC: %.3f)", auc)),
        F.when(drift_rate > DRIFT_RATE_TRIGGER, F.format_string("High drift rate: %.1f%%", drift_rate * 100)),
        F.when(F.coalesce(target_drifted, F.lit(False)), F.lit("Target drift detected (concept drift)")),
    ))


def should_retrain(perf: DataFrame, drift: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """M6: (recommended, reason) from the performance, drift and target rows."""
    x = _one(perf.select("roc_auc"), drift.select("drift_rate"))
    if target is not None:
        x = _one(x, target.select(F.col("drift_detected").alias("target_drifted")))
    else:
        x = x.withColumn("target_drifted", F.lit(False))
    r = retrain_reasons(F.col("roc_auc"), F.col("drift_rate"), F.col("target_drifted"))
    return x.select((F.size(r) > 0).alias("recommended"),
                    F.when(F.size(r) > 0, F.concat_ws("; ", r)).otherwise(F.lit("No retraining needed")).alias("reason"))


def health_status(auc: Column) -> Column:
    """M8: Healthy (>= .85), Warning (>= .75), Critical."""
    return F.when(auc >= HEALTHY_AUC, "Healthy").when(auc >= WARNING_AUC, "Warning").otherwise("Critical")


def drift_severity(drift_rate: Column) -> Column:
    """M9: Critical (> 30 %), Warning (> 10 %), Normal."""
    pct = drift_rate * 100
    return F.when(pct > DRIFT_CRITICAL_PCT, "Critical").when(pct > DRIFT_WARNING_PCT, "Warning").otherwise("Normal")


def validate_training_data(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """(is_valid, message) from one aggregate: row count, missing ratio, churn rate."""
    m = _one(df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("churn_rate")),
             missing_ratio(df))
    issues = F.array_compact(F.array(
        F.when(F.col("n") < MIN_TRAINING_ROWS, F.format_string("Insufficient samples: %d < 1000", F.col("n"))),
        F.when(F.col("missing_ratio") > MAX_MISSING,
               F.format_string("Excessive missing values: %.1f%%", F.col("missing_ratio") * 100)),
        F.when((F.col("churn_rate") < CHURN_RATE_RANGE[0]) | (F.col("churn_rate") > CHURN_RATE_RANGE[1]),
               F.format_string("Unusual churn rate: %.1f%%", F.col("churn_rate") * 100)),
    ))
    return m.select("n", F.round("churn_rate", 6).alias("churn_rate"), "missing_ratio",
                    (F.size(issues) == 0).alias("is_valid"),
                    F.when(F.size(issues) == 0, F.lit("Data validation passed"))
                    .otherwise(F.concat_ws("; ", issues)).alias("message"))


def champion_challenger(new_auc: Column, prod_auc: Column, min_improvement: float = MIN_IMPROVEMENT):
    """(deploy, reason). No champion (NULL) deploys; otherwise deploy only above the margin."""
    imp = new_auc - prod_auc
    deploy = F.when(prod_auc.isNull(), F.lit(True)).otherwise(imp > min_improvement)
    reason = (F.when(prod_auc.isNull(), F.lit("Initial model deployment"))
              .when(imp > min_improvement, F.format_string("New model improves ROC-AUC by %.4f", imp))
              .when(imp > 0, F.format_string(f"Improvement (%.4f) below threshold ({min_improvement})", imp))
              .otherwise(F.format_string("New model performs worse (decline: %.4f)", F.abs(imp))))
    return deploy, reason


def days_since(last_ts: Column, now: Column | None = None) -> Column:
    """Whole 24-hour days since the last retraining (NULL when never retrained)."""
    now = now if now is not None else F.current_timestamp()
    elapsed = F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(last_ts.cast("timestamp"))
    return F.floor(elapsed / 86_400).cast("int")


def cooldown_gate(history: DataFrame, cooldown_days: int = 0, now: Column | None = None) -> DataFrame:
    """(last_retrain, days_since, allowed). Allowed when never retrained or cooldown passed."""
    last = history.agg(F.max("timestamp").alias("last_retrain"))
    d = days_since(F.col("last_retrain"), now)
    return last.select("last_retrain", d.alias("days_since"),
                       (F.col("last_retrain").isNull() | (d >= F.lit(cooldown_days))).alias("allowed"))


# ---------------------------------------------------------------- M7, M12, M14-M16 drivers

REPORT_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("sample_size", T.LongType()),
    T.StructField("performance", T.StructType([
        T.StructField(n, T.DoubleType()) for n in ["accuracy", "roc_auc", "precision", "recall", "f1_score"]
    ] + [T.StructField("sample_size", T.LongType())])),
    T.StructField("feature_drift", T.StructType([
        T.StructField("features_checked", T.LongType()), T.StructField("features_drifted", T.LongType()),
        T.StructField("drifted_features", T.ArrayType(T.StringType())),
        T.StructField("drift_rate", T.DoubleType()),
        T.StructField("drift_details", T.ArrayType(T.StructType([
            T.StructField("feature", T.StringType()), T.StructField("drift_detected", T.BooleanType()),
            T.StructField("p_value", T.DoubleType()), T.StructField("ks_statistic", T.DoubleType())]))),
    ])),
    T.StructField("prediction_drift", T.StructType([
        T.StructField("drift_detected", T.BooleanType()), T.StructField("p_value", T.DoubleType()),
        T.StructField("ks_statistic", T.DoubleType()), T.StructField("mean_prediction_ref", T.DoubleType()),
        T.StructField("mean_prediction_new", T.DoubleType())])),
    T.StructField("target_drift", T.StructType([
        T.StructField("n_new", T.LongType()), T.StructField("chi2_statistic", T.DoubleType()),
        T.StructField("churn_rate_ref", T.DoubleType()), T.StructField("churn_rate_new", T.DoubleType()),
        T.StructField("p_value", T.DoubleType()), T.StructField("drift_detected", T.BooleanType())])),
    T.StructField("retraining", T.StructType([
        T.StructField("recommended", T.BooleanType()), T.StructField("reason", T.StringType())])),
])


def monitoring_report(model, profile: DataFrame, new: DataFrame, features: list[str],
                      with_labels: bool = True, now: str | None = None) -> DataFrame:
    """M7: one report row (``REPORT_SCHEMA``): performance, feature / prediction / target drift and the decision.

    ``profile`` is the stored reference profile (M1) with the live model's scores; only the batch is
    scanned. Label-dependent parts are NULL when ``with_labels`` is false (then only drift decides).
    """
    from ..session import checkpoint
    ts = now or _dt.datetime.now(_dt.timezone.utc).isoformat()
    new_scored = checkpoint(MD.score(model, new))
    drift, ks = profile_feature_drift(profile, new_scored, features)
    drift, ks = checkpoint(drift), checkpoint(ks)
    pdrift = profile_prediction_drift(profile, new_scored)
    details = ks.agg(F.sort_array(F.collect_list(F.struct("feature", "drift_detected", "p_value", "ks_statistic")))
                     .alias("drift_details"))
    base = _one(new_scored.agg(F.count(F.lit(1)).alias("sample_size")), _struct(_one(drift, details), "feature_drift"),
                _struct(pdrift, "prediction_drift"))
    if with_labels:
        perf = checkpoint(evaluate_performance(new_scored))
        tdrift = checkpoint(profile_target_drift(profile, new_scored))
        decision = should_retrain(perf, drift, tdrift)
        base = _one(base, _struct(MD.rounded_metrics(perf.drop("below_threshold")), "performance"), _struct(tdrift, "target_drift"))
    else:
        decision = drift.select((F.col("drift_rate") > DRIFT_RATE_TRIGGER).alias("recommended"),
                                F.when(F.col("drift_rate") > DRIFT_RATE_TRIGGER,
                                       F.format_string("High drift rate: %.1f%%", F.col("drift_rate") * 100))
                                .otherwise(F.lit("No retraining needed")).alias("reason"))
    out = _one(base, _struct(decision, "retraining")).withColumn("timestamp", F.lit(ts))
    return out.select(*[_shaped(out, f) for f in REPORT_SCHEMA])


def _struct(row: DataFrame, name: str) -> DataFrame:
    return row.select(F.struct(*row.columns).alias(name))


def _shaped(report: DataFrame, field: T.StructField) -> Column:
    """A report column in the order and types of ``REPORT_SCHEMA``; NULL where the report has none."""
    if field.name not in report.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    if not isinstance(field.dataType, T.StructType):
        return F.col(field.name).cast(field.dataType).alias(field.name)
    parts = F.struct(*[F.col(f"{field.name}.{f.name}").cast(f.dataType).alias(f.name) for f in field.dataType])
    return F.when(F.col(field.name).isNotNull(), parts).alias(field.name)


def drift_alert(report_row) -> tuple[str, str]:
    """Subject and text of the drift alert: counts, drift rate, the first five drifted features."""
    d = report_row["feature_drift"]
    body = "\n".join([f"Features drifted: {d['features_drifted']}/{d['features_checked']}", f"Drift rate: {d['drift_rate']:.1%}",
                      f"Top drifted features: {', '.join((d['drifted_features'] or [])[:5])}", f"Timestamp: {report_row['timestamp']}"])
    return "Data Drift Detected", body


def started_alert(reason: str) -> tuple[str, str]:
    """Subject and text of the alert before a retraining."""
    return "Model Retraining Started", f"Reason: {reason}"


def completed_alert(result: "RetrainResult") -> tuple[str, str]:
    """Subject and text of the alert after a retraining."""
    state = "DEPLOYED" if result.deployed else "NOT DEPLOYED"
    score = 0.0 if result.best_score is None else result.best_score
    body = "\n".join([f"Best model: {result.best_model or 'Unknown'}", f"Best score: {score:.4f}", f"Deployed: {result.deployed}",
                      f"Reason: {result.comparison_reason}", f"Duration: {result.duration_seconds:.1f} seconds",
                      f"Timestamp: {result.timestamp}"])
    return f"Model Retraining Complete - {state}", body


def alert_rows(spark: SparkSession, kind: str, subject: str, body: str) -> DataFrame:
    """An alert record (appended to the alerts table instead of being mailed)."""
    return spark.createDataFrame([(_dt.datetime.now(_dt.timezone.utc), kind, subject, body)],
                                 "ts timestamp, kind string, subject string, body string")


def promote(spark: SparkSession, model, model_dir: str, ts: str, name: str, auc: float, accuracy: float,
            source: str = "retraining") -> str:
    """Save the model under a new versioned path and append a deployment record; the live
    model is the latest record, so earlier versions stay available."""
    path = f"{model_dir}/versions/{ts.replace(':', '-')}"
    model.write().overwrite().save(path)
    spark.createDataFrame([(ts, name, float(auc), float(accuracy), "deployed", source, path)],
                          "deployment_timestamp string, model_name string, roc_auc double, accuracy double, "
                          "status string, source string, path string") \
        .write.mode("append").parquet(f"{model_dir}/deployments")
    return path


def live_model_path(spark: SparkSession, model_dir: str) -> str | None:
    """The path of the latest deployment record (K4 over the deployments table)."""
    from ..operators.profile import latest
    rows = latest(spark.read.parquet(f"{model_dir}/deployments"), "deployment_timestamp").collect()
    return rows[0]["path"] if rows else None


@dataclass
class RetrainResult:
    success: bool
    deployed: bool
    trigger_reason: str
    comparison_reason: str
    best_model: str | None
    best_score: float | None
    duration_seconds: float
    timestamp: str


def retrain(spark: SparkSession, data: DataFrame, features: list[str], trigger_reason: str,
            champion=None, kinds: tuple = ("random_forest", "boosted_trees"), seed: int = 42,
            model_dir: str | None = None) -> tuple[RetrainResult, object]:
    """Validate, split, fit candidates of 300 trees, pick the best by exact AUC, compare with the champion,
    and (M12) save the winner under a versioned path. No oversampling here, as in the original."""
    from ..operators.sampling import stratified_split
    from ..session import checkpoint
    t0 = time.time()
    ts = _dt.datetime.now(_dt.timezone.utc).isoformat()
    v = validate_training_data(data.select(*features, S.LABEL)).first()
    if not v["is_valid"]:
        return RetrainResult(False, False, trigger_reason, v["message"], None, None, time.time() - t0, ts), None
    split = checkpoint(stratified_split(data, 0.2, seed))
    train, test = split.where(F.col("split") == "train"), split.where(F.col("split") == "test")
    rows, models = [], {}
    for i, kind in enumerate(kinds):
        m = MD.fit(train, features, kind, {"n_estimators": 300}, seed)
        models[kind] = m
        met = MD.class_metrics(MD.score(m, test)).first()
        rows.append((i, kind, met["roc_auc"], met["accuracy"]))
    table = spark.createDataFrame(rows, "position int, model string, roc_auc double, accuracy double")
    best = MD.best_by(table, "roc_auc", "position").first()
    prod_auc = None
    if champion is not None:
        prod_auc = MD.class_metrics(MD.score(champion, test)).first()["roc_auc"]
    dec = spark.range(1).select(*champion_challenger(F.lit(best["roc_auc"]),
                                                     F.lit(prod_auc).cast("double"))).first()
    deployed, reason = bool(dec[0]), dec[1]
    if deployed and model_dir:
        promote(spark, models[best["model"]], model_dir, ts, best["model"], best["roc_auc"], best["accuracy"])
    res = RetrainResult(True, deployed, trigger_reason, reason, best["model"], float(best["roc_auc"]),
                        time.time() - t0, ts)
    return res, models[best["model"]]

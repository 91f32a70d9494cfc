"""End-to-end jobs: a training run (M17) and one monitoring cycle.

Both are driver functions over Spark jobs. Stage outputs that later stages read several times
(the cleaned table, the split feature table) are checkpointed to the shared folder named by
``spark.checkpoint.dir``, so a lost executor costs a recomputation of one stage, not the lineage.
Statistics are fitted on the training split only (``fit_on="train"``); ``fit_on="all"`` fits
them on every row, as the original did.
"""

from __future__ import annotations

import datetime as _dt
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.features import FeatureStats, engineer_features, fit_feature_stats
from ..operators import clean as C
from ..operators import models as MD
from ..operators import sampling as SP
from ..operators import profile as P
from ..operators.profile import merge_training_data
from ..session import checkpoint
from ..sources import io as IO
from ..sources.fixture import customer_usage
from . import monitoring as M

BASE_FEATURES = [c for c in S.NUMERIC_INPUTS if "charge" not in c]


def run_training(spark: SparkSession, sf_dir: str, out_dir: str, n_select: int = 20, rfe_step: float = 1,
                 kinds: tuple = tuple(MD.KINDS), tune: bool = True, n_iter: int = 8, folds: int = 3,
                 use_smote: bool = True, fit_on: str = "train", seed: int = 42, run_id: str | None = None) -> dict:
    """Merge -> clean -> split -> features -> RFE -> SMOTE -> fit/tune -> evaluate -> save."""
    t0 = time.time()
    run_id = run_id or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    metrics_path = f"{out_dir}/metrics"
    raw = checkpoint(customer_usage(spark, sf_dir))
    IO.log_metrics(spark, metrics_path, run_id, "merge", {"rows_merged": raw.count()})
    levels = C.fit_levels(raw, "state")
    clean = checkpoint(C.preprocess(raw, levels=levels))
    IO.log_metrics(spark, metrics_path, run_id, "preprocess", {"cleaned_rows": clean.count()})

    split = checkpoint(SP.stratified_split(clean, 0.2, seed))
    train0 = split.where(F.col("split") == "train")
    stats = fit_feature_stats(train0 if fit_on == "train" else split)
    feats = checkpoint(engineer_features(split, stats))
    candidates = [c for c in BASE_FEATURES + S.ENGINEERED + [c for c in feats.columns if c.startswith("state_")]
                  if c in feats.columns]
    train = feats.where(F.col("split") == "train")
    test = feats.where(F.col("split") == "test")

    ranking = MD.rfe(train if fit_on == "train" else feats, candidates, n_select=min(n_select, len(candidates)),
                     step=rfe_step, num_trees=200, seed=seed)
    selected = [f for f, r in ranking if r == 1]
    IO.save_features(spark, selected, f"{out_dir}/selected_features")
    IO.save_split(feats.select(S.ID, *selected, S.LABEL, "split"), f"{out_dir}/split")

    fit_rows = train.select(S.ID, *selected, S.LABEL)
    if use_smote:
        fit_rows = checkpoint(SP.smote(fit_rows, selected, seed=seed).drop("synthetic"))
    fit_rows = checkpoint(SP.kfold(fit_rows, folds, seed))

    rows, models = [], {}
    for i, kind in enumerate(kinds):
        if tune and kind in MD.SEARCH_SPACE:
            res = MD.random_search(fit_rows, selected, kind, n_iter=n_iter, folds=folds, seed=seed)
            model, params = res.model, res.best_params
        else:
            model, params = MD.fit(fit_rows, selected, kind, {}, seed), {}
        models[kind] = model
        met = MD.class_metrics(MD.score(model, test)).first().asDict()
        rows.append((i, kind, met["accuracy"], met["precision"], met["recall"], met["f1_score"], met["roc_auc"],
                     str(params)))
        IO.log_metrics(spark, metrics_path, run_id, kind, {k: met[k] for k in ("accuracy", "roc_auc")})
    table = spark.createDataFrame(rows, "position int, model string, accuracy double, precision double, "
                                        "recall double, f1_score double, roc_auc double, params string")
    IO.write_table(table, f"{out_dir}/evaluation")
    best = MD.best_by(table, "roc_auc", "position").first()
    IO.save_model(models[best["model"]], f"{out_dir}/model")
    spark.createDataFrame([stats.as_dict()]).write.mode("overwrite").json(f"{out_dir}/feature_stats")
    return {"run_id": run_id, "selected": selected, "best_model": best["model"], "best_roc_auc": best["roc_auc"],
            "evaluation": [r.asDict() for r in table.orderBy("position").collect()],
            "duration_seconds": time.time() - t0}


def retraining_rows(spark: SparkSession, reference: DataFrame, batches: str, features: list[str]) -> DataFrame:
    """M14 + U2: the reference rows plus every landed batch that has all columns, numbered anew (a customer
    may be in several batches)."""
    landed = IO.read_batches(spark, batches, [*features, S.LABEL])
    return checkpoint(merge_training_data(reference, landed, features).withColumn(S.ID, F.monotonically_increasing_id()))


def profile_of(model, reference: DataFrame, features: list[str]) -> DataFrame:
    """M1 of the reference with the model's scores (without a model, no score counts)."""
    if model is None:
        return M.reference_profile(reference, features)
    return M.reference_profile(MD.score(model, reference), features, "churn_probability")


def monitoring_cycle(spark: SparkSession, out_dir: str, reference: DataFrame | None, batch: DataFrame, features: list[str],
                     model, with_labels: bool = True, cooldown_days: int = 0, retrain_data: DataFrame | None = None,
                     model_dir: str | None = None) -> dict:
    """Land the batch, build the report, write it, raise alerts, honour the cooldown and
    retrain when recommended, by default on the reference and all landed batches. Reports, alerts and
    retraining summaries are tables.

    The reference is read in the first cycle, when its profile is stored, in a retraining, and when a new
    model's scores replace those of the profile; any other cycle reads the batch and the profile only.
    """
    ts = IO.write_batch(batch, f"{out_dir}/batches")
    profile = M.load_profile(spark, f"{out_dir}/profile")
    if profile is None:
        M.save_profile(profile_of(model, reference, features), f"{out_dir}/profile")
        profile = M.load_profile(spark, f"{out_dir}/profile")
    report = M.monitoring_report(model, profile, batch, features, with_labels)
    IO.write_report(report, f"{out_dir}/reports")
    # the decision is read off the written report; nothing is computed twice
    r = P.latest(IO.read_reports(spark, f"{out_dir}/reports", M.REPORT_SCHEMA), "timestamp").first()
    out = {"batch_ts": ts, "recommended": r["retraining"]["recommended"], "reason": r["retraining"]["reason"],
           "drift_rate": r["feature_drift"]["drift_rate"], "retrained": False}
    alert = lambda kind, text: M.alert_rows(spark, kind, *text).write.mode("append").parquet(f"{out_dir}/alerts")
    if not out["recommended"]:
        return out
    alert("drift", M.drift_alert(r))
    hist_path = f"{out_dir}/retraining"
    try:
        hist = spark.read.parquet(hist_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        hist = spark.createDataFrame([], "timestamp timestamp")
    gate = M.cooldown_gate(hist.select(F.col("timestamp").cast("timestamp").alias("timestamp")), cooldown_days).first()
    if not gate["allowed"]:
        out["reason"] += f"; cooldown: {gate['days_since']} days since last retraining"
        return out
    alert("retrain_started", M.started_alert(out["reason"]))
    data = retrain_data if retrain_data is not None else retraining_rows(spark, reference, f"{out_dir}/batches", features)
    res, new_model = M.retrain(spark, data, features, out["reason"], champion=model, model_dir=model_dir)
    summary = spark.createDataFrame([(res.success, res.deployed, res.trigger_reason, res.comparison_reason,
                                      res.best_model, res.best_score, res.duration_seconds, res.timestamp)],
                                    "success boolean, deployed boolean, trigger_reason string, comparison_reason string, "
                                    "best_model string, best_score double, duration_seconds double, timestamp string")
    summary.write.mode("append").parquet(hist_path)
    alert("retrain", M.completed_alert(res))
    if res.deployed and reference is not None:
        M.save_profile(profile_of(new_model, reference, features), f"{out_dir}/profile")
    out.update({"retrained": res.success, "deployed": res.deployed, "comparison": res.comparison_reason})
    return out


def load_stats(spark: SparkSession, path: str) -> FeatureStats:
    r = spark.read.json(path).first()
    return FeatureStats(r["max_total_minutes"], r["median_intl_minutes"])

"""Monitoring on the stored reference profile."""

import tempfile

import pytest
from pyspark.sql import functions as F

from churnlab import schema as S
from churnlab.operators import models as MD
from churnlab.operators import ordered as W
from churnlab.operators import stats as Q
from churnlab.plans import monitoring as M
from churnlab.plans.training import monitoring_cycle
from churnlab.sources import io as IO

FEATURES = ["x", "y"]


def rows(spark, n, shift=0.0, null_every=0):
    df = spark.range(n).select(
        F.col("id").alias(S.ID), (F.col("id") % 37 + shift).cast("double").alias("x"), (F.col("id") % 11).cast("double").alias("y"),
        (F.col("id") % 11 < 3).cast("int").alias(S.LABEL))
    if null_every:
        df = df.withColumn("x", F.when(F.col(S.ID) % null_every != 0, F.col("x")))
    return df


@pytest.fixture(scope="module")
def model(spark):
    return MD.fit(rows(spark, 400), FEATURES, "decision_tree", {"max_depth": 3})


def close(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for k, v in x.asDict().items():
            assert y[k] == (pytest.approx(v, rel=1e-9) if isinstance(v, float) else v), k


def test_profile_checks_equal_those_on_the_rows(spark, model):
    path = tempfile.mkdtemp(prefix="churnlab-prof-") + "/profile"
    ref, new = MD.score(model, rows(spark, 900, null_every=7)), MD.score(model, rows(spark, 260, shift=3.0, null_every=5))
    assert M.load_profile(spark, path) is None
    M.save_profile(M.reference_profile(rows(spark, 50), FEATURES), path, "2000")
    M.save_profile(M.reference_profile(ref, FEATURES, "churn_probability"), path, "2001")   # the latest version counts
    profile = M.load_profile(spark, path)
    summary, ks = M.profile_feature_drift(profile, new, [*FEATURES, "absent"])
    close(ks.orderBy("feature").collect(), W.ks_2samp(ref, new, FEATURES).orderBy("feature").collect())
    close(summary.collect(), M.feature_drift(ref, new, FEATURES)[0].collect())
    close(M.profile_prediction_drift(profile, new).collect(), M.prediction_drift(ref, new).collect())
    close(M.profile_target_drift(profile, new).collect(), Q.chi2_gof(ref, new).collect())


def test_empty_batch_and_no_common_feature(spark, model):
    profile = M.reference_profile(MD.score(model, rows(spark, 100)), FEATURES, "churn_probability")
    empty = MD.score(model, rows(spark, 100).limit(0))
    assert all(not r["drift_detected"] for r in M.profile_feature_drift(profile, empty, FEATURES)[1].collect())
    assert M.profile_feature_drift(profile, empty, ["absent"])[0].first()["features_checked"] == 0
    assert M.profile_prediction_drift(profile, empty).first()["mean_prediction_new"] is None


def test_cycles_after_the_first_read_the_batch_only(spark, model):
    out = tempfile.mkdtemp(prefix="churnlab-cycle-")
    first = monitoring_cycle(spark, out, rows(spark, 900), rows(spark, 300), FEATURES, model)
    again = monitoring_cycle(spark, out, None, rows(spark, 300), FEATURES, model)       # no reference rows at all
    assert (first["recommended"], first["drift_rate"]) == (again["recommended"], again["drift_rate"]) and again["drift_rate"] == 0.0
    drop = monitoring_cycle(spark, out, None, rows(spark, 300, shift=40.0), FEATURES, model, with_labels=False,
                            retrain_data=rows(spark, 60))
    assert drop["recommended"] and drop["drift_rate"] == 0.5
    reports = IO.read_reports(spark, f"{out}/reports", M.REPORT_SCHEMA).orderBy("timestamp").collect()
    assert [r["target_drift"] is None for r in reports] == [False, False, True]
    assert not reports[1]["prediction_drift"]["drift_detected"] and reports[1]["prediction_drift"]["ks_statistic"] < 0.02 and reports[2]["performance"] is None
    alerts = {r["kind"]: r for r in spark.read.parquet(f"{out}/alerts").collect()}
    assert set(alerts) == {"drift", "retrain_started", "retrain"}
    assert "Features drifted: 1/2" in alerts["drift"]["body"] and "Drift rate: 50.0%" in alerts["drift"]["body"]
    assert "x" in alerts["drift"]["body"] and "High drift rate" in alerts["retrain_started"]["body"]
    assert "NOT DEPLOYED" in alerts["retrain"]["subject"] and "Insufficient samples: 60 < 1000" in alerts["retrain"]["body"]


def test_decisions_use_the_unrounded_auc(spark):
    # AUC 0.7499996...: rounded to six places it would pass the threshold of 0.75
    n = 2_000_000
    scored = spark.createDataFrame([(1.0, 0.5, n * 3 - 3), (1.0, -0.5, n + 3), (0.0, 0.0, 4)], "label double, churn_probability double, k int")
    table = scored.select("label", "churn_probability", (F.col("churn_probability") > 0).alias("churn_prediction"),
                          F.explode(F.expr("sequence(1, k)"))).drop("col")
    row = M.evaluate_performance(table).first()
    assert row["roc_auc"] < 0.75 and row["below_threshold"] and round(row["roc_auc"], 6) == 0.75

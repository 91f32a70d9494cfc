"""The training run (M17) and one monitoring cycle (M15) end to end on the small fixture."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL

from churnlab.plans.training import monitoring_cycle, run_training
from churnlab.sources import io as IO


def test_training_run_and_cycle(spark):
    out = tempfile.mkdtemp(prefix="churnlab-run-")
    res = run_training(spark, SF_SMALL, out, n_select=8, rfe_step=0.5, kinds=("logistic_regression", "decision_tree"),
                       tune=False, folds=3)
    assert len(res["selected"]) == 8
    assert res["best_model"] in ("logistic_regression", "decision_tree")
    assert [r["position"] for r in res["evaluation"]] == [0, 1]
    model = IO.load_model(f"{out}/model")
    feats = IO.load_features(spark, f"{out}/selected_features")
    assert feats == res["selected"]
    split = spark.read.parquet(f"{out}/split")
    ref = split.where(F.col("split") == "train").drop("split")
    new = split.where(F.col("split") == "test").drop("split")
    # a drift-free cycle: report written, nothing triggered
    cyc = monitoring_cycle(spark, out, ref, new, feats, model, model_dir=f"{out}/models")
    assert spark.read.json(f"{out}/reports").count() == 1
    assert cyc["batch_ts"] and "recommended" in cyc
    # a cycle whose batch differs strongly: retraining is recommended, then refused by the
    # data check (150 rows < 1000), and the refusal is recorded
    shifted = new.withColumns({f: F.col(f) * 50 + 1000 for f in feats})
    cyc2 = monitoring_cycle(spark, out, ref, shifted, feats, model, model_dir=f"{out}/models")
    assert cyc2["recommended"] and "High drift rate" in cyc2["reason"]
    hist = spark.read.parquet(f"{out}/retraining").collect()
    assert hist and not hist[-1]["success"] and hist[-1]["comparison_reason"].startswith("Insufficient samples")
    kinds = sorted(r["kind"] for r in spark.read.parquet(f"{out}/alerts").collect())
    assert kinds == ["drift", "retrain", "retrain_started"]

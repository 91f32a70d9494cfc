"""Retraining reads every landed batch."""

import tempfile

from pyspark.sql import functions as F

from churnlab import schema as S
from churnlab.plans import monitoring as M
from churnlab.plans.training import monitoring_cycle
from churnlab.sources import io as IO


def test_cycle_after_two_landed_batches_trains_on_all(spark, monkeypatch):
    out, seen = tempfile.mkdtemp(prefix="churnlab-rows-"), {}
    rows = lambda lo, n: spark.range(lo, lo + n).select(F.col("id").alias(S.ID), F.col("id").cast("double").alias("x"),
                                                        (F.col("id") % 2).cast("int").alias(S.LABEL))
    report = spark.sql("SELECT struct(true AS recommended, 'r' AS reason) AS retraining, struct(0.5 AS drift_rate) AS feature_drift")
    monkeypatch.setattr(M, "monitoring_report", lambda *a: report)

    def retrain(spark, data, features, reason, **_):
        seen["rows"] = data.collect()
        return M.RetrainResult(False, False, reason, "stub", None, None, 0.0, "2026-01-01T00:00:00"), None

    monkeypatch.setattr(M, "retrain", retrain)
    IO.write_batch(rows(100, 20), f"{out}/batches", "20260101T000000")
    IO.write_batch(rows(200, 30), f"{out}/batches", "20260102T000000")
    IO.write_batch(rows(900, 5).drop("x"), f"{out}/batches", "20260103T000000")  # does not conform
    monitoring_cycle(spark, out, rows(0, 10), rows(200, 7), ["x"], None)
    assert sorted(r["x"] for r in seen["rows"]) == sorted(float(i) for i in [*range(10), *range(100, 120), *range(200, 230), *range(200, 207)])
    assert len({r[S.ID] for r in seen["rows"]}) == 67

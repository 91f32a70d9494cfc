"""Drift per closed window: equal to KS on the rows, stream equal to batch on late and unordered input."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from churnlab.operators import ordered as W
from churnlab.plans import monitoring as M
from churnlab.streaming import drift as D

FEATURES = ["x", "y"]
BEGIN = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def table(spark, n, shift=0.0):
    """Rows of three days; x drifts on the second one, y is null every fifth time."""
    t = F.timestamp_seconds(F.lit(int(BEGIN.timestamp())) + F.col("id") * F.lit(3 * 86400 // n))
    day = F.dayofmonth("ts")
    return (spark.range(n).withColumn("ts", t)
            .withColumn("x", (F.col("id") % 23 + F.when(day == 2, F.lit(9.0 + shift)).otherwise(F.lit(shift))).cast("double"))
            .withColumn("y", F.when(F.col("id") % 5 != 0, (F.col("id") % 7).cast("double"))).select("ts", "x", "y"))


def reference(spark, n=700):
    return spark.range(n).select((F.col("id") % 23).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"),
                                 (F.col("id") % 3 == 0).cast("int").alias("churn"))


def facts(df):
    return {(r["window_start"], r["feature"]): (r["ks_statistic"], r["n_ref"], r["n_new"], pytest.approx(r["p_value"], abs=1e-12),
                                                r["drift_detected"]) for r in df.collect()}


def test_windows_equal_ks_on_their_rows(spark):
    ref, new = reference(spark), table(spark, 900)
    got = D.window_drift(M.reference_profile(ref, FEATURES), new, FEATURES)
    by = facts(got)
    assert len(by) == 6
    for start in {w for w, _ in by}:
        part = new.where((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(start + dt.timedelta(days=1))))
        for r in W.ks_2samp(ref, part, FEATURES).collect():
            assert by[(start, r["feature"])] == (r["ks_statistic"], r["n_ref"], r["n_new"], pytest.approx(r["p_value"], abs=1e-12), r["drift_detected"])
    rates = [r["drift_rate"] for r in D.window_rates(got).orderBy("window_start").collect()]
    assert rates == [0.0, 0.5, 0.0]


def test_values_outside_the_reference_and_absent_features(spark):
    profile = M.reference_profile(reference(spark), ["x"])
    far = table(spark, 300, shift=1000.0)
    for (_, feature), row in facts(D.window_drift(profile, far, FEATURES)).items():
        assert row[0] == 1.0 and row[4] if feature == "x" else row[0] is None and not row[4]
    assert D.window_drift(profile, far.limit(0), FEATURES).count() == 0
    nan = far.withColumn("x", F.lit(float("nan")))
    assert {f for _, f in facts(D.window_drift(profile, nan, FEATURES))} == {"y"}


def test_stream_equals_batch_on_unordered_and_late_rows(spark):
    base = tempfile.mkdtemp(prefix="churnlab-drift-")
    M.save_profile(M.reference_profile(reference(spark), FEATURES), f"{base}/profile")
    profile = M.load_profile(spark, f"{base}/profile")
    rows = table(spark, 900)
    # the first file mixes days one and two out of order, the second closes both, the third comes too late for them
    first, rest = rows.where(F.dayofmonth("ts") < 3), rows.where(F.dayofmonth("ts") == 3)
    late = rows.where(F.dayofmonth("ts") == 1).withColumn("x", F.lit(5000.0))

    def run():
        query = D.stream_drift(spark, f"{base}/in", rows.schema, profile, FEATURES, f"{base}/out", f"{base}/ck", watermark="1 hour")
        query.processAllAvailable()
        kept = query.lastProgress["stateOperators"][0]["numRowsTotal"] if query.lastProgress and query.lastProgress["stateOperators"] else None
        query.stop()
        return kept

    for part in (first.orderBy(F.xxhash64("ts")), rest, late):
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
        kept = run()                             # a restart from the checkpoint each time
    assert kept == 23 + 7                        # state: the distinct values of the open third day alone
    out = spark.read.parquet(f"{base}/out")
    batch = D.window_drift(profile, first, FEATURES)
    assert facts(out.drop("batch_id")) == facts(batch) and out.count() == 4
    owners = out.groupBy("window_start").agg(F.countDistinct("batch_id").alias("n")).collect()
    assert [r["n"] for r in owners] == [1, 1]    # a window closes in one micro-batch, which owns its folder

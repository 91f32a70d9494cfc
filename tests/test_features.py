"""Hand-computed rows for the feature and cleaning rules (null and edge semantics)."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import PRESETS

from churnlab import schema as S
from churnlab.functions.bins import cut
from churnlab.functions.features import FeatureStats, engineer_features
from churnlab.operators import clean as C


def _requests(spark, rows):
    cols = [f[0] for f in S.REQUEST_FIELDS]
    data = [(i, *[r.get(c) for c in cols]) for i, r in enumerate(rows)]
    schema = "customer_id long, account_length int, international_plan string, voice_mail_plan string, " \
             "number_vmail_messages int, total_day_minutes double, total_eve_minutes double, " \
             "total_night_minutes double, total_intl_minutes double, total_day_calls int, total_eve_calls int, " \
             "total_night_calls int, total_intl_calls int, customer_service_calls int"
    return spark.createDataFrame(data, schema)


def test_high_risk_preset(spark):
    df = C.encode_yes_no(_requests(spark, [PRESETS["high"]]))
    r = engineer_features(df, FeatureStats(1000.0, 10.0)).first().asDict()
    assert r["total_minutes"] == 715.0
    assert r["total_calls"] == 310.0
    assert r["customer_tenure_months"] == 1.5
    assert r["avg_daily_usage"] == pytest.approx(286.0)
    assert r["call_frequency"] == pytest.approx(124.0)
    assert r["high_service_calls"] == 1 and r["has_vmail"] == 0
    assert r["tenure_usage_score"] == pytest.approx(429.0)
    assert r["service_calls_per_month"] == pytest.approx(2.0)
    assert r["usage_service_interaction"] == pytest.approx(715.0 / 1001.0 * 5)
    assert r["intl_plan_usage_flag"] == 1  # plan holder and 15 > 10
    assert r["log_total_minutes"] == pytest.approx(math.log1p(715.0))


def test_frame_local_stats_differ_from_fitted(spark):
    """A one-row frame with frame-local statistics: the flag can never fire (the train/score skew)."""
    df = C.encode_yes_no(_requests(spark, [PRESETS["high"]]))
    local = engineer_features(df).first()
    assert local["intl_plan_usage_flag"] == 0
    assert local["usage_service_interaction"] == pytest.approx(715.0 / 716.0 * 5)


def test_null_rules(spark):
    df = spark.createDataFrame(
        [(1, None, None, 2.0, None, None, 4, None)],
        "customer_id long, total_day_minutes double, total_eve_minutes double, total_night_minutes double, "
        "total_intl_minutes double, account_length int, customer_service_calls int, number_vmail_messages int")
    r = engineer_features(df, FeatureStats(10.0, 1.0)).first()
    assert r["total_minutes"] == 2.0            # NULLs skipped in the row sum
    assert r["high_service_calls"] == 1
    assert r["has_vmail"] == 0                  # NULL comparison counts as false
    assert r["customer_tenure_months"] is None
    assert r["avg_daily_usage"] == 0.0          # NULL filled with 0 then clipped before the log
    assert r["intl_usage_rate"] is None


def test_cut_is_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in [-1, 0, 1, 2, 3, 4, None]], "x int")
    got = [r[0] for r in df.select(cut(F.col("x"), [-1, 1, 3, math.inf], ["L", "M", "H"])).collect()]
    assert got == [None, "L", "L", "M", "M", "H", None]
    low = [r[0] for r in df.select(cut(F.col("x"), [0, 1, 3], ["a", "b"], include_lowest=True)).collect()]
    assert low[1] == "a"


def test_impute_encode_one_hot(spark):
    df = spark.createDataFrame(
        [(1, "B", "Yes", 1.0, True), (2, None, None, None, False), (3, "A", "No", 3.0, False),
         (4, "B", "No", 5.0, True)],
        "customer_id long, state string, voice_mail_plan string, total_eve_minutes double, churn boolean")
    out = C.preprocess(df).orderBy("customer_id").collect()
    assert out[1]["total_eve_minutes"] == 3.0   # median of 1, 3, 5
    assert out[1]["state_b"] == 1               # mode B fills the NULL state
    assert out[1]["voice_mail_plan"] == 0       # mode No, encoded
    assert "state_a" not in out[0].asDict()     # first level dropped
    assert [r["churn"] for r in out] == [1, 0, 0, 1]


def test_mode_ties_pick_smallest(spark):
    df = spark.createDataFrame([(1, "B"), (2, "A"), (3, None)], "customer_id long, state string")
    assert C.fit_imputation(df).modes["state"] == "A"


def test_dedup_keeps_smallest_id(spark):
    df = spark.createDataFrame([(5, "x", None), (2, "x", None), (3, "y", 1.0)], "customer_id long, a string, b double")
    got = sorted(tuple(r) for r in C.dedup_rows(df).collect())
    assert got == [(2, "x", None), (3, "y", 1.0)]


def test_validate_requests(spark):
    bad = dict(PRESETS["high"], account_length=400, international_plan="Maybe")
    partial = {k: PRESETS["low"][k] for k in list(PRESETS["low"])[:6]}
    df = _requests(spark, [PRESETS["high"], bad, partial])
    rows = C.validate_requests(df).orderBy("customer_id").collect()
    assert rows[0]["is_valid"]
    assert set(rows[1]["reject_reasons"]) == {"account_length: must be in [1, 250]",
                                              "international_plan: must be Yes or No"}
    assert not rows[2]["is_valid"] and len(rows[2]["reject_reasons"]) == 7


def test_clip_iqr_keeps_null(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]] + [(None,)], "x double")
    got = [r[0] for r in C.clip_iqr(df, ["x"]).collect()]
    assert got[-1] is None and max(v for v in got if v is not None) == pytest.approx(4 + 1.5 * 2)


def test_round_and_band(spark):
    df = spark.createDataFrame([(0.5,), (0.50001,), (None,)], "p double")
    pred, band = C.churn_band("p")
    got = [tuple(r) for r in df.select(pred, band).collect()]
    assert got == [(False, "Low"), (True, "High"), (False, "Low")]


def test_one_hot_levels_with_equal_safe_names(spark):
    df = spark.createDataFrame([("a b",), ("a-b",), ("c",), (None,)], "state string")
    out = C.one_hot(df, "state", levels=["a b", "a-b", "c"], drop_first=False)
    assert len(out.columns) == 3
    assert [tuple(r) for r in out.collect()] == [(1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 0)]
    assert out.columns[1:] == C.one_hot(df, "state", levels=["a b", "a-b", "c"]).columns

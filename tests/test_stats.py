"""p-value functions against textbook values, and invariants of the ordered operators."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from churnlab.functions import pvalues as PV
from churnlab.operators import ordered as W
from churnlab.operators import stats as Q


def test_pvalue_functions():
    assert PV.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert PV.t_two_sided(2.228138851986, 10) == pytest.approx(0.05, rel=1e-6)
    assert PV.f_sf(4.102821015130, 2, 10) == pytest.approx(0.05, rel=1e-6)
    # the published (statistic, p) pairs at one degree of freedom
    assert PV.chi2_sf(222.57, 1) == pytest.approx(2.49e-50, rel=0.01)
    assert PV.chi2_sf(34.13, 1) == pytest.approx(5.15e-09, rel=0.01)
    # Kolmogorov limit: Q(1.3581) ~ 0.05
    assert PV.ks_two_sample(1.3581 / np.sqrt(5e6), 1e7, 1e7) == pytest.approx(0.05, abs=2e-3)  # ne = 5e6
    assert PV.t_two_sided(40.0, 500) < 1e-100


def test_cramers_v_matches_published():
    assert np.sqrt(222.57 / 3333) == pytest.approx(0.258, abs=5e-4)
    assert np.sqrt(34.13 / 3333) == pytest.approx(0.101, abs=5e-4)


def test_prefix_sums_exact(spark):
    rng = np.random.RandomState(7)
    pdf = pd.DataFrame({"g": rng.randint(0, 3, 5000), "v": rng.randint(0, 700, 5000)})
    d = pdf.groupby(["g", "v"]).size().reset_index(name="n")
    sdf = spark.createDataFrame(d)
    out = W.prefix_sums(sdf, ["g"], "v", ["n"], n_buckets=16).toPandas().sort_values(["g", "v"])
    d = d.sort_values(["g", "v"])
    expect = d.groupby("g")["n"].cumsum().to_numpy()
    assert (out["cum_n"].to_numpy() == expect).all()
    desc = W.prefix_sums(sdf, ["g"], "v", ["n"], descending=True, n_buckets=8).toPandas().sort_values(["g", "v"])
    expect_desc = d.iloc[::-1].groupby("g")["n"].cumsum().iloc[::-1].to_numpy()
    assert (desc["cum_n"].to_numpy() == expect_desc).all()


def test_auc_equals_exact_evaluator(spark):
    rng = np.random.RandomState(3)
    y = rng.randint(0, 2, 3000)
    s = np.round(rng.rand(3000) * 0.5 + y * 0.3, 2)  # many ties
    df = spark.createDataFrame(pd.DataFrame({"score": s, "label": y.astype(float)}))
    ours = W.roc_auc(df, "score", "label").first()["roc_auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert ours == pytest.approx(ev.evaluate(df), abs=1e-12)


def test_ks_properties(spark):
    rng = np.random.RandomState(1)
    a = spark.createDataFrame(pd.DataFrame({"x": rng.normal(size=800)}))
    b = spark.createDataFrame(pd.DataFrame({"x": rng.normal(0.5, 1, size=600)}))
    self_ks = W.ks_2samp(a, a, ["x"]).first()
    assert self_ks["ks_statistic"] == 0.0 and self_ks["p_value"] == pytest.approx(1.0)
    ab, ba = W.ks_2samp(a, b, ["x"]).first(), W.ks_2samp(b, a, ["x"]).first()
    assert ab["ks_statistic"] == ba["ks_statistic"] > 0.1
    assert ab["drift_detected"]


def test_welch_and_anova_textbook(spark):
    pdf = pd.DataFrame({"churn": [1] * 5 + [0] * 6,
                        "x": [20.1, 21.5, 19.8, 22.4, 20.9, 18.2, 17.9, 18.8, 19.1, 17.5, 18.4]})
    df = spark.createDataFrame(pdf)
    r = Q.welch_t(df, ["x"]).first()
    a, b = pdf.x[pdf.churn == 1], pdf.x[pdf.churn == 0]
    se = np.sqrt(a.var() / len(a) + b.var() / len(b))
    assert r["t_statistic"] == pytest.approx((a.mean() - b.mean()) / se)
    assert 0 < r["p_value"] < 0.01
    g = spark.createDataFrame(pd.DataFrame({"g": ["a", "a", "b", "b", "c", "c"], "v": [1.0, 2, 3, 4, 5, 7]}))
    f = Q.anova_f(g, "g", "v").first()
    # SSB = 2*((1.5-3.667)^2 + (3.5-3.667)^2 + (6-3.667)^2) = 20.333; SSW = 0.5+0.5+2 = 3
    assert f["f_statistic"] == pytest.approx((20.3333333 / 2) / (3 / 3), rel=1e-6)


def test_chi2_yates(spark):
    pdf = pd.DataFrame({"plan": [1] * 30 + [0] * 70, "churn": [1] * 20 + [0] * 10 + [1] * 15 + [0] * 55})
    r = Q.chi2_independence(spark.createDataFrame(pdf), ["plan"]).first()
    # 2x2 with Yates: O=[[20,10],[15,55]], E=[[10.5,19.5],[24.5,45.5]], |O-E|-0.5 = 9
    expect = sum(9.0 ** 2 / e for e in [10.5, 19.5, 24.5, 45.5])
    assert r["chi2"] == pytest.approx(expect)
    assert r["dof"] == 1


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.RandomState(5)
    v = rng.randint(0, 50, 997).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"a": v}))
    got = {r["p"]: r["value"] for r in W.exact_quantiles(df, ["a"], [0.1, 0.5, 0.9]).collect()}
    for p, q in got.items():
        assert q == pytest.approx(np.quantile(v, p))


def test_roc_curve_drops_collinear(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.7, 0), (0.6, 0), (0.5, 1)], "score double, label int")
    pts = W.roc_curve(df, "score", "label").orderBy("point").collect()
    fpr = [p["fpr"] for p in pts]
    tpr = [p["tpr"] for p in pts]
    assert fpr[0] == 0 and tpr[0] == 0 and pts[0]["threshold"] == float("inf")
    assert (fpr[-1], tpr[-1]) == (1.0, 1.0)
    assert len(pts) == 5  # threshold 0.7 lies on the segment from 0.8 to 0.6 and is dropped
    assert 0.7 not in [p["threshold"] for p in pts]


def test_prefix_sums_many_ranges(spark):
    rng = np.random.RandomState(9)
    pdf = pd.DataFrame({"g": rng.randint(0, 2, 4000), "v": rng.normal(size=4000)}).drop_duplicates(["g", "v"])
    pdf["n"] = rng.randint(1, 5, len(pdf))
    sdf = spark.createDataFrame(pdf)
    out = W.prefix_sums(sdf, ["g"], "v", ["n"], n_buckets=400, total_prefix="all_", next_prefix="next_").toPandas() \
        .sort_values(["g", "v"])
    d = pdf.sort_values(["g", "v"])
    group = d.groupby("g")["n"]
    assert (out["cum_n"].to_numpy() == group.cumsum().to_numpy()).all()
    assert (out["all_n"].to_numpy() == group.transform("sum").to_numpy()).all()
    assert (out["next_n"].fillna(-1).to_numpy() == group.shift(-1).fillna(-1).to_numpy()).all()


def test_null_and_empty_keys_are_groups_of_their_own(spark):
    df = spark.createDataFrame([(None, 0.9, 1), (None, 0.1, 0), ("", 0.1, 1), ("", 0.9, 0)], "k string, score double, label int")
    got = {r["k"]: r["roc_auc"] for r in W.roc_auc(df, "score", "label", ["k"]).collect()}
    assert got == {None: 1.0, "": 0.0}
    curves = W.roc_curve(df, "score", "label", ["k"]).groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r["k"]: r["n"] for r in curves} == {None: 3, "": 3}


def test_ordered_operators_on_empty_tables(spark):
    none = spark.createDataFrame([], "score double, label int")
    assert W.roc_curve(none, "score", "label").count() == 0 and W.pr_curve(none, "score", "label").count() == 0
    assert W.column_quantiles(none, ["score"], [0.5]) == {"score": [None]}


def test_prefix_sums_splits_hot_value(spark):
    # one value holds 40 % of the rows: its rows are spread over ranges, ranks stay exact
    rng = np.random.RandomState(4)
    v = np.where(rng.rand(3000) < 0.4, 5.0, rng.normal(size=3000))
    pdf = pd.DataFrame({"id": np.arange(3000), "v": v, "one": 1})
    out = W.prefix_sums(spark.createDataFrame(pdf), [], "v", ["one"], tiebreak=["id"], n_buckets=32).toPandas()
    assert sorted(out["cum_one"]) == list(range(1, 3001))        # a permutation of ranks
    by_v = out.sort_values("cum_one")["v"].to_numpy()
    assert (np.diff(by_v) >= 0).all()                            # ranks follow the value order


def test_anova_without_groups_or_with_one(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 3.0)], "g string, v double")
    one = Q.anova_f(df, "g", "v", with_p=False).first()
    assert (one["groups"], one["n"], one["f_statistic"]) == (1, 2, None)
    none = Q.anova_f(df.where("g = 'z'"), "g", "v", with_p=False).first()
    assert none["groups"] == 0 and none["f_statistic"] is None

"""Invariants for splits, neighbours, SMOTE, models, RFE and attribution."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from churnlab import schema as S
from churnlab.operators import attribute as AT
from churnlab.operators import models as MD
from churnlab.operators import neighbors as NB
from churnlab.operators import sampling as SP


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.RandomState(11)
    n = 400
    x1 = rng.normal(size=n)
    x2 = rng.normal(size=n)
    x3 = rng.randint(0, 5, n).astype(float)
    y = (x1 + 0.5 * x2 + rng.normal(scale=0.7, size=n) > 0.9).astype(int)
    pdf = pd.DataFrame({S.ID: np.arange(n, dtype=np.int64), "x1": x1, "x2": x2, "x3": x3, S.LABEL: y})
    return spark.createDataFrame(pdf)


def test_stratified_split_exact_shares(frame):
    s = SP.stratified_split(frame, 0.2, seed=7)
    got = {(r[0], r[1]): r[2] for r in s.groupBy(S.LABEL, "split").count().collect()}
    for cls in (0, 1):
        n = got.get((cls, "test"), 0) + got.get((cls, "train"), 0)
        assert got.get((cls, "test"), 0) == int(np.floor(0.2 * n + 0.5))
    assert s.count() == 400 and s.select(S.ID).distinct().count() == 400


def test_kfold_balanced(frame):
    f = SP.kfold(frame, 5, seed=3)
    sizes = [r[1] for r in f.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 2 and sum(sizes) == 400


def test_positional_and_sample(frame):
    ref, new = SP.positional_split(frame, 0.8)
    assert ref.count() == 320 and new.agg(F.min(S.ID)).first()[0] == 320
    s1 = [r[0] for r in SP.sample_n(frame, 25, seed=5).select(S.ID).collect()]
    s2 = [r[0] for r in SP.sample_n(frame, 25, seed=5).select(S.ID).collect()]
    assert s1 == s2 and len(set(s1)) == 25
    assert SP.sample_n(frame, 1000).count() == 400


def test_knn_exact_with_ties(spark):
    # a hot group of identical points plus spread points: ties at distance 0 must not break it
    pts = [(i, 0.0, 0.0) for i in range(30)] + [(100 + i, float(i), float(i % 3)) for i in range(40)]
    df = spark.createDataFrame(pts, "customer_id long, a double, b double")
    got = NB.knn(df, ["a", "b"], 4, block=8).collect()
    bf = knn_brute_force(df, ["a", "b"], 4)
    by = {}
    for r in got:
        by.setdefault(r.customer_id, []).append((r.nn_rank, r.distance))
    for i, lst in bf.items():
        assert [round(d, 9) for _, d in sorted(by[i])] == [round(d, 9) for _, d in lst]


def test_smote_parity_and_bounds(frame):
    out = SP.smote(frame, ["x1", "x2", "x3"], k=5)
    counts = {r[0]: r[1] for r in out.groupBy(S.LABEL).count().collect()}
    assert counts[0] == counts[1]
    mino = frame.where(F.col(S.LABEL) == 1).agg(*[F.min(c).alias(f"mn_{c}") for c in ["x1", "x2"]],
                                                 *[F.max(c).alias(f"mx_{c}") for c in ["x1", "x2"]]).first()
    syn = out.where("synthetic").agg(F.min("x1"), F.max("x1"), F.min("x2"), F.max("x2")).first()
    assert syn[0] >= mino["mn_x1"] and syn[1] <= mino["mx_x1"]
    assert syn[2] >= mino["mn_x2"] and syn[3] <= mino["mx_x2"]
    assert out.where("not synthetic").count() == 400


def test_metrics_confusion_and_rfe(frame):
    tr = frame.where(F.col(S.ID) % 5 != 0)
    te = frame.where(F.col(S.ID) % 5 == 0)
    m = MD.fit(tr, ["x1", "x2", "x3"], "random_forest", {"n_estimators": 20, "max_depth": 5})
    sc = MD.score(m, te)
    cm = MD.confusion_matrix(sc).first()
    assert sum(cm) == te.count()
    met = MD.class_metrics(sc).first()
    assert met["accuracy"] == pytest.approx((cm["tp"] + cm["tn"]) / sum(cm), abs=1e-6)
    assert met["roc_auc"] > 0.7
    rk = MD.rfe(tr, ["x1", "x2", "x3"], n_select=1, step=1, num_trees=10)
    ranks = dict(rk)
    assert sorted(ranks.values()) == [1, 2, 3] and ranks["x1"] == 1


def test_sampled_shapley_telescopes(frame):
    feats = ["x1", "x2", "x3"]
    m = MD.fit(frame, feats, "random_forest", {"n_estimators": 10, "max_depth": 4})
    attr = AT.sampled_shapley(m, frame.limit(20), SP.sample_n(frame, 15), feats, perms=2)
    r = attr.select(F.max(F.abs(F.aggregate("attributions", F.lit(0.0), lambda a, x: a + x["shap_value"])
                                + F.col("base_value") - F.col("probability")))).first()[0]
    assert r < 1e-9
    top = AT.top_attributions(attr, 2).first()["top_shap_features"]
    assert len(top) == 2 and abs(top[0]["shap_value"]) >= abs(top[1]["shap_value"])


def test_random_search_and_cv(frame):
    f = SP.kfold(frame, 3, seed=1)
    res = MD.random_search(f, ["x1", "x2", "x3"], "logistic_regression", n_iter=2, folds=3)
    assert len(res.cv_scores) == 2 and "C" in res.best_params
    cv = MD.cv_score(SP.kfold(frame, 3), ["x1", "x2"], "logistic_regression", {"C": 1.0})
    assert len(cv["scores"]) == 3 and 0.5 < cv["mean"] <= 1.0


def test_attribution_queries_small(spark):
    from __spark_entry__ import queries
    df = queries()["logistic_attribution"](spark, SF_SMALL)
    rows = df.collect()
    assert rows and all(len(r["top_shap_features"]) == 6 for r in rows)


def test_grid_search_and_promote(spark, frame):
    import tempfile
    from churnlab.plans import monitoring as M
    f = SP.kfold(frame, 3, seed=2)
    res = MD.grid_search(f, ["x1", "x2"], "random_forest", {"n_estimators": [5, 10], "max_depth": [2, 4]}, folds=3)
    assert len(res.cv_scores) == 4 and set(res.best_params) == {"n_estimators", "max_depth"}
    d = tempfile.mkdtemp(prefix="churnlab-models-")
    p1 = M.promote(spark, res.model, d, "2026-01-01T00:00:00", "random_forest", 0.8, 0.7)
    p2 = M.promote(spark, res.model, d, "2026-02-01T00:00:00", "random_forest", 0.85, 0.75)
    assert p1 != p2 and M.live_model_path(spark, d) == p2


def knn_brute_force(points, features: list[str], k: int = 5, id_col: str = S.ID):
    """All pairs, in pandas."""
    import numpy as np
    pdf = points.select(id_col, *features).toPandas()
    X = pdf[features].to_numpy(dtype=float)
    ids = pdf[id_col].to_numpy()
    out = {}
    for i in range(len(ids)):
        d = np.sqrt(((X - X[i]) ** 2).sum(axis=1))
        order = sorted((d[j], ids[j]) for j in range(len(ids)) if j != i)
        out[int(ids[i])] = [(int(b), float(a)) for a, b in order[:k]]
    return out


def test_neighbours_and_smote_skip_points_with_null_features(spark):
    from churnlab.operators import neighbors, sampling
    rows = [(i, float(i), 2.0 * i, int(i < 8)) for i in range(24)] + [(100, None, 1.0, 1)]
    df = spark.createDataFrame(rows, "customer_id long, a double, b double, label int")
    minority = df.where("label = 1")
    near = neighbors.knn(minority, ["a", "b"], 3, "customer_id").collect()
    assert {r["customer_id"] for r in near} == set(range(8)) and all(r["distance"] is not None and r["nn_id"] != 100 for r in near)
    both = sampling.smote(df, ["a", "b"], label="label", id_col="customer_id").groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in both} == {0: 16, 1: 16}


def test_elimination_reads_rows_spread_over_all_cores(spark, monkeypatch):
    parts = []
    monkeypatch.setattr(MD, "fit", lambda df, *_: parts.append((df.rdd.getNumPartitions(), df.count())))
    monkeypatch.setattr(MD, "feature_importance", lambda m, features: [(f, float(i)) for i, f in enumerate(features)])
    df = spark.range(0, 200, 1, 1).selectExpr("id % 7 AS a", "id % 5 AS b", "id % 3 AS c", f"CAST(id % 2 AS int) AS {S.LABEL}")
    assert MD.rfe(df, ["a", "b", "c"], 1, 1, 5) == [("a", 3), ("b", 2), ("c", 1)]
    assert parts == [(spark.sparkContext.defaultParallelism, 200)] * 2

"""Registered model queries do the whole of the reference's job."""

from conftest import SF_SMALL

from churnlab import registry_models as R
from churnlab import schema as S
from test_sampling_models import knn_brute_force


def test_smote_and_neighbours_use_every_model_column(spark):
    train, _ = R._split(spark, SF_SMALL)
    minority = train.where(f"{S.LABEL} = 1")
    got = {}
    for r in sorted(R.q_knn(spark, SF_SMALL).collect(), key=lambda r: r["nn_rank"]):
        got.setdefault(r[S.ID], []).append(r["distance"])
    want = {i: [d for _, d in near] for i, near in knn_brute_force(minority, R.MODEL_FEATURES, 5).items()}
    assert got.keys() == want.keys() and all(len(got[i]) == len(want[i]) for i in want)
    assert all(abs(x - y) < 1e-6 for i in want for x, y in zip(got[i], want[i]))
    out = R.q_smote(spark, SF_SMALL)
    assert set(out.columns) == {S.ID, *R.MODEL_FEATURES, S.LABEL, "synthetic"}
    counts = {r[0]: r[1] for r in out.groupBy(S.LABEL).count().collect()}
    assert counts[0] == counts[1]


def test_elimination_and_candidates_have_the_size_of_the_reference(spark, monkeypatch):
    """200 trees, one column a round; 8 draws for every model with a search space. The fits are recorded, not made."""
    fits, searches = [], []

    def fit(df, features, kind, params=None, *_):
        fits.append((len(features), kind, params))
        return None

    monkeypatch.setattr(R.MD, "fit", fit)
    monkeypatch.setattr(R.MD, "feature_importance", lambda m, features: [(f, float(i)) for i, f in enumerate(features)])
    ranking = [r["ranking"] for r in R.q_rfe(spark, SF_SMALL).collect()]
    n = len(R.MODEL_FEATURES)
    assert [(f[0], f[2]["n_estimators"]) for f in fits] == [(w, 200) for w in range(n, 20, -1)]
    assert sorted(ranking) == [1] * 20 + list(range(2, n - 18))

    def search(train, features, kind, n_iter=8, folds=3, **_):
        searches.append((kind, n_iter, folds, train.select("fold").distinct().count()))
        return R.MD.TuneResult(None, {})

    monkeypatch.setattr(R.MD, "random_search", search)
    fits.clear()
    monkeypatch.setattr(R.MD, "score", lambda m, df: df)
    monkeypatch.setattr(R.MD, "class_metrics", lambda df: df.limit(1).select(S.LABEL))
    assert R.q_candidates(spark, SF_SMALL).count() == len(R.MD.KINDS)
    assert searches == [(k, 8, 3, 3) for k in R.MD.KINDS if k in R.MD.SEARCH_SPACE]
    assert [f[1] for f in fits] == ["decision_tree"]


def test_retraining_fits_300_trees(spark, monkeypatch):
    from churnlab.plans import monitoring as M
    fits = []
    data = spark.range(1500).selectExpr(f"id AS {S.ID}", "CAST(id AS double) AS x", f"CAST(id % 3 = 0 AS int) AS {S.LABEL}")
    met = spark.createDataFrame([(0.9, 0.8)], "roc_auc double, accuracy double")
    monkeypatch.setattr(M.MD, "fit", lambda df, features, kind, params, seed: fits.append((kind, params["n_estimators"])))
    monkeypatch.setattr(M.MD, "score", lambda m, df: df)
    monkeypatch.setattr(M.MD, "class_metrics", lambda df: met)
    res, _ = M.retrain(spark, data, ["x"], "test")
    assert res.success and fits == [("random_forest", 300), ("boosted_trees", 300)]

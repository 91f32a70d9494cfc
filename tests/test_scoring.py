"""Table scoring (T16) and its streaming twin."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import PRESETS, SF_SMALL

from churnlab import schema as S
from churnlab.functions.features import fit_feature_stats
from churnlab.operators import models as MD
from churnlab.operators import sampling as SP
from churnlab.plans.scoring import score_requests
from churnlab.registry import features
from churnlab.streaming.streams import stream_score

FEATS = ["account_length", "total_day_minutes", "customer_service_calls", "total_minutes", "day_usage_ratio",
         "intl_plan_usage_flag", "service_calls_per_month"]


@pytest.fixture(scope="module")
def trained(spark):
    f = features(spark, SF_SMALL)
    from churnlab.registry import cleaned
    stats = fit_feature_stats(cleaned(spark, SF_SMALL))
    model = MD.fit(f, FEATS, "random_forest", {"n_estimators": 20, "max_depth": 5})
    return model, stats, SP.sample_n(f, 20)


def _requests(spark):
    cols = [c for c, *_ in S.REQUEST_FIELDS]
    bad = dict(PRESETS["low"], customer_service_calls=42)
    rows = [(i, *[r[c] for c in cols]) for i, r in enumerate([PRESETS["high"], PRESETS["low"], bad])]
    schema = ("customer_id long, account_length int, international_plan string, voice_mail_plan string, "
              "number_vmail_messages int, total_day_minutes double, total_eve_minutes double, "
              "total_night_minutes double, total_intl_minutes double, total_day_calls int, total_eve_calls int, "
              "total_night_calls int, total_intl_calls int, customer_service_calls int")
    return spark.createDataFrame(rows, schema)


def test_score_requests(spark, trained):
    model, stats, bg = trained
    res, rej = score_requests(model, _requests(spark), stats, FEATS, background=bg)
    out = {r[S.ID]: r for r in res.collect()}
    assert set(out) == {0, 1}
    assert [r[S.ID] for r in rej.collect()] == [2]
    for r in out.values():
        assert 0.0 <= r["churn_probability"] <= 1.0
        assert r["churn_prediction"] == (r["churn_probability"] > 0.5)
        assert len(r["top_shap_features"]) == 6
        total = sum(t["shap_value"] for t in r["top_shap_features"])
        assert abs(total) <= 1.0
    # one request scored alone gets the same probability as in the batch (training statistics)
    alone, _ = score_requests(model, _requests(spark).where(F.col(S.ID) == 0), stats, FEATS)
    assert alone.first()["churn_probability"] == out[0]["churn_probability"]


def test_repeated_request_ids_are_explained_apart(spark, trained):
    model, stats, bg = trained
    requests = _requests(spark).where(F.col(S.ID) < 2)
    res, _ = score_requests(model, requests, stats, FEATS, background=bg)
    twice, _ = score_requests(model, requests.withColumn(S.ID, F.lit(7).cast("long")), stats, FEATS, background=bg)
    view = lambda d: sorted((r["churn_probability"], r["base_value"], len(r["top_shap_features"])) for r in d.collect())
    assert view(twice) == view(res)


def test_stream_score_matches_batch(spark, trained):
    model, stats, _ = trained
    base = tempfile.mkdtemp(prefix="churnlab-x1-")
    req = _requests(spark)
    req.write.parquet(f"{base}/in")
    q = stream_score(spark, f"{base}/in", req.schema, model, stats, FEATS, f"{base}/out", f"{base}/rej",
                     f"{base}/ck")
    q.processAllAvailable()
    q.stop()
    streamed = sorted((r[S.ID], r["churn_probability"]) for r in spark.read.parquet(f"{base}/out").collect())
    batch, _ = score_requests(model, req, stats, FEATS)
    assert streamed == sorted((r[S.ID], r["churn_probability"]) for r in batch.collect())
    assert spark.read.parquet(f"{base}/rej").count() == 1

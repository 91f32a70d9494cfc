"""Table scoring (T16): validated requests -> features -> probability -> top attributions.

The request table is validated row by row (rejects keep their reasons in a side table), the
valid rows are encoded and featurised with the *training* statistics (so a one-row batch is
scored like a row of the training table), aligned to the selected features, scored in bulk, and
explained. The model is a ``PipelineModel`` shipped to executors once per job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.features import FeatureStats, engineer_features
from ..operators import attribute as AT
from ..operators import clean as C
from ..operators import models as MD
from ..operators import tree_attribution as TA
from ..session import checkpoint


def prepare_requests(requests: DataFrame, stats: FeatureStats, features: list[str]) -> tuple[DataFrame, DataFrame]:
    """(aligned valid rows, rejects with reasons)."""
    v = C.validate_requests(requests)
    rejects = v.where(~F.col("is_valid")).select(S.ID, "reject_reasons")
    ok = v.where(F.col("is_valid")).drop("is_valid", "reject_reasons")
    enc = C.encode_yes_no(ok)
    feats = engineer_features(enc, stats)
    return C.align_features(feats, features, keep=[S.ID]), rejects


def score_requests(model, requests: DataFrame, stats: FeatureStats, features: list[str],
                   background: DataFrame | None = None, perms: int = 1, top: int = 6,
                   seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(results, rejects). Results: id, churn_probability, churn_prediction, base_value,
    top_shap_features (6 entries) - all rounded to 4 places. Ids may repeat: rows are told apart by a
    key of their own, checkpointed so that it holds on retries. Attributions of tree models are exact (boosted
    trees in log-odds), those of other models sampled with ``perms`` orders a background row."""
    aligned, rejects = prepare_requests(requests, stats, features)
    if background is not None:
        aligned = checkpoint(aligned.withColumn("__row", F.monotonically_increasing_id()))
    scored = MD.score(model, aligned.withColumn(S.LABEL, F.lit(0)))
    out = scored.select(S.ID, "churn_probability", "churn_prediction", *(["__row"] if background is not None else []))
    if background is not None:
        if isinstance(model.stages[-1], TA.TREE_MODELS):  # exact; other models by sampled orders
            attr = TA.tree_shapley(model, aligned, background, features, id_col="__row")
        else:
            attr = AT.sampled_shapley(model, aligned, background, features, perms, seed, id_col="__row")
        attr = AT.top_attributions(attr, top).select("__row", "base_value", "top_shap_features")
        out = out.join(attr, "__row", "left")
    else:
        out = out.withColumn("base_value", F.lit(None).cast("double")) \
            .withColumn("top_shap_features", F.lit(None).cast(S.ATTRIBUTION_TYPE))
    return out.select(S.ID, F.round("churn_probability", 4).alias("churn_probability"), "churn_prediction",
                      F.round("base_value", 4).alias("base_value"), "top_shap_features"), rejects

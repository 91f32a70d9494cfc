"""Registered model queries (no SQL twin: outputs depend on fitted models or iterative search).

They are checked by invariants in ``tests/`` (split sizes, SMOTE parity, RFE width, AUC against
Spark's evaluator, attribution telescoping, exact k-NN against brute force).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import oracle_sql as O
from . import schema as S
from .operators import attribute as AT
from .operators import models as MD
from .operators import neighbors as NB
from .operators import sampling as SP
from .operators import tree_attribution as TA
from .registry import cleaned, features, register
from .session import checkpoint

# Model inputs: numeric inputs without charges, plus the engineered features (fixed list).
MODEL_FEATURES = [c for c in S.NUMERIC_INPUTS if "charge" not in c] + S.ENGINEERED


def _split(spark, sf):
    """Feature table with a stratified hash split, checkpointed once per query."""
    f = features(spark, sf).select(S.ID, *MODEL_FEATURES, S.LABEL)
    s = checkpoint(SP.stratified_split(f, 0.2, seed=42))
    return s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "test").drop("split")


def _forest(train):
    return MD.fit(train, MODEL_FEATURES, "random_forest", {"n_estimators": 100, "max_depth": 10})


@register("forest_fit_score")
def q_forest(spark, sf):
    train, test = _split(spark, sf)
    return MD.score(_forest(train), test).select(S.ID, S.LABEL, "churn_probability", "churn_prediction")


@register("model_metrics_candidates")
def q_candidates(spark, sf):
    """T8-T12 + T17 + T19: four candidates on the oversampled training rows, tuned where they have a search
    space (8 draws, 3 folds), metrics on the test split."""
    train, test = _split(spark, sf)
    train = checkpoint(SP.kfold(SP.smote(train, MODEL_FEATURES, k=5).drop("synthetic"), 3))
    out = None
    for i, kind in enumerate(MD.KINDS):
        tuned = kind in MD.SEARCH_SPACE
        m = MD.random_search(train, MODEL_FEATURES, kind).model if tuned else MD.fit(train, MODEL_FEATURES, kind)
        met = MD.rounded_metrics(MD.class_metrics(MD.score(m, test))).select(F.lit(i).alias("position"), F.lit(kind).alias("model"), "*")
        out = met if out is None else out.unionByName(met)
    return out


@register("forest_importance")
def q_importance(spark, sf):
    """Forest importances, sorted."""
    train, _ = _split(spark, sf)
    imp = MD.feature_importance(_forest(train), MODEL_FEATURES)
    return spark.createDataFrame([(f, float(v)) for f, v in imp], "feature string, importance double") \
        .orderBy(F.desc("importance"), "feature")


@register("rfe_ranking")
def q_rfe(spark, sf):
    """Recursive elimination to 20 features, one a round, by forests of 200 trees; ranking 1 = kept."""
    train, _ = _split(spark, sf)
    rk = MD.rfe(train, MODEL_FEATURES, n_select=20, step=1, num_trees=200)
    return spark.createDataFrame(rk, "feature string, ranking int")


@register("smote_balanced")
def q_smote(spark, sf):
    """Training split plus synthetic minority rows (exact neighbours)."""
    train, _ = _split(spark, sf)
    return SP.smote(train, MODEL_FEATURES, k=5)


@register("minority_neighbors")
def q_knn(spark, sf):
    """Exact 5 nearest minority neighbours of every minority training row."""
    train, _ = _split(spark, sf)
    return NB.knn(train.where(F.col(S.LABEL) == 1), MODEL_FEATURES, 5)


# Numeric inputs without charges hold whole numbers, so distances and ties are the same in SQL.
PLAIN_FEATURES = [c for c in S.NUMERIC_INPUTS if "charge" not in c]
_SQUARES = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in PLAIN_FEATURES)


@register("neighbors_modkey", O.with_blocks(O.CLEANED, f"""
  , r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY churn ORDER BY (customer_id * 7919) % 100003, customer_id) AS rk,
                 COUNT(*) OVER (PARTITION BY churn) AS n FROM cleaned),
  m AS (SELECT * FROM r WHERE rk > ROUND(n * 0.2) AND churn = 1),
  p AS (SELECT a.customer_id, b.customer_id AS nn_id, SQRT(CAST({_SQUARES} AS DOUBLE)) AS distance
        FROM m a JOIN m b ON a.customer_id <> b.customer_id),
  k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY distance, nn_id) AS nn_rank FROM p)
  SELECT customer_id, CAST(nn_rank AS INTEGER) AS nn_rank, nn_id, ROUND(distance, 6) AS distance FROM k WHERE nn_rank <= 5"""))
def q_knn_modkey(spark, sf):
    """J4 on the usage columns of the minority rows of the SQL-expressible split."""
    c = cleaned(spark, sf).select(S.ID, *PLAIN_FEATURES, S.LABEL)
    train = SP.stratified_split(c, 0.2, order_key=SP.mod_key()).where(F.col("split") == "train")
    near = NB.knn(train.where(F.col(S.LABEL) == 1), PLAIN_FEATURES, 5)
    return near.withColumn("distance", F.round("distance", 6))


@register("sampled_attribution")
def q_attribution(spark, sf):
    """T20 + K2: attributions of the forest for every test row against a sample of 100 background
    rows, as the original explainer; exact over leaf paths. Top 6, rounded."""
    train, test = _split(spark, sf)
    m = _forest(train)
    bg = SP.sample_n(train, 100)
    attr = TA.tree_shapley(m, test, bg, MODEL_FEATURES)
    return AT.top_attributions(attr).select(S.ID, F.round("probability", 4).alias("churn_probability"),
                                            F.round("base_value", 4).alias("base_value"), "top_shap_features")


@register("global_attribution")
def q_global_attribution(spark, sf):
    """Mean |attribution| per feature over the test rows, top 8."""
    train, test = _split(spark, sf)
    m = _forest(train)
    attr = TA.tree_shapley(m, test, SP.sample_n(train, 100), MODEL_FEATURES)
    return AT.global_attribution(attr, 8)


@register("logistic_attribution")
def q_linear_attribution(spark, sf):
    """T20 (linear): exact log-odds contributions of a logistic fit, top 6 per test row."""
    train, test = _split(spark, sf)
    m = MD.fit(train, MODEL_FEATURES, "logistic_regression", {"C": 1.0})
    coefs, b0 = MD.logit_attribution_base(m)
    means = train.agg(*[F.avg(c).alias(c) for c in MODEL_FEATURES]).first().asDict()
    attr = AT.linear_attribution(test, MODEL_FEATURES, coefs, b0, means)
    return AT.top_attributions(attr).select(S.ID, F.round("base_value", 4).alias("base_value"), "top_shap_features")


#: Coefficients of the fixed linear form, by place in MODEL_FEATURES, and its intercept.
FIXED_COEFS = {f: (k % 4 + 1) * (-1) ** k / 100 for k, f in enumerate(MODEL_FEATURES)}
FIXED_INTERCEPT = -1.0
_FIXED_BASE = " + ".join(f"({c!r}) * (SELECT AVG(CAST({f} AS DOUBLE)) FROM features)" for f, c in FIXED_COEFS.items())


@register("linear_attribution_fixed", O.with_blocks(O.FEATURES, ", long AS (" + " UNION ALL ".join(
    f"SELECT {S.ID}, '{f}' AS feature, ({c!r}) * (CAST({f} AS DOUBLE) - (SELECT AVG(CAST({f} AS DOUBLE)) FROM features)) AS v FROM features"
    for f, c in FIXED_COEFS.items()) + f""")
  SELECT {S.ID}, feature, ROUND(v, 4) + 0.0 AS shap_value, (SELECT ROUND({FIXED_INTERCEPT} + {_FIXED_BASE}, 4)) AS base_value FROM long"""))
def q_linear_fixed(spark, sf):
    """T20 (linear) on fixed coefficients: every row's contribution of every feature."""
    f = features(spark, sf).select(S.ID, *[F.col(c).cast("double").alias(c) for c in MODEL_FEATURES])
    means = f.agg(*[F.avg(c).alias(c) for c in MODEL_FEATURES]).first().asDict()
    attr = AT.linear_attribution(f, MODEL_FEATURES, list(FIXED_COEFS.values()), FIXED_INTERCEPT, means)
    return attr.select(S.ID, F.round("base_value", 4).alias("base_value"), F.inline("attributions")).withColumn("shap_value", F.round("shap_value", 4) + 0.0)


@register("linear_top_attributions", O.with_blocks(O.FEATURES, ", long AS (" + " UNION ALL ".join(
    f"SELECT {S.ID}, '{f}' AS feature, ({c!r}) * (CAST({f} AS DOUBLE) - (SELECT AVG(CAST({f} AS DOUBLE)) FROM features)) AS v FROM features"
    for f, c in FIXED_COEFS.items()) + f""")
  SELECT {S.ID}, CAST(ROW_NUMBER() OVER w AS INTEGER) AS place, feature, ROUND(v, 4) + 0.0 AS shap_value FROM long
  WINDOW w AS (PARTITION BY {S.ID} ORDER BY ABS(v) DESC, feature) QUALIFY ROW_NUMBER() OVER w <= 6"""))
def q_linear_top(spark, sf):
    """K2 + T20 (linear): the six largest contributions of every row, in order."""
    from .operators.profile import top_k_per_row
    f = features(spark, sf).select(S.ID, *[F.col(c).cast("double").alias(c) for c in MODEL_FEATURES])
    means = f.agg(*[F.avg(c).alias(c) for c in MODEL_FEATURES]).first().asDict()
    attr = AT.linear_attribution(f, MODEL_FEATURES, list(FIXED_COEFS.values()), FIXED_INTERCEPT, means)
    top = attr.select(S.ID, F.posexplode(top_k_per_row(F.col("attributions"), 6)).alias("p", "a"))
    return top.select(S.ID, (F.col("p") + 1).alias("place"), "a.feature", (F.round("a.shap_value", 4) + 0.0).alias("shap_value"))


PAIR_COLS = ["total_day_minutes", "total_eve_minutes", "customer_service_calls", "international_plan"]


@register("pair_sample", O.with_blocks(O.FEATURES, f"SELECT {S.ID}, {S.LABEL}, {', '.join(PAIR_COLS)} FROM features"))
def q_pair_sample(spark, sf):
    """The columns of the pair plot with the class, over the whole table."""
    from .operators import profile as P
    return P.pair_table(features(spark, sf), PAIR_COLS)

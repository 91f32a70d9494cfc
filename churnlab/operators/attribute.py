"""Per-row feature attributions (T20) and their global summary.

* Logistic models: exact additive attribution in log-odds space, coef_j * (x_j - mean_j), with the
  base value the log-odds at the feature means; a pure projection.
* Any model (trees included): sampled Shapley values (Strumbelj and Kononenko, 2014). Every row
  is paired with every background row, ``perms`` times, each time with a seeded random
  permutation (the same sample set for every row); along a permutation the row's values replace the background's one feature at a
  time, and each step's change in class-1 probability is credited to the feature that moved.
  The steps telescope, so per row sum(phi) + base = probability exactly, where base is the mean
  probability over the background (the same for every row, like an explainer's expected value).

All instances are generated with ``explode`` inside Spark and scored by ``model.transform`` in
bulk; the background sample has a fixed size (it is broadcast), the work per row is
background x perms x (features + 1) model evaluations, and every row is explained.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from .profile import top_k, top_k_per_row


def linear_attribution(df: DataFrame, features: list[str], coefs: list[float], intercept: float,
                       means: dict, id_col: str = S.ID) -> DataFrame:
    """(id, base_value, attributions ARRAY<STRUCT<feature, shap_value>>) in log-odds space."""
    base = intercept + sum(c * float(means[f] or 0.0) for f, c in zip(features, coefs))
    arr = F.array(*[F.struct(F.lit(f).alias("feature"),
                             (F.lit(c) * (F.col(f).cast("double") - F.lit(float(means[f] or 0.0)))).alias("shap_value"))
                    for f, c in zip(features, coefs)])
    return df.select(id_col, F.lit(base).alias("base_value"), arr.alias("attributions"))


def sampled_shapley(model, rows: DataFrame, background: DataFrame, features: list[str], perms: int = 1,
                    seed: int = 42, id_col: str = S.ID, max_background: int = 1000) -> DataFrame:
    """(id, probability, base_value, attributions) for every row of ``rows``.

    ``background`` is a bounded sample (e.g. ``sampling.sample_n(ref, 100)``, at most
    ``max_background`` rows, checked); it is embedded in the plan as a literal array and exploded
    next to each row, so no join is involved.
    """
    d = len(features)
    bg_rows = background.select(*[F.col(f).cast("double").alias(f) for f in features]) \
        .limit(max_background + 1).collect()
    if len(bg_rows) > max_background:
        raise ValueError(f"background holds more than {max_background} rows; pass a bounded sample")
    # (background row, permutation) samples, drawn once from the seed and shared by every row;
    # positions are precomputed, so the per-row work has no higher-order functions
    rng = np.random.RandomState(seed)
    samples = []
    for i, r in enumerate(bg_rows):
        for _ in range(perms):
            perm = rng.permutation(d)
            pos = np.empty(d, dtype=int)
            pos[perm] = np.arange(1, d + 1)
            samples.append(dict({"perm": [int(v) for v in perm], "pos": [int(v) for v in pos]},
                                **{f: r[f] for f in features}))
    # one JSON literal (constant-folded once by the optimizer) instead of one literal per value
    z_type = T.ArrayType(T.StructType([T.StructField("perm", T.ArrayType(T.IntegerType())),
                                       T.StructField("pos", T.ArrayType(T.IntegerType()))] +
                                      [T.StructField(f, T.DoubleType()) for f in features]))
    z_arr = F.from_json(F.lit(json.dumps(samples)), z_type)
    x = rows.select(F.col(id_col), F.struct(*[F.col(f).cast("double").alias(f) for f in features]).alias("x"))
    s = x.withColumn("z", F.explode(z_arr)).withColumns({"perm": F.col("z.perm"), "pos": F.col("z.pos")})
    # the fan-out is background x perms x (features + 1) rows per input row: spread it over
    # proportionally more tasks (an explicit count, which adaptive execution does not merge away).
    # Hash-partitioning by the row id alone also satisfies both aggregates below, so no further
    # shuffle follows; one row's instances are bounded by the fan-out.
    n_parts = max(rows.sparkSession.sparkContext.defaultParallelism,
                  rows.rdd.getNumPartitions() * -(-len(samples) // 8))
    s = s.repartition(n_parts, F.col(id_col))
    s = s.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(d))))
    inst = {f: F.when(F.col("pos")[k] <= F.col("step"), F.col(f"x.{f}"))
            .otherwise(F.col(f"z.{f}")) for k, f in enumerate(features)}
    # the feature that entered at this step, and the one that enters at the next
    moved_in = F.when(F.col("step") > 0, F.element_at("perm", F.greatest(F.col("step"), F.lit(1))))
    moved_next = F.when(F.col("step") < d, F.element_at("perm", F.least(F.col("step") + 1, F.lit(d))))
    s = s.select(id_col, "step", moved_in.alias("m_in"), moved_next.alias("m_next"),
                 *[v.alias(f) for f, v in inst.items()])
    scored = model.transform(s.withColumn("label", F.lit(0.0)))
    p = scored.select(id_col, "step", "m_in", "m_next", vector_to_array("probability")[1].alias("p"))
    # phi_j = mean over samples of p(after j enters) - p(before j enters): each instance adds +p to
    # the feature that just entered and -p to the one entering next, so a grouped sum replaces a
    # window over the steps (no sort of the instances)
    n_samples = len(samples)
    names = F.array(*[F.lit(f) for f in features])
    # keys: feature index (>= 0), -1 = base (all-background instance), -2 = the row's own probability
    parts = F.filter(F.array(F.struct(F.col("m_in").alias("j"), F.col("p").alias("v")),
                             F.struct(F.col("m_next").alias("j"), (-F.col("p")).alias("v")),
                             F.struct(F.when(F.col("step") == 0, F.lit(-1)).alias("j"), F.col("p").alias("v")),
                             F.struct(F.when(F.col("step") == d, F.lit(-2)).alias("j"), F.col("p").alias("v"))),
                     lambda t: t["j"].isNotNull())
    contrib = p.select(id_col, F.explode(parts).alias("c")).select(id_col, F.col("c.j").alias("j"), F.col("c.v").alias("v"))
    g = contrib.groupBy(id_col, "j").agg((F.sum("v") / F.lit(n_samples)).alias("val"))
    # both aggregates are keyed by the row id, which the instances are already partitioned by
    return g.groupBy(id_col).agg(
        F.max(F.when(F.col("j") == -1, F.col("val"))).alias("base_value"),
        F.max(F.when(F.col("j") == -2, F.col("val"))).alias("probability"),
        F.collect_list(F.when(F.col("j") >= 0, F.struct(F.element_at(names, F.col("j") + 1).alias("feature"),
                                                        F.col("val").alias("shap_value")))).alias("attributions"))


def top_attributions(attr: DataFrame, k: int = 6, digits: int = 4) -> DataFrame:
    """K2 + P13 on attributions: the k largest by |value|, rounded."""
    top = top_k_per_row(F.col("attributions"), k)
    rounded = F.transform(top, lambda t: F.struct(t["feature"].alias("feature"),
                                                  F.round(t["shap_value"], digits).alias("shap_value")))
    return attr.withColumn("top_shap_features", rounded)


def global_attribution(attr: DataFrame, k: int = 8, id_col: str = S.ID) -> DataFrame:
    """Mean |attribution| per feature over all explained rows, top k."""
    long = attr.select(id_col, F.explode("attributions").alias("a")).select("a.feature", "a.shap_value")
    g = long.groupBy("feature").agg(F.avg(F.abs("shap_value")).alias("mean_abs_shap"))
    return top_k(g, "mean_abs_shap", k, tiebreak=["feature"])

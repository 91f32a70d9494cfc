"""Statistical aggregates (Q1-Q10).

Every test is one grouped aggregate over an unpivoted (feature, value, label) table: moments for
Welch t and Cohen's d, (n, sum, sum of squares) for ANOVA, cell counts for chi-squared. The
p-values are evaluated afterwards on the aggregated rows only (``functions.pvalues``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.bins import cut
from ..functions.frames import side_by_side
from ..functions.pvalues import p_chi2, p_f, p_t
from ..session import checkpoint
from .ordered import ks_2samp  # noqa: F401  (Q8 lives with the prefix sums)


def _long(df: DataFrame, cols: list[str], label: str = S.LABEL) -> DataFrame:
    return (df.select(F.col(label).cast("int").alias("y"), *[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot("y", cols, "feature", "value"))


def _cross_products(x: np.ndarray, here: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of every pair of columns, over the rows that have both: n, mean of the first and the second, their sums of
    squared deviations and of products of deviations. ``here`` tells values from NULLs."""
    m = here.astype(np.float64)
    center = np.divide(np.where(here, x, 0.0).sum(axis=0), m.sum(axis=0), out=np.zeros(x.shape[1]), where=here.any(axis=0))
    d = np.where(here, x - center, 0.0)
    n, s, q, p = m.T @ m, d.T @ m, (d * d).T @ m, d.T @ d
    some = np.maximum(n, 1.0)
    mean = center[:, None] + s / some
    return n, mean, mean.T, q - s * s / some, (q - s * s / some).T, p - s * s.T / some


def _merged(a: tuple | None, b: tuple) -> tuple:
    """The cross products of two sets of rows together."""
    if a is None:
        return b
    n = a[0] + b[0]
    share = np.divide(a[0] * b[0], n, out=np.zeros_like(n), where=n > 0)
    part = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    dx, dy = b[1] - a[1], b[2] - a[2]
    return (n, a[1] + dx * part, a[2] + dy * part, a[3] + b[3] + dx * dx * share, a[4] + b[4] + dy * dy * share,
            a[5] + b[5] + dx * dy * share)


def cross_products(df: DataFrame, cols: list[str]) -> DataFrame:
    """(k, n, mx, my, sxx, syy, sxy) of every pair a < b (k by position), one row per pair and task.

    A task multiplies each Arrow batch's block of columns with itself and adds the products up, so a row of
    the table is read once, whatever the number of pairs, and only pairs x tasks rows leave.
    """
    upper = np.triu_indices(len(cols), 1)
    names = ["n", "mx", "my", "sxx", "syy", "sxy"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            here = np.column_stack([batch.column(k).is_valid().to_numpy(zero_copy_only=False) for k in range(len(cols))])
            x = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(len(cols))]).astype(np.float64)
            total = _merged(total, _cross_products(np.where(here, x, 0.0), here))
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]), dtype=np.int32)), *(pa.array(t[upper]) for t in total)], ["k", *names])

    wide = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    return wide.mapInArrow(run, "k int, " + ", ".join(f"{c} double" for c in names))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Q1: pairwise-complete Pearson correlation for every pair a < b (by position), long form.

    The tasks' cross products are merged per pair: their sums, and what the tasks' means differ from the pair's
    mean. NULL on either side leaves the row out of the pair; a NaN makes its column's correlations NaN, a
    column of one value, or a pair without rows, NULL.
    """
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "feature_a string, feature_b string, corr double")
    pair = Window.partitionBy("k")  # one row per task
    parts = cross_products(df, cols)
    mean = lambda c: F.try_divide(F.sum(F.col(c) * F.col("n")).over(pair), F.sum("n").over(pair))
    parts = parts.withColumns({"dx": F.col("mx") - mean("mx"), "dy": F.col("my") - mean("my")})
    total = lambda s, a, b: F.sum(F.col(s) + F.col("n") * F.col(a) * F.col(b)).alias(s)
    g = parts.groupBy("k").agg(total("sxx", "dx", "dx"), total("syy", "dy", "dy"), total("sxy", "dx", "dy"))
    whole = F.sqrt(F.col("sxx")) * F.sqrt(F.col("syy"))
    left = F.array(*[F.lit(a) for a, _ in pairs])
    right = F.array(*[F.lit(b) for _, b in pairs])
    return g.select(F.element_at(left, F.col("k") + 1).alias("feature_a"),
                    F.element_at(right, F.col("k") + 1).alias("feature_b"),
                    F.round(F.try_divide(F.col("sxy"), whole), 6).alias("corr"))


def top_correlated(df: DataFrame, cols: list[str], label: str = S.LABEL, k: int = 10) -> DataFrame:
    """Q2: the k features most correlated with the label by absolute value (label excluded)."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(c) for c in cols])
    long = wide.unpivot([], cols, "feature", "corr").where(F.col("corr").isNotNull())
    return (long.select("feature", F.round("corr", 6).alias("corr"), F.round(F.abs("corr"), 6).alias("abs_corr"))
            .orderBy(F.desc("abs_corr"), "feature").limit(k))


def class_moments(df: DataFrame, cols: list[str], label: str = S.LABEL) -> DataFrame:
    """Per feature: count, mean and sample variance of each class (1 = churned, 0 = retained)."""
    long = _long(df, cols, label).where(F.col("value").isNotNull())
    v1 = F.when(F.col("y") == 1, F.col("value"))
    v0 = F.when(F.col("y") == 0, F.col("value"))
    return long.groupBy("feature").agg(
        F.count(v1).alias("n1"), F.count(v0).alias("n0"),
        F.avg(v1).alias("m1"), F.avg(v0).alias("m0"),
        F.var_samp(v1).alias("v1"), F.var_samp(v0).alias("v0"))


def welch_t(df: DataFrame, cols: list[str], label: str = S.LABEL, with_p: bool = True,
            alpha: float = 0.05) -> DataFrame:
    """Q3 + Q4: unequal-variance t (churned vs retained), Welch-Satterthwaite df and Cohen's d.

    With ``with_p``: two-sided p, -log10 p (20 when p is 0), significance, sorted by p.
    """
    m = class_moments(df, cols, label)
    se2 = F.col("v1") / F.col("n1") + F.col("v0") / F.col("n0")
    t = F.try_divide(F.col("m1") - F.col("m0"), F.sqrt(se2))
    dof = F.try_divide(se2 * se2, F.pow(F.col("v1") / F.col("n1"), 2) / (F.col("n1") - 1)
                       + F.pow(F.col("v0") / F.col("n0"), 2) / (F.col("n0") - 1))
    pooled = F.sqrt((F.col("v1") + F.col("v0")) / 2)
    d = F.when(pooled > 0, (F.col("m1") - F.col("m0")) / pooled).otherwise(F.lit(0.0))
    out = m.select("feature", t.alias("t_statistic"), dof.alias("dof"), d.alias("cohens_d"))
    if with_p:
        out = out.withColumn("p_value", p_t(F.col("t_statistic"), F.col("dof")))
        out = out.withColumns({
            "neg_log10_p": F.when(F.col("p_value") > 0, -F.log10("p_value")).otherwise(F.lit(20.0)),
            "significant": F.coalesce(F.col("p_value") < alpha, F.lit(False)),
        })
        return out.orderBy("p_value", "feature")
    return out.select("feature", F.round("t_statistic", 6).alias("t_statistic"),
                      F.round("dof", 6).alias("dof"), F.round("cohens_d", 6).alias("cohens_d"))


def contingency(df: DataFrame, cols: list[str], label: str = S.LABEL) -> DataFrame:
    """(feature, level, n1, n0): churned / retained counts per level of several columns, one pass."""
    long = (df.select(F.col(label).cast("int").alias("y"), *[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot("y", cols, "feature", "level").where(F.col("level").isNotNull()))
    return long.groupBy("feature", "level").agg(F.count_if(F.col("y") == 1).alias("n1"),
                                                F.count_if(F.col("y") == 0).alias("n0"))


def chi2_independence(df: DataFrame, cols: list[str], label: str = S.LABEL, correction: bool = True,
                      with_p: bool = True) -> DataFrame:
    """Q5 + Q6: chi-squared test of independence of each column with the 0/1 label, Cramer's V.

    At one degree of freedom the continuity (Yates) correction moves each observed count toward
    its expectation by min(0.5, |O - E|). Margins come from windows partitioned by feature over
    the cell table, which holds one row per (feature, level).
    """
    cells = contingency(df, cols, label).withColumns({"n1": F.col("n1").cast("double"),
                                                      "n0": F.col("n0").cast("double")})
    wf = Window.partitionBy("feature")
    # margin names differ from the cell names by more than case (Spark resolves names case-insensitively)
    cells = cells.withColumns({"tot1": F.sum("n1").over(wf), "tot0": F.sum("n0").over(wf),
                               "r": F.count(F.lit(1)).over(wf)})
    cells = cells.withColumns({"grand": F.col("tot1") + F.col("tot0"), "rt": F.col("n1") + F.col("n0"),
                               "c": (F.col("tot1") > 0).cast("int") + (F.col("tot0") > 0).cast("int")})
    dof = (F.col("r") - 1) * (F.col("c") - 1)

    def term(o, tot):
        e = F.col("rt") * F.col(tot) / F.col("grand")
        diff = e - F.col(o)
        obs = F.when((dof == 1) & F.lit(correction), F.col(o) + F.least(F.lit(0.5), F.abs(diff)) * F.signum(diff)) \
            .otherwise(F.col(o))
        return F.when(e > 0, F.pow(obs - e, 2) / e).otherwise(F.lit(0.0))

    g = cells.groupBy("feature").agg(F.sum(term("n1", "tot1") + term("n0", "tot0")).alias("chi2"),
                                     F.first(dof).alias("dof"), F.first("grand").alias("n"),
                                     F.first(F.least("r", "c")).alias("k"))
    out = g.select("feature", "chi2", F.col("dof").cast("bigint").alias("dof"), F.col("n").cast("bigint").alias("n"),
                   F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * (F.col("k") - 1))).alias("cramers_v"))
    if with_p:
        return out.withColumn("p_value", p_chi2(F.col("chi2"), F.col("dof").cast("double"))).orderBy("feature")
    return out.select("feature", F.round("chi2", 6).alias("chi2"), "dof", "n",
                      F.round("cramers_v", 6).alias("cramers_v")).orderBy("feature")


def anova_f(df: DataFrame, group: str, value: str, with_p: bool = True) -> DataFrame:
    """Q7: one-way ANOVA of ``value`` across the non-NULL levels of ``group``.

    Per group (n, mean, population variance) in one aggregate, checkpointed; the grand mean is one
    number and SSB and SSW are sums over the group rows.
    """
    g = checkpoint(df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
                   .groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(value).cast("double")).alias("m"),
                                       F.var_pop(F.col(value).cast("double")).alias("vp")))
    mean = g.agg(F.sum(F.col("n") * F.col("m")) / F.sum("n")).first()[0]
    apart = F.col("m") - F.lit(mean).cast("double")
    out = g.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").cast("bigint").alias("n"),
                F.coalesce(F.sum(F.col("n") * apart * apart), F.lit(0.0)).alias("ssb"),
                F.sum(F.col("n") * F.col("vp")).alias("ssw"))
    out = out.select("groups", "n", (F.col("groups") - 1).alias("df_between"),
                     (F.col("n") - F.col("groups")).alias("df_within"),
                     F.try_divide(F.try_divide(F.col("ssb"), F.col("groups") - 1),
                                  F.try_divide(F.col("ssw"), F.col("n") - F.col("groups")))
                     .alias("f_statistic"))
    if with_p:
        return out.withColumn("p_value", p_f(F.col("f_statistic"), F.col("df_between"), F.col("df_within")))
    return out.withColumn("f_statistic", F.round("f_statistic", 6))


def service_call_groups(df: DataFrame, include_lowest: bool = False) -> DataFrame:
    """The ANOVA grouping of service calls: (0,1], (1,3], (3,10] (0 calls fall outside by default)."""
    return df.withColumn("service_group", cut(F.col("customer_service_calls"), [0, 1, 3, 10],
                                              ["Low", "Medium", "High"], include_lowest))


def first_states(df: DataFrame, k: int = 10, state: str = "state") -> DataFrame:
    """The k states that appear first in id order (the file order stand-in): rows of those states."""
    first = df.groupBy(state).agg(F.min(S.ID).alias("first_id")).orderBy("first_id").limit(k)
    return df.join(F.broadcast(first.select(state)), state, "left_semi")


def chi2_gof(ref: DataFrame, new: DataFrame, label: str = S.LABEL, with_p: bool = True,
             alpha: float = 0.05) -> DataFrame:
    """Q9: goodness of fit of the new label counts to the reference shares (two cells, 0 and 1).

    Expected counts are reference share x new rows; chi2 = sum (obs - exp)^2 / exp over cells
    with exp > 0.
    """
    return chi2_gof_rate(ref.agg(F.avg(F.col(label).cast("double")).alias("ref_rate")), new, label, with_p, alpha)


def chi2_gof_rate(r: DataFrame, new: DataFrame, label: str = S.LABEL, with_p: bool = True, alpha: float = 0.05) -> DataFrame:
    """Q9 against a one-row table with the reference's ``ref_rate``."""
    n = new.agg(F.count(F.lit(1)).alias("n_new"), F.avg(F.col(label).cast("double")).alias("new_rate"))
    j = side_by_side(r, n)
    o1, o0 = F.col("new_rate") * F.col("n_new"), (1 - F.col("new_rate")) * F.col("n_new")
    e1, e0 = F.col("ref_rate") * F.col("n_new"), (1 - F.col("ref_rate")) * F.col("n_new")
    term = lambda o, e: F.when(e > 0, F.pow(o - e, 2) / e).otherwise(F.lit(0.0))
    out = j.select(F.col("n_new").cast("bigint").alias("n_new"), (term(o1, e1) + term(o0, e0)).alias("chi2_statistic"),
                   F.round("ref_rate", 6).alias("churn_rate_ref"), F.round("new_rate", 6).alias("churn_rate_new"))
    if with_p:
        out = out.withColumn("p_value", p_chi2(F.col("chi2_statistic"), F.lit(1.0)))
        out = out.withColumn("drift_detected", F.coalesce(F.col("p_value") < alpha, F.lit(False)))
    return out.withColumn("chi2_statistic", F.round("chi2_statistic", 6))


def drift_rate(ks: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Q10: features checked, drifted, their names (in feature order) and the drift rate."""
    pos = F.lit(0)
    if order:
        pos = F.coalesce(F.array_position(F.array(*[F.lit(c) for c in order]), F.col("feature")), F.lit(0))
    x = ks.withColumn("__pos", pos)
    return x.agg(
        F.count(F.lit(1)).alias("features_checked"),
        F.count_if("drift_detected").alias("features_drifted"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.struct("__pos", "feature")))),
                    lambda s: s["feature"]).alias("drifted_features"),
    ).withColumn("drift_rate", F.coalesce(F.try_divide(F.col("features_drifted"), F.col("features_checked")),
                                          F.lit(0.0)))

"""Profiling aggregates (A1-A19), top-k operators (K1-K5) and unions.

Every per-feature loop of the original becomes one unpivot followed by one grouped aggregate, so
features are processed in parallel and each source table is scanned once. Results that list
categories (segments) are left-joined from a tiny label dimension so empty bins appear with a
count of 0, in the label order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.bins import INF, cut, label_dim
from ..functions.features import tenure_month
from ..session import checkpoint

# Segment edges and labels.
SERVICE_EDGES = [-1, 1, 3, INF]
SERVICE_LABELS = ["Low (0-1)", "Medium (2-3)", "High (4+)"]
USAGE_EDGES = [0, 500, 900, INF]
USAGE_LABELS = ["Low", "Medium", "High"]
RISK_CALL_EDGES = [-1, 1, 3, 10]
RISK_CALL_LABELS = ["Low Risk (0-1)", "Medium Risk (2-3)", "High Risk (4+)"]
PROB_EDGES = [0, 0.3, 0.7, 1.0]
PROB_LABELS = ["Low", "Medium", "High"]
ANOVA_CALL_EDGES = [0, 1, 3, 10]
ANOVA_CALL_LABELS = ["Low", "Medium", "High"]

# Retention economics of the deployment notebook.
CUSTOMER_VALUE = 1200
CAMPAIGN_COST = 200
RETENTION_SUCCESS = 0.40


def _label(df: DataFrame) -> Column:
    return F.col(S.LABEL).cast("double")


# ---------------------------------------------------------------- A1-A7

def churn_rate(df: DataFrame) -> DataFrame:
    """A1: rows, columns and mean label."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.round(F.avg(_label(df)), 6).alias("churn_rate")).withColumn("columns", F.lit(len(df.columns)))


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """A2: count (or proportion) per value, most frequent first. The column may hold any number of
    values, so their total is one aggregate of the checkpointed counts and not a window."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if normalize:
        g = checkpoint(g)
        total = g.agg(F.sum("n")).first()[0]
        g = g.withColumn("share", F.round(F.try_divide(F.col("n"), F.lit(total).cast("bigint")), 6))
    return g.orderBy(F.desc("n"), col)


def rate_by(df: DataFrame, col: str) -> DataFrame:
    """A3: rows and churn rate within each value of ``col``."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(_label(df)), 6).alias("churn_rate"))
            .orderBy(col))


def crosstab(df: DataFrame, a: str, b: str, values: list, normalize: str | None = None) -> DataFrame:
    """A4: contingency of ``a`` by ``b`` with fixed pivot ``values`` (no discovery job).

    ``normalize='index'`` gives row percentages.
    """
    p = df.groupBy(a).pivot(b, values).agg(F.count(F.lit(1)))
    names = [str(v) for v in values]
    p = p.fillna(0, subset=names)
    if normalize == "index":
        tot = sum((F.col(n) for n in names), F.lit(0))
        p = p.select(a, *[F.round(F.col(n) * 100.0 / tot, 6).alias(n) for n in names])
    return p.orderBy(a)


def count_by_class(df: DataFrame, col: str) -> DataFrame:
    """A5: counts per (value, label)."""
    return df.groupBy(col, S.LABEL).agg(F.count(F.lit(1)).alias("n")).orderBy(col, S.LABEL)


def rate_by_tenure_month(df: DataFrame) -> DataFrame:
    """Churn rate by whole tenure month."""
    return (df.groupBy(tenure_month().alias("tenure_month"))
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(_label(df)), 6).alias("churn_rate"))
            .orderBy("tenure_month"))


def kpis(df: DataFrame) -> DataFrame:
    """Customers, churn rate, callers above 3 service calls, international plan holders."""
    intl = F.col("international_plan")
    is_intl = (intl == F.lit("Yes")) if dict(df.dtypes)["international_plan"] == "string" else (intl == 1)
    return df.agg(
        F.count(F.lit(1)).alias("customers"),
        F.round(F.avg(_label(df)), 6).alias("churn_rate"),
        F.count_if(F.col("customer_service_calls") > 3).alias("high_risk_callers"),
        F.count_if(is_intl).alias("intl_plan_users"),
    )


# ---------------------------------------------------------------- segments A8-A13

def segment_table(df: DataFrame, value: Column, edges: list, labels: list, name: str = "segment",
                  include_lowest: bool = False, aggs: list[Column] | None = None) -> DataFrame:
    """Group by a right-closed bin of ``value``; every label appears, in order (empty = count 0)."""
    aggs = aggs or [F.count(F.lit(1)).alias("n"), F.avg(_label(df)).alias("churn_rate")]
    binned = df.select(cut(value, edges, labels, include_lowest).alias(name), *[
        F.col(c) for c in df.columns if c != name])
    g = binned.where(F.col(name).isNotNull()).groupBy(name).agg(*aggs)
    dim = label_dim(df.sparkSession, labels, name)
    out = dim.join(F.broadcast(g), name, "left")
    if "n" in g.columns:
        out = out.withColumn("n", F.coalesce(F.col("n"), F.lit(0)).cast("bigint"))
    return out.orderBy("pos").drop("pos")


def service_segments(df: DataFrame) -> DataFrame:
    """A10: churn rate by service-call band (-1,1], (1,3], (3,inf)."""
    t = segment_table(df, F.col("customer_service_calls"), SERVICE_EDGES, SERVICE_LABELS, "service_segment")
    return t.withColumn("churn_rate", F.round("churn_rate", 6))


def usage_segments(df: DataFrame) -> DataFrame:
    """Churn rate by total-minutes band (0,500], (500,900], (900,inf)."""
    t = segment_table(df, F.col("total_minutes"), USAGE_EDGES, USAGE_LABELS, "usage_segment")
    return t.withColumn("churn_rate", F.round("churn_rate", 6))


def segment_rates(df: DataFrame) -> DataFrame:
    """Dashboard risk segments of service calls: count and churn rate in percent."""
    t = segment_table(df, F.col("customer_service_calls"), RISK_CALL_EDGES, RISK_CALL_LABELS, "risk_segment")
    return t.select("risk_segment", "n", F.round(F.col("churn_rate") * 100.0, 6).alias("churn_rate_pct"))


def segment_matrix(df: DataFrame) -> DataFrame:
    """Usage band x service band churn rate in percent, service bands pivoted (fixed values)."""
    binned = df.select(
        cut(F.col("total_minutes"), USAGE_EDGES, USAGE_LABELS).alias("usage_segment"),
        cut(F.col("customer_service_calls"), SERVICE_EDGES, SERVICE_LABELS).alias("service_segment"),
        _label(df).alias("y"))
    p = (binned.where(F.col("usage_segment").isNotNull() & F.col("service_segment").isNotNull())
         .groupBy("usage_segment").pivot("service_segment", SERVICE_LABELS).agg(F.avg("y") * 100.0))
    dim = label_dim(df.sparkSession, USAGE_LABELS, "usage_segment")
    out = dim.join(F.broadcast(p), "usage_segment", "left").orderBy("pos").drop("pos")
    return out.select("usage_segment", *[F.round(F.col(f"`{lab}`"), 6).alias(S.safe_name(lab))
                                         for lab in SERVICE_LABELS])


def risk_segments(df: DataFrame, prob: str = "churn_probability") -> DataFrame:
    """Probability bands (0,.3], (.3,.7], (.7,1]: customers, mean probability, churn rate (4 dp)."""
    t = segment_table(df, F.col(prob), PROB_EDGES, PROB_LABELS, "risk_segment", aggs=[
        F.count(F.lit(1)).alias("n"), F.avg(prob).alias("mean_probability"), F.avg(_label(df)).alias("churn_rate")])
    return t.select("risk_segment", "n", F.round("mean_probability", 4).alias("mean_probability"),
                    F.round("churn_rate", 4).alias("churn_rate"))


def retention_roi(segments: DataFrame) -> DataFrame:
    """Campaign economics on the high band of ``risk_segments``."""
    high = segments.where(F.col("risk_segment") == "High").select(F.col("n").cast("double").alias("n_high"))
    return high.select(
        F.col("n_high").cast("bigint").alias("high_risk_customers"),
        (F.col("n_high") * CUSTOMER_VALUE).alias("revenue_at_risk"),
        (F.col("n_high") * CAMPAIGN_COST).alias("campaign_cost"),
        (F.col("n_high") * RETENTION_SUCCESS * CUSTOMER_VALUE).alias("revenue_retained"),
        F.round(F.try_divide(F.col("n_high") * RETENTION_SUCCESS * CUSTOMER_VALUE - F.col("n_high") * CAMPAIGN_COST,
                             F.col("n_high") * CAMPAIGN_COST) * 100.0, 6).alias("roi_pct"),
    )


# ---------------------------------------------------------------- distributions A14-A17, A19

def histogram(df: DataFrame, col: str, bins: int = 30, by: str | None = S.LABEL,
              density: bool = False) -> DataFrame:
    """Equal-width bins between the column's min and max; the last bin is closed.

    Bounds come from one aggregate (two numbers); the counting is one grouped aggregate. With
    ``density`` each class's counts are divided by (class rows x bin width).
    """
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int")
    lo, hi = float(lo), float(hi)
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    x = F.col(col).cast("double")
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    keys = [b.alias("bin")] + ([F.col(by)] if by else [])
    g = df.where(x.isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    g = g.withColumns({"bin_start": F.lit(lo) + F.col("bin") * F.lit(width),
                       "bin_end": F.lit(lo) + (F.col("bin") + 1) * F.lit(width)})
    if density:
        part = Window.partitionBy(by) if by else Window.partitionBy()
        g = g.withColumn("density", F.col("n") / (F.sum("n").over(part) * F.lit(width)))
    return g.orderBy(*(["bin", by] if by else ["bin"]))


def discrete_histogram(df: DataFrame, col: str, by: str = S.LABEL) -> DataFrame:
    """A14 (discrete form): counts per integer value and class."""
    return count_by_class(df.withColumnRenamed(by, S.LABEL) if by != S.LABEL else df, col)


def box_summary(df: DataFrame, col: str, by: str = S.LABEL) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (clamped to data), mean and count per class."""
    x = F.col(col).cast("double")
    from .ordered import exact_quantiles_long
    qs = exact_quantiles_long(df.select(F.col(by), x.alias("value")), [by], "value", [0.25, 0.5, 0.75]).groupBy(by).agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n) for p, n in
          [(0.25, "q1"), (0.5, "median"), (0.75, "q3")]])
    m = df.groupBy(by).agg(F.avg(x).alias("mean"), F.count(x).alias("n"))
    q = m.join(qs, by)
    fences = q.select(by, (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lf"),
                      (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("uf"))
    whisk = (df.select(F.col(by), x.alias("x")).join(fences, by)
             .groupBy(by).agg(F.min(F.when(F.col("x") >= F.col("lf"), F.col("x"))).alias("lower_whisker"),
                              F.max(F.when(F.col("x") <= F.col("uf"), F.col("x"))).alias("upper_whisker")))
    out = q.join(whisk, by)
    return out.select(by, "n", *[F.round(c, 6).alias(c) for c in
                                 ["q1", "median", "q3", "mean", "lower_whisker", "upper_whisker"]]).orderBy(by)


#: Rows of statistics that are broadcast.
SMALL = 100_000


def kde(df: DataFrame, cols: list[str], by: str = S.LABEL, grid: int = 100) -> DataFrame:
    """Gaussian density per (feature, class) on an equal grid, Scott bandwidth n^(-1/5)*sd.

    The data are first reduced to distinct (feature, class, value, count) rows; per (feature, class) the
    terms of all grid points are then added side by side in one aggregate (combined before the shuffle), so
    no row per value and grid point is ever made. The statistics (one row per feature and class) are broadcast if
    they are counted to be few, so values aren't shuffled onto few keys. A single value, or all values equal, has no density.
    """
    long = df.select(F.col(by).alias("cls"), *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot("cls", cols, "feature", "value").where(F.col("value").isNotNull())
    distinct = long.groupBy("feature", "cls", "value").agg(F.count(F.lit(1)).alias("w"))
    stats = long.groupBy("feature", "cls").agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("value").alias("sd"),
        F.min("value").alias("lo"), F.max("value").alias("hi"))
    stats = stats.withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).where("bw > 0")
    stats = checkpoint(stats)  # one row per feature and class; counted before it is broadcast
    few = F.broadcast if stats.count() <= SMALL else lambda df: df
    keyed = stats.select(F.col("feature").alias("f"), F.col("cls").alias("c"), "n", "bw", "lo", "hi")
    x = lambda i: F.col("lo") + (F.col("hi") - F.col("lo")) * F.lit(i) / F.lit(grid - 1)
    z = lambda i: (x(i) - F.col("value")) / F.col("bw")
    both = distinct.join(few(keyed), (F.col("feature") == F.col("f")) & F.col("cls").eqNullSafe(F.col("c")))
    sums = both.groupBy("feature", "cls").agg(
        *[F.sum(F.col("w") * F.exp(F.lit(-0.5) * z(i) * z(i))).alias(f"s{i}") for i in range(grid)],
        *[F.first(c).alias(c) for c in ("n", "bw", "lo", "hi")])
    points = F.array(*[F.struct(F.lit(i).alias("i"), F.round(x(i), 6).alias("x"),
                                F.round(F.col(f"s{i}") / (F.col("n") * F.col("bw") * F.lit(math.sqrt(2 * math.pi))), 9).alias("density"))
                       for i in range(grid)])
    return sums.select("feature", F.col("cls").alias(by), F.inline(points)).orderBy("feature", by, "i")


def pair_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """The class-tagged columns of a pair plot, every row."""
    return df.select(S.ID, S.LABEL, *cols)


def value_range(df: DataFrame, col: str) -> DataFrame:
    """Min and max of a column (default filter bounds)."""
    return df.agg(F.min(col).alias("min_value"), F.max(col).alias("max_value"))


def class_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per-feature mean of each class with conditional aggregates (one scan, no per-class split)."""
    y = _label(df)
    long = df.select(y.alias("y"), *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        "y", cols, "feature", "value")
    return long.groupBy("feature").agg(
        F.round(F.avg(F.when(F.col("y") == 1, F.col("value"))), 6).alias("mean_churned"),
        F.round(F.avg(F.when(F.col("y") == 0, F.col("value"))), 6).alias("mean_retained"),
    ).orderBy("feature")


# ---------------------------------------------------------------- K1-K5

def top_k(df: DataFrame, by: str | Column, k: int, tiebreak: list[str] | None = None,
          ascending: bool = False) -> DataFrame:
    """K1: k rows by a metric with a deterministic tie-break (planned as TakeOrderedAndProject)."""
    key = F.col(by) if isinstance(by, str) else by
    order = [key.asc() if ascending else key.desc()] + [F.col(c).asc() for c in (tiebreak or [])]
    return df.orderBy(*order).limit(k)


def top_k_per_row(values: Column, k: int = 6) -> Column:
    """K2: the k entries of an ARRAY<STRUCT<feature, shap_value>> with the largest |value|.

    ``array_sort`` with a comparator runs per row inside codegen'd expressions, never a shuffle.
    """
    ordered = F.array_sort(values, lambda a, b: F.when(F.abs(a["shap_value"]) > F.abs(b["shap_value"]), -1)
                           .when(F.abs(a["shap_value"]) < F.abs(b["shap_value"]), 1)
                           .when(a["feature"] < b["feature"], -1).when(a["feature"] > b["feature"], 1)
                           .otherwise(0))
    return F.slice(ordered, 1, k)


def best_by(df: DataFrame, metric: str = "roc_auc", position: str = "position") -> DataFrame:
    """K3: the row with the largest metric; the first listed wins a tie."""
    return df.orderBy(F.desc(metric), F.asc(position)).limit(1)


def latest(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """K4: the newest record (one aggregate); of equal timestamps the largest by the columns in order."""
    s = F.struct(*[F.col(c) for c in df.columns])
    ordered = [c for c, t in df.dtypes if "map<" not in t and c != ts]
    return df.agg(F.max_by(s, F.struct(ts, *ordered)).alias("r")).select("r.*")


def first_n(values: Column, n: int = 5) -> Column:
    """K5: first n entries of an array column."""
    return F.slice(values, 1, n)


# ---------------------------------------------------------------- U1-U2

def merge_sources(*dfs: DataFrame) -> DataFrame:
    """Bag union by name (missing columns become NULL)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def merge_training_data(original: DataFrame, batches: DataFrame, features: list[str],
                        label: str = S.LABEL) -> DataFrame:
    """The selected columns of the original table plus every conforming landed batch.

    ``batches`` comes from ``io.read_batches`` (non-conforming batches are already skipped there).
    """
    cols = list(features) + [label]
    return original.select(*cols).unionByName(batches.select(*cols))

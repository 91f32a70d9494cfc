"""Ordered prefix sums (W1) and what they carry: KS statistics, ROC-AUC, ROC and PR curves, quantiles.

A window ordered over a whole column runs in one task, and one partitioned by feature runs one
task per feature. ``prefix_sums`` instead works in two levels:

1. the input is first reduced to one row per distinct (group, value) with integer counts;
2. it is range partitioned by (group, value, tie-break), each row tagged with its partition, and
   checkpointed: the tags are fixed for every later read and retry, and the input is computed once;
3. a running sum runs inside each (partition, group), i.e. in many tasks of bounded size;
4. the sums of each (partition, group) form a small table whose running sums are the offsets. It
   is joined back under Spark's own size check.

Counts are integers, so the sums are exact and independent of the ranges chosen. There is one
plan for every size, and no boundary passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.pvalues import p_ks
from ..session import checkpoint


def prefix_sums(df: DataFrame, keys: list[str], order: str, cols: list[str], descending: bool = False,
                n_buckets: int | None = None, prefix: str = "cum_", tiebreak: list[str] | None = None,
                total_prefix: str | None = None, next_prefix: str | None = None) -> DataFrame:
    """Inclusive running sums of ``cols`` over ``order`` within ``keys``, as ``prefix+col``.

    ``df`` must hold one row per (keys, order, *tiebreak) value (aggregate first); ``tiebreak``
    orders tied rows, and a value that holds many rows is split over partitions by it. Null keys
    are a group of their own. ``n_buckets`` sets the number of ranges, by default the session's
    shuffle partitions, joined by AQE where they are small. ``total_prefix`` adds each group's
    total of every column, ``next_prefix`` the columns of the row that follows (null at the end).
    """
    place = [F.col(order).desc() if descending else F.col(order).asc(), *[F.col(t) for t in tiebreak or []]]
    ranges = [F.col(k) for k in keys] + place
    ranged = df.repartitionByRange(n_buckets, *ranges) if n_buckets else df.repartitionByRange(*ranges)
    x = checkpoint(ranged.withColumn("__p", F.spark_partition_id()))
    here = Window.partitionBy("__p", *keys).orderBy(*place)
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    firsts = [F.min_by(F.struct(*cols), F.struct(-F.col(order) if descending else F.col(order), *(tiebreak or []))).alias("__f")] if next_prefix else []
    parts = x.groupBy("__p", *keys).agg(*[F.sum(c).alias(f"__t_{c}") for c in cols], *firsts)
    group = Window.partitionBy(*keys)
    before = group.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    small = [F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__o_{c}") for c in cols]
    if total_prefix:
        small += [F.sum(f"__t_{c}").over(group).alias(f"{total_prefix}{c}") for c in cols]
    if next_prefix:
        small.append(F.lead("__f").over(group.orderBy("__p")).alias("__f"))
    parts = parts.select(F.col("__p").alias("__q"), *[F.col(k).alias(f"__of_{k}") for k in keys], *small)

    x = x.withColumns({f"{prefix}{c}": F.sum(c).over(upto) for c in cols}
                      | ({f"{next_prefix}{c}": F.lead(c).over(here) for c in cols} if next_prefix else {}))
    on = [F.col("__p") == F.col("__q"), *[F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys]]
    x = x.join(parts, on).withColumns({f"{prefix}{c}": F.col(f"{prefix}{c}") + F.col(f"__o_{c}") for c in cols})
    if next_prefix:
        x = x.withColumns({f"{next_prefix}{c}": F.coalesce(F.col(f"{next_prefix}{c}"), F.col(f"__f.{c}")) for c in cols})
    return x.drop("__p", "__q", "__f", *[f"__of_{k}" for k in keys], *[f"__o_{c}" for c in cols])


def _long_two_sample(ref: DataFrame, new: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value, a, b): distinct values with reference (a) and new (b) counts."""
    def side(df, flag):
        return (df.select(*[F.col(c).cast("double").alias(c) for c in cols])
                .unpivot([], cols, "feature", "value").where(F.col("value").isNotNull())
                .withColumn("side", F.lit(flag)))
    both = side(ref, 0).unionByName(side(new, 1))
    return both.groupBy("feature", "value").agg(
        F.count_if(F.col("side") == 0).cast("bigint").alias("a"),
        F.count_if(F.col("side") == 1).cast("bigint").alias("b"))


def distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value, n): the distinct non-NULL values of each column with their counts."""
    return (df.select(*[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot([], cols, "feature", "value").where(F.col("value").isNotNull())
            .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))


def merged_counts(ref: DataFrame, new: DataFrame) -> DataFrame:
    """(feature, value, a, b) from two tables of (feature, value, n); rows of one value are added up."""
    side = lambda df, a, b: df.select("feature", "value", (F.col("n") * a).alias("a"), (F.col("n") * b).alias("b"))
    both = side(ref, 1, 0).unionByName(side(new, 0, 1))
    return both.groupBy("feature", "value").agg(F.sum("a").cast("bigint").alias("a"), F.sum("b").cast("bigint").alias("b"))


def ks_counts(counts: DataFrame, with_p: bool = True, alpha: float = 0.05) -> DataFrame:
    """Q8 over (feature, value, a, b): the largest |F_a - F_b| over the distinct values of each feature."""
    c = prefix_sums(counts, ["feature"], "value", ["a", "b"], total_prefix="n_")
    c = c.withColumnsRenamed({"n_a": "n_ref", "n_b": "n_new"})
    # an empty side leaves the statistic undefined (NULL), not an error
    gap = F.abs(F.try_divide(F.col("cum_a"), F.col("n_ref")) - F.try_divide(F.col("cum_b"), F.col("n_new")))
    out = c.groupBy("feature").agg(F.max(gap).alias("ks_statistic"),
                                   F.first("n_ref").alias("n_ref"), F.first("n_new").alias("n_new"))
    out = out.select("feature", "ks_statistic",
                     F.col("n_ref").cast("bigint").alias("n_ref"), F.col("n_new").cast("bigint").alias("n_new"))
    if with_p:
        out = out.withColumn("p_value", p_ks(F.col("ks_statistic"), F.col("n_ref"), F.col("n_new")))
        out = out.withColumn("drift_detected", F.coalesce(F.col("p_value") < alpha, F.lit(False)))
    # the statistic is rounded for display only, after the p-value and the flag
    return out.withColumn("ks_statistic", F.round("ks_statistic", 6))


def ks_2samp(ref: DataFrame, new: DataFrame, cols: list[str], with_p: bool = True,
             alpha: float = 0.05) -> DataFrame:
    """Q8: two-sample KS statistic per feature: max over distinct values of |F_ref - F_new|.

    NULLs are dropped per feature. ``n_ref``/``n_new`` are the non-NULL counts.
    """
    return ks_counts(_long_two_sample(ref, new, cols), with_p, alpha)


def _score_table(df: DataFrame, score: str, label: str, keys: list[str]) -> DataFrame:
    y = F.col(label).cast("int")
    return (df.where(F.col(score).isNotNull())
            .groupBy(*keys, F.col(score).cast("double").alias("score"))
            .agg(F.count_if(y == 1).cast("bigint").alias("pos"),
                 F.count_if(y != 1).cast("bigint").alias("neg")))


def roc_auc(df: DataFrame, score: str, label: str, keys: list[str] | None = None) -> DataFrame:
    """Tie-aware ROC-AUC (rank-sum form) per key: sum_v pos(v) * (neg below v + neg(v)/2) / (P N)."""
    keys = keys or []
    t = _score_table(df, score, label, keys)
    c = prefix_sums(t, keys, "score", ["neg"])
    part = c.groupBy(*keys).agg(
        F.sum((F.col("pos").cast("decimal(18,0)") * (F.col("cum_neg") * 2 - F.col("neg")).cast("decimal(19,0)"))
              .cast("decimal(38,0)")).alias("s"),  # twice the rank sum, exact at any count
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    whole = F.col("P").cast("double") * F.col("N").cast("double") * F.lit(2.0)
    return part.select(*keys, F.try_divide(F.col("s").cast("double"), whole).alias("roc_auc"),
                       F.col("P").cast("bigint").alias("positives"), F.col("N").cast("bigint").alias("negatives"))


def _indexed_desc(df: DataFrame, score: str, label: str, keys: list[str], **more) -> DataFrame:
    t = _score_table(df, score, label, keys).withColumn("one", F.lit(1).cast("bigint"))
    c = prefix_sums(t, keys, "score", ["pos", "neg", "one"], descending=True, total_prefix="total_", **more)
    return c.withColumnsRenamed({"cum_one": "idx", "cum_pos": "tps", "cum_neg": "fps", "total_pos": "P", "total_neg": "N"})


def _with_end(c: DataFrame, keys: list[str], point: dict, end: dict) -> DataFrame:
    """One row per curve point, and ``end`` once per key beside the first point, from one pass."""
    rows = [F.struct(*[v.alias(k) for k, v in p.items()]) for p in (point, end)]
    both = F.when(F.col("idx") == 1, F.array(*rows)).otherwise(F.array(rows[0]))
    return c.select(*keys, F.inline(both))


def roc_curve(df: DataFrame, score: str, label: str, keys: list[str] | None = None,
              drop_intermediate: bool = True) -> DataFrame:
    """(fpr, tpr, threshold) by descending distinct score, collinear points dropped, plus the
    (0, 0) start with an infinite threshold. A point is collinear with its neighbours where the
    next score has the same counts."""
    keys = keys or []
    c = _indexed_desc(df, score, label, keys, next_prefix="next_")
    if drop_intermediate:
        c = c.where((F.col("idx") == 1) | F.col("next_one").isNull()
                    | (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg")))
    return _with_end(c, keys,
                     {"point": F.col("idx").cast("bigint"),
                      "fpr": F.round(F.try_divide(F.col("fps"), F.col("N")), 6),
                      "tpr": F.round(F.try_divide(F.col("tps"), F.col("P")), 6), "threshold": F.col("score")},
                     {"point": F.lit(0).cast("bigint"), "fpr": F.lit(0.0), "tpr": F.lit(0.0),
                      "threshold": F.lit(float("inf"))})


def pr_curve(df: DataFrame, score: str, label: str, keys: list[str] | None = None) -> DataFrame:
    """Precision and recall for every distinct threshold (score >= t), plus the (recall 0,
    precision 1) end point and the base-rate line P / (P + N)."""
    keys = keys or []
    base = F.round(F.col("P") / (F.col("P") + F.col("N")), 6)
    return _with_end(_indexed_desc(df, score, label, keys), keys,
                     {"threshold": F.col("score"),
                      "precision": F.round(F.coalesce(F.try_divide(F.col("tps"), F.col("tps") + F.col("fps")), F.lit(0.0)), 6),
                      "recall": F.round(F.coalesce(F.try_divide(F.col("tps"), F.col("P")), F.lit(1.0)), 6),
                      "base_rate": base},
                     {"threshold": F.lit(None).cast("double"), "precision": F.lit(1.0), "recall": F.lit(0.0),
                      "base_rate": base})


def exact_quantiles_long(long: DataFrame, keys: list[str], value: str, probs: list[float]) -> DataFrame:
    """Exact, linearly interpolated quantiles of ``value`` per key group, from distinct-value counts.

    The distributed form: distinct (keys, value) counts, their running counts by ``prefix_sums``,
    and one grouped aggregate that picks, for every probability, the two order statistics around
    the target rank (the smallest value whose running count exceeds the 0-based rank).
    Output: keys..., p, value.
    """
    d = long.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("__v")) \
        .agg(F.count(F.lit(1)).alias("__n"))
    c = prefix_sums(d, keys, "__v", ["__n"], total_prefix="__total").withColumnRenamed("__total__n", "__total")
    aggs = []
    for i, p in enumerate(probs):
        pos = (F.col("__total") - 1) * F.lit(float(p))
        aggs += [F.min(F.when(F.col("cum___n") > F.floor(pos), F.col("__v"))).alias(f"lo{i}"),
                 F.min(F.when(F.col("cum___n") > F.ceil(pos), F.col("__v"))).alias(f"hi{i}"),
                 F.max(pos - F.floor(pos)).alias(f"fr{i}")]
    g = c.groupBy(*keys).agg(*aggs)
    arr = F.array(*[F.struct(F.lit(float(p)).alias("p"),
                             (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"fr{i}")).alias("value"))
                    for i, p in enumerate(probs)])
    return g.select(*keys, F.explode(arr).alias("q")).select(*keys, "q.p", "q.value")


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """Exact quantiles per feature of a wide table: (feature, p, value)."""
    long = (df.select(*[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot([], cols, "feature", "value"))
    return exact_quantiles_long(long, ["feature"], "value", probs)


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict:
    """{column: [q(p) for p in probs]} for a fit step (one small result on the driver)."""
    out = {c: [None] * len(probs) for c in cols}
    if not cols:
        return out
    idx = {float(p): i for i, p in enumerate(probs)}
    for r in exact_quantiles(df, cols, probs).collect():
        out[r["feature"]][idx[float(r["p"])]] = r["value"]
    return out

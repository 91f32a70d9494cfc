"""Engineered usage and behaviour features (E1-E16) as Spark column expressions.

Two statistics depend on the whole frame: the maximum of the clipped total minutes (for the
usage/service interaction) and the median of international minutes (for the plan-usage flag).
They are fitted once (``fit_feature_stats``) and applied as literals, so scoring a single row
uses the training statistics instead of the row's own. ``stats=None`` fits them on the frame at
hand, which reproduces frame-local behaviour.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S


@dataclass(frozen=True)
class FeatureStats:
    max_total_minutes: float | None
    median_intl_minutes: float | None

    def as_dict(self) -> dict:
        return asdict(self)


def _present(df: DataFrame, cols: list[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


def null_skipping_sum(cols: list[str]) -> Column:
    """Row sum that treats NULL as 0 (an all-NULL row sums to 0)."""
    total = F.lit(0.0)
    for c in cols:
        total = total + F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return total


def clip0(c: Column) -> Column:
    """fill NULL with 0, then clip below at 0."""
    return F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(0.0))


def flag(cond: Column) -> Column:
    """Boolean to 0/1 where an unknown comparison counts as false."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def clipped_total_minutes(df: DataFrame) -> Column:
    return clip0(null_skipping_sum(_present(df, S.MINUTE_COLS)))


def fit_feature_stats(df: DataFrame) -> FeatureStats:
    """The two frame statistics: the maximum (one aggregate) and an exact median (size-checked plan)."""
    mx = md = None
    if _present(df, S.MINUTE_COLS):
        mx = df.agg(F.max(clipped_total_minutes(df))).first()[0]
    if "total_intl_minutes" in df.columns:
        from ..operators.ordered import column_quantiles  # exact median
        md = column_quantiles(df, ["total_intl_minutes"], [0.5])["total_intl_minutes"][0]
    return FeatureStats(mx, md)


def drop_matching(df: DataFrame, token: str) -> DataFrame:
    """Drop every column whose lower-cased name contains ``token``."""
    return df.drop(*[c for c in df.columns if token in c.lower()])


def engineer_features(df: DataFrame, stats: FeatureStats | None = None) -> DataFrame:
    """E1-E14 in the reference order; charge columns are dropped first.

    Expects the plans already encoded as 0/1. Every feature is skipped when its inputs are absent.
    """
    df = drop_matching(df, "charge")
    if stats is None:
        stats = fit_feature_stats(df)
    cols = set(df.columns)
    new: dict[str, Column] = {}

    def have(*names):
        return all(n in cols or n in new for n in names)

    def ref(name):
        return new[name] if name in new else F.col(name)

    if have("account_length"):
        new["customer_tenure_months"] = F.col("account_length") / F.lit(30.0)
    minutes = _present(df, S.MINUTE_COLS)
    calls = _present(df, S.CALL_COLS)
    if minutes:
        new["total_minutes"] = null_skipping_sum(minutes)
    if calls:
        new["total_calls"] = null_skipping_sum(calls)
    tenure_plus1 = ref("customer_tenure_months") + F.lit(1.0) if have("customer_tenure_months") else None
    if have("total_minutes", "customer_tenure_months"):
        new["avg_daily_usage"] = F.try_divide(ref("total_minutes"), tenure_plus1)
    if have("total_calls", "customer_tenure_months"):
        new["call_frequency"] = F.try_divide(ref("total_calls"), tenure_plus1)
    if have("total_intl_minutes", "total_minutes"):
        new["intl_usage_rate"] = F.try_divide(F.col("total_intl_minutes"), ref("total_minutes") + F.lit(1.0))
    if have("customer_service_calls"):
        new["high_service_calls"] = flag(F.col("customer_service_calls") > 3)
    if have("number_vmail_messages"):
        new["has_vmail"] = flag(F.col("number_vmail_messages") > 0)
    df = df.withColumns(new)

    # log transforms: the base column is overwritten by its clipped value first
    logs = [c for c in ["total_minutes", "total_calls", "avg_daily_usage", "call_frequency"] if c in df.columns]
    df = df.withColumns({c: clip0(F.col(c)) for c in logs})
    df = df.withColumns({f"log_{c}": F.log1p(F.col(c)) for c in logs})

    later: dict[str, Column] = {}
    cols = set(df.columns)
    if {"total_minutes", "customer_service_calls"} <= cols:
        mx = stats.max_total_minutes
        denom = F.lit(None).cast("double") if mx is None else F.lit(float(mx) + 1.0)
        later["usage_service_interaction"] = (
            F.try_divide(F.col("total_minutes"), denom) * F.col("customer_service_calls"))
    if {"international_plan", "total_intl_minutes"} <= cols:
        md = stats.median_intl_minutes
        above = F.lit(False) if md is None else (F.col("total_intl_minutes") > F.lit(float(md)))
        later["intl_plan_usage_flag"] = flag((F.col("international_plan") == 1) & above)
    if {"total_day_minutes", "total_minutes"} <= cols:
        later["day_usage_ratio"] = F.try_divide(F.col("total_day_minutes"), F.col("total_minutes") + F.lit(1.0))
    if {"customer_tenure_months", "avg_daily_usage"} <= cols:
        later["tenure_usage_score"] = F.col("customer_tenure_months") * F.col("avg_daily_usage")
    if {"customer_service_calls", "customer_tenure_months"} <= cols:
        later["service_calls_per_month"] = F.try_divide(
            F.col("customer_service_calls").cast("double"), F.col("customer_tenure_months") + F.lit(1.0))
    return df.withColumns(later)


def tenure_month(col: str = "account_length") -> Column:
    """Whole months of tenure (floor division by 30)."""
    return F.floor(F.col(col) / F.lit(30)).cast("bigint")


def new_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """Names present after a step and absent before it (sorted)."""
    return sorted(set(after.columns) - set(before.columns))

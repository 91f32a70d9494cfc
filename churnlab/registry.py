"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the driver's tables.

``oracle()`` holds the DuckDB SQL twin of every query that SQL can express; column names are the
same on both sides. Queries that depend on fitted models or iterative algorithms have no SQL twin
and are checked by invariants in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle_sql as O
from . import schema as S
from .functions import features as FE
from .operators import clean as C
from .operators import profile as P
from .session import checkpoint
from .sources import fixture as FX

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(_QUERIES)


def oracle() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)


# ---------------------------------------------------------------- shared stages

def usage(spark: SparkSession, sf: str) -> DataFrame:
    return FX.customer_usage(spark, sf)


def cleaned(spark: SparkSession, sf: str, one_hot: bool = False) -> DataFrame:
    """C11 on the fixture (one-hot optional: the profile queries keep ``state``).

    Cleaning and feature engineering fit statistics (medians, modes, max, median) before they
    transform, so the customer-level table is read several times. The deduplicated table is
    checkpointed once to the shared folder: every later pass reads it (one row per customer) and
    re-runs only narrow projections, instead of the lineitem / orders aggregation, the joins and
    the dedup shuffle; the lineage is cut for retries.
    """
    return C.preprocess(checkpoint(C.dedup_rows(usage(spark, sf))), one_hot_state=one_hot, dedup=False)


def features(spark: SparkSession, sf: str) -> DataFrame:
    """E16 on the cleaned table, statistics fitted on the same frame."""
    return FE.engineer_features(cleaned(spark, sf))


def _r(c: str, d: int = 6):
    return F.round(F.col(c), d).alias(c)


# ---------------------------------------------------------------- first slice

@register("customer_usage", O.with_blocks(O.CUSTOMER_USAGE, "SELECT * FROM customer_usage"))
def q_customer_usage(spark, sf):
    return usage(spark, sf).withColumns({c: F.round(c, 6) for c in S.CHARGE_COLS})


@register("service_segments", O.with_blocks(O.FEATURES, """
  SELECT d.service_segment, CAST(COALESCE(g.n, 0) AS BIGINT) AS n, ROUND(g.churn_rate, 6) AS churn_rate
  FROM (VALUES (0, 'Low (0-1)'), (1, 'Medium (2-3)'), (2, 'High (4+)')) d(pos, service_segment)
  LEFT JOIN (
    SELECT CASE WHEN customer_service_calls > -1 AND customer_service_calls <= 1 THEN 'Low (0-1)'
                WHEN customer_service_calls > 1 AND customer_service_calls <= 3 THEN 'Medium (2-3)'
                WHEN customer_service_calls > 3 THEN 'High (4+)' END AS seg,
           COUNT(*) AS n, AVG(CAST(churn AS DOUBLE)) AS churn_rate
    FROM features GROUP BY 1) g ON g.seg = d.service_segment
  ORDER BY d.pos"""))
def q_service_segments(spark, sf):
    return P.service_segments(features(spark, sf))


def _load_all():
    from . import registry_models, registry_monitor, registry_more  # noqa: F401  (register the rest)

"""Right-closed interval binning (the ``pd.cut`` convention) and label dimensions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INF = math.inf


def cut(c: Column | str, edges: list[float], labels: list[str], include_lowest: bool = False) -> Column:
    """Label of the interval (e[i], e[i+1]] holding the value; NULL out of range or for NULL.

    Not ``Bucketizer``/``width_bucket``: those close intervals on the left.
    """
    c = F.col(c) if isinstance(c, str) else c
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    out = None
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        if lo == -INF:
            cond = F.lit(True)
        elif include_lowest and i == 0:
            cond = c >= F.lit(lo)
        else:
            cond = c > F.lit(lo)
        if hi != INF:
            cond = cond & (c <= F.lit(hi))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(None).cast("string"))


def label_dim(spark: SparkSession, labels: list[str], name: str = "segment") -> DataFrame:
    """Tiny ordered label table: keeps empty bins and the label order in grouped results."""
    schema = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField(name, T.StringType())])
    return spark.createDataFrame([(i, lab) for i, lab in enumerate(labels)], schema)


def sql_cut(expr: str, edges: list[float], labels: list[str], include_lowest: bool = False) -> str:
    """The same binning as a SQL CASE expression (used by oracles)."""
    parts = []
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        conds = []
        if lo != -INF:
            conds.append(f"{expr} {'>=' if include_lowest and i == 0 else '>'} {lo!r}")
        if hi != INF:
            conds.append(f"{expr} <= {hi!r}")
        parts.append(f"WHEN {' AND '.join(conds) or 'TRUE'} THEN '{label}'")
    return "CASE " + " ".join(parts) + " END"

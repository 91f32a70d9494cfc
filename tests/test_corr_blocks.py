"""Correlations by blocked cross products against numpy, pair by pair."""

import numpy as np
import pytest

from churnlab.operators import stats as Q

COLS = ["a", "b", "c", "d"]


def plain(rows):
    x = np.array([[np.nan if v is None else v for v in r] for r in rows], float).reshape(-1, 4)
    out = {}
    for i in range(4):
        for j in range(i + 1, 4):
            p, q = (x[~np.isnan(x[:, [i, j]]).any(axis=1)][:, k] for k in (i, j))
            out[COLS[i], COLS[j]] = None if len(set(p)) < 2 or len(set(q)) < 2 else np.corrcoef(p, q)[0, 1]
    return out


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_pairwise_complete(spark, parts, offset):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 4)) @ rng.normal(size=(4, 4)) + offset
    rows = [tuple(None if rng.random() < 0.1 * k else float(v) for k, v in enumerate(r)) for r in x]
    rows = sorted(rows, key=lambda r: r[0])  # tasks with different means
    got = Q.corr_matrix(spark.createDataFrame(rows, "a double, b double, c double, d double").repartitionByRange(parts, "a"), COLS)
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in got.collect()}
    want = plain(rows)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=2e-6) for k in want)


def test_constant_and_empty_columns_and_tables(spark):
    rows = [(float(k), 3.0, None, float(k % 3)) for k in range(50)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in Q.corr_matrix(df, COLS).collect()}
    want = plain(rows)
    assert got.keys() == want.keys() and got["a", "b"] is None and got["a", "d"] == pytest.approx(want["a", "d"], abs=1e-6)
    assert Q.corr_matrix(df.limit(0), COLS).collect() == [] and Q.corr_matrix(df, ["a"]).collect() == []

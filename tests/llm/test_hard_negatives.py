import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, relabel=False):
    """The contract over all pairs, rows of one id included."""
    kept = []
    for i, x, label in rows:
        if i is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        kept.append((i, [math.floor(256 * v) for v in x], (label + 1) % 10 if relabel and i % 7 == 0 else label))
    out = []
    dot = lambda a, b: max(-(2**63 - 1), min(2**63 - 1, sum(p * q for p, q in zip(a, b))))
    for k, (i, x, label) in enumerate(kept):
        if i % 100:
            continue
        scored = sorted((-dot(x, y), j, other == label) for m, (j, y, other) in enumerate(kept) if m != k)
        for p, pos, _ in [s for s in scored if s[2]][:5]:
            window = [(n, j) for n, j, same in scored if not same and 80 * -p <= 100 * -n <= 100 * -p]
            out += [(i, pos, r, j, -p, -n) for r, (n, j) in enumerate(window[:5], 1)]
    return sorted(out)


def run(spark, rows, extra=False, **sizes):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("_id", "_row", "score", "anchor") if extra else ():
        df = df.withColumn(c, F.lit("x"))
    return sorted(tuple(r) for r in H.hard_negatives(df, **sizes).collect())


def test_whole_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in H.op11_strassen_negatives(spark, path).collect())
    assert got == plain(rows, relabel=True) and got


@pytest.mark.parametrize("sizes", [{}, {"tile_rows": 40, "tile_anchors": 2}])
def test_ties_nulls_and_repeated_rows(spark, sizes):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.5, 0.25, -0.125, 1.0]) for _ in range(6)], rng.randrange(3)) for i in range(0, 700)]
    rows += [(300, rows[300][1], rows[300][2])] * 2 + [(2000, [0.5] * 6, 1)] * 7
    rows += [(None, [1.0] * 6, 1), (400, None, 1), (500, [1.0] * 6, None), (600, [1.0, None] * 3, 1), (800, [math.nan] * 6, 1),
             (900, [math.inf] + [0.0] * 5, 1), (1000, [], 1), (1100, [1.0] * 4, 2), (1200, [-1.0] * 6, 0)]
    assert run(spark, rows, extra=True, **sizes) == plain(rows)


def test_one_vector_held_by_most_rows(spark):
    rows = [(i, [0.3, 0.4], i % 2) for i in range(1500)] + [(3000 + i, [0.3, i / 400], 5) for i in range(150)]
    assert run(spark, rows, tile_rows=100, tile_anchors=4) == plain(rows)


def test_scores_beyond_64_bits(spark):
    big = 2.0**28
    rows = [(0, [big] * 4, 1), (1, [big] * 4, 1), (2, [big / 2] * 4, 1), (3, [big] * 4, 2), (4, [big * 0.45] * 4, 2), (5, [1e300] * 4, 2), (6, [-1e300] * 4, 1)]
    assert run(spark, rows) == plain(rows)
    fit = [(i, [v / 2**10 for v in x], label) for i, x, label in rows if i not in (5, 6)]
    assert run(spark, fit) == plain(fit) and plain(fit)[0][-1] > 2**50


def test_no_rows_and_no_partners(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0], 1), (1, [1.0], 2)]) == []
    assert run(spark, [(7, [1.0], 1)]) == []


def test_strassen_equals_plain_products():
    rng = np.random.default_rng(1)
    for _ in range(40):
        m, k, n = rng.integers(1, 70, 3)
        a, b = rng.integers(-2**62, 2**62, (m, k)), rng.integers(-2**62, 2**62, (k, n))
        assert (H.strassen(a, b, leaf=4) == a @ b).all()      # modulo 2**64
        small = H.scores(a >> 40, (b >> 40).T.copy(), leaf=3)
        assert (small == (a >> 40) @ (b >> 40)).all()

import random
import re
from itertools import combinations

import numpy as np

from churnlab.llm import near_dedup as N
from churnlab.llm.components import connected_components

from .helpers import docs_frame, real_docs, rows_of


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets, parent = {}, {}
    for i, t, *_ in rows:
        if i is not None:
            sets.setdefault(i, set()).add(shingles(t))
            parent[i] = i

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        if any(x and y and 100 * len(x & y) >= 85 * len(x | y) for x in sets[a] for y in sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    out = []
    for i, t, *_ in rows:
        c = None if i is None else root(i)
        out.append((i, len(shingles(t)), c, i == c))
    return sorted(out, key=repr)


def family(rng, n, edits):
    """A text and variants of it with up to ``edits`` words changed, added or left out."""
    base = [f"w{rng.randint(0, 500)}" for _ in range(n)]
    for _ in range(1_000_000):
        x = list(base)
        for _ in range(rng.randint(0, edits)):
            x[(k := rng.randrange(len(x))):k + rng.randint(0, 1)] = [f"q{rng.randint(0, 10 ** 6)}"] * rng.randint(0, 1)
        yield " ".join(x)


def cases():
    rng, rows = random.Random(5), []
    for n, edits in ((120, 5), (300, 12), (40, 2), (7, 1)):
        many = family(rng, n, edits)
        rows += [(len(rows) + k, next(many)) for k in range(45)]
    rng.shuffle(rows)
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one TWO"), (905, "one"), (906, "É é"), (907, "é é"),
                   (908, "x " * 30_000), (909, "x " * 20_000), (1, rows[0][1])][:-1] + [(5000, rows[0][1].upper()), (5000, rows[0][1].upper()), (None, rows[0][1])]


def test_components_equal_all_pairs(spark):
    rows = cases()
    assert rows_of(N.near_duplicate_components(docs_frame(spark, rows, extra=True).repartition(4))) == brute(rows)


def test_real_table(spark):
    rows = real_docs(spark)
    assert rows_of(N.near_duplicate_components(docs_frame(spark, rows))) == brute(rows)


def test_pigeonhole_every_pair_within_the_distance_meets(spark):
    rng = np.random.default_rng(3)
    sig = rng.integers(0, 256, (1, N.PLACES)).astype(np.uint8).repeat(200, 0)
    for k in range(1, 200):
        at = rng.choice(N.PLACES, 2 * N.CHUNKS - 1, replace=False)
        sig[k, at] += 1
    df = spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in enumerate(sig)], "id long, places binary")
    keys = {}
    for r in N.bucket_keys(df).collect():
        keys.setdefault(r["id"], set()).add(r["key"])
    assert all(keys[0] & keys[k] for k in range(1, 200))


def test_signature_distance_follows_similarity():
    rng = np.random.default_rng(4)
    a = np.unique(rng.integers(0, 1 << 63, 4000).astype(np.uint64) * np.uint64(2))
    b = np.unique(np.concatenate([a[:3400], rng.integers(0, 1 << 63, 300).astype(np.uint64)]))
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    differ = np.unpackbits((N.bits(N.lowest(a, N.WIDE)) ^ N.bits(N.lowest(b, N.WIDE))).view(np.uint8)).sum()
    assert abs(differ / N.WIDE - (1 - j) / 2) < 0.04


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1100)] + [(2000, k) for k in range(1900, 1990)]
    parent = {v: v for e in edges for v in e}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {v: root(v) for e in edges if e[0] != e[1] for v in e}


def test_drop_and_empty(spark):
    docs = docs_frame(spark, [(3, "a b c d e f"), (2, "A b c d e  f"), (9, "z"), (None, "z")], extra=True)
    left = N.drop_near_duplicates(docs)
    assert left.columns == docs.columns and [r[0] for r in rows_of(left, "doc_id")] == [2, 9, None]
    assert N.near_duplicate_components(docs_frame(spark, [])).collect() == []

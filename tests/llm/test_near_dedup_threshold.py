"""The link threshold of the near-duplicate operator and of the pipeline stage."""

import random
from itertools import combinations

import pytest

import corpus_pipeline as C
from churnlab.llm import near_dedup as N

from .helpers import docs_frame, real_docs, rows_of
from .test_near_dedup import cases, shingles


def kept_by_all_pairs(rows, percent):
    """Ids that are the smallest of their component, from all pairs of shingle sets."""
    sets = {i: shingles(t) for i, t, *_ in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return sorted((i,) for i in sets if root(i) == i)


def between(rng, first):
    """Pairs of texts with a similarity of 0.80 to under 0.85: 160 of 200 shingles, 81 of 100, 84 of 100."""
    rows = []
    for same, left, right in ((160, 20, 20), (160, 0, 40), (81, 10, 9), (84, 8, 8)):
        words = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(same + 4)]
        for extra in (left, right):
            rows.append((first + len(rows), " ".join(words + [f"v{rng.randint(0, 10 ** 6)}" for _ in range(extra)])))
    return rows


def test_stage_equals_all_pairs_at_80(spark):
    rows = [r for r in cases() if r[0] is not None and r[0] < 900] + between(random.Random(8), 10_000)
    want = kept_by_all_pairs(rows, 80)
    assert want != kept_by_all_pairs(rows, 85)
    assert rows_of(C.near_duplicates(spark, docs_frame(spark, rows).repartition(4), None), "doc_id") == sorted(want, key=repr)


def test_stage_equals_all_pairs_on_the_real_table(spark):
    rows = real_docs(spark)
    assert rows_of(C.near_duplicates(spark, docs_frame(spark, rows), None), "doc_id") == sorted(kept_by_all_pairs(rows, 80), key=repr)


def test_limits_follow_the_threshold():
    assert N.limits(85)[:3] == (85, 12, 6) and N.limits(80)[:3] == (80, 14, 5)
    for percent in (80, 85, 90, 95):
        lim, apart = N.limits(percent), 1 - percent / 100
        assert lim.chunks * lim.width <= N.MAX_KEYS <= 128
        assert N.beyond(lim.chunks * lim.width, apart * 255 / 256, 2 * lim.chunks - 1) <= N.MISSED
        assert max(N.beyond(N.BITS, apart / 2, lim.max_bits), N.beyond(N.WIDE, apart / 2, lim.max_wide)) <= N.FILTERED
    assert abs(N.beyond(4, 0.5, 2) - 5 / 16) < 1e-12
    with pytest.raises(ValueError):
        N.limits(50)


def test_bit_filters_lose_nothing_beside_the_index():
    assert (N.limits(85).max_bits, N.limits(85).max_wide) == (79, 230)
    for percent in (80, 85):
        lim, apart = N.limits(percent), 1 - percent / 100
        assert max(N.beyond(N.BITS, apart / 2, lim.max_bits), N.beyond(N.WIDE, apart / 2, lim.max_wide)) <= 1e-9

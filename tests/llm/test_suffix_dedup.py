import hashlib
import random
import re

import numpy as np

from churnlab.llm import suffix_dedup as S

from .helpers import docs_frame, real_docs


def brute(rows):
    """One result row per input row, by a table of all 50-byte strings."""
    texts = [((1 << 63) - 1 if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    least = {}
    for i, t in texts:
        for k in range(len(t) - 49):
            least[t[k:k + 50]] = min(i, least.get(t[k:k + 50], i))
    out = []
    for (i, t), r in zip(texts, rows):
        gone = bytearray(len(t))
        for k in range(len(t) - 49):
            if least[t[k:k + 50]] < i:
                gone[k:k + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((r[0], len(t), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in df.collect()), key=repr)


def cases():
    rng = random.Random(4)
    word = lambda n: "".join(rng.choices("abcdefg é", k=n))
    passage, edge = word(120), word(50)
    rows = [(i, word(rng.randint(0, 200)) + passage[rng.randint(0, 60):rng.randint(61, 120)] + word(rng.randint(0, 200))) for i in range(40)]
    rows += [(50, edge), (51, "x" + edge), (52, edge[:49]), (53, None), (54, ""), (55, "ab" * 400), (56, "ab" * 300 + word(9)), (57, "a" * 500)]
    rows += [(58, rows[3][1]), (58, rows[3][1]), (2, rows[9][1] + rows[5][1]), (None, rows[7][1]), (59, "a" * 49 + "b" + "a" * 60), (60, "日本" * 60), (61, "x日本" * 60)]
    return rows


def test_equals_the_table_of_all_strings(spark):
    rows = cases()
    assert found(S.drop_repeated_passages(docs_frame(spark, rows, extra=True).repartition(3))) == brute(rows)


def test_common_anchors(spark):
    rows = cases()
    assert found(S.drop_repeated_passages(docs_frame(spark, rows).repartition(3), common=0)) == brute(rows)


def test_real_table(spark):
    rows = real_docs(spark)
    assert found(S.drop_repeated_passages(docs_frame(spark, rows).repartition(4))) == brute(rows)


def test_long_texts_are_sliced(spark):
    rng = random.Random(8)
    long = "".join(rng.choices("abcdefghij ", k=2_500_000))
    rows = [(1, long), (2, long[900_000:1_200_000] + "q" * 30), (3, "zz" + long[1_048_500:1_048_600])]
    got = {r["doc_id"]: r for r in S.drop_repeated_passages(docs_frame(spark, rows)).collect()}
    assert got[1]["n_spans"] == 0 and len(got[1]["kept"]) == 2_500_000
    assert (got[2]["kept"], got[2]["n_spans"]) == (b"q" * 30, 1) and got[3]["kept"] == b"zz"


def test_suffix_order_and_collisions():
    rng = np.random.default_rng(2)
    content = rng.integers(0, 2, (60, S.WIDTH)).astype(np.uint8)
    content[20:40] = content[0]
    s = S.Suffixes(content, 3)
    n = len(content)
    record, offset = np.arange(n), np.full(n, 5)
    order = s.merge_sorted(record, offset, np.full(n, n), np.arange(n))
    keys = [content[r, 5:55].tobytes() for r in order]
    assert keys == sorted(keys) and sorted(order) == list(range(n))


def test_a_collision_is_sorted_again(monkeypatch):
    records = np.zeros(2, S.RECORD)
    records["high"], records["bytes"][1, 3] = 4, 7
    real, seeds = S._family, []

    def weak(seed, n):
        seeds.append(seed)
        values, powers, back = real(seed, n)
        return (np.zeros_like(values), powers, back) if seed == 11 else (values, powers, back)

    monkeypatch.setattr(S, "_family", weak)
    got = S.covered_windows(records, np.array([1, 2]))
    assert got.tolist() == [0, 0b10000] and seeds == [11, 12]


def test_offsets_in_parts_give_the_same(monkeypatch):
    rng = np.random.default_rng(6)
    records = np.zeros(80, S.RECORD)
    records["key"], records["low"], records["high"] = np.sort(rng.integers(0, 9, 80)), rng.integers(0, 5, 80), rng.integers(5, S.SPAN + 1, 80)
    records["bytes"] = np.repeat(rng.integers(0, 2, (8, S.WIDTH)), 10, 0)
    ids = rng.integers(0, 50, 80)
    whole = S.covered_windows(records, ids)
    monkeypatch.setattr(S, "SORTED_WINDOWS", 300)
    assert whole.any() and (S.covered_windows(records, ids) == whole).all()


def test_empty_table(spark):
    assert S.drop_repeated_passages(docs_frame(spark, [])).collect() == []

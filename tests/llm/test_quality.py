import re
from collections import Counter

import xxhash
from pyspark.sql import types as T

from churnlab.llm import quality as Q

from .helpers import docs_frame, real_docs, rows_of


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def hash_word(w):
    return signed(xxhash.xxh64(w.encode(), seed=42).intdigest())


def hash_pair(a, b):
    h = 42
    for x in (a, b):
        h = xxhash.xxh64((x & (1 << 64) - 1).to_bytes(8, "little"), seed=h).intdigest()
    return signed(h)


def base(t):
    ws = words(t)
    wins = Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))
    covered = {i + k for i in range(len(ws) - 4) if wins[tuple(ws[i:i + 5])] > 1 for k in range(5)}
    lines, seen, dup = (t or "").split("\n"), set(), 0
    for x in lines:
        if words(x):
            dup += x in seen
            seen.add(x)
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(covered),
            len(ws) < 10 or 100 * len(covered) > 20 * len(ws))


CASES = [(1, None), (2, ""), (3, "a b c d e f g h i j"), (4, "a b c d e a b c d e a b c d e"), (5, "x\ny\nx\n\n\nx y z"), (6, "# <b> $5 | *"),
         (7, " ".join(["w"] * 5000)), (8, "ab " * 3 + "\n" * 4 + "ab ab ab ab ab c d e f g h i"), (8, "ab " * 3), (9, "x" * 100_000),
         (10, " ".join(f"w{i % 700}" for i in range(3000)))]


def test_base_counts(spark):
    for rows in (CASES, real_docs(spark)):
        got = rows_of(Q.base_counts(docs_frame(spark, rows, extra=True)).drop("_hashes"))
        assert got == sorted(((r[0], *base(r[1])) for r in rows), key=repr)


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.LongType())]))


def test_ratio_equals_counting_by_hand(spark):
    import math
    rows, b = real_docs(spark, 80) + [(9001, None), (9002, "")], 512
    good = {r[0] for r in rows[::3]}
    got = {r["doc_id"]: r for r in Q.quality_verdicts(docs_frame(spark, rows), labels_frame(spark, [(i, 1) for i in good] + [(None, 1), (5, None)]), buckets=b).collect()}

    def grams(t):
        h = [hash_word(w) for w in words(t)]
        return [x % b for x in h] + [hash_pair(x, y) % b for x, y in zip(h, h[1:])]

    raw, target = Counter(), Counter()
    for i, t, *_ in rows:
        raw.update(grams(t))
        target.update(grams(t) if i in good else [])
    ratio = {k: math.log((target[k] + 1) / (sum(target.values()) + b)) - math.log((raw[k] + 1) / (sum(raw.values()) + b)) for k in range(b)}
    for i, t, *_ in rows:
        g = grams(t)
        want = sum(ratio[k] for k in g) / max(1, len(g))
        assert abs(got[i]["log_ratio"] - want) < 1e-6
        assert got[i]["kept"] == (not base(t)[-1] and got[i]["log_ratio"] >= Q.MIN_RATIO)


def test_without_labels_the_base_rules_decide(spark):
    got = Q.quality_verdicts(docs_frame(spark, CASES), labels_frame(spark, [])).collect()
    assert all(r["log_ratio"] == 0 and r["kept"] == (not r["base_failed"]) for r in got) and len(got) == len(CASES)


def test_trusted_bound(spark):
    labels = labels_frame(spark, [(i, 1) for i in range(3000)])
    assert 0 < Q.trusted_ids(labels, max_trusted=500).count() <= 600
    assert Q.trusted_ids(labels, max_trusted=3000).count() == 3000


def test_drop_keeps_columns_and_empty_table(spark):
    docs, labels = docs_frame(spark, CASES, extra=True), labels_frame(spark, [(3, 1)])
    left, verdicts = Q.drop_low_quality(docs, labels), Q.quality_verdicts(docs, labels)
    assert left.columns == docs.columns
    assert rows_of(left, "doc_id") == rows_of(verdicts.filter("kept"), "doc_id")
    assert Q.quality_verdicts(docs_frame(spark, []), labels).collect() == []


def test_labelled_junk_goes_and_good_text_stays(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = Q.quality_verdicts(docs, labels).join(labels, "doc_id").select("quality", "kept").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    assert sum(good) / len(good) > 0.97

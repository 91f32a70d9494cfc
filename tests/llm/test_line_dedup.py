import hashlib
import random
import re

from pyspark.sql import functions as F

from churnlab.llm import line_dedup as L

from .helpers import docs_frame, real_docs


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows):
    lines, first = [], {}
    for i, t, *_ in rows:
        lines += [((1 << 63) - 1 if i is None else i, k, x) for k, x in enumerate((t or "").split("\n")) if re.search(r"[^\x20\x09-\x0D]", x)]
    for i, k, x in sorted(lines):
        first.setdefault(x, (i, k))
    long = sorted((len(x), x) for x in first if len(x) >= L.MIN_CHARS)
    near = set()
    for n, (size, x) in enumerate(long):
        for size2, y in long[n + 1:]:
            if size2 - size > L.EDITS:
                break
            if distance(x, y) <= L.EDITS:
                near.add(max((x, y), key=first.get))
    out = []
    for i, t, *_ in rows:
        own, kept, exact, close, n = 1 << 63, [], 0, 0, 0
        own = (1 << 63) - 1 if i is None else i
        for k, x in enumerate((t or "").split("\n")):
            word = re.search(r"[^\x20\x09-\x0D]", x)
            n += bool(word)
            if word and first[x] < (own, k):
                exact += 1
            elif word and x in near:
                close += 1
            else:
                kept.append(x)
        out.append((i, n, exact, close, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(6)
    base = ["".join(rng.choices("abcd é", k=n)) + "x" for n in (31, 32, 33, 40, 64, 65, 130, 400)]
    rows = []
    for i in range(60):
        x = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(x))
            x[k:k + rng.randint(0, 1)] = rng.choices("abcd é", k=rng.randint(0, 1))
        rows.append((i, "\n".join(rng.sample(["".join(x), rng.choice(base), "short", "", " ", f"line {i % 7}"], k=rng.randint(1, 6)))))
    return rows + [(70, None), (71, ""), (72, "\n\n"), (5, rows[5][1]), (None, base[3] + "\nown line"), (73, "z" * 1_500 + "\n" + "z" * 1_499 + "y")]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equals_all_pairs(spark):
    rows = cases()
    assert found(L.line_report(docs_frame(spark, rows, extra=True).repartition(3))) == brute(rows)


def test_hot_lines_take_part_once(spark, monkeypatch):
    monkeypatch.setattr(L, "HOT", 2)
    rows = cases()
    assert found(L.line_report(docs_frame(spark, rows).repartition(3))) == brute(rows)


def test_real_lines(spark):
    rows = real_docs(spark, 50)
    assert found(L.line_report(docs_frame(spark, rows))) == brute(rows)


def test_bit_parallel_verification(spark):
    rng, pairs = random.Random(9), []
    for _ in range(400):
        a = "".join(rng.choices("ab é", k=rng.randint(1, 12)))
        b = "".join(rng.choices("ab é", k=max(1, len(a) + rng.randint(-2, 2))))
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("ok", L.within(F.col("a"), F.col("b")))
    assert all(r["ok"] == (distance(r["a"], r["b"]) <= 2) for r in df.collect())


def test_drop_keeps_columns(spark):
    docs = docs_frame(spark, [(1, "a line of text that is long enough to match\nx"), (2, "a line of text that is long enough to watch\ny"), (3, None)], extra=True)
    out = L.drop_repeated_lines(docs)
    assert out.columns == docs.columns and {r["doc_id"]: r["text"] for r in out.collect()} == {1: "a line of text that is long enough to match\nx", 2: "y", 3: None}


def test_empty_table(spark):
    assert L.line_report(docs_frame(spark, [])).collect() == []

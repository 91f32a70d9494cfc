import hashlib
import re

from pyspark.sql import functions as F

from churnlab.llm import exact_dedup as E

from .helpers import docs_frame, real_docs, rows_of


def brute(rows):
    normal = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(normal(t), []).append((-len(t or ""), i))
    return sorted(((i, min(g := groups[normal(t)])[1], len(g), i == min(g)[1], hashlib.sha256(normal(t).encode()).hexdigest())
                   for i, t, *_ in rows), key=repr)


CASES = [(1, "a b"), (2, "ab"), (3, " a\tb "), (4, None), (5, ""), (6, " \n"), (7, "ab "), (8, "é x"), (9, "éx "), (10, "x" * 200_000),
         (11, "x" * 200_000 + "\n"), (12, "q"), (12, "q")]


def test_cases_and_extra_columns(spark):
    for extra in (False, True):
        assert rows_of(E.duplicate_groups(docs_frame(spark, CASES, extra))) == brute(CASES)


def test_colliding_digests_compare_texts(spark):
    weak = lambda t: F.substring(F.sha2(t, 256), 1, 1)  # noqa: E731  sixteen digests at most
    got = rows_of(E.duplicate_groups(docs_frame(spark, CASES + real_docs(spark, 60)).repartition(5), digest=weak), "doc_id", "keep_id", "group_size", "kept")
    assert got == sorted((r[:4] for r in brute(CASES + real_docs(spark, 60))), key=repr)


def test_real_table(spark):
    rows = real_docs(spark)
    assert rows_of(E.duplicate_groups(docs_frame(spark, rows).repartition(7))) == brute(rows)


def test_null_id_comes_last(spark):
    got = rows_of(E.duplicate_groups(docs_frame(spark, [(None, "a"), (3, "a")])), "doc_id", "keep_id", "kept")
    assert got == [(3, 3, True), (None, 3, False)]


def test_drop_keeps_one_of_each_group_with_all_columns(spark):
    docs = docs_frame(spark, CASES, extra=True)
    left = E.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted({r["doc_id"] for r in left.collect()}) == sorted({r[0] for r in brute(CASES) if r[3]})


def test_empty_table(spark):
    assert E.duplicate_groups(docs_frame(spark, [])).collect() == []
    assert E.drop_exact_duplicates(docs_frame(spark, [])).collect() == []

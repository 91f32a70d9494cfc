import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from churnlab.llm import packing as P

from .helpers import docs_frame, real_docs


@pytest.fixture(scope="module")
def plain():
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids + [2]


def check(got, rows, ids_of):
    want = defaultdict(int)
    for i, t, *_ in rows:
        ids = ids_of(t)
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    have, places = defaultdict(int), defaultdict(list)
    for r in got:
        have[(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])] += 1
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert have == want
    for p in places.values():
        at = 0
        for o, n in sorted(p):
            assert o == at
            at += n
        assert at <= 1024
    return len(places)


CASES = [(1, None), (2, ""), (3, "a <|endoftext|> b"), (4, "é 日本 \t\n  x"), (5, "word " * 5000), (6, "same"), (6, "same"), (None, "no id"),
         (7, "x" * 120_000), (8, "a " * 1022), (9, "a " * 1023), (10, "a " * 1024)]


def test_pieces_and_places(spark, plain):
    assert check(P.packed_documents(docs_frame(spark, CASES, extra=True)).collect(), CASES, plain) >= 5


def test_real_table_is_within_one_of_its_bound(spark, plain):
    rows = real_docs(spark)
    got = P.packed_documents(docs_frame(spark, rows)).collect()
    n = check(got, rows, plain)
    counts = np.bincount([r["length"] for r in got], minlength=1025)
    assert n <= P.lower_bound(counts) + 1


def test_exchange_closes_gaps(spark):
    rng = random.Random(3)
    rows = [(i, 0, 0, rng.choice([600, 500, 400, 300, 124, 100, 24, 1023, 512]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    used = lambda d: d.select("sequence_id").distinct().count()
    one, many = used(P.pack(df, items=100, rounds=1)), used(P.pack(df, items=100))
    bound = P.lower_bound(np.bincount([r[3] for r in rows], minlength=1025))
    assert bound <= many <= one and many <= bound * 1.01 + 1


def test_bounds_never_exceed_a_packing():
    rng = np.random.default_rng(5)
    for _ in range(60):
        lengths = rng.integers(1, 30, rng.integers(1, 60))
        assert P.lower_bound(np.bincount(lengths, minlength=31), 30) <= len(P.best_fit(lengths, 30)[2])
    assert P.lower_bound(np.bincount([16] * 9, minlength=31), 30) == 9      # every pair is too long
    assert P.lower_bound(np.bincount([11] * 9, minlength=31), 30) == 5      # two to a bin
    assert P.best_fit(np.array([5, 30, 25, 1]), 30)[2].tolist() == [30, 30, 1]


def test_tokens_equal_the_tokenizers_library(plain):
    enc, rng = P.encoder(P.TOKENIZER), random.Random(7)
    chars = [chr(c) for c in [*range(0x250), 0x85, 0xA0, 0x2028, 0x3000, 0x4E00, 0x1F600, 0x301, 0x200D]] + ["<|endoftext|>", "  ", "'ll", "\n\n"]
    texts = ["".join(rng.choices(chars, k=rng.randint(1, 40))) for _ in range(3000)]
    texts += [f"a{chr(c)}b 1{chr(c)} {chr(c)}" for c in range(0, 0x30000, 37) if not 0xD800 <= c < 0xE000] + ["a" * 50_000, " " * 50_000]
    assert all(enc.encode(t, allowed_special="all") + [2] == plain(t) for t in texts)


def test_empty_table(spark):
    assert P.packed_documents(docs_frame(spark, [])).collect() == []

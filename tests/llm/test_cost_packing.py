import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from churnlab.llm import cost_packing as C
from churnlab.llm.packing import best_fit

from .helpers import docs_frame, real_docs


@pytest.fixture(scope="module")
def plain():
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path(C.TOKENIZER))
    return lambda t: [*tok.encode(t or "", add_special_tokens=False).ids, 1]


def check(got, rows, ids_of, capacity=2048):
    """Every id once, gapless sequences, no padding; gives the sequences."""
    have, places, copies = defaultdict(list), defaultdict(list), defaultdict(int)
    for key, text, *_ in rows:
        copies[key, tuple(ids_of(text))] += 1
    for r in got:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == r["length"] > 0
        have[r["doc_id"]].append((r["start"], r["doc_tokens"], ids))
        places[r["sequence_id"]].append((r["offset"], r["length"], r["sequence_cost"]))
    left = defaultdict(int)
    for (key, ids), n in copies.items():
        for at, token in enumerate(ids):
            left[key, len(ids), at, token] += n
    for key, pieces in have.items():
        for start, total, ids in pieces:
            for at, token in enumerate(ids, start):
                left[key, total, at, token] -= 1
    assert not any(left.values())
    for p in places.values():
        at = 0
        for offset, n, cost in sorted(p):
            assert offset == at
            at += n
        assert at == capacity or (at < capacity and at & (at - 1) == 0)
        assert {c for *_, c in p} == {sum(C.LINEAR * n + n * n for _, n, _ in p)}
    return places


CASES = [(1, None), (2, ""), (3, "a <|endoftext|> B"), (4, "é 日本 \t\n  x"), (5, "word " * 5000), (6, "same"), (6, "same"), (None, "no id"),
         (7, "x" * 30_000), (8, "a " * 2046), (9, "a " * 2047), (10, "a " * 2048), *((20 + i, "a copy of one text") for i in range(400))]


def test_pieces_and_places(spark, plain):
    check(C.cost_balanced(docs_frame(spark, CASES, extra=True)).collect(), CASES, plain)
    check(C.cost_balanced(docs_frame(spark, CASES), group_tokens=500).collect(), CASES, plain)


def test_real_table(spark, plain):
    rows = real_docs(spark)
    got = C.cost_balanced(docs_frame(spark, rows).coalesce(1)).collect()
    places = check(got, rows, plain)
    tokens = sum(len(plain(t)) for _, t, _ in rows)
    assert len(places) <= tokens // 2048 + 12
    assert len(got) <= len(rows) + len(places) + tokens // 2048 + 12   # a cut at most for every sequence


def test_costs_are_balanced():
    rng = np.random.default_rng(3)
    lengths = np.minimum(rng.lognormal(5.5, 0.5, 20_000).astype(int) + 1, 2048).tolist()
    places, cost = C.balanced(lengths)
    size = C.sequence_lengths(sum(lengths))
    full = [c for c, s in zip(cost, size) if s == 2048]
    # the same documents whole, each into the fullest sequence with room
    bins, _, load = best_fit(np.array(lengths), 2048)
    other = np.bincount(bins, [C.LINEAR * n + n * n for n in lengths])[load > 2000]
    assert np.std(full) < 0.6 * np.std(other)
    assert sum(n for _, _, n, _, _ in places) == sum(lengths) == sum(size)


@pytest.mark.parametrize("lengths", [[], [1], [2048], [3, 5, 9], [2047] * 5, [1] * 5000])
def test_places_of_small_groups(lengths):
    places, cost = C.balanced(lengths)
    by_item, by_sequence = defaultdict(list), defaultdict(list)
    for item, start, n, b, offset in places:
        by_item[item].append((start, n))
        by_sequence[b].append((offset, n))
    for kind, want in ((by_item, dict(enumerate(lengths))), (by_sequence, dict(enumerate(C.sequence_lengths(sum(lengths)))))):
        for k, n in want.items():
            at = 0
            for start, part in sorted(kind[k]):
                assert start == at
                at += part
            assert at == n


def test_a_first_choice_is_the_cheapest_with_room():
    # 6 fills the first; 5, 4 open sequences; 3 goes to the cheaper of 5 and 4 with room for all of it
    places, _ = C.balanced([6, 5, 4, 3, 2, 1, 3], capacity=8, linear=1)
    assert [(i, b) for i, _, _, b, _ in places[:4]] == [(0, 0), (1, 1), (2, 2), (3, 2)]


def test_tokens_equal_the_tokenizers_library(plain):
    rng = random.Random(7)
    odd = [chr(c) for c in [*range(0x378), 0x3A3, 0x2028, 0x3000, 0x4E00, 0x1F600, 0x212B, 0x200D]] + ["<|endoftext|>", "'ll", "'S", "\n\n", "<|", "  "]
    texts = ["".join(rng.choices(odd, k=rng.randint(1, 50))) for _ in range(3000)]
    texts += [f"a{chr(c)}b 1{chr(c)} {chr(c)}" for c in [*range(0x400), *range(0x400, 0x30000, 41)] if not 0xD800 <= c < 0xE000] + ["Aé" * 30_000]
    enc = C.WordEncoder(C.TOKENIZER, store_bytes=200_000)
    got = [ids for k in range(0, len(texts), 100) for ids in enc.encode([t.encode() for t in texts[k:k + 100]])]
    assert all(np.frombuffer(g, "<u4").tolist() == plain(t)[:-1] for g, t in zip(got, texts))
    assert enc.size <= 300_000


def test_query_digests(spark, plain):
    path = "/root/testdata/sf0.001"
    ids = {i: plain(t) for i, t, _ in real_docs(spark)}
    for r in C.op12_cost_balanced_packing(spark, path).collect():
        whole = ids[r["doc_id"]]
        part = np.array(whole[r["start"]:r["start"] + r["length"]], "<u4")
        assert (r["doc_tokens"], r["ids_crc32"]) == (len(whole), zlib.crc32(part.tobytes()))


def test_empty_table(spark):
    assert C.cost_balanced(docs_frame(spark, [])).collect() == []

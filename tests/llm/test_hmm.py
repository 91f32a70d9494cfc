import itertools
import math
import zlib
from collections import Counter

import numpy as np

from churnlab.llm import hmm as H

from .helpers import docs_frame, real_docs


def toks(t):
    return [*(t or "").encode().lower().split(), None]


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1


def test_base_columns(spark):
    rows = [*real_docs(spark), (900, None), (901, ""), (902, " \n"), (903, "É é A a"), (904, "x " * 30_000), (904, "x y"), (None, "no id")]
    counts = Counter(w for i, t, *_ in rows if not held(i) for w in toks(t))
    n, v = sum(counts.values()), len(counts)
    got = H.language_model_scores(docs_frame(spark, rows, extra=True), rounds=1).collect()
    assert len(got) == len(rows)
    want = Counter()
    for i, t, *_ in rows:
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in toks(t))
        want[(i, held(i), len(toks(t)), sum(counts[w] > 0 for w in toks(t)), n, round(base, 3))] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 3)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def tiny(states=2, classes=3, seed=1):
    rng = np.random.default_rng(seed)
    norm = lambda x: x / x.sum(-1, keepdims=True)
    return H.Model(norm(rng.random(states)), norm(rng.random(states)), norm(rng.random((states, states))), norm(rng.random((states, classes))))


def paths(model, seq):
    """(probability, path) of every state path."""
    for p in itertools.product(range(len(model.start)), repeat=len(seq)):
        x = model.start[p[0]] * model.emit[p[0], seq[0]]
        for a, b, s in zip(p, p[1:], seq[1:]):
            x *= model.move[a, b] * model.emit[b, s]
        yield x, p


def test_forward_and_counts_equal_all_paths():
    model, seqs = tiny(), [[0, 1, 2, 1], [2], [1, 1, 0], [0, 2, 2, 1, 0]]
    lanes = H.Lanes(np.array([len(s) for s in seqs]))
    flat = lanes.spread(np.array(sum(seqs, [])))
    emit, move, start, total = H.expected_counts(model, lanes, flat, np.ones(len(seqs), bool))
    want_emit, want_move, want_start, want = np.zeros_like(emit), np.zeros_like(move), np.zeros_like(start), 0.0
    for s in seqs:
        z = sum(x for x, _ in paths(model, s))
        want += math.log(z)
        for x, p in paths(model, s):
            want_start[p[0]] += x / z
            for state, c in zip(p, s):
                want_emit[state, c] += x / z
            for a, b in zip(p, p[1:]):
                want_move[a, b] += x / z
    assert np.allclose(emit, want_emit) and np.allclose(move, want_move) and np.allclose(start, want_start) and abs(total - want) < 1e-9


def test_training_raises_the_likelihood_and_beats_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = H.language_model_scores(docs).filter("held_out").agg({"score": "sum", "base_score": "sum", "n_tokens": "sum"}).first()
    assert got["sum(score)"] > got["sum(base_score)"]


def test_likelihood_never_falls(spark):
    docs = docs_frame(spark, real_docs(spark))
    rows = docs.selectExpr("doc_id", "false AS h", "cast(text AS binary) AS text")
    blocks = rows.mapInArrow(H._encode(3), "block bigint, bucket int, body binary, counts binary").filter("bucket = -1").select("body").cache()
    _, history = H.train(blocks, np.ones(H.CLASSES), 4, 5)
    assert all(b > a - 1 for a, b in zip(history, history[1:])) and len(history) == 5


def test_class_model_is_a_distribution():
    model = tiny(3, 4)
    lanes = H.Lanes(np.full(4 ** 3, 3))
    seqs = np.array(list(itertools.product(range(4), repeat=3))).reshape(-1)
    scale, _, _ = H.forward(model, lanes, lanes.spread(seqs), np.broadcast_to(model.start, (64, 3)), False)
    assert abs(np.exp(np.log(scale).reshape(3, 64).sum(0)).sum() - 1) < 1e-12


def test_empty_table(spark):
    assert H.language_model_scores(docs_frame(spark, [])).collect() == []

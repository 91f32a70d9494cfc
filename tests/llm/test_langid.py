import zlib

import numpy as np

from churnlab.llm import langid as L

from .helpers import docs_frame

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in L.predict_languages(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert set(got) == set(truth)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for i, r in got.items())
    held = [i for i in got if got[i]["held_out"]]
    assert sum(got[i]["lang_pred"] == truth[i] for i in held) / len(held) > 0.97


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    net = L.new_net(["a", "b", "c"])
    for name in ("embed", "bias", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.filters = [f.astype(np.float64) for f in net.filters]
    x, y = rng.integers(60, 90, (5, L.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    _, grads = L.gradients(net, x, y)
    for p, g in zip(net.parameters(), grads):
        flat = p.reshape(-1)
        for k in rng.choice(np.flatnonzero(np.abs(g.reshape(-1)) > 1e-4), 3):
            old, d = flat[k], 1e-6
            flat[k] = old + d
            up = L.gradients(net, x, y)[0]
            flat[k] = old - d
            down = L.gradients(net, x, y)[0]
            flat[k] = old
            assert abs((up - down) / (2 * d) - g.reshape(-1)[k]) < 1e-4


def test_tables_equal_the_convolutions():
    rng = np.random.default_rng(2)
    net = L.new_net(["a", "b"])
    x = rng.integers(0, 256, (9, L.WINDOW)).astype(np.uint8)
    logs = L.Tables(net).log_probabilities(x)
    for y in (0, 1):
        assert abs(-logs[:, y].mean() - L.gradients(net, x, np.full(9, y))[0]) < 1e-4


def test_windows_cover_whole_texts():
    texts = [b"", b"a" * 128, b"b" * 129, b"c"]
    x, row, used = L.windows_of(texts)
    assert row.tolist() == [1, 2, 2, 3] and used.tolist() == [128, 128, 1, 1]
    assert b"".join(w[:n].tobytes() for w, n in zip(x, used)) == b"".join(texts)


def test_cases(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !?", "en"), (4, "the cat and the dog sat on the mat", "en"), (4, "the cat and the dog sat on the mat", "en"),
            (5, "der Hund und die Katze sind nicht da", "de"), (None, "the dog", None), (6, "the " * 60_000, "en"), (7, "日本語", None)]
    got = {}
    for r in L.predict_languages(docs_frame(spark, rows, extra=True)).collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"] > 0))
    assert got[1] == got[2] == got[3] == [("und", False)]
    assert len(got[4]) == 2 and got[4][0] == got[4][1] and got[7][0][0] in ("en", "de") and got[None][0][0] in ("en", "de")


def test_nothing_to_learn_and_empty(spark):
    assert [r["lang_pred"] for r in L.predict_languages(docs_frame(spark, [(1, "the", None)])).collect()] == ["und"]
    assert L.predict_languages(docs_frame(spark, [])).collect() == []

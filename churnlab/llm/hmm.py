"""A hidden Markov language model (operator 1).

Words fall into ``CLASSES`` classes by a hash of their last bytes (short words are told apart, long
ones share the class of their ending); the end of a text is a class of its own. The model is

    P(text) = sum over state paths of the product of P(class | state) P(state | state before)
              times the product of P(word | class)

P(word | class) is counted over all training words, add-0.5, with one unknown word per class, so
the model is a proper distribution over known words and one unknown word in each class. States are
trained by Baum-Welch: each round sums expected counts over all training text in Spark (rows by
class, combined before the shuffle), and the driver only sees the ``CLASSES x STATES`` table.
Training reads texts in segments of at most ``SEGMENT`` tokens; scoring runs the scaled forward
recursion over whole texts, so the likelihood is exact.

Counts of words grow with the corpus and never meet in one place: blocks of text send their
distinct words once to hash buckets, which add up and answer with the counts.

Defined results: a null or empty text is one end token; ids that repeat are scored row by row, a
null id counts as text ''; without any training text every word is unknown; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, saved, text_of

STATES, CLASSES, ROUNDS, SEGMENT = 8, 8192, 6, 1024
BLOCK_TOKENS, BATCH_TOKENS, BUCKET_BYTES = 2_000_000, 200_000, 24 << 20
ENDING = 4
END = 0  # class, and place in each block's word list, of the end token


def word_class(word: bytes) -> int:
    return 1 + zlib.crc32(word[-ENDING:]) % (CLASSES - 1)


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1


# ---------------------------------------------------------------- blocks of text

@dataclass
class Texts:
    """Encoded documents: ids, held-out flags, tokens per document, each token's place in the block's
    word list, and the class of each listed word."""
    ids: np.ndarray
    held: np.ndarray
    lengths: np.ndarray
    tokens: np.ndarray
    classes: np.ndarray

    def pack(self) -> bytes:
        head = np.array([len(self.ids), len(self.tokens), len(self.classes)], np.int64)
        return b"".join(a.tobytes() for a in (head, self.ids, self.lengths, self.tokens, self.classes, self.held))

    @staticmethod
    def unpack(blob: bytes) -> "Texts":
        n, t, v = np.frombuffer(blob, np.int64, 3)
        at, out = 24, []
        for kind, size in ((np.int64, n), (np.int64, n), (np.uint32, t), (np.uint16, v), (np.uint8, n)):
            out.append(np.frombuffer(blob, kind, size, at))
            at += out[-1].nbytes
        ids, lengths, tokens, classes, held = out
        return Texts(ids, held.astype(bool), lengths, tokens, classes)


def _encode(buckets: int):
    def encoded(rows: list[tuple[int, bool, list[bytes]]], block: int):
        """The block's texts, then its messages to the buckets."""
        places: dict[bytes, int] = {}
        lengths = np.array([len(r[2]) + 1 for r in rows], np.int64)
        flat = np.fromiter((places.setdefault(w, len(places)) for r in rows for w in r[2]), np.uint32, int(lengths.sum()) - len(rows))
        words = list(places)
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(words) + 1, np.uint32)
        rank[order] = np.arange(1, len(words) + 1)
        tokens = np.full(int(lengths.sum()), END, np.uint32)
        inner = np.ones(len(tokens), bool)
        inner[np.cumsum(lengths) - 1] = False
        tokens[inner] = rank[flat]
        held = np.array([r[1] for r in rows], bool)
        counts = np.bincount(tokens[np.repeat(~held, lengths)], minlength=len(words) + 1)
        classes = np.array([END, *[word_class(words[i]) for i in order.tolist()]], np.uint16)
        yield block, -1, Texts(np.array([r[0] for r in rows], np.int64), held.astype(np.uint8), lengths, tokens, classes).pack(), None
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for k in range(buckets):
            a, b = cut[k], cut[k + 1]
            if a < b:
                yield block, k, b" ".join(words[i] for i in order[a:b].tolist()), counts[a + 1:b + 1].astype(np.int64).tobytes()
        yield block, buckets, b"", counts[:1].astype(np.int64).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block, rows, size = TaskContext.get().partitionId() << 32, [], 0

        def flush():
            out = list(zip(*encoded(rows, block)))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                                              ["block", "bucket", "body", "counts"])

        for batch in batches:
            for key, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = text.as_buffer().to_pybytes().lower().split()
                rows.append((key, held, words))
                size += len(words)
                if size >= BLOCK_TOKENS or len(rows) >= 50_000:
                    yield flush()
                    block, rows, size = block + 1, [], 0
        if rows:
            yield flush()
    return run


def _count(buckets: int):
    def count(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        """Training counts of a bucket's words, for each block in its order, and sums by class."""
        end, total = key[0] == buckets, {}
        lists = [[b""] if end else body.split(b" ") for body in group["body"]]
        counts = [np.frombuffer(c, np.int64).tolist() for c in group["counts"]]
        for words, own in zip(lists, counts):
            for w, c in zip(words, own):
                total[w] = total.get(w, 0) + c
        tokens, kinds = {}, {}
        for w, c in total.items():
            k = END if end else word_class(w)
            tokens[k], kinds[k] = tokens.get(k, 0) + c, kinds.get(k, 0) + (c > 0)
        answers = [(b, int(key[0]), np.array([total[w] for w in words], np.int64).tobytes(), None, None, None) for b, words in zip(group["block"], lists)]
        sums = (None, int(key[0]), None, [int(k) for k in tokens], [int(v) for v in tokens.values()], [int(v) for v in kinds.values()])
        return pd.DataFrame([*answers, sums], columns=["block", "bucket", "counts", "classes", "tokens", "kinds"])
    return count


# ---------------------------------------------------------------- the model

@dataclass
class Model:
    start: np.ndarray    # state of the first token
    inner: np.ndarray    # state at a cut of a training segment
    move: np.ndarray     # state by state
    emit: np.ndarray     # state by class


def first_model(class_tokens: np.ndarray, states: int, seed: int = 7) -> Model:
    """Class frequencies, disturbed by a fixed seed, and states that like to stay."""
    rng = np.random.default_rng(seed)
    emit = (class_tokens + 0.5) * np.exp(rng.normal(0, 1.0, (states, len(class_tokens))))
    move = np.full((states, states), 0.05 / max(1, states - 1)) if states > 1 else np.ones((1, 1))
    np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
    even = np.full(states, 1 / states)
    return Model(even, even, move, emit / emit.sum(1, keepdims=True))


class Lanes:
    """Sequences side by side, longest first, stored step by step: step t has the first ``alive[t]``."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        sorted_ = lengths[self.order]
        self.alive = np.searchsorted(-sorted_, -np.arange(1, sorted_[0] + 1), "right")
        self.offset = np.append(0, np.cumsum(self.alive))
        rank = np.empty(len(lengths), np.int64)
        rank[self.order] = np.arange(len(lengths))
        self.step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.rank = np.repeat(rank, lengths)
        self.place = self.offset[self.step] + self.rank

    def spread(self, tokens: np.ndarray) -> np.ndarray:
        out = np.empty_like(tokens)
        out[self.place] = tokens
        return out


def forward(model: Model, lanes: Lanes, classes: np.ndarray, begin: np.ndarray, keep: bool):
    """Scaled forward recursion. ``begin``: distribution of the first state, per lane.

    Returns the scales (their logs sum to the log likelihood), and with ``keep`` the scaled
    state probabilities and the emission of every token.
    """
    table = np.ascontiguousarray(model.emit.T)
    scale = np.empty(len(classes))
    emitted = table[classes] if keep else None
    alphas = np.empty_like(emitted) if keep else None
    a = None
    for t, n in enumerate(lanes.alive.tolist()):
        at = slice(lanes.offset[t], lanes.offset[t] + n)
        e = emitted[at] if keep else table[classes[at]]
        a = (begin[:n] if a is None else a[:n] @ model.move) * e
        s = a.sum(1)
        a /= s[:, None]
        scale[at] = s
        if keep:
            alphas[at] = a
    return scale, alphas, emitted


def expected_counts(model: Model, lanes: Lanes, classes: np.ndarray, first: np.ndarray) -> tuple:
    """Baum-Welch counts of some sequences: emissions, moves, starts, log likelihood.

    ``first`` marks the lanes that begin a text (in lane order).
    """
    begin = np.where(first[:, None], model.start, model.inner)
    scale, alpha, emitted = forward(model, lanes, classes, begin, True)
    later = emitted / scale[:, None]  # becomes emission times backward value, scaled
    beta = np.ones_like(alpha)
    back = model.move.T
    for t in range(len(lanes.alive) - 2, -1, -1):
        n = lanes.alive[t + 1]
        after = slice(lanes.offset[t + 1], lanes.offset[t + 1] + n)
        beta[lanes.offset[t]:lanes.offset[t] + n] = later[after] @ back
        if t:
            own = slice(lanes.offset[t], lanes.offset[t] + lanes.alive[t])
            later[own] *= beta[own]
    gamma = alpha * beta
    states = model.move.shape[0]
    emit = np.stack([np.bincount(classes, gamma[:, z], model.emit.shape[1]) for z in range(states)])
    n0 = lanes.alive[0]
    before = np.arange(n0, len(classes)) - np.repeat(lanes.alive[:-1], lanes.alive[1:])
    moves = model.move * (alpha[before].T @ later[n0:])
    return emit, moves, gamma[:n0][first].sum(0), np.log(scale).sum()


def _segments(lengths: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the training segments of texts laid end to end, and which begin a text."""
    count = -(-lengths // longest)
    out = np.full(count.sum(), longest, np.int64)
    ends = np.cumsum(count) - 1
    out[ends] = lengths - (count - 1) * longest
    first = np.zeros(len(out), bool)
    first[ends - count + 1] = True
    return out, first


def _batches(lengths: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Sequences of like length together, some ``size`` tokens at a time."""
    order = np.argsort(-lengths, kind="stable")
    group = (np.cumsum(lengths[order]) - 1) // size
    for part in np.split(order, np.flatnonzero(np.diff(group)) + 1):
        if len(part):
            yield part


def _taken(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    return flat[at]


def _counts_by_class(model: Model):
    """Expected counts of a task's training texts: rows (key, e0 ..), one for each class, state and start."""
    states, classes = model.emit.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit, moves, starts, total = np.zeros((states, classes)), np.zeros((states, states)), np.zeros(states), 0.0
        for batch in batches:
            for blob in batch.column(0):
                texts = Texts.unpack(blob.as_buffer().to_pybytes())
                flat = texts.classes[texts.tokens][np.repeat(~texts.held, texts.lengths)]
                lengths, first = _segments(texts.lengths[~texts.held], SEGMENT)
                at = np.cumsum(lengths) - lengths
                for part in _batches(lengths, BATCH_TOKENS):
                    lanes = Lanes(lengths[part])
                    e, m, s, ll = expected_counts(model, lanes, lanes.spread(_taken(flat, at[part], lengths[part])), first[part][lanes.order])
                    emit, moves, starts, total = emit + e, moves + m, starts + s, total + ll
        used = np.flatnonzero(emit.sum(0))
        keys = np.concatenate([used, -1 - np.arange(states), [-100, -200]])
        rows = np.concatenate([emit[:, used].T, moves, starts[None], np.full((1, states), total)])
        yield pa.RecordBatch.from_arrays([pa.array(keys), *[pa.array(rows[:, z]) for z in range(states)]], ["key", *[f"e{z}" for z in range(states)]])
    return run


def train(blocks: DataFrame, class_tokens: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """Baum-Welch over the encoded blocks; also the log likelihood before each round's update."""
    model, history = first_model(class_tokens, states), []
    schema = "key bigint, " + ", ".join(f"e{z} double" for z in range(states))
    for _ in range(rounds):
        sums = blocks.mapInArrow(_counts_by_class(model), schema).groupBy("key").agg(*[F.sum(f"e{z}").alias(f"e{z}") for z in range(states)])
        emit, move, start = np.full((states, len(class_tokens)), 0.5), np.full((states, states), 0.1), np.full(states, 0.1)
        for r in sums.collect():  # one row per class and state
            key, row = r[0], np.array(r[1:])
            if key >= 0:
                emit[:, key] += row
            elif key == -100:
                start += row
            elif key == -200:
                history.append(float(row[0]))
            else:
                move[-1 - key] += row
        inner = emit.sum(1)
        model = Model(start / start.sum(), inner / inner.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))
    return model, history


# ---------------------------------------------------------------- scores

def _score(model: Model, class_tokens: np.ndarray, class_kinds: np.ndarray):
    n, v = class_tokens.sum(), class_kinds.sum()
    within = np.log10(class_tokens + 0.5 * (class_kinds + 1))
    whole = np.log10(n + 0.5 * (v + 1))

    def score(key: tuple, texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        if not len(texts):
            return pd.DataFrame([], columns=columns)
        t = Texts.unpack(texts["body"].iat[0])
        told = dict(zip(answers["bucket"], answers["counts"]))
        counts = np.concatenate([np.frombuffer(told[k], np.int64) for k in [max(told), *sorted(told)[:-1]]])  # the end first
        log_count = np.log10(counts + 0.5)
        doc = np.repeat(np.arange(len(t.ids)), t.lengths)
        add = lambda per_word: np.bincount(doc, per_word[t.tokens], len(t.ids))
        base, inside = add(log_count - whole), add(log_count - within[t.classes])
        flat, at, hidden = t.classes[t.tokens], np.cumsum(t.lengths) - t.lengths, np.zeros(len(t.ids))
        for part in _batches(t.lengths, BATCH_TOKENS):
            lanes = Lanes(t.lengths[part])
            seen = lanes.spread(_taken(flat, at[part], t.lengths[part]))
            scale, _, _ = forward(model, lanes, seen, np.broadcast_to(model.start, (len(part), len(model.start))), False)
            ranks = np.concatenate([np.arange(n) for n in lanes.alive])
            hidden[part[lanes.order]] = np.bincount(ranks, np.log10(scale), len(part))
        return pd.DataFrame({"_id": t.ids, "held_out": t.held, "n_tokens": t.lengths, "n_known": add((counts > 0).astype(float)).astype(np.int64),
                             "base_score": base, "score": inside + hidden}, columns=columns)
    return score


_NO_ID = -(1 << 63)


def language_model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    text = text_of(text_col)
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = total // BUCKET_BYTES + 8
    rows = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)).alias("_id"), held_out(id_col).alias("_held"), text.cast("binary").alias("_text"))
    sent = saved(rows.mapInArrow(_encode(buckets), "block bigint, bucket int, body binary, counts binary"), "encoded")
    told = saved(sent.filter("bucket >= 0").groupBy("bucket").applyInPandas(
        _count(buckets), "block bigint, bucket int, counts binary, classes array<int>, tokens array<bigint>, kinds array<bigint>"), "word-counts")
    class_tokens, class_kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    sums = told.filter("classes IS NOT NULL").select(F.explode(F.arrays_zip("classes", "tokens", "kinds")).alias("x")).groupBy("x.classes").agg(
        F.sum("x.tokens").alias("t"), F.sum("x.kinds").alias("k"))
    for k, t, v in sums.collect():  # one row per class
        class_tokens[k], class_kinds[k] = t, v
    blocks = sent.filter("bucket = -1")
    model, _ = train(blocks.select("body"), class_tokens, states, rounds)
    answers = told.filter("block IS NOT NULL").select("block", "bucket", "counts")
    out = blocks.select("block", "body").groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        _score(model, class_tokens, class_kinds),
        "_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return out.select(F.when(F.col("_id") != _NO_ID, F.col("_id")).alias(id_col), "held_out", "n_tokens", "n_known",
                      F.lit(int(class_tokens.sum())).cast("bigint").alias("train_tokens"), "base_score", "score")


def op1_hidden_markov(spark, sf_dir: str) -> DataFrame:
    return language_model_scores(documents(spark, sf_dir))

"""Language identification by a byte convolutional network (operator 8).

Bytes are embedded, convolved by filters of several widths, max-pooled over a fixed-length window
and classified by a softmax; all of it trained in numpy. The training set is a bounded sample:
at most about ``DOCS_PER_LANG`` labelled documents of each language (chosen by a hash of the id),
``WINDOWS_PER_DOC`` windows of each, read once by the driver. Every window of every whole text is
then classified where it lies; a document's language is the one with the largest mean log
probability over its windows, weighted by their bytes.

On the way to the windows no convolution is multiplied out: two neighbouring bytes index a table
of their share in every filter, so a width-4 filter costs two look-ups.

Defined results: ``und`` with score 0 where the text is null or has no letter, or nothing could be
learned; equal texts get equal answers; a null id counts as text ''; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, text_of

WINDOW, WIDTHS, FILTERS, EMBED = 128, (2, 3, 4), 8, 8
DOCS_PER_LANG, WINDOWS_PER_DOC, EPOCHS, BATCH, RATE = 800, 4, 6, 64, 0.01
UNKNOWN = "und"


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


@dataclass
class Net:
    langs: list[str]
    embed: np.ndarray             # byte, EMBED
    filters: list[np.ndarray]     # for each width: width * EMBED, FILTERS
    bias: np.ndarray              # all filters
    out: np.ndarray               # all filters, language
    out_bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, self.bias, self.out, self.out_bias]


def new_net(langs: list[str], seed: int = 5) -> Net:
    rng = np.random.default_rng(seed)
    normal = lambda *shape: (rng.normal(0, 1, shape) / np.sqrt(shape[0])).astype(np.float32)
    total = FILTERS * len(WIDTHS)
    return Net(langs, rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), [normal(w * EMBED, FILTERS) for w in WIDTHS],
               np.zeros(total, np.float32), normal(total, len(langs)), np.zeros(len(langs), np.float32))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def gradients(net: Net, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy of windows ``x`` (n, WINDOW bytes) with language numbers ``y``, and its gradients."""
    n, lines = len(x), np.arange(len(x))[:, None]
    e = net.embed[x]
    peaks, pooled = [], []
    for w, filt in zip(WIDTHS, net.filters):
        view = np.lib.stride_tricks.sliding_window_view(e, w, axis=1).transpose(0, 1, 3, 2).reshape(n, WINDOW - w + 1, w * EMBED)
        z = view @ filt
        peaks.append(z.argmax(1))
        pooled.append(z.max(1))
    z = np.concatenate(pooled, 1) + net.bias
    h = np.maximum(z, 0)
    p = _softmax(h @ net.out + net.out_bias)
    loss = -float(np.log(p[np.arange(n), y] + 1e-12).mean())
    d = p.copy()
    d[np.arange(n), y] -= 1
    d /= n
    d_out, d_out_bias, d_z = h.T @ d, d.sum(0), (d @ net.out.T) * (z > 0)
    d_embed, d_filters = np.zeros_like(net.embed), []
    for k, (w, filt, at) in enumerate(zip(WIDTHS, net.filters, peaks)):  # only the pooled places carry a gradient
        g = d_z[:, k * FILTERS:(k + 1) * FILTERS]
        seen = x[lines[:, :, None], at[:, :, None] + np.arange(w)]                       # n, filter, width
        d_filters.append(np.einsum("nfwe,nf->wef", net.embed[seen], g).reshape(w * EMBED, FILTERS))
        share = np.einsum("nf,wef->nfwe", g, filt.reshape(w, EMBED, FILTERS))
        np.add.at(d_embed, seen.reshape(-1), share.reshape(-1, EMBED))
    return loss, [d_embed, *d_filters, d_z.sum(0), d_out, d_out_bias]


def fit(windows: np.ndarray, labels: np.ndarray, langs: list[str], epochs: int = EPOCHS, seed: int = 5) -> Net:
    """Adam over the sampled windows, in a fixed order of its own seed."""
    net, rng = new_net(langs, seed), np.random.default_rng(seed)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    step, total = 0, epochs * -(-len(windows) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), BATCH):
            part, step = order[i:i + BATCH], step + 1
            rate = RATE * (1 - step / (total + 1))
            for p, g, (m, v) in zip(net.parameters(), gradients(net, windows[part], labels[part])[1], moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return net


class Tables:
    """The net with every pair of bytes looked up."""

    def __init__(self, net: Net):
        parts = [filt.reshape(w, EMBED, FILTERS) for w, filt in zip(WIDTHS, net.filters)]
        one = [[net.embed @ part[k] for k in range(len(part))] for part in parts]        # width, place: 256, FILTERS
        self.pairs = [[(a[k][:, None] + a[k + 1][None]).reshape(65536, FILTERS) for k in range(0, len(a) - 1, 2)] for a in one]
        self.single = [a[-1] if len(a) % 2 else None for a in one]
        self.net = net

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.net.langs)), np.float32)
        for i in range(0, len(x), 1024):
            part = x[i:i + 1024]
            pair = part[:, :-1].astype(np.int32) << 8 | part[:, 1:]
            pooled = []
            for w, pairs, single in zip(WIDTHS, self.pairs, self.single):
                n = WINDOW - w + 1
                z = pairs[0].take(pair[:, :n], 0)
                for k in range(1, len(pairs)):
                    z += pairs[k].take(pair[:, 2 * k:2 * k + n], 0)
                if single is not None:
                    z += single.take(part[:, w - 1:], 0)
                pooled.append(z.max(1))
            h = np.maximum(np.concatenate(pooled, 1) + self.net.bias, 0)
            out[i:i + 1024] = np.log(_softmax(h @ self.net.out + self.net.out_bias) + 1e-12)
        return out


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of some texts (the last one of a text is padded with zeros), their rows and bytes."""
    sizes = np.array([len(t) for t in texts], np.int64)
    count = -(-sizes // WINDOW)
    flat = np.frombuffer(b"".join(t + bytes(-len(t) % WINDOW) for t in texts), np.uint8).reshape(-1, WINDOW)
    row = np.repeat(np.arange(len(texts)), count)
    used = np.full(len(flat), WINDOW, np.int64)
    ends = np.cumsum(count) - 1
    some = sizes > 0
    used[ends[some]] = sizes[some] - (count[some] - 1) * WINDOW
    return flat, row, used


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, docs_per_lang: int = DOCS_PER_LANG):
    """The bounded training set: windows, language numbers, languages."""
    rows = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull() & text_of(text_col).rlike(r"\p{L}")).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), F.col(lang_col).alias("_lang"), text_of(text_col).cast("binary").alias("_text"))
    counts = {r[0]: r[1] for r in rows.groupBy("_lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64), langs
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, int(min(1.0, docs_per_lang / counts[k]) * (1 << 20)))])
    chosen = rows.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < F.element_at(share, F.col("_lang")))
    places = F.greatest(F.length("_text") - WINDOW, F.lit(0)) + 1
    cuts = F.transform(F.sequence(F.lit(1), F.lit(WINDOWS_PER_DOC)), lambda k: F.substring("_text", F.pmod(F.xxhash64("_id", k), places).cast("int") + 1, F.lit(WINDOW)))
    got = sorted((r["_lang"], bytes(c)) for r in chosen.select("_lang", cuts.alias("c")).collect() for c in r["c"])
    x = np.frombuffer(b"".join(c.ljust(WINDOW, b"\0") for _, c in got), np.uint8).reshape(-1, WINDOW)
    return x, np.array([langs.index(k) for k, _ in got], np.int64), langs


def identify(docs: DataFrame, net: Net | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, lang_pred, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(net) if net else None
        for batch in batches:
            texts = batch.column(2).to_pylist()
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for part in _parts(texts if net else []):
                x, row, used = windows_of([texts[i] or b"" for i in part])
                logs = tables.log_probabilities(x) * used[:, None]
                total = np.zeros((len(part), len(net.langs)))
                np.add.at(total, row, logs)
                mean = total / np.maximum(1, np.bincount(row, used, len(part)))[:, None]
                best, p = mean.argmax(1), _softmax(mean)
                for k, i in enumerate(part):
                    if texts[i] is not None:
                        lang[i], score[i] = net.langs[best[k]], p[k, best[k]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang), pa.array(np.clip(score, 0, 1))], ["_id", "_held", "lang_pred", "score"])

    text = F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col).cast("binary"))
    rows = docs.select(F.col(id_col).alias("_id"), held_out(id_col).alias("_held"), text.alias("_text"))
    out = rows.mapInArrow(run, rows.select("_id", "_held").schema.add("lang_pred", "string").add("score", "double"))
    return out.withColumnsRenamed({"_id": id_col, "_held": "held_out"})


def _parts(texts: list) -> Iterator[list[int]]:
    """Row numbers, some megabytes of text at a time."""
    part, size = [], 0
    for i, t in enumerate(texts):
        part.append(i)
        size += len(t or b"")
        if size > 4_000_000:
            yield part
            part, size = [], 0
    if part:
        yield part


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      docs_per_lang: int = DOCS_PER_LANG) -> DataFrame:
    x, y, langs = sample(docs, id_col, text_col, lang_col, docs_per_lang)
    return identify(docs, fit(x, y, langs) if langs else None, id_col, text_col)


def op8_byte_cnn(spark, sf_dir: str) -> DataFrame:
    return predict_languages(documents(spark, sf_dir))

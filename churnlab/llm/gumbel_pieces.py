"""Sampled segmentations into subword pieces, without replacement (operator 5).

A text's segmentations into pieces of a SentencePiece vocabulary form a lattice. A segmentation
has probability proportional to the product of its pieces' weights; the weight of the piece with
merge rank r is 1 / (r + RANK_SHIFT). Gumbel top-k gives every segmentation an independently
perturbed log probability and emits the k largest: k distinct samples, without replacement.

They are found by a perturbed A-star search. A search node is a set of segmentations that share a
prefix and don't take certain next pieces; its priority is the exact largest perturbed value in
it, a Gumbel variable at the set's log mass, truncated at the value of the set it was cut from.
Suffix masses of the lattice (log sums, right to left) are the heuristic, so nothing is expanded in
vain: the best set's winner is drawn by forward sampling, the rest of the set falls apart at each
step of that winner, and the best part is next. The (k+1)-th value is the threshold kappa of the
inclusion score 1 - exp(-exp(log p - kappa)).

No piece crosses from a non-space into a space, so the lattice of a text is a row of word
lattices; each distinct word's is built once per batch store, and all texts of a batch are sampled
together. Uniform numbers are hashes of (row key, sample, word, step): the result of a row depends
on its key and text alone, not on batches or machines.

Defined results: a null or empty text has one segmentation without pieces (log probability 0,
inclusion 1); a text with fewer than k segmentations emits all of them; equal ids with equal texts
get equal samples; a null id is a key of its own; an empty table gives an empty result; extra
columns are ignored. Characters without a piece, a space mark written in the text too, become byte pieces. ``decode``
inverts every sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, text_of

MODEL, SAMPLES, RANK_SHIFT, SEED = "piece_bpe_32k.model", 2, 10.0, 20240301
SPACE = "▁"
UNITS = re.compile(" *[^ ]+| +")
#: Bytes of the arrays that the store of word lattices may fill before it is emptied, and text bytes that are sampled at once.
STORE_BYTES, BATCH_BYTES = 160_000_000, 250_000
U = np.uint64
#: Log probabilities are added in this unit as integers, so a sum doesn't depend on what else is in a batch.
UNIT = 2.0 ** -30


@lru_cache(maxsize=2)
def vocabulary(file: str):
    """(piece or proper prefix -> id or -1, id -> log weight, byte -> id, id -> piece)."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(file))
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    known, weight, byte = {}, np.zeros(len(pieces)), np.zeros(256, np.int64)
    for i, piece in enumerate(pieces):
        weight[i] = -np.log(len(pieces) + RANK_SHIFT)
        if model.is_byte(i):
            byte[int(piece[1:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            weight[i] = -np.log(RANK_SHIFT - model.get_score(i))
            known[piece] = i
    for piece in list(known):
        if SPACE in piece.lstrip(SPACE) or SPACE * 2 in piece and piece.strip(SPACE):
            raise ValueError(f"piece {piece!r} crosses words")
        for n in range(1, len(piece)):
            known.setdefault(piece[:n], -1)
    return known, weight, byte, pieces


@lru_cache(maxsize=2)
def byte_trie(file: str) -> tuple[np.ndarray, np.ndarray]:
    """The pieces as a trie of UTF-8 bytes, space marks as plain spaces.

    (state * 256 + byte -> next state or 0, state -> piece id or -1). State 0 is the root; states
    without a row in the first array are leaves.
    """
    known = vocabulary(file)[0]
    children, piece_of = [{}], [-1]
    for piece, i in known.items():
        if i < 0:
            continue
        if " " in piece or "\0" in piece:
            raise ValueError(f"piece {piece!r} holds a separator")
        state = 0
        for b in piece.replace(SPACE, " ").encode():
            state = children[state].setdefault(b, len(children))
            if state == len(children):
                children.append({})
                piece_of.append(-1)
        piece_of[state] = i
    inner = [s for s, c in enumerate(children) if c]
    number = np.empty(len(children), np.int32)
    number[inner + [s for s, c in enumerate(children) if not c]] = np.arange(len(children))
    step = np.zeros((len(inner), 256), np.int32)
    for row, s in enumerate(inner):
        step[row, list(children[s])] = number[list(children[s].values())]
    pieces = np.empty(len(children), np.int32)
    pieces[number] = piece_of
    return step.ravel(), pieces


class Lattices:
    """The lattices of distinct words, one after another, as flat arrays.

    A node is a byte of a word, or its end; edges are sorted by their node and then by length, with
    the byte pieces of a character that has no piece last. ``running`` is the probability of a
    node's edges up to and with this one.
    """

    def __init__(self, file: str):
        self.weight, self.byte = vocabulary(file)[1:3]
        self.step, self.piece_of = byte_trie(file)
        self.clear()

    def clear(self):
        self.words: dict[str, int] = {}          # word -> its first node
        self.size = self.held = 0                # nodes; bytes of the arrays
        # first: node -> first edge; id_from: edge -> place of its first id
        for name, kind in (("first", np.int64), ("source", np.int64), ("target", np.int64), ("log_p", np.float64),
                           ("units", np.int64), ("running", np.float64), ("ids", np.int32), ("id_from", np.int64)):
            whole = getattr(self, name).base if hasattr(self, name) else np.zeros(1000, kind)   # buffers stay
            setattr(self, name, whole[:name in ("first", "id_from")])

    def matches(self, data: np.ndarray, at: np.ndarray, width: np.ndarray):
        """(source, target, id or -1, rank among the source's edges) of all edges, and edges a node.

        All places walk the trie together, a byte a round.
        """
        count, single = np.zeros(len(data), np.int64), np.zeros(len(data), bool)
        found, place, state, depth = [], at, np.zeros(len(at), np.int32), 0
        rows = len(self.step) >> 8
        while len(place):
            state = self.step[(state.astype(np.int64) << 8) + data[place + depth]]
            depth += 1
            piece = self.piece_of[state]
            hit = np.flatnonzero(piece >= 0)
            source = place[hit]
            found.append((source, source + depth, piece[hit], count[source]))
            count[source] += 1
            single[source[width[source] == depth]] = True
            more = (state > 0) & (state < rows)
            place, state = place[more], state[more]
        lone = at[~single[at]]
        found.append((lone, lone + width[lone], np.full(len(lone), -1, np.int32), count[lone]))
        count[lone] += 1
        return (*(np.concatenate(x) for x in zip(*found)), count)

    def add(self, words: list[str]):
        """Append the lattices of new words."""
        base = self.size
        data = np.frombuffer(("\0".join(words) + "\0").encode(), np.uint8)
        char = np.flatnonzero((data & 0xC0) != 0x80)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        begin = np.append(0, char[ends[:-1]] + 1)
        self.words.update(zip(words, (base + begin).tolist()))
        width = np.zeros(len(data), np.int64)
        width[char] = np.diff(np.append(char, len(data)))
        source, target, piece, rank, count = self.matches(data, np.delete(char, ends), width)
        first = np.cumsum(count) - count
        slot = np.empty(len(source), np.int64)
        slot[first[source] + rank] = np.arange(len(source))
        source, target, piece = source[slot], target[slot], piece[slot]
        sizes, lone = np.ones(len(piece), np.int64), np.flatnonzero(piece < 0)
        sizes[lone] = (target - source)[lone]
        log_w = self.weight[piece]
        log_w[lone] = self.weight[self.byte[0]] * sizes[lone]   # all byte pieces have one weight
        end, wide = np.cumsum(sizes), sizes[lone]
        flat = piece if len(piece) == end[-1] else np.repeat(piece, sizes)
        inside = np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
        flat[np.repeat((end - sizes)[lone], wide) + inside] = self.byte[data[np.repeat(source[lone], wide) + inside]]
        # suffix masses: places from the last to the first, all words together
        where = np.arange(len(data)) - np.repeat(begin, np.diff(np.append(begin, len(data))))
        mass = np.zeros(len(data))
        turn = where[source]
        turn = turn.max() - turn
        order = np.argsort(turn.astype(np.uint16) if turn.max() < 1 << 16 else turn, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(turn[order])) + 1):
            value, at = log_w[part] + mass[target[part]], source[part]
            cut = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            mass[at[cut]] = np.logaddexp.reduceat(value, cut)
        log_p = log_w + mass[target] - mass[source]
        running, node, n = np.exp(log_p), np.flatnonzero(count > 1), 1
        while len(node):
            running[first[node] + n] += running[first[node] + n - 1]
            n += 1
            node = node[count[node] > n]
        node = np.flatnonzero(count)
        running[first[node] + count[node] - 1] = 2.0
        self.append(first=len(self.target) + np.cumsum(count), source=source + base, target=target + base, log_p=log_p,
                    units=np.rint(log_p / UNIT).astype(np.int64), running=running, ids=flat, id_from=self.id_from[-1] + end)
        self.size = base + len(data)

    def append(self, **arrays: np.ndarray):
        """Add to the arrays, which are views of buffers that grow by half when full."""
        for name, more in arrays.items():
            old = getattr(self, name)
            n = len(old) + len(more)
            whole = old.base
            if whole is None or len(whole) < n:
                whole = np.empty(n + n // 2, old.dtype)
                whole[:len(old)] = old
            whole[len(old):n] = more
            setattr(self, name, whole[:n])
            self.held += len(more) * old.itemsize

    def draw(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge of each node at which the running probability reaches ``u``."""
        low, high = self.first[node], self.first[node + 1] - 1
        free = np.flatnonzero(low < high)
        while len(free):
            a, b = low[free], high[free]
            middle = (a + b) >> 1
            up = self.running[middle] < u[free]
            a, b = np.where(up, middle + 1, a), np.where(up, b, middle)
            low[free], high[free] = a, b
            free = free[a < b]
        return low

    def nodes(self, words: list[str]) -> np.ndarray:
        """First node of every word."""
        new = set(words).difference(self.words)
        if new:
            self.add(list(new))
        return np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))


def uniform(key: np.ndarray, sample: int, index: np.ndarray, step: int) -> np.ndarray:
    """Numbers in (0, 1) hashed from the row key, the sample, a word or edge number and a step."""
    x = key + index.astype(np.uint64) * U(0x9E3779B97F4A7C15) + U((sample * 0xD1B54A32D192ED03 + step * 0x8CB92BA72F3D8DD7) % (1 << 64))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return ((x ^ (x >> U(31))) >> U(11)).astype(np.float64) * 2.0 ** -53 + 2.0 ** -54


def drawn(lat: Lattices, node: np.ndarray, key: np.ndarray, index: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Forward sampling from each node to its word's end: (index, edge) of every step, in order."""
    found, order, at, step = [], [], np.arange(len(node)), 0
    alive = lat.first[node] < lat.first[node + 1]
    at, node = at[alive], node[alive]
    while len(at):
        edge = lat.draw(node, uniform(key[at], sample, index[at], step))
        found.append(edge)
        order.append(at)
        node = lat.target[edge]
        alive = lat.first[node] < lat.first[node + 1]
        at, node, step = at[alive], node[alive], step + 1
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    where, edge = np.concatenate(order), np.concatenate(found)
    by = np.argsort(where, kind="stable")
    return where[by], edge[by]


def _gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


class Search:
    """Perturbed A-star over the segmentations of one text: its winners so far and its open sets."""

    def __init__(self):
        self.sets, self.found = [], []

    def best(self):
        """The best open set, None if all segmentations are out."""
        self.sets = [s for s in self.sets if s[0][s[2]] > -np.inf]
        return max(self.sets, key=lambda s: s[0][s[2]], default=None)


def split(lat: Lattices, parts: list[tuple], turn: int) -> None:
    """For each part (search, key, edges, words, banned, fixed, value) a winner is drawn: keep it, and the
    parts of its set by the step where they leave it.

    The first ``fixed`` steps are shared by the whole set; at the next one ``banned`` edges are out.
    """
    sizes = np.array([len(p[2]) for p in parts], np.int64)
    start, edges = np.cumsum(sizes) - sizes, np.concatenate([p[2] for p in parts])
    log_p = lat.log_p[edges]
    total = np.cumsum(np.append(0, lat.units[edges]))
    at = np.flatnonzero(log_p < 0)          # the only edge of a node has 0
    own = np.repeat(np.arange(len(parts)), np.diff(np.searchsorted(at, np.append(start, len(edges)))))
    inside = at - start[own]
    on = inside >= np.array([p[5] for p in parts], np.int64)[own]
    at, own, inside = at[on], own[on], inside[on]
    left, node = 1.0 - np.exp(log_p[at]), lat.source[edges[at]]
    free = lat.first[node + 1] - lat.first[node] > 1
    for n, (_, _, _, _, banned, fixed, _) in enumerate(parts):
        if len(banned):
            k = int(np.searchsorted(at, start[n] + fixed))
            if k < len(at) and at[k] == start[n] + fixed:
                left[k] -= np.exp(lat.log_p[banned]).sum()
                # a node with one edge left has nothing beside it, whatever rounding says
                free[k] = lat.first[node[k] + 1] - lat.first[node[k]] > 1 + len(banned)
    at, own, inside, left = at[free], own[free], inside[free], left[free]
    before = (total[at] - total[start[own]]) * UNIT
    key = np.array([p[1] for p in parts], np.uint64)[own]
    g = before + np.log(np.maximum(left, 1e-300)) + _gumbel(uniform(key, turn, inside, 1 << 20))
    top = -np.logaddexp(-np.array([p[6] for p in parts])[own], -g)   # truncated at the winner's value
    cut = np.searchsorted(own, np.arange(len(parts) + 1)).tolist()
    for (search, _, own_edges, words, banned, shared, _), a, b in zip(parts, cut, cut[1:]):
        if a < b:
            search.sets.append([top[a:b], inside[a:b], int(top[a:b].argmax()), own_edges, words, banned, shared])


def _restart(lat: Lattices, s: list, key: np.uint64, turn: int) -> tuple[np.ndarray, int, int, int]:
    """Take the best part out of set ``s``: its prefix, the edge at which it leaves, the banned ones."""
    top, at, best, edges, words, banned, fixed = s
    step = int(at[best])
    top[best] = -np.inf
    s[2] = int(np.argmax(top))
    out = np.append(banned, edges[step]) if step == fixed else edges[step:step + 1]
    node = int(lat.source[edges[step]])
    options = np.setdiff1d(np.arange(lat.first[node], lat.first[node + 1]), out)
    p = np.exp(lat.log_p[options])
    pick = options[min(int(np.searchsorted(np.cumsum(p) / p.sum(), uniform(key, turn, np.zeros(1), 1 << 21)[0])), len(options) - 1)]
    return out, step, int(pick), int(words[step])


def sample_texts(lat: Lattices, keys: np.ndarray, texts: list[str], samples: int) -> list[list[tuple]]:
    """For each text its samples: (ids, log probability, perturbed value, inclusion)."""
    units = [UNITS.findall(" " + t) if t else [] for t in texts]
    if lat.held > STORE_BYTES:
        lat.clear()
    sizes = np.array([len(u) for u in units], np.int64)
    node = lat.nodes([w for u in units for w in u])
    start = np.cumsum(sizes) - sizes
    key_of, inside = np.repeat(keys, sizes), np.arange(len(node)) - np.repeat(start, sizes)
    where, edge = drawn(lat, node, key_of, inside, 1)
    cut = np.searchsorted(where, np.append(start, len(node)))
    values = _gumbel(uniform(keys, 0, np.zeros(len(texts)), 0))
    search, none = [Search() for _ in texts], np.empty(0, np.int64)
    parts = [(s, keys[k], edge[cut[k]:cut[k + 1]], where[cut[k]:cut[k + 1]] - start[k], none, 0, float(values[k])) for k, s in enumerate(search)]
    for s, _, edges, _, _, _, value in parts:
        s.found.append((edges, float(lat.log_p[edges].sum()), value))
    split(lat, parts, 1)
    for turn in range(2, samples + 1):
        redo = []
        for k, s in enumerate(search):
            best = s.best() if len(s.found) == turn - 1 else None
            if best is not None:
                value = float(best[0][best[2]])
                redo.append((k, best, value, *_restart(lat, best, keys[k], turn)))
        if not redo:
            break
        # the rest of the word that is left, then all words after it
        rests = [np.append(lat.target[pick], node[start[k] + word + 1:start[k] + sizes[k]]) for k, _, _, _, _, pick, word in redo]
        count = np.array([len(r) for r in rests])
        begin = np.cumsum(count) - count
        number = np.concatenate([np.arange(word, word + n) for n, (_, _, _, _, _, _, word) in zip(count, redo)])
        at, more = drawn(lat, np.concatenate(rests), np.repeat(keys[[r[0] for r in redo]], count), number, turn)
        bounds = np.searchsorted(at, np.append(begin, count.sum()))
        parts = []
        for n, (k, best, value, out, step, pick, word) in enumerate(redo):
            tail = slice(bounds[n], bounds[n + 1])
            edges = np.concatenate([best[3][:step], [pick], more[tail]])
            words = np.concatenate([best[4][:step], [word], number[at[tail]]])
            search[k].found.append((edges, float(lat.log_p[edges].sum()), value))
            parts.append((search[k], keys[k], edges, words, out, step, value))
        split(lat, parts, turn)
    results = []
    for s in search:
        best = s.best() if len(s.found) == samples else None
        kappa = float(best[0][best[2]]) if best is not None else -np.inf
        rows = []
        for edges, log_p, value in s.found:
            inclusion = float(-np.expm1(-np.exp(np.clip(log_p - kappa, -700, 50)))) if kappa > -np.inf else 1.0
            rows.append((_ids(lat, edges), min(log_p, 0.0), value, inclusion))
        results.append(rows)
    return results


def _ids(lat: Lattices, edges: np.ndarray) -> np.ndarray:
    a, n = lat.id_from[edges], lat.id_from[edges + 1] - lat.id_from[edges]
    if len(n) == n.sum():
        return lat.ids[a]
    return lat.ids[np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def sampled_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES, model: str = MODEL,
                   seed: int = SEED, into: str | None = None) -> DataFrame:
    """One row per document and sample: id, sample (from 1), ids (little-endian 32-bit), n_pieces,
    log_prob, perturbed, inclusion; with ``into``, a column of that name with the text decoded from
    the ids. Samples come by falling perturbed value."""
    schema = docs.select(F.col(id_col).alias("_id")).schema.add("sample", "integer").add("ids", "binary").add("n_pieces", "long")
    for name in ("log_prob", "perturbed", "inclusion"):
        schema = schema.add(name, "double")
    if into:
        schema = schema.add(into, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = Lattices(model)
        for batch in batches:
            ids, keys, texts = batch.column(0).to_pylist(), batch.column(1).to_numpy().view(np.uint64), batch.column(2)
            part, size = [], 0
            for i in range(len(ids)):
                part.append(i)
                size += len(texts[i].as_buffer())
                if size >= BATCH_BYTES or i + 1 == len(ids):
                    found = sample_texts(lat, keys[part], [texts[k].as_py() for k in part], samples)
                    rows = [(ids[k], n, x.astype("<i4").tobytes(), len(x), *rest) for k, f in zip(part, found) for n, (x, *rest) in enumerate(f, 1)]
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                    if into:
                        columns.append(decode_all([x for f in found for x, *_ in f], model))
                    part, size = [], 0
                    yield pa.RecordBatch.from_arrays(columns, names)

    names = schema.fieldNames()
    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [to_arrow_type(f.dataType) for f in schema]
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.lit(seed), F.col(id_col).cast("string")).alias("_key"), text_of(text_col).alias("_text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


@lru_cache(maxsize=2)
def piece_bytes(file: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that each piece stands for, end to end, and where each piece's begin."""
    _, _, byte, pieces = vocabulary(file)
    value = {int(i): bytes([b]) for b, i in enumerate(byte)}
    found = [value.get(i) or piece.replace(SPACE, " ").encode() for i, piece in enumerate(pieces)]
    return np.frombuffer(b"".join(found), np.uint8), np.append(0, np.cumsum([len(x) for x in found]))


def decode_all(found: list[np.ndarray], model: str = MODEL) -> pa.Array:
    """The texts of rows of piece ids: the bytes of all pieces in one gather, the first space of each row dropped."""
    data, at = piece_bytes(model)
    ids = np.concatenate([np.empty(0, np.int64), *found])
    sizes = at[ids + 1] - at[ids]
    ends = np.cumsum(sizes)
    text = data[np.repeat(at[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
    cut = np.append(0, ends)[np.cumsum([0, *map(len, found)])].tolist()
    return pa.array([text[a + 1:b] for a, b in zip(cut, cut[1:])], pa.binary()).cast(pa.string())


def decode(ids: np.ndarray, model: str = MODEL) -> str:
    """The text of some piece ids."""
    return decode_all([np.asarray(ids, np.int64)], model)[0].as_py()


def decoded(samples: DataFrame, ids_col: str = "ids", into: str = "text", model: str = MODEL) -> DataFrame:
    """``samples`` with the decoded text as one more column; null ids give a null text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 100):
                part = batch.slice(a, 100)
                ids = part.column(ids_col)
                texts = decode_all([np.frombuffer(b or b"", "<i4").astype(np.int64) for b in ids.to_pylist()], model)
                texts = pc.if_else(ids.is_valid(), texts, pa.scalar(None, pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*part.schema.names, into])

    return samples.mapInArrow(run, samples.select("*").schema.add(into, "string"))


def op5_gumbel_segmentations(spark, sf_dir: str) -> DataFrame:
    found = sampled_pieces(documents(spark, sf_dir), into="text")
    return found.select("doc_id", "sample", "n_pieces", F.crc32("ids").alias("ids_crc32"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
                        "log_prob", "perturbed", "inclusion")

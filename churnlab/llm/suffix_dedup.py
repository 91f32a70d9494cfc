"""Repeated passages by a hash-compared suffix sort (operator 10).

A document loses every byte covered by a ``WINDOW``-byte string that also starts in a document
with a smaller id. Sorting all suffixes of the corpus would move every byte many times, so only
windows that can have an equal elsewhere are sorted:

1. Anchors. The lowest hash of the Q-byte substrings of a window is its anchor; equal windows
   have equal anchors at equal offsets. Each block of documents sends its distinct anchor hashes to
   hash-range buckets, which answer with those that occur in two documents or more.
2. Records. For shared anchors a block of documents sends the bytes around the anchor, once per
   distinct content, with the smallest id that has it. (Anchors found in very many blocks send
   one record per window instead, so that the records of a common passage and its many different
   surroundings spread over all buckets.)
3. Suffix sort. A bucket sorts the window suffixes of each anchor and offset: prefix polynomial
   hashes, common extensions by binary search over lengths, mergesort on those comparisons.
   Neighbours with a common extension of a whole window form a class, verified byte by byte;
   the class's smallest id decides which windows are covered.
4. Blocks turn the answers into covered bytes. All three passes over the texts read one shuffle.

A task holds one block (about ``BLOCK`` bytes of text, or one document) or one bucket; a hot
passage counts once per block in its bucket.

Defined results: texts are UTF-8 bytes, a null text is empty; matches never cross documents;
windows are judged on the input; texts under 50 bytes stay; rows that repeat an id don't cover
each other; a null id is larger than all others; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, text_of

WINDOW, Q = 50, 16
SPAN = WINDOW - Q            # an anchor is at most so many bytes behind its window's start
WIDTH = SPAN + WINDOW        # bytes around an anchor that its windows can cover
CHUNK, BLOCK = 1 << 19, 2 << 20
ANCHORS_PER_BUCKET, SORTED_TEXT, SORTED_WINDOWS = 250_000, 4 << 20, 150_000
#: Blocks with the same anchor beyond which it is sent window by window.
COMMON = 1_000
_LAST = np.iinfo(np.int64).max
_PLACE = np.uint64((1 << 28) - 1)
U = np.uint64


@lru_cache(maxsize=4)
def _family(seed: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random byte values, powers of an odd base and of its inverse modulo 2**64."""
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 1 << 63, 256, dtype=np.uint64) << U(1) | U(1)
    base = int(rng.integers(1 << 62, 1 << 63)) * 2 + 1
    inverse = pow(base, -1, 1 << 64)
    powers, back = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    powers[0] = back[0] = 1
    return values, np.cumprod(powers), np.cumprod(back)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _prefix(data: np.ndarray) -> np.ndarray:
    values, powers, _ = _family(1, CHUNK + WINDOW)
    return np.concatenate([[U(0)], np.cumsum(values[data] * powers[:len(data)])])


def _hashes(prefix: np.ndarray, length: int) -> np.ndarray:
    """Hash of every substring of ``length`` bytes, from the prefix hashes."""
    n = len(prefix) - length
    return _mixed((prefix[length:] - prefix[:-length]) * _family(1, CHUNK + WINDOW)[2][:n])


class Chunk:
    """Some whole texts (or slices of a long one) and their anchors.

    A run is an anchor and the windows that chose it: place, first and last window start, hash.
    """

    def __init__(self, pieces: list[tuple[int, int, bytes]]):
        self.row, self.shift = np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces], np.int64)
        self.data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
        ends = np.cumsum([len(p[2]) for p in pieces])
        self.starts = ends - [len(p[2]) for p in pieces]
        n = len(self.data) - WINDOW + 1
        self.place = self.first = self.last = np.empty(0, np.int64)
        self.hash = np.empty(0, np.uint64)
        if n < 1:
            self.of = self.place
            return
        self.prefix = _prefix(self.data)
        grams = _hashes(self.prefix, Q)
        low, reach = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), 1
        while reach * 2 <= SPAN + 1:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        if rest := SPAN + 1 - reach:
            low = np.minimum(low[:-rest], low[rest:])
        valid = np.ones(n, bool)
        for start, end in zip(self.starts.tolist(), ends.tolist()):
            valid[max(start, end - WINDOW + 1):end] = False
        at = np.flatnonzero(valid)
        chosen = (low[at] & _PLACE).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = chosen[1:] != chosen[:-1]
        self.place, self.first = chosen[new], at[new]
        self.last = at[np.append(new[1:], True)] if len(at) else at
        # an anchor is the lowest of many hashes: mixed again, so that buckets by range are even
        self.hash = _mixed(grams[self.place] ^ U(0x9E3779B97F4A7C15)) & ~U(1)
        self.of = np.searchsorted(self.starts, self.place, "right") - 1


def _chunks(texts: list[bytes]) -> Iterator[Chunk]:
    """Texts in order, cut into chunks of about CHUNK bytes; a longer text in overlapping slices."""
    pieces, size = [], 0
    for row, text in enumerate(texts):
        for shift in range(0, max(1, len(text) - WINDOW + 1), CHUNK - WINDOW):
            piece = text[shift:shift + CHUNK - 1]
            if size + len(piece) >= CHUNK:
                yield Chunk(pieces)
                pieces, size = [], 0
            pieces.append((row, shift, piece))
            size += len(piece)
    if pieces:
        yield Chunk(pieces)


# ---------------------------------------------------------------- 1. anchors

def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def _anchor_messages(buckets: int):
    """A block's distinct anchors by bucket; the lowest bit marks those of several of its documents."""
    def send(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        found = [(c.row[c.of], c.hash) for c in _chunks(group["_text"].tolist())]
        row = np.concatenate([np.empty(0, np.int64), *[f[0] for f in found]])
        hashes = np.concatenate([np.empty(0, np.uint64), *[f[1] for f in found]])
        order = np.lexsort((row, hashes))
        row, hashes = row[order], hashes[order]
        if not len(hashes):
            return pd.DataFrame([], columns=["bucket", "block", "hashes"])
        same = hashes[1:] == hashes[:-1]
        start = np.flatnonzero(np.append(True, ~same))
        several = np.add.reduceat(np.append(False, same & (row[1:] != row[:-1])), start) > 0
        hashes = hashes[start] | several.astype(np.uint64)
        bucket = _bucket(hashes, buckets)
        cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        rows = [(int(bucket[a]), int(key[0]), hashes[a:b].tobytes()) for a, b in zip(cut, np.append(cut[1:], len(hashes)))]
        return pd.DataFrame(rows, columns=["bucket", "block", "hashes"])
    return send


def _shared_anchors(common: int):
    """For each block of a bucket, its anchors that two documents have; the lowest bit marks common ones."""
    return lambda key, group: _shared(group, common)


def _shared(group: pd.DataFrame, common: int) -> pd.DataFrame:
    sizes = group["hashes"].str.len().to_numpy() // 8
    hashes = np.frombuffer(b"".join(group["hashes"]), np.uint64)
    home = np.repeat(group["block"].to_numpy(), sizes)
    order = np.argsort(hashes, kind="stable")
    sorted_ = hashes[order] & ~U(1)
    start = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
    count = np.diff(np.append(start, len(sorted_)))
    several = np.maximum.reduceat(hashes[order] & U(1), start) > 0
    mark = np.where((count > 1) | several, 1 + (count > common), 0)
    marks = np.empty(len(hashes), np.int64)
    marks[order] = np.repeat(mark, count)
    hits = pd.DataFrame({"block": home, "hash": (hashes & ~U(1)) | (marks == 2).astype(np.uint64)})[marks > 0].drop_duplicates()
    return pd.DataFrame([(b, np.sort(h.to_numpy()).tobytes()) for b, h in hits.groupby("block")["hash"]], columns=["block", "hashes"])


# ---------------------------------------------------------------- 2. records

RECORD = np.dtype([("key", "<u8"), ("low", "u1"), ("high", "u1"), ("bytes", "u1", WIDTH)])


class Block:
    """The texts of one block in a fixed order, their shared runs and distinct records.

    ``records`` are distinct, sorted by key; ``ids`` has the smallest document id of each. A window
    range (``chunk, row, first, last``) points to its record by ``record``.
    """

    def __init__(self, group: pd.DataFrame, shared: pd.DataFrame):
        rows = sorted(zip(group["_id"].tolist(), group["_text"].tolist()))
        self.ids_of = np.array([r[0] for r in rows], np.int64)
        self.texts = [r[1] for r in rows]
        marked = np.sort(np.concatenate([np.empty(0, np.uint64), *[np.frombuffer(h, np.uint64) for h in shared["hashes"]]]))
        known, common = marked & ~U(1), (marked & U(1)).astype(bool)
        parts = [self._of_chunk(c, known, common) for c in _chunks(self.texts)] if len(known) else []
        records = np.concatenate([np.empty(0, RECORD), *[p[0] for p in parts]])
        self.row, self.first, self.last = (np.concatenate([np.empty(0, np.int64), *[p[k] for p in parts]]) for k in (1, 2, 3))
        flat = np.ascontiguousarray(records).view(np.dtype((np.void, RECORD.itemsize)))
        _, at, back = np.unique(flat, return_index=True, return_inverse=True)
        by_key = np.argsort(records["key"][at], kind="stable")
        self.records, place = records[at][by_key], np.empty(len(at), np.int64)
        place[by_key] = np.arange(len(at))
        self.record = place[back.reshape(-1)]
        run_ids = self.ids_of[self.row]
        self.ids = np.full(len(at), _LAST)
        np.minimum.at(self.ids, self.record, run_ids)
        self.run_ids = run_ids

    def _of_chunk(self, c: Chunk, known: np.ndarray, common: np.ndarray):
        at = np.minimum(np.searchsorted(known, c.hash), len(known) - 1)
        hit = known[at] == c.hash
        apart = np.zeros(len(hit), bool)
        apart[hit] = common[at[hit]]
        place, first, last, of, key = (x[hit & ~apart] for x in (c.place, c.first, c.last, c.of, c.hash))
        rec = np.zeros(len(place), RECORD)
        rec["key"], rec["low"], rec["high"] = key, first - (place - SPAN), last - (place - SPAN)
        spot = place[:, None] - SPAN + np.arange(WIDTH)
        seen = (spot >= first[:, None]) & (spot < last[:, None] + WINDOW)
        rec["bytes"] = np.where(seen, c.data[np.clip(spot, 0, len(c.data) - 1)], 0)
        if apart.any():  # common anchors: one record per window, its own hash as the key
            n = (c.last - c.first + 1)[apart]
            starts = np.repeat(c.first[apart] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
            one = np.zeros(len(starts), RECORD)
            one["key"] = _hashes(c.prefix, WINDOW)[starts]
            one["bytes"][:, :WINDOW] = c.data[starts[:, None] + np.arange(WINDOW)]
            rec, first, last = np.concatenate([rec, one]), np.append(first, starts), np.append(last, starts)
            of = np.append(of, np.repeat(c.of[apart], n))
        at_text = c.shift[of] - c.starts[of]
        return rec, c.row[of], first + at_text, last + at_text

    def cuts(self, buckets: int) -> list[tuple[int, int, int]]:
        """(bucket, from, to) over the records."""
        bucket = _bucket(self.records["key"], buckets)
        cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.empty(0, np.int64)
        return [(int(bucket[a]), int(a), int(b)) for a, b in zip(cut, np.append(cut[1:], len(bucket)))]


def _record_messages(buckets: int):
    def send(key: tuple, group: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        from zstandard import ZstdCompressor
        if not len(group) or not len(shared):
            return pd.DataFrame([], columns=["bucket", "block", "ids", "records"])
        block, packer = Block(group, shared), ZstdCompressor(level=1)
        rows = [(k, int(key[0]), block.ids[a:b].tobytes(), packer.compress(block.records[a:b].tobytes())) for k, a, b in block.cuts(buckets)]
        return pd.DataFrame(rows, columns=["bucket", "block", "ids", "records"])
    return send


# ---------------------------------------------------------------- 3. suffix sort

class Suffixes:
    """Suffixes (record, offset) of the records' bytes, compared by hashes over ``WINDOW`` bytes."""

    def __init__(self, content: np.ndarray, seed: int):
        values, powers, _ = _family(seed, WIDTH + 1)
        self.content = content
        prefix = np.zeros((len(content), WIDTH + 1), np.uint64)
        np.cumsum(values[content] * powers[:WIDTH], axis=1, out=prefix[:, 1:])
        self.prefix = prefix.reshape(-1)

    def at(self, record, offset) -> np.ndarray:
        """Places of suffixes in the prefix hashes."""
        return record.astype(np.int64) * (WIDTH + 1) + offset

    def apart(self, a, b) -> np.ndarray:
        """Difference of prefix hashes at two places: it stays the same over equal bytes (offsets are equal)."""
        return self.prefix.take(a) - self.prefix.take(b)

    def agree(self, a, b, offset, length) -> np.ndarray:
        """Whether the first ``length`` bytes of two suffixes have equal hashes."""
        a, b = self.at(a, offset), self.at(b, offset)
        return self.apart(a + length, b + length) == self.apart(a, b)

    def compare(self, a, b, offset) -> np.ndarray:
        """-1, 0 or 1: whole windows first, else the common extension by binary search, then one byte."""
        out = np.zeros(len(a), np.int8)
        x, y = self.at(a, offset), self.at(b, offset)
        begin = self.apart(x, y)
        todo = np.flatnonzero(self.apart(x + WINDOW, y + WINDOW) != begin)
        a, b, offset, x, y, begin = a[todo], b[todo], offset[todo], x[todo], y[todo], begin[todo]
        low, high = np.zeros(len(todo), np.int64), np.full(len(todo), WINDOW - 1)
        while (low < high).any():
            middle = (low + high + 1) >> 1
            ok = self.apart(x + middle, y + middle) == begin
            low, high = np.where(ok, middle, low), np.where(ok, high, middle - 1)
        x, y = self.content[a, offset + low], self.content[b, offset + low]
        out[todo] = np.where(x < y, -1, 1)
        return out

    def merge_sorted(self, record: np.ndarray, offset: np.ndarray, size: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Order that sorts each group. Groups lie together; ``size`` is the group's, ``index`` the place in it.

        Bottom-up mergesort of all groups at once: each suffix finds its rank in the sibling run.
        """
        order = np.arange(len(record))
        base, width, longest = order - index, 1, int(size.max(initial=0))
        while width < longest:
            moving = np.flatnonzero(size > width)
            i, start = index[moving], base[moving]
            mine = i // width
            other = mine ^ 1
            low = np.minimum(other * width, size[moving])
            high = np.minimum(low + width, size[moving])
            begin, right = low.copy(), other > mine
            me, off = record[order[moving]], offset[order[moving]]
            while len(act := np.flatnonzero(low < high)):
                middle = (low[act] + high[act]) >> 1
                sign = self.compare(record[order[start[act] + middle]], me[act], off[act])
                before = (sign < 0) | ((sign == 0) & ~right[act])  # equal ones of the left run come first
                low[act], high[act] = np.where(before, middle + 1, low[act]), np.where(before, high[act], middle)
            target = start + np.minimum(mine, other) * width + (i - mine * width) + (low - begin)
            moved = order.copy()
            moved[target] = order[moving]
            order, width = moved, width * 2
        return order


def covered_windows(records: np.ndarray, ids: np.ndarray, seed: int = 11) -> np.ndarray:
    """For each record a bit mask of the offsets whose window a smaller id has, too.

    ``records`` are sorted by key. Windows of one key and offset are a group.
    """
    masks = np.zeros(len(records), np.uint64)
    total = int((records["high"].astype(np.int64) - records["low"] + 1).sum())
    parts = min(-(-total // SORTED_WINDOWS), SPAN + 1)
    for part in range(parts):  # groups of different offsets don't meet
        masks |= _covered(records, ids, seed, part, parts)
    return masks


def _covered(records: np.ndarray, ids: np.ndarray, seed: int, part: int, parts: int) -> np.ndarray:
    masks = np.zeros(len(records), np.uint64)
    count = records["high"].astype(np.int64) - records["low"] + 1
    record = np.repeat(np.arange(len(records), dtype=np.int32), count)
    offset = (np.arange(len(record)) - np.repeat(np.cumsum(count) - count, count) + records["low"][record]).astype(np.int32)
    if parts > 1:
        record, offset = record[offset % parts == part], offset[offset % parts == part]
        if not len(record):
            return masks
    group = np.cumsum(np.append(0, records["key"][1:] != records["key"][:-1]))[record] * 64 + offset
    order = np.argsort(group, kind="stable")
    record, offset, group = record[order], offset[order], group[order]
    start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(start, len(group)))
    index, size = np.arange(len(group)) - np.repeat(start, size), np.repeat(size, size)
    met = size > 1  # a window alone has no equal
    record, offset, group, size, index = record[met], offset[met], group[met], size[met], index[met]
    if not len(record):
        return masks
    while True:
        suffixes = Suffixes(records["bytes"], seed)
        sorted_ = suffixes.merge_sorted(record, offset, size, index)
        r, o, g = record[sorted_], offset[sorted_], group[sorted_]
        same = (g[1:] == g[:-1]) & suffixes.agree(r[1:], r[:-1], o[1:], WINDOW)
        if _really_equal(records["bytes"], r, o, np.flatnonzero(same)):
            break
        seed += 1  # a hash collision: sort again with another hash
    first = np.flatnonzero(np.append(True, ~same))
    least = np.repeat(np.minimum.reduceat(ids[r], first), np.diff(np.append(first, len(r))))
    hit = least < ids[r]
    np.bitwise_or.at(masks, r[hit], U(1) << o[hit].astype(np.uint64))
    return masks


def _really_equal(content: np.ndarray, record, offset, at: np.ndarray) -> bool:
    span = np.arange(WINDOW)
    for part in np.array_split(at, len(at) // 50_000 + 1):
        o = offset[part][:, None] + span
        if (content[record[part][:, None], o] != content[record[part + 1][:, None], o]).any():
            return False
    return True


def _bucket_masks(records: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """:func:`covered_windows` over records in any order, some thousand at a time.

    Equal records of several blocks are sorted once, under their smallest id; for larger ids all
    their windows are covered.
    """
    flat = records.view(np.dtype((np.void, RECORD.itemsize)))
    _, at, back = np.unique(flat, return_index=True, return_inverse=True)
    back = back.reshape(-1)
    least = np.full(len(at), _LAST)
    np.minimum.at(least, back, ids)
    distinct = records[at]
    order = np.argsort(distinct["key"], kind="stable")
    found, keys = np.empty(len(at), np.uint64), distinct["key"][order]
    begin = 0
    while begin < len(order):  # whole keys
        end = int(np.searchsorted(keys, keys[min(begin + 4_000, len(order) - 1)], "right"))
        part = order[begin:end]
        found[part] = covered_windows(distinct[part], least[part])
        begin = end
    low, count = records["low"].astype(np.uint64), records["high"].astype(np.uint64) - records["low"] + U(1)
    return np.where(ids > least[back], ((U(1) << count) - U(1)) << low, found[back])


def _sort_bucket(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    from zstandard import ZstdDecompressor
    unpacker = ZstdDecompressor()
    parts = [np.frombuffer(unpacker.decompress(r), RECORD) for r in group["records"]]
    records = np.concatenate(parts)
    ids = np.concatenate([np.frombuffer(x, np.int64) for x in group["ids"]])
    masks = _bucket_masks(records, ids)
    ends = np.cumsum([len(p) for p in parts])
    return pd.DataFrame({"block": group["block"], "bucket": int(key[0]),
                         "masks": [masks[e - len(p):e].tobytes() for e, p in zip(ends, parts)]})


# ---------------------------------------------------------------- 4. texts

def _kept_bytes(block: Block, masks: np.ndarray) -> Iterator[tuple[bytes, int]]:
    """Of each text the bytes that stay and the number of removed runs."""
    mask = masks[block.record]
    low = block.records["low"][block.record].astype(np.int64)
    whole = block.run_ids > block.ids[block.record]  # a smaller id of this block has the whole record
    start, length = block.first, block.last - block.first + 1
    at = np.repeat(start - np.append(0, np.cumsum(length)[:-1]), length) + np.arange(length.sum()) if len(start) else start
    run = np.repeat(np.arange(len(start)), length)
    bit = (at - start[run] + low[run]).astype(np.uint64)
    hit = whole[run] | ((mask[run] >> bit) & U(1)).astype(bool)
    at, row = at[hit], block.row[run[hit]]
    order = np.argsort(row, kind="stable")
    at, row = at[order], row[order]
    bounds = np.searchsorted(row, np.arange(len(block.texts) + 1))
    for k, text in enumerate(block.texts):
        own = at[bounds[k]:bounds[k + 1]]
        if not len(own):
            yield text, 0
            continue
        change = np.zeros(len(text) + 1, np.int64)
        np.add.at(change, own, 1)
        np.add.at(change, own + WINDOW, -1)
        gone = np.cumsum(change)[:-1] > 0
        yield np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())


def _apply(buckets: int):
    def finish(key: tuple, group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["_id", "n_bytes", "n_spans", "kept"]
        if not len(group):
            return pd.DataFrame([], columns=columns)
        shared = answers[answers["hashes"].notna()]
        block = Block(group, shared)
        masks = np.zeros(len(block.records), np.uint64)
        told = {k: m for k, m in zip(answers["bucket"], answers["masks"]) if m is not None}
        for k, a, b in block.cuts(buckets):
            masks[a:b] = np.frombuffer(told[k], np.uint64)
        rows = [(i, len(t), spans, kept) for i, t, (kept, spans) in zip(block.ids_of, block.texts, _kept_bytes(block, masks))]
        return pd.DataFrame(rows, columns=columns)
    return finish


def drop_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", common: int = COMMON) -> DataFrame:
    """One row per document: id, n_bytes, n_spans, kept (the remaining bytes)."""
    spark = docs.sparkSession
    text = text_of(text_col).cast("binary")
    total = docs.agg(F.sum(F.octet_length(text_of(text_col)))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = math.ceil(total / BLOCK) + 1
    buckets = max(math.ceil(total / 18 / ANCHORS_PER_BUCKET), min(blocks, least))
    sorters = max(math.ceil(total / SORTED_TEXT), min(blocks, least))
    rows = docs.select(F.pmod(F.xxhash64(F.col(id_col)), F.lit(blocks)).alias("block"),
                       F.coalesce(F.col(id_col).cast("bigint"), F.lit(int(_LAST))).alias("_id"), text.alias("_text"))
    sent = rows.groupBy("block").applyInPandas(_anchor_messages(buckets), "bucket bigint, block bigint, hashes binary")
    shared = sent.groupBy("bucket").applyInPandas(_shared_anchors(common), "block bigint, hashes binary")
    messages = rows.groupBy("block").cogroup(shared.groupBy("block")).applyInPandas(
        _record_messages(sorters), "bucket bigint, block bigint, ids binary, records binary")
    masks = messages.groupBy("bucket").applyInPandas(_sort_bucket, "block bigint, bucket bigint, masks binary")
    answers = masks.withColumn("hashes", F.lit(None).cast("binary")).unionByName(
        shared.select("block", F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("masks"), "hashes"))
    out = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        _apply(sorters), "_id bigint, n_bytes bigint, n_spans bigint, kept binary")
    return out.select(F.when(F.col("_id") != F.lit(int(_LAST)), F.col("_id")).alias(id_col), "n_bytes", "n_spans", "kept")


def op10_suffix_sort(spark, sf_dir: str) -> DataFrame:
    found = drop_repeated_passages(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("bigint").alias("n_removed"), "n_spans",
                        F.sha2("kept", 256).alias("kept_sha256"))

"""Best-fit packing (operator 6): bound-certified repacking of token pieces into sequences.

1. Documents become token ids (byte-level BPE, then an end id) and pieces of at most
   ``capacity`` tokens; of a longer document only the first piece may be shorter.
2. Full pieces are sequences of their own. The others are dealt into many partitions by a hash,
   and each partition packs its pieces best fit decreasing.
3. Dual-feasible functions of the length counts give lower bounds. A partition whose bin count
   equals its bound is certified. While the whole is above the bound of all pieces, partitions
   with gaps give up their bins that aren't full; the documents in them are exchanged (dealt anew
   into fewer, larger partitions, at most ``MAX_ITEMS`` pieces each) and packed again. A round
   that doesn't save a bin is dropped and ends the work.

No task sees more than ``MAX_ITEMS`` pieces or so, and the driver only sees counts by length and
by partition round, so nothing grows with the input but the number of partitions.

The ids are those of the ``tokenizers`` library for ``byte_bpe_50k.json`` without added special
tokens; they are made with the same vocabulary's ``tiktoken`` file, five times faster. Equal on
every code point and on random and very long texts (tests).

Defined results: a null text is empty, one piece holding the end id; a repeated row is packed as
often as it occurs; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, saved, text_of

CAPACITY, END_ID = 1024, 2
ITEMS, MAX_ITEMS, ROUNDS = 2_000, 64_000, 6
TOKENIZER = "byte_bpe_50k.tiktoken"


@lru_cache(maxsize=2)
def encoder(file: str):
    """Byte-level BPE from a ranks file; loaded once per worker."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(file), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={"<|endoftext|>": len(ranks)})


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 end_id: int = END_ID, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece: id, piece, start, length, ids (little-endian unsigned 32-bit)."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(enc.encode_to_numpy(text.as_py(), allowed_special="all"), np.uint32(end_id)).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                rows += [(key, k, a, b - a, ids[a:b].tobytes()) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), KINDS)] if rows else [pa.array([], t) for t in KINDS], NAMES)

    NAMES = ["_id", "piece", "start", "length", "ids"]
    KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), text_of(text_col).alias("_text"))
    return rows.mapInArrow(encode, "_id bigint, piece int, start bigint, length bigint, ids binary").withColumnRenamed("_id", id_col)


def lower_bound(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that any packing of ``counts[length]`` pieces needs, by dual-feasible functions."""
    size = np.arange(len(counts), dtype=np.int64)
    counts = counts.astype(np.int64)
    best = -(-int(counts @ size) // capacity)
    half = capacity // 2
    many, total = np.cumsum(counts[::-1])[::-1], np.concatenate([[0], np.cumsum(counts * size)])
    for a in range(1, half + 1):  # f: large pieces fill a bin, pieces under a count as nothing
        big = int(many[capacity - a + 1]) if capacity - a + 1 < len(counts) else 0
        middle_n = int(many[half + 1]) - big if half + 1 < len(counts) else 0
        top = min(capacity - a + 1, len(counts))
        middle = int(total[top] - total[half + 1]) if top > half + 1 else 0
        small = int(total[half + 1] - total[a])
        best = max(best, big + middle_n + max(0, -(-(small - (middle_n * capacity - middle)) // capacity)))
    for k in range(2, 21):  # u^k: lengths rounded to multiples of capacity / k unless they are one of 1/(k+1)
        exact = size * (k + 1) % capacity == 0
        worth = np.where(exact, size * k, size * (k + 1) // capacity * capacity)  # in units of capacity * k
        best = max(best, -(-int(counts @ worth) // (capacity * k)))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and each bin's load; longest first, into the fullest bin that fits."""
    bin_of, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by room left
    rooms, load = 0, []  # rooms: bit r set where a bin has r left
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(load)
            load.append(0)
        bin_of[i], offset[i] = b, capacity - room
        load[b] += n
        if room > n:
            free[room - n].append(b)
            rooms |= 1 << (room - n)
    return bin_of, offset, np.array(load, np.int64)


def _packed(items: DataFrame, parts: int, turn: int, capacity: int) -> DataFrame:
    """Deal items into ``parts`` groups by a hash and pack each; also each bin's load and
    whether its group is certified."""
    columns = [c for c in items.columns if not c.startswith("_")]
    schema = items.select(*columns).schema.add("sequence_id", "long").add("offset", "long").add("_load", "long").add("_certified", "boolean")

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        lengths = group["length"].to_numpy()
        bins, offset, load = best_fit(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        return group[columns].assign(sequence_id=(turn << 56) + (int(key[0]) << 24) + bins, offset=offset,
                                     _load=load[bins], _certified=len(load) == bound)

    part = F.pmod(F.xxhash64(F.lit(turn), *columns), F.lit(parts))
    return items.select(*columns).withColumn("_part", part).groupBy("_part").applyInPandas(pack, schema)


def _by_length(items: DataFrame, capacity: int) -> np.ndarray:
    counts = np.zeros(capacity + 1, np.int64)
    for r in items.groupBy("length").count().collect():  # at most one row per length
        counts[r["length"]] = r["count"]
    return counts


def pack(pieces: DataFrame, capacity: int = CAPACITY, items: int = ITEMS, max_items: int = MAX_ITEMS,
         rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` (any columns, one of them ``length``; read more than once) with sequence_id and offset."""
    full = pieces.filter(F.col("length") >= capacity)
    full = full.select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rest = pieces.filter(F.col("length") < capacity)
    counts = _by_length(rest, capacity)
    if not counts.sum():
        return full
    bound = lower_bound(counts, capacity)
    bins = lambda df: df.filter("offset = 0").count()
    state = saved(_packed(rest, -(-int(counts.sum()) // items), 1, capacity), "packed")
    settled, total = [], bins(state)
    for turn in range(2, rounds + 1):
        if total <= bound:
            break
        # a gap: room left in a bin; a certified group gives only bins that are mostly empty
        gap = (F.col("_load") < capacity) & (~F.col("_certified") | (F.col("_load") < capacity * 0.9))
        exchanged, stays = state.filter(gap), state.filter(~gap)
        n, before = exchanged.count(), bins(exchanged)
        if before < 2:
            break
        parts = -(-n // min(max_items, items * 4 ** (turn - 1)))
        again = saved(_packed(exchanged.drop("sequence_id", "offset"), parts, turn, capacity), "packed")
        after = bins(again)
        if after >= before:
            break
        settled.append(stays)
        state, total = again, total - before + after
    for df in settled:
        state = state.unionByName(df)
    return state.drop("_load", "_certified").unionByName(full)


def packed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Tokenize and pack: one row per piece with the digest of its ids in place of the ids."""
    pieces = token_pieces(docs, id_col, text_col, capacity)
    slim = saved(pieces.select(id_col, "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(slim, capacity)


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return packed_documents(documents(spark, sf_dir))

"""Cost-balanced packing (operator 12): documents into full sequences of about equal attention cost.

A document's cost is estimated as ``LINEAR * n + n * n``: the part of a layer that is linear in its
``n`` tokens and the attention of the tokens to each other (which ends at the document's edges).

1. Documents become token ids and an end id. Of a longer document, whole pieces of ``capacity``
   tokens are sequences of their own; what is left of it is treated like a short document.
2. A task gathers documents up to ``group_tokens`` tokens and opens the sequences that they fill
   to the last place: ``T // capacity`` of full length and, for the rest, one for each power of two
   in it. None of them has any padding.
3. Descending by cost, each document goes to the lowest-cost sequence with room for all of it. Where
   no sequence has that much room, the lowest-cost one with any room takes as much as it can, and
   the remainder goes back in line by its own cost.

It is one map over the table: nothing is shuffled, a task holds one group at a time whatever the
size of its input, equal rows need no common place, and a lost task is run again by itself with the
same result. Sequence ids hold the number of the input partition.

The ids are those of the ``tokenizers`` library for ``word_bpe_49k.json`` without added special
tokens. Its matches never hold white space, so ids are made once for each string between ASCII white
space and kept in a store of bounded size (tests compare with whole texts).

Defined results: a null text is empty, one piece holding the end id; a null id stays null; a
repeated row is packed as often as it occurs; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, text_of

CAPACITY, END_ID = 2048, 1
#: Linear against quadratic cost: 6 * width of the model, here 1,024.
LINEAR = 6144
GROUP_TOKENS = 4_000_000
TOKENIZER = "word_bpe_49k.json"
#: Bytes that the store of encoded strings may take, and the longest string that it keeps.
STORE_BYTES, STORE_WORD = 48_000_000, 64
TEXT_BYTES = 1_000_000
ENTRY_BYTES = 170  # of Python's own for an entry


class WordEncoder:
    """Ids of whole texts by way of the strings between ASCII white space.

    Strings of Latin letters, marks, digits and signs below U+0370 are split by the tokenizer's own pattern and
    merged by ``tiktoken``, with a space as the mark of a word's end (no word holds one), several times faster;
    all others, and those with special tokens, are encoded by ``tokenizers``.
    """

    OTHER = re.compile("[\x1c-\x1f\x85\xa0\u0370-\U0010ffff]|<[|]")

    def __init__(self, file: str, store_bytes: int = STORE_BYTES):
        import public_tokenizers
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
        with open(public_tokenizers.path(file)) as f:
            parts = json.load(f)
        self.words = regex.compile(parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] + r"|\s")
        special = {t["content"] for t in parts["added_tokens"]}
        byte_of = {c: b for b, c in byte_letters().items()}
        mark = parts["model"]["end_of_word_suffix"]
        ranks = {}
        for token, rank in parts["model"]["vocab"].items():
            if token not in special:
                end = token.endswith(mark)
                ranks[bytes(byte_of[c] for c in (token[:-len(mark)] if end else token)) + b" " * end] = rank
        self.line = ranks[b"\n"]
        self.merged = tiktoken.Encoding("words", pat_str=r"[^ \n]+ |\n", mergeable_ranks=ranks, special_tokens={})
        self.store: dict[bytes, bytes] = {}
        self.size, self.store_bytes = 0, store_bytes

    def _encoded(self, words: list[bytes]) -> dict[bytes, bytes]:
        found, plain, other = {}, [], []
        for w in words:
            text = w.decode()
            (other if self.OTHER.search(text) else plain).append((w, text))
        for (w, _), e in zip(other, self.tokenizer.encode_batch([t for _, t in other], add_special_tokens=False)):
            found[w] = np.array(e.ids, "<u4").tobytes()
        if plain:
            text = unicodedata.normalize("NFC", "\n".join([t for _, t in plain])).lower()
            marked = " ".join(self.words.findall(text)).replace(" \n ", " \n") + " \n"
            ids = self.merged.encode_to_numpy(marked, disallowed_special=()).astype("<u4")
            ends = np.flatnonzero(ids == self.line)
            ids, cuts = ids.tobytes(), (4 * ends).tolist()
            found.update((w, ids[a:b]) for (w, _), a, b in zip(plain, [0, *(c + 4 for c in cuts)], cuts))
        return found

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers, one string of bytes a text."""
        words = [t.split() for t in texts]  # bytes are split at [\x20\x09-\x0D]
        new = set().union(*words).difference(self.store) if words else set()
        once = self._encoded(list(new)) if new else {}
        self.store.update(once)
        ids = [b"".join(map(self.store.__getitem__, w)) for w in words]
        for w, e in once.items():
            if len(w) > STORE_WORD:
                del self.store[w]
            else:
                self.size += len(w) + len(e) + ENTRY_BYTES
        if self.size > self.store_bytes:
            self.store, self.size = {}, 0
        return ids


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in the vocabulary file: printable Latin-1 ones for themselves, others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(file: str) -> WordEncoder:
    return WordEncoder(file)


def sequence_lengths(total: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths that hold ``total`` tokens without padding: full ones, then powers of two."""
    rest = total % capacity
    return [capacity] * (total // capacity) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def balanced(lengths: list[int], capacity: int = CAPACITY, linear: int = LINEAR) -> tuple[list[tuple], list[int]]:
    """Places (item, start in the item, length, sequence, offset) and each sequence's cost.

    ``lengths`` are at most ``capacity``. Equal costs are taken by smaller number.
    """
    size = sequence_lengths(sum(lengths), capacity)
    room, cost, places = list(size), [0] * len(size), []
    line: list[list] = [[] for _ in range(capacity + 1)]  # by length, so by cost
    for i, n in enumerate(lengths):
        line[n].append((i, 0))
    fits = [(0, b) for b in range(len(size))]  # sequences with room for the length at hand, and some without
    left = list(fits)                          # sequences with any room
    aside: list[list[int]] = [[] for _ in range(capacity + 1)]  # without room for it, by room

    def put(item: int, start: int, n: int, b: int) -> None:
        places.append((item, start, n, b, size[b] - room[b]))
        room[b] -= n
        cost[b] += linear * n + n * n
        if room[b]:
            heapq.heappush(left, (cost[b], b))

    for n in range(capacity, 0, -1):
        for b in aside[n]:
            if room[b] == n:
                heapq.heappush(fits, (cost[b], b))
        for item, start in line[n]:
            while fits and (fits[0][0] != cost[fits[0][1]] or room[fits[0][1]] < n):
                c, b = heapq.heappop(fits)
                if c == cost[b] and room[b]:
                    aside[room[b]].append(b)
            if fits:
                b = heapq.heappop(fits)[1]
                put(item, start, n, b)
                if room[b] >= n:
                    heapq.heappush(fits, (cost[b], b))
                else:
                    aside[room[b]].append(b)
                continue
            while left[0][0] != cost[left[0][1]] or not room[left[0][1]]:
                heapq.heappop(left)
            b = heapq.heappop(left)[1]
            part = room[b]
            put(item, start, part, b)
            line[n - part].append((item, start + part))
    return places, cost


def cost_balanced(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
                  tokenizer: str = TOKENIZER, linear: int = LINEAR, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset and the sequence's cost."""
    end = np.array([end_id], "<u4").tobytes()
    names = ["_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_cost"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def table(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(rows), 2000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a:a + 2000]), kinds)], names)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        enc, keys, held, size = encoder(tokenizer), [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys.append(key)
                held.append(text.as_buffer().to_pybytes())
                size += len(held[-1])
                if size >= TEXT_BYTES:
                    yield from zip(keys, enc.encode(held))
                    keys, held, size = [], [], 0
        yield from zip(keys, enc.encode(held))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40  # of the next sequence
        full, group, tokens = [], [], 0  # whole pieces; rests (id, start, ids, doc_tokens) and their tokens

        def grouped() -> list[tuple]:
            places, cost = balanced([len(g[2]) // 4 for g in group], capacity, linear)
            return [(group[i][0], group[i][1] + a, n, group[i][2][4 * a:4 * (a + n)], group[i][3], number + b, offset, cost[b])
                    for i, a, n, b, offset in places]

        for key, ids in texts(batches):
            ids += end
            n = len(ids) // 4
            whole = n // capacity * capacity
            for a in range(0, whole, capacity):
                full.append((key, a, capacity, ids[4 * a:4 * (a + capacity)], n, number, 0, linear * capacity + capacity * capacity))
                number += 1
                if len(full) >= 2000:
                    yield from table(full)
                    full = []
            if n > whole:
                group.append((key, whole, ids[4 * whole:], n))
                tokens += n - whole
            if tokens >= group_tokens:
                rows = grouped()
                number = max(r[5] for r in rows) + 1
                yield from table(rows)
                group, tokens = [], 0
        yield from table(full)
        if group:
            yield from table(grouped())

    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), text_of(text_col).alias("_text"))
    schema = "_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, sequence_cost bigint"
    return rows.mapInArrow(pack, schema).withColumnRenamed("_id", id_col)


def op12_cost_balanced_packing(spark, sf_dir: str) -> DataFrame:
    return cost_balanced(documents(spark, sf_dir)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_cost")

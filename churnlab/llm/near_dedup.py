"""Near-duplicate groups by a multi-index Hamming join of b-bit MinHash signatures (operator 3).

A document is the set of its distinct five-word shingles. Documents are linked from a Jaccard
similarity of ``percent`` / 100 on (85 in the query); :func:`limits` derives all that follows from it.
``chunks * width`` MinHash values cut to 8 bits are the index signature. Pairs that differ in at most
``2 * chunks - 1`` places are searched: cut into ``chunks`` chunks, one chunk of such a pair has at
most one error (pigeonhole). Allowed errors are enumerated by masking each place of each chunk, so
every such pair meets in at least one bucket, whatever the data. The chunks are the widest with at
most ``MAX_KEYS`` keys a document where a pair at the threshold differs in more places with
probability ``MISSED`` at most, and less for closer pairs: 12 chunks of 6 and 7.7e-5 at 0.85 (10.8 of
72 places differ on average, more than 23 are missed), 14 chunks of 5 and 9.2e-5 at 0.8. Pairs that
meet are compared by a 1-bit signature of ``BITS`` functions before their sets are read: a pair at
the threshold differs in more than ``max_bits`` of them (79 of 512 at 0.85, 96 at 0.8) with probability
``FILTERED`` at most, nothing beside what the index misses.

Nothing emits all pairs of a bucket:

* documents with equal word sequences become one class first, represented by the smallest id;
* each bucket ties its members to one of them (a star), the one that meets most others in all its
  buckets. Star pairs within the distance are confirmed on the full shingle sets, and the links are
  joined into components;
* links that stars can't see lie between different components inside one bucket. Only buckets
  with more than one component go on, and there only members outside the bucket's first
  component are paired with members of other components, not yet seen and within the distance of
  a wider signature that is computed for these documents alone (``max_wide`` of ``WIDE`` bits, by the
  same probability: 230 of 2048 at 0.85, 291 at 0.8), and whose sets can reach the threshold by the
  16-bit marks of their shingles (a bound that no link fails; sets over ``MARKED`` shingles pass),
  so that hardly a pair but true links comes out of the join. A pair
  comes out of one bucket alone: that of the first chunk in which it has one error at most, at the place of the
  error or, if the chunks are equal, the first place. A link inside a component can't change it.

Defined results: white space is ASCII, A-Z is lower-cased; fewer than five words make one shingle;
a document without words has an empty set and is linked with nothing; a null text counts as
empty; rows that repeat an id count as that one id, each reported; a null id is never linked, is
reported with a null component and is kept; an empty table gives an empty result; extra columns
are ignored (kept by :func:`drop_near_duplicates`).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import exp, lgamma, log, log1p
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, drop_rows, keyed, saved, small, text_of
from .components import connected_components

SHINGLE, PERCENT = 5, 85
BITS, WIDE = 512, 2048
#: Sets of up to so many shingles are compared by 16-bit marks before pairs come out of a join.
MARKED = 1024
#: Keys of a document; chances that a pair at the threshold is beyond the index or a bit limit.
MAX_KEYS, MISSED, FILTERED = 80, 1e-4, 1e-9
#: Odd multipliers and offsets of the hash family, from one seed.
_RNG = np.random.default_rng(20240229)
_MUL = (_RNG.integers(0, 1 << 31, WIDE, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, WIDE, dtype=np.uint32)
_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


class Limits(NamedTuple):
    """What a link threshold asks of the index and of the bit signatures."""

    percent: int
    chunks: int
    width: int
    max_bits: int
    max_wide: int


def beyond(n: int, p: float, most: int) -> float:
    """The probability that more than ``most`` of ``n`` independent places differ, each with chance ``p``."""
    if p == 0:
        return 0.0
    return sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log1p(-p)) for k in range(most + 1, n + 1))


@lru_cache
def limits(percent: int) -> Limits:
    """The index shape and the bit limits of a threshold of ``percent`` / 100."""
    apart = 1 - percent / 100
    for width in range(8, 2, -1):
        for chunks in range(1, MAX_KEYS // width + 1):
            if beyond(chunks * width, apart * 255 / 256, 2 * chunks - 1) <= MISSED:
                within = [next(m for m in range(n) if beyond(n, apart / 2, m) <= FILTERED) for n in (BITS, WIDE)]
                return Limits(percent, chunks, width, *within)
    raise ValueError(f"no index of {MAX_KEYS} keys for a threshold of {percent} percent")


CHUNKS, WIDTH = limits(PERCENT)[1:3]
PLACES = CHUNKS * WIDTH


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, limit: int = 200_000):
        from xxhash import xxh64_intdigest
        self.known, self.limit, self.digest = {}, limit, xxh64_intdigest

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known, digest = self.known, self.digest
        if len(known) > self.limit:
            known.clear()
        for w in set(words).difference(known):
            known[w] = digest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: list[bytes], hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Distinct shingles of a text as sorted 64-bit hashes; a short text is one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    h = hashes(words)
    n = max(1, len(h) - size + 1)
    out = np.full(n, len(words) if len(words) < size else size, np.uint64)
    for k in range(min(size, len(h))):
        out = mixed(out * _STEP + h[k:k + n])
    return np.unique(out)


def lowest(shingles: np.ndarray, functions: int) -> np.ndarray:
    """The lowest value over the set of each of the first hash functions."""
    low = np.full(functions, 0xFFFFFFFF, np.uint32)
    mul, add = _MUL[:functions, None], _ADD[:functions, None]
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(x), 256):
        np.minimum(low, (x[None, i:i + 256] * mul + add).min(axis=1), out=low)
    return low


def bits(low: np.ndarray) -> np.ndarray:
    """One bit of each value, packed into 64-bit words."""
    return np.packbits((low >> np.uint32(8)).astype(np.uint8) & 1).view(np.int64)


def signatures(shingles: np.ndarray, places: int = PLACES) -> tuple[bytes, np.ndarray]:
    """The index signature (values cut to 8 bits) and the bit signature."""
    low = lowest(shingles, BITS)
    return low[:places].astype(np.uint8).tobytes(), bits(low)


def _words(text: pa.Scalar) -> list[bytes]:
    return text.as_buffer().to_pybytes().lower().split()


def fingerprints(docs: DataFrame, id_col: str, text_col: str, places: int = PLACES) -> DataFrame:
    """id, class digest (128 bits of the word sequence), n_shingles, index signature, bit signature."""
    from hashlib import blake2b

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            out = []
            for text in batch.column(1):
                words = _words(text)
                s = shingle_hashes(words, hashes)
                out.append((blake2b(b" ".join(words), digest_size=16).digest(), len(s), *signatures(s, places)))
            columns = [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "digest", "n", "places", "sig"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(compute, "id bigint, digest binary, n bigint, places binary, sig array<bigint>")


def bucket_keys(reps: DataFrame, chunks: int = CHUNKS, width: int = WIDTH) -> DataFrame:
    """(key, id): for each chunk and each masked place, the chunk's other symbols."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(len(ids), chunks, width).astype(np.int64)
            for c in range(chunks):
                for masked in range(width):
                    key = np.full(len(ids), c * width + masked, np.int64)
                    for k in range(width):
                        if k != masked:
                            key = key << 8 | sig[:, c, k]
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids)], ["key", "id"])

    return reps.select("id", "places").mapInArrow(keys, "key bigint, id bigint")


def _close(a: str, b: str, lim: Limits):
    """Sizes that allow the link, and bit signatures within the distance."""
    small, large = F.least(f"n_{a}", f"n_{b}"), F.greatest(f"n_{a}", f"n_{b}")
    words = [F.bit_count(F.get(f"sig_{a}", F.lit(k)).bitwiseXOR(F.get(f"sig_{b}", F.lit(k)))) for k in range(BITS // 64)]
    return (small * 100 >= large * lim.percent) & (sum(words[1:], words[0]) <= lim.max_bits)


def _named(reps: DataFrame, side: str) -> DataFrame:
    return reps.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("sig").alias(f"sig_{side}"))


def chunk_words(low: np.ndarray, chunks: int, width: int) -> np.ndarray:
    """Each chunk of the index signature as one 64-bit word, a place to a byte."""
    words = np.zeros((chunks, 8), np.uint8)
    words[:, :width] = low[:chunks * width].astype(np.uint8).reshape(chunks, width)
    return words.view(np.int64).ravel()


def _once(chunks: int, width: int):
    """Whether a bucket is the one for its pair: the first chunk with at most one error, and there the
    place that differs, or the first place of an equal chunk."""
    place = F.shiftright("key", 8 * (width - 1)).cast("int")
    apart = lambda c: F.get("parts_a", F.lit(c)).bitwiseXOR(F.get("parts_b", F.lit(c)))
    here = F.get("parts_a", F.floor(place / width).cast("int")).bitwiseXOR(F.get("parts_b", F.floor(place / width).cast("int")))
    fits = here.bitwiseAND(F.call_function("shiftleft", F.lit(0xFF).cast("bigint"), (place % width * 8).cast("int"))) != 0
    once = (place % width == 0) | fits
    for c in range(chunks - 1):
        one = [apart(c).bitwiseAND(F.lit(~(0xFF << 8 * k)).cast("bigint")) == 0 for k in range(width)]
        met = one[0]
        for x in one[1:]:
            met = met | x
        once = once & ~((place >= (c + 1) * width) & met)
    return once


def set_marks(shingles: np.ndarray) -> np.ndarray:
    """The distinct 16-bit marks of a set, for sets of up to ``MARKED`` shingles; none for larger ones."""
    return np.unique(shingles.astype(np.uint16)).view(np.int16).astype(np.int64) if len(shingles) <= MARKED else np.empty(0, np.int64)


def _may_link(lim: Limits):
    """Whether the sets can reach the threshold, by their marks: a common mark stands for one common shingle,
    or for more by as many as share a mark in either set. Sets without marks may."""
    lost = lambda s: F.col(f"n_{s}") - F.size(f"marks_{s}")
    common = F.size(F.array_intersect("marks_a", "marks_b")) + F.least(lost("a"), lost("b"))
    unmarked = (F.size("marks_a") == 0) | (F.size("marks_b") == 0)
    # the marks are named once: what occurs twice in a condition is worked out for every pair
    return unmarked | (common * (100 + lim.percent) >= (F.col("n_a") + F.col("n_b")) * lim.percent)


def _about(wanted: DataFrame, docs: DataFrame, id_col: str, text_col: str, compute) -> DataFrame:
    """(id, s): an array of 64-bit words about the shingle set of each wanted document, once per id.

    The ids are broadcast when counted and few; beyond that the join shuffles.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [compute(shingle_hashes(_words(t), hashes)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["id", "s"])

    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).cast("binary").alias("text")).join(small(wanted), "id", "left_semi")
    return texts.mapInArrow(run, "id bigint, s array<bigint>").dropDuplicates(["id"])


def confirmed(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    wanted = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "id")
    found = saved(_about(wanted, docs, id_col, text_col, lambda s: s.view(np.int64)), "shingle-sets")
    both = pairs.select("a", "b").join(found.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(
        found.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.filter(common * 100 >= (F.size("sa") + F.size("sb") - common) * percent).select("a", "b")


def _close_wide(lim: Limits):
    """The wide signatures within their distance."""
    return F.aggregate(F.zip_with("wide_a", "wide_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x) <= lim.max_wide


def near_duplicate_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept; linked from a similarity of ``percent`` / 100 on."""
    lim = limits(percent)
    prints = saved(fingerprints(docs, id_col, text_col, lim.chunks * lim.width), "fingerprints")
    classes = prints.filter("n > 0 AND id IS NOT NULL").groupBy("digest", "n", "places", "sig").agg(F.min("id").alias("id"))
    reps = saved(classes, "classes")
    keys = saved(bucket_keys(reps, lim.chunks, lim.width), "bucket-keys")
    shared = keys.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    met = saved(keys.join(shared, "key"), "shared-keys")
    # a bucket's hub is the member with most company in its buckets: few hubs serve a whole group
    company = met.groupBy("id").agg(F.sum("members").alias("company"))
    met = saved(met.join(company, "id").select("key", "id", "company"), "companies")
    hubs = met.groupBy("key").agg(F.min_by("id", F.struct(-F.col("company"), "id")).alias("hub"))
    met = saved(met.join(hubs, "key").select("key", "id", "hub"), "buckets")
    stars = met.filter("id <> hub").select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct()
    near = saved(stars.join(_named(reps, "a"), "a").join(_named(reps, "b"), "b").filter(_close("a", "b", lim)).select("a", "b"), "star-pairs")
    links = saved(confirmed(near, docs, id_col, text_col, percent), "links")
    label = saved(connected_components(links), "components")

    # what stars can't see: members of one bucket in different components
    told = met.join(label.withColumnRenamed("component", "c"), "id", "left").select("key", "id", F.coalesce("c", "id").alias("c"))
    told = saved(told.join(reps.select("id", "n", "sig"), "id").select("key", "id", "c", "n", "sig"), "told")
    spread = told.groupBy("key").agg(F.min("c").alias("first"), F.max("c").alias("last")).filter("first <> last")
    open_ = saved(told.join(spread, "key").drop("last"), "open-buckets")
    def signed(shingles: np.ndarray) -> np.ndarray:
        low = lowest(shingles, WIDE)
        return np.concatenate([bits(low), chunk_words(low, lim.chunks, lim.width), set_marks(shingles)])

    wide, words = _about(open_.select("id").distinct(), docs, id_col, text_col, signed), WIDE // 64
    wide = wide.select("id", F.slice("s", 1, words).alias("wide"), F.slice("s", words + 1, lim.chunks).alias("parts"),
                       F.expr(f"slice(s, {words + lim.chunks + 1}, {MARKED})").cast("array<smallint>").alias("marks"))
    open_ = saved(open_.join(wide, "id"), "open-wide")
    side = lambda s: open_.select("key", F.col("id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("wide", "parts", "marks", "c", "n", "sig", "first")])
    cross = side("a").filter("c_a <> first_a").join(side("b"), "key").filter(
        "c_a <> c_b AND (c_b = first_b OR a < b)").filter(_close("a", "b", lim) & _close_wide(lim) & _once(lim.chunks, lim.width) & _may_link(lim))
    cross = cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = saved(cross.join(near, ["a", "b"], "left_anti"), "cross-pairs")
    if not more.isEmpty():
        links = links.union(saved(confirmed(more, docs, id_col, text_col, percent), "links"))
        label = saved(connected_components(links), "components")

    rep = prints.groupBy("digest").agg(F.min(F.when(F.col("n") > 0, F.col("id"))).alias("rep"))
    named = rep.join(label.withColumnRenamed("id", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    out = prints.select("id", "digest", "n").join(named, "digest")
    component = F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("id"))
    component = F.when(F.col("id").isNotNull(), component)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, all columns as they are.

    Rows are linked and dropped by a number of their own, so texts that share an id are told apart.
    The smallest id of a component stays, then the first stored row; rows with a null id stay, too.
    """
    rows, key = keyed(docs, "near-rows")
    named = rows.filter(F.col(id_col).isNotNull())
    found = saved(near_duplicate_components(named, key, text_col, percent).select(key, "component_id"), "near-found")
    linked = small(saved(found.filter(F.col(key) != F.col("component_id")).select("component_id").distinct(), "near-linked"))
    ids = rows.select(key, F.col(id_col).cast("bigint").alias("_id"))
    told = saved(found.join(linked, "component_id").join(ids, key), "near-told")
    order = F.struct("_id", key)
    best = small(saved(told.groupBy("component_id").agg(F.min_by(key, order).alias("_best")), "near-best"))
    dropped = told.join(best, "component_id").filter(F.col(key) != F.col("_best")).select(key)
    return drop_rows(rows, key, saved(dropped, "near-dropped"))


def op3_multi_index_hamming(spark, sf_dir: str) -> DataFrame:
    return near_duplicate_components(documents(spark, sf_dir))

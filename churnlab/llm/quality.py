"""Quality rules (operator 4, DataFrame functions only): base counts and a hashed n-gram
log-likelihood ratio.

Word unigrams and bigrams are hashed into a fixed number of buckets. Two multinomials are
counted: the trusted target (documents that the labels call good, at most ``MAX_TRUSTED`` of
them, chosen by a hash of the id) and the raw corpus (every document). A document's score is the
mean over its n-grams of log p_target - log p_raw; a document is kept when the base rules hold
and the score reaches ``MIN_RATIO``. Everything happens inside the row: no shuffle but that of
the bucket counts, so no hot key and no repeated id can matter.

Defined results: a null or empty text has no words and fails the base rules; its score is 0;
without trusted labels the ratio is 0 everywhere and only the base rules decide; equal rows give
equal rows; an empty table gives an empty result; extra columns are ignored (or kept, in
:func:`drop_low_quality`).
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, documents, text_of

BUCKETS = 1 << 14
#: Documented bound of the labelled rows that the target is fitted on; their ids are broadcast.
MAX_TRUSTED = 200_000
SMOOTHING = 1.0
#: Mean log ratio per n-gram under which a document goes.
MIN_RATIO = -0.15


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def _buckets(hashes: Column, buckets: int) -> Column:
    """Bucket of every unigram and bigram of an array of word hashes."""
    pair = F.transform(hashes, lambda h, i: F.pmod(F.xxhash64(h, F.get(hashes, i + 1)), F.lit(buckets)).cast("int"))
    return F.concat(F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int")),
                    F.slice(pair, 1, F.greatest(F.size(hashes) - 1, F.lit(0))))


def _repeated_words(hashes: Column) -> Column:
    """Words inside five-word windows that the text has twice or more.

    Windows are compared by 64-bit hashes of their five word hashes. Only texts where two hashes
    agree are sorted; a repeated window adds its words that no earlier one has covered.
    """
    windows = F.transform(F.slice(hashes, 1, F.greatest(F.size(hashes) - 4, F.lit(0))),
                          lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, 5)]))

    def covered(found: Column) -> Column:
        def starts(s: Column) -> Column:
            same = lambda e, k: F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, same), lambda e: e["p"]))

        pairs = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        step = lambda a, p: F.struct((a["n"] + F.least(F.lit(5), p - a["end"])).alias("n"), p.alias("end"))
        return F.aggregate(_let(pairs, starts), F.struct(F.lit(0).alias("n"), F.lit(-5).alias("end")), step, lambda a: a["n"])

    return _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(0))


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, word hashes and the base columns of every document."""
    text = text_of(text_col)
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE}]"))
    rows = docs.select(F.col(id_col), text.alias("_text"), words_of(text).alias("_words"), lines.alias("_lines"))
    rows = rows.select(
        id_col, "_text", "_words", F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("_dup"))
    long = lambda c, name: c.cast("bigint").alias(name)
    rows = rows.select(
        id_col, "_hashes", long(F.size("_hashes"), "n_words"), long(F.length(F.array_join("_words", "")), "word_chars"),
        long(F.length("_text") - F.length(F.regexp_replace("_text", r"[#*$%&|<>]+", "")), "n_symbols"),
        long(F.col("_dup"), "n_dup_lines"), long(_repeated_words(F.col("_hashes")), "n_repeat_words"))
    return rows.withColumn("base_failed", (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20))


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """Ids that the labels call good; beyond ``max_trusted`` a hash of the id chooses."""
    good = labels.filter((F.col("quality") == 1) & F.col(id_col).isNotNull()).select(id_col).distinct()
    n = good.count()
    if n > max_trusted:
        good = good.filter(F.pmod(F.xxhash64(id_col), F.lit(n)) < int(max_trusted * 0.95))
    return good


def fit_ratio(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              buckets: int = BUCKETS) -> list[float]:
    """log p_target - log p_raw of every bucket, counted over all documents."""
    hashes = docs.select(F.col(id_col).alias("_id"), F.transform(words_of(text_of(text_col)), lambda w: F.xxhash64(w)).alias("_hashes"))
    marked = hashes.join(F.broadcast(trusted.select(F.col(id_col).alias("_id"), F.lit(1).alias("_target"))), "_id", "left")
    grams = marked.select(F.explode(_buckets(F.col("_hashes"), buckets)).alias("b"), F.coalesce("_target", F.lit(0)).alias("t"))
    raw, target = [0.0] * buckets, [0.0] * buckets
    for r in grams.groupBy("b").agg(F.sum("t").alias("t"), F.count("*").alias("n")).collect():  # one row per bucket at most
        raw[r["b"]], target[r["b"]] = float(r["n"]), float(r["t"])
    if not sum(target):
        return [0.0] * buckets
    norm = math.log(sum(raw) + SMOOTHING * buckets) - math.log(sum(target) + SMOOTHING * buckets)
    return [round(math.log(t + SMOOTHING) - math.log(r + SMOOTHING) + norm, 9) for t, r in zip(target, raw)]


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     buckets: int = BUCKETS, min_ratio: float = MIN_RATIO, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """One row per document: base columns, base_failed, kept, and the score log_ratio."""
    weights = fit_ratio(docs, trusted_ids(labels, id_col, max_trusted), id_col, text_col, buckets)
    return _scored(base_counts(docs, id_col, text_col), weights, buckets, min_ratio).drop("_hashes")


def _scored(rows: DataFrame, weights: list[float], buckets: int, min_ratio: float) -> DataFrame:
    table = F.from_json(F.lit(json.dumps(weights)), "array<double>")  # folded into one literal
    grams = F.greatest(F.col("n_words") * 2 - 1, F.lit(1))
    total = F.aggregate(_buckets(F.col("_hashes"), buckets), F.lit(0.0), lambda a, b: a + F.get(table, b))
    return (rows.withColumn("log_ratio", total / grams)
            .withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= min_ratio)))


def drop_low_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     buckets: int = BUCKETS, min_ratio: float = MIN_RATIO, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """``docs`` without the rows that the rules reject, all columns as they are."""
    weights = fit_ratio(docs, trusted_ids(labels, id_col, max_trusted), id_col, text_col, buckets)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(text_col).alias("_body"))
    # a row number beside the verdict keeps the filter above it; pushed down, it would repeat all counts
    scored = _scored(base_counts_of(rows), weights, buckets, min_ratio).withColumn("_at", F.monotonically_increasing_id())
    kept = scored.filter("kept AND _at >= 0")
    return kept.select("_row.*")


def base_counts_of(rows: DataFrame) -> DataFrame:
    """:func:`base_counts` with the whole row kept aside in ``_row``."""
    return base_counts(rows, "_row", "_body")


def op4_quality_ratio(spark, sf_dir: str) -> DataFrame:
    return quality_verdicts(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))

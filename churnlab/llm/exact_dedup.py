"""Exact duplicate groups by skew-safe combining (operator 2).

Texts are equal when identical after deleting ASCII white space. Three stages, each grouping on
the digest *and* the full normalised text, so a digest collision never merges two texts:

1. local: the map-side half of the first aggregate leaves one row per text and partition;
2. salted: those rows are shuffled by (digest, salt, text). The salt is the scan partition's
   number modulo ``salts``, so the local stage loses nothing and a hot text spreads over tasks;
3. global: at most ``salts`` winners per text meet on the digest.

The group table (without texts) is written to the shared folder and joined back on the digest.
Only if two texts share a digest do members carry their text into that join.

Defined results: a null text counts as empty; all empty texts form one group; of equal texts the
one with the most code points, then the smallest id stays (a null id comes last); rows that
repeat an id with an equal text all report it as theirs, so all of them have ``kept`` true; an
empty table gives an empty result; extra columns are ignored here and returned untouched by
:func:`drop_exact_duplicates`. Ids are integers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, documents, drop_rows, keyed, saved, small, text_of


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _combined(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the best id by rank, the best rank, the number of rows."""
    return rows.groupBy(*keys).agg(F.max_by("_keep", "_rank").alias("_keep"), F.max("_rank").alias("_rank"),
                                   F.sum("_n").alias("_n"))


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16,
                     digest: Callable[[Column], Column] = sha256, row: str | None = None) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256 (the digest column); with ``row``, a
    column that numbers the rows, also _at (that number), _points and _hash (of the normalised text)."""
    text = text_of(text_col)
    normal = F.regexp_replace(text, f"[{SPACE}]+", "")
    slim = docs.select(F.col(id_col).cast("bigint").alias("_id"), normal.alias("_text"), F.length(text).alias("_points"))
    more = [] if row is None else ["_at", "_points", "_hash"]
    if row is not None:
        slim = docs.select(F.col(id_col).cast("bigint").alias("_id"), normal.alias("_text"), F.length(text).alias("_points"), F.col(row).alias("_at"))
        slim = slim.withColumn("_hash", F.xxhash64("_text"))
    slim = slim.withColumn("_digest", digest(F.col("_text")))
    # most code points first, then the smallest id, as one fixed-width number (hash aggregation)
    rank = (F.col("_points").cast("decimal(11,0)") * F.lit(str(2 ** 64)).cast("decimal(20,0)")
            - F.coalesce("_id", F.lit(2 ** 63 - 1)).cast("decimal(20,0)")).cast("decimal(38,0)")
    rows = slim.select("_digest", (F.spark_partition_id() % salts).alias("_salt"), "_text",
                       F.col("_id").alias("_keep"), rank.alias("_rank"), F.lit(1).cast("bigint").alias("_n"))
    by_salt = _combined(rows, ["_digest", "_salt", "_text"])
    merged = _combined(by_salt.drop("_salt").repartition("_digest"), ["_digest", "_text"])
    per_digest = F.count("*").over(_by_digest())
    groups = saved(merged.withColumn("_variants", per_digest)
                   .select("_digest", F.when(F.col("_variants") > 1, F.col("_text")).alias("_variant"), "_keep", "_n"),
                   "exact-groups")
    collided = not groups.filter(F.col("_variant").isNotNull()).isEmpty()
    members = slim.select("_id", "_digest", *more, *(["_text"] if collided else []))
    on = members["_digest"] == groups["_digest"]
    if collided:
        on = on & (groups["_variant"].isNull() | (groups["_variant"] == members["_text"]))
    return members.join(groups, on).select(
        F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_n").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"), members["_digest"].alias("text_sha256"), *more)


def _by_digest():
    from pyspark.sql import Window
    return Window.partitionBy("_digest")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they are.

    Rows are dropped by a number of their own: of rows that repeat the id that stays, the one with the
    most code points, then the first stored stays; other texts under the same id, or a null id, stay.
    """
    rows, key = keyed(docs, "exact-rows")
    found = duplicate_groups(rows, id_col, text_col, salts, row=key).filter("group_size > 1")
    told = saved(found.select("text_sha256", "_hash", "kept", "_points", "_at"), "exact-told")
    best = told.filter("kept").groupBy("text_sha256", "_hash").agg(F.min_by("_at", F.struct(-F.col("_points"), F.col("_at"))).alias("_best"))
    best = saved(best, "exact-best")
    dropped = told.join(small(best), ["text_sha256", "_hash"]).filter("_at <> _best").select("_at")
    return drop_rows(rows, key, saved(dropped, "exact-dropped"))


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return duplicate_groups(documents(spark, sf_dir))


OP2_SQL = r"""
  WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal FROM documents)
  SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY normal) AS group_size,
         doc_id = first_value(doc_id) OVER w AS kept, sha256(normal) AS text_sha256
  FROM t WINDOW w AS (PARTITION BY normal ORDER BY points DESC, doc_id)"""

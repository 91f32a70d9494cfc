"""Hard-negative mining (operator 11): integer scores of anchor-candidate tiles by Strassen's recursion.

1. Rows become integer vectors, ``floor(scale * x)`` of each component, and are stored once, each
   with a row number of its own.
2. Candidates are dealt into parts of about ``TILE_ROWS`` rows and anchors into groups of about
   ``TILE_ANCHORS``, by a hash of the row number. Every (group, part) is a cell of a grid, and a cell
   is one tile: its anchors times its candidates, multiplied by Strassen's recursion on int64 with
   odd edges padded by zeros. Additions are exact; where a tile's largest possible score
   passes 64 bits it is multiplied with Python's integers instead.
3. First pass: each cell keeps a heap of the best ``positives`` rows of the anchor's label; heaps
   of all cells are merged. Second pass: the scores are made again, and each cell keeps a heap of the
   best ``negatives`` rows inside each positive's window; these are merged, too.

Scores of all pairs are never stored; a cell's rows, its tile and its heaps are bounded by
the two tile parameters, not by the table, by a label or by a repeated vector. A row travels once
per anchor group and an anchor once per part, so what is moved is the number of pairs
divided by the tile's edge.

Defined results: rows with a null id, label or vector, or a null or non-finite component take no
part; a component beyond +-9.2e18 after scaling counts as that, a score beyond 64 bits as
the largest or smallest one; shorter vectors are padded with zeros; a repeated row is a row of its
own everywhere (ties between rows of one id are any order, their results are equal or told apart by
the stored row number); an anchor without positives, and a positive without rows in its window, gives no
rows; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved

SCALE, ANCHOR_EVERY, POSITIVES, NEGATIVES = 256, 100, 5, 5
TILE_ROWS, TILE_ANCHORS, LEAF = 2048, 1024, 16
LARGEST, NONE = 2**63 - 1, -2**63


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` for integer matrices, seven half-size products a level; odd edges are padded with zeros."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b, leaf)[:m, :n]
    h, i, j = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    c = np.empty((m, n), a.dtype)
    c[:h, :j] = p1 + p4 - p5 + p7
    c[:h, j:] = p3 + p5
    c[h:, :j] = p2 + p4
    c[h:, j:] = p1 - p2 + p3 + p6
    return c


def scores(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Inner products of the rows of ``a`` with the rows of ``b``, held to 64 bits.

    Int64 sums wrap, so intermediate sums beyond 64 bits do no harm where the result fits.
    """
    most = lambda x: max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if a.shape[1] * most(a) * most(b) < LARGEST:
        return strassen(a, np.ascontiguousarray(b.T), leaf)
    exact = strassen(a.astype(object), b.T.astype(object), leaf)
    return np.clip(exact, NONE + 1, LARGEST).astype(np.int64)


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column as rows of one matrix, shorter ones padded with zeros."""
    column = column.combine_chunks()
    n = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if (n == width).all():
        return flat.reshape(len(n), width)
    out = np.zeros((len(n), width), np.int64)
    out[np.arange(width) < n[:, None]] = flat
    return out


def best(tile: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's ``k`` largest allowed entries, first columns first among equal ones."""
    held = np.where(allowed, tile, NONE)
    rows = np.flatnonzero(allowed.any(axis=1))
    found_r, found_c = [], []
    left = allowed.sum(axis=1)
    for turn in range(k):
        rows = rows[left[rows] > turn]
        if not len(rows):
            break
        cols = held[rows].argmax(axis=1)
        found_r.append(rows)
        found_c.append(cols)
        held[rows, cols] = NONE
    none = np.empty(0, np.int64)
    return np.concatenate([none, *found_r]), np.concatenate([none, *found_c])


def vectors(df: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """The rows that take part: _id, _label, _q (integers), _row (a number fixed by storage)."""
    x = F.col("_x")
    rows = df.select(F.col(id_col).cast("bigint").alias("_id"), label.cast("bigint").alias("_label"),
                     F.col(vector_col).cast("array<double>").alias("_x"))
    broken = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.filter(F.col("_id").isNotNull() & F.col("_label").isNotNull() & x.isNotNull() & ~broken)
    held = lambda v: F.greatest(F.least(v * scale, F.lit(9.2e18)), F.lit(-9.2e18))
    q = F.transform(x, lambda v: F.floor(held(v)).cast("bigint"))
    return saved(rows.select("_id", "_label", q.alias("_q"), F.monotonically_increasing_id().alias("_row")), "vectors")


def _grid(anchors: DataFrame, rows: DataFrame, groups: int, parts: int, tile, schema: str) -> DataFrame:
    """``tile(anchors, candidates)`` for every cell of the grid, candidates in the order of their ids."""
    deal = lambda n: F.pmod(F.xxhash64("_row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("_group", deal(groups)).withColumn("_part", every(parts))
    # columns of their own: both sides are read from one table
    right = rows.select(*[F.col(c).alias(c) for c in rows.columns]).withColumn("_part", deal(parts)).withColumn("_group", every(groups))

    def cell(a: pa.Table, c: pa.Table) -> pa.Table:
        if not len(a) or not len(c):
            return tile(None, a, c)
        c = c.sort_by([("_id", "ascending"), ("_row", "ascending")])
        width = max(int(np.diff(t["_q"].combine_chunks().offsets.to_numpy()).max()) for t in (a, c))
        return tile(scores(matrix(a["_q"], width), matrix(c["_q"], width)), a, c)

    keys = ["_group", "_part"]
    return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(cell, schema)


def hard_negatives(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
                   anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = 80,
                   scale: int = SCALE, tile_rows: int = TILE_ROWS, tile_anchors: int = TILE_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``label`` is an expression over ``df`` (default: the column ``label``), ``anchor`` one over the
    integer id ``_id`` (default: ids divisible by 100). A negative's score is at least ``percent`` per cent of the positive's, and at most that.
    """
    rows = vectors(df, id_col, vector_col, F.col("label") if label is None else label, scale)
    anchors = rows.filter(F.col("_id") % ANCHOR_EVERY == 0 if anchor is None else anchor)
    groups, parts = (max(1, -(-f.count() // n)) for f, n in ((anchors, tile_anchors), (rows, tile_rows)))

    def positive(tile: np.ndarray | None, a: pa.Table, c: pa.Table) -> pa.Table:
        cols = {"anchor": [], "anchor_id": [], "row": [], "id": [], "score": []}
        if tile is not None:
            col = lambda t, n: t[n].to_numpy()
            same = (col(a, "_label")[:, None] == col(c, "_label")) & (col(a, "_row")[:, None] != col(c, "_row"))
            i, j = best(tile, same, positives)
            cols = {"anchor": col(a, "_row")[i], "anchor_id": col(a, "_id")[i], "row": col(c, "_row")[j], "id": col(c, "_id")[j], "score": tile[i, j]}
        return pa.table({k: pa.array(v, pa.int64()) for k, v in cols.items()})

    heaps = _grid(anchors, rows, groups, parts, positive, "anchor long, anchor_id long, row long, id long, score long")
    order = [F.desc("score"), "id", "row"]
    merged = heaps.withColumn("rank", F.row_number().over(Window.partitionBy("anchor").orderBy(*order))).filter(F.col("rank") <= positives)
    # a window of a negative score is empty: its lower end would be above its upper end
    wanted = merged.filter("score >= 0").groupBy("anchor").agg(F.collect_list(F.struct("row", "id", "score")).alias("_wanted"))
    asked = saved(anchors.join(wanted, F.col("_row") == F.col("anchor")).drop("anchor"), "positives")

    def window(tile: np.ndarray | None, a: pa.Table, c: pa.Table) -> pa.Table:
        names = ["anchor", "anchor_id", "positive", "positive_id", "positive_score", "row", "id", "score"]
        found = []
        if tile is not None:
            col = lambda t, n: t[n].to_numpy()
            other = col(a, "_label")[:, None] != col(c, "_label")
            lists = a["_wanted"].to_pylist()
            for k in range(max(map(len, lists))):
                at = np.array([x for x, w in enumerate(lists) if len(w) > k])
                want = [lists[x][k] for x in at]
                most = np.array([w["score"] for w in want], np.int64)
                # percent * p <= 100 * n in whole numbers that can't pass 64 bits
                least = np.array([-(-percent * int(p) // 100) for p in most], np.int64)
                part = tile[at]
                i, j = best(part, other[at] & (part >= least[:, None]) & (part <= most[:, None]), negatives)
                get = lambda n: np.array([w[n] for w in want], np.int64)[i]  # noqa: B023, E731
                found.append([col(a, "_row")[at[i]], col(a, "_id")[at[i]], get("row"), get("id"), most[i], col(c, "_row")[j], col(c, "_id")[j], part[i, j]])
        return pa.table({n: pa.array(np.concatenate([np.empty(0, np.int64), *(f[x] for f in found)]), pa.int64()) for x, n in enumerate(names)})

    schema = "anchor long, anchor_id long, positive long, positive_id long, positive_score long, row long, id long, score long"
    heaps = _grid(asked, rows, groups, parts, window, schema)
    rank = F.row_number().over(Window.partitionBy("anchor", "positive").orderBy(*order))
    return heaps.withColumn("rank", rank).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_strassen_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label=label)


OP11_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * c.q[i])) AS BIGINT) AS score
  FROM r a JOIN r c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM p JOIN s n USING (anchor_id)
WHERE NOT n.same AND 80 * positive_score <= 100 * n.score AND n.score <= positive_score
QUALIFY rank <= 5
"""

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Fixed by the contracts: ASCII white space, as a Java / RE2 character-class body.
SPACE = r"\x20\x09-\x0D"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The text with null as the empty string."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs one stage, and later passes read only the columns
    they use. Every call takes a new folder.
    """
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"llm-{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` stored with one more column, a number of its own for each row, and that column's name.

    The number is fixed by what is stored, so it names the same row in every later read and retry,
    whatever the rows' ids are.
    """
    key, taken = "_row", {c.lower() for c in docs.columns}
    while key in taken:
        key += "_"
    return saved(docs.withColumn(key, F.monotonically_increasing_id()), name), key


def small(df: DataFrame, most: int = 2_000_000) -> DataFrame:
    """``df`` to be broadcast if it is counted and has at most ``most`` rows; otherwise a join shuffles it."""
    return F.broadcast(df) if df.count() <= most else df


def drop_rows(rows: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """``rows`` of :func:`keyed` without those whose number is in ``dropped`` (one column, materialised), and without the key."""
    return rows.join(small(dropped.toDF(key)), key, "left_anti").drop(key)

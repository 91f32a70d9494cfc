"""Sources and sinks.

Parquet is the storage format between stages (column pruning and predicate pushdown reach the
files); CSV is accepted at the edges with an explicit schema, never inferred.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S


def _display_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(S.DISPLAY_NAMES.get(f.name, f.name), f.dataType, True)
                         for f in schema.fields if f.name != S.ID])


def read_customers(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | None = None) -> DataFrame:
    """Customer file(s) with the original headers, renamed to internal names.

    CSV is read with an explicit schema (``enforceSchema=false`` checks headers by name). Without an
    id column, rows get one from the storage alone, so it is the same on any retry and under any split size:
    Parquet rows by file and position in the file; CSV rows, which Spark gives no position, by file,
    content and number among the file's rows of equal content (``numbered_rows``).
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        sch = _display_schema(schema or S.RAW_SCHEMA)
        df = (spark.read.option("header", True).option("enforceSchema", False).schema(sch).csv(path))
    back = {v: k for k, v in S.DISPLAY_NAMES.items()}
    names = [back.get(c.strip(), c.strip()) for c in df.columns]
    if S.ID in names:
        return df.toDF(*names)
    if fmt == "parquet":
        return df.withColumn(S.ID, F.xxhash64("_metadata.file_path", "_metadata.row_index")).toDF(*names, S.ID)
    return numbered_rows(df.withColumn("__file", F.col("_metadata.file_path")).toDF(*names, "__file"), "__file")


def numbered_rows(df: DataFrame, file_col: str, id_col: str = S.ID) -> DataFrame:
    """Rows with an id hashed from the file, the values and a number from 1 among equal rows; ``file_col`` is dropped.

    Equal rows are counted (map-side first, so a row repeated through the whole file is one record in the
    shuffle) and given back as often as they occur: which of them gets which number makes no difference.
    """
    cols = [c for c in df.columns if c != file_col]
    counted = df.groupBy(file_col, *cols).agg(F.count(F.lit(1)).alias("__n"))
    each = counted.withColumn("__at", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__n"))))
    # the hash passes over NULLs, so their places are part of it
    nulls = F.concat_ws("", *[F.col(c).isNull().cast("int").cast("string") for c in cols])
    return each.select(*cols, F.xxhash64(file_col, *cols, nulls, "__at").alias(id_col))


def validate_sources(spark: SparkSession, paths: list[str], fmt: str = "parquet") -> DataFrame:
    """Fail when a source is missing; otherwise (source, rows) from one scan of all files."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if not hp.getFileSystem(conf).exists(hp):
            missing.append(p)
    if missing:
        raise FileNotFoundError(f"Missing data sources: {missing}")
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    df = reader.format(fmt).load(paths)
    return df.groupBy(F.col("_metadata.file_path").alias("source")).agg(F.count(F.lit(1)).alias("rows"))


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """S3: persist a stage output as Parquet."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


MANIFEST_SCHEMA = "batch_ts string, columns map<string,string>, rows bigint, files bigint, landed_at timestamp"


def _manifest(base: str) -> str:
    return base.rstrip("/") + "_manifest"


def write_batch(df: DataFrame, base: str, ts: str | None = None) -> str:
    """Land a timestamped production batch in the folder ``batch_ts=<ts>``, then add it to the manifest.

    The manifest (columns with their types, rows, files) is written after the data: a batch that broke off
    has no row there and is not read. Landing a batch again replaces it.
    """
    ts = ts or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    spark, folder = df.sparkSession, f"{base.rstrip('/')}/batch_ts={ts}"
    df.write.mode("overwrite").parquet(folder)
    landed = spark.read.schema(df.schema).parquet(folder)
    columns = F.create_map(*[F.lit(v) for f in df.schema.fields for v in (f.name, f.dataType.simpleString())])
    # rows come from the footers: a count reads no column
    row = landed.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("_metadata.file_path").alias("files"))
    row.select(F.lit(ts).alias("batch_ts"), columns.alias("columns"), "rows", "files", F.current_timestamp().alias("landed_at")) \
        .write.mode("append").parquet(_manifest(base))
    return ts


def read_manifest(spark: SparkSession, base: str) -> DataFrame:
    """The newest manifest row of every landed batch; no rows where nothing has landed."""
    try:
        rows = spark.read.schema(MANIFEST_SCHEMA).parquet(_manifest(base))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    cols = rows.columns
    return rows.groupBy("batch_ts").agg(F.max_by(F.struct(*cols), F.struct("landed_at", "rows")).alias("r")).select("r.*")


def read_batches(spark: SparkSession, base: str, required: list[str], batches: list[str] | None = None) -> DataFrame:
    """All landed batches that carry every required column, as one table of these and ``batch_ts``.

    A batch conforms by its columns in the manifest, so a column of NULLs is no reason to drop it and no
    file is opened to decide. Batches whose required columns have other types are read apart and brought to a
    common type; the driver gets one row per distinct set of types, none per batch. Which folders to scan
    follows from a join with the manifest on the partition column. A batch without a manifest row is not read.
    """
    manifest = read_manifest(spark, base)
    if batches is not None:
        manifest = manifest.where(F.col("batch_ts").isin(batches))
    has_all = F.forall(F.array(*[F.lit(c) for c in required]), lambda c: F.map_contains_key("columns", c))
    fit = manifest.where(has_all).select("batch_ts", F.array(*[F.element_at("columns", F.lit(c)) for c in required]).alias("types"))
    kinds = [tuple(r["types"]) for r in fit.select("types").distinct().orderBy("types").collect()]
    out = None
    for kind in kinds:
        schema = ", ".join(f"`{c}` {t}" for c, t in zip(required, kind)) + ", batch_ts string"
        these = fit.where(F.col("types") == F.array(*[F.lit(t) for t in kind])).select("batch_ts")
        part = spark.read.schema(schema).parquet(base).join(these, "batch_ts", "left_semi").select(*required, "batch_ts")
        out = part if out is None else out.union(part)
    if out is None:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.DoubleType()) for c in required] + [T.StructField("batch_ts", T.StringType())]))
    return out


def write_report(df: DataFrame, path: str) -> None:
    """A (one-row) report as JSON."""
    df.coalesce(1).write.mode("append").json(path)


def read_reports(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Reports back, with each file's modification time (for K4 ``latest``)."""
    r = spark.read.schema(schema).json(path) if schema is not None else spark.read.json(path)
    return r.withColumn("file_time", F.col("_metadata.file_modification_time"))


def log_metrics(spark: SparkSession, path: str, run_id: str, step: str, metrics: dict) -> None:
    """Append (run_id, step, key, value, ts) rows."""
    ts = _dt.datetime.now(_dt.timezone.utc)
    rows = [(run_id, step, k, float(v), ts) for k, v in metrics.items() if v is not None]
    spark.createDataFrame(rows, "run_id string, step string, key string, value double, ts timestamp") \
        .write.mode("append").parquet(path)


def save_features(spark: SparkSession, features: list[str], path: str) -> None:
    """Ordered feature list as a (pos, feature) table."""
    spark.createDataFrame(list(enumerate(features)), "pos int, feature string").coalesce(1) \
        .write.mode("overwrite").parquet(path)


def load_features(spark: SparkSession, path: str) -> list[str]:
    return [r["feature"] for r in spark.read.parquet(path).orderBy("pos").collect()]


def save_model(model: PipelineModel, path: str) -> None:
    """S9."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_split(df: DataFrame, path: str) -> None:
    """Rows with their ``split`` column, partitioned by it."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def load_split(spark: SparkSession, path: str, split: str = "test") -> DataFrame:
    return spark.read.parquet(path).where(F.col("split") == split)


def export_filtered(df: DataFrame, path: str) -> None:
    """Filtered rows as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)

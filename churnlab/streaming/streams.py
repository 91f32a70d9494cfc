"""Structured Streaming twins of scoring and monitoring.

X1 ``stream_score``: request files arriving in a folder are scored per micro-batch with the same
table job as batch scoring (``foreachBatch``); results and rejects go to two tables partitioned
by batch id, each micro-batch overwriting only its own partition (idempotent on replay).

X2 ``stream_monitor``: event-time tumbling windows per event type with a watermark, so state is
bounded and rows later than the watermark are dropped; ``window_counts`` is its batch twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.features import FeatureStats
from ..plans.scoring import score_requests


def window_counts(events: DataFrame, window: str = "1 hour", ts: str = "ts", key: str = "event_type",
                  value: str = "value") -> DataFrame:
    """Batch twin of X2: per (tumbling window, key) the count and mean value."""
    return (events.groupBy(F.window(ts, window).alias("w"), F.col(key))
            .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "n",
                    F.round("mean_value", 6).alias("mean_value")))


def stream_monitor(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str, checkpoint_dir: str,
                   window: str = "1 hour", watermark: str = "2 hours", fmt: str = "parquet",
                   max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Windowed counts and means per event type, appended once the watermark passes a window."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = reader.format(fmt).load(source_dir)
    # watermarks need TIMESTAMP; a zone-less source column is read as session-time (UTC) instants
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    agg = window_counts(events.withWatermark("ts", watermark), window)
    return (agg.writeStream.outputMode("append").format("parquet")
            .option("path", sink_dir).option("checkpointLocation", checkpoint_dir).start())


def stream_score(spark: SparkSession, source_dir: str, schema: T.StructType, model, stats: FeatureStats,
                 features: list[str], out_dir: str, reject_dir: str, checkpoint_dir: str,
                 fmt: str = "parquet", background: DataFrame | None = None) -> StreamingQuery:
    """Score request files as they land (stateless), via ``foreachBatch``."""
    requests = spark.readStream.schema(schema).format(fmt).load(source_dir)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # foreachBatch may replay a micro-batch after a failure: each batch owns one partition
        # folder and overwrites it, so a replay replaces its own output instead of duplicating it
        res, rej = score_requests(model, batch, stats, features, background)
        res.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")
        rej.write.mode("overwrite").parquet(f"{reject_dir}/batch_id={batch_id}")

    return (requests.writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint_dir).start())

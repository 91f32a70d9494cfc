"""Feature drift on a stream of scored rows, window by window (X2 with M3 per micro-batch).

``stream_drift`` keeps distinct-value counts per (event-time window, feature) in the streaming state,
never rows: a value seen a million times is one entry, and the watermark drops a window's entries once
it is closed. A closed window's counts reach ``foreachBatch`` exactly once and are compared with the
reference profile (M1) by ``windowed_ks``. Every micro-batch overwrites its own partition of the
output, so a replay after a failure replaces its rows.

``window_drift`` is the batch twin over a whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.pvalues import p_ks
from ..operators.ordered import prefix_sums
from ..plans.monitoring import DRIFT_ALPHA

WINDOW = ["window_start", "window_end"]


def window_value_counts(rows: DataFrame, features: list[str], window: str = "1 day", ts: str = "ts") -> DataFrame:
    """(window_start, window_end, feature, value, n): distinct non-NULL, non-NaN values per tumbling window."""
    long = (rows.select(F.col(ts), *[F.col(c).cast("double").alias(c) for c in features])
            .select(ts, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in features])).alias("cell"))
            .select(ts, "cell.feature", "cell.value").where(F.col("value").isNotNull() & ~F.isnan("value")))
    return (long.groupBy(F.window(ts, window).alias("w"), "feature", "value").agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "feature", "value", "n"))


def windowed_ks(profile: DataFrame, counts: DataFrame, alpha: float = DRIFT_ALPHA) -> DataFrame:
    """(window_start, window_end, feature, ks_statistic, n_ref, n_new, p_value, drift_detected) for every window.

    Between two neighbouring values of a window its own distribution function is flat and the reference's
    rises, so the largest gap lies at a value of the window, from the right or just below it. One running
    sum over the profile and all windows' values therefore serves every window; the profile is not
    repeated for each. A feature without reference values has no statistic and no drift.
    """
    ref = profile.where(F.col("kind") == "feature").select("feature", "value", F.col("n").alias("a"))
    ref = ref.unionByName(counts.select("feature", "value").distinct().withColumn("a", F.lit(0).cast("bigint")))
    merged = ref.groupBy("feature", "value").agg(F.sum("a").cast("bigint").alias("a"))
    below = prefix_sums(merged, ["feature"], "value", ["a"], total_prefix="n_").select("feature", "value", "a", "cum_a", "n_a")
    mine = prefix_sums(counts.withColumnRenamed("n", "b"), [*WINDOW, "feature"], "value", ["b"], total_prefix="n_")
    both = mine.join(below, ["feature", "value"])
    share = lambda part, whole: F.try_divide(F.col(part), F.col(whole))
    at = F.abs(share("cum_a", "n_a") - share("cum_b", "n_b"))
    before = F.abs(F.try_divide(F.col("cum_a") - F.col("a"), F.col("n_a")) - F.try_divide(F.col("cum_b") - F.col("b"), F.col("n_b")))
    out = both.groupBy(*WINDOW, "feature").agg(F.max(F.greatest(at, before)).alias("ks_statistic"),
                                               F.first("n_a").cast("bigint").alias("n_ref"), F.first("n_b").cast("bigint").alias("n_new"))
    out = out.withColumn("p_value", p_ks(F.col("ks_statistic"), F.col("n_ref"), F.col("n_new")))
    # rounded for display only, after the p-value and the flag
    return (out.withColumn("drift_detected", F.coalesce(F.col("p_value") < alpha, F.lit(False)))
            .withColumn("ks_statistic", F.round("ks_statistic", 6)))


def window_rates(drift: DataFrame) -> DataFrame:
    """Per window the features checked (those with a statistic), the drifted ones and the drift rate."""
    return (drift.groupBy(*WINDOW).agg(F.count("ks_statistic").alias("features_checked"),
                                       F.count_if("drift_detected").alias("features_drifted"))
            .withColumn("drift_rate", F.coalesce(F.try_divide(F.col("features_drifted"), F.col("features_checked")), F.lit(0.0))))


def window_drift(profile: DataFrame, rows: DataFrame, features: list[str], window: str = "1 day", ts: str = "ts") -> DataFrame:
    """Batch twin of ``stream_drift``: all windows of a table."""
    return windowed_ks(profile, window_value_counts(rows, features, window, ts))


def stream_drift(spark: SparkSession, source_dir: str, schema: T.StructType, profile: DataFrame, features: list[str], out_dir: str,
                 checkpoint_dir: str, window: str = "1 day", watermark: str = "2 hours", ts: str = "ts", fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """X2 + M3: drift per closed window and feature, appended to ``out_dir``; rows later than the watermark are dropped.

    ``profile`` is a stored table (``monitoring.load_profile``): it is read again for every micro-batch that closes a window.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.format(fmt).load(source_dir).withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)

    def per_batch(closed: DataFrame, batch_id: int) -> None:
        # the state store gives its rows once per run of the micro-batch: they are kept before they are read twice
        held = closed.persist()
        try:
            if not held.isEmpty():
                windowed_ks(profile, held).write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")
        finally:
            held.unpersist()

    return (window_value_counts(rows, features, window, ts).writeStream.outputMode("append").foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint_dir).start())

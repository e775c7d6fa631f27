"""Continuous monitoring: fresh ingest, quarantine and counts as streaming queries.

Fresh ingest and quarantine are two queries over the same source with their own
checkpoints, because a sink behind a stateful operator never sees what that
operator dropped.  The freshness guard runs before the watermark: one record
from the far future would otherwise advance it past everything else.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from brightweir.operators import dedup
from brightweir.operators.freshness import fresh_only, reason_code

# Accepted rows span 24 hours and 15 minutes; a shorter delay would drop fresh rows silently.
WATERMARK = "25 hours"
# Tasks over which the first stage of deduplication spreads one key.
WAYS = 16


LANDED_SCHEMA = StructType(
    [StructField("source", StringType()), StructField("page", LongType()), StructField("payload", StringType())]
)


def file_stream(spark: SparkSession, path: str, schema: StructType, pattern: str = "*.parquet",
                files_per_trigger: int = 1000) -> DataFrame:
    """Landed Parquet files as a stream."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )


def landed_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """A landed table (``source, page, payload``) that keeps growing, as a stream."""
    return file_stream(spark, path, LANDED_SCHEMA, files_per_trigger=files_per_trigger)


def fresh_stream(stream: DataFrame, ts: str, ref: Column, key: str, spread_by: Sequence[str]) -> DataFrame:
    """Fresh rows, each key once within the watermark.

    The first stage drops repeats per key and salt, so that a hot key is
    handled by many tasks; the second sees at most one row per salt.
    """
    salted = (
        fresh_only(stream, ts, ref)
        .withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(WAYS)))
        .withWatermark(ts, WATERMARK)
    )
    return salted.dropDuplicatesWithinWatermark([key, "_salt"]).dropDuplicatesWithinWatermark([key]).drop("_salt")


def stale_stream(stream: DataFrame, ts: str, ref: Column) -> DataFrame:
    """Rows that are not fresh, with their reason.  Stateless."""
    return stream.withColumn("reason_code", reason_code(F.col(ts), ref)).where("reason_code is not null")


def window_counts(stream: DataFrame, ts: str, source: str, width: str = "1 hour", delay: str = WATERMARK) -> DataFrame:
    """Rows per tumbling window and source: once a window is closed, or at every change (``append_updates``)."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, width), source)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.col("window.start").alias("window_start"), source, "n_rows")
    )


def append_new(stream: DataFrame, path: str, checkpoint: str, key: str, order: Sequence[str]) -> StreamingQuery:
    """Append rows whose key the table does not hold yet, in everything available now.

    A batch that is replayed after a failure finds its rows in the table and
    appends nothing.
    """

    def write(batch: DataFrame, _: int) -> None:
        # The winners are counted, matched and written: one evaluation of the batch.
        winners = dedup.first_wins(batch, key, order).persist()
        try:
            dedup.append_new(winners, path, key)
        finally:
            winners.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_updates(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what changed in each batch to a folder of its own; a batch that is replayed replaces its folder.

    So windows that are still open when a run ends are counted too.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def latest_counts(updates: DataFrame, source: str) -> DataFrame:
    """The last count of each window and source in what ``append_updates`` has written."""
    return updates.groupBy("window_start", source).agg(F.max_by("n_rows", "batch").alias("n_rows"))


def append_all(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append every row of everything available now; the file sink commits each batch once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )

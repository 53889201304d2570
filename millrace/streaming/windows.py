"""Event-time windows, running totals and lookups on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.values import settle
from millrace.sinks.tables import KeyedTable
from millrace.streaming.runs import drain_batches


def sliding_stats(
    stream: DataFrame, ts: str, value: str, length: str = "10 seconds", slide: str = "2 seconds", lateness: str = "10 seconds",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Count, mean, minimum and maximum per sliding event-time window; rows later than the bound are dropped.

    Counts and sums are combined per task before the shuffle, so a hot window
    or key moves one row per task.
    """
    windowed = stream.withWatermark(ts, lateness).groupBy(F.window(ts, length, slide).alias("w"), *keys)
    return windowed.agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value"),
        F.min(value).alias("min_value"), F.max(value).alias("max_value"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys,
             "n", settle(F.col("mean_value"), 4).alias("mean_value"), "min_value", "max_value")


def running_totals(
    spark: SparkSession, stream: DataFrame, keys: Sequence[str], totals: Sequence[Column], path: str, checkpoint: str,
    buckets: int = 64,
) -> KeyedTable:
    """Totals per key over everything seen so far, kept in a keyed table.

    The state store holds the totals; each batch hands over only the keys it
    changed, with the batch number as sequence, so a repeated batch changes nothing.
    """
    table = KeyedTable(spark, path, keys, buckets)

    def store(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch.withColumn("_batch", F.lit(batch_id)), ["_batch"], except_columns=["_batch"])

    drain_batches(stream.groupBy(*keys).agg(*totals), store, checkpoint, "update")
    return table


def stream_changes(
    spark: SparkSession, stream: DataFrame, keys: Sequence[str], sequence_by: Sequence[str], path: str, checkpoint: str,
    delete_when=None, except_columns: Sequence[str] = (), buckets: int = 64,
) -> KeyedTable:
    """SCD type 1 table fed by a change stream; late and repeated changes give the same table."""
    table = KeyedTable(spark, path, keys, buckets)

    def store(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, sequence_by, delete_when, except_columns)

    drain_batches(stream, store, checkpoint, "append")
    return table


def enrich_stream(stream: DataFrame, ref: DataFrame, on, how: str = "inner") -> DataFrame:
    """Look every micro-batch up in a static table.

    Spark broadcasts the table when it is below the broadcast threshold and
    shuffles otherwise; the table is read again for each batch.
    """
    return stream.join(ref, on, how)

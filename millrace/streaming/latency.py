"""Latency tables of streaming runs, from quantile sketches stored per batch and merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import latency_millis
from millrace.operators.aggregates import SKETCH_SIZE, exact_quantiles, merged_sketches, quantile_sketches, quantiles_of
from millrace.operators.windows import join_on, number_batches


def with_latency(df: DataFrame, source_ts: str, sink_ts: str) -> DataFrame:
    return df.withColumn("latency", latency_millis(F.col(source_ts), F.col(sink_ts)))


GROUP = ["trigger_type", "batch_id"]


def store_latencies(df: DataFrame, path: str, source_ts: str = "source_ts", sink_ts: str = "sink_ts", size: int = SKETCH_SIZE):
    """A handler for micro-batches of ``df``'s columns: latencies of each batch as sketches, one row per trigger type.

    Only the sketches are kept; a repeated batch writes the same folder again.  Rows that bring a ``latency`` or a ``batch_id`` of
    their own keep it; a batch may then arrive in parts, which are merged when the sketches are read.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        timed = batch if "latency" in batch.columns else with_latency(batch, source_ts, sink_ts)
        if "batch_id" not in timed.columns:
            timed = timed.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        quantile_sketches(timed, GROUP, "latency", size).write.mode("overwrite").parquet(f"{path}/part={batch_id}")

    return store


def latency_per_batch(sketches: DataFrame, rows: DataFrame | None = None, slack: float = 0.02) -> DataFrame:
    """Mean and percentiles of ``latency`` per trigger type and batch from stored sketches, batches numbered per type.

    With the ``rows`` themselves the percentiles are exact: the sketches tell which rows decide them, within ``slack``.
    """
    merged = merged_sketches(sketches, GROUP)
    figures = quantiles_of(merged, GROUP, "latency") if rows is None else exact_quantiles(rows, merged, GROUP, "latency", slack)
    return number_batches(figures, ["trigger_type"], F.col("batch_id").asc_nulls_last(), "batch_no")


def compare_trigger_types(tables: Sequence[DataFrame], skip: int = 2) -> DataFrame:
    """Sketches of the batches of each trigger type, merged without the first ones, which carry start-up cost: mean and percentiles."""
    rows = tables[0]
    for other in tables[1:]:
        rows = rows.union(other.select(*rows.columns))
    batches = number_batches(rows.select(*GROUP).distinct(), ["trigger_type"], "batch_id", "batch_no")
    late = join_on(rows, batches.filter(F.col("batch_no") > skip), GROUP).select(*rows.columns)
    return quantiles_of(merged_sketches(late, ["trigger_type"]), ["trigger_type"], "latency")

"""Message payloads for a broker sink."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_payload(df: DataFrame, columns: Sequence[str], key: str | None = None) -> DataFrame:
    """One ``value`` column of JSON text (and a ``key``), the shape a broker sink expects."""
    cells = [F.col(key).cast("string").alias("key")] if key else []
    return df.select(*cells, F.to_json(F.struct(*columns)).alias("value"))


def with_headers(df: DataFrame, headers: Mapping[str, object]) -> DataFrame:
    """Add message headers such as trigger type, run id and batch id."""
    cells = [
        F.struct(F.lit(k).alias("key"), F.lit(str(v)).cast("binary").alias("value")) for k, v in headers.items()
    ]
    return df.withColumn("headers", F.array(*cells))


def send(df: DataFrame, options: Mapping[str, str]) -> None:
    """Batch write to a broker; the connector has to be on the class path."""
    df.write.format("kafka").options(**options).save()


def batch_sender(options: Mapping[str, str], trigger_type: str, run_id: str):
    """``foreachBatch`` function that stamps each message with trigger type, run and batch id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        send(with_headers(batch, {"trigger_type": trigger_type, "run_id": run_id, "batch_id": batch_id}), options)

    return write

"""Copies of result tables in a relational store."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from millrace.operators.quality import require_unique


def snapshot_to_store(df: DataFrame, keys: Sequence[str], url: str, table: str, options: Mapping[str, str] | None = None) -> None:
    """Replace the serving table with the current rows.

    Truncating keeps the table's indexes and grants; ``numPartitions`` in the
    options limits the number of parallel connections.
    """
    require_unique(df, keys)
    settings = {"truncate": "true", "batchsize": "10000", **(options or {})}
    df.write.mode("overwrite").options(**settings).jdbc(url, table)

"""Registry of the checked queries: a Spark function and, where SQL can say it, the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import is_folder, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a query; ``covers`` names the inventory entries it shows."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        COVERS[name] = tuple(covers.split())
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the supplied tables; times without zone are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as a file stream, be it one file or a folder of files."""
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    path = f"{folder}/{name}.parquet"
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def rounded(expression: str, digits: int) -> str:
    """SQL text for a float result rounded half away from zero, as the Spark side does."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38, 7)), {digits}) AS DOUBLE)"


__all__ = ["COVERS", "ORACLES", "QUERIES", "query", "rounded", "stream", "table"]

"""Compact JSON artifacts and their manifest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _pieces(df: DataFrame, order: Sequence[str | Column], piece: str | Column | None) -> tuple[DataFrame, str]:
    """(piece, value): one compact JSON text per row, each piece in order in one task."""
    name = piece if isinstance(piece, str) else "piece"
    number = F.lit(0) if piece is None else F.col(piece) if isinstance(piece, str) else piece
    columns = [c for c in df.columns if c != name]
    placed = df.select("*") if isinstance(piece, str) else df.withColumn(name, number)
    sorted_rows = placed.repartition(F.col(name)).sortWithinPartitions(F.col(name), *order)
    return sorted_rows.select(name, F.to_json(F.struct(*columns)).alias("value")), name


def write_json_gz(df: DataFrame, path: str, order: Sequence[str | Column], piece: str | Column | None = None) -> None:
    """Gzipped JSON lines, one file per piece (a day, a region; all rows without one) in a folder ``<piece>=<value>``.

    The same rows always give files of the same bytes, since neither samples nor the number of tasks decide what a file holds.  Pieces in
    order of their values are the whole in order if ``piece`` follows ``order``.  Choose pieces that a task can sort.
    """
    lines, name = _pieces(df, order, piece)
    lines.write.mode("overwrite").option("compression", "gzip").partitionBy(name).text(path)


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(file, length, hash) of all files of an artifact, ``file`` being the folder of its piece; read by tasks, a file at a time."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    folder = F.element_at(F.split("path", "/"), -2)
    return read.select(folder.alias("file"), "length", F.sha2("content", 256).alias("hash"))


def read_json_gz(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").json(path)


def write_manifest(spark: SparkSession, path: str, entries: Mapping[str, str]) -> None:
    """The list of finished artifacts.  Call it last: its presence tells that all others are complete."""
    rows = sorted(entries.items())
    spark.createDataFrame(rows, "artifact string, path string").coalesce(1).write.mode("overwrite").json(path)

"""XML files by row tag, with optional XSD check of each row."""

from __future__ import annotations

import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | None = None) -> DataFrame:
    """One row per element; attributes become ``_name``, repeated tags arrays, missing ones null."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader.schema(schema) if schema else reader).load(path)


def read_xml_checked(spark: SparkSession, path: str, row_tag: str, schema: T.StructType, xsd: str) -> DataFrame:
    """As :func:`read_xml`, rows that fail the XSD carry their text in ``_corrupt_record``."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.format("xml").option("rowTag", row_tag).option("rowValidationXSDPath", xsd)
    return reader.option("columnNameOfCorruptRecord", CORRUPT).schema(wide).load(path)


def send_xsd(spark: SparkSession, text: str, name: str) -> str:
    """Send an XSD to all executors; the result is the path to give to the reader."""
    local = Path(tempfile.mkdtemp(prefix="millrace-xsd-")) / name
    local.write_text(text, encoding="utf-8")
    spark.sparkContext.addFile(str(local))
    return name


def create_xml_table(spark: SparkSession, name: str, path: str, row_tag: str) -> None:
    spark.sql(f"CREATE TABLE {name} USING XML OPTIONS (path '{path}', rowTag '{row_tag}')")


def schema_of_xml(spark: SparkSession, sample: str) -> str:
    return spark.range(1).select(F.schema_of_xml(F.lit(sample))).first()[0]


def to_xml(df: DataFrame, columns: list[str], row_tag: str, name: str = "xml") -> DataFrame:
    """The columns as one XML element per row."""
    return df.withColumn(name, F.to_xml(F.struct(*columns), {"rowTag": row_tag}))


def from_xml(df: DataFrame, column: str, schema: str, name: str = "parsed") -> DataFrame:
    return df.withColumn(name, F.from_xml(F.col(column), schema))

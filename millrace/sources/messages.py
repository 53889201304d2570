"""Broker messages, live or replayed from files with the same columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import has_header, header_value

MESSAGE_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, "
    "timestampType int, headers array<struct<key: string, value: binary>>"
)

# Recorded messages are JSON lines: text key and value, the other columns as they are.
RECORDED_SCHEMA = (
    "key string, value string, topic string, partition int, offset bigint, timestamp timestamp, "
    "headers array<struct<key: string, value: string>>"
)


def broker_options(
    servers: str, topic: str, starting: str = "earliest", ending: str | None = None, headers: bool = True,
    user: str | None = None, password: str | None = None, extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for a topic; with a user, SASL over TLS."""
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting,
           "includeHeaders": str(headers).lower()}
    if ending:
        out["endingOffsets"] = ending
    if user:
        login = "org.apache.kafka.common.security.plain.PlainLoginModule required"
        out |= {
            "kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": f'{login} username="{user}" password="{password}";',
        }
    return {**out, **(extra or {})}


def read_broker(spark: SparkSession, options: Mapping[str, str], stream: bool = True) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**options).load()


def _shape(df: DataFrame) -> DataFrame:
    binary = F.transform("headers", lambda h: F.struct(h["key"].alias("key"), h["value"].cast("binary").alias("value")))
    return df.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "topic", "partition",
        "offset", "timestamp", F.lit(0).alias("timestampType"), binary.alias("headers"),
    )


def replay(
    spark: SparkSession, path: str, topic: str | None = None, stream: bool = False, first_offset: int | None = None,
    last_offset: int | None = None,
) -> DataFrame:
    """Recorded messages with the columns of a broker read; offsets may be limited to a range."""
    reader = spark.readStream if stream else spark.read
    df = _shape(reader.schema(RECORDED_SCHEMA).json(path))
    if topic is not None:
        df = df.filter(F.col("topic") == topic)
    if first_offset is not None:
        df = df.filter(F.col("offset") >= first_offset)
    if last_offset is not None:
        df = df.filter(F.col("offset") <= last_offset)
    return df


def decoded(messages: DataFrame, schema: str, required_header: str | None = None, header_columns: Mapping[str, str] | None = None) -> DataFrame:
    """JSON values to columns; only messages with the header when one is named."""
    if required_header is not None:
        messages = messages.filter(has_header(F.col("headers"), required_header))
    extra = [header_value(F.col("headers"), key).alias(name) for name, key in (header_columns or {}).items()]
    parsed = messages.select(
        F.from_json(F.col("value").cast("string"), schema).alias("data"), *extra,
        F.col("timestamp").alias("sink_timestamp"), "offset",
    )
    return parsed.select("data.*", *header_columns or {}, "sink_timestamp", "offset")

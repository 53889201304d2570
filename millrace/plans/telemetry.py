"""Device telemetry: flatten payloads, latest positions, clients, recent rows, traces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import safe_double, safe_iso
from millrace.operators.aggregates import client_stats
from millrace.operators.relational import known_position, newest
from millrace.operators.windows import even_subsample, latest_per_key

# Groups of a device payload and the values each carries.  Values are read as
# text, so that one bad value does not spoil its row.
GROUPS = {
    "acceleration": ["x", "y", "z"], "rotationRate": ["alpha", "beta", "gamma"], "orientation": ["alpha", "beta", "gamma"],
    "location": ["latitude", "longitude", "altitude", "accuracy", "speed", "heading"], "magnetometer": ["x", "y", "z"],
}
PREFIXES = {"acceleration": "acceleration_", "rotationRate": "rotation_", "orientation": "orientation_", "location": "", "magnetometer": "magnetic_"}

PAYLOAD_SCHEMA = "clientId string, timestamp string, " + ", ".join(
    f"{group}: struct<{', '.join(f'{v}: string' for v in values)}>".replace(":", " ", 1) for group, values in GROUPS.items()
)

NON_NUMERIC = {"allowNonNumericNumbers": "true"}


def flatten_payloads(df: DataFrame, payload: str, received_at: Column) -> DataFrame:
    """Nested JSON readings (batch or stream) to one flat row each.

    NaN and infinite values become null; readings with a bad time are left out.
    """
    parsed = df.select(F.from_json(payload, PAYLOAD_SCHEMA, NON_NUMERIC).alias("r"), received_at.alias("received_at"))
    cells = [
        safe_double(F.col(f"r.{group}.{value}")).alias(f"{PREFIXES[group]}{value}")
        for group, values in GROUPS.items() for value in values
    ]
    flat = parsed.select(
        F.expr("uuid()").alias("id"), F.col("r.clientId").alias("client_id"), safe_iso(F.col("r.timestamp")).alias("timestamp"),
        *cells, "received_at", F.lit(0).cast("bigint").alias("processing_time_ms"),
    )
    return flat.filter(F.col("timestamp").isNotNull())


def ingest_counts(df: DataFrame, payload: str) -> DataFrame:
    """Accepted and rejected readings."""
    stamp = safe_iso(F.from_json(payload, "timestamp string", NON_NUMERIC)["timestamp"])
    return df.agg(F.count_if(stamp.isNotNull()).alias("ok"), F.count_if(stamp.isNull()).alias("failed"))


def positioned(df: DataFrame) -> DataFrame:
    return df.filter(known_position(F.col("latitude"), F.col("longitude")))


def latest_locations(df: DataFrame, tie: str) -> DataFrame:
    return latest_per_key(positioned(df), ["client_id"], ["timestamp", tie])


def trace(df: DataFrame, tie: str, max_points: int) -> DataFrame:
    """Evenly thinned trace of every client."""
    return even_subsample(positioned(df), ["client_id"], ["timestamp", tie], max_points)


def clients(df: DataFrame, tie: str, as_of: Column) -> DataFrame:
    """Activity per client beside its last known position, if any."""
    last = latest_locations(df, tie).select("client_id", F.col("latitude").alias("last_lat"), F.col("longitude").alias("last_lon"))
    return client_stats(df, "client_id", "timestamp", as_of).join(last, "client_id", "left")


def client_totals(stats: DataFrame) -> DataFrame:
    return stats.agg(F.count(F.lit(1)).alias("total"), F.count_if("is_active").alias("active"))


def recent(df: DataFrame, tie: str, limit: int = 50) -> DataFrame:
    return newest(positioned(df), ["timestamp", tie], limit)


def per_minute(df: DataFrame, value: str, as_of: Column, minutes: int = 60) -> DataFrame:
    """Rows, clients, mean and sum of a value per minute of the last hour."""
    start = as_of - F.make_dt_interval(mins=F.lit(minutes))
    return df.filter(F.col("timestamp") > start).groupBy(F.date_trunc("minute", "timestamp").alias("minute")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("client_id").alias("n_clients"),
        F.avg(value).alias("mean_value"), F.sum(value).alias("sum_value"),
    ).orderBy(F.desc("minute")).limit(minutes)

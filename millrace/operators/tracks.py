"""Flight tracks, density and anomalies from state vectors.

Input columns: icao24, callsign, time_position, latitude, longitude,
geo_altitude, velocity, vertical_rate, squawk, on_ground.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.geo import REPORT_BOXES, grid_cell, in_box, region_box
from millrace.functions.times import time_bucket
from millrace.functions.values import settle
from millrace.operators.aggregates import distinct_per_band
from millrace.session import durable

# Report parameters.
TOP_FLIGHTS = 1500
TRACK_SECONDS = 60
DENSITY_SECONDS = 600
STEEPEST = 20
LOW_ALTITUDE, HIGH_ALTITUDE = 3000, 8000
SQUAWK_KINDS = {"7500": "hijack", "7600": "radio", "7700": "emergency"}
KIND_ORDER = ["hijack", "emergency", "radio", "steep"]

KEYS = ["icao24", "callsign"]


def airborne(states: DataFrame, region: str) -> DataFrame:
    """Flying aircraft inside the report box of a region."""
    box = region_box(region, REPORT_BOXES)
    return states.filter(in_box(F.col("latitude"), F.col("longitude"), box) & ~F.col("on_ground"))


def named(states: DataFrame) -> DataFrame:
    return states.filter(F.trim("callsign") != "").withColumn("callsign", F.trim("callsign"))


def resampled(states: DataFrame) -> DataFrame:
    """One averaged point per flight and minute."""
    bucket = time_bucket(F.col("time_position"), TRACK_SECONDS).alias("minute")
    return states.groupBy(*KEYS, bucket).agg(
        F.min(F.unix_timestamp("time_position")).alias("ts"),
        settle(F.avg("latitude"), 4).alias("lat"),
        settle(F.avg("longitude"), 4).alias("lon"),
        settle(F.avg("geo_altitude"), 0).alias("alt"),
        settle(F.avg("velocity"), 0).alias("vel"),
    )


def track(points: DataFrame, fields: list[str]) -> DataFrame:
    """Points of each flight as one array in time order; a flight has at most one point per minute."""
    ordered = F.sort_array(F.collect_list(F.struct("ts", *fields)))
    return points.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("t0"), F.max("ts").alias("t1"), ordered.alias("points")
    )


def prism(states: DataFrame, region: str, top: int = TOP_FLIGHTS) -> DataFrame:
    """Tracks of the flights with most observations in the region.

    The flights to keep are ``top`` rows; Spark sends them to all tasks if they are below its threshold, and the
    observations are reduced to minutes before any other shuffle.
    """
    seen = named(airborne(states, region))
    counts = seen.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("pts"))
    keep = counts.orderBy(F.desc("pts"), *KEYS).limit(top).select(*KEYS)
    return track(resampled(seen.join(keep, KEYS, "left_semi")), ["lat", "lon", "alt", "vel"])


def altitude_bands(col: Column) -> dict[str, Column]:
    """Low, middle and high band; an unknown altitude counts as high, as in the density report."""
    return {
        "c0": col < LOW_ALTITUDE,
        "c1": (col >= LOW_ALTITUDE) & (col < HIGH_ALTITUDE),
        "c2": ~F.coalesce(col < HIGH_ALTITUDE, F.lit(False)),
    }


def density(states: DataFrame, region: str, cell_degrees: float = 0.5) -> DataFrame:
    """Distinct aircraft per grid cell, ten minutes and altitude band."""
    cells = airborne(states, region).select(
        grid_cell(F.col("latitude"), F.col("longitude"), cell_degrees).alias("cell"),
        time_bucket(F.col("time_position"), DENSITY_SECONDS).alias("tb"), "icao24", "geo_altitude",
    )
    return distinct_per_band(cells, ["cell", "tb"], "icao24", altitude_bands(F.col("geo_altitude"))).drop("total")


def curve(states: DataFrame, region: str) -> DataFrame:
    """Distinct aircraft per ten minutes, in total and per known altitude band."""
    seen = airborne(states, region).select(
        time_bucket(F.col("time_position"), DENSITY_SECONDS).alias("tb"), "icao24", "geo_altitude"
    )
    alt = F.col("geo_altitude")
    bands = {**altitude_bands(alt), "c2": alt >= HIGH_ALTITUDE}
    return distinct_per_band(seen, ["tb"], "icao24", bands)


def flight_flags(states: DataFrame, region: str) -> DataFrame:
    """Per flight: emergency codes seen, steepest vertical rate, first emergency time."""
    emergency = F.col("squawk").isin(list(SQUAWK_KINDS))
    flags = [F.max(F.when(F.col("squawk") == code, 1).otherwise(0)).alias(f"e{code[:2]}") for code in SQUAWK_KINDS]
    return named(airborne(states, region)).groupBy(*KEYS).agg(
        *flags,
        F.max(F.abs("vertical_rate")).alias("max_vr"),
        F.min(F.when(emergency, F.unix_timestamp("time_position"))).alias("t_emerg"),
    )


def anomalies(states: DataFrame, region: str, steepest: int = STEEPEST) -> DataFrame:
    """Flights with an emergency code or among the steepest, with kind, label and track.

    The steepest are found by a top-k, not by ranking all flights in one task.
    """
    flags = flight_flags(states, region)
    top = flags.orderBy(F.desc_nulls_last("max_vr"), *KEYS).limit(steepest)
    coded = flags.filter((F.col("e75") == 1) | (F.col("e76") == 1) | (F.col("e77") == 1))
    # Written once: it is joined twice below, and would scan all states again each time.
    chosen = durable(coded.unionByName(top).distinct())
    seen = named(airborne(states, region)).join(chosen.select(*KEYS), KEYS, "left_semi")
    tracks = track(resampled(seen), ["lat", "lon", "alt"])
    rate = F.coalesce(settle(F.col("max_vr"), 1), F.lit(0.0))
    kind = (
        F.when(F.col("e77") == 1, SQUAWK_KINDS["7700"])
        .when(F.col("e76") == 1, SQUAWK_KINDS["7600"])
        .when(F.col("e75") == 1, SQUAWK_KINDS["7500"])
        .otherwise("steep")
    )
    label = (
        F.when(F.col("kind") == "emergency", "7700 · general emergency")
        .when(F.col("kind") == "radio", "7600 · radio failure")
        .when(F.col("kind") == "hijack", "7500 · unlawful interference")
        .otherwise(F.concat(F.lit("steep · "), F.round("max_vr", 0).cast("bigint").cast("string"), F.lit(" m/s vertical")))
    )
    joined = chosen.withColumn("max_vr", rate).withColumn("kind", kind).withColumn("label", label).join(tracks, KEYS)
    return joined.select(*KEYS, "kind", "label", "max_vr", "t_emerg", "n", "points")


def severity() -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KIND_ORDER]), F.col("kind"))


def anomaly_order() -> list[Column]:
    """Report order: by severity, then steepest first."""
    return [severity(), F.desc("max_vr"), F.col("icao24"), F.col("callsign")]


def live_figures(states: DataFrame) -> DataFrame:
    """Aircraft, mean altitude in feet, top speed in knots and countries of the flying aircraft with a position."""
    flying = states.filter(F.col("longitude").isNotNull() & F.col("latitude").isNotNull() & ~F.col("on_ground"))
    return flying.agg(
        F.count(F.lit(1)).alias("n_aircraft"),
        F.round(settle(F.avg(F.coalesce("geo_altitude", F.lit(0.0))), 6) * 3.28084, 0).alias("mean_altitude_ft"),
        F.round(F.max(F.coalesce("velocity", F.lit(0.0))) * 1.944, 0).alias("top_speed_kt"),
        F.countDistinct("origin_country").alias("n_countries"),
    )

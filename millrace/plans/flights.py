"""Flight tables: cleaning rules, regional tables, summary, report artifacts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.geo import REPORT_BOXES
from millrace.functions.times import within_clock
from millrace.operators import tracks
from millrace.operators.aggregates import dense_curve
from millrace.operators.quality import DROP, enforce, expect, expect_all
from millrace.operators.relational import tag_longitude_bands
from millrace.sinks.artifacts import write_json_gz, write_manifest

RULES = [
    *expect_all({
        "position set": "latitude IS NOT NULL AND longitude IS NOT NULL",
        "latitude in range": "latitude BETWEEN -90 AND 90",
        "longitude in range": "longitude BETWEEN -180 AND 180",
        "aircraft known": "icao24 IS NOT NULL",
    }, DROP),
    expect("plausible altitude", "geo_altitude IS NULL OR geo_altitude BETWEEN -500 AND 50000"),
    expect("valid track", "true_track IS NULL OR (true_track >= 0 AND true_track < 360)"),
]


def slice_of_day(states: DataFrame, start: str = "12:00", end: str = "12:15") -> DataFrame:
    return states.filter(within_clock(F.col("time_position"), start, end))


def clean(states: DataFrame, observation=None) -> DataFrame:
    return enforce(states, RULES, observation)


def regional_summary(states: DataFrame) -> DataFrame:
    """Rows, aircraft and mean altitude per longitude band, from one pass; overlaps count in both bands."""
    return tag_longitude_bands(states, "longitude").groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("icao24").alias("n_aircraft"),
        F.avg("geo_altitude").alias("mean_altitude"),
    )


def write_regions(states: DataFrame, root: str) -> None:
    """The three regional tables, ``band=<name>`` below ``root``, from one pass; a state where bands overlap is in both.

    The rebalance hint lets Spark split a region that has most of the rows.
    """
    tagged = tag_longitude_bands(clean(states), "longitude")
    tagged.hint("rebalance", "band").write.mode("overwrite").partitionBy("band").parquet(root)


def read_region(spark: SparkSession, root: str, band: str) -> DataFrame:
    """One of the regional tables; only its folder is read, and a region without states is empty."""
    return spark.read.parquet(root).filter(F.col("band") == band).drop("band")


def write_report(spark: SparkSession, states: DataFrame, root: str, regions: Sequence[str] = tuple(REPORT_BOXES)) -> None:
    """All artifacts of the regions, then the manifest."""
    entries = {}
    for region in regions:
        curve = dense_curve(tracks.curve(states, region), "tb", ["total", "c0", "c1", "c2"])
        day = F.floor(F.col("tb") * tracks.DENSITY_SECONDS / 86400).cast("bigint")
        parts = {
            "prism": (tracks.prism(states, region), tracks.KEYS, None),  # a fixed number of flights
            "density": (tracks.density(states, region), ["tb", "cell"], day),  # cells of the region times ten minutes of a day
            "curve": (curve, ["tb"], None),
            "anomaly": (tracks.anomalies(states, region).filter("n >= 2"), tracks.anomaly_order(), tracks.severity()),
        }
        for name, (df, order, piece) in parts.items():
            path = f"{root}/{region}/{name}"
            write_json_gz(df, path, order, piece)
            entries[f"{region}/{name}"] = path
    write_manifest(spark, f"{root}/manifest", entries)

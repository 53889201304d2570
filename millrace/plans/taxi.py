"""Taxi job: drop trips without distance, flag dear short rides, weekly means, rides to look at."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import settle
from millrace.operators.quality import enforce, expect_or_drop

RULES = [expect_or_drop("valid_distance", "trip_distance > 0.0")]


def valid_trips(trips: DataFrame, observation=None) -> DataFrame:
    return enforce(trips, RULES, observation).withColumn("week", F.date_trunc("week", "pickup_time").cast("date"))


def flagged_rides(trips: DataFrame, dear: float = 50.0, short: float = 5.0) -> DataFrame:
    same_zip = F.col("pickup_zip") == F.col("dropoff_zip")
    is_dear = F.col("fare_amount") > dear
    return trips.filter((same_zip & is_dear) | ((F.col("trip_distance") < short) & is_dear)).select(
        "week", F.col("pickup_zip").alias("zip"), "fare_amount", "trip_distance"
    )


def weekly_stats(trips: DataFrame) -> DataFrame:
    return trips.groupBy("week").agg(
        settle(F.avg("fare_amount"), 2).alias("avg_amount"), settle(F.avg("trip_distance"), 3).alias("avg_distance")
    )


def rides_to_check(flagged: DataFrame, stats: DataFrame, k: int = 3) -> DataFrame:
    """The dearest flagged rides beside the means of their week.

    The top rows are taken first: a left join on the unique week neither adds
    nor removes rides, so only ``k`` rows are joined.
    """
    order = [F.desc("fare_amount"), F.asc("trip_distance"), F.asc("zip"), F.asc("week")]
    return flagged.orderBy(*order).limit(k).join(stats, "week", "left")

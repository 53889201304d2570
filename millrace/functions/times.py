"""Date, time and bucket expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_bucket(ts: Column, seconds: int) -> Column:
    """Number of the fixed-width bucket since the epoch."""
    return F.floor(F.unix_timestamp(ts) / seconds).cast("bigint")


def bucket_start(bucket: Column, seconds: int) -> Column:
    return F.timestamp_seconds(bucket * seconds)


def notice_time(text: Column) -> Column:
    """Notice header time such as ``Thu 11 Apr 24 21:12:43 UT``; other text gives null."""
    body = F.regexp_extract(text, r"(\d{1,2} [A-Za-z]{3} \d{2} \d{2}:\d{2}:\d{2})", 1)
    return F.try_to_timestamp(body, F.lit("d MMM yy HH:mm:ss"))


def us_time(text: Column) -> Column:
    """``MM-dd-yyyy HH:mm:ss`` text; other text gives null."""
    return F.try_to_timestamp(text, F.lit("MM-dd-yyyy HH:mm:ss"))


def within_clock(ts: Column, start: str, end: str) -> Column:
    """True when the time of day lies in [start, end), both ``HH:mm``."""
    minute = F.hour(ts) * 60 + F.minute(ts)
    low, high = (int(t[:2]) * 60 + int(t[3:]) for t in (start, end))
    return (minute >= low) & (minute < high)


def since(ts: Column, as_of: Column, days: int = 0, hours: int = 0) -> Column:
    """True for times not older than the given span before ``as_of``."""
    return ts >= as_of - F.make_dt_interval(F.lit(days), F.lit(hours))


def age_text(ts: Column, as_of: Column) -> Column:
    """How long ago, in words: just now, minutes, hours, days."""
    seconds = F.floor((F.unix_millis(as_of) - F.unix_millis(ts)) / 1000)
    minutes, hours, days = (F.floor(seconds / n).cast("bigint") for n in (60, 3600, 86400))

    def worded(number: Column, unit: str) -> Column:
        return F.concat(number.cast("string"), F.lit(f" {unit}"), F.when(number > 1, "s").otherwise(""), F.lit(" ago"))

    return (
        F.when(seconds < 60, "just now")
        .when(minutes < 60, F.concat(minutes.cast("string"), F.lit(" min ago")))
        .when(hours < 24, worded(hours, "hour"))
        .otherwise(worded(days, "day"))
    )

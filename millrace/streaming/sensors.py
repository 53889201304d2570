"""Keyed state over sensor readings: running mean, trend, counts and alerts.

Only hot readings are remembered.  The mean is over the remembered readings before the current one and the current one, counted
once; the trend compares with the latest remembered reading.  The state is kept by Spark's state operator, per city, or per city and
slice of event time: then a large city is many keys, which any number of tasks share, and ``with_earlier_slices`` adds what
the slices before hold.  A call of the operator costs the same for one reading as for hundreds, so many small cities can be dealt to
buckets: a key of the operator is then a bucket, whose state has an entry for each of its cities.  Readings of one key and micro-batch
are handled by city and in time order, whatever the pieces they arrive in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.windows import join_on
from millrace.session import ROCKSDB

# Alert limits.
LIMITS = {"temperature": 25.0, "humidity": 80.0, "co2_level": 1000.0, "pm25_level": 35.0}
UNITS = {"temperature": "°C", "humidity": "%", "co2_level": "ppm", "pm25_level": "µg/m³"}
TITLES = {"temperature": "temperature", "humidity": "humidity", "co2_level": "co2_level", "pm25_level": "pm25_level"}

READING_SCHEMA = (
    "sensor_id string, city string, location string, timestamp timestamp, temperature double, humidity double, "
    "co2_level double, pm25_level double"
)
SLICE = "slice"
BUCKET = "bucket"
#: Readings of a bucket, of all slices together, where their number is known beforehand.
BUCKET_ROWS = 20_000
#: The state needs a store with column families; Spark's default store has none, and a caller's session may have kept it.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
#: Settings under which a query with a time to live ends when its input does.
DRAINING = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}
#: The slice of readings without a time, within the operator.
NO_TIME = -(1 << 62)
COLUMNS = [f.split()[0] for f in READING_SCHEMA.split(", ")]
#: The figures before a reading: hot readings, their sum, and the latest of them.
BEFORE_SCHEMA = "n bigint, total double, last_time timestamp, last_temp double"
NOTHING = (0, 0.0, None, None)
OUTPUT_SCHEMA = f"{READING_SCHEMA}, {SLICE} bigint, {BEFORE_SCHEMA}"


def alert_text(col=F.col) -> Column:
    """One sentence per exceeded limit, each ended by a semicolon; empty when all is well."""
    parts = [
        F.when(col(name) > limit, F.concat(F.lit(f"High {TITLES[name]} alert: "), col(name).cast("string"), F.lit(f" {UNITS[name]};")))
        for name, limit in LIMITS.items()
    ]
    return F.concat_ws("", *parts)


class HotReadings(StatefulProcessor):
    """Every reading with the hot ones that its city had before within the key: their number, sum, and the latest.

    The state is a list of one entry of fixed size per city of the key that had hot readings.  With ``ttl_ms`` it is a list of the hot
    readings instead, each forgotten so many milliseconds after the batch that brought it; Spark takes that time from the batch, so a
    repeated batch gives the same.  With ``closing``, a timer on event time forgets a slice once the watermark is past its end.
    """

    def __init__(self, hot: float, slice_seconds: int | None, ttl_ms: int | None, closing: bool):
        self.hot, self.slice_seconds, self.ttl_ms, self.closing = hot, slice_seconds, ttl_ms, closing

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        if self.ttl_ms is None:
            self.figures = handle.getListState("figures", f"city string, {BEFORE_SCHEMA}")
        else:
            self.hot_list = handle.getListState("hot", "city string, time timestamp, temperature double", self.ttl_ms)

    def _before(self) -> dict[str | None, tuple]:
        """(n, total, last_time, last_temp) of every city in the state."""
        if self.ttl_ms is None:
            return {city: tuple(known) for city, *known in self.figures.get()} if self.figures.exists() else {}
        out: dict[str | None, tuple] = {}
        for city, t, x in self.hot_list.get() if self.hot_list.exists() else ():
            n, total, last_time, last_temp = out.get(city, NOTHING)
            # The later of equal times is the one that came later.
            if not pd.isna(t) and (last_time is None or t >= last_time):
                last_time, last_temp = t, x
            out[city] = n + 1, total + x, last_time, last_temp
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # A key's readings of one batch: choose slices and buckets that a task can hold.
        frame = pd.concat(list(rows), ignore_index=True)
        codes, cities = pd.factorize(frame["city"], use_na_sentinel=False)
        order = _in_order(frame, codes)
        frame, city = frame.take(order).reset_index(drop=True), codes[order]
        cities = [None if pd.isna(c) else c for c in cities]
        known = self._before()
        start_n, start_total, start_time, start_temp = zip(*[known.get(c, NOTHING) for c in cities])
        start_time = pd.to_datetime(pd.Series(start_time, dtype=object)).to_numpy("datetime64[ns]")
        start_temp = np.array(start_temp, float)
        # The places of the first and the last reading of every city, and of its city's first for every reading.
        first = np.flatnonzero(np.concatenate([[True], city[1:] != city[:-1]]))
        last = np.concatenate([first[1:], [len(city)]]) - 1
        begin = np.repeat(first, last - first + 1)
        time, temperature = frame["timestamp"].to_numpy("datetime64[ns]"), frame["temperature"].to_numpy(float)
        hot = temperature > self.hot
        counted = np.cumsum(hot)
        counted -= (counted - hot)[begin]
        values = np.where(hot, temperature, 0.0)
        # Each city by itself, so that no other city's values round its sums.
        summed = np.concatenate([np.cumsum(v) for v in np.split(values, first[1:])])
        # Only a hot reading with a time can be the latest; a late one counts, but an earlier one stays the latest.
        latest = np.maximum.accumulate(np.where(hot & ~np.isnat(time) & ~(time < start_time[city]), np.arange(len(city)), -1))
        before = np.concatenate([[-1], latest[:-1]])
        own = before >= begin
        frame["n"] = np.array(start_n)[city] + counted - hot
        frame["total"] = np.array(start_total, float)[city] + summed - values
        frame["last_time"] = np.where(own, time[before], start_time[city])
        frame["last_temp"] = np.where(own, temperature[before], start_temp[city])
        if hot.any():
            if self.ttl_ms is None:
                for at in last[counted[last] > 0]:
                    c, new = city[at], latest[at]
                    newest = (frame["timestamp"].iat[new].to_pydatetime(), float(temperature[new])) if new >= begin[at] else known.get(cities[c], NOTHING)[2:]
                    known[cities[c]] = int(start_n[c] + counted[at]), float(start_total[c] + summed[at]), *newest
                self.figures.put([(c, *figures) for c, figures in known.items()])
            else:
                self.hot_list.appendList([
                    (cities[c], None if pd.isna(t) else t.to_pydatetime(), float(x)) for c, t, x in zip(city[hot], frame["timestamp"][hot], temperature[hot])
                ])
        if self.closing and key[1] != NO_TIME:
            self.handle.registerTimer(int((key[1] + 1) * self.slice_seconds * 1000))
        yield frame.drop(columns=BUCKET, errors="ignore")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.figures.clear()
        return iter([])


def _in_order(frame: pd.DataFrame, city: np.ndarray) -> np.ndarray:
    """The rows by city and in time order: those without a time last, equal times by sensor, then by the other columns, nulls first."""
    time, sensor = frame["timestamp"], pd.factorize(frame["sensor_id"], sort=True)[0]
    keys = [city, time.isna(), time.to_numpy("datetime64[ns]").view("int64"), sensor < 0, sensor, pd.factorize(frame["location"], sort=True)[0]]
    for c in COLUMNS:
        if c not in ("city", "timestamp", "sensor_id", "location"):
            numbers = frame[c].to_numpy(float)
            keys += [~np.isnan(numbers), np.where(np.isnan(numbers), 0.0, numbers)]
    return np.lexsort(keys[::-1])


def buckets_for(rows: int) -> int:
    """The number of buckets for so many readings."""
    return rows // BUCKET_ROWS + 1


def slice_of(slice_seconds: int | None) -> Column:
    """The slice of event time of a reading; null without a time, one for all where there are no slices."""
    if slice_seconds is None:
        return F.lit(0).cast("bigint")
    return F.floor(F.unix_micros("timestamp") / (slice_seconds * 1_000_000)).cast("bigint")


def hot_before(
    readings: DataFrame, hot: float = LIMITS["temperature"], slice_seconds: int | None = None, ttl_ms: int | None = None, lateness: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """The stream of readings with their slice and the figures before them in their city and slice.

    With ``buckets`` the operator's keys are so many buckets of cities, times the slices; without, every city is a key.  A checkpoint
    keeps its number of buckets.
    Start the query with the settings ``STATE_STORE``.  ``lateness`` sets a watermark: slices behind it are forgotten, and readings
    behind it dropped.  With ``ttl_ms`` Spark would run batches without input for ever; start a query that shall drain with the
    settings ``DRAINING``.
    """
    if lateness is not None and (slice_seconds is None or ttl_ms is not None):
        raise ValueError("a lateness needs slices, and no time to live beside it")
    columns = [f.split()[:2] for f in READING_SCHEMA.split(", ")]
    # A value that is not a number is a missing one.
    typed = readings.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if t == "double" else F.col(c).cast(t).alias(c) for c, t in columns])
    if lateness is not None:
        typed = typed.withWatermark("timestamp", lateness)
    mode = "EventTime" if lateness is not None else "ProcessingTime" if ttl_ms is not None else "None"
    # No null among the numbers of the key: pandas would make the whole column floats, which the state cannot tell from null.
    sliced = typed.withColumn(SLICE, F.coalesce(slice_of(slice_seconds), F.lit(NO_TIME)))
    if buckets is None:
        keyed = sliced.groupBy("city", SLICE)
    else:
        keyed = sliced.withColumn(BUCKET, F.pmod(F.hash("city"), F.lit(buckets))).groupBy(BUCKET, SLICE)
    out = keyed.transformWithStateInPandas(HotReadings(hot, slice_seconds, ttl_ms, lateness is not None), OUTPUT_SCHEMA, "Append", mode)
    return out.withColumn(SLICE, F.when(F.col(SLICE) != NO_TIME, F.col(SLICE)))


def figures(before: DataFrame, hot: float = LIMITS["temperature"]) -> DataFrame:
    """Mean, trend, hot count and alert text of every reading from the figures before it."""
    temp, last = F.col("temperature"), F.col("last_temp")
    trend = F.when(temp > last, "rising").when(temp < last, "falling").otherwise("stable")
    count = F.col("n") + F.coalesce(temp > hot, F.lit(False)).cast("bigint")
    return before.select(
        *COLUMNS, ((F.col("total") + temp) / (F.col("n") + 1)).alias("avg_temp"), trend.alias("temperature_trend"),
        count.alias("high_temp_count"), alert_text().alias("alerts"),
    )


def monitor(readings: DataFrame, hot: float = LIMITS["temperature"], ttl_ms: int | None = None) -> DataFrame:
    """The stream of readings with running figures per city and alert text."""
    return figures(hot_before(readings, hot, ttl_ms=ttl_ms), hot)


def with_earlier_slices(before: DataFrame, hot: float = LIMITS["temperature"]) -> DataFrame:
    """A written table of ``hot_before``, with the hot readings of all earlier slices of the city added to each reading.

    Slices are summed up with partial sums before the shuffle, and there is one row per city and slice to put in order, so a large
    city costs no more than its slices.  Readings without a time come after all others.
    """
    is_hot = F.coalesce(F.col("temperature") > hot, F.lit(False))
    timed = F.when(is_hot & F.col("timestamp").isNotNull(), F.struct(F.col("timestamp").alias("time"), F.col("sensor_id").alias("sensor"), F.col("temperature").alias("temp")))
    sums = before.groupBy("city", SLICE).agg(
        F.count_if(is_hot).alias("n"), F.sum(F.when(is_hot, F.col("temperature")).otherwise(0.0)).alias("total"), F.max(timed).alias("last")
    )
    earlier = Window.partitionBy("city").orderBy(F.col(SLICE).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        "city", SLICE, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_n"), F.coalesce(F.sum("total").over(earlier), F.lit(0.0)).alias("_total"),
        F.last("last", True).over(earlier).alias("_last"),
    )
    own = F.col("last_time").isNotNull()
    return join_on(before, carried, ["city", SLICE]).select(
        *COLUMNS, SLICE, (F.col("n") + F.col("_n")).alias("n"), (F.col("total") + F.col("_total")).alias("total"),
        F.when(own, F.col("last_time")).otherwise(F.col("_last.time")).alias("last_time"),
        F.when(own, F.col("last_temp")).otherwise(F.col("_last.temp")).alias("last_temp"),
    )


def rate_readings(spark, rows_per_second: int = 200, cities: int = 64, partitions: int = 8) -> DataFrame:
    """Readings from the rate source, spread over cities; the values follow from the row number."""
    rows = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).option("numPartitions", partitions).load()
    swing = F.sin(F.col("value") / 10)
    return rows.select(
        F.concat(F.lit("sensor-"), (F.col("value") % (cities * 4)).cast("string")).alias("sensor_id"),
        F.concat(F.lit("city-"), (F.col("value") % cities).cast("string")).alias("city"),
        F.lit("site").alias("location"), "timestamp", (22 + 8 * swing).alias("temperature"),
        (60 + 30 * swing).alias("humidity"), (800 + 400 * swing).alias("co2_level"), (25 + 20 * swing).alias("pm25_level"),
    )

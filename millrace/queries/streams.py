"""Streams over the supplied tables, drained to written tables and read back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions.values import settle
from millrace.operators import quality as Q
from millrace.operators.windows import join_on
from millrace.queries.aggregates import SLACK, rank_sql, with_ranks
from millrace.queries.changes import IS_DELETE, SCD1, SEQUENCE
from millrace.queries.registry import query, rounded, stream, table
from millrace.session import scratch_path
from millrace.sources import files
from millrace.streaming import latency, runs, sensors, windows


def events_stream(spark, d):
    return stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_to_table", "SRC-02 SRC-05 STR-04 SNK-12", "SELECT event_id, user_id, event_type FROM events WHERE value > 25")
def stream_to_table(spark, d):
    root = scratch_path(spark, "stream")
    big = stream(spark, d, "events").filter("value > 25").select("event_id", "user_id", "event_type")
    runs.drain_to_parquet(big, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


@query("stream_reads_new_files", "SRC-02 SRC-08 SNK-12", """
SELECT run, count(*) AS n FROM (SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END AS run FROM events) GROUP BY 1
""")
def stream_reads_new_files(spark, d):
    root = scratch_path(spark, "increments")
    e = table(spark, d, "events")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for run, part in ((1, e.filter(early)), (2, e.filter(~early))):
        part.write.mode("append").parquet(f"{root}/in")
        source = spark.readStream.schema(e.schema).parquet(f"{root}/in").select("event_id", F.lit(run).alias("run"))
        runs.drain_to_parquet(source, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").groupBy("run").agg(F.count(F.lit(1)).alias("n"))


@query("trigger_types", "STR-12 STR-13 STR-14", """
SELECT 'availableNow' AS trigger_type, count(*) AS n FROM events UNION ALL SELECT 'processingTime', count(*) FROM events
""")
def trigger_types(spark, d):
    root = scratch_path(spark, "triggers")
    parts = []
    for kind, interval in (("availableNow", None), ("processingTime", "0 seconds")):
        # Each query has its own checkpoint, so both see all rows.
        writer = stream(spark, d, "events").select("event_id").writeStream.format("parquet").option("path", f"{root}/{kind}")
        query_run = writer.option("checkpointLocation", f"{root}/checkpoints/{kind}").trigger(**runs.trigger_of(interval)).start()
        runs.until_idle(query_run)
        parts.append(spark.read.parquet(f"{root}/{kind}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("trigger_type"), "n"))
    return parts[0].union(parts[1])


@query("sliding_window_stream", "STR-01 STR-02 STR-03 JOB-10", f"""
WITH w AS (SELECT unnest([0, 6, 12, 18]) AS back, ts, value FROM events),
p AS (SELECT TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * (CAST(floor((epoch(ts) - epoch(TIMESTAMP '2024-01-01')) / 21600) AS BIGINT) * 6 - back) AS s, value FROM w)
SELECT s AS window_start, s + INTERVAL 1 DAY AS window_end, count(*) AS n, {rounded('avg(value)', 4)} AS mean_value, min(value) AS min_value, max(value) AS max_value
FROM p GROUP BY 1, 2 HAVING s + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND
""")
def sliding_window_stream(spark, d):
    root = scratch_path(spark, "windows")
    stats = windows.sliding_stats(events_stream(spark, d), "ts", "value", "1 day", "6 hours", "10 seconds")
    runs.drain_to_parquet(stats, f"{root}/out", f"{root}/checkpoint")
    out = spark.read.parquet(f"{root}/out")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("running_totals_stream", "AGG-11 STR-03", f"""
SELECT user_id, count(*) AS n, {rounded('sum(value)', 2)} AS total FROM events GROUP BY 1
""")
def running_totals_stream(spark, d):
    root = scratch_path(spark, "totals")
    totals = [F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")]
    store = windows.running_totals(spark, events_stream(spark, d), ["user_id"], totals, f"{root}/out", f"{root}/checkpoint", 8)
    return store.read().select("user_id", "n", F.round("total", 2).alias("total"))


@query("stream_static_join", "JN-02 JOB-02", """
SELECT event_id, c_name, c_mktsegment FROM events JOIN customer ON user_id = c_custkey
""")
def stream_static_join(spark, d):
    root = scratch_path(spark, "lookup")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    joined = windows.enrich_stream(stream(spark, d, "events").select("event_id", "user_id"), c, "user_id")
    runs.drain_to_parquet(joined.drop("user_id"), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


@query("change_stream_scd1", "CDC-01 CDC-02 STR-16", SCD1)
def change_stream_scd1(spark, d):
    root = scratch_path(spark, "changes")
    feed = stream(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value")
    store = windows.stream_changes(spark, feed, ["user_id"], SEQUENCE, f"{root}/out", f"{root}/checkpoint", IS_DELETE, buckets=8)
    return store.read().select("user_id", "event_type", "value")


@query("stream_expectations", "DQ-02 SNK-13 SRC-27", """
SELECT 'kept' AS what, count(*) FILTER (value <= 100 AND event_type != 'error') AS n FROM events
UNION ALL SELECT 'failed: small', count(*) FILTER (value > 100) FROM events
UNION ALL SELECT 'failed: no error', count(*) FILTER (event_type = 'error') FROM events UNION ALL SELECT 'rows', count(*) FROM events
""")
def stream_expectations(spark, d):
    root = scratch_path(spark, "rules")
    rules = [Q.expect_or_drop("small", "value <= 100"), Q.expect_or_drop("no error", "event_type != 'error'")]
    checked = Q.enforce(stream(spark, d, "events"), rules, "quality")
    run = runs.drain_to_parquet(checked, f"{root}/out", f"{root}/checkpoint")
    counts = spark.createDataFrame(list(runs.observed(run, "quality").items()), "what string, n bigint")
    kept = spark.read.parquet(f"{root}/out").agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("what"), "n")
    return kept.union(counts)


def readings(df):
    """Events as sensor readings: the user is the city."""
    v = F.col("value")
    k = F.get_json_object("props", "$.k").cast("double")
    return df.select(
        F.col("event_id").cast("string").alias("sensor_id"), F.col("user_id").cast("string").alias("city"), F.col("event_type").alias("location"),
        F.col("ts").cast("timestamp").alias("timestamp"), v.alias("temperature"), k.alias("humidity"), (v * 10).alias("co2_level"), (k / 2).alias("pm25_level"),
    )


@query("stateful_alerts", "STR-06 STR-07 STR-08 JOB-09", """
WITH r AS (SELECT CAST(user_id AS VARCHAR) AS city, value AS t, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k FROM events)
SELECT city, count(*) AS n, count(*) FILTER (t > 25) AS hot, count(*) FILTER (t > 25 OR k > 80 OR t * 10 > 1000 OR k / 2 > 35) AS alerted,
  count(*) FILTER (k / 2 > 35) AS dusty FROM r GROUP BY city
""")
def stateful_alerts(spark, d):
    """State per city: figures and alerts are complete as they leave the stream."""
    root = scratch_path(spark, "sensors")
    with runs.settings(spark, sensors.STATE_STORE):
        runs.drain_to_parquet(sensors.monitor(readings(stream(spark, d, "events"))), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").groupBy("city").agg(
        F.count(F.lit(1)).alias("n"), F.max("high_temp_count").alias("hot"), F.count_if(F.col("alerts") != "").alias("alerted"),
        F.count_if(F.col("alerts").contains("pm25")).alias("dusty"),
    )


@query("stateful_readings", "STR-06 STR-08", f"""
WITH r AS (SELECT event_id, CAST(user_id AS VARCHAR) AS city, ts, value AS t, value > 25 AS hot FROM events),
w AS (
  SELECT event_id, city, t, hot, count(*) FILTER (hot) OVER all_so_far AS high_temp_count, coalesce(sum(t) FILTER (hot) OVER earlier, 0) AS total,
    count(*) FILTER (hot) OVER earlier AS n, last_value(CASE WHEN hot THEN t END IGNORE NULLS) OVER earlier AS previous
  FROM r WINDOW all_so_far AS (PARTITION BY city ORDER BY ts, CAST(event_id AS VARCHAR) ROWS UNBOUNDED PRECEDING),
    earlier AS (PARTITION BY city ORDER BY ts, CAST(event_id AS VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT event_id, city, {rounded('(total + t) / (n + 1)', 4)} AS avg_temp, high_temp_count,
  CASE WHEN t > previous THEN 'rising' WHEN t < previous THEN 'falling' ELSE 'stable' END AS temperature_trend FROM w
""")
def stateful_readings(spark, d):
    """Mean, trend and count of every reading; the state is kept per city and week, so a hot city is many keys, in buckets of small cities."""
    root = scratch_path(spark, "readings")
    # Here events without a time come after all others and are remembered too: at the end of the times that pandas can hold.
    timed = readings(stream(spark, d, "events")).withColumn("timestamp", F.coalesce("timestamp", F.lit("2262-04-11").cast("timestamp")))
    before = sensors.hot_before(timed, slice_seconds=7 * 86400, buckets=sensors.buckets_for(table(spark, d, "events").count()))
    with runs.settings(spark, sensors.STATE_STORE):
        runs.drain_to_parquet(before, f"{root}/out", f"{root}/checkpoint")
    out = sensors.figures(sensors.with_earlier_slices(spark.read.parquet(f"{root}/out")))
    return out.select(
        F.col("sensor_id").cast("bigint").alias("event_id"), "city", settle(F.col("avg_temp"), 4).alias("avg_temp"),
        F.col("high_temp_count").cast("bigint").alias("high_temp_count"), "temperature_trend",
    )


@query("alert_texts", "STR-07", """
SELECT event_id, CASE WHEN t > 25 THEN 'High temperature alert: ' || t || ' °C;' ELSE '' END || CASE WHEN k > 80 THEN 'High humidity alert: ' || k || ' %;' ELSE '' END
  || CASE WHEN t * 40 > 1000 THEN 'High co2_level alert: ' || (t * 40) || ' ppm;' ELSE '' END || CASE WHEN k / 2 > 35 THEN 'High pm25_level alert: ' || (k / 2) || ' µg/m³;' ELSE '' END AS alerts
FROM (SELECT event_id, floor(value * 4) / 4 AS t, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k FROM events)
""")
def alert_texts(spark, d):
    """All four sentences; temperatures in quarters of a degree, so that every engine writes their digits alike."""
    quarters = F.floor(F.col("temperature") * 4) / 4
    shown = readings(table(spark, d, "events")).withColumn("temperature", quarters).withColumn("co2_level", F.col("temperature") * 40)
    return shown.select(F.col("sensor_id").cast("bigint").alias("event_id"), sensors.alert_text().alias("alerts"))


def stored_latencies(spark, d):
    """Sketches of a stream of events, one batch a week; an event reaches the sink as many milliseconds late as its value says."""
    root = scratch_path(spark, "latencies")
    e = table(spark, d, "events")
    weeks = e.select("event_type", F.col("ts").cast("timestamp").alias("source_ts"), F.col("value").cast("bigint").alias("late"), F.date_trunc("week", "ts").alias("week"))
    # One row per week: as long as the calendar.
    numbered = weeks.select("week").distinct().withColumn("batch_id", (F.row_number().over(Window.orderBy("week")) - 1).cast("bigint"))
    for week in [r.week for r in numbered.orderBy("week").collect()]:
        # A week arrives, and a run of the stream takes it as one batch.
        weeks.filter(F.col("week") == F.lit(week)).drop("week").write.mode("append").parquet(f"{root}/in")
        source = files.stream_table(spark, f"{root}/in")
        sunk = source.select(F.col("event_type").alias("trigger_type"), "source_ts", F.timestamp_add("MILLISECOND", F.col("late").cast("int"), "source_ts").alias("sink_ts"))
        runs.drain_batches(sunk, latency.store_latencies(sunk, f"{root}/sketches", size=256), f"{root}/checkpoint", "append")
    rows = weeks.join(numbered, "week").select(F.col("event_type").alias("trigger_type"), "batch_id", F.col("late").alias("latency"))
    return spark.read.parquet(f"{root}/sketches").drop("part"), rows


LATE = """(SELECT event_type AS trigger_type, dense_rank() OVER (ORDER BY date_trunc('week', ts)) - 1 AS batch_id, CAST(floor(value) AS BIGINT) AS latency FROM events)"""


def daily_latencies(spark, d):
    """Sketches of a stream of events, a week at a time, by type and day: the day is the batch, the value the latency; and the rows."""
    root = scratch_path(spark, "latencies")
    e = table(spark, d, "events").withColumn("week", F.date_trunc("week", "ts"))
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("batch_id")
    # One week per round: as many as the calendar has.
    for week in [r.week for r in e.select("week").distinct().orderBy("week").collect()]:
        e.filter(F.col("week").eqNullSafe(F.lit(week))).select("event_type", "ts", "value").write.mode("append").parquet(f"{root}/in")
        source = files.stream_table(spark, f"{root}/in")
        sunk = source.select(F.col("event_type").alias("trigger_type"), day, F.col("value").alias("latency"))
        runs.drain_batches(sunk, latency.store_latencies(sunk, f"{root}/sketches", size=256), f"{root}/checkpoint", "append")
    rows = e.select(F.col("event_type").alias("trigger_type"), day, F.col("value").alias("latency"))
    return spark.read.parquet(f"{root}/sketches").drop("part"), rows


PER_BATCH = f"""
SELECT event_type AS trigger_type, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS batch_id, {rounded('avg(value)', 4)} AS mean_latency,
  quantile_disc(value, 0.5) AS p50_latency, quantile_disc(value, 0.95) AS p95_latency, quantile_disc(value, 0.99) AS p99_latency,
  CAST(dense_rank() OVER (PARTITION BY event_type ORDER BY date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))) AS INT) AS batch_no
FROM events GROUP BY 1, 2, event_type, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))
"""


@query("latency_per_batch", "STR-11 WIN-05 AGG-15", PER_BATCH)
def latency_per_batch(spark, d):
    return latency.latency_per_batch(*daily_latencies(spark, d), SLACK).drop("n")


@query("latency_comparison", "STR-11 AGG-17 SET-03", rank_sql("latency", "trigger_type", f"(SELECT trigger_type, latency FROM {LATE} WHERE batch_id >= 2)"))
def latency_comparison(spark, d):
    """Sketches of two tables in one, without the first two batches."""
    sketches, rows = stored_latencies(spark, d)
    figures = latency.compare_trigger_types([sketches.filter("trigger_type = 'click'"), sketches.filter("trigger_type != 'click'")])
    return with_ranks(rows.filter("batch_id >= 2"), figures, ["trigger_type"], "latency")


@query("progress_figures", "STR-09 STR-10 SRC-27", """
WITH w AS (SELECT date_trunc('week', ts) AS week, user_id FROM events)
SELECT count(DISTINCT week) AS batches, count(*) AS input_rows, (SELECT CAST(sum(n) AS BIGINT) FROM (SELECT count(DISTINCT user_id) AS n FROM w GROUP BY week)) AS state_updates,
  count(DISTINCT user_id) AS state_rows, count(DISTINCT week) AS timed FROM w
""")
def progress_figures(spark, d):
    """One batch per week of events, counted per user: updates, input, state and times of every batch, from the recorded updates."""
    root = scratch_path(spark, "progress")
    weeks = table(spark, d, "events").select("user_id", F.date_trunc("week", "ts").alias("week"))
    weeks.repartition("week").write.partitionBy("week").parquet(f"{root}/in")
    source = files.stream_table(spark, f"{root}/in", files_per_batch=1)
    counted = source.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    with runs.settings(spark, {"spark.sql.shuffle.partitions": "2"}):
        run = runs.drain_batches(counted, lambda batch, _: batch.write.format("noop").mode("overwrite").save(), f"{root}/checkpoint")
    figures = runs.parse_progress(runs.updates_of(run))
    state = runs.state_operators(figures)
    return figures.agg(
        F.count_distinct("batchId").alias("batches"), F.sum("numInputRows").alias("input_rows"),
        F.count_if((F.col("work_ms") >= 0) & (F.col("trigger_ms") >= F.col("work_ms"))).alias("timed"),
    ).select(
        "batches", "input_rows", "timed", state.agg(F.sum("numRowsUpdated")).scalar().alias("state_updates"),
        state.agg(F.max("numRowsTotal")).scalar().alias("state_rows"),
    )


@query("interval_runs", "STR-14 STR-09", """
WITH e AS (SELECT count(DISTINCT date_trunc('week', ts)) AS batches, count(*) AS n FROM events)
SELECT millis, batches, n AS input_rows, batches - 1 AS intervals FROM e, (VALUES (500), (1000)) i(millis)
""")
def interval_runs(spark, d):
    """Two queries that run on at their own interval, a week's file at a time, until all are in, then stopped.

    Batches begin at whole multiples of the interval, or at once if the one before took longer: ``intervals`` counts those that began
    in a later interval than the one before, which is all but the first, however slow the machine.
    """
    root = scratch_path(spark, "intervals")
    weeks = table(spark, d, "events").select("event_id", F.date_trunc("week", "ts").alias("week"))
    weeks.repartition("week").write.partitionBy("week").parquet(f"{root}/in")
    out = None
    for millis in (500, 1000):
        source = files.stream_table(spark, f"{root}/in", files_per_batch=1)
        writer = source.writeStream.format("parquet").option("path", f"{root}/out/{millis}").outputMode("append")
        with runs.Running(writer, f"{root}/checkpoints/{millis}", f"{millis} milliseconds") as run:
            run.query.processAllAvailable()
        if run.error is not None:
            raise RuntimeError(run.error)
        at = F.unix_millis(F.to_timestamp(F.get_json_object("value", "$.timestamp")))
        begun = run.updates().filter(F.get_json_object("value", "$.numInputRows").cast("bigint") > 0).select("batch_id", at.alias("at"))
        # One row per batch of a run.
        number = F.floor(F.col("at") / millis)
        later = begun.withColumn("later", number > F.lag(number).over(Window.orderBy("batch_id")))
        apart = F.count_if(F.col("later"))
        counts = later.agg(F.count(F.lit(1)).alias("batches"), apart.alias("intervals"))
        written = spark.read.parquet(f"{root}/out/{millis}").agg(F.count(F.lit(1))).scalar()
        one = counts.select(F.lit(millis).alias("millis"), "batches", written.alias("input_rows"), "intervals")
        out = one if out is None else out.union(one)
    return out


@query("loan_datasets", "JOB-02 DQ-01 DQ-02 DQ-03 STR-16 SRC-27 SNK-13", """
WITH n AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey WHERE CAST(left(o_orderpriority, 1) AS INT) < 5),
g AS (SELECT *, coalesce(o_totalprice - 100000 > 0 AND CASE WHEN c_acctbal > 500 THEN c_acctbal END > 0, false) AS good FROM n)
SELECT 'cleaned' AS dataset, count(*) FILTER (good) AS n FROM g UNION ALL SELECT 'quarantined', count(*) FILTER (NOT good) FROM g
UNION ALL SELECT 'by_cost_center', (SELECT count(DISTINCT c_mktsegment) FROM g WHERE good)
UNION ALL SELECT 'dropped', count(*) FILTER (NOT good) FROM g
""")
def loan_datasets(spark, d):
    from millrace.plans import loans
    from millrace.plans.datasets import Datasets
    from millrace.queries.jobs import loan_transactions, treatments

    root = scratch_path(spark, "loans")
    landing = f"{root}/landing"
    loan_transactions(spark, d).write.json(landing)
    schema = loan_transactions(spark, d).schema
    ref = treatments(spark, d)
    sets = Datasets(spark, f"{root}/tables")

    # Defined from last to first: reading a dataset refreshes it before its reader.
    @sets.materialized_view("by_cost_center")
    def by_cost_center():
        return loans.balances_by_cost_center(sets.read("cleaned"))

    @sets.table("cleaned", rules=loans.RULES)
    def cleaned():
        return sets.read_stream("new")

    @sets.table("quarantined")
    def quarantined():
        return loans.quarantined(sets.read_stream("new"))

    @sets.view("new")
    def new():
        return loans.enriched(sets.read_stream("raw"), ref)

    @sets.table("raw")
    def raw():
        return spark.readStream.schema(schema).json(landing)

    sets.refresh()
    names = ["cleaned", "quarantined", "by_cost_center"]
    counts = [sets.read(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("dataset"), "n") for n in names]
    dropped = sets.rule_metrics().filter("rule = 'positive balance'").select(F.lit("dropped").alias("dataset"), F.col("failed").alias("n"))
    out = dropped
    for c in counts:
        out = out.union(c)
    return out


@query("booking_datasets", "JOB-03 CDC-01 STR-16", """
SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type != 'error'
""")
def booking_datasets(spark, d):
    from millrace.plans.datasets import Datasets

    sets = Datasets(spark, scratch_path(spark, "bookings"))

    @sets.table("updates")
    def updates():
        return stream(spark, d, "events").select("user_id", "event_id", "event_type", "value")

    sets.apply_changes("current", "updates", ["user_id"], ["event_id"], IS_DELETE, buckets=8)
    sets.refresh("current")
    return sets.read("current").select("user_id", "event_type", "value")


@query("window_means_by_type", "STR-02 STR-05", f"""
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, {rounded('avg(value)', 4)} AS mean_value FROM events GROUP BY 1, 2 HAVING CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM events)
""")
def window_means_by_type(spark, d):
    root = scratch_path(spark, "daily")
    with runs.settings(spark, {"spark.sql.shuffle.partitions": "4"}):
        stats = windows.sliding_stats(events_stream(spark, d), "ts", "value", "1 day", "1 day", "10 seconds", ["event_type"])
        runs.drain_to_parquet(stats, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").select(F.to_date("window_start").alias("day"), "event_type", "n", settle(F.col("mean_value"), 4).alias("mean_value"))

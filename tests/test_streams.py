import datetime as dt
import random
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.aggregates import exact_quantiles, quantile_sketches
from millrace.operators.quality import expect, expect_or_drop, expect_or_fail
from millrace.operators.windows import join_on
from millrace.plans.datasets import Datasets
from millrace.streaming import latency, runs, sensors, windows

T0 = dt.datetime(2024, 1, 1)


def feed(spark, path, part, data, schema):
    """Write one more input file and return the stream of the folder."""
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{path}/part={part}")
    return spark.readStream.schema(schema).parquet(f"{path}/part=*")


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_late_rows_are_dropped(spark, tmp_path):
    root, schema = str(tmp_path), "ts timestamp, v double"

    def run(part, data):
        stats = windows.sliding_stats(feed(spark, f"{root}/in", part, data, schema), "ts", "v")
        runs.drain_to_parquet(stats, f"{root}/out", f"{root}/cp", 120)

    run(1, [(at(1), 1.0), (at(3), 3.0), (at(60), 9.0)])
    run(2, [(at(2), 100.0), (at(100), 1.0)])  # at(2) is behind the watermark
    got = {r.window_start.second: (r.n, r.mean_value) for r in spark.read.parquet(f"{root}/out").filter(F.col("window_end") <= F.lit(at(14))).collect()}
    assert got[0] == (2, 2.0) and got[2] == (1, 3.0)
    assert all(n <= 2 for n, _ in got.values())


def test_stream_and_batch_windows_agree(spark, tmp_path):
    schema = "ts timestamp, v double"
    data = [(at(i * 0.7), float(i)) for i in range(200)]
    stream = feed(spark, str(tmp_path / "in"), 1, data, schema)
    runs.drain_to_parquet(windows.sliding_stats(stream, "ts", "v"), str(tmp_path / "out"), str(tmp_path / "cp"), 120)
    batch = windows.sliding_stats(spark.createDataFrame(data, schema), "ts", "v")
    closed = F.col("window_end") <= F.lit(data[-1][0] - dt.timedelta(seconds=10))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(batch.filter(closed))


def test_running_totals_over_two_runs(spark, tmp_path):
    schema, root = "k string, v double", str(tmp_path)
    totals = [F.sum("v").alias("total")]
    for part, data in ((1, [("a", 1.0), ("b", 2.0)]), (2, [("a", 5.0)])):
        stream = feed(spark, f"{root}/in", part, data, schema)
        table = windows.running_totals(spark, stream, ["k"], totals, f"{root}/out", f"{root}/cp", buckets=2)
    assert rows(table.read(), "k", "total") == [("a", 6.0), ("b", 2.0)]


def test_change_stream_over_two_runs(spark, tmp_path):
    schema, root = "k string, seq int, op string, v int", str(tmp_path)
    late_old = [("a", 1, "U", 1), ("b", 9, "U", 9)]
    for part, data in ((1, [("a", 2, "DELETE", None), ("b", 1, "U", 1)]), (2, late_old)):
        stream = feed(spark, f"{root}/in", part, data, schema)
        table = windows.stream_changes(spark, stream, ["k"], ["seq"], f"{root}/out", f"{root}/cp", "op = 'DELETE'", ["op"], 2)
    # The old upsert of a comes after its delete and must not bring it back.
    assert rows(table.read(), "k", "v") == [("b", 9)]


def reading(city, second, temp, humidity=50.0, co2=400.0, pm=10.0):
    return (f"s{second:03}", city, "site", at(second), temp, humidity, co2, pm)


def monitored(spark, root, part, data, **options):
    """One more run over one more file; all rows written so far."""
    stream = sensors.hot_before(feed(spark, f"{root}/in", part, data, sensors.READING_SCHEMA), **options)
    with runs.settings(spark, sensors.DRAINING if "ttl_ms" in options else {}):
        runs.drain_to_parquet(stream, f"{root}/out", f"{root}/cp", 180)
    return spark.read.parquet(f"{root}/out")


def test_city_monitor(spark, tmp_path):
    root = str(tmp_path)
    monitored(spark, root, 1, [reading("x", 2, 30.0), reading("x", 1, 20.0), reading("x", 3, 28.0), reading("y", 1, 10.0, pm=40.0)])
    out = sensors.figures(monitored(spark, root, 2, [reading("x", 4, 40.0, humidity=90.0, co2=1500.0), reading("x", 5, None)]))
    got = {(r.city, r.timestamp.second): r for r in out.collect()}
    facts = {k: (r.avg_temp, r.temperature_trend, r.high_temp_count) for k, r in got.items()}
    assert facts == {
        ("x", 1): (20.0, "stable", 0), ("x", 2): (30.0, "stable", 1), ("x", 3): (29.0, "falling", 2),
        ("x", 4): (pytest.approx(98 / 3), "rising", 3), ("x", 5): (None, "stable", 3), ("y", 1): (10.0, "stable", 0),
    }
    assert got[("y", 1)].alerts == "High pm25_level alert: 40.0 µg/m³;"
    assert got[("x", 4)].alerts == "High temperature alert: 40.0 °C;High humidity alert: 90.0 %;High co2_level alert: 1500.0 ppm;"
    assert got[("x", 1)].alerts == ""


def in_time_order(data):
    return sorted(data, key=lambda r: (r[3] is None, r[3] or at(0), r[0], r[2], r[4] is not None, r[4] or 0))


def plain_monitor(batches, slice_seconds=None):
    """A loop over the readings: hot ones of the city's slice in the order they came, after all of earlier slices."""
    out, seen = [], []
    key = lambda r: (r[1], None if r[3] is None or not slice_seconds else int((r[3] - dt.datetime(1970, 1, 1)).total_seconds() // slice_seconds))
    hot = lambda r: r[4] is not None and r[4] > 25
    for data in batches:
        for r in in_time_order(data):
            own = [s for s in seen if s[1] == r[1] and key(s) == key(r)]
            last = None
            for s in own:
                if hot(s) and s[3] is not None and (last is None or s[3] >= last[3]):
                    last = s
            out.append((r, own, last))
            seen.append(r)
    got = []
    for r, own, last in out:
        earlier = [s for s in seen if slice_seconds and s[1] == r[1] and key(s) != key(r) and (key(r)[1] is None or key(s)[1] is not None and key(s)[1] < key(r)[1])]
        known = [s[4] for s in own + earlier if hot(s)]
        if last is None:
            timed = [s for s in earlier if hot(s) and s[3] is not None]
            last = max(timed, key=lambda s: (s[3], s[0], s[4])) if timed else None
        t = r[4]
        trend = "stable" if t is None or last is None or t == last[4] else "rising" if t > last[4] else "falling"
        mean = None if t is None else round((sum(known) + t) / (len(known) + 1), 6)
        got.append((r[1], r[3], t, mean, trend, len(known) + hot(r)))
    return got


def noisy_batches(rng):
    out = []
    for part in (1, 2):
        data = [reading("x", rng.randrange(80 * part), rng.choice([None, 20.0, 25.0, 26.5, 30.0, 41.0])) for _ in range(300)]
        # Sensors of their own, so that no two readings tie.
        data = [(f"{r[0]}-{part}-{i:03}", *r[1:]) for i, r in enumerate(data)]
        out.append(data + [reading(None, 1, 30.0 + part), (f"s{part}", "x", "site", None, 50.0, 1.0, 1.0, 1.0)])
    return out


@pytest.mark.parametrize("slice_seconds, piece", [(None, 50), (None, 10000), (20, 50)])
def test_state_operator_equals_a_plain_loop(spark, tmp_path, slice_seconds, piece):
    """Two batches of one city, with late, missing and equal readings, in Arrow pieces that cut a key's readings."""
    batches = noisy_batches(random.Random(5))
    with runs.settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(piece), "spark.sql.execution.arrow.transformWithStateInPandas.maxRecordsPerBatch": str(piece)}):
        for part, data in enumerate(batches):
            out = monitored(spark, str(tmp_path), part, data, slice_seconds=slice_seconds)
    if slice_seconds:
        # One city, many keys, each of a bounded number of readings.
        assert out.filter("city = 'x'").groupBy("slice").count().agg(F.max("count")).first()[0] < 250
        out = sensors.with_earlier_slices(out)
    figures = sensors.figures(out).select("city", "timestamp", "temperature", F.round("avg_temp", 6), "temperature_trend", "high_temp_count")
    assert sorted(map(str, rows(figures))) == sorted(map(str, plain_monitor(batches, slice_seconds)))


@pytest.mark.parametrize("slice_seconds", [None, 20])
def test_buckets_of_cities_equal_a_plain_loop(spark, tmp_path, slice_seconds):
    """Two batches of 150 cities in two buckets, with state, late, missing and equal readings in pieces that cut a bucket's readings."""
    rng = random.Random(6)
    batches = []
    for part in (1, 2):
        data = [reading(f"c{rng.randrange(150)}", rng.randrange(80 * part), rng.choice([None, 20.0, 25.0, 26.5, 30.0, 41.0])) for _ in range(400)]
        data = [(f"{r[0]}-{part}-{i:03}", *r[1:]) for i, r in enumerate(data)]
        data += [reading(None, 1, 30.0 + part), reading("cold", 2, 20.0), reading("cold", 1, None)]
        batches.append(data + [(f"s{part}{i}", city, "site", None, 50.0 + i, 1.0, 1.0, 1.0) for i in (1, 2) for city in ("c1", "timeless")])
    piece = {"spark.sql.execution.arrow.maxRecordsPerBatch": "50", "spark.sql.execution.arrow.transformWithStateInPandas.maxRecordsPerBatch": "50"}
    with runs.settings(spark, piece):
        for part, data in enumerate(batches):
            out = monitored(spark, str(tmp_path), part, data, slice_seconds=slice_seconds, buckets=2)
    if slice_seconds:
        out = sensors.with_earlier_slices(out)
    figures = sensors.figures(out).select("city", "timestamp", "temperature", F.round("avg_temp", 6), "temperature_trend", "high_temp_count")
    assert sorted(map(str, rows(figures))) == sorted(map(str, plain_monitor(batches, slice_seconds)))


def test_readings_of_small_cities_share_keys(spark, tmp_path, monkeypatch):
    """A call of the operator takes longer than hundreds of readings, so it is not called for every city and week."""
    from millrace.queries import streams

    events = [(i, at(86400 * (i % 30)), i % 1000, "view", 20.0 + i % 10, None) for i in range(3000)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(events, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(streams, "scratch_path", lambda *_: f"{tmp_path}/run")
    assert streams.stateful_readings(spark, str(tmp_path)).count() == 3000
    updates = runs.Updates(spark, f"{tmp_path}/run/checkpoint/updates").table()
    # One bucket in five weeks or six; the cities alone would be 400.
    assert 1 <= runs.state_operators(runs.parse_progress(updates)).orderBy(F.desc("batchId")).first().numRowsTotal <= 6
    assert sensors.buckets_for(36_000_000) == 1801 and sensors.buckets_for(0) == 1


def test_sensor_queries_bring_their_state_store(spark, tmp_path):
    """A session with Spark's default state store, as one that this package did not build."""
    from millrace.queries.streams import stateful_alerts, stateful_readings

    events = [(1, at(1), 7, "view", 30.0, '{"k": 90}'), (2, at(2), 7, "view", 20.0, '{"k": 1}'), (3, at(3), 8, "view", 26.0, '{"k": 2}')]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(events, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    provider = "spark.sql.streaming.stateStore.providerClass"
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    with runs.settings(spark, {provider: default}):
        assert rows(stateful_alerts(spark, str(tmp_path))) == [("7", 2, 1, 1, 1), ("8", 1, 1, 1, 0)]
        assert rows(stateful_readings(spark, str(tmp_path)), "event_id", "avg_temp", "high_temp_count", "temperature_trend") == [
            (1, 30.0, 1, "stable"), (2, 25.0, 1, "falling"), (3, 26.0, 1, "stable")
        ]
        assert spark.conf.get(provider) == default


def test_readings_without_a_time_come_last(spark, tmp_path):
    from millrace.queries.streams import stateful_readings

    events = [(1, None, 7, "view", 40.0, None), (2, None, 7, "view", 35.0, None), (3, at(5), 7, "view", 30.0, None), (4, None, 7, "view", 36.0, None)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(events, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    assert rows(stateful_readings(spark, str(tmp_path)), "event_id", "avg_temp", "high_temp_count", "temperature_trend") == [
        (1, 35.0, 2, "rising"), (2, 35.0, 3, "falling"), (3, 30.0, 1, "stable"), (4, 35.25, 4, "rising")
    ]


def test_hot_readings_are_forgotten_after_their_time(spark, tmp_path):
    root = str(tmp_path)
    monitored(spark, root, 1, [reading("x", 1, 30.0), reading("x", 2, 40.0)], ttl_ms=3_600_000)
    kept = monitored(spark, root, 2, [reading("x", 3, 50.0)], ttl_ms=3_600_000)
    assert rows(kept.filter("temperature = 50"), "n", "total", "last_temp") == [(2, 70.0, 40.0)]
    root = str(tmp_path / "short")
    monitored(spark, root, 1, [reading("x", 1, 30.0)], ttl_ms=1)
    time.sleep(0.1)
    gone = monitored(spark, root, 2, [reading("x", 3, 50.0), reading("x", 4, 60.0)], ttl_ms=1)
    # The list is empty again; readings of one batch still count for each other.
    assert rows(gone.filter("temperature > 45"), "temperature", "n", "total", "last_temp") == [(50.0, 0, 0.0, None), (60.0, 1, 50.0, 50.0)]


def test_slices_behind_the_watermark_are_closed(spark, tmp_path):
    root = str(tmp_path)
    options = {"slice_seconds": 10, "lateness": "5 seconds"}
    for part, second in enumerate((1, 12, 23, 500)):
        out = monitored(spark, root, part, [reading("x", second, 30.0)], **options)
    assert rows(out, "slice", "n") == rows(out.selectExpr("floor(unix_seconds(timestamp) / 10)", "0L"))
    log = runs.Updates(spark, f"{root}/cp/updates").table()
    kept = runs.state_operators(runs.parse_progress(log)).orderBy(F.desc("batchId")).first()
    assert kept.numRowsTotal <= 4  # the state and the timer of the slices that are still open, not of all four
    with pytest.raises(ValueError, match="lateness"):
        sensors.hot_before(out.select(*sensors.COLUMNS), lateness="5 seconds")


def test_bounded_run_over_the_rate_source(spark, tmp_path):
    rates = sensors.rate_readings(spark, 50, 4, 2)
    writer = rates.writeStream.format("memory").queryName("rates").option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="0 seconds")
    with runs.recorded(spark, str(tmp_path / "updates")) as log, runs.settings(spark, {"spark.sql.shuffle.partitions": "2"}):
        query = writer.start()
        progress = runs.stop_after_batches(query, 2, log, timeout=120)
        assert progress.count() == 2 and not query.isActive
    figures = runs.parse_progress(progress)
    assert all(r.numInputRows > 0 and r.end_to_end_p99 is None and r.trigger_ms >= r.work_ms for r in figures.collect())
    assert spark.table("rates").filter("temperature BETWEEN 14 AND 30").count() > 0


def test_every_update_of_many_batches_is_kept(spark, tmp_path):
    """Three times as many batches as Spark remembers."""
    for i in range(300):
        (tmp_path / f"in/k={i % 3}").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"in/k={i % 3}/{i:03}.json").write_text(f'{{"v": {i}}}')
    stream = spark.readStream.schema("v int, k int").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    run = runs.drain_to_parquet(stream, str(tmp_path / "out"), str(tmp_path / "cp"), 300)
    figures = runs.parse_progress(runs.updates_of(run))
    assert figures.filter("numInputRows = 1 AND trigger_ms >= work_ms").select("batchId").distinct().count() == 300 == figures.count()
    assert len(list((tmp_path / "cp" / "updates").glob("*.json"))) >= 6
    assert run.log.lines == []


def test_running_query_shows_its_error(spark, tmp_path):
    stream = feed(spark, str(tmp_path / "in"), 1, [("a",)], "k string")
    bad = stream.select(F.raise_error("broken").cast("string").alias("k"))
    with runs.Running(bad.writeStream.format("noop"), str(tmp_path / "cp"), "1 second") as run:
        assert run.after(1, 60) is False
    assert "broken" in run.error
    good = stream.observe("seen", F.count(F.lit(1)).alias("n"))
    with runs.Running(good.writeStream.format("noop"), str(tmp_path / "cp2"), "1 second") as run:
        assert run.after(1, 60) is True
    assert run.error is None and run.metrics("seen") == {"n": 1} and run.updates().count() >= 1


def test_progress_with_latencies(spark):
    text = '{"batchId": 3, "numInputRows": 5, "latencies": {"e2eLatencyMs": {"P0": 1, "P50": 27, "P90": 48, "P95": 50, "P99": 62}}, "stateOperators": [{"operatorName": "tws", "numRowsTotal": 9}]}'
    got = runs.parse_progress(spark.createDataFrame([(text,)], "value string"))
    assert got.first().end_to_end_p99 == 62 and got.first().processing_p50 is None
    assert rows(runs.state_operators(got), "batchId", "operatorName", "numRowsTotal") == [(3, "tws", 9)]


def test_draining_in_time_or_error(spark, tmp_path):
    rates = spark.readStream.format("rate").load()
    query = rates.writeStream.format("memory").queryName("endless").option("checkpointLocation", str(tmp_path)).start()
    with pytest.raises(TimeoutError):
        runs.wait(query, 1)
    assert not query.isActive


def test_memory_and_console_sinks(spark, tmp_path, capfd):
    stream = feed(spark, str(tmp_path / "in"), 1, [("a", 1.0)], "k string, v double")
    runs.wait(runs.to_memory(stream.groupBy("k").count(), "counted"), 120)
    assert rows(spark.table("counted")) == [("a", 1)]
    runs.wait(runs.to_console(stream, str(tmp_path / "cp"), "append"), 120)
    assert runs.trigger_of("6 hours") == {"processingTime": "6 hours"}


def test_latency_tables(spark):
    data = [("mbm", b, at(0), at(0) + dt.timedelta(milliseconds=10 * b + i)) for b in range(5) for i in range(4)]
    df = latency.with_latency(spark.createDataFrame(data, "trigger_type string, batch_id int, a timestamp, b timestamp"), "a", "b")
    per = latency.latency_per_batch(quantile_sketches(df, latency.GROUP, "latency"))
    assert rows(per.filter("batch_id = 1"), "n", "p50_latency", "p99_latency", "batch_no", "mean_latency") == [(4, 11.0, 13.0, 2, 11.5)]
    both = latency.compare_trigger_types([quantile_sketches(df, latency.GROUP, "latency")])
    assert rows(both, "trigger_type", "n", "p99_latency") == [("mbm", 12, 43.0)]


def nearest_rank(values, share):
    """The smallest value that reaches the share."""
    values = sorted(values)
    return values[max(-(-len(values) * round(share * 100) // 100), 1) - 1]


@pytest.mark.parametrize("size, slack, known", [(8, 0.02, 1.0), (256, 0.02, 1.0), (256, 0.0, 1.0), (256, 0.02, 0.1)])
def test_exact_quantiles_whatever_the_sketch_says(spark, size, slack, known):
    """Groups far beyond a sketch, with ties; coarse sketches, and ones that miss most rows but tell their number."""
    rng = random.Random(3)
    data = {"a": [round(rng.expovariate(0.01), 1) for _ in range(3000)], "b": [7.0] * 500 + [rng.random() for _ in range(400)], None: [3.0, 1.0]}
    flat = [(k, v, i) for k, values in data.items() for i, v in enumerate(sorted(values))] + [("c", None, 0), ("a", None, 0)]
    df = spark.createDataFrame(flat, "k string, v double, i int").repartition(4)
    sketches = quantile_sketches(df.filter(F.col("i") < F.lit(known) * 3000), ["k"], "v", size)
    whole = quantile_sketches(df, ["k"], "v", size)
    sketches = join_on(sketches.select("k", "sketch"), whole.select("k", "n", "total"), ["k"])
    got = {r.k: tuple(r)[1:] for r in exact_quantiles(df, sketches, ["k"], "v", slack).select("k", "n", "p50_v", "p95_v", "p99_v").collect()}
    want = {k: (len(v), *[nearest_rank(v, p) for p in (0.5, 0.95, 0.99)]) for k, v in data.items()}
    assert got == {**want, "c": (None, None, None, None)}


def test_percentile_queries_return_the_percentiles(spark, tmp_path):
    """Values of groups larger than a sketch, not only their ranks; one batch a day, also for events without a time."""
    from millrace.queries.aggregates import sketched_percentiles
    from millrace.queries.streams import latency_per_batch

    rng = random.Random(4)
    events = [(kind, None if i % 50 == 0 else at(86400 * (i % 9)), rng.random() * 100) for kind in ("click", "view") for i in range(2000)]
    spark.createDataFrame(events, "event_type string, ts timestamp_ntz, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")

    def figures(values):
        return tuple(nearest_rank(values, p) for p in (0.5, 0.95, 0.99))

    kinds = {kind: figures([v for k, _, v in events if k == kind]) for kind in ("click", "view")}
    got = sketched_percentiles(spark, str(tmp_path)).select("event_type", "p50_value", "p95_value", "p99_value").collect()
    assert {r[0]: tuple(r)[1:] for r in got} == kinds
    groups = {}
    for kind, ts, v in events:
        groups.setdefault((kind, None if ts is None else (ts - T0).days), []).append(v)
    got = latency_per_batch(spark, str(tmp_path)).select("trigger_type", "batch_id", "batch_no", "p50_latency", "p95_latency", "p99_latency").collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == {(k, b, 10 if b is None else b + 1): figures(v) for (k, b), v in groups.items()}


# ---- datasets --------------------------------------------------------------


@pytest.fixture
def shop(spark, tmp_path):
    sets = Datasets(spark, str(tmp_path / "sets"))
    landing = str(tmp_path / "landing")

    def add(part, data):
        spark.createDataFrame(data, "id int, kind string, amount double").coalesce(1).write.mode("append").json(landing)

    @sets.materialized_view("totals", rules=[expect_or_drop("plus", "total > 0")])
    def totals():
        return sets.read("clean").groupBy("kind").agg(F.sum("amount").alias("total"))

    @sets.table("clean", rules=[expect("small", "amount < 100"), expect_or_drop("set", "amount IS NOT NULL")])
    def clean():
        return sets.read_stream("named")

    @sets.view("named")
    def named():
        return sets.read_stream("raw").withColumn("kind", F.upper("kind"))

    @sets.table("raw")
    def raw():
        return spark.readStream.schema("id int, kind string, amount double").json(landing)

    return sets, add


def test_datasets_run_in_order_and_incrementally(spark, shop):
    sets, add = shop
    add(1, [(1, "a", 5.0), (2, "a", None), (3, "b", 500.0), (4, "c", -1.0)])
    sets.refresh()
    assert rows(spark.read.parquet(sets.path("totals"))) == [("A", 5.0), ("B", 500.0)]
    add(2, [(5, "a", 7.0)])
    sets.refresh()
    assert rows(spark.read.parquet(sets.path("totals"))) == [("A", 12.0), ("B", 500.0)]
    got = sets.rule_metrics().groupBy("dataset", "rule").agg(F.sum("passed"), F.sum("failed"))
    assert rows(got) == [("clean", "set", 4, 1), ("clean", "small", 3, 2), ("totals", "plus", 4, 2)]


def test_datasets_at_an_interval_run_until_stopped(spark, tmp_path):
    sets = Datasets(spark, str(tmp_path / "sets"))
    landing = str(tmp_path / "landing")

    @sets.table("raw", interval="200 milliseconds", rules=[expect("small", "id < 2")])
    def raw():
        return spark.readStream.schema("id int").json(landing)

    spark.range(2).selectExpr("int(id) id").write.json(landing)
    sets.refresh("raw")
    assert rows(sets.read("raw")) == [(0,), (1,)]
    spark.range(2, 5).selectExpr("int(id) id").write.mode("append").json(landing)
    _, run = sets.running["raw"]
    run.query.processAllAvailable()
    sets.stop()
    assert sets.running == {} and sets.read("raw").count() == 5
    assert rows(sets.rule_metrics(), "dataset", "rule", "passed", "failed") == [("raw", "small", 2, 3)]


def test_dataset_errors(spark, shop):
    sets, _ = shop

    @sets.view("left")
    def left():
        return sets.read("right")

    @sets.materialized_view("right")
    def right():
        return sets.read("left")

    with pytest.raises(ValueError, match="circle"):
        sets.refresh("right")
    with pytest.raises(KeyError, match="unknown"):
        sets.refresh("nothing")
    with pytest.raises(ValueError, match="twice"):
        sets.view("left")(left)


def test_failing_rule_stops_the_refresh(spark, shop):
    sets, add = shop

    @sets.materialized_view("strict", rules=[expect_or_fail("no c", "kind != 'C'")])
    def strict():
        return sets.read("clean")

    add(1, [(1, "c", 5.0)])
    with pytest.raises(Exception, match="no c"):
        sets.refresh("strict")


def test_flows_into_a_table_and_a_sink(spark, shop):
    sets, add = shop
    add(1, [(1, "a", 5.0), (2, "b", 7.0)])
    sets.streaming_table("all")
    sets.sink("screen", "console", {"truncate": "false"}, "update")

    @sets.flow("all")
    def first():
        return sets.read_stream("raw").filter("kind = 'a'")

    @sets.flow("all", conf={"spark.sql.shuffle.partitions": "2"})
    def second():
        return sets.read_stream("raw").filter("kind = 'b'")

    @sets.flow("screen")
    def counts():
        return sets.read_stream("raw").groupBy("kind").count()

    sets.refresh("all", "screen")
    assert rows(sets.read("all"), "id") == [(1,), (2,)]


def test_change_table_in_datasets(spark, shop):
    sets, add = shop
    add(1, [(1, "a", 5.0), (1, "a", 7.0), (2, "x", 9.0)])
    sets.apply_changes("newest", "raw", ["id"], ["amount"], "kind = 'x'", buckets=2)
    sets.refresh("newest")
    assert rows(sets.read("newest")) == [(1, "a", 7.0)]
    with pytest.raises(ValueError, match="append-only"):
        sets.read_stream("newest")

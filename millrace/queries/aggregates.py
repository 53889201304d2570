"""Grouped figures and windows over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.values import settle
from millrace.operators import aggregates as A
from millrace.operators import windows as W
from millrace.queries.registry import query, rounded, table
from millrace.session import scratch_path


@query("event_counts", "AGG-01 AGG-07", "SELECT event_type, count(*) AS n FROM events GROUP BY ALL")
def event_counts(spark, d):
    table(spark, d, "events").createOrReplaceTempView("millrace_events")
    return spark.sql("SELECT event_type, count(*) AS n FROM millrace_events GROUP BY ALL")


@query("sales_stats", "AGG-02 DQ-06", f"""
SELECT l_returnflag, count(*) AS num_sales, sum(l_quantity) AS sum_quantity, {rounded('sum(l_extendedprice)', 2)} AS sum_price,
       {rounded('avg(l_extendedprice)', 2)} AS avg_price, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_suppliers
FROM lineitem GROUP BY l_returnflag HAVING sum(l_extendedprice) > 0
""")
def sales_stats(spark, d):
    from millrace.operators.quality import enforce, expect, expect_or_drop, expect_or_fail

    stats = table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("num_sales"), F.sum("l_quantity").alias("sum_quantity"),
        F.round(F.sum("l_extendedprice"), 2).alias("sum_price"), settle(F.avg("l_extendedprice"), 2).alias("avg_price"),
        F.countDistinct("l_partkey").alias("n_parts"), F.countDistinct("l_suppkey").alias("n_suppliers"),
    )
    return enforce(stats, [
        expect("has sales", "num_sales > 0"), expect_or_drop("revenue", "sum_price > 0"),
        expect_or_fail("flag known", "l_returnflag IS NOT NULL"),
    ])


@query("global_stats", "AGG-03 FN-11", """
SELECT count(*) AS num_events, count(DISTINCT user_id) AS n_entities, min(ts) AS first_ts, max(ts) AS last_ts,
       CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000) AS BIGINT) AS span_seconds FROM events
""")
def global_stats(spark, d):
    return A.span_stats(table(spark, d, "events"), "ts", "user_id")


@query("rate_by_two_keys", "AGG-04", f"""
SELECT c_mktsegment, o_orderpriority, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS finished,
       {rounded("count(*) FILTER (o_orderstatus = 'F') * 100.0e0 / count(*)", 2)} AS finished_pct
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2
""")
def rate_by_two_keys(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus")
    joined = o.join(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), F.col("c_custkey") == F.col("o_custkey"))
    return joined.groupBy("c_mktsegment", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"),
        A.rate_percent(F.col("o_orderstatus") == "F").alias("finished_pct"),
    )


@query("conditional_distinct", "AGG-05", """
SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS total,
       count(DISTINCT CASE WHEN value < 50 THEN user_id END) AS low,
       count(DISTINCT CASE WHEN value >= 50 AND value < 200 THEN user_id END) AS middle,
       count(DISTINCT CASE WHEN value >= 200 THEN user_id END) AS high
FROM events GROUP BY 1
""")
def conditional_distinct(spark, d):
    v = F.col("value")
    e = table(spark, d, "events").select(F.to_date("ts").alias("day"), "user_id", "value")
    return A.distinct_per_band(e, ["day"], "user_id", {"low": v < 50, "middle": (v >= 50) & (v < 200), "high": v >= 200})


@query("flag_aggregates", "AGG-06", """
SELECT user_id, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS has_error,
       max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS has_purchase,
       min(CASE WHEN event_type = 'error' THEN ts END) AS first_error, max(abs(value - 100)) AS max_distance
FROM events GROUP BY user_id
""")
def flag_aggregates(spark, d):
    is_error = F.col("event_type") == "error"
    return table(spark, d, "events").groupBy("user_id").agg(
        F.max(F.when(is_error, 1).otherwise(0)).alias("has_error"),
        F.max(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("has_purchase"),
        F.min(F.when(is_error, F.col("ts"))).alias("first_error"), F.max(F.abs(F.col("value") - 100)).alias("max_distance"),
    )


@query("ordinal_grouping", "AGG-08 TOP-02", f"""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderstatus, {rounded('sum(o_totalprice)', 2)} AS total
FROM orders GROUP BY 1, 2
""")
def ordinal_grouping(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("millrace_orders")
    return spark.sql("""
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderstatus, round(sum(o_totalprice), 2) AS total
        FROM millrace_orders GROUP BY 1, 2
    """)


@query("entity_summary", "AGG-09 AGG-10", f"""
SELECT o_custkey, count(*) AS num_orders, max(o_totalprice) AS max_total, {rounded('avg(o_totalprice)', 4)} AS avg_total
FROM orders GROUP BY o_custkey
""")
def entity_summary(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("num_orders"), F.max("o_totalprice").alias("max_total"),
        settle(F.avg("o_totalprice"), 4).alias("avg_total"),
    )


@query("collected_sets", "AGG-13", """
SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types,
       count(DISTINCT event_type) AS n_types FROM events GROUP BY user_id
""")
def collected_sets(spark, d):
    types = F.sort_array(F.collect_set("event_type"))
    return table(spark, d, "events").groupBy("user_id").agg(types.alias("t")).select(
        "user_id", F.array_join("t", ",").alias("types"), F.size("t").cast("bigint").alias("n_types")
    )


@query("spread_stats", "AGG-14", f"""
SELECT event_type, {rounded('stddev_samp(value)', 3)} AS sd, {rounded('avg(value)', 3)} AS mean,
       {rounded('avg(user_id)', 3)} AS mean_user FROM events GROUP BY event_type
""")
def spread_stats(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(
        settle(F.stddev_samp("value"), 3).alias("sd"), settle(F.avg("value"), 3).alias("mean"),
        settle(F.avg("user_id"), 3).alias("mean_user"),
    )


#: Share of a group's rows on either side of a quantile within which a sketch of size 256 finds it; its error is about 0.9 %.
SLACK = 0.02


def rank_sql(column: str, group: str, source: str) -> str:
    """The exact quantiles' own ranks in whole twentieths, so that a sketch with a rank error below 2 % agrees."""
    cells = ", ".join(
        f"CAST(round(20.0 * count(*) FILTER ({column} <= q{p}) / count(*)) AS INT) AS rank_p{p}" for p in (50, 95, 99)
    )
    return f"""SELECT {group}, count({column}) AS n, {rounded(f"avg({column})", 4)} AS mean, {cells} FROM {source}
JOIN (SELECT {group}, quantile_disc({column}, 0.5) AS q50, quantile_disc({column}, 0.95) AS q95, quantile_disc({column}, 0.99) AS q99 FROM {source} GROUP BY ALL) USING ({group}) GROUP BY {group}"""


def with_ranks(df, figures, group, value):
    """The figures with the true rank of each estimated quantile, in twentieths."""
    ranks = A.ranks_of(df, figures, group, value)
    cells = [F.round(F.col(f"rank_p{p}_{value}") * 20).cast("int").alias(f"rank_p{p}") for p in (50, 95, 99)]
    return W.join_on(figures, ranks, group).select(*group, "n", F.col(f"mean_{value}").alias("mean"), *cells)


@query("sketched_percentiles", "AGG-15", f"""
SELECT event_type, {rounded('avg(value)', 4)} AS mean_value, quantile_disc(value, 0.5) AS p50_value,
       quantile_disc(value, 0.95) AS p95_value, quantile_disc(value, 0.99) AS p99_value FROM events GROUP BY event_type
""")
def sketched_percentiles(spark, d):
    """Sketches of a few hundred numbers per week and type, stored, read back and merged per type; they tell which rows decide the percentiles."""
    path = scratch_path(spark, "sketches")
    e = table(spark, d, "events")
    weekly = e.withColumn("week", F.date_trunc("week", "ts"))
    A.quantile_sketches(weekly, ["event_type", "week"], "value", size=256).write.parquet(path)
    merged = A.merged_sketches(spark.read.parquet(path), ["event_type"])
    return A.exact_quantiles(e, merged, ["event_type"], "value", SLACK).drop("n")


@query("exact_p95", "AGG-15", """
SELECT event_type, quantile_disc(value, 0.95) AS quantile FROM events GROUP BY event_type
""")
def exact_p95(spark, d):
    return A.exact_quantile(table(spark, d, "events"), ["event_type"], "value", 0.95, "event_id")


@query("pivot_max", "AGG-16", """
SELECT CAST(ts AS DATE) AS day, max(CASE WHEN event_type = 'click' THEN value END) AS click,
       max(CASE WHEN event_type = 'error' THEN value END) AS error, max(CASE WHEN event_type = 'view' THEN value END) AS view
FROM events GROUP BY 1
""")
def pivot_max(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return e.groupBy("day").pivot("event_type", ["click", "error", "view"]).agg(F.max("value"))


@query("aggregate_of_aggregate", "AGG-17", f"""
WITH daily AS (SELECT event_type, CAST(ts AS DATE) AS day, max(value) AS top FROM events GROUP BY 1, 2),
     placed AS (SELECT *, dense_rank() OVER (PARTITION BY event_type ORDER BY day) AS no FROM daily)
SELECT event_type, {rounded('avg(top)', 2)} AS mean_top FROM placed WHERE no NOT IN (1, 2) GROUP BY event_type
""")
def aggregate_of_aggregate(spark, d):
    daily = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.max("value").alias("top"))
    placed = W.number_batches(daily, ["event_type"], "day", "no")
    return placed.filter("no > 2").groupBy("event_type").agg(settle(F.avg("top"), 2).alias("mean_top"))


@query("distinct_pairs", "AGG-18", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_pairs(spark, d):
    return table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query("value_share", "AGG-19", f"""
SELECT o_orderpriority, count(*) AS n, {rounded('count(*) * 100.0e0 / (SELECT count(*) FROM orders)', 4)} AS share
FROM orders GROUP BY 1
""")
def value_share(spark, d):
    return A.value_share(table(spark, d, "orders"), "o_orderpriority")


@query("peak_and_basket", "AGG-19 JOB-15", f"""
SELECT (SELECT hour(ts) FROM events GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)::INT AS peak_hour,
       {rounded('(SELECT avg(q) FROM (SELECT sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey))', 4)} AS mean_items
""")
def peak_and_basket(spark, d):
    peak = A.peak_group(table(spark, d, "events"), F.hour("ts"), "peak_hour")
    basket = A.mean_of_group_sums(table(spark, d, "lineitem"), "l_orderkey", "l_quantity")
    return peak.select("peak_hour", settle(basket.scalar(), 4).alias("mean_items"))


@query("size_estimate", "AGG-20", """
SELECT count(*) AS n_rows, CAST(round(count(*) * 288.0 / (1024 * 1024), 2) AS DOUBLE) AS size_mb FROM lineitem
""")
def size_estimate(spark, d):
    return A.size_estimate(table(spark, d, "lineitem"))


@query("minute_monitor", "AGG-21", f"""
WITH last AS (SELECT max(ts) AS newest FROM events)
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS minute, count(*) AS n, count(DISTINCT user_id) AS n_clients,
       {rounded('avg(value)', 4)} AS mean_value, {rounded('sum(value)', 2)} AS sum_value
FROM events, last WHERE ts > newest - INTERVAL 1 HOUR GROUP BY 1 ORDER BY 1 DESC LIMIT 60
""")
def minute_monitor(spark, d):
    from millrace.plans.telemetry import per_minute

    e = table(spark, d, "events").select("value", F.col("user_id").alias("client_id"), F.col("ts").cast("timestamp").alias("timestamp"))
    out = per_minute(e, "value", e.agg(F.max("timestamp")).scalar())
    return out.select(
        F.date_format("minute", "yyyy-MM-dd HH:mm").alias("minute"), "n", "n_clients",
        settle(F.col("mean_value"), 4).alias("mean_value"), F.round("sum_value", 2).alias("sum_value"),
    )


@query("client_stats", "AGG-22", """
SELECT user_id, count(*) AS event_count, min(ts) AS first_seen, max(ts) AS last_seen,
       (SELECT max(ts) FROM events) - max(ts) < INTERVAL 300 SECOND AS is_active FROM events GROUP BY user_id
""")
def client_stats(spark, d):
    e = table(spark, d, "events")
    return A.client_stats(e, "user_id", "ts", e.agg(F.max(F.col("ts").cast("timestamp"))).scalar())


@query("dense_curve", "AGG-24", """
WITH daily AS (SELECT date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS day_no, count(*) AS n FROM orders WHERE o_totalprice > 480000 GROUP BY 1)
SELECT f.day_no, coalesce(daily.n, 0) AS n FROM (SELECT unnest(generate_series(min(day_no), max(day_no))) AS day_no FROM daily) f LEFT JOIN daily ON daily.day_no = f.day_no
""")
def dense_curve(spark, d):
    day = F.date_diff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).cast("bigint")
    daily = table(spark, d, "orders").filter("o_totalprice > 480000").groupBy(day.alias("day_no")).agg(F.count(F.lit(1)).alias("n"))
    return A.dense_curve(daily, "day_no", ["n"])


@query("dictionary_ids", "AGG-25", """
WITH firsts AS (SELECT l_partkey, min(l_orderkey) AS first_order FROM lineitem GROUP BY 1)
SELECT l_partkey, row_number() OVER (ORDER BY first_order, l_partkey) - 1 AS id FROM firsts
""")
def dictionary_ids(spark, d):
    firsts = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.min("l_orderkey").alias("first_order"))
    return W.dense_ids(firsts, ["first_order", "l_partkey"]).select("l_partkey", "id")


@query("extents", "AGG-26", """
SELECT min(c_acctbal) AS min_c_acctbal, max(c_acctbal) AS max_c_acctbal, min(c_nationkey) AS min_c_nationkey, max(c_nationkey) AS max_c_nationkey FROM customer
""")
def extents(spark, d):
    return A.extents(table(spark, d, "customer"), ["c_acctbal", "c_nationkey"])


@query("value_histogram", "AGG-27", "SELECT CAST(floor(value / 50) AS BIGINT) AS bin, count(*) AS n FROM events GROUP BY 1")
def value_histogram(spark, d):
    return A.histogram(table(spark, d, "events"), "value", 50)


@query("hour_histogram", "AGG-27 FN-10", "SELECT CAST(hour(ts) AS INT) AS hour, count(*) AS n FROM events GROUP BY 1")
def hour_histogram(spark, d):
    return table(spark, d, "events").groupBy(F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


@query("dashboard_measures", "AGG-28 JOB-14", """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, sum(l_quantity) AS quantity, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers
FROM lineitem GROUP BY 1
""")
def dashboard_measures(spark, d):
    return table(spark, d, "lineitem").groupBy(F.date_trunc("month", "l_shipdate").cast("date").alias("month")).agg(
        F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("n"), F.countDistinct("l_suppkey").alias("suppliers")
    )


@query("snapshot_kpis", "AGG-29", f"""
SELECT count(*) AS n, {rounded('avg(value) * 3.28084', 2)} AS mean_ft, {rounded('max(value) * 1.94384', 2)} AS top_kt,
       count(DISTINCT event_type) AS n_types FROM events WHERE value > 0 AND event_type != 'signup'
""")
def snapshot_kpis(spark, d):
    from millrace.functions.geo import metres_to_feet, mps_to_knots

    return table(spark, d, "events").filter("value > 0 AND event_type != 'signup'").agg(
        F.count(F.lit(1)).alias("n"), settle(metres_to_feet(F.avg("value")), 2).alias("mean_ft"),
        settle(mps_to_knots(F.max("value")), 2).alias("top_kt"), F.countDistinct("event_type").alias("n_types"),
    )


# ---- windows ---------------------------------------------------------------

LATEST = """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
"""


@query("latest_per_key", "WIN-01 JOB-11", LATEST)
def latest_per_key(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return W.latest_per_key(e, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("latest_distinct_on", "WIN-02", LATEST.replace("SELECT user_id, event_id, event_type, value FROM", "SELECT DISTINCT ON (user_id) user_id, event_id, event_type, value FROM"))
def latest_distinct_on(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return W.first_row_per_key(e, ["user_id"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query("top_or_flagged", "WIN-03", """
WITH f AS (SELECT user_id, max(value) AS top, max(CASE WHEN event_type = 'error' AND value > 250 THEN 1 ELSE 0 END) AS flagged FROM events GROUP BY 1),
     r AS (SELECT *, row_number() OVER (ORDER BY top DESC NULLS LAST, user_id) AS rk FROM f)
SELECT user_id, top, flagged FROM r WHERE flagged = 1 OR rk <= 20
""")
def top_or_flagged(spark, d):
    is_big = (F.col("event_type") == "error") & (F.col("value") > 250)
    flags = table(spark, d, "events").groupBy("user_id").agg(
        F.max("value").alias("top"), F.max(F.when(is_big, 1).otherwise(0)).alias("flagged")
    )
    steepest = flags.orderBy(F.desc_nulls_last("top"), "user_id").limit(20)
    return flags.filter("flagged = 1").union(steepest).distinct()


@query("dense_rank_top", "WIN-04 JOB-14", """
SELECT week, user_id, n FROM (
  SELECT CAST(date_trunc('week', ts) AS DATE) AS week, user_id, count(*) AS n,
         dense_rank() OVER (PARTITION BY CAST(date_trunc('week', ts) AS DATE) ORDER BY count(*) DESC) AS rk
  FROM events GROUP BY 1, 2) WHERE rk = 1
""")
def dense_rank_top(spark, d):
    week = F.date_trunc("week", "ts").cast("date").alias("week")
    counts = table(spark, d, "events").groupBy(week, "user_id").agg(F.count(F.lit(1)).alias("n"))
    return W.top_ranked(counts, ["week"], "n").select("week", "user_id", "n")


@query("batch_numbers", "WIN-05", """
SELECT event_id, event_type, CAST(ts AS DATE) AS day, CAST(dense_rank() OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE)) AS INT) AS batch_no FROM events
""")
def batch_numbers(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    return W.dense_batch_number(e, ["event_type"], "day", "batch_no")


@query("lags_over_events", "WIN-06 WIN-07", f"""
SELECT event_id, lag(value, 1) OVER w AS back_1, lag(value, 7) OVER w AS back_7, lead(value, 1) OVER w AS ahead_1,
       {rounded('avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 4)} AS mean_7
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def lags_over_events(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    out = W.over_groups(e, ["user_id"], ["ts", "event_id"], lambda w: {
        "back_1": F.lag("value", 1).over(w), "back_7": F.lag("value", 7).over(w), "ahead_1": F.lead("value", 1).over(w),
        "mean_7": settle(F.avg("value").over(w.rowsBetween(-6, 0)), 4),
    }, before=7, after=1)
    return out.drop("user_id", "ts", "value")


@query("impute_group_mean", "WIN-08", f"""
SELECT event_id, {rounded('coalesce(v, avg(v) OVER (PARTITION BY user_id))', 4)} AS v
FROM (SELECT event_id, user_id, CASE WHEN event_type != 'error' THEN value END AS v FROM events)
""")
def impute_group_mean(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"))
    return W.impute_with_group_mean(e, ["user_id"], ["v"]).select("event_id", settle(F.col("v"), 4).alias("v"))


@query("even_subsample", "WIN-09 JOB-11", """
WITH tiled AS (SELECT event_id, user_id, ts, ntile(20) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS tile,
                      count(*) OVER (PARTITION BY user_id) AS total FROM events),
     firsts AS (SELECT *, row_number() OVER (PARTITION BY user_id, tile ORDER BY ts, event_id) AS rn FROM tiled)
SELECT user_id, event_id, tile FROM firsts WHERE rn = 1 OR total <= 20
""")
def even_subsample(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "ts")
    return W.even_subsample(e, ["user_id"], ["ts", "event_id"], 20).select("user_id", "event_id", "tile")


@query("even_subsample_sliced", "WIN-09", """
WITH tiled AS (SELECT event_id, event_type, ts, ntile(500) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS tile FROM events),
     firsts AS (SELECT *, row_number() OVER (PARTITION BY event_type, tile ORDER BY ts, event_id) AS rn FROM tiled)
SELECT event_type, event_id, tile FROM firsts WHERE rn = 1
""")
def even_subsample_sliced(spark, d):
    e = table(spark, d, "events").select("event_type", "event_id", "ts")
    return W.even_subsample(e, ["event_type"], ["ts", "event_id"], 500).select("event_type", "event_id", "tile")


@query("resample_tracks", "WIN-11 AGG-13 TOP-08", """
WITH hourly AS (SELECT user_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS bucket, count(*) AS n, max(value) AS top FROM events GROUP BY 1, 2)
SELECT user_id, count(*) AS n_buckets, string_agg(CAST(bucket AS VARCHAR) || '=' || CAST(n AS VARCHAR), ',' ORDER BY bucket) AS track FROM hourly GROUP BY 1
""")
def resample_tracks(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    hourly = W.resample(e, ["user_id"], "ts", 3600, [F.count(F.lit(1)).alias("n"), F.max("value").alias("top")])
    points = F.sort_array(F.collect_list(F.struct("bucket", "n")))
    text = F.transform(points, lambda p: F.concat_ws("=", p["bucket"].cast("string"), p["n"].cast("string")))
    return hourly.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_buckets"), F.array_join(text, ",").alias("track"))


@query("lag_features", "ML-01", f"""
WITH daily AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS units FROM lineitem GROUP BY 1, 2),
lagged AS (SELECT *, lag(units, 1) OVER w AS d1, lag(units, 2) OVER w AS d2, lag(units, 3) OVER w AS d3, lag(units, 7) OVER w AS d7,
  avg(units) OVER (PARTITION BY l_suppkey ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m7, lead(units, 1) OVER w AS target
  FROM daily WINDOW w AS (PARTITION BY l_suppkey ORDER BY day)),
filled AS (SELECT l_suppkey, day, units, coalesce(d1, avg(d1) OVER g) AS d1, coalesce(d2, avg(d2) OVER g) AS d2, coalesce(d3, avg(d3) OVER g) AS d3,
  coalesce(d7, avg(d7) OVER g) AS d7, coalesce(m7, avg(m7) OVER g) AS m7, target FROM lagged WINDOW g AS (PARTITION BY l_suppkey))
SELECT l_suppkey, day, units, {rounded('d1', 4)} AS units_d1, {rounded('d2', 4)} AS units_d2, {rounded('d3', 4)} AS units_d3,
  {rounded('d7', 4)} AS units_d7, {rounded('m7', 4)} AS mean_7d_units, CAST(dayofweek(day) + 1 AS INT) AS dow, target AS target_units
FROM filled WHERE d1 IS NOT NULL AND d2 IS NOT NULL AND d3 IS NOT NULL AND d7 IS NOT NULL AND m7 IS NOT NULL AND target IS NOT NULL
""")
def lag_features(spark, d):
    daily = table(spark, d, "lineitem").groupBy("l_suppkey", F.to_date("l_shipdate").alias("day")).agg(F.sum("l_quantity").alias("units"))
    out = W.lag_features(daily, ["l_suppkey"], "day", "units")
    names = ["units_d1", "units_d2", "units_d3", "units_d7", "mean_7d_units"]
    return out.select("l_suppkey", "day", "units", *[settle(F.col(n), 4).alias(n) for n in names], "dow", "target_units")


@query("global_positions", "WIN-10 AGG-25", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS position FROM orders
""")
def global_positions(spark, d):
    return W.with_positions(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), [], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")



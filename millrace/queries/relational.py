"""Projections, filters, joins, unions, top-k over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import words
from millrace.functions.times import since, within_clock
from millrace.functions.values import choose, md5_bucket, value_band
from millrace.operators import relational as R
from millrace.operators.windows import latest_per_key
from millrace.queries.registry import query, rounded, table


@query("qualified_star", "PRJ-01 PRJ-02 JN-01", """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, n_name
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def qualified_star(spark, d):
    c = table(spark, d, "customer").drop("c_acctbal")
    n = table(spark, d, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(c["*"], n.n_name)


@query("rename_and_derive", "PRJ-03 FN-01", """
SELECT s_suppkey AS supplier_id, lower(s_name) AS supplier_name, substring(s_name, 10) AS code,
       left(s_name, 8) AS head, right(s_name, 3) AS tail, replace(s_name, '#', '-') AS dashed,
       lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS padded, length(s_name) AS name_length,
       instr(s_name, '#') AS hash_at, s_name || '/' || CAST(s_nationkey AS VARCHAR) AS full_code
FROM supplier
""")
def rename_and_derive(spark, d):
    s = table(spark, d, "supplier").withColumnRenamed("s_suppkey", "supplier_id")
    return s.select(
        "supplier_id", F.lower("s_name").alias("supplier_name"), F.expr("substring(s_name, 10)").alias("code"),
        F.left("s_name", F.lit(8)).alias("head"), F.right("s_name", F.lit(3)).alias("tail"),
        F.replace("s_name", F.lit("#"), F.lit("-")).alias("dashed"),
        F.lpad(F.col("supplier_id").cast("string"), 6, "0").alias("padded"),
        F.length("s_name").cast("bigint").alias("name_length"), F.instr("s_name", "#").cast("bigint").alias("hash_at"),
        F.concat("s_name", F.lit("/"), F.col("s_nationkey").cast("string")).alias("full_code"),
    )


@query("or_of_ands", "PRJ-04", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
WHERE (l_suppkey = l_partkey AND l_extendedprice > 50000) OR (l_quantity < 5 AND l_extendedprice > 50000)
""")
def or_of_ands(spark, d):
    dear = F.col("l_extendedprice") > 50000
    return table(spark, d, "lineitem").filter(
        ((F.col("l_suppkey") == F.col("l_partkey")) & dear) | ((F.col("l_quantity") < 5) & dear)
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query("present_and_not_zero", "PRJ-05 PRJ-07", """
SELECT event_id, event_type, value FROM events
WHERE value IS NOT NULL AND value != 0 AND props != '' AND event_type NOT IN ('view', 'click')
""")
def present_and_not_zero(spark, d):
    e = table(spark, d, "events")
    return e.filter(
        F.col("value").isNotNull() & (F.col("value") != 0) & (F.col("props") != "") & ~F.col("event_type").isin("view", "click")
    ).select("event_id", "event_type", "value")


@query("bounding_box", "PRJ-06 SRC-26", """
SELECT c_custkey, c_nationkey, c_acctbal FROM customer
WHERE c_nationkey BETWEEN 5 AND 12 AND c_acctbal BETWEEN 0 AND 5000
""")
def bounding_box(spark, d):
    from millrace.functions.geo import in_box

    c = table(spark, d, "customer")
    return c.filter(in_box(F.col("c_nationkey"), F.col("c_acctbal"), (5, 12, 0, 5000))).select(
        "c_custkey", "c_nationkey", "c_acctbal"
    )


@query("text_search", "PRJ-08 PRJ-15 PRJ-16", """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE lower(c_mktsegment) LIKE '%build%' OR CAST(c_custkey AS VARCHAR) LIKE '12%'
   OR (c_custkey = 7 OR lower(c_name) = 'customer#000000011')
""")
def text_search(spark, d):
    c = table(spark, d, "customer")
    by_key = (F.col("c_custkey") == 7) | (F.lower("c_name") == "customer#000000011")
    return c.filter(
        R.contains_text(F.col("c_mktsegment"), "build") | R.number_starts_with(F.col("c_custkey"), "12")
        | R.optional_match("x", by_key)
    ).select("c_custkey", "c_name", "c_mktsegment")


@query("recent_orders", "PRJ-09 SRC-28", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 90 DAY
""")
def recent_orders(spark, d):
    o = table(spark, d, "orders")
    return o.filter(since(F.col("o_orderdate"), F.lit("2001-08-01").cast("timestamp_ntz"), days=90)).select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )


@query("latest_day_rows", "PRJ-10", """
SELECT event_id, user_id, value FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
""")
def latest_day_rows(spark, d):
    return R.latest_day(table(spark, d, "events"), "ts").select("event_id", "user_id", "value")


@query("child_summary", "PRJ-11", """
SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_children,
       (SELECT o_orderpriority FROM orders WHERE o_custkey = c_custkey ORDER BY o_orderkey LIMIT 1) AS first_o_orderpriority
FROM customer
""")
def child_summary(spark, d):
    orders = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return R.child_summary(table(spark, d, "customer").select("c_custkey"), orders, "c_custkey", "o_orderkey", "o_orderpriority")


@query("stats_row", "PRJ-12", f"""
SELECT (SELECT count(*) FROM customer) AS n_customers, (SELECT count(*) FROM orders) AS n_orders,
       (SELECT {rounded('sum(o_totalprice)', 2)} FROM orders WHERE o_orderstatus = 'F') AS finished_total,
       (SELECT count(DISTINCT s_nationkey) FROM supplier) AS n_supplier_nations,
       coalesce((SELECT sum(p_size) FROM part WHERE p_size < 0), 0)::BIGINT AS no_parts
""")
def stats_row(spark, d):
    orders = table(spark, d, "orders")
    return R.stats_row(spark, {
        "n_customers": table(spark, d, "customer").agg(F.count(F.lit(1))),
        "n_orders": orders.agg(F.count(F.lit(1))),
        "finished_total": orders.filter("o_orderstatus = 'F'").agg(F.round(F.sum("o_totalprice"), 2)),
        "n_supplier_nations": table(spark, d, "supplier").agg(F.countDistinct("s_nationkey")),
        "no_parts": table(spark, d, "part").filter("p_size < 0").agg(F.sum("p_size")),
    })


@query("case_bands", "PRJ-13 PRJ-14", """
SELECT c_custkey, CASE WHEN c_acctbal < 1000 THEN 'low' WHEN c_acctbal < 5000 THEN 'middle' ELSE 'high' END AS band,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'b' WHEN c_mktsegment = 'MACHINERY' THEN 'm' END AS segment_code,
       CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS in_debt
FROM customer
""")
def case_bands(spark, d):
    c = table(spark, d, "customer")
    codes = {"BUILDING": "b", "MACHINERY": "m"}
    return c.select(
        "c_custkey", value_band(F.col("c_acctbal"), (1000, 5000), ("low", "middle", "high")).alias("band"),
        choose([(F.col("c_mktsegment") == k, F.lit(v)) for k, v in codes.items()]).alias("segment_code"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("in_debt"),
    )


@query("nested_fields", "PRJ-17 PRJ-18 FN-08", """
SELECT event_id, user_id, event_type, value FROM events WHERE value > 100
""")
def nested_fields(spark, d):
    e = table(spark, d, "events").select(
        F.named_struct(F.lit("who"), F.struct("user_id"), F.lit("what"), F.struct("event_type", "value")).alias("data"), "event_id"
    )
    return e.filter("data.what.value > 100").select("event_id", "data.who.user_id", "data.what.*")


@query("hash_sample", "PRJ-19 PRJ-21", """
SELECT o_orderkey, CAST(('0x' || left(md5(CAST(o_orderkey AS VARCHAR)), 7)) AS BIGINT) % 5 AS bucket FROM orders
WHERE CAST(('0x' || left(md5(CAST(o_orderkey AS VARCHAR)), 7)) AS BIGINT) % 1000 < 100
""")
def hash_sample(spark, d):
    sample = R.fraction_sample(table(spark, d, "orders"), "o_orderkey", 100)
    return sample.select("o_orderkey", md5_bucket(F.col("o_orderkey"), 5).alias("bucket"))


@query("every_tenth", "PRJ-20 WIN-10", """
SELECT event_type, event_id FROM (
  SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events)
WHERE rn % 10 = 0
""")
def every_tenth(spark, d):
    e = table(spark, d, "events").select("event_type", "event_id")
    return R.every_nth(e, ["event_type"], ["event_id"], 10)


@query("longitude_bands", "PRJ-22", """
WITH placed AS (SELECT event_id, (event_id % 360) - 180 AS longitude FROM events)
SELECT event_id, 'americas' AS band FROM placed WHERE longitude BETWEEN -170 AND -30
UNION ALL SELECT event_id, 'emea' FROM placed WHERE longitude BETWEEN -30 AND 75
UNION ALL SELECT event_id, 'apac' FROM placed WHERE longitude BETWEEN 60 AND 180 OR longitude BETWEEN -180 AND -120
""")
def longitude_bands(spark, d):
    placed = table(spark, d, "events").select("event_id", (F.col("event_id") % 360 - 180).alias("longitude"))
    return R.tag_longitude_bands(placed, "longitude").select("event_id", "band")


@query("region_split", "PRJ-22 JN-07", """
SELECT r_name, count(*) AS n, count(DISTINCT n_name) AS n_nations FROM customer
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name
""")
def region_split(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    placed = table(spark, d, "customer").join(n, F.col("c_nationkey") == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return placed.groupBy("r_name").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("n_name").alias("n_nations"))


@query("noon_slice", "PRJ-23", """
SELECT event_id FROM events WHERE hour(ts) * 60 + minute(ts) >= 720 AND hour(ts) * 60 + minute(ts) < 735
""")
def noon_slice(spark, d):
    return table(spark, d, "events").filter(within_clock(F.col("ts"), "12:00", "12:15")).select("event_id")


@query("constant_lookup", "PRJ-24 SRC-22", """
WITH known(name, lat, lon) AS (VALUES ('AFRICA', 5.0::DOUBLE, 20.0::DOUBLE), ('ASIA', 40.0, 90.0), ('EUROPE', 50.0, 15.0))
SELECT n_nationkey, r_name, lat, lon FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN known ON r_name = name
""")
def constant_lookup(spark, d):
    known = spark.createDataFrame([("AFRICA", 5.0, 20.0), ("ASIA", 40.0, 90.0), ("EUROPE", 50.0, 15.0)], "r_name string, lat double, lon double")
    r = table(spark, d, "region")
    named = table(spark, d, "nation").join(r, F.col("n_regionkey") == r.r_regionkey)
    return R.lookup(named, known, "r_name").select("n_nationkey", "r_name", "lat", "lon")


@query("drop_empty_columns", "PRJ-25", """
SELECT p_partkey, p_size FROM part WHERE p_size IS NOT NULL AND p_size > 10
""")
def drop_empty_columns(spark, d):
    p = table(spark, d, "part").select(
        "p_partkey", F.when(F.col("p_size") > 10, F.col("p_size")).alias("p_size"), F.lit(None).cast("string").alias("empty")
    )
    return R.drop_columns_without_values(p).dropna(subset=["p_size"])


@query("unique_row_ids", "PRJ-26", """
SELECT count(*) AS n_rows, count(*) AS n_ids FROM part
""")
def unique_row_ids(spark, d):
    ids = R.with_row_ids(table(spark, d, "part").select("p_partkey"))
    return ids.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("row_id").alias("n_ids"))


@query("left_join_required", "JN-03 JN-13", """
SELECT c_custkey, o_orderkey AS order_id FROM customer LEFT JOIN orders ON c_custkey = o_custkey WHERE o_orderkey IS NOT NULL
""")
def left_join_required(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("order_id"))
    return R.with_left_attribute(table(spark, d, "customer").select("c_custkey"), orders, ["c_custkey"], "order_id")


@query("left_join_default", "JN-04", """
SELECT o_orderkey, CASE WHEN l.n > 0 THEN true ELSE false END AS has_returns
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) l ON o_orderkey = l_orderkey
""")
def left_join_default(spark, d):
    returned = table(spark, d, "lineitem").filter("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    joined = table(spark, d, "orders").select("o_orderkey").join(returned, "o_orderkey", "left")
    return joined.select("o_orderkey", F.coalesce(F.col("n") > 0, F.lit(False)).alias("has_returns"))


@query("anti_join_prospects", "JN-05 JN-06", """
SELECT c_custkey, c_acctbal,
       CASE WHEN c_acctbal > 7500 THEN 'Ultra' WHEN c_acctbal > 5000 THEN 'High' WHEN c_acctbal > 2500 THEN 'Affluent' ELSE 'Mass' END AS segment
FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 450000) o ON c_custkey = o_custkey WHERE o_orderkey IS NULL
""")
def anti_join_prospects(spark, d):
    orders = table(spark, d, "orders").filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    b = F.col("c_acctbal")
    band = F.when(b > 7500, "Ultra").when(b > 5000, "High").when(b > 2500, "Affluent").otherwise("Mass")
    return R.without_match(table(spark, d, "customer"), orders, "c_custkey").select("c_custkey", "c_acctbal", band.alias("segment"))


@query("left_join_chain", "JN-08", """
SELECT c.c_custkey, n_name, r_name, s.n_suppliers FROM customer c LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT s_nationkey, count(*) AS n_suppliers FROM supplier GROUP BY 1) s ON s_nationkey = c_nationkey
""")
def left_join_chain(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    s = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n_suppliers"))
    return (
        table(spark, d, "customer").join(n, F.col("c_nationkey") == n.n_nationkey, "left")
        .join(r, F.col("n_regionkey") == r.r_regionkey, "left").join(s, F.col("s_nationkey") == F.col("c_nationkey"), "left")
        .select("c_custkey", "n_name", "r_name", "n_suppliers")
    )


@query("top_group_rows", "JN-09 TOP-04", """
WITH top AS (SELECT user_id, event_type FROM events GROUP BY 1, 2 ORDER BY count(*) DESC, user_id, event_type LIMIT 25)
SELECT e.event_id, e.user_id, e.event_type FROM events e JOIN top USING (user_id, event_type)
""")
def top_group_rows(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "event_type")
    return R.only_top_groups(e, ["user_id", "event_type"], 25)


@query("self_enrichment", "JN-10", f"""
WITH weekly AS (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week, {rounded('avg(o_totalprice)', 2)} AS week_mean FROM orders GROUP BY 1)
SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS week, week_mean FROM orders
LEFT JOIN weekly ON weekly.week = CAST(date_trunc('week', o_orderdate) AS DATE) WHERE o_totalprice > 490000
""")
def self_enrichment(spark, d):
    from millrace.functions.values import settle

    o = table(spark, d, "orders").withColumn("week", F.date_trunc("week", "o_orderdate").cast("date"))
    weekly = o.groupBy("week").agg(settle(F.avg("o_totalprice"), 2).alias("week_mean"))
    return o.filter("o_totalprice > 490000").join(weekly, "week", "left").select("o_orderkey", "week", "week_mean")


@query("right_join_facts", "JN-11", """
SELECT o_orderkey, c_name FROM (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') c RIGHT JOIN orders ON c_custkey = o_custkey
""")
def right_join_facts(spark, d):
    c = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'")
    return c.join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "right").select("o_orderkey", "c_name")


@query("left_join_latest", "JN-12", """
WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
SELECT c_custkey, r.o_orderkey AS last_order FROM customer LEFT JOIN ranked r ON c_custkey = o_custkey AND r.rn = 1
""")
def left_join_latest(spark, d):
    last = latest_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    last = last.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("last_order"))
    return table(spark, d, "customer").select("c_custkey").join(last, "c_custkey", "left")


@query("feature_lookup", "JN-14", """
SELECT l.doc_id, l.quality, d.lang, d.n_chars FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id
""")
def feature_lookup(spark, d):
    from millrace.operators.features import feature_lookup as lookup

    labels = table(spark, d, "labels").select("doc_id", "quality")
    return lookup(labels, table(spark, d, "documents"), ["doc_id"], ["lang", "n_chars"])


@query("heavy_join", "JN-15 JOB-12", f"""
SELECT c_mktsegment AS segment, count(*) AS num_lines, {rounded('sum(l_extendedprice)', 2)} AS amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1
""")
def heavy_join(spark, d):
    # Each step sums before the next join, so a hot order or customer is one row per task.
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("amount")
    )
    per_customer = lines.join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey").groupBy(
        F.col("o_custkey").alias("c_custkey")
    ).agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))
    segments = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return per_customer.join(segments, "c_custkey").groupBy("segment").agg(
        F.sum("n").alias("num_lines"), F.round(F.sum("amount"), 2).alias("amount")
    )


@query("join_on_expression", "JN-16", """
SELECT e.event_id, n.n_name FROM (SELECT event_id, ' nation_' || CAST(event_id % 25 AS VARCHAR) || ' ' AS tag FROM events) e
JOIN nation n ON upper(trim(e.tag)) = n.n_name
""")
def join_on_expression(spark, d):
    tag = F.concat(F.lit(" nation_"), (F.col("event_id") % 25).cast("string"), F.lit(" "))
    e = table(spark, d, "events").select("event_id", tag.alias("tag"))
    n = table(spark, d, "nation")
    return e.join(n, F.upper(F.trim(e.tag)) == n.n_name).select("event_id", "n_name")


@query("balance_union", "SET-01", f"""
SELECT {rounded('sum(c_acctbal)', 2)} AS bal, c_nationkey AS location FROM customer GROUP BY c_nationkey
UNION SELECT {rounded('sum(s_acctbal)', 2)}, s_nationkey FROM supplier GROUP BY s_nationkey
""")
def balance_union(spark, d):
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("location")).agg(F.round(F.sum("c_acctbal"), 2).alias("bal"))
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("location")).agg(F.round(F.sum("s_acctbal"), 2).alias("bal"))
    return R.union_rows([c.select("bal", "location"), s.select("bal", "location")], distinct=True)


@query("labelled_counts", "SET-02 SET-03", """
SELECT 'orders' AS table_name, 'ALL' AS kind, count(*) AS n FROM orders
UNION ALL SELECT 'events', 'ALL', count(*) FROM events
UNION ALL SELECT 'events', event_type, count(*) FROM events GROUP BY event_type
""")
def labelled_counts(spark, d):
    frames = {
        "orders": table(spark, d, "orders").select(F.col("o_orderstatus").alias("kind")),
        "events": table(spark, d, "events").select(F.col("event_type").alias("kind")),
    }
    return R.labelled_counts(frames, "kind")


@query("top_five", "TOP-01 TOP-02", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5
""")
def top_five(spark, d):
    return table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5).select("o_orderkey", "o_totalprice")


@query("sorted_within_tasks", "TOP-03", """
SELECT c_custkey, c_acctbal FROM customer
""")
def sorted_within_tasks(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_acctbal").sortWithinPartitions(F.desc("c_acctbal"))


@query("latest_single_row", "TOP-05", """
SELECT event_id, user_id, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1
""")
def latest_single_row(spark, d):
    e = table(spark, d, "events")
    newest = F.max_by(F.struct("event_id", "user_id", "value"), F.struct("ts", "event_id")).alias("row")
    return e.agg(newest).select("row.*")


@query("newest_rows", "TOP-06", """
SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 50
""")
def newest_rows(spark, d):
    return R.newest(table(spark, d, "events"), ["ts", "event_id"], 50).select("event_id", "user_id", "event_type")


@query("custom_order_ranks", "TOP-07", """
SELECT * FROM (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, -o_totalprice, o_orderkey LIMIT 40)
""")
def custom_order_ranks(spark, d):
    severity = F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return o.orderBy(severity, F.desc("o_totalprice"), "o_orderkey").limit(40)


@query("size_text_order", "TOP-09", """
SELECT p_partkey, CAST(p_size AS VARCHAR) AS size FROM part ORDER BY CAST(p_size AS VARCHAR) DESC, p_partkey LIMIT 100
""")
def size_text_order(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("string").alias("size"))
    return p.orderBy(F.desc("size"), "p_partkey").limit(100)


@query("any_rows", "TOP-10", "SELECT least(count(*), 250) AS n, least(count(*), 250) AS known FROM orders")
def any_rows(spark, d):
    """Which rows come is not determined, so what is compared is how many, and that they are rows of the table."""
    orders = table(spark, d, "orders")
    some = orders.limit(250).select(F.col("o_orderkey").alias("key"))
    known = some.join(orders.select("o_orderkey"), F.col("key") == F.col("o_orderkey"), "left")
    return known.agg(F.count(F.lit(1)).alias("n"), F.count("o_orderkey").alias("known"))


@query("incremental_extract", "SNK-15", """
SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS watermark FROM orders
WHERE o_orderdate > TIMESTAMP '2001-01-01'
""")
def incremental_extract(spark, d):
    mark = F.lit("2001-01-01").cast("timestamp_ntz")
    return R.high_water_extract(table(spark, d, "orders"), "o_orderdate", "o_orderkey", mark).select("o_orderkey", "o_totalprice", "watermark")


@query("next_watermark", "SNK-15", """
SELECT max(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f')) AS watermark FROM orders
""")
def next_watermark(spark, d):
    mark = F.lit("1990-01-01").cast("timestamp_ntz")
    return R.next_mark(R.high_water_extract(table(spark, d, "orders"), "o_orderdate", "o_orderkey", mark))


@query("word_counts", "FN-02", """
SELECT doc_id, len(list_filter(string_split_regex(text, '\\s+'), lambda w: w != '')) AS n_words FROM documents
""")
def word_counts(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(words(F.col("text"))).cast("bigint").alias("n_words"))

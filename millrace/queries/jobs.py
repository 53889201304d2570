"""The end-to-end jobs, run over the supplied tables renamed to the shapes the jobs expect."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import geo
from millrace.functions.text import json_field
from millrace.functions.values import settle
from millrace.operators import tracks
from millrace.operators.aggregates import dense_curve
from millrace.plans import bakery, banking, bookings, customers, flights, hr, loans, notices, taxi, telemetry
from millrace.queries.registry import query, rounded, table
from millrace.queries.texts import LANGUAGE_WORDS, _count

# ---- bakery ----------------------------------------------------------------


def sales(spark, d):
    """Orders as sales: the customer is the shop, the priority the product, the status the payment method."""
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("transactionID"), F.col("o_custkey").alias("customerID"), F.col("o_custkey").alias("franchiseID"),
        F.col("o_orderdate").alias("dateTime"), F.col("o_orderpriority").alias("product"), F.lit(1).alias("quantity"),
        F.col("o_totalprice").alias("totalPrice"), F.col("o_orderstatus").alias("paymentMethod"),
    )


def franchises(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    placed = table(spark, d, "customer").join(n, F.col("c_nationkey") == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return placed.select(
        F.col("c_custkey").alias("franchiseID"), F.col("c_mktsegment").alias("district"), F.col("n_name").alias("city"),
        F.col("r_name").alias("country"), F.col("c_nationkey").alias("supplierId"), F.col("c_name").alias("size"),
    )


def ingredients(spark, d):
    s = table(spark, d, "supplier").filter("s_acctbal > 1000")
    return s.groupBy(F.col("s_nationkey").alias("supplierId")).agg(F.min("s_name").alias("ingredient"))


LOCATIONS = f"""
SELECT {rounded('sum(o_totalprice)', 2)} AS total_sales, c_mktsegment AS district, n_name AS city, r_name AS country, c_nationkey AS "supplierId"
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) GROUP BY 2, 3, 4, 5
"""


@query("flagship_locations", "JOB-01 JN-01 AGG-07 PRJ-10 DQ-02 DQ-03", LOCATIONS)
def flagship_locations(spark, d):
    return bakery.flagship_locations(sales(spark, d), franchises(spark, d))


@query("flagship_top5", "JOB-01 JN-03 TOP-01", f"""
SELECT total_sales, district, city, country, ingredient FROM ({LOCATIONS}) f
LEFT JOIN (SELECT s_nationkey, min(s_name) AS ingredient FROM supplier WHERE s_acctbal > 1000 GROUP BY 1) s ON f."supplierId" = s.s_nationkey
WHERE ingredient IS NOT NULL ORDER BY total_sales DESC, district, city, country, ingredient LIMIT 5
""")
def flagship_top5(spark, d):
    located = bakery.flagship_locations(sales(spark, d), franchises(spark, d))
    return bakery.top_flagships(located, ingredients(spark, d))


@query("bakery_sales_stats", "AGG-02 DQ-06", f"""
SELECT o_orderpriority AS product, count(*) AS num_sales, count(*) AS sum_quantity, {rounded('sum(o_totalprice)', 2)} AS sum_price,
  {rounded('avg(o_totalprice)', 2)} AS avg_price, count(DISTINCT o_custkey) AS n_customers, count(DISTINCT o_custkey) AS n_franchises
FROM orders GROUP BY 1
""")
def bakery_sales_stats(spark, d):
    return bakery.sales_stats(sales(spark, d))


@query("best_products", "JOB-15 TOP-01", f"""
SELECT o_orderpriority AS product, {rounded('sum(o_totalprice)', 2)} AS revenue FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3
""")
def best_products(spark, d):
    return bakery.best_products(sales(spark, d))


@query("store_insights", "JOB-15 AGG-19", f"""
WITH p AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)
SELECT CAST(0 AS INT) AS peak_hour, count(*) AS peak_sales, 1.0::DOUBLE AS mean_items,
  (SELECT o_orderstatus FROM p ORDER BY n DESC, 1 LIMIT 1) AS top_payment,
  {rounded('(SELECT max(n) FROM p) * 100.0e0 / count(*)', 4)} AS top_share FROM orders
""")
def store_insights(spark, d):
    return bakery.store_insights(sales(spark, d))


@query("large_purchases", "JOB-16 SRC-03", """
SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey AS tx, o_custkey AS customer FROM orders WHERE o_totalprice > 300000
""")
def large_purchases(spark, d):
    sent = bakery.large_purchases(sales(spark, d), 300_000)
    return sent.select("key", json_field(F.col("value"), "transactionID", "bigint").alias("tx"), json_field(F.col("value"), "customerID", "bigint").alias("customer"))


@query("franchises_in_city", "UDF-06 TOP-09", """
SELECT c_custkey AS "franchiseID", c_name AS size FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_7'
""")
def franchises_in_city(spark, d):
    return bakery.franchises_in(franchises(spark, d), "nation_7").select("franchiseID", "size")


# ---- loans -----------------------------------------------------------------


def loan_transactions(spark, d):
    """Orders as loan transactions: the balance may be negative, the treatment id is the priority's number."""
    c = table(spark, d, "customer")
    joined = table(spark, d, "orders").join(c, F.col("o_custkey") == c.c_custkey)
    return joined.select(
        F.col("o_orderkey").alias("id"), F.left("o_orderpriority", F.lit(1)).cast("int").alias("accounting_treatment_id"),
        (F.col("o_totalprice") - 100000).alias("balance"), F.when(F.col("c_acctbal") > 500, F.col("c_acctbal")).alias("arrears_balance"),
        F.col("c_mktsegment").alias("cost_center_code"), F.col("c_nationkey").cast("string").alias("country_code"), F.lit(2).alias("count"),
        F.date_format("o_orderdate", "MM-dd-yyyy HH:mm:ss").alias("next_payment_date"),
    )


def treatments(spark, d):
    o = table(spark, d, "orders").select("o_orderpriority").distinct()
    return o.select(F.left("o_orderpriority", F.lit(1)).cast("int").alias("id"), F.expr("substring(o_orderpriority, 3)").alias("accounting_treatment")).filter("id < 5")


def loan_history(spark, d):
    return table(spark, d, "customer").select(
        (F.col("c_nationkey") % 6).alias("accounting_treatment_id"), F.col("c_acctbal").cast("string").alias("revol_bal"), F.col("c_mktsegment").alias("addr_state")
    )


LOANS = """
new AS (SELECT o_orderkey AS id, o_totalprice - 100000 AS balance, CASE WHEN c_acctbal > 500 THEN c_acctbal END AS arrears,
               c_mktsegment AS cost_center_code, CAST(c_nationkey AS VARCHAR) AS country_code
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE CAST(left(o_orderpriority, 1) AS INT) < 5),
clean AS (SELECT * FROM new WHERE balance > 0 AND arrears > 0)
"""


@query("loan_quarantine", "JOB-02 DQ-05", f"WITH {LOANS} SELECT id, 'positive balance' AS violations FROM new WHERE NOT coalesce(balance > 0 AND arrears > 0, false)")
def loan_quarantine(spark, d):
    new = loans.enriched(loan_transactions(spark, d), treatments(spark, d))
    return loans.quarantined(new).select("id", "violations")


@query("loan_balances", "JOB-02 SET-01", f"""
WITH {LOANS}
SELECT {rounded('sum(c_acctbal)', 2)} AS bal, c_mktsegment AS location_code FROM customer WHERE c_nationkey % 6 BETWEEN 1 AND 4 GROUP BY 2
UNION SELECT {rounded('sum(balance)', 2)}, country_code FROM clean GROUP BY 2
""")
def loan_balances(spark, d):
    ref = treatments(spark, d)
    clean = loans.cleaned(loans.enriched(loan_transactions(spark, d), ref))
    return loans.total_balances(loans.historical(loan_history(spark, d), ref), clean)


@query("loan_cost_centers", "JOB-02 AGG-09", f"WITH {LOANS} SELECT cost_center_code, {rounded('sum(balance)', 2)} AS sum_balance FROM clean GROUP BY 1")
def loan_cost_centers(spark, d):
    return loans.balances_by_cost_center(loans.cleaned(loans.enriched(loan_transactions(spark, d), treatments(spark, d))))


@query("loan_countries", "JOB-02", f"WITH {LOANS} SELECT country_code, CAST(count(*) * 2 AS BIGINT) AS sum_count FROM clean GROUP BY 1")
def loan_countries(spark, d):
    return loans.counts_by_country(loans.cleaned(loans.enriched(loan_transactions(spark, d), treatments(spark, d))))


# ---- bookings, taxi, banking -----------------------------------------------


@query("booking_fraud", "JOB-03 CDC-01 JN-04 AGG-04", f"""
WITH b AS (SELECT o_custkey, CAST(left(o_orderpriority, 1) AS INT) AS party_size FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)
SELECT party_size, c_mktsegment AS payment_method, count(*) AS total_bookings, count(*) FILTER (c_acctbal < 1000) AS fraud_count,
  {rounded('count(*) FILTER (c_acctbal < 1000) * 100.0e0 / count(*)', 2)} AS fraud_rate_pct
FROM b JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
""")
def booking_fraud(spark, d):
    updates = table(spark, d, "orders").select(
        F.col("o_custkey").alias("booking_id"), F.col("o_orderkey").alias("booking_update_id"), F.left("o_orderpriority", F.lit(1)).cast("int").alias("guests_count")
    )
    c = table(spark, d, "customer").withColumnRenamed("c_custkey", "booking_id")
    flags = c.filter("c_acctbal < 2000").select(
        "booking_id", F.when(F.col("c_acctbal") < 1000, "fraud").otherwise("clear").alias("flag"),
        (F.col("c_acctbal") / 10000).alias("confidence"), F.lit("low balance").alias("reason"),
    )
    payments = c.select("booking_id", F.col("c_mktsegment").alias("payment_method"))
    return bookings.fraud_rates(bookings.with_fraud(bookings.current_bookings(updates), flags), payments)


def trips(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_shipdate").alias("pickup_time"), F.col("l_suppkey").alias("pickup_zip"), F.col("l_partkey").alias("dropoff_zip"),
        (F.col("l_extendedprice") / 1000).alias("fare_amount"), (F.col("l_quantity") - 1).alias("trip_distance"),
    )


TRIPS = """
t AS (SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS week, l_suppkey AS zip, l_partkey AS dropoff, l_extendedprice / 1000 AS fare_amount, l_quantity - 1 AS trip_distance
      FROM lineitem WHERE l_quantity - 1 > 0),
f AS (SELECT * FROM t WHERE (zip = dropoff AND fare_amount > 50) OR (trip_distance < 5 AND fare_amount > 50))
"""


@query("flagged_rides", "JOB-04 PRJ-04 DQ-02", f"WITH {TRIPS} SELECT week, zip, fare_amount, trip_distance FROM f")
def flagged_rides(spark, d):
    return taxi.flagged_rides(taxi.valid_trips(trips(spark, d)))


@query("weekly_flagged_top", "JOB-04 JN-10 AGG-08", f"""
WITH {TRIPS}, s AS (SELECT week, {rounded('avg(fare_amount)', 2)} AS avg_amount, {rounded('avg(trip_distance)', 3)} AS avg_distance FROM t GROUP BY 1)
SELECT f.week, f.zip, fare_amount, trip_distance, avg_amount, avg_distance FROM f LEFT JOIN s ON f.week = s.week
ORDER BY fare_amount DESC, trip_distance, f.zip, f.week LIMIT 3
""")
def weekly_flagged_top(spark, d):
    valid = taxi.valid_trips(trips(spark, d))
    return taxi.rides_to_check(taxi.flagged_rides(valid), taxi.weekly_stats(valid))


@query("wealth_prospects", "JOB-05 CDC-02 JN-05 PRJ-13", f"""
WITH worth AS (SELECT CAST(o_custkey AS VARCHAR) AS customer_id, {rounded('sum(o_totalprice)', 2)} AS total_net_worth FROM orders GROUP BY 1),
bank AS (SELECT CAST(user_id AS VARCHAR) AS customer_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type != 'error')
SELECT w.customer_id, total_net_worth, CASE WHEN total_net_worth > 5000000 THEN 'Ultra High Net Worth' WHEN total_net_worth > 2000000 THEN 'High Net Worth'
  WHEN total_net_worth > 1000000 THEN 'Affluent' ELSE 'Mass Affluent' END AS wealth_segment,
  {rounded('total_net_worth * 0.015e0', 0)} AS estimated_revenue, c.c_mktsegment AS campaign_name
FROM worth w LEFT JOIN bank b ON w.customer_id = b.customer_id LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = w.customer_id
WHERE b.customer_id IS NULL AND total_net_worth > 500000
""")
def wealth_prospects(spark, d):
    portfolio = table(spark, d, "orders").select(F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("portfolio_value"))
    feed = table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("customer_id"), F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", "DELETE").otherwise("UPSERT").alias("operation_type"),
    )
    campaigns = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_mktsegment").alias("campaign_name"))
    return banking.prospects(banking.net_worth(portfolio), banking.customers(feed), campaigns)


@query("rebalance", "JOB-05 AGG-12 JN-07", f"""
WITH b AS (SELECT o_custkey, avg(o_totalprice) AS avg_amount FROM orders GROUP BY 1),
j AS (SELECT b.o_custkey, o.o_orderpriority AS campaign_name, sum(avg_amount) AS cash, sum(c_acctbal * 100) AS inv
  FROM b JOIN customer ON b.o_custkey = c_custkey JOIN orders o ON o.o_custkey = b.o_custkey
  WHERE avg_amount > 2000 AND c_acctbal * 100 > 5000 GROUP BY 1, 2)
SELECT o_custkey AS customer_id, campaign_name, {rounded('cash', 2)} AS cash_position, {rounded('inv', 2)} AS investment_position,
  {rounded('cash / (cash + inv) * 100', 1)} AS cash_percentage,
  CASE WHEN cash > inv * 0.5 THEN 'Too Much Cash - Suggest Investment' WHEN cash < inv * 0.05 THEN 'Cash Poor - Suggest Liquidity Products' ELSE 'Balanced Portfolio' END AS recommendation,
  {rounded('CASE WHEN cash > inv * 0.5 THEN cash * 0.3e0 WHEN cash < inv * 0.05 THEN inv * 0.1e0 ELSE 0 END', 2)} AS suggested_amount FROM j
""")
def rebalance(spark, d):
    orders = table(spark, d, "orders").withColumnRenamed("o_custkey", "customer_id")
    summary = banking.banking_summary(orders.withColumnRenamed("o_totalprice", "amount"))
    worth = table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"), (F.col("c_acctbal") * 100).alias("total_net_worth"))
    return banking.rebalancing(summary, worth, orders.select("customer_id", F.col("o_orderpriority").alias("campaign_name")))


# ---- notices ---------------------------------------------------------------


def circulars(spark, d):
    """Documents as JSON circulars; those from one source lack a subject."""
    message = F.to_json(F.struct(
        F.lit("http://schema").alias("$schema"), F.col("source").alias("eventId"), F.col("lang").alias("submitter"),
        F.when(F.col("source") != "src0", F.concat(F.lit("Report "), F.col("doc_id").cast("string"))).alias("subject"),
        F.col("doc_id").alias("circularId"), F.col("text").alias("body"), (F.col("n_chars") * 1000).alias("createdOn"),
    ))
    return table(spark, d, "documents").select(F.col("doc_id").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"), message.alias("msg"))


CONTENT = "source || ' Report ' || doc_id || ' ' || text || ' ' || lang"


@query("circular_documents", "JOB-06 FN-01 FN-05 FN-08 DQ-02", f"""
SELECT md5({CONTENT}) AS content_id, 'https://circulars.example/' || doc_id AS file_path, doc_id || '.txt' AS file_name,
  length({CONTENT}) AS file_size, make_timestamp(n_chars * 1000000) AS modified FROM documents WHERE source != 'src0'
""")
def circular_documents(spark, d):
    docs = notices.documents(circulars(spark, d), "https://circulars.example/")
    return docs.select(
        F.md5("content").alias("content_id"), "metadata.file_path", "metadata.file_name", "metadata.file_size",
        F.col("metadata.file_modification_time").cast("timestamp_ntz").alias("modified"),
    )


_SCORES = ", ".join(f"{_count(ws)} AS s{i}" for i, ws in enumerate(LANGUAGE_WORDS.values()))
_PICK = " ".join(f"WHEN s{i} = top THEN '{label}'" for i, label in enumerate(LANGUAGE_WORDS))


@query("circular_label_counts", "JOB-06 SET-02 UDF-09", f"""
WITH c AS (SELECT {CONTENT} AS text FROM documents WHERE source != 'src0'), s AS (SELECT {_SCORES} FROM c), t AS (SELECT *, greatest(s0, s1, s2, s3) AS top FROM s),
l AS (SELECT CASE WHEN top = 0 THEN 'other' {_PICK} END AS event_class FROM t)
SELECT 'documents' AS table_name, 'ALL' AS event_class, count(*) AS n FROM l
UNION ALL SELECT 'classified_documents', 'ALL', count(*) FROM l UNION ALL SELECT 'classified_documents', event_class, count(*) FROM l GROUP BY 2
""")
def circular_label_counts(spark, d):
    docs = notices.documents(circulars(spark, d), "https://circulars.example/")
    return notices.label_counts(docs, notices.labelled(docs, LANGUAGE_WORDS))


# ---- flights ---------------------------------------------------------------


def states(spark, d):
    """Events as state vectors: user = aircraft, type = call sign, position and codes from value and payload."""
    k = F.from_json("props", "k int")["k"]
    v = F.col("value")
    squawk = F.when(k == 75, "7500").when(k == 76, "7600").when(k == 77, "7700").otherwise("1200")
    return table(spark, d, "events").select(
        F.concat(F.lit("a"), F.col("user_id").cast("string")).alias("icao24"),
        F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")).alias("callsign"),
        F.concat(F.lit("C"), (k % 40).cast("string")).alias("origin_country"),
        F.col("ts").cast("timestamp").alias("time_position"), (34 + k * 0.25).alias("latitude"), (-13 + v * 0.25).alias("longitude"),
        F.when(k != 13, v * 100).alias("geo_altitude"), (v + 100).alias("velocity"), (v - 60).alias("vertical_rate"),
        (k * 3.75).alias("true_track"), squawk.alias("squawk"), (F.col("event_type") == "signup").alias("on_ground"),
    )


STATES = """
st AS (SELECT 'a' || user_id AS icao24, upper(event_type) AS callsign, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, ts, epoch(ts) AS sec, value AS v, event_type = 'signup' AS on_ground FROM events),
sv AS (SELECT icao24, callsign, 'C' || (k % 40) AS country, ts, CAST(floor(sec) AS BIGINT) AS sec, 34 + k * 0.25e0 AS lat, -13 + v * 0.25e0 AS lon, CASE WHEN k != 13 THEN v * 100 END AS alt,
       v + 100 AS vel, v - 60 AS vr, k * 3.75e0 AS track, on_ground, CASE k WHEN 75 THEN '7500' WHEN 76 THEN '7600' WHEN 77 THEN '7700' ELSE '1200' END AS squawk FROM st),
fly AS (SELECT * FROM sv WHERE lat BETWEEN 35 AND 60 AND lon BETWEEN -12 AND 30 AND NOT on_ground)
"""
MINUTES = f"""
(SELECT s.icao24, s.callsign, sec // 60 AS minute, min(sec) AS ts, {rounded('avg(lat)', 4)} AS lat, {rounded('avg(lon)', 4)} AS lon,
 {rounded('avg(alt)', 0)} AS alt, {rounded('avg(vel)', 0)} AS vel FROM fly s JOIN %s c USING (icao24, callsign) GROUP BY 1, 2, 3)
"""


def points_text(fields):
    """Points as text: the time, then the fields with four decimals, empty when unknown."""
    def shown(p):
        return [F.coalesce(p[f].cast("decimal(18,4)").cast("string"), F.lit("")) for f in fields]

    return F.array_join(F.transform("points", lambda p: F.concat_ws(",", p["ts"].cast("string"), *shown(p))), "|")


def _point(fields):
    cells = " || ',' || ".join(f"coalesce(CAST({f} AS DECIMAL(18, 4))::VARCHAR, '')" for f in fields)
    return f"string_agg(m.ts || ',' || {cells}, '|' ORDER BY m.ts) AS track"


@query("flight_prism", "JOB-07 JN-09 WIN-11 AGG-13", f"""
WITH {STATES}, top AS (SELECT icao24, callsign FROM fly GROUP BY 1, 2 ORDER BY count(*) DESC, 1, 2 LIMIT 1500), m AS {MINUTES % 'top'}
SELECT icao24, callsign, count(*) AS n, min(ts) AS t0, max(ts) AS t1,
  {_point(['lat', 'lon', 'alt', 'vel'])} FROM m GROUP BY 1, 2
""")
def flight_prism(spark, d):
    out = tracks.prism(states(spark, d), "europe")
    return out.select("icao24", "callsign", "n", "t0", "t1", points_text(["lat", "lon", "alt", "vel"]).alias("track"))


@query("flight_density", "JOB-07 AGG-05 FN-17", f"""
WITH {STATES}
SELECT CAST(floor(lat / 0.5e0) AS BIGINT) || ':' || CAST(floor(lon / 0.5e0) AS BIGINT) AS cell, sec // 600 AS tb,
  count(DISTINCT CASE WHEN alt < 3000 THEN icao24 END) AS c0, count(DISTINCT CASE WHEN alt >= 3000 AND alt < 8000 THEN icao24 END) AS c1,
  count(DISTINCT CASE WHEN alt < 8000 THEN NULL ELSE icao24 END) AS c2 FROM fly GROUP BY 1, 2
""")
def flight_density(spark, d):
    return tracks.density(states(spark, d), "europe")


@query("flight_curve", "JOB-07 AGG-05 AGG-24", f"""
WITH {STATES}, c AS (SELECT sec // 600 AS tb, count(DISTINCT icao24) AS total, count(DISTINCT CASE WHEN alt < 3000 THEN icao24 END) AS c0,
  count(DISTINCT CASE WHEN alt >= 3000 AND alt < 8000 THEN icao24 END) AS c1, count(DISTINCT CASE WHEN alt >= 8000 THEN icao24 END) AS c2 FROM fly GROUP BY 1)
SELECT f.tb, coalesce(total, 0) AS total, coalesce(c0, 0) AS c0, coalesce(c1, 0) AS c1, coalesce(c2, 0) AS c2
FROM (SELECT unnest(generate_series(min(tb), max(tb))) AS tb FROM c) f LEFT JOIN c ON f.tb = c.tb
""")
def flight_curve(spark, d):
    return dense_curve(tracks.curve(states(spark, d), "europe"), "tb", ["total", "c0", "c1", "c2"])


@query("flight_anomalies", "JOB-07 AGG-06 WIN-03 TOP-07", f"""
WITH {STATES}, flags AS (SELECT icao24, callsign, max((squawk = '7500')::INT) AS e75, max((squawk = '7600')::INT) AS e76, max((squawk = '7700')::INT) AS e77,
  max(abs(vr)) AS max_vr, min(CASE WHEN squawk IN ('7500', '7600', '7700') THEN sec END) AS t_emerg FROM fly GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (ORDER BY max_vr DESC NULLS LAST, icao24, callsign) AS rk FROM flags),
a AS (SELECT * FROM r WHERE e75 = 1 OR e76 = 1 OR e77 = 1 OR rk <= 20), m AS {MINUTES % 'a'}
SELECT a.icao24, a.callsign, CASE WHEN e77 = 1 THEN 'emergency' WHEN e76 = 1 THEN 'radio' WHEN e75 = 1 THEN 'hijack' ELSE 'steep' END AS kind,
  {rounded('max_vr', 1)} AS max_vr, t_emerg, count(*) AS n, {_point(['lat', 'lon', 'alt'])}
FROM a JOIN m USING (icao24, callsign) GROUP BY ALL
""")
def flight_anomalies(spark, d):
    out = tracks.anomalies(states(spark, d), "europe")
    return out.select("icao24", "callsign", "kind", "max_vr", "t_emerg", "n", points_text(["lat", "lon", "alt"]).alias("track"))


@query("flight_live_figures", "AGG-29", f"""
WITH {STATES} SELECT count(*) AS n_aircraft, round(CAST({rounded('avg(coalesce(alt, 0))', 6)} * 3.28084e0 AS DECIMAL(38, 7)), 0)::DOUBLE AS mean_altitude_ft,
  round(max(vel) * 1.944e0, 0) AS top_speed_kt, count(DISTINCT country) AS n_countries FROM sv WHERE NOT on_ground
""")
def flight_live_figures(spark, d):
    return tracks.live_figures(states(spark, d))


@query("flight_regions", "JOB-08 DQ-04 PRJ-22", f"""
WITH {STATES}, c AS (SELECT * FROM sv WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180),
b AS (SELECT 'americas' AS band, * FROM c WHERE lon BETWEEN -170 AND -30 UNION ALL SELECT 'emea', * FROM c WHERE lon BETWEEN -30 AND 75
  UNION ALL SELECT 'apac', * FROM c WHERE lon BETWEEN 60 AND 180 OR lon BETWEEN -180 AND -120)
SELECT band, count(*) AS n, count(DISTINCT icao24) AS n_aircraft, {rounded('avg(alt)', 2)} AS mean_altitude FROM b GROUP BY 1
""")
def flight_regions(spark, d):
    out = flights.regional_summary(flights.clean(states(spark, d)))
    return out.withColumn("mean_altitude", settle(F.col("mean_altitude"), 2))


@query("regional_tables", "JOB-08 PRJ-22 SNK-01", f"""
WITH {STATES}, m AS (SELECT icao24, lat, lon * 7 AS x FROM sv), c AS (SELECT icao24, x - 360 * floor(x / 360) - 180 AS lon FROM m WHERE lat BETWEEN -90 AND 90)
SELECT 'americas' AS band, count(*) AS n, count(DISTINCT icao24) AS n_aircraft, min(lon) AS west, max(lon) AS east FROM c WHERE lon BETWEEN -170 AND -30
UNION ALL SELECT 'emea', count(*), count(DISTINCT icao24), min(lon), max(lon) FROM c WHERE lon BETWEEN -30 AND 75
UNION ALL SELECT 'apac', count(*), count(DISTINCT icao24), min(lon), max(lon) FROM c WHERE lon BETWEEN 60 AND 180 OR lon BETWEEN -180 AND -120
""")
def regional_tables(spark, d):
    """The regional tables as written and read back, one after the other; positions are moved so that every region has some."""
    from millrace.session import scratch_path

    root = scratch_path(spark, "regions")
    x = F.col("longitude") * 7
    flights.write_regions(states(spark, d).withColumn("longitude", x - 360 * F.floor(x / 360) - 180), root)
    out = None
    for band in geo.LONGITUDE_BANDS:
        figures = flights.read_region(spark, root, band).agg(
            F.count(F.lit(1)).alias("n"), F.countDistinct("icao24").alias("n_aircraft"), F.min("longitude").alias("west"), F.max("longitude").alias("east")
        )
        one = figures.select(F.lit(band).alias("band"), *figures.columns)
        out = one if out is None else out.union(one)
    return out


@query("flight_noon_slice", "JOB-08 PRJ-23", f"""
WITH {STATES} SELECT count(*) AS n FROM sv WHERE hour(ts) * 60 + minute(ts) >= 720 AND hour(ts) * 60 + minute(ts) < 735
""")
def flight_noon_slice(spark, d):
    return flights.slice_of_day(states(spark, d)).agg(F.count(F.lit(1)).alias("n"))


def artifact_sql(region: str) -> str:
    """Rows and a total of each artifact of a region, from the states in its box."""
    south, north, west, east = geo.REPORT_BOXES[region]
    band = "count(DISTINCT CASE WHEN alt < 3000 THEN icao24 END) AS c0, count(DISTINCT CASE WHEN alt >= 3000 AND alt < 8000 THEN icao24 END) AS c1"
    return f"""
SELECT * FROM (WITH {STATES.replace("BETWEEN 35 AND 60", f"BETWEEN {south} AND {north}").replace("BETWEEN -12 AND 30", f"BETWEEN {west} AND {east}")},
minutes AS (SELECT icao24, callsign, count(DISTINCT sec // 60) AS n, count(*) AS pts, max(abs(vr)) AS max_vr, max(CASE WHEN squawk IN ('7500', '7600', '7700') THEN 1 ELSE 0 END) AS coded FROM fly GROUP BY 1, 2),
cells AS (SELECT {band}, count(DISTINCT CASE WHEN alt < 8000 THEN NULL ELSE icao24 END) AS c2 FROM fly GROUP BY floor(lat / 0.5e0), floor(lon / 0.5e0), sec // 600),
curve AS (SELECT sec // 600 AS tb, count(DISTINCT icao24) AS total FROM fly GROUP BY 1)
SELECT '{region}/prism' AS artifact, count(*) AS n_rows, CAST(coalesce(sum(n), 0) AS BIGINT) AS total FROM (SELECT n FROM minutes ORDER BY pts DESC, icao24, callsign LIMIT 1500)
UNION ALL SELECT '{region}/density', count(*), CAST(coalesce(sum(c0 + c1 + c2), 0) AS BIGINT) FROM cells
UNION ALL SELECT '{region}/curve', coalesce(max(tb) - min(tb) + 1, 0), CAST(coalesce(sum(total), 0) AS BIGINT) FROM curve
UNION ALL SELECT '{region}/anomaly', count(*), CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT *, row_number() OVER (ORDER BY max_vr DESC NULLS LAST, icao24, callsign) AS rk FROM minutes) WHERE n >= 2 AND (coded = 1 OR rk <= 20))"""


ARTIFACTS = " UNION ALL ".join(map(artifact_sql, geo.REPORT_BOXES))


@query("flight_artifacts", "JOB-07 SNK-17 SNK-18", f"SELECT artifact, n_rows, total, true AS listed, true AS same_bytes FROM ({ARTIFACTS})")
def flight_artifacts(spark, d):
    """All artifacts of all regions, written twice from differently dealt rows: what they hold, whether the manifest lists them, whether
    every file has the same bytes in both."""
    from millrace.session import scratch_path
    from millrace.sinks import artifacts

    root = scratch_path(spark, "artifacts")
    seen = states(spark, d)
    flights.write_report(spark, seen, f"{root}/a")
    flights.write_report(spark, seen.repartition(3, "icao24"), f"{root}/b")
    points = "icao24 string, callsign string, n bigint"
    schemas = {
        "prism": (points, "n"), "density": ("cell string, tb bigint, c0 bigint, c1 bigint, c2 bigint", "c0 + c1 + c2"),
        "curve": ("tb bigint, total bigint", "total"), "anomaly": (points, "n"),
    }
    out = None
    for region in geo.REPORT_BOXES:
        for name, (schema, total) in schemas.items():
            label = f"{region}/{name}"
            held = artifacts.read_json_gz(spark, f"{root}/a/{label}", schema).agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.expr(total)), F.lit(0)).alias("total"))
            hashes = artifacts.file_hashes(spark, f"{root}/a/{label}").union(artifacts.file_hashes(spark, f"{root}/b/{label}"))
            # Every file stands twice with one length and one hash.
            same = hashes.groupBy("file", "length", "hash").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.bool_and(F.col("n") == 2), F.lit(True)))
            one = held.select(F.lit(label).alias("artifact"), "n_rows", "total", same.scalar().alias("same_bytes"))
            out = one if out is None else out.union(one)
    listed = spark.read.json(f"{root}/a/manifest", schema="artifact string, path string").select("artifact", F.col("path").endswith(F.col("artifact")).alias("listed"))
    return out.join(listed, "artifact", "full").select("artifact", "n_rows", "total", F.coalesce("listed", F.lit(False)).alias("listed"), "same_bytes")


# ---- telemetry, customers, HR ----------------------------------------------


def payloads(spark, d):
    """Events as nested device payloads; errors carry a bad time, views a bad number."""
    kind, v = F.col("event_type"), F.col("value")
    stamp = F.when(kind == "error", "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    place = F.struct(F.when(kind == "view", "NaN").otherwise(v.cast("string")).alias("latitude"), (v + 1).cast("string").alias("longitude"))
    body = F.to_json(F.struct(
        F.concat(F.lit("device-"), F.col("user_id").cast("string")).alias("clientId"), stamp.alias("timestamp"),
        F.struct(v.alias("x"), (v * 2).alias("y"), F.lit(None).cast("double").alias("z")).alias("acceleration"), place.alias("location"),
    ))
    return table(spark, d, "events").select("event_id", body.alias("payload"))


@query("device_payloads", "SNK-20 FN-14 JOB-11", """
SELECT 'device-' || user_id AS client_id, ts AS at, value AS acceleration_x, CAST(NULL AS DOUBLE) AS acceleration_z,
  CASE WHEN event_type != 'view' THEN value END AS latitude, value + 1 AS longitude FROM events WHERE event_type != 'error'
""")
def device_payloads(spark, d):
    flat = telemetry.flatten_payloads(payloads(spark, d), "payload", F.lit("2024-02-01").cast("timestamp"))
    return flat.select("client_id", F.col("timestamp").cast("timestamp_ntz").alias("at"), "acceleration_x", "acceleration_z", "latitude", "longitude")


@query("payload_counts", "SNK-20", "SELECT count(*) FILTER (event_type != 'error') AS ok, count(*) FILTER (event_type = 'error') AS failed FROM events")
def payload_counts(spark, d):
    return telemetry.ingest_counts(payloads(spark, d), "payload")


def devices(spark, d):
    return table(spark, d, "events").select(
        "event_id", F.concat(F.lit("device-"), F.col("user_id").cast("string")).alias("client_id"), F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("latitude"), (F.col("value") - 50).alias("longitude"),
    )


DEVICES = "dv AS (SELECT event_id, 'device-' || user_id AS client_id, ts, CASE WHEN event_type != 'view' THEN value END AS latitude, value - 50 AS longitude FROM events), ok AS (SELECT * FROM dv WHERE latitude != 0 AND longitude != 0)"


@query("device_locations", "WIN-01 PRJ-05 JOB-11", f"""
WITH {DEVICES} SELECT client_id, event_id, latitude, longitude FROM (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY ts DESC, event_id DESC) AS rn FROM ok) WHERE rn = 1
""")
def device_locations(spark, d):
    return telemetry.latest_locations(devices(spark, d), "event_id").drop("timestamp")


@query("device_clients", "AGG-22 JN-12 JOB-11", f"""
WITH {DEVICES}, c AS (SELECT client_id, count(*) AS event_count, max(ts) AS last_seen FROM dv GROUP BY 1),
l AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY ts DESC, event_id DESC) AS rn FROM ok)
SELECT c.client_id, event_count, last_seen, TIMESTAMP '2024-01-31' - last_seen < INTERVAL 3 HOUR AS is_active, latitude AS last_lat FROM c LEFT JOIN l ON c.client_id = l.client_id AND rn = 1
""")
def device_clients(spark, d):
    from millrace.operators.aggregates import client_stats

    e = devices(spark, d)
    at = F.lit("2024-01-31").cast("timestamp")
    last = telemetry.latest_locations(e, "event_id").select("client_id", F.col("latitude").alias("last_lat"))
    stats = client_stats(e, "client_id", "timestamp", at, 3 * 3600)
    return stats.join(last, "client_id", "left").select("client_id", "event_count", "last_seen", "is_active", "last_lat")


@query("device_totals", "AGG-22", """
SELECT count(*) AS total, count(*) FILTER (TIMESTAMP '2024-01-30 23:59:00' - last_seen < INTERVAL 300 SECOND) AS active FROM (SELECT user_id, max(ts) AS last_seen FROM events GROUP BY 1)
""")
def device_totals(spark, d):
    stats = telemetry.clients(devices(spark, d), "event_id", F.lit("2024-01-30 23:59:00").cast("timestamp"))
    return telemetry.client_totals(stats)


@query("device_recent", "TOP-06", f"WITH {DEVICES} SELECT event_id, client_id FROM ok ORDER BY ts DESC, event_id DESC LIMIT 50")
def device_recent(spark, d):
    return telemetry.recent(devices(spark, d), "event_id").select("event_id", "client_id")


@query("device_traces", "WIN-09 JOB-11", f"""
WITH {DEVICES}, t AS (SELECT *, ntile(12) OVER (PARTITION BY client_id ORDER BY ts, event_id) AS tile, count(*) OVER (PARTITION BY client_id) AS total FROM ok),
f AS (SELECT *, row_number() OVER (PARTITION BY client_id, tile ORDER BY ts, event_id) AS rn FROM t)
SELECT client_id, event_id FROM f WHERE rn = 1 OR total <= 12
""")
def device_traces(spark, d):
    return telemetry.trace(devices(spark, d), "event_id", 12).select("client_id", "event_id")


@query("customer_360", "JOB-12 JN-13 PRJ-13 FN-01", f"""
WITH o AS (SELECT o_custkey, sum(o_totalprice) AS total, count(*) AS n FROM orders GROUP BY 1)
SELECT c_custkey AS customer_id, lower(c_name) || '@example.com' AS email, {rounded('coalesce(total, 0) / greatest(coalesce(n, 0), 1)', 2)} AS avg_order_value,
  {rounded('c_custkey * 17 % 100 / 100.0e0', 2)} AS churn_risk_score, CASE WHEN c_custkey * 17 % 100 < 33 THEN 'Low' WHEN c_custkey * 17 % 100 < 66 THEN 'Medium' ELSE 'High' END AS churn_risk_band,
  p_name AS recommended_product_name, CAST(DATE '2024-01-31' - CAST(c_custkey % 90 AS INT) AS DATE) AS last_order_date
FROM customer LEFT JOIN o ON c_custkey = o_custkey LEFT JOIN part ON p_partkey = c_custkey % 12 + 1
""")
def customer_360(spark, d):
    totals = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(F.sum("o_totalprice").alias("total_sales"), F.count(F.lit(1)).alias("num_sales"))
    directory = table(spark, d, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"), F.col("c_nationkey").alias("city"), F.col("c_mktsegment").alias("segment")
    ).join(totals, "customer_id", "left").na.fill(0, ["total_sales", "num_sales"])
    products = table(spark, d, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category"), F.col("p_retailprice").alias("price")
    )
    out = customers.customer_360(directory, products, F.lit("2024-01-31").cast("date"))
    return out.select("customer_id", "email", "avg_order_value", "churn_risk_score", "churn_risk_band", "recommended_product_name", "last_order_date")


@query("sales_by_segment", "JOB-12 JN-15", f"""
SELECT c_mktsegment AS segment, CAST(count(*) AS BIGINT) AS num_events, {rounded('sum(o_totalprice)', 2)} AS amount FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1
""")
def sales_by_segment(spark, d):
    events = table(spark, d, "orders").select(F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("amount"))
    directory = table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"))
    return customers.sales_by_segment(events, directory)


def hr_tables(spark, d):
    """Customers as employees, their balance as salary, their orders as reviews."""
    c = table(spark, d, "customer").withColumnRenamed("c_custkey", "employee_id")
    employees = c.select("employee_id", F.col("c_mktsegment").alias("department"), F.lit("2015-03-01").cast("date").alias("hire_date"))
    pay = c.select(
        "employee_id", F.col("c_acctbal").alias("base_salary"), (F.col("c_acctbal") / 4).alias("bonus"),
        F.col("c_nationkey").alias("stock_options"), F.lit("2024-01-01").cast("date").alias("effective_date"),
    )
    reviews = table(spark, d, "orders").select(
        F.col("o_custkey").alias("employee_id"), F.left("o_orderpriority", F.lit(1)).cast("double").alias("rating"), F.col("o_orderdate").alias("review_date")
    )
    return employees, pay, reviews


@query("hr_performance", "UDF-05 AGG-23 GOV-01", f"""
SELECT c_mktsegment AS department, {rounded('avg(CAST(left(o_orderpriority, 1) AS DOUBLE))', 4)} AS avg_rating, min(CAST(left(o_orderpriority, 1) AS DOUBLE)) AS min_rating,
  max(CAST(left(o_orderpriority, 1) AS DOUBLE)) AS max_rating, count(DISTINCT c_custkey) AS employee_count, 9.0::DOUBLE AS avg_tenure_years
FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_mktsegment != 'MACHINERY' GROUP BY 1
""")
def hr_performance(spark, d):
    out = hr.performance(hr.analyst_view(*hr_tables(spark, d), hidden="MACHINERY"), F.lit("2024-06-01").cast("date"))
    return out.withColumn("avg_rating", settle(F.col("avg_rating"), 4))


@query("hr_operations", "UDF-05 AGG-23 JN-08", f"""
WITH v AS (SELECT c.* FROM customer c LEFT JOIN orders ON o_custkey = c_custkey WHERE c_mktsegment != 'MACHINERY')
SELECT c_mktsegment AS department, count(DISTINCT c_custkey) AS employee_count, {rounded('avg(c_acctbal)', 3)} AS avg_salary, {rounded('avg(c_acctbal * 1.25e0)', 3)} AS avg_total_comp FROM v GROUP BY 1
""")
def hr_operations(spark, d):
    out = hr.operations(hr.analyst_view(*hr_tables(spark, d), hidden="MACHINERY"))
    return out.select("department", "employee_count", settle(F.col("avg_salary"), 3).alias("avg_salary"), settle(F.col("avg_total_comp"), 3).alias("avg_total_comp"))

"""Functions, texts, vectors, masks and features over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import geo, text, times, values
from millrace.functions.values import settle
from millrace.operators import features as X
from millrace.operators import governance as G
from millrace.operators import texts as T
from millrace.operators import vectors as V
from millrace.queries.registry import query, rounded, table

K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"


@query("json_extract", "FN-05 FN-06", f"SELECT event_id, {K} AS k, CAST(NULL AS VARCHAR) AS missing FROM events")
def json_extract(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", text.json_field(F.col("props"), "k", "int").alias("k"), text.json_field(F.col("props"), "$schema").alias("missing"))


@query("json_payload", "FN-06 SNK-08 JOB-16", """
SELECT CAST(event_id AS VARCHAR) AS key, '{"event_id":' || CAST(event_id AS VARCHAR) || ',"event_type":"' || event_type || '","user_id":' || CAST(user_id AS VARCHAR) || '}' AS value
FROM events WHERE value > 25
""")
def json_payload(spark, d):
    from millrace.sinks.messages import json_payload as payload

    return payload(table(spark, d, "events").filter("value > 25"), ["event_id", "event_type", "user_id"], "event_id")


@query("message_headers", "SNK-09 FN-09 SRC-19", """
SELECT event_id, 'micro-batch' AS trigger_type, true AS has_batch, CAST(NULL AS VARCHAR) AS absent FROM events
""")
def message_headers(spark, d):
    from millrace.sinks.messages import with_headers

    sent = with_headers(table(spark, d, "events").select("event_id"), {"trigger_type": "micro-batch", "batch_id": 7})
    h = F.col("headers")
    return sent.select("event_id", text.header_value(h, "trigger_type").alias("trigger_type"),
                       text.has_header(h, "batch_id").alias("has_batch"), text.header_value(h, "other").alias("absent"))


@query("from_json_struct", "FN-06", f"SELECT event_id, {K} + 1 AS next_k FROM events")
def from_json_struct(spark, d):
    e = table(spark, d, "events").select("event_id", F.from_json("props", "k int").alias("p"))
    return e.select("event_id", (F.col("p.k") + 1).alias("next_k"))


def notices(spark, d):
    """One text message of ``KEY: value`` lines per event."""
    message = F.concat(
        F.lit("TITLE:   NOTICE "), F.col("event_id").cast("string"), F.lit("\nTGT_NAME: "), F.col("event_type"),
        F.lit("\nNOTICE_DATE: Thu 11 Apr 24 21:12:43 UT\n\nNEXT_POINT_RA: "), F.col("user_id").cast("string"),
        F.lit(".5d {+03h 13m 25s}\nCOMMENTS: first: one\nCOMMENTS: second"),
    )
    return table(spark, d, "events").select("event_id", message.alias("msg"))


@query("kv_lines", "FN-02", """
WITH m AS (SELECT event_id, unnest(['TITLE', 'TGT_NAME', 'NOTICE_DATE', 'NEXT_POINT_RA', 'COMMENTS', 'COMMENTS']) AS key,
  unnest(['NOTICE ' || event_id, event_type, 'Thu 11 Apr 24 21:12:43 UT', user_id || '.5d {+03h 13m 25s}', 'first: one', 'second']) AS value FROM events)
SELECT event_id, key, value FROM m
""")
def kv_lines(spark, d):
    return T.message_lines(notices(spark, d), "msg", ["event_id"]).drop("line_no")


@query("kv_lines_pivot", "FN-02 FN-03 FN-12 AGG-16 JOB-06", """
SELECT event_id, 'NOTICE ' || event_id AS "TITLE", event_type AS "TGT_NAME", TIMESTAMP '2024-04-11 21:12:43' AS notice_at,
       user_id + 0.5e0 AS ra_degrees, 'first: one second' AS "COMMENTS", CAST(NULL AS VARCHAR) AS "SLEW_DATE" FROM events
""")
def kv_lines_pivot(spark, d):
    from millrace.plans.notices import pointing_notices

    wide = pointing_notices(notices(spark, d), ["event_id"])
    return wide.select(
        "event_id", "TITLE", "TGT_NAME", F.col("NOTICE_DATE").cast("timestamp_ntz").alias("notice_at"),
        text.degrees_of(F.col("NEXT_POINT_RA")).alias("ra_degrees"), "COMMENTS", "SLEW_DATE",
    )


@query("kv_lines_grouped_pivot", "AGG-16", """
SELECT event_id, 'NOTICE ' || event_id AS "TITLE", event_type AS "TGT_NAME", 'second' AS "COMMENTS" FROM events
""")
def kv_lines_grouped_pivot(spark, d):
    from millrace.operators.aggregates import pivot_text

    lines = T.message_lines(notices(spark, d), "msg", ["event_id"])
    return pivot_text(lines, ["event_id"], "key", "value", ["TITLE", "TGT_NAME", "COMMENTS"])


@query("regex_extracts", "FN-03", """
SELECT c_custkey, regexp_replace(c_name, '[#0]+', '-') AS dashed, CAST(regexp_extract(c_name, '([1-9][0-9]*)$', 1) AS VARCHAR) AS tail FROM customer
""")
def regex_extracts(spark, d):
    c = table(spark, d, "customer")
    # Only the first run is replaced in the SQL; each name has one run of # and zeros before its number.
    return c.select(
        "c_custkey", F.regexp_replace("c_name", "(?s)^(.*?)[#0]+", "$1-").alias("dashed"),
        F.regexp_extract("c_name", "([1-9][0-9]*)$", 1).alias("tail"),
    )


@query("hash_ids", "FN-04", "SELECT doc_id, md5(text) AS text_id FROM documents")
def hash_ids(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5("text").alias("text_id"))


@query("hash_choice", "PRJ-21 FN-04 UDF-01")
def hash_choice(spark, d):
    choice = values.pick_by_hash(["card", "cash", "voucher"], F.col("o_orderkey"))
    return table(spark, d, "orders").groupBy(choice.alias("payment")).agg(F.count(F.lit(1)).alias("n"))


@query("md5_choice", "PRJ-21 UDF-01", """
SELECT o_orderkey, ['card', 'cash', 'voucher'][CAST(('0x' || left(md5(CAST(o_orderkey AS VARCHAR)), 7)) AS BIGINT) % 3 + 1] AS payment FROM orders
""")
def md5_choice(spark, d):
    choices = F.array(*[F.lit(c) for c in ("card", "cash", "voucher")])
    index = values.md5_bucket(F.col("o_orderkey"), 3).cast("int") + 1
    return table(spark, d, "orders").select("o_orderkey", F.element_at(choices, index).alias("payment"))


@query("caller_identity", "FN-20", "SELECT n_nationkey, true AS has_caller, 'masked' AS name FROM nation")
def caller_identity(spark, d):
    roles = ["readers"]  # the groups of the caller are an argument, the user comes from the session
    shown = G.role_mask(F.col("n_name"), roles, [("admins", lambda c: c)], G.fixed_text("masked"))
    return table(spark, d, "nation").select("n_nationkey", (F.length(F.current_user()) > 0).alias("has_caller"), shown.alias("name"))


@query("xml_round_trip", "FN-07 SRC-17", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def xml_round_trip(spark, d):
    from millrace.sources.xml import from_xml, to_xml

    s = to_xml(table(spark, d, "supplier"), ["s_suppkey", "s_name", "s_nationkey"], "supplier")
    return from_xml(s.select("xml"), "xml", "s_suppkey bigint, s_name string, s_nationkey int").select("parsed.*")


@query("date_parts", "FN-10", """
SELECT event_id, CAST(ts AS DATE) AS day, CAST(date_trunc('week', ts) AS DATE) AS week, CAST(date_trunc('month', ts) AS DATE) AS month,
       CAST(hour(ts) AS INT) AS h, CAST(month(ts) AS INT) AS m, CAST(year(ts) AS INT) AS y, CAST(quarter(ts) AS INT) AS q,
       CAST(dayofweek(ts) + 1 AS INT) AS dow, strftime(ts, '%Y/%m/%d') AS text, CAST(CAST(ts AS DATE) - INTERVAL 3 DAY AS DATE) AS earlier
FROM events
""")
def date_parts(spark, d):
    return table(spark, d, "events").select(
        "event_id", F.to_date("ts").alias("day"), F.date_trunc("week", "ts").cast("date").alias("week"),
        F.date_trunc("month", "ts").cast("date").alias("month"), F.hour("ts").alias("h"), F.month("ts").alias("m"),
        F.year("ts").alias("y"), F.quarter("ts").alias("q"), F.dayofweek("ts").alias("dow"),
        F.date_format("ts", "yyyy/MM/dd").alias("text"), F.date_sub(F.to_date("ts"), 3).alias("earlier"),
    )


@query("epoch_conversions", "FN-11 FN-22", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, epoch_us(ts) // 1000 AS millis, epoch_us(ts) AS micros,
       make_timestamp(epoch_us(ts) // 1000 * 1000) AS back, (epoch_us(ts) + 250000) // 1000 - epoch_us(ts) // 1000 AS latency FROM events
""")
def epoch_conversions(spark, d):
    ts = F.col("ts").cast("timestamp")
    later = ts + F.expr("INTERVAL 0.25 SECOND")
    return table(spark, d, "events").select(
        "event_id", F.unix_timestamp(ts).alias("seconds"), F.unix_millis(ts).alias("millis"), values.to_micros(ts).alias("micros"),
        values.millis_to_timestamp(F.unix_millis(ts)).cast("timestamp_ntz").alias("back"), values.latency_millis(ts, later).alias("latency"),
    )


@query("math_functions", "FN-13", f"""
SELECT event_id, {rounded('value', 1)} AS rounded, abs(value - 50) AS distance, CAST(floor(value) AS BIGINT) AS whole,
       event_id % 7 AS rest, least(value, 100) AS capped, greatest(value, 1) AS floored FROM events
""")
def math_functions(spark, d):
    v = F.col("value")
    return table(spark, d, "events").select(
        "event_id", settle(v, 1).alias("rounded"), F.abs(v - 50).alias("distance"), F.floor(v).alias("whole"),
        (F.col("event_id") % 7).alias("rest"), F.least(v, F.lit(100.0)).alias("capped"), F.greatest(v, F.lit(1.0)).alias("floored"),
    )


@query("safe_casts", "FN-14", f"""
SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN NULL WHEN 'click' THEN NULL ELSE value END AS number,
       CASE WHEN event_type = 'signup' THEN NULL ELSE {K} END AS whole,
       CASE WHEN event_type = 'error' THEN NULL ELSE TIMESTAMP '2024-05-01 10:00:00' END AS moment FROM events
""")
def safe_casts(spark, d):
    kind = F.col("event_type")
    raw = F.when(kind == "error", "n/a").when(kind == "view", "NaN").when(kind == "click", "Infinity").otherwise(F.col("value").cast("string"))
    count = F.when(kind == "signup", "many").otherwise(F.regexp_extract("props", "([0-9]+)", 1))
    stamp = F.when(kind == "error", "yesterday").otherwise("2024-05-01T10:00:00Z")
    return table(spark, d, "events").select(
        "event_id", values.safe_double(raw).alias("number"), values.safe_int(count).alias("whole"),
        values.safe_iso(stamp).cast("timestamp_ntz").alias("moment"),
    )


@query("null_fallbacks", "FN-15", """
SELECT event_id, coalesce(CASE WHEN event_type = 'view' THEN value END, CASE WHEN event_type != 'error' THEN value * 2 END) AS altitude FROM events
""")
def null_fallbacks(spark, d):
    v, kind = F.col("value"), F.col("event_type")
    return table(spark, d, "events").select("event_id", geo.best_altitude(F.when(kind == "view", v), F.when(kind != "error", v * 2)).alias("altitude"))


PLACE = "(event_id % 181 - 90)::DOUBLE AS lat, (event_id % 359 - 179)::DOUBLE AS lon"


def places(spark, d):
    return table(spark, d, "events").select(
        "event_id", (F.col("event_id") % 181 - 90).cast("double").alias("lat"), (F.col("event_id") % 359 - 179).cast("double").alias("lon"), "value"
    )


@query("unit_sphere", "FN-16", f"""
WITH p AS (SELECT event_id, radians(lat) AS north, radians(lon) AS east, 1 + value / 6371000.0e0 AS r FROM (SELECT event_id, {PLACE}, value FROM events))
SELECT event_id, {rounded('r * cos(north) * cos(east)', 5)} AS x, {rounded('r * cos(north) * sin(east)', 5)} AS y, {rounded('r * sin(north)', 5)} AS z FROM p
""")
def unit_sphere(spark, d):
    xyz = geo.sphere_point(F.col("lat"), F.col("lon"), F.col("value"))
    return places(spark, d).select("event_id", *[(settle(c, 5) + 0.0).alias(n) for n, c in xyz.items()])


@query("grid_cells", "FN-17", f"""
WITH p AS (SELECT event_id, {PLACE} FROM events)
SELECT CAST(floor(lat / 2.5e0) AS BIGINT) || ':' || CAST(floor(lon / 2.5e0) AS BIGINT) AS cell, count(*) AS n FROM p GROUP BY 1
""")
def grid_cells(spark, d):
    return places(spark, d).groupBy(geo.grid_cell(F.col("lat"), F.col("lon"), 2.5).alias("cell")).agg(F.count(F.lit(1)).alias("n"))


@query("unit_conversions", "FN-18", f"""
SELECT event_id, {rounded('value * 3.28084e0', 2)} AS feet, {rounded('value * 1.94384e0', 2)} AS knots, {rounded('value * 196.85e0', 2)} AS fpm,
  printf('%d° %.2f'' %s', CAST(floor(abs(v)) AS INT), round(CAST((abs(v) - floor(abs(v))) * 60 AS DECIMAL(38, 9)), 2)::DOUBLE, CASE WHEN v >= 0 THEN 'N' ELSE 'S' END) AS lat_text
FROM (SELECT event_id, value, (event_id % 721 - 360) / 4.0e0 AS v FROM events)
""")
def unit_conversions(spark, d):
    v = F.col("value")
    e = table(spark, d, "events").withColumn("lat", (F.col("event_id") % 721 - 360) / 4.0)
    return e.select(
        "event_id", settle(geo.metres_to_feet(v), 2).alias("feet"), settle(geo.mps_to_knots(v), 2).alias("knots"),
        settle(geo.mps_to_fpm(v), 2).alias("fpm"), geo.degree_minutes(F.col("lat"), "lat").alias("lat_text"),
    )


@query("heading_points", "FN-19", f"""
WITH p AS (SELECT event_id, radians(lat) AS a, lon, radians({K} * 3.6e0) AS c, value * 600.0e0 / 6371000.0e0 AS w FROM (SELECT event_id, {PLACE}, value, props FROM events)),
q AS (SELECT *, asin(greatest(-1.0e0, least(1.0e0, sin(a) * cos(w) + cos(a) * sin(w) * cos(c)))) AS b FROM p),
r AS (SELECT event_id, degrees(b) AS lat_ahead, lon + degrees(atan2(sin(c) * sin(w) * cos(a), cos(w) - sin(a) * sin(b))) AS l FROM q)
SELECT event_id, {rounded('lat_ahead', 5)} AS lat_ahead, {rounded('l - 360 * floor((l + 180) / 360)', 5)} AS lon_ahead FROM r
""")
def heading_points(spark, d):
    """Ten minutes ahead on a great circle."""
    e = places(spark, d).join(
        table(spark, d, "events").select("event_id", (text.json_field(F.col("props"), "k", "int") * 3.6).alias("track")), "event_id"
    )
    ahead = geo.dead_reckoning(F.col("lat"), F.col("lon"), F.col("track"), F.col("value"), 600)
    return e.select("event_id", *[(settle(c, 5) + 0.0).alias(n) for n, c in ahead.items()])


@query("age_texts", "FN-21", """
WITH a AS (SELECT event_id, CAST(floor((epoch_ms(TIMESTAMP '2024-01-31') - epoch_ms(ts)) / 1000) AS BIGINT) AS s FROM events)
SELECT event_id, CASE WHEN s < 60 THEN 'just now' WHEN s // 60 < 60 THEN (s // 60) || ' min ago'
  WHEN s // 3600 < 24 THEN (s // 3600) || ' hour' || CASE WHEN s // 3600 > 1 THEN 's' ELSE '' END || ' ago'
  ELSE (s // 86400) || ' day' || CASE WHEN s // 86400 > 1 THEN 's' ELSE '' END || ' ago' END AS age FROM a
""")
def age_texts(spark, d):
    age = times.age_text(F.col("ts").cast("timestamp"), F.lit("2024-01-31").cast("timestamp"))
    return table(spark, d, "events").select("event_id", age.alias("age"))


# ---- functions in SQL ------------------------------------------------------

@query("sql_scalar_function", "UDF-03 GOV-02", """
SELECT c_custkey, '***-**-' || right(c_name, 4) AS masked FROM customer
""")
def sql_scalar_function(spark, d):
    table(spark, d, "customer").createOrReplaceTempView("millrace_customer")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION millrace_mask(s STRING) RETURNS STRING RETURN concat('***-**-', right(s, 4))")
    return spark.sql("SELECT c_custkey, millrace_mask(c_name) AS masked FROM millrace_customer")


@query("sql_lookup_function", "UDF-04", """
WITH r AS (SELECT r_name || ': ' || r_regionkey AS said, r_name, row_number() OVER (ORDER BY r_name) AS place,
  row_number() OVER (PARTITION BY lower(r_name) LIKE '%asia%' ORDER BY r_name) AS asian FROM region)
SELECT string_agg(said, ' / ' ORDER BY said) FILTER (place <= 100) AS all_regions,
       string_agg(said, ' / ' ORDER BY said) FILTER (lower(r_name) LIKE '%asia%' AND asian <= 100) AS asia FROM r
""")
def sql_lookup_function(spark, d):
    """A report of the first hundred matches by name, so that its one text is bounded whatever the table."""
    table(spark, d, "region").createOrReplaceTempView("millrace_region")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION millrace_regions(topic STRING DEFAULT NULL) RETURNS STRING
        RETURN (SELECT concat_ws(' / ', array_sort(collect_list(said))) FROM (
                  SELECT concat(r_name, ': ', r_regionkey) AS said FROM millrace_region
                  WHERE millrace_regions.topic IS NULL OR lower(r_name) LIKE concat('%', lower(millrace_regions.topic), '%')
                  ORDER BY r_name LIMIT 100))
    """)
    return spark.sql("SELECT millrace_regions() AS all_regions, millrace_regions('Asia') AS asia")


@query("sql_table_function", "UDF-05 AGG-23", f"""
SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, {rounded('avg(2024 - year(o_orderdate))', 4)} AS avg_age FROM orders GROUP BY 1
""")
def sql_table_function(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("millrace_orders")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION millrace_status_report() RETURNS TABLE (o_orderstatus STRING, customers BIGINT, avg_age DOUBLE)
        RETURN SELECT o_orderstatus, count(DISTINCT o_custkey), round(round(avg(2024 - year(o_orderdate)), 7), 4) FROM millrace_orders GROUP BY o_orderstatus
    """)
    return spark.sql("SELECT * FROM millrace_status_report()")


@query("sql_table_function_argument", "UDF-06", f"""
SELECT p_type, count(*) AS n, {rounded('sum(p_retailprice)', 2)} AS total FROM part WHERE p_brand = 'Brand#2' GROUP BY 1
""")
def sql_table_function_argument(spark, d):
    table(spark, d, "part").createOrReplaceTempView("millrace_part")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION millrace_brand(brand STRING) RETURNS TABLE (p_type STRING, n BIGINT, total DOUBLE)
        RETURN SELECT p_type, count(*), round(sum(p_retailprice), 2) FROM millrace_part WHERE p_brand = millrace_brand.brand GROUP BY p_type
    """)
    return spark.sql("SELECT * FROM millrace_brand('Brand#2')")


@query("named_parameters", "UDF-07", "SELECT n_name FROM nation WHERE n_regionkey = 2")
def named_parameters(spark, d):
    table(spark, d, "nation").createOrReplaceTempView("millrace_nation")
    return spark.sql("SELECT n_name FROM IDENTIFIER(:t) WHERE n_regionkey = :r", {"t": "millrace_nation", "r": 2})


# ---- documents and models --------------------------------------------------

WORDS = "list_filter(string_split_regex(text, '\\s+'), lambda w: w != '')"


@query("chunk_documents", "UDF-02 JOB-13", f"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
     n AS (SELECT doc_id, ws, unnest(generate_series(0, CAST(greatest(1, ceil((len(ws) - 75) / 425.0e0)) AS BIGINT) - 1)) AS chunk_no FROM w WHERE len(ws) > 0),
     c AS (SELECT doc_id, chunk_no, array_to_string(list_slice(ws, chunk_no * 425 + 1, chunk_no * 425 + 500), ' ') AS chunk FROM n)
SELECT doc_id, CAST(chunk_no AS INT) AS chunk_no, length(chunk) AS n_chars, md5(chunk) AS chunk_id FROM c
""")
def chunk_documents(spark, d):
    chunks = T.chunk_words(table(spark, d, "documents").select("doc_id", "text"), "text")
    return chunks.select("doc_id", "chunk_no", F.length("chunk").cast("bigint").alias("n_chars"), "chunk_id")


# Word lists of the four languages of the documents, as labels of the classifier.
LANGUAGE_WORDS = {
    "english": ["the", "and", "of", "is"], "french": ["le", "la", "des", "et"],
    "german": ["der", "die", "und", "nicht"], "spanish": ["el", "los", "que", "una"],
}
TOKENS = "string_split_regex(lower(text), '[\\s.,;:!?()]+')"


def _count(words):
    listed = ", ".join(f"'{w}'" for w in words)
    return f"len(list_filter({TOKENS}, lambda w: w IN ({listed})))"


_SCORES = ", ".join(f"{_count(ws)} AS s{i}" for i, ws in enumerate(LANGUAGE_WORDS.values()))
_PICK = " ".join(f"WHEN s{i} = top THEN '{label}'" for i, label in enumerate(LANGUAGE_WORDS))


@query("classify_text", "UDF-09", f"""
WITH s AS (SELECT doc_id, {_SCORES} FROM documents), t AS (SELECT *, greatest(s0, s1, s2, s3) AS top FROM s)
SELECT doc_id, CASE WHEN top = 0 THEN 'other' {_PICK} END AS label FROM t
""")
def classify_text(spark, d):
    return T.classify(table(spark, d, "documents").select("doc_id", "text"), "text", LANGUAGE_WORDS).select("doc_id", "label")


@query("sentiment", "UDF-10", f"""
WITH s AS (SELECT doc_id, {_count(['good', 'the', 'le'])} AS p, {_count(['bad', 'of', 'des'])} AS n FROM documents)
SELECT doc_id, CASE WHEN p > n THEN 'positive' WHEN p < n THEN 'negative' ELSE 'neutral' END AS mood FROM s
""")
def sentiment(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return T.sentiment(docs, "text", ["good", "the", "le"], ["bad", "of", "des"], "mood").drop("text")


def _load_shouter():
    """Stands in for a text model: the first word of the prompt's last line, in capitals."""
    return lambda prompts: prompts.str.rsplit(": ", n=1).str[-1].str.upper()


@query("model_column", "UDF-08 UDF-10", "SELECT p_partkey, 'Sell: ' || p_name AS prompt, upper(p_name) AS answer FROM part")
def model_column(spark, d):
    p = table(spark, d, "part").select("p_partkey", T.build_prompt(["Sell: ", F.col("p_name")]).alias("prompt"))
    return T.apply_model(p, ["prompt"], "answer", _load_shouter)


@query("cosine_topk", "UDF-11", f"""
WITH u AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
     x AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM u),
     c AS (SELECT label, list(m ORDER BY pos) AS q FROM (SELECT label, pos, avg(x) AS m FROM x GROUP BY 1, 2) GROUP BY 1),
     s AS (SELECT c.label AS query_label, vec_id, list_cosine_similarity(q, v) AS similarity FROM c, u)
SELECT query_label, vec_id, {rounded('similarity', 5)} AS similarity, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_label ORDER BY similarity DESC, vec_id) AS INT) AS rank FROM s) WHERE rank <= 3
""")
def cosine_topk(spark, d):
    e = table(spark, d, "embeddings")
    queries = V.centroids(e, "label", "embedding").withColumnRenamed("label", "query_label")
    hits = V.cosine_top_k(e, "vec_id", "embedding", queries, "query_label", "embedding", 3)
    return hits.select("query_label", "vec_id", settle(F.col("similarity"), 5).alias("similarity"), "rank")


@query("nearest_rows", "UDF-11", f"""
WITH u AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
SELECT query_id, vec_id, {rounded('similarity', 5)} AS similarity, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(similarity, 12) DESC, vec_id) AS INT) AS rank
  FROM (SELECT a.vec_id AS query_id, b.vec_id, list_cosine_similarity(a.v, b.v) AS similarity FROM u a JOIN u b ON a.vec_id % 100 = 0)) WHERE rank <= 10
""")
def nearest_rows(spark, d):
    """Every hundredth vector against all vectors."""
    e = table(spark, d, "embeddings")
    queries = e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    hits = V.cosine_top_k(e, "vec_id", "embedding", queries, "query_id", "query", 10)
    return hits.select("query_id", "vec_id", settle(F.col("similarity"), 5).alias("similarity"), "rank")


@query("retrieved_context", "UDF-12", """
WITH u AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
     x AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM u),
     c AS (SELECT label, list(m ORDER BY pos) AS q FROM (SELECT label, pos, avg(x) AS m FROM x GROUP BY 1, 2) GROUP BY 1),
     s AS (SELECT c.label AS query_label, vec_id, row_number() OVER (PARTITION BY c.label ORDER BY list_cosine_similarity(q, v) DESC, vec_id) AS rank FROM c, u)
SELECT query_label, string_agg('vector ' || vec_id, ' | ' ORDER BY rank) AS context FROM s WHERE rank <= 3 GROUP BY 1
""")
def retrieved_context(spark, d):
    e = table(spark, d, "embeddings")
    queries = V.centroids(e, "label", "embedding").withColumnRenamed("label", "query_label")
    hits = V.cosine_top_k(e, "vec_id", "embedding", queries, "query_label", "embedding", 3)
    named = hits.withColumn("chunk", F.concat(F.lit("vector "), F.col("vec_id").cast("string")))
    return T.join_context(named, ["query_label"], "rank", "chunk", " | ")


# ---- masks -----------------------------------------------------------------

@query("mask_view", "GOV-02", """
SELECT c_custkey, 'admin' AS seen_by, c_name AS name FROM customer
UNION ALL SELECT c_custkey, 'analyst', 'ANALYTICS_MASKED' FROM customer
UNION ALL SELECT c_custkey, 'other', '***-**-' || right(c_name, 4) FROM customer
""")
def mask_view(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    cases = [("admins", lambda col: col), ("hr_data_analysts", G.fixed_text("ANALYTICS_MASKED"))]
    views = {"admin": ["admins"], "analyst": ["hr_data_analysts"], "other": []}
    parts = [
        c.select("c_custkey", F.lit(who).alias("seen_by"), G.role_mask(F.col("c_name"), roles, cases, G.last_four).alias("name"))
        for who, roles in views.items()
    ]
    return parts[0].union(parts[1]).union(parts[2])


@query("tagged_mask", "GOV-03", "SELECT c_custkey, '***REDACTED***' AS c_name, c_mktsegment FROM customer")
def tagged_mask(spark, d):
    c = G.tag_columns(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), {"c_name": ["class.name"]})
    return G.mask_tagged(c, ["class.name", "class.email"], G.fixed_text("***REDACTED***"), "ann", ["ann", "ben"])


@query("anonymised_view", "GOV-01", """
SELECT 'EMP_' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS anonymous_id, c_mktsegment, CAST(year(o_orderdate) AS INT) AS first_year, CAST(quarter(o_orderdate) AS INT) AS first_quarter
FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS o_orderdate FROM orders GROUP BY 1) ON c_custkey = o_custkey WHERE c_mktsegment != 'MACHINERY'
""")
def anonymised_view(spark, d):
    first = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderdate").alias("first"))
    c = table(spark, d, "customer").filter("c_mktsegment != 'MACHINERY'").join(first, "c_custkey", "left")
    return c.select(G.anonymous_id(F.col("c_custkey")).alias("anonymous_id"), "c_mktsegment", F.year("first").alias("first_year"), F.quarter("first").alias("first_quarter"))


@query("text_mentions", "GOV-05 PRJ-08", """
SELECT doc_id, left(text, 500) AS preview FROM documents WHERE contains(lower(text), 'license')
""")
def text_mentions(spark, d):
    return G.mentions(table(spark, d, "documents").select("doc_id", "text"), "text", "license").drop("text")


# ---- features --------------------------------------------------------------

MD5 = "CAST(('0x' || left(md5(CAST(doc_id AS VARCHAR)), 7)) AS BIGINT) % 100"


@query("hash_split", "ML-03", f"""
SELECT split, count(*) AS n FROM (SELECT CASE WHEN {MD5} < 80 THEN 'train' WHEN {MD5} < 90 THEN 'validate' ELSE 'test' END AS split FROM documents) GROUP BY 1
""")
def hash_split(spark, d):
    return X.hash_split(table(spark, d, "documents").select("doc_id"), "doc_id").groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("status_label", "ML-02 PRJ-07", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_bad FROM orders WHERE o_orderstatus IN ('F', 'O')
""")
def status_label(spark, d):
    return X.status_label(table(spark, d, "orders"), "o_orderstatus", "F", ["F", "O"]).select("o_orderkey", "is_bad")


@query("scaled_features", "ML-04", f"""
WITH s AS (SELECT avg(n_chars) AS m, stddev_samp(n_chars) AS sd FROM documents)
SELECT doc_id, {rounded('(n_chars - m) / sd', 5)} AS n_chars FROM documents, s
""")
def scaled_features(spark, d):
    scaled = X.scaled_values(table(spark, d, "documents"), ["n_chars"], ["doc_id"])
    return scaled.select("doc_id", settle(F.col("n_chars"), 5).alias("n_chars"))


@query("group_mean", "ML-08", f"SELECT c_nationkey, {rounded('avg(c_acctbal)', 2)} AS mean_balance FROM customer GROUP BY 1")
def group_mean(spark, d):
    return table(spark, d, "customer").groupBy("c_nationkey").agg(settle(F.avg("c_acctbal"), 2).alias("mean_balance"))


def document_features(spark, d):
    """Shape of the documents with a label: sizes, and shares that do not depend on them."""
    words = text.words(F.col("text"))
    share = lambda found, of: F.coalesce(F.try_divide(found.cast("double"), of.cast("double")), F.lit(0.0))
    lines = F.split("text", "\n")
    docs = table(spark, d, "documents").select(
        "doc_id", "lang", F.col("n_chars").cast("double").alias("n_chars"), F.size(words).cast("double").alias("n_words"), F.size(lines).cast("double").alias("n_lines"),
        share(F.size(F.array_distinct(words)), F.size(words)).alias("distinct_words"), share(F.size(F.array_distinct(lines)), F.size(lines)).alias("distinct_lines"),
        share(F.length(F.regexp_replace("text", r"\p{L}", "")), F.length("text")).alias("no_letters"),
    )
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return X.hash_split(X.feature_lookup(labels, docs, ["doc_id"], docs.columns[1:]), "doc_id", {"train": 80, "test": 20})


@query("model_figures", "ML-05 ML-06 ML-07", f"""
WITH t AS (SELECT quality, count(*) AS n FROM labels WHERE {MD5} >= 80 GROUP BY 1),
f AS (SELECT sum(n) AS n, 2.0 * max(n) / (sum(n) + max(n)) * max(n) / sum(n) AS guess FROM t),
p AS (SELECT n_chars FROM documents WHERE {MD5} >= 80)
SELECT 'f1' AS figure, CAST(n AS BIGINT) AS test_rows, {rounded('guess', 4)} AS guess, true AS agrees, true AS beats_guess FROM f
UNION ALL SELECT 'mse', count(*), {rounded('var_pop(n_chars) / 1e3', 2)}, true, true FROM p
""")
def model_figures(spark, d):
    """Two fitted models on their test rows: f1 of the quality of a document, squared error of its length in thousands.

    ``guess`` is the figure of the commonest label and of the mean; ``agrees``: the figure counted from the predictions is that of the
    evaluator; ``beats_guess``: f1 is higher, the error less than half.
    """
    scored = gbt_classifier(spark, d).select("quality", "prediction").persist()
    pairs = X.confusion(scored, "quality")
    common = pairs.groupBy("label").agg(F.sum("n").alias("n"))
    guess = X.weighted_f1(common.select("label", F.lit(common.orderBy(F.desc("n"), "label").first()[0]).alias("predicted"), "n")).scalar()
    f1 = X.weighted_f1(pairs).scalar()
    classes = pairs.agg(F.sum("n").alias("test_rows")).select(
        F.lit("f1").alias("figure"), "test_rows", settle(guess, 4).alias("guess"), (F.abs(f1 - X.f1(scored, "quality")) < 1e-9).alias("agrees"), (f1 > guess).alias("beats_guess")
    )
    lengths = document_lengths(spark, d).persist()
    error = F.avg((F.col("prediction") - F.col("length")) ** 2)
    numbers = lengths.agg(F.count(F.lit(1)).alias("test_rows"), F.var_pop("length").alias("spread"), error.alias("error")).select(
        F.lit("mse").alias("figure"), "test_rows", settle(F.col("spread") / 1e3, 2).alias("guess"),
        (F.abs(F.col("error") - X.mean_squared_error(lengths, "length")) < 1e-6 * F.col("error")).alias("agrees"), (F.col("error") < 0.5 * F.col("spread")).alias("beats_guess"),
    )
    return classes.union(numbers)


def document_lengths(spark, d):
    """Characters of the test documents as predicted from their words and lines."""
    words = text.words(F.col("text"))
    docs = table(spark, d, "documents").select(
        "doc_id", F.col("n_chars").cast("double").alias("length"), F.size(words).cast("double").alias("n_words"),
        F.size(F.array_distinct(words)).cast("double").alias("n_distinct"), F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
    )
    rows = X.hash_split(docs, "doc_id", {"train": 80, "test": 20})
    model = X.fit_regressor(rows.filter("split = 'train'"), "length", ["n_words", "n_distinct", "n_lines"], maxIter=10, maxDepth=5)
    return X.score(model, rows.filter("split = 'test'"), ["doc_id", "length"])


@query("gbt_classifier", "ML-04 ML-05 ML-07")
def gbt_classifier(spark, d):
    rows = document_features(spark, d)
    numbers = ["n_chars", "n_words", "n_lines", "distinct_words", "distinct_lines", "no_letters"]
    model = X.fit_classifier(rows.filter("split = 'train'"), "quality", numbers, ["lang"], maxIter=6, maxDepth=4)
    return X.score(model, rows.filter("split = 'test'"), ["doc_id", "quality"], probability=True)


@query("gbt_regression", "ML-06 ML-07")
def gbt_regression(spark, d):
    from millrace.operators.windows import in_bounded_tasks, lag_features

    items = table(spark, d, "lineitem")
    daily = items.groupBy("l_suppkey", F.to_date("l_shipdate").alias("day")).agg(F.sum("l_quantity").alias("units"))
    # The trees are fitted on rows that stay in memory as the windows left them, so their tasks must not grow with the table.
    daily = in_bounded_tasks(daily, ["l_suppkey"], items.count())
    rows = lag_features(daily, ["l_suppkey"], "day", "units").withColumn("key", F.concat_ws("/", "l_suppkey", "day"))
    rows = X.hash_split(rows, "key", {"train": 80, "test": 20})
    numbers = ["units", "units_d1", "units_d2", "units_d3", "units_d7", "mean_7d_units", "dow"]
    rows = X.to_numbers(rows, numbers)
    model = X.fit_regressor(rows.filter("split = 'train'"), "target_units", numbers, maxIter=4, maxDepth=3)
    return X.score(model, rows.filter("split = 'test'"), ["l_suppkey", "day", "target_units"])

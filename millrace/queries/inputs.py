"""File, XML, message and response sources, fed with files Spark writes from the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.queries.registry import query, table
from millrace.session import scratch_path
from millrace.sources import files, messages, states, xml
from millrace.streaming import runs


def drained(spark, source, root):
    runs.drain_to_parquet(source, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


@query("json_ingest", "SRC-08 SRC-11 SRC-05", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_ingest(spark, d):
    root = scratch_path(spark, "json")
    table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal").write.json(f"{root}/in")
    return drained(spark, files.ingest(spark, f"{root}/in", "json", f"{root}/schemas"), root).select("c_custkey", "c_name", "c_acctbal")


@query("csv_ingest", "SRC-09 SRC-07", "SELECT CAST(s_suppkey AS INT) AS s_suppkey, s_name, s_acctbal FROM supplier")
def csv_ingest(spark, d):
    root = scratch_path(spark, "csv")
    table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal").write.option("header", True).csv(f"{root}/in")
    return drained(spark, files.ingest(spark, f"{root}/in", "csv", f"{root}/schemas"), root)


@query("multiline_json_ingest", "SRC-10", "SELECT n_nationkey AS id, n_name AS name FROM nation")
def multiline_json_ingest(spark, d):
    root = scratch_path(spark, "multiline")
    # Per region and thousand of keys a folder of files, each a JSON array over several lines.
    one = F.concat(F.lit('{\n  "id": '), F.col("n_nationkey").cast("string"), F.lit(',\n  "name": "'), F.col("n_name"), F.lit('"\n}'))
    thousand = F.floor(F.col("n_nationkey") / 1000).alias("thousand")
    arrays = table(spark, d, "nation").groupBy("n_regionkey", thousand).agg(F.array_join(F.collect_list(one), ",\n").alias("body"))
    whole = arrays.select("n_regionkey", F.concat(F.lit("["), "body", F.lit("]")).alias("value"))
    # An array a row, so one row a file.
    whole.write.option("maxRecordsPerFile", 1).partitionBy("n_regionkey").text(f"{root}/in")
    source = files.ingest(spark, f"{root}/in/*/*.txt", "json", schema="id int, name string", options={"multiLine": "true"})
    return drained(spark, source, root)


@query("schema_evolution", "SRC-16 SRC-15 SNK-03 SRC-08", """
SELECT n_nationkey, n_name, CAST(NULL AS BIGINT) AS n_regionkey, CAST(NULL AS VARCHAR) AS rescued FROM nation
UNION ALL SELECT n_nationkey, n_name, n_regionkey, NULL FROM nation
UNION ALL SELECT n_nationkey, n_name, NULL, '{"n_regionkey":"region ' || n_regionkey || '"}' FROM nation
UNION ALL SELECT n_nationkey, n_name, n_regionkey, '{"n_comment":"new"}' FROM nation
""")
def schema_evolution(spark, d):
    """Four drops into one folder: two columns; a third one, added; text in it, rescued; a fourth column in mode rescue, rescued."""
    root = scratch_path(spark, "evolution")
    n = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region_text = F.concat(F.lit("region "), F.col("n_regionkey").cast("string"))
    drops = [
        (n.drop("n_regionkey"), files.ADD), (n, files.ADD), (n.withColumn("n_regionkey", region_text), files.ADD),
        (n.withColumn("n_comment", F.lit("new")), files.RESCUE),
    ]
    for part, mode in drops:
        part.write.mode("append").json(f"{root}/in")
        # Every start reads the schema of the new files only; schema and checkpoint are kept.
        source = files.ingest(spark, f"{root}/in", "json", f"{root}/schemas", mode=mode, rescue="rescued")
        runs.drain_to_parquet(source, f"{root}/out", f"{root}/checkpoint")
    out = spark.read.option("mergeSchema", "true").parquet(f"{root}/out")
    return out.select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name", "n_regionkey", "rescued")


@query("rescued_records", "SRC-09 SRC-15", """
SELECT 'csv' AS kind, CAST(s_suppkey AS BIGINT) AS id, CASE WHEN s_nationkey = 3 THEN NULL ELSE s_nationkey END AS nation,
  CASE WHEN s_nationkey = 3 THEN s_suppkey || ',n/a' END AS rescued FROM supplier
UNION ALL SELECT 'xml', s_suppkey, CASE WHEN s_nationkey = 3 THEN NULL ELSE s_nationkey END, CASE WHEN s_nationkey = 3 THEN '{"nation":"n/a"}' END FROM supplier
""")
def rescued_records(spark, d):
    """Suppliers as CSV and XML with an unreadable nation: the other columns are read, what does not fit is kept."""
    root = scratch_path(spark, "records")
    nation = F.when(F.col("s_nationkey") == 3, "n/a").otherwise(F.col("s_nationkey").cast("string"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), nation.alias("nation"))
    s.write.option("header", True).csv(f"{root}/csv")
    s.write.format("xml").option("rowTag", "s").option("rootTag", "all").save(f"{root}/xml")
    out = []
    for kind, options in (("csv", {}), ("xml", {"rowTag": "s"})):
        source = files.ingest(spark, f"{root}/{kind}", kind, schema="id long, nation int", rescue="rescued", options=options)
        runs.drain_to_parquet(source, f"{root}/out/{kind}", f"{root}/checkpoint/{kind}")
        out.append(spark.read.parquet(f"{root}/out/{kind}").select(F.lit(kind).alias("kind"), "id", "nation", "rescued"))
    return out[0].union(out[1])


@query("xml_files", "SRC-13 FN-07", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def xml_files(spark, d):
    path = scratch_path(spark, "xml")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("_id"), "s_name", "s_nationkey")
    s.write.format("xml").option("rowTag", "supplier").option("rootTag", "suppliers").save(path)
    read = xml.read_xml(spark, path, "supplier")
    return read.select(F.col("_id").alias("s_suppkey"), "s_name", F.col("s_nationkey").cast("int").alias("s_nationkey"))


@query("xml_table", "SRC-17", "SELECT s_nationkey, count(*) AS n, min(s_name) AS first_name FROM supplier GROUP BY 1")
def xml_table(spark, d):
    """XML files as a table of the catalog, read by its name in SQL."""
    path = scratch_path(spark, "xml-table")
    name = "millrace_" + path.rsplit("-", 1)[1]
    s = table(spark, d, "supplier").select("s_name", "s_nationkey")
    s.write.format("xml").option("rowTag", "supplier").option("rootTag", "suppliers").save(path)
    xml.create_xml_table(spark, name, path, "supplier")
    return spark.sql(f"SELECT CAST(s_nationkey AS INT) AS s_nationkey, count(*) AS n, min(s_name) AS first_name FROM {name} GROUP BY 1")


@query("xml_stream", "SRC-15 STR-04", "SELECT p_partkey, p_name, p_size FROM part")
def xml_stream(spark, d):
    root = scratch_path(spark, "xml-stream")
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    p.write.format("xml").option("rowTag", "part").option("rootTag", "parts").save(f"{root}/in")
    source = files.ingest(spark, f"{root}/in", "xml", f"{root}/schemas", options={"rowTag": "part"})
    return drained(spark, source, root).select("p_partkey", "p_name", F.col("p_size").cast("int").alias("p_size"))


SUPPLIER_XSD = """<?xml version="1.0"?>
<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="supplier"><xs:complexType><xs:sequence>
<xs:element name="s_name" type="xs:string"/><xs:element name="nation" type="xs:integer"/></xs:sequence>
<xs:attribute name="id" type="xs:integer" use="required"/></xs:complexType></xs:element></xs:schema>"""


@query("xml_checked", "SRC-14", """
SELECT s_suppkey, s_nationkey <= 12 AS valid, CASE WHEN s_nationkey <= 12 THEN s_name END AS s_name FROM supplier
""")
def xml_checked(spark, d):
    from pyspark.sql import types as T

    path = scratch_path(spark, "xml-checked")
    nation = F.when(F.col("s_nationkey") <= 12, F.col("s_nationkey").cast("string")).otherwise("unknown")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("_id"), "s_name", nation.alias("nation"))
    s.write.format("xml").option("rowTag", "supplier").option("rootTag", "suppliers").save(path)
    xsd = xml.send_xsd(spark, SUPPLIER_XSD, "supplier.xsd")
    schema = T.StructType.fromDDL("_id bigint, s_name string, nation int")
    read = xml.read_xml_checked(spark, path, "supplier", schema, xsd)
    broken = F.col(xml.CORRUPT)
    key = F.coalesce("_id", F.regexp_extract(broken, 'id="([0-9]+)"', 1).try_cast("bigint"))
    return read.select(key.alias("s_suppkey"), broken.isNull().alias("valid"), F.when(broken.isNull(), F.col("s_name")).alias("s_name"))


@query("message_replay", "SRC-18 SRC-19 FN-06 FN-09", """
SELECT event_id, user_id, event_type, 'run-1' AS run_id, event_id AS "offset" FROM events WHERE value > 1
""")
def message_replay(spark, d):
    root = scratch_path(spark, "messages")
    e = table(spark, d, "events")
    head = F.when(F.col("value") > 1, F.array(F.struct(F.lit("run_id").alias("key"), F.lit("run-1").alias("value")))).otherwise(F.array().cast("array<struct<key: string, value: string>>"))
    e.select(
        F.col("user_id").cast("string").alias("key"), F.to_json(F.struct("event_id", "user_id", "event_type")).alias("value"), F.lit("events").alias("topic"),
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"), head.alias("headers"),
    ).write.json(f"{root}/in")
    sent = messages.replay(spark, f"{root}/in", "events", first_offset=0)
    return messages.decoded(sent, "event_id bigint, user_id bigint, event_type string", "run_id", {"run_id": "run_id"}).drop("sink_timestamp")


def responses(spark, d):
    """Events as recorded responses of at most 100 states; errors are cut short, signups have no position."""
    v, kind = F.col("value"), F.col("event_type")
    fields = [
        F.concat(F.lit('"e'), F.col("event_id").cast("string"), F.lit('"')), F.lit('" CALL "'), F.lit('"X"'), F.floor(F.unix_timestamp(F.col("ts").cast("timestamp"))).cast("string"),
        F.lit("null"), F.when(kind == "signup", "null").otherwise(v.cast("string")), F.lit("48.5"), F.lit('"high"'), F.lit("false"), v.cast("string"),
        F.lit("90"), F.lit("null"), F.lit("[1, 2]"), F.lit("1000"), F.lit('"7700"'), F.lit("true"), F.lit("0"), F.lit("3"),
    ]
    full = F.concat(F.lit("["), F.concat_ws(", ", *fields), F.lit("]"))
    short = F.concat(F.lit("["), F.concat_ws(", ", *fields[:9]), F.lit("]"))
    vector = F.when(kind == "error", short).otherwise(full)
    hundred = F.floor(F.col("event_id") / 100).alias("hundred")
    grouped = table(spark, d, "events").groupBy(hundred).agg(F.collect_list(vector).alias("states"))
    return grouped.select(F.concat(F.lit('{"time": 1700000000, "states": ['), F.array_join("states", ", "), F.lit("]}")).alias("value"))


RESPONSES = """
SELECT 'e' || event_id AS icao24, CAST(floor(epoch(ts)) AS BIGINT) AS seen, value AS longitude, CAST(NULL AS DOUBLE) AS baro_altitude, 2::BIGINT AS n_sensors, '7700' AS squawk, CAST(3 AS INT) AS category
FROM events WHERE event_type NOT IN ('error', 'signup')
"""


def _shown(parsed):
    return parsed.select(
        "icao24", F.unix_timestamp("time_position").alias("seen"), "longitude", "baro_altitude", F.size("sensors").cast("bigint").alias("n_sensors"), "squawk", "category"
    )


@query("state_responses", "SRC-25 FN-14", RESPONSES)
def state_responses(spark, d):
    path = scratch_path(spark, "responses")
    responses(spark, d).write.text(path)
    return _shown(states.read_responses(spark, path))


@query("state_response_source", "SRC-23 SRC-24 STR-15", RESPONSES)
def state_response_source(spark, d):
    path = scratch_path(spark, "recorded")
    responses(spark, d).write.text(path)
    spark.dataSource.register(states.RecordedResponses)
    raw = spark.read.format("recorded_responses").load(path)
    return _shown(states.parse_responses(raw, "value"))


@query("shared_table_read", "SRC-28 SRC-01", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 110000 AND o_orderstatus = 'O'")
def shared_table_read(spark, d):
    o = table(spark, d, "orders")
    return o.filter("o_totalprice BETWEEN 100000 AND 110000 AND o_orderstatus = 'O'").select("o_orderkey", "o_totalprice")

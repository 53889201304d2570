"""Change capture, table writes and data quality over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import changes as C
from millrace.operators import quality as Q
from millrace.operators.governance import access_audit
from millrace.operators.relational import as_of
from millrace.queries.registry import query, rounded, table
from millrace.session import scratch_path
from millrace.sinks import tables as S

SEQUENCE = ["ts", "event_id"]
IS_DELETE = "event_type = 'error'"


def feed(spark, d):
    """Events as a change log: key user_id, ordered by time and id, deletes are the errors."""
    return table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value")


SCD1 = """
SELECT user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type != 'error'
"""


@query("apply_changes_scd1", "CDC-01 CDC-02 CDC-03", SCD1)
def apply_changes_scd1(spark, d):
    return C.apply_changes(feed(spark, d), ["user_id"], SEQUENCE, IS_DELETE, SEQUENCE)


SCD2 = """
WITH chain AS (SELECT user_id, event_id, event_type, value, ts AS valid_from,
                      lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM events)
SELECT user_id, event_id, event_type, value, valid_from, valid_to FROM chain WHERE event_type != 'error'
"""


@query("apply_changes_scd2", "CDC-04", SCD2)
def apply_changes_scd2(spark, d):
    return C.change_history(feed(spark, d), ["user_id"], SEQUENCE, IS_DELETE, ["ts"])


@query("apply_changes_scd2_blocks", "CDC-04", SCD2)
def apply_changes_scd2_blocks(spark, d):
    return C.change_history(feed(spark, d), ["user_id"], SEQUENCE, IS_DELETE, ["ts"], block_rows=7)


@query("history_as_of", "CDC-04 SRC-29", f"""
SELECT user_id, event_id FROM ({SCD2}) WHERE valid_from <= TIMESTAMP '2024-01-15' AND (valid_to IS NULL OR TIMESTAMP '2024-01-15' < valid_to)
""")
def history_as_of(spark, d):
    history = C.change_history(feed(spark, d), ["user_id"], SEQUENCE, IS_DELETE, ["ts"])
    return as_of(history, F.lit("2024-01-15").cast("timestamp_ntz")).select("user_id", "event_id")


@query("keyed_table_merges", "CDC-01 CDC-02 SNK-14", SCD1)
def keyed_table_merges(spark, d):
    # Two merges, the later changes first: sequence numbers decide, not the order of arrival.
    changes = feed(spark, d)
    store = S.KeyedTable(spark, scratch_path(spark, "keyed"), ["user_id"], buckets=8)
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    store.merge(changes.filter(late), SEQUENCE, IS_DELETE)
    store.merge(changes.filter(~late), SEQUENCE, IS_DELETE)
    return store.read().select("user_id", "event_type", "value")


@query("upsert_merge", "CDC-06", """
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer
""")
def upsert_merge(spark, d):
    c = table(spark, d, "customer")
    source = C.update_where(c.filter("c_mktsegment = 'BUILDING'"), None, {"c_acctbal": F.col("c_acctbal") + 1})
    Q.require_unique(source, ["c_custkey"])
    return C.upsert(c, source, ["c_custkey"])


@query("insert_if_absent", "SNK-16 CDC-14", """
SELECT s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT c_nationkey FROM customer)
""")
def insert_if_absent(spark, d):
    seen = table(spark, d, "customer").select(F.col("c_nationkey").cast("bigint").alias("s_suppkey"))
    return C.insert_absent(seen, table(spark, d, "supplier").select("s_suppkey"), ["s_suppkey"])


@query("update_rows", "CDC-08 CDC-09", """
SELECT s_suppkey, CASE WHEN s_nationkey IN (3, 5) THEN NULL ELSE s_acctbal END AS s_acctbal,
       CASE WHEN s_suppkey IN (1, 2) THEN s_name || ' (checked)' ELSE s_name END AS s_name FROM supplier
""")
def update_rows(spark, d):
    s = table(spark, d, "supplier")
    s = C.update_where(s, F.col("s_nationkey").isin(3, 5), {"s_acctbal": F.lit(None)})
    s = C.update_where(s, F.col("s_suppkey").isin(1, 2), {"s_name": F.concat("s_name", F.lit(" (checked)"))})
    return s.select("s_suppkey", "s_acctbal", "s_name")


@query("delete_rows", "CDC-10", "SELECT p_partkey, p_name FROM part WHERE p_name NOT LIKE '%bolt%'")
def delete_rows(spark, d):
    return C.delete_where(table(spark, d, "part"), F.col("p_name").like("%bolt%")).select("p_partkey", "p_name")


@query("add_column", "CDC-11", "SELECT n_nationkey, CAST(NULL AS VARCHAR) AS note FROM nation")
def add_column(spark, d):
    return C.add_columns(table(spark, d, "nation").select("n_nationkey"), {"note": "string"})


@query("replace_partitions", "CDC-05 SNK-01", f"""
SELECT o_orderstatus, count(*) AS n, {rounded("sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END)", 2)} AS total FROM orders GROUP BY 1
""")
def replace_partitions(spark, d):
    path = scratch_path(spark, "orders-by-status")
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    S.replace_partitions(o, path, ["o_orderstatus"])
    S.replace_partitions(o.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0)), path, ["o_orderstatus"])
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("table_writes", "SNK-02 SNK-04 SNK-01", """
SELECT 'appended' AS step, s_suppkey AS id, s_name AS label, CAST(NULL AS INT) AS nation FROM supplier
UNION ALL SELECT 'replaced', s_suppkey, NULL, s_nationkey FROM supplier WHERE s_acctbal > 0
""")
def table_writes(spark, d):
    """A table written, appended to with its columns in another order, and then replaced by one with other columns."""
    path = scratch_path(spark, "writes")
    name = "millrace_" + path.rsplit("-", 1)[1]
    s = table(spark, d, "supplier")
    first = s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("label"))
    S.overwrite_table(first.filter("id % 2 = 0"), name, f"{path}/first")
    S.append_table(first.filter("id % 2 = 1").select("label", "id"), name)
    # Kept aside, since the table is replaced before the rows are asked for.
    spark.table(name).write.parquet(f"{path}/kept")
    S.replace_table(s.filter("s_acctbal > 0").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation")), name, f"{path}/second")
    none = F.lit(None)
    appended = spark.read.parquet(f"{path}/kept").select(F.lit("appended").alias("step"), "id", "label", none.cast("int").alias("nation"))
    return appended.union(spark.table(name).select(F.lit("replaced"), "id", none.cast("string"), "nation"))


@query("feature_merge", "CDC-07 CDC-06", """
WITH f AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS units, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, day, CASE WHEN year(day) % 2 = 0 THEN units + 1 ELSE units END AS units, n FROM f
""")
def feature_merge(spark, d):
    """Features of a supplier and day: those of odd years and old ones of some even years, merged with new ones of even years."""
    from millrace.operators import features as X

    facts = table(spark, d, "lineitem").groupBy("l_suppkey", F.to_date("l_shipdate").alias("day")).agg(F.sum("l_quantity").alias("units"), F.count(F.lit(1)).alias("n"))
    even = F.year("day") % 2 == 0
    stored = facts.filter(~even | (F.year("day") % 4 == 0))
    return X.merge_features(stored, facts.filter(even).withColumn("units", F.col("units") + 1), ["l_suppkey", "day"])


@query("append_wider", "SNK-03", """
SELECT n_nationkey, n_name, CAST(NULL AS INT) AS region FROM nation UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM nation
""")
def append_wider(spark, d):
    path = scratch_path(spark, "wider")
    n = table(spark, d, "nation")
    S.append_wider(n.select("n_nationkey", "n_name"), path)
    S.append_wider(n.select("n_nationkey", "n_name", F.col("n_regionkey").alias("region")), path)
    return S.read_merged(spark, path).select("n_nationkey", "n_name", "region")


@query("csv_round_trip", "SNK-05 SRC-07 SRC-30", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier")
def csv_round_trip(spark, d):
    from millrace.sources.files import read_csv_text

    path = scratch_path(spark, "csv")
    table(spark, d, "supplier").drop("s_acctbal").repartition(4).write.option("header", True).csv(path)
    return read_csv_text(spark, path)


@query("json_round_trip", "SNK-06 SRC-06", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_round_trip(spark, d):
    path = scratch_path(spark, "json")
    table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal").repartition(4).write.json(path)
    return spark.read.json(path)


@query("clustered_write", "SNK-07 SRC-04 SRC-12", """
SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey BETWEEN 10 AND 20 GROUP BY 1
""")
def clustered_write(spark, d):
    from millrace.sources.files import read_path

    path = scratch_path(spark, "clustered")
    S.write_clustered(table(spark, d, "lineitem"), path, ["l_suppkey", "l_shipdate"])
    return read_path(spark, path).filter("l_suppkey BETWEEN 10 AND 20").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("catalog_table", "SNK-07 SNK-19 CDC-12 CDC-13 CDC-15 GOV-04 SRC-01", """
SELECT n_nationkey, n_name, 'true' AS contains_pii, false AS loaded_again FROM nation UNION ALL SELECT -1, 'NOWHERE', 'true', false
""")
def catalog_table(spark, d):
    from millrace.operators.governance import classify_table
    from millrace.sources.files import read_table

    path = scratch_path(spark, "catalog")
    name = "millrace_" + path.rsplit("-", 1)[1]
    nations = table(spark, d, "nation").select("n_nationkey", "n_name")
    S.load_if_empty(nations, name, path)
    again = S.load_if_empty(nations.limit(0), name, path)
    classify_table(spark, name, {"contains_pii": "true", "data_classification": "internal"})
    spark.sql(f"INSERT INTO {name} VALUES (-1, 'NOWHERE')")
    tagged = spark.sql(f"SHOW TBLPROPERTIES {name} ('contains_pii')").first()["value"]
    rows = read_table(spark, name).select("n_nationkey", "n_name", F.lit(tagged).alias("contains_pii"), F.lit(again).alias("loaded_again"))
    return rows


# ---- data quality ----------------------------------------------------------

LINE_RULES = [
    Q.expect("large discount", "l_discount <= 0.08"),
    Q.expect_or_drop("some quantity", "l_quantity >= 5"),
    Q.expect_or_drop("known flag", "l_returnflag IN ('A', 'N')"),
]


@query("expect_warn", "DQ-01", "SELECT l_orderkey, l_linenumber, l_partkey, l_discount FROM lineitem")
def expect_warn(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_discount")
    return Q.enforce(df, LINE_RULES[:1], "warnings")


@query("expect_warn_metrics", "DQ-01 SNK-13 SRC-27", """
SELECT 'lineitem' AS dataset, 'large discount' AS rule, 'warn' AS action, count(*) FILTER (l_discount <= 0.08) AS passed, count(*) FILTER (NOT l_discount <= 0.08) AS failed FROM lineitem
UNION ALL SELECT 'lineitem', 'some quantity', 'drop', count(*) FILTER (l_quantity >= 5), count(*) FILTER (NOT l_quantity >= 5) FROM lineitem
UNION ALL SELECT 'lineitem', 'known flag', 'drop', count(*) FILTER (l_returnflag IN ('A', 'N')), count(*) FILTER (l_returnflag NOT IN ('A', 'N')) FROM lineitem
""")
def expect_warn_metrics(spark, d):
    return Q.rule_metrics(table(spark, d, "lineitem"), "lineitem", LINE_RULES)


@query("expect_drop", "DQ-02 DQ-04", """
SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem WHERE l_quantity >= 5 AND l_returnflag IN ('A', 'N') GROUP BY 1
""")
def expect_drop(spark, d):
    kept = Q.enforce(table(spark, d, "lineitem"), LINE_RULES)
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query("expect_fail_passes", "DQ-03", "SELECT count(*) AS n FROM orders")
def expect_fail_passes(spark, d):
    rules = [Q.expect_or_fail("customer set", "o_custkey IS NOT NULL")]
    return Q.enforce(table(spark, d, "orders"), rules).agg(F.count(F.lit(1)).alias("n"))


@query("quarantine", "DQ-05", """
SELECT l_orderkey, l_linenumber, l_partkey, concat_ws('; ', CASE WHEN NOT l_quantity >= 5 THEN 'some quantity' END,
       CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'known flag' END) AS violations
FROM lineitem WHERE NOT (l_quantity >= 5 AND l_returnflag IN ('A', 'N'))
""")
def quarantine(spark, d):
    bad = Q.quarantine(table(spark, d, "lineitem"), LINE_RULES[1:])[1]
    return bad.select("l_orderkey", "l_linenumber", "l_partkey", "violations")


@query("declared_types", "DQ-07", """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_nationkey AS DOUBLE) AS nation FROM customer WHERE c_custkey IS NOT NULL
""")
def declared_types(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").cast("string").alias("nation"))
    typed = Q.with_declared_types(c, {"customer_id": "string", "nation": "double"})
    return Q.enforce(typed, [Q.expect_or_drop("customer known", "customer_id IS NOT NULL")])


def profiled_sql(column: str, numeric: bool) -> str:
    span = f"min({column})::DOUBLE AS min_value, max({column})::DOUBLE AS max_value" if numeric else "NULL::DOUBLE AS min_value, NULL::DOUBLE AS max_value"
    return f"""SELECT '{column}' AS column_name, count(*) AS n_rows, count(*) - count({column}) AS n_nulls, count(DISTINCT {column}) AS n_distinct,
      true AS near, {span} FROM orders"""


PROFILED = {"o_orderkey": True, "o_custkey": True, "o_orderstatus": False, "o_totalprice": True, "o_orderpriority": False}


@query("profile_table", "DQ-08", " UNION ALL ".join(profiled_sql(c, numeric) for c, numeric in PROFILED.items()))
def profile_table(spark, d):
    """Sketches per order status and year, stored, read back and merged; ``near``: the estimate is within 3 % of the distinct values."""
    path = scratch_path(spark, "profile")
    o = table(spark, d, "orders")
    numeric = [c for c, known in PROFILED.items() if known]
    parts = o.withColumn("part", F.concat_ws("/", "o_orderstatus", F.year("o_orderdate").cast("string")))
    Q.column_sketches(parts, list(PROFILED), ["part"], numeric).write.parquet(path)
    merged = Q.merged_profile(spark.read.parquet(path))
    # The distinct values themselves, to hold the estimates against: one row per column and value.
    cells = o.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in PROFILED])).alias("x")).select("x.*")
    exact = cells.filter("value IS NOT NULL").distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))
    near = F.abs(F.col("approx_distinct") - F.col("n_distinct")) <= 0.03 * F.col("n_distinct")
    return merged.join(exact, "column_name").select("column_name", "n_rows", "n_nulls", "n_distinct", near.alias("near"), "min_value", "max_value")


@query("duplicate_keys", "DQ-08", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def duplicate_keys(spark, d):
    return Q.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("reconcile", "DQ-09", """
SELECT (SELECT count(*) FROM orders) AS left_rows, (SELECT count(*) FROM orders WHERE o_orderkey IS NULL) AS left_null_keys,
       (SELECT count(*) FROM lineitem) AS right_rows, (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL) AS right_null_keys,
       count(DISTINCT o_orderkey) AS shared_keys, count(*) AS joined_rows FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def reconcile(spark, d):
    return Q.reconcile(
        table(spark, d, "orders").withColumnRenamed("o_orderkey", "key"), table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "key"), "key"
    )


@query("access_audit", "GOV-05", """
SELECT user_id, event_type, max(ts) AS last_accessed, count(*) AS reference_count,
       string_agg(DISTINCT regexp_extract(props, '([0-9]+)', 1), ',' ORDER BY regexp_extract(props, '([0-9]+)', 1)) AS names_used
FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 14 DAY GROUP BY 1, 2
""")
def access_audit_query(spark, d):
    e = table(spark, d, "events").withColumn("name", F.regexp_extract("props", "([0-9]+)", 1))
    return access_audit(e, ["user_id", "event_type"], "name", "ts", F.lit("2024-01-31").cast("timestamp_ntz"), 14)

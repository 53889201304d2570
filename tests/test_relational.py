import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import aggregates as A
from millrace.operators import governance as G
from millrace.operators import relational as R
from millrace.streaming.runs import settings


def test_bands_overlap_and_wrap(spark):
    df = spark.createDataFrame([(1, -100.0), (2, 65.0), (3, -175.0), (4, -150.0), (5, 0.0)], "id int, lon double")
    got = rows(R.tag_longitude_bands(df, "lon"), "id", "band")
    assert got == [(1, "americas"), (2, "apac"), (2, "emea"), (3, "apac"), (4, "americas"), (4, "apac"), (5, "emea")]
    assert {n: rows(p, "id") for n, p in R.split_by_longitude(df, "lon").items()} == {
        "americas": [(1,), (4,)], "emea": [(2,), (5,)], "apac": [(2,), (3,), (4,)]
    }


def test_lookup_broadcasts_only_below_the_threshold(spark):
    facts = spark.range(100).withColumnRenamed("id", "k")
    ref = spark.range(50).select(F.col("id").alias("k"), F.lit("v").alias("v"))

    def plan(threshold):
        with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": threshold}):
            return R.lookup(facts, ref, "k")._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan("10MB")
    assert "SortMergeJoin" in plan("-1")
    assert R.lookup(facts, ref, "k").count() == 100


def test_latest_day_is_a_pushed_scalar(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 23)), (2, dt.datetime(2024, 1, 2, 1)), (3, None)], "id int, ts timestamp")
    assert rows(R.latest_day(df, "ts"), "id") == [(2,)]


def test_position_filter(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 0.0, 2.0), (3, None, 2.0), (4, 1.0, 0.0)], "id int, lat double, lon double")
    assert rows(df.filter(R.known_position(F.col("lat"), F.col("lon"))), "id") == [(1,)]


def test_optional_parameter(spark):
    df = spark.createDataFrame([("Warranty",), ("Recall",)], "t string")
    both = df.filter(R.optional_match(None, F.lit(False)))
    assert both.count() == 2
    assert rows(df.filter(R.optional_match("rec", R.contains_text(F.col("t"), "REC")))) == [("Recall",)]


def test_child_summary_keeps_childless(spark):
    parents = spark.createDataFrame([("s1",), ("s2",)], "sid string")
    kids = spark.createDataFrame([("s1", 2, "second"), ("s1", 1, "first")], "sid string, id int, text string")
    assert rows(R.child_summary(parents, kids, "sid", "id", "text")) == [("s1", 2, "first"), ("s2", 0, None)]


def test_stats_row_turns_empty_into_zero(spark):
    df = spark.createDataFrame([(1,)], "a int").filter("a > 5")
    assert rows(R.stats_row(spark, {"s": df.agg(F.sum("a")), "n": df.agg(F.count("a"))})) == [(0, 0)]


def test_union_distinct_collapses(spark):
    df = spark.createDataFrame([(1.0, "x")], "bal double, code string")
    assert R.union_rows([df, df], distinct=True).count() == 1
    assert R.union_rows([df, df]).count() == 2


def test_only_top_groups_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("c",)], "k string")
    assert rows(R.only_top_groups(df, ["k"], 1)) == [("b",), ("b",)]


def test_extract_resumes_at_the_mark(spark):
    data = [(i, dt.datetime(2024, 1, 1, 0, 0, i)) for i in range(5)]
    df = spark.createDataFrame(data, "id int, at timestamp")
    part = R.high_water_extract(df, "at", "id", F.lit("2024-01-01 00:00:02").cast("timestamp"))
    assert [r.id for r in part.collect()] == [3, 4]
    mark = R.next_mark(part).first()[0]
    assert mark == "2024-01-01 00:00:04.000000"
    assert R.high_water_extract(df, "at", "id", F.lit(mark).cast("timestamp")).count() == 0


def test_drop_columns_without_values(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", None)], "a int, b string, c string")
    assert R.drop_columns_without_values(df).columns == ["a", "b"]


def test_distinct_per_band_counts_an_entity_once(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 50), (1, "b", 5), (1, None, 5)], "g int, e string, v int")
    bands = {"low": F.col("v") < 10, "high": F.col("v") >= 10}
    assert rows(A.distinct_per_band(df, ["g"], "e", bands)) == [(1, 2, 2, 1)]


def test_dense_curve(spark):
    df = spark.createDataFrame([(3, 1), (6, 2)], "b bigint, n int")
    assert rows(A.dense_curve(df, "b", ["n"])) == [(3, 1), (4, 0), (5, 0), (6, 2)]
    assert A.dense_curve(df.filter("b > 9"), "b", ["n"]).count() == 0


def test_exact_quantile_with_hot_group(spark):
    df = spark.range(1000).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"), "id")
    from millrace.operators import windows as W

    placed = W.with_positions(df, ["g"], ["v", "id"], "p").filter("p = 950")
    assert rows(placed, "v") == [(949.0,)]
    assert rows(A.exact_quantile(df, ["g"], "v", 0.95, "id")) == [("g", 949.0)]


def test_client_stats_active(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 0, 0)), ("b", dt.datetime(2024, 1, 1, 0, 9))], "c string, ts timestamp")
    got = A.client_stats(df, "c", "ts", F.lit("2024-01-01 00:10:00").cast("timestamp"))
    assert rows(got, "c", "is_active") == [("a", False), ("b", True)]


def test_role_masks(spark):
    df = spark.createDataFrame([("123-45-6789",), (None,)], "ssn string")
    cases = [("admins", lambda c: c), ("analysts", G.fixed_text("MASKED"))]

    def seen(roles):
        return [r[0] for r in df.select(G.role_mask(F.col("ssn"), roles, cases, G.last_four)).collect()]

    assert seen(["admins", "analysts"]) == ["123-45-6789", None]
    assert seen(["analysts"]) == ["MASKED", None]
    assert seen([]) == ["***-**-6789", None]


def test_tags_survive_a_table(spark, tmp_path):
    df = spark.createDataFrame([("a@x", "b")], "email string, other string")
    G.tag_columns(df, {"email": ["class.email"]}).write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    mask = G.fixed_text("***")
    assert rows(G.mask_tagged(read, ["class.email"], mask, "ann", ["ann"])) == [("***", "b")]
    assert rows(G.mask_tagged(read, ["class.email"], mask, "bob", ["ann"])) == [("a@x", "b")]


def test_anonymous_id_pads(spark):
    assert spark.range(1).select(G.anonymous_id(F.lit("E001"))).first()[0] == "EMP_00E001"


def test_table_class(spark):
    spark.sql("DROP TABLE IF EXISTS classed")
    spark.range(1).write.saveAsTable("classed")
    G.classify_table(spark, "classed", {"contains_pii": "true"})
    props = {r[0]: r[1] for r in spark.sql("SHOW TBLPROPERTIES classed").collect()}
    assert props["contains_pii"] == "true"
    assert spark.range(1).select(F.current_user()).first()[0]


def test_split_left_join_of_a_hot_key(spark):
    """A third of the right side on one key: same rows as a plain join, no task with more than twice the median."""
    left = spark.createDataFrame([(i, f"n{i}") for i in range(300)] + [(None, "none"), (7, "again")], "id int, name string")
    facts = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 200).cast("int").alias("id"), F.col("id").alias("v"), F.lit(None).cast("string").alias("w"))
    facts = facts.union(spark.createDataFrame([(None, 1, "x")], "id int, v long, w string")).repartition(6)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for k, v in zip(before, ("false", "-1", "16")):
        spark.conf.set(k, v)
    try:
        split = R.split_left_join(left, facts, ["id"], rows_per_piece=100)
        sizes = sorted(r["count"] for r in split.filter("v IS NOT NULL").groupBy(F.spark_partition_id()).count().collect())
        plain = left.join(facts, "id", "left").select(*split.columns)
        assert split.columns == ["id", "name", "v", "w"]
        assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert R.split_left_join(left, facts.limit(0), ["id"]).filter("v IS NULL").count() == 302
    assert R.split_left_join(left.limit(0), facts, ["id"]).count() == 0

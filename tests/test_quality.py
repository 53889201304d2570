import pytest
from conftest import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from millrace.operators import quality as Q

RULES = [
    Q.expect("early", "day < 10"),
    Q.expect_or_drop("positive", "balance > 0 AND arrears > 0"),
    Q.expect_or_fail("center set", "center IS NOT NULL"),
]


@pytest.fixture(scope="module")
def loans(spark):
    data = [(1, 5.0, 1.0, "x", 3), (2, None, 1.0, "x", 30), (3, -1.0, 2.0, "y", None), (4, 5.0, None, "y", 1), (5, 1.0, 1.0, "z", 20)]
    return spark.createDataFrame(data, "id int, balance double, arrears double, center string, day int")


def test_warn_keeps_and_drop_removes(loans):
    seen = Observation("loans")
    kept = Q.enforce(loans, RULES, seen)
    assert rows(kept, "id") == [(1,), (5,)]
    assert seen.get == {"rows": 5, "failed: early": 3, "failed: positive": 3, "failed: center set": 0}


def test_fail_names_the_rule(loans):
    bad = loans.withColumn("center", F.when(F.col("id") != 2, F.col("center")))
    with pytest.raises(Exception, match="violated: center set"):
        Q.enforce(bad, RULES).collect()


def test_fail_looks_only_at_the_rows_of_the_dataset(spark, tmp_path):
    spark.createDataFrame([(1, 2.0)], "id int, v double").write.parquet(str(tmp_path / "sales"))
    spark.createDataFrame([(1, "Bern"), (2, "test")], "id int, city string").write.parquet(str(tmp_path / "shops"))
    sales, shops = (spark.read.parquet(str(tmp_path / n)) for n in ("sales", "shops"))
    rule = [Q.expect_or_fail("real", "city != 'test'")]
    # The shop without sales is no row of the joined dataset, nor is it one of the totals.
    assert rows(Q.enforce(sales.join(shops, "id"), rule), "city") == [("Bern",)]
    assert rows(Q.enforce(sales.join(shops, "id").groupBy("city").agg(F.sum("v").alias("v")), rule)) == [("Bern", 2.0)]
    with pytest.raises(Exception, match="violated: real"):
        Q.enforce(shops.join(sales, "id", "left"), rule).collect()


def test_fail_is_not_pruned_away(loans):
    bad = loans.withColumn("center", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="violated: center set"):
        Q.enforce(bad, RULES).count()


def test_failed_stream_commits_nothing(spark, tmp_path, loans):
    from millrace.streaming.runs import drain_to_parquet

    bad = loans.withColumn("center", F.when(F.col("id") != 5, F.col("center")))
    bad.write.parquet(str(tmp_path / "in"))
    stream = Q.enforce(spark.readStream.schema(bad.schema).parquet(str(tmp_path / "in")), RULES)
    with pytest.raises(Exception, match="center set"):
        drain_to_parquet(stream, str(tmp_path / "out"), str(tmp_path / "cp"), 120)
    assert not list((tmp_path / "out").glob("_spark_metadata/0"))


def test_quarantine_is_the_exact_complement(loans):
    good, bad = Q.quarantine(loans, RULES[:2])
    assert rows(good.select("id").union(bad.select("id"))) == [(i,) for i in range(1, 6)]
    assert rows(bad, "id", "violations") == [(2, "early; positive"), (3, "early; positive"), (4, "positive"), (5, "early")]


def test_rules_on_aggregates(loans):
    sums = loans.groupBy("center").agg(F.sum("balance").alias("total"))
    assert rows(Q.enforce(sums, [Q.expect_or_drop("plus", "total > 0")])) == [("x", 5.0), ("y", 4.0), ("z", 1.0)]


def test_expect_all_and_metrics(loans):
    rules = Q.expect_all({"a": "id > 1", "b": "id < 5"}, Q.DROP)
    assert rows(Q.enforce(loans, rules), "id") == [(2,), (3,), (4,)]
    assert rows(Q.rule_metrics(loans, "loans", rules)) == [("loans", "a", "drop", 4, 1), ("loans", "b", "drop", 4, 1)]


def test_declared_types(spark):
    df = spark.createDataFrame([("1", "x"), ("q", "y")], "n string, s string")
    assert rows(Q.with_declared_types(df, {"n": "double", "s": "string"})) == [(1.0, "x"), (None, "y")]


def test_reconcile_counts_pairs_without_making_them(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (1,), (1,), (3,)], "k int")
    assert rows(Q.reconcile(a, b, "k")) == [(4, 1, 4, 0, 1, 6)]
    assert rows(Q.reconcile(a, b.filter("k = 3"), "k")) == [(4, 1, 1, 0, 0, 0)]


def test_unique_keys(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError, match="duplicate"):
        Q.require_unique(df, ["k"])
    Q.require_unique(df.distinct(), ["k"])


def test_profile(loans):
    out = {r.column_name: r for r in Q.profile(loans, ["balance", "center"], ["balance"]).collect()}
    assert (out["balance"].n_nulls, out["balance"].min_value, out["balance"].max_value) == (1, -1.0, 5.0)
    assert out["center"].approx_distinct == 3 and out["center"].min_value is None


def test_profiles_of_loads_merge(spark):
    df = spark.range(50000).selectExpr("id % 7 AS day", "cast(id % 20011 AS string) AS a", "CASE WHEN id % 10 = 0 THEN NULL ELSE id END AS b")
    parts = Q.column_sketches(df, ["a", "b"], ["day"], ["b"])
    assert parts.count() == 14
    merged = {r.column_name: r for r in Q.merged_profile(parts).collect()}
    whole = {r.column_name: r for r in Q.profile(df, ["a", "b"], ["b"]).collect()}
    for name, distinct in (("a", 20011), ("b", 45000)):
        assert abs(merged[name].approx_distinct - distinct) < 0.03 * distinct
        assert merged[name][:3] == whole[name][:3] and merged[name].n_rows == 50000
    assert (merged["b"].n_nulls, merged["b"].min_value, merged["b"].max_value) == (5000, 1.0, 49999.0)
    assert Q.profile(df.limit(0), ["a"]).first()[1:4] == (0, 0, 0)

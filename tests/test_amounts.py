"""Results that must not depend on how much data there is, or on null keys."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates, features, vectors, windows
from millrace.sinks import tables
from millrace.sources import files
from millrace.streaming import runs
from tests.conftest import rows


def test_all_updates_of_a_long_run_are_counted(spark, tmp_path):
    for i in range(110):
        folder = tmp_path / "in"
        folder.mkdir(exist_ok=True)
        (folder / f"{i:03}.json").write_text("\n".join(json.dumps({"x": i}) for _ in range(3)))
    stream = spark.readStream.schema("x int").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    counted = stream.observe("seen", F.count(F.lit(1)).alias("n"))
    query = runs.drain_to_parquet(counted, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert runs.observed(query, "seen") == {"n": 330}
    assert runs.parse_progress(runs.updates_of(query)).agg({"numInputRows": "sum"}).first()[0] == 330


def test_bucket_count_is_that_of_the_stored_table(spark, tmp_path):
    old = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v"), F.lit(0).alias("s"))
    tables.KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=8).merge(old, ["s"])
    again = tables.KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=64)
    assert again.buckets == 8
    again.merge(old.limit(3).withColumn("v", F.lit(2)).withColumn("s", F.lit(1)), ["s"])
    assert again.read().count() == 100 and again.read().filter("v = 2").count() == 3


def test_null_keys_stay(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), (None, 3, 3.0), (None, 4, 5.0)], "k string, t int, v double")
    assert windows.even_subsample(df, ["k"], ["t"], 2).count() == 4
    assert rows(aggregates.exact_quantile(df, ["k"], "v", 0.5, "t")) == [("a", 1.0), (None, 3.0)]
    assert windows.dense_batch_number(df, ["k"], "t", "n").count() == 4
    assert rows(windows.top_ranked(df, ["k"], "v").select("k", "v")) == [("a", 2.0), (None, 5.0)]


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0), (3, None, None)], "id int, a double, b double")
    got = rows(features.scaled_values(df, ["a", "b"], ["id"]))
    assert [r[1] for r in got] == [0.0, 0.0, 0.0]
    assert [round(r[2], 4) for r in got] == [-0.7071, 0.7071, 0.0]


def test_a_changed_type_is_noticed_and_kept(spark, tmp_path):
    folder, store = tmp_path / "in", str(tmp_path / "store")
    folder.mkdir()
    (folder / "a.json").write_text('{"id": 1, "x": 5}')
    assert files.resolve_schema(spark, str(folder), "json", store).simpleString() == "struct<id:bigint,x:bigint>"
    (folder / "b.json").write_text('{"id": 2, "x": "five"}')
    with pytest.raises(files.SchemaChanged, match="changed types: x"):
        files.resolve_schema(spark, str(folder), "json", store)
    schema = files.resolve_schema(spark, str(folder), "json", store, files.ADD)
    assert rows(spark.read.schema(schema).json(str(folder))) == [(1, "5"), (2, "five")]


def test_nearest_vectors_from_many_small_batches(spark):
    with runs.settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "10"}):
        table = spark.range(200).coalesce(1).select("id", F.array(F.cos(F.col("id") / 100), F.sin(F.col("id") / 100)).alias("v"))
        queries = spark.createDataFrame([(q, [1.0, q / 10]) for q in range(5)], "q int, v array<double>")
        best = vectors.cosine_top_k(table, "id", "v", queries, "q", "v", 1)
        assert rows(best.select("q", "id")) == [(0, 0), (1, 10), (2, 20), (3, 29), (4, 38)]

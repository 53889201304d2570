import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import windows as W


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; keys may be null; times repeat."""
    rnd = random.Random(5)
    data = [("hot", i // 3, i, rnd.random()) for i in range(900)]
    data += [(k, i, 10_000 + 100 * j + i, rnd.random()) for j, k in enumerate(["a", "b", None]) for i in range(30)]
    rnd.shuffle(data)
    return spark.createDataFrame(data, "k string, t int, id int, v double").repartition(4)


def test_positions_equal_row_number(skewed):
    plain = skewed.withColumn("p", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")).cast("bigint"))
    sliced = W.with_positions(skewed, ["k"], ["t", "id"], "p")
    assert rows(sliced, "k", "id", "p") == rows(plain, "k", "id", "p")


def test_global_positions_are_consecutive(skewed):
    got = W.with_positions(skewed, [], ["t", "id"], "p").orderBy("p").select("p", "t", "id").collect()
    assert [r.p for r in got] == list(range(1, 991))
    assert [(r.t, r.id) for r in got] == sorted((r.t, r.id) for r in got)


@pytest.mark.parametrize("block", [8, 50, 10_000])
def test_blocked_windows_equal_plain(skewed, block):
    def build(w):
        return {
            "l1": F.lag("v", 1).over(w), "l7": F.lag("v", 7).over(w), "n2": F.lead("v", 2).over(w),
            "m": F.round(F.avg("v").over(w.rowsBetween(-6, 0)), 9),
        }

    w = Window.partitionBy("k").orderBy("t", "id")
    plain = skewed.select("*", *[c.alias(n) for n, c in build(w).items()])
    blocked = W.over_groups(skewed, ["k"], ["t", "id"], build, 7, 2, block_rows=block)
    assert rows(plain) == rows(blocked)


def test_frames_longer_than_a_block_are_refused(skewed):
    with pytest.raises(ValueError, match="shorter"):
        W.over_groups(skewed, ["k"], ["t", "id"], lambda w: {}, 9, 0, block_rows=8)


@pytest.mark.parametrize("n", [1, 7, 30, 64])
def test_even_subsample_equals_ntile(skewed, n, monkeypatch):
    w = Window.partitionBy("k").orderBy("t", "id")
    tiles = skewed.withColumn("tile", F.ntile(n).over(w)).withColumn("total", F.count("*").over(Window.partitionBy("k")))
    first = Window.partitionBy("k", "tile").orderBy("t", "id")
    want = tiles.withColumn("rn", F.row_number().over(first)).filter("rn = 1 OR total <= %d" % n)
    keyed = skewed.filter("k IS NOT NULL")
    for block in (10, 10_000):
        monkeypatch.setattr(W, "BLOCK_ROWS", block)
        got = W.even_subsample(keyed, ["k"], ["t", "id"], n)
        assert rows(got, "k", "id") == rows(want.filter("k IS NOT NULL"), "k", "id")
        assert max(r["count"] for r in got.groupBy("k").count().collect()) <= n


def test_even_subsample_of_whole_table(skewed):
    assert W.even_subsample(skewed, [], ["t", "id"], 10).count() == 10


def test_latest_per_key_both_ways(skewed):
    a = W.latest_per_key(skewed, ["k"], ["t", "id"])
    b = W.first_row_per_key(skewed, ["k"], [F.desc("t"), F.desc("id")])
    assert rows(a, "k", "t", "id", "v") == rows(b, "k", "t", "id", "v")


def test_first_row_prunes_before_the_shuffle(skewed):
    plan = W.first_row_per_key(skewed, ["k"], [F.desc("t"), F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_top_ranked_keeps_ties(spark):
    df = spark.createDataFrame([("w", "a", 3), ("w", "b", 3), ("w", "c", 1), ("x", "d", 1)], "g string, u string, n int")
    assert rows(W.top_ranked(df, ["g"], "n"), "u") == [("a",), ("b",), ("d",)]


def test_impute_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, None), (None, 3, None), (None, 4, 8.0)], "k string, id int, v double")
    assert rows(W.impute_with_group_mean(df, ["k"], ["v"]), "id", "v") == [(1, 2.0), (2, 2.0), (3, 8.0), (4, 8.0)]


def test_dense_ids(spark):
    df = spark.createDataFrame([("x", 3), ("y", 1), ("z", 2)], "h string, first int")
    assert rows(W.dense_ids(df, ["first", "h"]), "h", "id") == [("x", 2), ("y", 0), ("z", 1)]


def test_dense_batch_number(spark):
    df = spark.createDataFrame([("m", 5), ("m", 5), ("m", 9), ("r", 2)], "t string, b int")
    assert rows(W.dense_batch_number(df, ["t"], "b", "no"), "t", "b", "no") == [("m", 5, 1), ("m", 5, 1), ("m", 9, 2), ("r", 2, 1)]


def test_quantile_sketches_merge_beyond_their_size(spark):
    from millrace.operators import aggregates as A

    df = spark.range(60000).selectExpr("id % 2 AS k", "id % 30 AS batch", "cast((id * 7919) % 60000 AS double) AS v")
    df = df.union(spark.createDataFrame([(0, 0, None), (1, 0, float("nan")), (None, 0, 5.0)], "k long, batch long, v double"))
    parts = A.quantile_sketches(df, ["k", "batch"], "v", size=200)
    assert parts.select(F.max(F.length("sketch"))).first()[0] < 8000  # of 2000 numbers
    figures = A.quantiles_of(A.merged_sketches(parts, ["k"]), ["k"], "v")
    ranks = {r[0]: r[1:] for r in A.ranks_of(df.filter("NOT isnan(v)"), figures, ["k"], "v").collect()}
    for k in (0, 1):
        assert all(abs(rank - share) < 0.02 for rank, share in zip(ranks[k], A.SHARES))
    got = {r.k: r for r in figures.collect()}
    assert (got[0].n, got[1].n, got[None].n, got[None].p50_v) == (30000, 30000, 1, 5.0)
    small = {r.k: r for r in A.percentiles(df.filter("v < 200"), ["k"], "v").collect()}
    assert small[0].p50_v in (98.0, 99.0, 100.0) and small[0].n == 100


def test_rows_kept_in_memory_are_dealt_by_their_number(spark):
    """Windows over small groups keep the tasks they were dealt to: more rows are more tasks, not larger ones."""
    daily = spark.range(600).select((F.col("id") % 60).alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 60).cast("int")).alias("day"), F.col("id").alias("units"))
    plain = W.lag_features(daily, ["k"], "day", "units")
    dealt = W.lag_features(W.in_bounded_tasks(daily, ["k"], 600, 30), ["k"], "day", "units")
    assert plain.rdd.getNumPartitions() <= 4 and dealt.rdd.getNumPartitions() == 20
    assert rows(dealt) == rows(plain)
    assert W.in_bounded_tasks(daily, ["k"], 600) is daily


def test_regression_rows_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    from millrace.operators import features
    from millrace.queries.texts import gbt_regression

    items = spark.range(400).select(
        (F.col("id") % 40).alias("l_suppkey"), F.timestamp_add("DAY", (F.col("id") / 40).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("l_shipdate"), F.lit(1.0).alias("l_quantity")
    )
    items.write.parquet(f"{tmp_path}/lineitem.parquet")
    tasks = []
    monkeypatch.setattr(W, "TASK_ROWS", 25)
    monkeypatch.setattr(features, "fit_regressor", lambda train, *args, **options: tasks.append(train.rdd.getNumPartitions()))
    monkeypatch.setattr(features, "score", lambda model, df, keep: df.select(*keep))
    gbt_regression(spark, str(tmp_path))
    assert tasks == [16]

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import changes as C
from millrace.operators.relational import as_of
from millrace.sinks import tables as S

LOG = [
    ("a", 1, "UPSERT", 10), ("a", 3, "DELETE", None), ("a", 2, "UPSERT", 20),  # out of order
    ("b", 1, "UPSERT", 1), ("b", 2, "DELETE", None), ("b", 5, "UPSERT", 5),  # delete, then back
    ("c", 4, "UPSERT", 4), ("c", 4, "UPSERT", 4),  # repeated
]


@pytest.fixture
def log(spark):
    return spark.createDataFrame(LOG, "k string, seq int, op string, v int")


def test_scd1_deletes_and_returns(log):
    out = C.apply_changes(log, ["k"], ["seq"], "op = 'DELETE'", ["seq", "op"])
    assert out.columns == ["k", "v"]
    assert rows(out) == [("b", 5), ("c", 4)]


def test_scd2_intervals(log):
    out = C.change_history(log, ["k"], ["seq"], "op = 'DELETE'", ["op", "seq"])
    assert rows(out.filter("k != 'c'"), "k", "v", "valid_from", "valid_to") == [
        ("a", 10, 1, 2), ("a", 20, 2, 3), ("b", 1, 1, 2), ("b", 5, 5, None)
    ]
    assert rows(as_of(out, 2), "k", "v") == [("a", 20)]
    assert rows(as_of(out, 1), "k", "v") == [("a", 10), ("b", 1)]


def test_scd2_blocks_equal_plain(spark):
    rnd = random.Random(3)
    data = [("hot" if rnd.random() < 0.5 else f"k{rnd.randrange(9)}", i, rnd.choice(["U", "U", "DELETE"]), i) for i in range(400)]
    log = spark.createDataFrame(data, "k string, seq int, op string, v int").repartition(4)
    plain = C.change_history(log, ["k"], ["seq"], "op = 'DELETE'")
    blocks = C.change_history(log, ["k"], ["seq"], "op = 'DELETE'", block_rows=4)
    assert rows(plain) == rows(blocks)
    # Intervals of a key do not overlap.
    ends = {}
    for r in plain.orderBy("k", "valid_from").collect():
        assert r.valid_to is None or r.valid_from < r.valid_to
        assert ends.get(r.k, -1) is not None and ends.get(r.k, -1) <= r.valid_from
        ends[r.k] = r.valid_to


def test_keyed_table_is_order_free_and_repeatable(spark, tmp_path, log):
    want = rows(C.apply_changes(log, ["k"], ["seq"], "op = 'DELETE'"), "k", "v")
    parts = [log.filter(f"seq = {s}") for s in (5, 3, 1, 4, 2, 1)]
    table = S.KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    for part in parts:
        table.merge(part, ["seq"], "op = 'DELETE'")
    assert rows(table.read(), "k", "v") == want


def test_keyed_table_finishes_an_interrupted_move(spark, tmp_path, log):
    table = S.KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    table.merge(log.filter("k = 'b'"), ["seq"], "op = 'DELETE'")
    # A merge that died after writing its buckets: they lie complete beside the table.
    other = S.KeyedTable(spark, str(tmp_path / "u"), ["k"], buckets=4)
    other.merge(log, ["seq"], "op = 'DELETE'")
    (tmp_path / "u").rename(tmp_path / "t_staged")
    (tmp_path / "t_staged" / "_SUCCESS").touch()
    table.recover()
    assert rows(table.read(), "k", "v") == [("b", 5), ("c", 4)]
    assert not (tmp_path / "t_staged").exists()


def test_keyed_table_merge_touches_only_changed_buckets(spark, tmp_path):
    table = S.KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=8)
    table.merge(spark.range(200).withColumn("seq", F.lit(1)), ["seq"])
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    table.merge(spark.createDataFrame([(7, 2)], "id bigint, seq int"), ["seq"])
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    assert len(set(before.items()) - set(after.items())) == 1
    assert table.read().count() == 200


def test_upsert_needs_equal_schemas(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    b = spark.createDataFrame([(2, "z"), (3, "w")], "id int, v string")
    assert rows(C.upsert(a, b, ["id"])) == [(1, "x"), (2, "z"), (3, "w")]
    with pytest.raises(ValueError, match="schemas differ"):
        C.upsert(a, b.withColumn("v", F.lit(1)), ["id"])


def test_insert_absent_on_composite_key(spark):
    a = spark.createDataFrame([(1, 1), (1, 2)], "j int, r int")
    b = spark.createDataFrame([(1, 2), (1, 3), (2, 1)], "j int, r int")
    assert rows(C.insert_absent(a, b, ["j", "r"])) == [(1, 3), (2, 1)]


def test_update_and_delete_treat_null_as_no(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, v string")
    assert rows(C.delete_where(df, "v = 'a'")) == [(2, None), (3, "b")]
    assert rows(C.update_where(df, "v = 'a'", {"v": F.lit("z")})) == [(1, "z"), (2, None), (3, "b")]
    assert rows(C.update_where(df, None, {"v": F.lit(dt.date(2024, 1, 2))}), "v") == [("2024-01-02",)] * 3


def test_add_columns_is_idempotent(spark):
    df = spark.range(1)
    once = C.add_columns(df, {"d": "string"})
    assert C.add_columns(once, {"d": "string"}).columns == ["id", "d"]


def test_table_writes(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    S.overwrite_table(df, "w1")
    S.append_table(df, "w1")
    assert spark.table("w1").count() == 2
    assert not S.load_if_empty(df, "w1")
    S.replace_table(df.withColumn("n", F.lit(2)), "w1")
    assert spark.table("w1").columns == ["id", "v", "n"]
    spark.sql("INSERT INTO w1 VALUES (2, 'b', 3)")
    assert rows(spark.table("w1")) == [(1, "a", 2), (2, "b", 3)]
    spark.sql("DROP TABLE IF EXISTS w2")
    assert S.load_if_empty(df, "w2")
    spark.sql("CREATE SCHEMA IF NOT EXISTS extra")
    spark.sql("DROP SCHEMA IF EXISTS extra")


def test_daily_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5)), (2, dt.datetime(2024, 1, 2, 6))], "id int, ts timestamp")
    S.write_daily(df, str(tmp_path / "d"), "ts")
    assert sorted(p.name for p in (tmp_path / "d").glob("event_date=*")) == ["event_date=2024-01-01", "event_date=2024-01-02"]


def test_feature_merge_by_two_columns(spark):
    from millrace.operators import features as X

    old = spark.createDataFrame([(1, 1, 5.0), (1, 2, 6.0)], "k int, day int, v double")
    new = spark.createDataFrame([(1, 2, 7.0), (2, 1, 8.0)], "k int, day int, v double")
    assert rows(X.merge_features(old, new, ["k", "day"])) == [(1, 1, 5.0), (1, 2, 7.0), (2, 1, 8.0)]
    with pytest.raises(ValueError, match="duplicate keys"):
        X.merge_features(old, new.union(new), ["k", "day"])
    with pytest.raises(ValueError, match="without a value"):
        X.merge_features(old, new.withColumn("day", F.lit(None).cast("int")), ["k", "day"])

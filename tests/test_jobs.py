import datetime as dt
import gzip
import json

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import features as X
from millrace.operators import tracks
from millrace.operators import vectors as V
from millrace.plans import bakery, banking, flights, hr, loans, telemetry
from millrace.sinks import artifacts, messages
from millrace.sinks.serving import snapshot_to_store


def brute_force(unit, query, k):
    sims = np.round(unit @ (query / np.linalg.norm(query)), 12)
    best = sorted(range(len(unit)), key=lambda i: (-sims[i], i))[:k]
    return [(i, sims[i]) for i in best]


@pytest.mark.parametrize("cells, piece, block", [(None, 8192, 1024), (12, 20, 2)])
def test_cosine_top_k_equals_brute_force(spark, monkeypatch, cells, piece, block):
    monkeypatch.setattr(V, "PIECE_ROWS", piece)
    monkeypatch.setattr(V, "QUERY_ROWS", block)
    rng = np.random.default_rng(3)
    data = rng.normal(size=(300, 8)).astype("float32").astype("float64")
    data[50:150] = data[49]  # a third of the vectors are copies
    odd = [(1000, None), (1001, []), (1002, [0.0] * 8), (1003, [float("nan")] + [1.0] * 7)]
    table = [(i, v.tolist()) for i, v in enumerate(data)] + odd
    vectors = spark.createDataFrame(table, "id bigint, v array<float>").repartition(5)
    asked = [3, 49, 200, 250, 299]
    queries = spark.createDataFrame([(q, data[q].tolist()) for q in asked] + [(-1, None), (-2, [0.0] * 8)], "q bigint, qv array<double>")
    index = V.VectorIndex(vectors, "id", "v", cells)
    assert index.counts.sum() == 300
    got = index.nearest(queries, "q", "qv", 4, 1).collect()
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    found = {(r.q, r["rank"]): (r.id, r.similarity) for r in got}
    assert len(found) == len(got) == 4 * len(asked)
    for q in asked:
        expected = brute_force(unit, data[q], 4)
        assert [found[q, k + 1][0] for k in range(4)] == [i for i, _ in expected]
        assert [found[q, k + 1][1] for k in range(4)] == pytest.approx([x for _, x in expected], abs=1e-9)
    assert index.nearest(queries.limit(0), "q", "qv").count() == 0
    assert V.cosine_top_k(vectors.limit(0), "id", "v", queries, "q", "qv").count() == 0
    with pytest.raises(ValueError, match="differently"):
        index.nearest(queries.withColumnRenamed("q", "id"), "id", "qv")


def test_index_skips_cells_and_first_round_recalls(spark):
    """Clustered vectors: the exact search compares a small part of all pairs, and its first round alone finds nearly all."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    data = (centres[rng.integers(0, 40, 8000)] + 0.15 * rng.normal(size=(8000, 16)))
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id bigint, v array<double>")
    queries = vectors.filter("id % 100 = 0").selectExpr("id q", "v qv")
    index = V.VectorIndex(vectors, "id", "v", 40)
    pairs = []
    best = index._best

    def counted(wanted, query_key, k):
        sizes = spark.createDataFrame([(i, int(n)) for i, n in enumerate(index.counts)], "_cell int, n long")
        pairs.append(wanted.join(sizes, "_cell").agg(F.sum("n")).first()[0] or 0)
        return best(wanted, query_key, k)

    index._best = counted
    exact = {(r.q, r["rank"]): r.id for r in index.nearest(queries, "q", "qv", 3).collect()}
    for q in range(0, 8000, 100):
        assert [exact[q, k] for k in (1, 2, 3)] == [i for i, _ in brute_force(unit, data[q], 3)]
    assert sum(pairs) < 0.3 * 80 * 8000
    first = {(r.q, r["rank"]): r.id for r in index.nearest(queries, "q", "qv", 3, exact=False).collect()}
    assert sum(first.get(k) == v for k, v in exact.items()) >= 0.9 * len(exact)


def test_centroids_and_cosine(spark):
    df = spark.createDataFrame([(1, [1.0, 3.0]), (1, [3.0, 5.0])], "g int, v array<double>")
    assert rows(V.centroids(df, "g", "v")) == [(1, [2.0, 4.0])]
    assert spark.range(1).select(V.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0)))).first()[0] == pytest.approx(0.7071, abs=1e-4)


def test_split_is_fixed_and_complete(spark):
    df = X.hash_split(spark.range(2000), "id")
    shares = {r.split: r["count"] / 2000 for r in df.groupBy("split").count().collect()}
    assert shares == {"train": pytest.approx(0.8, abs=0.03), "validate": pytest.approx(0.1, abs=0.03), "test": pytest.approx(0.1, abs=0.03)}
    with pytest.raises(ValueError):
        X.hash_split(df, "id", {"a": 50})


def test_models_learn(spark):
    df = spark.range(400).select(
        "id", (F.col("id") % 20).cast("double").alias("x"), F.when(F.col("id") % 3 == 0, "u").otherwise("v").alias("c")
    ).withColumn("y", (F.col("x") > 9).cast("int")).withColumn("z", F.col("x") * 2)
    train, test = df.filter("id < 300"), df.filter("id >= 300").withColumn("c", F.lit("unseen"))
    model = X.fit_classifier(train, "y", ["x"], ["c"], maxIter=3, maxDepth=2)
    assert X.f1(X.score(model, test, ["id", "y"]), "y") > 0.95
    reg = X.fit_regressor(train, "z", ["x"], maxIter=5, maxDepth=4)
    assert X.mean_squared_error(X.score(reg, test, ["id", "z"]), "z") < 20


def state(icao, call, second, lat=50.0, lon=8.0, alt=5000.0, vr=0.0, squawk="1000", ground=False):
    at = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)
    return (icao, call, "X", at, lat, lon, alt, 200.0, vr, 10.0, squawk, ground)


STATE = "icao24 string, callsign string, origin_country string, time_position timestamp, latitude double, longitude double, geo_altitude double, velocity double, vertical_rate double, true_track double, squawk string, on_ground boolean"


@pytest.fixture(scope="module")
def sky(spark):
    data = [state("a", " AB ", s, lat=50 + s / 600) for s in (0, 30, 60, 700)]
    data += [state("b", "B", 10, squawk="7700"), state("b", "B", 100, vr=-3.0, squawk="7500"), state("c", "C", 5, vr=30.0), state("c", "C", 65, vr=1.0)]
    data += [state("d", "D", 5, ground=True), state("e", " ", 5), state("f", "F", 5, lon=100.0), state("g", "G", 1300, alt=None)]
    return spark.createDataFrame(data, STATE)


def test_prism_keeps_the_busiest(sky):
    got = tracks.prism(sky, "europe", top=1).collect()
    assert len(got) == 1 and got[0].callsign == "AB" and got[0].n == 3
    assert [p.ts - got[0].t0 for p in got[0].points] == [0, 60, 700] and got[0].points[0].lat == 50.025


def test_density_and_curve_treat_unknown_altitude_differently(sky):
    assert rows(tracks.density(sky, "europe").filter("tb % 3 = 2"), "c0", "c1", "c2") == [(0, 0, 1)]
    late = tracks.curve(sky, "europe").orderBy(F.desc("tb")).first()
    assert (late.total, late.c0, late.c1, late.c2) == (1, 0, 0, 0)


def test_anomalies(sky):
    got = tracks.anomalies(sky, "europe", steepest=1).orderBy(*tracks.anomaly_order()).collect()
    assert [(r.icao24, r.kind, r.n) for r in got] == [("b", "emergency", 2), ("c", "steep", 2)]
    assert got[0].label.startswith("7700") and got[1].label == "steep · 30 m/s vertical" and got[1].t_emerg is None


def test_report_is_repeatable_and_manifest_comes_last(spark, sky, tmp_path):
    def texts(root):
        out = {}
        for file in sorted(root.rglob("part-*.gz")):
            out.setdefault(str(file.parent.parent.relative_to(root)), []).append(gzip.decompress(file.read_bytes()))
        return {k: b"".join(v) for k, v in out.items()}

    flights.write_report(spark, sky, str(tmp_path / "one"), ["europe"])
    flights.write_report(spark, sky.repartition(7), str(tmp_path / "two"), ["europe"])
    one, two = texts(tmp_path / "one"), texts(tmp_path / "two")
    assert one == two and set(one) == {"europe/prism", "europe/density", "europe/curve", "europe/anomaly"}
    curve = [json.loads(line) for line in one["europe/curve"].splitlines()]
    assert [(c["total"], c["c1"]) for c in curve] == [(4, 4), (1, 1), (1, 0)]
    manifest = spark.read.json(str(tmp_path / "one" / "manifest")).collect()
    assert len(manifest) == 4
    hashes = [rows(artifacts.file_hashes(spark, str(tmp_path / run / "europe"))) for run in ("one", "two")]
    assert hashes[0] == hashes[1] and len(hashes[0]) >= 4
    newest = max(f.stat().st_mtime_ns for f in (tmp_path / "one").rglob("part-*.gz"))
    assert min(f.stat().st_mtime_ns for f in (tmp_path / "one" / "manifest").glob("part-*")) >= newest


def test_flight_rules(sky, spark):
    wild = sky.union(spark.createDataFrame([state("z", "Z", 1, lat=95.0), state(None, "N", 1), state("y", "Y", 1, alt=99999.0)], STATE))
    assert flights.clean(wild).count() == sky.count() + 1


def test_artifacts_of_many_rows_have_the_same_bytes(spark, tmp_path):
    """More rows than Spark samples for ranges, dealt differently: still equal files, in order within and over the pieces."""
    df = spark.range(40000).selectExpr("id % 3 AS day", "(id * 7919) % 40000 AS id", "concat('v', id) AS v")
    for run, n in (("a", 3), ("b", 11)):
        artifacts.write_json_gz(df.repartition(n), str(tmp_path / run), ["day", "id"], "day")
    a, b = (rows(artifacts.file_hashes(spark, str(tmp_path / run))) for run in "ab")
    assert a == b and [r[0] for r in a] == ["day=0", "day=1", "day=2"]
    for day in range(3):
        text = gzip.decompress(next((tmp_path / "a" / f"day={day}").glob("part-*")).read_bytes())
        ids = [json.loads(line)["id"] for line in text.splitlines()]
        assert ids == sorted(ids) and "day" not in json.loads(text.splitlines()[0])


def test_artifact_lines_are_compact(spark, tmp_path):
    df = spark.createDataFrame([("eu", 2, "b"), ("eu", 1, "a")], "region string, id int, v string")
    artifacts.write_json_gz(df, str(tmp_path / "x"), ["id"], "region")
    text = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "x").rglob("part-*.gz")))
    assert text == b'{"id":1,"v":"a"}\n{"id":2,"v":"b"}\n'


def test_flagship_stops_on_test_city(spark):
    sales = spark.createDataFrame([(1, dt.datetime(2024, 1, 2), 5.0), (1, dt.datetime(2024, 1, 1), 9.0)], "franchiseID int, dateTime timestamp, totalPrice double")
    shops = spark.createDataFrame([(1, "d", "test", "c", 7)], "franchiseID int, district string, city string, country string, supplierId int")
    with pytest.raises(Exception, match="real_city"):
        bakery.flagship_locations(sales, shops).collect()
    good = bakery.flagship_locations(sales, shops.withColumn("city", F.lit("Bern")))
    assert rows(good, "total_sales", "city") == [(5.0, "Bern")]
    assert bakery.flagship_locations(sales, shops.withColumn("city", F.lit("Bern")).withColumn("supplierId", F.lit(None).cast("int"))).count() == 0


def test_loans_split_has_no_gap(spark):
    data = [(i, 1, b, a, "cc", "DE", 1, "05-03-2024 04:16:31") for i, (b, a) in enumerate([(5.0, 5.0), (None, 5.0), (0.0, 5.0), (5.0, None), (5.0, -1.0)])]
    tx = spark.createDataFrame(data, "id int, accounting_treatment_id int, balance double, arrears_balance double, cost_center_code string, country_code string, count int, next_payment_date string")
    new = loans.enriched(tx, spark.createDataFrame([(1, "x")], "id int, accounting_treatment string"))
    good, bad = loans.cleaned(new), loans.quarantined(new)
    assert rows(good, "id") == [(0,)] and rows(bad, "id") == [(1,), (2,), (3,), (4,)]
    assert str(good.first().next_payment_at) == "2024-05-03 04:16:31"


def test_rebalancing_multiplies_by_campaign_rows(spark):
    s = spark.createDataFrame([(1, 3000.0)], "customer_id int, avg_amount double")
    w = spark.createDataFrame([(1, 6000.0)], "customer_id int, total_net_worth double")
    c = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y")], "customer_id int, campaign_name string")
    assert rows(banking.rebalancing(s, w, c), "campaign_name", "cash_position", "recommendation") == [("x", 6000.0, "Balanced Portfolio"), ("y", 3000.0, "Balanced Portfolio")]


def test_payloads(spark):
    body = {"clientId": "d", "timestamp": "2024-01-01T00:00:00Z", "acceleration": {"x": 1.5, "y": None}, "location": {"latitude": "Infinity", "longitude": 8}}
    texts = [json.dumps(body), json.dumps({**body, "timestamp": "soon"}), json.dumps({"clientId": "e", "timestamp": "2024-01-01T00:00:00"}), '{"clientId": "n", "timestamp": "2024-01-01T00:00:00Z", "acceleration": {"x": NaN}}']
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    got = {r.client_id: r for r in telemetry.flatten_payloads(df, "p", F.current_timestamp()).collect()}
    assert set(got) == {"d", "e", "n"}
    assert (got["d"].acceleration_x, got["d"].acceleration_y, got["d"].latitude, got["d"].longitude) == (1.5, None, None, 8.0)
    assert got["e"].magnetic_z is None and got["n"].acceleration_x is None
    assert rows(telemetry.ingest_counts(df, "p")) == [(3, 1)]


def test_message_payload(spark):
    df = messages.json_payload(spark.createDataFrame([(1, "a", None)], "id int, v string, n int"), ["id", "v", "n"], "id")
    assert rows(df) == [("1", '{"id":1,"v":"a"}')]


def test_serving_copy_needs_unique_keys(spark):
    with pytest.raises(ValueError, match="duplicate"):
        snapshot_to_store(spark.createDataFrame([(1,), (1,)], "k int"), ["k"], "jdbc:none", "t")


def test_full_view_repeats_per_case(spark):
    e = spark.createDataFrame([(1, "IT")], "employee_id int, department string")
    none = spark.createDataFrame([], "employee_id int, base_salary int")
    cases = spark.createDataFrame([(1, 10), (1, 11)], "employee_id int, case_id int")
    reviews = spark.createDataFrame([(1, 4.0)], "employee_id int, rating double")
    assert rows(hr.full_view(e, none, reviews, cases), "employee_id", "base_salary", "rating", "case_id") == [(1, None, 4.0, 10), (1, None, 4.0, 11)]

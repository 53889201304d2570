import math
import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions import geo, text, times, values
from millrace.operators import texts as T

UTC = "TIMESTAMP'2024-05-01 12:00:00'"


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_safe_casts(spark):
    df = spark.createDataFrame([("1.5",), ("NaN",), ("Infinity",), ("-Infinity",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(values.safe_double(F.col("s"))).collect()] == [1.5, None, None, None, None, None]
    assert one(spark, values.safe_int(F.lit("7x")), values.safe_bool(F.lit("true"))) == (None, True)
    assert one(spark, values.safe_iso(F.lit("not a time")))[0] is None
    assert one(spark, values.safe_iso(F.lit("2024-05-01T10:00:00+02:00")).cast("string"))[0] == "2024-05-01 08:00:00"


def test_settle_is_stable_at_halves(spark):
    assert one(spark, values.settle(F.lit(2.675), 2), values.settle(F.lit(2.6749999999999), 2)) == (2.68, 2.68)


def test_value_band_needs_matching_labels(spark):
    with pytest.raises(ValueError):
        values.value_band(F.lit(1), [1, 2], ["a"])
    assert one(spark, values.value_band(F.lit(0.33), (0.33, 0.66), ("Low", "Medium", "High")))[0] == "Medium"


def test_choose_without_match_is_null(spark):
    assert one(spark, values.choose([(F.lit(False), F.lit("a"))]))[0] is None
    assert one(spark, values.choose([], "z"))[0] == "z"


def test_notice_and_us_times(spark):
    got = one(
        spark, times.notice_time(F.lit("Thu 11 Apr 24 21:12:43 UT")).cast("string"), times.notice_time(F.lit("soon")).cast("string"),
        times.us_time(F.lit("05-03-2024 04:16:31")).cast("string"), times.us_time(F.lit("2024-05-03")).cast("string"),
    )
    assert got == ("2024-04-11 21:12:43", None, "2024-05-03 04:16:31", None)


@pytest.mark.parametrize("seconds, words", [
    (5, "just now"), (60, "1 min ago"), (3599, "59 min ago"), (3600, "1 hour ago"), (7200, "2 hours ago"), (86400, "1 day ago"), (200000, "2 days ago"),
])
def test_age_text(spark, seconds, words):
    at = F.expr(UTC)
    assert one(spark, times.age_text(at - F.expr(f"INTERVAL {seconds} SECOND"), at))[0] == words


def test_degree_minutes(spark):
    got = one(spark, geo.degree_minutes(F.lit(48.356), "lat"), geo.degree_minutes(F.lit(-30.147), "lat"), geo.degree_minutes(F.lit(-0.5), "lon"), geo.degree_minutes(F.lit(9.999999), "lon"))
    assert got == ("48° 21.36' N", "30° 8.82' S", "0° 30.00' W", "10° 0.00' E")


def test_geocentric_axes(spark):
    for lat, lon, expected in ((0.0, 0.0, (1, 0, 0)), (0.0, 90.0, (0, 1, 0)), (90.0, 33.0, (0, 0, 1)), (0.0, -180.0, (-1, 0, 0))):
        got = geo.sphere_point(F.lit(lat), F.lit(lon), F.lit(0.0))
        assert [round(v, 9) + 0 for v in one(spark, got["x"], got["y"], got["z"])] == list(expected)
    high = geo.sphere_point(F.lit(0.0), F.lit(0.0), F.lit(geo.EARTH_RADIUS_M))
    assert one(spark, high["x"])[0] == 2.0


def test_great_circle_ahead(spark):
    degree = math.pi * geo.EARTH_RADIUS_M / 180
    def ahead(lat, lon, track, degrees):
        got = geo.dead_reckoning(F.lit(lat), F.lit(lon), F.lit(track), F.lit(degrees * degree / 60), 60)
        return [round(v, 6) + 0 for v in one(spark, got["lat_ahead"], got["lon_ahead"])]

    assert ahead(0.0, 10.0, 90.0, 5.0) == [0, 15] and ahead(10.0, 10.0, 0.0, 5.0) == [15, 10]
    assert ahead(0.0, 178.0, 90.0, 5.0) == [0, -177]
    assert ahead(88.0, 0.0, 0.0, 5.0) == [87, -180]  # over the pole
    none = geo.dead_reckoning(F.lit(0.0), F.lit(0.0), F.lit(None).cast("double"), F.lit(1.0), 60)
    assert one(spark, none["lat_ahead"], none["lon_ahead"]) == (None, None)


def test_unknown_region_is_an_error():
    with pytest.raises(ValueError, match="unknown region"):
        geo.region_box("ATLANTIS")
    assert geo.region_box("EUROPE") == (35.0, 72.0, -25.0, 45.0)


def test_units(spark):
    assert one(spark, geo.metres_to_feet(F.lit(1000.0)), geo.mps_to_knots(F.lit(100.0)), geo.mps_to_fpm(F.lit(2.0))) == pytest.approx((3280.84, 194.384, 393.7))


def test_altitude_prefers_geometric(spark):
    assert one(spark, geo.best_altitude(F.lit(0.0), F.lit(5.0)), geo.best_altitude(F.lit(None).cast("double"), F.lit(5.0))) == (0.0, 5.0)


def test_lines_with_and_without_colons(spark):
    df = spark.createDataFrame([("A: 1\nno colon\n\nB: x: y\nB: z",)], "m string")
    got = rows(T.message_lines(df, "m", []), "line_no", "key", "value")
    assert got == [(0, "A", "1"), (1, "no colon", "no colon"), (3, "B", "x: y"), (4, "B", "z")]
    wide = T.pivot_messages(df, "m", [], ["A", "B", "C"], ["B"])
    assert rows(wide) == [("1", "x: y z", None)]
    assert rows(T.pivot_messages(df, "m", [], ["B"])) == [("z",)]


def test_pointing_numbers(spark):
    got = one(spark, text.degrees_of(F.lit("-30.147d {-30d 08'} (J2000)")), text.minutes_of(F.lit("1080.00 [sec]   (=18.0 [min])")), text.degrees_of(F.lit("none")))
    assert got == (-30.147, 18.0, None)


def test_json_with_odd_names_and_bad_text(spark):
    got = one(spark, text.json_field(F.lit('{"$schema": "u", "n": 4}'), "$schema"), text.json_field(F.lit('{"n": 4}'), "n", "int"), text.json_field(F.lit("{oops"), "n"))
    assert got == ("u", 4, None)


def test_chunks_overlap_and_cover(spark):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(23))), (2, "short one"), (3, "  "), (4, None)], "id int, t string")
    got = T.chunk_words(df, "t", 10, 4).orderBy("id", "chunk_no").collect()
    first = [r.chunk.split() for r in got if r.id == 1]
    assert [c[0] for c in first] == ["w0", "w6", "w12", "w18"] and first[-1][-1] == "w22"
    assert all(a[-4:] == b[:4] for a, b in zip(first, first[1:]))
    assert [r.chunk for r in got if r.id == 2] == ["short one"] and {r.id for r in got} == {1, 2}
    with pytest.raises(ValueError):
        T.chunk_words(df, "t", 4, 4)


def test_classify_first_label_wins_ties(spark):
    df = spark.createDataFrame([("a burst from a supernova",), ("nothing here",), ("neutrino neutrino burst",)], "t string")
    assert [r.label for r in T.classify(df, "t", T.EVENT_LABELS).collect()] == ["gamma-ray burst", "other", "neutrino"]


def test_model_with_two_inputs_loads_once_per_task(spark):
    def load():
        return lambda a, b: a.str.len() + b

    df = spark.createDataFrame([("abc", 1), ("z", 5)], "a string, b int")
    assert rows(T.apply_model(df, ["a", "b"], "m", load, "long"), "m") == [(4,), (6,)]


def test_prompt_with_null_is_null(spark):
    assert one(spark, T.build_prompt(["x ", F.lit(None)]))[0] is None


def test_circulars_without_subject_are_dropped(spark):
    msg = '{"$schema": "s", "eventId": "E", "subject": %s, "body": "B", "submitter": "S", "circularId": 7, "createdOn": 1000}'
    df = spark.createDataFrame([(1, msg % '"T"'), (2, msg % "null"), (3, "broken")], "offset int, msg string")
    docs = T.circular_documents(T.parse_circulars(df, "msg", ["offset"]), "http://x/").collect()
    assert len(docs) == 1 and docs[0].content == "E T B S"
    assert docs[0].metadata.file_path == "http://x/7" and docs[0].metadata.file_size == 7
    assert docs[0].metadata.file_modification_time.replace(tzinfo=None) <= dt.datetime(1970, 1, 2)


def test_headers(spark):
    df = spark.createDataFrame([([("run", bytearray(b"r1")), ("run", bytearray(b"r2"))],), ([],)], "h array<struct<key: string, value: binary>>")
    got = [tuple(r) for r in df.select(text.has_header(F.col("h"), "run"), text.header_value(F.col("h"), "run")).collect()]
    assert got == [(True, "r1"), (False, None)]

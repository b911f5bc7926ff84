from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from blotter.functions import (
    DESCENT_LABELS,
    ENGLISH_LABELS,
    GREEK_LABELS,
    code_prefix,
    day_band,
    haversine_km,
    haversine_udf,
    money_to_int,
    not_null_island,
    parse_date,
    parse_timestamp,
    recode,
    to_double,
    to_int,
    with_geodesic_km,
    zip5,
    zip_text,
)
from tests.vincenty_ref import vincenty_reference_km


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_parse_timestamp_12_hour_clock(spark):
    out = _one(spark, [("01/02/2015 12:00:00 AM",), ("01/02/2015 12:30:00 PM",), ("garbage",), (None,)],
               "s string", parse_timestamp("s"))
    assert out[0].hour == 0 and out[1].hour == 12 and out[1].minute == 30
    assert out[2] is None and out[3] is None
    d = _one(spark, [("03/04/2015 11:00:00 PM",)], "s string", parse_date("s"))
    assert str(d[0]) == "2015-03-04"


def test_money_and_ints(spark):
    assert _one(spark, [("$12,345",), ("",), ("n/a",), (None,)], "s string", money_to_int("s")) == [12345, None, None, None]
    assert _one(spark, [("01",), (" 7 ",), ("x",)], "s string", to_int("s")) == [1, 7, None]


def test_zip5(spark):
    assert _one(spark, [("90012;90013",), ("90001",), (None,)], "s string", zip5("s")) == ["90012", "90001", None]


def test_code_prefix_never_null(spark):
    out = _one(spark, [(101,), (200,), (1,), (None,)], "c int", code_prefix("c", "1"))
    assert out == [True, False, True, False]


def test_null_island(spark):
    rows = [(0.0, 0.0), (0.0, -118.3), (34.0, 0.0), (None, -118.0), (34.0, -118.0)]
    assert _one(spark, rows, "lat double, lon double", not_null_island("lat", "lon")) == [False, True, True, False, True]


@pytest.mark.parametrize("hhmm,label", [
    (459, "Νύχτα"), (500, "Πρωί"), (1159, "Πρωί"), (1160, "Νύχτα"), (1200, "Απόγευμα"), (1659, "Απόγευμα"),
    (1700, "Βράδυ"), (2059, "Βράδυ"), (2100, "Νύχτα"), (0, "Νύχτα"), (2359, "Νύχτα"), (None, None),
])
def test_day_band_edges(spark, hhmm, label):
    assert _one(spark, [(hhmm,)], "t int", day_band("t")) == [label]


def test_day_band_text_and_labels(spark):
    assert _one(spark, [("0730",), ("x",)], "t string", day_band("t", ENGLISH_LABELS)) == ["morning", None]
    assert GREEK_LABELS[0] == "Πρωί"


def test_recode_keeps_unknown(spark):
    out = _one(spark, [("A",), ("-",), (None,), ("W",)], "c string", recode("c"))
    assert out == ["Other Asian", "-", None, "White"]
    assert len(DESCENT_LABELS) == 19


def _dist(spark, pts):
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    return [r.distance_km for r in with_geodesic_km(df, "a", "b", "c", "d").collect()]


def test_geodesic_published_line_and_identity(spark):
    def dms(d, m, s):
        return math.copysign(abs(d) + m / 60 + s / 3600, d)
    flinders = (dms(-37, 57, 3.72030), dms(144, 25, 29.52440))
    buninyong = (dms(-37, 39, 10.15610), dms(143, 55, 35.38390))
    out = _dist(spark, [(*flinders, *buninyong), (34.0, -118.2, 34.0, -118.2), (None, 1.0, 2.0, 3.0)])
    assert abs(out[0] - 54.972271) < 1e-6  # Vincenty (1975) test line, metres to the mm
    assert out[1] == 0.0 and out[2] is None


def test_geodesic_matches_reference_and_is_symmetric(spark):
    rnd = random.Random(7)
    pts = [(rnd.uniform(33, 35), rnd.uniform(-119, -117), rnd.uniform(-60, 60), rnd.uniform(-170, 170))
           for _ in range(50)]
    fwd = _dist(spark, pts)
    back = _dist(spark, [(c, d, a, b) for a, b, c, d in pts])
    for p, x, y in zip(pts, fwd, back):
        ref = vincenty_reference_km(*p)
        assert x is not None and abs(x - ref) < 1e-6 and abs(x - y) < 1e-6 and x >= 0


def test_geodesic_near_antipodal(spark):
    """Published lengths (km) of lines that the plain iteration can't solve, and lines half round the spheroid."""
    half = 20003.9314586236
    pts = [(0.0, 0.0, 0.5, 179.5), (0.0, 0.0, 0.5, 179.7), (-30.0, 0.0, 29.9, 179.8), (0.0, 0.0, 0.0, 180.0),
           (30.0, 10.0, -30.0, -170.0), (90.0, 0.0, -90.0, 10.0)]
    want = [19936.288579, 19944.127421, 19989.832828, half, half, half]
    out = _dist(spark, pts)
    assert all(abs(x - y) < 2e-6 for x, y in zip(out, want))
    back = _dist(spark, [(c, d, a, b) for a, b, c, d in pts])
    assert all(abs(x - y) < 1e-6 for x, y in zip(out, back))


def test_geodesic_keeps_the_callers_columns(spark):
    df = spark.createDataFrame([(34.0, -118.0, 34.5, -118.4, "x", "old")],
                               "a double, b double, c double, d double, __geo_lam string, distance_km string")
    out = with_geodesic_km(df, "a", "b", "c", "d")
    assert sorted(out.columns) == sorted(df.columns) and out.columns.count("distance_km") == 1
    row = out.first()
    assert row["__geo_lam"] == "x" and abs(row["distance_km"] - 66.6) < 1


def test_numbers_in_decimal_form(spark):
    row = spark.sql("SELECT ' 101.0' a, '$12,345.67' b, '1.5e2' c, 'x' d, '99999999999' e, 1234 f, '90012' g, '501.0' h")
    got = row.select(to_int("a"), money_to_int("b"), to_int("c"), to_int("d"), to_int("e"), zip_text("f"),
                     zip_text("g"), zip_text("h")).first()
    assert tuple(got) == (101, 12345, 150, None, None, "01234", "90012", "00501")


def test_haversine_udf_equals_native(spark):
    df = spark.createDataFrame([(34.0, -118.0, 34.5, -118.4), (0.0, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    rows = df.select(haversine_km("a", "b", "c", "d").alias("n"), haversine_udf("a", "b", "c", "d").alias("u")).collect()
    for r in rows:
        assert abs(r.n - r.u) < 1e-9
    assert abs(rows[1].n - 111.195) < 0.01
    assert df.select(F.round(haversine_km("a", "b", "a", "b"), 6)).first()[0] == 0.0


def test_numbers_that_are_none(spark):
    rows = [("NaN", " 1.5 ", float("nan")), ("Infinity", "-inf", float("inf")), ("+Infinity", "1e999", float("-inf")), (None, "", 2.0)]
    df = spark.createDataFrame(rows, "a string, b string, c double")
    assert [tuple(r) for r in df.select(to_double("a"), to_double("b"), to_double("c")).collect()] == [
        (None, 1.5, None), (None, None, None), (None, None, None), (None, None, 2.0)]
    points = [(float("nan"), 1.0), (1.0, float("inf")), (1.0, None), (0.0, -0.0), (1.0, 0.0)]
    assert _one(spark, points, "lat double, lon double", not_null_island("lat", "lon")) == [False, False, False, False, True]


def test_geodesic_of_numbers_that_are_none(spark):
    nan, inf = float("nan"), float("inf")
    out = _dist(spark, [(nan, 0.0, 1.0, 1.0), (0.0, inf, 1.0, 1.0), (0.0, 0.0, -inf, 1.0), (0.0, 0.0, 1.0, None), (0.0, 0.0, 0.0, 1.0)])
    assert out[:4] == [None] * 4 and abs(out[4] - 111.319490793) < 1e-8
    rows = [("34.5", "-118"), ("NaN", "1")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r[0] for r in with_geodesic_km(df, to_double("a"), to_double("b"), F.lit(34.5), F.lit(-118.0), "d").select("d").collect()]
    assert got == [0.0, None]


def _by_halving(lat1, lon1, lat2, lon2):
    """Distance (km) by halving the bracketed unknown 200 times, in plain Python."""
    a, f = 6378137.0, 1 / 298.257223563
    b = (1 - f) * a
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
    gap = math.pi - abs((math.radians(lon2) - math.radians(lon1) + math.pi) % (2 * math.pi) - math.pi)

    def terms(x):
        ss = math.hypot(math.cos(u2) * math.sin(x), math.sin(u1 + u2) - 2 * math.sin(u1) * math.cos(u2) * math.sin(x / 2) ** 2)
        cs = math.sin(u1) * math.sin(u2) - math.cos(u1) * math.cos(u2) * math.cos(x)
        sa = math.cos(u1) * math.cos(u2) * math.sin(x) / ss if ss else 0.0
        c2a = 1 - sa * sa
        return ss, cs, math.atan2(ss, cs), sa, c2a, cs - 2 * math.sin(u1) * math.sin(u2) / c2a if c2a else 0.0

    def short(x):
        ss, cs, sig, sa, c2a, m = terms(x)
        c = f / 16 * c2a * (4 + f * (4 - 3 * c2a))
        return x + (1 - c) * f * sa * (sig + c * ss * (m + c * cs * (2 * m * m - 1))) < gap

    lo, hi = 0.0, gap
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if short(mid) else (lo, mid)
    ss, cs, sig, sa, c2a, m = terms(lo)
    q = c2a * (a * a - b * b) / (b * b)
    big_a = 1 + q / 16384 * (4096 + q * (-768 + q * (320 - 175 * q)))
    big_b = q / 1024 * (256 + q * (-128 + q * (74 - 47 * q)))
    d = big_b * ss * (m + big_b / 4 * (cs * (2 * m * m - 1) - big_b / 6 * m * (4 * ss * ss - 3) * (4 * m * m - 3)))
    return b * big_a * (sig - d) / 1000


def test_geodesic_of_hard_pairs_against_halving(spark):
    rnd = random.Random(3)
    pts = []
    for _ in range(300):
        lat, lon = rnd.uniform(-89, 89), rnd.uniform(-180, 180)
        for spread in (1.0, 0.1, 1e-3, 1e-6):
            pts.append((lat, lon, -lat + rnd.uniform(-spread, spread), lon + 180 + rnd.uniform(-spread, spread)))
        pts.append((lat, lon, lat + rnd.uniform(-1e-4, 1e-4), lon + rnd.uniform(-1e-4, 1e-4)))
        pts.append((rnd.uniform(-1e-3, 1e-3), lon, 0.0, lon + 180 + rnd.uniform(-1, 1)))
        pts.append((lat, lon, rnd.uniform(-89, 89), rnd.uniform(-180, 180)))
        pts.append((rnd.choice([-1, 1]) * 90.0, lon, lat, 0.0))
    out = _dist(spark, pts)
    worst = max(abs(x - _by_halving(*p)) for p, x in zip(pts, out))
    assert worst < 2e-8, worst


def test_geodesic_stays_in_generated_code(spark):
    df = spark.range(8).select(*[(F.col("id") * k + 0.5).alias(n) for k, n in zip((3, 7, 5, 2), "abcd")])
    plan = with_geodesic_km(df, "a", "b", "c", "d")._jdf.queryExecution().executedPlan().toString()
    projects = [line for line in plan.splitlines() if "Project" in line]
    assert projects and all("*(" in line for line in projects)
    for word in ("lambda", "aggregate(", "transform("):
        assert word not in plan


def test_arrow_udf_keeps_nulls_and_sets_solvers_up_once_a_task(spark):
    from blotter.functions import make_distance_udf
    from blotter.functions.geodesic import haversine_np

    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (None, 0.0, 0.0, 1.0), (nan, 0.0, 0.0, 1.0), (0.0, inf, 0.0, 1.0)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_udf("a", "b", "c", "d")).collect()]
    assert abs(got[0] - 111.195) < 0.01 and got[1:] == [None] * 3
    made = spark.sparkContext.accumulator(0)

    def setup():
        made.add(1)
        return lambda *p: haversine_np(*p) * 2

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        many = spark.range(0, 1000, 1, 2).select(*[(F.col("id") / 100).alias(c) for c in "abc"], F.lit(0).alias("d"))
        udf = make_distance_udf(setup=setup)
        twice = many.select((udf("a", "b", "c", "d") - 2 * haversine_km("a", "b", "c", "d")).alias("x")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(twice) == 1000 and all(abs(r["x"]) < 1e-9 for r in twice) and made.value == 2
    with pytest.raises(ValueError):
        make_distance_udf()

"""Property tests against plain-Python definitions."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blotter import plans
from blotter.functions import GREEK_LABELS, day_band, with_geodesic_km
from blotter.operators import top_n_per_group, union_by_position
from tests.vincenty_ref import vincenty_reference_km

SETTINGS = settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))


def _band(t):
    if t is None:
        return None
    if 500 <= t <= 1159:
        return GREEK_LABELS[0]
    if 1200 <= t <= 1659:
        return GREEK_LABELS[1]
    if 1700 <= t <= 2059:
        return GREEK_LABELS[2]
    return GREEK_LABELS[3]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=2400)), min_size=1, max_size=60))
def test_bands_match_definition_and_counts_add_up(spark, times):
    df = spark.createDataFrame([(t, "STREET" if i % 3 else "HOME") for i, t in enumerate(times)],
                               "time_occ int, premis_desc string")
    got = [r[0] for r in df.select(day_band("time_occ")).collect()]
    assert got == [_band(t) for t in times]
    counts = plans.day_band_counts(df)
    expected = sum(1 for i, t in enumerate(times) if t is not None and i % 3)
    assert sum(r.crime_total for r in counts.collect()) == expected


@SETTINGS
@given(st.lists(st.tuples(st.integers(2000, 2002), st.integers(1, 12), st.integers(0, 20)), min_size=1, max_size=30,
                unique_by=lambda x: (x[0], x[1])),
       st.integers(1, 4))
def test_top_n_keeps_every_row_within_rank(spark, rows, n):
    df = spark.createDataFrame(rows, "year int, month int, crime_total long")
    got = {(r.year, r.month) for r in top_n_per_group(df, "year", "crime_total", n).collect()}
    want = {(y, m) for y, m, c in rows if sum(1 for y2, _, c2 in rows if y2 == y and c2 > c) < n}
    assert got == want


@SETTINGS
@given(st.integers(0, 20), st.integers(0, 20))
def test_union_row_count_adds(spark, a, b):
    x = spark.range(a).select(F.col("id"), F.lit("x").alias("s"))
    y = spark.range(b).select(F.col("id").alias("k"), F.lit("y").alias("t"))
    assert union_by_position(x, y).count() == a + b


@SETTINGS
@given(st.lists(st.tuples(st.floats(-60, 60), st.floats(-170, 170), st.floats(-60, 60), st.floats(-170, 170)),
                min_size=1, max_size=20))
def test_geodesic_symmetric_nonnegative_and_exact(spark, pts):
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    fwd = [r.distance_km for r in with_geodesic_km(df, "a", "b", "c", "d").collect()]
    back = [r.distance_km for r in with_geodesic_km(df, "c", "d", "a", "b").collect()]
    for p, x, y in zip(pts, fwd, back):
        assert x >= 0 and abs(x - y) < 1e-4
        gap = 180 - abs((p[3] - p[1] + 180) % 360 - 180)
        if gap > 2 or abs(p[0] + p[2]) > 2:  # the plain iteration doesn't converge near the antipode
            assert abs(x - vincenty_reference_km(*p)) < 1e-4
    same = [r.distance_km for r in with_geodesic_km(df, "a", "b", "a", "b").collect()]
    assert all(v == 0.0 for v in same)

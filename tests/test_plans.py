from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from blotter import plans
from blotter.operators import union_by_position
from blotter.sources import clean, read_csv


@pytest.fixture(scope="module")
def incidents(spark, incident_files):
    f1, f2 = incident_files
    raw1 = read_csv(spark, f1, table="incidents")
    raw2 = read_csv(spark, f2, table="incidents")
    return union_by_position(raw1, raw2)


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_top_months_dataframe_equals_sql_and_drops_bad_dates(spark, incidents):
    a = plans.top_months_per_year(incidents, "date_rptd", n=3)
    b = plans.top_months_per_year_sql(spark, incidents, "date_rptd", n=3)
    assert _rows(a) == _rows(b)
    assert a.columns == ["year", "month", "crime_total", "ranking"]
    # dr 3 (empty) and 4 (garbage) are dropped; 2015-01 has two rows
    assert _rows(a) == [(2015, 1, 2, 1), (2015, 2, 1, 2), (2016, 2, 1, 1), (2016, 3, 1, 1)]


def test_q1_on_typed_timestamps(spark, incidents):
    typed = clean(incidents, "incidents")
    assert _rows(plans.top_months_per_year(typed, "date_rptd")) == _rows(
        plans.top_months_per_year(incidents, "date_rptd"))


def test_day_bands_dataframe_equals_sql_and_counts_add_up(spark, incidents):
    a = plans.day_band_counts(incidents)
    b = plans.day_band_counts_sql(spark, incidents)
    assert _rows(a) == _rows(b)
    street_with_time = incidents.filter("premis_desc = 'STREET' and time_occ <> ''").count()
    assert sum(r.crime_total for r in a.collect()) == street_with_time
    assert dict(_rows(a)) == {"Νύχτα": 4, "Πρωί": 1}


def test_band_labels(spark, incidents):
    out = {r.dr_no: r.time_of_day for r in plans.band_labels(incidents).collect()}
    assert out["1"] == "Απόγευμα" and out["2"] == "Νύχτα" and out["4"] is None


@pytest.fixture(scope="module")
def geo(spark):
    return spark.createDataFrame([(34.05, -118.25, "90012;90013"), (34.10, -118.20, "90001"),
                                  (34.20, -118.10, None)], "lat double, lon double, zip_raw string")


@pytest.fixture(scope="module")
def income(spark):
    return spark.createDataFrame([(90012, "$90,000"), (90001, "$20,000"), (90099, "$99,000"), (90013, "")],
                                 "zip_code int, income_raw string")


def test_q3_profiles(spark, incidents, geo, income):
    top = plans.income_zip_profile(incidents, geo, income, year=2015, k=1, end="top")
    # 90099 is richest but has no incidents: ranked only after the join
    assert _rows(top) == [("Black", 1), ("White", 1)]
    bottom = plans.income_zip_profile(incidents, geo, income, year=2015, k=1, end="bottom")
    assert _rows(bottom) == [("Other Asian", 1), ("White", 1)]
    both = plans.income_zip_profile(incidents, geo, income, year=2015, k=2, end="top")
    assert sum(r.total_victims for r in both.collect()) == 4
    rows_mode = plans.income_zip_profile(incidents, geo, income, year=2015, k=2, end="top", distinct=False)
    assert _rows(rows_mode) == _rows(top)  # the first two rows both sit in 90012
    keys = plans.ranking_zip_list(incidents, geo, income, year=2015, k=2, end="top")
    assert keys.first().zips == ["90001", "90012"]


def test_q4_station_profile(spark, incidents):
    stations = spark.createDataFrame([(-118.25, 34.05, "Central", 1), (-118.30, 34.10, "Rampart", 2)],
                                     "x double, y double, division string, prec int")
    typed = clean(incidents, "incidents")
    out = plans.station_profile(typed, stations)
    got = {r.division: (r.incidents_total, r.average_distance) for r in out.collect()}
    # dr 1 (area "01", code 101, at the station) counts; dr 2 code 200 not; dr 3 null island;
    # dr 4 empty code; dr 5 missing lon; dr 6, 7 firearm in area 2
    assert got["Central"] == (1, 0.0)
    assert got["Rampart"][0] == 2 and got["Rampart"][1] == pytest.approx(9.2, abs=0.1)
    for strategy in ("broadcast", "merge", "shuffle_hash"):
        assert _rows(plans.station_profile(typed, stations, strategy=strategy)) == _rows(out)


def test_q4_duplicate_station_fails(spark, incidents):
    stations = spark.createDataFrame([(-118.25, 34.05, "Central", 1), (-118.3, 34.1, "Other", 1)],
                                     "x double, y double, division string, prec int")
    with pytest.raises(Exception, match="duplicate"):
        plans.station_profile(clean(incidents, "incidents"), stations).collect()


def test_q3_on_typed_parquet_pushes_the_year_range(spark, incident_files, geo, income):
    from blotter.session import scratch_path
    from blotter.sources import csv_to_parquet

    typed = csv_to_parquet(spark, list(incident_files), scratch_path(spark, "typed-etl"), table="incidents",
                           typed=True)
    assert dict(typed.dtypes)["date_occ"] == "timestamp"
    counts = plans.year_point_counts(typed, 2015)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = counts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters" in plan and "GreaterThanOrEqual(date_occ" in plan and "LessThan(date_occ" in plan
    text = read_csv(spark, list(incident_files), table="incidents")
    for end in ("top", "bottom"):
        assert _rows(plans.income_zip_profile(typed, geo, income, year=2015, k=1, end=end)) == _rows(
            plans.income_zip_profile(text, geo, income, year=2015, k=1, end=end))


def test_q3_zip_listed_twice_in_income_takes_one_place(spark, incidents, geo):
    income = spark.createDataFrame([(90012, "$90,000"), (90012, "$91,000"), (90001, "$20,000")],
                                   "zip_code int, income_raw string")
    assert plans.ranking_zip_list(incidents, geo, income, year=2015, k=2).first().zips == ["90001", "90012"]
    assert plans.ranking_zip_list(incidents, geo, income, year=2015, k=1, end="bottom").first().zips == ["90001"]
    # the join multiplies rows of 90012 by its two income rows (as any inner
    # join does); the key restriction itself must not multiply them again
    only = plans.income_zip_profile(incidents, geo, income, year=2015, k=1, end="top")
    assert _rows(only) == [("Black", 2), ("White", 2)]


def test_q3_zip_keeps_leading_zeros(spark, incidents, geo):
    zero = geo.withColumn("zip_raw", F.regexp_replace("zip_raw", "^900", "000"))
    as_number = spark.createDataFrame([(12, "$90,000.99"), (1, "$20,000")], "zip_code int, income_raw string")
    assert plans.ranking_zip_list(incidents, zero, as_number, year=2015, k=2).first().zips == ["00001", "00012"]


def test_q4_counts_points_below_the_join(spark, incidents):
    stations = spark.createDataFrame([(-118.25, 34.05, "Central", 1), (-118.30, 34.10, "Rampart", 2)],
                                     "x double, y double, division string, prec int")
    plan = plans.station_distances(clean(incidents, "incidents"), stations)._jdf.queryExecution().optimizedPlan().toString()
    join_at = plan.index("Join")
    assert "Aggregate" in plan[join_at:] and "Aggregate" not in plan[:join_at]


def test_q4_mean_covers_every_counted_incident(spark):
    inc = spark.createDataFrame([("101", 0.5, 179.7, 1), ("101", 0.5, 179.7, 1), ("101", 0.0, 1.0, 1)],
                                "weapon_cd string, lat double, lon double, area int")
    stations = spark.createDataFrame([(0.0, 0.0, "Zero", 1)], "x double, y double, division string, prec int")
    row = plans.station_profile(inc, stations).first()
    assert tuple(row) == ("Zero", 3, round((2 * 19944.127421 + 111.319491) / 3, 3))


def test_q3_scans_incidents_once(spark, incidents, geo, income):
    out = plans.income_zip_profile(clean(incidents, "incidents"), geo, income, year=2015, k=1, end="top")
    out.collect()  # the final adaptive plan exists after execution
    final = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final


def test_q4_duplicate_station_policies(spark, incidents):
    stations = spark.createDataFrame([(-118.25, 34.05, "Central", 1), (-118.25, 34.05, "Other", 1),
                                      (-118.30, 34.10, "Rampart", 2)], "x double, y double, division string, prec int")
    typed = clean(incidents, "incidents")
    first = {r.division: r.incidents_total for r in plans.station_profile(typed, stations, duplicates="first").collect()}
    assert first == {"Central": 1, "Rampart": 2}
    both = {r.division: r.incidents_total for r in plans.station_profile(typed, stations, duplicates="all").collect()}
    assert both == {"Central": 1, "Other": 1, "Rampart": 2}


def test_q3_both_ends_in_one_job(spark, incidents, geo, income):
    both = plans.income_zip_profiles(incidents, geo, income, year=2015, k=1)
    rows = _rows(both)
    for end in ("top", "bottom"):
        single = _rows(plans.income_zip_profile(incidents, geo, income, year=2015, k=1, end=end))
        assert [r[1:] for r in rows if r[0] == end] == single
    final = both._jdf.queryExecution().executedPlan().toString()
    assert final.count("ReusedExchange") >= 2  # three branches, one scan


def test_q4_filters_reach_typed_parquet(spark, incident_files):
    from blotter.session import scratch_path
    from blotter.sources import csv_to_parquet

    typed = csv_to_parquet(spark, list(incident_files), scratch_path(spark, "typed-q4"), table="incidents",
                           typed=True)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = plans.firearm_incidents(typed)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    assert "IsNotNull(weapon_cd)" in pushed and "IsNotNull(lat)" in pushed
    assert "ReadSchema: struct<area:int,weapon_cd:int,lat:double,lon:double>" in plan


def test_station_mean_covers_what_is_counted_and_is_the_same_in_any_order(spark):
    """Stations and incidents without a point, or with one that is no number, take no part."""
    nan = float("nan")
    inc = spark.range(0, 5000).selectExpr("101 AS weapon_cd", "CAST(1 + id % 3 AS INT) AS area",
                                          "34 + (id % 700) / 997 AS lat", "-118 - (id % 311) / 991 AS lon")
    bad = spark.createDataFrame([(101, 1, nan, -118.0), (101, 1, 34.0, float("inf")), (101, 1, None, -118.0), (101, 9, 34.0, -118.0)],
                                "weapon_cd int, area int, lat double, lon double")
    st = spark.createDataFrame([(-118.2, 34.1, "A", 1), (None, 34.1, "A", 1), (-118.3, nan, "C", 3), (-118.4, 34.2, "B", 2),
                                (-118.4, 34.2, "X", None), (-118.4, 34.2, "Y", None)], "x double, y double, division string, prec int")
    want = None
    for parts in (1, 7, 211):
        got = [tuple(r) for r in plans.station_profile(inc.unionByName(bad).repartition(parts), st, duplicates="all").collect()]
        assert got == [tuple(r) for r in plans.station_profile(inc.repartition(parts), st).collect()]
        assert want is None or got == want
        want = got
    assert [(d, n) for d, n, _ in want] == [("A", 1667), ("B", 1667)] and all(0 < m < 100 for _, _, m in want)

"""Q4 -- per police division: firearm incidents and mean distance to the
division's station.

Inputs (clean column names):

* incidents: ``weapon_cd, lat, lon, area``
* stations: ``x`` (longitude), ``y`` (latitude), ``division``, ``prec``

Plan: scan -> code-prefix and null-island filters -> incidents counted per
(area, point), with partial counts, so a hot area or block is one row per
point before anything is joined -> equi-join on area = prec -> one geodesic
distance per distinct point, as native column arithmetic -> partial (count,
count * distance) sums per station, distances in whole micrometres, so that the mean
has the same bits however rows are spread -> mean rounded to 3 decimals -> sort.
Stations without a (finite) point take no part; every other pair has a
distance, so the mean covers exactly the incidents that are counted.

Duplicate station numbers (``duplicates=``): ``"raise"`` (default) fails the
query, since a join would count those incidents twice; ``"first"`` keeps
one station per number (the first division name), as a lookup map would;
``"all"`` keeps every pair, as a relational join does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions.geodesic import with_geodesic_km
from blotter.functions.parsing import code_prefix, finite, not_null_island
from blotter.operators.aggregates import exact_mean
from blotter.operators.joins import first_per_key, join, require_unique


def firearm_incidents(incidents: DataFrame, code_prefix_text: str = "1") -> DataFrame:
    """``prec, lat, lon`` of incidents whose weapon code starts with the
    prefix and whose point is known and not (0, 0)."""
    # ``weapon_cd IS NOT NULL`` is implied by the prefix test but, unlike it,
    # reaches the Parquet reader (most incidents carry no weapon code).
    return (incidents
            .filter(F.col("weapon_cd").isNotNull() & code_prefix("weapon_cd", code_prefix_text)
                    & not_null_island("lat", "lon"))
            .select(F.col("area").alias("prec"), "lat", "lon"))


DUPLICATES = ("raise", "first", "all")


def station_points(stations: DataFrame, duplicates: str = "raise") -> DataFrame:
    if duplicates not in DUPLICATES:
        raise ValueError(f"duplicates must be one of {DUPLICATES}")
    st = stations.select("prec", "division", F.col("y").alias("st_lat"), F.col("x").alias("st_lon"))
    st = st.filter(finite("st_lat").isNotNull() & finite("st_lon").isNotNull())
    if duplicates == "raise":
        return require_unique(st, "prec", "station number")
    if duplicates == "first":
        return first_per_key(st, "prec", ["division", "st_lat", "st_lon"])
    return st


def station_distances(incidents: DataFrame, stations: DataFrame, code_prefix_text: str = "1",
                      strategy: str | None = None, duplicates: str = "raise",
                      salt: int | None = None) -> DataFrame:
    """One row per matched (area, point): ``prec, division, n, distance_km``
    with its number of incidents."""
    points = (firearm_incidents(incidents, code_prefix_text)
              .groupBy("prec", "lat", "lon").agg(F.count(F.lit(1)).alias("n")))
    joined = join(points, station_points(stations, duplicates), "prec", strategy=strategy, salt=salt)
    return with_geodesic_km(joined, "lat", "lon", "st_lat", "st_lon", "distance_km").select(
        "prec", "division", "n", "distance_km")


def station_profile(incidents: DataFrame, stations: DataFrame, code_prefix_text: str = "1",
                    strategy: str | None = None, duplicates: str = "raise",
                    salt: int | None = None) -> DataFrame:
    """``division, incidents_total, average_distance`` (km, 3 decimals),
    most incidents first."""
    d = station_distances(incidents, stations, code_prefix_text, strategy, duplicates, salt)
    agg = d.groupBy("prec", "division").agg(
        F.sum("n").alias("incidents_total"),
        F.round(exact_mean(F.col("distance_km"), F.col("n")), 3).alias("average_distance"))
    return agg.select("division", "incidents_total", "average_distance").orderBy(
        F.desc("incidents_total"), "division")

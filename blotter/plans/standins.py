"""Incident-shaped inputs derived from the star-schema test tables.

The test tables (orders, customer, nation, events, ...) hold no dates as
text, coordinates or ZIP codes. These functions derive deterministic
stand-ins with plain integer arithmetic on the keys, so an independent SQL
engine computes exactly the same values (the oracle queries repeat the
rules in SQL). Every stand-in is a lazy transformation of the given
tables: its size grows with them.

Rules, with ``k = o_orderkey`` and ``c = c_custkey``:

* incidents = orders JOIN customer on the customer key;
  ``date_rptd`` / ``date_occ`` = the order date as ``MM/dd/yyyy hh:mm:ss a``
  text, null when ``k % 97 = 0``, ``'garbage'`` when ``k % 89 = 0``;
  ``area`` = customer nation; ``weapon_cd`` = ``100 + k*7 % 500``, null when
  ``k % 31 = 0``; ``lat`` = ``33.7 + (k % 700) / 1000``,
  ``lon`` = ``-118.7 + (k % 500) / 1000``, both 0 when ``k % 211 = 0``;
  ``vict_descent`` = letter ``c % 20`` of ``DESCENT_CODES``, null when
  ``c % 23 = 0``; ``premis_desc`` = order priority.
* The two incident files are the orders before 1998 and from 1998 on.
* raw_incidents: the same rows as 28 text columns (see the function).
* geo = the distinct non-zero points of the incidents; with
  ``p = k % 3500`` (one value per point) ``zip_raw`` = ``90000 + p % 25``
  as text, followed by ``';90013'`` when ``p % 3 = 0``, null when
  ``p % 41 = 0``.
* income: one row per nation ``i``: ``zip_code = 90000 + i``,
  ``income_raw`` = ``''`` when ``i % 8 = 7`` else ``'$' || (20 + i*37 % 25 * 3) || ',000'``.
* stations: one row per nation ``i``: ``prec = i``, ``division = n_name``,
  ``y = 33.7 + (i % 700) / 1000``, ``x = -118.7 + (i % 500) / 1000``.
* events as incidents: ``time_occ`` = hour*100 + minute of ``ts``,
  ``premis_desc`` = ``event_type``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions.bands import hhmm_of
from blotter.functions.parsing import INCIDENT_TS_FORMAT
from blotter.functions.recode import DESCENT_LABELS
from blotter.sources.schemas import INCIDENT_COLUMNS

# The code book's codes in its order, then one code outside it.
DESCENT_CODES = "".join(DESCENT_LABELS) + "-"

SPLIT_DATE = "1998-01-01"


def _k() -> F.Column:
    return F.col("o_orderkey")


def order_dates(orders: DataFrame) -> DataFrame:
    """The incidents' own columns, which need no customer: number, dates, weapon, point, premises."""
    k = _k()
    date_text = (F.when(k % 97 == 0, F.lit(None).cast("string"))
                 .when(k % 89 == 0, F.lit("garbage"))
                 .otherwise(F.date_format("o_orderdate", INCIDENT_TS_FORMAT)))
    island = k % 211 == 0
    return orders.select(
        k.alias("dr_no"),
        date_text.alias("date_rptd"),
        date_text.alias("date_occ"),
        F.when(k % 31 == 0, F.lit(None).cast("int"))
         .otherwise((F.lit(100) + (k * 7) % 500).cast("int")).alias("weapon_cd"),
        F.when(island, F.lit(0.0)).otherwise(F.lit(33.7) + (k % 700) / 1000).alias("lat"),
        F.when(island, F.lit(0.0)).otherwise(F.lit(-118.7) + (k % 500) / 1000).alias("lon"),
        F.col("o_orderpriority").alias("premis_desc"),
        "o_orderdate", "o_custkey",
    )


def incidents(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Incidents with what the customer decides: area and victim descent."""
    c = F.col("c_custkey")
    joined = order_dates(orders).join(customer, F.col("o_custkey") == c, "inner")
    return joined.select(
        "dr_no", "date_rptd", "date_occ", F.col("c_nationkey").cast("int").alias("area"), "weapon_cd", "lat", "lon",
        F.when(c % 23 == 0, F.lit(None).cast("string"))
         .otherwise(F.substring(F.lit(DESCENT_CODES), (c % 20 + 1).cast("int"), 1)).alias("vict_descent"),
        "premis_desc", "o_orderdate")


def order_halves(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The orders behind the two 'yearly files'; union them before joining anything."""
    split = F.lit(SPLIT_DATE).cast("timestamp_ntz")
    return orders.filter(F.col("o_orderdate") < split), orders.filter(F.col("o_orderdate") >= split)


def raw_incidents(inc: DataFrame) -> DataFrame:
    """Incidents as the 28 text columns of the raw files, under their original headers.

    Areas are zero-padded, every 13th weapon code and area has a decimal form, times are
    ``HHMM`` text (empty when ``dr_no % 53 = 0``), and one field holds a comma and quotes.
    """
    k = F.col("dr_no")
    decimal = lambda c: F.when(k % 13 == 0, F.concat(c, F.lit(".0"))).otherwise(c)
    text = {
        "dr_no": k.cast("string"),
        "date_rptd": F.col("date_rptd"),
        "date_occ": F.col("date_occ"),
        "time_occ": F.when(k % 53 != 0, F.lpad(((k % 24) * 100 + k % 60).cast("string"), 4, "0")),
        "area": decimal(F.lpad(F.col("area").cast("string"), 2, "0")),
        "crm_cd_desc": F.concat(F.lit('KIND "'), (k % 7).cast("string"), F.lit('", OTHER')),
        "vict_descent": F.col("vict_descent"),
        "premis_desc": F.col("premis_desc"),
        "weapon_cd": decimal(F.col("weapon_cd").cast("string")),
        "lat": F.col("lat").cast("string"),
        "lon": F.col("lon").cast("string"),
    }
    empty = F.lit(None).cast("string")
    return inc.select(*[text.get(clean, empty).alias(raw) for raw, clean in INCIDENT_COLUMNS])


def geo(inc: DataFrame) -> DataFrame:
    """Reverse-geocoding stand-in: ``lat, lon, zip_raw``, one row per point."""
    p = F.col("dr_no") % 3500
    zip_raw = (F.when(p % 41 == 0, F.lit(None).cast("string"))
               .otherwise(F.concat((F.lit(90000) + p % 25).cast("string"),
                                   F.when(p % 3 == 0, F.lit(";90013")).otherwise(F.lit("")))))
    pts = inc.filter((F.col("lat") != 0) | (F.col("lon") != 0))
    return pts.select("lat", "lon", zip_raw.alias("zip_raw")).distinct()


def income(nation: DataFrame) -> DataFrame:
    """Income stand-in: ``zip_code`` (int), ``community``, ``income_raw``."""
    i = F.col("n_nationkey")
    raw = (F.when(i % 8 == 7, F.lit(""))
           .otherwise(F.concat(F.lit("$"), (F.lit(20) + (i * 37) % 25 * 3).cast("string"), F.lit(",000"))))
    return nation.select((F.lit(90000) + i).cast("int").alias("zip_code"),
                         F.col("n_name").alias("community"), raw.alias("income_raw"))


def stations(nation: DataFrame) -> DataFrame:
    """Police-station stand-in: ``x, y, fid, division, location, prec``."""
    i = F.col("n_nationkey")
    return nation.select(
        (F.lit(-118.7) + (i % 500) / 1000).alias("x"),
        (F.lit(33.7) + (i % 700) / 1000).alias("y"),
        i.cast("int").alias("fid"),
        F.col("n_name").alias("division"),
        F.concat(F.lit("station "), i.cast("string")).alias("location"),
        i.cast("int").alias("prec"),
    )


def event_incidents(events: DataFrame) -> DataFrame:
    """Events as incidents: ``dr_no, time_occ, premis_desc``."""
    return events.select(F.col("event_id").alias("dr_no"), hhmm_of("ts").alias("time_occ"),
                         F.col("event_type").alias("premis_desc"))


def point_pairs(orders: DataFrame) -> DataFrame:
    """Pairs of points all over the globe: ``dr_no, lat1, lon1, lat2, lon2``.

    By ``k % 4``: nearly or exactly antipodal, equal, with a pole, and unrelated points.
    One coordinate is no number if 37 divides ``k`` (NaN), infinite if 41 does, and null if 43 does.
    """
    k = _k()
    kind = k % 4
    lat1, lon1 = (k % 161 - 80).cast("double"), (k * 7 % 360 - 180).cast("double")
    lat2 = (F.when(kind == 0, -lat1 + (k % 11 - 5) / 10).when(kind == 1, lat1)
            .when(kind == 2, F.when(k % 3 == 0, 90.0).otherwise(-90.0)).otherwise((k * 13 % 161 - 80).cast("double")))
    lon2 = (F.when(kind == 0, lon1 + 180 - (k % 13) / 10).when(kind == 1, lon1)
            .otherwise((k * 17 % 360 - 180).cast("double")))
    lat1 = F.when(k % 37 == 0, F.lit(float("nan"))).otherwise(lat1)
    lon2 = F.when(k % 41 == 0, F.lit(float("-inf"))).when(k % 43 != 0, lon2)
    return orders.select(k.alias("dr_no"), lat1.alias("lat1"), lon1.alias("lon1"), lat2.alias("lat2"), lon2.alias("lon2"))

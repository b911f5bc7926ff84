"""Declared schemas for the incident data set and its lookup tables.

Every CSV is read with one of these schemas (no inference pass): each
column arrives as text and is converted by ``blotter.functions.parsing``
with ``try_*`` functions, so one bad field nulls that field instead of
failing the job (ANSI mode) or shifting the row. Raw headers are renamed to
snake_case; the incident file's ``"AREA "`` header carries a trailing space
in one of the two yearly files, which positional reading makes irrelevant.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column order of the public city incident files
# (raw header text -> clean name). Reading is positional.
INCIDENT_COLUMNS = [
    ("DR_NO", "dr_no"),
    ("Date Rptd", "date_rptd"),
    ("DATE OCC", "date_occ"),
    ("TIME OCC", "time_occ"),
    ("AREA ", "area"),
    ("AREA NAME", "area_name"),
    ("Rpt Dist No", "rpt_dist_no"),
    ("Part 1-2", "part_1_2"),
    ("Crm Cd", "crm_cd"),
    ("Crm Cd Desc", "crm_cd_desc"),
    ("Mocodes", "mocodes"),
    ("Vict Age", "vict_age"),
    ("Vict Sex", "vict_sex"),
    ("Vict Descent", "vict_descent"),
    ("Premis Cd", "premis_cd"),
    ("Premis Desc", "premis_desc"),
    ("Weapon Used Cd", "weapon_cd"),
    ("Weapon Desc", "weapon_desc"),
    ("Status", "status"),
    ("Status Desc", "status_desc"),
    ("Crm Cd 1", "crm_cd_1"),
    ("Crm Cd 2", "crm_cd_2"),
    ("Crm Cd 3", "crm_cd_3"),
    ("Crm Cd 4", "crm_cd_4"),
    ("LOCATION", "location"),
    ("Cross Street", "cross_street"),
    ("LAT", "lat"),
    ("LON", "lon"),
]

# Reverse-geocoding file (point -> ZIP code text).
GEO_COLUMNS = [("LAT", "lat"), ("LON", "lon"), ("ZIPcode", "zip_raw")]

# Median income per ZIP code.
INCOME_COLUMNS = [
    ("Zip Code", "zip_code"),
    ("Community", "community"),
    ("Estimated Median Income", "income_raw"),
]

# Police station file; X is longitude, Y latitude.
STATION_COLUMNS = [
    ("X", "x"),
    ("Y", "y"),
    ("FID", "fid"),
    ("DIVISION", "division"),
    ("LOCATION", "location"),
    ("PREC", "prec"),
]

LAYOUTS = {
    "incidents": INCIDENT_COLUMNS,
    "geo": GEO_COLUMNS,
    "income": INCOME_COLUMNS,
    "stations": STATION_COLUMNS,
}


def text_schema(columns: list[tuple[str, str]]) -> T.StructType:
    """All-string schema with the clean names, for positional CSV reads."""
    return T.StructType([T.StructField(clean, T.StringType(), True) for _, clean in columns])


def raw_header(columns: list[tuple[str, str]]) -> list[str]:
    return [raw for raw, _ in columns]


# Typed forms after cleaning (see ``blotter.sources.readers.clean``).
INCIDENT_TYPES = {
    "date_rptd": T.TimestampType(),
    "date_occ": T.TimestampType(),
    "time_occ": T.IntegerType(),
    "area": T.IntegerType(),
    "weapon_cd": T.IntegerType(),
    "lat": T.DoubleType(),
    "lon": T.DoubleType(),
}
GEO_TYPES = {"lat": T.DoubleType(), "lon": T.DoubleType()}
INCOME_TYPES: dict[str, T.DataType] = {}  # a ZIP is text: as a number it loses leading zeros
STATION_TYPES = {"x": T.DoubleType(), "y": T.DoubleType(), "prec": T.IntegerType()}

TYPES = {
    "incidents": INCIDENT_TYPES,
    "geo": GEO_TYPES,
    "income": INCOME_TYPES,
    "stations": STATION_TYPES,
}

# Column by whose ranges a typed table is dealt to files.
CLUSTER = {"incidents": "date_occ"}

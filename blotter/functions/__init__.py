from blotter.functions.bands import ENGLISH_LABELS, GREEK_LABELS, day_band, hhmm_of
from blotter.functions.geodesic import haversine_km, haversine_udf, make_distance_udf, with_geodesic_km
from blotter.functions.parsing import (
    INCIDENT_TS_FORMAT,
    code_prefix,
    in_year,
    money_to_int,
    month_of,
    not_null_island,
    parse_date,
    parse_timestamp,
    to_double,
    to_int,
    year_of,
    zip5,
    zip_text,
)
from blotter.functions.recode import DESCENT_LABELS, recode, recode_frame

__all__ = [
    "DESCENT_LABELS",
    "ENGLISH_LABELS",
    "GREEK_LABELS",
    "INCIDENT_TS_FORMAT",
    "code_prefix",
    "day_band",
    "haversine_km",
    "haversine_udf",
    "hhmm_of",
    "in_year",
    "make_distance_udf",
    "money_to_int",
    "month_of",
    "not_null_island",
    "parse_date",
    "parse_timestamp",
    "recode",
    "recode_frame",
    "to_double",
    "to_int",
    "with_geodesic_km",
    "year_of",
    "zip5",
    "zip_text",
]

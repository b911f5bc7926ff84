"""Column -> Column cleaning functions.

All of them are built-in Spark expressions (JVM side, whole-stage codegen)
and none fails on bad input: unparseable text becomes null, so ANSI mode
never aborts a job over one malformed field.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.functions.columns import ColumnLike, as_col

# Fixed value: the incident files write dates as 12-hour clock text with a
# meridiem marker, e.g. "01/08/2015 12:00:00 AM" (12 AM is hour 0).
INCIDENT_TS_FORMAT = "MM/dd/yyyy hh:mm:ss a"


def parse_timestamp(c: ColumnLike, fmt: str = INCIDENT_TS_FORMAT) -> Column:
    """Text -> timestamp; null when the text does not match ``fmt``."""
    return F.try_to_timestamp(as_col(c), F.lit(fmt))


def parse_date(c: ColumnLike, fmt: str = INCIDENT_TS_FORMAT) -> Column:
    """Text -> date (day part of the parsed timestamp); null when invalid."""
    return parse_timestamp(c, fmt).cast("date")


def to_int(c: ColumnLike) -> Column:
    """Text or number -> int; null for text that is not a number.

    Leading zeros and decimal forms are accepted (``"01"`` -> 1, ``"101.0"``
    -> 101, decimals are cut off), surrounding blanks ignored.
    """
    return F.trim(as_col(c).cast("string")).try_cast("double").try_cast("int")


def finite(c: ColumnLike) -> Column:
    """A double as it is; null for NaN and the infinities."""
    col = as_col(c)
    return F.when(F.abs(col) < F.lit(float("inf")), col)  # NaN is larger than any number


def to_double(c: ColumnLike) -> Column:
    """Text or number -> finite double; null for text that is not a number, "NaN" and "Infinity" included."""
    return finite(F.trim(as_col(c).cast("string")).try_cast("double"))


def money_to_int(c: ColumnLike) -> Column:
    """Money text such as ``"$12,345"`` or ``"$12,345.67"`` -> 12345; empty or invalid -> null."""
    return to_int(F.regexp_replace(as_col(c), r"[$,]", ""))


def zip5(c: ColumnLike) -> Column:
    """First five characters of a ZIP field (``"90012;90013"`` -> ``"90012"``)."""
    return F.substring(as_col(c), 1, 5)


def zip_text(c: ColumnLike) -> Column:
    """A ZIP code as text of at least five digits: number files lose leading
    zeros (``1234`` or ``1234.0`` -> ``"01234"``)."""
    text = F.regexp_replace(F.trim(as_col(c).cast("string")), r"\.0*$", "")
    return F.when(F.length(text).between(1, 4), F.lpad(text, 5, "0")).otherwise(text)


def code_prefix(c: ColumnLike, prefix: str = "1") -> Column:
    """True when the integer code's text starts with ``prefix``.

    Missing codes give ``False`` rather than null, so the predicate can be
    combined freely.
    """
    return F.coalesce(as_col(c).cast("string").startswith(prefix), F.lit(False))


def not_null_island(lat: ColumnLike = "lat", lon: ColumnLike = "lon") -> Column:
    """Keep points with known coordinates that are not (0, 0).

    A point survives when both coordinates are present, not NaN or infinite, and
    at least one of them is non-zero, compared as numbers (``0.0`` is zero too).
    Never null.
    """
    la, lo = as_col(lat), as_col(lon)
    known = la.isNotNull() & lo.isNotNull() & (F.abs(la) < float("inf")) & (F.abs(lo) < float("inf"))
    return known & ((la != F.lit(0.0)) | (lo != F.lit(0.0)))


def year_of(c: ColumnLike) -> Column:
    return F.year(as_col(c))


def month_of(c: ColumnLike) -> Column:
    return F.month(as_col(c))


def in_year(c: ColumnLike, year: int, kind: str = "timestamp") -> Column:
    """``year(c) = year`` written as a half-open range of literals of the
    column's own type (``kind``: timestamp, timestamp_ntz or date), so the
    predicate reaches the Parquet reader and row groups of other years are
    skipped by their min/max statistics."""
    col = as_col(c)
    lo = F.lit(f"{year:04d}-01-01").cast(kind)
    hi = F.lit(f"{year + 1:04d}-01-01").cast(kind)
    return (col >= lo) & (col < hi)

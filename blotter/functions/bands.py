"""Part-of-day bands for HHMM clock values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.functions.columns import ColumnLike, as_col
from blotter.functions.parsing import to_int

# Band labels in the order morning, afternoon, evening, night
# (the incident reports use Greek labels).
GREEK_LABELS = ("Πρωί", "Απόγευμα", "Βράδυ", "Νύχτα")
ENGLISH_LABELS = ("morning", "afternoon", "evening", "night")

# Inclusive HHMM bounds of the first three bands; every other
# value (21:00-04:59, and non-clock values such as 1160-1199) is night.
BAND_BOUNDS = ((500, 1159), (1200, 1659), (1700, 2059))


def day_band(hhmm: ColumnLike, labels: tuple[str, str, str, str] = GREEK_LABELS) -> Column:
    """HHMM (int or text) -> band label, as a single CASE expression.

    Null or unparseable input gives null; callers that follow the report
    semantics drop those rows before banding.
    """
    t = to_int(hhmm)
    (m0, m1), (a0, a1), (e0, e1) = BAND_BOUNDS
    return (
        F.when(t.isNull(), F.lit(None).cast("string"))
        .when(t.between(m0, m1), F.lit(labels[0]))
        .when(t.between(a0, a1), F.lit(labels[1]))
        .when(t.between(e0, e1), F.lit(labels[2]))
        .otherwise(F.lit(labels[3]))
    )


def hhmm_of(ts: ColumnLike) -> Column:
    """Timestamp -> HHMM integer (hour * 100 + minute)."""
    c = as_col(ts)
    return (F.hour(c) * 100 + F.minute(c)).cast("int")

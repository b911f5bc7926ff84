"""Code -> label recoding through a fixed map; unknown codes pass through."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.columns import ColumnLike, as_col

# Victim descent code book of the city incident files.
DESCENT_LABELS = {
    "A": "Other Asian",
    "B": "Black",
    "C": "Chinese",
    "D": "Cambodian",
    "F": "Filipino",
    "G": "Guamanian",
    "H": "Hispanic/Latin/Mexican",
    "I": "American Indian/Alaskan Native",
    "J": "Japanese",
    "K": "Korean",
    "L": "Laotian",
    "O": "Other",
    "P": "Pacific Islander",
    "S": "Samoan",
    "U": "Hawaiian",
    "V": "Vietnamese",
    "W": "White",
    "X": "Unknown",
    "Z": "Asian Indian",
}


def recode(c: ColumnLike, mapping: Mapping[str, str] = DESCENT_LABELS) -> Column:
    """Map codes to labels; codes outside ``mapping`` (and nulls) are kept.

    Expressed as a literal map lookup, which stays inside generated code and
    costs one hash probe per row regardless of the map size.
    """
    col = as_col(c)
    if not mapping:
        return col
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, col), col)


def recode_frame(df: DataFrame, column: str, mapping: Mapping[str, str] = DESCENT_LABELS) -> DataFrame:
    """DataFrame form: ``df.replace(mapping, subset=[column])`` semantics."""
    return df.withColumn(column, recode(column, mapping))

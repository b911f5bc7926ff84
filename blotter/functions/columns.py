"""Small shared helpers for functions that accept a name or a Column."""

from __future__ import annotations

from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Union[str, Column]


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c

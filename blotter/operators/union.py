"""Set union of relations (UNION ALL: duplicates kept)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_position(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """UNION ALL matching columns by position; names come from ``first``.

    Each further input must have the same number of columns; its columns
    are renamed to ``first``'s names (types are widened by Spark).
    """
    names = first.columns
    frames = [first]
    for df in rest:
        if len(df.columns) != len(names):
            raise ValueError(f"union by position needs {len(names)} columns, got {len(df.columns)}")
        frames.append(df.toDF(*names))
    return reduce(DataFrame.unionAll, frames)


def union_by_name(first: DataFrame, *rest: DataFrame, allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), rest, first)

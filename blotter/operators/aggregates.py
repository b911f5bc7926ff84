"""Grouped counts and means.

All are built-in aggregates, so Spark combines map-side (partial
aggregation) and shuffles one row per group per task, however skewed the
groups are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.functions.parsing import finite


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def count_by(df: DataFrame, keys: str | Sequence[str], out: str = "crime_total") -> DataFrame:
    """Rows per group, as ``out`` (bigint)."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(out))


DIGITS = 9  # doubles are summed as whole numbers of this many decimals


def in_units(value: Column, digits: int = DIGITS) -> Column:
    """A double as a whole number of its last of ``digits`` decimals (half away from zero); null for null, NaN and infinite values.

    Whole numbers add up to the same sum in any order, which doubles do not. A value of
    over 38 digits in this unit fails the query (ANSI mode).
    """
    return F.round(finite(value) * F.lit(10.0 ** digits)).cast("decimal(38,0)")


def exact_mean(value: Column, weight: Column | None = None, digits: int = DIGITS) -> Column:
    """Mean of doubles taken to ``digits`` decimals, the same bits however rows are spread over tasks.

    Rows without a finite value count neither in the sum nor in the number of rows;
    ``weight`` is how many rows a row stands for (a whole number).
    """
    units = in_units(value, digits)
    n = F.lit(1).cast("long") if weight is None else weight.cast("long")
    total = F.sum((units * n.cast("decimal(20,0)")).cast("decimal(38,0)"))
    return total.cast("double") / F.sum(F.when(units.isNotNull(), n)) / F.lit(10.0 ** digits)


def count_and_mean(df: DataFrame, keys: str | Sequence[str], value: str,
                   count_out: str = "n", mean_out: str = "mean", decimals: int | None = 3) -> DataFrame:
    """Rows and mean of ``value`` per group; the mean is rounded half-up.

    Means of doubles and floats are ``exact_mean``: they ignore NaN and infinite values
    and don't depend on how rows are spread over tasks.
    """
    doubles = isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType))
    mean = exact_mean(F.col(value)) if doubles else F.avg(value)
    if decimals is not None:
        mean = F.round(mean, decimals)
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(count_out), mean.alias(mean_out))


def composite_reduce_mean(df: DataFrame, keys: str | Sequence[str], value: str,
                          carry: str | None = None, count_out: str = "n", sum_out: str = "total",
                          mean_out: str = "mean", decimals: int = 3) -> DataFrame:
    """One pass computing (carried value, count, sum) per key, then the mean
    as sum / count in double precision. ``carry`` is any value of the group;
    put it in ``keys`` instead when a deterministic value is needed. Doubles are
    summed as whole numbers (``in_units``), so the sum doesn't depend on the order of rows."""
    doubles = isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType))
    total = F.sum(in_units(F.col(value))).cast("double") / F.lit(10.0 ** DIGITS) if doubles else F.sum(value)
    aggs = [F.count(F.lit(1)).alias(count_out), total.alias(sum_out)]
    if carry:
        aggs.insert(0, F.any_value(carry).alias(carry))
    out = df.groupBy(*_keys(keys)).agg(*aggs)
    return out.withColumn(mean_out, F.round(F.col(sum_out).cast("double") / F.col(count_out), decimals))

"""Q1 -- for each year, the months with the most incidents.

Plan: scan -> parse date -> (year, month) partial count -> shuffle on
(year, month) -> final count -> rank within year (partial and final
WindowGroupLimit keep only candidate rows) -> sort. Only one row per
(year, month) per task crosses the network, however many incidents there
are, and the window input is one row per month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.functions.parsing import INCIDENT_TS_FORMAT, parse_timestamp
from blotter.operators.ranking import rank_within, top_n_per_group


def as_timestamp(df: DataFrame, column: str, fmt: str = INCIDENT_TS_FORMAT) -> Column:
    """The column as a timestamp: text is parsed with ``fmt`` (invalid ->
    null), timestamps and dates are used as they are."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(column)
    return parse_timestamp(column, fmt)


def monthly_counts(df: DataFrame, ts_col: str = "date_rptd", fmt: str = INCIDENT_TS_FORMAT,
                   out: str = "crime_total") -> DataFrame:
    """Rows per (year, month); rows without a valid date are dropped.

    Invalid dates fall into one (null, null) group whose count of valid
    timestamps is 0, dropped after the aggregation. Filtering on the parsed
    value before aggregating would be pushed below the projection and parse
    every date twice.
    """
    ts = as_timestamp(df, ts_col, fmt)
    months = df.select(ts.alias("_ts")).select(
        F.year("_ts").alias("year"), F.month("_ts").alias("month"), "_ts")
    counts = months.groupBy("year", "month").agg(F.count("_ts").alias(out))
    return counts.filter(F.col(out) > 0)


def monthly_rank(df: DataFrame, ts_col: str = "date_rptd", fmt: str = INCIDENT_TS_FORMAT) -> DataFrame:
    """Every (year, month) with its rank by count within the year."""
    return rank_within(monthly_counts(df, ts_col, fmt), "year", "crime_total")


def top_months_per_year(df: DataFrame, ts_col: str = "date_rptd", n: int = 3,
                        fmt: str = INCIDENT_TS_FORMAT) -> DataFrame:
    """``year, month, crime_total, ranking`` for ranks <= n (ties kept),
    ordered by year, then count descending, then month."""
    top = top_n_per_group(monthly_counts(df, ts_col, fmt), "year", "crime_total", n)
    return top.select("year", "month", "crime_total", "ranking").orderBy(
        "year", F.desc("crime_total"), "month")


# One aggregation over parsed timestamps, ranked in the same step as it is
# counted (a window over aggregates). count(ts) leaves out dates that don't
# parse, so their group has 0 and is removed without parsing anything twice.
_TOP_MONTHS_SQL = """
SELECT month_rank.* FROM (
    SELECT year(ts) AS year, month(ts) AS month, count(ts) AS crime_total,
           rank() OVER (PARTITION BY year(ts) ORDER BY count(ts) DESC) AS ranking
    FROM (SELECT try_to_timestamp(`{ts_col}`, :fmt) AS ts FROM {{src}})
    GROUP BY ALL
    HAVING crime_total > 0
) AS month_rank
WHERE month_rank.ranking <= :n
ORDER BY month_rank.year, month_rank.crime_total DESC, month_rank.month
"""


def top_months_per_year_sql(spark: SparkSession, df: DataFrame, ts_col: str = "date_rptd", n: int = 3,
                            fmt: str = INCIDENT_TS_FORMAT) -> DataFrame:
    """The same result through SQL text over ``df`` (bound as ``{src}``).

    ``ts_col`` must be a text column; the format and ``n`` are bound as
    parameters, never spliced into the text.
    """
    if "`" in ts_col:
        raise ValueError("column name may not contain a backtick")
    query = _TOP_MONTHS_SQL.format(ts_col=ts_col)
    return spark.sql(query, args={"fmt": fmt, "n": n}, src=df)

"""Q2 -- incidents at one kind of premises, counted per part of day.

Plan: scan with the premises filter pushed to the reader -> band label
(one CASE expression) -> partial count -> shuffle of at most four rows per
task -> final count -> sort of four rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.bands import BAND_BOUNDS, GREEK_LABELS, day_band


def band_labels(df: DataFrame, time_col: str = "time_occ", labels=GREEK_LABELS,
                out: str = "time_of_day") -> DataFrame:
    """Add the band label of each row's HHMM value."""
    return df.withColumn(out, day_band(time_col, labels))


def day_band_counts(df: DataFrame, time_col: str = "time_occ", premis_col: str = "premis_desc",
                    premis: str = "STREET", labels=GREEK_LABELS) -> DataFrame:
    """``time_of_day, crime_total`` for rows at ``premis``, most frequent
    band first. Rows with a missing or non-numeric time are dropped."""
    # A missing or non-numeric time gives a null label; that group counts 0
    # labelled rows and is dropped after the aggregation (a filter on the
    # label before it would be pushed down and evaluate the CASE twice).
    rows = (df.filter(F.col(premis_col) == F.lit(premis))
            .select(day_band(time_col, labels).alias("time_of_day")))
    counts = rows.groupBy("time_of_day").agg(F.count("time_of_day").alias("crime_total"))
    return counts.filter(F.col("crime_total") > 0).orderBy(F.desc("crime_total"), "time_of_day")


_DAY_BANDS_SQL = """
SELECT time_of_day, count(*) AS crime_total
FROM (
    SELECT CASE {bands} ELSE {last} END AS time_of_day
    FROM (SELECT try_cast(try_cast(trim(CAST(`{time_col}` AS STRING)) AS DOUBLE) AS INT) AS hhmm
          FROM {{src}} WHERE `{premis_col}` = :premis)
)
GROUP BY time_of_day
HAVING time_of_day IS NOT NULL
ORDER BY crime_total DESC, time_of_day
"""


def day_band_counts_sql(spark: SparkSession, df: DataFrame, time_col: str = "time_occ",
                        premis_col: str = "premis_desc", premis: str = "STREET",
                        labels=GREEK_LABELS) -> DataFrame:
    """The same result through SQL text over ``df`` (bound as ``{src}``)."""
    for name in (time_col, premis_col):
        if "`" in name:
            raise ValueError("column name may not contain a backtick")
    bands = " ".join(["WHEN hhmm IS NULL THEN NULL",
                      *(f"WHEN hhmm BETWEEN {lo} AND {hi} THEN :label{i}" for i, (lo, hi) in enumerate(BAND_BOUNDS))])
    query = _DAY_BANDS_SQL.format(time_col=time_col, premis_col=premis_col, bands=bands, last=f":label{len(BAND_BOUNDS)}")
    args = {"premis": premis, **{f"label{i}": label for i, label in enumerate(labels)}}
    return spark.sql(query, args=args, src=df)

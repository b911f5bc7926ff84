"""Q3 -- victim groups in the highest- and lowest-income ZIP codes of a year.

Inputs (clean column names):

* incidents: ``vict_descent, lat, lon, date_occ`` (text or timestamp)
* geo: ``lat, lon, zip_raw`` -- point to ZIP text, possibly ``"90012;90013"``
* income: ``zip_code`` (int or text), ``income_raw`` (money text) --
  or already-typed ``zip`` / ``income`` columns.

Plan: the year's incidents are first reduced to counts per (lat, lon,
descent) -- counts are additive, and map-side partial aggregation turns a
hot location into one row per task before anything is shuffled. The
counts join the geocoded points on exact (lat, lon) and the income table
on the ZIP text (dimension tables: the planner broadcasts them by size, at
run time with AQE; a large geocoder falls back to a sort-merge join whose
skew AQE splits), and are summed per (zip, income, descent). That small
table feeds both the choice of the k ZIPs (a k-row limit) and the final
sums; the keys are applied by a broadcast join on the distinct key set,
so both branches share one exchange and the incidents are scanned once.

Semantics (see README): ZIPs are ranked only among those that have
incidents in the year after both joins; ``distinct=True`` takes k distinct
ZIPs by income (ties by ZIP text); ``distinct=False`` takes the ZIPs of the
top k *incident rows* ordered the same way, which may be a single ZIP.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.functions.parsing import INCIDENT_TS_FORMAT, in_year, money_to_int, zip5, zip_text
from blotter.functions.recode import DESCENT_LABELS, recode
from blotter.operators.joins import join
from blotter.operators.ranking import top_k_rows
from blotter.plans.top_months import as_timestamp


def clean_geo(geo: DataFrame) -> DataFrame:
    """``lat, lon, zip`` with the first listed ZIP as five-digit text; rows without a ZIP dropped."""
    z = F.col("zip") if "zip" in geo.columns else zip5("zip_raw")
    return geo.select("lat", "lon", zip_text(z).alias("zip")).filter(F.col("zip").isNotNull())


def clean_income(income: DataFrame) -> DataFrame:
    """``zip`` as five-digit text (the geocoder's ZIP is text, the income
    file's a number, which has lost leading zeros) and ``income`` as int;
    unknown incomes dropped."""
    z = F.col("zip") if "zip" in income.columns else F.col("zip_code")
    inc = F.col("income") if "income" in income.columns else money_to_int("income_raw")
    return (income.select(zip_text(z).alias("zip"), inc.cast("int").alias("income"))
            .filter(F.col("income").isNotNull()))


def incidents_with_income(incidents: DataFrame, geo: DataFrame, income: DataFrame, year: int,
                          strategy: str | None = None, fmt: str = INCIDENT_TS_FORMAT,
                          keep: tuple[str, ...] = ()) -> DataFrame:
    """Incident rows of ``year`` with their ZIP and the ZIP's income
    (columns ``vict_descent, zip, income`` plus ``keep``)."""
    inc = (incidents
           .filter(F.col("vict_descent").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull())
           .filter(_year_filter(incidents, "date_occ", year, fmt))
           .select(*keep, "vict_descent", "lat", "lon"))
    with_zip = join(inc, clean_geo(geo), ["lat", "lon"], strategy=strategy).drop("lat", "lon")
    return join(with_zip, clean_income(income), "zip", strategy=strategy)


def zip_descent_counts(joined: DataFrame) -> DataFrame:
    """One row per (zip, income, vict_descent) with its incident count."""
    return joined.groupBy("zip", "income", "vict_descent").agg(F.count(F.lit(1)).alias("n"))


def _year_filter(incidents: DataFrame, column: str, year: int, fmt: str):
    kind = dict(incidents.dtypes)[column]
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return in_year(column, year, kind)  # stored dates: pushed to the scan
    return F.year(as_timestamp(incidents, column, fmt)) == F.lit(year)


def year_point_counts(incidents: DataFrame, year: int, fmt: str = INCIDENT_TS_FORMAT) -> DataFrame:
    """Incidents of ``year`` counted per (lat, lon, vict_descent)."""
    return (incidents
            .filter(F.col("vict_descent").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull())
            .filter(_year_filter(incidents, "date_occ", year, fmt))
            .groupBy("lat", "lon", "vict_descent").agg(F.count(F.lit(1)).alias("n")))


def zip_descent_totals(incidents: DataFrame, geo: DataFrame, income: DataFrame, year: int,
                       strategy: str | None = None, fmt: str = INCIDENT_TS_FORMAT) -> DataFrame:
    """Same table as ``zip_descent_counts`` over ``incidents_with_income``,
    computed from per-point counts (aggregate first, then join)."""
    pts = year_point_counts(incidents, year, fmt)
    with_zip = join(pts, clean_geo(geo), ["lat", "lon"], strategy=strategy).drop("lat", "lon")
    with_income = join(with_zip, clean_income(income), "zip", strategy=strategy)
    return with_income.groupBy("zip", "income", "vict_descent").agg(F.sum("n").alias("n"))


def ranking_zips(per_zip: DataFrame, k: int = 3, end: str = "top", distinct: bool = True) -> DataFrame:
    """The ``zip`` values that the profile keeps (at most k rows)."""
    if end not in ("top", "bottom"):
        raise ValueError("end must be 'top' or 'bottom'")
    by_income = F.desc("income") if end == "top" else F.asc("income")
    # ZIPs with at least one incident. Using the row totals (rather than a
    # bare distinct) keeps this branch on the same aggregated subtree as the
    # final sums, so the two branches share one exchange.
    totals = per_zip.groupBy("zip", "income").agg(F.sum("n").alias("rows")).filter(F.col("rows") > 0)
    if distinct:
        # a ZIP that the income table lists twice takes one of the k places,
        # with its income nearest to this end
        best = F.max("income") if end == "top" else F.min("income")
        return top_k_rows(totals.groupBy("zip").agg(best.alias("income")), [by_income, F.asc("zip")], k).select("zip")
    first_k = top_k_rows(totals, [by_income, F.asc("zip")], k)
    # Row reading: walk the (at most k) best (zip, income) groups in order and
    # keep those that hold one of the first k joined rows.
    w = Window.orderBy(by_income, F.asc("zip")).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(w), F.lit(0))
    return first_k.withColumn("_before", before).filter(F.col("_before") < k).select("zip")


def income_zip_profile(incidents: DataFrame, geo: DataFrame, income: DataFrame, year: int = 2015,
                       k: int = 3, end: str = "top", distinct: bool = True,
                       strategy: str | None = None, labels=DESCENT_LABELS,
                       fmt: str = INCIDENT_TS_FORMAT) -> DataFrame:
    """``vict_descent, total_victims`` in the k highest (``end="top"``) or
    lowest income ZIPs, largest group first."""
    per_zip = zip_descent_totals(incidents, geo, income, year, strategy, fmt)
    keys = ranking_zips(per_zip, k, end, distinct)
    # ``keys`` holds at most k ZIPs; made distinct, an inner join with it is
    # a semi-join, and unlike a semi-join it is not pushed below the
    # aggregate, so ``per_zip`` stays one shared subtree.
    kept = per_zip.join(F.broadcast(keys.distinct()), "zip", "inner")
    return (kept.groupBy(recode("vict_descent", labels).alias("vict_descent"))
            .agg(F.sum("n").alias("total_victims"))
            .orderBy(F.desc("total_victims"), "vict_descent"))


def income_zip_profiles(incidents: DataFrame, geo: DataFrame, income: DataFrame, year: int = 2015,
                        k: int = 3, distinct: bool = True, strategy: str | None = None,
                        labels=DESCENT_LABELS, fmt: str = INCIDENT_TS_FORMAT) -> DataFrame:
    """Both reports in one job: ``end, vict_descent, total_victims`` for
    ``end`` = ``"top"`` and ``"bottom"``, from a single aggregated subtree
    (the incidents are scanned once for both ends)."""
    per_zip = zip_descent_totals(incidents, geo, income, year, strategy, fmt)
    keys = (ranking_zips(per_zip, k, "top", distinct).distinct().withColumn("end", F.lit("top"))
            .unionByName(ranking_zips(per_zip, k, "bottom", distinct).distinct().withColumn("end", F.lit("bottom"))))
    # at most 2k (zip, end) rows; a ZIP in both ends feeds both reports
    kept = per_zip.join(F.broadcast(keys), "zip", "inner")
    return (kept.groupBy("end", recode("vict_descent", labels).alias("vict_descent"))
            .agg(F.sum("n").alias("total_victims"))
            .orderBy(F.desc("end"), F.desc("total_victims"), "vict_descent"))


def ranking_zip_list(incidents: DataFrame, geo: DataFrame, income: DataFrame, year: int = 2015,
                     k: int = 3, end: str = "top", distinct: bool = True,
                     strategy: str | None = None) -> DataFrame:
    """One row, column ``zips``: the sorted array of the chosen ZIPs."""
    per_zip = zip_descent_totals(incidents, geo, income, year, strategy)
    return ranking_zips(per_zip, k, end, distinct).agg(F.sort_array(F.collect_list("zip")).alias("zips"))

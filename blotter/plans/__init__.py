from blotter.plans.day_bands import band_labels, day_band_counts, day_band_counts_sql
from blotter.plans.income_profile import (
    clean_geo,
    clean_income,
    income_zip_profile,
    income_zip_profiles,
    incidents_with_income,
    ranking_zip_list,
    ranking_zips,
    year_point_counts,
    zip_descent_counts,
    zip_descent_totals,
)
from blotter.plans.station_profile import firearm_incidents, station_distances, station_profile
from blotter.plans.top_months import (
    as_timestamp,
    monthly_counts,
    monthly_rank,
    top_months_per_year,
    top_months_per_year_sql,
)

__all__ = [
    "as_timestamp",
    "band_labels",
    "clean_geo",
    "clean_income",
    "day_band_counts",
    "day_band_counts_sql",
    "firearm_incidents",
    "income_zip_profile",
    "income_zip_profiles",
    "incidents_with_income",
    "monthly_counts",
    "monthly_rank",
    "ranking_zip_list",
    "ranking_zips",
    "station_distances",
    "station_profile",
    "top_months_per_year",
    "top_months_per_year_sql",
    "year_point_counts",
    "zip_descent_counts",
    "zip_descent_totals",
]

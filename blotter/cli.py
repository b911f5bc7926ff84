"""Command line: run one report on incident files.

    python -m blotter top-months      --incidents A.csv B.csv [--format csv|parquet|text] [--sql] [-n 3]
    python -m blotter day-bands       --incidents ... [--sql] [--premis STREET]
    python -m blotter income-profile  --incidents ... --geo G.csv --income I.csv [--year 2015] [-k 3]
                                      [--end top|bottom|both] [--rows] [--strategy broadcast|merge|shuffle_hash]
    python -m blotter station-profile --incidents ... --stations S.csv [--strategy ...] [--salt N]
    python -m blotter csv-to-parquet  --src A.csv B.csv --dst OUT [--table incidents] [--typed]
                                      [--set-aside] [--input-order]

Paths are any Hadoop-supported URI. The result is shown (``--show N``) or
written as Parquet (``--output``); ``--explain`` prints the physical plan.
Under spark-submit the cluster's master and settings apply.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame

from blotter import plans
from blotter.session import build_session
from blotter.sources import clean, convert_csv, read_csv, read_table, write_parquet

STRATEGIES = ["broadcast", "merge", "shuffle_hash"]


def _incidents(spark, args) -> DataFrame:
    return read_table(spark, args.incidents, "incidents", args.format)


def _top_months(spark, args) -> DataFrame:
    inc = _incidents(spark, args)
    if args.sql:
        return plans.top_months_per_year_sql(spark, inc, "date_rptd", n=args.n)
    return plans.top_months_per_year(inc, "date_rptd", n=args.n)


def _day_bands(spark, args) -> DataFrame:
    inc = _incidents(spark, args)
    if args.sql:
        return plans.day_band_counts_sql(spark, inc, premis=args.premis)
    return plans.day_band_counts(inc, premis=args.premis)


def _income_profile(spark, args) -> DataFrame:
    inc = clean(_incidents(spark, args), "incidents")
    geo = clean(read_csv(spark, args.geo, table="geo"), "geo")
    income = clean(read_csv(spark, args.income, table="income"), "income")
    if args.end == "both":
        return plans.income_zip_profiles(inc, geo, income, year=args.year, k=args.k,
                                         distinct=not args.rows, strategy=args.strategy)
    return plans.income_zip_profile(inc, geo, income, year=args.year, k=args.k, end=args.end,
                                    distinct=not args.rows, strategy=args.strategy)


def _station_profile(spark, args) -> DataFrame:
    inc = clean(_incidents(spark, args), "incidents")
    stations = clean(read_csv(spark, args.stations, table="stations"), "stations")
    return plans.station_profile(inc, stations, code_prefix_text=args.code_prefix,
                                 strategy=args.strategy, duplicates=args.duplicates, salt=args.salt)


def _csv_to_parquet(spark, args) -> DataFrame:
    done = convert_csv(spark, args.src, args.dst, table=args.table, typed=args.typed, set_aside=args.set_aside,
                       cluster_by=None if args.input_order else "auto")
    print(f"{done.n_rows} rows, {done.n_rejects} malformed records" + (" set aside" if args.set_aside else " among them"))
    return done.rows


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m blotter", description="Incident reports on Spark")
    sub = p.add_subparsers(dest="command", required=True)

    def common(sp, incidents=True):
        if incidents:
            sp.add_argument("--incidents", nargs="+", required=True)
            sp.add_argument("--format", choices=["csv", "parquet", "text"], default="csv")
        sp.add_argument("--output", help="write the result as Parquet here")
        sp.add_argument("--show", type=int, default=100)
        sp.add_argument("--explain", action="store_true")
        sp.add_argument("--master", help="e.g. local[8]; omit under spark-submit")

    sp = sub.add_parser("top-months")
    common(sp)
    sp.add_argument("--sql", action="store_true")
    sp.add_argument("-n", type=int, default=3)
    sp.set_defaults(run=_top_months)

    sp = sub.add_parser("day-bands")
    common(sp)
    sp.add_argument("--sql", action="store_true")
    sp.add_argument("--premis", default="STREET")
    sp.set_defaults(run=_day_bands)

    sp = sub.add_parser("income-profile")
    common(sp)
    sp.add_argument("--geo", nargs="+", required=True)
    sp.add_argument("--income", nargs="+", required=True)
    sp.add_argument("--year", type=int, default=2015)
    sp.add_argument("-k", type=int, default=3)
    sp.add_argument("--end", choices=["top", "bottom", "both"], default="both")
    sp.add_argument("--rows", action="store_true", help="rank incident rows, not distinct ZIPs")
    sp.add_argument("--strategy", choices=STRATEGIES)
    sp.set_defaults(run=_income_profile)

    sp = sub.add_parser("station-profile")
    common(sp)
    sp.add_argument("--stations", nargs="+", required=True)
    sp.add_argument("--code-prefix", default="1")
    sp.add_argument("--strategy", choices=STRATEGIES)
    sp.add_argument("--salt", type=int)
    sp.add_argument("--duplicates", choices=["raise", "first", "all"], default="raise",
                    help="repeated station numbers: fail, keep one (lookup map), or keep all (join)")
    sp.set_defaults(run=_station_profile)

    sp = sub.add_parser("csv-to-parquet")
    common(sp, incidents=False)
    sp.add_argument("--src", nargs="+", required=True)
    sp.add_argument("--dst", required=True)
    sp.add_argument("--table", default="incidents")
    sp.add_argument("--typed", action="store_true", help="store parsed dates/numbers (enables row-group skipping)")
    sp.add_argument("--set-aside", action="store_true", help="malformed records go to DST/part=rejects, rows to DST/part=rows")
    sp.add_argument("--input-order", action="store_true", help="keep the input's order instead of clustering typed rows by date")
    sp.set_defaults(run=_csv_to_parquet)
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(args.master, app_name=f"blotter {args.command}")
    df = args.run(spark, args)
    if args.explain:
        df.explain("formatted")
    if args.output:
        write_parquet(df, args.output)
    elif args.command != "csv-to-parquet":
        df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())

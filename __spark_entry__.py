"""

``entry(spark)`` runs the flagship report (top months per year) on
sf0.001. ``queries()`` registers one callable per operator of the survey's
inventory, each reading the star-schema test tables of ``sf_dir`` and the
incident-shaped stand-ins derived from them (``blotter.plans.standins``).
``oracle_sql()`` gives, per query, an independently written DuckDB query
over the same tables; stand-ins are re-derived there in SQL.
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from blotter import plans  # noqa: E402
from blotter.functions import (  # noqa: E402
    DESCENT_LABELS,
    code_prefix,
    haversine_udf,
    money_to_int,
    not_null_island,
    parse_date,
    parse_timestamp,
    recode,
    with_geodesic_km,
    zip5,
    zip_text,
)
from blotter.operators import (  # noqa: E402
    composite_reduce_mean,
    count_and_mean,
    hot_keys,
    in_list,
    join,
    lookup,
    semi_join,
    union_by_position,
)
from blotter.plans import standins  # noqa: E402
from blotter.session import REQUIRED_CONF, scratch_path  # noqa: E402
from blotter.sources import (  # noqa: E402
    FIRST_LINE,
    clean,
    convert_csv,
    csv_to_parquet,
    header_line,
    parse_csv_lines,
    read_csv,
    read_table,
    read_text_lines,
    register_view,
    reject_counts,
    run_sql,
    write_csv,
    write_parquet,
)

try:  # the corpus operators are an optional part
    _CORPUS = importlib.import_module("blotter.llm.queries")
except ModuleNotFoundError as missing:
    if not str(missing.name).startswith(("blotter.llm", "corpus_pipeline")):
        raise
    _CORPUS = None

FLAGSHIP_SF = "/root/testdata/sf0.001"
Q3_YEAR = 1997
DROPPED_STATIONS = (3, 7, 11)
NULL_STATION = 5


def _prepare(spark: SparkSession) -> None:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _union_orders(spark, sf_dir) -> DataFrame:
    """The orders behind the two yearly files, unioned before anything is joined."""
    return union_by_position(*standins.order_halves(_t(spark, sf_dir, "orders")))


def _inc(spark, sf_dir) -> DataFrame:
    return standins.incidents(_t(spark, sf_dir, "orders"), _t(spark, sf_dir, "customer")).drop("o_orderdate")


def _inc_union(spark, sf_dir) -> DataFrame:
    return standins.incidents(_union_orders(spark, sf_dir), _t(spark, sf_dir, "customer")).drop("o_orderdate")


def _dates(spark, sf_dir) -> DataFrame:
    """Incident columns that need no customer."""
    return standins.order_dates(_t(spark, sf_dir, "orders")).drop("o_orderdate", "o_custkey")


def _geo(spark, sf_dir) -> DataFrame:
    return standins.geo(_dates(spark, sf_dir))


def _income(spark, sf_dir) -> DataFrame:
    return standins.income(_t(spark, sf_dir, "nation"))


def _stations(spark, sf_dir) -> DataFrame:
    return standins.stations(_t(spark, sf_dir, "nation"))


def _stations_dup(spark, sf_dir) -> DataFrame:
    st = _stations(spark, sf_dir)
    extra = st.filter(F.col("prec") % 5 == 0).withColumn("division", F.concat("division", F.lit("_B")))
    return st.unionByName(extra)


def _events(spark, sf_dir) -> DataFrame:
    return standins.event_incidents(_t(spark, sf_dir, "events"))


# ---------------------------------------------------------------- sources

def _customer_notes(spark, sf_dir) -> DataFrame:
    """Customers plus a text field holding a comma and doubled quotes."""
    c = _t(spark, sf_dir, "customer")
    note = F.concat(F.col("c_mktsegment"), F.lit(', "'), F.col("c_name"), F.lit('"'))
    return c.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", note.alias("note"))


def q_csv_roundtrip_scan(spark, sf_dir):
    src = _customer_notes(spark, sf_dir)
    path = scratch_path(spark, "csv-roundtrip")
    write_csv(src, path)
    return read_csv(spark, path, schema=src.schema)


def q_csv_to_parquet(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    csv_path = scratch_path(spark, "orders-csv")
    write_csv(orders, csv_path)
    return csv_to_parquet(spark, csv_path, scratch_path(spark, "orders-parquet"), schema=orders.schema)


def q_text_line_parse(spark, sf_dir):
    """Folders of lines: an empty first file, blank first lines, two spellings of the header, and headers and blanks in between."""
    src = _customer_notes(spark, sf_dir)
    header = header_line(src.columns)
    body = src.select(F.to_csv(F.struct(*src.columns), {"escape": '"'}).alias("value"), F.col("c_custkey").alias("k"))
    extra = src.filter(F.col("c_custkey") % 7 == 0).select(
        F.when(F.col("c_custkey") % 2 == 0, F.lit("")).otherwise(F.lit(" \t ")).alias("value"), F.col("c_custkey").alias("k"))
    path = scratch_path(spark, "text-lines")
    for i, spelling in enumerate((header, header.upper().replace(",", " ,"))):
        mine = body.unionAll(extra).unionAll(src.filter("c_custkey % 500 = 0").select(F.lit(spelling), "c_custkey"))
        first = spark.createDataFrame([("", -3), (" \t", -2), (spelling, -1)], "value string, k long")
        rows = mine.filter(F.col("k") % 2 == i).unionAll(first).repartitionByRange(4, "k").sortWithinPartitions("k")
        rows.select("value").write.mode("append").text(f"{path}/{i}")
    spark.createDataFrame([], "value string").write.text(f"{path}/0-empty")
    return parse_csv_lines(read_text_lines(spark, [f"{path}/0-empty", f"{path}/0", f"{path}/1"]), src.schema, header=FIRST_LINE)


def _faulty_csv(spark, sf_dir) -> tuple[str, DataFrame]:
    """Customers as CSV without a header; some records are cut off, too long, of a wrong type or left open."""
    src = _customer_notes(spark, sf_dir)
    k = F.col("c_custkey")
    line = F.to_csv(F.struct(*src.columns), {"escape": '"'})
    faulty = (F.when(k % 11 == 0, F.concat(k.cast("string"), F.lit(",cut off")))
              .when(k % 13 == 0, F.concat(line, F.lit(',"one, more"')))
              .when(k % 17 == 0, F.concat(F.lit("key "), line))
              .when(k % 19 == 0, F.concat(k.cast("string"), F.lit(',"open')))
              .otherwise(line))
    path = scratch_path(spark, "csv-rejects")
    src.select(faulty.alias("value")).write.text(path)
    return path, src


def q_csv_reject_counts(spark, sf_dir):
    path, src = _faulty_csv(spark, sf_dir)
    return reject_counts(read_csv(spark, path, schema=src.schema, rejects=True, header="false"))


def q_csv_reject_rows(spark, sf_dir):
    """Malformed records set aside by the conversion, with its own counts beside each."""
    path, src = _faulty_csv(spark, sf_dir)
    done = convert_csv(spark, path, scratch_path(spark, "converted"), schema=src.schema, set_aside=True, header="false")
    return done.rejects.select("record", "reason", F.col("file").contains("part-").alias("has_file"),
                               F.lit(done.n_rows).alias("n_rows"), F.lit(done.n_rejects).alias("n_rejects"))


def q_csv_accepted_rows(spark, sf_dir):
    path, src = _faulty_csv(spark, sf_dir)
    done = convert_csv(spark, path, scratch_path(spark, "converted"), schema=src.schema, set_aside=True, header="false")
    return done.rows


# ---------------------------------------------------------------- raw files -> layout reader -> clean -> report

def _raw_csv(spark, sf_dir) -> str:
    """The incidents as 28-column text files under the original headers; their folder."""
    path = scratch_path(spark, "raw-incidents")
    write_csv(standins.raw_incidents(_inc_union(spark, sf_dir)), path)
    return path


def q_q1_from_csv(spark, sf_dir):
    return plans.top_months_per_year(read_table(spark, _raw_csv(spark, sf_dir), "incidents", "csv"), n=3)


def q_q1_from_raw_parquet(spark, sf_dir):
    path = scratch_path(spark, "raw-parquet")
    write_parquet(standins.raw_incidents(_inc_union(spark, sf_dir)), path)
    return plans.top_months_per_year(read_table(spark, path, "incidents", "parquet"), n=3)


def q_q1_from_typed_parquet(spark, sf_dir):
    typed = csv_to_parquet(spark, _raw_csv(spark, sf_dir), scratch_path(spark, "typed"), table="incidents", typed=True)
    return plans.top_months_per_year(typed, n=3)


def q_q2_from_text(spark, sf_dir):
    inc = read_table(spark, _raw_csv(spark, sf_dir), "incidents", "text")
    return plans.day_band_counts(clean(inc, "incidents"), premis="1-URGENT")


def q_q3_from_typed_parquet(spark, sf_dir):
    typed = csv_to_parquet(spark, _raw_csv(spark, sf_dir), scratch_path(spark, "typed"), table="incidents", typed=True)
    return plans.income_zip_profile(typed, _geo(spark, sf_dir), _income(spark, sf_dir), year=Q3_YEAR, k=3)


def q_q4_from_text(spark, sf_dir):
    """Raw lines with coordinates that are no numbers; stations without a point or number, or listed twice without a point."""
    raw = standins.raw_incidents(_inc_union(spark, sf_dir))
    k = F.col("DR_NO").cast("long")
    raw = raw.withColumns({"LAT": F.when(k % 43 == 0, F.lit("NaN")).otherwise(F.col("LAT")),
                           "LON": F.when(k % 47 == 0, F.lit("-Infinity")).otherwise(F.col("LON"))})
    path = scratch_path(spark, "raw-incidents")
    write_csv(raw, path)
    st = _stations(spark, sf_dir)
    st = st.withColumn("y", F.when(F.col("prec") % 7 != 3, F.col("y")))
    again = st.filter("prec = 1").withColumn("x", F.lit(float("nan")))
    nobody = st.filter("prec < 2").withColumn("prec", F.lit(None).cast("int"))
    st = st.unionByName(again).unionByName(nobody)
    return plans.station_profile(clean(read_table(spark, path, "incidents", "text"), "incidents"), st)


def q_sql_over_view(spark, sf_dir):
    register_view(_t(spark, sf_dir, "orders"), "blotter_orders")
    return run_sql(spark, """
        WITH dated AS (
            SELECT *, CAST(year(o_orderdate) AS INT) AS order_year
            FROM blotter_orders
            WHERE o_orderstatus = 'F'
        ),
        per_group AS (
            SELECT o_orderpriority, order_year, count(*) AS n_orders,
                   CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_price
            FROM dated
            GROUP BY o_orderpriority, order_year
        )
        SELECT o_orderpriority, order_year, n_orders, total_price FROM per_group
    """)


def q_union_by_position(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    split = F.lit(standins.SPLIT_DATE).cast("timestamp_ntz")
    early = o.filter(F.col("o_orderdate") < split).select("o_orderkey", "o_orderdate", "o_totalprice")
    late = o.filter(F.col("o_orderdate") >= split).select(
        F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("day"), F.col("o_totalprice").alias("price"))
    return union_by_position(early, late)


# ---------------------------------------------------------------- Q1

def q_parse_valid_dates(spark, sf_dir):
    inc = _dates(spark, sf_dir)
    ts = parse_timestamp("date_rptd")
    return (inc.filter(F.col("date_rptd").isNotNull() & ts.isNotNull())
            .select("dr_no", ts.cast("timestamp_ntz").alias("date_reported"),
                    parse_date("date_rptd").alias("report_date")))


def q_monthly_counts(spark, sf_dir):
    return plans.monthly_counts(_t(spark, sf_dir, "orders"), "o_orderdate")


def q_monthly_rank(spark, sf_dir):
    return plans.monthly_rank(_t(spark, sf_dir, "orders"), "o_orderdate")


def q_top_months_per_year(spark, sf_dir):
    return plans.top_months_per_year(standins.order_dates(_union_orders(spark, sf_dir)), "date_rptd", n=3)


def q_top_months_per_year_sql(spark, sf_dir):
    return plans.top_months_per_year_sql(spark, standins.order_dates(_union_orders(spark, sf_dir)), "date_rptd", n=3)


# ---------------------------------------------------------------- Q2

def q_day_band_label(spark, sf_dir):
    return plans.band_labels(_events(spark, sf_dir), "time_occ").select("dr_no", "time_occ", "time_of_day")


def q_day_band_counts(spark, sf_dir):
    return plans.day_band_counts(_events(spark, sf_dir), premis="error")


def q_day_band_counts_sql(spark, sf_dir):
    return plans.day_band_counts_sql(spark, _events(spark, sf_dir), premis="error")


# ---------------------------------------------------------------- filters and scalar functions

def q_code_prefix_filter(spark, sf_dir):
    return _dates(spark, sf_dir).filter(code_prefix("weapon_cd", "1")).select("dr_no", "weapon_cd")


def q_null_island_filter(spark, sf_dir):
    return _dates(spark, sf_dir).filter(not_null_island("lat", "lon")).select("dr_no", "lat", "lon")


def q_money_to_int(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    raw = (F.when(F.col("o_orderkey") % 8 == 7, F.lit(""))
           .when(F.col("o_orderkey") % 8 == 6, F.concat(F.lit("$"), F.format_number(F.floor("o_totalprice"), 0)))
           .otherwise(F.concat(F.lit("$"), F.format_number("o_totalprice", 2))))
    return o.select(F.col("o_orderkey").alias("dr_no"), money_to_int(raw).alias("income"))


def q_zip5(spark, sf_dir):
    return _geo(spark, sf_dir).select("lat", "lon", zip5("zip_raw").alias("zip"))


def q_recode_labels(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", recode("l_returnflag", DESCENT_LABELS).alias("l_returnflag"))


def q_filter_year(spark, sf_dir):
    inc = _dates(spark, sf_dir)
    return inc.filter(F.year(parse_timestamp("date_occ")) == Q3_YEAR).select("dr_no")


# ---------------------------------------------------------------- joins

def q_join_two_keys(spark, sf_dir):
    inc = _dates(spark, sf_dir).select("dr_no", "lat", "lon")
    return join(inc, _geo(spark, sf_dir), ["lat", "lon"]).select("dr_no", "lat", "lon", "zip_raw")


def _inc_area(spark, sf_dir) -> DataFrame:
    return _inc(spark, sf_dir).select("dr_no", F.col("area").alias("prec"))


def q_join_one_key_broadcast(spark, sf_dir):
    st = _stations(spark, sf_dir).select("prec", "division")
    return join(_inc_area(spark, sf_dir), st, "prec", strategy="broadcast").select("dr_no", "prec", "division")


def q_join_one_key_merge(spark, sf_dir):
    st = _stations_dup(spark, sf_dir).select("prec", "division")
    return join(_inc_area(spark, sf_dir), st, "prec", strategy="merge").select("dr_no", "prec", "division")


def q_join_one_key_shuffle_hash(spark, sf_dir):
    st = _stations_dup(spark, sf_dir).select("prec", "division")
    return join(_inc_area(spark, sf_dir), st, "prec", strategy="shuffle_hash").select("dr_no", "prec", "division")


def q_join_one_key_salted(spark, sf_dir):
    st = _stations_dup(spark, sf_dir).select("prec", "division")
    return join(_inc_area(spark, sf_dir), st, "prec", strategy="merge", salt=8).select("dr_no", "prec", "division")


def _hot_area(spark, sf_dir) -> DataFrame:
    """Incidents of which a third lies in one area, and another third has no area."""
    k = F.col("dr_no")
    area = F.when(k % 3 == 0, F.lit(7)).when(k % 3 == 1, F.col("prec"))
    return _inc_area(spark, sf_dir).withColumn("prec", area.cast("int"))


def q_join_hot_key_salted(spark, sf_dir):
    st = _stations_dup(spark, sf_dir).select("prec", "division")
    return join(_hot_area(spark, sf_dir), st, "prec", "left", strategy="merge", salt=8).select("dr_no", "prec", "division")


def q_hot_keys(spark, sf_dir):
    """The keys of at least a tenth of the rows, from the sketch, with their exact rows."""
    inc = _hot_area(spark, sf_dir)
    rows = [(h, n) for h, n, _ in hot_keys(inc, "prec", 0.1)]
    found = spark.createDataFrame(rows, "h long, n_rows long")
    keys = inc.select("prec", F.xxhash64("prec").alias("h")).distinct()
    return found.join(keys, "h").select("prec", "n_rows")


def q_join_mixed_type_key(spark, sf_dir):
    """Text ZIPs with leading zeros against numbers that have lost them."""
    zero = F.regexp_replace("zip_raw", "^9", "0")
    g = plans.clean_geo(_geo(spark, sf_dir).withColumn("zip_raw", zero))
    inc_tab = _income(spark, sf_dir).select(zip_text(F.col("zip_code") - 90000).alias("zip"), "income_raw")
    return join(g, inc_tab, "zip").select("lat", "lon", "zip", "income_raw")


def q_lookup_with_default(spark, sf_dir):
    """A map with missing, repeated and null-valued stations."""
    st = _stations_dup(spark, sf_dir).filter(~F.col("prec").isin(*DROPPED_STATIONS))
    st = st.withColumn("division", F.when(F.col("prec") != NULL_STATION, F.col("division")))
    return lookup(_inc_area(spark, sf_dir), st, "prec", ["division"], default="Unknown").select(
        "dr_no", "prec", "division")


# ---------------------------------------------------------------- Q3 pieces

def _ranking(spark, sf_dir, end, distinct=True):
    return plans.ranking_zip_list(_inc(spark, sf_dir), _geo(spark, sf_dir), _income(spark, sf_dir),
                                  year=Q3_YEAR, k=3, end=end, distinct=distinct)


def q_top_k_keys(spark, sf_dir):
    return _ranking(spark, sf_dir, "top").select(F.array_join("zips", ",").alias("zips"))


def q_bottom_k_keys(spark, sf_dir):
    return _ranking(spark, sf_dir, "bottom").select(F.array_join("zips", ",").alias("zips"))


def _joined_1997(spark, sf_dir) -> DataFrame:
    inc = _inc(spark, sf_dir)
    return plans.incidents_with_income(inc, _geo(spark, sf_dir), _income(spark, sf_dir), Q3_YEAR,
                                       keep=("dr_no",))


def q_in_list_filter(spark, sf_dir):
    # The k = 3 keys come back to the driver (a bounded, 3-element list)
    # and return as literals, as the collected-list form does.
    keys = _ranking(spark, sf_dir, "top").first()["zips"]
    return in_list(_joined_1997(spark, sf_dir), "zip", keys).select("dr_no", "zip", "income")


def q_semi_join_filter(spark, sf_dir):
    per_zip = plans.zip_descent_counts(_joined_1997(spark, sf_dir))
    keys = plans.ranking_zips(per_zip, 3, "top", True)
    return semi_join(_joined_1997(spark, sf_dir), keys, "zip").select("dr_no", "zip", "income")


def _profile(spark, sf_dir, end, distinct, strategy=None):
    return plans.income_zip_profile(_inc(spark, sf_dir), _geo(spark, sf_dir), _income(spark, sf_dir),
                                    year=Q3_YEAR, k=3, end=end, distinct=distinct, strategy=strategy)


def q_profile_top_income_zips(spark, sf_dir):
    return _profile(spark, sf_dir, "top", True)


def q_profile_bottom_income_zips(spark, sf_dir):
    return _profile(spark, sf_dir, "bottom", True)


def q_profile_top_income_rows(spark, sf_dir):
    return _profile(spark, sf_dir, "top", False)


def q_profile_bottom_income_rows(spark, sf_dir):
    return _profile(spark, sf_dir, "bottom", False)


def q_profile_top_income_broadcast(spark, sf_dir):
    return _profile(spark, sf_dir, "top", True, "broadcast")


def q_profile_top_income_merge(spark, sf_dir):
    return _profile(spark, sf_dir, "top", True, "merge")


def q_profile_both_ends(spark, sf_dir):
    return plans.income_zip_profiles(_inc(spark, sf_dir), _geo(spark, sf_dir), _income(spark, sf_dir),
                                     year=Q3_YEAR, k=3)


# ---------------------------------------------------------------- aggregates

def q_group_count_avg(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return count_and_mean(li, "l_returnflag", "l_quantity", count_out="n_rows", mean_out="avg_qty")


def q_composite_reduce_mean(spark, sf_dir):
    # prices carry two decimals: summed exactly as DECIMAL, so the result
    # does not depend on how rows are spread over tasks
    li = _t(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.lower("l_returnflag").alias("flag_lower"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    out = composite_reduce_mean(li, "l_returnflag", "price", carry="flag_lower",
                                count_out="n_rows", sum_out="total_price", mean_out="mean_price")
    return out.withColumn("total_price", F.col("total_price").cast("double"))


# ---------------------------------------------------------------- Q4 pieces

def _inc_station_pairs(spark, sf_dir) -> DataFrame:
    st = _stations(spark, sf_dir).select("prec", F.col("y").alias("st_lat"), F.col("x").alias("st_lon"))
    inc = _inc(spark, sf_dir).select("dr_no", F.col("area").alias("prec"), "lat", "lon")
    return join(inc, st, "prec", strategy="broadcast")


def q_geodesic_km(spark, sf_dir):
    d = with_geodesic_km(_inc_station_pairs(spark, sf_dir), "lat", "lon", "st_lat", "st_lon", "distance_km")
    return d.select("dr_no", F.round("distance_km", 3).alias("distance_km"))


def q_geodesic_km_global(spark, sf_dir):
    pairs = standins.point_pairs(_t(spark, sf_dir, "orders"))
    d = with_geodesic_km(pairs, "lat1", "lon1", "lat2", "lon2", "distance_km")
    return d.select("dr_no", F.round("distance_km", 3).alias("distance_km"))


def q_udf_distance(spark, sf_dir):
    p = _inc_station_pairs(spark, sf_dir)
    return p.select("dr_no", F.round(haversine_udf("lat", "lon", "st_lat", "st_lon"), 3).alias("distance_km"))


def q_station_profile(spark, sf_dir):
    return plans.station_profile(_inc_union(spark, sf_dir), _stations(spark, sf_dir))


def q_station_profile_broadcast(spark, sf_dir):
    return plans.station_profile(_inc_union(spark, sf_dir), _stations(spark, sf_dir), strategy="broadcast")


def q_station_profile_merge(spark, sf_dir):
    return plans.station_profile(_inc_union(spark, sf_dir), _stations(spark, sf_dir), strategy="merge")


def q_station_profile_map_lookup(spark, sf_dir):
    """Repeated station numbers resolved as a lookup map: one station each."""
    return plans.station_profile(_inc_union(spark, sf_dir), _stations_dup(spark, sf_dir), duplicates="first")


def q_station_profile_all_pairs(spark, sf_dir):
    """Repeated station numbers kept, as a relational join does."""
    return plans.station_profile(_inc_union(spark, sf_dir), _stations_dup(spark, sf_dir), duplicates="all")


def q_result_size(spark, sf_dir):
    return q_station_profile(spark, sf_dir).select(F.count(F.lit(1)).alias("n_rows"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_roundtrip_scan": q_csv_roundtrip_scan,
    "csv_to_parquet": q_csv_to_parquet,
    "text_line_parse": q_text_line_parse,
    "csv_reject_counts": q_csv_reject_counts,
    "csv_reject_rows": q_csv_reject_rows,
    "csv_accepted_rows": q_csv_accepted_rows,
    "q1_from_csv": q_q1_from_csv,
    "q1_from_raw_parquet": q_q1_from_raw_parquet,
    "q1_from_typed_parquet": q_q1_from_typed_parquet,
    "q2_from_text": q_q2_from_text,
    "q3_from_typed_parquet": q_q3_from_typed_parquet,
    "q4_from_text": q_q4_from_text,
    "sql_over_view": q_sql_over_view,
    "union_by_position": q_union_by_position,
    "parse_valid_dates": q_parse_valid_dates,
    "monthly_counts": q_monthly_counts,
    "monthly_rank": q_monthly_rank,
    "top_months_per_year": q_top_months_per_year,
    "top_months_per_year_sql": q_top_months_per_year_sql,
    "day_band_label": q_day_band_label,
    "day_band_counts": q_day_band_counts,
    "day_band_counts_sql": q_day_band_counts_sql,
    "code_prefix_filter": q_code_prefix_filter,
    "null_island_filter": q_null_island_filter,
    "money_to_int": q_money_to_int,
    "zip5": q_zip5,
    "recode_labels": q_recode_labels,
    "filter_year": q_filter_year,
    "join_two_keys": q_join_two_keys,
    "join_one_key_broadcast": q_join_one_key_broadcast,
    "join_one_key_merge": q_join_one_key_merge,
    "join_one_key_shuffle_hash": q_join_one_key_shuffle_hash,
    "join_one_key_salted": q_join_one_key_salted,
    "join_hot_key_salted": q_join_hot_key_salted,
    "hot_keys": q_hot_keys,
    "join_mixed_type_key": q_join_mixed_type_key,
    "lookup_with_default": q_lookup_with_default,
    "top_k_keys": q_top_k_keys,
    "bottom_k_keys": q_bottom_k_keys,
    "in_list_filter": q_in_list_filter,
    "semi_join_filter": q_semi_join_filter,
    "group_count_avg": q_group_count_avg,
    "composite_reduce_mean": q_composite_reduce_mean,
    "geodesic_km": q_geodesic_km,
    "geodesic_km_global": q_geodesic_km_global,
    "udf_distance": q_udf_distance,
    "profile_top_income_zips": q_profile_top_income_zips,
    "profile_bottom_income_zips": q_profile_bottom_income_zips,
    "profile_top_income_rows": q_profile_top_income_rows,
    "profile_bottom_income_rows": q_profile_bottom_income_rows,
    "profile_top_income_broadcast": q_profile_top_income_broadcast,
    "profile_top_income_merge": q_profile_top_income_merge,
    "profile_both_ends": q_profile_both_ends,
    "station_profile": q_station_profile,
    "station_profile_broadcast": q_station_profile_broadcast,
    "station_profile_merge": q_station_profile_merge,
    "station_profile_map_lookup": q_station_profile_map_lookup,
    "station_profile_all_pairs": q_station_profile_all_pairs,
    "result_size": q_result_size,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top three months per year over the unioned incident files."""
    return q_top_months_per_year(spark, FLAGSHIP_SF)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES) | (_CORPUS.QUERIES if _CORPUS else {})


def oracle_sql() -> dict[str, str]:
    from duck_oracles import ORACLES

    return {name: ORACLES[name] for name in _QUERIES if name in ORACLES} | (_CORPUS.ORACLES if _CORPUS else {})

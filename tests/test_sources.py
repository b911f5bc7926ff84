from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.session import scratch_path
from blotter.sources import (
    REJECT_COLUMN,
    clean,
    csv_to_parquet,
    first_line,
    parse_csv_lines,
    read_csv,
    read_parquet,
    read_text_lines,
    register_view,
    reject_counts,
    run_sql,
    text_schema,
    write_parquet,
)
from blotter.sources.schemas import INCIDENT_COLUMNS


def test_csv_scan_declared_schema_keeps_quoted_fields(spark, incident_files):
    df = read_csv(spark, list(incident_files), table="incidents")
    assert df.count() == 7  # header of each file skipped, blank line skipped
    row = df.filter(F.col("dr_no") == "1").first()
    assert row.premis_desc == 'A "B", C'
    assert row.lat == "34.05" and row.lon == "-118.25"  # not shifted by the quoted comma
    assert len(df.columns) == len(INCIDENT_COLUMNS)


def test_clean_converts_types_without_failing(spark, incident_files):
    df = clean(read_csv(spark, list(incident_files), table="incidents"), "incidents")
    types = dict(df.dtypes)
    assert types["area"] == "int" and types["lat"] == "double" and types["date_rptd"] == "timestamp"
    rows = {r.dr_no: r for r in df.collect()}
    assert rows["1"].area == 1  # zero-padded "01"
    assert rows["4"].date_rptd is None and rows["4"].time_occ is None  # garbage / empty
    assert rows["5"].lon is None
    assert rows["1"].date_rptd.hour == 12 and rows["1"].date_occ.hour == 0


def test_text_lines_parse_drops_headers_and_blanks(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    p = tmp_path / "lines"
    p.mkdir()
    (p / "part1.txt").write_text('a,b\n1,"x, ""y"""\n\n2,z\n')
    (p / "part2.txt").write_text("a,b\n   \n\t\n \t \n3,w\n")
    out = parse_csv_lines(read_text_lines(spark, str(p)), schema, header="a,b")
    assert sorted((r.a, r.b) for r in out.collect()) == [(1, 'x, "y"'), (2, "z"), (3, "w")]


def test_parquet_write_fails_if_exists_and_roundtrips(spark):
    path = scratch_path(spark, "test-parquet")
    df = spark.range(5).withColumn("s", F.col("id").cast("string"))
    write_parquet(df, path)
    with pytest.raises(Exception):
        write_parquet(df, path)
    assert sorted(r.id for r in read_parquet(spark, path).collect()) == [0, 1, 2, 3, 4]


def test_csv_to_parquet(spark, incident_files):
    dst = scratch_path(spark, "test-etl")
    out = csv_to_parquet(spark, list(incident_files), dst, table="incidents")
    assert out.count() == 7
    assert out.schema == text_schema(INCIDENT_COLUMNS)


def test_sql_over_view_with_bound_frame(spark):
    register_view(spark.range(10), "blotter_test_view")
    assert run_sql(spark, "SELECT count(*) AS n FROM blotter_test_view WHERE id < 4").first().n == 4
    df = spark.range(3)
    assert run_sql(spark, "SELECT sum(id) AS s FROM {src}", src=df).first().s == 3


def test_text_lines_header_from_first_line(spark, tmp_path):
    from blotter.sources import FIRST_LINE

    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    p = tmp_path / "one.txt"
    p.write_text("a,b\n1,x\n\n2,y\n")
    out = parse_csv_lines(read_text_lines(spark, str(p)), schema, header=FIRST_LINE)
    assert sorted((r.a, r.b) for r in out.collect()) == [(1, "x"), (2, "y")]


def test_parquet_with_raw_headers_feeds_the_reports(spark, incident_files):
    from blotter import plans
    from blotter.sources import read_table
    from blotter.sources.schemas import INCIDENT_COLUMNS

    raw_names = [raw for raw, _ in INCIDENT_COLUMNS]
    raw = read_csv(spark, list(incident_files), table="incidents").toDF(*raw_names)
    raw = raw.withColumn("AREA ", F.col("`AREA `").cast("int")).withColumn("LAT", F.col("LAT").cast("double"))
    path = scratch_path(spark, "raw-headers")
    write_parquet(raw, path)
    df = read_table(spark, path, "incidents", fmt="parquet")
    assert "date_rptd" in df.columns and "area" in df.columns and "lat" in df.columns
    expected = plans.top_months_per_year(read_csv(spark, list(incident_files), table="incidents"))
    assert [tuple(r) for r in plans.top_months_per_year(df).collect()] == [tuple(r) for r in expected.collect()]


def test_header_is_the_first_line_of_the_first_file_by_path(spark, tmp_path):
    """Spark reads large files first; the header is still that of the first path."""
    from blotter.sources import FIRST_LINE

    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    p = tmp_path / "folder"
    p.mkdir()
    (p / "a-small.txt").write_text("a,b\n1,x\n")
    (p / "b-large.txt").write_text("".join(f"{i},row\n" for i in range(2, 2000)))
    lines = read_text_lines(spark, str(p))
    assert first_line(lines) == "a,b"
    out = parse_csv_lines(lines, schema, header=FIRST_LINE)
    assert out.count() == 1999 and out.filter("a is null").count() == 0


def test_malformed_records_are_counted(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    f = tmp_path / "bad.csv"
    f.write_text('a,b\n1,x\n2\n3,y,z\nfour,w\n5,"q ""r"", s"\n')
    df = read_csv(spark, str(f), schema=schema, rejects=True)
    assert tuple(reject_counts(df).first()) == (5, 3)
    assert sorted(r[REJECT_COLUMN] for r in df.collect() if r[REJECT_COLUMN]) == ["2", "3,y,z", "four,w"]
    assert read_csv(spark, str(f), schema=schema).columns == ["a", "b"]


def _lines(spark, folder, files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / name).write_text(text)


AB = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def _parsed(spark, *paths):
    from blotter.sources import FIRST_LINE

    rows = parse_csv_lines(read_text_lines(spark, [str(p) for p in paths]), AB, header=FIRST_LINE)
    return sorted(map(tuple, rows.collect()), key=str)


def test_headers_of_empty_blank_and_differently_spelled_files(spark, tmp_path):
    """An empty first file, a blank first line, another spelling, a file without a header, a header that comes again."""
    _lines(spark, tmp_path / "d", {"0.txt": "", "1.txt": " \t\n\na,b\n1,x\n", "2.txt": '\n"A" , B\n2,y\n', "3.txt": "3,z\na,b\n4,w\n",
                                   "4.txt": "\n  \n"})
    assert _parsed(spark, tmp_path / "d") == [(1, "x"), (2, "y"), (3, "z"), (4, "w")]
    assert first_line(read_text_lines(spark, str(tmp_path / "d"))) == "a,b"
    # folders have headers of their own
    _lines(spark, tmp_path / "e", {"0.txt": "left,right\n5,v\na,b\n"})
    assert _parsed(spark, tmp_path / "d", tmp_path / "e") == [(1, "x"), (2, "y"), (3, "z"), (4, "w"), (5, "v"), (None, "b")]
    _lines(spark, tmp_path / "none", {"0.txt": "", "1.txt": "\n \n"})
    assert _parsed(spark, tmp_path / "none") == [] and first_line(read_text_lines(spark, str(tmp_path / "none"))) is None


def test_headers_of_files_read_in_many_blocks(spark, tmp_path):
    body = "".join(f"{i},{'x' * 50}\n" for i in range(3000))
    _lines(spark, tmp_path / "d", {"a.txt": "\n" * 9000 + "a,b\n" + body, "b.txt": "a,b\n" + body})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        assert len(_parsed(spark, tmp_path / "d")) == 6000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_text_files_of_one_folder_spell_their_headers(spark, incident_files):
    from blotter.sources import read_table

    rows = read_table(spark, list(incident_files), "incidents", fmt="text")
    assert sorted(r["dr_no"] for r in rows.collect()) == [str(i) for i in range(1, 8)]


def test_conversion_sets_malformed_records_aside_in_one_scan(spark, tmp_path):
    from blotter.sources import convert_csv

    f = tmp_path / "bad.csv"
    f.write_text('a,b\n1,x\n2\n3,y,z\nfour,w\n5,"q ""r"", s"\n"open\n')
    done = convert_csv(spark, str(f), str(tmp_path / "out"), schema=AB, set_aside=True)
    assert (done.n_rows, done.n_rejects) == (2, 4)
    assert sorted(tuple(r) for r in done.rows.collect()) == [(1, "x"), (5, 'q "r", s')]
    assert done.rows.schema == AB
    got = {r["record"]: r["reason"] for r in done.rejects.collect()}
    assert got == {"2": "too few fields", "3,y,z": "too many fields", "four,w": "value does not fit its type", '"open': "open quote"}
    assert all(r["file"].endswith("bad.csv") for r in done.rejects.collect())
    kept = convert_csv(spark, str(f), str(tmp_path / "all"), schema=AB)
    assert (kept.n_rows, kept.n_rejects, kept.rejects) == (6, 4, None) and kept.rows.columns == ["a", "b"]
    f.write_text("a,b\n1,x\n")
    clean_file = convert_csv(spark, str(f), str(tmp_path / "clean"), schema=AB, set_aside=True)
    assert (clean_file.n_rows, clean_file.n_rejects, clean_file.rejects.count()) == (1, 0, 0)
    f.write_text("a,b\nx\n")
    no_rows = convert_csv(spark, str(f), str(tmp_path / "bad"), schema=AB, set_aside=True)
    assert (no_rows.n_rows, no_rows.n_rejects, no_rows.rows.count()) == (0, 1, 0)


def _scan_rows(df):
    """Rows that the Parquet reader handed out, by its metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName().startswith("Adaptive") else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def _rows_in_groups_of(folder, year):
    """Rows of the row groups whose dates reach into the year, by the files' own statistics."""
    import pyarrow.parquet as pq

    n = 0
    for f in folder.glob("*.parquet"):
        meta = pq.read_metadata(f)
        at = meta.schema.names.index("date_occ")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            if stats.has_min_max and stats.min.year <= year <= stats.max.year:
                n += meta.row_group(g).num_rows
    return n


def test_typed_parquet_is_clustered_so_that_a_year_is_skipped_to(spark, tmp_path):
    from blotter.functions.parsing import in_year
    from blotter.sources import convert_csv
    from blotter.sources.schemas import INCIDENT_COLUMNS
    from tests.conftest import csv_text, incident_line

    import random

    rng = random.Random(1)
    years = [2010 + i % 10 for i in range(20_000)]
    rng.shuffle(years)
    rows = [incident_line(dr_no=i, date_occ=f"{1 + i % 12:02d}/{1 + i % 28:02d}/{y} 01:00:00 PM") for i, y in enumerate(years)]
    rows += [incident_line(dr_no=90_000 + i, date_occ="") for i in range(1000)]
    header = [raw for raw, _ in INCIDENT_COLUMNS]
    src = tmp_path / "in.csv"
    src.write_text(csv_text(rows, header))
    spark.conf.set("parquet.block.size", "16384")
    try:
        read = {}
        for name, by in (("ranges", "auto"), ("input", None)):
            done = convert_csv(spark, str(src), str(tmp_path / name), table="incidents", typed=True, cluster_by=by)
            assert (done.n_rows, done.n_rejects) == (21_000, 0)
            year = done.rows.filter(in_year("date_occ", 2014)).select("dr_no", "date_occ")
            assert year.count() == 2000
            read[name] = _scan_rows(year)
            assert read[name] == _rows_in_groups_of(tmp_path / name, 2014)
    finally:
        spark.conf.unset("parquet.block.size")
    assert read["input"] == 21_000 and read["ranges"] < 6000

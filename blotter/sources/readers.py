"""Readers and writers for the incident data set.

* CSV with a declared all-text schema (no inference job), header skipped,
  ``""`` inside quotes read as a literal quote (``escape='"'``), so a field
  such as ``"A ""B"", C"`` neither splits nor shifts later columns.
* Text lines (``spark.read.text``) parsed with ``from_csv`` for inputs that
  arrive as raw lines: blank lines are dropped by a column predicate, each
  file's own header by a small table of first lines.
* Parquet, the working format; ``convert_csv`` converts once, counts while it
  writes, and can set malformed records aside and cluster by date.

Typed cleaning is separate (``clean``), so every source feeds the same
pipelines.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.functions import parsing
from blotter.session import scratch_table
from blotter.sources import schemas

CSV_OPTIONS = {"header": "true", "escape": '"', "mode": "PERMISSIVE"}
REJECT_COLUMN = "_corrupt_record"


def _layout(table: str) -> list[tuple[str, str]]:
    try:
        return schemas.LAYOUTS[table]
    except KeyError:
        raise ValueError(f"unknown table layout {table!r}; one of {sorted(schemas.LAYOUTS)}") from None


def read_csv(spark: SparkSession, paths: str | Iterable[str], table: str | None = None,
             schema: T.StructType | None = None, rejects: bool = False, **options: str) -> DataFrame:
    """Read CSV file(s) with a declared schema.

    ``table`` names one of the known layouts (columns come out as text with
    clean names); alternatively pass ``schema``. Several paths are read as
    one relation -- the union of files with the same column order.

    A malformed record (too few or too many fields, or a field that doesn't
    fit the schema) keeps what could be read. With ``rejects=True`` the column
    ``_corrupt_record`` holds its text and is null for all other records, so
    bad records can be counted (``reject_counts``) or set aside.
    """
    if schema is None:
        if table is None:
            raise ValueError("pass table= or schema=")
        schema = schemas.text_schema(_layout(table))
    opts = {**CSV_OPTIONS, **options}
    if rejects:
        schema = T.StructType([*schema.fields, T.StructField(REJECT_COLUMN, T.StringType())])
        opts["columnNameOfCorruptRecord"] = REJECT_COLUMN
    path_list = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).options(**opts).csv(path_list)


def reject_counts(df: DataFrame) -> DataFrame:
    """``n_rows, n_rejects`` of a table read with ``rejects=True``."""
    # The count looks at a hash of all columns, so that the reader parses them
    # all: a record's faults show only in columns that are read.
    every = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return (df.select(F.col(REJECT_COLUMN).isNotNull().alias("bad"), every.alias("hash"))
            .agg(F.count_if(F.col("hash") >= F.lit(-2 ** 63)).alias("n_rows"), F.count_if("bad").alias("n_rejects")))


def read_parquet(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    path_list = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.parquet(*path_list)


def read_text_lines(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Raw lines, one row each, column ``value``."""
    path_list = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.text(path_list)


def _fields(line: Column) -> Column:
    """A header line's names, trimmed and in lower case."""
    return F.transform(F.split(F.lower(line), ","), lambda name: F.trim(F.translate(name, '"\t\ufeff', "  ")))


def file_headers(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``file, line``: the lines that are headers in a file.

    ``lines`` comes from ``read_text_lines``. The header of a folder is the first
    line that isn't blank of its first file (by path) that has one, so empty files and blank
    first lines don't matter; it is a header in every file of the folder, where it may come
    again or not at all. A file's own first line that isn't blank is a header of that
    file if half of the folder's names or more are among its fields (compared trimmed and without
    regard to case): files may spell the header differently.

    A file's lines are ordered by where their block starts and by their place in it,
    whatever task reads them. One pass; one row a file and task is shuffled. The result is written to
    the scratch folder, so its size is known to what joins it.
    """
    rows = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("place"), F.col(value_col).alias("own"))
    own = rows.filter(F.col("own").rlike(r"\S")).groupBy("file").agg(F.min_by("own", F.struct("block", "place")).alias("own"))
    own = scratch_table(own.withColumn("folder", F.regexp_replace("file", "/[^/]*$", "")), "first-lines")
    first = own.groupBy("folder").agg(F.min_by("own", "file").alias("first"))
    both = own.join(first, "folder")
    names = _fields(F.col("first"))
    like = 2 * F.size(F.array_intersect(names, _fields(F.col("own")))) >= F.size(F.array_distinct(names))
    both = both.select("file", F.explode(F.array_distinct(F.array("first", F.when(like, F.col("own")).otherwise(F.col("first"))))).alias("line"))
    return scratch_table(both, "headers")


def first_line(lines: DataFrame, value_col: str = "value") -> str | None:
    """The first line that isn't blank of the first such file by path (one line comes to the driver)."""
    rows = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("place"), F.col(value_col).alias("line"))
    row = rows.filter(F.col("line").rlike(r"\S")).agg(F.min_by("line", F.struct("file", "block", "place"))).first()
    return row[0]


FIRST_LINE = object()  # ``header=FIRST_LINE``: headers are found in the files, see ``file_headers``


def parse_csv_lines(lines: DataFrame, schema: T.StructType, header: str | object | None = None,
                    value_col: str = "value") -> DataFrame:
    """Parse CSV text lines into typed columns.

    Lines equal to ``header`` (every copy, e.g. one per concatenated file)
    and lines of white space only are dropped; each remaining line is parsed
    by ``from_csv`` with quote-doubling escapes, so quoted commas stay inside
    their field. Missing trailing fields come out null. With
    ``header=FIRST_LINE`` every file drops the lines that ``file_headers`` found for it; this
    reads the text once more, which a given ``header`` saves.
    """
    v = F.col(value_col)
    rows = lines.filter(v.rlike(r"\S"))
    if header is FIRST_LINE:
        heads = file_headers(lines, value_col).select(F.col("file").alias("__file"), F.col("line").alias(value_col))
        rows = rows.withColumn("__file", F.col("_metadata.file_path")).join(heads, ["__file", value_col], "left_anti")
    elif header is not None:
        rows = rows.filter(v != F.lit(header))
    parsed = F.from_csv(v, schema.simpleString(), {"escape": '"', "mode": "PERMISSIVE"})
    return rows.select(parsed.alias("r")).select("r.*")


def normalize_columns(df: DataFrame, table: str) -> DataFrame:
    """Rename raw header names of a known layout (``"Date Rptd"``,
    ``"AREA "`` ...; compared trimmed and case-insensitively) to the clean
    names. Columns already clean or unknown are kept as they are."""
    names = {}
    for raw, cleaned in _layout(table):
        names[raw.strip().lower()] = cleaned
        names[cleaned] = cleaned
    cols = [F.col(f"`{c}`").alias(names.get(c.strip().lower(), c)) for c in df.columns]
    return df.select(*cols)


def read_table(spark: SparkSession, paths: str | Iterable[str], table: str, fmt: str = "csv") -> DataFrame:
    """Read a known table layout from CSV, raw text lines or Parquet.

    CSV and text give text columns with clean names (type them with
    ``clean``). For text input each file drops its header lines (see ``file_headers``),
    as files of one data set may spell the header differently.
    Parquet may come from ``csv_to_parquet`` or keep the raw CSV headers
    (renamed to clean names here).
    """
    path_list = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "csv":
        return read_csv(spark, path_list, table=table)
    if fmt == "parquet":
        return normalize_columns(read_parquet(spark, path_list), table)
    if fmt == "text":
        schema = schemas.text_schema(_layout(table))
        return parse_csv_lines(read_text_lines(spark, path_list), schema, header=FIRST_LINE)
    raise ValueError(f"fmt must be csv, parquet or text, got {fmt!r}")


def header_line(columns: list[str]) -> str:
    """The CSV header line that ``write_csv`` produces for ``columns``."""
    out = []
    for c in columns:
        if any(ch in c for ch in ',"\n'):
            c = '"' + c.replace('"', '""') + '"'
        out.append(c)
    return ",".join(out)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(header="true", escape='"', quoteAll="false").csv(path)


_TIMESTAMPS = "spark.sql.parquet.outputTimestampType"


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: list[str] | None = None) -> None:
    """Write Parquet; default mode fails if ``path`` exists.

    Timestamps are written in microseconds: the 96-bit form has no min/max statistics, so
    no scan could skip a row group by them.
    """
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    conf = df.sparkSession.conf
    before = conf.get(_TIMESTAMPS)
    conf.set(_TIMESTAMPS, "TIMESTAMP_MICROS")
    try:
        w.parquet(path)
    finally:
        conf.set(_TIMESTAMPS, before)


@dataclass(frozen=True)
class Conversion:
    """A finished conversion: the Parquet rows, the rejected records, and how many of each were written."""

    rows: DataFrame
    rejects: DataFrame | None
    n_rows: int
    n_rejects: int


REJECT_SCHEMA = "record string, reason string, file string"


def reject_reason(record: Column, width: int) -> Column:
    """Why a CSV record doesn't fit ``width`` typed fields."""
    quotes = F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))
    bare = F.regexp_replace(record, r'"(?:[^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return (F.when(quotes % 2 != 0, "open quote").when(fields < width, "too few fields")
            .when(fields > width, "too many fields").otherwise("value does not fit its type"))


def convert_csv(spark: SparkSession, src: str | Iterable[str], dst: str, table: str | None = None,
                schema: T.StructType | None = None, mode: str = "errorifexists", typed: bool = False,
                set_aside: bool = False, cluster_by: str | None = "auto", **options: str) -> Conversion:
    """Convert CSV to Parquet, counting rows and malformed records while they are written.

    With ``typed=True`` (a known ``table`` layout) dates, codes and coordinates
    are stored parsed. ``cluster_by`` deals the rows to files by ranges of that column and sorts
    them inside, so that a scan for a range of it skips the other files and row groups by
    their min/max statistics, in whatever order the input comes; ``"auto"`` takes the layout's
    date for typed tables (``schemas.CLUSTER``), ``None`` keeps the input's order and saves the shuffle.

    With ``set_aside=True`` malformed records go, from the same scan and write, to
    ``dst/part=rejects`` as (record, reason, file), the others to ``dst/part=rows``. Otherwise
    they stay among the rows (and count as rows) with what could be read. The counts are
    observed at the write itself, so nothing is read twice for them.
    """
    if typed and table is None:
        raise ValueError("typed conversion needs a known table layout")
    df = read_csv(spark, src, table=table, schema=schema, rejects=True, **options)
    names = [c for c in df.columns if c != REJECT_COLUMN]
    bad = F.col(REJECT_COLUMN).isNotNull()
    if set_aside:
        reason = F.when(bad, reject_reason(F.col(REJECT_COLUMN), len(names)))
        df = df.withColumns({"__reason": reason, "__file": F.when(bad, F.col("_metadata.file_path"))})
    if typed:
        df = clean(df, table)
    key = schemas.CLUSTER.get(table) if cluster_by == "auto" and typed else None if cluster_by == "auto" else cluster_by
    if key is not None:
        # rows of one value, or without one, are split among files by their hash
        df = df.repartitionByRange(F.col(key), F.xxhash64(*[F.col(f"`{c}`") for c in names], REJECT_COLUMN))
        df = df.sortWithinPartitions(key)
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("rejects"))
    if not set_aside:
        write_parquet(df.drop(REJECT_COLUMN), dst, mode=mode)
        counts = seen.get
        return Conversion(spark.read.parquet(dst), None, counts["n"], counts["rejects"])
    rejected = F.when(bad, F.struct(F.col(REJECT_COLUMN).alias("record"), F.col("__reason").alias("reason"),
                                    F.col("__file").alias("file")))
    kept = [F.when(~bad, F.col(f"`{c}`")).alias(c) for c in names]
    part = F.when(bad, "rejects").otherwise("rows").alias("part")
    write_parquet(df.select(*kept, rejected.alias("__reject"), part), dst, mode=mode, partition_by=["part"])
    types = df.select(*names).schema
    counts = seen.get
    rows, rejects = (spark.read.schema(s).parquet(f"{dst}/part={p}") if n else spark.createDataFrame([], s) for p, n, s in (
        ("rows", counts["n"] - counts["rejects"], types),
        ("rejects", counts["rejects"], T.StructType().add("__reject", T.StructType.fromDDL(REJECT_SCHEMA)))))
    return Conversion(rows, rejects.select("__reject.*"), counts["n"] - counts["rejects"], counts["rejects"])


def csv_to_parquet(spark: SparkSession, src: str | Iterable[str], dst: str,
                   table: str | None = None, schema: T.StructType | None = None,
                   mode: str = "errorifexists", typed: bool = False, cluster_by: str | None = "auto") -> DataFrame:
    """``convert_csv`` without its counts; returns the Parquet view."""
    return convert_csv(spark, src, dst, table=table, schema=schema, mode=mode, typed=typed, cluster_by=cluster_by).rows


def clean(df: DataFrame, table: str) -> DataFrame:
    """Convert a text-typed table of a known layout to its typed form.

    Columns that are already typed (e.g. read from typed Parquet) are left
    as they are, so ``clean`` can be applied to any source.
    """
    conv = {}
    types = dict(df.dtypes)
    for name, dtype in schemas.TYPES[table].items():
        if name not in df.columns or types[name] != "string":
            continue
        if isinstance(dtype, T.TimestampType):
            conv[name] = parsing.parse_timestamp(name)
        elif isinstance(dtype, T.IntegerType):
            conv[name] = parsing.to_int(name)
        elif isinstance(dtype, T.DoubleType):
            conv[name] = parsing.to_double(name)
    return df.withColumns(conv) if conv else df


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a session temporary view for SQL text."""
    df.createOrReplaceTempView(name)
    return df


def run_sql(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """Run SQL text; ``{name}`` placeholders bind the given DataFrames."""
    return spark.sql(query, **frames)

from blotter.sources.readers import (
    FIRST_LINE,
    REJECT_COLUMN,
    Conversion,
    clean,
    convert_csv,
    csv_to_parquet,
    file_headers,
    first_line,
    header_line,
    normalize_columns,
    parse_csv_lines,
    read_csv,
    read_parquet,
    read_table,
    read_text_lines,
    register_view,
    reject_counts,
    reject_reason,
    run_sql,
    write_csv,
    write_parquet,
)
from blotter.sources.schemas import LAYOUTS, text_schema

__all__ = [
    "Conversion",
    "FIRST_LINE",
    "LAYOUTS",
    "REJECT_COLUMN",
    "clean",
    "convert_csv",
    "csv_to_parquet",
    "file_headers",
    "first_line",
    "header_line",
    "normalize_columns",
    "parse_csv_lines",
    "read_csv",
    "read_parquet",
    "read_table",
    "read_text_lines",
    "register_view",
    "reject_counts",
    "reject_reason",
    "run_sql",
    "text_schema",
    "write_csv",
    "write_parquet",
]

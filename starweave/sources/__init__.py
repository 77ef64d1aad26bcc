"""Sources: declared schemas and file readers."""

from starweave.sources.readers import (
    TEXT_OPTIONS,
    enforce_widths,
    load_table,
    read_csv,
    read_json,
    read_json_mapped,
    read_parquet,
    read_table,
    templated_path,
    with_arrival,
    with_line_number,
    with_lineage,
)
from starweave.sources.schemas import create_all, drop_all, table_schema

__all__ = [
    "TEXT_OPTIONS",
    "create_all",
    "drop_all",
    "enforce_widths",
    "load_table",
    "read_csv",
    "read_json",
    "read_json_mapped",
    "read_parquet",
    "read_table",
    "table_schema",
    "templated_path",
    "with_arrival",
    "with_line_number",
    "with_lineage",
]

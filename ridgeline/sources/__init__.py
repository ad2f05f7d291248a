"""Sources, sinks and fixtures."""

from ridgeline.sources.io import (
    input_bytes,
    load_tables,
    preview,
    read_json,
    read_table,
    schema_table,
    write_json,
    write_parquet,
)

__all__ = [
    "input_bytes", "load_tables", "preview", "read_json", "read_table", "schema_table",
    "write_json", "write_parquet",
]

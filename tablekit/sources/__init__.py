"""Readers and writers."""

from tablekit.sources.readers import (
    from_rows,
    read_baskets,
    read_csv,
    read_delimited,
    read_lines,
    read_table,
    sql_over,
)
from tablekit.sources.writers import preview, write_partitioned

__all__ = [
    "from_rows",
    "preview",
    "read_baskets",
    "read_csv",
    "read_delimited",
    "read_lines",
    "read_table",
    "sql_over",
    "write_partitioned",
]

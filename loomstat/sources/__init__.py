"""Readers and writers."""

from loomstat.sources.files import (
    read_csv_by_name,
    read_delimited,
    read_double_rows,
    read_labeled_dense,
    read_libsvm,
    read_lines,
    write_text,
)

__all__ = [
    "read_csv_by_name",
    "read_delimited",
    "read_double_rows",
    "read_labeled_dense",
    "read_libsvm",
    "read_lines",
    "write_text",
]

"""Readers and writers: the raw order lake, the warehouse/mart table store, JDBC, and
the raw table derived from the driver's test tables."""

from lastmile.sources.lake import read_raw, read_raw_slice, slice_filter, write_raw
from lastmile.sources.store import read_table, write_table
from lastmile.sources.testdata import raw_from_tables

__all__ = [
    "raw_from_tables",
    "read_raw",
    "read_raw_slice",
    "read_table",
    "slice_filter",
    "write_raw",
    "write_table",
]

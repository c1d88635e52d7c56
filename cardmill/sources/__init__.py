"""Readers."""

from cardmill.sources.files import read_csv, read_json_entries, read_json_labels, read_json_map
from cardmill.sources.jdbc import JdbcSource
from cardmill.sources.lake import read_day, read_days, read_table, read_table_if_present

__all__ = [
    "JdbcSource",
    "read_csv",
    "read_day",
    "read_days",
    "read_json_entries",
    "read_json_labels",
    "read_json_map",
    "read_table",
    "read_table_if_present",
]

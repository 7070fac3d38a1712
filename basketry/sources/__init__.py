"""Scans and sinks: text files with headers, Parquet adapters, reports."""

from basketry.sources.reports import (
    read_itemset_report,
    read_itemset_table,
    write_itemset_table,
    write_lines,
)
from basketry.sources.tables import as_entities, as_measurements
from basketry.sources.text import (
    drop_header,
    first_line,
    read_body,
    read_entities_text,
    read_lines,
    read_measurements_text,
    write_entities_text,
    write_measurements_text,
)

__all__ = [
    "as_entities", "as_measurements", "drop_header", "first_line", "read_body",
    "read_entities_text", "read_itemset_report", "read_itemset_table", "read_lines",
    "read_measurements_text", "write_entities_text", "write_itemset_table", "write_lines",
    "write_measurements_text",
]

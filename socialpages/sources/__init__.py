"""Sources (positional CSV files, the benchmark's parquet tables) and text sinks."""

from socialpages.sources import driver_tables
from socialpages.sources.csv_files import parse_lines, read_access, read_friends, read_lines, read_pages
from socialpages.sources.lines import read_numbered_lines, relation_lines, write_with_header
from socialpages.sources.shared_friends import drop_shared, share_friends, shared_friends
from socialpages.sources.sinks import write_report_text, write_tsv, write_value_text

__all__ = [
    "driver_tables",
    "drop_shared",
    "parse_lines",
    "read_access",
    "read_friends",
    "read_lines",
    "read_numbered_lines",
    "read_pages",
    "relation_lines",
    "share_friends",
    "shared_friends",
    "write_report_text",
    "write_tsv",
    "write_value_text",
    "write_with_header",
]

"""socialpages: batch reports over a social-page dataset, written for Spark.

Three relations -- ``pages`` (a person is a page), ``friends`` (directed
owner -> friend edges) and ``access_logs`` (who read which page, when) --
and eight reports over them, each a DataFrame -> DataFrame function that
Catalyst plans and the cluster executes.  Nothing here collects to the
driver; every report's work is partitioned by Spark.
"""

from socialpages.operators.report_text import nationality_report_chunks
from socialpages.operators.reports import (
    access_diversity,
    connectedness_factor,
    country_page_count,
    disconnected_users,
    nationality_hobby_report,
    nationality_hobby_rows,
    popular_users,
    third_field_count,
    top_accessed_pages,
    unvisited_friends,
)
from socialpages.operators.rejects import observe_rejects, reject_counts, top_accessed_pages_audited, top_pages_rejects
from socialpages.sources.csv_files import parse_lines, read_access, read_friends, read_lines, read_pages
from socialpages.sources.lines import read_numbered_lines, relation_lines, write_with_header
from socialpages.sources.shared_friends import drop_shared, share_friends, shared_friends
from socialpages.sources.sinks import write_report_text, write_tsv, write_value_text

__all__ = [
    "access_diversity",
    "connectedness_factor",
    "country_page_count",
    "disconnected_users",
    "drop_shared",
    "nationality_hobby_report",
    "nationality_hobby_rows",
    "nationality_report_chunks",
    "observe_rejects",
    "popular_users",
    "parse_lines",
    "read_access",
    "read_friends",
    "read_lines",
    "read_numbered_lines",
    "read_pages",
    "relation_lines",
    "share_friends",
    "shared_friends",
    "reject_counts",
    "third_field_count",
    "top_accessed_pages",
    "top_accessed_pages_audited",
    "top_pages_rejects",
    "unvisited_friends",
    "write_report_text",
    "write_tsv",
    "write_value_text",
    "write_with_header",
]

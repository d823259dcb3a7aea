"""The reports (one function each) and the reject counter."""

from socialpages.operators.rejects import observe_rejects, reject_counts, top_accessed_pages_audited, top_pages_rejects
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

__all__ = [
    "access_diversity",
    "connectedness_factor",
    "country_page_count",
    "disconnected_users",
    "nationality_hobby_report",
    "nationality_hobby_rows",
    "nationality_report_chunks",
    "observe_rejects",
    "popular_users",
    "reject_counts",
    "third_field_count",
    "top_accessed_pages",
    "top_accessed_pages_audited",
    "top_pages_rejects",
    "unvisited_friends",
]

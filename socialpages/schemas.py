"""Column layout of the three relations.

The CSV files are positional: the i-th comma-separated field of a line is
column i below.  Every CSV field is loaded as a string (the reports compare
ids as text, like the original line-based jobs); typed sources such as the
driver's parquet tables provide the same column names with their own types.
"""

PAGES_COLUMNS = ["person_id", "name", "nationality", "country_code", "hobby"]
FRIENDS_COLUMNS = ["friend_rel", "person_id", "my_friend", "date_of_friendship", "desc"]
ACCESS_COLUMNS = ["access_id", "by_who", "what_page", "type_of_access", "access_time"]

# Number of fields Java's ``line.split(",")`` would have produced for a text
# row.  Only rows loaded from text carry it.
N_FIELDS = "_n_fields"

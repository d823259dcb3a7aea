"""Fixed values.

The results match the original reports only with exactly these values:
the files' text formats, the report defaults and the text rules of Java's
``String.trim`` and ``Integer.parseInt``.  They are stated here plainly,
together, in file and report order; everything else derives from them.
"""

# --- fixed values ----------------------------------------------------------------------------

# Field separator (no quoting, no escaping) and time format.
FIELD_SEPARATOR = ","
ACCESS_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Report defaults: A's nationality and its "name, hobby" separator, B's top k,
# F's name for an owner without a page, G's window in days of 24 hours.
DEFAULT_NATIONALITY = "Latvia"
MEMBER_SEPARATOR = ", "
DEFAULT_TOP_K = 10
UNKNOWN_NAME = "Unknown"
DEFAULT_DAYS = 14

# String.trim() strips every leading and trailing character whose code point
# is at most U+0020; Integer.parseInt accepts an optional sign and ASCII digits.
JAVA_TRIM_MAX_CODE_POINT = 0x20
STRICT_INT_PATTERN = r"^[+-]?[0-9]+$"

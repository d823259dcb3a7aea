"""Scalar column helpers: Java-style trim, strict int parse, arity guard,
exact-hour time cutoff.  All are built-in Spark expressions."""

from socialpages.functions.text import (
    JAVA_TRIM_CHARS,
    STRICT_INT_PATTERN,
    has_min_fields,
    is_int_text,
    is_string,
    java_trim,
    joinable,
    present,
    present_expr,
    strict_int,
    trimmed,
    with_min_fields,
)
from socialpages.functions.time import access_time, before_cutoff

__all__ = [
    "JAVA_TRIM_CHARS",
    "STRICT_INT_PATTERN",
    "access_time",
    "before_cutoff",
    "has_min_fields",
    "is_int_text",
    "is_string",
    "java_trim",
    "joinable",
    "present",
    "present_expr",
    "strict_int",
    "trimmed",
    "with_min_fields",
]

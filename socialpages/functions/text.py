"""Column expressions for the text rules of the line-based reports.

All of them are built-in Spark expressions (codegen'd, JVM-side); none is
a Python UDF.  Helpers that take ``(df, name)`` look at the column's type
at plan-building time: the text rules (trim, strict int parse, "" as an
empty field) apply to string columns only, typed columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from socialpages.constants import JAVA_TRIM_MAX_CODE_POINT, STRICT_INT_PATTERN
from socialpages.schemas import N_FIELDS

# Every character String.trim() strips: U+0000 up to the fixed maximum.
JAVA_TRIM_CHARS = "".join(chr(code) for code in range(0, JAVA_TRIM_MAX_CODE_POINT + 1))

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_string(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def is_integral(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, _INTEGRAL)


def java_trim(col: Column | str) -> Column:
    """``String.trim()``: strip chars <= U+0020 at both ends (Spark's plain
    ``trim`` strips spaces only)."""
    return F.trim(F.col(col) if isinstance(col, str) else col, F.lit(JAVA_TRIM_CHARS))


def trimmed(df: DataFrame, name: str) -> Column:
    """The column, Java-trimmed if it is text."""
    return java_trim(name) if is_string(df, name) else F.col(name)


def strict_int(df: DataFrame, name: str, trim: bool = False) -> Column:
    """``Integer.parseInt`` on a text column: NULL when the text is not an
    optionally signed run of ASCII digits or overflows int32.

    Integral columns are already numbers and are kept as they are (widened
    to bigint), so typed ids beyond 2^31 stay valid.
    """
    if is_integral(df, name):
        return F.col(name).cast("bigint")
    text = F.col(name).cast("string")
    if trim:
        text = java_trim(text)
    return F.when(text.rlike(STRICT_INT_PATTERN), text.try_cast("int"))


def is_int_text(col: Column) -> Column:
    """True when the value, as text, passes ``strict_int`` (NULL counts as a
    failure)."""
    text = col.cast("string")
    return F.coalesce(
        text.rlike(STRICT_INT_PATTERN) & text.try_cast("int").isNotNull(), F.lit(False)
    )


def present(df: DataFrame, name: str) -> Column:
    """A usable key: not NULL and, for text, not the empty string."""
    c = F.col(name)
    if is_string(df, name):
        return c.isNotNull() & (c != F.lit(""))
    return c.isNotNull()


def present_expr(col: Column) -> Column:
    """``present`` for a computed string expression."""
    return col.isNotNull() & (col != F.lit(""))


def has_min_fields(df: DataFrame, more_than: int, columns: list[str]) -> Column | None:
    """The arity guard ``parts.length > more_than`` of the line-based jobs as a
    condition, or None where every row passes.

    Text rows carry their Java split length in ``_n_fields``.  For typed rows
    the length is the position of the last field that is present (not NULL and,
    for text, not empty), so a row passes if any of the relation's ``columns``
    at position ``more_than`` or later is present.  A frame that has none of
    these columns, or has one that cannot be NULL, is complete; the optimizer
    drops the condition where a join or filter already implies it.
    """
    if N_FIELDS in df.columns:
        return F.col(N_FIELDS) > F.lit(more_than)
    later = [c for c in columns[more_than:] if c in df.columns]
    if not later or any(not df.schema[c].nullable and not is_string(df, c) for c in later):
        return None
    condition = present(df, later[0])
    for c in later[1:]:
        condition = condition | present(df, c)
    return F.coalesce(condition, F.lit(False)) if any(is_string(df, c) for c in later) else condition


def with_min_fields(df: DataFrame, more_than: int, columns: list[str], required: str | None = None) -> DataFrame:
    """The rows that pass ``has_min_fields``.

    ``required`` names a column that the caller tests for presence anyway.  If it
    is at position ``more_than`` or later, that test implies the guard on typed
    rows, and no further column is read for it.
    """
    if required in columns[more_than:] and N_FIELDS not in df.columns:
        return df
    condition = has_min_fields(df, more_than, columns)
    return df if condition is None else df.where(condition)


def joinable(left: DataFrame, left_column: str, right: DataFrame, right_column: str) -> tuple[DataFrame, DataFrame]:
    """Both frames with the two columns as text if just one of them is text, so
    that a typed id meets the same id as text instead of failing a cast."""
    if is_string(left, left_column) == is_string(right, right_column):
        return left, right
    return (
        left.withColumn(left_column, F.col(left_column).cast("string")),
        right.withColumn(right_column, F.col(right_column).cast("string")),
    )

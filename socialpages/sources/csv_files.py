"""Load the three positional CSV relations.

The files are comma-separated, unquoted, one header line per file, CRLF or
LF line ends.  The rules below reproduce how the line-based jobs see a
line (``line.split(",")``):

* no quoting, no escaping: ``"x,y"`` is two fields;
* an empty field is the empty string, never NULL -- a short row's missing
  fields are empty as well, which is how Java's split sees trailing empty
  fields (it drops them);
* ``_n_fields`` is the Java split length: the position of the last
  non-empty field.  The reports' arity guards (``parts.length > k``) test
  it; see ``socialpages.functions.with_min_fields``;
* the first line of every file is the header and is dropped (only the
  true header -- not the first line of every input split);
* no trimming: each report trims where the original job does.

A line may have any number of fields and any characters (NUL, quotes and
Unicode's non-characters included): the reader delivers whole lines and
``parse_lines`` splits them.  Several paths (or a directory / glob) load as
one relation, the union of their rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from socialpages.constants import FIELD_SEPARATOR
from socialpages.schemas import ACCESS_COLUMNS, FRIENDS_COLUMNS, N_FIELDS, PAGES_COLUMNS

LINE = "value"

# A line never holds the characters that end lines: as separator and quote of
# the reader they leave every line whole, whatever else is in it.
_NO_SEPARATOR, _NO_QUOTE = "\r", "\n"


def split_length(line: Column) -> Column:
    """``line.split(",").length`` in Java: fields up to the last non-empty one;
    a line of separators only has none, the empty line has one."""
    kept = F.rtrim(line, F.lit(FIELD_SEPARATOR))
    return (
        F.when(line == "", F.lit(1))
        .when(kept == "", F.lit(0))
        .otherwise(F.size(F.split(kept, FIELD_SEPARATOR, -1)))
    )


def parse_lines(lines: DataFrame, columns: list[str], line: str = LINE, keep: list[str] | None = None) -> DataFrame:
    """The relation of whole lines: the columns in ``keep``, the first fields
    under the names in ``columns`` (a missing field is empty) and ``_n_fields``.
    A NULL line has no fields."""
    text = F.coalesce(F.col(line), F.lit(FIELD_SEPARATOR))
    fields = F.split(text, FIELD_SEPARATOR, -1)
    return lines.select(
        *(keep or []),
        *[F.coalesce(F.get(fields, i), F.lit("")).alias(c) for i, c in enumerate(columns)],
        split_length(text).alias(N_FIELDS),
    )


def read_lines(spark: SparkSession, paths, header: bool = True) -> DataFrame:
    """The files' lines as one column, without each file's header line; blank
    lines, which every arity guard drops, are skipped."""
    return (
        spark.read.schema(f"{LINE} string")
        .option("header", header)
        .option("enforceSchema", True)
        .option("sep", _NO_SEPARATOR)
        .option("quote", _NO_QUOTE)
        .option("escape", _NO_QUOTE)
        .csv(paths)
    )


def _read(spark: SparkSession, paths, columns: list[str], header: bool) -> DataFrame:
    return parse_lines(read_lines(spark, paths, header), columns)


def read_pages(spark: SparkSession, paths, header: bool = True) -> DataFrame:
    """``PersonID,Name,Nationality,Country Code,Hobby`` -> pages relation."""
    return _read(spark, paths, PAGES_COLUMNS, header)


def read_friends(spark: SparkSession, paths, header: bool = True) -> DataFrame:
    """``FriendRel,PersonID,MyFriend,DateOfFriendship,Desc`` -> friends."""
    return _read(spark, paths, FRIENDS_COLUMNS, header)


def read_access(spark: SparkSession, paths, header: bool = True) -> DataFrame:
    """``AccessID,ByWho,WhatPage,TypeOfAccess,AccessTime`` -> access_logs."""
    return _read(spark, paths, ACCESS_COLUMNS, header)

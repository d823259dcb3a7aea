"""The nationality report's value as data.

The original job's record is a nationality and one text: every member line,
each followed by a newline.  For a large nationality that text does not fit in a
row or a task, so it is a sequence of chunks of bounded length: together, in
order, they are the text, and any part of it can be read by its offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from socialpages.constants import MEMBER_SEPARATOR
from socialpages.functions.text import java_trim, trimmed, with_min_fields
from socialpages.operators.reports import nationality_condition
from socialpages.plans.ordering import with_offsets
from socialpages.schemas import PAGES_COLUMNS

CHUNK_CHARS = 1 << 16


def _members(pages: DataFrame, nationality: str | None) -> DataFrame:
    """``(nationality, member, tie)``: ``tie`` tells equal member lines apart."""
    p = with_min_fields(pages, 4, PAGES_COLUMNS)
    where = F.col("nationality").isNotNull() if nationality is None else nationality_condition(p, nationality)
    return p.where(where).select(
        java_trim(F.col("nationality").cast("string")).alias("nationality"),
        F.concat(
            F.coalesce(trimmed(p, "name"), F.lit("")), F.lit(MEMBER_SEPARATOR), F.coalesce(trimmed(p, "hobby"), F.lit(""))
        ).alias("member"),
        F.col("person_id").cast("string").alias("tie"),
    )


def nationality_report_chunks(pages: DataFrame, nationality: str | None = None, chunk: int = CHUNK_CHARS) -> DataFrame:
    """``(nationality, chunk_no, offset, text)`` of one nationality, or of all.

    A nationality's text is its member lines (``name, hobby``) in byte order,
    each followed by a newline.  Chunk ``chunk_no`` (from 0) holds the characters
    ``offset`` to ``offset + chunk`` of it; all but the last have exactly ``chunk``
    characters, whatever lines they cut.  Rows need a fifth field; values are
    trimmed, a missing name or hobby is empty; rows without a nationality are
    left out.  No members, no chunks.

    Plan: the lines are range-sorted once; each learns its offset from the ranges'
    totals and a running sum in its range; a line gives one piece to each chunk
    that it reaches into; a chunk gathers at most ``chunk`` pieces of together
    ``chunk`` characters.  No task or row holds a whole nationality.
    """
    if chunk < 1:
        raise ValueError("a chunk has at least one character")
    lines = _members(pages, nationality).withColumn("line", F.concat("member", F.lit("\n")))
    lines = with_offsets(lines, ["nationality", "member", "tie"], F.char_length("line"), ["nationality"], "at")
    pieces = lines.withColumn("stop", F.col("at") + F.char_length("line")).withColumn(
        "chunk_no", F.explode(F.expr(f"sequence(at div {chunk}, (stop - 1) div {chunk})"))
    )
    pieces = pieces.withColumn("begin", F.greatest("at", F.col("chunk_no") * chunk)).selectExpr(
        "nationality", "chunk_no", "begin",
        f"substring(line, cast(begin - at + 1 as int), cast(least(stop, (chunk_no + 1) * {chunk}) - begin as int)) as piece",
    )
    gathered = pieces.groupBy("nationality", "chunk_no").agg(F.array_sort(F.collect_list(F.struct("begin", "piece"))).alias("pieces"))
    return gathered.selectExpr("nationality", "chunk_no", f"chunk_no * {chunk} as offset", "array_join(pieces.piece, '') as text")

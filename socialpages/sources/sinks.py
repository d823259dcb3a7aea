"""Text sinks in the layout of the original jobs' output files.

All writes are distributed (one file per partition) and refuse an existing
output directory unless ``mode`` says otherwise.  Values are written raw:
no quoting, NULL written as the empty string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from socialpages.plans.lineage import discard, staged


def _text(col) -> F.Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


# The original jobs' lines show names and counts without the ids.
CONNECTEDNESS_LINE = ("who", "connectedness")
DIVERSITY_LINE = ("name", "total_accesses", "distinct_pages")
POPULAR_LINE = ("name", "n")


def write_tsv(
    df: DataFrame, path: str, mode: str = "errorifexists", sort_by: list[str] | None = None,
    columns: tuple[str, ...] | None = None,
) -> None:
    """``key TAB value...`` lines, one per row: the given columns, or all in
    DataFrame order.

    ``sort_by`` orders the output (part files in order) the way the original
    jobs' single reducer did: by key, strings in byte order.  It costs a
    range-partitioned sort, so it is off by default.
    """
    if sort_by:
        df = df.orderBy(*sort_by)
    df.select(F.concat_ws("\t", *[_text(c) for c in columns or df.columns]).alias("value")).write.mode(
        mode
    ).text(path)


def write_value_text(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Top-pages layout: ``accesses TAB person_id,name,nationality``.

    The rows are written in the report's order (accesses descending).
    """
    line = F.concat(
        _text("accesses"), F.lit("\t"),
        F.concat_ws(",", _text("person_id"), _text("name"), _text("nationality")),
    )
    ordered = df.orderBy(
        F.desc("accesses"), F.asc("person_id"), F.asc("name"), F.asc("nationality")
    )
    ordered.select(line.alias("value")).write.mode(mode).text(path)


def write_report_text(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Nationality report layout from ``(nationality, member)`` rows.

    Per nationality: ``nationality TAB first member``, the other members one
    per line, then an empty line -- the text of one ``key TAB value`` record
    whose value is every member followed by a newline.  Members are sorted.

    No group is ever gathered into one row or one task: each row gets an id, and
    the head of a group is the row with the smallest (member, id), found by an
    aggregate of one row per nationality.  The other rows are those whose id is
    no head's, an anti join on the row id, which is unique, so rows of one
    nationality spread over all tasks.  The lines are written by a
    range-partitioned global sort on (nationality, section, member, id), so even
    identical member lines of one huge nationality spread over many tasks and
    files.  The ids are fixed by a table in ``spark.checkpoint.dir`` before they
    are used twice, so an input whose row order is not reproducible cannot make
    the two uses disagree; the table is removed after the write.
    """
    spark = report.sparkSession
    rows, kept = staged(
        report.select(
            "nationality", F.coalesce("member", F.lit("")).alias("member"), F.monotonically_increasing_id().alias("_row")
        )
    )
    try:
        first = rows.groupBy("nationality").agg(F.min(F.struct("member", "_row")).alias("f"))
        head = first.select(
            "nationality", F.lit(0).alias("section"), F.col("f.member").alias("member"),
            F.col("f._row").alias("_row"),
            F.concat(_text("nationality"), F.lit("\t"), F.col("f.member")).alias("line"),
        )
        body = rows.join(first.select(F.col("f._row").alias("_row")), "_row", "left_anti").select(
            "nationality", F.lit(1).alias("section"), "member", "_row", F.col("member").alias("line")
        )
        tail = first.select(
            "nationality", F.lit(2).alias("section"), F.lit("").alias("member"),
            F.lit(0).cast("bigint").alias("_row"), F.lit("").alias("line"),
        )
        lines = head.unionByName(body).unionByName(tail)
        lines.orderBy("nationality", "section", "member", "_row").select("line").write.mode(mode).text(path)
    finally:
        discard(spark, kept)

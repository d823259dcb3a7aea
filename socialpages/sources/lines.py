"""Text files as ordered lines, and positional CSV files with a header each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from socialpages.constants import FIELD_SEPARATOR
from socialpages.plans.lineage import staged
from socialpages.plans.ordering import range_starts
from socialpages.sources.csv_files import LINE


def read_numbered_lines(spark: SparkSession, paths) -> DataFrame:
    """``(line_no, line)`` of the text files at ``paths``: their lines from 1 in file
    order, that is part files by their number, other files by path, lines by
    their place in the file.  Blank lines count, NUL and all other characters
    are kept.

    A split of a file knows where it starts; its rows are read in order.  The
    lines of each split are counted, and the running sums over the splits, a
    row for each, are the splits' first numbers: no window over all lines.  The
    lines are written to the shared folder once, so that counts and numbers
    come from the same reading.
    """
    lines, _ = staged(
        spark.read.text(paths).select(
            F.expr("try_cast(regexp_extract(_metadata.file_path, '/part-([0-9]+)[^/]*$', 1) as bigint)").alias("part"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
            F.col("value").alias("line"),
        )
    )
    split = ["part", "file", "start"]
    first = lines.groupBy("file", "start").agg(F.min("row").alias("first"))
    before = range_starts(lines, split, F.lit(1), [], "before").drop("part")
    return (
        lines.join(before.join(first, ["file", "start"]), ["file", "start"])
        .select((F.col("before") + F.col("row") - F.col("first") + 1).alias("line_no"), "line")
    )


def relation_lines(df: DataFrame, columns: list[str]) -> DataFrame:
    """One line for each row: the columns' values as text, NULL as the empty text,
    with the field separator between them.  Values must not hold it or a line
    break: the files know no quoting."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return df.select(F.concat_ws(FIELD_SEPARATOR, *fields).alias(LINE))


def write_with_header(lines: DataFrame, path: str, header: str, files: int = 1, mode: str = "errorifexists") -> None:
    """The lines (the first column of ``lines``) as ``files`` text files, each with the header
    line first, as the ``read_*`` functions load them.  Lines are dealt out evenly, in no
    stated order; a file without lines holds its header only."""
    spark = lines.sparkSession
    body = lines.toDF(LINE).select(
        F.pmod(F.monotonically_increasing_id(), F.lit(files)).cast("int").alias("file"), F.lit(1).alias("section"), LINE
    )
    heads = spark.range(files).select(F.col("id").cast("int").alias("file"), F.lit(0).alias("section"), F.lit(header).alias(LINE))
    rows = heads.unionByName(body).repartitionById(files, F.col("file")).sortWithinPartitions("file", "section")
    rows.select(LINE).write.mode(mode).text(path)

"""Running totals and row numbers over a global order, without one task that
sees all rows.

The rows are sorted by range partitioning and written once, each with its
place (number of its range and row in it).  A total for each range, and group
within it, is a small table; its running sums are where the ranges start.  A
row's number is its range's start plus its row in the range; a running total
adds a window over the range.  Only the small table, one row for each range
(and for each group in a range), is summed up in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from socialpages.plans.lineage import staged

# monotonically_increasing_id(): the partition's number above, the row below
_ROW_BITS = 33


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def placed(df: DataFrame, order: list) -> tuple[DataFrame, str, str]:
    """``df`` globally sorted by ``order`` and written to the shared folder, with two
    columns, whose names are returned: the range and the row in it."""
    part, row, place = (fresh_name(df, c) for c in ("_range", "_row", "_place"))
    sorted_rows = df.orderBy(*order) if order else df
    rows = sorted_rows.withColumn(place, F.monotonically_increasing_id()).select(
        *df.columns,
        F.shiftright(place, _ROW_BITS).alias(part),
        F.col(place).bitwiseAND((1 << _ROW_BITS) - 1).alias(row),
    )
    return staged(rows)[0], part, row


def range_starts(rows: DataFrame, part: list[str], value: Column, group: list[str], out: str) -> DataFrame:
    """``(part..., group..., out)``: for each range and group the sum of ``value`` over the
    group's rows in earlier ranges.  Ranges are ordered by the columns ``part``."""
    total = fresh_name(rows, "_total")
    totals = rows.groupBy(*part, *group).agg(F.sum(value).alias(total))
    earlier = Window.partitionBy(*group).orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*part, *group, F.coalesce(F.sum(total).over(earlier), F.lit(0)).cast("bigint").alias(out))


def _joined(rows: DataFrame, starts: DataFrame, keys: list[str]) -> DataFrame:
    """Equal keys, nulls included."""
    renamed = {k: fresh_name(rows, f"_start_{k}") for k in keys}
    starts = starts.withColumnsRenamed(renamed)
    same = [rows[k].eqNullSafe(starts[renamed[k]]) for k in keys]
    return rows.join(starts, same).drop(*renamed.values())


def numbered(df: DataFrame, order: list, out: str = "line_no") -> DataFrame:
    """``df`` with a bigint column ``out``: the row's number, from 1, in the global order
    ``order``.  Equal rows are numbered in some order; give a total order for
    numbers that do not depend on the partitioning."""
    if fresh_name(df, out) != out:
        raise ValueError(f"the table has a column {out} already")
    rows, part, row = placed(df, order)
    before = fresh_name(rows, "_before")
    starts = range_starts(rows, [part], F.lit(1), [], before)
    return _joined(rows, starts, [part]).select(*df.columns, (F.col(before) + F.col(row) + 1).alias(out))


def with_offsets(df: DataFrame, order: list, value: Column, group: list[str] | None = None, out: str = "offset") -> DataFrame:
    """``df`` with a bigint column ``out``: the sum of ``value`` (not null) over the rows before
    it in the order ``order``, within its ``group``.

    ``order`` should start with the group's columns: then a range holds few
    groups, and a group that holds a third of all rows is spread over a third
    of the ranges."""
    if fresh_name(df, out) != out:
        raise ValueError(f"the table has a column {out} already")
    group = list(group or [])
    weight = fresh_name(df, "_weight")
    rows, part, row = placed(df.withColumn(weight, value.cast("bigint")), order)
    before = fresh_name(rows, "_before")
    starts = range_starts(rows, [part], F.col(weight), group, before)
    inside = Window.partitionBy(part, *group).orderBy(row).rowsBetween(Window.unboundedPreceding, -1)
    rows = _joined(rows, starts, [part, *group])
    total = F.col(before) + F.coalesce(F.sum(weight).over(inside), F.lit(0))
    return rows.select(*df.columns, total.cast("bigint").alias(out))

"""Read a report's physical plan as text (for tests and tuning).

Uses only ``DataFrame.explain``; the plan is what Catalyst and AQE chose.
"""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buffer = io.StringIO()
    with contextlib.redirect_stdout(buffer):
        df.explain(mode=mode)
    return buffer.getvalue()


def count_nodes(df: DataFrame, node: str) -> int:
    """How many physical operators named ``node`` (e.g. ``Exchange``) the
    plan holds, subqueries included."""
    count = 0
    for line in plan_text(df, "simple").splitlines():
        name = line.lstrip(" :+-")
        if name.startswith(node):
            count += 1
    return count

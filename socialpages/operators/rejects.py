"""Reject counting: rows too short for a field, and rows whose field a strict
int parse refuses.

The original top-pages job first tests the arity of a row and then counts, in
one job counter over both inputs, the rows whose id field is not an int.  Here
the counts are a query -- one partial row per task -- or, inside a larger job,
an ``Observation`` filled while that job runs (no extra pass over the data).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from socialpages.constants import DEFAULT_TOP_K
from socialpages.functions.text import has_min_fields, is_int_text, is_integral, present, strict_int
from socialpages.operators.reports import leading_pages
from socialpages.plans.lineage import staged
from socialpages.schemas import ACCESS_COLUMNS, PAGES_COLUMNS

RULES = ("int", "present")


def _accepted(df: DataFrame, column: str, rule: str) -> Column:
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    if rule == "present":
        return F.coalesce(present(df, column), F.lit(False))
    if is_integral(df, column):
        return F.col(column).isNotNull()
    return is_int_text(F.col(column))


def _counts(df: DataFrame, column: str, rule: str, more_than: int | None, columns: list[str] | None) -> list[Column]:
    guard = None if more_than is None else has_min_fields(df, more_than, columns or df.columns)
    guard = F.lit(True) if guard is None else F.coalesce(guard, F.lit(False))
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~guard).alias("n_short"),
        F.count_if(guard & ~_accepted(df, column, rule)).alias("n_rejected"),
    ]


def reject_counts(
    df: DataFrame, column: str, rule: str = "int", more_than: int | None = None, columns: list[str] | None = None
) -> DataFrame:
    """One row ``(n_rows, n_short, n_rejected)``.

    ``n_short``: rows that the arity guard ``more_than`` (over the relation's
    ``columns``) drops, 0 without a guard.  ``n_rejected``: rows that pass the
    guard and that the rule refuses.
    ``rule="int"``: ``column`` is not an int in ``Integer.parseInt``'s sense
    (the top-pages report drops such ids; NULL is a reject).
    ``rule="present"``: ``column`` is NULL or empty -- the id is blank; the
    reports keyed by text ids drop these rows.
    """
    return df.agg(*_counts(df, column, rule, more_than, columns))


def top_pages_rejects(pages: DataFrame, access: DataFrame) -> DataFrame:
    """The top-pages job's reject counter: ``(src, n_rows, n_short,
    n_rejected)`` for each input and, as ``total``, over both."""
    parts = [
        reject_counts(access, "what_page", more_than=2, columns=ACCESS_COLUMNS).withColumn("src", F.lit("access")),
        reject_counts(pages, "person_id", more_than=2, columns=PAGES_COLUMNS).withColumn("src", F.lit("pages")),
    ]
    return _with_total(parts[0].unionByName(parts[1]))


def _with_total(counts: DataFrame) -> DataFrame:
    return (
        counts.rollup("src")
        .agg(*[F.sum(c).alias(c) for c in ("n_rows", "n_short", "n_rejected")])
        .select(F.coalesce("src", F.lit("total")).alias("src"), "n_rows", "n_short", "n_rejected")
    )


def top_accessed_pages_audited(pages: DataFrame, access: DataFrame, k: int = DEFAULT_TOP_K) -> tuple[DataFrame, DataFrame]:
    """The top-pages report and its reject counter from one reading of each input:
    the rows of ``top_accessed_pages`` and those of ``top_pages_rejects``.

    The access log is grouped by the parsed page, its short and refused rows
    each a group beside the pages, so that one partially aggregated pass gives
    the counts of both results.  Page rows are parsed once, with what the job
    makes of them.  Both are written to the shared folder (a row for each
    page accessed, and the page rows) and the two results read these tables.
    """
    entry = F.when(_guard(access, ACCESS_COLUMNS), F.when(_accepted(access, "what_page", "int"), F.lit("ok")).otherwise("rejected"))
    hits, _ = staged(
        access.select(entry.alias("entry"), strict_int(access, "what_page").alias("page"))
        .select(F.coalesce("entry", F.lit("short")).alias("entry"), F.when(F.col("entry") == "ok", F.col("page")).alias("page"))
        .groupBy("entry", "page")
        .agg(F.count(F.lit(1)).alias("accesses"))
    )
    entry = F.when(_guard(pages, PAGES_COLUMNS), F.when(_accepted(pages, "person_id", "int"), F.lit("ok")).otherwise("rejected"))
    rows, _ = staged(
        pages.select(
            F.coalesce(entry, F.lit("short")).alias("entry"), strict_int(pages, "person_id").alias("person_id"), "name", "nationality"
        )
    )
    accepted = rows.where("entry = 'ok'").select("person_id", "name", "nationality")
    report = leading_pages(accepted, hits.where("entry = 'ok'").select("page", "accesses"), k)
    seen = hits.select(F.lit("access").alias("src"), "entry", F.col("accesses").alias("n")).unionByName(
        rows.select(F.lit("pages").alias("src"), "entry", F.lit(1).cast("bigint").alias("n"))
    )
    none = F.lit(0).cast("bigint")
    counts = seen.groupBy("src").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("entry") == "short", F.col("n"))), none).alias("n_short"),
        F.coalesce(F.sum(F.when(F.col("entry") == "rejected", F.col("n"))), none).alias("n_rejected"),
    )
    return report, _with_total(counts)


def _guard(df: DataFrame, columns: list[str]) -> Column:
    guard = has_min_fields(df, 2, columns)
    return F.lit(True) if guard is None else F.coalesce(guard, F.lit(False))


def observe_rejects(
    df: DataFrame, column: str, name: str = "rejects", rule: str = "int",
    more_than: int | None = None, columns: list[str] | None = None,
) -> tuple[DataFrame, Observation]:
    """``df`` with an attached observation of the same three counts.

    Read ``observation.get`` after the first action on the returned frame.
    """
    observation = Observation(name)
    return df.observe(observation, *_counts(df, column, rule, more_than, columns)), observation

"""The eight reports, one DataFrame -> DataFrame function each.

Inputs are the three relations with the column names of
``socialpages.schemas`` -- from ``socialpages.sources.read_*`` (text, all
strings, with ``_n_fields``) or any typed source with the same names.

Plan shape, shared by all reports:

* every aggregate runs before the join it feeds (map-side partial
  aggregation, so a hot page or person is combined inside each task
  before the shuffle and a hot key never ships its raw rows);
* names are reduced to one row per id (``min``) before joining, so joins
  never multiply rows, and every join input holds at most one row per
  key -- a hot key cannot skew a join (the top-pages report, which must
  keep repeated page rows, joins them to its k leading ids only);
* join strategies are left to Catalyst and AQE: a side is broadcast only
  when its size is under ``spark.sql.autoBroadcastJoinThreshold``
  (statically from file sizes, or at run time from the measured shuffle
  output), otherwise the join is a sort-merge join;
* nothing is collected to the driver and no group is gathered into a
  single row: top-k keeps k rows per task, the global average is one
  partial row per task.

Ids are compared as text for text input (``"04" != "4"``) except in the
top-pages report, which parses them as ints like the original job.  Rows
whose grouping id is empty are dropped (they never join);
``reject_counts`` counts them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from socialpages.constants import (
    DEFAULT_DAYS,
    DEFAULT_NATIONALITY,
    DEFAULT_TOP_K,
    MEMBER_SEPARATOR,
    UNKNOWN_NAME,
)
from socialpages.functions.text import (
    is_string,
    java_trim,
    joinable,
    present,
    strict_int,
    trimmed,
    with_min_fields,
)
from socialpages.functions.time import access_time, before_cutoff
from socialpages.schemas import ACCESS_COLUMNS, FRIENDS_COLUMNS, PAGES_COLUMNS


def _rows() -> Column:
    """Row count (``count(1)``)."""
    return F.count(F.lit(1))


def _text(df: DataFrame, name: str, trim: bool) -> Column:
    """The column as text, Java-trimmed when ``trim``.  Typed values are
    rendered as strings, which carry no surrounding whitespace to trim."""
    if not is_string(df, name):
        return F.col(name).cast("string")
    return java_trim(F.col(name)) if trim else F.col(name)


def _names_by_id(pages: DataFrame, min_fields: int, trim_id: bool, trim_name: bool,
                 blank_name_is_missing: bool = False) -> DataFrame:
    """``(id, name)`` with one row per page id: the smallest name.

    The original jobs keep whichever row of a repeated id arrives last,
    which depends on the shuffle; ``min`` is the deterministic choice.
    """
    p = with_min_fields(pages, min_fields, PAGES_COLUMNS)
    ids = p.select(
        (trimmed(p, "person_id") if trim_id else F.col("person_id")).alias("id"),
        (trimmed(p, "name") if trim_name else F.col("name")).alias("name"),
    )
    name = F.nullif(F.col("name"), F.lit("")) if blank_name_is_missing else F.col("name")
    return ids.where(present(ids, "id")).groupBy("id").agg(F.min(name).alias("name"))


# --- A: members of one nationality ---------------------------------------------------------

def nationality_condition(pages: DataFrame, nationality: str) -> Column:
    """The (trimmed) nationality is the given one."""
    cond = trimmed(pages, "nationality") == F.lit(nationality)
    if is_string(pages, "nationality") and nationality:
        # Implied by the trimmed equality and pushable into the scan, where
        # dictionary-encoded row groups without the value are skipped.
        cond = F.col("nationality").contains(nationality) & cond
    return cond


def _nationality_members(pages: DataFrame, nationality: str) -> DataFrame:
    p = with_min_fields(pages, 4, PAGES_COLUMNS)
    return p.where(nationality_condition(p, nationality)).select(
        F.coalesce(trimmed(p, "name"), F.lit("")).alias("name"),
        F.coalesce(trimmed(p, "hobby"), F.lit("")).alias("hobby"),
    )


def nationality_hobby_rows(pages: DataFrame, nationality: str = DEFAULT_NATIONALITY) -> DataFrame:
    """Names and hobbies of the people of one nationality: ``(name, hobby)``.

    Rows need a fifth field; nationality, name and hobby are trimmed, a missing
    name is empty; the match is exact and case-sensitive.  No shuffle.
    """
    return _nationality_members(pages, nationality)


def nationality_hobby_report(pages: DataFrame, nationality: str = DEFAULT_NATIONALITY) -> DataFrame:
    """The report form: ``(nationality, member)``, member = ``name, hobby``.

    One row per member line of the original report (whose single output
    record joins all member lines of the nationality); gathering them into
    one value would put a whole nationality in one row, so the joined text
    is produced by the sink ``write_report_text`` instead.  No shuffle.
    """
    m = _nationality_members(pages, nationality)
    return m.select(
        F.lit(nationality).alias("nationality"),
        F.concat(F.col("name"), F.lit(MEMBER_SEPARATOR), F.col("hobby")).alias("member"),
    )


# --- B: most accessed pages ------------------------------------------------------------------

def top_accessed_pages(pages: DataFrame, access: DataFrame, k: int = DEFAULT_TOP_K) -> DataFrame:
    """The ``k`` most accessed pages: ``(accesses, person_id, name, nationality)``.

    Accesses of every type count.  Page ids on both sides are parsed as
    ints (text that is not an int is rejected); accesses to unknown pages
    and pages never accessed are left out.  A page id listed on several
    page rows keeps all of them, each with the page's count.  Order:
    accesses descending, then id, name, nationality ascending; exactly
    ``k`` rows (ties at rank k are cut by id).

    Plan:

    1. accesses per page and the distinct page ids, both partially
       aggregated map-side, joined on the id (one row per id on each side);
    2. the top ``k`` ids by (accesses desc, id) -- ``TakeOrderedAndProject``.
       Every id has at least one page row, so these ``k`` ids hold all
       rows of the answer;
    3. the page rows of those ids.  The planner knows the size of ``k`` rows: it
       broadcasts them while they are under its threshold, and then no page row
       is shuffled; beyond it the page rows are joined by id, both sides plain
       shuffles that AQE can split where one id is on many page rows;
    4. the final top ``k`` rows, again ``k`` per task and then merged.

    ``k`` rows are merged in one task (steps 2 and 4), so ``k`` is bounded by
    what one task can sort; it is a report's length, not a share of the data.
    """
    a = with_min_fields(access, 2, ACCESS_COLUMNS, required="what_page")
    hits = a.select(strict_int(a, "what_page").alias("page")).where(F.col("page").isNotNull())
    p = with_min_fields(pages, 2, PAGES_COLUMNS)
    details = p.select(
        strict_int(p, "person_id").alias("person_id"), F.col("name"), F.col("nationality")
    ).where(F.col("person_id").isNotNull())
    return leading_pages(details, hits.groupBy("page").agg(_rows().alias("accesses")), k)


def leading_pages(details: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` leading rows of ``details(person_id, name, nationality)`` by
    ``counts(page, accesses)``, one row for each page."""
    listed = details.select("person_id").distinct()
    leaders = (
        counts.join(listed, counts.page == listed.person_id)
        .orderBy(F.desc("accesses"), F.asc("person_id"))
        .limit(k)
        .select(F.col("person_id").alias("leader"), "accesses")
    )
    rows = details.join(leaders, details.person_id == leaders.leader)
    return (
        rows.orderBy(
            F.desc("accesses"), F.asc("person_id"), F.asc("name"), F.asc("nationality")
        )
        .limit(k)
        .select("accesses", "person_id", "name", "nationality")
    )


# --- C: pages per country --------------------------------------------------------------------

def country_page_count(pages: DataFrame) -> DataFrame:
    """Pages per (trimmed) nationality: ``(nationality, n_pages)``.

    Rows need a fourth field.  One partially aggregated shuffle.
    """
    p = with_min_fields(pages, 3, PAGES_COLUMNS)
    return p.groupBy(trimmed(p, "nationality").alias("nationality")).agg(_rows().alias("n_pages"))


def third_field_count(pages: DataFrame, access: DataFrame) -> DataFrame:
    """Occurrences of each value of the third field over both files: ``(k, n)``.

    The original country count reads the access log too, so its keys mix
    nationalities with accessed page ids; this is that count, without the
    header lines.  Union all of the two projections, one shuffle.
    """
    a = with_min_fields(access, 3, ACCESS_COLUMNS)
    p = with_min_fields(pages, 3, PAGES_COLUMNS)
    values = a.select(_text(a, "what_page", trim=True).alias("k")).unionByName(
        p.select(_text(p, "nationality", trim=True).alias("k"))
    )
    return values.groupBy("k").agg(_rows().alias("n"))


# --- D: how often a page owner is listed as a friend -------------------------------------------

def connectedness_factor(pages: DataFrame, friends: DataFrame) -> DataFrame:
    """In-degree per page: ``(id, who, connectedness)``.

    ``connectedness`` counts friend rows naming the page as ``my_friend``
    (repeated edges count again).  Every page appears, with 0 when nobody
    lists it.  A friend id with no page -- or whose page has an empty
    name -- is reported as ``(id, id, 0)``: the original report prints the
    id with zero and drops its count, and that rule is kept on purpose.
    Ids and names are trimmed.  Friend rows need a third field and page
    rows a second one; shorter rows are rejected.

    Plan: partial count per friend id, one name per page id, full outer
    sort-merge join on the id (both sides already hash-partitioned on it).
    """
    f = with_min_fields(friends, 2, FRIENDS_COLUMNS, required="my_friend")
    listed = f.select(trimmed(f, "my_friend").alias("friend"))
    indegree = listed.where(present(listed, "friend")).groupBy("friend").agg(_rows().alias("n"))
    names = _names_by_id(pages, 1, trim_id=True, trim_name=True, blank_name_is_missing=True)
    names, indegree = joinable(names, "id", indegree, "friend")
    joined = names.join(indegree, names.id == indegree.friend, "full_outer")
    has_page = F.col("name").isNotNull()
    the_id = F.coalesce(F.col("id"), F.col("friend"))
    return joined.select(
        the_id.alias("id"),
        F.when(has_page, F.col("name")).otherwise(the_id.cast("string")).alias("who"),
        F.when(has_page, F.coalesce(F.col("n"), F.lit(0))).otherwise(F.lit(0)).cast("bigint")
        .alias("connectedness"),
    )


# --- E: accesses and distinct pages per person ------------------------------------------------

def access_diversity(pages: DataFrame, access: DataFrame) -> DataFrame:
    """Per person with a page and at least one access:
    ``(person_id, name, total_accesses, distinct_pages)``.

    Exact distinct count (an empty page field counts as a value).  Access
    rows need a third field, page rows a second one.  Ids are not trimmed.

    Plan: count per (reader, page) first -- this splits a heavy reader over
    its pages and collapses repeats map-side -- then sum and count per
    reader, then an inner join with one name per page id.
    """
    a = with_min_fields(access, 2, ACCESS_COLUMNS)
    reads = a.select(F.col("by_who"), F.col("what_page").alias("page"))
    per_pair = reads.where(present(reads, "by_who")).groupBy("by_who", "page").agg(_rows().alias("c"))
    per_reader = per_pair.groupBy("by_who").agg(
        F.sum("c").alias("total_accesses"), F.count("page").alias("distinct_pages")
    )
    names = _names_by_id(pages, 1, trim_id=False, trim_name=False)
    names, per_reader = joinable(names, "id", per_reader, "by_who")
    return names.join(per_reader, names.id == per_reader.by_who).select(
        F.col("id").alias("person_id"), "name", "total_accesses", "distinct_pages"
    )


# --- F: declared friends whose page was never visited --------------------------------------------

def unvisited_friends(pages: DataFrame, friends: DataFrame, access: DataFrame) -> DataFrame:
    """Per owner: distinct friends whose page the owner never accessed:
    ``(person_id, name, n_unvisited)``, only owners with at least one.

    Any access type is a visit.  Self-edges and friends without a page
    count.  ``name`` is ``Unknown`` for an owner without a page.  Ids are
    compared untrimmed; friend and access rows need a third field, page
    rows a second.

    Plan: distinct (owner, friend) edges and distinct (reader, page)
    visits -- both partially aggregated, so a repeated pair or a hot owner
    is combined map-side -- then a left anti join on the pair (both sides
    are already partitioned on it, no further shuffle), a count per owner
    and a left join with one name per page id.
    """
    f = with_min_fields(friends, 2, FRIENDS_COLUMNS)
    edges = f.select(F.col("person_id").alias("owner"), F.col("my_friend").alias("friend"))
    edges = edges.where(present(edges, "owner")).distinct()
    a = with_min_fields(access, 2, ACCESS_COLUMNS)
    visits = a.select(F.col("by_who").alias("owner"), F.col("what_page").alias("friend")).distinct()
    for column in ("owner", "friend"):
        edges, visits = joinable(edges, column, visits, column)
    unvisited = (
        edges.join(visits, ["owner", "friend"], "left_anti")
        .groupBy("owner")
        .agg(_rows().alias("n_unvisited"))
    )
    names = _names_by_id(pages, 1, trim_id=False, trim_name=False)
    unvisited, names = joinable(unvisited, "owner", names, "id")
    return unvisited.join(names, unvisited.owner == names.id, "left").select(
        F.col("owner").alias("person_id"),
        F.coalesce(F.col("name"), F.lit(UNKNOWN_NAME)).alias("name"),
        "n_unvisited",
    )


# --- G: people without recent access ---------------------------------------------------------

def disconnected_users(
    pages: DataFrame,
    access: DataFrame,
    as_of: dt.datetime | str | None = None,
    days: int = DEFAULT_DAYS,
) -> DataFrame:
    """Pages whose owner has not accessed anything since ``as_of - days``:
    ``(person_id, name)``.

    Kept when the owner's latest access is strictly before the cutoff or
    there is none (an access time that does not parse counts as none).
    The window is ``days * 24`` exact hours.  ``as_of`` defaults to now.
    (The original job parses times with a pattern that never fits the
    data and so lists every page; this is the rule it was written for.)

    Plan: partial max per reader, one name per page id, left join, filter.
    """
    a = with_min_fields(access, 1, ACCESS_COLUMNS, required="by_who")
    reads = a.select(trimmed(a, "by_who").alias("reader"), access_time(a, "access_time").alias("ts"))
    last = reads.where(present(reads, "reader")).groupBy("reader").agg(F.max("ts").alias("last_access"))
    names = _names_by_id(pages, 2, trim_id=False, trim_name=False)
    ts_type = last.schema["last_access"].dataType
    names, last = joinable(names, "id", last, "reader")
    joined = names.join(last, names.id == last.reader, "left")
    stale = F.col("last_access").isNull() | before_cutoff(F.col("last_access"), ts_type, as_of, days)
    return joined.where(stale).select(F.col("id").alias("person_id"), "name")


# --- H: people with more friends than average ----------------------------------------------------

def popular_users(pages: DataFrame, friends: DataFrame) -> DataFrame:
    """People who list more friends than the average person: ``(id, name, n)``.

    ``n`` counts friend rows per owner (out-degree; repeated edges count).
    The average is over every id found in either relation, zeros
    included, and the comparison is strict.  ``name`` is NULL for an owner
    without a page.  Ids are trimmed; friend rows need a third field and
    page rows a second.

    Plan: one name per page id and the count per owner, each partially
    aggregated (the counts by hash, so friend rows are not sorted), joined by
    a full outer join of one row per id on each side.  The average is taken from
    the same grouped rows: its subquery reads names and counts too, so that it
    reuses both shuffles and the inputs are read and joined once.
    """
    f = with_min_fields(friends, 2, FRIENDS_COLUMNS)
    owners = f.select(trimmed(f, "person_id").alias("owner"))
    counts = owners.where(present(owners, "owner")).groupBy("owner").agg(_rows().alias("listed"))
    names = _names_by_id(pages, 1, trim_id=True, trim_name=False)
    names, counts = joinable(names, "id", counts, "owner")
    people = names.join(counts, names.id == counts.owner, "full_outer").select(
        F.coalesce("id", "owner").alias("id"), "name", F.coalesce("listed", F.lit(0)).alias("n")
    )
    # counting the names keeps them in the subquery: its shuffles are the ones above
    both = people.agg(F.struct(F.avg("n").alias("average"), F.count("name").alias("named")).alias("both"))
    return people.where(F.col("n") > both.scalar().getField("average"))

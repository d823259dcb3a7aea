"""The three relations defined over the benchmark's parquet tables.

The benchmark ships no social-page CSVs; these views map its TPC-H-like
tables onto the same column names, with their native types:

* pages   = customer JOIN nation: c_custkey person_id, c_name name,
  n_name nationality, c_nationkey country_code, c_mktsegment hobby;
* access  = events: event_id access_id, user_id by_who, integer ``k`` of
  the JSON ``props`` what_page, event_type type_of_access, ts access_time;
* friends = lineitem JOIN orders on the order key: o_custkey person_id and
  l_partkey (variant ``part``) or l_suppkey (variant ``supp``) my_friend (no
  report reads the date or the description).

Further views over whole tables reach what these cannot:

* ``pages_nulls``: pages with missing names, country codes and hobbies;
* ``pages_few``: supplier JOIN nation, fewer ids than readers and owners;
* ``pages_repeated``: orders, with many page rows for one id;
* ``pages_text`` / ``access_text``: pages and access as lines of text, some of
  them short, padded, with ids that are no ints, with times that do not parse;
* ``pages_files`` / ``access_files`` / ``friends_files``: such lines, some with header words
  and with Unicode's non-characters in them, written as CSV files with a header
  each and read back through the file readers.

Each view is a lazy DataFrame: Catalyst prunes the columns a report does
not read (the JSON is only parsed when ``what_page`` is used) and pushes
filters into the parquet scans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from socialpages.plans.lineage import scratch_path
from socialpages.schemas import ACCESS_COLUMNS, PAGES_COLUMNS
from socialpages.sources.csv_files import LINE, parse_lines, read_access, read_friends, read_pages
from socialpages.sources.lines import write_with_header

FRIEND_VARIANTS = {"part": "l_partkey", "supp": "l_suppkey"}


def _view_name(sf_dir: str, name: str) -> str:
    digest = hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:12]
    return f"socialpages_{name}_{digest}"


def _registered(spark: SparkSession, view: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()``, registered once per session as a temporary view.

    File listing, footer reads and analysis happen once; later reports in
    the same session resolve the view by name.  A temporary view is only a
    named logical plan, so Catalyst still prunes and pushes down through it.
    """
    if not spark.catalog.tableExists(view):
        build().createOrReplaceTempView(view)
    return spark.table(view)


RELATIONS = ("pages", "access", *[f"friends_{v}" for v in FRIEND_VARIANTS])
TABLES = ("customer", "supplier", "nation", "events", "lineitem", "orders")


def refresh(spark: SparkSession, sf_dir: str) -> None:
    """Forget the registered views of ``sf_dir`` (re-listed on next use)."""
    for name in RELATIONS + TABLES:
        spark.catalog.dropTempView(_view_name(sf_dir, name))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return _registered(spark, _view_name(sf_dir, name), lambda: spark.read.parquet(path))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _registered(spark, _view_name(sf_dir, "pages"), lambda: _pages(spark, sf_dir))


def access(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _registered(spark, _view_name(sf_dir, "access"), lambda: _access(spark, sf_dir))


def friends(spark: SparkSession, sf_dir: str, variant: str = "part") -> DataFrame:
    if variant not in FRIEND_VARIANTS:
        raise ValueError(f"variant must be one of {sorted(FRIEND_VARIANTS)}")
    return _registered(
        spark, _view_name(sf_dir, f"friends_{variant}"), lambda: _friends(spark, sf_dir, variant)
    )


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("person_id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("nationality"),
        _never_null("c_nationkey").alias("country_code"),
        F.col("c_mktsegment").alias("hobby"),
    )


def _never_null(join_key: str) -> Column:
    """An inner join's key is not NULL; told so, the arity guard of a typed
    relation needs no other column."""
    return F.coalesce(F.col(join_key), F.lit(-1))


def _access(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    # json_tuple (a one-row-per-input generator) parses each document once;
    # an inlined get_json_object would be parsed again by every filter
    # Catalyst pushes below the projection (e.g. the join's IS NOT NULL).
    parsed = events.select(
        "event_id", "user_id", "event_type", "ts", F.json_tuple("props", "k").alias("k")
    )
    return parsed.select(
        F.col("event_id").alias("access_id"),
        F.col("user_id").alias("by_who"),
        F.col("k").try_cast("bigint").alias("what_page"),
        F.col("event_type").alias("type_of_access"),
        F.col("ts").alias("access_time"),
    )


def _friends(spark: SparkSession, sf_dir: str, variant: str) -> DataFrame:
    friend_col = FRIEND_VARIANTS[variant]
    lineitem = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders")
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("friend_rel"),
        F.col("o_custkey").alias("person_id"),
        F.col(friend_col).alias("my_friend"),
    )


def pages_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).selectExpr(
        "person_id",
        "if(person_id % 5 = 0, null, name) as name",
        "nationality",
        "if(person_id % 3 = 0, null, country_code) as country_code",
        "nullif(hobby, 'BUILDING') as hobby",
    )


def pages_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = _table(spark, sf_dir, "supplier"), _table(spark, sf_dir, "nation")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("person_id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("nationality"),
        _never_null("s_nationkey").alias("country_code"),
        F.lit("supply").alias("hobby"),
    )


def pages_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        "o_custkey as person_id",
        "concat('Order ', cast(o_orderkey as string)) as name",
        "o_orderstatus as nationality",
        "cast(o_custkey % 25 as int) as country_code",
        "o_orderpriority as hobby",
    )


# Lines of text made of the two relations, in SQL that other engines read too.
PAGE_LINE = """
CASE WHEN person_id % 12 = 1 THEN 'c' ELSE '' END || CAST(person_id AS STRING) || ',' || name ||
CASE WHEN person_id % 10 = 6 THEN ''
     ELSE ',' || CASE WHEN person_id % 9 = 4 THEN '  ' || nationality || ' ' ELSE nationality END || ',' ||
          CAST(country_code AS STRING) || ',' || CASE WHEN person_id % 7 = 2 THEN ',' ELSE hobby || ' ' END
END"""
ACCESS_LINE = """
CAST(access_id AS STRING) || ',' ||
CASE WHEN access_id % 19 = 2 THEN ' ' || CAST(by_who AS STRING) || ' ' ELSE CAST(by_who AS STRING) END ||
CASE WHEN access_id % 11 = 3 THEN ',,'
     ELSE ',' || CASE WHEN access_id % 13 = 5 THEN 'p' || CAST(what_page AS STRING)
                      WHEN access_id % 17 = 7 THEN CAST(what_page + 3000000000 AS STRING)
                      WHEN access_id % 19 = 2 THEN '+0' || CAST(what_page AS STRING)
                      ELSE CAST(what_page AS STRING) END || ',' || type_of_access || ',' ||
          CASE WHEN access_id % 23 = 9 THEN 'at noon' ELSE CAST(date_trunc('second', access_time) AS STRING) END ||
          CASE WHEN access_id % 29 = 4 THEN ',more,,' ELSE '' END
END"""


def pages_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(pages(spark, sf_dir).select(F.expr(PAGE_LINE).alias(LINE)), PAGES_COLUMNS)


def access_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(access(spark, sf_dir).select(F.expr(ACCESS_LINE).alias(LINE)), ACCESS_COLUMNS)


# Lines as above, some names of which are header words or hold characters that no
# Unicode text should.
FILE_LINE = f"""
CASE WHEN person_id % 41 = 3 THEN replace({PAGE_LINE.strip()}, name, 'PersonID')
     WHEN person_id % 41 = 5 THEN replace({PAGE_LINE.strip()}, name, 'Name')
     WHEN person_id % 41 = 7 THEN replace({PAGE_LINE.strip()}, name, '\ufffe"\uffff' || name)
     ELSE {PAGE_LINE.strip()}
END"""
FRIEND_LINE = """
CAST(friend_rel AS STRING) || ',' || CAST(person_id AS STRING) || ',' ||
CASE WHEN friend_rel % 37 = 2 THEN '' WHEN friend_rel % 5 = 1 THEN ' ' || CAST(my_friend AS STRING) || ' '
     ELSE CAST(my_friend AS STRING) END || ',,' ||
CASE WHEN friend_rel % 31 = 4 THEN 'MyFriend' ELSE '' END"""

PAGES_HEADER = "PersonID,Name,Nationality,Country Code,Hobby"
FRIENDS_HEADER = "FriendRel,PersonID,MyFriend,DateOfFriendship,Desc"
ACCESS_HEADER = "AccessID,ByWho,WhatPage,TypeOfAccess,AccessTime"
FOLDERS = 3
FILES = 4


def _through_files(lines: DataFrame, header: str, read: Callable) -> DataFrame:
    """The relation of ``lines(value, folder)`` through files in several folders."""
    spark = lines.sparkSession
    root = scratch_path(spark, "files")
    for k in range(FOLDERS):
        write_with_header(lines.where(F.col("folder") == k).select(LINE), f"{root}/{k}", header, FILES)
    return read(spark, [f"{root}/{k}" for k in range(FOLDERS)])


def pages_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = pages(spark, sf_dir).select(F.expr(FILE_LINE).alias(LINE), (F.col("person_id") % FOLDERS).alias("folder"))
    return _through_files(lines, PAGES_HEADER, read_pages)


def access_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = access(spark, sf_dir).select(F.expr(ACCESS_LINE).alias(LINE), (F.col("access_id") % FOLDERS).alias("folder"))
    return _through_files(lines, ACCESS_HEADER, read_access)


def friends_files(spark: SparkSession, sf_dir: str, variant: str = "part") -> DataFrame:
    lines = friends(spark, sf_dir, variant).select(F.expr(FRIEND_LINE).alias(LINE), (F.col("friend_rel") % FOLDERS).alias("folder"))
    return _through_files(lines, FRIENDS_HEADER, read_friends)

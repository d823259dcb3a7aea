"""
DuckDB oracle for each.

The reports run on the benchmark's parquet tables through the views of
``socialpages.sources.driver_tables`` (pages = customer JOIN nation,
access = events, friends = lineitem JOIN orders).  Every query reads the
whole tables; nothing is sampled or capped except B's top-k, which is the
report itself.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from socialpages.constants import DEFAULT_DAYS, DEFAULT_TOP_K  # noqa: E402
from socialpages.operators import (  # noqa: E402
    access_diversity,
    connectedness_factor,
    country_page_count,
    disconnected_users,
    nationality_hobby_report,
    nationality_hobby_rows,
    nationality_report_chunks,
    popular_users,
    third_field_count,
    top_accessed_pages,
    top_accessed_pages_audited,
    top_pages_rejects,
    unvisited_friends,
)
from socialpages.schemas import ACCESS_COLUMNS, FRIENDS_COLUMNS, PAGES_COLUMNS  # noqa: E402
from socialpages.sources import driver_tables as dv  # noqa: E402
from socialpages.plans import scratch_path  # noqa: E402
from socialpages.sources import (  # noqa: E402
    parse_lines,
    read_numbered_lines,
    share_friends,
    shared_friends,
    write_tsv,
    write_value_text,
)
from socialpages.sources.sinks import CONNECTEDNESS_LINE  # noqa: E402

# The text operators are an optional part: without their folder, the pipeline
# file that belongs to it or a library that they need, everything else still works.
try:
    import corpus_pipeline  # noqa: F401
    from socialpages.llm import queries as llm_queries
except ImportError:
    llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

# Report parameters on the benchmark tables (fixed values): nationality
# NATION_7 for the nationality report, the default top 10 pages, and the
# default 14-day window ending 2024-02-13 12:00 (cutoff 2024-01-30 12:00)
# for disconnected users, chunks of 1000 characters for the report's text.
NATIONALITY = "NATION_7"
TOP_K = DEFAULT_TOP_K
AS_OF = dt.datetime(2024, 2, 13, 12, 0, 0)
DAYS = DEFAULT_DAYS
REPORT_CHUNK = 1000


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the top accessed pages on the sf0.001 tables."""
    return _top_accessed_pages(spark, SMOKE_DIR)


def _top_accessed_pages(spark, d):
    return top_accessed_pages(dv.pages(spark, d), dv.access(spark, d), TOP_K)


def _text_fields(spark, d):
    """Whole texts of documents as lines: Java split length, first five fields."""
    documents = spark.read.parquet(f"{d}/documents.parquet")
    return parse_lines(documents, PAGES_COLUMNS, "text", keep=["doc_id"])


def _top_accessed_pages_lines(spark, d):
    """The report's text output, written and read back in order."""
    out = scratch_path(spark, "lines")
    write_value_text(_top_accessed_pages(spark, d), out)
    return read_numbered_lines(spark, out)


def _connectedness_lines(spark, d):
    """The report's text output in the order of its key, ids as text."""
    out = scratch_path(spark, "lines")
    report = connectedness_factor(dv.pages(spark, d), dv.friends(spark, d, "supp"))
    write_tsv(report.withColumn("id", report.id.cast("string")), out, sort_by=["id"], columns=CONNECTEDNESS_LINE)
    return read_numbered_lines(spark, out)


def _shared(spark, d, layout):
    """The friends relation written once in the layout of a report."""
    name = f"friends_{uuid.uuid4().hex}"
    share_friends(dv.friends(spark, d, "part"), name, [layout], buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return shared_friends(spark, name, layout)


def _top_pages_audited(spark, d):
    """Both results of one reading: the report's rows and the counters."""
    rows, counts = top_accessed_pages_audited(dv.pages_text(spark, d), dv.access_text(spark, d), TOP_K)
    report = rows.selectExpr("'report' AS part", "CAST(person_id AS STRING) AS item", "name", "nationality", "accesses AS value")
    each = ", ".join(f"named_struct('item', concat(src, ' {c}'), 'value', {c})" for c in ("n_rows", "n_short", "n_rejected"))
    rejects = counts.selectExpr(f"inline(array({each}))")
    return report.unionByName(rejects.selectExpr("'rejects' AS part", "item", "'' AS name", "'' AS nationality", "value"))


def reports() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The reports over the views of the driver tables."""
    P, A, F_ = dv.pages, dv.access, dv.friends
    few, many, nulls, text, log = dv.pages_few, dv.pages_repeated, dv.pages_nulls, dv.pages_text, dv.access_text
    return {
        "nationality_hobby_rows": lambda s, d: nationality_hobby_rows(P(s, d), NATIONALITY),
        "nationality_hobby_report": lambda s, d: nationality_hobby_report(P(s, d), NATIONALITY),
        "top_accessed_pages": _top_accessed_pages,
        "country_page_count": lambda s, d: country_page_count(P(s, d)),
        "third_field_count": lambda s, d: third_field_count(P(s, d), A(s, d)),
        "connectedness_part": lambda s, d: connectedness_factor(P(s, d), F_(s, d, "part")),
        "connectedness_supp": lambda s, d: connectedness_factor(P(s, d), F_(s, d, "supp")),
        "access_diversity": lambda s, d: access_diversity(P(s, d), A(s, d)),
        "unvisited_friends_part": lambda s, d: unvisited_friends(P(s, d), F_(s, d, "part"), A(s, d)),
        "unvisited_friends_supp": lambda s, d: unvisited_friends(P(s, d), F_(s, d, "supp"), A(s, d)),
        "disconnected_users": lambda s, d: disconnected_users(P(s, d), A(s, d), as_of=AS_OF, days=DAYS),
        "popular_users": lambda s, d: popular_users(P(s, d), F_(s, d, "part")),
        "reject_counts": lambda s, d: top_pages_rejects(P(s, d), A(s, d)),
        # missing values
        "nationality_hobby_nulls": lambda s, d: nationality_hobby_report(nulls(s, d), NATIONALITY),
        "country_page_count_nulls": lambda s, d: country_page_count(nulls(s, d)),
        # ids without a page
        "connectedness_few": lambda s, d: connectedness_factor(few(s, d), F_(s, d, "part")),
        "access_diversity_few": lambda s, d: access_diversity(few(s, d), A(s, d)),
        "unvisited_friends_few": lambda s, d: unvisited_friends(few(s, d), F_(s, d, "part"), A(s, d)),
        "popular_users_few": lambda s, d: popular_users(few(s, d), F_(s, d, "part")),
        # many page rows for one id
        "top_accessed_pages_repeated": lambda s, d: top_accessed_pages(many(s, d), A(s, d), TOP_K),
        "access_diversity_repeated": lambda s, d: access_diversity(many(s, d), A(s, d)),
        "popular_users_repeated": lambda s, d: popular_users(many(s, d), F_(s, d, "part")),
        # lines of text
        "text_fields": _text_fields,
        "nationality_hobby_text": lambda s, d: nationality_hobby_rows(text(s, d), NATIONALITY),
        "top_accessed_pages_text": lambda s, d: top_accessed_pages(text(s, d), log(s, d), TOP_K),
        "country_page_count_text": lambda s, d: country_page_count(text(s, d)),
        "third_field_count_text": lambda s, d: third_field_count(text(s, d), log(s, d)),
        "access_diversity_text": lambda s, d: access_diversity(text(s, d), log(s, d)),
        "disconnected_users_text": lambda s, d: disconnected_users(text(s, d), log(s, d), as_of=AS_OF, days=DAYS),
        "reject_counts_text": lambda s, d: top_pages_rejects(text(s, d), log(s, d)),
        # CSV files with headers, written from the tables and read by the loader
        "nationality_hobby_files": lambda s, d: nationality_hobby_rows(dv.pages_files(s, d), NATIONALITY),
        "top_accessed_pages_files": lambda s, d: top_accessed_pages(dv.pages_files(s, d), dv.access_files(s, d), TOP_K),
        "connectedness_files": lambda s, d: connectedness_factor(dv.pages_files(s, d), dv.friends_files(s, d, "supp")),
        "unvisited_friends_files": lambda s, d: unvisited_friends(
            dv.pages_files(s, d), dv.friends_files(s, d, "part"), dv.access_files(s, d)
        ),
        # the nationality report's text, in chunks
        "nationality_report_chunks": lambda s, d: nationality_report_chunks(P(s, d), NATIONALITY, REPORT_CHUNK),
        "nationality_report_chunks_repeated": lambda s, d: nationality_report_chunks(many(s, d), chunk=REPORT_CHUNK),
        "nationality_report_chunks_text": lambda s, d: nationality_report_chunks(text(s, d), chunk=REPORT_CHUNK),
        # text output read back in its order
        "top_accessed_pages_lines": _top_accessed_pages_lines,
        "connectedness_lines": _connectedness_lines,
        # rows and reject counters from one reading of the inputs
        "top_accessed_pages_audited": _top_pages_audited,
        # friends written once in the layout of the report
        "connectedness_shared": lambda s, d: connectedness_factor(P(s, d), _shared(s, d, "friend")),
        "unvisited_friends_shared": lambda s, d: unvisited_friends(P(s, d), _shared(s, d, "pair"), A(s, d)),
        "popular_users_shared": lambda s, d: popular_users(P(s, d), _shared(s, d, "owner")),
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**reports(), **(llm_queries.queries() if llm_queries else {})}


# --- oracle ------------------------------------------------------------------------------

_P = """p AS (
  SELECT c_custkey AS person_id, c_name AS name, n_name AS nationality,
         c_nationkey AS country_code, c_mktsegment AS hobby
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

_P_NULLS = _P.replace("p AS", "whole AS") + """,
p AS (
  SELECT person_id, CASE WHEN person_id % 5 <> 0 THEN name END AS name, nationality,
         CASE WHEN person_id % 3 <> 0 THEN country_code END AS country_code, nullif(hobby, 'BUILDING') AS hobby
  FROM whole)"""

_P_FEW = """p AS (
  SELECT s_suppkey AS person_id, s_name AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

_P_MANY = """p AS (
  SELECT o_custkey AS person_id, 'Order ' || o_orderkey AS name, o_orderstatus AS nationality FROM orders)"""

_A = """a AS (
  SELECT event_id AS access_id, user_id AS by_who,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS what_page,
         event_type AS type_of_access, ts AS access_time
  FROM events)"""


def _f(column: str) -> str:
    return f"""f AS (
  SELECT l_orderkey * 10 + l_linenumber AS friend_rel, o_custkey AS person_id,
         {column} AS my_friend
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _fields_sql(line: str, names: list[str]) -> str:
    """First fields of a line and its split length."""
    fields = ", ".join(f"coalesce(string_split({line}, ',')[{i + 1}], '') AS {n}" for i, n in enumerate(names))
    return f"""{fields},
         CASE WHEN {line} = '' THEN 1 WHEN regexp_full_match({line}, ',*') THEN 0
              ELSE len(string_split(regexp_replace({line}, ',+$', ''), ',')) END AS nf"""


def _trim_sql(x: str) -> str:
    return f"regexp_replace({x}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def _int_sql(x: str) -> str:
    digits = f"TRY_CAST(ltrim({x}, '+') AS BIGINT)"
    return (
        f"(CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') "
        f"AND {digits} BETWEEN -2147483648 AND 2147483647 THEN {digits} END)"
    )


_TEXT = (
    _P.replace("p AS", "typed_p AS") + ",\n" + _A.replace("a AS", "typed_a AS", 1) + f""",
pl AS (SELECT {dv.PAGE_LINE} AS line FROM typed_p),
al AS (SELECT {dv.ACCESS_LINE} AS line FROM typed_a),
p AS (SELECT {_fields_sql("line", PAGES_COLUMNS)} FROM pl),
a AS (SELECT {_fields_sql("line", ACCESS_COLUMNS)} FROM al)"""
)


_FILES = (
    _TEXT.replace(dv.PAGE_LINE, dv.FILE_LINE) + ",\n" + _f("l_suppkey").replace("f AS", "supp_f AS")
    + ",\n" + _f("l_partkey").replace("f AS", "part_f AS") + f""",
supp_l AS (SELECT {dv.FRIEND_LINE} AS line FROM supp_f),
part_l AS (SELECT {dv.FRIEND_LINE} AS line FROM part_f),
fs AS (SELECT {_fields_sql("line", FRIENDS_COLUMNS)} FROM supp_l),
fp AS (SELECT {_fields_sql("line", FRIENDS_COLUMNS)} FROM part_l)"""
)


def _chunks_sql(views: str, members: str) -> str:
    """Chunks of each nationality's whole text, of ``members(nationality, member)``."""
    return _with(views) + f""",
m AS ({members}),
whole AS (SELECT nationality, string_agg(member || chr(10), '' ORDER BY member) AS v FROM m GROUP BY nationality)
SELECT nationality, chunk_no, chunk_no * {REPORT_CHUNK} AS "offset", substr(v, chunk_no * {REPORT_CHUNK} + 1, {REPORT_CHUNK}) AS text
FROM (SELECT nationality, v, unnest(range((length(v) + {REPORT_CHUNK} - 1) // {REPORT_CHUNK})) AS chunk_no FROM whole)"""


def _with(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"


def _connectedness_sql(pages: str, column: str) -> str:
    return _with(pages, _f(column)) + """
SELECT coalesce(p.person_id, g.my_friend) AS id,
       coalesce(p.name, CAST(g.my_friend AS VARCHAR)) AS who,
       CAST(CASE WHEN p.person_id IS NULL THEN 0 ELSE coalesce(g.n, 0) END AS BIGINT) AS connectedness
FROM p FULL JOIN (SELECT my_friend, count(*) AS n FROM f GROUP BY my_friend) g
  ON p.person_id = g.my_friend"""


def _unvisited_sql(pages: str, column: str) -> str:
    return _with(pages, _A, _f(column)) + """
SELECT u.person_id, coalesce(p.name, 'Unknown') AS name, u.n AS n_unvisited
FROM (
  SELECT e.person_id, count(*) AS n
  FROM (SELECT DISTINCT person_id, my_friend FROM f) e
  WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.by_who = e.person_id AND a.what_page = e.my_friend)
  GROUP BY e.person_id) u
LEFT JOIN p ON p.person_id = u.person_id"""


def _top_sql(pages: str) -> str:
    return _with(pages, _A) + f"""
SELECT c.n AS accesses, p.person_id, p.name, p.nationality
FROM p JOIN (SELECT what_page, count(*) AS n FROM a GROUP BY what_page) c
  ON c.what_page = p.person_id
ORDER BY c.n DESC, p.person_id, p.name, p.nationality
LIMIT {TOP_K}"""


def _top_text_sql(views: str) -> str:
    return _with(views) + f"""
SELECT c.n AS accesses, CAST(q.person_id AS INTEGER) AS person_id, q.name, q.nationality
FROM (SELECT {_int_sql("person_id")} AS person_id, name, nationality FROM p WHERE nf > 2) q
JOIN (SELECT {_int_sql("what_page")} AS page, count(*) AS n FROM a WHERE nf > 2 GROUP BY page) c ON c.page = q.person_id
ORDER BY accesses DESC, q.person_id, q.name, q.nationality
LIMIT {TOP_K}"""


def _rejects_text_sql() -> str:
    return _with(_TEXT) + f"""
SELECT coalesce(src, 'total') AS src, count(*) AS n_rows, count(*) FILTER (WHERE nf <= 2) AS n_short,
       count(*) FILTER (WHERE nf > 2 AND k IS NULL) AS n_rejected
FROM (
  SELECT 'access' AS src, nf, {_int_sql("what_page")} AS k FROM a
  UNION ALL
  SELECT 'pages' AS src, nf, {_int_sql("person_id")} AS k FROM p) t
GROUP BY ROLLUP (src)"""


def _diversity_sql(pages: str) -> str:
    return _with(pages, _A) + """
SELECT p.person_id, p.name, r.t AS total_accesses, r.d AS distinct_pages
FROM (SELECT person_id, min(name) AS name FROM p GROUP BY person_id) p JOIN (
  SELECT by_who, count(*) AS t, count(DISTINCT what_page) AS d FROM a GROUP BY by_who) r
  ON r.by_who = p.person_id"""


def _popular_sql(pages: str) -> str:
    return _with(pages, _f("l_partkey")) + """,
k AS (
  SELECT coalesce(p.person_id, g.person_id) AS id, p.name, coalesce(g.n, 0) AS n
  FROM (SELECT person_id, min(name) AS name FROM p GROUP BY person_id) p
  FULL JOIN (SELECT person_id, count(*) AS n FROM f GROUP BY person_id) g
    ON p.person_id = g.person_id)
SELECT id, name, n FROM k WHERE n > (SELECT avg(n) FROM k)"""


_CUTOFF = (AS_OF - dt.timedelta(days=DAYS)).isoformat(sep=" ")


def report_sql() -> dict[str, str]:
    return {
        "nationality_hobby_rows": _with(_P)
        + f"SELECT name, hobby FROM p WHERE nationality = '{NATIONALITY}'",
        "nationality_hobby_report": _with(_P)
        + f"SELECT nationality, name || ', ' || hobby AS member FROM p "
        f"WHERE nationality = '{NATIONALITY}'",
        "top_accessed_pages": _top_sql(_P),
        "country_page_count": _with(_P)
        + "SELECT nationality, count(*) AS n_pages FROM p GROUP BY nationality",
        "third_field_count": _with(_P, _A)
        + """
SELECT k, count(*) AS n FROM (
  SELECT CAST(what_page AS VARCHAR) AS k FROM a
  UNION ALL
  SELECT nationality AS k FROM p) t
GROUP BY k""",
        "connectedness_part": _connectedness_sql(_P, "l_partkey"),
        "connectedness_supp": _connectedness_sql(_P, "l_suppkey"),
        "access_diversity": _diversity_sql(_P),
        "unvisited_friends_part": _unvisited_sql(_P, "l_partkey"),
        "unvisited_friends_supp": _unvisited_sql(_P, "l_suppkey"),
        "disconnected_users": _with(_P, _A)
        + f"""
SELECT p.person_id, p.name
FROM p LEFT JOIN (SELECT by_who, max(access_time) AS m FROM a GROUP BY by_who) l
  ON l.by_who = p.person_id
WHERE l.m IS NULL OR l.m < TIMESTAMP '{_CUTOFF}'""",
        "popular_users": _popular_sql(_P),
        "reject_counts": _with(_P, _A)
        + """
SELECT coalesce(src, 'total') AS src, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_short,
       count(*) FILTER (WHERE k IS NULL) AS n_rejected
FROM (
  SELECT 'access' AS src, what_page AS k FROM a
  UNION ALL
  SELECT 'pages' AS src, person_id AS k FROM p) t
GROUP BY ROLLUP (src)""",
        "nationality_hobby_nulls": _with(_P_NULLS)
        + f"SELECT nationality, coalesce(name, '') || ', ' || hobby AS member FROM p "
        f"WHERE nationality = '{NATIONALITY}' AND hobby IS NOT NULL",
        "country_page_count_nulls": _with(_P_NULLS)
        + "SELECT nationality, count(*) AS n_pages FROM p WHERE country_code IS NOT NULL OR hobby IS NOT NULL GROUP BY nationality",
        "connectedness_few": _connectedness_sql(_P_FEW, "l_partkey"),
        "access_diversity_few": _diversity_sql(_P_FEW),
        "unvisited_friends_few": _unvisited_sql(_P_FEW, "l_partkey"),
        "popular_users_few": _popular_sql(_P_FEW),
        "top_accessed_pages_repeated": _top_sql(_P_MANY),
        "access_diversity_repeated": _diversity_sql(_P_MANY),
        "popular_users_repeated": _popular_sql(_P_MANY),
        "text_fields": f"""
SELECT doc_id, {_fields_sql("coalesce(text, ',')", PAGES_COLUMNS).replace("AS nf", "AS _n_fields")} FROM documents""",
        "nationality_hobby_text": _with(_TEXT)
        + f"""
SELECT {_trim_sql("name")} AS name, {_trim_sql("hobby")} AS hobby
FROM p WHERE nf > 4 AND {_trim_sql("nationality")} = '{NATIONALITY}'""",
        "top_accessed_pages_text": _top_text_sql(_TEXT),
        "country_page_count_text": _with(_TEXT)
        + f"SELECT {_trim_sql('nationality')} AS nationality, count(*) AS n_pages FROM p WHERE nf > 3 GROUP BY ALL",
        "third_field_count_text": _with(_TEXT)
        + f"""
SELECT k, count(*) AS n FROM (
  SELECT {_trim_sql("what_page")} AS k FROM a WHERE nf > 3
  UNION ALL
  SELECT {_trim_sql("nationality")} AS k FROM p WHERE nf > 3) t
GROUP BY k""",
        "access_diversity_text": _with(_TEXT)
        + """
SELECT q.person_id, q.name, r.t AS total_accesses, r.d AS distinct_pages
FROM (SELECT person_id, min(name) AS name FROM p WHERE nf > 1 AND person_id <> '' GROUP BY person_id) q JOIN (
  SELECT by_who, count(*) AS t, count(DISTINCT what_page) AS d FROM a WHERE nf > 2 AND by_who <> '' GROUP BY by_who) r
  ON r.by_who = q.person_id""",
        "disconnected_users_text": _with(_TEXT)
        + f"""
SELECT q.person_id, q.name
FROM (SELECT person_id, min(name) AS name FROM p WHERE nf > 2 AND person_id <> '' GROUP BY person_id) q LEFT JOIN (
  SELECT {_trim_sql("by_who")} AS reader, max(try_strptime({_trim_sql("access_time")}, '%Y-%m-%d %H:%M:%S')) AS m
  FROM a WHERE nf > 1 GROUP BY reader) l ON l.reader = q.person_id
WHERE l.m IS NULL OR l.m < TIMESTAMP '{_CUTOFF}'""",
        "reject_counts_text": _rejects_text_sql(),
        "nationality_hobby_files": _with(_FILES)
        + f"""
SELECT {_trim_sql("name")} AS name, {_trim_sql("hobby")} AS hobby
FROM p WHERE nf > 4 AND {_trim_sql("nationality")} = '{NATIONALITY}'""",
        "top_accessed_pages_files": _top_text_sql(_FILES),
        "connectedness_files": _with(_FILES)
        + f""",
names AS (
  SELECT {_trim_sql("person_id")} AS id, min(nullif({_trim_sql("name")}, '')) AS name FROM p WHERE nf > 1 GROUP BY 1 HAVING id <> ''),
n AS (SELECT {_trim_sql("my_friend")} AS friend, count(*) AS n FROM fs WHERE nf > 2 GROUP BY 1 HAVING friend <> '')
SELECT coalesce(id, friend) AS id, coalesce(name, id, friend) AS who,
       CAST(CASE WHEN name IS NULL THEN 0 ELSE coalesce(n.n, 0) END AS BIGINT) AS connectedness
FROM names FULL JOIN n ON id = friend""",
        "unvisited_friends_files": _with(_FILES)
        + """
SELECT u.person_id, coalesce(q.name, 'Unknown') AS name, u.n AS n_unvisited
FROM (
  SELECT e.person_id, count(*) AS n
  FROM (SELECT DISTINCT person_id, my_friend FROM fp WHERE nf > 2 AND person_id <> '') e
  WHERE NOT EXISTS (SELECT 1 FROM a WHERE nf > 2 AND a.by_who = e.person_id AND a.what_page = e.my_friend)
  GROUP BY e.person_id) u
LEFT JOIN (SELECT person_id, min(name) AS name FROM p WHERE nf > 1 GROUP BY person_id) q ON q.person_id = u.person_id""",
        "nationality_report_chunks": _chunks_sql(
            _P, f"SELECT nationality, name || ', ' || hobby AS member FROM p WHERE nationality = '{NATIONALITY}'"
        ),
        "nationality_report_chunks_repeated": _chunks_sql(
            _P_MANY.replace("AS nationality FROM", "AS nationality, o_orderpriority AS hobby FROM"),
            "SELECT nationality, name || ', ' || hobby AS member FROM p",
        ),
        "nationality_report_chunks_text": _chunks_sql(
            _TEXT,
            f"""SELECT {_trim_sql("nationality")} AS nationality, {_trim_sql("name")} || ', ' || {_trim_sql("hobby")} AS member
  FROM p WHERE nf > 4""",
        ),
        "top_accessed_pages_lines": f"""
SELECT row_number() OVER (ORDER BY accesses DESC, person_id, name, nationality) AS line_no,
       accesses || chr(9) || person_id || ',' || name || ',' || nationality AS line
FROM ({_top_sql(_P)})""",
        "connectedness_lines": f"""
SELECT row_number() OVER (ORDER BY CAST(id AS VARCHAR)) AS line_no, who || chr(9) || connectedness AS line
FROM ({_connectedness_sql(_P, "l_suppkey")})""",
        "top_accessed_pages_audited": f"""
WITH counts AS ({_rejects_text_sql()})
SELECT 'report' AS part, CAST(person_id AS VARCHAR) AS item, name, nationality, accesses AS value FROM ({_top_text_sql(_TEXT)})
UNION ALL
SELECT 'rejects', src || ' n_rows', '', '', n_rows FROM counts
UNION ALL
SELECT 'rejects', src || ' n_short', '', '', n_short FROM counts
UNION ALL
SELECT 'rejects', src || ' n_rejected', '', '', n_rejected FROM counts""",
        "connectedness_shared": _connectedness_sql(_P, "l_partkey"),
        "unvisited_friends_shared": _unvisited_sql(_P, "l_partkey"),
        "popular_users_shared": _popular_sql(_P),
    }


def oracle_sql() -> dict[str, str]:
    return {**report_sql(), **(llm_queries.oracle_sql() if llm_queries else {})}

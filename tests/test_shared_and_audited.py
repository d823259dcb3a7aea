"""The friends relation in bucketed layouts, and the top-pages report with its
reject counters from one reading."""

import re

import pytest

from socialpages import (
    connectedness_factor,
    drop_shared,
    popular_users,
    read_access,
    read_friends,
    read_pages,
    share_friends,
    shared_friends,
    top_accessed_pages,
    top_accessed_pages_audited,
    top_pages_rejects,
    unvisited_friends,
)
from test_brute_force import make_files


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(params=[11, 12])
def frames(request, spark, tmp_path):
    (pages, friends, access), _ = make_files(tmp_path, request.param)
    return read_pages(spark, pages), read_friends(spark, friends), read_access(spark, access)


def test_reports_are_the_same_on_shared_friends(spark, frames, tmp_path):
    pages, friends, access = frames
    name = f"shared_{tmp_path.name}".replace("-", "_")
    share_friends(friends, name, ["friend", "owner", "pair"], buckets=5)
    try:
        assert rows(connectedness_factor(pages, shared_friends(spark, name, "friend"))) == rows(connectedness_factor(pages, friends))
        assert rows(popular_users(pages, shared_friends(spark, name, "owner"))) == rows(popular_users(pages, friends))
        assert rows(unvisited_friends(pages, shared_friends(spark, name, "pair"), access)) == rows(unvisited_friends(pages, friends, access))
        with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
            share_friends(friends, name, ["owner"], buckets=5)
    finally:
        drop_shared(spark, name)
    assert not spark.catalog.tableExists(f"{name}_by_owner")


def test_edges_are_not_shuffled(spark, tmp_path):
    friends = spark.range(4000).selectExpr("id as friend_rel", "id % 300 as person_id", "id % 171 as my_friend")
    pages = spark.range(200).selectExpr("id as person_id", "concat('n', id) as name", "'x' as nationality", "1 as country_code", "'h' as hobby")
    access = spark.range(900).selectExpr("id as access_id", "id % 300 as by_who", "id % 50 as what_page", "'v' as type_of_access")
    name = f"plan_{tmp_path.name}".replace("-", "_")
    share_friends(friends, name, ["friend", "owner", "pair"], buckets=8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        reports = {
            "friend": connectedness_factor(pages, shared_friends(spark, name, "friend")),
            "owner": popular_users(pages, shared_friends(spark, name, "owner")),
            "pair": unvisited_friends(pages, shared_friends(spark, name, "pair"), access),
        }
        for layout, report in reports.items():
            text = report._jdf.queryExecution().executedPlan().toString()
            lines = text.splitlines()
            for at, line in enumerate(lines):
                if f"{name}_by_{layout}[" not in line:
                    continue
                assert "Bucketed: true" in line
                # up from the scan to the aggregate's second half: no exchange between
                above, depth = [], len(re.match(r"[ :|*+\-]*", line).group())
                for up in reversed(lines[:at]):
                    if len(re.match(r"[ :|*+\-]*", up).group()) < depth:
                        depth = len(re.match(r"[ :|*+\-]*", up).group())
                        above.append(up)
                    if "Join" in up:
                        break
                final = [x for x in above if "HashAggregate" in x]
                assert len(final) >= 2 and not any("Exchange" in x for x in above), layout
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        drop_shared(spark, name)


def test_audited_rows_and_counters(spark, frames):
    pages, _, access = frames
    report, counts = top_accessed_pages_audited(pages, access, 5)
    assert [tuple(r) for r in report.collect()] == [tuple(r) for r in top_accessed_pages(pages, access, 5).collect()]
    assert rows(counts) == rows(top_pages_rejects(pages, access))
    assert sum(r.n_rejected + r.n_short for r in counts.collect()) > 0


def test_audited_typed_and_empty_inputs(spark):
    pages = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (None, "c", "x")], "person_id long, name string, nationality string")
    access = spark.createDataFrame([(1, 1, 2), (2, 1, 2), (3, 1, None)], "access_id long, by_who long, what_page long")
    report, counts = top_accessed_pages_audited(pages, access)
    assert [tuple(r) for r in report.collect()] == [tuple(r) for r in top_accessed_pages(pages, access).collect()]
    assert rows(counts) == rows(top_pages_rejects(pages, access))
    report, counts = top_accessed_pages_audited(pages.limit(0), access.limit(0))
    assert report.count() == 0 and all(r.n_rows in (0, None) for r in counts.collect())

"""Physical-plan properties of the registered queries: JVM-only execution,
no pair-producing joins, pruned and filtered scans, partial aggregation."""

import os
import re

import pytest

import __spark_entry__ as E
from conftest import TESTDATA
from socialpages.plans import plan_text

SF = f"{TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

PYTHON_NODES = ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "FlatMapCoGroupsInPandas", "PythonUDF"]


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_text(fn(spark, SF), "formatted") for name, fn in E.reports().items()}


def test_no_python_and_no_pairwise_joins(plans):
    for name, text in plans.items():
        for node in PYTHON_NODES + ["CartesianProduct", "BroadcastNestedLoopJoin"]:
            assert node not in text, (name, node)


def test_scans_read_only_needed_columns(plans):
    assert "ReadSchema: struct<props:string>" in plans["top_accessed_pages"]
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plans["disconnected_users"]
    assert "l_suppkey" not in plans["connectedness_part"]


def test_nationality_filter_reaches_the_scan(plans):
    text = plans["nationality_hobby_rows"]
    assert "StringContains(n_name,NATION_7)" in text
    assert "Exchange" not in text.split("===== Subqueries")[0].replace("BroadcastExchange", "")


def test_aggregates_are_partial_before_shuffle(plans):
    for name in ["top_accessed_pages", "country_page_count", "connectedness_part", "access_diversity",
                 "unvisited_friends_part", "disconnected_users", "popular_users", "reject_counts"]:
        assert "partial_" in plans[name], name


def test_top_k_is_take_ordered(plans):
    assert "TakeOrderedAndProject" in plans["top_accessed_pages"]


def test_popular_users_reads_its_inputs_once(spark):
    """The average reuses both shuffles, so scans and input joins run once."""
    df = E.reports()["popular_users"](spark, SF)
    df.collect()
    final = re.sub(r"== Initial Plan ==.*?(?=\n {0,6}\+- SortMergeJoin|\Z)", "", df._jdf.queryExecution().executedPlan().toString())
    assert "ReusedExchange" in final
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(E.reports()["popular_users"](spark, SF), "simple")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("ReusedExchange") == 2 and text.count("FullOuter") == 2
    for table in ("lineitem", "orders", "customer", "nation"):
        assert text.count(f"{table}.parquet") == 1, table
    # friend rows are counted by hash, only names need a sorted aggregate
    assert re.search(r"HashAggregate\(keys=\[owner#\d+L?\], functions=\[partial_count", text)


def _exchange_inputs(text):
    """The ``Input`` column lists of every shuffle Exchange in a formatted plan."""
    inputs, current = [], None
    for line in text.splitlines():
        if line.startswith("(") and ") Exchange" in line:
            current = line
        elif current and line.startswith("Input"):
            inputs.append(line)
            current = None
    return inputs


def test_top_pages_shuffles_page_rows_only_beyond_the_broadcast_threshold(spark):
    from pyspark.sql import functions as F

    from socialpages import top_accessed_pages

    n = 3000
    # one page id on a third of all page rows
    pages = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("person_id"),
        F.concat(F.lit("name"), F.col("id").cast("string")).alias("name"),
        F.lit("N").alias("nationality"),
    )
    access = spark.range(3 * n).select((F.col("id") % n).alias("what_page"))
    shuffled = _exchange_inputs(plan_text(top_accessed_pages(pages, access, 5)))
    assert shuffled and not any("name" in cols for cols in shuffled)
    for threshold in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            got = [tuple(r) for r in top_accessed_pages(pages, access, 5).collect()]
            assert got == [(3, 1, "name1", "N"), (3, 2, "name2", "N"), (3, 4, "name4", "N"),
                           (3, 5, "name5", "N"), (3, 7, "name0", "N")]
            hot = top_accessed_pages(pages, access.union(spark.range(50).select(F.lit(7).alias("what_page"))), 3)
            assert [tuple(r) for r in hot.collect()] == [(53, 7, "name0", "N"), (53, 7, "name1002", "N"),
                                                          (53, 7, "name1005", "N")]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def large_input_plans(spark):
    """Plans as Spark picks them when every input except tiny `nation` is large
    (at sf0.001 `nation` is 2.5 KB and every other table is larger)."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3000")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        yield lambda name: plan_text(E.reports()[name](spark, SF), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def _shuffle_keys(text):
    import re
    return [re.sub(r"#\d+L?", "", m) for m in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", text)]


def test_diversity_spreads_a_heavy_reader_over_pages_first(large_input_plans):
    keys = _shuffle_keys(large_input_plans("access_diversity"))
    # plan text is top-down: the per-reader shuffle sits above (runs after) the per-pair one
    assert keys.index("by_who") < keys.index("by_who, page")


def test_unvisited_distinct_pairs_then_anti_join_without_reshuffle(large_input_plans):
    text = large_input_plans("unvisited_friends_part")
    keys = _shuffle_keys(text)
    assert keys.count("owner, friend") == 2          # distinct edges, distinct visits
    assert "SortMergeJoin [owner, friend], [owner, friend], LeftAnti" in __import__("re").sub(r"#\d+L?", "", text)
    # lineitem and orders for the friends join, the two distinct sets, the count per owner, the names
    assert len(keys) == 6


def test_connectedness_joins_two_aggregates(large_input_plans):
    import re
    text = re.sub(r"#\d+L?", "", large_input_plans("connectedness_part"))
    assert "SortMergeJoin [id], [friend], FullOuter" in text
    assert sorted(_shuffle_keys(text)) == ["friend", "id", "l_orderkey", "o_orderkey"]

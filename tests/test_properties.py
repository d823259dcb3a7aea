"""Properties over the benchmark tables and over random CSV files."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from socialpages import (
    access_diversity,
    connectedness_factor,
    country_page_count,
    disconnected_users,
    nationality_hobby_report,
    nationality_hobby_rows,
    popular_users,
    read_access,
    read_friends,
    read_pages,
    reject_counts,
    third_field_count,
    top_accessed_pages,
    unvisited_friends,
    write_tsv,
)
from socialpages.sources import driver_tables as dv
from test_brute_force import AS_OF, make_files

SF = f"{TESTDATA}/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def tables(spark):
    return dv.pages(spark, SF), dv.friends(spark, SF, "part"), dv.access(spark, SF)


@needs_tables
def test_connectedness_sums_to_edges_into_known_pages(tables):
    P, Fr, _ = tables
    total = connectedness_factor(P, Fr).agg(F.sum("connectedness")).first()[0]
    known = Fr.join(P, Fr.my_friend == P.person_id, "left_semi").count()
    assert total == known


@needs_tables
def test_diversity_totals_sum_to_accesses_by_known_people(tables):
    P, _, A = tables
    total = access_diversity(P, A).agg(F.sum("total_accesses")).first()[0]
    assert total == A.join(P, A.by_who == P.person_id, "left_semi").count()


@needs_tables
def test_unvisited_at_most_distinct_out_degree(tables):
    P, Fr, A = tables
    deg = Fr.select("person_id", "my_friend").distinct().groupBy("person_id").agg(F.count("*").alias("deg"))
    u = unvisited_friends(P, Fr, A)
    assert u.join(deg, "person_id").where(F.col("n_unvisited") > F.col("deg")).count() == 0
    assert u.join(deg, "person_id", "left_anti").count() == 0


REPORTS = {
    "rows": (lambda P, Fr, A: nationality_hobby_rows(P, "Latvia"), ["name", "hobby"]),
    "report": (lambda P, Fr, A: nationality_hobby_report(P, "Latvia"), ["nationality", "member"]),
    "top": (lambda P, Fr, A: top_accessed_pages(P, A, 5), ["accesses", "person_id", "name", "nationality"]),
    "countries": (lambda P, Fr, A: country_page_count(P), ["nationality", "n_pages"]),
    "third": (lambda P, Fr, A: third_field_count(P, A), ["k", "n"]),
    "connectedness": (lambda P, Fr, A: connectedness_factor(P, Fr), ["id", "who", "connectedness"]),
    "diversity": (lambda P, Fr, A: access_diversity(P, A), ["person_id", "name", "total_accesses", "distinct_pages"]),
    "unvisited": (lambda P, Fr, A: unvisited_friends(P, Fr, A), ["person_id", "name", "n_unvisited"]),
    "disconnected": (lambda P, Fr, A: disconnected_users(P, A, as_of=AS_OF), ["person_id", "name"]),
    "popular": (lambda P, Fr, A: popular_users(P, Fr), ["id", "name", "n"]),
}


@pytest.fixture(scope="module")
def random_csv(spark, tmp_path_factory):
    (pp, fp, ap), _ = make_files(tmp_path_factory.mktemp("prop"), 11)
    return read_pages(spark, pp), read_friends(spark, fp), read_access(spark, ap)


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_same_rows_for_one_and_eight_partitions(random_csv, name):
    fn, cols = REPORTS[name]
    P, Fr, A = random_csv
    one = fn(P.coalesce(1), Fr.coalesce(1), A.coalesce(1))
    eight = fn(P.repartition(8), Fr.repartition(8), A.repartition(8))
    key = lambda r: tuple(str(r[c]) for c in cols)
    assert sorted(one.collect(), key=key) == sorted(eight.collect(), key=key)


def test_present_rule_counts_blank_and_missing_ids(spark, random_csv):
    _, Fr, _ = random_csv
    expected = Fr.where((F.col("my_friend") == "") ).count()
    assert tuple(reject_counts(Fr, "my_friend", rule="present").first()) == (Fr.count(), 0, expected)
    with pytest.raises(ValueError):
        reject_counts(Fr, "my_friend", rule="bogus")


def test_tsv_sorted_by_key_in_byte_order(spark, tmp_path):
    df = spark.createDataFrame([(k,) for k in ["2", "10", "1", "b", "B"]], "k string").repartition(3)
    out = str(tmp_path / "s")
    write_tsv(df, out, sort_by=["k"])
    import glob
    lines = []
    for part in sorted(glob.glob(f"{out}/part-*")):
        lines.extend(open(part).read().split())
    assert lines == ["1", "10", "2", "B", "b"]

"""Hand-worked answers on the small sample files of conftest.py."""

import datetime as dt

import pytest

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
    third_field_count,
    top_accessed_pages,
    top_pages_rejects,
    unvisited_friends,
)


@pytest.fixture(scope="module")
def rel(spark, sample):
    return read_pages(spark, sample["pages"]), read_friends(spark, sample["friends"]), read_access(spark, sample["access"])


def test_loads_all_rows_without_headers(rel):
    P, Fr, A = rel
    assert (P.count(), Fr.count(), A.count()) == (6, 8, 8)
    assert P.where("person_id = 'PersonID'").count() == 0


def test_a_latvia(rel):
    rows = nationality_hobby_rows(rel[0], "Latvia").collect()
    assert sorted((r.name, r.hobby) for r in rows) == [("Ann Lee", "Chess"), ("Cy Dow", "Crocheting")]
    report = nationality_hobby_report(rel[0], "Latvia").collect()
    assert sorted((r.nationality, r.member) for r in report) == [("Latvia", "Ann Lee, Chess"), ("Latvia", "Cy Dow, Crocheting")]


def test_b_top(rel):
    P, _, A = rel
    assert [(r.accesses, r.person_id) for r in top_accessed_pages(P, A).collect()] == [(4, 0), (2, 1), (1, 2), (1, 5)]
    assert [r.person_id for r in top_accessed_pages(P, A, 3).collect()] == [0, 1, 2]


def test_c_countries(rel):
    P, _, A = rel
    assert {r.nationality: r.n_pages for r in country_page_count(P).collect()} == {"Latvia": 2, "Peru": 2, "Chad": 1, "Mali": 1}
    both = {r.k: r.n for r in third_field_count(P, A).collect()}
    assert both == {"Latvia": 2, "Peru": 2, "Chad": 1, "Mali": 1, "0": 4, "1": 2, "2": 1, "5": 1}


def test_d_connectedness(rel):
    P, Fr, _ = rel
    got = {r.id: (r.who, r.connectedness) for r in connectedness_factor(P, Fr).collect()}
    assert got == {"0": ("Ann Lee", 3), "1": ("Bob Ray", 2), "2": ("Cy Dow", 1), "3": ("Di Fox", 1), "4": ("Ed Poe", 0),
                   "5": ("Flo May", 0), "9": ("9", 0)}


def test_e_diversity(rel):
    P, _, A = rel
    got = {r.person_id: (r.total_accesses, r.distinct_pages) for r in access_diversity(P, A).collect()}
    assert got == {"0": (2, 1), "1": (1, 1), "2": (1, 1), "3": (2, 2), "4": (1, 1)}


def test_f_unvisited(rel):
    P, Fr, A = rel
    assert {r.person_id: r.n_unvisited for r in unvisited_friends(P, Fr, A).collect()} == {"0": 1, "2": 2, "4": 1}


def test_g_disconnected(rel):
    P, _, A = rel
    got = disconnected_users(P, A, as_of=dt.datetime(2024, 2, 13, 12)).collect()
    assert sorted(r.person_id for r in got) == ["0", "1", "4", "5"]
    later = disconnected_users(P, A, as_of=dt.datetime(2024, 2, 13, 12, 0, 1)).collect()
    assert sorted(r.person_id for r in later) == ["0", "1", "3", "4", "5"]


def test_h_popular(rel):
    P, Fr, _ = rel
    assert {r.id: (r.name, r.n) for r in popular_users(P, Fr).collect()} == {"0": ("Ann Lee", 3), "2": ("Cy Dow", 2)}


def test_no_rejects(rel):
    P, _, A = rel
    got = {r.src: (r.n_rows, r.n_short, r.n_rejected) for r in top_pages_rejects(P, A).collect()}
    assert got == {"access": (8, 0, 0), "pages": (6, 0, 0), "total": (14, 0, 0)}

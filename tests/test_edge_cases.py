"""Hand-written cases from FIXTURES.md: ties, duplicates, dangling ids,
strict comparisons, empty tables, header words inside data."""

import datetime as dt

from conftest import ACCESS_HEADER, FRIENDS_HEADER, PAGES_HEADER, write_csv
from socialpages import (
    connectedness_factor,
    country_page_count,
    disconnected_users,
    nationality_hobby_rows,
    observe_rejects,
    popular_users,
    read_access,
    read_friends,
    read_pages,
    reject_counts,
    access_diversity,
    nationality_hobby_report,
    top_accessed_pages,
    top_pages_rejects,
    unvisited_friends,
    write_report_text,
)


def _load(spark, tmp_path, pages=(), friends=(), access=()):
    return (
        read_pages(spark, write_csv(tmp_path, "p.csv", PAGES_HEADER, list(pages))),
        read_friends(spark, write_csv(tmp_path, "f.csv", FRIENDS_HEADER, list(friends))),
        read_access(spark, write_csv(tmp_path, "a.csv", ACCESS_HEADER, list(access))),
    )


def test_header_words_inside_data_survive(spark, tmp_path):
    P, _, _ = _load(spark, tmp_path, pages=["1,Name,Latvia,1,Name tags", "2,Bob,Latvia,1,PersonID"])
    got = sorted(tuple(r) for r in nationality_hobby_rows(P, "Latvia").collect())
    assert got == [("Bob", "PersonID"), ("Name", "Name tags")]


def test_trimmed_nationality_and_empty_hobby(spark, tmp_path):
    P, _, _ = _load(spark, tmp_path, pages=["1,Ann , \tLatvia ,1,Chess", "2,Bob,Latvia,1,", "3,Cy,Latvia,1, "])
    got = sorted(tuple(r) for r in nationality_hobby_rows(P, "Latvia").collect())
    # row 2 has only four Java fields and is skipped; row 3's hobby is a space
    assert got == [("Ann", "Chess"), ("Cy", "")]


def test_top_k_tie_at_rank_k_cut_by_id(spark, tmp_path):
    pages = [f"{i},P{i},N,1,h" for i in range(12)]
    access = [f"{n},0,{i},View,2024-01-01 00:00:00" for n, i in enumerate(list(range(12)) + [11, 11])]
    P, _, A = _load(spark, tmp_path, pages=pages, access=access)
    got = [(r.accesses, r.person_id) for r in top_accessed_pages(P, A, 3).collect()]
    assert got == [(3, 11), (1, 0), (1, 1)]


def test_top_pages_keeps_duplicate_page_rows_and_int_ids(spark, tmp_path):
    P, _, A = _load(spark, tmp_path, pages=["4,Ann,N,1,h", "04,Ann2,N,1,h", "x,Bad,N,1,h"],
                    access=["0,1,+4,View,t", "1,1, 4,View,t", "2,1,abc,View,t"])
    got = sorted(tuple(r) for r in top_accessed_pages(P, A).collect())
    assert got == [(1, 4, "Ann", "N"), (1, 4, "Ann2", "N")]
    assert tuple(reject_counts(A, "what_page").first()) == (3, 0, 2)
    observed, obs = observe_rejects(P, "person_id")
    observed.count()
    assert obs.get == {"n_rows": 3, "n_short": 0, "n_rejected": 1}


def test_connectedness_dangling_and_empty_name(spark, tmp_path):
    P, Fr, _ = _load(spark, tmp_path, pages=["1,Ann,N,1,h", "2,,N,1,h"],
                     friends=["0,1,2,d,x", "1,1,2,d,x", "2,2,9,d,x", "3,2,1,d,x", "4,2, 1 ,d,x"])
    got = sorted(tuple(r) for r in connectedness_factor(P, Fr).collect())
    assert got == [("1", "Ann", 2), ("2", "2", 0), ("9", "9", 0)]


def test_unvisited_self_edge_duplicates_and_unknown_owner(spark, tmp_path):
    P, Fr, A = _load(spark, tmp_path, pages=["1,Ann,N,1,h"],
                     friends=["0,1,1,d,x", "1,1,2,d,x", "2,1,2,d,x", "3,7,1,d,x", "4,1,,d,x"],
                     access=["0,1,2,View,t"])
    got = sorted(tuple(r) for r in unvisited_friends(P, Fr, A).collect())
    # owner 1: friends {1, 2, ""} minus visited {2}; owner 7 has no page
    assert got == [("1", "Ann", 2), ("7", "Unknown", 1)]


def test_disconnected_strict_cutoff(spark, tmp_path):
    P, _, A = _load(spark, tmp_path, pages=[f"{i},P{i},N,1,h" for i in range(4)],
                    access=["0,0,1,View,2024-01-30 12:00:00", "1,1,1,View,2024-01-30 11:59:59.999",
                            "2,1,1,View,2024-01-30 11:59:59", "3,3,1,View,not a time"])
    got = sorted(r.person_id for r in disconnected_users(P, A, as_of=dt.datetime(2024, 2, 13, 12)).collect())
    assert got == ["1", "2", "3"]


def test_popular_strictly_above_average_and_empty_tables(spark, tmp_path):
    P, Fr, _ = _load(spark, tmp_path, pages=["1,Ann,N,1,h", "2,Bob,N,1,h"],
                     friends=["0,1,5,d,x", "1,1,6,d,x", "2,3,5,d,x"])
    # average = 3 rows / 3 ids = 1.0: owner 1 (2) is above, owner 3 (1) is not
    assert sorted(tuple(r) for r in popular_users(P, Fr).collect()) == [("1", "Ann", 2)]
    E, EF, _ = _load(spark, tmp_path / "..", pages=[], friends=[])
    assert popular_users(E, EF).count() == 0
    assert country_page_count(E).count() == 0


def test_short_rows_are_not_rejects(spark, tmp_path):
    P, _, A = _load(spark, tmp_path, pages=["1,Ann,N,1,h", "x,Bad,N", "y,Short"],
                    access=["0,1,5,View,t", "1,1", "2,1,,,", "3,1,x,View,t", "4,1,99999999999,View,t"])
    got = {r.src: (r.n_rows, r.n_short, r.n_rejected) for r in top_pages_rejects(P, A).collect()}
    assert got == {"access": (5, 2, 2), "pages": (3, 1, 1), "total": (8, 3, 3)}


TYPED_PAGES = "person_id long, name string, nationality string, country_code int, hobby string"


def test_typed_rows_with_missing_values(spark, tmp_path):
    P = spark.createDataFrame([(1, None, "Latvia", 1, "Go"), (2, "Bob", "Latvia", None, "Chess"), (3, "Cy", "Latvia", 4, None),
                               (4, None, None, None, None), (5, "Di", "Peru", None, ""), (6, "Ed", "Peru", None, None)], TYPED_PAGES)
    assert sorted(tuple(r) for r in nationality_hobby_rows(P, "Latvia").collect()) == [("", "Go"), ("Bob", "Chess")]
    write_report_text(nationality_hobby_report(P, "Latvia"), str(tmp_path / "a"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "a").glob("part-*")))
    assert text == "Latvia\t, Go\nBob, Chess\n\n"
    # rows 4 to 6 have nothing behind their third field
    assert {r.nationality: r.n_pages for r in country_page_count(P).collect()} == {"Latvia": 3}
    Fr = spark.createDataFrame([(1, 1, 2, None, None), (2, 1, None, None, "x"), (3, 2, None, None, None)],
                               "friend_rel long, person_id long, my_friend long, date_of_friendship date, desc string")
    # page 4 is no page; owner 1 has two friend rows, owner 2 a short one
    assert [tuple(r) for r in popular_users(P, Fr).collect()] == [(1, None, 2)]
    assert {r.id: r.connectedness for r in connectedness_factor(P, Fr).collect()} == {1: 0, 2: 1, 3: 0, 5: 0, 6: 0}
    A = spark.createDataFrame([(1, 2, None, None, None), (2, 2, None, "View", None), (3, 2, 3, None, None)],
                              "access_id long, by_who long, what_page long, type_of_access string, access_time timestamp")
    assert [tuple(r) for r in access_diversity(P, A).collect()] == [(2, "Bob", 2, 1)]


def test_a_frame_without_the_later_columns_is_complete(spark):
    P = spark.createDataFrame([(None,), ("N",)], "nationality string")
    assert country_page_count(P).count() == 2


def test_typed_ids_meet_text_ids(spark):
    P = spark.createDataFrame([(1, "Ann", "N", 1, "h"), (7, "Bo", "N", 1, "h")], TYPED_PAGES)
    Fr = spark.createDataFrame([("0", "1", "x7", "d", "x"), ("1", "1", "7", "d", "x"), ("2", "q", "7", "d", "x")],
                               "friend_rel string, person_id string, my_friend string, date_of_friendship string, desc string")
    A = spark.createDataFrame([(1, 1, 7, "v", None)], "access_id long, by_who long, what_page long, type_of_access string, access_time timestamp")
    assert {r.id: r.connectedness for r in connectedness_factor(P, Fr).collect()} == {"1": 0, "7": 2, "x7": 0}
    assert {r.person_id: (r.name, r.n_unvisited) for r in unvisited_friends(P, Fr, A).collect()} == {"1": ("Ann", 1), "q": ("Unknown", 1)}
    assert {r.id: (r.name, r.n) for r in popular_users(P, Fr).collect()} == {"1": ("Ann", 2)}
    text_log = A.selectExpr("access_id", "'1' as by_who", "what_page", "type_of_access", "timestamp'2024-01-01' as access_time")
    assert {r.person_id for r in disconnected_users(P, text_log, as_of=dt.datetime(2024, 1, 2)).collect()} == {"7"}
    assert [r.person_id for r in access_diversity(P, text_log).collect()] == ["1"]


def test_large_k_with_one_page_id_on_a_third_of_the_rows(spark):
    pages = spark.range(6000).selectExpr("if(id % 3 = 0, 7, id) as person_id", "cast(id as string) as name", "'N' as nationality")
    access = spark.range(9000).selectExpr("id % 3000 as what_page")
    sizes = {}
    for k in (10, 100_000, 1_000_000):
        rows = top_accessed_pages(pages, access, k).collect()
        sizes[k] = len(rows)
        assert [tuple(r) for r in rows[:3]] == [(3, 1, "1", "N"), (3, 2, "2", "N"), (3, 4, "4", "N")]
    # ids 1 to 2999 without the multiples of 3, and 2000 rows of id 7 besides its own
    assert sizes == {10: 10, 100_000: 2000 + 2000, 1_000_000: 4000}


def test_zoned_as_of(spark):
    P = spark.createDataFrame([(1, "Ann", "N", 1, "h"), (2, "Bo", "N", 1, "h")], TYPED_PAGES)
    zoned = dt.datetime(2024, 2, 13, 15, tzinfo=dt.timezone(dt.timedelta(hours=5)))  # 10:00 UTC
    for zone, shift in (("UTC", 0), ("America/New_York", -5)):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            for kind in ("timestamp_ntz", "timestamp"):
                # one minute before and at the cutoff, on the session's clock
                A = spark.sql(f"""select 1 as by_who, cast('2024-01-30 {10 + shift:02}:00:00' as {kind}) as access_time
                                  union all select 2, cast('2024-01-30 {9 + shift:02}:59:00' as {kind})""")
                for as_of in (zoned, "2024-02-13 15:00:00+05:00", "2024-02-13T10:00:00Z"):
                    got = disconnected_users(P, A, as_of=as_of).collect()
                    assert [r.person_id for r in got] == [2], (zone, kind, as_of)
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")

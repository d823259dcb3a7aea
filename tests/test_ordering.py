"""Row numbers and running totals over a global order, ordered text files, and
the report's text in chunks."""

import glob
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import PAGES_HEADER, write_csv
from socialpages import (
    nationality_report_chunks,
    read_numbered_lines,
    read_pages,
    relation_lines,
    write_report_text,
    write_tsv,
    write_with_header,
    nationality_hobby_report,
)
from socialpages.plans import numbered, plan_text, with_offsets
from socialpages.plans.ordering import placed


def test_numbers_follow_the_order(spark):
    df = spark.range(0, 4000, 1, 7).select((F.col("id") * 7919 % 4000).alias("k"), F.lit("x").alias("_range"), F.lit(1).alias("_before"))
    got = numbered(df, [F.desc("k")], "no").collect()
    assert sorted((r.no, r.k) for r in got) == [(i + 1, 3999 - i) for i in range(4000)]
    assert {(r["_range"], r["_before"]) for r in got} == {("x", 1)}
    with pytest.raises(ValueError):
        numbered(df, ["k"], "K")


def test_offsets_in_groups_with_a_hot_and_a_null_group(spark):
    df = spark.range(0, 3000, 1, 5).selectExpr(
        "id", "if(id % 3 = 0, 'hot', if(id % 10 = 1, null, cast(id % 7 as string))) as g", "id % 5 as n"
    )
    totals, want = defaultdict(int), {}
    for r in sorted(df.collect(), key=lambda r: r.id):
        want[r.id] = totals[r.g]
        totals[r.g] += r.n
    got = with_offsets(df, ["g", "id"], F.col("n"), ["g"]).collect()
    assert {r.id: r.offset for r in got} == want
    whole = with_offsets(df, ["id"], F.lit(1)).collect()
    assert all(r.offset == r.id for r in whole)


def test_a_hot_group_is_spread_over_ranges(spark):
    df = spark.range(0, 40_000, 1, 4).select(F.lit("hot").alias("g"), (F.col("id") * 7919 % 40_000).alias("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows, part, _ = placed(df, ["g", "id"])
        sizes = [r["count"] for r in rows.groupBy(part).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 40_000 and max(sizes) < 10_000


def test_empty_frames(spark):
    empty = spark.range(0).select("id", F.lit("g").alias("g"))
    assert numbered(empty, ["id"]).count() == 0
    assert with_offsets(empty, ["id"], F.lit(1), ["g"]).count() == 0


def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


def large_splits(spark):
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


AWKWARD = ["\x00nul", "a￾b", "￿c", '"q', "#c", "  lead", "x\x0by\x85z", "\\,", "é", "PersonID", "Name tags", "\x1f"]


def test_numbered_lines_over_many_splits(spark, tmp_path):
    lines = [f"{i:05d}{AWKWARD[i % 12]}" * (i % 4) for i in range(1500)]  # every fourth line is blank
    out = str(tmp_path / "t")
    spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string").repartitionByRange(
        6, "i"
    ).sortWithinPartitions("i").select("value").write.text(out)
    small_splits(spark)
    try:
        got = read_numbered_lines(spark, out)
        assert sorted(map(tuple, got.collect())) == [(i + 1, x) for i, x in enumerate(lines)]
    finally:
        large_splits(spark)
    assert len(glob.glob(out + "/part-*")) == 6


def test_part_files_are_ordered_by_number_and_others_by_path(spark, tmp_path):
    for name, text in [("part-100000-x", "c"), ("part-99999-x", "b"), ("part-00002-x", "a")]:
        (tmp_path / name).write_text(text + "\n")
    assert [r.line for r in read_numbered_lines(spark, str(tmp_path)).orderBy("line_no").collect()] == ["a", "b", "c"]
    other = tmp_path / "o"
    other.mkdir()
    (other / "2.txt").write_text("y\r\nz")
    (other / "1.txt").write_text("x\n")
    (other / "3.txt").write_text("")
    got = read_numbered_lines(spark, [str(other / "2.txt"), str(other / "1.txt"), str(other / "3.txt")])
    assert sorted(map(tuple, got.collect())) == [(1, "x"), (2, "y"), (3, "z")]


def test_sorted_output_read_back(spark, tmp_path):
    df = spark.range(0, 700, 1, 5).select(F.col("id").cast("string").alias("id"), (F.col("id") % 3).alias("n"))
    out = str(tmp_path / "s")
    write_tsv(df, out, sort_by=["id"])
    got = read_numbered_lines(spark, out).orderBy("line_no").collect()
    assert [r.line for r in got] == [f"{i}\t{int(i) % 3}" for i in sorted(map(str, range(700)))]


# --- files ---------------------------------------------------------------------------------


def test_any_character_survives_the_loader_over_many_splits(spark, tmp_path):
    rows = [(str(i), AWKWARD[i % len(AWKWARD)], "Latvia", "1", AWKWARD[i % 7]) for i in range(900)]
    rows = [r for r in rows if "," not in r[1] and "," not in r[4]]
    lines = [",".join(r) for r in rows]
    paths = [write_csv(tmp_path, f"p{k}.csv", PAGES_HEADER, lines[k::3], newline=["\r\n", "\n", "\n"][k]) for k in range(3)]
    small_splits(spark)
    try:
        pages = read_pages(spark, paths)
        assert pages.rdd.getNumPartitions() > 20
        got = [(r.person_id, r.name, r.nationality, r.country_code, r.hobby) for r in pages.collect()]
    finally:
        large_splits(spark)
    assert sorted(got) == sorted(rows)


def test_a_line_that_starts_with_a_non_character(spark, tmp_path):
    path = write_csv(tmp_path, "p.csv", PAGES_HEADER, ["1,a￾b,Latvia,1,Chess", "￿2,x,Peru,2,Golf", "﻿3,y,Peru,2,\x00"])
    got = sorted(tuple(r) for r in read_pages(spark, path).collect())
    assert got == sorted([
        ("1", "a￾b", "Latvia", "1", "Chess", 5), ("￿2", "x", "Peru", "2", "Golf", 5), ("﻿3", "y", "Peru", "2", "\x00", 5),
    ])


def test_files_with_a_header_each_round_trip(spark, tmp_path):
    rows = [(i, f"n{i}￾￿\"", "Latvia", 1, None if i % 4 else "Name") for i in range(500)] + [(500, "Name", None, None, "PersonID")]
    df = spark.createDataFrame(rows, "person_id int, name string, nationality string, country_code int, hobby string")
    out = str(tmp_path / "f")
    write_with_header(relation_lines(df, df.columns), out, PAGES_HEADER, files=4)
    parts = sorted(glob.glob(out + "/part-*"))
    assert len(parts) == 4
    for part in parts:
        with open(part, newline="") as fh:
            text = fh.read().split("\n")
        assert text[0] == PAGES_HEADER and text.count(PAGES_HEADER) == 1
    got = read_pages(spark, parts).select("person_id", "name", "nationality", "hobby").collect()
    assert sorted(map(tuple, got)) == sorted((str(a), b or "", c or "", e or "") for a, b, c, _, e in rows)
    with pytest.raises(Exception):
        write_with_header(relation_lines(df, df.columns), out, PAGES_HEADER)
    none = str(tmp_path / "none")
    write_with_header(relation_lines(df.limit(0), df.columns), none, PAGES_HEADER, files=2)
    assert read_pages(spark, none).count() == 0


# --- the nationality report's text -----------------------------------------------------------


def people(seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(400):
        nationality = rnd.choice(["Latvia", " Latvia\t", "Peru", "", None, "Chad"]) if i % 3 else "Hot"
        rows.append((str(i), rnd.choice(["Ann", "Zoë ", "", None, "日本", "a\x01b", "a"]), nationality, "1", rnd.choice(["Chess", " Go", "x" * 37, None])))
    return rows


def model_text(rows, nationality):
    trim = lambda x: (x or "").strip("".join(map(chr, range(33))))
    members = [f"{trim(n)}, {trim(h)}" for _, n, c, k, h in rows if c is not None and trim(c) == nationality and h]
    return "".join(m + "\n" for m in sorted(members, key=lambda m: m.encode()))


@pytest.mark.parametrize("chunk", [1, 7, 64, 100_000])
def test_chunks_are_the_text(spark, chunk):
    rows = people(chunk)
    pages = spark.createDataFrame(rows, "person_id string, name string, nationality string, country_code string, hobby string").repartition(5)
    found = defaultdict(list)
    for r in nationality_report_chunks(pages, chunk=chunk).collect():
        assert r.offset == r.chunk_no * chunk
        found[r.nationality].append((r.chunk_no, r.text))
    assert set(found) == {"Latvia", "Peru", "", "Chad", "Hot"}
    for nationality, parts in found.items():
        parts.sort()
        assert [k for k, _ in parts] == list(range(len(parts)))
        assert all(len(t) == chunk for _, t in parts[:-1]) and 1 <= len(parts[-1][1]) <= chunk
        assert "".join(t for _, t in parts) == model_text(rows, nationality)


def test_chunks_of_one_nationality_equal_the_text_sink(spark, tmp_path):
    rows = people(3)
    pages = spark.createDataFrame(rows, "person_id string, name string, nationality string, country_code string, hobby string")
    chunks = nationality_report_chunks(pages, "Latvia", 50).orderBy("chunk_no").collect()
    text = "".join(r.text for r in chunks)
    assert {r.nationality for r in chunks} == {"Latvia"} and text == model_text(rows, "Latvia")
    out = str(tmp_path / "a")
    write_report_text(nationality_hobby_report(pages, "Latvia"), out)
    lines = [r.line for r in read_numbered_lines(spark, out).orderBy("line_no").collect()]
    assert "\n".join(lines) == "Latvia\t" + text
    assert nationality_report_chunks(pages, "Nowhere").count() == 0
    assert nationality_report_chunks(pages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        nationality_report_chunks(pages, "Latvia", 0)


def test_no_window_without_a_range_of_its_rows(spark):
    pages = spark.createDataFrame(people(1), "person_id string, name string, nationality string, country_code string, hobby string")
    text = plan_text(nationality_report_chunks(pages, chunk=64), "simple")
    assert "SinglePartition" not in text and "CartesianProduct" not in text and "Python" not in text


def test_leftovers_can_be_removed(spark):
    import os

    from socialpages.plans import discard_leftovers, staged

    frame, path = staged(spark.range(5))
    assert os.path.isdir(path.removeprefix("file:")) and frame.count() == 5
    assert discard_leftovers(spark) >= 1
    assert not os.path.exists(path.removeprefix("file:")) and discard_leftovers(spark) == 0

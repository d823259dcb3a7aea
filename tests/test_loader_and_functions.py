"""CSV loading rules and the scalar helpers."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import ACCESS_HEADER, FRIENDS_HEADER, PAGES_HEADER, write_csv
from socialpages import read_access, read_friends, read_pages
from socialpages.functions import before_cutoff, java_trim, strict_int


def test_split_rules(spark, tmp_path):
    path = write_csv(tmp_path, "p.csv", PAGES_HEADER, [
        "1,Ann,Latvia,1,",           # trailing empty field: Java length 4
        "2,Bob",                     # short row
        "",                          # blank line: dropped
        '3,"x,y",Peru,2,Golf',       # no quoting: the quote splits
        "4,,Chad,3,Chess,extra",     # middle empty field, six fields
        ",,,,,",                     # only commas
    ])
    rows = read_pages(spark, path).orderBy("person_id").collect()
    got = [(r.person_id, r.name, r.nationality, r.hobby, r._n_fields) for r in rows]
    assert got == [
        ("", "", "", "", 0),
        ("1", "Ann", "Latvia", "", 4),
        ("2", "Bob", "", "", 2),
        ("3", '"x', 'y"', "2", 6),
        ("4", "", "Chad", "Chess", 6),
    ]


def test_header_dropped_per_file_and_lf_files(spark, tmp_path):
    a = write_csv(tmp_path, "a.csv", ACCESS_HEADER, ["0,1,2,View,2024-01-01 00:00:00"])
    b = write_csv(tmp_path, "b.csv", ACCESS_HEADER, ["1,3,4,View,2024-01-02 00:00:00"], newline="\n")
    df = read_access(spark, [a, b])
    assert sorted(r.access_id for r in df.collect()) == ["0", "1"]


def test_no_trim_on_load(spark, tmp_path):
    path = write_csv(tmp_path, "f.csv", FRIENDS_HEADER, [" 0,\t4 ,10,2018-08-07,Aunt"])
    r = read_friends(spark, path).first()
    assert (r.friend_rel, r.person_id) == (" 0", "\t4 ")


def test_java_trim_and_strict_int(spark):
    df = spark.createDataFrame([(" 4",), ("+4",), ("04",), ("abc",), ("99999999999",), ("-7",), ("4.0",)], "s string")
    out = df.select(java_trim(F.lit("\t a \x00")).alias("t"), strict_int(df, "s").alias("i")).collect()
    assert out[0].t == "a"
    assert [r.i for r in out] == [None, 4, 4, None, None, -7, None]
    assert [r.i for r in df.select(strict_int(df, "s", trim=True).alias("i")).collect()][0] == 4


def test_cutoff_is_exact_hours_across_clock_change(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 2024-03-10 is the spring-forward day: 14 calendar days back from
        # 2024-03-20 12:00 local is 335 hours, 336 exact hours is 11:00 local.
        df = spark.createDataFrame([("2024-03-06 11:30:00",), ("2024-03-06 10:59:59",)], "s string")
        ts = F.to_timestamp("s")
        cond = before_cutoff(ts, df.select(ts).schema[0].dataType, "2024-03-20 12:00:00", 14)
        got = [r.s for r in df.where(cond).collect()]
        assert got == ["2024-03-06 10:59:59"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_cutoff_on_wall_clock_timestamps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 30, 12, 0, 0),), (dt.datetime(2024, 1, 30, 11, 59, 59),)],
                               "t timestamp_ntz")
    cond = before_cutoff(F.col("t"), df.schema["t"].dataType, dt.datetime(2024, 2, 13, 12), 14)
    assert [r.t for r in df.where(cond).collect()] == [dt.datetime(2024, 1, 30, 11, 59, 59)]


def test_backslash_hash_and_whitespace_lines(spark, tmp_path):
    path = write_csv(tmp_path, "p.csv", PAGES_HEADER, [
        "1,a\\,b,Latvia,1,x",   # no escaping: the backslash stays, the comma splits
        "   ",                  # whitespace only: skipped like a blank line (one field; every guard drops it)
        "#3,c,Chad,3,z",        # no comment character
    ])
    got = [(r.person_id, r.name, r.nationality) for r in read_pages(spark, path).orderBy("person_id").collect()]
    assert got == [("#3", "c", "Chad"), ("1", "a\\", "b")]


def test_random_lines_split_like_java(spark, tmp_path):
    import random

    import model

    rng = random.Random(5)
    atoms = ["", "", "a", "7", " ", "\t", '"', "x y", "Name", "-3"]
    lines = []
    for _ in range(600):
        n = rng.randint(1, 12)
        line = ",".join(rng.choice(atoms) for _ in range(n))
        if line.strip(" \t") == "":
            continue  # blank and whitespace-only lines are skipped by the reader
        lines.append(line)
    path = write_csv(tmp_path, "r.csv", PAGES_HEADER, lines)
    rows = read_pages(spark, path).collect()  # one small file: one task, file order
    assert len(rows) == len(lines)
    for line, row in zip(lines, rows):
        parts = model.jsplit(line)
        assert row._n_fields == len(parts), line
        padded = parts + [""] * 5
        assert [row.person_id, row.name, row.nationality, row.country_code, row.hobby] == padded[:5], line


def test_checkpoint_dir_and_materialize(spark):
    from socialpages.plans import ensure_checkpoint_dir, materialize, plan_text

    folder = ensure_checkpoint_dir(spark)
    assert folder and spark.sparkContext.getCheckpointDir() is not None
    df = spark.range(10).selectExpr("id", "id * 2 AS twice")
    m = materialize(df)
    assert m.count() == 10 and "Range" not in plan_text(m, "simple")


def test_strict_int_on_random_text(spark):
    import random

    import model

    rng = random.Random(9)
    atoms = ["0", "1", "7", "9", "+", "-", " ", "\t", "a", ".", "_", "2147483647", "2147483648", "-2147483648"]
    values = ["".join(rng.choice(atoms) for _ in range(rng.randint(0, 4))) for _ in range(3000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: r.v for r in df.select("i", strict_int(df, "s").alias("v")).collect()}
    for i, v in enumerate(values):
        assert got[i] == model.parse_int(v), repr(v)


def test_partitions_for():
    from socialpages.session import partitions_for

    assert partitions_for(0) == 1
    assert partitions_for(256 * 1024 * 1024) == 1
    assert partitions_for(256 * 1024 * 1024 + 1) == 2
    assert partitions_for(10 * 1024**4) == 40960          # a 10 TiB shuffle at 256 MiB each


def test_header_dropped_once_per_file_not_per_split(spark, tmp_path):
    lines = [f"{i},{i % 50},{i % 97},View,2024-01-01 00:00:00" for i in range(20000)]
    path = write_csv(tmp_path, "big.csv", ACCESS_HEADER, lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        df = read_access(spark, path)
        assert df.rdd.getNumPartitions() > 5          # the file is read as many splits
        assert df.count() == 20000                    # every data row survives, the header does not
        assert df.where("access_id = 'AccessID'").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_any_number_of_fields_and_nul_characters(spark, tmp_path):
    path = write_csv(tmp_path, "wide.csv", PAGES_HEADER, [
        ",".join(str(i) for i in range(21_000)), "\x00a,\x00,c\x00", "1," + "x" * 200_000, ",".join([""] * 30_000),
    ])
    rows = {r.person_id: r for r in read_pages(spark, path).collect()}
    assert rows["0"]._n_fields == 21_000 and rows["0"].hobby == "4"
    assert (rows["\x00a"].name, rows["\x00a"].nationality, rows["\x00a"]._n_fields) == ("\x00", "c\x00", 3)
    assert len(rows["1"].name) == 200_000 and rows[""]._n_fields == 0


def test_parse_lines_keeps_columns_and_reads_null_lines(spark):
    from socialpages import parse_lines

    lines = spark.createDataFrame([(1, "a,b"), (2, None), (3, "")], "id int, line string")
    got = parse_lines(lines, ["x", "y"], "line", keep=["id"]).collect()
    assert [tuple(r) for r in got] == [(1, "a", "b", 2), (2, "", "", 0), (3, "", "", 1)]


def test_staged_tables_go_when_told(spark):
    import os

    from socialpages.plans import discard, staged

    table, path = staged(spark.range(5))
    local = path.removeprefix("file:")
    assert table.count() == 5 and os.path.isdir(local)
    discard(spark, path)
    assert not os.path.exists(local)

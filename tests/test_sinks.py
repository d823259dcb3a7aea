"""Text sinks write the original output layouts."""

import glob

import pytest

from socialpages import nationality_hobby_report, write_report_text, write_tsv, write_value_text


def _read_lines(folder):
    lines = []
    for part in sorted(glob.glob(f"{folder}/part-*")):
        with open(part) as fh:
            lines.extend(fh.read().split("\n")[:-1])
    return lines


def test_tsv_and_refuses_existing(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, n int").coalesce(1)
    out = str(tmp_path / "tsv")
    write_tsv(df, out)
    assert sorted(_read_lines(out)) == ["a\t1", "b\t"]
    with pytest.raises(Exception):
        write_tsv(df, out)


def test_value_text(spark, tmp_path):
    df = spark.createDataFrame([(5, 0, "Eric", "East Timor"), (7, 3, "Al", "Peru")],
                               "accesses long, person_id int, name string, nationality string")
    out = str(tmp_path / "b")
    write_value_text(df, out)
    assert _read_lines(out) == ["7\t3,Al,Peru", "5\t0,Eric,East Timor"]


def test_report_text_layout(spark, tmp_path):
    pages = spark.createDataFrame(
        [("1", "Zed", "Latvia", "1", "Go"), ("2", "Ann", "Latvia", "1", "Chess"),
         ("3", "Ann", "Latvia", "1", "Chess"), ("4", "Bob", "Peru", "1", "Golf")],
        "person_id string, name string, nationality string, country_code string, hobby string")
    out = str(tmp_path / "a")
    write_report_text(nationality_hobby_report(pages, "Latvia"), out)
    assert _read_lines(out) == ["Latvia\tAnn, Chess", "Ann, Chess", "Zed, Go", ""]


def test_report_text_many_identical_members(spark, tmp_path):
    from pyspark.sql import functions as F

    report = spark.range(0, 200, 1, 8).select(
        F.lit("Latvia").alias("nationality"),
        F.when(F.col("id") < 150, F.lit("Ann, Chess")).otherwise(F.lit("Bob, Go")).alias("member"),
    )
    out = str(tmp_path / "dups")
    write_report_text(report, out)
    assert _read_lines(out) == ["Latvia\tAnn, Chess"] + ["Ann, Chess"] * 149 + ["Bob, Go"] * 50 + [""]


def test_report_text_from_shuffled_input(spark, tmp_path):
    from pyspark.sql import functions as F

    report = spark.range(0, 300, 1, 6).select(
        F.lit("Peru").alias("nationality"), (F.col("id") % 7).cast("string").alias("member")
    ).repartition(5)
    out = str(tmp_path / "shuffled")
    write_report_text(report, out)
    body = [str(i % 7) for i in range(300)]
    assert _read_lines(out) == ["Peru\t0"] + sorted(body)[1:] + [""]

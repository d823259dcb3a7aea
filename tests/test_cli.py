"""The command line writes each report's text output."""

import glob

import pytest

from socialpages.__main__ import main


def _lines(folder):
    out = []
    for part in sorted(glob.glob(f"{folder}/part-*")):
        with open(part) as fh:
            out.extend(fh.read().split("\n")[:-1])
    return out


def test_cli_reports(spark, sample, tmp_path):
    pages, friends, access = sample["pages"], sample["friends"], sample["access"]
    main(["nationality", "--pages", pages, "--out", str(tmp_path / "a")])
    assert _lines(tmp_path / "a") == ["Latvia\tAnn Lee, Chess", "Cy Dow, Crocheting", ""]
    main(["top_pages", "--pages", pages, "--access", access, "--out", str(tmp_path / "b")])
    assert _lines(tmp_path / "b") == ["4\t0,Ann Lee,Latvia", "2\t1,Bob Ray,Peru", "1\t2,Cy Dow,Latvia", "1\t5,Flo May,Mali"]
    main(["disconnected", "--pages", pages, "--access", access, "--as-of", "2024-02-13T12:00:00", "--out", str(tmp_path / "g")])
    assert sorted(_lines(tmp_path / "g")) == ["0\tAnn Lee", "1\tBob Ray", "4\tEd Poe", "5\tFlo May"]
    main(["connectedness", "--pages", pages, "--friends", friends, "--out", str(tmp_path / "d")])
    assert sorted(_lines(tmp_path / "d")) == ["9\t0", "Ann Lee\t3", "Bob Ray\t2", "Cy Dow\t1", "Di Fox\t1", "Ed Poe\t0", "Flo May\t0"]
    main(["diversity", "--pages", pages, "--access", access, "--out", str(tmp_path / "e")])
    assert "Ann Lee\t2\t1" in _lines(tmp_path / "e") and "Di Fox\t2\t2" in _lines(tmp_path / "e")
    main(["popular", "--pages", pages, "--friends", friends, "--out", str(tmp_path / "p")])
    assert sorted(_lines(tmp_path / "p")) == ["Ann Lee\t3", "Cy Dow\t2"]
    main(["rejects", "--pages", pages, "--access", access, "--out", str(tmp_path / "r")])
    assert _lines(tmp_path / "r") == ["access\t8\t0\t0", "pages\t6\t0\t0", "total\t14\t0\t0"]
    with pytest.raises(SystemExit):
        main(["popular", "--pages", pages, "--out", str(tmp_path / "h")])


def test_cli_all_reports(spark, sample, tmp_path):
    main(["all", "--pages", sample["pages"], "--friends", sample["friends"], "--access", sample["access"],
          "--as-of", "2024-02-13T12:00:00", "--cache", "--out", str(tmp_path / "all")])
    counts = {name: len(_lines(tmp_path / "all" / name)) for name in
              ["nationality", "top_pages", "countries", "third_field", "connectedness", "diversity",
               "unvisited", "disconnected", "popular", "rejects"]}
    assert counts == {"nationality": 3, "top_pages": 4, "countries": 4, "third_field": 8, "connectedness": 7,
                      "diversity": 5, "unvisited": 3, "disconnected": 4, "popular": 2, "rejects": 3}


def test_cli_sorted_output(spark, sample, tmp_path):
    main(["countries", "--pages", sample["pages"], "--sorted", "--out", str(tmp_path / "c")])
    assert _lines(tmp_path / "c") == ["Chad\t1", "Latvia\t2", "Mali\t1", "Peru\t2"]

"""Run one report over the CSV files and write its text output.

    python -m socialpages top_pages --pages pages.csv \
        --access access_logs.csv --out top_pages

Reports: nationality, top_pages, countries, third_field, connectedness,
diversity, unvisited, disconnected, popular, rejects -- or ``all``, which
writes every report into ``OUT/<report>`` from one read of each file
(``--cache`` keeps the parsed relations in executor memory and disk; the
cache keeps its lineage, so a lost executor's part is recomputed).  Outputs are
tab-separated text directories in the original layouts: the nationality
report as one ``key TAB member-lines`` record per nationality, the top
pages as ``accesses TAB id,name,nationality``, the others as one line per
row with the report's columns.  An existing output directory is refused.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark import StorageLevel

from socialpages import operators as ops
from socialpages.constants import DEFAULT_DAYS, DEFAULT_NATIONALITY, DEFAULT_TOP_K
from socialpages.session import build_session
from socialpages.sources import (
    read_access,
    read_friends,
    read_pages,
    write_report_text,
    write_tsv,
    write_value_text,
)
from socialpages.sources.sinks import CONNECTEDNESS_LINE, DIVERSITY_LINE, POPULAR_LINE

NEEDS = {
    "nationality": ("pages",),
    "top_pages": ("pages", "access"),
    "countries": ("pages",),
    "third_field": ("pages", "access"),
    "connectedness": ("pages", "friends"),
    "diversity": ("pages", "access"),
    "unvisited": ("pages", "friends", "access"),
    "disconnected": ("pages", "access"),
    "popular": ("pages", "friends"),
    "rejects": ("pages", "access"),
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="socialpages")
    parser.add_argument("report", choices=sorted(NEEDS) + ["all"])
    parser.add_argument("--pages", nargs="+")
    parser.add_argument("--friends", nargs="+")
    parser.add_argument("--access", nargs="+")
    parser.add_argument("--out", required=True)
    parser.add_argument("--nationality", default=DEFAULT_NATIONALITY)
    parser.add_argument("--k", type=int, default=DEFAULT_TOP_K)
    parser.add_argument("--as-of", type=dt.datetime.fromisoformat, default=None)
    parser.add_argument("--days", type=int, default=DEFAULT_DAYS)
    parser.add_argument("--mode", default="errorifexists")
    parser.add_argument("--sorted", action="store_true", help="order lines by the report key")
    parser.add_argument("--cache", action="store_true", help="with all: persist the parsed inputs")
    args = parser.parse_args(argv)

    reports = sorted(NEEDS) if args.report == "all" else [args.report]
    needed = {name for report in reports for name in NEEDS[report]}
    missing = sorted(name for name in needed if not getattr(args, name))
    if missing:
        parser.error(f"{args.report} needs --{' --'.join(missing)}")

    spark = build_session()
    inputs = {
        "pages": read_pages(spark, args.pages) if args.pages else None,
        "friends": read_friends(spark, args.friends) if args.friends else None,
        "access": read_access(spark, args.access) if args.access else None,
    }
    cached = args.cache and len(reports) > 1
    if cached:
        inputs = {k: (v.persist(StorageLevel.MEMORY_AND_DISK) if v is not None else None) for k, v in inputs.items()}
    for report in reports:
        out = f"{args.out.rstrip('/')}/{report}" if args.report == "all" else args.out
        _write(report, inputs, args, out)
    for df in inputs.values():
        if cached and df is not None:
            df.unpersist()


def _write(report: str, inputs: dict, args: argparse.Namespace, out: str) -> None:
    p, f, a = inputs["pages"], inputs["friends"], inputs["access"]
    if report == "nationality":
        write_report_text(ops.nationality_hobby_report(p, args.nationality), out, args.mode)
        return
    if report == "top_pages":
        write_value_text(ops.top_accessed_pages(p, a, args.k), out, args.mode)
        return
    result = {
        "countries": lambda: ops.country_page_count(p),
        "third_field": lambda: ops.third_field_count(p, a),
        "connectedness": lambda: ops.connectedness_factor(p, f),
        "diversity": lambda: ops.access_diversity(p, a),
        "unvisited": lambda: ops.unvisited_friends(p, f, a),
        "disconnected": lambda: ops.disconnected_users(p, a, args.as_of, args.days),
        "popular": lambda: ops.popular_users(p, f),
        "rejects": lambda: ops.top_pages_rejects(p, a),
    }[report]()
    lines = {"connectedness": CONNECTEDNESS_LINE, "diversity": DIVERSITY_LINE, "popular": POPULAR_LINE}.get(report)
    write_tsv(result, out, args.mode, sort_by=[result.columns[0]] if args.sorted or report == "rejects" else None, columns=lines)


if __name__ == "__main__":
    main()

"""Plain-Python model of the reports, written from their contracts (not
from the Spark code), used as the brute-force oracle in the tests.

Lines are split the way ``String.split(",")`` does (trailing empty fields
dropped); the first line of each file is the header.
"""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter, defaultdict

JAVA_WS = "".join(chr(c) for c in range(0x21))
INT_RE = re.compile(r"^[+-]?[0-9]+$")


def jsplit(line: str) -> list[str]:
    parts = line.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def jtrim(s: str) -> str:
    return s.strip(JAVA_WS)


def parse_int(s: str):
    if not INT_RE.match(s):
        return None
    v = int(s)
    return v if -(2**31) <= v < 2**31 else None


def rows(lines: list[str]) -> list[list[str]]:
    return [jsplit(line) for line in lines if line != ""]


def nationality_rows(pages, nat):
    return sorted((jtrim(p[1]), jtrim(p[4])) for p in rows(pages) if len(p) > 4 and jtrim(p[2]) == nat)


def top_pages(pages, access, k=10):
    counts = Counter()
    for a in rows(access):
        if len(a) > 2 and parse_int(a[2]) is not None:
            counts[parse_int(a[2])] += 1
    out = []
    for p in rows(pages):
        if len(p) > 2 and parse_int(p[0]) is not None and counts[parse_int(p[0])] > 0:
            out.append((counts[parse_int(p[0])], parse_int(p[0]), p[1], p[2]))
    out.sort(key=lambda r: (-r[0], r[1], r[2], r[3]))
    return out[:k]


def country_count(pages):
    return sorted(Counter(jtrim(p[2]) for p in rows(pages) if len(p) > 3).items())


def third_field(pages, access):
    c = Counter(jtrim(p[2]) for p in rows(pages) if len(p) > 3)
    c.update(jtrim(a[2]) for a in rows(access) if len(a) > 3)
    return sorted(c.items())


def _names(pages, min_len, trim_id, trim_name, blank_missing=False):
    names = defaultdict(list)
    for p in rows(pages):
        if len(p) > min_len:
            i = jtrim(p[0]) if trim_id else p[0]
            n = jtrim(p[1]) if trim_name else p[1]
            if i != "":
                names[i].append(n)
    out = {}
    for i, ns in names.items():
        cand = [n for n in ns if n != ""] if blank_missing else ns
        out[i] = min(cand) if cand else None
    return out


def connectedness(pages, friends):
    indeg = Counter()
    for f in rows(friends):
        if len(f) > 2 and jtrim(f[2]) != "":
            indeg[jtrim(f[2])] += 1
    names = _names(pages, 1, True, True, blank_missing=True)
    out = []
    for i in set(names) | set(indeg):
        if names.get(i) is not None:
            out.append((i, names[i], indeg.get(i, 0)))
        else:
            out.append((i, i, 0))
    return sorted(out)


def diversity(pages, access):
    total, pages_seen = Counter(), defaultdict(set)
    for a in rows(access):
        if len(a) > 2 and a[1] != "":
            total[a[1]] += 1
            pages_seen[a[1]].add(a[2])
    names = _names(pages, 1, False, False)
    return sorted((i, names[i], total[i], len(pages_seen[i])) for i in names if total[i] > 0)


def unvisited(pages, friends, access):
    edges = {(f[1], f[2]) for f in rows(friends) if len(f) > 2 and f[1] != ""}
    visits = {(a[1], a[2]) for a in rows(access) if len(a) > 2}
    counts = Counter(o for o, fr in edges - visits)
    names = _names(pages, 1, False, False)
    return sorted((o, names.get(o) if names.get(o) is not None else "Unknown", n) for o, n in counts.items())


def disconnected(pages, access, as_of: dt.datetime, days=14):
    last = {}
    for a in rows(access):
        if len(a) > 1 and jtrim(a[1]) != "":
            who = jtrim(a[1])
            ts = None
            if len(a) > 4:
                try:
                    ts = dt.datetime.strptime(jtrim(a[4]), "%Y-%m-%d %H:%M:%S")
                except ValueError:
                    ts = None
            prev = last.get(who)
            if ts is not None and (prev is None or ts > prev):
                last[who] = ts
            else:
                last.setdefault(who, prev)
    cutoff = as_of - dt.timedelta(days=days)
    names = _names(pages, 2, False, False)
    return sorted((i, n) for i, n in names.items() if last.get(i) is None or last[i] < cutoff)


def popular(pages, friends):
    outdeg = Counter()
    for f in rows(friends):
        if len(f) > 2 and jtrim(f[1]) != "":
            outdeg[jtrim(f[1])] += 1
    names = _names(pages, 1, True, False)
    ids = set(names) | set(outdeg)
    if not ids:
        return []
    avg = sum(outdeg[i] for i in ids) / len(ids)
    return sorted((i, names.get(i), outdeg[i]) for i in ids if outdeg[i] > avg)

import random
import re

from socialpages.llm import licenses


def words(passage):
    return re.findall(r"[^\W_]+", passage.lower())


def grams(w):
    return set(zip(w, w[1:]))


def brute(text, templates=licenses.TEMPLATES, threshold=licenses.THRESHOLD):
    """All windows of a template's size that start at one of its bigrams."""
    w = words(text or "")
    pairs = list(zip(w, w[1:]))
    hits = []
    for name, t in templates:
        b = grams(words(t))
        for s, pair in enumerate(pairs):
            if pair in b:
                a = set(pairs[s : s + len(b)])
                dice = 2.0 * len(a & b) / (len(a) + len(b))
                if dice >= threshold:
                    hits.append((dice, name))
    if not hits:
        return None, None, "", 0
    top = max(d for d, _ in hits)
    return min(x for d, x in hits if d == top), top, ",".join(sorted({x for _, x in hits})), len(hits)


def texts():
    rnd = random.Random(1)
    out = [None, "", "\n\n", "one", "Released under the MIT License.", "released UNDER the mit-license!!", "Released under the MIT Licence"]
    for _ in range(150):
        lines = []
        for _ in range(rnd.randrange(6)):
            t = rnd.choice(licenses.TEMPLATES)[1].split()
            if rnd.random() < 0.5:
                t = [rnd.choice(["mit", "der", "x1", "Ünd"]) for _ in range(rnd.choice([2, 7, 40]))]
            else:
                for _ in range(rnd.choice([0, 0, 1, 2, 5])):
                    t[rnd.randrange(len(t))] = rnd.choice(["foo", "the", "License"])
                if rnd.random() < 0.3:
                    t[rnd.randrange(len(t))] += "\n"
            lines.append(" ".join(t))
            if rnd.random() < 0.3:
                lines.append(rnd.choice(["", " ", "--", " \n\n "]))
        out.append("\n".join(lines))
    return out


def test_against_brute_force(spark):
    rows = [(i, t, 1) for i, t in enumerate(texts())] + [(4, texts()[4], 1), (4, texts()[4], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, name int").repartition(4)
    got = licenses.scanned(docs)
    assert got.columns == [*docs.columns, "licence"]
    got = sorted(((r.doc_id, *r.licence) for r in got.collect()), key=str)
    assert got == sorted(((i, *brute(t)) for i, t, _ in rows), key=str)
    assert {g[1] for g in got} >= {None, "MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0"}


def test_bounds_lose_no_window(spark):
    """Texts just at the threshold by deletion, by insertion and inside other words."""
    base = [f"w{i}" for i in range(21)]  # 20 bigrams
    templates = [("T", " ".join(base))]
    rows = [(n, " ".join(base[: n + 1])) for n in range(1, 21)]
    rows += [(100 + n, " ".join([f"y{i}" for i in range(n)] + base + [f"x{i}" for i in range(n)])) for n in range(20)]
    rows += [(200 + n, " ".join(x for i in range(21) for x in ([base[i], f"z{i}"] if i % 20 < n else [base[i]]))) for n in range(20)]
    rows += [(300 + n, " ".join(base[:n] + base[n + 1 :])) for n in range(21)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for threshold in (0.5, 0.8, 1.0):
        got = {r.doc_id: tuple(r.licence) for r in licenses.scanned(docs, templates=templates, threshold=threshold).collect()}
        assert got == {i: brute(t, templates, threshold) for i, t in rows}
    assert brute(rows[13][1], templates)[0] == "T" and brute(rows[11][1], templates)[0] is None


def test_notices_inside_lines_and_over_line_ends(spark):
    mit = [t for n, t in licenses.TEMPLATES if n == "MIT"]
    cc = dict(licenses.TEMPLATES)["CC-BY-4.0"].split()
    lgpl = dict(licenses.TEMPLATES)["LGPL-3.0"].split()
    rows = [
        (1, "This little tool was written by Ann in 2019 and is released under the MIT License. Enjoy it."),
        (2, "Notes on the text.\n" + "\n * ".join([" ".join(cc[:5]), " ".join(cc[5:])]) + " And more prose here."),
        (3, "Prose before. " + mit[2] + "\nafter"), (4, "Prose before. " + mit[3].upper() + " after"),
        (5, "/*\n" + "\n".join(" * " + " ".join(lgpl[i : i + 9]) for i in range(0, len(lgpl), 9)) + "\n */"),
        (6, "the license of the software in the name of the work"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.licence.license for r in licenses.scanned(docs).collect()}
    assert got == {1: "MIT", 2: "CC-BY-4.0", 3: "MIT", 4: "MIT", 5: "LGPL-3.0", 6: None}


def test_many_templates(spark):
    """The list has no limit: a text names the one of 1500 templates that it holds."""
    rnd = random.Random(8)
    templates = [(f"L{i}", " ".join(f"v{rnd.randrange(900)}" for _ in range(rnd.randrange(2, 25)))) for i in range(1500)]
    rows = [(i, f"before it {t} behind it") for i, (_, t) in enumerate(templates[::25])]
    got = {r.doc_id: tuple(r.licence) for r in licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string"), templates=templates).collect()}
    assert got == {i: brute(t, templates) for i, t in rows}
    assert all(f"L{25 * i}" in got[i][2].split(",") for i, _ in rows)


def test_no_python_and_no_shuffle(spark):
    plan = licenses.scanned(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_empty_table_long_text_and_no_templates(spark):
    docs = spark.createDataFrame([(1, "a b " * 100_000 + "\n " * 50_000 + "\nReleased under the MIT License.")], "doc_id long, text string")
    assert licenses.scanned(docs).first()["licence"].license == "MIT"
    assert licenses.scanned(docs.where("false")).count() == 0
    assert licenses.scanned(docs, templates=()).first()["licence"].license is None
    assert licenses.scanned(docs, templates=[("x", "word"), ("y", "")]).first()["licence"].n_windows == 0
    odd = spark.createDataFrame([(1, "it is Ann's own licence")], "doc_id long, text string")
    assert licenses.scanned(odd, templates=[("Ann's \\", "Ann's own licence")]).first()["licence"].license == "Ann's \\"

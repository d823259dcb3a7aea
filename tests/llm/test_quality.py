import random
import re
import unicodedata
from collections import Counter

import pytest

from socialpages.llm import quality as q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(8)}
    n, chars = len(w), sum(map(len, w))
    symbols = sum(c in "#*$%&|<>" for c in text)
    dup = len(lines) - len(set(lines))
    base = n < 20 or 100 * len(covered) > 30 * n
    upper = sum(unicodedata.category(c) == "Lu" for c in text)
    lower = sum(unicodedata.category(c) == "Ll" for c in text)
    letter = lambda c: unicodedata.category(c)[0] == "L"

    def strip(x):
        while x and not letter(x[0]):
            x = x[1:]
        while x and not letter(x[-1]):
            x = x[:-1]
        return x.lower()

    bad = (
        100 * symbols > 10 * n
        or 100 * dup > 50 * len(lines)
        or 100 * sum(a == b for a, b in zip(w, w[1:])) > 30 * n
        or not 2 * n <= chars <= 15 * n
        or 100 * upper > 50 * (upper + lower)
        or 100 * sum(any(map(letter, x)) for x in w) < 70 * n
        or 100 * sum(strip(x) in q.COMMON_WORDS.split() for x in w) < 2 * n
    )
    return n, chars, symbols, dup, len(covered), base, not base and not bad


def texts():
    rnd = random.Random(3)
    vocab = "the of Été und la x12 77 a&b WORD WORD !! <b> (the), straße łód ñandú".split() + [f"wort{i}" for i in range(40)]
    out = [None, "", " \n\t", "the " * 50, "word " * 19, "\n".join(["the same line here"] * 9 + ["x"] * 3), "\x1f \x85 the"]
    out += [x for x in (
        " ".join(f"a{i} the" for i in range(30)), " ".join(f"A{i}X THE" for i in range(30)), " ".join(f"{i} the" for i in range(30)),
        " ".join(f"wort{i}" for i in range(60)), " ".join(f"{'l' * 40}{i} the" for i in range(30)), " ".join(f"the ## w{i}" for i in range(30)),
        " ".join(f"of w{i} w{i} w{i}" for i in range(30)), " ".join("the of a in" for i in range(2)) + " " + " ".join(f"the q{i}" for i in range(40)),
    )]
    out.append("\n".join(f"dup one\ndup two\nthe w{i}" for i in range(12)))
    for _ in range(120):
        w = [rnd.choice(vocab) for _ in range(rnd.choice([0, 5, 19, 20, 60, 300]))]
        if w and rnd.random() < 0.5:
            a = rnd.randrange(len(w))
            w[a:a] = w[:9] * rnd.choice([1, 2, 8])
        out.append("".join(x + rnd.choice([" ", " ", "\n", "\t", "  "]) for x in w))
    return out


def test_counts_and_verdicts_match_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(0, None), (8, texts()[8])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, quality_ string").repartition(4)
    out = q.judged(docs).select("doc_id", "quality.*").collect()
    got = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in out)
    assert got == sorted((i, *brute(t)) for i, t in rows)
    assert {r.rejected_by for r in out} >= {None, "base", "many_symbols", "many_echoes", "many_dup_lines", "mostly_upper",
                                            "few_letter_words", "few_common_words", "odd_word_length"}


@pytest.mark.parametrize("order", [[r.name for r in q.RULES], [r.name for r in q.RULES][::-1]])
def test_the_order_does_not_change_the_verdict(spark, order):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id long, text string")
    got = q.judged(docs, order=order).select("doc_id", "quality.kept").collect()
    assert {r.doc_id: r.kept for r in got} == {i: brute(t)[-1] for i, t in enumerate(texts())}


def test_order_is_by_rejection_per_cost(spark):
    docs = spark.createDataFrame([(i, " ".join(f"the ## w{i}{j}" for j in range(30))) for i in range(50)], "doc_id long, text string")
    order = q.cascade_order(docs)
    assert order[0] == "many_symbols" and sorted(order) == sorted(r.name for r in q.RULES)
    assert 1 <= q.estimate(docs, sample_rows=10).first()["n"] < 50  # ten to be expected


def test_keep_good_keeps_columns_and_empty_tables_work(spark):
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts())], "doc_id long, text string, _quality int")
    kept = q.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, t in enumerate(texts()) if brute(t)[-1]}
    empty = docs.where("false")
    assert q.keep_good(empty).count() == 0 and q.judged(empty).count() == 0


def test_languages_without_a_word_list_keep_their_clean_texts(spark):
    clean = {
        "ru": "Каждое утро старый рыбак выходил на берег реки, смотрел на воду и тихо рассказывал внуку длинные истории о далёких городах, "
              "больших кораблях и смелых людях, которых встретил раньше",
        "pl": "Każdego ranka stary rybak wychodził nad rzekę, patrzył długo wodę oraz cicho opowiadał wnukowi historie dalekich miast, "
              "wielkich statków, odważnych ludzi, których kiedyś spotkał podczas podróży",
    }
    rows = [(i, t, lang) for i, (lang, t) in enumerate(clean.items())]
    rows += [(10, clean["ru"], None), (11, clean["ru"], "en"), (12, clean["ru"], "EN-us"), (13, "слово " * 40, "ru"), (14, None, "ru")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.kept, r.rejected_by) for r in q.judged(docs, lang="lang").select("doc_id", "quality.*").collect()}
    few = (False, "few_common_words")
    assert got == {0: (True, None), 1: (True, None), 10: (True, None), 11: few, 12: few, 13: (False, "base"), 14: (False, "base")}
    assert {r.doc_id for r in q.keep_good(docs, lang="lang").collect()} == {0, 1, 10}


def test_a_very_long_text(spark):
    long = " ".join(f"the w{i % 50_000}" for i in range(150_000))
    docs = spark.createDataFrame([(1, long)], "doc_id long, text string")
    r = q.judged(docs).first()["quality"]
    assert r.n_words == 300_000 and r.n_repeat_words == 300_000 and r.base_failed


def test_the_sample_is_drawn_from_every_task_without_an_exchange(spark):
    """Rows of all partitions are measured, about as many as asked for, and no text is moved."""
    docs = spark.range(0, 4000, 1, 8).selectExpr(
        "id as doc_id", "array_join(transform(sequence(1, 30), j -> concat('w', j, 'x', id)), ' ') as text"
    )
    for rows in (400, 10_000):
        got = {r.rule: r.n for r in q.estimate(docs, sample_rows=rows).collect()}
        assert len(set(got.values())) == 1 and 0.7 * min(rows, 4000) <= max(got.values()) <= 1.3 * rows
    plan = q.estimate(docs, sample_rows=400)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow") :]
    assert "Exchange" not in below.split("Initial Plan")[0] and "SinglePartition" not in plan

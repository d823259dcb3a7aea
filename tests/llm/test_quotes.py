import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from socialpages.llm import quotes


def parse(text):
    own, runs, last = [], [], None
    for line in (text or "").split("\n"):
        mark = re.match(r"(?:> ?)*", line).group()
        level, body = mark.count(">"), line[len(mark):]
        if level == 0:
            own.append(body)
        if not body.strip(" "):
            last = None
            continue
        if last == level:
            runs[-1][1].append(body)
        else:
            runs.append((level, [body]))
        last = level
    normal = [(d, re.sub(r"[\x20\x09-\x0d]+", " ", "\n".join(b).lower()).strip(" ")) for d, b in runs]
    return "\n".join(own), [(d, p) for d, p in normal if p]


def brute(messages):
    """{id: (own, parent, root, level, n_quoted, n_linked)}; one row for each id."""
    parts = {i: parse(t) for i, t in messages}
    first = {}
    for i in sorted(parts):
        for d, p in parts[i][1]:
            if d == 0:
                first.setdefault(p, i)
    parent, counts = {}, {}
    for i, (_, ps) in parts.items():
        votes, quoted, linked = {}, 0, 0
        for d, p in ps:
            if d:
                quoted += 1
                o = first.get(p)
                if o is not None and o < i:
                    linked += 1
                    votes[(d, o)] = votes.get((d, o), 0) + 1
        parent[i] = min((d, -n, o) for (d, o), n in votes.items())[2] if votes else None
        counts[i] = (quoted, linked)
    out = {}
    for i in parts:
        at, level = i, 0
        while parent[at] is not None:
            at, level = parent[at], level + 1
        out[i] = (parts[i][0], parent[i], at, level, *counts[i])
    return out


def mail(seed=1, n=120):
    rnd = random.Random(seed)
    said, out = [], []
    for i in range(n):
        own = [" ".join(rnd.choice(["alpha", "Beta", "gamma", "ça", f"w{rnd.randrange(50)}"]) for _ in range(rnd.randrange(1, 6)))
               for _ in range(rnd.randrange(1, 4))]
        body = []
        if said and rnd.random() < 0.8:
            quoted = rnd.choice(said[-15:]).split("\n")
            quoted = quoted[rnd.randrange(len(quoted)) if rnd.random() < 0.2 else 0 :]
            body += [(">" if q.startswith(">") and rnd.random() < 0.5 else "> ") + q for q in quoted]
            if rnd.random() < 0.3:
                body.append("")
        for line in own:
            body += [line] + [rnd.choice(["", " ", "\t"])] * (rnd.random() < 0.3)
        text = "\n".join(body)
        if rnd.random() < 0.2:
            text = text.upper().replace(" ", "  ")
        said.append(text)
        out.append((i * 3, text))
    return out + [(1000, None), (1001, ""), (1002, ">"), (1003, "> > nobody said this"), (1004, "a\x01b\x02c")]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = mail(seed)
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "id long, message string, hash int, level string").repartition(5)
    got = quotes.conversations(frame, text="message")
    assert got.columns == [*frame.columns, "thread"]
    got = {r.id: r.thread for r in got.collect()}
    # in passages U+0001 and U+0002 count as spaces, the own text keeps them
    want = {i: (parse(dict(rows)[i])[0], *w[1:]) for i, w in brute([(i, (t or "").translate({1: " ", 2: " "})) for i, t in rows]).items()}
    assert want[1004][0] == "a\x01b\x02c"
    assert {i: (t.own_text, t.parent, t.root, t.level, t.n_quoted, t.n_linked) for i, t in got.items()} == want
    assert max(w[3] for w in want.values()) > 3


def test_nested_levels_and_spacing(spark):
    rows = [
        (1, "First  point\nsecond line"),
        (2, "> first point\n> Second Line\nMy answer"),
        (3, "> > first point\n> > second line\n> my ANSWER\n\nThird"),
        (4, ">>> first point\n>>> second line\n>> my answer\n> third\nFourth"),
        (5, "> third\n> \n> fourth\nfifth"),
    ]
    got = {r.id: r.thread for r in quotes.conversations(spark.createDataFrame(rows, "id long, text string")).collect()}
    assert [got[i].parent for i in (1, 2, 3, 4, 5)] == [None, 1, 2, 3, 3]
    assert [got[i].level for i in (1, 2, 3, 4, 5)] == [0, 1, 2, 3, 3]
    assert {t.root for t in got.values()} == {1}
    assert got[3].own_text == "\nThird" and got[4].own_text == "Fourth"


def test_null_ids_repeats_and_empty(spark):
    rows = [(None, "> hello there"), (1, "hello there"), (2, "> hello there\nyes"), (2, "> hello there\nyes"), (3, None)]
    frame = spark.createDataFrame(rows, "id long, text string")
    got = quotes.conversations(frame).collect()
    assert len(got) == 5
    assert [(r.id, r.thread.parent, r.thread.level) for r in sorted(got, key=lambda r: (r.id or 0, r.text or ""))] == [
        (None, None, 0), (1, None, 0), (2, 1, 1), (2, 1, 1), (3, None, 0)]
    assert quotes.conversations(frame.where("false")).count() == 0


def test_a_long_chain_and_a_long_message(spark):
    rows = [(0, "start 0")] + [(i, f"> start {i - 1}\nstart {i}") for i in range(1, 300)]
    rows.append((500, "\n".join(f"> start {i % 300}" + ("\n>" if i % 2 else "") for i in range(40_000))))
    rows.append((501, ">" * 50_000 + "deep\n" + "> " * 50_000 + "deep"))
    got = {r.id: r.thread for r in quotes.conversations(spark.createDataFrame(rows, "id long, text string")).collect()}
    assert got[501].n_quoted == 1 and got[501].own_text == ""
    assert all(got[i].level == i and got[i].root == 0 for i in range(300))
    assert got[500].n_quoted == 20_000


def test_turns_as_replies(spark):
    turns = [(1, 0, "user", "Hi\nyou"), (1, 1, "assistant", "Well"), (1, 2, "user", None), (1, 3, "user", "ok"), (2, 0, "user", "Hi\nyou"),
             (2, 1, "user", "q"), (None, 1, "user", "z"), (2, None, "user", "y")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    mails = quotes.as_replies(frame)
    text = {(r.conv_id, r.turn): r.message for r in mails.collect()}
    assert text[(1, 1)] == "> Hi\n> you\nWell"
    assert text[(1, 2)] == "> > Hi\n> > you\n> Well\n"
    assert text[(1, 3)] == "> > Well\nok"
    assert (text[(None, 1)], text[(2, None)]) == ("z", "y") and len(text) == 8
    got = {(r.conv_id, r.turn): r.thread for r in quotes.conversations(mails.withColumn("x", F.lit(1)), text="message").collect()}
    assert tuple(got[(2, 1)].parent) == (1, 0)
    assert hashlib.sha256(got[(1, 1)].own_text.encode()).hexdigest() == hashlib.sha256(b"Well").hexdigest()


def test_a_passage_that_a_third_of_the_messages_quote(spark, monkeypatch):
    """Without Spark's skew join, one hot passage and one much-answered message are
    spread over the partitions."""
    from socialpages.llm import common

    n = 3000
    rows = [(0, "the hot passage"), (1, "another")]
    rows += [(i, f"> the hot passage\nanswer {i}" if i % 3 == 0 else f"> another\nown {i}" if i % 3 == 1 else f"text {i}") for i in range(2, n)]
    frame = spark.createDataFrame(rows, "id long, text string").repartition(8)
    sizes = []
    original = common.join_to_unique

    def measured(left, right, key, deal_by, how="inner"):
        out = original(left, right, key, deal_by, how, least=100)
        sizes.append([r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()])
        return out

    monkeypatch.setattr(quotes, "join_to_unique", measured)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = {r.id: r.thread for r in quotes.conversations(frame).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert all(got[i].parent == (0 if i % 3 == 0 else 1 if i % 3 == 1 else None) for i in range(2, n))
    hot = [s for s in sizes if sum(s) > n / 2]
    assert hot and all(max(s) < 0.2 * sum(s) for s in hot)


def test_joining_to_unique_keys(spark):
    from socialpages.llm.common import join_to_unique

    left = spark.range(4000).selectExpr("id", "if(id % 2 = 0, 7, if(id % 5 = 0, null, id % 300)) as k", "1 as _salt", "2 as _hot")
    right = spark.range(0, 200).selectExpr("id as k", "id * 10 as v")
    for how in ("inner", "left"):
        want = sorted(map(tuple, left.join(right, "k", how).collect()), key=str)
        for least in (50, 10_000):
            got = join_to_unique(left, right, "k", "id", how, least)
            assert got.columns == ["k", "id", "_salt", "_hot", "v"] and sorted(map(tuple, got.collect()), key=str) == want

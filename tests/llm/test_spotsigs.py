import hashlib
import random
import unicodedata

from pyspark.sql import functions as F

from socialpages.llm import spotsigs


def brute_set(text):
    """Signatures as tuples (anchor, chain) or the whole text."""
    plain = "".join(c if unicodedata.category(c)[0] in "LN" else " " for c in (text or "").lower()).split()
    common = set(spotsigs.ANCHORS.split())
    out = set()
    for i, w in enumerate(plain):
        if w in common:
            chain = [x for x in plain[i + 1 :] if x not in common][: spotsigs.CHAIN]
            if len(chain) == spotsigs.CHAIN:
                out.add((w, *chain))
    return out or {("all", *plain)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def texts(seed=1, n=40):
    rnd = random.Random(seed)
    vocab = "the of und la que a".split() + [f"word{i}" for i in range(30)] + ["Über", "x-y", "the,", "77"]
    out = [None, "", " \n", "the", "the of", "the word1", "the word1 word2", "of the word1 the word2", "alone here", "the w1 w2 of und", "x of a the", "the the", "...", "The. WORD1 & word2"]
    for _ in range(n):
        out.append(rnd.choice([" ", "\n", ", "]).join(rnd.choice(vocab) for _ in range(rnd.choice([1, 5, 30, 120]))))
    out += [out[-1], out[-1] + " tail", out[15].upper()]
    return out


def test_edit_check_against_brute_force(spark):
    data = [(i * 3 - 20, t) for i, t in enumerate(texts())]
    random.Random(2).shuffle(data)
    data += [(None, "the last word1 word2 of all")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in data], "doc_id long, text string, _part int, set int").repartition(6)
    got = {r.doc_id: r for r in spotsigs.edit_check(docs).collect()}
    assert len(got) == len(data)
    order = sorted((r for r in data if r[0] is not None), reverse=True) + [data[-1]]
    prints = {}
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        half = len(t) // 2
        changed = t[: len(t) - half] + nxt[:half]
        r, s = got[i], brute_set(t)
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert r.near_edited == jaccard(s, brute_set(changed))
        assert r.near_next == jaccard(s, brute_set(nxt))
        assert r.n_signatures == len(s)
        for key, p in ((frozenset(s), r.fingerprint), (frozenset(brute_set(changed)), r.edited_fingerprint)):
            assert prints.setdefault(key, p) == p
    assert len(set(prints.values())) == len(prints)


def test_repeated_rows_one_row_and_none(spark):
    docs = spark.createDataFrame([(1, "the a1 b1"), (1, "the a1 b1"), (1, None)], "doc_id long, text string")
    assert spotsigs.edit_check(docs).count() == 3
    one = spotsigs.edit_check(docs.limit(1)).first()
    assert one.near_next == 1.0
    assert spotsigs.edit_check(docs.where("false")).count() == 0


def test_next_row_over_many_ranges(spark):
    ids = random.Random(3).sample(range(-(10**12), 10**12), 500)
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").repartition(9)
    got = {r.doc_id: r.next_t for r in spotsigs.with_next(docs, {"t": F.col("text")}).collect()}
    order = sorted(ids, reverse=True)
    assert got == {a: f"t{b}" for a, b in zip(order, order[1:] + order[:1])}


def test_near_duplicates_against_brute_force(spark):
    rnd = random.Random(4)
    data, base = [], None
    for i in range(120):
        if base is None or rnd.random() < 0.3:
            base = [rnd.choice(["the", "of", "a"] + [f"w{k}" for k in range(200)]) for _ in range(rnd.choice([6, 40, 150]))]
        mine = list(base)
        for _ in range(rnd.choice([0, 1, 2, 8])):
            mine[rnd.randrange(len(mine))] = f"z{rnd.randrange(999)}"
        data.append((i, " ".join(mine)))
    data += [(900, None), (901, ""), (None, data[0][1])]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    sets = [brute_set(t) for _, t in data]
    group = list(range(len(data)))
    for i in range(len(data)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8 and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    want = {i: min(data[k][0] for k in range(len(data)) if group[k] == g and data[k][0] is not None) for (i, _), g in zip(data, group)}
    got = {r.doc_id: r.class_id for r in spotsigs.near_duplicates(docs).collect()}
    assert got == want and len(set(want.values())) > 10


def test_a_hot_signature_makes_no_large_bucket(spark):
    boiler = spark.range(400).selectExpr("concat('the b', id, ' plate') as t").select("t", spotsigs.signatures("t")[0].alias("h"))
    hot = min(boiler.collect(), key=lambda r: r.h).t  # its hash comes first by number
    data = [(i, hot + " " + " ".join(f"the x{i}y{k} z" for k in range(12))) for i in range(300)]
    data += [(1000 + i, data[i][1] + " tail") for i in range(5)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    sets = docs.select(F.col("doc_id").alias("first"), spotsigs.signatures("text").alias("set")).withColumn("print", spotsigs.digest("set"))
    index = spotsigs._prefixes(spotsigs._rare_first(sets), 0.8)
    assert index.groupBy("band", "sig").count().agg(F.max("count")).first()[0] < 10
    got = {r.doc_id: r.class_id for r in spotsigs.near_duplicates(docs).collect()}
    assert got == {i: i % 1000 for i, _ in data}


def test_block_pairs_give_the_pairs_of_one_block(spark):
    rnd = random.Random(6)
    rows = [(f"p{i}", n, 0, rnd.randrange(3), rnd.randrange(2), near, f"r{i % 7}") for i in range(60) for n in [rnd.choice([8, 9, 10])] for near in (0, 1)]
    member = spark.createDataFrame(rows, "print string, n int, band int, pos int, sig long, near int, root string")
    whole, cut = ({tuple(r) for r in spotsigs._likely(member, 0.8, block).collect()} for block in (1024, 7))
    assert whole == cut and len(whole) > 20


def test_a_long_text(spark):
    long = " ".join(f"the w{i}" for i in range(60_000))
    docs = spark.createDataFrame([(1, long), (2, "x"), (3, "the " * 60_000), (4, "of a w1 " + "the " * 60_000)], "doc_id long, text string")
    assert {r.doc_id: r.n_signatures for r in spotsigs.edit_check(docs).collect()} == {1: 59_999, 2: 1, 3: 1, 4: 1}


def test_common_signatures_alone_do_not_bring_texts_to_comparison(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "HOT_LEAST", 100, raising=False)
    rnd = random.Random(7)
    pool = [f"the x{i} y{i}" for i in range(6000)]  # each in about 6 texts
    data = [(i, " ".join(rnd.sample(pool, 60))) for i in range(600)]
    data += [(1000 + i, data[i][1] + " the last one") for i in range(5)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    compared, plain = [], spotsigs.staged

    def staged(df):
        out = plain(df)
        if df.columns == ["print", "set"]:
            compared.append(out[0].count())
        return out

    monkeypatch.setattr(spotsigs, "staged", staged)
    got = {r.doc_id: r.class_id for r in spotsigs.near_duplicates(docs).collect()}
    assert got == {i: i % 1000 for i, _ in data}
    assert len(compared) == 1 and 10 <= compared[0] < 300


def test_alike_sets_share_a_part_if_one_is_sure(spark):
    rnd = random.Random(8)

    def hashes(k):
        return [rnd.randrange(-(2**63), 2**63) for _ in range(k)]

    hot, rows = hashes(40), []
    for i in range(1500):
        n = rnd.choice([4, 5, 8, 9, 12, 20, 31, 60, 125, 400])
        common = hashes(n) + rnd.sample(hot, rnd.choice([0, 0, n // 10]))
        gone = rnd.randrange(len(common) // 4 + 1)  # at most a fifth of both together is in one only
        first = rnd.randrange(gone + 1)
        for side, more in (("a", first), ("b", gone - first)):
            rows.append((i, f"{side}{i}".encode(), sorted(common + hashes(more))))
    sets = spark.createDataFrame(rows, "pair long, print binary, set array<bigint>")
    for listed in (hot, []):
        cuts = spotsigs._segments(sets, 0.8, listed).collect()
        sure, held = {}, {}
        for r in cuts:
            p = bytes(r.print)
            sure[p] = sure.get(p, True) and r.sure
            held.setdefault(p, set()).update((r.band, s) for s in r.sigs)
        pairs = [(f"a{i}".encode(), f"b{i}".encode()) for i in range(1500)]
        known = [(a, b) for a, b in pairs if sure[a] or sure[b]]
        assert len(known) > 1200 and all(held[a] & held[b] for a, b in known)


def test_classes_of_sets_of_many_lengths_and_hot_signatures(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "HOT_LEAST", 60)
    rnd = random.Random(9)
    fixed = [f"the h{k} i{k}" for k in range(12)]
    data = []
    for g in range(60):
        base = [f"of g{g}a{k} g{g}b{k}" for k in range(rnd.choice([3, 4, 5, 7, 10, 16, 33, 80]))] + fixed[: rnd.choice([0, 4, 12])]
        for _ in range(5):
            mine = [s for s in base if rnd.random() > rnd.choice([0, 0.05, 0.12])] + [f"la n{rnd.random()} m" for _ in range(rnd.choice([0, 1, 2]))]
            data.append((len(data), " ".join(mine)))
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    sets = [brute_set(t) for _, t in data]
    group = list(range(len(data)))
    for i in range(len(data)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8 and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    least = {g: group.index(g) for g in set(group)}
    got = {r.doc_id: r.class_id for r in spotsigs.near_duplicates(docs).collect()}
    assert got == {i: least[g] for i, g in enumerate(group)}

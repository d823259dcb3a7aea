import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from socialpages.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [t.translate({c: c + 32 for c in range(0x41, 0x5B)}) for t in TERM.findall(text or "")]


def brute(rows, min_docs, top):
    """Rows ``(text, lang, source)``."""
    rows = [(terms(t), g or "", s or "") for t, g, s in rows]
    df, groups = defaultdict(Counter), defaultdict(dict)
    for ts, g, s in rows:
        df[g].update(set(ts))
        groups[g].setdefault(s, Counter()).update(ts)
    out = []
    for g, sources in groups.items():
        kept = sorted(t for t, n in df[g].items() if n >= min_docs)
        v = len(kept)

        def price(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * v) for t in kept}

        whole = price(sum(sources.values(), Counter()))
        prices = {s: price(c) for s, c in sources.items()}
        for s in sources:
            found = [(o, sum(abs(prices[s][t] - prices[o][t]) for t in kept)) for o in sources if o != s]
            best = [(t, prices[s][t] - whole[t]) for t in kept if sources[s][t] and prices[s][t] > whole[t]]
            for part, values, most in (("pair", found, None), ("term", best, top)):
                ranked = sorted(values, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(g, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


def corpus(seed, sources=9):
    rnd = random.Random(seed)
    vocab = ["Straße", "été", "Ünder", "don't", "a1b", "naïve", "x_y", "İ", "日本", *[f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]]
    rows = []
    for _ in range(160):
        n = rnd.choice([0, 1, 5, 40])
        text = rnd.choice([" ", "\n", ", "]).join(rnd.choice(vocab[: rnd.choice([9, 60, 129])]) for _ in range(n))
        source = f"s{rnd.randrange(sources)}" if rnd.random() < 0.6 else "hot"
        rows.append((rnd.choice([text, text.upper()]), rnd.choice(["en", "de", None, ""]), rnd.choice([source, None, "日"])))
    return rows + [(None, "en", "silent"), ("", "only", "one"), ("q", "two", "a"), ("r", "two", "b"), rows[0], rows[0]]


def frame(spark, rows):
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    return docs.withColumn("term", F.lit(1)).withColumn("n", F.lit("x")).withColumn("price", F.lit(None).cast("int"))


@pytest.mark.parametrize("seed,min_docs,top", [(1, 5, 50), (2, 3, 7), (3, 1000, 50)])
def test_against_brute_force(spark, seed, min_docs, top):
    rows = corpus(seed)
    got = divergence.source_divergence(frame(spark, rows).repartition(6), min_docs=min_docs, top=top)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert sorted(map(tuple, got.collect())) == brute(rows, min_docs, top)


def test_blocks_and_tiles(spark, monkeypatch):
    """The product is the same in blocks of few terms and tiles of few sources."""
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 7)
    monkeypatch.setattr(divergence, "TILE", 3)
    monkeypatch.setattr(divergence, "SLICE_BYTES", 300)
    rows = corpus(4, sources=14)
    got = divergence.source_divergence(frame(spark, rows).repartition(3), min_docs=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 50)


def test_large_counts(spark):
    """Prices are exact beyond 64 bits."""
    assert spark.range(1).selectExpr(divergence._price("9000000000000000000", "9100000000000000001", "30000") + " as p").first().p == (
        1 + 10**9 * (9 * 10**18 + 5) // (9100000000000000001 + 150000)
    )


def test_empty(spark):
    assert divergence.source_divergence(frame(spark, corpus(1)).limit(0)).count() == 0
    one = divergence.source_divergence(frame(spark, [(None, None, None)]), min_docs=1)
    assert one.count() == 0

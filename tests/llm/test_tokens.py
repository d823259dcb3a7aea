import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from socialpages.llm import tokens

PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def ranks():
    return tokens.load_ranks(PATH)


@pytest.fixture(scope="module")
def counter(ranks):
    return tokens.Counter(ranks)


def full(counter, text):
    return len(counter.encoding.encode_ordinary(text))


def some_text(rnd, n):
    parts = ["the", "I'll", "don't", "'re", "'", " ", "  ", "\n\n", "\t", "123", "foo-bar", "über", "你好", "🙂", "...", "\x1c", "\x85", " ", "a" * 30, "'s", "x'"]
    return "".join(rnd.choice(parts) + rnd.choice(["", " ", " "]) for _ in range(n))


def check(tree, text, counter):
    assert tree.tokens[1] == full(counter, text) and tree.chars[1] == len(text)
    for sums in (tree.chars, tree.tokens):
        for i in range(1, tree.size):
            assert sums[i] == sums[2 * i] + sums[2 * i + 1]


def test_building_counts_like_the_library(counter):
    rnd = random.Random(1)
    for n in [0, 1, 2, 10, 63, 64, 65, 400, 3000]:
        text = some_text(rnd, n)
        tree, pretokens = tokens.build(text, counter)
        check(tree, text, counter)
        assert "".join(counter.pattern.findall(text)) == text and pretokens == len(counter.pattern.findall(text))


@pytest.mark.parametrize("seed", range(6))
def test_many_edits_keep_the_count(counter, seed):
    rnd = random.Random(seed)
    text = some_text(rnd, rnd.choice([0, 3, 200, 1500]))
    tree, _ = tokens.build(text, counter)
    for _ in range(60):
        start = rnd.choice([0, len(text), rnd.randrange(-2, len(text) + 3)])
        length = rnd.choice([0, 0, 1, 2, 5, 40, len(text) // 2, 10**6 if rnd.random() < 0.1 else 3])
        insert = rnd.choice(["", "", "a", " ", "'", "'l", "l", "\n", "  ", some_text(rnd, rnd.choice([1, 5, 200]))])
        text, tree, _ = tokens.edit(text, tree, start, length, insert, counter)
        check(tree, text, counter)


@pytest.mark.parametrize("chunk,window", [(16, 8), (7, 64), (1, 1)])
def test_chunks_and_windows_do_not_matter(counter, monkeypatch, chunk, window):
    monkeypatch.setattr(tokens, "CHUNK", chunk)
    monkeypatch.setattr(tokens, "WINDOW", window)
    rnd = random.Random(chunk)
    for n in (0, 40, 600):
        text = some_text(rnd, n)
        body, (tree, _) = tokens.Body(text), tokens.build(text, counter)
        for _ in range(40):
            start, length = rnd.choice([0, len(text), rnd.randrange(len(text) + 1)]), rnd.choice([0, 1, 3, 50, 10**6 if rnd.random() < 0.1 else 2])
            insert = rnd.choice(["", "'", "r", "e", "'re", " ", "\n", some_text(rnd, rnd.choice([1, 30]))])
            tree, _ = tokens.edit_body(body, tree, start, length, insert, counter)
            text = text[:start] + insert + text[start + length :]
            assert str(body) == text and body.length == len(text)
            a, b = sorted(rnd.randrange(len(text) + 1) for _ in range(2))
            assert body.slice(a, b) == text[a:b]
            check(tree, text, counter)


def test_the_time_of_an_edit_does_not_follow_the_text(counter):
    seconds = {}
    for n in (100_000, 4_000_000):
        text = ("word another thing here " * (n // 24 + 1))[:n]
        body, (tree, _) = tokens.Body(text), tokens.build(text, counter)
        began = time.perf_counter()
        for k in range(200):
            tree, _ = tokens.edit_body(body, tree, n // 2 + k * 7, 5, "other words", counter)
        seconds[n] = time.perf_counter() - began
    assert seconds[4_000_000] < 5 * seconds[100_000] + 0.05


def test_small_edits_encode_little(counter):
    rnd = random.Random(3)
    text = " ".join(f"word{rnd.randrange(999)}" for _ in range(20_000))
    tree, _ = tokens.build(text, counter)
    for start in (0, 5000, len(text) // 2, len(text) - 3):
        new, tree, n = tokens.edit(text, tree, start, 5, "other words", counter)
        assert n <= 3 * tokens.LEAF
        check(tree, new, counter)
        text = new


def test_columns(spark, ranks, counter):
    rnd = random.Random(5)
    texts = [None, "", " ", "x"] + [some_text(rnd, n) for n in (5, 70, 300, 1000)] + ["word " * 60_000]
    rows = [(i, t, 1, "y") for i, t in enumerate(texts)] + [(5, texts[5], 1, "y")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, chars int, tokens string").repartition(3)
    docs = docs.withColumn("edits", tokens.sample_edits())
    got = tokens.apply_edits(tokens.with_trees(docs, ranks), ranks)
    assert got.columns == [*docs.columns, "tree", "edited"]
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        text = r.text or ""
        assert r.tree.n_tokens == full(counter, text) and r.tree.n_pretokens == len(counter.pattern.findall(text))
        for e in r.edits:
            s = min(e.start or 0, len(text))
            text = text[:s] + (e.insert or "") + text[s + e.length :]
        assert r.edited.text == text and r.edited.n_tokens == full(counter, text)
        check(tokens.Tree(r.edited.tree.n_leaves, np.array(r.edited.tree.chars), np.array(r.edited.tree.tokens)), text, counter)


def test_null_edits_and_empty_table(spark, ranks, counter):
    docs = spark.createDataFrame([(1, "a b c", None), (2, "a b c", [None, (None, None, None), (1, None, "zz")])], f"doc_id long, text string, edits {tokens.EDITS}")
    got = {r.doc_id: r.edited for r in tokens.apply_edits(tokens.with_trees(docs, ranks), ranks).collect()}
    assert got[1].text == "a b c" and got[1].n_encoded == 0 and got[2].text == "azz b c" and got[2].n_tokens == full(counter, "azz b c")
    empty = docs.where(F.lit(False))
    assert tokens.apply_edits(tokens.with_trees(empty, ranks), ranks).count() == 0

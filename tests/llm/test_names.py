"""Every operator that adds a column keeps a column of the table that has the
name already, and names its own with underscores in front."""

import pytest
from pyspark.sql import functions as F

from socialpages.llm import licenses, mixing, periods, pieces, quality, quotes, simhash, spotsigs, substring, tokens
from socialpages.llm.queries import PIECES_FILE, RANKS_FILE


@pytest.fixture(scope="module")
def ranks():
    return tokens.load_ranks(RANKS_FILE)


@pytest.fixture(scope="module")
def model():
    return pieces.load(PIECES_FILE)


def operators(ranks, model):
    return {
        "quality": lambda d: quality.judged(d),
        "licence": lambda d: licenses.scanned(d),
        "fingerprint": lambda d: simhash.with_fingerprint(d),
        "signatures": lambda d: spotsigs.fingerprints(d),
        "dedup": lambda d: substring.remove_repeats(d),
        "mix": lambda d: mixing.mixed(d, {"lang": 0.5}),
        "tree": lambda d: tokens.with_trees(d, ranks),
        "edited": lambda d: tokens.apply_edits(
            tokens.with_trees(d.withColumn("edits", tokens.sample_edits()), ranks), ranks
        ).drop("edits", "tree"),
        "pieces": lambda d: pieces.round_trip(d, model),
        "ids": lambda d: pieces.encode(d, model),
        "thread": lambda d: quotes.conversations(d, id_column="doc_id"),
        "periods": lambda d: periods.with_runs(d),
    }


@pytest.mark.parametrize("name", sorted(operators(None, None)))
def test_own_column_survives(spark, ranks, model, name):
    rows = [(1, "one two three", "en"), (2, None, None), (None, "", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn(name.upper(), F.lit("mine"))
    got = operators(ranks, model)[name](docs)
    assert got.columns == ["doc_id", "text", "lang", name.upper(), f"_{name}"]
    out = got.collect()
    assert len(out) == 3 and {r[name.upper()] for r in out} == {"mine"}
    plain = operators(ranks, model)[name](docs.drop(name.upper()))
    assert plain.columns == ["doc_id", "text", "lang", name]
    assert sorted(map(str, (r[f"_{name}"] for r in out))) == sorted(map(str, (r[name] for r in plain.collect())))

"""Every registered query over its whole table, against its DuckDB SQL or, where
SQL does not express it, against the brute-force versions of the other tests."""

import hashlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
import test_mixing
import test_pieces
import test_simhash
import test_spotsigs
import test_substring
import test_tokens
from socialpages.llm import mixing, queries, tokens

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "conversations"]
NAMES = [
    "op1_quotation_linking", "op2_simhash_near_dedup", "op3_spotsigs", "op4_quality_rules", "op5_license_scan",
    "op6_token_counts", "op7_warc_zstd", "op8_sentencepiece", "op9_mixing", "op10_substring_dedup",
    "op11_ngram_jaccard_join", "op12_periodic_runs", "op13_source_divergence", "spotsigs_near_duplicates", "pipeline",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("select doc_id, text from documents order by doc_id").fetchall()


def test_all_are_registered():
    assert sorted(queries.queries()) == sorted(NAMES)
    assert set(NAMES) <= set(E.queries()) and set(queries.oracle_sql()) <= set(E.oracle_sql())


def _rows(frame, columns):
    frame = frame[columns].astype(object)
    return sorted(map(tuple, frame.where(frame.notna(), None).values.tolist()), key=str)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, duck, name):
    got, want = queries.queries()[name](spark, SF).toPandas(), duck.execute(queries.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns) and _rows(got, columns) == _rows(want, columns)


def test_op2(spark, documents):
    got = queries.op2_simhash_near_dedup(spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == test_simhash.brute_groups(documents)
    assert got[0].__fields__ == ["doc_id", "fingerprint", "component_id"]


def test_op3(spark, documents):
    got = {r.doc_id: r for r in queries.op3_spotsigs(spark, SF).collect()}
    order = documents[::-1]
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        assert got[i].n_chars == len(t)
        s = test_spotsigs.brute_set(t)
        assert got[i].near_edited == test_spotsigs.jaccard(s, test_spotsigs.brute_set(t[: len(t) - half] + nxt[:half]))
        assert got[i].near_next == test_spotsigs.jaccard(s, test_spotsigs.brute_set(nxt))


def test_spotsigs_near_duplicates(spark, documents):
    got = {r.doc_id: r.class_id for r in queries.spotsigs_near_duplicates(spark, SF).collect()}
    sets = [(i, frozenset(test_spotsigs.brute_set(t))) for i, t in documents]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if len(a & b) >= 0.8 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    assert got == {i: find(i) for i, _ in sets}


def test_op10(spark, documents):
    got = sorted(map(tuple, queries.op10_substring_dedup(spark, SF).collect()), key=str)
    assert got == sorted((r[:4] for r in test_substring.brute(documents, 20)), key=str)


def test_op6(spark, documents):
    counter = tokens.Counter(tokens.load_ranks(queries.RANKS_FILE))
    got = {r.doc_id: r for r in queries.op6_token_counts(spark, SF).collect()}
    assert sorted(got) == [i for i, _ in documents]
    for i, text in documents:
        text = text or ""
        n, new = len(text), text
        for start, length, insert in ((n // 2, 16, text[:24]), (n * 3 // 4, 10, ""), (n + 64, 0, " the end")):
            start = min(start, len(new))
            new = new[:start] + insert + new[start + length :]
        r = got[i]
        assert (r.n_pretokens, r.n_tokens) == (len(counter.pattern.findall(text)), test_tokens.full(counter, text))
        assert (r.n_tokens_edited, r.edited_sha256) == (test_tokens.full(counter, new), hashlib.sha256(new.encode()).hexdigest())
        assert 0 < r.n_encoded <= 3 * 4 * tokens.LEAF + len(counter.pattern.findall(text[:24] + " the end"))


def test_op8(spark, documents):
    from sentencepiece import sentencepiece_model_pb2

    vocabulary = sentencepiece_model_pb2.ModelProto()
    with open(queries.PIECES_FILE, "rb") as f:
        vocabulary.ParseFromString(f.read())
    byte = {i for i, p in enumerate(vocabulary.pieces) if p.type == 6}
    got = {r.doc_id: r for r in queries.op8_sentencepiece(spark, SF).collect()}
    assert sorted(got) == [i for i, _ in documents]
    for i, text in documents:
        ids, r = test_pieces.brute(vocabulary, text or ""), got[i]
        assert (r.n_pieces, r.n_byte_pieces) == (len(ids), sum(x in byte for x in ids))
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()
        assert r.same and r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_op9(spark, duck):
    data = duck.execute("select doc_id, text, lang, source from documents").fetchall()
    got = {r.doc_id: r for r in queries.op9_mixing(spark, SF).collect()}
    cells, factor = test_mixing.brute(data, queries.MIX_TARGETS)
    cells = {c: t for c, t in cells.items() if t}
    total, scale = sum(cells.values()), 1 / max(factor[c] for c in cells)
    # the least share of the tokens to expect: solved by halving
    expected = lambda x: sum(t * min(1, factor[c] * x) for c, t in cells.items()) / total
    if expected(scale) < mixing.BUDGET:
        low, high = scale, scale * 1e6
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if expected(mid) < mixing.BUDGET else (low, mid)
        scale = high
    assert sorted(got) == sorted(r[0] for r in data)
    for i, text, lang, source in data:
        topic, n = test_mixing.topic_of(text)
        r = got[i]
        assert (r.topic, r.n_tokens, r.lang, r.source) == (topic, n, lang, source)
        if n:
            assert r.probability == pytest.approx(min(1.0, factor[(source, lang, topic)] * scale), rel=1e-5)
        u = test_mixing.draw(i, text, mixing.SEED)
        if abs(u - r.probability) > 1e-9:
            assert r.kept == (u < r.probability)


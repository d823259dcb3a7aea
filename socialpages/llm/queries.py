"""The registered queries: one thin query per operator, each over its whole
table, and the DuckDB SQL of those that SQL can express.

``queries()`` and ``oracle_sql()`` are merged into the driver's entry file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from socialpages.llm import divergence, periods, pieces, tokens
from socialpages.llm.common import table, words_sql
from socialpages.llm.licenses import TEMPLATES, THRESHOLD, scanned
from socialpages.llm.mixing import mixed
from socialpages.llm.ngram_join import jaccard_components
from socialpages.llm.quality import (
    COMMON_WORDS,
    LANGUAGES,
    MAX_DUP_LINES_PERCENT,
    MAX_ECHO_PERCENT,
    MAX_REPEAT_PERCENT,
    MAX_SYMBOLS_PERCENT,
    MAX_UPPER_PERCENT,
    MAX_WORD_CHARS,
    MIN_COMMON_WORDS_PERCENT,
    MIN_LETTER_WORDS_PERCENT,
    MIN_WORD_CHARS,
    MIN_WORDS,
    judged,
)
from socialpages.llm.quotes import as_replies, conversations
from socialpages.llm.simhash import simhash_groups
from socialpages.llm.spotsigs import edit_check, near_duplicates
from socialpages.llm.substring import remove_repeats
from socialpages.llm.warc import archived
from socialpages.plans.lineage import staged

# Where the public vocabulary files are (driver only: tasks get the vocabulary).
TOKENIZERS = "/opt/tokenizers"
PIECES_FILE = f"{TOKENIZERS}/piece_bpe_32k.model"
RANKS_FILE = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"

# Sources and topics nearer to each other than they are, languages as stated.
MIX_TARGETS = {
    "source": 0.7,
    "lang": {"en": 0.55, "de": 0.17, "fr": 0.15, "es": 0.13},
    "topic": 0.9,
}


def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    # read twice, for the links and for the texts: joined once
    replies, _ = staged(as_replies(turns).select("conv_id", "turn", "id", "message"))
    found = conversations(replies, text="message")
    return found.select(
        "conv_id",
        "turn",
        F.col("thread.parent.conv_id").alias("parent_conv"),
        F.col("thread.parent.turn").alias("parent_turn"),
        F.col("thread.root.conv_id").alias("root_conv"),
        F.col("thread.root.turn").alias("root_turn"),
        F.col("thread.level").cast("long").alias("level"),
        F.col("thread.n_quoted").alias("n_quoted"),
        F.col("thread.n_linked").alias("n_linked"),
        F.sha2("thread.own_text", 256).alias("own_sha256"),
    )


OP1_SQL = r"""
WITH RECURSIVE m AS (SELECT conv_id, turn, text FROM conversations),
u AS (
  SELECT conv_id, turn, n, h FROM (
    SELECT conv_id, turn, unnest(range(len(ps))) AS n,
           unnest(list_transform(ps, lambda p: trim(regexp_replace(lower(p), '[\x20\x09-\x0D]+', ' ', 'g')))) AS h
    FROM (SELECT conv_id, turn, string_split_regex(text, '\n *(?:\n *)+') AS ps FROM m))
  WHERE h <> ''),
o AS (SELECT h, min(struct_pack(c := conv_id, t := turn)) AS f FROM u GROUP BY h),
q AS (
  SELECT m.conv_id, m.turn, b.lvl, CASE WHEN f < struct_pack(c := m.conv_id, t := m.turn) THEN f END AS f
  FROM m, (VALUES (1), (2)) b(lvl), u, o
  WHERE u.conv_id = m.conv_id AND u.turn = m.turn - b.lvl AND o.h = u.h),
v AS (SELECT conv_id, turn, lvl, f, count(*) AS n FROM q GROUP BY ALL),
p AS (
  SELECT conv_id, turn, sum(n) AS n_quoted, sum(CASE WHEN f IS NOT NULL THEN n ELSE 0 END) AS n_linked,
         min(CASE WHEN f IS NOT NULL THEN struct_pack(l := lvl, k := -n, f := f) END).f AS f
  FROM v GROUP BY conv_id, turn),
tree AS (
  SELECT m.conv_id, m.turn, f FROM m LEFT JOIN p ON p.conv_id = m.conv_id AND p.turn = m.turn),
walk AS (
  SELECT conv_id, turn, conv_id AS rc, turn AS rt, 0 AS level FROM tree WHERE f IS NULL
  UNION ALL
  SELECT tree.conv_id, tree.turn, walk.rc, walk.rt, walk.level + 1 FROM tree, walk
  WHERE tree.f.c = walk.conv_id AND tree.f.t = walk.turn)
SELECT m.conv_id, m.turn, p.f.c AS parent_conv, p.f.t AS parent_turn, rc AS root_conv, rt AS root_turn,
       CAST(level AS BIGINT) AS level, CAST(coalesce(n_quoted, 0) AS BIGINT) AS n_quoted,
       CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked, sha256(coalesce(m.text, '')) AS own_sha256
FROM m JOIN walk USING (conv_id, turn) LEFT JOIN p USING (conv_id, turn)"""


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, distance=3)


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_check(table(spark, sf_dir, "documents").select("doc_id", "text"))


def spotsigs_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search of op3 over all documents: classes of texts with a coefficient of 0.8 or more."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), threshold=0.8)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judged(docs, lang="lang").select(
        "doc_id",
        *[f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")],
    )


OP4_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         coalesce(lower(string_split(replace(trim(lang), '_', '-'), '-')[1]) IN {LANGUAGES}, false) AS listed,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
v AS (
  SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, ws FROM d WHERE len(ws) >= 8),
g AS (SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS s FROM v),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM g) WHERE n > 1),
cov AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, i + unnest(range(0, 8)) AS p FROM r) GROUP BY doc_id),
c AS (
  SELECT d.doc_id, text, ws, listed, len(ls) AS n_lines,
         CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_echoes,
         len(regexp_extract_all(text, '\p{{Lu}}')) AS n_upper, len(regexp_extract_all(text, '\p{{Ll}}')) AS n_lower,
         len(list_filter(ws, lambda w: regexp_matches(w, '\p{{L}}'))) AS n_letter,
         len(list_filter(ws, lambda w: list_contains(string_split('{COMMON_WORDS}', ' '),
             lower(regexp_replace(w, '^[^\p{{L}}]+|[^\p{{L}}]+$', '', 'g'))))) AS n_common
  FROM d LEFT JOIN cov ON cov.doc_id = d.doc_id),
b AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
         OR 100 * n_symbols > {MAX_SYMBOLS_PERCENT} * n_words
         OR 100 * n_dup_lines > {MAX_DUP_LINES_PERCENT} * n_lines
         OR 100 * n_echoes > {MAX_ECHO_PERCENT} * n_words
         OR word_chars < {MIN_WORD_CHARS} * n_words OR word_chars > {MAX_WORD_CHARS} * n_words
         OR 100 * n_upper > {MAX_UPPER_PERCENT} * (n_upper + n_lower)
         OR 100 * n_letter < {MIN_LETTER_WORDS_PERCENT} * n_words
         OR (listed AND 100 * n_common < {MIN_COMMON_WORDS_PERCENT} * n_words)) AS kept
FROM b"""


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "licence.*")


_TEMPLATE_ROWS = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in TEMPLATES)

OP5_SQL = rf"""
WITH d AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS ws
  FROM documents),
g AS (SELECT doc_id, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) AS g FROM d),
tw AS (
  SELECT name, list_filter(string_split(regexp_replace(lower(x), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda y: y <> '') AS ws
  FROM (VALUES {_TEMPLATE_ROWS}) v(name, x)),
t AS (SELECT name, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS b FROM tw),
starts AS (
  SELECT doc_id, name, g, b, unnest(list_filter(range(1, len(g) + 1), lambda i: list_contains(b, g[i]))) AS s
  FROM g, t WHERE list_has_any(g, b)),
windows AS (SELECT doc_id, name, b, list_distinct(g[s:s + len(b) - 1]) AS w FROM starts),
hits AS (SELECT doc_id, name, 2.0::DOUBLE * len(list_intersect(w, b)) / (len(w) + len(b)) AS dice FROM windows),
best AS (
  SELECT doc_id, max(dice) AS dice, arg_min(name, struct_pack(d := -dice, x := name)) AS license, count(*) AS n,
         string_agg(DISTINCT name, ',' ORDER BY name) AS licenses
  FROM hits WHERE dice >= {THRESHOLD} GROUP BY doc_id)
SELECT d.doc_id, license, dice, coalesce(licenses, '') AS licenses, coalesce(n, 0)::BIGINT AS n_windows
FROM documents d LEFT JOIN best USING (doc_id)"""


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = tokens.load_ranks(RANKS_FILE)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("edits", tokens.sample_edits())
    edited = tokens.apply_edits(tokens.with_trees(docs, ranks), ranks)
    return edited.select(
        "doc_id",
        "tree.n_pretokens",
        "tree.n_tokens",
        F.col("edited.n_tokens").alias("n_tokens_edited"),
        F.col("edited.n_encoded").alias("n_encoded"),
        F.sha2("edited.text", 256).alias("edited_sha256"),
    )


def op7_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return archived(pages, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP7_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM f"""


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.round_trip(docs, pieces.load(PIECES_FILE)).select("doc_id", "pieces.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixed(docs, MIX_TARGETS).select("doc_id", "source", "lang", "mix.*")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, k=20, with_text=False).select("doc_id", "dedup.*")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(ws[i:i+19], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d WHERE len(ws) >= 20)),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM g) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, i + unnest(range(0, 20)) AS p FROM again)),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"), size=5)


OP11_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM d),
k AS (SELECT doc_id, sh, len(sh) AS n, CASE WHEN len(sh) > 0 THEN sha256(array_to_string(list_sort(sh), chr(10))) END AS same FROM s),
c AS (SELECT same, min(doc_id) AS node, any_value(n) AS n, arg_min(sh, doc_id) AS sh FROM k WHERE n > 0 GROUP BY same),
t AS (SELECT node, n, unnest(sh) AS t FROM c),
i AS (
  SELECT a.node AS a, b.node AS b, any_value(a.n + b.n) AS sizes, count(*) AS common
  FROM t a JOIN t b ON a.t = b.t AND a.node < b.node AND 10 * least(a.n, b.n) >= 8 * greatest(a.n, b.n) GROUP BY a.node, b.node),
l AS (SELECT a, b FROM i WHERE 100 * common >= 80 * (sizes - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT node AS a, node AS b FROM c UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT k.doc_id, CAST(k.n AS BIGINT) AS n_shingles, coalesce(comp.component_id, k.doc_id) AS component_id
FROM k LEFT JOIN c ON c.same = k.same LEFT JOIN comp ON comp.a = c.node"""


def planted_runs(text: str = "text", id_column: str = "doc_id"):
    """A tenth of the texts, by the CRC of the id, with their words made periodic from
    some word on; the others as they are."""
    words, h = words_sql(text), f"crc32(cast({id_column} as string))"
    start = f"cast(({h} div 10) % n as int)"
    period = f"cast(1 + (n - a) div (3 + ({h} div 10) % 8) as int)"
    made = f"""
      array_join(flatten(transform(array(({words})), w ->
        flatten(transform(array(size(w)), n ->
          flatten(transform(array({start}), a ->
            flatten(transform(array({period}), p ->
              transform(sequence(0, n - 1), i -> w[if(i < a, i, a + (i - a) % p)])))))))))
      , ' ')"""
    return F.expr(f"CASE WHEN {h} % 10 = 0 AND {text} RLIKE '[^\\\\x20\\\\x09-\\\\x0D]' THEN {made} ELSE {text} END")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted_runs().alias("text"))
    runs, best = "periods.runs", "array_max(transform(periods.runs, r -> struct(r.length, -r.start as start, -r.period as period)))"
    found = periods.with_runs(docs, min_length=12).select("doc_id", "periods", F.expr(best).alias("best"))
    lines = f"transform({runs}, r -> concat_ws(',', cast(r.start as string), cast(r.length as string), cast(r.period as string)) || '\\n')"
    return found.selectExpr(
        "doc_id",
        f"cast(size({runs}) as long) as n_runs",
        "-best.start as start",
        "best.length as length",
        "-best.period as period",
        "1000 * best.length div -best.period as exponent_milli",
        f"sha2(array_join({lines}, ''), 256) as runs_sha256",
        "sha2(coalesce(periods.collapsed, ''), 256) as collapsed_sha256",
    )


# A run's equal words, q apart, are at least six: pairs of equal six-word windows of a
# document, grouped by distance and unbroken stretch, are all candidates.
OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         xor(list_reduce(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT)),
             lambda c, b: list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
             4294967295), 4294967295) AS h
  FROM documents),
s AS (SELECT *, len(ws) AS n, h // 10 AS g, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM s),
t AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE ws END AS ws
  FROM p),
v AS (SELECT doc_id, n, ws, unnest(range(n - 5)) AS i FROM t WHERE n >= 12),
x AS (SELECT doc_id, n, i, array_to_string(ws[i + 1:i + 6], ' ') AS f FROM v),
y AS (
  SELECT a.doc_id, a.n, a.i, b.i - a.i AS q FROM x a JOIN x b ON b.doc_id = a.doc_id AND b.f = a.f AND b.i > a.i),
z AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS grp FROM y),
st AS (SELECT doc_id, q, min(i) AS start, count(*) + 5 + q AS length FROM z GROUP BY doc_id, q, grp),
r AS (
  SELECT doc_id, start, length, min(q) AS q FROM st WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM r),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(n)) AS i FROM t),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS c FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
best AS (
  SELECT doc_id, count(*) AS n_runs, arg_min(struct_pack(s := start, l := length, q := q), struct_pack(l := -length, s := start, q := q)) AS b,
         string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines
  FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(b.s AS BIGINT) AS start, CAST(b.l AS BIGINT) AS length,
       CAST(b.q AS BIGINT) AS period, CAST(1000 * b.l // b.q AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(c, '')) AS collapsed_sha256
FROM d LEFT JOIN best ON best.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id"""


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text", "lang", "source")
    return divergence.source_divergence(docs, min_docs=30, top=50)


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
w AS (SELECT id, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS whole FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
vo AS (SELECT lang, count(*)::HUGEINT AS v, sum(whole)::HUGEINT AS n FROM kept GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
tot AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM c GROUP BY ALL),
full_table AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(tot.n, 0) + 5 * vo.v) AS p,
         1 + (1000000000::HUGEINT * (kept.whole + 5)) // (vo.n + 5 * vo.v) AS q
  FROM g JOIN kept USING (lang) JOIN vo USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
  LEFT JOIN tot ON tot.lang = g.lang AND tot.source = g.source),
pv AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM full_table a JOIN full_table b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(pv.value, 0) AS value
  FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, p - q, row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, encode(term)) AS rank
  FROM full_table WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it uses this module's parameters

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "op1_quotation_linking": op1_quotation_linking,
        "op2_simhash_near_dedup": op2_simhash_near_dedup,
        "op3_spotsigs": op3_spotsigs,
        "spotsigs_near_duplicates": spotsigs_near_duplicates,
        "op4_quality_rules": op4_quality_rules,
        "op5_license_scan": op5_license_scan,
        "op6_token_counts": op6_token_counts,
        "op7_warc_zstd": op7_warc_zstd,
        "op8_sentencepiece": op8_sentencepiece,
        "op9_mixing": op9_mixing,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_ngram_jaccard_join": op11_ngram_jaccard_join,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_source_divergence": op13_source_divergence,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quotation_linking": OP1_SQL,
        "op4_quality_rules": OP4_SQL,
        "op5_license_scan": OP5_SQL,
        "op7_warc_zstd": OP7_SQL,
        "op10_substring_dedup": OP10_SQL,
        "op11_ngram_jaccard_join": OP11_SQL,
        "op12_periodic_runs": OP12_SQL,
        "op13_source_divergence": OP13_SQL,
    }

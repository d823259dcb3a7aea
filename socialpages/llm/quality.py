"""Quality rules as a short-circuit cascade.

Every rule is a cheap integer test on counts of one text.  A bounded sample
is judged by every rule, which gives each rule's cost per text and the share
of texts it rejects.  The rules then run in order of rejection per cost, and
a text that one rule rejects is not seen by the later ones.  The verdict is
"no rule rejects", so the order changes the work and never the result.

The base counts are computed for every text: they are output columns, and
several rules use them.

All rules but one hold for any language whose words are spaced.  The share of
common words is asked of the languages with a word list only (``LANGUAGES``:
English, German, French, Spanish), if the texts' language is known from a
column; texts of other languages, or of none given, are left to the others.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from socialpages.llm.common import Words, by_slices, fresh, split_words, text_slices
from socialpages.llm.substring import rolling

# Fixed values of the base counts.
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Fixed values of the rules: limits, and common words of four languages.
MAX_SYMBOLS_PERCENT = 10
MAX_DUP_LINES_PERCENT = 50
MAX_ECHO_PERCENT = 30
MIN_WORD_CHARS = 2
MAX_WORD_CHARS = 15
MAX_UPPER_PERCENT = 50
MIN_LETTER_WORDS_PERCENT = 70
MIN_COMMON_WORDS_PERCENT = 2
COMMON_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "auf das den der des die ein eine für ist mit nicht und von zu "
    "au avec ce dans de des du en est et la le les ou par pas pour que qui un une "
    "como con del el en es la las los no para por que se su un una y"
)
LANGUAGES = ("en", "eng", "de", "deu", "ger", "fr", "fra", "fre", "es", "spa")
SAMPLE_ROWS = 2000
SAMPLE_SEED = 11


def _per_text(words: Words, per_unique: np.ndarray) -> np.ndarray:
    """Sum over each text's words of a number known for each unique word."""
    total = np.concatenate([[0], np.cumsum(per_unique[words.codes])]) if len(words.codes) else np.zeros(1, np.int64)
    return total[words.offsets[1:]] - total[words.offsets[:-1]]


def _repeat_words(words: Words) -> np.ndarray:
    """Words in windows of ``REPEAT_WINDOW`` words found twice or more in their
    text.  Equal hashes are checked on the words."""
    codes, owner, k = words.codes, words.owner, REPEAT_WINDOW
    n = len(words.offsets) - 1
    if len(codes) < k:
        return np.zeros(n, np.int64)
    at = np.flatnonzero(owner[: len(owner) - k + 1] == owner[k - 1 :])
    draw = np.random.default_rng(0).integers(0, 2**64, len(words.unique), np.uint64)
    window = rolling(draw[codes], k)[at] ^ (owner[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    by = at[np.argsort(window, kind="stable")]
    window = np.sort(window)
    pair = np.flatnonzero(np.diff(window) == 0) if len(at) else np.zeros(0, np.int64)
    a, b = by[pair], by[pair + 1]
    same = owner[a] == owner[b]
    for j in range(k):
        same &= codes[a + j] == codes[b + j]
    found = np.unique(np.concatenate([a[same], b[same]]))
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, found, 1)
    np.add.at(cover, found + k, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    return covered[words.offsets[1:]] - covered[words.offsets[:-1]]


def _lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and how many of them equal an earlier one, per text."""
    lists = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), "\n")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    encoded = lists.flatten().dictionary_encode()
    full = pc.binary_length(pc.ascii_trim_whitespace(encoded.dictionary)).to_numpy(zero_copy_only=False) > 0
    codes = encoded.indices.to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    stay = full[codes] if len(codes) else np.zeros(0, bool)
    codes, owner = codes[stay], owner[stay]
    lines = np.bincount(owner, minlength=len(texts))
    distinct = np.unique(owner * (len(full) + 1) + codes) // (len(full) + 1)
    return lines, lines - np.bincount(distinct, minlength=len(texts))


class Counts:
    """Base counts of a batch of texts."""

    def __init__(self, texts: pa.Array):
        words = split_words(texts)
        unique = words.unique
        chars = pc.utf8_length(unique).to_numpy(zero_copy_only=False).astype(np.int64)
        symbols = sum(
            (pc.count_substring(unique, s).to_numpy(zero_copy_only=False).astype(np.int64) for s in SYMBOLS),
            np.zeros(len(unique), np.int64),
        )
        self.n_words = words.counts
        self.word_chars = _per_text(words, chars)
        self.n_symbols = _per_text(words, symbols)
        self.n_lines, self.n_dup_lines = _lines(texts)
        self.n_repeat_words = _repeat_words(words)
        self.base_failed = (self.n_words < MIN_WORDS) | (100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words)


@dataclass(frozen=True)
class Rule:
    """``rejects(texts, counts, rows)``: which of the given rows (positions in
    the batch; ``texts`` holds just these) the rule rejects."""

    name: str
    rejects: Callable[[pa.Array, Counts, np.ndarray], np.ndarray]


def _matches(texts: pa.Array, pattern: str) -> np.ndarray:
    return pc.count_substring_regex(pc.fill_null(texts, ""), pattern).to_numpy(zero_copy_only=False).astype(np.int64)


def _many_symbols(texts, c, rows):
    return 100 * c.n_symbols[rows] > MAX_SYMBOLS_PERCENT * c.n_words[rows]


def _many_dup_lines(texts, c, rows):
    return 100 * c.n_dup_lines[rows] > MAX_DUP_LINES_PERCENT * c.n_lines[rows]


def _many_echoes(texts, c, rows):
    """Words that equal the word just before them."""
    words = split_words(texts)
    again = np.zeros(len(words.codes), np.int64)
    again[1:] = (np.diff(words.codes) == 0) & (np.diff(words.owner) == 0)
    total = np.concatenate([[0], np.cumsum(again)])
    echoes = total[words.offsets[1:]] - total[words.offsets[:-1]]
    return 100 * echoes > MAX_ECHO_PERCENT * words.counts


def _odd_word_length(texts, c, rows):
    n = c.n_words[rows]
    return (c.word_chars[rows] < MIN_WORD_CHARS * n) | (c.word_chars[rows] > MAX_WORD_CHARS * n)


def _mostly_upper(texts, c, rows):
    upper, lower = _matches(texts, r"\p{Lu}"), _matches(texts, r"\p{Ll}")
    return 100 * upper > MAX_UPPER_PERCENT * (upper + lower)


def _few_letter_words(texts, c, rows):
    words = split_words(texts)
    lettered = pc.match_substring_regex(words.unique, r"\p{L}").to_numpy(zero_copy_only=False).astype(np.int64)
    return 100 * _per_text(words, lettered) < MIN_LETTER_WORDS_PERCENT * words.counts


def _few_common_words(texts, c, rows):
    words = split_words(texts)
    bare = pc.utf8_lower(pc.replace_substring_regex(words.unique, r"^[^\p{L}]+|[^\p{L}]+$", ""))
    common = pc.is_in(bare, pa.array(sorted(set(COMMON_WORDS.split())), bare.type)).to_numpy(zero_copy_only=False)
    return 100 * _per_text(words, common.astype(np.int64)) < MIN_COMMON_WORDS_PERCENT * words.counts


RULES = (
    Rule("many_symbols", _many_symbols),
    Rule("many_dup_lines", _many_dup_lines),
    Rule("many_echoes", _many_echoes),
    Rule("odd_word_length", _odd_word_length),
    Rule("mostly_upper", _mostly_upper),
    Rule("few_letter_words", _few_letter_words),
    Rule("few_common_words", _few_common_words),
)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text"):
            texts, counts = part.column(0), Counts(part.column(0))
            rows = np.flatnonzero(~counts.base_failed)
            judged, out = texts.take(pa.array(rows)), []
            for rule in RULES:
                began = time.perf_counter()
                rejected = int(rule.rejects(judged, counts, rows).sum())
                out.append((rule.name, time.perf_counter() - began, len(rows), rejected))
            yield pa.record_batch([pa.array(c) for c in zip(*out)], ["rule", "seconds", "n", "rejected"])


def estimate(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(rule, seconds, n, rejected)``: each rule's cost and rejections on a sample of
    all rows, ``sample_rows`` of them to be expected (one row for each rule).  Every
    task draws from its own rows, so no text is moved."""
    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = docs.select(F.col(text).alias("text")).sample(fraction=share, seed=SAMPLE_SEED)
    return (
        sample.mapInArrow(_measure, "rule string, seconds double, n long, rejected long")
        .groupBy("rule")
        .agg(*(F.sum(c).alias(c) for c in ("seconds", "n", "rejected")))
    )


def cascade_order(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by rejection per cost on the sample, highest first (an empty
    sample: as listed)."""
    measured = {r["rule"]: r for r in estimate(docs, text, sample_rows).collect()}  # one row for each rule

    def gain(rule):
        r = measured.get(rule.name)
        return -(r["rejected"] / max(r["seconds"], 1e-9)) if r else 0.0

    return [rule.name for rule in sorted(RULES, key=gain)]


VERDICT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, rejected_by string"


def _judge(texts: pa.Array, listed: pa.Array, order: list[str]) -> pa.StructArray:
    rules = {r.name: r for r in RULES}
    listed = listed.to_numpy(zero_copy_only=False).astype(bool)
    counts = Counts(texts)
    rows = np.flatnonzero(~counts.base_failed)
    by = np.full(len(texts), None, object)
    by[counts.base_failed] = "base"
    for name in order:
        if not len(rows):
            break
        rejected = rules[name].rejects(texts.take(pa.array(rows)), counts, rows)
        if name == "few_common_words":
            rejected &= listed[rows]
        by[rows[rejected]] = name
        rows = rows[~rejected]
    kept = np.zeros(len(texts), bool)
    kept[rows] = True
    columns = [getattr(counts, c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")]
    arrays = [pa.array(c) for c in columns] + [pa.array(kept), pa.array(by, pa.string())]
    return pa.StructArray.from_arrays(arrays, [f.split()[0] for f in VERDICT.split(", ")])


def _has_word_list(lang: str) -> Column:
    """Whether a language code ("en", "en-GB", "EN_us") has common words here (null: no)."""
    code = F.lower(F.substring_index(F.translate(F.trim(F.col(lang)), "_", "-"), "-", 1))
    return F.coalesce(code.isin(*LANGUAGES), F.lit(False))


def judged(
    docs: DataFrame, text: str = "text", out: str = "quality", order: list[str] | None = None, lang: str | None = None
) -> DataFrame:
    """``docs`` with a struct column ``out`` (with underscores in front where ``docs``
    has that name): the base counts, ``base_failed``,
    ``kept`` and ``rejected_by`` (the first rule of the cascade that rejects;
    it depends on the order, the rest does not).  ``lang`` names the column of
    language codes; without one the texts all count as of the listed languages.

    A null or empty text has no words and fails the base.  Every row stays,
    repeated ones too; an empty table gives no rows; other columns are carried.
    """
    order = cascade_order(docs, text) if order is None else order
    out = fresh(docs, out)

    def judge(texts: pa.Array, listed: pa.Array) -> pa.Array:
        return by_slices(lambda *part: _judge(*part, order), texts, listed)

    return docs.withColumn(out, F.arrow_udf(judge, VERDICT)(F.col(text), _has_word_list(lang) if lang else F.lit(True)))


def keep_good(docs: DataFrame, text: str = "text", lang: str | None = None) -> DataFrame:
    """The rows of ``docs`` that the cascade keeps, with the same columns."""
    out = fresh(docs, "_quality")
    return judged(docs, text, out, lang=lang).where(F.col(f"{out}.kept")).select(*docs.columns)

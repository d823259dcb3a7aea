"""Periodic run detection in the words of a text, by a dictionary of basic
factors.

A run is a maximal stretch of words with smallest period ``q`` (words ``q``
apart are equal) that is at least two periods and ``min_length`` words long.

1. Dictionary.  The factor of length ``L = 2^k`` at a word is named by the
   names of its two halves.  Names are per text, and only factors that a text
   has twice stay in the dictionary: it shrinks fast on prose and is empty
   after the longest repeat.
2. Progressions.  The occurrences of a factor that follow each other within
   ``L / 2`` are an arithmetic progression, its difference the factor's own
   smallest period (Fine and Wilf).  So within ``2 L`` of an occurrence there
   are at most three further progressions.
3. Proposals.  A run of period ``q``, ``L <= q < 2 L``, holds the factor at its
   start again ``q`` words on.  The two are in different progressions, or the
   factor's period would be the run's.  The differences between two
   progressions are again a progression; each difference is proposed once, by
   a member of one and the head of the other.  The proposals of a level are at
   most six for each occurrence.
4. Extension.  The names give how far a proposal goes on to the right and to the
   left: one comparison for each level, all proposals at once.  Proposals of
   the same stretch are one run; of several periods of a stretch the smallest
   counts.

Everything runs in tasks over slices of about ``SLICE_BYTES`` of text, arrays
of a few dozen bytes for each word; nothing is shuffled.  A text is never cut,
so one text needs memory for its own words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from socialpages.llm.common import as_bytes, fresh, split_words, text_slices

MIN_LENGTH = 12
SLICE_BYTES = 4 << 20
FOLLOWING = 3


class Factors:
    """The dictionary of the texts ``codes[offsets[i]:offsets[i + 1]]``: per
    level the words at which a repeated factor starts, and the factors' names."""

    def __init__(self, codes: np.ndarray, offsets: np.ndarray):
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        end = offsets[1:][owner]
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        at, key, length = np.arange(len(codes)), owner * (int(codes.max(initial=0)) + 1) + codes, 1
        while len(at):
            by = np.argsort(key, kind="stable")
            new = np.concatenate([[True], np.diff(key[by]) != 0])
            name = np.cumsum(new) - 1
            again = np.bincount(name)[name] > 1
            by, name = by[again], name[again]
            if not len(by):
                break
            # by name, then by place; and by place
            place = np.sort(by)
            by_place = np.empty(len(key), np.int64)
            by_place[by] = name
            names = by_place[place]
            self.levels.append((at[place], names, at[by]))
            at, names = at[place], names
            half = np.searchsorted(at, at + length)
            half[half == len(at)] = 0
            whole = (at[half] == at + length) & (at + 2 * length <= end[at])
            key = names[whole] * (int(names.max()) + 1) + names[half[whole]]
            at, length = at[whole], 2 * length

    def name(self, level: int, at: np.ndarray) -> np.ndarray:
        """Names of the factors at the given words, -1 for one that is not repeated."""
        places, names, _ = self.levels[level]
        i = np.searchsorted(places, at)
        i[i == len(places)] = 0
        return np.where(places[i] == at, names[i], -1)

    def _equal(self, level: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        name = self.name(level, x)
        return (name >= 0) & (name == self.name(level, y))

    def extent(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many words on from ``x`` and ``y``, and before them, are equal.
        No factor of twice the top level's length repeats, so each level is
        used at most once."""
        right, left = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        for level in reversed(range(len(self.levels))):
            right += self._equal(level, x + right, y + right).astype(np.int64) << level
            back = left + (1 << level)
            left += self._equal(level, x - back, y - back).astype(np.int64) << level
        return left, right

    def proposals(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Words and periods, each at least the level's length and less than twice it."""
        length = 1 << level
        names, order = self.levels[level][1:]
        # occurrences by name and place, in progressions
        places = self.levels[level][0]
        name = names[np.searchsorted(places, order)]
        follows = (np.diff(name) == 0) & (np.diff(order) <= length // 2)
        start = np.concatenate([[True], ~follows])
        chain = np.cumsum(start) - 1
        head, chain_name = order[start], name[start]
        found = []
        for step in range(1, FOLLOWING + 1):
            ahead = np.minimum(chain + step, len(head) - 1)
            period = head[ahead] - order
            fits = (chain + step < len(head)) & (chain_name[ahead] == name) & (period >= length) & (period < 2 * length)
            found.append((order[fits], period[fits]))
            behind = np.maximum(chain - step, 0)
            period = order - head[behind]
            fits = (chain >= step) & (chain_name[behind] == name) & (period >= length) & (period < 2 * length)
            found.append((head[behind][fits], period[fits]))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def find_runs(codes: np.ndarray, offsets: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, ...]:
    """Starts (in ``codes``), lengths and periods of the runs of every text, by
    start, then period."""
    factors = Factors(codes, offsets)
    found = []
    for level in range(len(factors.levels)):
        at, period = factors.proposals(level)
        left, right = factors.extent(at, at + period)
        equal = left + right
        good = (equal >= period) & (equal + period >= min_length)
        found.append(np.stack([(at - left)[good], (equal + period)[good], period[good]]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = np.concatenate(found, axis=1)
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    # of one stretch the smallest period, its multiples go
    first = np.concatenate([[True], (np.diff(start) != 0) | (np.diff(length) != 0)])[: len(start)]
    start, length, period = start[first], length[first], period[first]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


RUNS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
KIND = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _solve(texts: pa.Array, min_length: int) -> pa.StructArray:
    words = split_words(texts)
    offsets = words.offsets
    start, length, period = find_runs(words.codes, offsets, min_length)
    doc = np.searchsorted(offsets, start, side="right") - 1
    change = np.zeros(len(words.codes) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    keep = np.cumsum(change[:-1]) == 0
    n_runs = np.bincount(doc, minlength=len(texts))
    collapsed = []
    for i, (text, valid) in enumerate(zip(as_bytes(texts), texts.is_valid().to_pylist())):
        found = text.split()
        if n_runs[i]:
            found = [w for w, stays in zip(found, keep[offsets[i] : offsets[i + 1]].tolist()) if stays]
        collapsed.append(b" ".join(found) if valid else None)
    spans = pa.StructArray.from_arrays(
        [pa.array(start - offsets[doc]), pa.array(length), pa.array(period)], ["start", "length", "period"]
    )
    ends = np.concatenate([[0], np.cumsum(n_runs)]).astype(np.int32)
    return pa.StructArray.from_arrays(
        [
            pa.array(words.counts),
            pa.ListArray.from_arrays(pa.array(ends), spans),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ],
        ["n_words", "runs", "collapsed"],
    )


def with_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, out: str = "periods") -> DataFrame:
    """``docs`` with a struct column ``out`` (with underscores in front where ``docs`` has
    that name): ``n_words``, ``runs`` (start word,
    length and period of every run, by start, then period) and ``collapsed``:
    the text's words joined by one space, without the words that a run holds
    after its first period.

    A null or empty text has no words and no runs, and a null text stays null.
    Texts of any length are read whole.  Every row stays, repeated ones too.
    An empty table gives no rows.  Other columns are carried along.
    """
    out = fresh(docs, out)

    at = docs.columns.index(text)

    def solve(batches):
        for batch in batches:
            texts = pa.record_batch([batch.column(at)], ["text"])
            place = 0
            for part in text_slices(texts, "text", SLICE_BYTES):
                rows = batch.slice(place, part.num_rows)
                yield pa.RecordBatch.from_arrays([*rows.columns, _solve(part.column(0), min_length)], names=[*rows.schema.names, out])
                place += part.num_rows

    return docs.mapInArrow(solve, T.StructType([*docs.schema.fields, T.StructField(out, T.StructType.fromDDL(KIND))]))

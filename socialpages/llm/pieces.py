"""SentencePiece encoding and decoding: unigram Viterbi over a double-array
trie of pieces, byte fallback, white-space markers.

The vocabulary file is a parameter; its pieces and scores are used as they
are (scores as log probabilities).  A text gets a leading marker if the model
asks for one, its spaces become markers, and the pieces with the greatest sum
of scores are its encoding; of equal sums the one whose last piece is longer,
from the end of each unit.  A character without a piece costs the least score
less 10 and becomes its UTF-8 bytes.

No piece reaches over the start of a run of markers, nor over a character
that is in no piece.  So a text falls apart into units there, exactly, and the
best encoding of the text is that of its units.  Each distinct unit of a
slice of texts is solved once, all of them together: one step of the Viterbi
recursion extends every unit through the trie with vector operations.
"""

from __future__ import annotations

import hashlib
import math
import struct
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from socialpages.llm.common import fresh, text_slices

MARKER = "▁"
# Fixed values of the model file: piece types and field numbers.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
FIELD_PIECE, FIELD_NORMALIZER = 1, 3
FIELD_TEXT, FIELD_SCORE, FIELD_TYPE = 1, 2, 3
FIELD_CHARSMAP, FIELD_DUMMY_PREFIX, FIELD_EXTRA_SPACES = 2, 3, 4
UNKNOWN_PENALTY = 10.0

SLICE_BYTES = 2 << 20
# Units longer than this are solved one by one, in stretches of so many starts.
LONG_UNIT = 1024
STRETCH = 1 << 16
NOT_A_CHAR = 0x110000  # between texts
DRAW = 0x9E3779B97F4A7C15


def _fields(data: bytes):
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass
class Trie:
    """Double array over dense character codes: from ``state`` the character
    with code ``c`` leads to ``base[state] + c`` if ``check`` there is
    ``state``; ``piece`` is the id of the piece that ends there, or -1."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray


def build_trie(pieces: list[tuple[tuple[int, ...], int]]) -> Trie:
    """Trie of (codes, id); codes are at least 1.  Nodes with many children are
    placed first, each at the first base whose slots are all free."""
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for codes, number in pieces:
        node = 0
        for c in codes:
            node = children[node].setdefault(c, len(children))
            if node == len(children):
                children.append({})
                ends.append(-1)
        ends[node] = number
    most = 1 + max((max(c) for c in children if c), default=0)
    free = np.ones(2 * len(children) + 3 * most, bool)  # enough: the end of it fits any node
    free[0] = False
    where: dict[int, int] = {}
    inner = sorted((n for n in range(len(children)) if children[n]), key=lambda n: -len(children[n]))
    for node in (n for n in inner if len(children[n]) > 1):
        codes = np.fromiter(sorted(children[node]), np.int64)
        slots = np.flatnonzero(free)
        for start in range(0, len(slots), 1024):
            bases = slots[start : start + 1024] - codes[0]
            bases = bases[(bases >= 0) & (bases + most < len(free))]
            fits = np.flatnonzero(free[bases[:, None] + codes].all(axis=1))
            if len(fits):
                where[node] = at = int(bases[fits[0]])
                free[at + codes] = False
                break
    # a single child takes any free slot
    slots = iter(np.flatnonzero(free[most:]) + most)
    for node in inner:
        if node not in where:
            to = int(next(slots))
            where[node] = to - next(iter(children[node]))
            free[to] = False
    slot = {0: 0}
    grown = len(free)
    base, check, piece = np.zeros(grown, np.int64), np.full(grown, -1), np.full(grown, -1)
    for node, kids in enumerate(children):  # parents come before their children
        if node in where:
            state = slot[node]
            base[state] = where[node]
            for c, kid in kids.items():
                slot[kid] = to = where[node] + c
                check[to], piece[to] = state, ends[kid]
    return Trie(base, check, piece)


class Model:
    """A vocabulary with its trie; ``encode`` and ``decode`` work on Arrow arrays."""

    def __init__(self, data: bytes):
        pieces, self.dummy_prefix = [], True
        for number, value in _fields(data):
            if number == FIELD_PIECE:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[FIELD_SCORE])[0] if FIELD_SCORE in piece else 0.0
                pieces.append((piece[FIELD_TEXT].decode(), score, piece.get(FIELD_TYPE, NORMAL)))
            elif number == FIELD_NORMALIZER:
                rules = dict(_fields(value))
                self.dummy_prefix = bool(rules.get(FIELD_DUMMY_PREFIX, 1))
                if rules.get(FIELD_CHARSMAP) or rules.get(FIELD_EXTRA_SPACES, 1):
                    raise ValueError("only models with the identity normaliser are supported")
        usable = [(i, p, s) for i, (p, s, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED)]
        if any(MARKER in p.lstrip(MARKER) for _, p, _ in usable):
            raise ValueError("a piece has a marker after another character")
        self.bytes_id = np.full(256, -1, np.int32)
        for i, (p, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.bytes_id[int(p[1:-1], 16)] = i
        if (self.bytes_id < 0).any():
            raise ValueError("the model has no byte pieces")
        self.score = np.array([s for _, s, _ in pieces], np.float64)
        self.unknown = min(s for _, _, s in usable) - UNKNOWN_PENALTY
        letters = sorted({c for _, p, _ in usable for c in p})
        self.code = np.zeros(NOT_A_CHAR + 1, np.int32)  # 0: in no piece
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        codes = {c: i + 1 for i, c in enumerate(letters)}
        self.trie = build_trie([(tuple(codes[c] for c in p), i) for i, p, _ in usable])
        spelled = [
            bytes([int(p[1:-1], 16)]) if kind == BYTE else b"" if kind in (UNKNOWN, CONTROL) else p.replace(MARKER, " ").encode()
            for p, _, kind in pieces
        ]
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_at = np.concatenate([[0], np.cumsum([len(s) for s in spelled])])

    # -- encoding -----------------------------------------------------------

    def _units(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of the units of the concatenated texts."""
        marker = chars == ord(MARKER)
        alone = self.code[chars] == 0
        cut = np.ones(len(chars), bool)
        cut[1:] = (marker[1:] & ~marker[:-1]) | alone[1:] | alone[:-1]
        starts = np.flatnonzero(cut)
        return starts, np.diff(np.concatenate([starts, [len(chars)]]))

    @staticmethod
    def _distinct(chars, starts, lengths):
        """One unit for each distinct one, and which of them each unit is."""
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(len(chars), DRAW, np.uint64))
            inverse = np.cumprod(np.full(len(chars), pow(DRAW, -1, 2**64), np.uint64))
            value = (chars.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
            value ^= value >> np.uint64(32)
            value *= np.uint64(0xBF58476D1CE4E5B9)
            total = np.concatenate([[np.uint64(0)], np.cumsum(value * inverse)])
            key = (total[starts + lengths] - total[starts]) * powers[starts] + lengths.astype(np.uint64)
        _, one, which = np.unique(key, return_index=True, return_inverse=True)
        # equal keys must be equal units; any that are not stand for themselves
        other = one[which]
        bad = lengths[other] != lengths
        span = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        reach = np.minimum(np.repeat(starts[other], lengths) + span, len(chars) - 1)
        differs = chars[np.repeat(starts, lengths) + span] != chars[reach]
        bad |= np.add.reduceat(differs, np.cumsum(lengths) - lengths) > 0
        extra = np.flatnonzero(bad)
        which[extra] = len(one) + np.arange(len(extra))
        return np.concatenate([one, extra]), which

    def _solve(self, codes, starts, lengths):
        """Viterbi over all units at once.  Returns, for each place of the
        units laid end to end (``lengths + 1`` places each), the start of the
        best last piece and its id (-1: a character without a piece)."""
        trie, n = self.trie, len(starts)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        place = np.cumsum(lengths + 1) - (lengths + 1)
        best = np.full(int((lengths + 1).sum()), -np.inf)
        back = np.zeros(len(best), np.int64)
        last = np.full(len(best), -1, np.int64)
        best[place] = 0.0
        long = int(np.searchsorted(-lengths, -LONG_UNIT, side="left"))
        for unit in range(long):
            mine = slice(int(place[unit]), int(place[unit] + lengths[unit] + 1))
            back[mine], last[mine] = self._solve_long(codes[starts[unit] : starts[unit] + lengths[unit]])
        for s in range(int(lengths[long]) if long < n else 0):
            live = np.arange(long, np.searchsorted(-lengths, -s, side="left"))  # longer than s
            here = best[place[live] + s]
            single = np.zeros(len(live), bool)
            state = np.zeros(len(live), np.int64)
            j = 0
            while len(live):
                live_codes = codes[starts[live] + s + j]
                to = trie.base[state] + live_codes
                step = (trie.check[to] == state) & (live_codes > 0)
                if j == 0:
                    first, unknown_from = step, live
                live, state, here = live[step], to[step], here[step]
                number = trie.piece[state]
                end = number >= 0
                if j == 0:
                    single[np.flatnonzero(first)[end]] = True
                    lone = unknown_from[~single]
                    target = place[lone] + s + 1
                    value = best[place[lone] + s] + self.unknown
                    better = value > best[target]
                    best[target[better]], back[target[better]], last[target[better]] = value[better], s, -1
                target = place[live[end]] + s + j + 1
                value = here[end] + self.score[number[end]]
                better = value > best[target]
                target = target[better]
                best[target], back[target], last[target] = value[better], s, number[end][better]
                j += 1
                on = lengths[live] > s + j
                live, state, here = live[on], state[on], here[on]
        return order, place, back, last

    def _matches(self, codes, first, stop):
        """Pieces that start from ``first`` to before ``stop``: starts, lengths and ids, by
        start, then length.  All starts go down the trie together."""
        trie, found = self.trie, []
        live, state, j = np.arange(first, stop), np.zeros(stop - first, np.int64), 0
        while len(live):
            live_codes = codes[live + j]
            to = trie.base[state] + live_codes
            step = (trie.check[to] == state) & (live_codes > 0)
            live, state, j = live[step], to[step], j + 1
            number = trie.piece[state]
            end = number >= 0
            found.append((live[end], np.full(int(end.sum()), j), number[end]))
            on = live + j < len(codes)
            live, state = live[on], state[on]
        start, length, number = (np.concatenate([f[i] for f in found]) for i in range(3))
        by = np.lexsort((length, start))
        return start[by], length[by], number[by]

    def _solve_long(self, codes):
        """Viterbi over one long unit: the matches of a stretch of starts at a time, then
        one plain pass over them.  Same results, in the same order, as for short units."""
        n = len(codes)
        best, back, last = array("d", [-math.inf]) * (n + 1), array("q", [0]) * (n + 1), array("q", [-1]) * (n + 1)
        best[0] = 0.0
        for first in range(0, n, STRETCH):
            stop = min(first + STRETCH, n)
            start, length, number = self._matches(codes, first, stop)
            counts = np.bincount(start - first, minlength=stop - first).tolist()
            lone = np.ones(stop - first, bool)
            lone[start[length == 1] - first] = False
            ends, scores, number = (start + length).tolist(), self.score[number].tolist(), number.tolist()
            at = 0
            for s, count, alone in zip(range(first, stop), counts, lone.tolist()):
                here = best[s]
                if alone and here + self.unknown > best[s + 1]:
                    best[s + 1], back[s + 1], last[s + 1] = here + self.unknown, s, -1
                for m in range(at, at + count):
                    end = ends[m]
                    value = here + scores[m]
                    if value > best[end]:
                        best[end], back[end], last[end] = value, s, number[m]
                at += count
        return np.frombuffer(back, np.int64), np.frombuffer(last, np.int64)

    @staticmethod
    def _trace_long(back: np.ndarray) -> np.ndarray:
        """The places at which the pieces of one unit end, from the last one on."""
        steps, places, at = back.tolist(), array("q"), len(back) - 1
        while at > 0:
            places.append(at)
            at = steps[at]
        return np.frombuffer(places, np.int64) if places else np.zeros(0, np.int64)

    def _encode_units(self, chars, starts, lengths):
        """Ids of every unit: flat ids and offsets."""
        order, place, back, last = self._solve(self.code[chars], starts, lengths)
        long = int((lengths > LONG_UNIT).sum())
        at, unit, owner, number, char = lengths[order].copy(), np.arange(long, len(order)), [], [], []
        at = at[long:]
        traced = []
        for u in range(long):
            mine = slice(int(place[u]), int(place[u] + lengths[order[u]] + 1))
            ends = self._trace_long(back[mine])
            traced.append((np.full(len(ends), u), last[mine][ends], chars[starts[order[u]] + back[mine][ends]], np.arange(len(ends))))
        while len(unit):
            here = place[unit] + at
            owner.append(unit)
            number.append(last[here])
            at = back[here]
            char.append(chars[starts[order[unit]] + at])
            on = at > 0
            unit, at = unit[on], at[on]
        if not owner and not traced:
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        steps = np.concatenate([np.repeat(np.arange(len(owner)), [len(o) for o in owner]), *[t[3] for t in traced]]).astype(np.int64)
        owner = order[np.concatenate([*owner, *[t[0] for t in traced]])]
        number = np.concatenate([*number, *[t[1] for t in traced]])
        char = np.concatenate([*char, *[t[2] for t in traced]])
        by = np.lexsort((-steps, owner))
        owner, number, char = owner[by], number[by], char[by]
        # characters without a piece become their UTF-8 bytes
        none = np.flatnonzero(number < 0)
        size = np.ones(len(number), np.int64)
        size[none] = 1 + (char[none] >= 0x80) + (char[none] >= 0x800) + (char[none] >= 0x10000)
        offsets = np.concatenate([[0], np.cumsum(size)])
        ids = np.zeros(offsets[-1], np.int32)
        known = number >= 0
        ids[offsets[:-1][known]] = number[known]
        for width in range(1, 5):
            rows = none[size[none] == width]
            point = char[rows].astype(np.int64)
            for b in range(width):
                shift = 6 * (width - 1 - b)
                if width == 1:
                    byte = point
                elif b == 0:
                    byte = (0xF00 >> width) & 0xFF | (point >> shift)
                else:
                    byte = 0x80 | ((point >> shift) & 0x3F)
                ids[offsets[rows] + b] = self.bytes_id[byte]
        per_unit = np.zeros(len(starts), np.int64)
        np.add.at(per_unit, owner, size)
        return ids, np.concatenate([[0], np.cumsum(per_unit)])

    def _encode_slice(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        shaped = [(MARKER * self.dummy_prefix + t.replace(" ", MARKER)) if t else "" for t in texts]
        lens = np.array([len(t) for t in shaped], np.int64)
        chars = np.frombuffer("".join(shaped).encode("utf-32-le"), np.int32)
        if not len(chars):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        starts, lengths = self._units(chars)
        heads = np.unique(np.concatenate([starts, (np.cumsum(lens) - lens)[lens > 0]]))
        starts, lengths = heads, np.diff(np.concatenate([heads, [len(chars)]]))
        one, which = self._distinct(chars, starts, lengths)
        ids, at = self._encode_units(chars, starts[one], lengths[one])
        size = np.diff(at)[which]
        ends = np.concatenate([[0], np.cumsum(size)])
        flat = ids[np.repeat(at[:-1][which] - ends[:-1], size) + np.arange(ends[-1])]
        return flat, ends[np.searchsorted(starts, np.concatenate([[0], np.cumsum(lens)]))]

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids of each text (null: null; empty: no ids)."""
        parts = []
        for part in text_slices(pa.record_batch([texts.cast(pa.string())], ["t"]), "t", SLICE_BYTES):
            column = part.column(0)
            flat, offsets = self._encode_slice([t or "" for t in column.to_pylist()])
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat, pa.int32()))
            parts.append(pc.if_else(column.is_valid(), lists, pa.scalar(None, lists.type)) if column.null_count else lists)
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    # -- decoding -----------------------------------------------------------

    def decode(self, ids: pa.Array) -> pa.Array:
        """Text of each list of ids (null: null).  Byte pieces are joined and
        read as UTF-8; what is none becomes U+FFFD.  Unknown and control
        pieces, null ids and ids outside the vocabulary give nothing."""
        size = np.diff(self.spelled_at)
        out = []
        for row in ids:
            if not row.is_valid:
                out.append(None)
                continue
            n = row.values.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            n = n[(n >= 0) & (n < len(size))]
            width = size[n]
            ends = np.cumsum(width)
            total = int(ends[-1]) if len(ends) else 0
            data = self.spelled[np.repeat(self.spelled_at[n] - (ends - width), width) + np.arange(total)].tobytes()
            if self.dummy_prefix and data[:1] == b" ":
                data = data[1:]
            out.append(data.decode("utf-8", "replace"))
        return pa.array(out, pa.string())


def load(path: str) -> Model:
    """The model of a vocabulary file on the driver; tasks get it by value."""
    with open(path, "rb") as f:
        return Model(f.read())


def encode(docs: DataFrame, model: Model, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with an array<int> column ``out`` of piece ids (null text: null, empty
    text: empty; underscores in front of the name where ``docs`` has it).  Every row stays; other columns are carried along."""

    def ids(texts: pa.Array) -> pa.Array:
        return model.encode(texts)

    return docs.withColumn(fresh(docs, out), F.arrow_udf(ids, "array<int>")(F.col(text)))


def decode(rows: DataFrame, model: Model, ids: str = "ids", out: str = "text") -> DataFrame:
    """``rows`` with the text of a column of piece ids (null: null), as ``out``; a column
    of that name is replaced, as the text that the ids were made of."""

    def texts(column: pa.Array) -> pa.Array:
        return model.decode(column)

    return rows.withColumn(out, F.arrow_udf(texts, "string")(F.col(ids)))


ROUND_TRIP = "n_pieces long, n_byte_pieces long, ids_sha256 string, decoded_sha256 string, same boolean"


def round_trip(docs: DataFrame, model: Model, text: str = "text", out: str = "pieces", with_ids: bool = False) -> DataFrame:
    """``docs`` with a struct column ``out`` (with underscores in front where ``docs`` has
    that name): number of pieces and of byte pieces,
    SHA-256 of the ids (little-endian 32-bit) and of the decoded text, whether
    that equals the text, and, ``with_ids``, the ids.  A null text counts as
    empty."""

    kind = ROUND_TRIP + ", ids array<int>" * with_ids

    def both(texts: pa.Array) -> pa.Array:
        texts = pc.fill_null(texts, "")
        lists = model.encode(texts)
        decoded = model.decode(lists)
        offsets, flat = lists.offsets.to_numpy(), lists.flatten().to_numpy()
        offsets = offsets - offsets[0]
        is_byte = np.zeros(len(model.score), np.int64)
        is_byte[model.bytes_id] = 1
        total = np.concatenate([[0], np.cumsum(is_byte[flat])])
        return pa.StructArray.from_arrays(
            [
                pa.array(np.diff(offsets).astype(np.int64)),
                pa.array(total[offsets[1:]] - total[offsets[:-1]]),
                pa.array([hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])], pa.string()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded.to_pylist()], pa.string()),
                pc.equal(texts, decoded),
                *[lists] * with_ids,
            ],
            [f.split()[0] for f in kind.split(", ")],
        )

    return docs.withColumn(fresh(docs, out), F.arrow_udf(both, kind)(F.col(text)))

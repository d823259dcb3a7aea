"""Edit-aware token counts.

A text is cut into pre-tokens by the vocabulary's pattern; its token count is
the sum of theirs.  A document keeps a segment tree whose leaves hold the
characters and tokens of ``LEAF`` pre-tokens each, and whose inner nodes hold
the sums of their children.

An edit re-encodes only what it can change.  The pattern looks ahead by two
characters at most and never back, so pre-tokens that end ``CONTEXT`` or more
characters before the edit stay, and once a new pre-token starts where an old
leaf started behind the edit, all the rest stays too.  The leaves between are
encoded anew and the sums above them updated; only if there are more leaves
than before the tree is laid out again, from leaf sums, without encoding.  The
text itself is held in chunks while it is edited, and the pattern runs over a
window behind the edit, so an edit's time does not follow the text's length.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from socialpages.llm.common import by_slices, fresh

LEAF = 64
CONTEXT = 4
CHUNK = 1 << 15
WINDOW = 1 << 10
CACHE = 1 << 18  # pre-tokens whose counts a task remembers

# Fixed value: the pattern that goes with the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Counter(dict):
    """Tokens of a pre-token, remembered."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.encoding = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        # the library's white space is the Unicode property
        space = PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.pattern = regex.compile(space)

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[piece] = n = len(self.encoding.encode_ordinary(piece))
        return n


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file (base64 token and rank a line); read on the driver."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _halved(sums: np.ndarray) -> np.ndarray:
    return sums[0::2] + sums[1::2]


@dataclass
class Tree:
    """Heap layout: node ``i`` has the children ``2 i`` and ``2 i + 1``, the
    root is 1, leaf ``j`` is ``size + j``; ``n`` leaves are in use."""

    n: int
    chars: np.ndarray
    tokens: np.ndarray

    @property
    def size(self) -> int:
        return len(self.chars) // 2

    @classmethod
    def of_leaves(cls, chars: np.ndarray, tokens: np.ndarray) -> Tree:
        n = len(chars)
        size = 1 << max(0, n - 1).bit_length()
        columns = []
        for leaves in (chars, tokens):
            level = np.zeros(size, np.int64)
            level[:n] = leaves
            levels = [level]
            while len(levels[-1]) > 1:
                levels.append(_halved(levels[-1]))
            columns.append(np.concatenate([[0], *levels[::-1]]))
        return cls(n, *columns)

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        return self.chars[self.size : self.size + self.n], self.tokens[self.size : self.size + self.n]

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and its first character (descends
        from the root; behind the end: the last leaf)."""
        node, start = 1, 0
        while node < self.size:
            left = int(self.chars[2 * node])
            if place < start + left:
                node = 2 * node
            else:
                node, start = 2 * node + 1, start + left
        leaf = node - self.size
        if leaf >= self.n:
            leaf = self.n - 1
            start = int(self.chars[1] - self.chars[self.size + leaf])
        return leaf, start

    def replace(self, a: int, b: int, chars: np.ndarray, tokens: np.ndarray) -> Tree:
        """The tree with the leaves from ``a`` to before ``b`` replaced."""
        if len(chars) > b - a:
            old = self.leaves()
            return Tree.of_leaves(*(np.concatenate([o[:a], new, o[b:]]) for o, new in zip(old, (chars, tokens))))
        for sums, new in ((self.chars, chars), (self.tokens, tokens)):
            sums[self.size + a : self.size + b] = np.pad(new, (0, b - a - len(new)))
        low, high = self.size + a, self.size + b - 1
        while low > 1:  # the nodes above, level by level
            low, high = low // 2, high // 2
            for sums in (self.chars, self.tokens):
                sums[low : high + 1] = _halved(sums[2 * low : 2 * high + 2])
        return self


def _leaf_sums(lengths: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(0, len(lengths), LEAF)
    return np.add.reduceat(lengths, at), np.add.reduceat(counts, at)


def build(text: str, counter: Counter) -> tuple[Tree, int]:
    """The tree of a text and its number of pre-tokens."""
    pieces = counter.pattern.findall(text)
    if not pieces:
        return Tree.of_leaves(np.zeros(1, np.int64), np.zeros(1, np.int64)), 0
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    counts = np.fromiter(map(counter.__getitem__, pieces), np.int64, len(pieces))
    return Tree.of_leaves(*_leaf_sums(lengths, counts)), len(pieces)


class Body:
    """A text in chunks, so that an edit moves the chunks it touches only."""

    def __init__(self, text: str):
        self.chunks = [text[i : i + CHUNK] for i in range(0, len(text), CHUNK)]
        self.length = len(text)

    def __str__(self) -> str:
        return "".join(self.chunks)

    def _at(self, place: int) -> tuple[int, int]:
        """Number and start of the chunk that a place is in (at the end: the last)."""
        start = 0
        for i, chunk in enumerate(self.chunks):
            if place < start + len(chunk):
                return i, start
            start += len(chunk)
        return (len(self.chunks) - 1, start - len(self.chunks[-1])) if self.chunks else (0, 0)

    def slice(self, start: int, stop: int) -> str:
        i, begin = self._at(start)
        parts = []
        for chunk in self.chunks[i:]:
            if begin >= stop:
                break
            parts.append(chunk[max(0, start - begin) : stop - begin])
            begin += len(chunk)
        return "".join(parts)

    def replace(self, start: int, stop: int, insert: str) -> None:
        (i, begin), (j, end) = self._at(start), self._at(stop)
        held = [self.chunks[i][: start - begin] if self.chunks else "", insert, self.chunks[j][stop - end :] if self.chunks else ""]
        new = "".join(held)
        step = CHUNK if len(new) > 2 * CHUNK else max(1, len(new))
        self.chunks[i : j + 1] = [new[k : k + step] for k in range(0, len(new), step)]
        self.length += len(insert) - (stop - start)


def edit_body(body: Body, tree: Tree, start: int, length: int, insert: str, counter: Counter) -> tuple[Tree, int]:
    """Replace ``length`` characters from ``start`` (both cut to the text) in place.
    Returns the new tree and how many pre-tokens were encoded."""
    start = min(max(start, 0), body.length)
    stop = min(start + max(length, 0), body.length)
    first, begin = tree.leaf_at(max(0, start - CONTEXT))
    chars, _ = tree.leaves()
    # the next old leaf behind the edit, where old and new may meet again, and
    # its place in the new text; only leaves that the new pieces reach are passed
    meet, goal = first, begin
    while meet < tree.n and goal < stop:
        goal += int(chars[meet])
        meet += 1
    goal += len(insert) - (stop - start)
    body.replace(start, stop, insert)
    pieces, last, at, reach = [], tree.n, begin, len(insert) + WINDOW
    met = meet < tree.n and goal == begin
    while not met and at < body.length:
        window = body.slice(at, at + reach)
        whole, from_here = at + len(window) >= body.length, at
        for m in counter.pattern.finditer(window):
            if not whole and m.end() + CONTEXT > len(window):
                break  # what follows may change it
            pieces.append(m.group())
            at = from_here + m.end()
            while meet < tree.n and goal < at:
                goal += int(chars[meet])
                meet += 1
            met = meet < tree.n and goal == at
            if met:
                break
        reach *= 2
    if met:
        last = meet
    if not pieces:
        none = np.zeros(0, np.int64)
        return tree.replace(first, last, none, none) if last > first else tree, 0
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    counts = np.fromiter(map(counter.__getitem__, pieces), np.int64, len(pieces))
    return tree.replace(first, last, *_leaf_sums(lengths, counts)), len(pieces)


def edit(text: str, tree: Tree, start: int, length: int, insert: str, counter: Counter) -> tuple[str, Tree, int]:
    """``edit_body`` of a plain text: the new text, its tree and how many pre-tokens
    were encoded."""
    body = Body(text)
    tree, n = edit_body(body, tree, start, length, insert, counter)
    return str(body), tree, n


TREE = "struct<n_leaves:int,chars:array<bigint>,tokens:array<bigint>>"
TREE_ARROW = pa.struct([("n_leaves", pa.int32()), ("chars", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))])
EDITS = "array<struct<start:bigint,length:bigint,insert:string>>"


def _tree_row(t: Tree) -> dict:
    return {"n_leaves": t.n, "chars": t.chars, "tokens": t.tokens}


def with_trees(docs: DataFrame, ranks: dict[bytes, int], text: str = "text", out: str = "tree") -> DataFrame:
    """``docs`` with a struct column ``out`` (with underscores in front where ``docs`` has
    that name): ``n_tokens``, ``n_pretokens`` and
    ``tree`` (number of leaves, heap arrays of character and token sums).

    A null or empty text has no tokens and one empty leaf.  Every row stays;
    other columns are carried along; an empty table gives no rows.
    """

    def some(texts: pa.Array, counter: Counter) -> pa.Array:
        built = [build(t or "", counter) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [
                pa.array([int(t.tokens[1]) for t, _ in built], pa.int64()),
                pa.array([n for _, n in built], pa.int64()),
                pa.array([_tree_row(t) for t, _ in built], TREE_ARROW),
            ],
            ["n_tokens", "n_pretokens", "tree"],
        )

    def trees(texts: pa.Array) -> pa.Array:
        counter = Counter(ranks)
        return by_slices(lambda part: some(part, counter), texts)

    kind = f"n_tokens long, n_pretokens long, tree {TREE}"
    return docs.withColumn(fresh(docs, out), F.arrow_udf(trees, kind)(F.col(text)))


def apply_edits(
    rows: DataFrame, ranks: dict[bytes, int], edits: str = "edits", text: str = "text", tree: str = "tree.tree", out: str = "edited"
) -> DataFrame:
    """``rows`` with a struct column ``out`` (with underscores in front where ``rows`` has
    that name) after their edits: ``text``,
    ``tree``, ``n_tokens`` and ``n_encoded`` (pre-tokens encoded anew).

    ``edits`` is an array of (start, length, insert), in code points, each made
    on the outcome of the one before.  Starts and lengths are cut to the text;
    a null edit, or a null array, changes nothing; a null insert is empty.
    """

    def some(texts: pa.Array, trees: pa.Array, edits: pa.Array, counter: Counter) -> pa.Array:
        out = []
        for text, held, todo in zip(texts.to_pylist(), trees, edits.to_pylist()):
            body, encoded = Body(text or ""), 0
            chars, tokens = (held[c].values.to_numpy(zero_copy_only=False).copy() for c in ("chars", "tokens"))
            t = Tree(held["n_leaves"].as_py(), chars, tokens)
            for e in todo or ():
                if e is not None:
                    t, n = edit_body(body, t, e["start"] or 0, e["length"] or 0, e["insert"] or "", counter)
                    encoded += n
            out.append((str(body), _tree_row(t), int(t.tokens[1]), encoded))
        kinds = (pa.string(), TREE_ARROW, pa.int64(), pa.int64())
        columns = list(zip(*out)) or [()] * 4
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["text", "tree", "n_tokens", "n_encoded"])

    def apply(texts: pa.Array, trees: pa.Array, edits: pa.Array) -> pa.Array:
        counter = Counter(ranks)
        return by_slices(lambda *part: some(*part, counter), texts, trees, edits)

    kind = f"text string, tree {TREE}, n_tokens long, n_encoded long"
    return rows.withColumn(fresh(rows, out), F.arrow_udf(apply, kind)(F.col(text), F.col(tree), F.col(edits)))


def sample_edits(text: str = "text") -> Column:
    """Three edits made of the text itself: its first 24 characters over 16 in
    the middle, ten characters less at three quarters, two words at the end."""
    n = f"char_length({text})"
    return F.expr(
        f"cast(array(named_struct('start', {n} div 2, 'length', 16, 'insert', substring({text}, 1, 24)), "
        f"named_struct('start', {n} * 3 div 4, 'length', 10, 'insert', ''), "
        f"named_struct('start', {n} + 64, 'length', 0, 'insert', ' the end')) as {EDITS})"
    )

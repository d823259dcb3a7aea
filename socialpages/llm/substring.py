"""Substring dedup: words covered by a k-word window that starts earlier
elsewhere are removed (De Bruijn compaction).

The k-word windows are the edges of a De Bruijn graph over (k-1)-word nodes.

1. Edges.  Each slice of texts hashes its windows (vectorised) and drops, by
   comparing the words themselves, every window that repeats an earlier one
   of the same slice; those are already known to be repeats.  So a window
   that a third of the corpus holds leaves a slice once.
2. Minimiser partitioning.  Consecutive windows with the same least m-gram
   hash travel as one record (a super-k-mer) to the bucket of that m-gram, so
   equal windows meet and neighbours stay together.  In its bucket a window
   that also starts earlier becomes a repeated edge with the coordinates of
   the first start.  A bucket with more than ``most`` windows, such as that of
   a line which a third of the corpus holds, is dealt out again by the hash of
   the window itself, so no task holds more than that and its share of the rest.
   Windows match on a 56-bit window hash and 32 further bits of their least
   m-gram.
3. Compaction.  A repeated edge and the next one form one path where the
   source takes the same step.  Pieces of paths that were cut by bucket
   borders are joined end to start (Spark equality joins) into maximal paths,
   with the coordinates of the span and of its source.
4. Removal.  The paths of a document are joined to its text, the covered
   words go.

Within a slice repeats are compared word by word.  Between slices they rest on
the 88 bits; the two coordinates of a long span run in parallel, so each of its
windows would have to match by chance at the right place.

"Earlier" means a smaller id, or an earlier start in the same document.  Ids are
integers.  A row is known by its id and a 64-bit hash of its text: rows with one
id count as one document if their texts agree; with different texts they are
ordered by that hash.  A null id is smaller than any other.  A null or empty
text has no words.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from socialpages.llm.common import as_bytes, fresh, shuffle_partitions, split_words, text_slices
from socialpages.plans.lineage import discard, staged

WINDOW = 20
ANCHOR = 4
HASH_BYTES = 7
SLICE_BYTES = 4 << 20
BUCKET_CHARS = 1 << 25
BUCKET_WINDOWS = 1 << 23
NO_ID = -(2**63)
MULTIPLIER = 0x9E3779B97F4A7C15
MASK = 2**64 - 1

PIECES = "doc long, text_hash long, pos int, n int, src long, src_hash long, src_pos int"
PIECES_ARROW = pa.schema(
    [("doc", pa.int64()), ("text_hash", pa.int64()), ("pos", pa.int32()), ("n", pa.int32()),
     ("src", pa.int64()), ("src_hash", pa.int64()), ("src_pos", pa.int32())]
)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive values (by doubling)."""
    n = len(values) - k + 1
    done, total, power, width, left = 0, None, values, 1, k
    while left:
        if left & 1:
            part = power[done : done + n]
            total = part.copy() if total is None else total * np.uint64(pow(MULTIPLIER, width, MASK + 1)) + part
            done += width
        left >>= 1
        if left:
            power = power[:-width] * np.uint64(pow(MULTIPLIER, width, MASK + 1)) + power[width:]
            width *= 2
    return _mixed(total)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values (by doubling)."""
    reach, least = 1, values
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _runs(*steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs in which every given array grows by one
    (arrays of the same length; give constants as ``arange + constant``)."""
    n = len(steps[0])
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    breaks = np.any([np.diff(s) != 1 for s in steps], axis=0)
    starts = np.concatenate([[0], np.flatnonzero(breaks) + 1])
    return starts, np.diff(np.concatenate([starts, [n]]))


def _pieces(doc, text_hash, pos, src, src_hash, src_pos) -> pa.RecordBatch:
    """Repeated windows, ordered by place, as runs that the source shares."""
    grow = np.arange(len(pos))
    runs, n = _runs(pos, src_pos, doc + grow, text_hash + grow, src + grow, src_hash + grow)
    columns = (doc[runs], text_hash[runs], pos[runs], n, src[runs], src_hash[runs], src_pos[runs])
    return pa.record_batch([pa.array(c.astype(t.to_pandas_dtype())) for c, t in zip(columns, PIECES_ARROW.types)], schema=PIECES_ARROW)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, byte planes together, compressed."""
    planes = b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes() for a in arrays)
    return zstandard.compress(planes, 1)


def _unpack(data: bytes, n: int, *types) -> list[np.ndarray]:
    planes, out, at = np.frombuffer(zstandard.decompress(data), np.uint8), [], 0
    for t in types:
        size = np.dtype(t).itemsize
        out.append(np.ascontiguousarray(planes[at : at + n * size].reshape(size, n).T).view(t).reshape(n))
        at += n * size
    return out


EDGES = "bucket int, records int, meta binary, hashes binary, " + PIECES
EDGES_ARROW = pa.schema(
    [("bucket", pa.int32()), ("records", pa.int32()), ("meta", pa.binary()), ("hashes", pa.binary()), *PIECES_ARROW]
)


def _edge_rows(batch: pa.RecordBatch, buckets: int, k: int, m: int) -> Iterator[pa.RecordBatch]:
    """Edges of one slice: rows with packed super-k-mers for each bucket, and
    rows with the pieces that repeat an earlier place of the slice."""
    ids = batch.column("doc").to_numpy()
    hashes = batch.column("text_hash").to_numpy()
    order = np.lexsort((hashes, ids))
    ids, hashes = ids[order], hashes[order]
    new = np.concatenate([[True], (np.diff(ids) != 0) | (np.diff(hashes) != 0)])
    batch, ids, hashes = batch.take(pa.array(order[new])), ids[new], hashes[new]

    words = split_words(batch.column("text"))
    codes, owner = words.codes, words.owner
    if len(codes) < k:
        return
    unique = as_bytes(words.unique)
    values = np.fromiter(map(xxhash.xxh64_intdigest, unique), np.uint64, len(unique))[codes]
    at = np.flatnonzero(owner[: len(owner) - k + 1] == owner[k - 1 :])
    if not len(at):
        return
    window = rolling(values, k)[at] & np.uint64((1 << 8 * HASH_BYTES) - 1)
    least = sliding_min(rolling(values, m), k - m + 1)[at]
    owner = owner[at]
    pos = at - words.offsets[owner]

    # repeats within the slice, which is in order of place
    by = np.argsort(window, kind="stable")
    starts = np.concatenate([[True], np.diff(window[by]) != 0])
    first = np.empty(len(at), np.int64)
    first[by] = by[np.flatnonzero(starts)[np.cumsum(starts) - 1]]
    again = np.flatnonzero(first != np.arange(len(at)))
    same = np.ones(len(again), bool)
    for j in range(k):
        same &= codes[at[again] + j] == codes[at[first[again]] + j]
    again = again[same]
    src = first[again]
    if len(again):
        found = _pieces(ids[owner[again]], hashes[owner[again]], pos[again], ids[owner[src]], hashes[owner[src]], pos[src])
        blank = [pa.nulls(len(found), t) for t in EDGES_ARROW.types[1:4]]
        place = pa.array((np.arange(len(found)) % buckets).astype(np.int32))
        yield pa.RecordBatch.from_arrays([place, *blank, *found.columns], schema=EDGES_ARROW)

    # the others, as super-k-mers
    kept = np.ones(len(at), bool)
    kept[again] = False
    kept = np.flatnonzero(kept)
    # a run ends where positions do not follow, or the least m-gram changes
    change = np.concatenate([[0], np.cumsum(np.diff(least[kept]) != 0)])
    grow = np.arange(len(kept))
    runs, n = _runs(kept, change + grow, owner[kept] + grow)
    anchor = _mixed(least[kept[runs]])
    bucket = ((anchor >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    edges = np.concatenate([np.flatnonzero(np.concatenate([[True], np.diff(bucket[by]) != 0])), [len(by)]])
    rows = []
    for s, e in zip(edges[:-1], edges[1:]):
        mine = by[s:e]
        head, count = kept[runs[mine]], n[mine]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        who = owner[head]
        rows.append((
            int(bucket[mine[0]]),
            len(mine),
            _pack(np.diff(ids[who], prepend=0), hashes[who], pos[head].astype(np.int32), count.astype(np.int32),
                  anchor[mine].astype(np.uint32)),
            window[np.repeat(head, count) + within].view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes(),
        ))
        if len(rows) == 64:
            yield _edge_batch(rows)
            rows = []
    if rows:
        yield _edge_batch(rows)


def _edge_batch(rows) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), EDGES_ARROW.types)]
    return pa.RecordBatch.from_arrays(columns + [pa.nulls(len(rows), t) for t in EDGES_ARROW.types[4:]], schema=EDGES_ARROW)


class _Windows:
    """Window hashes, and the super-k-mers (row, first place, number of windows,
    anchor) that they belong to, in order.  Only the windows asked for are spelled out."""

    def __init__(self, doc, text_hash, pos, count, anchor, window):
        self.runs = (doc, text_hash, pos, anchor)
        self.count, self.ends, self.window = count, np.cumsum(count, dtype=np.int64), window

    @staticmethod
    def of_records(packed: list[tuple[int, bytes, bytes]]) -> _Windows:
        """The windows of packed super-k-mers."""
        parts = [_unpack(meta, n, np.int64, np.int64, np.int32, np.int32, np.uint32) for n, meta, _ in packed]
        doc = np.concatenate([np.cumsum(p[0]) for p in parts])
        text_hash, pos, count, anchor = (np.concatenate([p[i] for p in parts]) for i in range(1, 5))
        hashes = np.frombuffer(b"".join(h for _, _, h in packed), np.uint8).reshape(-1, HASH_BYTES)
        window = np.zeros((len(hashes), 8), np.uint8)
        window[:, :HASH_BYTES] = hashes
        return _Windows(doc, text_hash, pos, count, anchor, window.view(np.uint64).reshape(-1))

    @staticmethod
    def of_dealt(packed: list[tuple[int, bytes]]) -> _Windows:
        parts = [_unpack(data, n, np.int64, np.int64, np.int32, np.uint32, np.uint64) for n, data in packed]
        doc, text_hash, pos, anchor, window = (np.concatenate([p[i] for p in parts]) for i in range(5))
        return _Windows(doc, text_hash, pos, np.ones(len(pos), np.int32), anchor, window)

    def at(self, windows: np.ndarray) -> tuple[np.ndarray, ...]:
        """Row, text hash, place and anchor of some windows."""
        run = np.searchsorted(self.ends, windows, side="right")
        doc, text_hash, pos, anchor = self.runs
        return doc[run], text_hash[run], pos[run] + (windows - (self.ends[run] - self.count[run])), anchor[run]

    def dealt(self, buckets: int) -> Iterator[tuple[int, int, bytes]]:
        """The windows by their own hash: bucket, number of windows, packed columns."""
        bucket = (_mixed(self.window) % np.uint64(buckets)).astype(np.int32)
        by = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[by], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(ends)):
            mine = by[ends[b] : ends[b + 1]]
            doc, text_hash, pos, anchor = self.at(mine)
            yield int(b), len(mine), _pack(doc, text_hash, pos.astype(np.int32), anchor, self.window[mine])

    def repeated(self) -> pa.RecordBatch:
        """Those that also start earlier, with the first start."""
        by = np.argsort(self.window)
        equal = np.diff(self.window[by]) == 0
        some = by[np.concatenate([equal, [False]]) | np.concatenate([[False], equal])]
        del by, equal
        window, (doc, text_hash, pos, anchor) = self.window[some], self.at(some)
        by = np.lexsort((pos, text_hash, doc, anchor, window))
        doc, text_hash, pos, anchor, window = (c[by] for c in (doc, text_hash, pos, anchor, window))
        starts = np.concatenate([[True], (np.diff(window) != 0) | (anchor[1:] != anchor[:-1])])[: len(window)]
        first = np.flatnonzero(starts)[np.cumsum(starts) - 1] if len(window) else np.zeros(0, np.int64)
        later = np.flatnonzero((doc != doc[first]) | (text_hash != text_hash[first]) | (pos != pos[first]))
        first = first[later]
        by = np.lexsort((pos[later], text_hash[later], doc[later]))
        later, first = later[by], first[by]
        return _pieces(doc[later], text_hash[later], pos[later], doc[first], text_hash[first], pos[first])


DEALT = f"{PIECES}, bucket int, windows int, packed binary"
DEALT_ARROW = pa.schema([*PIECES_ARROW, ("bucket", pa.int32()), ("windows", pa.int32()), ("packed", pa.binary())])


def _with_blanks(found: pa.RecordBatch) -> pa.RecordBatch:
    blank = [pa.nulls(len(found), t) for t in DEALT_ARROW.types[len(PIECES_ARROW) :]]
    return pa.RecordBatch.from_arrays([*found.columns, *blank], schema=DEALT_ARROW)


def _deal(windows: _Windows, buckets: int) -> Iterator[pa.RecordBatch]:
    rows = list(windows.dealt(buckets))
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), DEALT_ARROW.types[len(PIECES_ARROW) :])]
    blank = [pa.nulls(len(rows), t) for t in PIECES_ARROW.types]
    yield pa.RecordBatch.from_arrays([*blank, *columns], schema=DEALT_ARROW)


def _bucket_rows(batches: Iterator[pa.RecordBatch], buckets: int, most: int) -> Iterator[pa.RecordBatch]:
    """Batches sorted by bucket; holds one bucket of at most ``most`` windows at a
    time.  What a larger one holds is dealt out again."""
    open_bucket, held, size, over = None, [], 0, False
    for batch in batches:
        pieces = batch.filter(pc.is_null(batch.column("records"))) if batch.num_rows else batch
        if len(pieces):
            yield _with_blanks(pa.RecordBatch.from_arrays(pieces.columns[4:], schema=PIECES_ARROW))
        for bucket, n, meta, hashes in zip(*(batch.column(c).to_pylist() for c in ("bucket", "records", "meta", "hashes"))):
            if n is None:
                continue
            if bucket != open_bucket:
                if held:
                    yield from _deal(_Windows.of_records(held), buckets) if over else [_with_blanks(_Windows.of_records(held).repeated())]
                open_bucket, held, size, over = bucket, [], 0, False
            held.append((n, meta, hashes))
            size += len(hashes) // HASH_BYTES
            if size > most:
                yield from _deal(_Windows.of_records(held), buckets)
                held, size, over = [], 0, True
    if held:
        yield from _deal(_Windows.of_records(held), buckets) if over else [_with_blanks(_Windows.of_records(held).repeated())]


def _dealt_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dealt windows sorted by bucket; holds one bucket at a time."""
    open_bucket, held = None, []
    for batch in batches:
        for bucket, n, packed in zip(*(batch.column(c).to_pylist() for c in ("bucket", "windows", "packed"))):
            if bucket != open_bucket and held:
                yield _Windows.of_dealt(held).repeated()
                held = []
            open_bucket = bucket
            held.append((n, packed))
    if held:
        yield _Windows.of_dealt(held).repeated()


def repeated_edges(docs: DataFrame, k: int = WINDOW, m: int = ANCHOR, most: int = BUCKET_WINDOWS) -> tuple[DataFrame, list[str]]:
    """Pieces of repeated paths in ``docs(doc, text_hash, text)``: ``n`` windows
    from word ``pos`` that also start earlier, at ``src_pos`` of ``src``; and the
    paths of the tables in the shared folder that hold them."""
    chars = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(shuffle_partitions(docs.sparkSession), -(-chars // BUCKET_CHARS))

    def emit(batches):
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                yield from _edge_rows(part, buckets, k, m)

    edges = docs.mapInArrow(emit, EDGES)
    met = (
        edges.repartitionById(buckets, F.col("bucket"))
        .sortWithinPartitions("bucket")
        .mapInArrow(lambda batches: _bucket_rows(batches, buckets, most), DEALT)
    )
    found, path = staged(met)
    pieces = found.where("packed is null").drop("bucket", "windows", "packed")
    dealt = found.where("packed is not null").select("bucket", "windows", "packed")
    if dealt.isEmpty():
        return pieces, [path]
    again = dealt.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket")
    more, second = staged(again.mapInArrow(_dealt_rows, PIECES))
    return pieces.unionByName(more), [path, second]


_LINE = ["doc", "text_hash", "src", "src_hash", "ahead"]


def compact(pieces: DataFrame) -> DataFrame:
    """Maximal paths ``(doc, text_hash, pos, n, src, src_hash, src_pos)`` of
    pieces (which are read twice).

    The pieces of one path lie on one line (same document, source and distance
    between the two).  A place where a piece ends and the next one starts has
    one way in and one way out: it is inside a path.  The full outer join of
    starts and ends leaves the other places, the heads and tails of paths.
    """
    pieces = pieces.withColumn("ahead", F.expr("src_pos - pos"))
    starts = pieces.groupBy(*_LINE, F.col("pos").alias("place")).agg(F.count(F.lit(1)).alias("starts"))
    ends = pieces.groupBy(*_LINE, F.expr("pos + n").alias("place")).agg(F.count(F.lit(1)).alias("ends"))
    delta = F.coalesce("starts", F.lit(0)) - F.coalesce("ends", F.lit(0))
    tips = starts.join(ends, [*_LINE, "place"], "full_outer").select(*_LINE, "place", delta.alias("delta")).where("delta <> 0")
    # pieces of a repeated row may overlap, so a path is over when as many
    # pieces have ended as have started
    line = Window.partitionBy(*_LINE).orderBy("place")
    return (
        tips.withColumn("over", (F.sum("delta").over(line) == 0).cast("int"))
        .withColumn("path", F.sum("over").over(line) - F.col("over"))
        .groupBy(*_LINE, "path")
        .agg(F.min("place").alias("pos"), F.max("place").alias("stop"))
        .selectExpr("doc", "text_hash", "pos", "stop - pos as n", "src", "src_hash", "pos + ahead as src_pos")
    )


def repeated_paths(docs: DataFrame, k: int = WINDOW, m: int = ANCHOR, most: int = BUCKET_WINDOWS) -> DataFrame:
    """The maximal repeated paths of ``docs(doc, text_hash, text)``, as a table
    in the shared folder: a row for each path, however long."""
    pieces, held = repeated_edges(docs, k, m, most)
    paths, _ = staged(compact(pieces))
    for path in held:
        discard(docs.sparkSession, path)
    return paths


_WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def _cut(text: bytes, spans, n_words: int) -> np.ndarray:
    change = np.zeros(n_words + 1, np.int64)
    for s in spans:
        change[s["start"]] += 1
        change[min(s["start"] + s["n"], n_words)] -= 1
    return np.cumsum(change[:-1]) == 0


def _remove(texts: pa.Array, spans: pa.Array, with_text: bool) -> pa.Array:
    n_words, n_removed, digest, kept_text = [], [], [], []
    for text, raw, cut in zip(as_bytes(texts), texts.is_valid().to_pylist(), spans.to_pylist()):
        found = text.split()
        n_words.append(len(found))
        kept = found
        result = text if raw else None
        if cut:
            keep = _cut(text, cut, len(found))
            kept = [w for w, stays in zip(found, keep) if stays]
            if with_text:
                at = list(_WORD.finditer(text))
                runs, n = _runs(np.flatnonzero(keep))
                stay = np.flatnonzero(keep)
                result = b" ".join(text[at[stay[r]].start() : at[stay[r + c - 1]].end()] for r, c in zip(runs, n))
        n_removed.append(len(found) - len(kept))
        digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        kept_text.append(result)
    columns = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string())]
    names = ["n_words", "n_removed", "kept_sha256"]
    if with_text:
        columns, names = columns + [pa.array(kept_text, pa.binary()).cast(pa.string())], names + ["kept_text"]
    return pa.StructArray.from_arrays(columns, names)


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", k: int = WINDOW, m: int = ANCHOR, with_text: bool = True,
    out: str = "dedup", most: int = BUCKET_WINDOWS,
) -> DataFrame:
    """``docs`` with a struct column ``out`` (with underscores in front where
    ``docs`` has that name): ``n_words``, ``n_removed``,
    ``kept_sha256`` (kept words joined by one space) and, ``with_text``,
    ``kept_text``: the text itself if nothing is removed, else its kept
    stretches as they stand, joined by a space.

    Every row stays, repeated ones too.  Windows are judged on the input.
    An empty table gives no rows; columns of any other name are carried along.
    """
    keyed = docs.select(
        F.coalesce(F.col(id_column), F.lit(NO_ID)).cast("long").alias("doc"),
        F.xxhash64(text).alias("text_hash"),
        F.col(text).alias("text"),
    )
    out = fresh(docs, out)
    paths = repeated_paths(keyed, k, m, most)
    spans = paths.groupBy("doc", "text_hash").agg(
        F.collect_list(F.struct(F.col("pos").alias("start"), (F.col("n") + (k - 1)).alias("n"))).alias("spans")
    )
    doc, text_hash, cuts = (fresh(docs, c) for c in ("_doc", "_text_hash", "_spans"))
    spans = spans.toDF(doc, text_hash, cuts)

    def remove(texts: pa.Array, cuts: pa.Array) -> pa.Array:
        return _remove(texts, cuts, with_text)

    kind = "n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    joined = docs.withColumn(doc, F.coalesce(F.col(id_column), F.lit(NO_ID)).cast("long")).withColumn(
        text_hash, F.xxhash64(text)
    )
    joined = joined.join(spans, [doc, text_hash], "left")
    return joined.withColumn(out, F.arrow_udf(remove, kind)(F.col(text), F.col(cuts))).select(*docs.columns, out)

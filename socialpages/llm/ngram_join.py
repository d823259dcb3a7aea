"""Exact n-gram Jaccard join in the metric space of shingle sets.

The Jaccard distance of two sets is a metric.  Documents at most ``EPS`` = 0.2
apart are linked.

1. Isolation.  A document that has less than 80% of its shingles in common with
   all others together is farther than ``EPS`` from each of them: it is a region
   of its own.  Each slice of texts finds the shingles that its own documents
   share and sends every distinct shingle once, four bytes and a place, to the
   bucket of its hash, where those of several slices meet.  A shingle that a
   third of the corpus holds leaves a slice once.  A chance match only keeps a
   document for the next steps.
2. Points.  Documents of equal sets are one point of the space.  Of every point
   the shingles that other points have too are found exactly; with less than 80%
   of them it is alone.
3. Pivots.  A point's nearest points agree with it on most of 8 min-hashes.  The
   points that lead their groups (by how many others share their min-hashes, then
   by how few shingles are their own) become pivots, the others join the pivot of most of their groups if the exact
   distance is at most ``EPS``: the pivots' Voronoi regions, of radius at most
   ``EPS``.  What is left elects pivots again.  A point that no region of
   ``LEAST_REGION`` takes is a pivot on its own, of radius 0.  The election decides
   only where a point goes, never whether a link is found.
4. Windows.  By the triangle inequality a link between the regions of ``p`` and
   ``q`` needs ``d(p, q) <= R(p) + R(q) + EPS``.  These pairs of pivots are found
   exactly (prefixes of the sets, rarest shingles first; of two single points one
   must have few shingles of its own).  If their regions are not connected yet,
   the points of ``p`` whose own distance admits a link are replicated to ``q``, and
   those within ``R(q) + EPS`` of ``q`` go on, recursively, to the points of ``q`` that
   admit one.  Both steps compute exact distances.  Two points at a pivot also
   differ in at least the difference of what they lack of it, and in all
   shingles that no other point has, which keeps pairs of edited copies with
   different edits out of the windows.

Points of one region are connected through their pivot, so a group of copies,
however large, costs one distance for each copy.  Distances are computed in
units of about ``UNIT_SHINGLES`` shingles against one set.  Shingles are 64-bit hashes;
a chance match of two within one pair of documents is not told apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from socialpages.llm.common import as_bytes, shuffle_partitions, split_words, text_slices, translated
from socialpages.llm.components import components
from socialpages.llm.substring import rolling
from socialpages.plans.lineage import discard, staged

SHINGLE = 5
PERCENT = 80
EPS = 1 - PERCENT / 100
SLACK = 1e-9
MINS = 8
LEAST_VOTES = 3
ELECTIONS = 3
LEAST_REGION = 16
SLICE_BYTES = 4 << 20
BUCKET_BYTES = 32 << 20
UNIT_SHINGLES = 1 << 20
SHARED = 0xFFFFFFFF

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, hashes)``: the distinct shingles of every text, ascending.
    Fewer words than ``size`` are one shingle, no words none."""
    words = split_words(translated(texts, _LOWER))
    unique = as_bytes(words.unique)
    values = np.fromiter(map(xxhash.xxh64_intdigest, unique), np.uint64, len(unique))[words.codes]
    owner, counts = words.owner, words.counts
    who, found = [], []
    if len(values) >= size:
        at = np.flatnonzero(owner[: len(owner) - size + 1] == owner[size - 1 :])
        who.append(owner[at])
        found.append(rolling(values, size)[at])
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            who.append(short)
            found.append(rolling(values, n)[words.offsets[short]])
    who = np.concatenate(who) if who else np.zeros(0, np.int64)
    found = np.concatenate(found) if found else np.zeros(0, np.uint64)
    by = np.lexsort((found, who))
    who, found = who[by], found[by]
    new = np.concatenate([[True], (np.diff(who) != 0) | (found[1:] != found[:-1])])[: len(who)]
    who, found = who[new], found[new]
    return np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(texts)))]), found


# --- isolation ---------------------------------------------------------------------------

_PLACE = [("slice", pa.int64()), ("row", pa.int64())]
_PACKED = [("bucket", pa.int32()), ("shingles", pa.binary())]


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.record_batch([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)


def _send(batch: pa.RecordBatch, schema: pa.Schema, buckets: int, size: int) -> Iterator[pa.RecordBatch]:
    """One slice: a row for each document, with the number of its shingles that
    the slice shares, and the slice's distinct shingles by bucket."""
    offsets, shingles = shingle_sets(batch.column("text"), size)
    n = np.diff(offsets)
    row = np.repeat(np.arange(len(n)), n)
    by = np.argsort(shingles, kind="stable")
    new = np.concatenate([[True], shingles[by][1:] != shingles[by][:-1]])[: len(by)]
    group = np.cumsum(new) - 1
    shared = np.bincount(group)[group] > 1 if len(by) else new
    hits = np.bincount(row[by][shared], minlength=len(n))
    raw = shingles.tobytes()
    digests = [xxhash.xxh3_128_digest(raw[8 * a : 8 * b]) for a, b in zip(offsets[:-1], offsets[1:])]
    keys = batch.column("key")
    me = xxhash.xxh64_intdigest(keys.to_numpy().tobytes()) >> 1
    place = pa.array((np.arange(len(n)) % buckets).astype(np.int32))
    yield _batch(
        schema, bucket=place, slice=pa.array([me] * len(n), pa.int64()), row=pa.array(np.arange(len(n))),
        id=batch.column("id"), key=keys, n=pa.array(n), hits=pa.array(hits), digest=pa.array(digests, pa.binary()),
    )
    once = by[new]
    where = np.where(shared[new], SHARED, row[once]).astype(np.uint32)
    bucket = (shingles[once] % np.uint64(buckets)).astype(np.int32)
    short = (shingles[once] >> np.uint64(32)).astype(np.uint32)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    used = np.flatnonzero(np.diff(ends))
    for start in range(0, len(used), 256):
        part = used[start : start + 256]
        mine = [order[ends[b] : ends[b + 1]] for b in part]
        yield _batch(
            schema, bucket=pa.array(part.astype(np.int32)), slice=pa.array([me] * len(part), pa.int64()),
            shingles=pa.array([short[m].tobytes() for m in mine], pa.binary()),
            rows=pa.array([where[m].tobytes() for m in mine], pa.binary()),
        )


def _meet(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """For each slice the rows of one bucket whose shingles other slices have too,
    a row for each such shingle."""
    shingles = np.concatenate([np.frombuffer(s, np.uint32) for _, s, _ in held])
    rows = np.concatenate([np.frombuffer(r, np.uint32) for _, _, r in held])
    part = np.repeat(np.arange(len(held)), [len(s) // 4 for _, s, _ in held])
    by = np.argsort(shingles)
    same = shingles[by][1:] == shingles[by][:-1]
    met = by[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    met = np.sort(met[rows[met] != SHARED])
    ends = np.searchsorted(part[met], np.arange(len(held) + 1))
    some = np.flatnonzero(np.diff(ends))
    return _batch(
        schema, slice=pa.array([held[i][0] for i in some], pa.int64()),
        rows=pa.array([rows[met[ends[i] : ends[i + 1]]].tobytes() for i in some], pa.binary()),
    )


def _gather(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches sorted by bucket; holds one bucket at a time."""
    open_bucket, held = None, []
    for batch in batches:
        document = pc.is_null(batch.column("shingles"))
        if batch.num_rows:
            documents = batch.filter(document)
            if len(documents):
                yield pa.record_batch([documents.column(f.name) for f in schema], schema=schema)
        packed = batch.filter(pc.invert(document))
        for bucket, *rest in zip(*(packed.column(c).to_pylist() for c in ("bucket", "slice", "shingles", "rows"))):
            if bucket != open_bucket and held:
                yield _meet(held, schema)
                held = []
            open_bucket = bucket
            held.append(rest)
    if held:
        yield _meet(held, schema)


def _added_up(rows: pa.Table) -> pa.Table:
    """The documents of one slice with all their shared shingles counted."""
    packed = pc.is_null(rows.column("row"))
    found = np.concatenate([np.frombuffer(x, np.uint32) for x in rows.filter(packed).column("rows").to_pylist()] or [np.zeros(0, np.uint32)])
    documents = rows.filter(pc.invert(packed))
    row = documents.column("row").to_numpy()
    hits = documents.column("hits").to_numpy() + np.bincount(found, minlength=int(row.max(initial=0)) + 1)[row]
    return documents.select(["id", "key", "n", "digest"]).append_column("hits", pa.array(hits))


def _surveyed(docs: DataFrame, size: int) -> DataFrame:
    """``(id, key, n, digest, hits)`` of every row of ``docs(id, key, text)``: set size, set
    digest, how many of its shingles another document has too (or some more)."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(shuffle_partitions(spark), -(-total // BUCKET_BYTES))
    kind = docs.schema["id"].dataType
    facts = f"slice long, row long, id {kind.simpleString()}, key long, n long, hits long, digest binary, rows binary"
    arrow = pa.schema([*_PLACE, ("id", _arrow_type(kind)), ("key", pa.int64()), ("n", pa.int64()), ("hits", pa.int64()), ("digest", pa.binary()), ("rows", pa.binary())])
    full = pa.schema([*arrow, *_PACKED])

    def send(batches):
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                yield from _send(part, full, buckets, size)

    rows = docs.mapInArrow(send, facts + ", bucket int, shingles binary")
    met = rows.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(lambda b: _gather(b, arrow), facts)
    return met.groupBy("slice").applyInArrow(
        _added_up, f"id {kind.simpleString()}, key long, n long, digest binary, hits long"
    )


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


# --- points and distances ----------------------------------------------------------------

SETS = "node long, n long, mins array<long>, shingles array<long>"


def _points(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text", SLICE_BYTES):
            offsets, shingles = shingle_sets(part.column("text"), size)
            starts, n = offsets[:-1], np.diff(offsets)
            some = np.flatnonzero(n)
            mins = np.zeros((len(n), MINS), np.uint64)
            for j in range(MINS):
                mixed = (shingles ^ (shingles >> np.uint64(31))) * np.uint64((0x9E3779B97F4A7C15 * (2 * j + 1)) % 2**64)
                mixed ^= mixed >> np.uint64(29)
                if len(some):
                    mins[some, j] = np.minimum.reduceat(mixed, starts[some])
            lists = [
                pa.LargeListArray.from_arrays(pa.array(o), pa.array(v.view(np.int64))).cast(pa.list_(pa.int64()))
                for o, v in ((np.arange(len(n) + 1) * MINS, mins.reshape(-1)), (offsets, shingles))
            ]
            yield pa.record_batch([part.column("key"), pa.array(n), *lists], ["node", "n", "mins", "shingles"])


def _overlaps(rows: pa.Table) -> pa.Table:
    """Sizes of one set, of the others of its unit, and of their intersections."""
    rows = rows.combine_chunks()
    head = pc.is_null(rows.column("b"))
    one = np.sort(rows.filter(head).column("shingles").combine_chunks().flatten().to_numpy())
    others = rows.filter(pc.invert(head))
    lists = others.column("shingles").combine_chunks()
    flat = lists.flatten().to_numpy()
    at = np.minimum(np.searchsorted(one, flat), max(0, len(one) - 1))
    total = np.concatenate([[0], np.cumsum(one[at] == flat if len(one) else np.zeros(len(flat), bool))])
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    columns = [others.column("a"), others.column("b"), pa.array(total[ends] - total[ends - sizes])]
    return pa.table([*columns, pa.array(len(one) + sizes)], names=["a", "b", "common", "both"])


def distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``(a, b, common, distance, linked)`` of the pairs ``(a, b)`` of points, which
    differ from each other and are of similar size; an ``a`` with many partners is
    dealt over several units."""
    pairs, _ = staged(pairs)
    size = sets.selectExpr("node as a", "n")
    units = pairs.groupBy("a").count().join(size, "a").selectExpr("a", f"cast(ceil(count * n / {UNIT_SHINGLES}) as int) as units")
    dealt, _ = staged(pairs.join(units, "a").selectExpr("a", "b", "cast(pmod(xxhash64(b), units) as int) as unit"))
    one = dealt.select("a", "unit").distinct().join(sets.selectExpr("node as a", "shingles"), "a")
    other = dealt.join(sets.selectExpr("node as b", "shingles"), "b")
    rows = one.selectExpr("a", "unit", "cast(null as long) as b", "shingles").unionByName(other.select("a", "unit", "b", "shingles"))
    common = rows.groupBy("a", "unit").applyInArrow(_overlaps, "a long, b long, common long, both long")
    return common.selectExpr("a", "b", "common", "both - common as joint").selectExpr(
        "a", "b", "common", "1 - common / joint as distance", f"100 * common >= {PERCENT} * joint as linked"
    )


# --- regions -----------------------------------------------------------------------------


def _elected(active: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pivots ``(pivot)`` among ``active(node, own, mins)`` and the homes ``(a, b)`` that the
    other points try: the pivot that leads most of their min-hash groups.  Of points
    in equally large groups the one with the fewest shingles of its own leads: the
    text that the others are edited copies of."""
    seen = active.select("node", F.posexplode("mins").alias("j", "m"))
    size = seen.groupBy("j", "m").agg(F.count(F.lit(1)).alias("size"))
    near = seen.join(size, ["j", "m"]).groupBy("node").agg(F.sum("size").alias("near"))
    rank = near.join(active.select("node", "own"), "node").select("node", F.struct("near", (-F.col("own")).alias("few"), "node").alias("rank"))
    lead = seen.join(rank, "node").groupBy("j", "m").agg(F.max_by("node", "rank").alias("pivot"))
    votes, _ = staged(seen.join(lead, ["j", "m"]).groupBy("node", "pivot").agg(F.count(F.lit(1)).alias("votes")))
    best = votes.groupBy("node").agg(F.max_by("pivot", F.struct("votes", F.expr("pivot = node"), "pivot")).alias("pivot"))
    pivots, _ = staged(best.where("pivot = node").select("pivot"))
    tried = (
        votes.join(pivots, "pivot").groupBy("node")
        .agg(F.max_by("pivot", F.struct("votes", "pivot")).alias("a"), F.max("votes").alias("votes"))
        .where(f"votes >= {LEAST_VOTES}")
        .join(pivots.selectExpr("pivot as node"), "node", "left_anti")
    )
    return pivots, tried.selectExpr("a", "node as b")


def _regions(points: DataFrame, sets: DataFrame) -> DataFrame:
    """``(pivot, node, away, common)``: every point, its pivot, its distance to it, at
    most ``EPS``, and the size of their intersection.  A pivot is in its own region."""
    active, parts = points.select("node", "n", "own").join(sets.select("node", "mins"), "node"), []
    for _ in range(ELECTIONS):
        pivots, tried = _elected(active)
        near, _ = staged(distances(tried, sets).where("linked").selectExpr("a as pivot", "b as node", "distance as away", "common"))
        large = near.groupBy("pivot").count().where(f"count >= {LEAST_REGION}").select("pivot")
        part, _ = staged(near.join(large, "pivot").unionByName(_alone(active.join(large.toDF("node"), "node"))))
        parts.append(part)
        active, _ = staged(active.join(part.select("node"), "node", "left_anti"))
        if part.isEmpty():
            break
    return _union([*parts, _alone(active)])


def _alone(points: DataFrame) -> DataFrame:
    return points.selectExpr("node as pivot", "node", "cast(0 as double) as away", "n as common")


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _shared(sets: DataFrame) -> DataFrame:
    """``(node, n, own, found)`` of the points that can have links: set size, how many
    shingles no other point has, and the others, the rarest first."""
    tokens = sets.select("node", "n", F.explode("shingles").alias("h"))
    common = tokens.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    found = tokens.join(common, "h").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("found"))
    return found.selectExpr("node", "n", "n - size(found) as own", "found.h as found").where(f"100 * (n - own) >= {PERCENT} * n")


def _prefix(pivots: DataFrame, radius: float) -> DataFrame:
    """The first shingles of each of ``pivots(pivot, radius, n, own, found)``, enough to meet
    any set that is at most its radius, ``radius`` and ``EPS`` away: of two sets with a share
    ``s`` of each in common, each has a common shingle among its first ``n - ceil(s n) + 1`` in
    any order that both follow.  Its own shingles are first of all and only counted."""
    least = f"cast(ceil((1 - radius - {radius!r} - {EPS!r} - {SLACK}) * n) as int)"
    return (
        pivots.withColumn("first", F.expr(f"size(found) - {least} + 1")).where("first > 0")
        .select("pivot", "radius", "n", "own", F.explode(F.expr("slice(found, 1, first)")).alias("h"))
    )


def _near_pivots(pivots: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of ``pivots(pivot, radius, n, own, found)`` with every pair that is at
    most the two radii and ``EPS`` apart (and others): regions with all others, and
    single points with single points.

    Two linked points differ in at most a ninth of their sizes' sum, and their own
    shingles are part of that, so one of them has no more than a ninth of its size."""
    widest = pivots.agg(F.max("radius")).first()[0] or 0.0
    share = f"(1 - x.radius - y.radius - {EPS!r} - {SLACK})"
    fits = (
        f"x.h = y.h and least(x.n, y.n) >= {share} * greatest(x.n, y.n) and "
        f"(1 + {share}) * (x.own + y.own) <= (1 - {share}) * (x.n + y.n)"
    )
    regions, singles = pivots.where("radius > 0"), pivots.where("radius = 0")
    light = singles.where(f"{100 + PERCENT} * own <= {100 - PERCENT} * n")
    wide = _prefix(regions, widest).alias("x").join(
        _prefix(pivots, widest).alias("y"), F.expr(f"{fits} and (y.radius = 0 or x.pivot < y.pivot)")
    )
    narrow = _prefix(light, 0.0).alias("x").join(
        _prefix(singles, 0.0).alias("y"),
        F.expr(f"{fits} and x.pivot <> y.pivot and (x.pivot < y.pivot or {100 + PERCENT} * y.own > {100 - PERCENT} * y.n)"),
    )
    both = [j.selectExpr("x.pivot as a", "y.pivot as b") for j in (wide, narrow)]
    return both[0].unionByName(both[1]).distinct()


def _admits(x: str, y: str, pivot: str) -> str:
    """Condition under which two points at a pivot may be linked: they differ at least in the
    difference of what they lack of the pivot, and in what only they have or in the
    difference of what they have beside it."""
    lack = f"abs(({pivot}_n - {x}_common) - ({pivot}_n - {y}_common))"
    more = f"greatest({x}_own + {y}_own, abs(({x}_n - {x}_common) - ({y}_n - {y}_common)))"
    return f"{100 + PERCENT} * ({lack} + {more}) <= {100 - PERCENT} * ({x}_n + {y}_n)"


def _window_links(near: DataFrame, regions: DataFrame, points: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect the regions of the pairs ``near(p, q, common, distance, rp,
    rq)`` of pivots, ``rp >= rq``."""
    sizes = points.select("node", "n", "own")
    members = regions.join(sizes, "node").select("pivot", "node", "away", "common", "n", "own")
    x_side = members.toDF("p", "x", "x_away", "x_common", "x_n", "x_own")
    q_size, p_size = sizes.toDF("q", "q_n", "q_own"), sizes.toDF("p", "p_n", "p_own")
    pairs = near.withColumnRenamed("common", "q_common").join(q_size, "q").join(p_size, "p").join(x_side, "p")
    boundary = pairs.where(f"x_away >= distance - {EPS!r} - rq - {SLACK}").where(f"rq > 0 or {_admits('x', 'q', 'p')}")
    found, _ = staged(distances(boundary.selectExpr("q as a", "x as b").distinct(), sets))
    again = (
        # a single point has no others at it: only regions are looked into further
        found.where("not linked").join(near.where("rq > 0").selectExpr("q as a", "rq").distinct(), "a")
        .where(f"distance <= rq + {EPS!r} + {SLACK}")
        .selectExpr("a as pivot", "b as x", "distance", "common as x_common")
        .join(sizes.toDF("x", "x_n", "x_own"), "x").join(sizes.toDF("pivot", "pivot_n", "pivot_own"), "pivot")
        .join(members.toDF("pivot", "y", "y_away", "y_common", "y_n", "y_own"), "pivot")
        .where(f"y <> pivot and y <> x and y_away >= distance - {EPS!r} - {SLACK}").where(_admits("x", "y", "pivot"))
    )
    deeper = distances(again.selectExpr("x as a", "y as b").distinct(), sets)
    return found.where("linked").select("a", "b").unionByName(deeper.where("linked").select("a", "b"))


def _labels(sets: DataFrame) -> DataFrame:
    """``(node, root)`` of the points that have links."""
    points, _ = staged(_shared(sets))
    regions, _ = staged(_regions(points, sets))
    radii = regions.groupBy("pivot").agg(F.max("away").alias("radius"))
    pivots, _ = staged(radii.join(points.withColumnRenamed("node", "pivot"), "pivot"))
    near = distances(_near_pivots(pivots), sets)
    radii = pivots.select("pivot", "radius")
    near = near.join(radii.toDF("a", "ra"), "a").join(radii.toDF("b", "rb"), "b").where(f"distance <= ra + rb + {EPS!r} + {SLACK}")
    near, _ = staged(near)
    links = regions.selectExpr("pivot as a", "node as b").where("a <> b").unionByName(near.where("linked").select("a", "b"))
    labels, _ = staged(components(links))
    apart = (
        near.where("not linked and ra + rb > 0")
        .join(labels.toDF("a", "one"), "a", "left").join(labels.toDF("b", "two"), "b", "left")
        .where("coalesce(one, a) <> coalesce(two, b)")
        .selectExpr(
            "if(ra >= rb, a, b) as p", "if(ra >= rb, b, a) as q", "common", "distance", "greatest(ra, rb) as rp", "least(ra, rb) as rq"
        )
    )
    apart, _ = staged(apart)
    if apart.isEmpty():
        return labels
    more, _ = staged(_window_links(apart, regions, points, sets))
    if more.isEmpty():
        return labels
    return components(labels.selectExpr("root as a", "node as b").unionByName(more))


def jaccard_components(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = SHINGLE
) -> DataFrame:
    """``(id, n_shingles, component_id)`` for every row of ``docs``: the size of its
    set of distinct ``size``-word shingles (A-Z lower-cased; fewer words: the
    whole sequence is the one shingle) and the least id reachable over links of
    at least 80% Jaccard similarity, itself included.

    A null or empty text, or one without words, has no shingles and no links.
    Repeated rows stay repeated; rows of one id are points of their own, by
    their texts.  A null id keeps its row and names no component (a component
    without any id has a null name).  Ids may be of any type that Spark orders
    and Arrow carries.  An empty table gives no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    rows = rows.select("id", F.xxhash64("id", "text").alias("key"), "text")
    facts, _ = staged(_surveyed(rows, size))
    near = facts.where(f"n > 0 and 100 * hits >= {PERCENT} * n")
    classes, _ = staged(near.groupBy("digest").agg(F.min("key").alias("node"), F.countDistinct("key").alias("copies")))
    wanted = rows.select("key", "text").join(classes.selectExpr("node as key"), "key", "left_semi")
    points = wanted.mapInArrow(lambda batches: _points(batches, size), SETS)
    if not facts.groupBy("key").count().where("count > 1").isEmpty():
        points = points.dropDuplicates(["node"])
    sets, held = staged(points)
    labels, _ = staged(_labels(sets))
    discard(spark, held)
    member = near.select("id", "key", "digest").join(classes, "digest").join(labels, "node", "left")
    member = member.select("id", "key", F.coalesce("root", "node").alias("root")).distinct()
    named = member.groupBy("root").agg(F.min("id").alias("component_id"))
    label, _ = staged(member.select("key", "root").distinct().join(named, "root").select("key", "component_id", F.lit(True).alias("known")))
    return facts.join(label, "key", "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
        F.expr("if(known, component_id, id)").alias("component_id"),
    )

"""Source divergence audit: how far apart the term distributions of the sources
of a language are, from joint count tables made by one-hot matrix products.

1. Counts.  Each slice of texts counts its terms by (language, source), and in
   how many documents of each (vectorised); Spark adds the counts up, so a hot
   source leaves a slice as one row for each term.  A language keeps the terms
   found in at least ``min_docs`` of its documents.
2. Prices.  A term counted ``c`` times in a group (a language's source, or the
   whole language) of ``N`` kept words has the price
   ``1 + floor(10^9 (c + 5) / (N + 5 V))``, ``V`` the kept terms; decimals of
   38 digits, so that no product overflows.
3. Level products.  The indicator matrix of a language has a row for each kept
   term and a column for each (source, count level).  The product of its
   transpose with itself holds the joint table of every pair of sources: how
   many terms have level ``i`` in one and level ``j`` in the other.  It is
   worked out in blocks, ``BLOCK_TERMS`` rows by ``TILE`` x ``TILE`` sources.
   A block of a one-hot matrix has one 1 in each row, so its product is the
   exact count of the (level, level) cells that its rows hit.
4. A block prices its joint tables: the sum of ``cell x |price - price|``.  It
   is linear in the cells, so the blocks' sums add up to the pair's value and
   no joint table is shuffled.

Units of work are bounded by the two constants, however many terms, sources or
documents there are; a language's term with many sources meets each tile pair
once.  The result has a row for each ordered pair of sources of a language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from socialpages.llm.common import Words, split_words, text_slices, translated
from socialpages.plans.lineage import discard, staged

MIN_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
SMOOTHING = 5
BLOCK_TERMS = 8192
TILE = 64
SLICE_BYTES = 8 << 20

# Letters and every byte of a multi-byte character stay, A-Z become a-z, all
# other bytes separate terms.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

COUNTS = "lang string, source string, term string, n long, docs long"
COUNTS_ARROW = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
)


def split_terms(texts: pa.Array) -> Words:
    """The terms of every text: maximal runs of ASCII letters and non-ASCII
    characters, only A-Z lower-cased."""
    return split_words(translated(texts, _FOLD))


def _count_slice(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Counts of one slice, and a row without a term for each of its groups."""
    langs = pc.fill_null(batch.column("lang"), "").dictionary_encode()
    sources = pc.fill_null(batch.column("source"), "").dictionary_encode()
    width = len(sources.dictionary)
    both = langs.indices.to_numpy().astype(np.int64) * width + sources.indices.to_numpy()
    groups, group = np.unique(both, return_inverse=True)
    terms = split_terms(batch.column("text"))
    size = max(1, len(terms.unique))
    cells, n = np.unique(group[terms.owner] * size + terms.codes, return_counts=True)
    once = np.unique(terms.owner * size + terms.codes)
    # the same cells in the same order: every cell is in a document
    docs = np.unique(group[once // size] * size + once % size, return_counts=True)[1]
    who = np.concatenate([groups[cells // size], groups])
    blank = len(groups)
    term = pa.concat_arrays([terms.unique.take(pa.array(cells % size)).cast(pa.string()), pa.nulls(blank, pa.string())])
    return pa.record_batch(
        [
            langs.dictionary.take(pa.array(who // width)),
            sources.dictionary.take(pa.array(who % width)),
            term,
            pa.array(np.concatenate([n, np.zeros(blank, np.int64)])),
            pa.array(np.concatenate([docs, np.zeros(blank, np.int64)])),
        ],
        schema=COUNTS_ARROW,
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text", SLICE_BYTES):
            yield _count_slice(part)


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences of the term and documents
    with it; and one row without a term for each group, so that groups without
    any term are seen."""
    rows = docs.select(
        F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"),
        F.col(source).cast("string").alias("source"),
    )
    return (
        rows.mapInArrow(_count, COUNTS)
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def _price(count: str, total: str, terms: str) -> str:
    wide = f"cast({count} as decimal(20,0)) + {SMOOTHING}"
    return f"1 + cast({SCALE} as decimal(10,0)) * ({wide}) div (cast({total} as decimal(20,0)) + {SMOOTHING} * {terms})"


def _levels(values: np.ndarray, prices: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A source's indicator columns: each row's level, and the levels' prices."""
    _, first, level = np.unique(values, return_index=True, return_inverse=True)
    return level, prices[first]


def _joint_value(a: tuple, b: tuple) -> int:
    """Priced product of the indicator columns of two sources."""
    (level_a, price_a), (level_b, price_b) = a, b
    width = len(price_b)
    cell = level_a * width + level_b
    if len(price_a) * width <= 4 * len(cell):
        joint = np.bincount(cell, minlength=len(price_a) * width)
        at = np.flatnonzero(joint)
        joint = joint[at]
    else:
        at, joint = np.unique(cell, return_counts=True)
    return int((joint * np.abs(price_a[at // width] - price_b[at % width])).sum())


def _block(rows: pa.Table) -> pa.Table:
    """Values of the source pairs of one unit, over the terms of its block.

    Rows without a term name the unit's sources, the price of count zero and
    the number of kept terms of the block."""
    rows = rows.combine_chunks()
    blank = pc.is_null(rows.column("term"))
    heads, cells = rows.filter(blank), rows.filter(pc.invert(blank))
    names, at_side = heads.column("source").to_pylist(), heads.column("side").to_pylist()
    order = sorted(range(len(names)), key=lambda i: names[i])
    terms = heads.column("n")[0].as_py()
    zero = heads.column("price").to_numpy()
    index = pc.index_in(cells.column("source"), value_set=heads.column("source").combine_chunks()).to_numpy(
        zero_copy_only=False
    )
    row = cells.column("term").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    value, price = cells.column("n").to_numpy(), cells.column("price").to_numpy()
    # the block's matrix: a column of levels for each source, level zero elsewhere
    columns = []
    for s in range(len(names)):
        mine = index == s
        counts, prices = np.zeros(terms, np.int64), np.full(terms, zero[s], np.int64)
        counts[row[mine]], prices[row[mine]] = value[mine], price[mine]
        columns.append(_levels(counts, prices))
    same = rows.column("lo")[0] == rows.column("hi")[0]
    out = []
    for x, i in enumerate(order):
        for j in order[x + 1 :]:
            if same or at_side[i] != at_side[j]:
                out.append((names[i], names[j], _joint_value(columns[i], columns[j])))
    first, second, values = zip(*out) if out else ((), (), ())
    lang = rows.column("lang")[0].as_py()
    return pa.table(
        [pa.array([lang] * len(out), pa.string()), pa.array(first, pa.string()), pa.array(second, pa.string()), pa.array(values, pa.int64())],
        names=["lang", "a", "b", "value"],
    )


def _pair_values(cells: DataFrame, groups: DataFrame, kept: DataFrame) -> DataFrame:
    """``(lang, a, b, value)`` of every pair of sources, ``a`` before ``b``."""
    seat = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    seats = groups.select(
        "lang", "source", "total", "terms", F.expr(f"cast(ceil(greatest(terms, 1) / {BLOCK_TERMS}) as int)").alias("blocks"),
        F.floor(seat / TILE).cast("int").alias("tile"),
    )
    tiles = F.max("tile").over(Window.partitionBy("lang")) + 1
    seats = seats.withColumn("tiles", tiles)
    block = "cast(pmod(xxhash64(term), blocks) as int) as block"
    filled = kept.join(groups.groupBy("lang").agg(F.max("terms").alias("terms")), "lang").withColumn(
        "blocks", F.expr(f"cast(ceil(greatest(terms, 1) / {BLOCK_TERMS}) as int)")
    )
    filled = filled.selectExpr("lang", block).groupBy("lang", "block").agg(F.count(F.lit(1)).alias("n"))
    heads = (
        seats.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
        .join(filled, ["lang", "block"], "left")
        .selectExpr(
            "lang", "block", "tile", "tiles", "source", "cast(null as string) as term", "coalesce(n, 0) as n",
            f"if(terms = 0, 0, {_price('0', 'total', 'greatest(terms, 1)')}) as price",
        )
    )
    body = cells.join(seats.select("lang", "source", "blocks", "tile", "tiles"), ["lang", "source"]).selectExpr(
        "lang", block, "tile", "tiles", "source", "term", "n", "price"
    )
    units = (
        heads.unionByName(body)
        .withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
        .selectExpr(
            "lang", "block", "least(tile, other) as lo", "greatest(tile, other) as hi",
            "if(tile <= other, 0, 1) as side", "source", "term", "n", "cast(price as long) as price",
        )
    )
    values = units.groupBy("lang", "block", "lo", "hi").applyInArrow(_block, "lang string, a string, b string, value long")
    return values.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def source_divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for every (language, source)
    found, even without terms.

    ``part`` ``pair``: ``item`` is each other source of the language, ``value``
    the sum over all kept terms of the distance between the two prices (0 if no
    term is kept).  ``part`` ``term``: ``item`` is each kept term that the
    source has and prices above its language, ``value`` the difference; the
    first ``top`` ranks only, which is the report's length.  Ranks run from 1
    by value descending, then item in UTF-8 order.

    A null text, language or source is the empty string.  Texts of any length
    are read whole; repeated rows count again.  An empty table gives no rows.
    Other columns are not read, whatever their names.  The intermediate tables
    stay in the shared checkpoint folder as long as the result may read them.
    """
    spark = docs.sparkSession
    counts, raw = staged(term_counts(docs, text, lang, source))
    kept, _ = staged(
        counts.where("term is not null").groupBy("lang", "term")
        .agg(F.sum("n").alias("whole"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= min_docs).select("lang", "term", "whole")
    )
    found, between = staged(counts.where("term is not null").select("lang", "source", "term", "n").join(kept, ["lang", "term"]))
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("whole").alias("lang_total"))
    groups, _ = staged(
        counts.where("term is null").select("lang", "source")
        .join(found.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(vocabulary, "lang", "left")
        .na.fill(0, ["total", "terms", "lang_total"])
    )
    cells, _ = staged(
        found.join(groups, ["lang", "source"]).select(
            "lang", "source", "term", "n", F.expr(_price("n", "total", "terms")).cast("long").alias("price"),
            F.expr(_price("whole", "lang_total", "terms")).cast("long").alias("lang_price"),
        )
    )
    discard(spark, raw)
    discard(spark, between)

    pairs = _pair_values(cells.drop("lang_price"), groups, kept)
    both = pairs.selectExpr("lang", "inline(array(named_struct('source', a, 'item', b), named_struct('source', b, 'item', a)))", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pair_rows = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    terms = cells.where("price > lang_price").selectExpr("lang", "source", "term as item", "price - lang_price as value")
    term_rows = (
        terms.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    )
    return pair_rows.unionByName(term_rows)

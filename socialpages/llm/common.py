"""Helpers shared by the text operators: table access, column checks and
Arrow-side word splitting.

Words are runs of characters other than space and U+0009-U+000D everywhere
in this subpackage (``[^\\x20\\x09-\\x0D]+``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from socialpages.plans.lineage import discard, staged

WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, through Spark's reader (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores added, so that it clashes with
    no column of ``df`` (column names compare without case, as in Spark)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


HOT_SHARE = 1000
HOT_ROWS = 10_000
SALTS = 64


def join_to_unique(left: DataFrame, right: DataFrame, key: str, deal_by: str, how: str = "inner", least: int = HOT_ROWS) -> DataFrame:
    """``left`` joined by ``key`` to ``right``, which has one row for each key, with the hot
    keys of ``left`` dealt out.

    A key is hot if it has more than a thousandth of ``left``'s rows (and more than
    ``least``), so there are fewer than a thousand of them: that bound lets the list be
    broadcast.  A hot key's rows go to ``SALTS`` partitions by ``deal_by``, and its one row
    on the right to each of them.  ``left`` is read twice."""
    bound = max(least, left.count() // HOT_SHARE)
    hot, salt = fresh(left, "_hot"), fresh(left, "_salt")
    keys = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(hot)).where(F.col(hot) > bound)
    keys, path = staged(keys)
    if keys.isEmpty():
        discard(left.sparkSession, path)
        return left.join(right, key, how)
    dealt = F.when(F.col(hot).isNotNull(), F.pmod(F.xxhash64(deal_by), F.lit(SALTS))).otherwise(0).cast("int")
    left = left.join(F.broadcast(keys), key, "left").withColumn(salt, dealt).drop(hot)
    copies = F.explode(F.sequence(F.lit(0), F.when(F.col(hot).isNotNull(), F.lit(SALTS - 1)).otherwise(0)))
    right = right.join(F.broadcast(keys), key, "left").withColumn(salt, copies).drop(hot)
    return left.join(right, [key, salt], how).drop(salt)


def words_sql(column: str) -> str:
    """Spark SQL for the array of words of a text column (null: no words)."""
    spaced = f"translate(coalesce({column}, ''), '\\t\\n\\u000B\\u000C\\r', '     ')"
    return f"filter(split({spaced}, ' ', -1), w -> w <> '')"


def words(column: str):
    return F.expr(words_sql(column))


def as_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, a null as the empty text."""
    return [b"" if t is None else t for t in texts.cast(pa.binary()).to_pylist()]


@dataclass
class Words:
    """The words of a batch of texts: text ``i`` has the words
    ``codes[offsets[i]:offsets[i + 1]]``, each an index into ``unique``."""

    offsets: np.ndarray
    codes: np.ndarray
    unique: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)


def translated(texts: pa.Array, table: bytes) -> pa.Array:
    """The texts with each UTF-8 byte replaced by ``table``'s (which keeps the
    bytes of multi-byte characters), a null as the empty text."""
    whole = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")])
    _, ends, data = whole.buffers()
    ends = np.frombuffer(ends, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    body = memoryview(data)[ends[0] : ends[-1]].tobytes().translate(table) if data else b""
    return pa.LargeStringArray.from_buffers(len(whole), pa.py_buffer((ends - ends[0]).tobytes()), pa.py_buffer(body))


def split_words(texts: pa.Array) -> Words:
    """Words of every text, vectorised (Arrow's ASCII white space is exactly
    the six separators; the empty strings it leaves at the ends are dropped)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    offsets = offsets - offsets[0]
    encoded = flat.dictionary_encode()
    codes = encoded.indices.to_numpy().astype(np.int64)
    unique = encoded.dictionary
    full = (pc.binary_length(unique).to_numpy(zero_copy_only=False) > 0)[codes] if len(codes) else np.zeros(0, bool)
    if not full.all():
        kept = np.concatenate([[0], np.cumsum(full)])
        offsets, codes = kept[offsets], codes[full]
    return Words(offsets, codes, unique)


def text_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 8 << 20):
    """The batch in row slices of about ``max_bytes`` of text each (one row at
    least), so that working memory does not follow the batch size."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(sizes):
        return
    group = (np.cumsum(sizes) - sizes) // max_bytes
    starts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(sizes)]])
    for a, b in zip(starts[:-1], starts[1:]):
        yield batch.slice(int(a), int(b - a))


def by_slices(function, texts: pa.Array, *others: pa.Array) -> pa.Array:
    """``function`` of the arrays, worked out over slices of about 8 MB of text."""
    batch = pa.record_batch([texts, *others], ["text", *map(str, range(len(others)))])
    parts = [function(*part.columns) for part in text_slices(batch, "text")]
    return pa.concat_arrays(parts) if parts else function(texts, *others)

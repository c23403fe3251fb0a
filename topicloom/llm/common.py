"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows that one window slice should hold at most, on average.
SLICE_ROWS = 1 << 14
# Bytes of text that a task works on at once.
CHUNK_BYTES = 2 << 20


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def hex_digits(rows: int, groups: int = 1) -> int:
    """Hex digits of an md5 key that cut ``rows`` rows in ``groups`` groups into slices of about SLICE_ROWS."""
    digits = 0
    while groups * SLICE_ROWS * 16**digits < rows:
        digits += 1
    return digits


def sliced_rank(rows: DataFrame, group: Sequence[str], order: Sequence[str], key: str, ties: Sequence[Column], digits: int, name: str) -> DataFrame:
    """Adds the position (from 0) of each row in its group, in the order of ``order``, ``key``, ``ties``.

    ``key`` is an md5 in hex. A group is never sorted as a whole: rows are numbered within slices of equal ``order``
    and equal leading ``digits`` of the key, and each slice starts where the counts of the slices before it end. The
    result does not depend on ``digits``.
    """
    cut = F.substring(key, 1, digits) if digits else F.lit("")
    parts = [*group, *order, "__cut"]
    marked = rows.withColumn("__cut", cut)
    before = Window.partitionBy(*group).orderBy(*order, "__cut").rowsBetween(Window.unboundedPreceding, -1)
    counts = marked.groupBy(*parts).agg(F.count(F.lit(1)).alias("__n"))
    starts = counts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    within = Window.partitionBy(*parts).orderBy(key, *ties)
    ranked = marked.withColumn("__place", F.row_number().over(within) - 1)
    same = None
    for c in parts:
        one = ranked[c].eqNullSafe(starts[c])
        same = one if same is None else same & one
    kept = [ranked[c] for c in rows.columns]
    return ranked.join(starts, same).select(*kept, (starts["__start"] + ranked["__place"]).alias(name))


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of at most about ``limit`` bytes of text (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, base + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end
    # Workers are used again by later tasks, which need the memory.
    pa.default_memory_pool().release_unused()


def text_bytes(column: pa.Array):
    """The text column as one byte array and the places where its rows begin; null counts as empty."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]


def word_codes(column: pa.Array, table=None, lower: bool = True):
    """Row and code of each word of the texts in text order, and the distinct words as bytes.

    Words are runs of bytes that ``table`` (256 bytes to bytes) does not map to a blank; without a table they are runs
    of anything but ASCII white space.
    """
    import numpy as np
    import pyarrow.compute as pc

    column = pc.fill_null(column, "")
    flat, offsets = text_bytes(pc.utf8_lower(column) if lower else column)
    if table is None:
        inside = (flat != 32) & ((flat < 9) | (flat > 13))
    else:
        flat = table[flat]
        inside = flat != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    # A run that goes on over the end of a text is cut there.
    cuts = np.unique(offsets[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < len(flat))]
    cuts = cuts[inside[cuts] & inside[cuts - 1]]
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    rows = np.searchsorted(offsets, starts, side="right") - 1
    # Only the bytes of words, one after the other, make the column of words.
    total = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    held = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(total.tobytes()), pa.py_buffer(flat[inside].tobytes())])
    coded = held.dictionary_encode()
    return rows, coded.indices.to_numpy(), coded.dictionary.to_pylist()


def word_hashes(column: pa.Array):
    """64-bit hashes of the words of the texts (lower case, split at white space), and where each text begins."""
    import numpy as np
    from pandas.util import hash_array

    rows, codes, words = word_codes(column)
    hashed = hash_array(np.array(words, dtype=object), categorize=False) if words else np.zeros(0, np.uint64)
    return hashed[codes], np.searchsorted(rows, np.arange(len(column) + 1))


def mixed(x):
    """A fixed permutation of 64-bit numbers that spreads every bit (a published finaliser)."""
    import numpy as np

    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack_texts(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``column`` (a text without nulls) as compressed bytes in ``packed``; its shuffle is half the size."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=3)
        for batch in text_chunks(batches, column):
            names = [c for c in batch.schema.names if c != column]
            texts = batch.column(column).cast(pa.large_binary())
            packed = [len(t).to_bytes(8, "little") + codec.compress(t, asbytes=True) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(packed, pa.binary())], names=[*names, "packed"])

    fields = [f for f in rows.schema.fields if f.name != column]
    return rows.mapInArrow(press, StructType([*fields, StructField("packed", BinaryType())]))


def unpack(packed: bytes) -> bytes:
    """The bytes of one packed text."""
    size = int.from_bytes(packed[:8], "little")
    return pa.Codec("zstd").decompress(packed[8:], size, asbytes=True) if size else b""

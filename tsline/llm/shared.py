"""Helpers shared by the text operators: words, scratch tables, Arrow text views, components."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsline.plans.materialize import write_scratch

#: A word is a run of bytes that are neither space nor one of the controls 09-0D.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def free_shuffles(df: DataFrame) -> None:
    """Let Spark drop the shuffle files of plans that nothing refers to any more.

    Its cleaner waits for the driver's collector, which a large heap runs seldom;
    called between two steps that move much, so that disks hold one of them.
    """
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def require(df: DataFrame, *cols: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the input has {df.columns}")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores behind those that ``df`` has already."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def word_count(text):
    """Number of words of a string column; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, or those of a binary one (null: empty), and each row's start, plus the end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64,
                            len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


#: Bytes of text that a Python worker handles at a time.
AT_ONCE = 1 << 20


def give_back() -> None:
    """Hand freed memory back, at the end of a worker's task: the process stays and waits for the next one."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def bounded(batches, column: int, limit: int = AT_ONCE):
    """Arrow batches cut so that a string column has at most ``limit`` bytes in each, or one row."""
    for batch in batches:
        _, offsets = text_buffer(batch.column(column))
        row = 0
        while row < batch.num_rows:
            stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
            yield batch.slice(row, stop - row)
            row = stop
        give_back()


def slices(data: np.ndarray, offsets: np.ndarray, kind=pa.large_binary()) -> pa.Array:
    """Adjacent slices of a byte buffer as an Arrow array, without a copy of the bytes."""
    return pa.Array.from_buffers(kind, len(offsets) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)])


def word_view(column: pa.Array, fold: bool = False, inside: np.ndarray | None = None):
    """Distinct words of a batch, each word's index among them, and each row's first word, plus the end.

    With ``fold``, A-Z are lower-cased. ``inside`` says for each of the 256 byte
    values whether it is part of a word; without it, the gaps of ``WORD`` end words.
    """
    data, offsets = text_buffer(column)
    if fold:
        data = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)
    solid = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D))) if inside is None else inside[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[starts] = solid[starts]
    packed = np.concatenate([[0], np.cumsum(solid)])  # place of a byte once gaps are gone
    at = packed[:-1][first]
    words = slices(data[solid], np.append(at, packed[-1]), pa.large_binary()).dictionary_encode()
    before = np.concatenate([[0], np.cumsum(first)])
    return words.dictionary, np.asarray(words.indices).astype(np.int64), before[offsets]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(id, component)``; the smallest id names one.

    Alternating large-star and small-star steps: each step is a grouped minimum
    and a join, and only edge rows move, so no component is gathered anywhere.
    Every step is written to the shared folder. Ids without an edge are left
    out; self loops and repeated edges are harmless; no edges give no rows.
    """
    cur = write_scratch(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while True:
        # large star: every neighbour above a node is tied to the node's smallest neighbour
        both = cur.select("a", "b").union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        # small star: every neighbour below a node, and the node, are tied to the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        down = large.join(low, "a")
        small = (down.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        cur = write_scratch(small, name)
        # done when all are stars: no node is below one and above another, and none has two roots
        roots = cur.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        if (roots.where("n > 1").select("a").limit(1)
                .union(cur.join(roots.select(F.col("a").alias("b")), "b", "left_semi").select("a").limit(1))).isEmpty():
            break
    members = cur.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    roots = members.select(F.col("component").alias("id"), "component").distinct()
    return members.union(roots)

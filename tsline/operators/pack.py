"""Packing lines into payloads.

A payload (batch) is at most ``batch_size`` lines of one key, consecutive in
time order, joined with newlines.  Group sizes are bounded by ``batch_size``
by construction, so the final ``groupBy`` never gathers an unbounded group.
The last batch of a key holds the remainder (B16).

Lines move once.  They are range-partitioned on (key, order, start of the line),
so sampled bounds split a hot key over many tasks; each task sorts its part and
numbers every key's lines, and the result is written.  A partition's first key is
the only one that may have begun before it, so a running sum over the partitions'
runs gives one number for each partition: the rank its first line has in its key.
Payloads are then cut where the lines lie.  Only pieces of payloads that a
partition's bound cuts, or whose end a task does not see, are brought together
afterwards: at most the last payload of a key and two for each partition or split.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsline.functions.text import java_trim
from tsline.functions.timeunit import floor_div
from tsline.operators.rank import partitions_for
from tsline.plans.materialize import write_scratch

DEFAULT_BATCH_SIZE = 5000


def _check_size(batch_size: int) -> None:
    if not isinstance(batch_size, int) or batch_size <= 0:
        raise ValueError(f"batch size must be a positive integer, got {batch_size!r}")


def clean_rows(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Trim every line and drop null or blank ones, row by row (B4), before any
    grouping: a compiled projection, no per-element lambda after the collect."""
    trimmed = lines.withColumn(line_col, java_trim(F.col(line_col)))
    return trimmed.where(F.col(line_col).isNotNull() & (F.col(line_col) != ""))


def _finish(grouped: DataFrame) -> DataFrame:
    """``_items`` (sorted structs with field ``l``, already clean) -> body, n_lines, n_bytes."""
    return (grouped.withColumn("body", F.array_join(F.col("_items")["l"], "\n"))
                   .withColumn("n_lines", F.size("_items").cast("bigint"))
                   .withColumn("n_bytes", F.octet_length("body").cast("bigint"))
                   .drop("_items"))


def _collect(df: DataFrame, group: Sequence[Column], order: Column, line_col: str) -> DataFrame:
    return df.groupBy(*group).agg(
        F.sort_array(F.collect_list(F.struct(order.alias("o"), F.col(line_col).alias("l"))))
         .alias("_items"))


#: Characters of a line that the range partitioning looks at; lines equal in these stay together.
RANGE_CHARS = 128


def _changes(columns: list[pa.Array], n: int) -> np.ndarray:
    """Rows that differ from the row before in any column; the first row does.  Nulls equal nulls, NaN equals NaN."""
    new = np.zeros(n, bool)
    new[:1] = True
    if n > 1:
        for col in columns:
            a, b = col.slice(0, n - 1), col.slice(1)
            same = pc.fill_null(pc.equal(a, b), False)
            same = pc.or_(same, pc.and_(pc.is_null(a, nan_is_null=True), pc.is_null(b, nan_is_null=True)))
            new[1:] |= ~np.asarray(same)
    return new


def _columns(batch: pa.RecordBatch, names: Sequence[str]) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(k)) for k in names]


def _number(keys: Sequence[str]):
    """Adds to sorted rows the partition, the place in the key's run there, and whether the run is the first."""
    def run(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        held, count, first = None, 0, True  # the last row's key, lines of its run so far, still the first run
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            cols = _columns(batch, keys)
            with_last = cols if held is None else [pa.concat_arrays([h, c]) for h, c in zip(held, cols)]
            new = _changes(with_last, n + (held is not None))[int(held is not None):]
            if not keys:
                new[:] = False
                new[:1] = held is None
            starts = np.flatnonzero(new)
            run_of = np.cumsum(new)  # 0: goes on from the batch before
            base = np.concatenate([[-count], starts])
            local = np.arange(n) - base[run_of]
            in_first = (run_of == 0) & first if held is not None else (run_of == 1)
            first = bool(in_first[-1])
            count = int(local[-1]) + 1
            held = [c.slice(n - 1) for c in cols]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, pid, np.int32)), pa.array(local), pa.array(in_first)],
                names=[*batch.schema.names, "_pid", "_local", "_first"])
    return run


def _assemble(keys: Sequence[str], line_col: str, size: int, whole: bool):
    """Payloads from rows ``(keys, line, _pid, _rank)`` in order: the whole ones, or the pieces of the others.

    A piece ends where the key, the payload or the partition changes.  It is whole
    when its first line opens a payload, and its last one fills it or is followed
    by another line of the partition.
    """
    def pieces(table: pa.RecordBatch, last: bool):
        n = table.num_rows
        rank = np.asarray(table.column(table.schema.get_field_index("_rank")))
        pid = np.asarray(table.column(table.schema.get_field_index("_pid")))
        new = _changes(_columns(table, keys), n)
        new[1:] |= (rank[1:] != rank[:-1] + 1) | (pid[1:] != pid[:-1]) | (rank[1:] // size != rank[:-1] // size)
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], n)
        if not last:  # the last piece may go on
            starts, ends, rest = starts[:-1], ends[:-1], table.slice(starts[-1])
        else:
            rest = None
        followed = np.zeros(len(starts), bool)
        inner = ends < n
        followed[inner] = pid[ends[inner]] == pid[starts[inner]]
        full = (rank[starts] % size == 0) & ((ends - starts == size) | followed)
        chosen = np.flatnonzero(full == whole)
        lines = table.column(table.schema.get_field_index(line_col))
        take = np.concatenate([np.arange(starts[i], ends[i]) for i in chosen]) if len(chosen) else np.zeros(0, np.int64)
        many = ends[chosen] - starts[chosen]
        lists = pa.LargeListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(many)]), pa.int64()), lines.take(pa.array(take)))
        at = pa.array(starts[chosen])
        return rest, pa.RecordBatch.from_arrays(
            [*(c.take(at) for c in _columns(table, keys)), pa.array(rank[starts[chosen]] // size),
             pc.binary_join(lists, "\n").cast(lines.type), pa.array(many.astype(np.int64)),
             pa.array(rank[starts[chosen]])],
            names=[*keys, "batch_id", "body", "n_lines", "_start"])

    def run(batches):
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            rest, out = pieces(table, False)
            yield out
        if rest is not None:
            yield pieces(rest, True)[1]
    return run


def pack_by_count(lines: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE,
                  keys: Sequence[str] = (), order: Sequence[str] = ("time_ns",),
                  line_col: str = "line", num_partitions: int | None = None) -> DataFrame:
    """Lines -> payloads of at most ``batch_size`` lines per key.

    Rows are ordered by ``order`` then by the line text, so equal timestamps
    still give one deterministic packing.  Output: keys, batch_id (0-based per
    key), body, n_lines, n_bytes.
    """
    _check_size(batch_size)
    keys = list(keys)
    rows = clean_rows(lines, line_col)
    sort = [F.col(f"`{c}`") for c in [*keys, *order]]
    ranged = rows.repartitionByRange(num_partitions or partitions_for(rows), *sort,
                                     F.substring(F.col(f"`{line_col}`"), 1, RANGE_CHARS))
    kept = ranged.sortWithinPartitions(*sort, F.col(f"`{line_col}`")).select(
        *[F.col(f"`{c}`") for c in [*keys, line_col]])
    laid = T.StructType([*kept.schema, T.StructField("_pid", T.IntegerType()),
                         T.StructField("_local", T.LongType()), T.StructField("_first", T.BooleanType())])
    laid = write_scratch(kept.mapInArrow(_number(keys), laid), "pack-layout")

    key_cols = [F.col(f"`{k}`") for k in keys]
    runs = laid.groupBy("_pid", *key_cols).agg((F.max("_local") + 1).alias("n"), F.max("_first").alias("first"))
    before = Window.partitionBy(*key_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = write_scratch(runs.withColumn("_off", F.coalesce(F.sum("n").over(before), F.lit(0)))
                            .where("first").select("_pid", "_off"), "pack-offsets")
    # one row for each partition
    ranked = laid.join(F.broadcast(offsets), "_pid").select(
        *key_cols, F.col(f"`{line_col}`"), "_pid",
        (F.col("_local") + F.when(F.col("_first"), F.col("_off")).otherwise(0)).alias("_rank"))
    out = T.StructType([*[kept.schema[k] for k in keys], T.StructField("batch_id", T.LongType()),
                        T.StructField("body", T.StringType()), T.StructField("n_lines", T.LongType()),
                        T.StructField("_start", T.LongType())])
    complete = ranked.mapInArrow(_assemble(keys, line_col, batch_size, True), out).drop("_start")
    pieces = ranked.mapInArrow(_assemble(keys, line_col, batch_size, False), out).groupBy(
        *key_cols, F.col("batch_id")).agg(F.sort_array(F.collect_list(F.struct("_start", "body"))).alias("parts"),
                                          F.sum("n_lines").alias("n_lines"))
    joined = pieces.select(*key_cols, "batch_id", F.array_join(F.col("parts")["body"], "\n").alias("body"), "n_lines")
    return complete.unionByName(joined).withColumn("n_bytes", F.octet_length("body").cast("bigint"))


def pack_by_interval(lines: DataFrame, interval_ns: int, batch_size: int = DEFAULT_BATCH_SIZE,
                     keys: Sequence[str] = (), time_col: str = "time_ns",
                     line_col: str = "line", num_partitions: int | None = None) -> DataFrame:
    """Lines -> payloads per key and time interval, each at most ``batch_size``
    lines (B8: a flush happens when either bound is reached).

    Output adds ``bucket_ns`` (start of the interval) to the keys.
    """
    if interval_ns <= 0:
        raise ValueError("interval must be positive")
    bucketed = lines.withColumn("bucket_ns", floor_div(F.col(time_col), interval_ns)
                                * F.lit(interval_ns))
    return pack_by_count(bucketed, batch_size, list(keys) + ["bucket_ns"], [time_col],
                         line_col, num_partitions)


def payloads(lines: DataFrame, group: Sequence[str | Column], line_col: str = "line",
             order: str | None = None) -> DataFrame:
    """Join the lines of caller-defined, bounded groups into bodies.

    Null, empty and blank lines are dropped and each line is trimmed; a group
    whose lines are all blank yields no payload.  The caller guarantees the
    groups are bounded (e.g. ids divided by a batch size).
    """
    ordering = F.col(order) if order else F.col(line_col)
    group = [F.col(g) if isinstance(g, str) else g for g in group]
    return _finish(_collect(clean_rows(lines, line_col), group, ordering, line_col))


def route(lines: DataFrame, database: str | Column, measurement: str | Column,
          retention_policy: str | Column | None = None) -> DataFrame:
    """Attach destination columns (B12); a blank database is an error at write time."""
    def as_col(v):
        return F.lit(v) if isinstance(v, str) or v is None else v
    if isinstance(database, str) and not database.strip():
        raise ValueError("database must not be blank")
    return lines.select(as_col(database).cast("string").alias("database"),
                        as_col(retention_policy).cast("string").alias("retention_policy"),
                        as_col(measurement).cast("string").alias("measurement"), "*")

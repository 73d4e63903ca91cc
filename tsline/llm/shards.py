"""Shards along a Hilbert curve over several metadata columns.

Each column is quantised into ``2 ** bits`` buckets of like row counts that keep
its order, the buckets are the coordinates of a cell, and rows are sorted by the
cell's place on the Hilbert curve. Neighbouring places are neighbouring cells, so a
run of the curve spans a small range of every column: cut into shards, the files'
least and greatest values let a reader skip most files for a filter on any of them.

Law ``rows``: shard ``s`` of ``n`` holds the rows at places ``s * N / n`` to
``(s + 1) * N / n`` of the order, so counts differ by one at most. Law ``bytes``: a
row goes to the shard in which its first byte falls, when the sizes of all rows are
laid end to end and cut into equal parts; a shard is then off by one row's size at most.

Defined cases: null and NaN values lie in a column's first and last bucket; rows of
one cell are ordered by ``order``, null first; rows equal in every sort column are
interchangeable and spread over tasks and shards by their place in the input; an empty
table gives no rows; columns named like any other, also like results, are kept inside
the struct ``row``. Strings are quantised by the six bytes behind their common prefix,
so strings equal in these share a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsline.llm.shared import require, write_scratch
from tsline.operators.rank import partitions_for, rank_within

#: Bits of a coordinate; the curve's table has ``2 ** (bits * columns)`` rows.
BITS = 5
MOST_CELL_BITS = 16
_ACCURACY = 10_000
_PREFIX = 6


def _common_prefix(a: str | None, b: str | None) -> int:
    a, b = (a or "").encode(), (b or "").encode()
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def ordinals(rows: DataFrame, dims: list[str]) -> list[Column]:
    """A double for every column that keeps its order; strings lose what lies behind some bytes."""
    kinds = {c: rows.schema[c].dataType for c in dims}
    texts = [c for c in dims if isinstance(kinds[c], T.StringType)]
    ends = rows.agg(*[f(F.col(f"`{c}`")).alias(f"{f.__name__}{i}") for i, c in enumerate(texts)
                      for f in (F.min, F.max)]).first() if texts else None
    out = []
    for c in dims:
        col = F.col(f"`{c}`")
        if c in texts:
            i = texts.index(c)
            skip = _common_prefix(ends[f"min{i}"], ends[f"max{i}"])
            head = F.hex(F.substring(col.cast("binary"), skip + 1, _PREFIX))
            out.append(F.conv(F.rpad(head, 2 * _PREFIX, "0"), 16, 10).cast("double"))
        elif isinstance(kinds[c], (T.NumericType, T.BooleanType)):
            out.append(col.cast("double"))
        elif isinstance(kinds[c], (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out.append(F.unix_micros(col.cast("timestamp")).cast("double"))
        else:
            raise ValueError(f"{c} of type {kinds[c].simpleString()} has no order to quantise")
    return out


def quantised(rows: DataFrame, dims: list[str], bits: int = BITS) -> list[Column]:
    """The bucket of every column, 0 to ``2 ** bits - 1``, with like row counts in the buckets."""
    values = ordinals(rows, dims)
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = rows.agg(*[F.percentile_approx(F.when(~F.isnan(v), v), shares, _ACCURACY).alias(str(i))
                      for i, v in enumerate(values)]).first()
    out = []
    for v, bounds in zip(values, cuts):
        bucket = F.lit(0)
        for bound in sorted(set(bounds or [])):  # the greatest bucket whose bounds all lie below the value
            weight = sum(b == bound for b in bounds)
            bucket = bucket + F.when(v > bound, weight).otherwise(0)
        out.append(bucket.cast("int"))
    return out


def curve(spark, dims: int, bits: int) -> DataFrame:
    """``(cell, place)``: the place on the Hilbert curve of every cell of the grid.

    ``cell`` is the coordinates' bits side by side, the first in the highest. The
    coordinates are turned into the curve's by Skilling's transposition
    (Programming the Hilbert curve, 2004), a projection for each step.
    """
    if dims * bits > MOST_CELL_BITS:
        raise ValueError(f"{dims} columns of {bits} bits make a table beyond {MOST_CELL_BITS} bits")
    cells = spark.range(1 << (dims * bits)).select(F.col("id").cast("int").alias("cell"))
    names = [f"x{i}" for i in range(dims)]
    at = cells.select("cell", *[F.shiftright("cell", bits * (dims - 1 - i)).bitwiseAND((1 << bits) - 1).alias(n)
                                for i, n in enumerate(names)])
    first = F.col(names[0])
    for level in range(bits - 1, 0, -1):
        one, low = 1 << level, (1 << level) - 1
        for n in names:
            own = F.col(n)
            swap = first.bitwiseXOR(own).bitwiseAND(low)
            set_ = own.bitwiseAND(one) != 0
            changed = {names[0]: F.when(set_, first.bitwiseXOR(low)).otherwise(first.bitwiseXOR(swap))}
            if n != names[0]:
                changed[n] = F.when(set_, own).otherwise(own.bitwiseXOR(swap))
            at = at.withColumns(changed)
    for before, n in zip(names[:-1], names[1:]):
        at = at.withColumn(n, F.col(n).bitwiseXOR(F.col(before)))
    turn = F.lit(0)
    for level in range(bits - 1, 0, -1):
        turn = turn.bitwiseXOR(F.when(F.col(names[-1]).bitwiseAND(1 << level) != 0, (1 << level) - 1).otherwise(0))
    at = at.withColumn("turn", turn)
    place = F.lit(0)
    for level in range(bits - 1, -1, -1):
        for n in names:
            bit = F.shiftright(F.col(n).bitwiseXOR(F.col("turn")), level).bitwiseAND(1)
            place = F.shiftleft(place, 1).bitwiseOR(bit)
    return at.select("cell", place.cast("int").alias("place"))


def curve_shards(df: DataFrame, dims: list[str], shards: int, order: list[str], keep: list[str] | None = None,
                 law: str = "rows", size: Column | None = None, bits: int = BITS) -> DataFrame:
    """``(row, place, shard, slot)`` of every row: its ``keep`` columns (all, if not named) as a
    struct, its place on the curve, its shard and its place in the shard from 0.

    ``size`` is the length of a row for the law ``bytes``. Only the kept columns move.
    """
    if law not in ("rows", "bytes") or law == "bytes" and size is None:
        raise ValueError("law is rows, or bytes with a size")
    require(df, *dims, *order, *(keep or []))
    if len(set(dims)) < len(dims) or not dims or shards < 1:
        raise ValueError("dims names columns once each, and there is at least one shard")
    cell = F.lit(0)
    for bucket in quantised(df, dims, bits):
        cell = F.shiftleft(cell, bits).bitwiseOR(bucket)
    # the last sort column spreads rows that are equal in all others; splits number alike when read again
    given = df.select(F.struct(*[F.col(f"`{c}`") for c in keep or df.columns]).alias("row"), cell.alias("cell"),
                      *[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)],
                      (F.lit(0) if size is None else size).cast("long").alias("size"),
                      F.monotonically_increasing_id().alias("tie"))
    # 2 ** MOST_CELL_BITS rows at most
    placed = given.join(F.broadcast(curve(df.sparkSession, len(dims), bits)), "cell").drop("cell")
    sort = ["place", *[f"o{i}" for i in range(len(order))], "tie"]
    ranked = rank_within(placed.select("row", "size", *sort), [], sort, num_partitions=partitions_for(given))
    if law == "bytes":
        ranked = _bytes_before(ranked)
    at = F.col("before" if law == "bytes" else "_rank").alias("at")
    ranked = write_scratch(ranked.select("row", "place", "size", "_rank", at), "curve-order")
    total = ranked.agg(F.sum("size") if law == "bytes" else F.count(F.lit(1))).first()[0] or 0
    cut = ranked.withColumn("shard", F.expr(
        f"cast(least(at * {shards}L div {max(1, total)}L, {shards - 1}L) AS int)"))  # rows of no size may lie at the end
    starts = cut.groupBy("shard").agg(F.min("_rank").alias("start"))  # a row for each shard
    return cut.join(F.broadcast(starts), "shard").select(
        "row", "place", "shard", (F.col("_rank") - F.col("start")).alias("slot"))


def _bytes_before(ranked: DataFrame) -> DataFrame:
    """Sum of the sizes of all rows before each row, from the range partitions of the ranking."""
    runs = ranked.groupBy("_pid").agg(F.sum("size").alias("n"))
    runs = runs.select("_pid", F.coalesce(F.sum("n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"))
    inside = Window.partitionBy("_pid").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    return ranked.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        write_scratch(runs, "byte-runs"), "_pid").withColumn("before", F.col("before") + F.col("off"))


def write_shards(sharded: DataFrame, path: str, shards: int) -> None:
    """One folder a shard, its rows in the order of the curve, with the columns of ``row``.

    The folders' column is ``shard``, with underscores behind it where ``row`` has one of that name.
    """
    name, taken = "shard", {c.lower() for c in sharded.schema["row"].dataType.names}
    while name in taken:
        name += "_"
    (sharded.repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot")
     .select(F.col("shard").alias(name), "row.*").write.partitionBy(name).parquet(path))

"""Exact 0-based rank of each row within its key, safe for skewed keys.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` moves every row of a
key into one task; one key holding a third of the data would make one task
sort a third of the data.  Here instead:

1. range-partition on (key, order...) and sort inside each partition: the
   sampled range bounds split a hot key across many partitions.  Without an
   explicit count, there is a partition for each ``TARGET_BYTES`` of the plan's
   estimated input, and never fewer than ``spark.sql.shuffle.partitions``
   (adaptive execution merges small ones, but cannot split);
2. number rows inside each partition with ``monotonically_increasing_id``
   (partition id in the high bits, position in the low bits) and write the
   result once to the shared checkpoint folder, so every later use sees the
   same positions (lineage is cut; a lost executor cannot change them);
3. aggregate one row per (partition, key) run: first position and length.
   This table has at most (#keys + P) rows; a running sum over the runs of a
   key gives each run's offset;
4. join the runs back on (partition, key).  The runs were written as a table, so
   Spark knows their bytes and broadcasts them only under its own threshold.

rank = run offset + (position - run's first position).  Rows that are equal in
every sort column stay together in one partition.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsline.plans.materialize import write_scratch

TARGET_BYTES = 128 << 20
_POS_BITS = 33


def partitions_for(df: DataFrame) -> int:
    """Partitions for the estimated size of ``df``, at least ``spark.sql.shuffle.partitions``."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    floor = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a plan without statistics reports an absurd size: leave the count to the session
    return max(floor, -(-size // TARGET_BYTES)) if size < 1 << 60 else floor


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                num_partitions: int | None = None) -> DataFrame:
    """Add ``_rank`` (bigint, 0-based) = position of the row inside its key when
    sorted by ``order``, and ``_pid``, the range partition the row was placed in
    (a hot key shows up in several).  ``order`` should make rows unique (or rows
    equal in every sort column must be interchangeable) for a deterministic result.  Without keys,
    the running sum over the runs is one task's work: one row per partition."""
    keys, order = list(keys), list(order)
    sort_cols = [F.col(f"`{c}`") for c in keys + order]
    # positions are read after the exchange (coalesced or not) and written once,
    # so every later use sees the same partition ids
    ranged = df.repartitionByRange(num_partitions or partitions_for(df), *sort_cols)
    laid = (ranged.sortWithinPartitions(*sort_cols)
              .withColumn("_pos", F.monotonically_increasing_id()))
    laid = write_scratch(laid, "rank")
    laid = laid.withColumn("_pid", F.shiftright(F.col("_pos"), _POS_BITS))

    key_cols = [F.col(f"`{k}`") for k in keys]
    runs = laid.groupBy("_pid", *key_cols).agg(F.min("_pos").alias("_first"),
                                               F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key_cols).orderBy("_pid") \
                   .rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_pid", *key_cols, "_first",
                       F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    runs = write_scratch(runs, "rank-runs")
    # null keys: join with null-safe equality so their rows are ranked too
    cond = [laid["_pid"] == runs["_pid"]] + [laid[k].eqNullSafe(runs[k]) for k in keys]
    joined = laid.join(runs, cond)
    out_cols = [laid[c] for c in df.columns]
    rank = (runs["_off"] + laid["_pos"] - runs["_first"]).alias("_rank")
    return joined.select(*out_cols, rank, laid["_pid"])

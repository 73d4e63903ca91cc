"""Changelog rows (C3) and the upsert view (F1).

Spark rows carry no row kind, so the kind is an ordinary column holding
``+I``, ``-U``, ``+U`` or ``-D``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Row kinds that become points; the others are dropped.
KEPT_KINDS = ("+I", "+U")
ALL_KINDS = ("+I", "-U", "+U", "-D")


def changelog_filter(df: DataFrame, op_col: str = "op") -> DataFrame:
    """Keep INSERT and UPDATE_AFTER rows; drop UPDATE_BEFORE and DELETE."""
    return df.where(F.col(op_col).isin(*KEPT_KINDS))


def upsert_latest(df: DataFrame, key: Sequence[str], seq: str | Column, values: Sequence[str],
                  ties: Sequence[str] = (), total: bool = False) -> DataFrame:
    """Collapse rows with the same point key, the row with the highest ``seq`` wins.

    Of equal ``seq``, the highest ``ties`` columns (kept in the result) and then the
    greatest values win.  A single value without ``ties`` is the exception unless
    ``total`` is set: any of the tied rows may win, for a hash aggregate.

    A grouped aggregate rather than ``row_number`` over a window: it is combined
    map-side, so a key with millions of copies (replays) is reduced before the
    shuffle and never lands in one task.
    """
    seq_col = F.col(seq) if isinstance(seq, str) else seq
    keys = [F.col(f"`{k}`") for k in key]
    if len(values) == 1 and not ties and not total:
        # one fixed-width buffer per group: planned as a hash aggregate
        v = values[0]
        return (df.groupBy(*keys).agg(F.max_by(F.col(f"`{v}`"), seq_col).alias(v),
                                      F.max(seq_col).alias("seq")))
    # one struct, so that all columns come from the same row
    row = F.struct(seq_col.alias("s"), F.struct(*[F.col(f"`{c}`").alias(c) for c in ties] or [F.lit(0).alias("n")]).alias("t"),
                   F.struct(*[F.col(f"`{v}`").alias(v) for v in values]).alias("v"))
    agg = df.groupBy(*keys).agg(F.max(row).alias("_last"))
    return agg.select(*keys, *[F.col("_last.v")[v].alias(v) for v in values], F.col("_last.s").alias("seq"),
                      *[F.col("_last.t")[c].alias(c) for c in ties])

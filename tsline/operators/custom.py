"""User-supplied converters (K1, K2).

A user line converter is a callable ``df -> Column`` giving the line text (null
skips the record); a user point converter gives a POINT struct.  Both are
ordinary Spark expressions, so they stay in the JVM.  Code that cannot be
written as an expression can be wrapped with ``arrow_line_encoder``: it runs
per Arrow batch (vectorised), never per row.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LineEncoder = Callable[[DataFrame], Column]
PointEncoder = Callable[[DataFrame], Column]

_POINT_FIELDS = ("measurement", "tags", "fields", "time_ns")


def encode_custom(df: DataFrame, encoder: LineEncoder, keep: Sequence[str] = ()) -> DataFrame:
    """Apply a user line converter; null or empty results are dropped."""
    line = encoder(df)
    return (df.select(*[F.col(f"`{k}`") for k in keep], line.cast("string").alias("line"))
              .where(F.col("line").isNotNull() & (F.col("line") != "")))


def points_from(df: DataFrame, encoder: PointEncoder) -> DataFrame:
    """Apply a user point converter; null points are dropped."""
    point = encoder(df)
    out = df.select(point.alias("p")).where(F.col("p").isNotNull()).select("p.*")
    missing = [f for f in _POINT_FIELDS if f not in out.columns]
    if missing:
        raise ValueError(f"point converter result lacks {missing}")
    return out.select(*_POINT_FIELDS)


def arrow_line_encoder(fn: Callable[[pd.DataFrame], pd.Series], columns: Sequence[str]) -> LineEncoder:
    """Wrap opaque Python code (pandas in, line strings out) as a vectorised UDF."""
    @F.pandas_udf("string")
    def _udf(*cols: pd.Series) -> pd.Series:
        frame = pd.concat(cols, axis=1)
        frame.columns = list(columns)
        return fn(frame)

    def encoder(df: DataFrame) -> Column:
        return _udf(*[F.col(f"`{c}`") for c in columns])
    return encoder

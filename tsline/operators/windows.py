"""Tumbling-window aggregates written back as points.

Batch: the window is integer arithmetic on epoch ns (no time zone, exact).
Each aggregate is algebraic, so partial aggregation runs before the shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsline.functions.timeunit import floor_div, time_value
from tsline.operators.encode import encode_lines
from tsline.plans.roles import resolve

# Length of a duration unit in ns, for strings like '10 seconds'.
UNIT_NS = {
    "ns": 1, "nanosecond": 1, "us": 1_000, "microsecond": 1_000, "ms": 1_000_000,
    "millisecond": 1_000_000, "s": 1_000_000_000, "second": 1_000_000_000,
    "m": 60_000_000_000, "minute": 60_000_000_000, "h": 3_600_000_000_000,
    "hour": 3_600_000_000_000, "d": 86_400_000_000_000, "day": 86_400_000_000_000,
}


def duration_ns(text: str | int) -> int:
    """'10 seconds' / '1 day' / 500 (ns) -> ns."""
    if isinstance(text, int):
        return text
    number, unit = text.strip().split()
    unit = unit.lower().rstrip("s") if unit.lower() not in ("ns", "us", "ms", "s") else unit.lower()
    return int(number) * UNIT_NS[unit]


def tumble_agg(df: DataFrame, time: str, every: str | int, by: Sequence[str], value: str,
               precision: str = "ms") -> DataFrame:
    """AVG, MAX, MIN, COUNT(*) of ``value`` per tumbling window and ``by``.

    Output: window_start_ns, window_end_ns, by..., avg_value, max_value,
    min_value, record_count.  ``window_end_ns`` is the point time when the
    result is encoded (see ``encode_window_points``).
    """
    step = duration_ns(every)
    spec = resolve(df, "agg", tags=list(by), fields=[value], time=time, precision=precision)
    t = spec.time
    ns = time_value(t.col, t.dtype, precision) if t else None
    if ns is None:
        raise ValueError(f"time column {time!r} not found")
    start = (floor_div(ns, step) * F.lit(step)).alias("window_start_ns")
    by_cols = [F.col(f"`{b}`") for b in by]
    # a row without a time belongs to no window (the stream drops it too)
    agg = df.where(t.col.isNotNull()).groupBy(start, *by_cols).agg(
        F.avg(value).alias("avg_value"), F.max(value).alias("max_value"),
        F.min(value).alias("min_value"), F.count(F.lit(1)).alias("record_count"))
    return agg.select("window_start_ns", (F.col("window_start_ns") + F.lit(step))
                      .alias("window_end_ns"), *by, "avg_value", "max_value", "min_value",
                      "record_count")


def tumble_lines(df: DataFrame, measurement: str, time: str, every: str | int, by: Sequence[str],
                 value: str, precision: str = "ms", digits: int | None = None) -> DataFrame:
    """``tumble_agg`` written as points (E1): tags = ``by``, fields = the aggregates,
    time = the window end.  ``digits`` rounds the average first."""
    agg = tumble_agg(df, time, every, by, value, precision)
    if digits is not None:
        agg = agg.withColumn("avg_value", F.round("avg_value", digits))
    return encode_lines(agg, measurement, tags=list(by),
                        fields=["avg_value", "max_value", "min_value", "record_count"],
                        time="window_end_ns", precision="ns")

"""Questions asked of stored points.

Input is a POINT DataFrame (measurement, tags, fields, time_ns), usually from
``decode_lines``.  Every aggregate here is algebraic (count/min/max/sum) or a
distinct, so Spark combines it map-side before the shuffle and a hot series
or measurement is reduced before it reaches a single task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsline.functions.fmt import BOOL, FLOAT, INT, STRING
from tsline.functions.timeunit import floor_div
from tsline.operators.points import tags_line_text
from tsline.functions import escape as E

# Field type names shown by a field-key listing.
TYPE_NAMES = {INT: "integer", FLOAT: "float", BOOL: "boolean", STRING: "string"}


def _good(points: DataFrame) -> DataFrame:
    if "_corrupt" in points.columns:
        return points.where(F.col("_corrupt").isNull())
    return points


def series_key(measurement: Column, tags: Column) -> Column:
    """Canonical series text: escaped measurement + tags sorted by key."""
    return F.concat(E.escape_measurement(measurement), tags_line_text(tags))


def with_series(points: DataFrame) -> DataFrame:
    return points.withColumn("series", series_key(F.col("measurement"), F.col("tags")))


def measurements(points: DataFrame) -> DataFrame:
    """SHOW MEASUREMENTS."""
    return _good(points).select("measurement").distinct()


def count_points(points: DataFrame) -> DataFrame:
    """Points per measurement."""
    return _good(points).groupBy("measurement").agg(F.count(F.lit(1)).alias("n_points"))


def count_fields(points: DataFrame) -> DataFrame:
    """COUNT(*) per field: non-null values of each field key."""
    exploded = _good(points).select("measurement", F.explode(F.map_keys("fields")).alias("field_key"))
    return exploded.groupBy("measurement", "field_key").agg(F.count(F.lit(1)).alias("n_values"))


def tag_keys(points: DataFrame) -> DataFrame:
    """SHOW TAG KEYS (E5)."""
    return (_good(points).select("measurement", F.explode(F.map_keys("tags")).alias("tag_key"))
                         .distinct())


def field_keys(points: DataFrame) -> DataFrame:
    """SHOW FIELD KEYS with their types."""
    mapping = F.create_map(*[x for k, v in TYPE_NAMES.items() for x in (F.lit(k), F.lit(v))])
    exploded = _good(points).select("measurement", F.explode("fields").alias("field_key", "v"))
    return (exploded.select("measurement", "field_key",
                            mapping[F.col("v")["type"]].alias("field_type"))
                    .distinct())


def series_index(points: DataFrame) -> DataFrame:
    """One row per series with its point count and time range.

    Maps cannot be grouped on, so the series is keyed by its canonical text.
    """
    return (with_series(_good(points))
            .groupBy("measurement", "series")
            .agg(F.count(F.lit(1)).alias("n_points"), F.min("time_ns").alias("first_ns"),
                 F.max("time_ns").alias("last_ns")))


def filter_tag(points: DataFrame, key: str, value: str) -> DataFrame:
    """WHERE tag = value."""
    return _good(points).where(F.col("tags")[key] == F.lit(value))


def delete_by_time(points: DataFrame, after_ns: int | None = None, before_ns: int | None = None,
                   keep_corrupt: bool = False) -> DataFrame:
    """Points that survive ``DELETE ... WHERE time > after AND time < before``.

    Either bound may be left out; without both nothing is deleted.  Points
    without a time stay.  ``sources.lines.delete_points`` writes the survivors
    to a new folder.
    """
    bounds = []
    if after_ns is not None:
        bounds.append(F.col("time_ns") > F.lit(after_ns))
    if before_ns is not None:
        bounds.append(F.col("time_ns") < F.lit(before_ns))
    deleted = F.coalesce(reduce(and_, bounds), F.lit(False)) if bounds else F.lit(False)
    return (points if keep_corrupt else _good(points)).where(~deleted)


def latest_n(points: DataFrame, n: int, tag: tuple[str, str] | None = None) -> DataFrame:
    """Newest ``n`` points, optionally of one tag value.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its own top n and only those reach the final merge.
    """
    pts = filter_tag(points, *tag) if tag else _good(points)
    return with_series(pts).orderBy(F.col("time_ns").desc(), F.col("series")).limit(n)


def points_per_interval(points: DataFrame, interval_ns: int = 1_000_000_000) -> DataFrame:
    """Point counts per time interval and the rate per second."""
    bucket = (floor_div(F.col("time_ns"), interval_ns) * F.lit(interval_ns)).alias("bucket_ns")
    return (_good(points).groupBy(bucket).agg(F.count(F.lit(1)).alias("n_points"))
            .withColumn("points_per_second",
                        F.col("n_points") * F.lit(1e9) / F.lit(float(interval_ns))))

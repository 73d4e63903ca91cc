"""Stored lines: write as text, scan back into points and typed rows."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsline.functions.escape import TAG_PAIRS, escape_text
from tsline.operators.decode import LETTER_TYPES, decode_columns, decode_lines
from tsline.operators.explore import delete_by_time, filter_tag
from tsline.session import scratch_path

# A field key seen with several types reads back as the widest of them; integers that a
# double cannot hold ("I") read back as text next to floats.
EXACT_INT = 1 << 53
MAX_KEYS = 10_000
_WIDEN = {frozenset({"i", "f"}): "f", frozenset({"i", "I"}): "i"}


def write_lines(lines: DataFrame, path: str | None = None, line_col: str = "line",
                compression: str | None = None) -> str:
    """Write the ``line`` column as text files; returns the folder.

    Without a path the folder is a fresh one under ``spark.checkpoint.dir``.
    """
    path = path or scratch_path(lines.sparkSession, "lines")
    writer = lines.select(F.col(line_col).alias("value")).write.mode("errorifexists")
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)
    return path


def scan_points(spark: SparkSession, path: str, tag: tuple[str, str] | None = None) -> DataFrame:
    """Text files of lines -> POINT rows (+ ``_corrupt``).

    With ``tag``, only points with that tag value: lines whose text does not
    hold the escaped pair are left out before anything is decoded (C9).
    """
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    if tag is None:
        return decode_lines(lines)
    key, value = (escape_text(x, TAG_PAIRS) for x in tag)
    return filter_tag(decode_lines(lines.where(F.col("line").contains(f",{key}={value}"))), *tag)


def stream_points(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files of lines arriving in a folder -> a stream of POINT rows (+ ``_corrupt``) (A4)."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return decode_lines(reader.text(path).withColumnRenamed("value", "line"))


def delete_points(spark: SparkSession, path: str, out: str, after_ns: int | None = None,
                  before_ns: int | None = None) -> str:
    """Rewrite the lines at ``path`` without the deleted time range to the new folder ``out``.

    Lines stay as they are, byte for byte; corrupt ones are kept.
    """
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    points = decode_lines(lines.withColumn("_text", F.col("line")), keep=["_text"])
    kept = delete_by_time(points, after_ns, before_ns, keep_corrupt=True)
    return write_lines(kept, out, line_col="_text")


def infer_layout(points: DataFrame) -> tuple[list[str], dict[str, T.DataType]]:
    """Distinct tag keys and field keys with their types, in one pass.

    The result has one row per key and type, computed with a distributed
    ``distinct``, and becomes the column list, so more than ``MAX_KEYS`` of them
    is an error: name the columns wanted, or use ``scan_points`` (maps).
    """
    good = points.where(F.col("_corrupt").isNull())
    kinds = F.concat(
        F.transform(F.map_keys("tags"), lambda k: F.struct(F.lit("tag").alias("kind"),
                                                          k.alias("k"), F.lit("").alias("t"))),
        F.transform(F.map_entries("fields"), lambda e: F.struct(
            F.lit("field").alias("kind"), e["key"].alias("k"),
            F.when((e["value"]["type"] == "i") & (F.length(e["value"]["text"]) > 15)
                   & (F.abs(e["value"]["text"].try_cast("decimal(38,0)")) > EXACT_INT), "I")
            .otherwise(e["value"]["type"]).alias("t"))))
    rows = good.select(F.explode(kinds).alias("x")).select("x.*").distinct().limit(MAX_KEYS + 1).collect()
    if len(rows) > MAX_KEYS:
        raise ValueError(f"more than {MAX_KEYS} tag and field keys: name the columns to read")
    types: dict[str, set] = {}
    for r in rows:
        if r["kind"] == "field":
            types.setdefault(r["k"], set()).add(r["t"])
    fields = {}
    for k, ts in types.items():
        letter = next(iter(ts)) if len(ts) == 1 else _WIDEN.get(frozenset(ts), "s")
        letter = "i" if letter == "I" else letter
        fields[k] = LETTER_TYPES[letter]
    tags = sorted({r["k"] for r in rows if r["kind"] == "tag"})
    return tags, dict(sorted(fields.items()))


def read_back(spark: SparkSession, path: str, tags: list[str] | None = None,
              fields: Mapping[str, T.DataType] | None = None,
              measurement: str | None = None, corrupt: Observation | None = None) -> DataFrame:
    """``SELECT *`` over stored lines: one typed column per tag and field.

    Corrupt lines are left out; ``corrupt``, an observation, reports their
    number (``n_corrupt``) once the result has been computed.

    With a known layout the lines are decoded straight into columns (no maps);
    otherwise the layout is first found with a distinct over decoded points.
    """
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    if tags is None or fields is None:
        points = decode_lines(lines)
        if measurement is not None:
            points = points.where(F.col("measurement") == measurement)
        found_tags, found_fields = infer_layout(points)
        tags = found_tags if tags is None else tags
        fields = found_fields if fields is None else fields
    if corrupt is None:
        out = decode_columns(lines, tags, fields)
    else:
        out = decode_columns(lines, tags, fields, keep_corrupt=True)
        out = out.observe(corrupt, F.count("_corrupt").alias("n_corrupt"))
        out = out.where(F.col("_corrupt").isNull()).drop("_corrupt")
    if measurement is not None:
        out = out.where(F.col("measurement") == measurement)
    return out

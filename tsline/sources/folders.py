"""The measurement as a destination: a folder for each, however many there are.

Rows are range-partitioned by measurement and a hash of the line, so a measurement that
holds a third of all lines is written by many tasks and a task sees few measurements. Each
task sorts by measurement and Spark's writer then has one open file at a time. Lines without
a measurement, by the grammar, are kept in a folder of their own and read back with null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tsline.functions import escape as E
from tsline.operators.decode import MEAS

SCHEMA = "line string, measurement string"


def measurement_of(line: Column) -> Column:
    """The measurement at the start of a line; null where there is none."""
    name = F.regexp_extract(line, MEAS, 1)
    plain = F.instr(name, "\\") == 0
    return F.when(name != "", F.when(plain, name).otherwise(E.unescape(name)))


def write_by_measurement(lines: DataFrame, path: str, line_col: str = "line", partitions: int | None = None) -> str:
    """Append lines to one folder a measurement under ``path``; null lines are left out."""
    rows = lines.where(F.col(line_col).isNotNull()).select(
        F.col(line_col).alias("line"), measurement_of(F.col(line_col)).alias("measurement"))
    order = [F.col("measurement"), F.xxhash64("line")]
    spread = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    (spread.sortWithinPartitions("measurement").write.mode("append").partitionBy("measurement").parquet(path))
    return path


def read_by_measurement(spark: SparkSession, path: str, measurement: str | None = None) -> DataFrame:
    """``(line, measurement)``; of one measurement, only its folder's files are opened."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    return rows if measurement is None else rows.where(F.col("measurement") == measurement)

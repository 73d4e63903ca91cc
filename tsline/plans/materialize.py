"""Cutting lineage through a written table in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tsline.session import scratch_path


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Used where a result must be computed exactly once (positions that later
    stages join on) and must survive lost executors: the files live in the
    shared folder, and later scans only read the columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)

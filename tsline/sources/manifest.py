"""Versions of a folder's content: each commit writes the list of what is live as a new version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Manifest:
    """Versions ``v00000001``, ... under ``path/manifest``, tables of ``schema``.  One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        done = [n for n in names if n.startswith("v") and fs.exists(
            jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest/{n}/_SUCCESS"))]
        return sorted(int(n[1:]) for n in done)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest if none is named; no rows before the first commit."""
        if version is None:
            known = self.versions()
            version = known[-1] if known else 0
        if version == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/manifest/v{version:08d}")

    def commit(self, rows: DataFrame) -> int:
        """Write ``rows`` as the next version and return its number."""
        known = self.versions()
        version = (known[-1] if known else 0) + 1
        # a row for each file or run, as many as a driver's file index holds
        rows.select(*[c.split()[0] for c in self.schema.split(", ")]).coalesce(1).write.mode("errorifexists").parquet(
            f"{self.path}/manifest/v{version:08d}")
        return version

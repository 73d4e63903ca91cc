"""A log of upserts that is compacted as it grows.

Every micro-batch becomes a run: its rows, one for each point key, in buckets of the
key and sorted by it. When ``fan_in`` runs of a level exist they are merged into one run
of the next level, so a row is rewritten once a level and a reader finds few runs. A
manifest names the live runs and the last micro-batch in each; readers follow it, and a
replayed micro-batch that is in the log already changes nothing. A log belongs to one
stream, known by its checkpoint: another one, whose micro-batches are counted from 0
again, is an error.

Of rows of one key the highest ``seq`` wins; of equal ones the row of the later
micro-batch, then the greatest values, so the view is the same however runs were merged.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsline.operators.changelog import upsert_latest
from tsline.sources.manifest import Manifest

RUNS = "run string, level int, batch bigint, source string"


class UpsertLog:
    """Runs of ``key..., time_ns, values..., seq`` under ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], values: Sequence[str],
                 buckets: int = 16, fan_in: int = 8):
        if buckets < 1 or fan_in < 2:
            raise ValueError("a log has a bucket at least, and merges two runs at least")
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.values = [*key, "time_ns"], list(values)
        self.buckets, self.fan_in = buckets, fan_in
        self.manifest = Manifest(spark, path, RUNS)

    def runs(self) -> list:
        """Live runs, one row each."""
        return sorted(self.manifest.read().collect(), key=lambda r: (r["batch"], r["run"]))

    def add(self, batch: DataFrame, batch_id: int, source: str = "") -> None:
        """Append a micro-batch of a stream; one that is in the log already is left as it is."""
        live = self.runs()
        if any(r["source"] != source for r in live):
            raise ValueError(f"the log at {self.path!r} belongs to the stream {live[0]['source']!r}, not {source!r}")
        if any(r["batch"] >= batch_id for r in live):
            return
        rows = upsert_latest(batch, self.key, "seq", self.values, total=True).withColumn(
            "batch", F.lit(batch_id).cast("bigint"))
        name = f"l0-b{batch_id}"
        self._write(rows, name)
        self._commit([*live, (name, 0, batch_id, source)])
        self._merge_full_levels()

    def _write(self, rows: DataFrame, name: str) -> None:
        keys = [F.col(f"`{k}`") for k in self.key]
        bucket = F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")
        # a run that a failed attempt left behind has the same name
        (rows.withColumn("_bucket", bucket).repartition("_bucket").sortWithinPartitions("_bucket", *keys)
             .write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/runs/{name}"))

    def _commit(self, runs: list) -> None:
        self.manifest.commit(self.spark.createDataFrame([tuple(r) for r in runs], RUNS))

    def _read(self, runs: list) -> DataFrame:
        # bucket folders say where rows lie and are no column
        return self.spark.read.option("recursiveFileLookup", "true").parquet(
            *[f"{self.path}/runs/{r['run']}" for r in runs])

    def _merge_full_levels(self) -> None:
        level = 0
        while True:
            live = self.runs()
            own = [r for r in live if r["level"] == level]
            if not own and not any(r["level"] > level for r in live):
                return
            if len(own) >= self.fan_in:
                self._merge(own, level + 1, live)
            level += 1

    def _merge(self, own: list, level: int, live: list) -> None:
        last = max(r["batch"] for r in own)
        name = f"l{level}-b{last}"
        self._write(self._latest(self._read(own)), name)
        gone = {r["run"] for r in own}
        self._commit([r for r in live if r["run"] not in gone] + [(name, level, last, own[0]["source"])])

    def compact(self) -> None:
        """Merge all runs into one."""
        live = self.runs()
        if len(live) > 1:
            self._merge(live, max(r["level"] for r in live) + 1, live)

    def _latest(self, rows: DataFrame) -> DataFrame:
        return upsert_latest(rows, self.key, "seq", self.values, ties=["batch"])

    def view(self) -> DataFrame:
        """The current row of every key, with its ``seq``."""
        live = self.runs()
        if not live:
            raise ValueError(f"nothing was written to {self.path!r} yet")
        return self._latest(self._read(live)).drop("batch")

"""Latency quantiles that merge: one sketch per group of writes, stored and merged later.

Exact quantiles need every latency again; a sketch of a few hundred numbers does not, and
sketches of micro-batches, jobs or days merge into the sketch of all their writes. They are
Spark's own aggregates, combined map-side, so a group that holds a third of all rows costs
its tasks one sketch each. Null latencies are not counted; a group without any has no sketch
and no quantiles.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Accuracy of a sketch: about so many numbers are kept at the widest level.
K = 400
#: The share of values at or below an estimate is off its quantile by no more than this. It is twice
#: the error that sketches of 200 have at 99 % confidence, so those of ``K`` stay far inside it.
RANK_ERROR = 0.0266
QUANTILES = (0.5, 0.95, 0.99)


def latency_sketches(log: DataFrame, by: Sequence[str] = (), latency: str = "latency_ms") -> DataFrame:
    """``by`` columns, ``n_latencies``, ``latency_max`` and ``sketch`` of each group of writes."""
    value = F.col(latency).cast("bigint")
    return (log.where(value.isNotNull()).groupBy(*by)
               .agg(F.count(F.lit(1)).alias("n_latencies"), F.max(value).alias("latency_max"),
                    F.kll_sketch_agg_bigint(value, F.lit(K)).alias("sketch"))
               .where("n_latencies > 0"))


def add_sketches(log: DataFrame, path: str, by: Sequence[str] = (), latency: str = "latency_ms") -> None:
    """Append the sketches of one job or micro-batch to the table at ``path``."""
    latency_sketches(log, by, latency).write.mode("append").parquet(path)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merged_quantiles(sketches: DataFrame, by: Sequence[str] = (),
                     quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """``by`` columns, ``n_latencies``, ``latency_max``, ``quantile`` and ``latency`` of the merged sketches."""
    merged = sketches.groupBy(*by).agg(F.sum("n_latencies").alias("n_latencies"),
                                       F.max("latency_max").alias("latency_max"),
                                       F.kll_merge_agg_bigint("sketch", F.lit(K)).alias("sketch")).where(
        "n_latencies > 0")
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    found = F.kll_sketch_get_quantile_bigint("sketch", asked)
    return (merged.withColumn("found", F.explode(F.arrays_zip(asked.alias("quantile"), found.alias("latency"))))
                  .select(*by, "n_latencies", "latency_max", F.col("found.quantile").alias("quantile"),
                          F.col("found.latency").alias("latency")))

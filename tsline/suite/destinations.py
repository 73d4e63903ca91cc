"""Queries for destinations by measurement and for merged latency sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tsline.operators.encode import encode_lines
from tsline.session import scratch_path
from tsline.sources.folders import read_by_measurement, write_by_measurement
from tsline.sources.latency import QUANTILES, RANK_ERROR, add_sketches, merged_quantiles, read_sketches
from tsline.suite.packing import _ROUTED
from tsline.suite.registry import query, table


@query("route_folders", f"""SELECT event_type AS measurement, count(*) AS n_lines,
    CAST(sum(strlen({_ROUTED})) AS BIGINT) AS n_bytes FROM events GROUP BY ALL""")
def q_route_folders(spark, sf_dir):
    """Every measurement in a folder of its own, read back by folder."""
    lines = encode_lines(table(spark, sf_dir, "events"), F.col("event_type"), tags=["user_id"], fields=["value"],
                         time="ts")
    stored = read_by_measurement(spark, write_by_measurement(lines, scratch_path(spark, "folders")))
    return stored.groupBy("measurement").agg(F.count(F.lit(1)).alias("n_lines"),
                                             F.sum(F.octet_length("line")).cast("bigint").alias("n_bytes"))


@query("latency_sketch", f"""SELECT event_type, q.quantile, count(*) AS n_latencies,
    max(CAST(floor(value * 1000) AS BIGINT)) AS latency_max, true AS within_error
FROM events, (VALUES {', '.join(f'({q}::DOUBLE)' for q in QUANTILES)}) AS q(quantile) GROUP BY ALL""")
def q_latency_sketch(spark, sf_dir):
    """Sketches of five jobs, stored and merged; each quantile's rank is held against all rows."""
    path = scratch_path(spark, "sketches")
    rows = table(spark, sf_dir, "events").select("event_id", "event_type",
                                                 F.floor(F.col("value") * 1000).cast("bigint").alias("latency_ms"))
    for job in range(5):
        add_sketches(rows.where(F.pmod("event_id", F.lit(5)) == job), path, ["event_type"])
    found = merged_quantiles(read_sketches(spark, path), ["event_type"])
    # three rows an event type: the estimates are what is small
    beside = rows.join(F.broadcast(found), "event_type").groupBy("event_type", "quantile", "n_latencies", "latency_max")
    below = beside.agg(F.count_if(F.col("latency_ms") < F.col("latency")).alias("under"),
                       F.count_if(F.col("latency_ms") <= F.col("latency")).alias("upto"))
    return below.select("event_type", "quantile", "n_latencies", "latency_max",
                        ((F.col("under") / F.col("n_latencies") <= F.col("quantile") + RANK_ERROR)
                         & (F.col("upto") / F.col("n_latencies") >= F.col("quantile") - RANK_ERROR))
                        .alias("within_error"))

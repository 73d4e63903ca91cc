"""Folders by measurement, and latency sketches that merge."""

import os

from pyspark.sql import functions as F

from tsline.sources.folders import read_by_measurement, write_by_measurement
from tsline.sources.latency import RANK_ERROR, add_sketches, latency_sketches, merged_quantiles, read_sketches


def test_ten_thousand_destinations(spark, tmp_dir):
    rows = spark.range(30_000).select(F.concat(F.lit("m"), F.col("id") % 10_000, F.lit(" f="), F.col("id")).alias("line"))
    write_by_measurement(rows, tmp_dir, partitions=4)
    assert len([d for d in os.listdir(tmp_dir) if d.startswith("measurement=")]) == 10_000
    back = spark.read.schema("line string").parquet(f"{tmp_dir}/measurement=m77")
    assert sorted(r["line"] for r in back.collect()) == ["m77 f=10077", "m77 f=20077", "m77 f=77"]


def test_odd_measurements_come_back(spark, tmp_dir):
    lines = ["a\\ b f=1", "a\\,b,t=1 f=1", "a/b%=: f=2", "7 f=1", "07 f=1", "", " f=1", None, "A f=1", "é f=1", "a\\ b f=1"]
    write_by_measurement(spark.createDataFrame([(x,) for x in lines], "line string"), tmp_dir)
    back = [(r["measurement"], r["line"]) for r in read_by_measurement(spark, tmp_dir).collect()]
    assert sorted(back, key=str) == sorted([
        ("a b", "a\\ b f=1"), ("a b", "a\\ b f=1"), ("a,b", "a\\,b,t=1 f=1"), ("a/b%=:", "a/b%=: f=2"), ("7", "7 f=1"),
        ("07", "07 f=1"), (None, ""), (None, " f=1"), ("A", "A f=1"), ("é", "é f=1")], key=str)
    one = read_by_measurement(spark, tmp_dir, "a b")
    assert one.count() == 2
    assert "PartitionFilters: [isnotnull(measurement" in one._jdf.queryExecution().toString()


def test_a_hot_measurement_is_spread(spark, tmp_dir):
    rows = spark.range(20_000).select(F.concat(F.lit("hot f="), F.col("id")).alias("line"))
    write_by_measurement(rows, tmp_dir, partitions=4)
    assert len([f for f in os.listdir(f"{tmp_dir}/measurement=hot") if f.endswith(".parquet")]) == 4


def test_sketches_merge_within_the_error(spark, tmp_dir):
    # skewed values, one group with a third of the rows, parts of very different sizes
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 4)).alias("db"),
        (F.pow(F.col("id") % 5003, F.lit(2)) / 7).cast("bigint").alias("latency_ms"), "id")
    for low, high in ((0, 50), (50, 20_000), (20_000, 20_001), (20_001, 60_000)):
        add_sketches(rows.where((F.col("id") >= low) & (F.col("id") < high)), tmp_dir, ["db"])
    got = merged_quantiles(read_sketches(spark, tmp_dir), ["db"], [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]).collect()
    assert len(got) == 5 * 6
    values = {}
    for r in rows.collect():
        values.setdefault(r["db"], []).append(r["latency_ms"])
    for r in got:
        own = values[r["db"]]
        assert r["n_latencies"] == len(own) and r["latency_max"] == max(own)
        assert sum(v < r["latency"] for v in own) / len(own) <= r["quantile"] + RANK_ERROR
        assert sum(v <= r["latency"] for v in own) / len(own) >= r["quantile"] - RANK_ERROR


def test_sketches_of_nothing(spark):
    none = spark.createDataFrame([("a", None), ("b", 5), ("b", None)], "db string, latency_ms long")
    got = merged_quantiles(latency_sketches(none, ["db"]), ["db"], [0.5]).collect()
    assert [(r["db"], r["n_latencies"], r["latency"]) for r in got] == [("b", 1, 5)]
    assert merged_quantiles(latency_sketches(none.where("false"))).collect() == []

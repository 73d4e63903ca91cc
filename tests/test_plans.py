"""Plan shape: encoding is one codegen stage next to the scan, pruned and pushed down."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tsline.operators.encode import encode_lines
from tsline.operators.explore import latest_n, series_index
from tsline.operators.rank import rank_within
from tsline.sources.lines import scan_points, write_lines


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_encode_is_codegen_without_python(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    plan = _plan(encode_lines(ev, "events", tags=["event_type"], fields=["value"], time="ts"))
    assert "*(1) Project" in plan
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan
    assert "isnotnull(value" in plan       # rows without a field are dropped before concat


def test_spark_chooses_how_the_run_table_is_joined(spark):
    """By the bytes of the written table, under its own threshold."""
    df = spark.range(2000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    assert "BroadcastHashJoin" in _plan(rank_within(df, ["k"], ["t"], num_partitions=4))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(rank_within(df, ["k"], ["t"], num_partitions=4))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan


def test_explore_aggregates_are_partial_and_limits_take_ordered(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    pts = scan_points(spark, write_lines(encode_lines(ev, F.col("event_type"), tags=["user_id"],
                                                      fields=["value"], time="ts")))
    plan = _plan(series_index(pts))
    assert "partial_count" in plan or "partial_" in plan
    assert "TakeOrderedAndProject" in _plan(latest_n(pts, 5))

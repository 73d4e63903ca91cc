"""Smaller behaviours: routing checks, user point converters, layout widening, deletes."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsline.operators.custom import points_from
from tsline.operators.decode import decode_columns, decode_lines
from tsline.operators.explore import delete_by_time, points_per_interval
from tsline.operators.pack import route
from tsline.operators.rank import partitions_for
from tsline.operators.windows import tumble_agg
from tsline.sources.lines import delete_points, infer_layout, read_back, scan_points, write_lines


def test_route_rejects_blank_database(spark):
    df = spark.createDataFrame([("m v=1 1",)], "line string")
    with pytest.raises(ValueError):
        route(df, "  ", "m")
    out = route(df, "db", F.lit("m"), "rp1").collect()[0]
    assert (out["database"], out["retention_policy"], out["measurement"]) == ("db", "rp1", "m")


def test_point_converter_must_give_a_point(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError):
        points_from(df, lambda d: F.struct(F.lit("m").alias("measurement")))


def test_layout_widens_int_and_float(spark):
    lines = spark.createDataFrame([("m,h=a f=1i,s=\"x\" 1",), ("m f=2.5,b=true 2",)], "line string")
    tags, fields = infer_layout(decode_lines(lines))
    assert tags == ["h"]
    assert fields == {"b": T.BooleanType(), "f": T.DoubleType(), "s": T.StringType()}


def test_layout_keeps_large_integers_exact(spark):
    lines = spark.createDataFrame([("m f=9007199254740993i,g=1i 1",), ("m f=2.5,g=2.5 2",)], "line string")
    path = write_lines(lines)
    _, fields = infer_layout(decode_lines(lines))
    assert fields == {"f": T.StringType(), "g": T.DoubleType()}
    assert {r["f"] for r in read_back(spark, path).collect()} == {"9007199254740993", "2.5"}


def test_delete_range_and_rates(spark, tmp_dir):
    rows = [(f"m v={i}i {i * 10**9}",) for i in range(10)] + [("m v=99i",), ("broken",)]
    lines = spark.createDataFrame(rows, "line string")
    pts = decode_lines(lines)
    kept = lambda **b: sorted(-1 if r["time_ns"] is None else r["time_ns"] // 10**9 for r in delete_by_time(pts, **b).collect())
    assert kept(after_ns=2 * 10**9, before_ns=7 * 10**9) == [-1, 0, 1, 2, 7, 8, 9]
    assert kept(after_ns=7 * 10**9, before_ns=2 * 10**9) == [-1, *range(10)]
    assert kept(after_ns=7 * 10**9) == [-1, *range(8)]
    assert kept() == [-1, *range(10)]
    out = delete_points(spark, write_lines(lines), tmp_dir, after_ns=2 * 10**9)
    assert sorted(r["value"] for r in spark.read.text(out).collect()) == sorted(
        ["m v=0i 0", "m v=1i 1000000000", "m v=2i 2000000000", "m v=99i", "broken"])
    rates = points_per_interval(pts.where("time_ns IS NOT NULL"), 5 * 10**9).orderBy("bucket_ns").collect()
    assert [(r["n_points"], r["points_per_second"]) for r in rates] == [(5, 1.0), (5, 1.0)]


def test_one_corrupt_rule_and_column_names(spark):
    rows = ["m,time=a,x=1 time=1i,v=2i,x=\"q\" 5", "m v=1i,v=2i 5", "m,a=1,a=2 v=1i 5", "m v=1i 99999999999999999999",
            "broken", "m v=\"say \\\"hi\\\"\" 6", "m v=t 7"]
    lines = spark.createDataFrame([(r,) for r in rows], "line string")
    bad = {r["_corrupt"] for r in decode_lines(lines).collect()} - {None}
    path = write_lines(lines)
    seen = Observation("bad lines")
    back = read_back(spark, path, corrupt=seen)
    got = back.collect()
    assert len(got) == len(rows) - len(bad) and seen.get["n_corrupt"] == len(bad)
    assert len(set(back.columns)) == len(back.columns)
    assert {"time", "time_tag", "time_field", "x_tag", "x_field", "v", "time_ns", "measurement"} == set(back.columns)
    assert {r["v"] for r in got} == {"2", 'say "hi"', "true"}
    assert {r["time_tag"] for r in got} == {"a", None}
    kept = decode_columns(lines, ["a"], {"v": T.LongType()}, keep_corrupt=True)
    assert {r["_corrupt"] for r in kept.collect()} - {None} == bad


def test_rows_without_a_time_are_in_no_window(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "a", 1.0), (None, "a", 2.0)], "ts timestamp, k string, v double")
    rows = tumble_agg(df, "ts", "10 seconds", ["k"], "v").collect()
    assert [r["record_count"] for r in rows] == [1]


def test_partitions_follow_the_input(spark):
    small = spark.range(10)
    assert partitions_for(small) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert partitions_for(spark.range(1 << 31)) == (1 << 34) // (128 << 20)


def test_the_checkpoint_folder_must_be_named(spark):
    from tsline.session import ensure_checkpoint_dir, scratch_path
    folder = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(folder)
    assert ensure_checkpoint_dir(spark)


def test_tag_scan_filters_before_decoding(spark):
    rows = ["m,host=a\\ b v=1i 1", "m,host=a\\ bc v=2i 2", 'm,x=1 v="m,host=a\\\\ b" 3', "m,host=c v=4i 4", "broken,host=a\\ b"]
    path = write_lines(spark.createDataFrame([(r,) for r in rows], "line string"))
    got = scan_points(spark, path, tag=("host", "a b"))
    assert [r["time_ns"] for r in got.collect()] == [1]
    assert "Contains(" in got._jdf.queryExecution().toString()

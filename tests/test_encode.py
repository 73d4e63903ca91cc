"""Encoding rules, one test per fact of FIXTURES F4, F6, F7, F9, F10 and SURVEY 1.4."""

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import lines_of
from tsline.operators.encode import encode_lines
from tsline.operators.points import encode, points_to_lines, to_points


def one(spark, rows, schema, measurement, **kw):
    df = spark.createDataFrame(rows, schema)
    return lines_of(encode_lines(df, measurement, **kw))


def test_full_line(spark):
    got = one(spark, [("server01", "us-west", "Hello World", 42, 3.14, 1609459200000)],
              "host string, region string, message string, value int, temperature double, ts bigint",
              "cpu", tags=["host", "region"], time="ts")
    assert got == ['cpu,host=server01,region=us-west message="Hello World",value=42i,'
                   'temperature=3.14 1609459200000000000']


def test_no_tags(spark):
    got = one(spark, [(99.9, 1000)], "value double, count bigint", "metrics")
    assert got[0].startswith("metrics value=99.9,count=1000i ")


def test_only_field_null_gives_no_line(spark):
    assert one(spark, [("a", None)], "host string, v double", "m", tags=["host"]) == []


def test_tag_escaping(spark):
    got = one(spark, [("server 01", "region,east", "key=value", 1.0)],
              "a string, b string, c string, v double", "m", tags=["a", "b", "c"])
    assert got[0].startswith(r"m,a=server\ 01,b=region\,east,c=key\=value v=1.0 ")


def test_quote_escaping(spark):
    got = one(spark, [('He said "Hello"',)], "message string", "m")
    assert got[0].startswith(r'm message="He said \"Hello\"" ')


def test_backslash_and_newline_full_vs_compat(spark):
    rows = [("a\\b", "line1\nline2\\")]
    schema = "t string, s string"
    full = one(spark, rows, schema, "m", tags=["t"])[0]
    assert full.startswith('m,t=a\\\\b s="line1\\nline2\\\\" ')
    assert "\n" not in full
    compat = one(spark, rows, schema, "m", tags=["t"], escape="compat")[0]
    assert compat.startswith('m,t=a\\b s="line1\nline2\\" ')


def test_value_types(spark):
    schema = T.StructType([T.StructField(n, t) for n, t in [
        ("b", T.BooleanType()), ("y", T.ByteType()), ("sh", T.ShortType()), ("i", T.IntegerType()),
        ("l", T.LongType()), ("f", T.FloatType()), ("d", T.DoubleType()),
        ("dec", T.DecimalType(10, 2))]])
    got = one(spark, [(True, 1, 10, 100, 1000, 3.14, 2.718, Decimal("123.45"))], schema, "m")
    assert got[0].startswith('m b=true,y=1i,sh=10i,i=100i,l=1000i,f=3.14,d=2.718,dec="123.45" ')
    as_float = one(spark, [(Decimal("123.45"),)], "dec decimal(10,2)", "m", decimal_as="float")
    assert as_float[0].startswith("m dec=123.45 ")


def test_non_finite(spark):
    rows = [(math.nan, math.inf, -math.inf, 1.0)]
    schema = "a double, b double, c double, d double"
    got = one(spark, rows, schema, "m")
    assert got[0].startswith("m a=NaN,b=Infinity,c=-Infinity,d=1.0 ")
    dropped = one(spark, rows, schema, "m", non_finite="drop")
    assert dropped[0].startswith("m d=1.0 ")


def test_row_kinds(spark):
    df = spark.createDataFrame([("-D", 1.0), ("-U", 2.0), ("+I", 3.0), ("+U", 4.0)],
                               "op string, v double")
    got = lines_of(encode_lines(df, "m", fields=["v"], time=None, op_col="op"))
    assert sorted(x.split(" ")[1] for x in got) == ["v=3.0", "v=4.0"]


def test_bigint_time_precisions(spark):
    df = spark.createDataFrame([(1756080005, 1.0)], "t bigint, v double")
    assert lines_of(encode_lines(df, "m", time="t", precision="us"))[0].endswith(" 1756080005000")
    assert lines_of(encode_lines(df, "m", time="t"))[0].endswith(" 1756080005000000")
    small = spark.createDataFrame([(480_000, 1.0)], "t bigint, v double")
    assert lines_of(encode_lines(small, "m", time="t", precision="m"))[0].endswith(
        f" {480_000 * 60_000_000_000}")
    assert lines_of(encode_lines(small, "m", time="t", precision="h"))[0].endswith(
        f" {480_000 * 3_600_000_000_000}")
    with pytest.raises(ValueError):
        encode_lines(df, "m", time="t", precision="fortnight")


def test_timestamp_time_ns_and_compat(spark):
    ts = dt.datetime(2021, 1, 1, 0, 0, 0)
    for ttype in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame([(ts, 1.0)], f"t {ttype}, v double")
        assert lines_of(encode_lines(df, "m", time="t"))[0].endswith(" 1609459200000000000")
        assert lines_of(encode_lines(df, "m", time="t", time_unit="compat"))[0].endswith(
            " 1609459200000")


def test_time_is_zone_independent(spark):
    ts = dt.datetime(2024, 7, 3, 9, 46, 40, 120000)
    df = spark.createDataFrame([(ts, 1.0)], "t timestamp_ntz, v double")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = lines_of(encode_lines(df, "m", time="t"))[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got.endswith(" 1720000000120000000")


def test_missing_time_is_now(spark):
    got = one(spark, [(1.0,)], "v double", "m")
    stamp = int(got[0].rsplit(" ", 1)[1])
    assert abs(stamp / 1e9 - dt.datetime.now(dt.timezone.utc).timestamp()) < 3600


def test_empty_tag_and_empty_field(spark):
    got = one(spark, [("", "")], "empty_tag string, empty_field string", "m", tags=["empty_tag"])
    assert got[0].startswith('m,empty_tag= empty_field="" ')
    dropped = one(spark, [("", "x")], "t string, f string", "m", tags=["t"], empty_tag="drop")
    assert dropped[0].startswith('m f="x" ')


def test_f4_all_types_sql_rows(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 0), "id1", 42, 100000, 3.14, 2.718, True, "test",
             Decimal("123.45")),
            (dt.datetime(2024, 1, 1, 0, 0, 1), "id2", -10, -999999, -1.23, -456.78, False,
             "example", Decimal("999.99"))]
    schema = ("ts timestamp, id string, int_val int, bigint_val bigint, float_val float, "
              "double_val double, bool_val boolean, string_val string, decimal_val decimal(10,2)")
    got = one(spark, rows, schema, "type_test", tags=["id"], time="ts")
    assert got == [
        'type_test,id=id1 int_val=42i,bigint_val=100000i,float_val=3.14,double_val=2.718,'
        'bool_val=true,string_val="test",decimal_val="123.45" 1704067200000000000',
        'type_test,id=id2 int_val=-10i,bigint_val=-999999i,float_val=-1.23,double_val=-456.78,'
        'bool_val=false,string_val="example",decimal_val="999.99" 1704067201000000000']


def test_f6_roles_and_nulls(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 0), "dev1", "us-east", "active", 100.5, 200.3),
            (dt.datetime(2024, 1, 1, 0, 0, 1), "dev2", "us-west", "inactive", None, 150.7),
            (dt.datetime(2024, 1, 1, 0, 0, 2), "dev3", "us-south", "active", 75.2, None)]
    schema = ("event_time timestamp, device_id string, region string, status string, "
              "metric1 double, metric2 double")
    got = one(spark, rows, schema, "custom_metrics", tags="device_id, region ,status",
              fields="metric1,metric2", time="event_time")
    assert got == [
        "custom_metrics,device_id=dev1,region=us-east,status=active metric1=100.5,metric2=200.3 "
        "1704067200000000000",
        "custom_metrics,device_id=dev2,region=us-west,status=inactive metric2=150.7 "
        "1704067201000000000",
        "custom_metrics,device_id=dev3,region=us-south,status=active metric1=75.2 "
        "1704067202000000000"]


def test_tags_sorted_fields_in_schema_order(spark):
    got = one(spark, [("1", "2", 1, 2)], "zeta string, alpha string, f2 int, f1 int", "m",
              tags=["zeta", "alpha"])
    assert got[0].startswith("m,alpha=2,zeta=1 f2=1i,f1=2i ")


def test_numeric_and_bool_tags(spark):
    got = one(spark, [(123, True, 3.14, 1.0)], "i int, b boolean, d double, v double", "m",
              tags=["i", "b", "d"])
    assert got[0].startswith("m,b=true,d=3.14,i=123 v=1.0 ")


def test_timestamp_field_iso_text(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 0),), (dt.datetime(2024, 1, 1, 0, 0, 5),),
            (dt.datetime(2024, 1, 1, 0, 0, 5, 120000),), (dt.datetime(2024, 1, 1, 0, 0, 5, 123456),)]
    got = one(spark, rows, "t timestamp_ntz", "m")
    texts = [x.split(" ")[1] for x in got]
    assert texts == ['t="2024-01-01T00:00"', 't="2024-01-01T00:00:05"',
                     't="2024-01-01T00:00:05.120"', 't="2024-01-01T00:00:05.123456"']


def test_unknown_role_names_ignored_and_errors(spark):
    df = spark.createDataFrame([("a", 1.0)], "h string, v double")
    assert lines_of(encode_lines(df, "m", tags="h, nope", fields="v, nope2"))[0].startswith(
        "m,h=a v=1.0 ")
    with pytest.raises(ValueError):
        encode_lines(df, "m", tags=["h"], fields=["h", "v"])
    with pytest.raises(ValueError):
        encode_lines(df, "m", tags=["h"], fields={})
    with pytest.raises(ValueError):
        encode_lines(df, "  ")
    with pytest.raises(TypeError):
        encode_lines(spark.createDataFrame([([1],)], "a array<int>"), "m")


def test_builder_with_computed_columns(spark):
    df = spark.createDataFrame([("x", 2.0, 5)], "host string, v double, t bigint")
    got = lines_of(encode_lines(df, "m", tags={"env": F.lit("prod"), "h": F.upper("host")},
                                fields={"double": F.col("v") * 2}, time=F.col("t"),
                                precision="s"))
    assert got == ["m,env=prod,h=X double=4.0 5000000000"]


def test_measurement_from_column(spark):
    df = spark.createDataFrame([("cpu load", 1.0)], "name string, v double")
    got = lines_of(encode_lines(df, F.col("name"), fields=["v"]))
    assert got[0].startswith(r"cpu\ load v=1.0 ")


def test_point_path_marker_and_equivalence(spark):
    df = spark.createDataFrame([("server01", None, 1704067200000)], "host string, v double, t bigint")
    pts = to_points(df, "m", tags=["host"], time="t", on_empty="marker")
    assert lines_of(points_to_lines(pts)) == ["m,host=server01 _empty=true 1704067200000000000"]
    assert lines_of(encode_lines(df, "m", tags=["host"], time="t", on_empty="marker")) == \
        ["m,host=server01 _empty=true 1704067200000000000"]
    cpu = spark.createDataFrame([("server01", "cpu0", 75.5, 1)], "host string, cpu string, "
                                "usage double, t bigint")
    line = lines_of(encode(cpu, "cpu_metrics", tags=["host"], time="t", path="line"))
    point = lines_of(encode(cpu, "cpu_metrics", tags=["host"], time="t", path="point"))
    assert line == point == ['cpu_metrics,host=server01 cpu="cpu0",usage=75.5 1000000']
    with pytest.raises(ValueError):
        encode(cpu, "m", path="json")


def test_overflow_modes(spark):
    df = spark.createDataFrame([(9_000_000_000_000_000, 1.0)], "t bigint, v double")
    with pytest.raises(Exception):
        encode_lines(df, "m", time="t", precision="s").collect()
    got = lines_of(encode_lines(df, "m", time="t", precision="s", overflow="null"))
    assert got == []       # the overflowing row is left out instead of failing the task


def test_arrow_line_encoder_for_opaque_code(spark):
    from tsline.operators.custom import arrow_line_encoder, encode_custom
    from tsline.session import ship_package
    ship_package(spark)
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "host string, v double")

    def my_lines(pdf):   # runs once per Arrow batch, never per row
        out = "m,host=" + pdf["host"] + " v=" + pdf["v"].astype(str)
        return out.where(pdf["v"].notna(), None)
    got = lines_of(encode_custom(df, arrow_line_encoder(my_lines, ["host", "v"])))
    assert got == ["m,host=a v=1.5"]


def test_overflow_raises_without_ansi(spark):
    df = spark.createDataFrame([(9_000_000_000_000_000, 1.0)], "t bigint, v double")
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        with pytest.raises(Exception, match="overflows"):
            encode_lines(df, "m", time="t", precision="s").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)

"""The lineproto sink: options, retries, timeouts, adaptive size, routing, SQL insert."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tsline.sources.delivery import (read_payload_lines, read_write_log, register, send_lines,
                                     write_stats)
from tsline.sources.sink import backoff_ms, next_batch_size, parse_options
from tsline.plans.roles import split_names


@pytest.fixture(autouse=True)
def _faults(spark):
    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(__file__), "faults.py"))


def _lines(spark, n=2500, parts=3):
    return spark.range(n).select(F.format_string("m,k=%d v=%di %d", F.col("id") % 7, F.col("id"),
                                                 F.col("id")).alias("line")).repartition(parts)


def test_options_validation():
    with pytest.raises(ValueError):
        parse_options({"path": "/x", "database": "  "})
    with pytest.raises(ValueError):
        parse_options({"path": "/x", "database": "d", "batch-size": "0"})
    with pytest.raises(ValueError):
        parse_options({"path": "/x", "database": "d", "max-retries": "-1"})
    with pytest.raises(ValueError):
        parse_options({"database": "d"})
    with pytest.raises(ValueError):
        parse_options({"path": "/x", "database": "d", "converter.type": "xml"})
    o = parse_options({"path": "/x", "database": "d"})
    assert (o.batch_size, o.max_retries, o.timeout_s, o.attempts) == (5000, 3, 30.0, 4)
    assert split_names("tag1, tag2 ,tag3") == ["tag1", "tag2", "tag3"]


def test_backoff_and_adaptive_rules():
    assert [backoff_ms(k) for k in (1, 2, 3, 4, 5)] == [2000, 4000, 8000, 10000, 10000]
    assert next_batch_size(1000, 1000, 100, 0) == 1200
    assert next_batch_size(3900, 1000, 100, 0) == 4000
    assert next_batch_size(2000, 1000, 600, 0) == 1400
    assert next_batch_size(1100, 1000, 100, 1) == 1000
    assert next_batch_size(1500, 1000, 400, 0) == 1500


def test_sink_delivers_every_line_in_bounded_payloads(spark, tmp_dir):
    log = tmp_dir + "-log"
    seen = send_lines(_lines(spark), tmp_dir, "db1", batch_size=300, write_log=log)
    assert seen["rows"] == 2500 and seen["bytes"] > 0
    back = read_payload_lines(spark, tmp_dir)
    assert back.count() == 2500
    assert back.select("line").exceptAll(_lines(spark)).count() == 0
    # one file per task and destination, and nothing staged is left
    assert len(glob.glob(f"{tmp_dir}/database=db1/rp=*/*.lp")) == 3
    assert not [p for p in glob.glob(f"{tmp_dir}/_staging/*")]
    sizes = [r["n_lines"] for r in read_write_log(spark, log).collect()]
    assert max(sizes) <= 300 and sum(sizes) == 2500
    stats = write_stats(read_write_log(spark, log)).collect()[0]
    assert stats["n_lines"] == 2500 and stats["n_payloads"] == len(sizes)
    summary = json.load(open(glob.glob(f"{log}/_summary/*.json")[0]))
    assert summary["lines"] == 2500 and summary["state"] == "committed"


def test_retries_then_success(spark, tmp_dir):
    log = tmp_dir + "-log"
    send_lines(_lines(spark, 400, 2), tmp_dir, "db", batch_size=100, max_retries=3,
               retry_base_ms=1, retry_max_ms=5, write_log=log,
               transport="faults:flaky", **{"transport.fail_times": 2})
    assert read_payload_lines(spark, tmp_dir).count() == 400
    attempts = [r["attempts"] for r in read_write_log(spark, log).collect()]
    assert attempts and all(a == 3 for a in attempts)


def test_exhausted_retries_fail_the_job(spark, tmp_dir):
    with pytest.raises(Exception):
        send_lines(_lines(spark, 50, 1), tmp_dir, "db", max_retries=1, retry_base_ms=1,
                   transport="faults:broken")


def test_timeout_counts_as_failed_attempt(spark, tmp_dir):
    log = tmp_dir + "-log"
    with pytest.raises(Exception):
        send_lines(_lines(spark, 10, 1), tmp_dir, "db", max_retries=0, request_timeout=0.5,
                   transport="faults:slow", **{"transport.delay_s": 3}, write_log=log)
    assert glob.glob(f"{tmp_dir}/database=*") == []
    rows = spark.read.json(f"{log}/*.jsonl").collect() if glob.glob(f"{log}/*.jsonl") else []
    assert rows and not rows[0]["ok"] and "TimeoutError" in rows[0]["error"]


def test_adaptive_batch_grows(spark, tmp_dir):
    log = tmp_dir + "-log"
    send_lines(_lines(spark, 6000, 1), tmp_dir, "db", batch_size=100, adaptive_batch=True,
               write_log=log)
    sizes = [r["n_lines"] for r in read_write_log(spark, log).orderBy("batch_name").collect()]
    assert sizes[0] == 100 and max(sizes) > 100 and max(sizes) <= 400
    assert sum(sizes) == 6000


def test_routing_columns(spark, tmp_dir):
    df = _lines(spark, 300, 2).withColumn(
        "database", F.when(F.rand(1) < 0.5, F.lit("east")).otherwise(F.lit("west")))
    send_lines(df, tmp_dir, "fallback", batch_size=50)
    back = read_payload_lines(spark, tmp_dir)
    assert {r["database"] for r in back.select("database").distinct().collect()} == {"east", "west"}
    assert back.count() == 300


def test_sql_insert_with_options(spark, tmp_dir):
    register(spark)
    _lines(spark, 120, 2).createOrReplaceTempView("t_lines")
    spark.sql("CREATE TABLE IF NOT EXISTS t_sink (line STRING) USING lineproto")
    spark.sql(f"INSERT INTO t_sink WITH ('path'='{tmp_dir}', 'database'='sqldb', "
              "'batch-size'='50') SELECT line FROM t_lines")
    assert read_payload_lines(spark, tmp_dir).where("database = 'sqldb'").count() == 120
    assert os.path.isdir(f"{tmp_dir}/database=sqldb")


def test_sql_insert_raw_rows_with_role_options(spark, tmp_dir):
    """INSERT INTO sink SELECT * with role options: the writer encodes, same lines as the
    DataFrame encoder."""
    import datetime as dt
    import math
    from decimal import Decimal
    from tsline.operators.encode import encode_lines
    register(spark)
    rows = [(dt.datetime(2024, 1, 1, 0, 0, i % 3, (i * 137) % 1_000_000), f"s {i % 3}", f"r,{i}",
             i * 1.5, None if i % 4 == 0 else f'v "{i}"\\\n', i % 2 == 0, i * 1000, Decimal(i) / 7,
             (1e7 * i, 1e-5 * i, math.nan, math.inf)[i % 4], float(i) / 3, i % 5, i % 3 == 0,
             dt.datetime(2020, 2, 2, 1, 2, i % 60, (i % 4) * 250000))
            for i in range(40)]
    schema = ("ts timestamp, sensor string, region string, temp double, note string, ok boolean, "
              "n bigint, dec decimal(10,2), odd double, f float, zone int, hot boolean, seen timestamp")
    spark.createDataFrame(rows, schema).createOrReplaceTempView("raw_src")
    spark.sql(f"CREATE TABLE IF NOT EXISTS raw_sink ({schema}) USING lineproto")
    spark.sql(f"INSERT INTO raw_sink WITH ('path'='{tmp_dir}', 'database'='raw', "
              "'measurement'='sensor data', 'tag-fields'='sensor, region, zone, hot', "
              "'timestamp-field'='ts', 'batch-size'='7') SELECT * FROM raw_src")
    got = read_payload_lines(spark, tmp_dir).select("line")
    want = encode_lines(spark.table("raw_src"), "sensor data", tags="sensor, region, zone, hot",
                        time="ts")
    assert got.count() == 40
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_sql_insert_raw_rows_without_time_share_one_now(spark, tmp_dir):
    register(spark)
    spark.range(300).select((F.col("id") % 7).alias("k"), F.col("id").alias("v")) \
        .repartition(3).createOrReplaceTempView("raw_notime")
    spark.sql("DROP TABLE IF EXISTS raw_notime_sink")
    spark.sql("CREATE TABLE raw_notime_sink (k BIGINT, v BIGINT) USING lineproto")
    spark.sql(f"INSERT INTO raw_notime_sink WITH ('path'='{tmp_dir}', 'database'='nt', "
              "'measurement'='m', 'tag-fields'='k') SELECT * FROM raw_notime")
    times = read_payload_lines(spark, tmp_dir).select(
        F.substring_index("line", " ", -1).alias("t")).distinct().collect()
    assert len(times) == 1


def test_send_lines_with_raw_rows(spark, tmp_dir):
    from tsline.operators.encode import encode_lines
    df = spark.range(120).select((F.col("id") % 4).alias("k"), (F.col("id") * 0.5).alias("v"),
                                 F.col("id").alias("t"))
    seen = send_lines(df, tmp_dir, "raw", measurement="m", tag_fields="k", timestamp_field="t",
                      source_precision="s", batch_size=25)
    assert seen["rows"] == 120
    got = read_payload_lines(spark, tmp_dir).select("line")
    want = encode_lines(df, "m", tags=["k"], time="t", precision="s")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_options_are_checked(spark, tmp_dir):
    base = {"path": "/x", "database": "d"}
    for bad in ({"tag-field": "a"}, {"batchsize": "5"}, {"tag-fields": "a"}, {"measurement": " "}):
        with pytest.raises(ValueError):
            parse_options({**base, **bad})
    parse_options({**base, "transport.anything": "1", "measurement": "m", "tag-fields": "a"})
    rows = spark.range(3).select("id", F.lit(1.5).alias("v"))
    with pytest.raises(ValueError, match="measurement"):
        send_lines(rows, tmp_dir, "d")
    with pytest.raises(ValueError, match="lines already"):
        send_lines(_lines(spark, 3, 1), tmp_dir, "d", measurement="m")
    with pytest.raises(ValueError, match="lines already"):
        send_lines(_lines(spark, 3, 1), tmp_dir, "d", converter_type="point")
    with pytest.raises(Exception, match="only appends"):
        register(spark)
        _lines(spark, 3, 1).write.format("lineproto").options(path=tmp_dir, database="d").mode("overwrite").save()


def test_parallelism_converter_and_named_options(spark, tmp_dir):
    from tsline.operators.encode import encode_lines
    rows = spark.range(100).select((F.col("id") % 4).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"),
                                   F.col("id").alias("t"), F.when(F.col("id") % 5 == 0, "-D").otherwise("+I").alias("op"))
    spark.conf.set("tsline.sink.metrics.path", tmp_dir)
    spark.conf.set("tsline.sink.metrics.database", "named")
    spark.conf.set("tsline.sink.metrics.sink.parallelism", "5")
    send_lines(rows, sink="metrics", measurement="m", tag_fields="k", timestamp_field="t", source_precision="s",
               converter_type="point", op_field="op", on_empty="marker")
    assert len(glob.glob(f"{tmp_dir}/database=named/rp=*/*.lp")) == 5
    got = read_payload_lines(spark, tmp_dir).select("line")
    want = encode_lines(rows.drop("op").where("t % 5 <> 0"), "m", tags="k", time="t", precision="s", on_empty="marker")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    with pytest.raises(ValueError):
        send_lines(rows, sink="unknown", measurement="m")


def test_a_failed_job_leaves_nothing_and_a_log_of_its_own(spark, tmp_dir):
    """Half a file of a failed attempt is never seen; its log does not count."""
    log = tmp_dir + "-log"
    with pytest.raises(Exception):
        send_lines(_lines(spark, 900, 1), tmp_dir, "db", batch_size=100, write_log=log, transport="faults:half",
                   max_retries=0)
    assert glob.glob(f"{tmp_dir}/database=*") == []
    logged = [json.loads(x) for p in glob.glob(f"{log}/*.jsonl") for x in open(p)]
    assert sum(r["n_lines"] for r in logged if r["ok"]) == 100
    send_lines(_lines(spark, 900, 2), tmp_dir, "db", batch_size=100, write_log=log)
    assert read_payload_lines(spark, tmp_dir).count() == 900
    stats = write_stats(read_write_log(spark, log)).collect()[0]
    assert (stats["n_lines"], stats["n_failed_attempts"]) == (900, 0)
    assert read_write_log(spark, log, all_attempts=True).count() > stats["n_payloads"]


def test_errors_are_logged_whole(spark, tmp_dir):
    log = tmp_dir + "-log"
    with pytest.raises(Exception):
        send_lines(_lines(spark, 5, 1), tmp_dir, "db", write_log=log, transport="faults:broken", max_retries=0)
    assert "x" * 2000 in open(glob.glob(f"{log}/*.jsonl")[0]).read()


def test_raw_batches_with_nulls():
    import pyarrow as pa
    from tsline.sources.arrow_encode import encode_batch, spec_from_options
    rb = pa.RecordBatch.from_pydict({"t": pa.array([1, 2, 3, 4]), "a": pa.array([None, "x", None, None], pa.string()),
                                     "b": pa.array([None, None, "y z", None], pa.string()),
                                     "v": pa.array([1.5, None, None, None]), "op": pa.array(["+I", "+U", "-D", None])})
    options = {"measurement": "m", "tag-fields": "a,b", "timestamp-field": "t", "source-precision": "ns", "field-fields": "v"}
    assert encode_batch(rb, spec_from_options(options, rb.schema)).to_pylist() == ["m v=1.5 1", None, None, None]
    marked = spec_from_options({**options, "on-empty": "marker"}, rb.schema)
    assert encode_batch(rb, marked).to_pylist() == ["m v=1.5 1", "m,a=x _empty=true 2", "m,b=y\\ z _empty=true 3", "m _empty=true 4"]
    kept = spec_from_options({**options, "on-empty": "marker", "op-field": "op"}, rb.schema)
    assert encode_batch(rb, kept).to_pylist() == ["m v=1.5 1", "m,a=x _empty=true 2", None, None]
    with pytest.raises(ValueError):
        spec_from_options({**options, "escape": "none"}, rb.schema)


def test_streams_with_own_checkpoints_share_a_path(spark, tmp_dir):
    from tsline.streaming import stream as ST
    src = tmp_dir + "-src"
    _lines(spark, 50, 1).write.parquet(src)
    schema = spark.read.parquet(src).schema
    for name in ("one", "two", "two"):  # the third run resumes the second's checkpoint: nothing new
        ST.start_sink(ST.read_stream(spark, src, schema), f"{tmp_dir}-ck-{name}", path=tmp_dir,
                      database="db").awaitTermination()
    assert read_payload_lines(spark, tmp_dir).count() == 100
    raw = spark.range(20).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    raw.write.parquet(tmp_dir + "-raw")
    ST.start_sink(ST.read_stream(spark, tmp_dir + "-raw", raw.schema), tmp_dir + "-ck-raw", path=tmp_dir + "-out",
                  database="db", measurement="m", tag_fields="k").awaitTermination()
    times = read_payload_lines(spark, tmp_dir + "-out").select(F.substring_index("line", " ", -1).alias("t"))
    assert times.count() == 20 and times.distinct().count() == 1

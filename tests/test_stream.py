"""Structured Streaming: late rows against the watermark, at-least-once replay, upserts."""

import datetime as dt
import glob
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tsline.session import scratch_path
from tsline.sources.delivery import read_payload_lines
from tsline.streaming import stream as ST

BASE = dt.datetime(2024, 1, 1, 0, 0, 0)


def _write_files(folder, batches):
    """One Parquet file per batch, modification times increasing in order."""
    os.makedirs(folder)
    now = time.time() - 1000
    for i, rows in enumerate(batches):
        table = pa.table({"ts": pa.array([BASE + dt.timedelta(seconds=s) for s, _, _ in rows],
                                         pa.timestamp("us")),
                          "location": [loc for _, loc, _ in rows],
                          "temperature": [float(v) for _, _, v in rows]})
        path = os.path.join(folder, f"part-{i}.parquet")
        pq.write_table(table, path)
        os.utime(path, (now + i * 10, now + i * 10))
    return pq.read_table(os.path.join(folder, "part-0.parquet")).schema


def _schema(spark, folder):
    return spark.read.parquet(folder).schema


def test_tumble_drops_late_rows(spark):
    src = scratch_path(spark, "late-src")
    _write_files(src, [
        [(1, "hall", 20), (4, "hall", 22), (8, "room1", 30)],   # window [0,10)
        [(100, "hall", 25)],                                     # watermark -> 95 s
        [(101, "hall", 26)],                                     # one batch later
        [(5, "hall", 99)],                                       # late: older than the watermark
    ])
    out, ck = scratch_path(spark, "late-out"), scratch_path(spark, "late-ck")
    stream = ST.read_stream(spark, src, _schema(spark, src), max_files_per_trigger=1)
    agg = ST.stream_tumble(stream, "ts", "10 seconds", ["location"], "temperature",
                           watermark="5 seconds")
    ST.start_files(agg, out, ck, fmt="parquet").awaitTermination()
    rows = {(r["window_start_ns"] // 10**9 - int(BASE.replace(tzinfo=dt.timezone.utc).timestamp()),
             r["location"]): (r["record_count"], r["max_value"])
            for r in spark.read.parquet(out).collect()}
    # the late 99.0 never reaches the [0,10) hall window; [100,110) is still open
    assert rows == {(0, "hall"): (2, 22.0), (0, "room1"): (1, 30.0)}


def test_stream_sink_replays_after_failure(spark):
    src = scratch_path(spark, "replay-src")
    _write_files(src, [[(i, "hall", i) for i in range(50)], [(i, "room", i) for i in range(60, 90)]])
    out, ck = scratch_path(spark, "replay-out"), scratch_path(spark, "replay-ck")

    def run(**extra):
        stream = ST.read_stream(spark, src, _schema(spark, src), max_files_per_trigger=1)
        lines = ST.stream_lines(stream, "sensor", tags=["location"], time="ts")
        return ST.start_sink(lines, ck, path=out, database="db", batch_size=7, **extra)

    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(__file__), "faults.py"))
    with pytest.raises(Exception):
        run(max_retries=0, transport="faults:broken").awaitTermination()
    run().awaitTermination()
    back = read_payload_lines(spark, out)
    assert back.count() == 80 and back.distinct().count() == 80
    assert all(os.path.basename(p).startswith("query-") for p in glob.glob(f"{out}/*/*/*.lp"))


def test_stream_upsert_keeps_last_write(spark):
    src = scratch_path(spark, "ups-src")
    _write_files(src, [[(1, "hall", 1), (2, "hall", 2)], [(3, "hall", 3), (4000, "hall", 4)]])
    out, ck = scratch_path(spark, "ups-out"), scratch_path(spark, "ups-ck")
    stream = ST.read_stream(spark, src, _schema(spark, src), max_files_per_trigger=1)
    stream = stream.withColumn("seq", F.col("temperature").cast("long"))
    updates = ST.stream_upsert(stream, ["location"], "ts", "seq", ["temperature"],
                               watermark="1 hour", round_to="1 hour")
    ST.start_upsert_log(updates, out, ck, ["location"], ["temperature"]).awaitTermination()
    view = ST.collapse_upserts(spark, out, ["location"], ["temperature"]).orderBy("time_ns").collect()
    assert [(r["temperature"], r["seq"]) for r in view] == [(3.0, 3), (4.0, 4)]


def test_stream_window_points_through_the_sink(spark):
    """Stream -> watermark + window -> aggregates encoded as lines -> lineproto sink."""
    src = scratch_path(spark, "winsink-src")
    _write_files(src, [[(1, "hall", 20), (4, "hall", 22), (8, "room1", 30)], [(100, "hall", 25)]])
    out, ck = scratch_path(spark, "winsink-out"), scratch_path(spark, "winsink-ck")
    stream = ST.read_stream(spark, src, _schema(spark, src), max_files_per_trigger=1)
    agg = ST.stream_tumble(stream, "ts", "10 seconds", ["location"], "temperature")
    lines = ST.stream_lines(agg, "temps", tags=["location"],
                            fields=["avg_value", "max_value", "min_value", "record_count"],
                            time="window_end_ns", precision="ns")
    ST.start_sink(lines, ck, path=out, database="db").awaitTermination()
    got = sorted(r["line"] for r in read_payload_lines(spark, out).collect())
    end = int((BASE + dt.timedelta(seconds=10)).replace(tzinfo=dt.timezone.utc).timestamp()) * 10**9
    assert got == [f"temps,location=hall avg_value=21.0,max_value=22.0,min_value=20.0,"
                   f"record_count=2i {end}",
                   f"temps,location=room1 avg_value=30.0,max_value=30.0,min_value=30.0,"
                   f"record_count=1i {end}"]


def test_stream_raw_rows_and_processing_time(spark):
    """Raw rows through the streaming sink with role options and no time column: the
    writer encodes them, and every line of one job carries the same processing time."""
    src = scratch_path(spark, "raw-src")
    _write_files(src, [[(i, "hall", i) for i in range(30)]])
    out, ck = scratch_path(spark, "raw-out"), scratch_path(spark, "raw-ck")
    stream = ST.read_stream(spark, src, _schema(spark, src)).drop("ts")
    ST.start_sink(stream, ck, path=out, database="db", measurement="sensor",
                  tag_fields="location", batch_size=8).awaitTermination()
    back = read_payload_lines(spark, out)
    assert back.count() == 30
    first = back.select(F.substring_index("line", " ", 1).alias("head")).distinct().collect()
    assert [r["head"] for r in first] == ["sensor,location=hall"]
    now = ST.time_now_stream(ST.read_stream(spark, src, _schema(spark, src)))
    assert now.isStreaming and "time_ns" in now.columns


def test_late_rows_are_written_by_all_tasks(spark, tmp_dir, monkeypatch):
    """Waves of many files give the rows of the oracle."""
    import glob

    import duckdb

    from conftest import SF_SMALL
    from tsline.suite import ORACLES, QUERIES, delivered

    folders = {}
    made = delivered.scratch_path
    monkeypatch.setattr(delivered, "scratch_path",
                        lambda session, name: folders.setdefault(name, made(session, name)))
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(4).write.parquet(f"{tmp_dir}/events.parquet")
    got = QUERIES["stream_late"](spark, tmp_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    want = con.execute(ORACLES["stream_late"])
    columns = [c[0] for c in want.description]
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted(want.fetchall())
    assert len(glob.glob(f"{folders['late-src'].removeprefix('file:')}/part-*")) > 2

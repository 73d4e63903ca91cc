"""Queries for delivery (B1-B3, B13) and Structured Streaming.

Each query runs its job to completion into a fresh folder under
``spark.checkpoint.dir`` and returns a batch DataFrame over what was written.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tsline.session import scratch_path
from tsline.sources.delivery import read_payload_lines, register, send_lines
from tsline.streaming import stream as ST
from tsline.suite import sqlbits as S
from tsline.suite.formats import EVENTS_TAGS, events_lines
from tsline.suite.registry import query, table

DATABASE = "tsline"
_LINES_SQL = f"SELECT {S.EVENTS_LINE} AS line, '{DATABASE}' AS database FROM events"


def _events_stream(spark, sf_dir, files_per_trigger=None):
    schema = table(spark, sf_dir, "events").schema
    return ST.read_stream(spark, sf_dir, schema, glob="events.parquet",
                          max_files_per_trigger=files_per_trigger)


@query("sink_batch", _LINES_SQL)
def q_sink_batch(spark, sf_dir):
    out = scratch_path(spark, "sink")
    # each task sends a contiguous, time-ordered run of a series
    lines = events_lines(spark, sf_dir, keep=["event_type"], time_col="time_ns")
    send_lines(lines, out, DATABASE, batch_size=500, by=["event_type", "time_ns"])
    return read_payload_lines(spark, out).select("line", "database")


@query("sink_sql", _LINES_SQL)
def q_sink_sql(spark, sf_dir):
    register(spark)
    out = scratch_path(spark, "sink-sql")
    events_lines(spark, sf_dir).createOrReplaceTempView("tsline_event_lines")
    spark.sql("DROP TABLE IF EXISTS tsline_sink")
    spark.sql("CREATE TABLE tsline_sink (line STRING) USING lineproto")
    spark.sql(f"""INSERT INTO tsline_sink WITH ('path' = '{out}', 'database' = '{DATABASE}',
                  'batch-size' = '1000', 'max-retries' = '3')
                  SELECT line FROM tsline_event_lines""")
    return read_payload_lines(spark, out).select("line", "database")


@query("sink_sql_rows", _LINES_SQL)
def q_sink_sql_rows(spark, sf_dir):
    register(spark)
    out = scratch_path(spark, "sink-sql-rows")
    table(spark, sf_dir, "events").createOrReplaceTempView("tsline_events_raw")
    spark.sql("DROP TABLE IF EXISTS tsline_raw_sink")
    spark.sql("CREATE TABLE tsline_raw_sink (event_id BIGINT, ts TIMESTAMP_NTZ, "
              "user_id BIGINT, event_type STRING, value DOUBLE, props STRING) USING lineproto")
    # raw rows and role options, as a SQL user of the reference writes them
    spark.sql(f"""INSERT INTO tsline_raw_sink WITH ('path' = '{out}', 'database' = '{DATABASE}',
                  'measurement' = 'events', 'tag-fields' = 'event_type,user_id',
                  'timestamp-field' = 'ts', 'batch-size' = '1000')
                  SELECT * FROM tsline_events_raw""")
    return read_payload_lines(spark, out).select("line", "database")


@query("stream_encode", f"SELECT {S.EVENTS_LINE} AS line FROM events")
def q_stream_encode(spark, sf_dir):
    out, ck = scratch_path(spark, "stream-lines"), scratch_path(spark, "stream-ck")
    lines = ST.stream_lines(_events_stream(spark, sf_dir), "events", tags=EVENTS_TAGS, time="ts")
    ST.start_files(lines, out, ck).awaitTermination()
    return spark.read.text(out).select(F.col("value").alias("line"))


@query("stream_sink", _LINES_SQL)
def q_stream_sink(spark, sf_dir):
    out, ck = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ck")
    lines = ST.stream_lines(_events_stream(spark, sf_dir), "events", tags=EVENTS_TAGS, time="ts")
    ST.start_sink(lines, ck, path=out, database=DATABASE, batch_size=1000).awaitTermination()
    return read_payload_lines(spark, out).select("line", "database")


# Windows close when the watermark (latest event time - 5 s) passes their end.
@query("stream_tumble", """WITH w AS (SELECT epoch_us(ts) // 10000000 * 10000000000 AS window_start_ns,
    epoch_us(ts) // 10000000 * 10000000000 + 10000000000 AS window_end_ns, event_type,
    round(avg(value), 6) AS avg_value, max(value) AS max_value, min(value) AS min_value,
    count(*) AS record_count FROM events GROUP BY ALL)
SELECT * FROM w
WHERE window_end_ns <= (SELECT (epoch_us(max(ts)) // 1000) * 1000000 - 5000000000 FROM events)""")
def q_stream_tumble(spark, sf_dir):
    out, ck = scratch_path(spark, "stream-tumble"), scratch_path(spark, "stream-ck")
    agg = ST.stream_tumble(_events_stream(spark, sf_dir), "ts", "10 seconds", ["event_type"],
                           "value", watermark="5 seconds")
    ST.start_files(agg, out, ck, fmt="parquet").awaitTermination()
    return spark.read.parquet(out).withColumn("avg_value", F.round("avg_value", 6))


_HOUR_NS = 3_600_000_000_000


@query("stream_dedup", f"""SELECT event_type, epoch_us(ts) // 3600000000 * {_HOUR_NS} AS time_ns,
    arg_max(value, event_id) AS value, max(event_id) AS seq FROM events GROUP BY ALL""")
def q_stream_dedup(spark, sf_dir):
    out, ck = scratch_path(spark, "stream-upsert"), scratch_path(spark, "stream-ck")
    updates = ST.stream_upsert(_events_stream(spark, sf_dir), ["event_type"], "ts", "event_id",
                               ["value"], watermark="1 hour", round_to="1 hour")
    ST.start_upsert_log(updates, out, ck, ["event_type"], ["value"]).awaitTermination()
    return ST.collapse_upserts(spark, out, ["event_type"], ["value"])


@query("stream_dedup_values", f"""SELECT event_type, epoch_us(ts) // 3600000000 * {_HOUR_NS} AS time_ns,
    arg_max(value, event_id) AS value, arg_max(props, event_id) AS props, arg_max(user_id, event_id) AS user_id,
    max(event_id) AS seq FROM events GROUP BY ALL""")
def q_stream_dedup_values(spark, sf_dir):
    """Several values, one of them text, through many micro-batches and merged runs of the log."""
    src, out, ck = (scratch_path(spark, x) for x in ("upsert-src", "stream-upsert", "stream-ck"))
    events = table(spark, sf_dir, "events")
    events.repartition(10, "event_id").write.parquet(src)
    stream = ST.read_stream(spark, src, events.schema, max_files_per_trigger=1)
    values = ["value", "props", "user_id"]
    updates = ST.stream_upsert(stream, ["event_type"], "ts", "event_id", values, watermark="3650 days", round_to="1 hour")
    ST.start_upsert_log(updates, out, ck, ["event_type"], values, fan_in=4).awaitTermination()
    return ST.collapse_upserts(spark, out, ["event_type"], values)

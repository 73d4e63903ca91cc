"""Structured Streaming: sources, streaming encode, sink, windows, upserts.

Delivery is at least once: Spark writes a micro-batch's offsets before it
runs and its commit after; a crash in between replays the same rows, and the
sink names payloads by micro-batch so a replay overwrites (3.3 of SURVEY).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tsline.functions.timeunit import epoch_micros, floor_div, time_value
from tsline.operators.encode import encode_lines
from tsline.operators.windows import duration_ns
from tsline.sources.delivery import prepare, register
from tsline.sources.sink import NAME, parse_options
from tsline.streaming.upserts import UpsertLog


def event_time(df: DataFrame, col: str) -> DataFrame:
    """Make ``col`` a TIMESTAMP (watermarks refuse TIMESTAMP_NTZ); NTZ is read as UTC."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return df.withColumn(col, F.timestamp_micros(epoch_micros(F.col(col), dtype)))
    return df


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None,
                max_files_per_trigger: int | None = None, time_col: str | None = None) -> DataFrame:
    """Parquet files arriving in ``folder`` as a stream (A2)."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.parquet(folder)
    return event_time(df, time_col) if time_col else df


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def stream_lines(stream: DataFrame, measurement, tags=None, fields=None, time=None,
                 **options) -> DataFrame:
    """Streaming encode (J7): the same single projection as batch, map-only."""
    return encode_lines(stream, measurement, tags, fields, time, **options)


def start_files(lines: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                fmt: str = "text") -> StreamingQuery:
    """Write streaming lines as files (exactly-once through the file sink's log)."""
    out = lines.select(F.col("line").alias("value")) if fmt == "text" else lines
    writer = (out.writeStream.format(fmt).option("path", path)
                 .option("checkpointLocation", checkpoint).outputMode("append"))
    return _trigger(writer, trigger).start()


def start_sink(lines: DataFrame, checkpoint: str, trigger: str | None = None,
               sink: str | None = None, **options) -> StreamingQuery:
    """Streaming delivery through the ``lineproto`` sink (B2), of lines or of raw rows with
    role options; raw rows are encoded in the JVM, with one "now" per micro-batch.

    ``flush_interval`` (ms) becomes the processing-time trigger when no
    trigger is given, as the reference flushes on a timer-like interval.
    """
    register(lines.sparkSession)
    out, opts, parallelism = prepare(lines, sink, **options)
    parsed = parse_options(opts)
    if trigger is None and "flush-interval" in opts:
        trigger = f"{parsed.flush_interval_ms} milliseconds"
    if parallelism:
        out = out.repartition(parallelism)
    writer = (out.writeStream.format(NAME).options(**opts)
                 .option("checkpointLocation", checkpoint).outputMode("append"))
    return _trigger(writer, trigger).start()


def stream_tumble(stream: DataFrame, time: str, every: str, by: Sequence[str], value: str,
                  watermark: str = "5 seconds") -> DataFrame:
    """Event-time tumbling aggregate with a watermark (E1, J1-J3), append mode.

    A window is emitted once the watermark passes its end; rows older than the
    watermark of the previous micro-batch are dropped as late.
    """
    df = event_time(stream, time)
    win = F.window(F.col(time), every)
    agg = (df.withWatermark(time, watermark)
             .groupBy(win.alias("w"), *[F.col(b) for b in by])
             .agg(F.avg(value).alias("avg_value"), F.max(value).alias("max_value"),
                  F.min(value).alias("min_value"), F.count(F.lit(1)).alias("record_count")))
    return agg.select((F.unix_micros(F.col("w.start")) * 1000).alias("window_start_ns"),
                      (F.unix_micros(F.col("w.end")) * 1000).alias("window_end_ns"),
                      *by, "avg_value", "max_value", "min_value", "record_count")


def stream_upsert(stream: DataFrame, key: Sequence[str], time: str, seq: str,
                  values: Sequence[str], watermark: str, round_to: str | None = None) -> DataFrame:
    """Streaming last-write-wins per (key, time) (J6), for update output mode.

    A grouped streaming aggregate: Spark combines it map-side
    inside each micro-batch, so many copies of one point are reduced before
    the shuffle; the state keeps one row per point key until the watermark
    passes its time.  Emitted rows are appended to a log; ``collapse_upserts``
    gives the current view (latest emission per key wins).
    """
    df = event_time(stream, time)
    t = F.col(time)
    if round_to:
        step = duration_ns(round_to)
        micros = F.unix_micros(t)
        t = F.timestamp_micros(floor_div(micros, step // 1000) * F.lit(step // 1000))
    df = df.withColumn("_t", t)
    grouped = df.withWatermark("_t", watermark).groupBy(*[F.col(k) for k in key], F.col("_t"))
    time_ns = (F.unix_micros("_t") * 1000).alias("time_ns")
    # seq first, then the values: ties have one outcome whatever order rows come in
    row = F.struct(F.col(seq).alias("seq"), F.struct(*[F.col(v).alias(v) for v in values]).alias("v"))
    return (grouped.agg(F.max(row).alias("_last"))
                   .select(*key, time_ns, *[F.col("_last.v")[v].alias(v) for v in values],
                           F.col("_last.seq").alias("seq")))


def start_upsert_log(updates: DataFrame, path: str, checkpoint: str, key: Sequence[str], values: Sequence[str],
                     trigger: str | None = None, **options) -> StreamingQuery:
    """Add each micro-batch of :func:`stream_upsert` to the compacted log at ``path`` (``upserts.UpsertLog``)."""
    log = UpsertLog(updates.sparkSession, path, key, values, **options)
    writer = (updates.writeStream.outputMode("update")
                     .foreachBatch(lambda batch, batch_id: log.add(batch, batch_id, checkpoint))
                     .option("checkpointLocation", checkpoint))
    return _trigger(writer, trigger).start()


def collapse_upserts(spark: SparkSession, path: str, key: Sequence[str],
                     values: Sequence[str]) -> DataFrame:
    """Current view of an upsert log: per (key, time) the row with the highest seq."""
    return UpsertLog(spark, path, key, values).view()


def time_now_stream(stream: DataFrame) -> DataFrame:
    """Processing time in ns for rows without an event time (J5): fixed per micro-batch."""
    return stream.withColumn("time_ns", time_value(None, None))


__all__ = ["read_stream", "stream_lines", "start_files", "start_sink", "stream_tumble",
           "stream_upsert", "start_upsert_log", "collapse_upserts", "event_time",
           "time_now_stream"]

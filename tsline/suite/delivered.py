"""Queries over what delivery leaves behind: shared paths, raw rows with nulls, write logs,
late rows, mixed types, deletes (A4, B2, B3, B15, C3-C6, C10, E4, E9, E10, J3, L6)."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tsline.functions.sql import register_functions
from tsline.operators.decode import decode_lines
from tsline.session import scratch_path
from tsline.sources.delivery import (lines_per_second, read_payload_lines, read_write_log, register,
                                     send_lines, write_stats)
from tsline.sources.lines import delete_points, read_back, scan_points, stream_points, write_lines
from tsline.streaming import stream as ST
from tsline.suite import sqlbits as S
from tsline.suite.formats import EVENTS_TAGS, events_lines
from tsline.suite.readback import CUTOFF_NS, store_lines
from tsline.suite.registry import query, table

DATABASE = "tsline"


@query("stream_sink_shared", f"SELECT {S.EVENTS_LINE} AS line, '{DATABASE}' AS database FROM events")
def q_stream_sink_shared(spark, sf_dir):
    """Two queries with checkpoints of their own deliver into one path: nothing is replaced."""
    out = scratch_path(spark, "stream-shared")
    schema = table(spark, sf_dir, "events").schema
    for half in (0, 1):
        events = ST.read_stream(spark, sf_dir, schema, glob="events.parquet").where(
            F.col("event_id") % 2 == half)
        lines = ST.stream_lines(events, "events", tags=EVENTS_TAGS, time="ts")
        ST.start_sink(lines, scratch_path(spark, "stream-ck"), path=out, database=DATABASE,
                      batch_size=1000).awaitTermination()
    return read_payload_lines(spark, out).select("line", "database")


_FLAKY = {"transport": "tsline.suite.flaky:transport", "batch_size": 100, "max_retries": 3, "retry_base_ms": 1,
          "retry_max_ms": 4, "request_timeout": 0.4}


@query("sink_flaky", f"SELECT {S.EVENTS_LINE} AS line, '{DATABASE}' AS database FROM events")
def q_sink_flaky(spark, sf_dir):
    """Every task dies after two payloads; run again, the job sends what was not acknowledged: each line once.

    First attempts fail and slow ones run into the timeout on the way (B9, B10).
    """
    out, ledger = scratch_path(spark, "flaky"), scratch_path(spark, "ledger")
    lines = events_lines(spark, sf_dir).repartition(4)
    options = {**_FLAKY, "ledger": ledger, "ledger_name": "events", "transport.fail_first": "true"}
    try:
        send_lines(lines, out, DATABASE, **options, **{"transport.die_after": 2})
    except Exception as error:  # noqa: BLE001 - the injected failure, whatever Spark wraps it in
        if "the connection is gone" not in str(error):
            raise
    send_lines(lines, out, DATABASE, **options, **{"transport.slow_s": 1.0})
    return read_payload_lines(spark, out).select("line", "database")


@query("stream_flaky", f"SELECT {S.EVENTS_LINE} AS line, '{DATABASE}' AS database FROM events")
def q_stream_flaky(spark, sf_dir):
    """A micro-batch that fails half way is replayed after a restart: lines already delivered are not sent again."""
    out, ledger, checkpoint = (scratch_path(spark, x) for x in ("flaky", "ledger", "stream-ck"))
    schema = table(spark, sf_dir, "events").schema
    for die_after in (3, -1):
        events = ST.read_stream(spark, sf_dir, schema, glob="events.parquet")
        lines = ST.stream_lines(events, "events", tags=EVENTS_TAGS, time="ts")
        try:
            ST.start_sink(lines, checkpoint, path=out, database=DATABASE, ledger=ledger, **_FLAKY,
                          **{"transport.die_after": die_after}).awaitTermination()
        except Exception as error:  # noqa: BLE001 - the injected failure, whatever Spark wraps it in
            if die_after < 0 or "the connection is gone" not in str(error):
                raise
    return read_payload_lines(spark, out).select("line", "database")


@query("sink_adaptive", """WITH RECURSIVE w(size, start) AS (SELECT 5, 0 UNION ALL
    SELECT least(CAST(floor(size * 1.2) AS INTEGER), 20), start + 10 * size FROM w
    WHERE start + 10 * size < (SELECT count(*) FROM events)),
p AS (SELECT size, start + size * i AS pos FROM w, range(10) r(i))
SELECT CAST(least(size, n - pos) AS BIGINT) AS n_lines, CAST(count(*) AS BIGINT) AS n_payloads
FROM p, (SELECT count(*) AS n FROM events) WHERE pos < n GROUP BY 1""")
def q_sink_adaptive(spark, sf_dir):
    """Payloads of one connection grow by a fifth after every ten fast ones, up to four times."""
    out, log = scratch_path(spark, "adaptive"), scratch_path(spark, "write-log")
    # one task is one connection, whose payloads follow each other
    lines = events_lines(spark, sf_dir).coalesce(1)
    send_lines(lines, out, DATABASE, batch_size=5, adaptive_batch="true", write_log=log)
    return read_write_log(spark, log).groupBy("n_lines").agg(F.count(F.lit(1)).alias("n_payloads"))


_RAW = {
    "event_type": "CASE WHEN event_id % 5 = 0 OR event_id % 7 = 1 THEN NULL ELSE event_type END",
    "user_id": "CASE WHEN event_id % 5 = 0 OR event_id % 7 = 2 THEN NULL ELSE user_id END",
    "value": "CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END",
    "props": "CASE WHEN event_id % 4 = 0 AND event_id % 3 = 0 THEN NULL ELSE props END",
    "op": "CASE event_id % 11 WHEN 3 THEN '-U' WHEN 4 THEN '-D' WHEN 5 THEN '+U' ELSE '+I' END",
}


@query("sink_sql_nulls", f"""WITH r AS (SELECT ts, {', '.join(f'{x} AS {n}' for n, x in _RAW.items())} FROM events)
SELECT 'events' || coalesce({S.tag('event_type', 'event_type')}, '')
       || coalesce({S.tag('user_id', 'user_id', False)}, '') || ' '
       || coalesce(nullif(concat_ws(',', {S.fnum('value', 'value')}, {S.fstr('props', 'props')}), ''), '_empty=true')
       || ' ' || CAST({S.ns('ts')} AS VARCHAR) AS line FROM r WHERE op IN ('+I', '+U')""")
def q_sink_sql_nulls(spark, sf_dir):
    """Raw rows through SQL: null tags, rows without any tag or field, a changelog column."""
    register(spark)
    out = scratch_path(spark, "sink-sql-nulls")
    table(spark, sf_dir, "events").selectExpr(
        "ts", *[f"{x} AS {n}" for n, x in _RAW.items()]).createOrReplaceTempView("tsline_events_nulls")
    spark.sql("DROP TABLE IF EXISTS tsline_nulls_sink")
    spark.sql("CREATE TABLE tsline_nulls_sink (ts TIMESTAMP_NTZ, event_type STRING, user_id BIGINT, "
              "value DOUBLE, props STRING, op STRING) USING lineproto")
    spark.sql(f"""INSERT INTO tsline_nulls_sink WITH ('path' = '{out}', 'database' = '{DATABASE}',
                  'measurement' = 'events', 'tag-fields' = 'event_type,user_id', 'timestamp-field' = 'ts',
                  'op-field' = 'op', 'on-empty' = 'marker') SELECT * FROM tsline_events_nulls""")
    return read_payload_lines(spark, out).select("line")


def _logged(spark, sf_dir):
    out, log = scratch_path(spark, "logged"), scratch_path(spark, "write-log")
    send_lines(events_lines(spark, sf_dir), out, DATABASE, batch_size=500, write_log=log)
    return read_write_log(spark, log)


@query("write_log_stats", f"""SELECT CAST(count(*) AS BIGINT) AS n_lines,
    CAST(sum(strlen({S.EVENTS_LINE})) AS BIGINT) AS line_bytes, CAST(0 AS BIGINT) AS n_failed_attempts,
    true AS quantiles_ordered, true AS has_last_success FROM events""")
def q_write_log_stats(spark, sf_dir):
    """Totals of a delivery, from its write log (a payload has one newline less than lines)."""
    stats = write_stats(_logged(spark, sf_dir))
    q = F.col("latency_ms_p50_p95_p99")
    return stats.select(
        "n_lines", (F.col("n_bytes") - F.col("n_lines") + F.col("n_payloads")).alias("line_bytes"),
        "n_failed_attempts", ((q[0] <= q[1]) & (q[1] <= q[2])).alias("quantiles_ordered"),
        F.col("last_success").isNotNull().alias("has_last_success"))


@query("log_lines_per_second", "SELECT CAST(count(*) AS BIGINT) AS n_lines, true AS all_positive FROM events")
def q_log_lines_per_second(spark, sf_dir):
    rates = lines_per_second(_logged(spark, sf_dir))
    return rates.agg(F.sum("lines_per_second").alias("n_lines"),
                     F.min(F.col("lines_per_second") > 0).alias("all_positive"))


# A field that is an integer on some lines and text on others, a tag named like the time column,
# and every ninth line broken.
_MIXED = f"""CASE WHEN event_id % 9 = 0 THEN 'broken line' ELSE 'm,time=' || event_type || ' v='
    || CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) || 'i' ELSE '"x' || CAST(event_id AS VARCHAR) || '"' END
    || ' ' || CAST({S.ns('ts')} AS VARCHAR) END"""


@query("read_back_mixed", """SELECT event_type AS time_tag, CASE WHEN event_id % 2 = 0
    THEN CAST(event_id AS VARCHAR) ELSE 'x' || CAST(event_id AS VARCHAR) END AS v, epoch_us(ts) * 1000 AS time_ns,
    (SELECT count(*) FROM events WHERE event_id % 9 = 0) AS n_corrupt FROM events WHERE event_id % 9 <> 0""")
def q_read_back_mixed(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    i = F.col("event_id")
    good = F.concat(F.lit("m,time="), F.col("event_type"), F.lit(" v="),
                    F.when(i % 2 == 0, F.concat(i.cast("string"), F.lit("i")))
                    .otherwise(F.concat(F.lit('"x'), i.cast("string"), F.lit('"'))),
                    F.lit(" "), _ns(ev).cast("string"))
    path = write_lines(ev.select(F.when(i % 9 == 0, F.lit("broken line")).otherwise(good).alias("line")))
    bad = Observation("corrupt_lines")
    rows = read_back(spark, path, corrupt=bad).select("time_tag", "v", "time_ns")
    stored = scratch_path(spark, "mixed")
    rows.write.parquet(stored)
    return spark.read.parquet(stored).withColumn("n_corrupt", F.lit(bad.get["n_corrupt"]).cast("bigint"))


def _ns(df):
    from tsline.functions import timeunit as U
    return U.ts_to_ns(F.col("ts"), df.schema["ts"].dataType)


_FROM_NS = CUTOFF_NS - 5 * 86_400_000_000_000


@query("delete_range", f"""SELECT event_type AS measurement, count(*) AS n_points FROM events
WHERE NOT (epoch_us(ts) * 1000 > {_FROM_NS} AND epoch_us(ts) * 1000 < {CUTOFF_NS}) GROUP BY 1""")
def q_delete_range(spark, sf_dir):
    """The store rewritten without a time range, read back from the new folder."""
    path = delete_points(spark, write_lines(store_lines(spark, sf_dir)), scratch_path(spark, "deleted"),
                         after_ns=_FROM_NS, before_ns=CUTOFF_NS)
    return scan_points(spark, path).groupBy("measurement").agg(F.count(F.lit(1)).alias("n_points"))


@query("stream_read_back", """SELECT event_type AS measurement, CAST(user_id AS VARCHAR) AS user_id, value,
    epoch_us(ts) * 1000 AS time_ns FROM events""")
def q_stream_read_back(spark, sf_dir):
    """Stored lines scanned as a stream of points."""
    stored, out = write_lines(store_lines(spark, sf_dir)), scratch_path(spark, "stream-points")
    points = stream_points(spark, stored).where("_corrupt IS NULL").select(
        "measurement", F.col("tags")["user_id"].alias("user_id"),
        F.col("fields")["value"]["text"].cast("double").alias("value"), "time_ns")
    ST.start_files(points, out, scratch_path(spark, "stream-ck"), fmt="parquet").awaitTermination()
    return spark.read.parquet(out)


_DAY_US = 86_400_000_000


@query("stream_late", f"""WITH e AS (SELECT ts, epoch_us(ts) AS us, event_type,
    epoch_us(ts) // {_DAY_US} % 2 AS odd FROM events),
m AS (SELECT max(us) // 1000 * 1000 - 5000000 AS mark FROM e WHERE odd = 0),
kept AS (SELECT * FROM e, m WHERE odd = 0 OR us // 10000000 * 10000000 + 10000000 > mark)
SELECT us // 10000000 * 10000000000 AS window_start_ns, event_type, count(*) AS record_count
FROM kept GROUP BY ALL
HAVING us // 10000000 * 10000000 + 10000000 <= (SELECT max(us) // 1000 * 1000 - 5000000 FROM e)
""".replace("HAVING us // 10000000 * 10000000 + 10000000", "HAVING (us // 10000000 * 10000000) + 10000000")
       .replace("GROUP BY ALL\n", "GROUP BY us // 10000000, event_type\n"))
def q_stream_late(spark, sf_dir):
    """Two waves of files in order: rows of the second that lie behind the watermark of the first are dropped.

    Each wave is written by as many tasks as read it and is one run of the stream, so one
    micro-batch; the checkpoint carries the watermark and the files read already.
    """
    src, out = scratch_path(spark, "late-src"), scratch_path(spark, "late-out")
    ev = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    day = F.floor(_ns(ev) / (_DAY_US * 1000)) % 2
    checkpoint = scratch_path(spark, "stream-ck")
    for odd in (0, 1):
        ev.where(day == odd).write.mode("append").parquet(src)
        stream = ST.read_stream(spark, src, ev.schema)
        agg = ST.stream_tumble(stream, "ts", "10 seconds", ["event_type"], "value", watermark="5 seconds")
        ST.start_files(agg, out, checkpoint, fmt="parquet").awaitTermination()
    return spark.read.parquet(out).select("window_start_ns", "event_type", "record_count")


@query("sql_functions_more", f"""SELECT event_id, '"' || CAST(CAST(CAST(value AS DECIMAL(12, 2)) AS DECIMAL(38, 18)) AS VARCHAR) || '"' AS dec_text,
    epoch_us(ts) // 1000 * 1000 AS back_us, 60000000000 AS minute_ns, props AS unescaped FROM events""")
def q_sql_functions_more(spark, sf_dir):
    register_functions(spark)
    table(spark, sf_dir, "events").createOrReplaceTempView("tsline_events_fn")
    return spark.sql("""SELECT event_id, tsl_decimal(cast(cast(value AS DECIMAL(12, 2)) AS DECIMAL(38, 18))) AS dec_text,
        unix_micros(tsl_ns_to_time(tsl_ns_ntz(ts))) div 1000 * 1000 AS back_us, tsl_precision_ns('m') AS minute_ns,
        tsl_unescape(tsl_escape_tag(props)) AS unescaped FROM tsline_events_fn""")


@query("decode_repeated", """SELECT event_id, event_id % 3 = 0 AS is_corrupt FROM events""")
def q_decode_repeated(spark, sf_dir):
    """A repeated field key makes a line corrupt."""
    ev = table(spark, sf_dir, "events")
    line = F.concat(F.lit("m v="), F.col("event_id").cast("string"), F.lit("i"),
                    F.when(F.col("event_id") % 3 == 0, F.lit(",v=1i")).otherwise(F.lit("")), F.lit(" 1"))
    decoded = decode_lines(ev.select("event_id", line.alias("line")), keep=["event_id"])
    return decoded.select("event_id", F.col("_corrupt").isNotNull().alias("is_corrupt"))

"""Queries for payloads, packing, routing and write totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from tsline.functions.text import clean_payload
from tsline.operators.pack import pack_by_count, pack_by_interval, payloads, route
from tsline.operators.encode import encode_lines
from tsline.session import scratch_path
from tsline.sources.delivery import read_payload_lines, send_lines
from tsline.suite import sqlbits as S
from tsline.suite.formats import events_lines
from tsline.suite.registry import query, table

BATCH = 500
DAY_NS = 86_400_000_000_000

_CLEAN = """array_to_string(list_filter(list_transform(string_split({x}, chr(10)),
    lambda s: {trim}), lambda s: s <> ''), chr(10))"""


@query("payload_clean", f"""SELECT doc_id, md5(nullif({_CLEAN.format(x='text', trim=S.java_trim('s'))}, ''))
    AS body_md5, length(nullif({_CLEAN.format(x='text', trim=S.java_trim('s'))}, '')) AS body_chars
FROM documents""")
def q_payload_clean(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    body = clean_payload(F.col("text"))
    return docs.select("doc_id", F.md5(body).alias("body_md5"),
                       F.length(body).cast("bigint").alias("body_chars"))


# lines made dirty on purpose: null, empty, blank and padded ones
_DIRTY = f"""CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   '
    WHEN 3 THEN '  ' || {S.EVENTS_LINE} || chr(9) ELSE {S.EVENTS_LINE} END"""


@query("payload_join", f"""WITH d AS (SELECT event_type, event_id // {BATCH} AS batch_id, event_id,
    {S.java_trim(_DIRTY)} AS l FROM events)
SELECT event_type, batch_id, md5(string_agg(l, chr(10) ORDER BY event_id)) AS body_md5,
       count(*) AS n_lines, CAST(sum(strlen(l)) + count(*) - 1 AS BIGINT) AS n_bytes
FROM d WHERE l IS NOT NULL AND l <> '' GROUP BY event_type, batch_id""")
def q_payload_join(spark, sf_dir):
    lines = events_lines(spark, sf_dir, keep=["event_type", "event_id"])
    e = F.col("event_id") % 7
    dirty = (F.when(e == 0, F.lit(None)).when(e == 1, F.lit("")).when(e == 2, F.lit("   "))
              .when(e == 3, F.concat(F.lit("  "), F.col("line"), F.lit("\t")))
              .otherwise(F.col("line")))
    batch = F.floor(F.col("event_id") / BATCH).cast("bigint").alias("batch_id")
    out = payloads(lines.withColumn("line", dirty), ["event_type", batch], order="event_id")
    return out.select("event_type", "batch_id", F.md5("body").alias("body_md5"),
                      "n_lines", "n_bytes")


_RANKED = f"""SELECT event_type, epoch_us(ts) * 1000 AS time_ns, {S.EVENTS_LINE} AS line FROM events"""


@query("pack_by_count", f"""WITH r AS (SELECT event_type, line, time_ns,
    (row_number() OVER (PARTITION BY event_type ORDER BY time_ns, line) - 1) // {BATCH} AS batch_id
    FROM ({_RANKED}))
SELECT event_type, batch_id, md5(string_agg(line, chr(10) ORDER BY time_ns, line)) AS body_md5,
       count(*) AS n_lines, CAST(sum(strlen(line)) + count(*) - 1 AS BIGINT) AS n_bytes
FROM r GROUP BY event_type, batch_id""")
def q_pack_by_count(spark, sf_dir):
    lines = events_lines(spark, sf_dir, keep=["event_type"], time_col="time_ns")
    packed = pack_by_count(lines, BATCH, keys=["event_type"])
    return packed.select("event_type", "batch_id", F.md5("body").alias("body_md5"),
                         "n_lines", "n_bytes")


@query("pack_by_interval", f"""WITH b AS (SELECT *, time_ns // {DAY_NS} * {DAY_NS} AS bucket_ns
    FROM ({_RANKED})),
r AS (SELECT *, (row_number() OVER (PARTITION BY event_type, bucket_ns ORDER BY time_ns, line) - 1)
    // {BATCH} AS batch_id FROM b)
SELECT event_type, bucket_ns, batch_id, md5(string_agg(line, chr(10) ORDER BY time_ns, line))
    AS body_md5, count(*) AS n_lines, CAST(sum(strlen(line)) + count(*) - 1 AS BIGINT) AS n_bytes
FROM r GROUP BY event_type, bucket_ns, batch_id""")
def q_pack_by_interval(spark, sf_dir):
    lines = events_lines(spark, sf_dir, keep=["event_type"], time_col="time_ns")
    packed = pack_by_interval(lines, DAY_NS, BATCH, keys=["event_type"])
    return packed.select("event_type", "bucket_ns", "batch_id", F.md5("body").alias("body_md5"),
                         "n_lines", "n_bytes")


@query("write_stats", f"""WITH r AS (SELECT event_type, strlen(line) AS nb,
    (row_number() OVER (PARTITION BY event_type ORDER BY time_ns, line) - 1) // {BATCH} AS batch_id
    FROM ({_RANKED})),
b AS (SELECT event_type, batch_id, count(*) AS n_lines, sum(nb) + count(*) - 1 AS n_bytes
    FROM r GROUP BY ALL)
SELECT event_type, count(*) AS n_batches, CAST(sum(n_lines) AS BIGINT) AS n_lines,
    CAST(sum(n_bytes) AS BIGINT) AS n_bytes, CAST(max(n_bytes) AS BIGINT) AS max_batch_bytes
FROM b GROUP BY event_type""")
def q_write_stats(spark, sf_dir):
    lines = events_lines(spark, sf_dir, keep=["event_type"], time_col="time_ns")
    packed = pack_by_count(lines, BATCH, keys=["event_type"])
    return packed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_batches"), F.sum("n_lines").alias("n_lines"),
        F.sum("n_bytes").alias("n_bytes"), F.max("n_bytes").alias("max_batch_bytes"))


_ROUTED = S.line("event_type", [S.tag("user_id", "user_id", False)],
                 [S.fnum("value", "value")], S.ns("ts"))


@query("route_by_measurement", f"""SELECT 'db' || CAST(user_id % 3 AS VARCHAR) AS database,
    CASE WHEN user_id % 2 = 0 THEN 'short' ELSE 'autogen' END AS retention_policy,
    event_type AS measurement, count(*) AS n_lines, CAST(sum(strlen({_ROUTED})) AS BIGINT) AS n_bytes
FROM events GROUP BY ALL""")
def q_route_by_measurement(spark, sf_dir):
    """Routed rows through the sink, read back by destination."""
    ev = table(spark, sf_dir, "events")
    lines = encode_lines(ev, F.col("event_type"), tags=["user_id"], fields=["value"], time="ts",
                         keep=["user_id", "event_type"])
    routed = route(lines.select("line", "user_id", "event_type"),
                   F.concat(F.lit("db"), (F.col("user_id") % 3).cast("string")), F.col("event_type"),
                   F.when(F.col("user_id") % 2 == 0, "short"))
    out = scratch_path(spark, "routed")
    send_lines(routed.select("line", "database", "retention_policy"), out, "unrouted", batch_size=500)
    stored = read_payload_lines(spark, out)
    return (stored.groupBy("database", "retention_policy",
                           F.substring_index("line", ",", 1).alias("measurement"))
                  .agg(F.count(F.lit(1)).alias("n_lines"),
                       F.sum(F.octet_length("line")).cast("bigint").alias("n_bytes")))

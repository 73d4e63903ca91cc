"""Queries over stored lines read back as points."""

from __future__ import annotations

from pyspark.sql import functions as F

from tsline.functions import timeunit as U
from tsline.operators import explore as X
from tsline.operators.changelog import upsert_latest
from tsline.operators.encode import encode_lines
from tsline.operators.windows import tumble_agg, tumble_lines
from tsline.session import scratch_path
from tsline.sources.lines import read_back, scan_points, write_lines
from tsline.sources.store import LineStore
from tsline.suite import sqlbits as S
from tsline.suite.registry import query, table

# The store: measurement = event_type, tag user_id, fields value, note (null on
# every third event), event_id; time ts.
_NOTE = "CASE WHEN event_id % 3 = 0 THEN NULL ELSE props END"
_STORE_SERIES = "event_type || ',user_id=' || CAST(user_id AS VARCHAR)"
CUTOFF_NS = 1_705_000_000_000_000_000      # 2024-01-11T19:06:40Z


def store_lines(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("note", F.expr(_NOTE))
    return encode_lines(ev, F.col("event_type"), tags=["user_id"],
                        fields=["value", "note", "event_id"], time="ts")


def store_points(spark, sf_dir, tag=None):
    """The store as the reference's tests see it: lines written, then read back."""
    return scan_points(spark, write_lines(store_lines(spark, sf_dir)), tag)


@query("measurements", "SELECT DISTINCT event_type AS measurement FROM events")
def q_measurements(spark, sf_dir):
    return X.measurements(store_points(spark, sf_dir))


@query("count_points", "SELECT event_type AS measurement, count(*) AS n_points FROM events GROUP BY 1")
def q_count_points(spark, sf_dir):
    return X.count_points(store_points(spark, sf_dir))


@query("count_fields", f"""SELECT measurement, field_key, count(*) AS n_values FROM (
    SELECT event_type AS measurement, 'value' AS field_key FROM events
    UNION ALL SELECT event_type, 'note' FROM events WHERE ({_NOTE}) IS NOT NULL
    UNION ALL SELECT event_type, 'event_id' FROM events) GROUP BY ALL""")
def q_count_fields(spark, sf_dir):
    return X.count_fields(store_points(spark, sf_dir))


@query("tag_keys", "SELECT DISTINCT event_type AS measurement, 'user_id' AS tag_key FROM events")
def q_tag_keys(spark, sf_dir):
    return X.tag_keys(store_points(spark, sf_dir))


@query("field_keys", """SELECT DISTINCT measurement, field_key, field_type FROM (
    SELECT event_type AS measurement, 'value' AS field_key, 'float' AS field_type FROM events
    UNION ALL SELECT event_type, 'note', 'string' FROM events WHERE event_id % 3 <> 0
    UNION ALL SELECT event_type, 'event_id', 'integer' FROM events)""")
def q_field_keys(spark, sf_dir):
    return X.field_keys(store_points(spark, sf_dir))


@query("series_index", f"""SELECT event_type AS measurement, {_STORE_SERIES} AS series,
    count(*) AS n_points, min(epoch_us(ts)) * 1000 AS first_ns, max(epoch_us(ts)) * 1000 AS last_ns
FROM events GROUP BY ALL""")
def q_series_index(spark, sf_dir):
    return X.series_index(store_points(spark, sf_dir))


def _point_row(points):
    return points.select("measurement", F.col("tags")["user_id"].alias("user_id"),
                         F.col("fields")["event_id"]["text"].cast("bigint").alias("event_id"),
                         "time_ns")


_POINT_ROW = "event_type AS measurement, CAST(user_id AS VARCHAR) AS user_id, event_id, epoch_us(ts) * 1000 AS time_ns"


@query("filter_tag", f"SELECT {_POINT_ROW} FROM events WHERE user_id = 7")
def q_filter_tag(spark, sf_dir):
    return _point_row(store_points(spark, sf_dir, tag=("user_id", "7")))


@query("latest_n", f"""SELECT {_POINT_ROW}, {_STORE_SERIES} AS series FROM events
ORDER BY time_ns DESC, series LIMIT 5""")
def q_latest_n(spark, sf_dir):
    top = X.latest_n(store_points(spark, sf_dir), 5)
    return top.select("measurement", F.col("tags")["user_id"].alias("user_id"),
                      F.col("fields")["event_id"]["text"].cast("bigint").alias("event_id"),
                      "time_ns", "series")


@query("latest_n_tag", f"""SELECT {_POINT_ROW}, {_STORE_SERIES} AS series FROM events
WHERE user_id = 7 ORDER BY time_ns DESC, series LIMIT 5""")
def q_latest_n_tag(spark, sf_dir):
    top = X.latest_n(store_points(spark, sf_dir, tag=("user_id", "7")), 5)
    return top.select("measurement", F.col("tags")["user_id"].alias("user_id"),
                      F.col("fields")["event_id"]["text"].cast("bigint").alias("event_id"),
                      "time_ns", "series")


_FROM_NS = CUTOFF_NS - 5 * 86_400_000_000_000
_KEPT = f"NOT (epoch_us(ts) * 1000 > {_FROM_NS} AND epoch_us(ts) * 1000 < {CUTOFF_NS})"


def _stored(spark, sf_dir, deleted=False):
    """The store's lines in a ``LineStore``, appended in two parts, with a time range deleted."""
    store = LineStore(spark, scratch_path(spark, "line-store"))
    lines = store_lines(spark, sf_dir)
    for part in (0, 1):
        store.append(lines.where(F.pmod(F.xxhash64("line"), F.lit(2)) == part))
    if deleted:
        store.delete(after_ns=_FROM_NS, before_ns=CUTOFF_NS)
    return store


@query("store_filter_tag", f"SELECT {_POINT_ROW} FROM events WHERE user_id = 7")
def q_store_filter_tag(spark, sf_dir):
    """Only files that hold the tag pair are read."""
    return _point_row(_stored(spark, sf_dir).points(tag=("user_id", "7")))


@query("store_latest_n_tag", f"""SELECT {_POINT_ROW}, {_STORE_SERIES} AS series FROM events
WHERE user_id = 7 ORDER BY time_ns DESC, series LIMIT 5""")
def q_store_latest_n_tag(spark, sf_dir):
    top = X.latest_n(_stored(spark, sf_dir).points(tag=("user_id", "7")), 5)
    return top.select("measurement", F.col("tags")["user_id"].alias("user_id"),
                      F.col("fields")["event_id"]["text"].cast("bigint").alias("event_id"),
                      "time_ns", "series")


@query("store_range", f"""SELECT {_POINT_ROW} FROM events WHERE event_type = 'click'
AND epoch_us(ts) * 1000 > {_FROM_NS} AND epoch_us(ts) * 1000 < {CUTOFF_NS}""")
def q_store_range(spark, sf_dir):
    """Only files of the measurement and the time range are read."""
    return _point_row(_stored(spark, sf_dir).points("click", after_ns=_FROM_NS, before_ns=CUTOFF_NS))


@query("store_delete", f"""SELECT event_type AS measurement, count(*) AS n_points, max(epoch_us(ts)) * 1000 AS last_ns
FROM events WHERE {_KEPT} GROUP BY 1""")
def q_store_delete(spark, sf_dir):
    """A time range deleted by rewriting only the files that it cuts."""
    points = _stored(spark, sf_dir, deleted=True).points()
    return points.groupBy("measurement").agg(F.count(F.lit(1)).alias("n_points"), F.max("time_ns").alias("last_ns"))


@query("store_keys", f"""SELECT DISTINCT measurement, kind, key, type FROM (
    SELECT event_type AS measurement, 'tag' AS kind, 'user_id' AS key, 's' AS type FROM events WHERE {_KEPT}
    UNION ALL SELECT event_type, 'field', 'value', 'f' FROM events WHERE {_KEPT}
    UNION ALL SELECT event_type, 'field', 'note', 's' FROM events WHERE event_id % 3 <> 0 AND {_KEPT}
    UNION ALL SELECT event_type, 'field', 'event_id', 'i' FROM events WHERE {_KEPT})""")
def q_store_keys(spark, sf_dir):
    """The key catalog after two appends and a delete."""
    return _stored(spark, sf_dir, deleted=True).keys()


@query("store_counts", f"SELECT event_type AS measurement, count(*) AS n_points FROM events WHERE {_KEPT} GROUP BY 1")
def q_store_counts(spark, sf_dir):
    return _stored(spark, sf_dir, deleted=True).count_points()


@query("limit_n", "SELECT count(*) AS n_rows FROM (SELECT * FROM events LIMIT 5)")
def q_limit_n(spark, sf_dir):
    return store_points(spark, sf_dir).limit(5).agg(F.count(F.lit(1)).alias("n_rows"))


@query("delete_by_time", f"""SELECT event_type AS measurement, count(*) AS n_points,
    max(epoch_us(ts)) * 1000 AS last_ns FROM events WHERE epoch_us(ts) * 1000 <= {CUTOFF_NS} GROUP BY 1""")
def q_delete_by_time(spark, sf_dir):
    kept = X.delete_by_time(store_points(spark, sf_dir), after_ns=CUTOFF_NS)
    return kept.groupBy("measurement").agg(F.count(F.lit(1)).alias("n_points"),
                                           F.max("time_ns").alias("last_ns"))


@query("points_per_second", """SELECT epoch_us(ts) // 60000000 * 60000000000 AS bucket_ns,
    count(*) AS n_points, count(*) / 60.0 AS points_per_second FROM events GROUP BY 1""")
def q_points_per_second(spark, sf_dir):
    return X.points_per_interval(store_points(spark, sf_dir), 60_000_000_000)


@query("read_back", """SELECT doc_id, lang, source, text, n_chars FROM documents""")
def q_read_back(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    lines = encode_lines(docs, "documents", tags=["lang", "source"], fields=["text", "n_chars"],
                         time="doc_id", precision="ns")
    path = write_lines(lines)
    back = read_back(spark, path)
    return back.select(F.col("time_ns").alias("doc_id"), "lang", "source", "text", "n_chars")


@query("tumble_agg", """SELECT epoch_us(ts) // 10000000 * 10000000000 AS window_start_ns,
    epoch_us(ts) // 10000000 * 10000000000 + 10000000000 AS window_end_ns, event_type,
    round(avg(value), 6) AS avg_value, max(value) AS max_value, min(value) AS min_value,
    count(*) AS record_count FROM events GROUP BY ALL""")
def q_tumble_agg(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    out = tumble_agg(ev, "ts", "10 seconds", ["event_type"], "value")
    return out.withColumn("avg_value", F.round("avg_value", 6))


@query("tumble_lines", f"""WITH w AS (SELECT event_type,
    epoch_us(ts) // 10000000 * 10000000000 + 10000000000 AS window_end_ns,
    round(avg(value), 6) AS avg_value, max(value) AS max_value, min(value) AS min_value,
    count(*) AS record_count FROM events GROUP BY ALL)
SELECT {S.line("'event_stats'", [S.tag('event_type', 'event_type')],
               [S.fnum('avg_value', 'avg_value'), S.fnum('max_value', 'max_value'),
                S.fnum('min_value', 'min_value'), S.fint('record_count', 'record_count')],
               'window_end_ns')} AS line FROM w""")
def q_tumble_lines(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return tumble_lines(ev, "event_stats", "ts", "10 seconds", ["event_type"], "value", digits=6)


_HOUR_NS = 3_600_000_000_000


@query("upsert_latest", f"""SELECT event_type, epoch_us(ts) // 3600000000 * {_HOUR_NS} AS time_ns,
    arg_max(value, event_id) AS value, max(event_id) AS seq FROM events GROUP BY ALL""")
def q_upsert_latest(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    ns = U.ts_to_ns(F.col("ts"), ev.schema["ts"].dataType)
    # points of one series at one (hourly) time overwrite each other: the later event wins
    pts = ev.select("event_type", (U.floor_div(ns, _HOUR_NS) * F.lit(_HOUR_NS)).alias("time_ns"),
                    "value", "event_id")
    return upsert_latest(pts, ["event_type", "time_ns"], "event_id", ["value"])


@query("inline_values", f"""SELECT e.event_id, {S.line("'custom_metrics'",
    [S.tag('device_id', "'dev' || CAST(e.user_id AS VARCHAR)"), S.tag('region', 'v.region'),
     S.tag('status', 'v.status')],
    [S.fnum('metric1', 'v.metric1'), S.fnum('metric2', 'e.value')],
    S.ns("e.ts"))} AS line
FROM events e JOIN (VALUES ('click', 'us-east', 'active', 100.5, TIMESTAMP '2024-01-01 00:00:00'),
    ('view', 'us-west', 'inactive', CAST(NULL AS DOUBLE), TIMESTAMP '2024-01-01 00:00:00'),
    ('purchase', 'us-south', NULL, 75.2, TIMESTAMP '2024-01-01 00:00:00'),
    ('signup', NULL, 'active', 0.5, TIMESTAMP '2024-01-01 00:00:00'),
    ('error', NULL, NULL, CAST(NULL AS DOUBLE), TIMESTAMP '2024-01-01 00:00:00'))
    AS v(event_type, region, status, metric1, base) ON e.event_type = v.event_type""")
def q_inline_values(spark, sf_dir):
    table(spark, sf_dir, "events").createOrReplaceTempView("tsline_events")
    joined = spark.sql("""
        SELECT e.event_id, e.user_id, e.value, e.ts, v.region, v.status, v.metric1
        FROM tsline_events e JOIN (VALUES
            ('click', 'us-east', 'active', 100.5D, TIMESTAMP_NTZ '2024-01-01 00:00:00'),
            ('view', 'us-west', 'inactive', CAST(NULL AS DOUBLE), TIMESTAMP_NTZ '2024-01-01 00:00:00'),
            ('purchase', 'us-south', CAST(NULL AS STRING), 75.2D, TIMESTAMP_NTZ '2024-01-01 00:00:00'),
            ('signup', CAST(NULL AS STRING), 'active', 0.5D, TIMESTAMP_NTZ '2024-01-01 00:00:00'),
            ('error', CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS DOUBLE),
             TIMESTAMP_NTZ '2024-01-01 00:00:00'))
          AS v(event_type, region, status, metric1, base)
        ON e.event_type = v.event_type""")
    prepared = joined.withColumn("device_id", F.concat(F.lit("dev"), F.col("user_id").cast("string")))
    return encode_lines(prepared, "custom_metrics", tags=["device_id", "region", "status"],
                        fields={"metric1": "metric1", "metric2": "value"}, time="ts",
                        keep=["event_id"])

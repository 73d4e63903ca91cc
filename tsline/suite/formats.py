"""Queries for the scalar functions (I1-I17) and the flagship encode (L1)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsline.functions import escape as E
from tsline.functions import fmt
from tsline.functions import text as X
from tsline.functions import timeunit as U
from tsline.operators.encode import encode_lines
from tsline.suite import sqlbits as S
from tsline.suite.registry import query, table

EVENTS_TAGS = ["event_type", "user_id"]


def events_lines(spark, sf_dir, **kw):
    ev = table(spark, sf_dir, "events")
    return encode_lines(ev, "events", tags=EVENTS_TAGS, time="ts", **kw)


@query("encode_lines", f"SELECT {S.EVENTS_LINE} AS line FROM events")
def q_encode_lines(spark, sf_dir):
    return events_lines(spark, sf_dir)


@query("escape_tag", f"SELECT p_partkey, {S.esc_tag('p_name')} AS tag_text FROM part")
def q_escape_tag(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", E.escape_tag(F.col("p_name")).alias("tag_text"))


@query("quote_string", f"SELECT doc_id, {S.quote('text')} AS field_text FROM documents")
def q_quote_string(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", E.quote_string(F.col("text")).alias("field_text"))


@query("format_float", """SELECT event_id, CAST(value AS VARCHAR) AS f_double,
       CAST(-value AS VARCHAR) AS f_negative, CAST(CAST(value AS FLOAT) AS VARCHAR) AS f_float
FROM events""")
def q_format_float(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    v = F.col("value")
    return ev.select("event_id", fmt.field_text(v, T.DoubleType()).alias("f_double"),
                     fmt.field_text(-v, T.DoubleType()).alias("f_negative"),
                     fmt.field_text(v.cast("float"), T.FloatType()).alias("f_float"))


@query("format_int", """SELECT event_id, CAST(event_id AS VARCHAR) || 'i' AS f_bigint,
       CAST(user_id AS VARCHAR) || 'i' AS f_int, CAST(-(user_id % 100) AS VARCHAR) || 'i' AS f_smallint
FROM events""")
def q_format_int(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", fmt.field_text(F.col("event_id"), T.LongType()).alias("f_bigint"),
        fmt.field_text(F.col("user_id").cast("int"), T.IntegerType()).alias("f_int"),
        fmt.field_text((-(F.col("user_id") % 100)).cast("smallint"), T.ShortType())
        .alias("f_smallint"))


@query("format_bool", """SELECT event_id, CAST(value > 50 AS VARCHAR) AS f_bool,
       CAST(event_type = 'click' AS VARCHAR) AS f_click FROM events""")
def q_format_bool(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", fmt.field_text(F.col("value") > 50, T.BooleanType()).alias("f_bool"),
                     fmt.field_text(F.col("event_type") == "click", T.BooleanType())
                     .alias("f_click"))


@query("format_decimal", """SELECT event_id,
       '"' || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) || '"' AS f_decimal,
       '"' || CAST(CAST(value * 1000 AS DECIMAL(12,1)) AS VARCHAR) || '"' AS f_decimal_1
FROM events""")
def q_format_decimal(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    d2 = F.col("value").cast("decimal(10,2)")
    d1 = (F.col("value") * 1000).cast("decimal(12,1)")
    return ev.select("event_id", fmt.field_text(d2, T.DecimalType(10, 2)).alias("f_decimal"),
                     fmt.field_text(d1, T.DecimalType(12, 1)).alias("f_decimal_1"))


_TS3 = """CASE event_id % 3 WHEN 0 THEN date_trunc('minute', ts)
                           WHEN 1 THEN date_trunc('second', ts) ELSE ts END"""
_TS3_MS = "CASE WHEN event_id % 5 = 0 THEN date_trunc('millisecond', ts) ELSE ({}) END".format(_TS3)


@query("format_timestamp", f"""SELECT event_id, '"' || CASE
    WHEN epoch_us(t) % 1000000 = 0 AND second(t) = 0 THEN strftime(t, '%Y-%m-%dT%H:%M')
    WHEN epoch_us(t) % 1000000 = 0 THEN strftime(t, '%Y-%m-%dT%H:%M:%S')
    WHEN epoch_us(t) % 1000 = 0 THEN strftime(t, '%Y-%m-%dT%H:%M:%S.%g')
    ELSE strftime(t, '%Y-%m-%dT%H:%M:%S.%f') END || '"' AS f_ts
FROM (SELECT event_id, {_TS3_MS} AS t FROM events)""")
def q_format_timestamp(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    e = F.col("event_id")
    micros = U.epoch_micros(F.col("ts"), ev.schema["ts"].dataType)

    def trunc(step):  # truncation on the epoch value: no session time zone involved
        return U.floor_div(micros, step) * F.lit(step)
    m3 = (F.when(e % 3 == 0, trunc(60_000_000)).when(e % 3 == 1, trunc(1_000_000))
           .otherwise(micros))
    t = U.micros_to_ntz(F.when(e % 5 == 0, trunc(1000)).otherwise(m3))
    return ev.select("event_id", fmt.field_text(t, T.TimestampNTZType()).alias("f_ts"))


@query("tag_text", f"""SELECT l_orderkey, l_linenumber,
    'lineitem' || ',l_discount=' || CAST(l_discount AS VARCHAR) || ',l_linenumber=' || CAST(l_linenumber AS VARCHAR)
    || ',l_partkey=' || CAST(l_partkey AS VARCHAR) || ',l_quantity=' || CAST(l_quantity AS VARCHAR)
    || ',l_returnflag=' || {S.esc_tag('l_returnflag')}
    || ' l_extendedprice=' || CAST(l_extendedprice AS VARCHAR) || ' ' || CAST({S.ns('l_shipdate')} AS VARCHAR) AS line
FROM lineitem""")
def q_tag_text(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return encode_lines(li, "lineitem",
                        tags=["l_returnflag", "l_quantity", "l_linenumber", "l_partkey", "l_discount"],
                        fields=["l_extendedprice"], time="l_shipdate",
                        keep=["l_orderkey", "l_linenumber"])


@query("format_all_types", f"""SELECT l_orderkey, l_linenumber,
    'lineitem,l_returnflag=' || {S.esc_tag('l_returnflag')} || ' ' || concat_ws(',',
      'l_linenumber=' || CAST(l_linenumber AS VARCHAR) || 'i',
      'l_orderkey=' || CAST(l_orderkey AS VARCHAR) || 'i',
      'small=' || CAST(l_linenumber AS VARCHAR) || 'i',
      'disc_f=' || CAST(CAST(l_discount AS FLOAT) AS VARCHAR),
      'l_extendedprice=' || CAST(l_extendedprice AS VARCHAR),
      'returned=' || CAST(l_returnflag = 'R' AS VARCHAR),
      'l_linestatus=' || {S.quote('l_linestatus')},
      'tax_dec="' || CAST(CAST(l_tax AS DECIMAL(10,2)) AS VARCHAR) || '"',
      'shipped="' || CASE WHEN second(l_shipdate) = 0 AND epoch_us(l_shipdate) % 1000000 = 0
                          THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M')
                          ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') END || '"')
    || ' ' || CAST({S.ns('l_shipdate')} AS VARCHAR) AS line
FROM lineitem""")
def q_format_all_types(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    typed = li.select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate",
        F.col("l_linenumber").cast("smallint").alias("small"),
        F.col("l_discount").cast("float").alias("disc_f"), "l_extendedprice",
        (F.col("l_returnflag") == "R").alias("returned"), "l_linestatus",
        F.col("l_tax").cast("decimal(10,2)").alias("tax_dec"),
        F.col("l_shipdate").alias("shipped"))
    fields = ["l_linenumber", "l_orderkey", "small", "disc_f", "l_extendedprice", "returned",
              "l_linestatus", "tax_dec", "shipped"]
    return encode_lines(typed, "lineitem", tags=["l_returnflag"], fields=fields,
                        time="l_shipdate", keep=["l_orderkey", "l_linenumber"])


_PRECISIONS = ["ns", "us", "ms", "s", "m", "h"]
_FACTORS = {p: U.PRECISION_NS[p] for p in _PRECISIONS}


@query("time_to_ns", "SELECT event_id, " + ", ".join(
    f"event_id * {f} AS ns_from_{p}" for p, f in _FACTORS.items()) + " FROM events")
def q_time_to_ns(spark, sf_dir):
    # ids reach any size: hours above 2,562,047 have no bigint of ns, and one such value is no reason to lose the others
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", *[U.epoch_to_ns(F.col("event_id"), p, overflow="null").alias(f"ns_from_{p}")
                                   for p in _PRECISIONS])


@query("time_to_unit", "SELECT event_id, " + ", ".join(
    f"(epoch_us(ts) * 1000) // {f} AS t_{p}" for p, f in _FACTORS.items()) + " FROM events")
def q_time_to_unit(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    dtype = ev.schema["ts"].dataType
    ns = U.ts_to_ns(F.col("ts"), dtype)
    return ev.select("event_id", *[U.ns_to_unit(ns, p).alias(f"t_{p}") for p in _PRECISIONS])


@query("time_from_timestamp", """SELECT event_id, epoch_us(ts) * 1000 AS time_ns,
       epoch_us(ts) // 1000 AS time_ms_compat FROM events""")
def q_time_from_timestamp(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    dtype = ev.schema["ts"].dataType
    return ev.select("event_id", U.time_value(F.col("ts"), dtype).alias("time_ns"),
                     U.time_value(F.col("ts"), dtype, unit="compat").alias("time_ms_compat"))


@query("time_from_instant", """SELECT event_id, (epoch_us(ts) // 1000) * 1000000 AS time_ns
FROM events""")
def q_time_from_instant(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", U.instant_to_ns(F.col("ts"), ev.schema["ts"].dataType)
                     .alias("time_ns"))


@query("time_default", """SELECT event_id, true AS has_time FROM events""")
def q_time_default(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    lines = encode_lines(ev, "events", tags=EVENTS_TAGS, fields=["value"], keep=["event_id"],
                         time_col="time_ns")
    # 'now' is one value per query: later than any stored event, same for every row
    return lines.select("event_id", (F.col("time_ns") > F.lit(1_700_000_000_000_000_000))
                        .alias("has_time"))


@query("line_bytes", f"""SELECT doc_id, strlen({S.line("'documents'",
    [S.tag('lang', 'lang'), S.tag('source', 'source')],
    [S.fstr('text', 'text'), S.fint('n_chars', 'n_chars')], 'doc_id * 1000000000')}) AS n_bytes
FROM documents""")
def q_line_bytes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    lines = encode_lines(docs, "documents", tags=["lang", "source"], fields=["text", "n_chars"],
                         time="doc_id", precision="s", keep=["doc_id"])
    return lines.select("doc_id", X.line_bytes(F.col("line")).cast("bigint").alias("n_bytes"))


@query("sql_functions", f"SELECT {S.EVENTS_LINE} AS line FROM events")
def q_sql_functions(spark, sf_dir):
    from tsline.functions.sql import register_functions
    register_functions(spark)
    table(spark, sf_dir, "events").createOrReplaceTempView("tsline_sql_events")
    dtype = spark.table("tsline_sql_events").schema["ts"].dataType
    ns_fn = "tsl_ns_ntz" if isinstance(dtype, T.TimestampNTZType) else "tsl_ns"
    return spark.sql(f"""
        SELECT tsl_line('events',
                        concat_ws('', tsl_tag('event_type', event_type),
                                      tsl_tag('user_id', cast(user_id AS STRING))),
                        concat_ws(',', tsl_field('event_id', tsl_int(event_id)),
                                       tsl_field('value', tsl_float(value)),
                                       tsl_field('props', tsl_quote(props))),
                        {ns_fn}(ts)) AS line
        FROM tsline_sql_events""")

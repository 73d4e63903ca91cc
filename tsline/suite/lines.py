"""Queries for roles, nulls, changelog, the point path and decoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from tsline.functions import timeunit as U
from tsline.operators.custom import encode_custom, points_from
from tsline.operators.decode import decode_lines
from tsline.operators.encode import encode_lines
from tsline.operators.points import encode, points_to_lines, to_points
from tsline.suite import sqlbits as S
from tsline.suite.formats import EVENTS_TAGS, events_lines
from tsline.suite.registry import query, table

_NULL_ET = "nullif(event_type, 'click')"


@query("null_fields", f"""SELECT event_id, {S.line("'events'", [S.tag('user_id', 'user_id', False)],
    [S.fstr('et', _NULL_ET), S.fnum('value', 'value')], S.ns('ts'))} AS line FROM events""")
def q_null_fields(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("et", F.expr(_NULL_ET))
    return encode_lines(ev, "events", tags=["user_id"], fields=["et", "value"], time="ts",
                        keep=["event_id"])


@query("null_tags", f"""SELECT event_id, {S.line("'events'",
    [S.tag('et', _NULL_ET), S.tag('user_id', 'user_id', False)],
    [S.fnum('value', 'value')], S.ns('ts'))} AS line FROM events""")
def q_null_tags(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("et", F.expr(_NULL_ET))
    return encode_lines(ev, "events", tags=["et", "user_id"], fields=["value"], time="ts",
                        keep=["event_id"])


@query("empty_drop", f"""SELECT event_id, {S.line("'events'", [S.tag('user_id', 'user_id', False)],
    [S.fstr('et', _NULL_ET)], S.ns('ts'))} AS line FROM events WHERE {_NULL_ET} IS NOT NULL""")
def q_empty_drop(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("et", F.expr(_NULL_ET))
    return encode_lines(ev, "events", tags=["user_id"], fields=["et"], time="ts",
                        keep=["event_id"])


@query("empty_marker", f"""SELECT event_id, 'events,user_id=' || CAST(user_id AS VARCHAR) || ' '
    || coalesce({S.fstr('et', _NULL_ET)}, '_empty=true') || ' ' || CAST({S.ns('ts')} AS VARCHAR)
    AS line FROM events""")
def q_empty_marker(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("et", F.expr(_NULL_ET))
    return encode_lines(ev, "events", tags=["user_id"], fields=["et"], time="ts",
                        keep=["event_id"], on_empty="marker")


_OP = "CASE event_id % 4 WHEN 0 THEN '+I' WHEN 1 THEN '-U' WHEN 2 THEN '+U' ELSE '-D' END"


@query("changelog_filter", f"""SELECT event_id, {S.EVENTS_LINE} AS line FROM events
WHERE ({_OP}) IN ('+I', '+U')""")
def q_changelog_filter(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("op", F.expr(_OP))
    return encode_lines(ev, "events", tags=EVENTS_TAGS, fields=["event_id", "value", "props"],
                        time="ts", keep=["event_id"], op_col="op")


@query("roles_default", f"""SELECT c_custkey, {S.line("'customer'",
    [S.tag('c_mktsegment', 'c_mktsegment'), S.tag('c_nationkey', 'c_nationkey', False)],
    [S.fstr('c_name', 'c_name'), S.fnum('c_acctbal', 'c_acctbal')],
    'c_custkey * 1000000000')} AS line FROM customer""")
def q_roles_default(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    # comma list with stray spaces, as in a SQL option; fields = the remaining columns
    return encode_lines(cust, "customer", tags=" c_mktsegment, c_nationkey ,", time="c_custkey",
                        precision="s", keep=["c_custkey"])


@query("roles_explicit", f"""SELECT n_nationkey, {S.line("'nation'",
    [S.tag('n_regionkey', 'n_regionkey', False)], [S.fstr('n_name', 'n_name')],
    'n_nationkey * 3600000000000')} AS line FROM nation""")
def q_roles_explicit(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    # 'no_such_column' is ignored, as unknown names in the role options are
    return encode_lines(nation, "nation", tags="n_regionkey", fields="n_name, no_such_column",
                        time="n_nationkey", precision="h", keep=["n_nationkey"])


@query("computed_columns", f"""SELECT o_orderkey, {S.line("'orders'",
    ["',env=prod'", S.tag('status', 'upper(o_orderstatus)')],
    [S.fnum('price2', 'o_totalprice * 2'), S.fstr('priority', 'o_orderpriority')],
    S.ns('o_orderdate'))} AS line FROM orders""")
def q_computed_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return encode_lines(orders, "orders",
                        tags={"env": F.lit("prod"), "status": F.upper("o_orderstatus")},
                        fields={"price2": F.col("o_totalprice") * 2, "priority": "o_orderpriority"},
                        time="o_orderdate", keep=["o_orderkey"])


def _flat_points(points):
    tags = F.array_join(F.transform(F.array_sort(F.map_entries("tags")),
                                    lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    fields = F.array_join(F.transform(F.map_entries("fields"), lambda e: F.concat_ws(
        ":", e["key"], e["value"]["type"], e["value"]["text"])), ",")
    return points.select("measurement", tags.alias("tags_text"), fields.alias("fields_text"),
                         "time_ns")


@query("to_points", """SELECT 'events' AS measurement,
    'event_type=' || event_type || ',user_id=' || CAST(user_id AS VARCHAR) AS tags_text,
    'event_id:i:' || CAST(event_id AS VARCHAR) || ',value:f:' || CAST(value AS VARCHAR)
    || ',props:s:' || props AS fields_text, epoch_us(ts) * 1000 AS time_ns FROM events""")
def q_to_points(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return _flat_points(to_points(ev, "events", tags=EVENTS_TAGS, time="ts"))


@query("points_to_lines", f"SELECT {S.EVENTS_LINE} AS line FROM events")
def q_points_to_lines(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return points_to_lines(to_points(ev, "events", tags=EVENTS_TAGS, time="ts"))


@query("path_equivalence", """SELECT CAST(0 AS BIGINT) AS n_diff, CAST(count(*)
    + (SELECT count(*) FROM documents WHERE text IS NOT NULL OR lang IS NOT NULL OR n_chars IS NOT NULL) AS BIGINT)
    AS n_lines FROM events WHERE event_type <> 'click' OR event_id % 2 = 0""")
def q_path_equivalence(spark, sf_dir):
    """Both encoders over events with null tags and fields, and over the texts of documents."""
    ev = table(spark, sf_dir, "events").select(
        "ts", F.expr(_NULL_ET).alias("et"), F.expr("CASE WHEN event_id % 2 = 0 THEN user_id END").alias("half"),
        F.expr("CASE WHEN event_id % 3 = 0 THEN props END").alias("third"), "user_id")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars", "source")
    sides = []
    for path in ("line", "point"):
        a = encode(ev, "events", tags=["user_id", "third"], fields=["et", "half"], time="ts", path=path)
        b = encode(docs, "docs", tags=["source"], fields=["text", "lang", "n_chars"], time="doc_id", path=path)
        sides.append(a.select("line").unionByName(b.select("line")))
    # multiset difference in one grouped pass: per distinct line, copies on each side
    tagged = (sides[0].select("line", F.lit(1).alias("a"), F.lit(0).alias("b"))
              .unionByName(sides[1].select("line", F.lit(0).alias("a"), F.lit(1).alias("b"))))
    per_line = tagged.groupBy("line").agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    return per_line.agg(F.sum(F.abs(F.col("na") - F.col("nb"))).alias("n_diff"),
                        F.sum("na").alias("n_lines"))


def decoded_events(spark, sf_dir):
    return decode_lines(events_lines(spark, sf_dir))


@query("decode_lines", """SELECT 'events' AS measurement, event_type, CAST(user_id AS VARCHAR) AS user_id,
    event_id, value, props, epoch_us(ts) * 1000 AS time_ns, 0 AS n_corrupt FROM events""")
def q_decode_lines(spark, sf_dir):
    pts = decoded_events(spark, sf_dir)
    f = F.col("fields")
    return pts.select(
        "measurement", F.col("tags")["event_type"].alias("event_type"),
        F.col("tags")["user_id"].alias("user_id"),
        f["event_id"]["text"].cast("bigint").alias("event_id"),
        f["value"]["text"].cast("double").alias("value"), f["props"]["text"].alias("props"),
        "time_ns", F.col("_corrupt").isNotNull().cast("int").alias("n_corrupt"))


@query("custom_encoder", f"""SELECT o_orderkey, 'orders,status=' || o_orderstatus || ' total='
    || CAST(o_totalprice AS VARCHAR) || ',late=' || CAST(o_orderpriority = '1-URGENT' AS VARCHAR)
    || ' ' || CAST({S.ns('o_orderdate')} AS VARCHAR) AS line FROM orders WHERE o_orderstatus <> 'P'""")
def q_custom_encoder(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    dtype = orders.schema["o_orderdate"].dataType

    def my_line(df):
        # user code: any Column; null means 'skip this record'
        return F.when(F.col("o_orderstatus") != "P", F.concat(
            F.lit("orders,status="), F.col("o_orderstatus"), F.lit(" total="),
            F.col("o_totalprice").cast("string"), F.lit(",late="),
            (F.col("o_orderpriority") == "1-URGENT").cast("string"), F.lit(" "),
            U.ts_to_ns(F.col("o_orderdate"), dtype).cast("string")))
    return encode_custom(orders, my_line, keep=["o_orderkey"])


@query("custom_point", f"""SELECT {S.line("'orders'", [S.tag('prio', 'o_orderpriority')],
    [S.fnum('total', 'o_totalprice'), S.fint('cust', 'o_custkey')], S.ns('o_orderdate'))} AS line
FROM orders""")
def q_custom_point(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    dtype = orders.schema["o_orderdate"].dataType

    def my_point(df):
        return F.struct(
            F.lit("orders").alias("measurement"),
            F.create_map(F.lit("prio"), F.col("o_orderpriority")).alias("tags"),
            F.create_map(F.lit("total"), F.struct(F.lit("f").alias("type"),
                                                  F.col("o_totalprice").cast("string").alias("text")),
                         F.lit("cust"), F.struct(F.lit("i").alias("type"),
                                                 F.col("o_custkey").cast("string").alias("text")))
            .alias("fields"),
            U.ts_to_ns(F.col("o_orderdate"), dtype).alias("time_ns"))
    return points_to_lines(points_from(orders, my_point))

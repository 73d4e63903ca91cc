"""The tsl_* SQL functions give the same text as the DataFrame functions."""

from pyspark.sql import functions as F

from tsline.functions import escape as E
from tsline.functions.sql import FUNCTIONS, register_functions
from tsline.functions.text import java_trim
from tsline.functions.timeunit import epoch_to_ns

HOSTILE = ["plain", "a b", "a,b=c", 'q"uote', "back\\slash", "new\nline", "cr\rx", "", " \t pad \n",
           "é漢😀", "\\n literal"]


def test_sql_functions_match_column_functions(spark):
    names = register_functions(spark)
    assert set(names) == set(FUNCTIONS)
    df = spark.createDataFrame([(s, i) for i, s in enumerate(HOSTILE)], "s string, i bigint")
    df.createOrReplaceTempView("hostile")
    got = spark.sql("""SELECT s, tsl_escape_tag(s) AS t, tsl_escape_measurement(s) AS m,
                              tsl_quote(s) AS q, tsl_trim(s) AS tr, tsl_epoch_ns(i, 's') AS ns,
                              tsl_tag('k k', s) AS tag, tsl_field('f', tsl_int(i)) AS fld
                       FROM hostile""")
    want = df.select("s", E.escape_tag(F.col("s")).alias("t"),
                     E.escape_measurement(F.col("s")).alias("m"),
                     E.quote_string(F.col("s")).alias("q"), java_trim(F.col("s")).alias("tr"),
                     epoch_to_ns(F.col("i"), "s").alias("ns"),
                     F.concat(F.lit(",k\\ k="), E.escape_tag(F.col("s"))).alias("tag"),
                     F.concat(F.lit("f="), F.col("i").cast("string"), F.lit("i")).alias("fld"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_tsl_line_drops_rows_without_fields(spark):
    register_functions(spark)
    rows = spark.sql("""SELECT tsl_line('m', tsl_tag('h', 'x'), concat_ws(',', tsl_field('v', NULL)),
                                         5) AS a,
                               tsl_line('m', '', 'v=1.0', 7) AS b""").collect()[0]
    assert rows["a"] is None and rows["b"] == "m v=1.0 7"


def test_views_over_stored_lines(spark, tmp_dir):
    from tsline.functions.sql import create_line_view, create_points_view, create_read_back_view
    from tsline.sources.lines import write_lines
    df = spark.createDataFrame([("s1", "hall", 21.5, 1), ("s2", "room", 22.0, 2)],
                               "sensor_id string, location string, temperature double, t bigint")
    df.createOrReplaceTempView("sensors")
    lines = create_line_view(spark, "sensor_lines", "sensors", "sensor",
                             tags="sensor_id, location", time="t", precision="s")
    path = write_lines(lines, tmp_dir)
    create_points_view(spark, "sensor_points", path)
    got = spark.sql("SELECT tags['location'] AS loc, fields['temperature'].text AS temp "
                    "FROM sensor_points ORDER BY time_ns").collect()
    assert [(r["loc"], r["temp"]) for r in got] == [("hall", "21.5"), ("room", "22.0")]
    create_read_back_view(spark, "sensor_rows", path)
    rows = spark.sql("SELECT sensor_id, temperature FROM sensor_rows ORDER BY time").collect()
    assert [(r[0], r[1]) for r in rows] == [("s1", 21.5), ("s2", 22.0)]

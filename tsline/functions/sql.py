"""The scalar functions as SQL temporary functions (2.10), plus a view helper for SQL users.

Every function is a SQL UDF (``CREATE TEMPORARY FUNCTION ... RETURN expr``):
Spark inlines its body into the plan, so it runs as built-in expressions with
code generation, exactly like the DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tsline.functions import escape as E
from tsline.functions.timeunit import PRECISION_NS
from tsline.operators.points import encode

def _sql_lit(text: str) -> str:
    """A Spark SQL expression for ``text``: a quoted literal (backslash doubled),
    or ``char(n)`` for a newline / carriage return."""
    if text in ("\n", "\r"):
        return f"char({ord(text)})"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _replace_chain(x: str, pairs) -> str:
    for a, b in pairs:
        x = f"replace({x}, {_sql_lit(a)}, {_sql_lit(b)})"
    return x


_TAG = E.TAG_PAIRS
_MEAS = E.MEASUREMENT_PAIRS
_STR = E.STRING_PAIRS
_PRECISION_CASE = "CASE p " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in PRECISION_NS.items()) \
    + " ELSE raise_error(concat('unknown precision ', coalesce(p, 'null'))) END"


def _checked(product: str, source: str) -> str:
    """A product that must fit 64 bits: null only where its source is."""
    return (f"CASE WHEN {source} IS NULL THEN NULL ELSE coalesce({product}, "
            f"raise_error(concat('time out of range: ', cast({source} AS STRING)))) END")


# ISO text as a field shows it: seconds and fraction only where they are not zero
_MICRO = "cast(extract(SECOND FROM t) * 1000000 AS BIGINT)"
_ISO = ("concat(date_format(t, \"yyyy-MM-dd'T'HH:mm\"), CASE "
        f"WHEN {_MICRO} = 0 THEN '' "
        f"WHEN {_MICRO} % 1000000 = 0 THEN date_format(t, ':ss') "
        f"WHEN {_MICRO} % 1000 = 0 THEN date_format(t, ':ss.SSS') "
        "ELSE date_format(t, ':ss.SSSSSS') END)")
_UNESCAPE = (r"array_join(transform(split(s, '\\\\\\\\'), p -> regexp_replace(replace(replace(p, "
             r"'\\n', char(10)), '\\r', char(13)), '\\\\([ ,=" '"' r"])', '$1')), '\\')")

# name -> (parameters, return type, body)
FUNCTIONS = {
    "tsl_escape_tag": ("s STRING", "STRING", _replace_chain("s", _TAG)),
    "tsl_escape_key": ("s STRING", "STRING", _replace_chain("s", _TAG)),
    "tsl_escape_measurement": ("s STRING", "STRING", _replace_chain("s", _MEAS)),
    "tsl_quote": ("s STRING", "STRING", f"concat('\"', {_replace_chain('s', _STR)}, '\"')"),
    "tsl_int": ("x BIGINT", "STRING", "concat(cast(x AS STRING), 'i')"),
    "tsl_float": ("x DOUBLE", "STRING", "cast(x AS STRING)"),
    "tsl_bool": ("b BOOLEAN", "STRING", "cast(b AS STRING)"),
    "tsl_epoch_ns": ("x BIGINT, p STRING", "BIGINT",
                     _checked(f"try_multiply(x, cast({_PRECISION_CASE} AS BIGINT))", "x")),
    "tsl_ns": ("t TIMESTAMP", "BIGINT", _checked("try_multiply(unix_micros(t), 1000L)", "t")),
    # TIMESTAMP_NTZ read as UTC wall clock, independent of the session time zone
    "tsl_ns_ntz": ("t TIMESTAMP_NTZ", "BIGINT",
                   "(cast(unix_date(cast(t AS DATE)) AS BIGINT) * 86400000000"
                   " + cast(hour(t) AS BIGINT) * 3600000000 + cast(minute(t) AS BIGINT) * 60000000"
                   " + cast(extract(SECOND FROM t) * 1000000 AS BIGINT))"
                   " * 1000"),
    "tsl_tag": ("k STRING, v STRING", "STRING",
                f"CASE WHEN v IS NULL THEN NULL ELSE concat(',', {_replace_chain('k', _TAG)}, '=', "
                f"{_replace_chain('v', _TAG)}) END"),
    "tsl_field": ("k STRING, text STRING", "STRING",
                  f"CASE WHEN text IS NULL THEN NULL ELSE concat({_replace_chain('k', _TAG)}, '=', "
                  "text) END"),
    "tsl_line": ("m STRING, tags STRING, fields STRING, t BIGINT", "STRING",
                 "CASE WHEN fields IS NULL OR fields = '' THEN NULL ELSE concat("
                 f"{_replace_chain('m', _MEAS)}, coalesce(tags, ''), ' ', fields, ' ', "
                 "cast(coalesce(t, unix_micros(current_timestamp()) * 1000) AS STRING)) END"),
    "tsl_trim": ("s STRING", "STRING", "regexp_replace(s, '^[\\\\x00-\\\\x20]+|[\\\\x00-\\\\x20]+$', '')"),
    # decimals and timestamps are quoted text
    "tsl_decimal": ("x DECIMAL(38, 18)", "STRING", "concat('\"', cast(x AS STRING), '\"')"),
    "tsl_timestamp": ("t TIMESTAMP_NTZ", "STRING", "concat('\"', " + _ISO + ", '\"')"),
    "tsl_ns_to_time": ("ns BIGINT", "TIMESTAMP", "timestamp_micros(cast(floor(ns / 1000.0BD) AS BIGINT))"),
    "tsl_precision_ns": ("p STRING", "BIGINT", f"cast({_PRECISION_CASE} AS BIGINT)"),
    "tsl_unescape": ("s STRING", "STRING", _UNESCAPE),
    "tsl_bytes": ("s STRING", "INT", "octet_length(s)"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) every ``tsl_*`` temporary function in this session."""
    for name, (params, ret, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {ret} "
                  f"RETURN {body}")
    return sorted(FUNCTIONS)


def create_line_view(spark: SparkSession, view: str, source: str | DataFrame, measurement: str,
                     tags=None, fields=None, time=None, path: str = "line",
                     **options) -> DataFrame:
    """Encode a table (or a SQL query, or a DataFrame) with role options and
    publish the lines as a temporary view, for ``INSERT INTO sink SELECT line FROM view``.
    ``path`` picks the line or point encoder (``converter.type``)."""
    if isinstance(source, DataFrame):
        df = source
    elif source.strip().lower().startswith("select"):
        df = spark.sql(source)
    else:
        df = spark.table(source)
    lines = encode(df, measurement, tags, fields, time, path=path, **options)
    lines.createOrReplaceTempView(view)
    return lines


def create_points_view(spark: SparkSession, view: str, path: str) -> DataFrame:
    """Stored lines at ``path`` as a view of decoded points, for SQL:
    ``SELECT measurement, tags['host'], fields['v'].text, time_ns FROM view``."""
    from tsline.sources.lines import scan_points
    points = scan_points(spark, path)
    points.createOrReplaceTempView(view)
    return points


def create_read_back_view(spark: SparkSession, view: str, path: str, measurement: str | None = None,
                          tags=None, fields=None) -> DataFrame:
    """Stored lines as a view with one typed column per tag and field (``SELECT *``)."""
    from tsline.sources.lines import read_back
    rows = read_back(spark, path, tags, fields, measurement)
    rows.createOrReplaceTempView(view)
    return rows

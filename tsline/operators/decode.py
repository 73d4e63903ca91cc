"""Lines -> points (L3, I19) and points -> typed columns.

Parsing uses built-in regex expressions only.  Every pattern uses possessive
runs (``++``/``*+``) so long values never make the JVM regex engine recurse
per character.  The long part of a line (the field set) is scanned by one
``regexp_extract_all``; keys are then cut from each short fragment.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsline.functions import escape as E
from tsline.functions.fmt import BOOL, FLOAT, INT, STRING
from tsline.functions.timeunit import ns_to_timestamp

# Patterns of the line grammar (Java regex).
HEAD = r"(?s)^((?:[^ \\]++|\\.)++)"                       # measurement + tags, up to first bare space
MEAS = r"(?s)^((?:[^ ,\\]++|\\.)++)"
KEY = r"(?:[^ ,=\\]++|\\.)++"
TAG_VALUE = r"(?:[^ ,\\]++|\\.)*+"
TAG = rf"(?s),({KEY})=({TAG_VALUE})"
FIELD_KEY = r'(?:[^ ,="\\]++|\\.)++'
QUOTED = r'"(?:[^"\\]++|\\.)*+"'
FIELD = rf'(?s)(?:^|,)({FIELD_KEY})=({QUOTED}|[^ ,"]++)'
TIME = r"^-?[0-9]{1,19}$"
# the whole line in one possessive pass: measurement, tags, fields, optional time
LINE = (rf"(?s)^(?:[^ ,\\]++|\\.)++(?:,{KEY}={TAG_VALUE})*+ "
        rf"{FIELD_KEY}=(?:{QUOTED}|[^ ,\"]++)(?:,{FIELD_KEY}=(?:{QUOTED}|[^ ,\"]++))*+"
        r"(?: -?[0-9]{1,19})?$")
TRUE_WORDS = ("t", "T", "true", "True", "TRUE")
FALSE_WORDS = ("f", "F", "false", "False", "FALSE")

POINT_COLUMNS = ("measurement", "tags", "fields", "time_ns", "_corrupt")


def _field_type(raw: Column) -> Column:
    """Type letter from the raw value text: quoted -> s, trailing i -> i, bool word -> b, else f."""
    return (F.when(raw.startswith('"'), F.lit(STRING))
             .when(raw.endswith("i"), F.lit(INT))
             .when(raw.isin(*TRUE_WORDS, *FALSE_WORDS), F.lit(BOOL))
             .otherwise(F.lit(FLOAT)))


def _field_text(raw: Column, unescape: bool) -> Column:
    """Raw value text -> unescaped value text (no quotes, no 'i')."""
    inner = raw.substr(F.lit(2), F.length(raw) - 2)
    return (F.when(raw.startswith('"'), E.unescape(inner) if unescape else inner)
             .when(raw.endswith("i"), raw.substr(F.lit(1), F.length(raw) - 1))
             .when(raw.isin(*TRUE_WORDS), F.lit("true"))
             .when(raw.isin(*FALSE_WORDS), F.lit("false"))
             .otherwise(raw))


def _decode_steps(df: DataFrame, line_col: str) -> DataFrame:
    """Each step is a projection of its own: Catalyst keeps a costly expression
    that later steps use several times in one place instead of repeating it."""
    c = F.col
    df = df.withColumn("_head", F.regexp_extract(c(line_col), HEAD, 1))
    df = df.withColumn("_rest", c(line_col).substr(F.length("_head") + 2, F.length(line_col)))
    df = df.withColumn("_last", F.substring_index("_rest", " ", -1))
    df = df.withColumn("_has_t", (F.instr("_rest", " ") > 0) & c("_last").rlike(TIME))
    df = df.select("*",
                   F.when(c("_has_t"), c("_rest").substr(F.lit(1), F.length("_rest")
                                                         - F.length("_last") - 1))
                    .otherwise(c("_rest")).alias("_fields"),
                   F.when(c("_has_t"), c("_last").try_cast("bigint")).alias("_t"),
                   F.regexp_extract("_head", MEAS, 1).alias("_meas"),
                   F.regexp_extract_all("_head", F.lit(TAG), 1).alias("_tk"),
                   F.regexp_extract_all("_head", F.lit(TAG), 2).alias("_tv"))
    df = df.select("*", F.regexp_extract_all("_fields", F.lit(FIELD), 1).alias("_fk"),
                   F.regexp_extract_all("_fields", F.lit(FIELD), 2).alias("_fv"))
    ok = (c(line_col).rlike(LINE)
          & (F.size(F.array_distinct("_tk")) == F.size("_tk"))
          & (F.size(F.array_distinct("_fk")) == F.size("_fk"))
          & (~c("_has_t") | c("_t").isNotNull()))
    df = df.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    good = c("_ok")
    # a line without any backslash has nothing to unescape: skip the per-element work
    plain_head = F.instr("_head", "\\") == 0
    plain_fields = F.instr("_fields", "\\") == 0
    tags = F.map_from_arrays(
        F.when(plain_head, c("_tk")).otherwise(F.transform("_tk", E.unescape)),
        F.when(plain_head, c("_tv")).otherwise(F.transform("_tv", E.unescape)))
    keys = F.when(plain_fields, c("_fk")).otherwise(F.transform("_fk", E.unescape))
    texts = (F.when(plain_fields, F.transform("_fv", lambda x: _field_text(x, False)))
              .otherwise(F.transform("_fv", lambda x: _field_text(x, True))))
    values = F.arrays_zip(F.transform("_fv", _field_type), texts).cast(
        "array<struct<type:string,text:string>>")
    fields = F.map_from_arrays(keys, values)
    return df.select("*",
                     F.when(good, F.when(plain_head, c("_meas")).otherwise(E.unescape(c("_meas"))))
                     .alias("measurement"),
                     F.when(good, tags).alias("tags"),
                     F.when(good, fields).alias("fields"),
                     F.when(good, c("_t")).alias("time_ns"),
                     F.when(~good, c(line_col)).alias("_corrupt"))


def decode_lines(lines: DataFrame, line_col: str = "line", keep: Sequence[str] = ()) -> DataFrame:
    """Decode a ``line`` column into POINT columns plus ``_corrupt`` (the bad line)."""
    src = lines.select(*[F.col(f"`{k}`") for k in keep], F.col(line_col).alias("_line"))
    return _decode_steps(src, "_line").select(*[F.col(f"`{k}`") for k in keep], *POINT_COLUMNS)


def _line_key(name: str) -> str:
    """A key as it appears on a line (escaped)."""
    return E.escape_text(name, E.TAG_PAIRS)


def _typed_value(raw: Column, dtype: T.DataType) -> Column:
    """Raw field text on a line -> value of the requested Spark type."""
    plain = F.instr(raw, "\\") == 0
    if isinstance(dtype, T.StringType):
        return F.when(plain, _field_text(raw, False)).otherwise(_field_text(raw, True))
    if isinstance(dtype, T.BooleanType):
        return (F.when(raw.isin(*TRUE_WORDS), F.lit(True))
                 .when(raw.isin(*FALSE_WORDS), F.lit(False)))
    number = F.when(raw.endswith("i"), raw.substr(F.lit(1), F.length(raw) - 1)).otherwise(raw)
    return number.try_cast(dtype)


RESERVED = ("time_ns", "measurement", "_corrupt")


def column_names(tags: Sequence[str], fields: Sequence[str], time_col: str = "time") -> tuple[dict, dict]:
    """Column of each tag and field key.

    A key that is also another column's name (``time``, ``time_ns``,
    ``measurement``, ``_corrupt``, or a key of both kinds) gets the suffix
    ``_tag`` or ``_field``.  Names are compared without case, as Spark does.
    """
    taken = [n.lower() for n in (*RESERVED, time_col, *tags, *fields)]

    def named(key: str, suffix: str) -> str:
        return key + suffix if taken.count(key.lower()) > 1 else key
    return {k: named(k, "_tag") for k in tags}, {k: named(k, "_field") for k in fields}


def decode_columns(lines: DataFrame, tags: Sequence[str], fields: Mapping[str, T.DataType],
                   line_col: str = "line", time_col: str = "time",
                   keep_corrupt: bool = False) -> DataFrame:
    """Lines -> one typed column per requested tag and field, for a known layout.

    Each key is cut out by its own anchored, possessive regex, so no map is
    built and no lambda runs per row; the whole projection compiles.  Lines
    outside the grammar, with a repeated key or with a time that does not fit
    are corrupt, as in ``decode_lines``: they are left out, or with
    ``keep_corrupt`` kept with the line in ``_corrupt`` and nulls elsewhere.
    A key missing on a line gives null.
    """
    c = F.col
    df = lines.select(c(line_col).alias("_line"))
    df = df.withColumn("_head", F.regexp_extract("_line", HEAD, 1))
    df = df.withColumn("_rest", c("_line").substr(F.length("_head") + 2, F.length("_line")))
    df = df.withColumn("_last", F.substring_index("_rest", " ", -1))
    df = df.withColumn("_has_t", (F.instr("_rest", " ") > 0) & c("_last").rlike(TIME))
    df = df.select("*", F.when(c("_has_t"), c("_rest").substr(
        F.lit(1), F.length("_rest") - F.length("_last") - 1)).otherwise(c("_rest")).alias("_fields"),
        F.when(c("_has_t"), c("_last").try_cast("bigint")).alias("_t"))
    df = df.select("*", F.regexp_extract_all("_head", F.lit(TAG), 1).alias("_tk"),
                   F.regexp_extract_all("_head", F.lit(TAG), 2).alias("_tv"),
                   F.regexp_extract_all("_fields", F.lit(FIELD), 1).alias("_fk"),
                   F.regexp_extract_all("_fields", F.lit(FIELD), 2).alias("_fv"))
    good = F.coalesce(c("_line").rlike(LINE)
                      & (F.size(F.array_distinct("_tk")) == F.size("_tk"))
                      & (F.size(F.array_distinct("_fk")) == F.size("_fk"))
                      & (~c("_has_t") | c("_t").isNotNull()), F.lit(False))
    # a filter on the extracted keys would be pushed below their projection and every pattern run twice;
    # it stays above a projection that numbers rows
    df = df.select("*", good.alias("_good"), F.monotonically_increasing_id().alias("_row"))
    if not keep_corrupt:
        df = df.where(c("_good") & (c("_row") >= 0))
    plain_head = F.instr("_head", "\\") == 0
    meas = F.regexp_extract("_head", MEAS, 1)
    whole = (lambda x: F.when(c("_good"), x)) if keep_corrupt else (lambda x: x)
    cols = [whole(ns_to_timestamp(c("_t"))).alias(time_col), whole(c("_t")).alias("time_ns"),
            whole(F.when(plain_head, meas).otherwise(E.unescape(meas))).alias("measurement")]

    def lookup(keys: str, values: str, key: str) -> Column:
        # keys are matched in their escaped form: nothing to unescape on the key side
        pos = F.array_position(keys, F.lit(_line_key(key))).cast("int")
        return F.when(pos > 0, F.element_at(values, pos))

    tag_names, field_names = column_names(tags, list(fields), time_col)
    for k in tags:
        raw = lookup("_tk", "_tv", k)
        cols.append(whole(F.when(plain_head, raw).otherwise(E.unescape(raw))).alias(tag_names[k]))
    for k, dtype in fields.items():
        cols.append(whole(_typed_value(lookup("_fk", "_fv", k), dtype)).alias(field_names[k]))
    if keep_corrupt:
        cols.append(F.when(~c("_good"), c("_line")).alias("_corrupt"))
    return df.select(*cols)


def _typed_field(fields: Column, name: str, dtype: T.DataType) -> Column:
    text = fields[name]["text"]
    if isinstance(dtype, T.StringType):
        return text
    return text.try_cast(dtype)


def pivot_points(points: DataFrame, tag_keys: Sequence[str], field_types: Mapping[str, T.DataType],
                 time_col: str = "time") -> DataFrame:
    """Points -> one column per tag and field, typed (L6).  ``time`` is a TIMESTAMP
    (microsecond resolution) next to the exact ``time_ns``."""
    cols = [ns_to_timestamp(F.col("time_ns")).alias(time_col), F.col("time_ns"),
            F.col("measurement")]
    tag_names, field_names = column_names(tag_keys, list(field_types), time_col)
    cols += [F.col("tags")[k].alias(tag_names[k]) for k in tag_keys]
    cols += [_typed_field(F.col("fields"), k, t).alias(field_names[k]) for k, t in field_types.items()]
    return points.where(F.col("_corrupt").isNull()).select(*cols)


# Field type letter -> Spark type used when the read-back schema is inferred.
LETTER_TYPES = {INT: T.LongType(), FLOAT: T.DoubleType(), BOOL: T.BooleanType(),
                STRING: T.StringType()}

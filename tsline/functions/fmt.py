"""Value text of fields and tags, chosen from the Spark type.

The formatting is decided once on the driver from the schema; what runs on
the executors is a plain built-in expression per column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsline.functions import escape as E
from tsline.functions.timeunit import TIMESTAMPS, epoch_micros, micros_to_ntz

# Field type letters of the POINT struct.
INT, FLOAT, BOOL, STRING = "i", "f", "b", "s"

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)


def check_supported(name: str, dtype: T.DataType) -> None:
    ok = isinstance(dtype, _INTS + _FLOATS + TIMESTAMPS
                    + (T.BooleanType, T.StringType, T.DecimalType))
    if not ok:
        raise TypeError(
            f"column {name!r} has type {dtype.simpleString()}; only boolean, integer, "
            "float, double, decimal, string and timestamp columns can be tags or fields")


def iso_text(c: Column, dtype: T.DataType) -> Column:
    """Timestamp -> ISO local text (I7): ``2024-01-01T00:00``, seconds only when
    not zero, fraction in 3 or 6 digits; NTZ as stored, TIMESTAMP in UTC."""
    ntz = c if isinstance(dtype, T.TimestampNTZType) else micros_to_ntz(epoch_micros(c, dtype))
    s = ntz.cast("string")                       # 'yyyy-MM-dd HH:mm:ss[.f{1,6}]'
    head = F.replace(F.substring(s, 1, 19), F.lit(" "), F.lit("T"))
    frac = F.regexp_extract(s, r"\.(\d+)$", 1)
    padded = F.when(F.length(frac) <= 3, F.rpad(frac, 3, "0")).otherwise(F.rpad(frac, 6, "0"))
    no_frac = F.when(F.substring(head, 17, 3) == ":00", F.substring(head, 1, 16)).otherwise(head)
    return F.when(frac == "", no_frac).otherwise(F.concat(head, F.lit("."), padded))


def field_type(dtype: T.DataType, decimal_as: str = "string") -> str:
    if isinstance(dtype, T.BooleanType):
        return BOOL
    if isinstance(dtype, _INTS):
        return INT
    if isinstance(dtype, _FLOATS):
        return FLOAT
    if isinstance(dtype, T.DecimalType):
        return FLOAT if decimal_as == "float" else STRING
    return STRING


def field_raw(c: Column, dtype: T.DataType, decimal_as: str = "string",
              non_finite: str = "keep") -> Column:
    """Unescaped value text of a field (the ``text`` of a POINT field)."""
    if isinstance(dtype, TIMESTAMPS):
        return iso_text(c, dtype)
    if isinstance(dtype, T.DecimalType) and decimal_as == "float":
        c = c.cast("double")
        dtype = T.DoubleType()
    text = c.cast("string")
    if isinstance(dtype, _FLOATS) and non_finite == "drop":
        bad = F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
        text = F.when(~bad, text)
    return text


def render_field(raw: Column, ftype: Column | str, mode: str = "full") -> Column:
    """Field value text on the wire from (type letter, raw text)."""
    if isinstance(ftype, str):
        if ftype == INT:
            return F.concat(raw, F.lit("i"))
        if ftype == STRING:
            return E.quote_string(raw, mode)
        return raw
    return (F.when(ftype == INT, F.concat(raw, F.lit("i")))
            .when(ftype == STRING, E.quote_string(raw, mode))
            .otherwise(raw))


def field_text(c: Column, dtype: T.DataType, mode: str = "full", decimal_as: str = "string",
               non_finite: str = "keep") -> Column:
    """Typed field value as written (I9): ``42i``, ``3.14``, ``true``, ``"txt"``."""
    return render_field(field_raw(c, dtype, decimal_as, non_finite),
                        field_type(dtype, decimal_as), mode)


def tag_raw(c: Column, dtype: T.DataType, empty_tag: str = "keep") -> Column:
    """Any supported type -> tag text before escaping (I8, Q22)."""
    text = iso_text(c, dtype) if isinstance(dtype, TIMESTAMPS) else c.cast("string")
    if empty_tag == "drop":
        text = F.when(text != "", text)
    return text

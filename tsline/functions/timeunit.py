"""Time conversion to the single nanosecond clock of the line text.

All conversions are built-in expressions and independent of the session time
zone: TIMESTAMP_NTZ values are read as UTC wall clock from their date and time
of day, TIMESTAMP values through ``unix_micros``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Precision codes and their length in nanoseconds.
PRECISION_NS = {
    "ns": 1,
    "us": 1_000,
    "ms": 1_000_000,
    "s": 1_000_000_000,
    "m": 60_000_000_000,
    "h": 3_600_000_000_000,
}

INTEGRAL = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def precision_factor(precision: str) -> int:
    """ns per unit of ``precision`` (I15); unknown codes raise (Q3)."""
    try:
        return PRECISION_NS[precision]
    except KeyError:
        raise ValueError(
            f"unknown precision {precision!r}; expected one of {sorted(PRECISION_NS)}") from None


def floor_div(c: Column, factor: int) -> Column:
    """Integer division rounding toward minus infinity, as a bigint."""
    f = F.lit(factor).cast("bigint")
    # exact: the dividend is a multiple of f, and `div` is integral division
    return F.call_function("div", c - F.pmod(c, f), f)


def checked_multiply(c: Column, factor: int, overflow: str = "raise") -> Column:
    """``c * factor`` as bigint; on overflow fail the task (``"raise"``) or give
    null (``"null"``), whatever the session's ANSI setting is."""
    product = F.try_multiply(c, F.lit(factor).cast("bigint"))
    if overflow == "null":
        return product
    # the error branch is only evaluated when the product is null
    return F.coalesce(product, F.when(c.isNotNull(), F.raise_error(
        F.lit(f"time value overflows nanoseconds (x{factor})"))).cast("bigint"))


def epoch_to_ns(c: Column, precision: str = "ms", overflow: str = "raise") -> Column:
    """Epoch integer in ``precision`` units -> ns.

    ``overflow="raise"`` fails the task on overflow; ``"null"`` gives null so
    the caller can leave the row out.
    """
    factor = precision_factor(precision)
    c = c.cast("bigint")
    return c if factor == 1 else checked_multiply(c, factor, overflow)


def ns_to_unit(c: Column, precision: str) -> Column:
    """ns -> epoch integer in ``precision`` units, flooring (reverse of I15)."""
    factor = precision_factor(precision)
    return c if factor == 1 else floor_div(c, factor)


def ntz_epoch_micros(c: Column) -> Column:
    """TIMESTAMP_NTZ read as UTC wall clock -> epoch microseconds."""
    return (F.unix_date(c.cast("date")).cast("bigint") * F.lit(86_400_000_000)
            + F.hour(c).cast("bigint") * F.lit(3_600_000_000)
            + F.minute(c).cast("bigint") * F.lit(60_000_000)
            + (F.extract(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("bigint"))


def epoch_micros(c: Column, dtype: T.DataType) -> Column:
    """Any timestamp flavour -> epoch microseconds (session-zone free)."""
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_epoch_micros(c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    raise TypeError(f"not a timestamp type: {dtype.simpleString()}")


def ts_to_ns(c: Column, dtype: T.DataType, overflow: str = "raise") -> Column:
    """Timestamp column -> epoch ns (I11); instants after 2262 overflow ns."""
    return checked_multiply(epoch_micros(c, dtype), 1000, overflow)


def ts_to_ms(c: Column, dtype: T.DataType) -> Column:
    """Timestamp column -> epoch ms, flooring (the reference's unit for timestamps)."""
    return floor_div(epoch_micros(c, dtype), 1000)


def instant_to_ns(c: Column, dtype: T.DataType) -> Column:
    """Instant at millisecond resolution -> ns; sub-ms digits are dropped."""
    return ts_to_ms(c, dtype) * F.lit(1_000_000)


def micros_to_ntz(c: Column) -> Column:
    """Epoch microseconds -> TIMESTAMP_NTZ holding the UTC wall clock."""
    return F.timestamp_add("MICROSECOND", c, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def to_utc_timestamp(c: Column, dtype: T.DataType) -> Column:
    """Any timestamp flavour -> TIMESTAMP (an instant), NTZ read as UTC."""
    if isinstance(dtype, T.TimestampType):
        return c
    return F.timestamp_micros(epoch_micros(c, dtype))


def ns_to_timestamp(c: Column) -> Column:
    """Epoch ns -> TIMESTAMP (microsecond resolution, floor)."""
    return F.timestamp_micros(floor_div(c, 1000))


def now_ns() -> Column:
    """Current time in ns, one value per query / micro-batch."""
    return F.unix_micros(F.current_timestamp()) * F.lit(1000)


def time_value(c: Column | None, dtype: T.DataType | None, precision: str = "ms",
               unit: str = "ns", overflow: str = "raise") -> Column:
    """Role 'time' -> the number written at the end of a line.

    ``unit="ns"`` (default): every type becomes ns.  ``unit="compat"``: integers
    become ns, timestamps stay in ms (two units on one wire, as the reference).
    A missing column or a null value means 'now'; with ``overflow="null"`` a
    value that overflows ns gives null (so the line is dropped, not re-timed).
    """
    if unit not in ("ns", "compat"):
        raise ValueError(f"time unit must be 'ns' or 'compat', got {unit!r}")
    precision_factor(precision)
    if c is None:
        return now_ns()
    if isinstance(dtype, INTEGRAL):
        value = epoch_to_ns(c, precision, overflow)
    elif isinstance(dtype, TIMESTAMPS):
        value = ts_to_ms(c, dtype) if unit == "compat" else ts_to_ns(c, dtype, overflow)
    else:
        raise TypeError(
            f"time column must be BIGINT/INT or TIMESTAMP, got {dtype.simpleString()}")
    return F.when(c.isNull(), now_ns()).otherwise(value)

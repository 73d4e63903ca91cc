"""Encoding inside the sink, for SQL ``INSERT INTO sink SELECT * FROM src``.

A Python data source writer only receives rows, so when a SQL user inserts
raw columns with role options (``measurement``, ``tag-fields``,
``field-fields``, ``timestamp-field``, ``source-precision``) the lines are
built here, one Arrow batch at a time with Arrow compute kernels.  The rules are
those of ``operators.encode``; the text of some doubles of 1e7 and more, or
under 1e-3, may have other digits that denote the same number.  DataFrames with
raw rows never come here: ``send_lines`` and ``start_sink`` encode in the JVM.
"""

from __future__ import annotations

import time as _time
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tsline.functions.timeunit import precision_factor

from tsline.functions.escape import (CONTROL_PAIRS, MEASUREMENT_PAIRS, STRING_PAIRS, TAG_PAIRS,
                                     escape_text)
from tsline.operators.changelog import KEPT_KINDS


@dataclass(frozen=True)
class ArrowSpec:
    measurement: str
    tags: tuple[str, ...]
    fields: tuple[str, ...]
    time: str | None
    precision: str = "ms"
    now_ns: int | None = None      # 'now' for rows without a time: one value per job
    op: str | None = None          # changelog column: only +I and +U rows become lines
    marker: bool = False           # a row without fields gets the field _empty=true
    compat: bool = False           # the short escape rules


def _names(value) -> list[str]:
    return [p.strip() for p in (value or "").split(",") if p.strip()]


def spec_from_options(opts: dict, schema: pa.Schema, now_ns: int | None = None) -> ArrowSpec:
    """Role options -> spec; unknown names are ignored, default fields = the rest."""
    present = set(schema.names)
    tags = sorted(n for n in _names(opts.get("tag-fields")) if n in present)
    time = opts.get("timestamp-field")
    time = time.strip() if time and time.strip() in present else None
    op = (opts.get("op-field") or "").strip() or None
    if op and op not in present:
        raise ValueError(f"op-field {op!r} is not a column")
    marker = _choice(opts, "on-empty", ("drop", "marker")) == "marker"
    compat = _choice(opts, "escape", ("full", "compat")) == "compat"
    given = _names(opts.get("field-fields"))
    fields = [n for n in given if n in present] if given else \
        [n for n in schema.names if n not in tags and n not in (time, op)]
    if not fields and not marker:
        raise ValueError("no field columns: every row would be dropped")
    precision = (opts.get("source-precision") or "ms").strip()
    precision_factor(precision)
    return ArrowSpec(opts["measurement"], tuple(tags), tuple(fields), time, precision, now_ns,
                     op, marker, compat)


def _choice(opts: dict, key: str, allowed: tuple[str, ...]) -> str:
    value = (opts.get(key) or allowed[0]).strip()
    if value not in allowed:
        raise ValueError(f"option {key!r} must be one of {allowed}, got {value!r}")
    return value


def _replace(arr: pa.Array, pairs) -> pa.Array:
    for a, b in pairs:
        arr = pc.replace_substring(arr, a, b)
    return arr


def _cat(*parts) -> pa.Array:
    return pc.binary_join_element_wise(*parts, "")


def _java_scientific(x: float, float32: bool) -> str:
    text = repr(np.float32(x)) if float32 else repr(float(x))
    text = text.replace("np.float32(", "").rstrip(")")
    d = Decimal(text).normalize()
    sign, digits, exp = d.as_tuple()
    e = exp + len(digits) - 1
    mant = str(digits[0]) + "." + ("".join(map(str, digits[1:])) or "0")
    return ("-" if sign else "") + mant + "E" + str(e)


def java_float_text(arr: pa.Array) -> pa.Array:
    """Floating point text as Java prints it (``1.0E7``, ``0.23``, ``NaN``)."""
    float32 = pa.types.is_float32(arr.type)
    text = pc.cast(arr, pa.string())
    text = pc.if_else(pc.match_substring_regex(text, r"^-?[0-9]+$"), _cat(text, pa.scalar(".0")), text)
    mag = pc.abs(pc.cast(arr, pa.float64()))
    finite = pc.is_finite(arr)
    sci = pc.and_(finite, pc.and_(pc.not_equal(mag, 0.0),
                                  pc.or_(pc.less(mag, 1e-3), pc.greater_equal(mag, 1e7))))
    if pc.any(sci).as_py():
        values = arr.to_pylist()
        flags = sci.to_pylist()
        fixed = [_java_scientific(v, float32) if f else None for v, f in zip(values, flags)]
        text = pc.if_else(sci, pa.array(fixed, pa.string()), text)
    text = pc.if_else(pc.is_nan(arr), pa.scalar("NaN"), text)
    text = pc.if_else(pc.equal(arr, float("inf")), pa.scalar("Infinity"), text)
    text = pc.if_else(pc.equal(arr, float("-inf")), pa.scalar("-Infinity"), text)
    return text


def _micros(arr: pa.Array) -> pa.Array:
    unit_type = pa.timestamp("us", tz=arr.type.tz)
    return pc.cast(pc.cast(arr, unit_type), pa.int64())


def iso_text(arr: pa.Array) -> pa.Array:
    """Timestamp -> ``2024-01-01T00:00[:ss[.fff|.ffffff]]`` (UTC wall clock)."""
    micros = _micros(arr)
    m = pc.fill_null(micros, 0).to_numpy(zero_copy_only=False)
    frac = np.mod(m, 1_000_000)                   # floor modulo: right for pre-1970 too
    secs = np.mod(np.floor_divide(m, 1_000_000), 60)
    ntz = pc.cast(micros, pa.timestamp("us"))
    base = pc.strftime(ntz, format="%Y-%m-%dT%H:%M")
    pad = lambda v, n: pc.utf8_lpad(pc.cast(pa.array(v), pa.string()), n, "0")
    with_sec = _cat(base, pa.scalar(":"), pad(secs, 2))
    frac_text = pc.if_else(pa.array(frac % 1000 == 0),
                           _cat(with_sec, pa.scalar("."), pad(frac // 1000, 3)),
                           _cat(with_sec, pa.scalar("."), pad(frac, 6)))
    no_frac = pc.if_else(pa.array(secs == 0), base, with_sec)
    text = pc.if_else(pa.array(frac == 0), no_frac, frac_text)
    return pc.if_else(pc.is_valid(micros), text, pa.scalar(None, pa.string()))


def _raw_text(arr: pa.Array) -> pa.Array:
    t = arr.type
    if pa.types.is_floating(t):
        return java_float_text(arr)
    if pa.types.is_timestamp(t):
        return iso_text(arr)
    if pa.types.is_boolean(t):
        return pc.if_else(arr, pa.scalar("true"), pa.scalar("false"))
    return pc.cast(arr, pa.string())


def field_text(arr: pa.Array, compat: bool = False) -> pa.Array:
    t = arr.type
    raw = _raw_text(arr)
    if pa.types.is_integer(t):
        return _cat(raw, pa.scalar("i"))
    if pa.types.is_string(t) or pa.types.is_large_string(t) or pa.types.is_timestamp(t) \
            or pa.types.is_decimal(t):
        pairs = STRING_PAIRS[len(CONTROL_PAIRS):] if compat else STRING_PAIRS
        return _cat(pa.scalar('"'), _replace(raw, pairs), pa.scalar('"'))
    if pa.types.is_floating(t) or pa.types.is_boolean(t):
        return raw
    raise TypeError(f"column type {t} cannot be a field")


def tag_text(arr: pa.Array, compat: bool = False) -> pa.Array:
    raw = _raw_text(arr)
    if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) \
            or pa.types.is_timestamp(arr.type):
        return _replace(raw, TAG_PAIRS[len(CONTROL_PAIRS):] if compat else TAG_PAIRS)
    return raw


def time_ns(rb: pa.RecordBatch, spec: ArrowSpec) -> pa.Array:
    now = pa.scalar(spec.now_ns if spec.now_ns is not None else _time.time_ns() // 1000 * 1000,
                    pa.int64())
    if spec.time is None:
        return pa.array(np.full(rb.num_rows, now.as_py(), dtype=np.int64))
    col = rb.column(rb.schema.get_field_index(spec.time))
    if pa.types.is_timestamp(col.type):
        value = pc.multiply_checked(_micros(col), 1000)
    elif pa.types.is_integer(col.type):
        value = pc.multiply_checked(pc.cast(col, pa.int64()), precision_factor(spec.precision))
    else:
        raise TypeError(f"time column must be BIGINT/INT or TIMESTAMP, got {col.type}")
    return pc.fill_null(value, now)


def _pieces(names, texts, compat: bool, rows: int) -> pa.Array:
    """``,name=text`` of every column that has a value, joined row by row (empty without any)."""
    joined = pa.array([""] * rows, pa.string())
    for name, text in zip(names, texts):
        key = name if compat else escape_text(name, TAG_PAIRS)
        joined = _cat(joined, pc.fill_null(_cat(pa.scalar(f",{key}="), text), ""))
    return joined


def encode_batch(rb: pa.RecordBatch, spec: ArrowSpec) -> pa.Array:
    """Rows of one Arrow batch -> lines; rows without a field or a kept row kind give no line."""
    col = lambda n: rb.column(rb.schema.get_field_index(n))
    meas = spec.measurement if spec.compat else escape_text(spec.measurement, MEASUREMENT_PAIRS)
    tags = _pieces(spec.tags, [tag_text(col(n), spec.compat) for n in spec.tags], spec.compat, rb.num_rows)
    fields = _pieces(spec.fields, [field_text(col(n), spec.compat) for n in spec.fields], spec.compat,
                     rb.num_rows)
    fields = pc.utf8_slice_codeunits(fields, 1)
    present = pc.not_equal(fields, "")
    if spec.marker:
        fields = pc.if_else(present, fields, pa.scalar("_empty=true"))
        present = pa.array([True] * rb.num_rows)
    if spec.op:
        kept = pc.is_in(col(spec.op), value_set=pa.array(KEPT_KINDS, col(spec.op).type))
        present = pc.and_(present, kept)
    line = _cat(pa.scalar(meas), tags, pa.scalar(" "), fields, pa.scalar(" "),
                pc.cast(time_ns(rb, spec), pa.string()))
    return pc.if_else(present, line, pa.scalar(None, pa.string()))

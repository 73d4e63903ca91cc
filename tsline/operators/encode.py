"""Rows -> lines (L1, C2, C4-C6, C11, K3): one built-in projection.

The line is a single ``concat`` of per-column fragments; ``concat_ws`` skips
the fragments of null tags and null fields.  No Python runs per row, so the
whole projection stays inside one whole-stage-codegen span next to the scan.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsline.functions import escape as E
from tsline.functions.fmt import field_text, tag_raw
from tsline.functions.timeunit import time_value
from tsline.plans.roles import ColumnLike, LineSpec, Roles, resolve

EMPTY_MARKER = "_empty=true"
_PLAIN_TAG_TYPES = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                    T.FloatType, T.DoubleType, T.DecimalType)


def tags_text(spec: LineSpec) -> Column:
    """``,k1=v1,k2=v2`` with null tags left out (C4); empty string when none."""
    frags = [F.concat(F.lit("," + _plain_key(r.name, spec.escape) + "="), _tag_value(r, spec))
             for r in spec.tags]
    return F.concat_ws("", *frags) if frags else F.lit("")


def _tag_value(r, spec: LineSpec) -> Column:
    raw = tag_raw(r.col, r.dtype, spec.empty_tag)
    if isinstance(r.dtype, _PLAIN_TAG_TYPES):      # digits, '-', '.', letters: nothing to escape
        return raw
    return E.escape_tag(raw, spec.escape)


def fields_text(spec: LineSpec) -> Column:
    """``k1=v1,k2=v2`` with null fields left out (C5); empty string when none."""
    frags = [F.concat(F.lit(_plain_key(r.name, spec.escape) + "="),
                      field_text(r.col, r.dtype, spec.escape, spec.decimal_as, spec.non_finite))
             for r in spec.fields]
    return F.concat_ws(",", *frags) if frags else F.lit("")


def _plain_key(name: str, mode: str) -> str:
    """Escape a key known on the driver (same rule as ``escape.escape_key``)."""
    return name if mode == "compat" else E.escape_text(name, E.TAG_PAIRS)


def time_text(spec: LineSpec) -> Column:
    t = spec.time
    return time_value(t.col if t else None, t.dtype if t else None,
                      spec.precision, spec.time_unit, spec.overflow)


def has_field(spec: LineSpec) -> Column:
    """True when at least one field will be written.

    Tested on the raw columns, not on the built text, so a filter on it is
    cheap and its null checks can reach the Parquet scan.
    """
    conds = []
    for r in spec.fields:
        c = r.col.isNotNull()
        if spec.non_finite == "drop" and isinstance(r.dtype, (T.FloatType, T.DoubleType)):
            c = c & ~F.isnan(r.col) & (F.abs(r.col) != F.lit(float("inf")))
        conds.append(c)
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def _plain_line(spec: LineSpec) -> Column:
    """The line for a row already known to have a field (or with the marker)."""
    meas = E.escape_measurement(spec.measurement, spec.escape)
    fields = fields_text(spec)
    if spec.on_empty == "marker":
        fields = F.when(has_field(spec), fields).otherwise(F.lit(EMPTY_MARKER))
    return F.concat(meas, tags_text(spec), F.lit(" "), fields, F.lit(" "),
                    time_text(spec).cast("string"))


def row_filter(spec: LineSpec) -> Column | None:
    """Rows that give a line: a field is present (C6), the measurement is set, the
    time did not overflow.  Checked on raw columns, before the text is built."""
    conds = []
    if spec.on_empty == "drop":
        conds.append(has_field(spec))
    if not spec.measurement_literal:
        conds.append(spec.measurement.isNotNull())
    if spec.overflow == "null" and spec.time is not None:
        conds.append(time_text(spec).isNotNull())
    return reduce(lambda a, b: a & b, conds) if conds else None


def line_column(spec: LineSpec) -> Column:
    """The line, or null when the row gives none."""
    keep = row_filter(spec)
    line = _plain_line(spec)
    return line if keep is None else F.when(keep, line)


def encode_lines(df: DataFrame, measurement: ColumnLike, tags: Roles = None,
                 fields: Roles = None, time: ColumnLike | None = None, *,
                 keep: Sequence[str] = (), op_col: str | None = None,
                 time_col: str | None = None, **options) -> DataFrame:
    """Encode every row as one line; rows without a line are dropped.

    ``keep`` carries extra columns next to ``line`` (e.g. a key for packing).
    ``op_col`` names a changelog column; only ``+I``/``+U`` rows are encoded (C3).
    ``time_col`` adds the line's time value under that name (for packing).
    Options: precision, time_unit, escape, on_empty, decimal_as, non_finite,
    empty_tag, overflow (see ``plans.roles``).
    """
    if op_col is not None:
        from tsline.operators.changelog import changelog_filter
        df = changelog_filter(df, op_col)
    spec = resolve(df, measurement, tags, fields, time, **options)
    # filter on raw columns first, then build the text unconditionally: no CASE
    # around the big concat, and the time value is shared with ``time_col``
    keep_rows = row_filter(spec)
    src = df.where(keep_rows) if keep_rows is not None else df
    extra = [time_text(spec).alias(time_col)] if time_col else []
    return src.select(*[F.col(f"`{k}`") for k in keep], *extra, _plain_line(spec).alias("line"))

"""Column roles (C1, K3, C11): which columns are tags, fields and time.

Resolution is a driver-side pass over ``df.schema``; the result is a
``LineSpec`` of (name, Column, DataType) triples that the encoders turn into a
single projection.  Only referenced columns reach the scan (column pruning).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsline.functions.fmt import check_supported
from tsline.functions.timeunit import precision_factor

ColumnLike = Union[str, Column]
Roles = Union[None, str, Sequence[str], Mapping[str, ColumnLike]]

_OPTION_VALUES = {
    "time_unit": ("ns", "compat"),
    "escape": ("full", "compat"),
    "on_empty": ("drop", "marker"),
    "decimal_as": ("string", "float"),
    "non_finite": ("keep", "drop"),
    "empty_tag": ("keep", "drop"),
    "overflow": ("raise", "null"),
    # accepted for compatibility; null fields are always left out
    "ignore_null_values": (True, False, "true", "false"),
}


@dataclass(frozen=True)
class Role:
    name: str
    col: Column
    dtype: T.DataType


@dataclass(frozen=True)
class LineSpec:
    measurement: Column
    tags: tuple[Role, ...]
    fields: tuple[Role, ...]
    time: Role | None
    precision: str = "ms"
    time_unit: str = "ns"
    escape: str = "full"
    on_empty: str = "drop"
    decimal_as: str = "string"
    non_finite: str = "keep"
    empty_tag: str = "keep"
    overflow: str = "raise"
    measurement_literal: bool = True


def split_names(value: Roles) -> list[str] | None:
    """``"a, b ,c"`` or a sequence -> trimmed names, blanks dropped."""
    if value is None:
        return None
    if isinstance(value, str):
        parts = value.split(",")
    else:
        parts = list(value)
    return [p.strip() for p in parts if p and p.strip()]


def _typed(df: DataFrame, name: str, c: ColumnLike) -> Role:
    col = F.col(c) if isinstance(c, str) else c
    dtype = df.select(col.alias("_x")).schema["_x"].dataType   # analysis only, no job
    check_supported(name, dtype)
    return Role(name, col, dtype)


def _from_names(df: DataFrame, names: list[str]) -> list[Role]:
    present = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for n in names:
        if n in present:                   # unknown names are ignored (C1)
            check_supported(n, present[n])
            out.append(Role(n, F.col(f"`{n}`"), present[n]))
    return out


def resolve(df: DataFrame, measurement: ColumnLike, tags: Roles = None,
            fields: Roles = None, time: ColumnLike | None = None,
            **options) -> LineSpec:
    """Build the spec.  ``tags``/``fields`` are names (list or comma string) or a
    mapping name -> column/expression (builder form).  Default fields are every
    column that is neither a tag nor the time column, in schema order."""
    for key, value in options.items():
        allowed = _OPTION_VALUES.get(key)
        if key == "precision":
            precision_factor(value)
        elif allowed is None:
            raise TypeError(f"unknown option {key!r}")
        elif value not in allowed:
            raise ValueError(f"option {key}={value!r}; expected one of {allowed}")

    if isinstance(measurement, str):
        if not measurement.strip():
            raise ValueError("measurement must not be blank")
        meas_col = F.lit(measurement)
    else:
        meas_col = measurement

    time_role = None
    time_name = None
    if isinstance(time, str):
        if time in df.columns:
            time_name = time
            time_role = Role(time, F.col(f"`{time}`"), df.schema[time].dataType)
    elif time is not None:
        time_role = _typed(df, "time", time)

    if isinstance(tags, Mapping):
        tag_roles = [_typed(df, k, v) for k, v in tags.items()]
    else:
        tag_roles = _from_names(df, split_names(tags) or [])
    tag_names = {r.name for r in tag_roles}

    if isinstance(fields, Mapping):
        field_roles = [_typed(df, k, v) for k, v in fields.items()]
        if not field_roles:
            raise ValueError("at least one field is required")
    elif fields is None:
        skip = tag_names | ({time_name} if time_name else set())
        field_roles = _from_names(df, [c for c in df.columns if c not in skip])
    else:
        field_roles = _from_names(df, split_names(fields) or [])

    names = [r.name for r in tag_roles] + [r.name for r in field_roles]
    dup = {n for n in names if names.count(n) > 1}
    if dup:
        raise ValueError(f"column(s) {sorted(dup)} given more than one role")
    if not field_roles and options.get("on_empty", "drop") == "drop":
        raise ValueError("no field columns: every row would be dropped")

    tag_roles.sort(key=lambda r: r.name)          # deterministic tag order (Q14)
    options.pop("ignore_null_values", None)
    return LineSpec(measurement=meas_col, tags=tuple(tag_roles), fields=tuple(field_roles),
                    time=time_role, measurement_literal=isinstance(measurement, str), **options)

"""The point path.

A POINT is ``struct<measurement, tags map<string,string>,
fields map<string, struct<type,text>>, time_ns>`` holding unescaped text;
the type letter (i, f, b, s) says how the text is written on a line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsline.functions import escape as E
from tsline.functions.fmt import BOOL, field_raw, field_type, render_field, tag_raw
from tsline.operators.encode import EMPTY_MARKER, encode_lines, row_filter, time_text
from tsline.functions.timeunit import now_ns
from tsline.plans.roles import ColumnLike, LineSpec, Roles, resolve

TAGS_TYPE = "map<string,string>"
FIELDS_TYPE = "map<string,struct<type:string,text:string>>"
POINT_DDL = f"measurement string, tags {TAGS_TYPE}, fields {FIELDS_TYPE}, time_ns bigint"
PATHS = ("line", "point")


def _map(pairs: list[tuple[str, Column]], ddl: str) -> Column:
    if not pairs:
        return F.create_map().cast(ddl)
    args = []
    for k, v in pairs:
        args += [F.lit(k), v]
    return F.create_map(*args)


def point_column(spec: LineSpec, filtered: bool = False) -> Column:
    """POINT struct, or null when no field is set and ``on_empty="drop"``.

    ``filtered=True``: the caller already kept only rows with a field (see
    ``encode.row_filter``), so no CASE wraps the struct.
    """
    tags = F.map_filter(
        _map([(r.name, tag_raw(r.col, r.dtype, spec.empty_tag)) for r in spec.tags], TAGS_TYPE),
        lambda k, v: v.isNotNull())
    fpairs = []
    for r in spec.fields:
        raw = field_raw(r.col, r.dtype, spec.decimal_as, spec.non_finite)
        fpairs.append((r.name, F.struct(F.lit(field_type(r.dtype, spec.decimal_as)).alias("type"),
                                        raw.alias("text"))))
    fields = F.map_filter(_map(fpairs, FIELDS_TYPE), lambda k, v: v["text"].isNotNull())
    empty = F.size(fields) == 0
    if spec.on_empty == "marker":
        marker = F.create_map(F.lit(EMPTY_MARKER.split("=")[0]),
                              F.struct(F.lit(BOOL).alias("type"), F.lit("true").alias("text")))
        fields = F.when(empty, marker).otherwise(fields)
    point = F.struct(spec.measurement.cast("string").alias("measurement"), tags.alias("tags"),
                     fields.alias("fields"), time_text(spec).alias("time_ns"))
    if spec.on_empty == "drop" and not filtered:
        point = F.when(~empty, point)
    return point


def to_points(df: DataFrame, measurement: ColumnLike, tags: Roles = None, fields: Roles = None,
              time: ColumnLike | None = None, *, op_col: str | None = None,
              **options) -> DataFrame:
    """Rows -> POINT columns (flattened: measurement, tags, fields, time_ns)."""
    if op_col is not None:
        from tsline.operators.changelog import changelog_filter
        df = changelog_filter(df, op_col)
    spec = resolve(df, measurement, tags, fields, time, **options)
    keep_rows = row_filter(spec)
    src = df.where(keep_rows) if keep_rows is not None else df
    return src.select(point_column(spec, filtered=True).alias("p")).select("p.*")


def tags_line_text(tags: Column, mode: str = "full") -> Column:
    """Tag map -> ``,k=v`` run sorted by key."""
    entries = F.array_sort(F.map_entries(tags))
    return F.array_join(F.transform(entries, lambda e: F.concat(
        F.lit(","), E.escape_key(e["key"], mode), F.lit("="), E.escape_tag(e["value"], mode))), "")


def fields_line_text(fields: Column, mode: str = "full") -> Column:
    """Field map -> ``k=v,...`` in map order."""
    return F.array_join(F.transform(F.map_entries(fields), lambda e: F.concat(
        E.escape_key(e["key"], mode), F.lit("="),
        render_field(e["value"]["text"], e["value"]["type"], mode))), ",")


def point_line(measurement: Column, tags: Column, fields: Column, time_ns: Column,
               mode: str = "full", checked: bool = False) -> Column:
    """One POINT -> its line (L4); null when the point has no field.

    ``checked=True``: the caller kept only points with a field, so no CASE
    wraps the text.
    """
    ftext = fields_line_text(fields, mode)
    line = F.concat(E.escape_measurement(measurement, mode), tags_line_text(tags, mode),
                    F.lit(" "), ftext, F.lit(" "), F.coalesce(time_ns, now_ns()).cast("string"))
    return line if checked else F.when(F.size(fields) > 0, line)


def points_to_lines(points: DataFrame, mode: str = "full") -> DataFrame:
    """POINT rows -> ``line`` (the legacy path: build the point, then its text)."""
    line = point_line(F.col("measurement"), F.col("tags"), F.col("fields"), F.col("time_ns"), mode,
                      checked=True)
    return (points.where((F.size("fields") > 0) & F.col("measurement").isNotNull())
                  .select(line.alias("line")))


def encode(df: DataFrame, measurement: ColumnLike, tags: Roles = None, fields: Roles = None,
           time: ColumnLike | None = None, *, path: str = "line", **kw) -> DataFrame:
    """Choose the encoder (B17): ``"line"`` writes text directly, ``"point"``
    builds POINT maps first; both give the same lines."""
    if path in (None, "line", "line-protocol"):
        return encode_lines(df, measurement, tags, fields, time, **kw)
    if path == "point":
        if kw.get("keep") or kw.get("time_col"):
            raise ValueError("keep/time_col are only supported on the line path")
        mode = kw.get("escape", "full")
        return points_to_lines(to_points(df, measurement, tags, fields, time, **kw), mode)
    raise ValueError(f"unknown encoder path {path!r}; expected one of {PATHS}")

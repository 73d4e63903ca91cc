"""Line and payload text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's String.trim() removes every char <= U+0020 at both ends.
TRIM_CHARS = "".join(chr(i) for i in range(0, 33))


def java_trim(c: Column) -> Column:
    return F.trim(c, F.lit(TRIM_CHARS))


def is_blank(c: Column) -> Column:
    return c.isNull() | (java_trim(c) == "")


def line_bytes(c: Column) -> Column:
    """UTF-8 byte length of a line (I16)."""
    return F.octet_length(c)


def join_lines(lines: Column) -> Column:
    """Array of lines -> payload body: drop null/blank, trim each, join with newline.

    An empty result is null: no payload is sent for it.
    """
    kept = F.filter(F.transform(lines, java_trim), lambda x: x.isNotNull() & (x != ""))
    return F.when(F.size(kept) > 0, F.array_join(kept, "\n"))


def clean_payload(body: Column) -> Column:
    """Multi-line body -> split, trim, drop blank lines, re-join."""
    return join_lines(F.split(body, "\n"))

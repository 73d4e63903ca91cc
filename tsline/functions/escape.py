"""Escaping and unescaping of line text, as Spark column expressions.

Every function takes and returns a ``Column`` (so it also works on lambda
variables inside ``transform``) and runs as a built-in JVM expression.

Fixed values (the text format; a reader must undo exactly these):

- measurement name, escape="full": backslash, newline, carriage return, comma, space
- tag key, tag value, field key, escape="full": the same five plus ``=``
- string field value, escape="full": backslash, newline, carriage return, double quote
- tag value, escape="compat": space, comma, ``=`` (measurement and keys untouched)
- string field value, escape="compat": double quote only

Newline and carriage return are written as the two characters ``\\n`` and
``\\r`` so one line never spans two; every other escaped character gets a
backslash in front.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BS = "\\"
NL = "\n"
CR = "\r"


# The same rules as (character, replacement) pairs, in the order they apply.
CONTROL_PAIRS = [(BS, BS + BS), (NL, BS + "n"), (CR, BS + "r")]
MEASUREMENT_PAIRS = CONTROL_PAIRS + [(",", BS + ","), (" ", BS + " ")]
TAG_PAIRS = CONTROL_PAIRS + [(" ", BS + " "), (",", BS + ","), ("=", BS + "=")]
STRING_PAIRS = CONTROL_PAIRS + [('"', BS + '"')]


def escape_text(text: str, pairs=TAG_PAIRS) -> str:
    """Plain-Python escaping for names known on the driver (keys, measurements)."""
    for a, b in pairs:
        text = text.replace(a, b)
    return text


def _apply(c: Column, pairs) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def escape_measurement(c: Column, mode: str = "full") -> Column:
    return c if mode == "compat" else _apply(c, MEASUREMENT_PAIRS)


def escape_key(c: Column, mode: str = "full") -> Column:
    """Tag key or field key."""
    return c if mode == "compat" else _apply(c, TAG_PAIRS)


def escape_tag(c: Column, mode: str = "full") -> Column:
    """Tag value: space, comma and '=' get a backslash."""
    return _apply(c, TAG_PAIRS if mode == "full" else TAG_PAIRS[len(CONTROL_PAIRS):])


def escape_string(c: Column, mode: str = "full") -> Column:
    """Inside of a quoted string field (without the quotes)."""
    return _apply(c, STRING_PAIRS if mode == "full" else STRING_PAIRS[len(CONTROL_PAIRS):])


def quote_string(c: Column, mode: str = "full") -> Column:
    """String field value: quoted, inner quotes escaped."""
    return F.concat(F.lit('"'), escape_string(c, mode), F.lit('"'))


def _unescape_piece(p: Column) -> Column:
    # p holds no escaped backslash, so every remaining backslash starts one pair
    p = _apply(p, [(BS + "n", NL), (BS + "r", CR)])
    return F.regexp_replace(p, r'\\([ ,="])', "$1")


def unescape(c: Column) -> Column:
    """Inverse of every escape above.

    Splitting on escaped backslashes first makes the result exact for any
    input: each piece is unescaped alone and the pieces are joined with one
    backslash.  Values without a backslash take the cheap branch.
    """
    pieces = F.split(c, r"\\\\")
    slow = F.array_join(F.transform(pieces, _unescape_piece), BS)
    return F.when(F.instr(c, BS) == 0, c).otherwise(slow)


def unquote_string(c: Column) -> Column:
    """Quoted string field text -> original string."""
    return unescape(c.substr(F.lit(2), F.length(c) - 2))

"""DuckDB SQL fragments for the oracles: the same text rules written in SQL.

DuckDB string literals keep backslashes as they are, so ``'\\'`` below is a
one-character string in SQL.
"""

from __future__ import annotations

BS = "\\"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _rep(x: str, a: str, b: str) -> str:
    return f"replace({x}, {a}, {b})"


def esc_controls(x: str) -> str:
    x = _rep(x, lit(BS), lit(BS + BS))
    x = _rep(x, "chr(10)", lit(BS + "n"))
    return _rep(x, "chr(13)", lit(BS + "r"))


def esc_tag(x: str) -> str:
    x = esc_controls(x)
    for ch in (" ", ",", "="):
        x = _rep(x, lit(ch), lit(BS + ch))
    return x


def esc_meas(x: str) -> str:
    x = esc_controls(x)
    for ch in (",", " "):
        x = _rep(x, lit(ch), lit(BS + ch))
    return x


def quote(x: str) -> str:
    return f"""('"' || {_rep(esc_controls(x), lit('"'), lit(BS + '"'))} || '"')"""


def vc(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def ns(ts: str) -> str:
    return f"(epoch_us({ts}) * 1000)"


def fint(name: str, x: str) -> str:
    return f"'{name}=' || {vc(x)} || 'i'"


def fnum(name: str, x: str) -> str:
    return f"'{name}=' || {vc(x)}"


def fstr(name: str, x: str) -> str:
    return f"'{name}=' || {quote(x)}"


def tag(name: str, x: str, escape: bool = True) -> str:
    return f"',{name}=' || {esc_tag(x) if escape else vc(x)}"


def line(meas: str, tags: list[str], fields: list[str], time: str) -> str:
    """measurement SQL, tag fragments (',k=v', sorted by key), field fragments, time SQL."""
    tag_sql = f"concat_ws('', {', '.join(tags)})" if tags else "''"
    return (f"({meas} || {tag_sql} || ' ' || concat_ws(',', {', '.join(fields)})"
            f" || ' ' || {vc(time)})")


# Java's String.trim(): every char <= U+0020 at both ends.
JAVA_TRIM_CHARS = " || ".join(f"chr({i})" for i in range(1, 33))


def java_trim(x: str) -> str:
    return f"trim({x}, {JAVA_TRIM_CHARS})"


# The events table as lines: measurement 'events', tags event_type and user_id,
# fields event_id, value, props in schema order, time ts in ns.
EVENTS_LINE = line("'events'", [tag("event_type", "event_type"), tag("user_id", "user_id", False)],
                   [fint("event_id", "event_id"), fnum("value", "value"), fstr("props", "props")],
                   ns("ts"))

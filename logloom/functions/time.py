"""Timestamps, interval buckets and date-pattern routing."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: the date format of the common log format.
COMMON_LOG_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"

# Where a strftime directive sits in 'yyyy-MM-dd HH:mm:ss'.
_DIRECTIVES = {
    "Y": (1, 4),
    "y": (3, 2),
    "m": (6, 2),
    "d": (9, 2),
    "H": (12, 2),
    "M": (15, 2),
    "S": (18, 2),
}


def parse_timestamp(raw: str, formats: Sequence[str] = ()) -> tuple[str, str]:
    """The instant and the wall clock of a timestamp text.

    ISO-8601 is always understood, ``formats`` are tried after it. The wall
    clock is the record's own: ``01:30+03:00`` stays half past one. Text that
    names no date is NULL in both.
    """
    wall = f"try_cast({raw} AS TIMESTAMP_NTZ)"
    instants = [f"CASE WHEN {wall} IS NOT NULL THEN try_cast({raw} AS TIMESTAMP) END"]
    walls = [wall]
    for fmt in formats:
        instant = f"try_to_timestamp({raw}, '{fmt}')"
        instants.append(instant)
        walls.append(f"CASE WHEN {instant} IS NOT NULL THEN to_timestamp_ntz({raw}, '{fmt}') END")
    return f"coalesce({', '.join(instants)})", f"coalesce({', '.join(walls)})"


def as_instant(value) -> Column:
    """A bound given as text, ``datetime`` or column, as a timestamp column.

    A text that is no time is an error: as a NULL it would reject every record.
    """
    if isinstance(value, Column):
        return value
    text = value if isinstance(value, str) else value.isoformat()
    bound = F.lit(text).cast("timestamp")
    readable = SparkSession.active().sql("SELECT try_cast(:text AS timestamp) IS NOT NULL", args={"text": text})
    if not readable.first()[0]:
        raise ValueError(f"not a time: {text!r}")
    return bound


def bucket_start(ts: str, interval: int) -> str:
    """Epoch second at which the interval that holds ``ts`` begins."""
    return f"unix_seconds({ts}) - pmod(unix_seconds({ts}), {int(interval)}L)"


def strftime(wall: str, pattern: str) -> Column:
    """Format a wall clock by a pattern of %Y %y %m %d %H %M %S %j and %%.

    Built from the text of the wall clock, so the session time zone (and its
    daylight-saving gaps) plays no part.
    """
    parts = []
    for literal, directive in re.findall(r"([^%]+)|%(.?)", pattern, re.DOTALL):
        if literal:
            parts.append(F.lit(literal))
        elif directive == "%":
            parts.append(F.lit("%"))
        elif directive == "j":
            parts.append(F.expr(f"lpad(CAST(dayofyear({wall}) AS STRING), 3, '0')"))
        elif directive in _DIRECTIVES:
            start, length = _DIRECTIVES[directive]
            parts.append(F.expr(f"substr(CAST({wall} AS STRING), {start}, {length})"))
        else:
            raise ValueError(f"unsupported directive %{directive} in {pattern!r}")
    return F.concat(*parts) if parts else F.lit("")


def iso_text(wall: str, instant: str) -> str:
    """ISO-8601 text of a wall clock with the offset that leads to the instant."""
    text = f"CAST({wall} AS STRING)"
    padded = f"CASE WHEN contains({text}, '.') THEN rpad({text}, 26, '0') ELSE {text} END"
    # The wall clock as if it were UTC; no session time zone is involved.
    wall_second = (
        f"(CAST(unix_date(CAST({wall} AS DATE)) AS BIGINT) * 86400 "
        f"+ hour({wall}) * 3600 + minute({wall}) * 60 + second({wall}))"
    )
    offset = f"({wall_second} - unix_seconds({instant}))"
    hours = f"lpad(CAST(abs({offset}) div 3600 AS STRING), 2, '0')"
    minutes = f"lpad(CAST(abs({offset}) div 60 % 60 AS STRING), 2, '0')"
    return (
        f"concat(replace({padded}, ' ', 'T'), CASE WHEN {offset} < 0 THEN '-' ELSE '+' END, "
        f"{hours}, ':', {minutes})"
    )

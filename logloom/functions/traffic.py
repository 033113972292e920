"""Expressions of the traffic statistics."""

from __future__ import annotations

# Labels and patterns of the statistics dimensions.
UUID_PATTERN = (
    "[A-Fa-f0-9]{8}-[A-Fa-f0-9]{4}-[A-Fa-f0-9]{4}-[A-Fa-f0-9]{4}-[A-Fa-f0-9]{12}"
)
UUID_LABEL = "<uuid>"
ID_PATTERN = "^[0-9]+$"
ID_LABEL = "<id>"
NO_PATH_LABEL = "#"
NO_CACHE_LABEL = "NONE"
LOWEST_BIN = -31


def path_label(part: str) -> str:
    """Path component with UUIDs and pure numbers masked, ``#`` when missing."""
    masked = f"regexp_replace({part}, '{UUID_PATTERN}', '{UUID_LABEL}')"
    return (
        f"coalesce(regexp_replace({masked}, r'{ID_PATTERN}', '{ID_LABEL}'), '{NO_PATH_LABEL}')"
    )


def cache_label(state: str) -> str:
    return f"coalesce({state}, '{NO_CACHE_LABEL}')"


def last_value(values: str) -> str:
    """Last element of a list, NULL for a missing one."""
    return f"try_element_at({values}, -1)"


def number(value: str) -> str:
    """Not-a-number counts as missing."""
    return f"CASE WHEN NOT isnan({value}) THEN {value} END"


def latency_bin(seconds: str) -> str:
    """Lower edge, in whole milliseconds, of the logarithmic bin of a duration.

    Ten bins per decade, truncated toward zero: the bin around one second is
    twice as wide, and every duration without a logarithm is in the lowest bin.
    """
    step = (
        f"CASE WHEN {seconds} > 0 AND {seconds} < DOUBLE('inf') "
        f"THEN CAST(log10({seconds}) * 10 AS INT) ELSE {LOWEST_BIN} END"
    )
    return f"CAST(floor(pow(10.0D, ({step}) / 10) * 1000) AS STRING)"

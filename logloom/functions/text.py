"""String-to-value expressions shared by the record projection.

All functions in this folder take Spark SQL expressions as text and return one:
a whole projection then reaches the JVM in a single call, where the same tree
built column by column costs thousands of calls per plan. Use them with
``F.expr`` or ``selectExpr``.
"""

from __future__ import annotations

from collections.abc import Callable

# Every character that counts as white space in a text value.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_RUN = r"r'(?U)[\s\x1c-\x1f]+'"

# Spellings of "no value" in an access log.
PLACEHOLDERS = "('-', '')"

# The spellings of infinity, lower case.
_INFINITY = "('inf', '+inf', '-inf', 'infinity', '+infinity', '-infinity')"


def let(name: str, value: str, body: str) -> str:
    """Evaluate ``value`` once and use it as ``name``, any number of times.

    Inside a lambda a referenced expression is evaluated per element, so a
    costly one is bound to a lambda variable first.
    """
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def strip(value: str) -> str:
    """Trim every kind of white space (``trim`` alone takes spaces only)."""
    return f"btrim({value}, '{WHITESPACE}')"


def present(value: str) -> str:
    """Placeholders become NULL."""
    return f"CASE WHEN {value} NOT IN {PLACEHOLDERS} THEN {value} END"


def parse_long(value: str) -> str:
    """Whole number or NULL; ``12.5`` is NULL, under any ANSI setting.

    The cast trims ASCII white space itself, so the full trim is only tried on
    what it could not read.
    """
    return f"coalesce(try_cast({value} AS BIGINT), try_cast({strip(value)} AS BIGINT))"


def parse_double(value: str) -> str:
    """Floating-point number or NULL.

    The cast alone would also take Java literals such as ``1d`` and ``0x1p3``.
    """
    return (
        f"CASE WHEN NOT ({value} RLIKE '[dDfFxX]' AND lower({strip(value)}) NOT IN {_INFINITY}) "
        f"THEN coalesce(try_cast({value} AS DOUBLE), try_cast({strip(value)} AS DOUBLE)) END"
    )


def split_values(value: str, cast: Callable[[str], str] | None = None) -> str:
    """``a, b : c`` to an array; placeholders are left out, none left is NULL.

    The comma separates only when a space follows, so ``a,b`` is one item.
    ``cast`` is applied to every item.
    """
    parts = f"split(replace({value}, ', ', ' : '), ' : ')"
    kept = f"filter(transform({parts}, _p -> {strip('_p')}), _p -> _p NOT IN {PLACEHOLDERS})"
    items = f"transform(_items, _i -> {cast('_i')})" if cast else "_items"
    several = let("_items", kept, f"CASE WHEN size(_items) > 0 THEN {items} END")
    # Most lists hold one plain item, with nothing to split or trim.
    single = f"array({cast(value) if cast else value})"
    return (
        f"CASE WHEN {value} RLIKE '^[!-~]+$' THEN "
        f"CASE WHEN {value} NOT IN {PLACEHOLDERS} THEN {single} END ELSE {several} END"
    )

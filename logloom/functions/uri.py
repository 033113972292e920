"""Request line, URI, path and query-string expressions."""

from __future__ import annotations

from logloom.functions.text import WHITESPACE_RUN, let, parse_double, strip


def request_tokens(request: str) -> str:
    """White-space separated tokens of a request line."""
    return f"split({strip(request)}, {WHITESPACE_RUN})"


def uri_query(uri: str) -> str:
    """Text after the last ``?``; NULL when there is none."""
    return f"CASE WHEN contains({uri}, '?') THEN substring_index({uri}, '?', -1) END"


def uri_path(uri: str) -> str:
    """Text before the last ``?``; the whole URI when there is none."""
    tail = f"char_length(substring_index({uri}, '?', -1))"
    return (
        f"CASE WHEN contains({uri}, '?') "
        f"THEN left({uri}, char_length({uri}) - {tail} - 1) ELSE {uri} END"
    )


def path_part(path: str, n: int) -> str:
    """The n-th ``/``-separated component, NULL when absent or empty."""
    return f"nullif(split_part({path}, '/', {n + 1}), '')"


def path_segments(path: str) -> str:
    """Non-empty components with their raw split position; none left is NULL."""
    numbered = f"transform(split({path}, '/'), (_s, _n) -> struct(_n AS n, _s AS seg))"
    kept = f"filter({numbered}, _e -> _e.seg <> '')"
    return let("_kept", kept, "CASE WHEN size(_kept) > 0 THEN _kept END")


def form_decode(text: str) -> str:
    """``+`` and percent decoding that leaves stray ``%`` signs alone."""
    escaped = f"regexp_replace({text}, '%(?![0-9A-Fa-f]{{2}})', '%25')"
    return (
        f"CASE WHEN contains({text}, '%') OR contains({text}, '+') "
        f"THEN url_decode({escaped}) ELSE {text} END"
    )


def query_map(query: str) -> str:
    """Query string to ``map<string, array<string>>``.

    Names without a value are left out and repeated names keep their order.
    Dots in names become underscores; when names meet that way they replace
    each other instead of merging: the last dotted one counts, and a plain one
    only when no dotted name maps to it. The work grows like sorting the pairs.
    """
    given = f"filter(split({query}, '&'), _a -> _a RLIKE '(?s)=.')"
    name = form_decode("substring_index(_a, '=', 1)")
    value = form_decode("substr(_a, instr(_a, '=') + 1)")
    # Sorted by name and place, the values of a name stand together, in their order.
    pairs = f"sort_array(transform({given}, (_a, _i) -> struct({name} AS name, _i AS place, {value} AS value)))"
    starts = "filter(sequence(0, size(_p) - 1), _i -> _i = 0 OR get(_p, _i).name <> get(_p, _i - 1).name)"
    run = """transform(_s, (_b, _k) -> struct(replace(get(_p, _b).name, '.', '_') AS name,
        contains(get(_p, _b).name, '.') AS dotted, get(_p, _b).place AS place,
        transform(slice(_p, _b + 1, coalesce(get(_s, _k + 1), size(_p)) - _b), _v -> _v.value) AS given))"""
    # Of the names that became equal the last one counts, dotted ones coming last.
    last = """transform(filter(_r, (_x, _i) -> _i = size(_r) - 1 OR get(_r, _i + 1).name <> _x.name),
        _x -> struct(_x.place, _x.name, _x.given))"""
    body = let("_w", f"sort_array({last})", "map_from_arrays(_w.name, _w.given)")
    body = let("_r", f"sort_array({run})", body)
    body = f"CASE WHEN size(_p) = 0 THEN CAST(map() AS map<string,array<string>>) ELSE {let('_s', starts, body)} END"
    return f"CASE WHEN {query} IS NOT NULL THEN {let('_p', pairs, body)} END"


def query_point(query: str) -> str:
    """``lat`` with ``lng`` (or, only if that is missing, ``lon``) as a point."""

    def first(name: str) -> str:
        return parse_double(f"get(try_element_at({query}, '{name}'), 0)")

    lon = (
        f"CASE WHEN map_contains_key({query}, 'lng') THEN {first('lng')} "
        f"ELSE {first('lon')} END"
    )
    return (
        f"CASE WHEN map_contains_key({query}, 'lat') THEN "
        + let(
            "_point",
            f"struct({first('lat')} AS lat, {lon} AS lon)",
            "CASE WHEN _point.lat IS NOT NULL AND _point.lon IS NOT NULL THEN _point END",
        )
        + " END"
    )

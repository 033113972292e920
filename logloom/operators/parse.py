"""Record projection: a line of text becomes a typed row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.text import (
    PLACEHOLDERS,
    let,
    parse_double,
    parse_long,
    present,
    split_values,
)
from logloom.functions.time import COMMON_LOG_FORMAT, parse_timestamp
from logloom.functions.uri import (
    path_part,
    path_segments,
    query_map,
    query_point,
    request_tokens,
    uri_path,
    uri_query,
)
from logloom.schema import (
    DECODED_FIELDS,
    DOUBLE_FIELDS,
    DOUBLE_LIST_FIELDS,
    ENRICHED_FIELDS,
    LONG_FIELDS,
    LONG_LIST_FIELDS,
    RECORD_SCHEMA,
    TEXT_LIST_FIELDS,
)

TimestampParser = Callable[[Column], tuple[Column, Column]]

_LINE = "array<struct<" + ",".join(f"`{f}`:string" for f in DECODED_FIELDS) + ">>"


def decode_lines(
    lines: DataFrame,
    ts_formats: Sequence[str] = (COMMON_LOG_FORMAT,),
    ts_parser: TimestampParser | None = None,
) -> DataFrame:
    """The known fields of the JSON object in ``value``: text, and casts of it.

    Every field is first read as text: logs quote numbers, and a typed decoder
    would turn those into NULL. The line is read as a one-element array, so
    that text after the object makes it malformed (``_decoded`` is false).
    Placeholders become NULL, except in the timestamp, which must hold a date.
    ``_cast_<field>`` is the typed value of a field that can be unreadable.

    The columns leave through ``inline``. Filters on them are not pushed below
    it, so each line is decoded and cast once however many columns are tested.
    """
    carried = [f"`{c}`" for c in lines.columns]
    parsed = lines.selectExpr(
        *carried, f"from_json(concat('[', value, ']'), '{_LINE}') AS _objects"
    )
    checked = parsed.selectExpr(
        *carried,
        "coalesce(size(_objects) = 1 AND get(_objects, 0) IS NOT NULL"
        " AND (endswith(value, '}') OR endswith(btrim(value, ' \\t\\n\\r'), '}')), false) AS _decoded",
        "_objects",
    )
    decoded = checked.selectExpr(
        *carried, "_decoded", "inline_outer(CASE WHEN _decoded THEN _objects END)"
    )
    cleaned = [f"{present(f'`{f}`')} AS `{f}`" for f in DECODED_FIELDS if f != "timestamp"]
    texts = decoded.selectExpr(*carried, "_decoded", "timestamp", *cleaned)

    if ts_parser is None:
        instant, wall = map(F.expr, parse_timestamp("timestamp", ts_formats))
    else:
        instant, wall = ts_parser(F.col("timestamp"))
    casts = {"status": "try_cast(status AS INT)"}
    casts |= {f: parse_long(f) for f in LONG_FIELDS}
    casts |= {f: parse_double(f) for f in DOUBLE_FIELDS}
    casts |= {f: split_values(f, parse_double) for f in DOUBLE_LIST_FIELDS}
    casts |= {f: split_values(f, parse_long) for f in LONG_LIST_FIELDS}
    members = ["_decoded", "_instant", "_wall"]
    members += [f"`{f}`" for f in DECODED_FIELDS]
    members += [f"{c} AS _cast_{f}" for f, c in casts.items()]
    return (
        texts.select("*", instant.alias("_instant"), wall.alias("_wall"))
        .selectExpr(*carried, f"struct({', '.join(members)}) AS _columns")
        .selectExpr(*carried, "inline(array(_columns))")
    )


def _replace(df: DataFrame, columns: dict[str, str], drop: Sequence[str] = ()) -> DataFrame:
    """Set columns to SQL expressions in one projection."""
    kept = [f"`{c}`" for c in df.columns if c not in columns and c not in drop]
    return df.selectExpr(*kept, *[f"{e} AS `{c}`" for c, e in columns.items()])


def split_request(cleaned: DataFrame) -> DataFrame:
    """Take URI and protocol out of a three-token request line.

    The method is not kept, and neither is the request line once it is split.
    A URI field of its own wins: then the request line stays as it is.
    """
    tokens = _replace(
        cleaned,
        {"_tokens": f"CASE WHEN request_uri IS NULL THEN {request_tokens('request')} END"},
    )
    split = "coalesce(size(_tokens) = 3, false)"
    return _replace(
        tokens,
        {
            "request_uri": f"CASE WHEN {split} THEN get(_tokens, 1) ELSE request_uri END",
            "server_protocol": f"CASE WHEN {split} THEN get(_tokens, 2) ELSE server_protocol END",
            "request": f"CASE WHEN NOT {split} THEN request END",
        },
        drop=["_tokens"],
    )


def split_uri(requests: DataFrame) -> DataFrame:
    """Path, path components, query string, query map and query point.

    Without a URI the fields of the same name in the line, if any, stay.
    """
    parts = _replace(
        requests, {"_query": uri_query("request_uri"), "_path": uri_path("request_uri")}
    )
    with_map = _replace(parts, {"query": query_map("_query")})
    has_uri = "request_uri IS NOT NULL"
    return _replace(
        with_map,
        {
            "request_path": f"CASE WHEN {has_uri} THEN _path ELSE request_path END",
            "request_qs": f"CASE WHEN {has_uri} THEN _query ELSE request_qs END",
            "request_path_1": f"coalesce({path_part('_path', 1)}, request_path_1)",
            "request_path_2": f"coalesce({path_part('_path', 2)}, request_path_2)",
            "path_segments": path_segments("_path"),
            "query_geo": query_point("query"),
        },
        drop=["_query", "_path"],
    )


def add_unknown_fields(records: DataFrame) -> DataFrame:
    """Fields the decoder does not know, each with its own JSON type.

    Read from the line apart from the known fields, so a plan that never reads
    ``extra`` never pays for it. The last of repeated keys counts.
    """
    known = ", ".join(f"'{f}'" for f in DECODED_FIELDS + ("@timestamp",))
    unknown = (
        "map_filter(from_json(value, 'map<string,variant>'), (_k, _v) -> "
        f"_k NOT IN ({known}) AND coalesce(CAST(_v AS STRING), 'null') NOT IN {PLACEHOLDERS})"
    )
    last_only = (
        "map_from_entries(filter(map_entries(_unknown), (_e, _i) -> NOT array_contains("
        "slice(map_keys(_unknown), _i + 2, size(_unknown)), _e.key)))"
    )
    return _replace(
        _replace(records, {"_unknown": unknown}),
        {
            "extra": "CASE WHEN size(_unknown) = 0 THEN NULL "
            "WHEN size(array_distinct(map_keys(_unknown))) = size(_unknown) THEN _unknown "
            f"ELSE {last_only} END"
        },
        drop=["_unknown"],
    )


def parse_access_log(
    lines: DataFrame,
    hostname: str | Column | None = None,
    ts_formats: Sequence[str] = (COMMON_LOG_FORMAT,),
    ts_parser: TimestampParser | None = None,
    on_error: str = "quarantine",
) -> DataFrame:
    """Typed records from a DataFrame with a ``value`` column of JSON lines.

    Other columns of ``lines`` are carried along. ``_errors`` names the fields
    that could not be read (NULL for a good record) and ``_line`` holds the
    text; ``accepted`` and ``rejected`` tell the two apart. With
    ``on_error="fail"`` a bad record ends the job instead.

    An absent field is NULL. Known limits of the native casts: digit groups
    such as ``1_0`` and integers beyond 64 bits are errors, and so is a JSON
    number with a fraction in an integer field.
    """
    if on_error not in ("quarantine", "fail"):
        raise ValueError(f"on_error must be 'quarantine' or 'fail', not {on_error!r}")
    carried = [c for c in lines.columns if c != "value"]
    decoded = decode_lines(lines, ts_formats, ts_parser)
    problems = {
        "json": "NOT _decoded",
        "timestamp": "_decoded AND _instant IS NULL",
    }
    problems |= {
        f: f"{f} IS NOT NULL AND _cast_{f} IS NULL"
        for f in ("status",) + LONG_FIELDS + DOUBLE_FIELDS
    }
    problems |= {
        f: f"coalesce(exists(_cast_{f}, _x -> _x IS NULL), false)"
        for f in DOUBLE_LIST_FIELDS + LONG_LIST_FIELDS
    }
    good = " AND ".join(f"NOT ({problem})" for problem in problems.values())
    errors = ", ".join(f"CASE WHEN {problem} THEN '{f}' END" for f, problem in problems.items())

    derived = {
        "@timestamp": "_instant",
        "ts_local": "_wall",
    }
    derived |= {f: split_values(f) for f in TEXT_LIST_FIELDS}
    derived |= {
        c.removeprefix("_cast_"): c for c in decoded.columns if c.startswith("_cast_")
    }
    produced = [c for c in RECORD_SCHEMA.fieldNames() if c not in ENRICHED_FIELDS]
    columns = [F.expr(f"{derived.get(c, f'`{c}`')} AS `{c}`") for c in produced]
    if hostname is not None:
        value = hostname if isinstance(hostname, Column) else F.lit(hostname)
        columns[produced.index("@hostname")] = value.alias("@hostname")
    result = split_uri(split_request(add_unknown_fields(decoded))).select(
        *carried,
        *columns,
        F.expr("value AS _line"),
        F.expr(f"{good} AS _good"),
        F.expr(f"CASE WHEN NOT ({good}) THEN array_compact(array({errors})) END AS _errors"),
    )
    if on_error == "fail":
        message = F.concat(
            F.lit("bad record ("), F.array_join("_errors", ", "), F.lit("): "), F.col("_line")
        )
        result = result.where(
            F.col("_good") | F.raise_error(message).cast("boolean")
        )
    return result


def accepted(records: DataFrame) -> DataFrame:
    """Records that were read completely."""
    return records.where("_good").drop("_good", "_errors", "_line")


def rejected(records: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """Text and unreadable fields of every bad record, as dead letters.

    A record that lacks one of the ``required`` fields is bad, too.
    """
    carried = [
        c
        for c in records.columns
        if c not in RECORD_SCHEMA.fieldNames() and c not in ("_line", "_good", "_errors")
    ]
    missing = F.array_compact(
        F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in required])
    ).cast("array<string>")
    bad = reduce(or_, [F.col(f).isNull() for f in required], ~F.col("_good"))
    return records.where(bad).select(
        *carried,
        F.col("_line").alias("value"),
        F.when(F.col("_good"), missing).otherwise(F.col("_errors")).alias("errors"),
    )

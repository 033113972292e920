"""Whole jobs over bounded input, each one lazy plan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.operators.documents import (
    DEFAULT_PATTERN,
    DEFAULT_TYPE,
    REJECTED,
    append_documents,
    to_documents,
    to_documents_and_letters,
)
from logloom.operators.extensions import Extension, apply_extensions
from logloom.operators.filters import time_range
from logloom.operators.geo import geoip_join
from logloom.operators.parse import accepted, parse_access_log, rejected
from logloom.operators.stats import DEFAULT_INTERVAL, http_stats, metric_lines
from logloom.sinks import write_json_lines, write_metrics, write_rejected


def records_in_range(
    lines: DataFrame,
    ranges: DataFrame | None = None,
    extensions: Iterable[str | Extension] = (),
    min_timestamp=None,
    max_timestamp=None,
    **parse_options,
) -> DataFrame:
    """Parse, look up places, apply extensions, then cut to the time range.

    The range is tested last because an extension may change the time; the
    optimizer moves it down to the decoded line when none does.
    """
    records = accepted(parse_access_log(lines, **parse_options))
    if ranges is not None:
        records = geoip_join(records, ranges)
    records = apply_extensions(records, extensions)
    return time_range(records, min_timestamp, max_timestamp)


def indexed(
    lines: DataFrame,
    pattern: str = DEFAULT_PATTERN,
    ranges: DataFrame | None = None,
    extensions: Iterable[str | Extension] = (),
    min_timestamp=None,
    max_timestamp=None,
    **parse_options,
) -> DataFrame:
    """Documents and dead letters of lines, for one write.

    Without extensions and lookup the lines are decoded once; with them the letters
    are a second and lighter branch, as an extension sees only good records.
    """
    extensions = list(extensions)
    if not extensions and ranges is None:
        records = parse_access_log(lines, **parse_options)
        return to_documents_and_letters(records, pattern, min_timestamp, max_timestamp)
    documents = to_documents(
        records_in_range(lines, ranges, extensions, min_timestamp, max_timestamp, **parse_options), pattern
    )
    letters = rejected(parse_access_log(lines, **parse_options), ("request_id",)).select(
        F.lit(REJECTED).alias("_index"), F.col("value").alias("_line"), F.col("errors").alias("_errors")
    )
    return documents.unionByName(letters, allowMissingColumns=True)


def index_log(
    spark: SparkSession,
    lines: DataFrame,
    path: str,
    batch: str,
    rejects: str | bool | None = None,
    pattern: str = DEFAULT_PATTERN,
    **options,
) -> None:
    """Write the documents of a log to a table.

    Dead letters, if wanted, go with them (``rejects=True``; ``read_letters``), or to a
    folder of JSON lines of their own. The latter is a second and lighter pass: it
    decodes and casts, but touches no URI, query string or unknown field.
    """
    if rejects is True:
        append_documents(indexed(lines, pattern, **options), path, batch)
        return
    documents = to_documents(records_in_range(lines, **options), pattern)
    append_documents(documents, path, batch)
    if rejects:
        parse_options = {
            k: v
            for k, v in options.items()
            if k in ("hostname", "ts_formats", "ts_parser", "on_error")
        }
        letters = rejected(parse_access_log(lines, **parse_options), ("request_id",))
        write_rejected(letters.select("value", "errors"), rejects, batch)


def dump_log(
    lines: DataFrame,
    path: str,
    pattern: str = DEFAULT_PATTERN,
    doc_type: str = DEFAULT_TYPE,
    **options,
) -> None:
    """Write the documents of a log as JSON lines."""
    write_json_lines(to_documents(records_in_range(lines, **options), pattern), path, doc_type)


def measure_log(
    records: DataFrame, prefix: str, interval: int = DEFAULT_INTERVAL
) -> DataFrame:
    """Metric lines of records, from lines just parsed or a table written before.

    The table of all versions gives the same numbers as the log: every delivery
    counts as a hit.
    """
    return metric_lines(http_stats(records, interval), prefix)


def measure_log_to(
    records: DataFrame, path: str, batch: str, prefix: str, interval: int = DEFAULT_INTERVAL
) -> None:
    """Write the metric lines of records."""
    write_metrics(measure_log(records, prefix, interval), path, batch)

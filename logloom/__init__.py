"""Web access-log analytics on Spark."""

from logloom.operators.documents import (
    append_documents,
    compact_dates,
    compact_documents,
    dates_to_compact,
    json_lines,
    latest_documents,
    read_documents,
    read_letters,
    read_versions,
    route_index,
    stream_versions,
    to_documents,
    to_envelope,
    upsert_documents,
)
from logloom.operators.extensions import (
    apply_extensions,
    pandas_extension,
    register_extension,
)
from logloom.operators.filters import time_range
from logloom.operators.geo import geoip_join, load_ranges
from logloom.operators.parse import accepted, parse_access_log, rejected
from logloom.operators.stats import http_stats, metric_lines
from logloom.plans.jobs import dump_log, index_log, measure_log, measure_log_to
from logloom.schema import DOCUMENT_SCHEMA, ensure_table, load_schema, refresh_table
from logloom.sinks import read_metrics
from logloom.sources.access_log import (
    read_access_log,
    stream_access_log,
    stream_access_log_topic,
)
from logloom.streaming.queries import (
    flush_stats,
    late_records,
    stream_stats,
    stream_stats_by_arrival,
    stream_upsert,
)

__all__ = [
    "DOCUMENT_SCHEMA",
    "accepted",
    "append_documents",
    "apply_extensions",
    "compact_dates",
    "compact_documents",
    "dates_to_compact",
    "dump_log",
    "ensure_table",
    "flush_stats",
    "geoip_join",
    "http_stats",
    "index_log",
    "json_lines",
    "late_records",
    "latest_documents",
    "load_ranges",
    "load_schema",
    "measure_log",
    "measure_log_to",
    "metric_lines",
    "pandas_extension",
    "parse_access_log",
    "read_access_log",
    "read_documents",
    "read_letters",
    "read_metrics",
    "read_versions",
    "refresh_table",
    "register_extension",
    "rejected",
    "route_index",
    "stream_access_log",
    "stream_access_log_topic",
    "stream_stats",
    "stream_stats_by_arrival",
    "stream_upsert",
    "stream_versions",
    "time_range",
    "to_documents",
    "to_envelope",
    "upsert_documents",
]

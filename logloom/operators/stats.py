"""HTTP traffic statistics per interval."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from logloom.functions.time import bucket_start
from logloom.functions.traffic import cache_label, last_value, latency_bin, number, path_label
from logloom.schema import STATS_SCHEMA

DEFAULT_INTERVAL = 10
# Fixed value: how many intervals a closed one is remembered, to tell late records from new ones.
REMEMBERED = 100

METRICS = ("request_time", "upstream_response_time", "bytes_sent")
_DIMS = ("host", "request_path_1", "request_path_2", "status")
_GROUP = ("metric", *_DIMS, "cache", "bin")
_NONE = "CAST(NULL AS STRING)"


def traffic_rows(records: DataFrame) -> DataFrame:
    """The dimensions and measures of every record that counts.

    Connections without a request (status 0) do not count, nor do records that
    lack a host or a status.
    """
    return records.where("host IS NOT NULL AND status IS NOT NULL AND status <> 0").selectExpr(
        "`@timestamp`",
        "host",
        f"{path_label('request_path_1')} AS request_path_1",
        f"{path_label('request_path_2')} AS request_path_2",
        "status",
        f"{cache_label('upstream_cache_status')} AS upstream_cache_status",
        f"{number('request_time')} AS request_time",
        f"{number(last_value('upstream_response_time'))} AS upstream_last",
        "bytes_sent",
    )


def arrivals(records: DataFrame, interval: int = DEFAULT_INTERVAL) -> DataFrame:
    """The interval of every record that counts, alone."""
    counted = records.where("host IS NOT NULL AND status IS NOT NULL AND status <> 0")
    return counted.selectExpr(f"{bucket_start('`@timestamp`', interval)} AS bucket")


def _spread(rows: DataFrame, *key: str, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Each record under its metrics: its time ``v``, or its bytes ``b``."""
    parts = {
        "request_time": f"upstream_cache_status, {latency_bin('request_time')}, request_time, CAST(NULL AS BIGINT)",
        "upstream_response_time": f"{_NONE}, {latency_bin('upstream_last')}, upstream_last, CAST(NULL AS BIGINT)",
        "bytes_sent": f"{_NONE}, {_NONE}, CAST(bytes_sent AS DOUBLE), bytes_sent",
    }
    chosen = ", ".join(f"'{m}', {parts[m]}" for m in metrics)
    spread = rows.selectExpr(*key, *_DIMS, f"stack({len(metrics)}, {chosen}) AS (metric, cache, bin, v, b)")
    return spread.where("metric <> 'upstream_response_time' OR v IS NOT NULL")


def _values(groups: DataFrame, bucket: str) -> DataFrame:
    """One row per value of groups with ``total``, ``n`` and ``whole``."""
    values = f"""CASE WHEN metric = 'bytes_sent'
      THEN array(struct({_NONE} AS agg, total AS value, whole))
      ELSE array(struct('sum' AS agg, total AS value, CAST(NULL AS BIGINT) AS whole),
                 struct('count' AS agg, n AS value, CAST(NULL AS BIGINT) AS whole)) END"""
    return groups.selectExpr(
        f"{bucket} AS bucket",
        "metric",
        *_DIMS,
        "cache AS upstream_cache_status",
        "bin",
        f"inline({values})",
    ).select(*STATS_SCHEMA.fieldNames())


def http_stats(
    records: DataFrame,
    interval: int = DEFAULT_INTERVAL,
    delay: str = "5 seconds",
    metrics: Sequence[str] = METRICS,
) -> DataFrame:
    """Sums and counts per ``interval`` seconds, one row per metric value.

    ``request_time`` is grouped by host, path, status, cache state and latency
    bin, ``upstream_response_time`` (last upstream, where there is one) by the
    same without the cache state, ``bytes_sent`` by host, path and status.
    ``whole`` is the exact sum of bytes; it is NULL where 64 bits are too few.

    Each record is spread over the ``metrics`` asked for and all are summed by one
    aggregation: one pass over the input, summed before the only shuffle. On a
    stream an interval is emitted once the watermark, ``delay`` behind the
    newest record that counts, has passed its end; later records are dropped.
    """
    rows = traffic_rows(records)
    if records.isStreaming:
        rows = rows.withWatermark("`@timestamp`", delay)
        key = F.expr(f"window(`@timestamp`, '{int(interval)} seconds') AS window")
        bucket = "unix_seconds(window.start)"
    else:
        key = F.expr(f"{bucket_start('`@timestamp`', interval)} AS bucket")
        bucket = "bucket"
    groups = _spread(rows, "`@timestamp`", metrics=metrics).groupBy(key, *_GROUP).agg(
        F.expr("coalesce(sum(v), 0D) AS total"),
        F.expr("CAST(count(v) AS DOUBLE) AS n"),
        F.expr("IF(count(b) = 0, 0L, try_sum(b)) AS whole"),
    )
    return _values(groups, bucket)


def open_stats(state: DataFrame) -> DataFrame:
    """The statistics that a stopped stream of ``http_stats`` still holds in its state.

    ``state`` is what Spark's reader of streaming state returns for the
    checkpoint: the groups of the intervals that are not closed, each with
    the buffers of its sums.
    """
    # Buffers in the order of the aggregates above; two have the same name.
    buffers = state.selectExpr("key.*", "inline(array(value))").toDF(
        "window", *_GROUP, "sum", "n", "bytes", "whole", "none"
    )
    groups = buffers.selectExpr(
        "window", *_GROUP, "coalesce(sum, 0D) AS total", "CAST(n AS DOUBLE) AS n", "IF(bytes = 0, 0L, whole) AS whole"
    )
    return _values(groups, "unix_seconds(window.start)")


_ARRIVED = (
    "bucket bigint, metric string, host string, request_path_1 string, request_path_2 string, status int,"
    " cache string, bin string, total double, n double, whole bigint, late bigint"
)
_SUMS = "total double, n bigint, whole bigint, closed boolean"


def _close_on_arrival(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState, interval: int, delay: float):
    """Sums of one group of one interval; emitted when nothing has come for a while."""
    bucket, metric = key[:2]
    total, n, whole, closed = state.get if state.exists else (0.0, 0, 0, False)
    if state.hasTimedOut:
        if closed:
            state.remove()
            return
        state.update((total, n, whole, True))
        state.setTimeoutDuration(int(REMEMBERED * interval * 1000))
        yield pd.DataFrame([(*key, total, float(n), whole, None)], columns=_names(_ARRIVED))
        return
    late = 0
    for part in parts:
        late += len(part)
        if not closed:
            total += float(part["v"].sum())
            n += int(part["v"].count())
            whole = None if whole is None else whole + sum(map(int, part["b"].dropna()))
            whole = whole if whole is not None and abs(whole) < 1 << 63 else None
    if closed:
        state.setTimeoutDuration(int(REMEMBERED * interval * 1000))
        if metric == "request_time":  # a record has one row of it
            yield pd.DataFrame([(*key, None, None, None, late)], columns=_names(_ARRIVED))
        return
    state.update((total, n, whole, False))
    now = state.getCurrentProcessingTimeMs()
    state.setTimeoutDuration(max(1, int(max((bucket + interval) * 1000, now) + delay * 1000 - now)))


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def arrival_stats(records: DataFrame, interval: int = DEFAULT_INTERVAL, delay: float = 5.0) -> DataFrame:
    """``http_stats`` of a stream whose intervals close by the clock.

    A group of an interval is emitted ``delay`` seconds after the interval's end and
    after the group's last record, also when the source has fallen silent. The
    state holds sums, never records, and remembers closed groups for
    ``REMEMBERED`` intervals; records of such are not counted again but returned as
    rows of ``late`` records. Sums are made in Python, on batches.
    """
    spread = _spread(traffic_rows(records), f"{bucket_start('`@timestamp`', interval)} AS bucket")
    spread = spread.withColumn("b", F.col("b").cast("string"))  # pandas would round whole numbers with gaps

    def close(key, parts, state):
        return _close_on_arrival(key, parts, state, interval, delay)

    return spread.groupBy("bucket", *_GROUP).applyInPandasWithState(
        close, _ARRIVED, _SUMS, "append", GroupStateTimeout.ProcessingTimeTimeout
    )


def arrived(groups: DataFrame) -> DataFrame:
    """Statistics among the rows of ``arrival_stats``."""
    return _values(groups.where("late IS NULL"), "bucket")


def metric_lines(stats: DataFrame, prefix: str) -> DataFrame:
    """Plaintext ``name value timestamp`` lines in ``value``, with ``bucket``.

    The name is the prefix as given and then every part with its dots replaced;
    names that become equal that way stay separate lines. Time sums have three
    decimals, counts and bytes are whole.
    """
    parts = [f for f in STATS_SCHEMA.fieldNames() if f not in ("bucket", "value", "whole")]
    name = F.concat_ws(
        ".", F.lit(prefix), *[F.expr(f"replace(CAST({p} AS STRING), '.', '_')") for p in parts]
    )
    text = F.expr(
        "CASE WHEN agg = 'sum' THEN printf('%.3f', value)"
        " WHEN whole IS NOT NULL THEN CAST(whole AS STRING)"
        " WHEN value < 9e18D THEN CAST(CAST(value AS BIGINT) AS STRING) ELSE printf('%.0f', value) END"
    )
    return stats.select(
        "bucket", F.concat_ws(" ", name, text, F.expr("CAST(bucket AS STRING)")).alias("value")
    )

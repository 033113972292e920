"""Continuous statistics and documents."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from logloom.operators.documents import (
    DEFAULT_PATTERN,
    REJECTED,
    append_documents,
    to_documents,
    to_documents_and_letters,
)
from logloom.operators.extensions import Extension, apply_extensions
from logloom.operators.filters import time_range
from logloom.operators.geo import BROADCAST_BYTES, RangeLookup
from logloom.operators.parse import accepted, parse_access_log, rejected
from logloom.operators.stats import (
    DEFAULT_INTERVAL,
    arrival_stats,
    arrivals,
    arrived,
    http_stats,
    metric_lines,
    open_stats,
)
from logloom.sinks import FLUSH, write_late, write_metrics, write_rejected
from logloom.sources.access_log import number_lines

# How long the sinks wait at most, and how late a record may be.
DEFAULT_TRIGGER = "10 seconds"
DEFAULT_DELAY = "5 seconds"


def _start(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str | None,
) -> StreamingQuery:
    """Start a query; without a trigger it catches up once and stops."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def _batch_name(batch: DataFrame, number: int) -> str:
    """A name that no other query uses; a replay of the micro-batch has it again."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{number}"


def stream_stats(
    records: DataFrame,
    path: str,
    checkpoint: str,
    prefix: str,
    interval: int = DEFAULT_INTERVAL,
    delay: str = DEFAULT_DELAY,
    trigger: str | None = DEFAULT_TRIGGER,
    late: str | None = None,
) -> StreamingQuery:
    """Write the metric lines of every closed interval to ``path``.

    An interval closes when a record ``delay`` past its end has been seen;
    records that come later than that are dropped. Intervals still open when the
    input ends stay in the state; ``flush_stats`` writes them.

    ``late`` is a folder for the number of dropped records per interval and
    micro-batch (``late_records`` adds them up). They are told by the watermark
    that Spark has noted for the micro-batch before this one, which is the one it
    drops by. A second branch of the query finds them, so lines are decoded twice;
    a stream of documents already written (``stream_versions``) spares that.
    """
    lines = metric_lines(http_stats(records, interval, delay), prefix)
    if late is None:
        return _start(
            lines,
            lambda batch, number: write_metrics(batch, path, _batch_name(batch, number)),
            checkpoint,
            trigger,
        )
    every = lines.unionByName(arrivals(records, interval).withColumn("value", F.lit(None).cast("string")))

    def handle(batch: DataFrame, number: int) -> None:
        closed = _watermark(batch.sparkSession, checkpoint, number - 1)
        over = F.col("value").isNotNull() | ((F.col("bucket") + interval) * 1000 <= closed)
        rows, name = batch.where(over).persist(), _batch_name(batch, number)
        try:  # both outputs of a micro-batch that is run once
            write_metrics(rows.where("value IS NOT NULL"), path, name)
            write_late(rows.where("value IS NULL").groupBy("bucket").agg(F.count("*").alias("n")), late, name)
        finally:
            rows.unpersist()

    return _start(every, handle, checkpoint, trigger)


def _watermark(spark: SparkSession, checkpoint: str, number: int) -> int:
    """Milliseconds of the watermark noted for a micro-batch; 0 before the first."""
    if number < 0:
        return 0
    notes = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{number}").where("value LIKE '{%batchWatermarkMs%'")
    return json.loads(notes.first().value)["batchWatermarkMs"]


def late_records(spark: SparkSession, late: str) -> DataFrame:
    """(bucket, n): how many records came too late for each interval, over all runs."""
    return spark.read.schema("bucket bigint, n bigint").json(late).groupBy("bucket").agg(F.sum("n").alias("n"))


def flush_stats(spark: SparkSession, path: str, checkpoint: str, prefix: str) -> None:
    """Write the metric lines of the intervals that a stopped ``stream_stats`` left open.

    They are read from the stream's state, which stays as it is. If the stream
    goes on, the intervals are written again when they close, with what came
    since; ``read_metrics`` returns those lines then. Flushing again
    replaces the flush before.
    """
    query = json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value)["id"]
    state = spark.read.format("statestore").load(checkpoint)
    write_metrics(metric_lines(open_stats(state), prefix), path, f"{FLUSH}{query}")


def stream_stats_by_arrival(
    records: DataFrame,
    path: str,
    checkpoint: str,
    prefix: str,
    late: str,
    interval: int = DEFAULT_INTERVAL,
    delay: float = 5.0,
    trigger: str | None = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """Write the metric lines of intervals that close by the clock, see ``arrival_stats``.

    For sources that may fall silent: no later record is needed to close an
    interval. Late records are counted in ``late`` as by ``stream_stats``.
    """

    def handle(batch: DataFrame, number: int) -> None:
        groups, name = batch.persist(), _batch_name(batch, number)
        try:
            write_metrics(metric_lines(arrived(groups), prefix), path, name)
            write_late(groups.where("late IS NOT NULL").groupBy("bucket").agg(F.sum("late").alias("n")), late, name)
        finally:
            groups.unpersist()

    return _start(arrival_stats(records, interval, delay), handle, checkpoint, trigger)


def stream_upsert(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    rejects: str | bool | None = None,
    pattern: str = DEFAULT_PATTERN,
    extensions: Iterable[str | Extension] = (),
    min_timestamp=None,
    max_timestamp=None,
    trigger: str | None = DEFAULT_TRIGGER,
    ranges: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    **parse_options,
) -> StreamingQuery:
    """Parse a stream of lines and append its documents to the table at ``path``.

    A replayed micro-batch replaces its own folder, named by query and number, and readers settle repeated
    deliveries, so restarts and duplicates leave one document per key. Places are
    looked up in ``ranges``, which are measured once for all micro-batches.

    Dead letters go to the table with the documents (``rejects=True``; ``read_letters``):
    without extensions and lookup that decodes a micro-batch once and keeps nothing. With a
    folder of their own the records of the micro-batch are cached for both outputs.
    """
    extensions = list(extensions)
    lookup = RangeLookup(ranges, broadcast_bytes) if ranges is not None else None

    def handle(batch: DataFrame, number: int) -> None:
        name = _batch_name(batch, number)
        numbered = number_lines(batch) if "line" in _sequence_fields(batch) else batch
        records = parse_access_log(numbered, **parse_options)
        if rejects is True and not extensions and lookup is None:
            both = to_documents_and_letters(records, pattern, min_timestamp, max_timestamp)
            append_documents(both, path, name, stale=False)
            return
        if rejects:
            # Both outputs read the micro-batch, which the trigger bounds.
            records = records.persist()
        try:
            kept = accepted(records)
            if lookup is not None:
                kept = lookup.join(kept, few=True)
            kept = apply_extensions(kept, extensions)
            kept = time_range(kept, min_timestamp, max_timestamp)
            documents, letters = to_documents(kept, pattern), rejected(records, required=("request_id",))
            if rejects is True:
                letters = letters.selectExpr(f"'{REJECTED}' AS _index", "value AS _line", "errors AS _errors")
                documents = documents.unionByName(letters, allowMissingColumns=True)
            append_documents(documents, path, name, stale=False)
            if rejects and rejects is not True:
                write_rejected(letters.select("value", "errors"), rejects, name)
        finally:
            if rejects:
                records.unpersist()

    return _start(lines, handle, checkpoint, trigger)


def _sequence_fields(batch: DataFrame) -> list[str]:
    kind = batch.schema["_seq"].dataType
    return kind.fieldNames() if isinstance(kind, StructType) else []

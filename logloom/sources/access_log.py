"""Sources of access-log lines, bounded and unbounded."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _valid_text() -> Column:
    """Invalid bytes become U+FFFD instead of failing later."""
    return F.make_valid_utf8("value").alias("value")


def _file_position(line: Column) -> Column:
    """Place of a line among all files; a later line compares greater.

    Files are ordered by modification time, lines by their position: the start
    of the read block and a number that rises within a task.
    """
    return F.struct(
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        line.cast("bigint").alias("line"),
    ).alias("_seq")


def read_access_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of bounded files: ``value`` and their place ``_seq``.

    Takes files, folders, globs and compressed files. An unterminated last
    line counts.
    """
    return spark.read.text(path).select(
        _valid_text(), _file_position(F.monotonically_increasing_id())
    )


def stream_access_log(
    spark: SparkSession,
    path: str,
    start: str | dt.datetime = "earliest",
    max_files: int | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """Lines of files that keep arriving in a folder.

    A file is read once, when it appears: publish closed files (write
    elsewhere, then rename), or use ``stream_access_log_topic``. A rotated log
    is a new file, and no line is ever half read.

    ``start`` is ``"earliest"`` (files already there first), a time (only
    files modified since) or ``"latest"`` (now). ``"latest"`` is settled once
    per ``checkpoint`` so that a restart goes on where it stopped.
    ``max_files`` bounds a micro-batch.
    """
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(path)
    if start == "latest":
        if checkpoint is None:
            raise ValueError("start='latest' needs the checkpoint of the query")
        start = _settled_start(spark, checkpoint)
    if start != "earliest":
        since = start if isinstance(start, str) else start.isoformat()
        lines = lines.where(
            F.col("_metadata.file_modification_time") >= F.lit(since).cast("timestamp")
        )
    # Streams number no lines; ``number_lines`` adds it within a micro-batch.
    return lines.select(_valid_text(), _file_position(F.lit(None)))


def number_lines(batch: DataFrame) -> DataFrame:
    """Line numbers for the places in a micro-batch, where the source gave none."""
    line = F.coalesce("_seq.line", F.monotonically_increasing_id())
    return batch.withColumn("_seq", F.col("_seq").withField("line", line))


def stream_access_log_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    start: str = "latest",
    max_offsets: int | None = None,
) -> DataFrame:
    """Lines of a Kafka topic, from its end or its beginning.

    Needs Spark's Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        F.make_valid_utf8(F.col("value").cast("string")).alias("value"),
        F.struct(
            F.col("timestamp").alias("file_time"),
            F.concat_ws("/", "topic", F.col("partition").cast("string")).alias("file_path"),
            F.lit(0).cast("bigint").alias("block_start"),
            F.col("offset").alias("line"),
        ).alias("_seq"),
    )


def _settled_start(spark: SparkSession, checkpoint: str) -> str:
    """The start time kept beside a checkpoint, written on first use."""
    place = f"{checkpoint.rstrip('/')}-start"
    try:
        kept = spark.read.text(place).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = None
    if kept is None:  # nothing there, or a write that was cut off
        now = dt.datetime.now(dt.timezone.utc).isoformat()
        spark.createDataFrame([(now,)], "value string").write.mode("overwrite").text(place)
        return now
    return kept[0]

"""Text sinks: JSON lines, dead letters and metric lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom.operators.documents import DEFAULT_TYPE, json_lines

#: Begins the names of batches that hold intervals not closed yet.
FLUSH = "flush-"


def write_json_lines(documents: DataFrame, path: str, doc_type: str = DEFAULT_TYPE) -> None:
    """One JSON envelope per line; no shuffle."""
    json_lines(documents, doc_type).write.mode("overwrite").text(path)


def write_rejected(letters: DataFrame, path: str, batch: str) -> None:
    """Dead letters of one batch, in a folder of their own so a replay is safe."""
    letters.write.mode("overwrite").json(f"{path}/batch={batch}")


def write_metrics(lines: DataFrame, path: str, batch: str) -> None:
    """Metric lines of one batch, partitioned by the day of their interval.

    Delivery is at least once over batches; a line's name and time identify it.
    """
    days = F.date_from_unix_date(F.floor(F.col("bucket") / 86400).cast("int"))
    (
        lines.select("value", days.alias("day"))
        .write.mode("overwrite")
        .partitionBy("day")
        .text(f"{path}/batch={batch}")
    )


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metric values by ``name`` and ``time``, each once.

    Lines are written at least once. Of several of one name and time that of a closed
    interval counts before that of an open one, then the line of the last batch name.
    """
    lines = spark.read.schema("value string, batch string, day date").text(path)
    part = r"regexp_extract(value, r'^(.*) (\S+) (\S+)$', {})"
    parts = lines.selectExpr(
        f"{part.format(1)} AS name", f"{part.format(2)} AS value", f"CAST({part.format(3)} AS BIGINT) AS time", "batch"
    )
    chosen = Window.partitionBy("name", "time").orderBy(F.col("batch").startswith(FLUSH), F.desc("batch"))
    return parts.withColumn("_rank", F.row_number().over(chosen)).where("_rank = 1").drop("_rank", "batch")


def write_late(counts: DataFrame, path: str, batch: str) -> None:
    """Late records per interval of one batch, in a folder of its own."""
    counts.write.mode("overwrite").json(f"{path}/batch={batch}")

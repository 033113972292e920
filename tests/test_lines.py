"""How the derived log is shared out among tasks."""

import datetime as dt
import glob

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import checks.lines
import checks.queries
from checks.queries import documents, lines, stream_lines, streamed_growing


def _events(tmp_path, rows):
    """Events in one row group, however many splits it spans."""
    ids = range(rows)
    columns = {
        "event_id": pa.array(ids, pa.int64()),
        "ts": pa.array([dt.datetime(2024, 1, 1) + dt.timedelta(seconds=n) for n in ids], pa.timestamp("us")),
        "user_id": pa.array([n % 7 for n in ids], pa.int64()),
        "event_type": ["view"] * rows,
        "value": [n * 0.5 for n in ids],
        "props": [f"{n * 7919}" * 20 for n in ids],
    }
    pq.write_table(pa.table(columns), tmp_path / "events.parquet")
    return str(tmp_path)


def test_no_task_derives_more_lines_than_the_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(checks.lines, "LINES", 500, raising=False)
    folder = _events(tmp_path, 6000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")  # more splits than cores
    try:
        found = lines(spark, folder)
        tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(tasks) == 6000 and found.select("event_id").distinct().count() == 6000
        assert len(tasks) == 12 and max(tasks) < 750
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_streamed_lines_are_shared_out_as_well(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(checks.lines, "LINES", 500, raising=False)
    folder, sizes = _events(tmp_path, 6000), []
    query = stream_lines(spark, folder).writeStream.trigger(availableNow=True).foreachBatch(
        lambda batch, _: sizes.extend(r["count"] for r in batch.groupBy(F.spark_partition_id()).count().collect())
    ).option("checkpointLocation", str(tmp_path / "check")).start()
    query.awaitTermination()
    assert sum(sizes) == 6000 and max(sizes) < 750


def test_a_growing_log_has_as_many_files_as_its_size_asks_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(checks.lines, "LINES", 250, raising=False)
    kept = str(tmp_path / "kept")
    monkeypatch.setattr(checks.queries, "shared_folder", lambda _, purpose: f"{kept}/{purpose}")
    found = streamed_growing(spark, _events(tmp_path, 2000))
    files = glob.glob(f"{kept}/growing/log/access-*.log")
    sizes = [sum(1 for _ in open(f)) for f in files]
    assert len(files) == 8 and sum(sizes) == 2000 and max(sizes) < 400
    assert found.count() == documents(spark, str(tmp_path)).count()

"""Streams: rotation, starting points, late records, and stream against batch."""

import datetime as dt
import json
import os
import shutil
import time

import pytest
from conftest import record

from logloom.operators.documents import (
    compact_dates,
    dates_to_compact,
    read_documents,
    read_letters,
    read_versions,
    stream_versions,
)
from logloom.operators.parse import accepted, parse_access_log
from logloom.operators.stats import http_stats, metric_lines
from logloom.plans.jobs import index_log
from logloom.sinks import read_metrics
from logloom.sources.access_log import read_access_log, stream_access_log
from logloom.streaming.queries import (
    flush_stats,
    late_records,
    stream_stats,
    stream_stats_by_arrival,
    stream_upsert,
)


@pytest.fixture
def folder(tmp_path):
    """A watched folder, and a way to publish closed files into it."""
    place = tmp_path / "log"
    place.mkdir()

    def publish(name, *items, modified=None):
        text = "".join((i if isinstance(i, str) else json.dumps(i)) + "\n" for i in items)
        staged = tmp_path / f"staged-{name}"
        staged.write_text(text)
        if modified is not None:
            os.utime(staged, (modified, modified))
        shutil.move(staged, place / name)

    publish.path = str(place)
    return publish


def at(second, **fields):
    return record(
        timestamp=dt.datetime.fromtimestamp(1704067200 + second, dt.timezone.utc).isoformat(),
        request_id=f"r{second}",
        request_time="0.1",
        **fields,
    )


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def test_documents_over_rotation_and_restart(spark, folder, tmp_path):
    table, check, bad = (str(tmp_path / n) for n in ("docs", "check", "bad"))

    def catch_up():
        source = stream_access_log(spark, folder.path, max_files=1)
        return run(stream_upsert(source, table, check, rejects=bad, trigger=None, hostname="w"))

    folder("a.1", at(0, host="old"), at(1), "{bad", modified=1704067300)
    catch_up()
    # The log rotates: the next file is read from its start, the old one not again.
    folder("a.2", at(0, host="new"), at(2), modified=1704067400)
    catch_up()
    catch_up()
    found = {(r._id, r.host) for r in read_documents(spark, table).collect()}
    assert found == {("r0", "new"), ("r1", "example.com"), ("r2", "example.com")}
    assert read_versions(spark, table).count() == 4
    assert [r.value for r in spark.read.json(bad).where("value is not null").collect()] == ["{bad"]


def test_letters_with_documents(spark, folder, tmp_path):
    folder("a", at(0), "{bad", record(request_id=None))
    for n, extensions in enumerate(([], [lambda df: df.where("host = 'example.com'")])):
        table = str(tmp_path / f"docs{n}")
        for _ in range(2):
            source = stream_access_log(spark, folder.path)
            run(stream_upsert(source, table, f"{table}-check", rejects=True, trigger=None, extensions=extensions))
        assert [r._id for r in read_versions(spark, table).collect()] == ["r0"]
        assert sorted(r.errors[0] for r in read_letters(spark, table).collect()) == ["json", "request_id"]


def test_starting_points(spark, folder, tmp_path):
    folder("old", at(0), modified=1704067300)
    folder("new", at(1), modified=1704067400)

    def seen(name, **options):
        table = str(tmp_path / name)
        source = stream_access_log(spark, folder.path, **options)
        run(stream_upsert(source, table, f"{table}-check", trigger=None))
        return {r._id for r in read_versions(spark, table).collect()}

    assert seen("all") == {"r0", "r1"}
    since = dt.datetime.fromtimestamp(1704067350, dt.timezone.utc)
    assert seen("since", start=since) == {"r1"}
    with pytest.raises(ValueError):
        stream_access_log(spark, folder.path, start="latest")
    kept = str(tmp_path / "latest-check")
    assert seen("latest", start="latest", checkpoint=kept) == set()
    folder("later", at(2))
    # A restart keeps the first start, so nothing that came between is lost.
    assert seen("latest", start="latest", checkpoint=kept) == {"r2"}


def test_stream_equals_batch_but_for_open_intervals(spark, folder, tmp_path):
    folder("a", *[at(s, host=f"h{s % 3}") for s in range(0, 95)], at(200), at(400, status=0))
    folder("b", *[at(s) for s in range(60, 100, 7)])
    path = str(tmp_path / "metrics")
    records = accepted(parse_access_log(stream_access_log(spark, folder.path)))
    run(stream_stats(records, path, str(tmp_path / "check"), "p", trigger=None))
    streamed = sorted(r.value for r in spark.read.schema("value string").text(path).collect())
    batch = metric_lines(
        http_stats(accepted(parse_access_log(read_access_log(spark, folder.path)))), "p"
    )
    # The newest record that counts is at 200 s: intervals up to 195 s close.
    closed = batch.where(f"bucket + 10 <= {1704067200 + 195}")
    assert streamed == sorted(r.value for r in closed.collect())
    assert len(streamed) > 30


def test_last_interval_stays_open(spark, folder, tmp_path):
    folder("a", at(0), at(12))
    path = str(tmp_path / "metrics")
    records = accepted(parse_access_log(stream_access_log(spark, folder.path)))
    run(stream_stats(records, path, str(tmp_path / "check"), "p", trigger=None))
    assert spark.read.schema("value string").text(path).count() == 0


def test_late_records_are_dropped_and_counted(spark, folder, tmp_path):
    path, check, late = (str(tmp_path / n) for n in ("metrics", "check", "late"))

    def catch_up():
        source = stream_access_log(spark, folder.path, max_files=1)
        records = accepted(parse_access_log(source))
        run(stream_stats(records, path, check, "p", trigger=None, late=late))
        return {r.bucket - 1704067200: r.n for r in late_records(spark, late).collect()}

    folder("a", at(3), at(8), at(14))
    assert catch_up() == {}
    folder("b", at(9), at(100))  # not late: the watermark is at 9 s
    assert catch_up() == {}
    # Its interval was closed. Three rows of the aggregation each, but records are counted.
    folder("c", at(5, upstream_response_time="0.1"), at(6, bytes_sent=1), at(7, status=0), at(101), at(15))
    assert catch_up() == {0: 2, 10: 1}
    assert catch_up() == {0: 2, 10: 1}
    counts = {
        r.value.split()[2]: r.value.split()[1]
        for r in spark.read.schema("value string").text(path).collect()
        if ".request_time.count." in r.value
    }
    assert counts == {"1704067200": "3", "1704067210": "1"}


def test_late_records_over_many_triggers(spark, folder, tmp_path):
    """More micro-batches than progress reports are remembered."""
    for n in range(8):
        folder(f"{n}", at(1000 + 100 * n), *[at(5)] * (5 if n == 2 else 0), modified=1704067300 + n)
    late, kept = str(tmp_path / "late"), spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        source = stream_access_log(spark, folder.path, max_files=1)
        records = accepted(parse_access_log(source))
        query = run(stream_stats(records, str(tmp_path / "m"), str(tmp_path / "check"), "p", trigger=None, late=late))
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert len(query.recentProgress) <= 3
    assert [(r.bucket, r.n) for r in late_records(spark, late).collect()] == [(1704067200, 5)]


def test_flush_writes_open_intervals(spark, folder, tmp_path):
    path, check = str(tmp_path / "metrics"), str(tmp_path / "check")

    def catch_up(flush=True):
        records = accepted(parse_access_log(stream_access_log(spark, folder.path)))
        run(stream_stats(records, path, check, "p", trigger=None))
        if flush:
            flush_stats(spark, path, check, "p")
        return sorted((r.name, r.value, r.time) for r in read_metrics(spark, path).collect())

    def batch():
        stats = http_stats(accepted(parse_access_log(read_access_log(spark, folder.path))))
        lines = (r.value.rsplit(" ", 2) for r in metric_lines(stats, "p").collect())
        return sorted((n, v, int(t)) for n, v, t in lines)

    big = 9007199254740993
    folder("a", *[at(s, host=f"h{s % 3}", bytes_sent=s) for s in range(0, 95)], at(96, bytes_sent=big), at(97))
    assert catch_up() == batch()
    assert any(v == str(big) for _, v, _ in batch())
    # The stream goes on: open intervals get more, close, and others open.
    folder("b", at(98, bytes_sent=5), at(140), at(155, upstream_response_time="0.5"))
    assert catch_up(flush=False) == [line for line in batch() if line[2] < 1704067350]
    assert spark.read.text(path).count() > len(batch())  # what was flushed is still there, and not returned
    assert catch_up() == batch()


def test_exact_bytes(spark, lines):
    rows = [record(request_id=str(n), bytes_sent=b, host=h) for n, (h, b) in enumerate([("a", 2**53 + 1), ("a", 0), ("b", 2**63 - 1), ("b", 2**63 - 1), ("c", None)])]
    stats = http_stats(accepted(parse_access_log(lines(*rows)))).where("metric = 'bytes_sent'")
    found = {r.value.split(".")[2]: r.value.split()[1] for r in metric_lines(stats, "p").collect()}
    assert found == {"a": "9007199254740993", "b": "18446744073709552000", "c": "0"}


def test_intervals_close_when_the_source_is_silent(spark, folder, tmp_path):
    path, check, late = (str(tmp_path / n) for n in ("metrics", "check", "late"))
    big = 2**53 + 1
    folder("a", at(3, bytes_sent=big), at(8), at(14, host="b", upstream_response_time="0.2"))
    records = accepted(parse_access_log(stream_access_log(spark, folder.path)))
    query = stream_stats_by_arrival(records, path, check, "p", late, delay=1.0, trigger="1 second")
    try:
        wait(query, lambda: len(metrics(spark, path)) >= 8)
        assert metrics(spark, path) == sorted(
            r.value for r in metric_lines(http_stats(accepted(parse_access_log(read_access_log(spark, folder.path)))), "p").collect()
        )
        folder("b", at(5), at(6, bytes_sent=1), at(40))
        wait(query, lambda: len(metrics(spark, path)) >= 11)
        wait(query, lambda: late_records(spark, late).count() == 1)
    finally:
        query.stop()
    assert [(r.bucket, r.n) for r in late_records(spark, late).collect()] == [(1704067200, 2)]
    assert f"p.bytes_sent.example_com.a.b.200 {big} 1704067200" in metrics(spark, path)


def metrics(spark, path):
    try:
        return sorted(r.value for r in spark.read.schema("value string").text(path).collect())
    except Exception:  # nothing written yet, or a folder being replaced
        return []


def wait(query, done, seconds=90):
    end = time.time() + seconds
    while not done():
        assert query.exception() is None and time.time() < end
        time.sleep(0.5)


def test_statistics_follow_the_table(spark, folder, tmp_path):
    table, path = str(tmp_path / "docs"), str(tmp_path / "metrics")

    def catch_up():
        lines = stream_access_log(spark, folder.path)
        run(stream_upsert(lines, table, str(tmp_path / "check"), trigger=None))
        stream = stream_versions(spark, table)
        run(stream_stats(stream, path, str(tmp_path / "check2"), "p", trigger=None, late=str(tmp_path / "late")))
        flush_stats(spark, path, str(tmp_path / "check2"), "p")

    folder("a", at(0), at(1), at(1, host="again"), at(33))
    catch_up()
    folder("b", at(34))
    catch_up()
    compact_dates(spark, table, dates_to_compact(spark, table))
    catch_up()
    batch = metric_lines(http_stats(accepted(parse_access_log(read_access_log(spark, folder.path)))), "p")
    assert sorted(f"{r.name} {r.value} {r.time}" for r in read_metrics(spark, path).collect()) == sorted(r.value for r in batch.collect())


def test_two_writers_of_one_table(spark, folder, tmp_path):
    table, bad = str(tmp_path / "docs"), str(tmp_path / "bad")
    folder("a", at(0), "{bad")
    index_log(spark, read_access_log(spark, folder.path), table, batch="0", rejects=bad, hostname="w")
    folder("b", at(1), "{worse")
    for check in ("one", "two"):
        source = stream_access_log(spark, folder.path)
        run(stream_upsert(source, table, str(tmp_path / check), rejects=bad, trigger=None, hostname="w"))
        folder(f"c-{check}", at(2 if check == "one" else 3))
    got = {r._id for r in read_documents(spark, table).select("_id").collect()}
    assert got == {"r0", "r1", "r2"}
    assert spark.read.json(bad).select("value").distinct().count() == 2


def test_two_metric_streams(spark, folder, tmp_path):
    folder("a", at(0), at(100))
    for name in ("one", "two"):
        records = accepted(parse_access_log(stream_access_log(spark, folder.path)))
        run(stream_stats(records, str(tmp_path / "metrics"), str(tmp_path / name), name, trigger=None))
    lines = [r.value for r in spark.read.text(str(tmp_path / "metrics")).collect()]
    assert {line.split(".")[0] for line in lines} == {"one", "two"}

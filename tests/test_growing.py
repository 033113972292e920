"""Files that are appended to, renamed and emptied while they are followed."""

import json
import os
import random

import pytest
from conftest import record

from logloom.operators.documents import read_documents, read_versions
from logloom.sources import growing
from logloom.sources.growing import GrowingReader, follow_access_log
from logloom.streaming.queries import stream_upsert


class Follower:
    """What a stream does with a reader: keeps the last offset, reads what is new."""

    def __init__(self, pattern, **options):
        self.reader = GrowingReader({"path": str(pattern), **options})
        self.offset = json.loads(json.dumps(self.reader.initialOffset()))

    def plan(self):
        end = json.loads(json.dumps(self.reader.latestOffset()))
        spans, self.offset = self.reader.partitions(self.offset, end), end
        return spans

    def read(self):
        return self.lines(self.plan())

    def lines(self, spans):
        return [line for s in spans for batch in self.reader.read(s) for line in batch["value"].to_pylist()]


def append(path, data):
    with open(path, "ab") as file:
        file.write(data)


def test_a_last_line_waits_for_its_end(tmp_path):
    log = tmp_path / "access.log"
    append(log, b"one\r\ntwo\n\nthr")
    follower = Follower(tmp_path / "access.log*")
    assert follower.read() == ["one", "two", ""]
    assert follower.read() == []
    append(log, b"ee")
    assert follower.read() == []
    append(log, b"\xff\nfour\n")
    assert follower.read() == ["three�", "four"]


def test_starting_at_the_end(tmp_path):
    log = tmp_path / "access.log"
    append(log, b"old\nhal")
    follower = Follower(tmp_path / "access.log*", start="latest")
    append(log, b"f\nnew\n")
    append(tmp_path / "access.log.2", b"another\n")
    assert sorted(follower.read()) == ["another", "half", "new"]


def test_rotation(tmp_path):
    log, old = tmp_path / "access.log", tmp_path / "access.log.1"
    append(log, b"a\nb")
    follower = Follower(tmp_path / "access.log*", follow="access.log", quiet="0")
    assert follower.read() == ["a"]
    os.rename(log, old)
    append(old, b"b\nc\n")
    append(log, b"x\n")
    assert sorted(follower.read()) == ["bb", "c", "x"]
    append(old, b"unended")
    os.utime(old, (1, 1))
    append(log, b"y\nz")
    assert sorted(follower.read()) == ["unended", "y"]
    os.remove(old)
    append(log, b"\n")
    assert follower.read() == ["z"]
    # Between planning and reading.
    append(log, b"w\n")
    spans = follower.plan()
    os.rename(log, old)
    append(log, b"not this\n")
    assert follower.lines(spans) == ["w"]
    os.remove(log)
    append(log, b"")
    os.truncate(old, 0)
    append(old, b"again\n")
    assert follower.read() == ["again"]


def test_spans_hold_every_line_once(tmp_path, monkeypatch):
    chosen = random.Random(5)
    texts = ["x" * chosen.choice((0, 1, 2, 7, 30, 200)) + str(n) for n in range(300)]
    append(tmp_path / "log", "".join(f"{t}\n" for t in texts).encode())
    for split in (1, 2, 3, 10, 64, 1000, 1 << 20):
        monkeypatch.setattr(growing, "SPLIT", split)
        monkeypatch.setattr(growing, "LOOK_BACK", 5)
        follower = Follower(tmp_path / "log")
        assert follower.read() == texts
        assert sorted({s.first for s in follower.reader.partitions({}, follower.offset)})[:2] == [0, split][: 1 + (split < 5000)]


def test_documents_of_a_growing_log(spark, tmp_path):
    (tmp_path / "log").mkdir()
    log, table = tmp_path / "log" / "access.log", str(tmp_path / "docs")

    def catch_up(start="earliest"):
        lines = follow_access_log(spark, f"{log}*", start=start, follow="access.log")
        query = stream_upsert(lines, table, str(tmp_path / "check"), trigger=None)
        query.awaitTermination(120)
        assert query.exception() is None
        return {(r._id, r.host) for r in read_documents(spark, table).collect()}

    def text(**fields):
        return json.dumps(record(**fields)).encode() + b"\n"

    append(log, text(request_id="a", host="old") + text(request_id="b")[:20])
    assert catch_up() == {("a", "old")}
    append(log, text(request_id="b")[20:] + text(request_id="a", host="new"))
    assert catch_up() == {("a", "new"), ("b", "example.com")}
    os.rename(log, f"{log}.1")
    append(f"{log}.1", text(request_id="c"))
    append(log, text(request_id="d") + b"{bad\n")
    assert {k for k, _ in catch_up()} == set("abcd")
    assert {k for k, _ in catch_up()} == set("abcd")
    assert read_versions(spark, table).count() == 5
    with pytest.raises(ValueError):
        follow_access_log(spark, str(log), start="middle")


def test_only_what_comes_later(spark, tmp_path):
    log, table = tmp_path / "access.log", str(tmp_path / "docs")
    append(log, json.dumps(record(request_id="before")).encode() + b"\n")
    lines = follow_access_log(spark, str(log))
    query = stream_upsert(lines, table, str(tmp_path / "check"), trigger="1 second")
    try:
        for n in range(60):
            append(log, json.dumps(record(request_id=f"r{n}")).encode() + b"\n")
            query.processAllAvailable()
            if read_versions(spark, table).count():
                break
    finally:
        query.stop()
    found = {r._id for r in read_versions(spark, table).collect()}
    assert found and "before" not in found

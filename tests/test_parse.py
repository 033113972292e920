"""Record projection over ordinary and adversarial lines."""

import datetime as dt
import json

import pytest
from conftest import record
from pyspark.sql import functions as F

from logloom.operators.extensions import (
    apply_extensions,
    load_extension,
    pandas_extension,
    register_extension,
)
from logloom.operators.filters import time_range
from logloom.operators.parse import accepted, parse_access_log, rejected
from logloom.sources.access_log import read_access_log


def parse(lines, **options):
    rows = accepted(parse_access_log(lines, **options)).orderBy("_seq").collect()
    return [r.asDict(recursive=True) for r in rows]


def errors(lines, required=()):
    letters = rejected(parse_access_log(lines), required)
    return {r.value: r.errors for r in letters.collect()}


def test_typed_fields(lines, each_mode):
    (row,) = parse(
        lines(
            record(
                request_time="0.25", gzip_ratio=2, bytes_sent=" 10 ", connection=7,
                request_length="-", connection_requests="", upstream_addr="a:1, b:2 : -",
                upstream_response_time="0.1, - : 0.3", upstream_response_length="1 : 2",
                upstream_connect_time="-", status="200",
            )
        ),
        hostname="web1",
    )
    assert row["@hostname"] == "web1"
    assert row["status"] == 200
    assert (row["request_time"], row["gzip_ratio"], row["bytes_sent"], row["connection"]) == (
        0.25, 2.0, 10, 7,
    )
    assert row["request_length"] is None and row["connection_requests"] is None
    assert row["upstream_addr"] == ["a:1", "b:2"]
    assert row["upstream_response_time"] == [0.1, 0.3]
    assert row["upstream_response_length"] == [1, 2]
    assert row["upstream_connect_time"] is None
    assert row["ts_local"] == dt.datetime(2024, 3, 10, 2, 30)


def test_request_line(lines, each_mode):
    three, two, own, neither = parse(
        lines(
            record(request="GET  /x?q=1\tHTTP/1.1"),
            record(request="GET /x"),
            record(request_uri="/u?v?w=1"),
            record(request="-", request_path="/kept", request_path_1="kept", server_protocol="h2"),
        )
    )
    assert three["request"] is None
    assert (three["request_uri"], three["server_protocol"]) == ("/x?q=1", "HTTP/1.1")
    assert (three["request_path"], three["request_qs"], three["query"]) == ("/x", "q=1", {"q": ["1"]})
    assert two["request"] == "GET /x" and two["request_uri"] is None and two["query"] is None
    assert own["request"] == "GET /a/b HTTP/1.1" and own["request_path"] == "/u?v"
    assert own["server_protocol"] is None
    assert (neither["request_path"], neither["request_path_1"], neither["server_protocol"]) == (
        "/kept", "kept", "h2",
    )
    assert neither["path_segments"] is None


def test_empty_query_is_an_empty_map(lines):
    (row,) = parse(lines(record(request_uri="/x?")))
    assert row["request_qs"] == "" and row["query"] == {}


def test_bad_lines_are_set_aside(lines, each_mode):
    good = json.dumps(record())
    bad = {
        "{bad": ["json"],
        "": ["json"],
        "   ": ["json"],
        "[1]": ["json"],
        f"[{good}]": ["json"],
        "42": ["json"],
        "null": ["json"],
        good + " tail": ["json"],
        good + good: ["json"],
        f"{good},{good}": ["json"],
        good + "}": ["json"],
        good[:-1]: ["json"],
        json.dumps(record(timestamp=None)): ["timestamp"],
        json.dumps(record(timestamp="-")): ["timestamp"],
        json.dumps(record(timestamp="no date")): ["timestamp"],
        json.dumps(record(bytes_sent="12.5")): ["bytes_sent"],
        json.dumps(record(request_time="1d", gzip_ratio="x")): ["request_time", "gzip_ratio"],
        json.dumps(record(upstream_connect_time="0.1, x")): ["upstream_connect_time"],
        json.dumps(record(upstream_response_length="1 : 1.5")): ["upstream_response_length"],
        json.dumps(record(status="ok")): ["status"],
    }
    frame = lines(*bad, good)
    assert errors(frame) == bad
    assert len(parse(frame)) == 1


def test_missing_key_is_rejected_on_request(lines):
    keyless = json.dumps(record(request_id=None))
    assert errors(lines(keyless)) == {}
    assert errors(lines(keyless), ["request_id"]) == {keyless: ["request_id"]}


def test_fail_mode(lines):
    with pytest.raises(Exception, match="bad record"):
        parse_access_log(lines("{bad"), on_error="fail").collect()
    with pytest.raises(ValueError):
        parse_access_log(lines("{}"), on_error="ignore")
    assert len(parse(lines(record()), on_error="fail")) == 1


def test_repeated_keys_last_wins(lines):
    text = json.dumps(record())[:-1] + ', "host": "last", "x": 1, "x": 2}'
    (row,) = parse(lines(text))
    assert row["host"] == "last"
    assert {k: v.toJson() for k, v in row["extra"].items()} == {"x": "2"}


def test_unknown_fields_keep_their_type(lines):
    (row, none) = parse(
        lines(
            record(a=1, b="1", c=True, d=None, e={"f": [1]}, g="-", h="", i=1.5)
            | {"d": None},
            record(),
        )
    )
    assert {k: v.toJson() for k, v in row["extra"].items()} == {
        "a": "1", "b": '"1"', "c": "true", "d": "null", "e": '{"f":[1]}', "i": "1.5",
    }
    assert none["extra"] is None


def test_null_fields_pass(lines):
    text = json.dumps({**record(), "request_time": None, "host": None})
    (row,) = parse(lines(text))
    assert row["request_time"] is None and row["host"] is None


def test_timestamp_parsers(lines):
    clf = record(timestamp="01/Mar/2018:01:30:00 +0300")
    (row,) = parse(lines(clf))
    assert row["ts_local"] == dt.datetime(2018, 3, 1, 1, 30)
    assert errors_of(lines(clf), ts_formats=()) == [["timestamp"]]

    def epoch(raw):
        instant = F.timestamp_seconds(raw.try_cast("double"))
        return instant, F.convert_timezone(F.lit("UTC"), F.lit("UTC"), instant.cast("timestamp_ntz"))

    (row,) = parse(lines(record(timestamp="1519857000")), ts_parser=epoch)
    assert row["@timestamp"].timestamp() == 1519857000


def errors_of(frame, **options):
    return [r.errors for r in rejected(parse_access_log(frame, **options)).collect()]


def test_time_range(lines):
    frame = lines(*[record(timestamp=f"2024-01-01T00:00:0{s}Z") for s in range(4)])
    records = accepted(parse_access_log(frame))

    def seconds(*bounds):
        return [r._seq for r in time_range(records, *bounds).orderBy("_seq").collect()]

    assert seconds("2024-01-01T00:00:01Z", "2024-01-01T00:00:03Z") == [1, 2]
    bound = dt.datetime(2024, 1, 1, 0, 0, 2, tzinfo=dt.timezone.utc)
    assert seconds(bound) == [2, 3]
    assert seconds(None, bound) == [0, 1]
    assert seconds() == [0, 1, 2, 3]


def test_extensions(lines):
    @register_extension("only-errors")
    def only_errors(df):
        return df.where("status >= 500")

    frame = lines(record(status=200), record(status=502, request_id="r2"))
    records = accepted(parse_access_log(frame)).select("request_id", "status")

    def shout(batch):
        batch["request_id"] = batch["request_id"].str.upper()
        return batch

    step = pandas_extension(shout, records.schema)
    found = apply_extensions(records, ["only-errors", step]).collect()
    assert [tuple(r) for r in found] == [("R2", 502)]
    with pytest.raises(ValueError, match="missing"):
        load_extension("missing")


def test_text_source(spark, tmp_path):
    import gzip

    text = "\n".join(json.dumps(record(request_id=f"r{n}")) for n in range(5))
    (tmp_path / "one.json").write_bytes(text.encode() + b"\n" + b'{"bad \xff"')
    with gzip.open(tmp_path / "two.json.gz", "wt") as f:
        f.write(json.dumps(record(request_id="zipped")))
    source = read_access_log(spark, str(tmp_path))
    parsed = parse_access_log(source)
    assert {r.request_id for r in accepted(parsed).collect()} == {
        *(f"r{n}" for n in range(5)), "zipped",
    }
    (letter,) = rejected(parsed).collect()
    assert letter.value == '{"bad �"'
    ordered = source.where("value like '%r_\"%'").orderBy("_seq").collect()
    assert [json.loads(r.value)["request_id"] for r in ordered] == [f"r{n}" for n in range(5)]


def test_white_space_around_a_line(spark, lines):
    good = json.dumps(record())
    texts = [good + end for end in ("", " ", "\t", "\r", "\n", "\r\n ")] + ["\t" + good]
    records = parse_access_log(lines(*texts))
    assert accepted(records).count() == len(texts)
    assert accepted(parse_access_log(lines(good + "\t]", good + "\x0b,"))).count() == 0


def test_unreadable_bound(spark, lines, each_mode):
    records = accepted(parse_access_log(lines(record())))
    with pytest.raises(ValueError, match="junk"):
        time_range(records, "junk")

"""Golden values of every expression, under both ANSI settings."""

import math
import random
from urllib.parse import parse_qs

import pytest
from pyspark.sql import functions as F

from logloom.functions.address import ipv4_number
from logloom.functions.text import WHITESPACE, parse_double, parse_long, split_values, strip
from logloom.functions.time import bucket_start, iso_text, parse_timestamp, strftime
from logloom.functions.traffic import latency_bin, path_label
from logloom.functions.uri import (
    path_part,
    path_segments,
    query_map,
    query_point,
    request_tokens,
    uri_path,
    uri_query,
)


@pytest.fixture
def values(spark):
    def evaluate(expression, inputs, kind="string"):
        rows = spark.createDataFrame(
            [(n, i) for n, i in enumerate(inputs)], f"n int, x {kind}"
        ).select("n", F.expr(expression).alias("y"))
        return [r.y for r in sorted(rows.collect(), key=lambda r: r.n)]

    return evaluate


def test_white_space_is_pythons():
    every = {chr(c) for c in range(0x110000) if chr(c).isspace()}
    assert set(WHITESPACE) == every


def test_strip(values, each_mode):
    texts = [" a\t", " b c ", "", "\x1f"]
    assert values(strip("x"), texts) == [t.strip() for t in texts]


def test_numbers(values, each_mode):
    longs = ["12", " 12 ", "+5", "-7", "12.5", "1e3", "x", "", None, " 8", str(2**70)]
    assert values(parse_long("x"), longs) == [12, 12, 5, -7, None, None, None, None, None, 8, None]
    doubles = ["1.5", ".5", "5.", "1e3", "1d", "1.5f", "0x1p3", "inf", "-Infinity", "x", None, " 2\t"]
    assert values(parse_double("x"), doubles) == [
        1.5, 0.5, 5.0, 1000.0, None, None, None, math.inf, -math.inf, None, None, 2.0,
    ]
    assert math.isnan(values(parse_double("x"), ["nan"])[0])


def test_lists(values, each_mode):
    texts = ["a:1, b:2 : -", "-, -", "a,b", "one", "-", "", None, "\ttab ", "a : : b"]
    assert values(split_values("x"), texts) == [
        ["a:1", "b:2"], None, ["a,b"], ["one"], None, None, None, ["tab"], ["a", ": b"],
    ]
    assert values(split_values("x", parse_long), ["1, 2 : x", "3"]) == [[1, 2, None], [3]]


def test_uri(values, each_mode):
    uris = ["/a?b?c=1", "/x?", "/x", "/p#f?x=1", "?", "", None]
    assert values(uri_path("x"), uris) == ["/a?b", "/x", "/x", "/p#f", "", "", None]
    assert values(uri_query("x"), uris) == ["c=1", "", None, "x=1", "", None, None]


def test_path(values, each_mode):
    paths = ["/a//b/", "http://h/p", "/", "", None]
    assert [
        None if v is None else [(e.n, e.seg) for e in v] for v in values(path_segments("x"), paths)
    ] == [[(1, "a"), (3, "b")], [(0, "http:"), (2, "h"), (3, "p")], None, None, None]
    assert values(path_part("x", 1), paths) == ["a", None, None, None, None]
    assert values(path_part("x", 2), paths) == [None, "h", None, None, None]


def test_request_tokens(values, each_mode):
    assert values(request_tokens("x"), ["GET /x HTTP/1.1", " a\t b ", "one"]) == [
        ["GET", "/x", "HTTP/1.1"], ["a", "b"], ["one"],
    ]


def test_query_golden(values, each_mode):
    cases = {
        "a=1&a=2": {"a": ["1", "2"]},
        "a&b=": {},
        "": {},
        "=x": {"": ["x"]},
        "a=1;b=2": {"a": ["1;b=2"]},
        "a=1=2": {"a": ["1=2"]},
        "a==": {"a": ["="]},
        "a+b=c%2Bd": {"a b": ["c+d"]},
        "a=%&b=%41": {"a": ["%"], "b": ["A"]},
        "a.b=1&a_b=2": {"a_b": ["1"]},
        "a_b=2": {"a_b": ["2"]},
        "a.b.c=1&a.b_c=2": {"a_b_c": ["2"]},
        "x=%E2%82%AC": {"x": ["€"]},
    }
    assert values(query_map("x"), list(cases) + [None]) == [*cases.values(), None]


def model(query):
    """The same rules over the standard library's parser."""
    parsed = parse_qs(query)
    for key in list(parsed):
        if "." in key:
            parsed[key.replace(".", "_")] = parsed.pop(key)
    return parsed


def test_query_random(values):
    rng = random.Random(7)
    alphabet = list("ab._=&&%+41zG;? ") + ["é", "%C3%A9", "%2e", "a.b=1&", "a_b=2&"]
    queries = ["".join(rng.choices(alphabet, k=rng.randint(0, 24))) for _ in range(4000)]
    found = values(query_map("x"), queries)
    wrong = [(q, f, model(q)) for q, f in zip(queries, found) if f != model(q)]
    assert wrong == []


def test_query_point(values, each_mode):
    cases = [
        {"lat": ["1"], "lng": ["2"], "lon": ["3"]},
        {"lat": ["1"], "lon": ["3", "9"]},
        {"lat": ["1"], "lng": ["bad"], "lon": ["3"]},
        {"lat": ["1d"], "lon": ["3"]},
        {"lat": ["1"]},
        None,
    ]
    found = values(query_point("x"), cases, "map<string,array<string>>")
    assert [None if v is None else (v.lat, v.lon) for v in found] == [
        (1.0, 2.0), (1.0, 3.0), None, None, None, None,
    ]


def test_latency_bins(values, each_mode):
    seconds = [0.0, 0.001, 0.795, 1.258, 0.002, -1.0, math.inf, None, 100.0]
    labels = ["0", "1", "1000", "1000", "2", "0", "0", "0", "100000"]
    assert values(latency_bin("x"), seconds, "double") == labels
    millis = [m / 1000 for m in range(1, 3000)]
    expected = [str(int(10 ** (int(math.log10(s) * 10) / 10) * 1000)) for s in millis]
    assert values(latency_bin("x"), millis, "double") == expected


def test_path_label(values, each_mode):
    parts = ["x-123e4567-e89b-12d3-a456-426614174000", "42", "v42", None]
    assert values(path_label("x"), parts) == ["x-<uuid>", "<id>", "v42", "#"]


def test_timestamps(spark, values, each_mode):
    texts = [
        "2018-03-01T01:30:00+03:00",
        "2024-03-10T02:30:00Z",  # a wall clock the session zone skips
        "01/Mar/2018:01:30:00 +0300",
        "-",
        "",
        "yesterday",
        "2018-03-01T01:30:00.25-05:00",
    ]
    instant, wall = parse_timestamp("x", ["dd/MMM/yyyy:HH:mm:ss Z"])
    assert values(f"unix_micros({instant})", texts) == [
        1519857000000000, 1710037800000000, 1519857000000000, None, None, None, 1519885800250000,
    ]
    assert values(f"CAST({wall} AS STRING)", texts) == [
        "2018-03-01 01:30:00", "2024-03-10 02:30:00", "2018-03-01 01:30:00", None, None, None,
        "2018-03-01 01:30:00.25",
    ]
    assert values(iso_text(wall, instant), texts) == [
        "2018-03-01T01:30:00+03:00", "2024-03-10T02:30:00+00:00", "2018-03-01T01:30:00+03:00",
        None, None, None, "2018-03-01T01:30:00.250000-05:00",
    ]
    assert values(bucket_start(instant, 10), ["2018-03-01T00:00:19Z"]) == [1519862410]


def test_date_pattern(spark):
    row = spark.range(1).selectExpr("TIMESTAMP_NTZ'2024-03-10 02:30:09' AS w")
    text = row.select(strftime("w", "nginx-%Y.%m.%d %H%M%S %y %j 100%%").alias("s")).first().s
    assert text == "nginx-2024.03.10 023009 24 070 100%"
    with pytest.raises(ValueError, match="%A"):
        strftime("w", "x-%A")


def test_addresses(values, each_mode):
    texts = ["0.0.0.0", "255.255.255.255", "10.1.2.3", "256.1.1.1", "::1", "a.b.c.d", "1.2.3", None]
    assert values(ipv4_number("x"), texts) == [
        0, 2**32 - 1, 10 * 2**24 + 2**16 + 2 * 256 + 3, None, None, None, None, None,
    ]

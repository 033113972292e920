"""Traffic statistics: rules on missing values, labels, names and plan."""

from conftest import record

from logloom.operators.parse import accepted, parse_access_log
from logloom.operators.stats import http_stats, metric_lines


def metrics(lines, *items, interval=10, prefix="p.h"):
    records = accepted(parse_access_log(lines(*items)))
    return sorted(r.value for r in metric_lines(http_stats(records, interval), prefix).collect())


AT = "2024-01-01T00:00:03Z"
T = 1704067200


def test_sums_counts_and_names(lines, each_mode):
    hit = dict(
        timestamp=AT, host="a.b", request="GET /x.y/42 HTTP/1.1", request_time="0.5",
        upstream_response_time="9, 0.2", bytes_sent=10, upstream_cache_status="HIT",
    )
    later = record(**{**hit, "timestamp": "2024-01-01T00:00:10Z"})
    assert metrics(lines, record(**hit), record(**hit), later) == sorted(
        [
            f"p.h.request_time.sum.a_b.x_y.<id>.200.HIT.501 1.000 {T}",
            f"p.h.request_time.count.a_b.x_y.<id>.200.HIT.501 2 {T}",
            f"p.h.upstream_response_time.sum.a_b.x_y.<id>.200.251 0.400 {T}",
            f"p.h.upstream_response_time.count.a_b.x_y.<id>.200.251 2 {T}",
            f"p.h.bytes_sent.a_b.x_y.<id>.200 20 {T}",
            f"p.h.request_time.sum.a_b.x_y.<id>.200.HIT.501 0.500 {T + 10}",
            f"p.h.request_time.count.a_b.x_y.<id>.200.HIT.501 1 {T + 10}",
            f"p.h.upstream_response_time.sum.a_b.x_y.<id>.200.251 0.200 {T + 10}",
            f"p.h.upstream_response_time.count.a_b.x_y.<id>.200.251 1 {T + 10}",
            f"p.h.bytes_sent.a_b.x_y.<id>.200 10 {T + 10}",
        ]
    )


def test_missing_values(lines, each_mode):
    bare = record(timestamp=AT, request="-")
    assert metrics(lines, bare) == sorted(
        [
            f"p.h.request_time.sum.example_com.#.#.200.NONE.0 0.000 {T}",
            f"p.h.request_time.count.example_com.#.#.200.NONE.0 0 {T}",
            f"p.h.bytes_sent.example_com.#.#.200 0 {T}",
        ]
    )


def test_rows_that_do_not_count(lines):
    assert metrics(
        lines,
        record(status=0),
        record(status="0"),
        record(host="-"),
        record(host=None),
        record(status=None),
        "{bad",
    ) == []


def test_keyless_records_count(lines):
    assert len(metrics(lines, record(request_id=None))) == 3


def test_not_a_number_is_missing(lines):
    (count, *_) = [m for m in metrics(lines, record(request_time="nan")) if ".count." in m]
    assert count.split()[1] == "0"


def test_names_that_meet_stay_apart(lines):
    found = metrics(lines, record(host="a.b", bytes_sent=1), record(host="a_b", bytes_sent=2))
    assert [m.split()[1] for m in found if ".bytes_sent." in m] == ["1", "2"]


def test_one_pass_and_one_shuffle(lines):
    stats = http_stats(accepted(parse_access_log(lines(record()).repartition(3))), 10)
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("from_json(") == 1
    assert plan.count("partial_sum") == 1
    assert "variant" not in plan.lower()

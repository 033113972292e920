"""Range lookup against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from logloom.operators.geo import RangeLookup, geoip_join, load_ranges


def number(address):
    a, b, c, d = map(int, address.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


def text(n):
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


def make(seed):
    """Disjoint ranges from one address to many buckets wide, and addresses of
    which a third share one bucket."""
    rng = random.Random(seed)
    cuts = sorted(rng.sample(range(2**32), 60) + [number("10.7.0.0") + i * 40 for i in range(60)])
    ranges = [
        (lo, hi - 1 - rng.randint(0, (hi - lo) // 3), float(i), -float(i), f"c{i}", f"r{i % 5}")
        for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))
        if hi - lo > 1 and rng.random() < 0.8
    ]
    addresses = [text(rng.randrange(2**32)) for _ in range(300)]
    addresses += [f"10.7.{rng.randint(0, 20)}.{rng.randint(0, 255)}" for _ in range(250)]
    addresses += [text(e) for lo, hi, *_ in ranges for e in (lo, hi, max(lo - 1, 0), min(hi + 1, 2**32 - 1))]
    addresses += ["10.7.1.1"] * 200 + [None, "::1", "host", "-"] * 20
    return ranges, addresses


def brute(ranges, address):
    try:
        n = number(address)
    except (ValueError, AttributeError):
        return None
    return next((c for lo, hi, _, _, c, _ in ranges if lo <= n <= hi), None)


@pytest.mark.parametrize("options", [{}, {"bucket_bits": 20}, {"broadcast_bytes": -1}])
def test_matches_brute_force(spark, options):
    ranges, addresses = make(3)
    table = spark.createDataFrame(
        ranges, "lo bigint, hi bigint, lat double, lon double, city string, region_name string"
    )
    records = spark.createDataFrame(list(enumerate(addresses)), "n int, remote_addr string")
    joined = geoip_join(records.repartition(3), table, **options)
    found = {r.n: r for r in joined.collect()}
    assert joined.count() == len(addresses) == len(found)
    for n, address in enumerate(addresses):
        city = brute(ranges, address)
        assert found[n].city == city, address
        if city is None:
            assert found[n].geoip is None and found[n].region_name is None
        else:
            i = float(city[1:])
            assert (found[n].geoip.lat, found[n].geoip.lon) == (i, -i)


def test_plans(spark):
    ranges, addresses = make(4)
    table = spark.createDataFrame(
        ranges, "lo bigint, hi bigint, lat double, lon double, city string, region_name string"
    )
    records = spark.createDataFrame([(a,) for a in addresses], "remote_addr string")
    small = geoip_join(records, table)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in small and "NestedLoop" not in small and "Cartesian" not in small
    assert "Exchange hashpartitioning" not in small
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = geoip_join(records.repartition(3), table, broadcast_bytes=-1)
        large = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "NestedLoop" not in large and "Cartesian" not in large
    # Addresses become one row each before they are shuffled, and records are joined by them alone.
    assert "HashAggregate(keys=[_address" in large and "LeftOuter" in large
    assert "SortMergeJoin [_key" in large


def test_one_measurement_serves_many_batches(spark):
    ranges, addresses = make(5)
    table = spark.createDataFrame(
        ranges, "lo bigint, hi bigint, lat double, lon double, city string, region_name string"
    )
    for size in (-1, 1 << 20):
        lookup = RangeLookup(table, size)
        for part in (addresses[:200], addresses[200:], []):
            records = spark.createDataFrame([(a,) for a in part], "remote_addr string")
            found = lookup.join(records, few=True).select("remote_addr", "city").collect()
            assert sorted(map(str, found)) == sorted(
                str(r) for r in spark.createDataFrame([(a, brute(ranges, a)) for a in part], "remote_addr string, city string").collect()
            )


def test_a_large_table_needs_bounded_records(spark, tmp_path):
    (tmp_path / "log").mkdir()
    stream = spark.readStream.schema("remote_addr string").json(str(tmp_path / "log"))
    table = spark.createDataFrame([(1, 2, 0.0, 0.0, "c", "r")], "lo bigint, hi bigint, lat double, lon double, city string, region_name string")
    assert geoip_join(stream, table).isStreaming
    with pytest.raises(ValueError, match="micro-batch"):
        geoip_join(stream, table, broadcast_bytes=-1)


def test_absent_ranges(spark, tmp_path):
    records = spark.createDataFrame([("10.0.0.1",)], "remote_addr string")
    assert load_ranges(spark, None) is None
    assert load_ranges(spark, str(tmp_path / "none")) is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_ranges(spark, str(tmp_path / "none"), explicit=True)
    row = geoip_join(records, None).select("remote_addr", F.col("geoip.lat"), "city").first()
    assert tuple(row) == ("10.0.0.1", None, None)
    empty = spark.createDataFrame(
        [], "lo bigint, hi bigint, lat double, lon double, city string, region_name string"
    )
    assert geoip_join(records, empty).first().city is None

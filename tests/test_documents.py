"""Keys, routing, idempotent writes and JSON lines."""

import json

import pytest
from conftest import record
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.operators.documents import (
    append_documents,
    compact_dates,
    compact_documents,
    dates_to_compact,
    index_range,
    json_lines,
    latest_documents,
    read_documents,
    read_letters,
    read_versions,
    to_documents,
    to_envelope,
    upsert_documents,
)
from logloom.operators.parse import accepted, parse_access_log
from logloom.plans.jobs import dump_log, index_log, indexed, measure_log, records_in_range
from logloom.schema import DOCUMENT_SCHEMA, ensure_table, load_schema, refresh_table
from logloom.sources.access_log import read_access_log


def documents(frame, **options):
    return to_documents(accepted(parse_access_log(frame, **options)))


def test_routes_by_the_records_own_date(lines):
    found = documents(
        lines(
            record(timestamp="2018-03-01T01:30:00+03:00"),
            record(timestamp="2018-02-28T23:30:00-05:00"),
            record(request_id=None),
        )
    )
    assert sorted(r._index for r in found.collect()) == ["nginx-2018.02.28", "nginx-2018.03.01"]


def test_json_lines_are_flat(lines):
    source = record(
        request="GET /a//c/d?x.y=1&lat=1&lon=2 HTTP/1.1", timestamp="2018-03-01T01:30:00.5+03:00",
        bytes_sent="7", tag="t", n=3, flag=False, nested={"k": [1]}, request_path_3="old",
        request_path_9="kept", query="old",
    )
    (line,) = json_lines(documents(lines(source), hostname="web1").drop("_seq"), "kind").collect()
    assert json.loads(line.value) == {
        "_id": "r1",
        "_index": "nginx-2018.03.01",
        "_type": "kind",
        "_source": {
            "@timestamp": "2018-03-01T01:30:00.500000+03:00",
            "@hostname": "web1",
            "host": "example.com",
            "request_uri": "/a//c/d?x.y=1&lat=1&lon=2",
            "server_protocol": "HTTP/1.1",
            "request_path": "/a//c/d",
            "request_qs": "x.y=1&lat=1&lon=2",
            "status": 200,
            "query": {"x_y": ["1"], "lat": ["1"], "lon": ["2"]},
            "query_geo": {"lat": 1.0, "lon": 2.0},
            "bytes_sent": 7,
            "request_path_1": "a",
            "request_path_3": "c",
            "request_path_4": "d",
            "request_path_9": "kept",
            "tag": "t",
            "n": 3,
            "flag": False,
            "nested": {"k": [1]},
        },
    }
    (bare,) = json_lines(documents(lines(record(request="-"))).drop("_seq")).collect()
    assert set(json.loads(bare.value)["_source"]) == {"@timestamp", "host", "status"}


def test_envelope(lines):
    row = to_envelope(documents(lines(record()))).first()
    assert (row._id, row._index, row._type) == ("r1", "nginx-2024.03.10", "access_log")
    assert row._source.host == "example.com"
    assert "_id" not in row._source and "request_id" not in row._source


def test_latest_wins_and_hot_keys_shrink_before_the_shuffle(lines, spark):
    copies = [record(host=f"h{n}") for n in range(50)] + [record(request_id="r2", host="x")]
    found = latest_documents(documents(lines(*copies).repartition(3)))
    assert {(r._id, r.host) for r in found.collect()} == {("r1", "h49"), ("r2", "x")}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window ") < plan.index("Exchange hashpartitioning") < plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning"))


def test_settled_reads_are_pruned(spark, lines, tmp_path):
    path = str(tmp_path / "docs")
    append_documents(documents(lines(record(), record(host="b"))), path, "1")
    found = read_documents(spark, path).select("_id", "host")
    assert [(r._id, r.host) for r in found.collect()] == [("r1", "b")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<_seq:bigint,_id:string,host:string>" in plan


def test_upsert_is_idempotent(spark, lines, tmp_path):
    path = str(tmp_path / "docs")
    first = documents(lines(record(host="old"), record(request_id="r2")))
    schema = first.schema
    upsert_documents(spark, first, path, "1")
    newer = documents(lines(record(host="new"))).withColumn("_seq", F.col("_seq") + 10)
    once = upsert_documents(spark, newer, path, "2")
    assert {(r._id, r.host) for r in once.collect()} == {("r1", "new"), ("r2", "example.com")}
    again = upsert_documents(spark, newer, path, "2")
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))
    assert read_versions(spark, path, schema).count() == 3
    # An older delivery that arrives late does not win.
    late = upsert_documents(spark, first, path, "3")
    assert {(r._id, r.host) for r in late.collect()} == {("r1", "new"), ("r2", "example.com")}
    compact_documents(spark, path, str(tmp_path / "compact"), schema)
    compacted = read_versions(spark, str(tmp_path / "compact"), schema)
    assert compacted.count() == 2
    assert read_documents(spark, str(tmp_path / "nothing")).count() == 0


def test_reads_prune_partitions(spark, lines, tmp_path):
    path = str(tmp_path / "docs")
    days = [record(timestamp=f"2024-01-{d:02}T12:00:00Z", request_id=f"r{d}") for d in range(1, 29)]
    incoming = documents(lines(*days))
    append_documents(incoming, path, "1")
    found = read_documents(
        spark, path, incoming.schema,
        min_timestamp="2024-01-10T00:00:00Z", max_timestamp="2024-01-12T00:00:00Z",
    )
    assert {r._id for r in found.collect()} == {f"r{d}" for d in range(8, 15)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_index" in plan
    # Only the folders of the range are listed.
    listed = {f.split("_index=")[1].split("/")[0] for f in found.inputFiles()}
    assert listed == {f"nginx-2024.01.{d:02}" for d in range(8, 15)}
    one = read_documents(spark, path, index="nginx-2024.01.03")
    assert [r._id for r in one.collect()] == ["r3"] and len(one.inputFiles()) == 1
    assert read_documents(spark, path, index=[]).count() == read_documents(spark, path, index="nothing").count() == 0
    assert read_documents(spark, path, min_timestamp="2024-01-20T00:00:00Z").count() == 11
    assert index_range("%d.%m.%Y", "2024-01-10", None) == (None, None)
    assert index_range("x-%Y%m%d", None, "2024-01-10T00:00:00") == (None, "x-20240112")
    hourly = documents(lines(record(timestamp="2024-01-10T07:00:00Z"))).withColumn("_index", F.lit("x-2024.01.10.07"))
    append_documents(hourly, str(tmp_path / "hours"), "1")
    bounds = {"min_timestamp": "2024-01-10T00:00:00Z", "max_timestamp": "2024-01-11T00:00:00Z"}
    assert read_documents(spark, str(tmp_path / "hours"), pattern="x-%Y.%m.%d.%H", **bounds).count() == 1


def test_a_batch_replaces_itself_on_all_dates(spark, lines, tmp_path):
    path = str(tmp_path / "docs")
    days = [record(timestamp=f"2024-01-0{d}T12:00:00Z", request_id=f"r{d}") for d in range(1, 5)]
    append_documents(documents(lines(*days)), path, "a:b{1}")
    append_documents(documents(lines(days[0])), path, "other")
    append_documents(documents(lines(*days[1:3])), path, "a:b{1}")
    assert sorted((r._id, r.batch) for r in read_versions(spark, path).collect()) == [
        ("r1", "other"), ("r2", "a:b{1}"), ("r3", "a:b{1}"),
    ]
    append_documents(documents(lines()), path, "a:b{1}")
    assert [r._id for r in read_versions(spark, path).collect()] == ["r1"]


def test_a_task_writes_no_file_for_each_date(spark, lines, tmp_path):
    path = str(tmp_path / "docs")
    days = [record(timestamp=f"2024-01-{d:02}T12:00:00Z", request_id=f"r{d}.{n}") for n in range(20) for d in (1, 2, 3)]
    append_documents(documents(lines(*days).repartition(6)), path, "1")
    assert len(spark.read.parquet(path).inputFiles()) == 3


def test_dates_are_compacted_beside_writers(spark, lines, tmp_path):
    path = str(tmp_path / "docs")

    def add(batch, *rows):
        append_documents(documents(lines(*rows)).withColumn("_seq", F.lit(int(batch)).cast("bigint")), path, batch)

    def day(d, key, host):
        return record(timestamp=f"2024-01-0{d}T12:00:00Z", request_id=key, host=host)

    add("1", day(1, "a", "old"), day(1, "b", "x"), day(2, "a", "x"))
    add("2", day(1, "a", "new"))
    assert dates_to_compact(spark, path) == ["nginx-2024.01.01"]
    before = sorted(map(str, read_documents(spark, path).collect()))
    sources = compact_dates(spark, path, dates_to_compact(spark, path), keep_sources=True)
    # A batch that came while the dates were settled, and a replay of one that is in them.
    add("3", day(1, "c", "x"))
    for source in sources:
        assert spark.read.parquet(source).count() > 0
    assert sorted(map(str, read_documents(spark, path).where("_id != 'c'").collect())) == before
    compact_dates(spark, path, dates_to_compact(spark, path))
    add("2", day(1, "a", "new"))
    current = {(r._id, r.host) for r in read_documents(spark, path, index="nginx-2024.01.01").collect()}
    assert current == {("a", "new"), ("b", "x"), ("c", "x")}
    compact_dates(spark, path, dates_to_compact(spark, path))
    assert dates_to_compact(spark, path) == [] and read_versions(spark, path).count() == 4
    assert {(r._id, r.host) for r in read_versions(spark, path, index="nginx-2024.01.01").collect()} == current
    assert compact_dates(spark, path, ["nothing"]) == []


def test_columns_of_extensions_stay_with_the_table(spark, lines, tmp_path):
    path, target = str(tmp_path / "docs"), str(tmp_path / "settled")
    plain = documents(lines(record(request_id="p", slow="text", n=1)))
    added = documents(lines(record(slow="text", n=1))).withColumn("slow", F.lit(True)).withColumn("at", F.struct(F.lit(1).alias("x")))
    append_documents(plain, path, "1")
    append_documents(added, path, "2")
    compact_dates(spark, path, dates_to_compact(spark, path))
    compact_documents(spark, path, target)
    for place in (path, target):
        found = {r._id: r for r in read_documents(spark, place).collect()}
        assert (found["r1"].slow, found["r1"]["at"].x, found["p"].slow) == (True, 1, None)
        body = {k: json.loads(r.value)["_source"] for r in json_lines(read_documents(spark, place)).collect() for k in [json.loads(r.value)["_id"]]}
        # The column wins over the field of the line, as the extension has replaced it.
        assert (body["r1"]["slow"], body["r1"]["at"], body["r1"]["n"]) == (True, {"x": 1}, 1)
        assert body["p"]["slow"] == "text" and "at" not in body["p"]
    with pytest.raises(ValueError, match="slow"):
        compact_documents(spark, path, str(tmp_path / "less"), DOCUMENT_SCHEMA)
    with pytest.raises(ValueError, match="slow"):
        append_documents(plain.withColumn("slow", F.lit(1)), path, "3")


def test_table_declaration(spark, tmp_path):
    place = str(tmp_path / "table")
    table = ensure_table(spark, "docs_a", place)
    assert table.schema.fieldNames() == DOCUMENT_SCHEMA.fieldNames()
    own = T.StructType(
        [T.StructField(c, T.StringType()) for c in ("_id", "host", "_index", "batch")]
    )
    own = load_schema(own.json())
    assert ensure_table(spark, "docs_a", place, own).schema.fieldNames() == DOCUMENT_SCHEMA.fieldNames()
    assert ensure_table(spark, "docs_a", place, own, force=True).schema.fieldNames() == own.fieldNames()
    spark.sql("DROP TABLE docs_a")


def test_whole_jobs(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    rows = [record(request_id=f"r{n}", timestamp=f"2024-01-01T00:00:{n:02}Z", bytes_sent=n) for n in range(30)]
    (log / "a.json").write_text("\n".join(map(json.dumps, rows)) + "\n{bad\n" + json.dumps(record(request_id=None)))
    lines = read_access_log(spark, str(log))
    path, rejects, dump = (str(tmp_path / n) for n in ("docs", "rejects", "dump"))
    index_log(spark, lines, path, "1", rejects, hostname="w", min_timestamp="2024-01-01T00:00:10Z", max_timestamp="2024-01-01T00:00:20Z")
    found = read_documents(spark, path)
    assert {r._id for r in found.collect()} == {f"r{n}" for n in range(10, 20)}
    assert sorted(r.errors[0] for r in spark.read.json(rejects).collect()) == ["json", "request_id"]
    dump_log(lines, dump, hostname="w", max_timestamp="2024-01-01T00:00:05Z")
    assert spark.read.text(dump).count() == 5
    # Statistics of the written table and of the log agree.
    ensure_table(spark, "docs_b", path)
    from_table = measure_log(refresh_table(spark, "docs_b"), "p")
    from_log = measure_log(
        records_in_range(lines, min_timestamp="2024-01-01T00:00:10Z", max_timestamp="2024-01-01T00:00:20Z"), "p"
    )
    assert sorted(r.value for r in from_table.collect()) == sorted(r.value for r in from_log.collect())
    assert from_table.count() > 0
    spark.sql("DROP TABLE docs_b")


def test_documents_and_letters_in_one_write(spark, lines, tmp_path):
    rows = [record(request_id=f"r{d}", timestamp=f"2024-01-0{d}T12:00:00Z") for d in range(1, 5)]
    source = lines(*rows, "{bad", record(request_id=None), record(status="x", request_id="s"), record(timestamp="-"))
    bad = {("{bad", ("json",)), (json.dumps(record(request_id=None)), ("request_id",)),
           (json.dumps(record(status="x", request_id="s")), ("status",)), (json.dumps(record(timestamp="-")), ("timestamp",))}
    bounds = {"min_timestamp": "2024-01-02T00:00:00Z", "max_timestamp": "2024-01-04T00:00:00Z"}

    def mark(df):
        return df.withColumn("slow", F.lit(True))

    for n, extensions in enumerate(([], [mark])):
        path = str(tmp_path / f"docs{n}")
        plan = indexed(source, extensions=extensions, **bounds)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan") == 1 + n
        index_log(spark, source, path, "1", rejects=True, extensions=extensions, **bounds)
        index_log(spark, source, path, "1", rejects=True, extensions=extensions, **bounds)
        assert {r._id for r in read_documents(spark, path).collect()} == {"r2", "r3"}
        letters = read_letters(spark, path).collect()
        assert {(r.value, tuple(r.errors)) for r in letters} == bad and len(letters) == 4
        index_log(spark, source, path, "2", rejects=True, extensions=extensions)
        assert read_versions(spark, path).count() == 6 and read_letters(spark, path).count() == 8
        assert dates_to_compact(spark, path) == ["nginx-2024.01.02", "nginx-2024.01.03"]
        assert not {"_line", "_errors"} & set(read_documents(spark, path).columns)
    assert read_letters(spark, str(tmp_path / "nothing")).count() == 0


def test_sequence_is_required_to_be_comparable(lines):
    with pytest.raises(Exception):
        latest_documents(documents(lines(record())), sequence="query").collect()

"""The JSON form of documents with many unknown fields."""

import json

from conftest import record
from pyspark.sql import functions as F

from logloom.operators.documents import json_lines, to_documents
from logloom.operators.parse import accepted, parse_access_log


def _documents(frame):
    return to_documents(accepted(parse_access_log(frame))).drop("_seq")


def test_path_components_are_not_built_again_for_each_unknown_field(lines, capsys):
    json_lines(_documents(lines(record()))).explain("extended")
    analyzed = capsys.readouterr().out.split("== Optimized")[0]
    assert "map_concat(" in analyzed and "map_contains_key(map_concat(" not in analyzed


def test_unknown_fields_give_way_to_path_components_and_columns(lines):
    plain = record(request_id="a", request="GET /x/y/z HTTP/1.1", one="1", two=[2], three={"é}{": "}"})
    clash = record(request_id="b", request="GET /x/y/z HTTP/1.1", request_path_3="own", one="1", slow="given")
    none = record(request_id="c")
    found = _documents(lines(plain, clash, none)).withColumn("slow", F.expr("IF(_id = 'b', 'set', NULL)"))
    body = {d["_id"]: d["_source"] for d in map(json.loads, (r.value for r in json_lines(found).collect()))}
    assert body["a"]["request_path_3"] == "z" and body["a"]["two"] == [2] and body["a"]["three"] == {"é}{": "}"}
    assert body["b"]["request_path_3"] == "z" and body["b"]["slow"] == "set" and body["b"]["one"] == "1"
    assert "one" not in body["c"] and "slow" not in body["c"]

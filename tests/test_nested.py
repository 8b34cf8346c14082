import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rosterlake.operators import nested

SPOOL = "spool_seq long, resource_type string, resource_id string, body string, spooled_at timestamp"


def spool(spark, bodies):
    data = [(i, "T", f"r{i}" if not isinstance(b, tuple) else b[0], b if not isinstance(b, tuple) else b[1]) for i, b in enumerate(bodies)]
    return spark.createDataFrame(data, "spool_seq long, resource_type string, resource_id string, body string").withColumn("spooled_at", F.timestamp_seconds("spool_seq"))


def found(spark, bodies):
    return rows(nested.spool_children(spool(spark, bodies)), "parent_id", "child_path", "child_pos")


def test_positions_and_nulls(spark):
    body = json.dumps({"resourceType": "T", "a": [{"b": [None, {"c": [{"d": 1}, 5]}]}, None, "x", {"b": []}]})
    assert found(spark, [body]) == [("r0", "a", "0"), ("r0", "a", "3"), ("r0", "a.b", "0.1"), ("r0", "a.b.c", "0.1.0")]


def test_lone_object_counts_where_the_name_holds_arrays_elsewhere(spark):
    lone, many = json.dumps({"resourceType": "T", "a": {"z": 1}, "o": {"a": {"z": 2}}, "p": {"q": 1}}), json.dumps({"resourceType": "T", "a": [{"z": 1}]})
    assert found(spark, [lone, many]) == [("r0", "a", "0"), ("r0", "o.a", "0"), ("r1", "a", "0")]
    assert found(spark, [lone]) == []


def test_wrapped_bodies_and_unreadable_ones(spark):
    inner = json.dumps({"resourceType": "T", "a": [{"b": 1}]})
    bodies = ["﻿​ " + inner, json.dumps(inner), json.dumps({"fullUrl": "u", "resource": json.loads(inner)}), json.dumps({"resource": inner}), inner[:-3], "<html>", "", None, inner + " x", inner.replace(":", "=")]
    assert [r[0] for r in found(spark, bodies)] == ["r0", "r1", "r2", "r3"]


def test_latest_readable_counts_and_null_ids_do_not(spark):
    new, old = json.dumps({"resourceType": "T", "a": [{}, {}]}), json.dumps({"resourceType": "T", "a": [{}]})
    assert found(spark, [("x", old), ("x", new), ("x", new[:-2]), (None, new), ("", new)]) == [("x", "a", "0"), ("x", "a", "1")]


def test_array_in_array_and_any_depth(spark):
    assert found(spark, [json.dumps({"resourceType": "T", "a": [[{"b": 1}], []]})]) == [("r0", "a", "0.0")]
    deep = {"resourceType": "T", "q": "]}{ in \" a text [{"}
    at = deep
    for n in range(16):
        at["n"] = {} if n < 15 else [{"x": 1}]
        at = at["n"]
    shallow = json.dumps({"resourceType": "T", "a": [{"b": 1}]})
    path = ".".join(["n"] * 16)
    got = found(spark, [json.dumps(deep), shallow])
    assert ("r0", path, ".".join(["0"] * 16)) in got and ("r1", "a", "0") in got and len(got) == 17
    records = nested.json_records(spool(spark, [shallow]), "body").where("record is not null")
    with pytest.raises(Exception, match="nested deeper"):
        nested.json_children(records, [F.col("resource_id")], "record", ["a"], 1).collect()


def test_empty_spool(spark):
    assert found(spark, []) == []


def test_typed_children_and_tables(spark):
    df = spark.sql("""SELECT 1L AS id, array(struct('p' AS pos, array(struct('h' AS x), null) AS hours), null) AS places, cast(null AS array<struct<y:int>>) AS none, array(1, 2) AS plain
      UNION ALL SELECT 2L, array(), array(), array()""")
    assert rows(nested.typed_children(df, F.col("id"), "T")) == [("T", "1", "places", "0"), ("T", "1", "places.hours", "0.0")]
    tables = nested.child_tables(df, "id")
    assert set(tables) == {"", "places", "places.hours", "none"}
    assert rows(tables["places"]) == [("1", "0", None, "p")] and tables["places"].columns[3] == "item_pos"
    assert rows(tables["places.hours"]) == [("1", "0.0", "0", "h")]
    assert tables[""].count() == 2 and tables["none"].count() == 0

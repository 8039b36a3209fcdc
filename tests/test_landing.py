"""Landed JSON -> bronze: every key kept, coordinates in any form, both file layouts, bad input."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import types as T

from snapflow.operators.flatten import flatten_structs, normalize_pair
from snapflow.schemas import BRONZE
from snapflow.sources.lake import read_bronze
from snapflow.sources.landing import LandingError, read_landed_json, to_bronze
from snapflow.sources.sinks import append_snapshot

TS = dt.datetime(2023, 11, 9, 17, 42, 30)
POINT = {"lat": 50.25, "lon": -3.5}
NESTED = {"stationcode": "n1", "capacity": 12, "coordonnees_geo": POINT}
FLAT = {"stationcode": "f1", "capacity": 12, "coordonnees_geo.lat": 50.25, "coordonnees_geo.lon": -3.5}


def land(tmp_root, payload):
    path = os.path.join(tmp_root, f"feed-{len(os.listdir(tmp_root))}.json")
    with open(path, "w") as f:
        f.write(payload if isinstance(payload, str) else json.dumps(payload))
    return path


def bronze(spark, tmp_root, payload, layout="array"):
    return to_bronze(read_landed_json(spark, land(tmp_root, payload), layout), TS)


def places(df):
    return {r["stationcode"]: (r["coordonnees_geo.lat"], r["coordonnees_geo.lon"]) for r in df.collect()}


def test_nested_and_flat_coordinates_give_equal_rows(spark, tmp_root):
    nested = bronze(spark, tmp_root, [NESTED]).drop("stationcode")
    flat = bronze(spark, tmp_root, [FLAT]).drop("stationcode")
    assert nested.columns == flat.columns and nested.collect() == flat.collect()
    assert "coordonnees_geo" not in nested.columns


def test_both_forms_in_one_file(spark, tmp_root):
    got = places(bronze(spark, tmp_root, [NESTED, FLAT, {"stationcode": "none"}]))
    assert got == {"n1": (50.25, -3.5), "f1": (50.25, -3.5), "none": (None, None)}


def test_objects_next_to_other_values(spark, tmp_root):
    rows = [NESTED, {"stationcode": "t", "coordonnees_geo": "unknown"}, {"stationcode": "z", "coordonnees_geo": None}]
    assert places(bronze(spark, tmp_root, rows)) == {"n1": (50.25, -3.5), "t": (None, None), "z": (None, None)}


def test_one_stamp_for_the_batch(spark, tmp_root):
    rows = bronze(spark, tmp_root, [NESTED, FLAT]).select("ingested_at", "date").distinct().collect()
    assert [tuple(r) for r in rows] == [(TS, TS.date())]


def test_undeclared_keys_reach_stored_bronze(spark, tmp_root):
    first = [NESTED | {"kiosk": True, "operator": {"name": "velo", "zone": {"id": 7}}, "tags": ["a", "b"]}]
    later = [FLAT | {"kiosk": "broken", "note": 3.5}]
    root = os.path.join(tmp_root, "bronze")
    for k, payload in enumerate((first, later)):
        append_snapshot(bronze(spark, tmp_root, payload), root, file_stem=f"10-0{k}-00", staging_root=os.path.join(tmp_root, "s"))
    extra = ["kiosk", "operator.name", "operator.zone.id", "tags", "note"]
    got = {r["stationcode"]: tuple(r[c] for c in extra) for r in read_bronze(spark, root, extra).collect()}
    assert got == {"n1": ("true", "velo", "7", '["a","b"]', None), "f1": ("broken", None, None, None, "3.5")}
    assert read_bronze(spark, root).columns == BRONZE.fieldNames()


def test_declared_types(spark, tmp_root):
    df = bronze(spark, tmp_root, [NESTED])
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in BRONZE.fields]
    (r,) = df.collect()
    assert r["capacity"] == 12 and r["duedate"] is None


def test_lines_layout_reads_every_line(spark, tmp_root):
    text = "\n".join(json.dumps(NESTED | {"stationcode": f"s{i}"}) for i in range(5))
    assert bronze(spark, tmp_root, text, layout="lines").count() == 5


def test_lines_read_as_array_fail_loudly(spark, tmp_root):
    for text in ("\n".join(json.dumps(NESTED) for _ in range(5)), json.dumps([NESTED]) + json.dumps([FLAT])):
        with pytest.raises(LandingError):
            read_landed_json(spark, land(tmp_root, text))


def test_single_record_is_an_array_of_one(spark, tmp_root):
    assert bronze(spark, tmp_root, NESTED).count() == 1


@pytest.mark.parametrize("text", ["[{not json", "[] trailing"])
def test_malformed_input_fails(spark, tmp_root, text):
    with pytest.raises(Exception):
        read_landed_json(spark, land(tmp_root, text)).collect()


@pytest.mark.parametrize("text", [" ", "3", "[1]", "[null]", '{"a":1}] rest', '{"a":1},0] rest', '{"a":1},{"a":2}', '[[{"a":1}]]', '{"a":1,"a":2}'])
def test_other_than_one_value_of_records_fails(spark, tmp_root, text):
    with pytest.raises(LandingError):
        read_landed_json(spark, land(tmp_root, text))


def test_line_with_two_values_fails_and_blank_lines_do_not_count(spark, tmp_root):
    with pytest.raises(LandingError):
        read_landed_json(spark, land(tmp_root, '{"a":1}\n{"a":2} {"a":3}\n'), "lines")
    rows = read_landed_json(spark, land(tmp_root, '{"a":1}\n\n  \t\n{"a":2}\n'), "lines")
    assert sorted(r["a"] for r in rows.collect()) == [1, 2]


def test_values_keep_their_kind(spark, tmp_root):
    records = [
        {"n": 3, "x": 1.5, "b": True, "s": "7", "never": None, "tags": [1, 2], "o": {"OBJECT<a": 1, "void": None}, "mixed": 4},
        {"n": 2**40, "x": 2, "b": False, "s": "x", "never": None, "tags": [], "o": {"OBJECT<a": 2}, "mixed": {"k": [1]}},
    ]
    df = read_landed_json(spark, land(tmp_root, "\n " + json.dumps(records, indent=1)))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert (kinds["n"], kinds["b"], kinds["s"], kinds["never"], kinds["tags"], kinds["mixed"]) == (
        "bigint", "boolean", "string", "string", "array<bigint>", "variant")
    assert "OBJECT<a" in df.schema["o"].dataType.fieldNames()
    got = sorted(df.selectExpr("n", "double(x) x", "b", "s", "tags", "o.`OBJECT<a` a", "string(mixed) mixed").collect(), key=lambda r: r["n"])
    assert [tuple(r) for r in got] == [(3, 1.5, True, "7", [1, 2], 1, "4"), (2**40, 2.0, False, "x", [], 2, '{"k":[1]}')]
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_no_records(spark, tmp_root):
    for text in ("", "[]", "[{}]"):
        df = bronze(spark, tmp_root, text)
        assert df.columns == BRONZE.fieldNames() and df.count() == (text == "[{}]")


def test_unknown_layout(spark, tmp_root):
    with pytest.raises(ValueError):
        read_landed_json(spark, land(tmp_root, [NESTED]), "csv")


def test_flat_input_unchanged(spark):
    df = spark.createDataFrame([("x", 1.0, 2.0)], "stationcode string, `coordonnees_geo.lat` double, `coordonnees_geo.lon` double")
    out = normalize_pair(df, "coordonnees_geo", ("lat", "lon"))
    assert out.columns == df.columns and out.collect() == df.collect()


def test_flatten_keeps_arrays_and_drops_parent(spark):
    schema = T.StructType([
        T.StructField("a", T.StructType([T.StructField("b", T.LongType()), T.StructField("c", T.StructType([T.StructField("d", T.StringType())]))])),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ])
    df = spark.createDataFrame([((1, ("x",)), ["t"]), (None, None)], schema)
    out = flatten_structs(df)
    assert out.columns == ["a.b", "a.c.d", "tags"]
    assert [tuple(r) for r in out.collect()] == [(1, "x", ["t"]), (None, None, None)]

"""Flattening and alignment of JSON records."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from formtide.operators import records, reshape
from formtide.operators.profile import type_sets


def leaves_of(node, path="", sep="_"):
    out = {}
    if isinstance(node, dict):
        for key, child in node.items():
            out.update(leaves_of(child, f"{path}{sep}{key}" if path else key, sep))
    elif isinstance(node, list):
        for i, child in enumerate(node):
            out.update(leaves_of(child, f"{path}{sep}{i}", sep))
    elif path:
        out[path] = node
    return out


def random_node(rng, depth):
    kind = rng.random()
    if depth and kind < 0.35:
        return {f"k{rng.randrange(100)}": random_node(rng, depth - 1) for _ in range(rng.randrange(4))}
    if depth and kind < 0.6:
        return [random_node(rng, depth - 1) for _ in range(rng.randrange(4))]
    return rng.choice([None, True, False, rng.randrange(10**6), rng.random(), "x", "é \"q\" \\", "", 2.0, -1])


def text_of(value):
    return None if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def frame(spark, documents):
    return spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "id int, doc string")


def collected(leaves, n):
    got = [{} for _ in range(n)]
    for row in leaves.collect():
        assert row.path not in got[row.id], "one leaf per path"
        got[row.id][row.path] = row.value
    return got


def test_random_documents_of_any_depth(spark):
    rng = random.Random(7)
    nodes = [random_node(rng, rng.choice([3, 6, 14])) for _ in range(300)]
    deep = 5
    for _ in range(20):
        deep = {"k": [deep, None, "s"], "e": {}, "n": 1.5, "b": True}
    nodes.append(deep)
    leaves = records.flatten_json(frame(spark, map(json.dumps, nodes)), "doc")
    got = collected(leaves, len(nodes))

    def comparable(value):
        try:
            return float(value)
        except (TypeError, ValueError):
            return value

    for node, mine in zip(nodes, got):
        expected = {k: comparable(text_of(v)) for k, v in leaves_of(node).items()}
        assert {k: comparable(v) for k, v in mine.items()} == expected


def test_deep_leaves_equal_those_of_generators(spark, monkeypatch):
    rng = random.Random(11)
    numbers = ["2.0", "1e20", "0.00001", "0.0", "-0.0", "1e3", "7", "100.00", "1.50", "1e-7", "123456789012345678901",
               "12345678901234567890.0", "9223372036854775807", "1.7976931348623157e308", "-12.340"]
    cells = [*numbers, "null", "true", '"x"', '"é \\"q\\" \\\\ \\ud83d\\ude00"', "{}", "[]", "[1.0,[2e0,{}]]"]

    def nested(depth):
        inner = nested(depth - 1) if depth else rng.choice(cells)
        return f"[{inner},{rng.choice(cells)}]" if rng.random() < 0.4 else f'{{"k":{inner},"n":{rng.choice(cells)}}}'

    df = frame(spark, [nested(rng.randrange(10)) for _ in range(300)])
    monkeypatch.setattr(records, "NATIVE_LEVELS", 3)
    names = ["id", "path", "value", "kind", "level", "in_list"]
    for lists in (True, False):
        deep = records.flatten_json(df, "doc", explode_arrays=lists).select(*names)
        native = records.flatten_json(df, "doc", explode_arrays=lists, depth=14).select(*names)
        rows = sorted(map(tuple, deep.collect()), key=str)
        assert rows == sorted(map(tuple, native.collect()), key=str) and max(r[4] for r in rows) > 8

    flat = f"[{','.join(cells)}]"
    rows = records.flatten_json(frame(spark, [flat, '{"k":' * 30 + flat + "}" * 30]), "doc").collect()
    shallow, deep = ({r.path.split("_", 1 - i)[-1].replace("k_", ""): (r.value, r.kind) for r in rows if r.id == i}
                     for i in (0, 1))
    assert len(shallow) == len(deep) > 20 and {k.lstrip("_"): v for k, v in shallow.items()} == deep


def test_special_documents(spark):
    documents = ['{"":{"a":1}}', "[1,{\"x\":2}]", "5", "null", "bad", "{}", '{"a":1,"a":2}', '{"M":1,"m":2}', None]
    got = collected(records.flatten_json(frame(spark, documents), "doc"), len(documents))
    assert got == [{"a": "1"}, {"_0": "1", "_1_x": "2"}, {}, {}, {}, {}, {"a": "2"}, {"M": "1", "m": "2"}, {}]
    named = collected(records.flatten_json(frame(spark, ["5"]), "doc", parent="p"), 1)
    assert named == [{"p": "5"}]


def test_declared_depth_never_loses_leaves(spark):
    documents = frame(spark, ['{"a":{"b":{"c":1}}}'])
    assert records.flatten_json(documents, "doc", depth=3).count() == 1
    with pytest.raises(Exception, match="deeper than the declared 2 levels"):
        records.flatten_json(documents, "doc", depth=2).count()


def test_kinds(spark):
    doc = '{"i":1,"big":123456789012345678901,"f":2.0,"e":1e3,"s":"x","b":true,"n":null}'
    rows = records.flatten_json(frame(spark, [doc]), "doc").collect()
    assert {r.path: (r.value, r.kind) for r in rows} == {
        "i": ("1", "int"), "big": ("123456789012345678901", "int"), "f": ("2.0", "float"),
        "e": ("1000.0", "float"), "s": ("x", "str"), "b": ("true", "bool"), "n": (None, "null"),
    }


def test_library_flavour(spark):
    visit = {"site": "N4", "tank": {"cover": None, "pump": {"hours": [12, 7]}, "readings": [{"ph": 6.5, "ok": True}]}}
    df = frame(spark, [json.dumps([visit, {"grid": [[3], 4]}]), json.dumps({"team": "x", "crew": "y"})])
    rows = records.flatten_records(df, "doc").collect()
    got = {(r.id, r.item, r.path): r.value for r in rows}
    assert got == {
        (0, 0, "site"): "N4", (0, 0, "tank.cover"): None,
        (0, 0, "tank.pump.hours.0"): "12", (0, 0, "tank.pump.hours.1"): "7",
        (0, 0, "tank.readings.0.ph"): "6.5", (0, 0, "tank.readings.0.ok"): "true",
        (0, 1, "grid.0.0"): "3", (0, 1, "grid.1"): "4", (1, 0, "team"): "x", (1, 0, "crew"): "y",
    }


def test_normalize_keeps_lists(spark):
    df = frame(spark, ['{"a":{"b.c":1,"l":[1,{"x":2}],"e":[],"o":{}}}'])
    rows = records.normalize_json(df, "doc").collect()
    assert {r.path: r.value for r in rows} == {"a_b_c": "1", "a_l": '[1,{"x":2}]', "a_e": "[]"}


def test_find_by_prefix_ignores_strings_in_lists(spark):
    doc = '{"a":"gridfs://1","l":["gridfs://2",{"b":"gridfs://3"}],"n":"x gridfs://4"}'
    rows = records.find_by_prefix(frame(spark, [doc]), "doc", "gridfs://").collect()
    assert sorted(r.value for r in rows) == ["gridfs://1", "gridfs://3"]


def test_find_by_prefix_unfolds_only_records_that_may_hold_it(spark):
    documents = ['{"a":"gridfs:\\/\\/1"}', '{"a":"\\u0067ridfs://2"}', '{"a":"other"}', '{"gridfs://":1}', None, "gridfs://"]
    df = frame(spark, documents)
    found = records.find_by_prefix(df, "doc", "gridfs://")
    assert sorted((r.id, r.value) for r in found.collect()) == [(0, "gridfs://1"), (1, "gridfs://2")]
    plan = records.find_by_prefix(df, "doc", "gridfs://")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Contains(doc") > plan.rindex("variant_explode")  # below all generators
    quoted = frame(spark, ['{"a":"\\"x\\" y"}'])
    assert [r.value for r in records.find_by_prefix(quoted, "doc", '"x').collect()] == ['"x" y']
    parsed = df.select("id", records.parse_json("doc").alias("doc"))
    assert records.find_by_prefix(parsed, "doc", "gridfs://").count() == 2


def test_collisions_keep_the_value_nearest_the_root(spark):
    leaves = records.flatten_json(frame(spark, ['{"a":{"b":1},"a_b":2,"c":3}']), "doc")
    fields = reshape.gather_fields(leaves, ["id"])
    assert fields.first().fields == {"a_b": "2", "c": "3"}
    wide = reshape.pivot_wide(leaves, ["id"], ["a_b", "c", "absent"])
    assert tuple(wide.first()) == (0, "2", "3", None)
    assert [tuple(r) for r in reshape.path_collisions(leaves, ["id"]).collect()] == [(0, "a_b", 2)]


def test_fields_to_columns(spark):
    df = spark.sql("""SELECT 1 AS id, map('a.b', 'x"\\\\ y', 'B', NULL, 'b', 'é') AS fields""")
    wide = reshape.fields_to_columns(df, "fields", ["a.b", "B", "b", "none"])
    assert tuple(wide.first()) == (1, 'x"\\ y', None, "é", None)


def test_align_and_type_sets(spark):
    df = spark.createDataFrame([('{"a":1,"z":null}',), ('{"b":"x","a":2.0}',), ("{}",)], "doc string")
    table = records.align_json_records(df, "doc")
    assert table.columns == ["a", "b", "z"]
    assert sorted(map(tuple, table.collect()), key=str) == [("1", None, None), ("2.0", "x", None), (None, None, None)]
    types = {r.path: r.types for r in type_sets(df, "doc").collect()}
    assert types == {"a": ["float", "int"], "b": ["str"], "z": None}
    frames = [spark.sql("SELECT 1 AS z, 2 AS a"), spark.sql("SELECT 3 AS b")]
    assert records.align_frames(frames).columns == ["a", "b", "z"]


def test_parse_or_skip_and_paths(spark):
    df = frame(spark, ['{"a":1}', "{}", "[]", "7", "x", None, "[0]", '{"a":{"b":[{}]}}', '["a",":"]', '{"a":[null]}'])
    assert sorted(r.id for r in records.parse_or_skip(df, "doc").collect()) == [0, 6, 8, 9]
    paths = records.distinct_paths(records.flatten_json(df, "doc"))
    assert sorted(r.path for r in paths.collect()) == ["_0", "_1", "a", "a_0"]


def test_row_to_json(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS string) AS b")
    assert df.select(records.row_to_json(df).alias("x")).first().x == '{"a":1,"b":null}'


def test_flattening_is_one_pass_without_shuffle(spark):
    df = frame(spark, ['{"a":1}']).withColumn("unused", F.lit("x"))
    plan = records.flatten_json(df, "doc", depth=4).select("path", "value")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Join" not in text and "Union" not in text and "Python" not in text
    assert text.count("Generate variant_explode") == 4


@pytest.mark.parametrize("depth", [None, 14])
@pytest.mark.parametrize("lists", [True, False])
def test_unfolded_fields_are_the_gathered_leaves(spark, depth, lists):
    deep = '{"k":' * 11 + '{"x":[1,2.0,{"y":null}],"e":{}}' + "}" * 11
    documents = [
        '{"a":{"b":1},"a_b":2,"c":[1,[2,{"d":"x"}],{}],"e":{},"f":[],"g":null,"h":true,"i":2.0,"j":1e30}',
        deep, "5", "[]", "{}", "null", "broken", None, '[{"a":1},"t"]', '{"a":"{\\"b\\":1}","é":"ü"}',
        '{"x":12345678901234567890123,"y":1.50,"z":-0.0}', '{"a":{"b":{"c":1}},"a_b":{"c":2},"a_b_c":3}',
    ]
    df = frame(spark, documents)
    if lists:
        gathered = reshape.gather_fields(records.flatten_json(df, "doc", depth=depth), ["id"])
        unfolded = records.unfold_fields(df, "doc", depth=depth)
    else:
        gathered = reshape.gather_fields(records.normalize_json(df, "doc", depth=depth), ["id"])
        unfolded = records.normalize_fields(df, "doc", depth=depth)
    one, other = ({r.id: r.fields for r in d.collect()} for d in (gathered, unfolded))
    assert one == other and len(one) == (6 if lists else 5)


def test_unfolding_stops_at_a_record_deeper_than_declared(spark):
    df = frame(spark, ['{"a":{"b":{"c":{}}}}', '{"a":1}'])
    assert records.unfold_fields(df, "doc", depth=3).count() == 1
    with pytest.raises(Exception, match="deeper than the declared 1 levels at a"):
        records.unfold_fields(df, "doc", depth=1).collect()


@pytest.mark.parametrize("depth", [None, 4])
def test_prefix_search_drops_other_leaves_before_the_next_level(spark, depth):
    texts = ['{"a":"p1","b":{"c":"p2","d":["p3",{"e":"p4"}],"f":"x"},"g":1,"h":null,"i":{},"j":[]}',
             '["p5"]', '"p6"', "{", None, '{"n":{"p":{"q":"p7"}},"m":"P8","":"p9"}']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, record string")
    found = records.find_by_prefix(df, "record", "p", depth=depth)
    leaves = records.flatten_json(df, "record", depth=depth)
    expected = leaves.filter("kind = 'str' AND NOT in_list AND startswith(value, 'p')")
    assert sorted(found.collect()) == sorted(expected.collect())
    assert found.columns == expected.columns
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    generators = [place for place, line in enumerate(plan.splitlines()) if "Generate variant_explode" in line]
    steps = [plan.splitlines()[a:b] for a, b in zip(generators, generators[1:])]
    assert steps and all(any("startswith" in line.lower() for line in step) for step in steps)


def test_keys_of_records_come_from_one_record_of_every_shape(spark):
    texts = ['{"a":1,"b":{"c":"x","d":[{"e":1}]}}', '{"a":"y","b":{"c":null,"d":[]}}', '{"a":{"z":1.5},"b":2}',
             '{"x: STRING":1}', '{"x: BIGINT":1}', '{"q r":{"`s`":true}}', '{"n":{},"m":[1,{"o":2}]}', "[1]", "3",
             "{", None, '{"a":{"z":12345.25}}', '{"i.j":1,"i":{"j":2,"k":3e9}}', '{"7":1,"":2,"é":3}']
    df = spark.createDataFrame([(text,) for text in texts], "record string")
    expected = records.sorted_keys(records.normalize_fields(df, "record"), "fields")
    assert records.normalized_keys(df, "record") == expected
    assert {"a", "a_z", "b_c", "x: STRING", "x: BIGINT"} <= set(expected)

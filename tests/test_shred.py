import json
import random

from pyspark.sql import functions as F

from ledgerloom.operators import shred

KEYS = (*shred.LABEL_ARRAYS, "other", "x")


def brute(i, o, at=""):
    out = set()
    if isinstance(o, dict):
        for k, v in o.items():
            p = f"{at}.{k}" if at else k
            if k in shred.LABEL_ARRAYS:
                for j, e in enumerate(v if isinstance(v, list) else [v]):
                    if e is not None:
                        out |= {(i, f"{p}[{j}]")} | brute(i, e, f"{p}[{j}]")
            elif isinstance(v, list):
                for j, e in enumerate(v):
                    out |= brute(i, e, f"{p}[{j}]")
            else:
                out |= brute(i, v, p)
    return out


def grown(rng, depth):
    kind = rng.choice(["obj", "arr", "null", "str", "int"]) if depth else rng.choice(["null", "str", "int"])
    if kind == "obj":
        return {k: grown(rng, depth - 1) for k in rng.sample(KEYS, rng.randint(0, 4))}
    if kind == "arr":
        return [grown(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return {"null": None, "str": rng.choice(["", "null", "[1]", '{"tables": 1}', "é"]), "int": 7}[kind]


def test_random_records_against_brute_force(spark):
    rng = random.Random(3)
    docs = [{k: grown(rng, 5) for k in rng.sample(KEYS, 4)} for _ in range(150)]
    rows = [(i, json.dumps(d, ensure_ascii=False), i, "clash") for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "id bigint, payload string, ordinal int, path string")
    got = [tuple(r) for r in shred.flatten_levels(df, "id", "payload", shred.LABEL_ARRAYS).select("id", "path").collect()]
    want = set().union(*(brute(i, d) for i, d in enumerate(docs)))
    assert len(got) == len(set(got)) and set(got) == want


def test_bad_empty_and_repeated_records(spark):
    rows = [(1, None), (2, ""), (3, "{broken"), (4, "[]"), (5, "null"), (6, '{"tables": null}'), (7, '{"tables": [null, {"row_labels": "lone"}]}'), (7, '{"tables": [null, {"row_labels": "lone"}]}')]
    got = sorted((r.id, r.path, r.parent_path, r.ordinal) for r in shred.flatten_levels(spark.createDataFrame(rows, "id int, payload string"), "id", "payload", shred.LABEL_ARRAYS).collect())
    assert got == [(7, "tables[1]", None, 1)] * 2 + [(7, "tables[1].row_labels[0]", "tables[1]", 0)] * 2 or got == sorted([(7, "tables[1]", None, 1), (7, "tables[1]", None, 1), (7, "tables[1].row_labels[0]", "tables[1]", 0), (7, "tables[1].row_labels[0]", "tables[1]", 0)])
    empty = spark.createDataFrame([], "id int, payload string")
    assert shred.flatten_levels(empty, "id", "payload").count() == 0
    assert shred.merged_schema(empty, "payload").count() == 0 and shred.rejected(empty, "id", "payload").count() == 0


def test_long_and_deep(spark):
    deep = {"label": "end"}
    for _ in range(12):
        deep = {"sub_labels": [deep]}
    wide = {"tables": [{"period_labels": ["x" * 100_000] * 3}]}
    df = spark.createDataFrame([(1, json.dumps({"tables": [{"row_labels": deep}]})), (2, json.dumps(wide))], "id int, payload string")
    got = {(r.id, r.path) for r in shred.flatten_levels(df, "id", "payload", shred.LABEL_ARRAYS).select("id", "path").collect()}
    assert got == brute(1, {"tables": [{"row_labels": deep}]}) | brute(2, wide)


def test_child_tables_and_types(spark):
    doc = {"tables": [{"line_position": 3, "row_labels": [{"row_index": "2", "label": "a"}, "lone", {"row_index": "bad", "label": None}]}]}
    levels = shred.flatten_levels(spark.createDataFrame([(1, json.dumps(doc))], "id int, payload string"), "id", "payload")
    kids = shred.child_tables(levels, "id", {"row_labels": {"row_index": "bigint", "label": "string"}})
    got = sorted((r.ordinal, r.row_index, r.label) for r in kids["row_labels"].collect())
    assert got == [(0, 2, "a"), (1, None, None), (2, None, None)]
    typed = spark.createDataFrame([(1, [(1, "x"), None]), (2, None), (3, [])], "id int, arr array<struct<a:int,b:string>>")
    assert [tuple(r) for r in shred.flatten_typed(typed, "id", "arr", F.lit("k")).collect()] == [(1, "k", 0, 1, "x")]


def test_nested_arrays_become_tables_of_their_own(spark):
    rows = [(1, [("a", ["x", None, "y"], (7, [([3],)])), None, ("b", None, None)]), (2, None), (3, [])]
    df = spark.createDataFrame(rows, "id int, arr array<struct<n:string,arr:array<string>,s:struct<k:int,deep:array<struct<v:array<int>>>>>>")
    kids = {k: [tuple(r) for r in d.collect()] for k, d in shred.flatten_nested(df, "id", "arr", F.lit("k")).items()}
    assert kids["arr"][0][:4] == (1, "k", 0, "a") and len(kids["arr"]) == 2 and kids["arr"][1][2] == 2
    assert kids["arr.arr"] == [(1, "k", 0, 0, "x"), (1, "k", 0, 2, "y")]
    assert kids["arr.s.deep"] == [(1, "k", 0, 0)] and kids["arr.s.deep.v"] == [(1, "k", 0, 0, 0, 3)]


def test_what_the_merged_schema_lists_is_exploded(spark):
    """Arrays of names nobody gave beforehand come out, with a lone value as element 0, and fields get a type that holds them."""
    docs = [{"footnotes": [{"mark": 1, "text": "a"}, {"mark": 2.5}], "note": {"note_rows": ["x", None, "y"]}}, {"footnotes": {"mark": "3", "ok": True}}]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, payload string")
    schema = shred.merged_schema(df, "payload")
    arrays = shred.schema_arrays(schema)
    assert arrays == ("footnotes", "note_rows") and shred.listed_arrays(df, "payload") == ("note_rows",)
    levels = shred.flatten_levels(df, "id", "payload")
    assert sorted((r.id, r.path, r.parent_path) for r in levels.collect()) == [(0, "footnotes[0]", None), (0, "footnotes[1]", None), (0, "note.note_rows[0]", None), (0, "note.note_rows[2]", None), (1, "footnotes[0]", None)]
    fields = shred.schema_fields(schema, arrays)
    assert fields["footnotes"] == {"mark": "string", "ok": "boolean", "text": "string"}
    kids = shred.child_tables(levels, "id", fields)
    assert sorted((r.id, r.ordinal, r.mark) for r in kids["footnotes"].collect()) == [(0, 0, "1"), (0, 1, "2.5"), (1, 0, "3")]
    kinds = {(r.level, r.kind, r.n) for r in schema.groupBy("level", "kind").sum("n").toDF("level", "kind", "n").collect()}
    assert {("footnotes", "array", 1), ("footnotes", "object", 1), ("footnotes.mark", "scalar", 3), ("note.note_rows", "array", 1)} <= kinds


def test_rejected_records_have_a_reason(spark):
    rows = [(1, None), (2, ""), (3, "{broken"), (4, '{"a": 1, "a": 2}'), (5, '{"a": 1}'), (6, "[]")]
    got = {tuple(r) for r in shred.rejected(spark.createDataFrame(rows, "id int, payload string"), "id", "payload").collect()}
    assert got == {(1, "missing"), (2, "not_json"), (3, "not_json"), (4, "repeated_field")}

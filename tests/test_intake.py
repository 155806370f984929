import json
import random

import pytest

from ledgerloom.operators import intake


def parse(line):
    """Fields of a line by a state machine, or None if a quote is out of place."""
    fields, i, n = [], 0, len(line)
    while True:
        if i < n and line[i] == '"':
            i, text = i + 1, ""
            while True:
                if i >= n:
                    return None
                if line[i] == '"':
                    if line[i + 1 : i + 2] == '"':
                        text, i = text + '"', i + 2
                        continue
                    i += 1
                    break
                text, i = text + line[i], i + 1
            if i < n and line[i] != ",":
                return None
        else:
            j = line.find(",", i)
            j = n if j < 0 else j
            text = line[i:j]
            if '"' in text:
                return None
            i = j
        fields.append(text)
        if i >= n:
            return fields
        i += 1


def whole(s, least):
    return s != "" and all(c in "0123456789" for c in s) and int(s) >= least


def reason(feed, line):
    f = parse(line or "")
    if f is None:
        return "quoting"
    if len(f) != {"candidates": 10, "anomalies": 5}.get(feed, -1):
        return "column_count"
    if feed == "candidates":
        try:
            w = json.loads(f[8])
            warned = isinstance(w, list) and all(isinstance(x, str) for x in w)
        except ValueError:
            warned = False
        ok = f[0] != "" and whole(f[1], 1) and (f[2] == "" or whole(f[2], 1)) and f[4] in intake.STATUSES and whole(f[5], 0) and whole(f[6], 0) and warned
    else:
        head, _, n = f[4].partition(":")
        limit = {"n_rows>200": 200, "n_cols>50": 50}.get(head)
        ok = f[1] != "" and f[0] == f"{f[1]}|{f[2]}" and whole(f[2], 1) and limit is not None and whole(n, limit + 1)
    return None if ok else "invalid_value"


PARTS = ['"', '""', ",", "a", "1", "\n", "\u0001", "\u0001s", " ", '"a"', ",,", '\\"']


def lines():
    rng = random.Random(5)
    for _ in range(1500):
        yield rng.choice(["candidates", "anomalies", None, "other"]), "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12)))
    good = ["r", "5", "", "notes", "success", "3", "4", "", "[]", "p"]
    for col, values in {
        1: ["0", "00", "007", "9" * 40, "+1", " 1", "1\n", "٣", "1.0"],
        2: ["", "0", "12", "x"],
        4: ["failed", "Success", "success "],
        5: ["0", "-0", "", "1e3"],
        8: ["", "[", '["a"]', '["a","b"]', '["a" "b"]', "[1]", '[["a"]]', "['a']", '["\\x"]', '["\\u00e9\\n"]', '["a",]', ' [ "a" , "b" ] ', '["a\tb"]', "[s]", '["a"]x', "null", '{"a":"b"}', '["\u0001"]', "[\u0001]"],
    }.items():
        for v in values:
            f = list(good)
            f[col] = v
            yield "candidates", ",".join('"' + x.replace('"', '""') + '"' for x in f)
    for v in ["n_rows>200:201", "n_rows>200:200", "n_rows>200:0201", "n_cols>50:51", "n_cols>50:50", "n_cols>50:" + "9" * 50, "n_rows>200:", "n_rows>200: 300", "n_rows>200:300x"]:
        yield "anomalies", f"r|5,r,5,p,{v}"
    yield "anomalies", "r|5,r,6,p,n_rows>200:300"
    yield "anomalies", "|5,,5,p,n_rows>200:300"
    yield "candidates", None
    yield "candidates", 'r,5,,notes,success,3,4,"' + "long, " * 50_000 + '",[],p'
    yield "candidates", "," * 100_000


def test_reasons_against_brute_force(spark):
    rows = [(i, f, ln, 1, "clash") for i, (f, ln) in enumerate(lines())]
    feed = spark.createDataFrame(rows, "line_id bigint, feed string, raw_line string, position int, cells string")
    got = {r.line_id: r.reason for r in intake.rejected(feed.drop("cells")).collect()}
    want = {i: r for i, f, ln, *_ in rows if (r := reason(f, ln))}
    assert got == want


def test_fields_against_brute_force(spark):
    rows = [(i, ln) for i, (_, ln) in enumerate(lines()) if ln is not None and parse(ln) is not None]
    df = spark.createDataFrame(rows, "i int, raw string")
    got = {r.i: list(r.f) for r in df.select("i", intake.record_fields(df.raw).alias("f")).collect()}
    assert got == {i: parse(ln) for i, ln in rows}


def test_loaded_rows_are_those_not_rejected(spark):
    rows = [(1, "candidates", 'r,5,,notes,success,3,4,,"[""a""]",p'), (2, "candidates", "r,0,,notes,success,3,4,,[],p"), (3, "anomalies", "r|5,r,5,p,n_cols>50:60"), (1, "candidates", 'r,5,,notes,success,3,4,,"[""a""]",p')]
    feed = spark.createDataFrame(rows, "line_id bigint, feed string, raw_line string")
    c = intake.loaded(feed, "candidates").collect()
    assert [(r.line_id, r.page, r.n_rows, r.warnings) for r in c] == [(1, None, 3, ["a"])] * 2
    assert intake.loaded(feed, "anomalies").count() == 1
    assert intake.rejected(feed.limit(0)).count() == 0


@pytest.mark.parametrize("text,ok", [("[]", True), ("[ ]", True), ('["a", "b"]', True), ("[,]", False), ('"a"', False)])
def test_strict_json(spark, text, ok):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(intake.strict_json_strings(df.t).alias("k")).first().k is ok

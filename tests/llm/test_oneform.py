import itertools
import unicodedata

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import oneform
from ledgerloom.llm.oneform import one_form


@pytest.mark.parametrize(
    "a,b",
    [
        ("Cộng", "Ｃộｎｇ"), ("Tổng cộng", unicodedata.normalize("NFD", "Tổng cộng")), ("Chỉ tiêu", "Chỉ tiêu"), ("Chỉ tiêu", "Chỉ  tiêu"), ("Thuyết minh", "T⁠huyết minh﻿"),
        ("CTCP", "СТСР"), ("VND", "VΝD"), ("Nguyên giá", "Nguуên gіá"), ("Điện", "Ðiện"), ("Điện", "Ɖiện"), ("Северная", "Cеверная"), ("II", "Ⅱ"), ("a b", " a\t\nb "), ("ﬁ", "fi"),
    ],
)
def test_look_alikes_get_one_form(a, b):
    assert one_form(a) == one_form(b)


@pytest.mark.parametrize("a,b", [("m²", "m2"), ("Cộng", "cộng"), ("Cộng", "Công"), ("β", "B"), ("Северная", "Cebephaя"), ("hòa", "hoà"), ("1", "l"), ("½", "1/2"), ("нить", "hutb")])
def test_visible_differences_stay(a, b):
    assert one_form(a) != one_form(b)


def test_script_of_a_token_decides():
    assert one_form("Cеверная") == "Северная"
    assert one_form("«Северная нить»") == "«Северная нить»"
    assert one_form("аррlе") == "apple"


@pytest.mark.parametrize("s", ["", " ", "Ｎｈàｃｈｏ", "Cеверная нить β", "á̂", "​", "е" * 50_000])
def test_idempotent(s):
    assert one_form(one_form(s)) == one_form(s)


def test_jvm_path_equals_python(spark):
    texts = ["a  b\n", "Cộng", " \t", "", "Tổng \r\n cộng", "x" * 100_000, "Ｃộｎｇ", None]
    df = spark.createDataFrame([(t, 1) for t in texts], "t string, form int")
    got = {r.t: r.form for r in oneform.with_form(df, "t", "form").collect()}
    assert got == {t: None if t is None else one_form(t) for t in texts}
    odd = {r.t: r.o for r in df.select("t", oneform.is_odd(F.col("t")).alias("o")).collect()}
    assert odd["Ｃộｎｇ"] and not odd["Tổng \r\n cộng"] and odd[None] is None


def brute(items):
    tight = lambda s: "".join(c for c in s if c not in " \t\n\r")
    out = set()
    for (f, s, k, t), (f2, s2, k2, t2) in itertools.combinations(items, 2):
        if f == f2 and s == s2 and t is not None and t2 is not None and k != k2 and one_form(t) and one_form(t) == one_form(t2) and tight(t) != tight(t2):
            out.add((f, *sorted((k, k2), key=str.encode)))
    return out


def test_pairs_against_brute_force(spark):
    texts = ["Cộng", "Ｃộｎｇ", "Cộng", "Cộng ", "công", "a b", "a b", "a  b", "", " ", "​", None, "m²", "m2"]
    items = [(f, s, f"{s}|{i}", t) for f in ("grid", "question") for s in ("x", "y", None) for i, t in enumerate(texts)] + [("grid", "x", "x|0", "Cộng")]
    df = spark.createDataFrame([(*i, "clash") for i in items], "field string, scope string, key string, text string, form string")
    got = [tuple(r) for r in oneform.look_alike_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(items)
    assert oneform.look_alike_pairs(df.limit(0)).count() == 0


def test_hot_group_of_identical_texts(spark):
    df = spark.range(60_000).select(F.lit("grid").alias("field"), F.lit("s").alias("scope"), F.concat(F.lit("s|"), F.col("id").cast("string")).alias("key"), F.when(F.col("id") == 7, "Ｃộｎｇ").otherwise("Cộng").alias("text"))
    assert oneform.look_alike_pairs(df).count() == 59_999


def test_items_of_tables_without_an_odd_text_are_left_out(spark):
    rows = [("k|1", "r", [["Cộng", "Ｃộｎｇ"]], [(0, 0, "Cộng")]), ("k|2", "r2", [["Cộng"]], [(0, 0, "Cộng")]), ("k|3", "r", None, None), ("k|4", "r3", [], [(0, 0, None), (1, 0, "Ｃ")])]
    df = spark.createDataFrame(rows, "table_key string, report_id string, grid array<array<string>>, row_labels array<struct<row_index:int,column_index:int,label:string>>")
    pairs = [tuple(r) for r in oneform.look_alike_pairs(oneform.table_items(df)).collect()]
    assert pairs == [("grid", "k|1|0|0", "k|1|0|1")]


@pytest.mark.parametrize("a,b", [("đô", "đ\u03bf\u0302"), ("Cộng", "C\u043e\u0323\u0302ng"), ("Cộng", "C\u03bf\u0302\u0323ng"), ("á", "\u0430\u0301")])
def test_marks_on_look_alikes_compose(a, b):
    assert one_form(b) == one_form(a) == a and one_form(one_form(b)) == one_form(b)


@pytest.mark.parametrize("s", ["\u03b2\u0435\xf4", "-\u0430\u03b1\u03b2C.", "\u0421\u03b2\u039f", "\u043e\u0306C\u0323\u03b2"])
def test_idempotent_over_three_scripts(s):
    assert one_form(one_form(s)) == one_form(s)


@pytest.mark.parametrize(
    "a,b",
    [("kat", "κat"), ("unit", "υnit"), ("x", "χ"), ("Source", "Տource"), ("Apple", "Ꭺpple"), ("word", "ѡord"), ("C", "Ϲ"), ("Car", "Ϲar"), ("ROPE", "ꓣꓳꓑꓰ"), ("ГОСТ", "ΓОСΤ"), ("Coptic", "Ⲥoptic")],
)
def test_more_scripts(a, b):
    assert one_form(b) == one_form(a) == a


@pytest.mark.parametrize("s", ["οτι", "日本ー", "ſ", "ϐ", "β", "Москва", "Ελλάδα"])
def test_words_of_one_other_script_stay(s):
    assert one_form(s) == s


def test_script_sets_are_intersected():
    assert oneform.resolved_scripts("аррlе") == {"Latn", "Cyrl"} and oneform.resolved_scripts("Cеверная") == {"Cyrl"} and oneform.resolved_scripts("aжβ") == frozenset()
    assert oneform.resolved_scripts("12-3") is None and oneform.resolved_scripts("日ー") == {"Jpan"} and "Latn" in oneform.resolved_scripts("đố")


def test_random_strings_are_idempotent():
    import random

    rng = random.Random(2)
    pool = "aеоΟАΒβιкЖꓮᎠՏоx̂́đ нитьⅡＣ日ー-.1²ѡϹſ​"
    for _ in range(20_000):
        s = "".join(rng.choice(pool) for _ in range(6))
        assert one_form(one_form(s)) == one_form(s)


def class_rows(items):
    tight = lambda s: "".join(c for c in s if c not in " \t\n\r")
    groups = {}
    for f, s, k, t in set(items):
        if t is not None and one_form(t):
            groups.setdefault((f, s, one_form(t)), set()).add((k, tight(t)))
    return {(f, s, k, len({t for _, t in g}), sum(o != t for _, o in g)) for (f, s, _), g in groups.items() if len({t for _, t in g}) > 1 for k, t in g}


@pytest.mark.parametrize("limit", [None, 0])
def test_classes_and_pairs_with_and_without_broadcasts(spark, monkeypatch, limit):
    from ledgerloom import session

    if limit is not None:
        monkeypatch.setattr(oneform, "join_checked", lambda *a, **k: session.join_checked(*a, **k, limit=limit))
    texts = ["Cộng", "Ｃộｎｇ", "Cộng ", "công", "a b", "a b", "a  b", "", None, "m²"]
    items = [(f, s, f"{s}|{i}", t) for f in ("grid", "question") for s in ("x", None) for i, t in enumerate(texts)] + [("grid", "x", "x|0", "Cộng")]
    df = spark.createDataFrame(items, "field string, scope string, key string, text string")
    got = [tuple(r) for r in oneform.look_alike_classes(df).select("field", "scope", "key", "n_variants", "n_links").collect()]
    assert len(got) == len(set(got)) and set(got) == class_rows(items)
    assert {tuple(r) for r in oneform.look_alike_pairs(df).collect()} == brute(items)
    assert oneform.look_alike_classes(df.limit(0)).count() == 0

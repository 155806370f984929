"""One consistent form for text that looks the same but is stored with different characters.

Letters drawn alike are one look, whatever their script. A token's resolved script set is the intersection, over its
letters, of the scripts in which each letter's look can be written (by script extensions; signs common to all scripts
don't count). If several scripts remain, or one that isn't the letters' own, the token is a mixed-script or whole-script
confusable and is respelled in one of them: Latin if it is among them, else the first in a fixed order. If none remains,
letters with a Latin look are written in Latin and the others stay. Full-width and other compatibility forms, blanks and
invisible characters are normalized; composition is NFC. Superscripts, case and accents are visible and stay.
"""

from __future__ import annotations

import re
import unicodedata as u
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from ..functions.text import CYRILLIC_LOOKALIKES, GREEK_LOOKALIKES, INVISIBLE, LATIN_LOOKALIKES, WIDE_BLANKS
from ..session import join_checked, settle

# Letters of each script drawn like a Latin letter (beyond those of the core's tables), and letters that
# two other scripts share. Letters that only resemble each other are not here.
_LIKE_LATIN = {
    "Cyrl": CYRILLIC_LOOKALIKES | dict(zip("ѴѵѡүЅԌ", "VvwySG")),
    "Grek": GREEK_LOOKALIKES | dict(zip("ϹϲͿϳικυχγ", "CcJjikuxy")),
    "Armn": dict(zip("ԼՕՍՏհյոսօզց", "LOUShjnuoqg")),
    "Cher": dict(zip("ᎠᎢᎥᎪᎫᎬᎳᎷᎻᎽᏀᏃᏒᏙᏚᏞᏟᏢᏦᏴ", "DTiAJEWMHYGZRVSLCPKB")),
    "Copt": dict(zip("ⲂⲎⲒⲔⲘⲚⲞⲟⲢⲣⲤⲥⲦⲨⲬⲭ", "BHIKMNOoPpCcTYXx")),
    "Lisu": dict(zip("ꓮꓐꓚꓓꓰꓝꓖꓧꓲꓙꓗꓡꓟꓠꓳꓑꓣꓢꓔꓴꓦꓪꓫꓬꓜ", "ABCDEFGHIJKLMNOPRSTUVWXYZ")),
}
_LIKE_GREEK = {"Cyrl": dict(zip("ГПФф", "ΓΠΦφ"))}
#: Scripts in order of preference, as a token's spelling.
_SCRIPTS = ("Latn", "Cyrl", "Grek", "Armn", "Cher", "Copt", "Lisu", "Geor", "Hebr", "Arab", "Deva", "Beng", "Thai", "Laoo", "Khmr", "Ethi", "Hani", "Hira", "Kana", "Hang", "Bopo")
#: Writing systems that use several scripts.
_SYSTEMS = {"Hani": ("Jpan", "Kore", "Hanb"), "Hira": ("Jpan",), "Kana": ("Jpan",), "Hang": ("Kore",), "Bopo": ("Hanb",)}

#: Compatibility mappings that keep the look; superscripts, subscripts, fractions and circles don't.
_SAME_LOOK = ("<wide>", "<narrow>", "<compat>", "<noBreak>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>")
_DASHES = {"‐": "-", "‑": "-"}
_VIETNAMESE = "àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ"
_PLAIN = _VIETNAMESE + _VIETNAMESE.upper()
#: Texts of these characters alone only need their blanks collapsed.
_ORDINARY = "\t\n\r" + "".join(map(chr, range(0x20, 0x7F))) + _PLAIN
ORDINARY_BLANKS = r"[ \t\n\r]+"
_SPACES = re.compile(ORDINARY_BLANKS)
#: Combining marks belong to the token of the letter that carries them.
_MARKS = "".join(c for c in map(chr, range(0x300, 0x20000)) if u.category(c).startswith("M"))
_TOKEN = re.compile(rf"[^\W_](?:[^\W_]|[{re.escape(_MARKS)}])*", re.UNICODE)


@lru_cache(maxsize=4096)
def _char(c: str) -> str:
    """One character without regard to its neighbours."""
    if c in INVISIBLE or (u.category(c) == "Cf"):
        return ""
    if c in WIDE_BLANKS or u.category(c) in ("Zs", "Zl", "Zp"):
        return " "
    if c in _DASHES:
        return _DASHES[c]
    if c in _LOOK:
        return c
    d = u.decomposition(c)
    if d.startswith(_SAME_LOOK) and not (d.startswith("<compat>") and _variant(c)):
        return "".join(_char(x) for x in u.normalize("NFKC", c))
    return LATIN_LOOKALIKES.get(c, c)


def _variant(c: str) -> bool:
    """Whether a letter's compatibility form is another shape of one letter, as the long s is, and not the same look."""
    plain = u.normalize("NFKC", c)
    return c != "\u00b5" and len(plain) == 1 and u.category(c)[0] == u.category(plain)[0] == "L" and u.name(plain, "").split(" ")[0] in ("LATIN", "GREEK")


#: Per letter that has look-alikes: script to the letter of that script that looks the same.
_LOOK: dict[str, dict[str, str]] = {}
for _like, _home in ((_LIKE_LATIN, "Latn"), (_LIKE_GREEK, "Grek")):
    for _script, _pairs in _like.items():
        for _letter, _plain in _pairs.items():
            _same = _LOOK.setdefault(_plain, {_home: _plain})
            _same.setdefault(_script, _letter)
            _LOOK[_letter] = _same


@lru_cache(maxsize=4096)
def _scripts(c: str) -> frozenset[str] | None:
    """Scripts in which the look of a letter can be written, by script extensions; None for what belongs to all scripts."""
    if not u.category(c).startswith("L"):
        return None
    if c in _LOOK:
        return frozenset(_LOOK[c])
    import regex

    own = {s for s in _SCRIPTS if regex.match(rf"\p{{scx={s}}}", c)}
    if not own and not regex.match(r"\p{scx=Common}|\p{scx=Inherited}", c):
        own = {u.name(c, "unknown").split(" ")[0]}
    return frozenset(own | {x for s in own for x in _SYSTEMS.get(s, ())}) or None


def resolved_scripts(tok: str) -> frozenset[str] | None:
    """Intersection of the script sets of a token's letters: empty if they fit no one script, None without a letter."""
    out: frozenset[str] | None = None
    for c in u.normalize("NFD", tok):
        s = _scripts(c)
        if s is not None:
            out = s if out is None else out & s
    return out


def _token(tok: str) -> str:
    """A token in its one script. The choice depends on the looks alone, so look-alike tokens meet and it is idempotent."""
    plain = u.normalize("NFD", tok)
    fit = resolved_scripts(tok)
    if fit is None:
        return tok
    target = next((s for s in _SCRIPTS if s in fit), None) or "Latn"
    return u.normalize("NFC", "".join(_LOOK[c].get(target, c) if c in _LOOK else c for c in plain))


def one_form(s: str) -> str:
    """The consistent form of one text. Idempotent; runs of blanks become one, ends are stripped."""
    if not s.isascii():
        s = u.normalize("NFC", "".join(map(_char, s)))
        s = _TOKEN.sub(lambda m: m[0] if m[0].isascii() else _token(m[0]), s)
    return _SPACES.sub(" ", s).strip(" ")


@F.pandas_udf(StringType())
def _one_form_udf(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in it:
        yield s.map(one_form, na_action="ignore")


def is_odd(c: Column) -> Column:
    """Whether a text has a character beyond the ordinary ones (deleting those is far faster than a negated class)."""
    return F.length(F.translate(c, _ORDINARY, "")) > 0


def blanks_collapsed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, ORDINARY_BLANKS, " "))


def with_form(df: DataFrame, text: str, out: str) -> DataFrame:
    """df plus the consistent form of column text; null stays null, empty stays empty.

    Only texts with an unusual character are worked on in Python; the others need no more than a JVM expression and
    pass as nulls, so the input is read once.
    """
    odd = _one_form_udf(F.when(is_odd(F.col(text)), F.col(text)))
    return df.withColumn(out, F.coalesce(odd, blanks_collapsed(F.col(text))))


def look_alike_pairs(items: DataFrame) -> DataFrame:
    """Pairs of keys in one scope whose texts look the same but differ in characters.

    items: field, scope, key, text. Result: field, key_a, key_b, each pair once, smaller key by bytes
    first. Texts that differ only in ordinary blanks count as the same characters. Nulls are left out;
    blank texts too. Repeated items count once; a key is never paired with itself.

    Groups without a difference are dropped after a map-side aggregate. In the others classes of equal
    characters are paired, never members with members of the same class, and the members join on
    (group, class), so identical copies aren't compared with each other.
    """
    formed = with_form(items.filter(F.col("text").isNotNull()), "text", "form").filter("form <> ''")
    keyed = formed.select(
        "field",
        "key",
        F.xxhash64("field", "scope", "form").alias("g1"),
        F.xxhash64("form", "scope", F.lit(7)).alias("g2"),
        F.xxhash64(F.regexp_replace("text", ORDINARY_BLANKS, "")).alias("cls"),
    )
    keyed = settle(keyed)
    classes = keyed.groupBy("field", "g1", "g2").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo <> hi").select("field", "g1", "g2")
    live = settle(join_checked(keyed, settle(classes), ["field", "g1", "g2"], "left_semi", 40).distinct())
    kinds = settle(live.select("field", "g1", "g2", "cls").distinct())
    kinds = kinds.alias("a").join(kinds.alias("b"), ["field", "g1", "g2"]).filter("a.cls < b.cls").select("field", "g1", "g2", F.col("a.cls").alias("cls_a"), F.col("b.cls").alias("cls_b"))
    kinds = settle(kinds)
    left = live.select("field", "g1", "g2", F.col("cls").alias("cls_a"), F.col("key").alias("k1"))
    right = live.select("field", "g1", "g2", F.col("cls").alias("cls_b"), F.col("key").alias("k2"))
    # While the pairs of classes are few, the members of a hot class stay where they lie here.
    pairs = join_checked(left, kinds, ["field", "g1", "g2", "cls_a"], "inner", 48).join(right, ["field", "g1", "g2", "cls_b"]).filter("k1 <> k2")
    return pairs.select("field", F.least("k1", "k2").alias("key_a"), F.greatest("k1", "k2").alias("key_b")).distinct()


def look_alike_classes(items: DataFrame) -> DataFrame:
    """One row per distinct item that looks like another one of other characters: field, scope, key, class_id, variant, n_variants, n_links.

    class_id is a hash of field, scope and form, variant numbers the spellings of the class from 1, n_links counts the items of
    other spellings. The size is that of the input, however many items share a look, where pairs would grow with its square.
    Nulls and blank texts are left out. Counts are of (class, spelling), pre-aggregated map-side.
    """
    formed = with_form(items.filter(F.col("text").isNotNull()), "text", "form").filter("form <> ''")
    class_id = F.substring(F.sha2(F.to_json(F.struct("field", "scope", "form")), 256), 1, 32)
    keyed = settle(formed.select("field", "scope", "key", class_id.alias("class_id"), F.xxhash64(F.regexp_replace("text", ORDINARY_BLANKS, "")).alias("cls")).distinct())
    sizes = keyed.groupBy("class_id", "cls").agg(F.count("*").alias("n"))
    # A class has as many spellings as are typed, not as many as there are items.
    per = sizes.groupBy("class_id").agg(F.sum("n").alias("total"), F.count("*").alias("n_variants"), F.sort_array(F.collect_list("cls")).alias("all")).filter("n_variants > 1")
    known = per.join(sizes, "class_id").select("class_id", "cls", F.array_position("all", F.col("cls")).cast("int").alias("variant"), "n_variants", (F.col("total") - F.col("n")).alias("n_links"))
    return join_checked(keyed, settle(known), ["class_id", "cls"], "inner", 96).select("field", "scope", "key", "class_id", "variant", "n_variants", "n_links")


def _cells(t: DataFrame) -> DataFrame:
    rows = t.select("table_key", F.posexplode("grid").alias("r", "row"))
    cells = rows.select("table_key", "r", F.posexplode("row").alias("c", "text"))
    return cells.select(F.lit("grid").alias("field"), F.col("table_key").alias("scope"), F.concat_ws("|", "table_key", F.col("r").cast("string"), F.col("c").cast("string")).alias("key"), "text")


def _labels(t: DataFrame) -> DataFrame:
    lab = t.select("report_id", "table_key", F.explode("row_labels").alias("l"))
    key = F.concat_ws("|", "table_key", F.col("l.row_index").cast("string"), F.col("l.column_index").cast("string"))
    return lab.select(F.lit("row_labels").alias("field"), F.col("report_id").alias("scope"), key.alias("key"), F.col("l.label").alias("text"))


def table_items(tables: DataFrame) -> DataFrame:
    """Cells and row labels of the tables that can hold a pair, as items for look_alike_pairs.

    A pair needs an odd text in its scope, so tables of scopes without one are left out. The scopes
    are counted and broadcast only while small; beyond that they join by shuffle.
    """
    t = tables.select("table_key", "report_id", "grid", "row_labels")
    odd_grid = is_odd(F.array_join(F.flatten("grid"), ""))
    odd_label = is_odd(F.array_join(F.transform("row_labels", lambda x: x["label"]), ""))
    odd = settle(t.select("table_key", "report_id", odd_grid.alias("g"), odd_label.alias("l")).filter("g or l"))
    cells = join_checked(t.select("table_key", "grid"), odd.filter("g").select("table_key").distinct(), "table_key", "left_semi", 120)
    labels = join_checked(t.select("report_id", "table_key", "row_labels"), odd.filter("l").select("report_id").distinct(), "report_id", "left_semi", 120)
    return _cells(cells).unionByName(_labels(labels))


def question_items(questions: DataFrame) -> DataFrame:
    return questions.select(F.lit("question").alias("field"), F.col("set_name").alias("scope"), F.col("id").cast("string").alias("key"), F.col("question").alias("text"))

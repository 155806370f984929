"""Column builders for text: tokens, folding, number parsing, truncation."""

from __future__ import annotations

import itertools
import json
import unicodedata

from pyspark.sql import Column, functions as F

# Letters of other scripts drawn like a Latin letter.
CYRILLIC_LOOKALIKES = dict(zip("АВЕКМНОРСТУХЅІЈԚԜҮаеорсухѕіјԛԝһԁӏ", "ABEKMHOPCTYXSIJQWYaeopcyxsijqwhdl"))
GREEK_LOOKALIKES = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧνορα", "ABEZHIKMNOPTYXvopa"))
LATIN_LOOKALIKES = {"Ð": "Đ", "Ɖ": "Đ"}
LOOKALIKES = CYRILLIC_LOOKALIKES | GREEK_LOOKALIKES | LATIN_LOOKALIKES
#: Invisible characters: soft hyphen, zero-width signs, direction marks, word joiner, byte-order mark.
INVISIBLE = "­͏؜᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩﻿"
#: Blanks other than the ordinary one.
WIDE_BLANKS = "               　"
WORD = r"[\p{L}\p{N}_]+"


def _pairs() -> tuple[str, str, str, str]:
    """Translate tables: to one spelling with accents kept, and further to plain letters."""
    src, dst = list(WIDE_BLANKS), [" "] * len(WIDE_BLANKS)
    for c, d in LOOKALIKES.items():
        src.append(c), dst.append(d)
    for code in range(0xFF01, 0xFF5F):
        src.append(chr(code)), dst.append(chr(code - 0xFEE0))
    fsrc, fdst = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        c = chr(code)
        base = unicodedata.normalize("NFD", c)[0]
        base = {"đ": "d", "Đ": "D"}.get(c, base)
        if base != c and base.isascii():
            fsrc.append(c), fdst.append(base)
    return "".join(src) + INVISIBLE, "".join(dst), "".join(fsrc), "".join(fdst)


ONE_SRC, ONE_DST, FOLD_SRC, FOLD_DST = _pairs()


def one_spelling(c: Column) -> Column:
    """Full-width, look-alike and invisible characters brought to ordinary ones (accents stay as stored)."""
    return F.translate(c, ONE_SRC, ONE_DST)


def fold(c: Column) -> Column:
    """Lower-case text without accents, composed or combining, đ as d."""
    return F.lower(F.translate(F.regexp_replace(one_spelling(c), r"\p{M}+", ""), FOLD_SRC, FOLD_DST))


def fold_text(s: str) -> str:
    """The same as `fold` for one Python string."""
    s = "".join(ch for ch in s.translate(_ONE) if not unicodedata.category(ch).startswith("M"))
    return s.translate(_FOLD).lower()


_ONE = {ord(a): (ONE_DST[i] if i < len(ONE_DST) else None) for i, a in enumerate(ONE_SRC)}
_FOLD = {ord(a): b for a, b in zip(FOLD_SRC, FOLD_DST)}


def _compositions() -> dict[str, str]:
    """Letter with one or two combining marks, in any order, to the composed letter, for all letters of the Latin blocks."""
    out: dict[str, str] = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        c = chr(code)
        parts = unicodedata.normalize("NFD", c)
        if len(parts) > 1 and unicodedata.normalize("NFC", parts) == c:
            for marks in itertools.permutations(parts[1:]):
                typed = parts[0] + "".join(marks)
                if unicodedata.normalize("NFC", typed) == c:
                    out[typed] = c
                    if len(marks) == 2 and len(half := unicodedata.normalize("NFC", typed[:2])) == 1:
                        out[half + marks[1]] = c
    return out


COMPOSITIONS = json.dumps(_compositions(), ensure_ascii=False)


def composed(c: Column) -> Column:
    """Text with letters and their combining marks composed (NFC for the Latin blocks); only texts with a mark are worked on."""
    table = F.from_json(F.lit(COMPOSITIONS), "map<string,string>")
    # Each letter with its marks stands alone between the other runs.
    pieces = F.split(c, r"(?=\p{L}\p{M})|(?<=\p{M})(?!\p{M})")
    done = F.array_join(F.transform(pieces, lambda p: F.when(p.rlike(r"\p{M}"), F.coalesce(F.try_element_at(table, p), p)).otherwise(p)), "")
    return F.when(c.rlike(r"\p{M}"), done).otherwise(c)


def let(value: Column, body) -> Column:
    """body(value) with value worked out once a row, also where body uses it inside a lambda.

    A column that a lambda over an array captures is otherwise worked out again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokens(c: Column, stop: list[str] | tuple[str, ...] = ()) -> Column:
    """Lower-case word tokens in order, repeats kept, stop words left out; null gives an empty array."""
    found = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(f"({WORD})"), 1)
    return F.filter(found, lambda t: ~t.isin(*stop)) if stop else found


def truncated(c: Column, limit: int = 200) -> Column:
    """Text of at most limit characters, the last being an ellipsis where it was cut."""
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - 1), F.lit("…"))).otherwise(c)


def number(c: Column) -> Column:
    """A financial number as DOUBLE, null where there is none.

    Parentheses negate. All characters but digits, comma, point and minus are dropped. Marks that
    group three digits are thousands; of two kinds of mark the later one is the decimal mark.
    """
    s = F.trim(F.regexp_replace(c, " ", " "))
    body = F.regexp_replace(s, r"[^0-9,.\-]", "")
    grouped = body.rlike(r"^-?[0-9]{1,3}(\.[0-9]{3})+$") | body.rlike(r"^-?[0-9]{1,3}(,[0-9]{3})+$")
    both = body.contains(".") & body.contains(",")
    comma_last = F.length(F.substring_index(body, ",", -1)) < F.length(F.substring_index(body, ".", -1))
    text = (
        F.when(grouped, F.regexp_replace(body, "[.,]", ""))
        .when(both & comma_last, F.replace(F.replace(body, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when(both, F.replace(body, F.lit(","), F.lit("")))
        .otherwise(F.replace(body, F.lit(","), F.lit(".")))
    )
    value = F.when(text.rlike(r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)$"), text.try_cast("double"))
    negative = s.startswith("(") & s.endswith(")")
    return F.when(s.isin("", "-", "–", "—"), F.lit(None)).when(negative, -F.abs(value)).otherwise(value)

"""Units of money written in text: scale and currency, all in JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import INVISIBLE, WIDE_BLANKS, fold

# Spellings after folding (lower case, no accents).
SCALES = (
    (1e12, r"(?:nghin|ngan|thousand) ?(?:ty|ti|billion)|trillion|1[.,]000[.,]000[.,]000[.,]000"),
    (1e9, r"ty|ti|billion|bn|1[.,]000[.,]000[.,]000"),
    (1e6, r"trieu|tr\.?|million|mil|mn|mio|1[.,]000[.,]000"),
    (1e3, r"nghin|ngan|thousand|k|1[.,]000|1000"),
)
CURRENCIES = (
    ("SGD", r"do la singapore|singapore dollars?|sgd|s\$"),
    ("USD", r"do la my|do la|us dollars?|dollars?|usd|us\$|\$"),
    ("EUR", r"euro?|€"),
    ("CNY", r"nhan dan te|cny|rmb|yuan"),
    ("JPY", r"yen nhat|yen|jpy|¥"),
    ("GBP", r"bang anh|gbp|£"),
    ("VND", r"dong viet nam|viet nam dong|dong vn|dong|vnd|d|₫"),
)
_SCALE = "|".join(p for _, p in SCALES)
_CUR = "|".join(p for _, p in CURRENCIES)
#: Words before "dong" that make it part of another word pair (contract, board, activity, labour, change, community).
_NOT_BEFORE = "".join(f"(?<!{w} )" for w in ("hop", "hoi", "hoat", "lao", "bien", "cong", "tac", "co", "dong"))
UNIT = rf"(?<![a-z0-9]){_NOT_BEFORE}(?:(?:{_SCALE}) ?)?(?:{_CUR})(?: (?:trillion|billion|million|thousand|bn|mn))?(?![a-z0-9])"
KEYWORD = r"(?:don vi(?: tinh)?(?: tien te)?|dvt|unit|currency)[^a-z0-9]*"


def _clean(c: Column) -> Column:
    return F.trim(F.regexp_replace(fold(c), r"[\s ]+", " "))


def unit_phrase(c: Column) -> Column:
    """The last unit phrase in a text, folded; null if there is none."""
    found = F.regexp_extract_all(_clean(c), F.lit(f"({UNIT})"), 1)
    return F.when(F.size(found) > 0, F.element_at(found, -1))


def declared_phrase(c: Column) -> Column:
    """The unit phrase that follows a word like "unit:"; null if there is none."""
    got = F.regexp_extract(_clean(c), rf"(?<![a-z]){KEYWORD}({UNIT})", 1)
    return F.when(got != "", got)


def scale_of(phrase: Column) -> Column:
    out = F.lit(1.0)
    for factor, p in reversed(SCALES):
        out = F.when(phrase.rlike(rf"(?<![a-z0-9])(?:{p})(?= ?(?:{_CUR})(?![a-z0-9]))|(?<= )(?:{p})$"), F.lit(factor)).otherwise(out)
    return F.when(phrase.isNotNull(), out)


def currency_of(phrase: Column) -> Column:
    out = F.lit(None).cast("string")
    for code, p in reversed(CURRENCIES):
        out = F.when(phrase.rlike(rf"(?<![a-z])(?:{p})(?![a-z])|(?:tr\.?|k)(?:{p})$"), F.lit(code)).otherwise(out)
    return out


#: Blanks and invisible signs vanish from amounts, dashes become a minus, full-width digits ordinary.
_AMOUNT_SRC = "−–—" + "".join(map(chr, range(0xFF01, 0xFF5F))) + " \t\r\n\x0b\x0c" + WIDE_BLANKS + INVISIBLE
_AMOUNT_DST = "---" + "".join(map(chr, range(0x21, 0x7F)))
_AMOUNT = r"^[-+(]*[0-9]+(?:[.,][0-9]+)*\)?$"


def is_amount(c: Column) -> Column:
    """Whether `amount` finds a number; cheaper as a filter than the number itself."""
    return F.translate(c, _AMOUNT_SRC, _AMOUNT_DST).rlike(_AMOUNT)


def amount(c: Column) -> Column:
    """The number in a cell as DOUBLE, null where there is none.

    `(1.234)` and a leading minus negate; three digits after a separator are thousands, any other
    number of digits after the last separator are decimals; blanks of any kind inside are dropped.
    """
    s = F.translate(c, _AMOUNT_SRC, _AMOUNT_DST)
    points = F.translate(s, ",()+-", ".")
    last = F.length(F.substring_index(points, ".", -1))
    whole = (last == 3) | ~points.contains(".")
    value = F.translate(points, ".", "").try_cast("double") / F.when(whole, F.lit(1.0)).otherwise(F.pow(F.lit(10.0), last.cast("double")))
    negative = s.startswith("-") | (s.startswith("(") & s.endswith(")"))
    return F.when(s.rlike(_AMOUNT), F.when(negative, -value).otherwise(value))

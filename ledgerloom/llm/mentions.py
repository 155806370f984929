"""Company names typed freely in questions, mapped to the entries of a reference list.

A multi-pattern automaton over canonical names and aliases finds embedded mentions; of overlapping ones the
longest wins. No sentence shape is assumed: a question's words are labelled by what they may be in a name
(legal form, sector, word of the list's names, capitals, code), runs of such words are spans, and a span is
compared as it stands, then by edit distance without blanks, then by the overlap of token sets, where rare
tokens weigh more and a token may have a slip. A span that is evidently a company's name or code but close
to no entry is reported as NONE.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from ..functions.text import fold_text
from .oneform import one_form

NONE = "NONE"
#: Least weighted overlap of token sets, and how far it must be ahead of the next entry's.
OVERLAP, AHEAD = 0.8, 0.05
#: Largest reference list that is sent to every worker (about 200 bytes an entry).
MAX_ENTRIES = 100_000

# Sectors of the list with their English words, folded.
SECTORS = {
    "bao bi": "packaging", "ban le": "retail", "bat dong san": "real estate", "cang bien": "seaport", "cao su": "rubber", "cap nuoc": "water",
    "chung khoan": "securities", "det may": "textile", "dien luc": "power", "du lich": "tourism", "duoc pham": "pharma", "giay": "paper",
    "go noi that": "furniture", "hoa chat": "chemicals", "khoang san": "minerals", "mia duong": "sugar", "nhua": "plastics", "phan bon": "fertilizer",
    "tap doan": "group", "thep": "steel", "thuc an chan nuoi": "feed", "thuy san": "seafood", "van tai bien": "shipping", "vien thong": "telecom",
    "xay dung": "construction", "xi mang": "cement", "ngan hang": "commercial bank",
}
#: Legal forms, folded; longest first.
LEGAL = (
    "ngan hang thuong mai co phan", "tong cong ty co phan", "cong ty co phan", "tong cong ty cp", "joint stock company", "joint stock co", "ngan hang tmcp", "cong ty cp", "tong cong ty",
    "c ty co phan", "cty co phan", "tong cty cp", "joint stock", "corporation", "tong cty", "c ty cp", "cty cp", "nh tmcp", "nhtmcp", "cong ty", "ct cp", "ctcp", "c ty", "corp", "tmcp", "nha bang", "cong ty tnhh", "tnhh",
    "company", "cty", "tct", "jsc", "inc", "ltd", "ct", "cp", "co", "nh", "ma",
)

#: Forms of banks, which tell a bank from other entries of its brand.
BANKS = ("ngan hang thuong mai co phan", "ngan hang tmcp", "nh tmcp", "nhtmcp", "nha bang", "nh")
#: Forms that need a word of a name beside them to say that a company is meant.
_WEAK = {"cong ty", "company", "co", "ct", "cp", "nh", "ma", "cty", "tct", "c ty", "tong cong ty", "tong cty", "nha bang", "corporation"}
# Words of questions, units and figures, with accents; a name is never made of these alone.
_COMMON = frozenset(
    """
    năm là có của và với trong tại cuối đầu bao nhiêu mấy bằng đạt ghi nhận công bố cho biết hãy tìm tính xin hỏi theo báo cáo số liệu so giữa bên nào lớn nhỏ nhất cao thấp hơn
    chênh lệch mà hợp các từ đến quý tháng ngày đơn vị về thì được này đó như sau trước hay hoặc vào toàn danh sách trung bình tổng cộng hãng mã sở hữu triệu tỷ tỉ nghìn ngàn đồng
    hai ba bốn sánh vì sao tôi muốn xem nếu ai máy móc thiết bị nguồn vốn kiến vật vnd vnđ vn usd eur euro sgd jpy cny gbp yen yên nhật đô mỹ singapore billion million thousand trđ tr đ việt nam trăm phần bn mn us
    what which how much many the of and for is was were to between than with who year net total revenue profit income assets bctc roe roa roi eps vas ifrs gaap vat q1 q2 q3 q4
    ctcp tmcp tnhh tct jsc ceo cfo hđqt bđs tscđ đvt ngoài
    """.split()
)
_MONEY = frozenset("vnd usd eur sgd jpy cny gbp trd roe roa roi eps vas ifrs gaap vat bctc".split())
_COMMON_FOLDED = frozenset(map(fold_text, _COMMON))
_REMEMBERED = 100_000
_SYLLABLE = re.compile(r"(?:ngh?|nh|gh|gi|kh|ph|th|tr|ch|qu|[bcdghklmnprstvx])?[aeiouy]{1,3}(?:ch|ng|nh|[cmnpt])?")
_CODE = re.compile(r"(?=[a-z0-9]*[a-z])[a-z0-9]{2,5}")
_WORD = re.compile(r"[^\W_]+")
_BREAKS = re.compile(r"[^a-z0-9]+")
_TELEX = ((re.compile(r"([aeod])\1"), r"\1"), (re.compile(r"w"), ""), (re.compile(r"(?<=[a-z])[sfrxj]\b"), ""))


def words(s: str) -> str:
    return _BREAKS.sub(" ", s).strip()


def bare(s: str) -> str:
    """Name without legal forms; s is folded words."""
    s = f" {s} "
    for form in LEGAL:
        while f" {form} " in s:
            s = s.replace(f" {form} ", " ")
    return s.strip()


def edits(a: str, b: str, limit: int) -> int:
    """Edit distance with neighbours swapped as one edit; limit + 1 if it is more than limit."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    prev2, prev = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            v = min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y))
            if prev2 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, prev2[j - 2] + 1)
            cur.append(v)
        if min(cur) > limit:
            return limit + 1
        prev2, prev = prev, cur
    return prev[-1]


def grams(s: str) -> list[str]:
    """Two-letter groups in order."""
    s = f"^{s}$"
    return [s[i : i + 2] for i in range(len(s) - 1)]


def dropped(s: str) -> set[str]:
    """s and s with one letter left out; strings one edit apart share one of these."""
    return {s, *(s[:i] + s[i + 1 :] for i in range(len(s)))}


_SECTOR_WORDS = {w for k, v in SECTORS.items() for w in f"{k} {v}".split()}


class Matcher:
    """Automaton and similarity index over (ticker, name) entries."""

    def __init__(self, entries: list[tuple[str, str]]):
        import ahocorasick

        self.tickers = {t.lower(): t for t, _ in entries}
        self.aliases: dict[str, set[str]] = defaultdict(set)
        brands: dict[str, set[str]] = defaultdict(set)
        self.sector: dict[str, str] = {}
        for ticker, name in entries:
            full = words(fold_text(one_form(name)))
            sector, brand = self.parts(full)
            self.sector[ticker] = sector
            self.aliases[full].add(ticker)
            brands[brand].add(ticker)
            if sector:
                en = SECTORS[sector]
                for alias in (f"{sector} {brand}", f"{brand} {sector}", f"{brand} {en}", f"{en} {brand}"):
                    self.aliases[alias].add(ticker)
            if sector == "ngan hang":
                for form in BANKS:
                    self.aliases[f"{form} {brand}"].add(ticker)
        for brand, of in brands.items():
            if len(of) == 1:
                self.aliases[brand] |= of
        # Words of brands: folded to the spellings with accents.
        self.syllables: dict[str, set[str]] = defaultdict(set)
        for _, name in entries:
            rest = set(self.parts(words(fold_text(one_form(name))))[1].split())
            for w in _WORD.findall(one_form(name)):
                if (f := fold_text(w)) in rest:
                    self.syllables[f].add(w.lower())
        self.classes = Phrases([*SECTORS, *SECTORS.values()])
        # Sectors and legal forms without blanks, with one letter left out too, for words with a slip.
        self.blurred: dict[str, list[tuple[str, str, frozenset[str]]]] = defaultdict(list)
        self.class_words = {w for p in (self.classes, _LEGAL_WORDS) for x in p.all for w in x.split() if len(w) > 1}
        for kind, phrases in (("S", self.classes), ("L", _LEGAL_WORDS)):
            for x in phrases.all:
                solid = x.replace(" ", "")
                if len(solid) >= 6 or kind == "S" and len(solid) >= 4:
                    for v in dropped(solid):
                        self.blurred[v].append((kind, x, frozenset(x.split())))
        self.auto = ahocorasick.Automaton()
        for alias, of in self.aliases.items():
            self.auto.add_word(f" {alias} ", (alias, of))
        if len(self.auto):
            self.auto.make_automaton()
        # Similarity: aliases without blanks, under their two-letter groups.
        self.solid: dict[str, set[str]] = defaultdict(set)
        for alias, of in self.aliases.items():
            self.solid[alias.replace(" ", "")] |= of
            name = bare(alias)
            self.solid[name.replace(" ", "")] |= brands.get(name, of)  # a brand of several says nothing alone
        self.index: dict[tuple[str, int], list[str]] = defaultdict(list)
        for s in self.solid:
            for k, g in enumerate(grams(s)):
                self.index[g, k].append(s)
        self.seen: dict[str, tuple[str | None, int]] = {}
        self.touching: dict[str, bool] = {}
        self.blurs: dict[str, list[tuple[str, str, frozenset[str]]]] = {}

        # Token sets of each entry, under the tokens of its brand and those with one letter left out.
        self.sets: dict[str, tuple[set[str], list[set[str]]]] = {}
        for ticker, name in entries:
            full = words(fold_text(one_form(name)))
            sector, brand = self.parts(full)
            own = set(brand.split())
            sets = [own, own | set(sector.split()), own | set(SECTORS.get(sector, "").split()), set(bare(full).split())]
            self.sets[ticker] = own, [x for k, x in enumerate(sets) if x and x not in sets[:k]]
        self.holders: dict[str, set[str]] = defaultdict(set)
        df: dict[str, int] = defaultdict(int)
        for ticker, (own, sets) in self.sets.items():
            for t in own:
                self.holders[t].add(ticker)
            for t in set().union(*sets):
                df[t] += 1
        self.weight = {t: math.log(1 + len(self.sets) / n) for t, n in df.items()}
        self.rarest = math.log(1 + len(self.sets))
        self.near: dict[str, set[str]] = defaultdict(set)
        for t in self.holders:
            for v in dropped(t):
                self.near[v].add(t)

    @staticmethod
    def parts(full: str) -> tuple[str, str]:
        """Sector and brand of a canonical name; a group or a bank counts as sector only without another one."""
        rest = bare(full)
        bank = full.startswith("ngan hang")
        for s in sorted(SECTORS, key=len, reverse=True):
            if s not in ("tap doan", "ngan hang") and f" {s} " in f" {rest} ":
                return s, bare(f" {rest} ".replace(f" {s} ", " ").replace(" tap doan ", " ").strip())
        if f" tap doan " in f" {rest} ":
            return "tap doan", f" {rest} ".replace(" tap doan ", " ").strip()
        return ("ngan hang" if bank else ""), rest

    def mentions(self, text: str) -> list[tuple[int, int, str, set[str]]]:
        """Longest non-overlapping aliases in folded words: start, end, alias, tickers."""
        if not len(self.auto):
            return []
        padded = f" {text} "
        hits = [(end - len(a) - 1, end - 1, a, of) for end, (a, of) in self.auto.iter(padded)]
        out: list[tuple[int, int, str, set[str]]] = []
        for h in sorted(hits, key=lambda h: (h[0] - h[1], h[0])):
            if all(h[1] < o[0] or h[0] > o[1] for o in out):
                out.append(h)
        return out

    def covers(self, slot: str, ticker: str, alias: str) -> bool:
        """Whether a mention accounts for the whole slot but legal forms (one slip allowed), the code and the entry's own sector."""
        sector = self.sector[ticker]
        own = [w for w in (sector, SECTORS.get(sector, ""), "tap doan", "group", ticker.lower()) if w]
        for rest in f" {slot} ".split(f" {alias} ", 1):
            rest = f" {rest.strip()} "
            for w in own:
                rest = rest.replace(f" {w} ", " ")
            if bare(rest.strip()) and not any(edits(rest.replace(" ", ""), form.replace(" ", ""), 1) <= 1 for form in LEGAL if len(form) > 3):
                return False
        return True

    def paired(self, toks: set[str], names: set[str]) -> tuple[set[str], set[str], int]:
        """Tokens of a slot and of a name that go together, and the slips in them."""
        same = toks & names
        left, rest, slips = set(same), set(same), 0
        for t in sorted(toks - same):
            fits = [n for n in sorted(names - rest) if min(len(t), len(n)) >= 3 and edits(t, n, 1) <= 1]
            if fits:
                left.add(t)
                rest.add(fits[0])
                slips += 1
        return left, rest, slips

    def overlap(self, slot: str) -> str:
        """The one entry whose token set overlaps the slot's most, by weight and far enough, else NONE.

        Two tokens of the brand, or all of it, must be there, and a sector that isn't the entry's own rules it
        out. Slips are as many as `nearest` allows, never in all tokens of the brand, and none beside an added token.
        """
        toks = {t for t in bare(slot).split() if t not in self.tickers}
        heavy = lambda ts: sum(self.weight.get(t, self.rarest) for t in ts)
        limit = 1 if sum(map(len, toks)) < 14 else 2
        score: dict[str, float] = {}
        for ticker in {k for t in toks for v in dropped(t) for n in self.near.get(v, ()) for k in self.holders[n]}:
            own, sets = self.sets[ticker]
            for names in sets:
                left, rest, slips = self.paired(toks, names)
                extra = toks - left
                if slips > limit or slips and extra or extra & _SECTOR_WORDS or not own & toks or len(own & rest) < min(2, len(own)):
                    continue
                both = heavy(rest)
                score[ticker] = max(score.get(ticker, 0.0), 2 * both / (2 * both + heavy(names - rest) + heavy(extra)) - 0.01 * slips)
        if not score:
            return NONE
        ranked = sorted(score.items(), key=lambda x: -x[1])
        ahead = len(ranked) == 1 or ranked[0][1] - ranked[1][1] >= AHEAD
        return ranked[0][0] if ranked[0][1] >= OVERLAP and ahead else NONE

    def similar(self, span: str) -> tuple[str | None, int]:
        """The one entry whose name, written without blanks, is the same but for a slip of typing, and the slips."""
        if span not in self.seen:
            if len(self.seen) > _REMEMBERED:
                self.seen.clear()
            self.seen[span] = self.slipped(span)
        return self.seen[span]

    def slipped(self, span: str) -> tuple[str | None, int]:
        core = bare(span)
        toks = core.split()
        if toks and toks[-1] in self.tickers and len(toks) > 1:
            core = " ".join(toks[:-1])
        typed = core
        for p, r in _TELEX:  # accents left as the keys that type them
            typed = p.sub(r, typed)
        # A name as it stands goes before one without its legal form, and that before one without its group word.
        limit = 1 if len(core.replace(" ", "")) < 14 else 2
        for forms in ({span}, {typed, core}, {core.replace("tap doan ", "")}):
            near, d = self.nearest({f.replace(" ", "") for f in forms}, limit)
            if len(near) == 1:
                return next(iter(near)), d
        return None, 9

    def nearest(self, forms: set[str], limit: int) -> tuple[set[str], int]:
        """Entries with an alias within the slips allowed of one of the forms, the fewest slips only, and the slips."""
        best: dict[str, int] = {}
        for form in forms:
            if len(form) < 4:
                continue
            if form in self.solid:
                for t in self.solid[form]:
                    best[t] = 0
                continue
            seen: dict[str, int] = defaultdict(int)
            gs = grams(form)
            for k, g in enumerate(gs):
                for at in range(k - limit, k + limit + 1):
                    for s in self.index.get((g, at), ()):
                        seen[s] += 1
            for s, n in seen.items():
                # One edit changes at most three two-letter groups.
                if n >= len(gs) - 3 * limit and abs(len(s) - len(form)) <= limit and (d := edits(form, s, limit)) <= limit:
                    for t in self.solid[s]:
                        best[t] = min(best.get(t, 9), d)
        low = min(best.values(), default=9)
        return {t for t, d in best.items() if d == low}, low

    # ---- spans of a question that can be names

    def read(self, question: str) -> list["Word"]:
        """Words of a question with what each may be in a name."""
        text = one_form(question)
        out: list[Word] = []
        end = 0
        for m in _WORD.finditer(text):
            raw = m[0]
            gap = text[end : m.start()]
            end = m.end()
            out.append(Word(raw, raw.lower(), fold_text(raw), gap))
        letters = [w for w in out if w.raw[0].isalpha()]
        large = sum(w.raw.isupper() and len(w.raw) > 1 for w in letters)
        titled = sum(w.titled for w in letters)
        shouting, headline = large * 2 > len(letters) > 3, titled * 5 > len(letters) * 4 and len(letters) > 6
        folded = [w.fold for w in out]
        for kind, phrases in (("S", self.classes), ("L", _LEGAL_WORDS)):
            i = 0
            while i < len(out):
                n = next((n for n in range(min(phrases.longest.get(folded[i], 0), len(out) - i), 0, -1) if " ".join(folded[i : i + n]) in phrases.all and all(w.near for w in out[i + 1 : i + n])), 0)
                said = " ".join(folded[i : i + n])
                # Short forms look like everyday words unless they stand in capitals or with a point.
                if n and not (kind == "L" and (said == "ma" or said in ("co", "ct", "cp", "nh", "inc", "ltd") and not out[i].raw[0].isupper())):
                    for w in out[i : i + n]:
                        w.kind, w.phrase = kind, said
                i += max(n, 1)
        self.mark_blurred(out)
        # Where accents are typed, a word without them isn't the everyday word that has them.
        accented = sum(w.low != w.fold for w in letters) * 4 > len(letters)
        for i, w in enumerate(out):
            if w.kind:
                continue
            common = w.low in _COMMON or not accented and w.low == w.fold and w.fold in _COMMON_FOLDED
            known = w.fold in self.syllables and (w.low == w.fold or w.low in self.syllables[w.fold])
            camel = len(w.fold) > 5 and any(x.islower() and y.isupper() for x, y in zip(w.raw, w.raw[1:]))
            marked = i > 0 and out[i - 1].low in ("mã", "ma") and w.near or w.gap.endswith("(") and (i + 1 == len(out) or ")" in out[i + 1].gap)
            alone = not (w.raw.isalpha() and any(o.raw.isupper() and len(o.raw) > 1 and o.kind != "L" and o.fold not in _MONEY and o.fold not in self.tickers for o in ([out[i - 1]] if i and w.near else []) + ([out[i + 1]] if i + 1 < len(out) and out[i + 1].near else [])))
            if _CODE.fullmatch(w.low) and not common and not w.raw.isdigit():
                listed, foreign = w.low in self.tickers, not _SYLLABLE.fullmatch(w.low)
                shown = w.raw.isupper() and not shouting and alone
                if listed and (shown or marked or foreign) or shown and (len(w.raw) > 2 or marked) or marked and (len(w.raw) == 3 and (foreign or i and out[i - 1].low == "mã") or w.raw.isupper()) or len(w.raw) == 3 and foreign and re.search("[jwzf0-9]|q(?!u)", w.low) and re.match("[a-z]", w.low) and not known:
                    w.kind = "K"
                    continue
            if w.raw.isdigit():
                continue
            w.common = common
            if not common and (known or len(w.fold) > 5 and w.fold in self.solid):
                w.kind = "B"
            elif w.fold.isascii() and not common and not headline and not shouting and (camel or w.titled and i > 0):
                w.kind = "C"
            elif known:
                w.kind, w.edge = "W", True
            else:
                w.edge = w.titled and not headline or not common and (len(w.fold) < 3 or w.fold in _SECTOR_WORDS or self.touches(w.fold))
        for i, w in enumerate(out):  # an everyday word that stands in capitals beside a word of a name
            if w.kind == "W" and w.titled and (i and w.near and out[i - 1].kind in ("B", "C", "S", "L") or i + 1 < len(out) and out[i + 1].near and (out[i + 1].kind in ("B", "C") or out[i + 1].kind == "W" and out[i + 1].titled)):
                w.kind, w.common = "B", False
        for k in (1, -1) if not shouting else ():  # words in capitals beside a name in capitals
            for i in range(len(out))[::k]:
                w, j = out[i], i - k
                if not w.kind and not w.common and len(w.raw) > 1 and w.raw.isupper() and 0 <= j < len(out) and (w if k > 0 else out[j]).near and out[j].kind in ("B", "C", "S") and not out[j].slip and out[j].raw.isupper() and len(out[j].raw) > 1:
                    w.kind = "C"
        return out

    def touches(self, word: str) -> bool:
        """Whether a word is at most a slip away from a word of the list's names."""
        if word not in self.touching:
            if len(self.touching) > _REMEMBERED:
                self.touching.clear()
            self.touching[word] = any(v in self.near for v in dropped(word))
        return self.touching[word]

    def mark_blurred(self, out: list["Word"]) -> None:
        """Sectors and legal forms with one slip of typing."""
        for i, first in enumerate(out):
            if first.kind == "S":
                continue
            if not first.kind and 3 <= len(first.fold) <= 5 and first.raw[0].isupper() and sum(map(str.isupper, first.raw)) * 2 > len(first.raw) and first.low not in self.tickers and first.low not in _COMMON and any(edits(first.low, x, 1) <= 1 for x in ("ctcp", "tmcp", "tnhh")):
                first.kind, first.phrase = "L", "ctcp"
                continue
            solid, hit, n, some = "", None, 0, False
            for j in range(i, min(i + 6, len(out))):
                w = out[j]
                if j > i and not w.near or w.raw.isdigit():
                    break
                solid += w.fold
                some = some or w.fold in self.class_words
                if len(solid) > 30:
                    break
                if len(solid) > 3 and not w.kind and (some or j == i and w.low not in _COMMON):
                    for kind, x, parts in self.blurs_of(solid):
                        # Of several words one at least stands as it is.
                        if (j == i if len(parts) == 1 and not first.kind else any(o.fold in parts for o in out[i : j + 1])) and (len(x) > 5 or first.titled or j + 1 < len(out) and out[j + 1].near and out[j + 1].fold in self.syllables):
                            hit, n = (kind, x), j + 1
            if hit:
                for w in out[i:n]:
                    (w.kind, w.phrase), w.slip = hit, True

    def blurs_of(self, solid: str) -> list[tuple[str, str, frozenset[str]]]:
        """Sectors and legal forms at most a slip away from letters without blanks."""
        if solid not in self.blurs:
            if len(self.blurs) > _REMEMBERED:
                self.blurs.clear()
            self.blurs[solid] = list(dict.fromkeys(b for v in dropped(solid) for b in self.blurred.get(v, ()) if edits(solid, b[1].replace(" ", ""), 1) <= 1))
        return self.blurs[solid]

    def spans(self, out: list["Word"]) -> list[tuple[int, int]]:
        """Runs of words that belong together as one name."""
        got: list[tuple[int, int]] = []
        i = 0
        while i < len(out):
            if not out[i].kind:
                i += 1
                continue
            j = i + 1
            while j < len(out):
                w, before = out[j], out[j - 1]
                if w.kind == "L" and not w.near:
                    # A legal form behind a comma or dash ends a name; one that begins the next name doesn't belong here.
                    end = next((k for k in range(j + 1, len(out)) if not (out[k].near and out[k].kind == "L")), len(out))
                    joined = w.gap.strip() in (",", "-", ", -", ".", "(", ".,") and before.kind != "K" and (end == len(out) or not out[end].near or not out[end].kind)
                else:
                    joined = bool(w.kind) and (w.near and not (w.kind == "K" and before.kind == "K") or w.kind == "K" and w.gap.strip() in ("(", ".(", ". ("))
                if joined:
                    j += 1
                elif w.near and not w.kind and not w.raw.isdigit() and (not w.common or w.titled) and (w.edge or not _SYLLABLE.fullmatch(w.fold)) and before.kind in ("B", "C", "S", "L", "W") and j + 1 < len(out) and out[j + 1].near and out[j + 1].kind in ("B", "C", "S", "W"):
                    j += 2
                else:
                    break
            got.append((i, j))
            i = j
        return got

    def named(self, out: list["Word"], a: int, b: int) -> bool:
        """Whether a span is a company's name even if no entry is like it."""
        span = out[a:b]
        own = [w for w in span if w.kind in ("B", "C", "W")]
        if all(w.kind == "W" for w in own):
            own = []
        if any(w.kind == "K" for w in span):
            return True
        strong = any(w.kind == "L" and w.phrase not in _WEAK for w in span)
        weak = any(w.kind == "L" for w in span)
        follows = b < len(out) and out[b].near and not out[b].common and not out[b].raw.isdigit()
        if strong and (own or follows and span[-1].kind in ("L", "S") and (any(w.kind == "S" for w in span) or out[b].titled)):
            return True
        run, sure = 0, False
        for w in span:
            if w.kind not in ("B", "C", "W"):
                run, sure = 0, False
                continue
            run += w.kind != "W"
            sure = sure or w.kind == "B" or w.kind == "C" and w.titled
            if run > 1 and sure:
                return True
        if not own:  # capitals like a sector's name with a slip and nothing else
            return sum(w.slip and w.titled for w in span) > 1
        one = own[0]
        if any(w.kind == "S" for w in span) or weak:
            return one.titled or one.low != one.fold
        return one.kind == "C" and len(one.fold) > 3 and not _SYLLABLE.fullmatch(one.fold)

    def found(self, question: str | None) -> list[str]:
        """Tickers a question names, in order, each once; NONE for a name off the list; nothing if it names none."""
        out = self.read(question or "")
        answers: list[str] = []
        done = 0
        for a, b in self.spans(out):
            if a < done:
                continue
            hit, upto = self.settled(out, a, b, done)
            if hit:
                answers.append(hit)
                done = upto
        return list(dict.fromkeys(answers))

    def settled(self, out: list["Word"], a: int, b: int, done: int) -> tuple[str | None, int]:
        """Entry, NONE or nothing for a span, and where it ends; words beside it may belong to it."""
        text = lambda i, j: " ".join(w.fold for w in out[i:j])
        span = out[a:b]
        own = any(w.kind in ("B", "C", "W") for w in span)
        if not own and any(w.kind == "K" for w in span):
            code = next(w.low for w in span if w.kind == "K")
            return self.tickers.get(code, NONE), b
        if len(span) == 1 and span[0].raw in ("JSC", "INC", "LTD"):
            return NONE, b  # a form that stands where a name would is a code
        if not own and not any(w.kind == "L" for w in span) and len(span) < 2:
            return None, b
        evident = self.named(out, a, b)
        lefts, rights = [a], [b]
        sure = any(w.kind in ("B", "C", "S", "L") for w in span)
        beside = lambda w: w.edge and (sure or not w.common or w.titled)
        while a - lefts[-1] < 2 and lefts[-1] > done and out[lefts[-1]].near and beside(out[lefts[-1] - 1]):
            lefts.append(lefts[-1] - 1)
        while rights[-1] - b < 2 and rights[-1] < len(out) and out[rights[-1]].near and beside(out[rights[-1]]):
            rights.append(rights[-1] + 1)
        # Everyday words at the ends may stand outside the name.
        for at, step, ends in ((a, 1, lefts), (b, -1, rights)):
            while lefts[0] < rights[0] and a < at + step < b and (out[at if step > 0 else at - 1].kind == "W" or out[at if step > 0 else at - 1].titled and at == 0):
                at += step
                ends.append(at)
        tries = sorted({(i, j) for i in lefts for j in rights if i < j}, key=lambda x: (x[0] - x[1], x[0]))
        for i, j in tries:
            if (t := self.exact(text(i, j))) != NONE:
                # A longer name with a slip goes before a shorter one that ends inside it.
                wider = [(d, x, y) for p, q in tries if p <= i and q >= j and q - p > j - i for x, d in [self.similar(text(p, q))] if x and d < 2 for y in [q]]
                return min(wider)[1:] if wider else (t, j)
        near = [(d, i - j, t, j) for i, j in tries for t, d in [self.similar(text(i, j))] if t and (d == 0 or any(w.kind != "W" for w in out[i:j]))]
        if near:
            _, _, t, j = min(near)
            return t, j
        if not evident:
            return None, b
        if own:
            i, j = min(lefts), max(rights)
            t = self.overlap(text(i, j))
            code = next((w.low for w in span if w.kind == "K"), None)
            return (self.tickers.get(code, NONE) if t == NONE and code else t), b
        return NONE, b

    def exact(self, span: str) -> str:
        """The entry with an alias that accounts for the whole span, else NONE."""
        for _, _, alias, of in self.mentions(span):
            fit = [t for t in of if self.covers(span, t, alias)]
            if len(fit) == 1:
                return fit[0]
        return NONE


class Word:
    """A word of a question: as typed, lower, folded, what stands before it, and its part in a name.

    kind: L legal form, S sector, B word of the list's names, W one that is also an everyday word, C capitalised, K code,
    else empty. edge: it may
    belong to a name beside it. common: a word of questions.
    """

    __slots__ = ("raw", "low", "fold", "gap", "near", "titled", "kind", "phrase", "edge", "common", "slip")

    def __init__(self, raw: str, low: str, fold: str, gap: str):
        self.raw, self.low, self.fold, self.gap = raw, low, fold, gap
        self.near = gap.strip() in ("", ".", "'", "’") or gap == "-" or gap == "/"
        self.titled = raw[0].isupper() and not (raw.isupper() and len(raw) > 1)
        self.kind = self.phrase = ""
        self.edge = self.common = self.slip = False


class Phrases:
    """Word groups by their first word, with the length of the longest that begins with it."""

    def __init__(self, phrases):
        self.all = frozenset(phrases)
        self.longest: dict[str, int] = {}
        for p in self.all:
            first = p.split(" ", 1)[0]
            self.longest[first] = max(self.longest.get(first, 0), p.count(" ") + 1)


_LEGAL_WORDS = Phrases(LEGAL)


def map_mentions(questions: DataFrame, companies: DataFrame, id_col: str = "id", text_col: str = "question") -> DataFrame:
    """One row per question and entry it names: id, ticker (NONE for a name off the list).

    Null and empty questions, and those naming nothing, give no row. Repeated questions are mapped once
    per id. The reference list is bounded by MAX_ENTRIES and goes to the workers; questions never meet
    it in a join, each is matched where it lies, so skew in the names costs nothing.
    """
    entries = [(r[0], r[1]) for r in companies.select("ticker", "name").dropna().limit(MAX_ENTRIES + 1).collect()]
    if len(entries) > MAX_ENTRIES:
        raise ValueError(f"the reference list has more than {MAX_ENTRIES} entries")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Matcher(entries)
        for pdf in batches:
            rows = [(i, t) for i, q in zip(pdf[id_col], pdf[text_col]) for t in m.found(q)]
            yield pd.DataFrame(rows, columns=[id_col, "ticker"])

    kind = questions.schema[id_col].dataType.simpleString()
    return questions.select(id_col, text_col).mapInPandas(run, f"{id_col} {kind}, ticker string").distinct()

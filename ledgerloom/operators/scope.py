"""What a question is about: companies, years, report variant and financial concepts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import WORD, composed, fold, tokens
from ..session import join_checked, settle
from .index import STOP_WORDS

# Vocabularies of scope resolution.
TICKER = r"^(?=.*[A-Z])[A-Z0-9]{2,5}$"
NOT_TICKERS = ("BCTC", "CTCP", "TMCP", "TCT", "TNHH", "VND")
NAME_NOISE = ("công", "ty", "cổ", "phần", "tổng", "ngân", "hàng")
PHRASE_NOISE = (*NAME_NOISE, "ctcp", "tmcp", "tct", "tnhh", "tập", "đoàn", "việt", "nam")
SEPARATE_WORDS = ("công ty mẹ", "công ty riêng", "bctc riêng", "báo cáo tài chính riêng")
CONSOLIDATED_WORDS = ("hợp nhất", "tập đoàn", "bctc hợp nhất")
LINE_ITEMS = (
    "doanh thu thuần", "lợi nhuận sau thuế", "lợi nhuận trước thuế", "lợi nhuận gộp", "lợi nhuận thuần từ hoạt động kinh doanh", "vốn chủ sở hữu",
    "tổng tài sản", "tổng cộng tài sản", "nợ phải trả", "nợ ngắn hạn", "tài sản ngắn hạn", "hàng tồn kho", "tài sản cố định",
    "lưu chuyển tiền thuần từ hoạt động kinh doanh", "chi phí lãi vay", "giá vốn hàng bán",
)
RATIOS = {
    "roe": ["vốn chủ sở hữu", "lợi nhuận sau thuế"],
    "roa": ["tổng cộng tài sản", "lợi nhuận sau thuế"],
    "vòng quay tổng tài sản": ["doanh thu thuần", "tổng tài sản"],
    "vòng quay tài sản cố định": ["doanh thu thuần", "tài sản cố định"],
    "vòng quay hàng tồn kho": ["giá vốn hàng bán", "hàng tồn kho"],
    "biên lợi nhuận gộp": ["lợi nhuận gộp", "doanh thu thuần"],
    "biên lợi nhuận ròng": ["lợi nhuận sau thuế", "doanh thu thuần"],
    "biên lợi nhuận hoạt động": ["lợi nhuận thuần từ hoạt động kinh doanh", "doanh thu thuần"],
    "hệ số thanh toán nhanh": ["tài sản ngắn hạn", "hàng tồn kho", "nợ ngắn hạn"],
    "hệ số thanh toán hiện hành": ["tài sản ngắn hạn", "nợ ngắn hạn"],
    "khả năng thanh toán lãi vay": ["lợi nhuận trước thuế", "chi phí lãi vay"],
    "hệ số nợ": ["nợ phải trả", "tổng tài sản"],
    "hệ số dòng tiền": ["lưu chuyển tiền thuần từ hoạt động kinh doanh", "nợ ngắn hạn"],
}
CONCEPT_BUDGET, CONCEPT_FLOOR, CONCEPT_POOL, TICKER_CAP = 10, 2, 15, 30
#: Distinct words of names that are held against the questions' words before runs are cut.
MOST_WORDS = 20_000


def years(question: Column) -> Column:
    """Sorted years named, inclusive ranges filled in; empty for none."""
    q = F.coalesce(question, F.lit(""))
    single = F.transform(F.regexp_extract_all(q, F.lit(r"\b((?:19|20)[0-9]{2})\b"), 1), lambda y: y.cast("int"))
    pattern = r"(?iu)\b((?:19|20)[0-9]{2}\s*(?:-|–|—|đến|tới)\s*(?:19|20)[0-9]{2})\b"
    spans = F.transform(F.regexp_extract_all(q, F.lit(pattern), 1), lambda s: F.struct(F.substring(s, 1, 4).cast("int").alias("a"), F.right(s, F.lit(4)).cast("int").alias("b")))
    filled = F.flatten(F.transform(spans, lambda s: F.when(s["a"] <= s["b"], F.sequence(s["a"], F.greatest(s["a"], s["b"]))).otherwise(F.array().cast("array<int>"))))
    return F.array_sort(F.array_distinct(F.concat(single, filled)))


def variant(question: Column) -> Column:
    """separate, consolidated or null, as the question says."""
    q = F.lower(question)
    said = lambda words: F.greatest(*[q.contains(w) for w in words])
    return F.when(said(SEPARATE_WORDS), "separate").when(said(CONSOLIDATED_WORDS), "consolidated")


def code_words(text: Column) -> Column:
    """Distinct words in order that look like tickers: two to five capitals and digits, one capital at least."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), 1)
    return F.array_distinct(F.filter(found, lambda t: t.rlike(TICKER)))


def literal_codes(question: Column) -> Column:
    """code_words without the codes of legal forms and of the currency."""
    return F.filter(code_words(question), lambda t: ~t.isin(*NOT_TICKERS))


def _content(c: Column) -> Column:
    # Folded as one text, as no token holds a blank.
    kept = F.array_join(F.filter(tokens(c, STOP_WORDS), lambda t: ~t.isin(*PHRASE_NOISE)), " ")
    return F.filter(F.split(fold(kept), " "), lambda t: t != "")


def registry(companies: DataFrame) -> DataFrame:
    """ticker with its name's token arrays: content (folded, no noise) and plain (for overlap)."""
    return companies.select("ticker", _content(F.col("name")).alias("content"), F.array_distinct(F.filter(tokens(F.col("name"), STOP_WORDS), lambda t: ~t.isin(*NAME_NOISE))).alias("plain"))


def _runs(reg: DataFrame) -> DataFrame:
    """Every run of consecutive content tokens of every name: ticker, n_content, longest, run (joined), width."""
    n = F.size("content")
    r = reg.filter(n > 0).withColumn("n_content", n).withColumn("s", F.explode(F.sequence(F.lit(1), n)))
    r = r.withColumn("width", F.explode(F.sequence(F.lit(1), F.col("n_content") - F.col("s") + 1)))
    toks = F.slice("content", F.col("s"), F.col("width"))
    return r.select("ticker", "n_content", "s", "width", F.array_join(toks, " ").alias("run"), F.array_max(F.transform(toks, F.length)).alias("longest"))


def phrase_matches(questions: DataFrame, companies: DataFrame) -> DataFrame:
    """(id, ticker) of companies whose distinctive name phrase stands in the question.

    Runs of question tokens meet runs of name tokens by an equi-join; per pair the longest common run
    counts. It is accepted for a one-token name of four letters or more, for a whole name of two tokens
    or more, or for half a name by a run of four tokens (three, with one of five letters or more). A
    match strictly inside another company's longer match falls away.
    """
    runs = _runs(registry(companies))
    widest = runs.agg(F.max("width")).first()[0] or 0  # no run of question tokens longer than a name can match
    words = [r[0] for r in runs.filter("width = 1").select("run").distinct().limit(MOST_WORDS + 1).collect()]
    q = questions.select("id", _content(F.col("question")).alias("t")).filter(F.size("t") > 0)
    # A shorter run is never accepted, and where a longer one is there it isn't the longest: common words meet no names.
    runs = runs.filter("width = n_content OR (width >= 3 AND width * 2 >= n_content)")
    starts = F.sequence(F.lit(1), F.size("t"))
    if len(words) <= MOST_WORDS:
        # A run with a word that no name has can't match.
        q = q.withColumn("t", F.transform("t", lambda w: F.when(w.isin(words), w).otherwise("|")))
        starts = F.filter(starts, lambda s: F.element_at("t", s) != "|")
    q = q.withColumn("s", F.explode(starts))
    q = q.withColumn("width", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(widest), F.size("t") - F.col("s") + 1)))))
    q = q.select("id", F.array_join(F.slice("t", F.col("s"), F.col("width")), " ").alias("run")).filter(~F.col("run").contains("|"))
    # While the names' runs are few, the questions' runs stay where they lie; a hot word costs nothing then.
    best = join_checked(q, runs, "run", "inner", 160).groupBy("id", "ticker", "n_content").agg(F.max_by(F.struct("run", "width", "longest"), F.struct("width", -F.col("s"))).alias("b"))
    w, long = F.col("b.width"), F.col("b.longest")
    ok = ((F.col("n_content") == 1) & (w == 1) & (long >= 4)) | ((w == F.col("n_content")) & (w >= 2)) | ((w * 2 >= F.col("n_content")) & ((w >= 4) | ((w >= 3) & (long >= 5))))
    best = best.filter(ok).select("id", "ticker", F.col("b.run").alias("run"), F.col("b.width").alias("width"))
    others = Window.partitionBy("id")
    inside = lambda o: (o["width"] > F.col("width")) & F.concat(F.lit(" "), o["run"], F.lit(" ")).contains(F.concat(F.lit(" "), F.col("run"), F.lit(" ")))
    # At most one match per company and question; a question names few.
    seen = best.withColumn("all", F.collect_set(F.struct("run", "width")).over(others))
    return seen.filter(~F.exists("all", inside)).select("id", "ticker")


def resolved_tickers(questions: DataFrame, companies: DataFrame) -> DataFrame:
    """(id, tickers): literal codes on the list and phrase matches combined, sorted; empty where none is resolved.

    A literal that is a name token of a phrase winner is replaced by it. Without phrases, questions
    without a literal take all companies with three or more name tokens in common; those with one keep
    it, unless one single best company has it among its name tokens.
    """
    reg = registry(companies)
    q = questions.select("id", "question").dropDuplicates(["id"])
    lit = q.select("id", F.explode(literal_codes(F.col("question"))).alias("ticker"))
    lit = join_checked(lit, reg.select("ticker"), "ticker", "left_semi", 16)
    lit = lit.groupBy("id").agg(F.collect_set("ticker").alias("literal"))
    ph = join_checked(phrase_matches(q, companies), reg.select("ticker", "content"), "ticker", "inner", 200).groupBy("id").agg(F.collect_set("ticker").alias("phrase"), F.array_distinct(F.flatten(F.collect_set("content"))).alias("phrase_tokens"))
    ph = settle(ph)
    # The overlap of words counts only where there is no phrase.
    qt = q.join(ph.select("id"), "id", "left_anti").select("id", F.explode(F.array_distinct(tokens(F.col("question"), STOP_WORDS))).alias("term"))
    over = join_checked(qt, reg.select("ticker", F.explode("plain").alias("term")), "term", "inner", 40).groupBy("id", "ticker").agg(F.count("*").alias("n")).filter("n >= 3")
    over = join_checked(over, reg.select("ticker", "plain"), "ticker", "inner", 200).groupBy("id").agg(F.collect_set("ticker").alias("strong"), F.collect_list(F.struct("n", "ticker", "plain")).alias("o"))
    best_n = F.array_max(F.transform("o", lambda x: x["n"]))
    over = over.withColumn("best", F.filter("o", lambda x: x["n"] == best_n)).drop("o")
    j = q.join(lit, "id", "left").join(ph, "id", "left").join(over, "id", "left")
    none = F.array().cast("array<string>")
    literal, phrase, strong = (F.coalesce(F.col(c), none) for c in ("literal", "phrase", "strong"))
    nested = F.filter(literal, lambda t: F.array_contains(F.col("phrase_tokens"), F.lower(t)))
    single = F.get("best", F.lit(0))
    nested_one = F.filter(literal, lambda t: F.array_contains(single["plain"], F.lower(t)))
    out = (
        F.when((F.size(phrase) > 0) & (F.size(literal) > 0), F.array_union(F.array_except(literal, nested), phrase))
        .when(F.size(phrase) > 0, phrase)
        .when(F.size(literal) == 0, strong)
        .when((F.size("best") == 1) & (F.size(nested_one) > 0), F.array_union(F.array_except(literal, nested_one), F.array(single["ticker"])))
        .otherwise(literal)
    )
    return j.select("id", F.array_sort(out).alias("tickers"))


def concepts(questions: DataFrame) -> DataFrame:
    """(id, concepts): operand phrases of the ratios a question names, then its line items, each once in order.

    Line items are taken longest first; a phrase claims its letters, which no shorter one may use.
    """
    q = questions.select("id", F.lower(composed(F.coalesce("question", F.lit("")))).alias("t"))
    none = F.array().cast("array<string>")
    parts = [F.when(F.col("t").contains(k), F.array(*map(F.lit, v))).otherwise(none) for k, v in RATIOS.items()]
    # The claimed letters pass through one column per phrase, so the plan stays linear in the phrases.
    q = q.withColumn("rest", F.col("t"))
    hits = []
    for i, p in enumerate(sorted(LINE_ITEMS, key=lambda x: (-len(x), LINE_ITEMS.index(x)))):
        q = q.withColumn(f"h{i}", F.when(F.col("rest").contains(p), p)).withColumn("rest", F.replace("rest", F.lit(p), F.lit("\u0001" * len(p))))
        hits.append(f"h{i}")
    return q.select("id", F.array_distinct(F.concat(*parts, F.array_compact(F.array(*hits)))).alias("concepts"))


def concept_budget(n_companies: Column) -> Column:
    return F.when(n_companies <= 1, CONCEPT_BUDGET).otherwise(F.greatest(F.lit(CONCEPT_FLOOR), F.floor(F.lit(CONCEPT_POOL) / F.greatest(n_companies, F.lit(1))))).cast("int")

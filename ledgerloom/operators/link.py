"""Questions grounded to numeric cells: operands, their tiers and order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import composed, fold, let, number, tokens
from .extract import strip
from .scope import RATIOS, code_words, variant, years

# Fixed values.
LINK_STOP = tuple("là của và các những bao nhiêu công ty năm trong tại vào cuối đầu".split())
NOT_TICKERS = ("BCTC", "CP", "CTCP", "TMCP", "TCT", "TNHH", "VND")
ROLE_WORDS = ("maso", "ma", "code", "thuyetminh", "thuyetminhso", "note", "notes", "ghichu", "diengiai", "biendong", "phantram", "chitieu", "nguonvon")
REQUESTED_UNIT = r"(?iu)((?:nghìn\s*tỷ|tỷ|triệu|nghìn)?\s*(?:đồng|vnd|%))"
FAMILIES = (
    ("ratio_or_derived", ("roe", "roa", "tỷ lệ", "tỷ suất", "trên tài sản")),
    ("growth", ("bao nhiêu phần trăm", "tăng trưởng", "thay đổi bao nhiêu %")),
    ("aggregation", ("tổng cộng", "tổng số", "trung bình", "median", "cộng lại")),
)
COMPARISON_WORDS = ("chênh lệch", "biến động", "cao hơn", "thấp hơn", "so với")
MOST_OPERANDS, RELEVANT_TABLES, YEAR_BONUS = 120, 8, 0.05


def family(question: Column, available: Column | None = None) -> Column:
    """Shape of a question by ordered rules; available: array of tickers among its tables."""
    q = F.lower(F.coalesce(question, F.lit("")))
    said = lambda words: F.greatest(*[q.contains(w) for w in words])
    codes = code_words(question)
    several = F.lit(False) if available is None else F.size(F.filter(F.array_intersect(codes, available), lambda t: ~t.isin(*NOT_TICKERS))) > 1
    out = F.when(several, "cross_company_comparison").when(said(COMPARISON_WORDS), "comparison").otherwise("direct_lookup")
    for name, words in reversed(FAMILIES):
        out = F.when(said(words), name).otherwise(out)
    return out


def requested_unit(question: Column) -> Column:
    got = F.trim(F.regexp_extract(F.coalesce(question, F.lit("")), REQUESTED_UNIT, 1))
    return F.when(got != "", got)


def question_tokens(question: Column) -> Column:
    """Distinct linking tokens of a question and of the operands of the ratios it names."""
    q = F.lower(composed(F.coalesce(question, F.lit(""))))
    more = F.array_compact(F.array(*[F.when(q.contains(k), F.lit(" ".join(v))) for k, v in RATIOS.items()]))
    return link_tokens(F.concat_ws(" ", question, F.array_join(more, " ")))


def link_tokens(c: Column) -> Column:
    """Distinct linking tokens of a text, letters composed."""
    return F.array_distinct(tokens(composed(c), LINK_STOP))


def is_value_column(column_index: Column, header_path: Column) -> Column:
    """Whether a column can hold amounts: not the first, and not headed as a code, note or description."""
    role = F.regexp_replace(fold(F.coalesce(header_path, F.lit(""))), r"[^\p{L}\p{N}]", "")
    return (column_index > 0) & ~role.isin(*ROLE_WORDS)


def year_conflict(table_year: Column, header: Column, asked: Column) -> Column:
    """The question names years, and neither the table's year nor its column header is one of them."""
    in_header = F.exists(asked, lambda y: header.contains(y.cast("string")))
    return (F.size(asked) > 0) & ~F.coalesce(F.array_contains(asked, table_year), F.lit(False)) & ~F.coalesce(in_header, F.lit(False))


def variant_conflict(table_variant: Column, asked: Column) -> Column:
    return asked.isNotNull() & F.coalesce(~table_variant.isin("", "unspecified") & (table_variant != asked), F.lit(False))


def value_cells(tables: DataFrame) -> DataFrame:
    """Numeric cells of value columns in labelled rows: table_key, row and column index, row_label, column_header, raw_value, numeric_value, and the table's ticker, year, variant, identity.

    Headers and roles are worked out once per column and labels once per row, before any cell is exploded.
    """
    empty = lambda c: F.array().cast(tables.schema[c].dataType)
    paths = F.map_from_entries(F.array_distinct(F.transform(F.coalesce("column_metadata", empty("column_metadata")), lambda m: F.struct(m["column_index"], m["header_path"]))))
    labels = F.map_from_entries(F.transform(F.coalesce("row_labels", empty("row_labels")), lambda m: F.struct(m["row_index"], m["label"])))
    about = ["table_key", "ticker", "year", "variant", "table_identity"]
    t = tables.filter(F.size("grid") > 0)
    width = F.aggregate("grid", F.lit(0), lambda m, r: F.greatest(m, F.size(r)))

    def columns(by_column):
        def column(i):
            header = F.coalesce(F.substring(strip(F.get(F.get("grid", F.lit(0)), i)), 1, 160), F.lit(""))
            path = F.try_element_at(by_column, i)
            return F.struct(header.alias("h"), is_value_column(i, F.when(path.isNull() | (path == ""), header).otherwise(path)).alias("ok"))

        return F.transform(F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0))), column)

    t = t.select(*about, "grid", labels.alias("labels"), let(paths, columns).alias("cols"))
    rows = t.select(*about, "labels", "cols", F.posexplode("grid").alias("row_index", "row")).withColumn("row_label", F.try_element_at("labels", F.col("row_index"))).filter("row_label is not null")
    kept = F.filter(F.transform("row", lambda v, i: F.struct(i.alias("column_index"), v.alias("raw_value"), F.get("cols", i).alias("c"))), lambda s: s["c"]["ok"])
    cells = rows.select(*about, "row_index", "row_label", F.explode(kept).alias("s")).select(*about, "row_index", "row_label", "s.column_index", F.col("s.c.h").alias("column_header"), "s.raw_value")
    return cells.withColumn("numeric_value", number(F.col("raw_value"))).filter(F.col("numeric_value").isNotNull())


def operands(questions: DataFrame, pairs: DataFrame, cells: DataFrame) -> DataFrame:
    """Scored operands of each question: score is the share of the row label's tokens the question names, plus a bonus for the table's year.

    questions: id, question. pairs: id, table_key (the tables retrieved for a question). Rows of score 0
    vanish where any row of the question has a positive score. tier counts conflicts of variant and year.
    """
    q = questions.select("id", question_tokens(F.col("question")).alias("q_tokens"), years(F.col("question")).alias("asked_years"), variant(F.col("question")).alias("asked_variant"))
    label = link_tokens(F.col("row_label"))
    j = pairs.select("id", "table_key").distinct().join(q, "id").join(cells.withColumn("label_tokens", label), "table_key")
    share = F.size(F.array_intersect("q_tokens", "label_tokens")) / F.greatest(F.size("label_tokens"), F.lit(1))
    named = F.coalesce(F.array_contains("asked_years", F.col("year")), F.lit(False))
    j = j.withColumn("score", share + F.when(named, YEAR_BONUS).otherwise(0.0))
    tier = variant_conflict(F.col("variant"), F.col("asked_variant")).cast("int") + year_conflict(F.col("year"), F.col("column_header"), F.col("asked_years")).cast("int")
    j = j.withColumn("tier", tier)
    best = F.max("score").over(Window.partitionBy("id"))
    return j.withColumn("best", best).filter((F.col("score") > 0) | (F.col("best") <= 0)).drop("best", "q_tokens", "label_tokens")


def ordered(ops: DataFrame, concepts: DataFrame, most: int = MOST_OPERANDS) -> DataFrame:
    """Operands with pos from 1 to most, by tier, score and place.

    Where a question names two concepts or more, the tables of a tier take turns: those that cover more
    concepts first, then those with the better best score, then by key.
    """
    o = ops.join(concepts, "id", "left").withColumn("several", F.coalesce(F.size("concepts") >= 2, F.lit(False)))
    place = [F.desc("score"), "table_key", "row_index", "column_index"]
    covered = F.filter("concepts", lambda c: F.lower(composed(F.col("row_label"))).contains(c))
    per_table = Window.partitionBy("id", "table_key")
    o = o.withColumn("covers", F.size(F.array_distinct(F.flatten(F.collect_set(covered).over(per_table)))))
    o = o.withColumn("turn", F.row_number().over(Window.partitionBy("id", "tier", "table_key").orderBy(*place)))
    o = o.withColumn("lead", F.max("score").over(Window.partitionBy("id", "tier", "table_key")))
    turns = lambda c: F.when(F.col("several"), c)
    order = Window.partitionBy("id").orderBy("tier", turns(F.col("turn")), turns(-F.col("covers")), turns(-F.col("lead")), turns(F.col("table_key")), *place)
    return o.withColumn("pos", F.row_number().over(order)).filter(F.col("pos") <= most).drop("several", "covers", "turn", "lead", "concepts")


def relevant_tables(ordered_ops: DataFrame, most: int = RELEVANT_TABLES) -> DataFrame:
    """(id, table_key, rank): the first distinct tables in operand order."""
    first = ordered_ops.groupBy("id", "table_key").agg(F.min("pos").alias("pos"))
    w = Window.partitionBy("id").orderBy("pos")
    return first.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most).select("id", "table_key", "rank")

"""Queries over retrieval, linking, plans and metrics, each with the SQL it must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.text import ONE_DST, ONE_SRC, number
from ..operators import dense, index as I, link as L, metrics as M, normalize as N, package as K, plan as P, rank as R, retrieve as V, scope as S
from ..operators.together import best_in_scopes
from ..session import join_checked, settle, table
from ..streaming.ingest import windowed_counts
from . import jobs
from .table_queries import _CELLS, number_sql, scale_sql

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_WORDS = r"regexp_extract_all(lower(coalesce({}, '')), '[\p{{L}}\p{{N}}_]+')"
_STOP = "(" + ", ".join(f"'{w}'" for w in I.STOP_WORDS) + ")"


def words_sql(c: str, stop: str = _STOP) -> str:
    return f"list_filter({_WORDS.format(c)}, lambda t: t NOT IN {stop})"


# ---- sparse retrieval


def _bm25_sql(docs: str, queries: str, tail: str) -> str:
    """docs: scope, doc_id, text; queries: query_id, scope, text."""
    return f"""
WITH docs AS ({docs}), queries AS ({queries}),
dt AS (SELECT scope, doc_id, {words_sql("text")} AS t FROM docs),
st AS (SELECT scope, count(*) AS n_docs, avg(len(t)) AS avgdl FROM dt GROUP BY 1),
po AS (SELECT scope, doc_id, term, dl, count(*) AS f FROM (SELECT scope, doc_id, len(t) AS dl, unnest(t) AS term FROM dt) GROUP BY ALL),
df AS (SELECT scope, term, count(*) AS n_t FROM po GROUP BY ALL),
qt AS (SELECT query_id, scope, term, count(*) AS qf FROM (SELECT query_id, scope, unnest({words_sql("text")}) AS term FROM queries) GROUP BY ALL),
sc AS (SELECT query_id, qt.scope, doc_id, round(sum(qf * ln(1e0 + (n_docs - n_t + 0.5e0) / (n_t + 0.5e0)) * (f * 2.5e0 / (f + 1.5e0 * (0.25e0 + 0.75e0 * dl / avgdl)))), 6) AS score
  FROM qt JOIN po USING (scope, term) JOIN df USING (scope, term) JOIN st USING (scope) GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY query_id, scope ORDER BY score DESC, doc_id::VARCHAR) AS rank FROM sc)
{tail}"""


@query(f"""WITH dt AS (SELECT section_header AS scope, record_id, {words_sql("searchable_text")} AS t FROM norm_tables),
st AS (SELECT scope, count(*) AS n_docs FROM dt GROUP BY 1), x AS (SELECT DISTINCT scope, record_id, unnest(t) AS term FROM dt),
df AS (SELECT scope, term, count(*) AS n_t FROM x GROUP BY ALL)
SELECT scope, term, n_t, round(ln(1e0 + (n_docs - n_t + 0.5e0) / (n_t + 0.5e0)), 6) AS idf FROM df JOIN st USING (scope)""")
def s_term_stats(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "norm_tables").select(F.col("section_header").alias("scope"), F.col("record_id").alias("doc_id"), F.col("searchable_text").alias("text"))
    return I.term_stats(I.postings(docs), I.scope_stats(docs)).select("scope", "term", "n_t", F.round("idf", 6).alias("idf"))


def _tables(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "norm_tables", widen=True)


def _asked(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct questions."""
    return table(spark, sf, "dev_questions").select("id", "question").dropDuplicates(["id"])


_DQ = "(SELECT id, any_value(question) AS question FROM dev_questions GROUP BY id)"


@query(_bm25_sql("SELECT 0 AS scope, record_id AS doc_id, searchable_text AS text FROM norm_tables", f"SELECT id AS query_id, 0 AS scope, question AS text FROM {_DQ} WHERE id % 20 = 0",
                 "SELECT query_id, doc_id, score, rank FROM rk WHERE rank <= 10"))
def s_bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The stated query set, every question whose id is divisible by 20, against all tables."""
    docs = _tables(spark, sf).select(F.lit(0).alias("scope"), F.col("record_id").alias("doc_id"), F.col("searchable_text").alias("text"))
    q = _asked(spark, sf).filter("id % 20 = 0").select(F.col("id").alias("query_id"), F.lit(0).alias("scope"), F.col("question").alias("text"))
    return I.top_documents(docs, q, 10, digits=6).select("query_id", "doc_id", "score", "rank")


_CODES = r"list_distinct(list_filter(regexp_extract_all(coalesce(question, ''), '[\p{L}\p{N}_]+'), lambda t: regexp_full_match(t, '[A-Z0-9]{2,5}') AND regexp_matches(t, '[A-Z]') AND t NOT IN ('BCTC', 'CTCP', 'TMCP', 'TCT', 'TNHH', 'VND')))"
_SCOPED_DOCS = """SELECT n.ticker AS scope, record_id AS doc_id, repeat(coalesce(n.ticker, '') || ' ' || coalesce(c.name, '') || ' ' || coalesce(n.year::VARCHAR, '') || ' ', 5) || coalesce(searchable_text, '') AS text
FROM norm_tables n LEFT JOIN companies c USING (ticker)"""
_SCOPED_Q = f"""SELECT id AS query_id, scope, question AS text FROM (SELECT id, question, unnest({_CODES}) AS scope FROM {_DQ}) WHERE scope IN (SELECT ticker FROM companies)"""


def _scoped(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    names = F.broadcast(table(spark, sf, "companies").select("ticker", "name"))  # the fixed registry
    docs = _tables(spark, sf).select("ticker", "record_id", "year", "searchable_text").join(names, "ticker", "left")
    docs = docs.select(F.col("ticker").alias("scope"), F.col("record_id").alias("doc_id"), I.enriched([F.col("ticker"), F.col("name"), F.col("year")], F.col("searchable_text")).alias("text"))
    q = _asked(spark, sf).select(F.col("id").alias("query_id"), F.explode(S.literal_codes(F.col("question"))).alias("scope"), F.col("question").alias("text"))
    return docs, q.join(names.select(F.col("ticker").alias("scope")), "scope", "left_semi")


@query(_bm25_sql(_SCOPED_DOCS, _SCOPED_Q, "SELECT query_id, scope, doc_id, score, rank FROM rk WHERE rank <= 10"))
def s_bm25_scoped(spark: SparkSession, sf: str) -> DataFrame:
    docs, q = _scoped(spark, sf)
    return I.top_documents(docs, q.withColumn("query_id", F.concat_ws("#", F.col("query_id").cast("string"), "scope")), 10, digits=6).select(F.substring_index("query_id", "#", 1).cast("bigint").alias("query_id"), "scope", "doc_id", "score", "rank")


# ---- scope of a question


@query(rf"""WITH q AS (SELECT id, coalesce(question, '') AS q FROM {_DQ}),
y AS (SELECT id, unnest(regexp_extract_all(q, '\b((?:19|20)[0-9]{{2}})\b', 1))::INT AS y FROM q),
s AS (SELECT id, unnest(regexp_extract_all(q, '(?i)\b((?:19|20)[0-9]{{2}}\s*(?:-|–|—|đến|tới)\s*(?:19|20)[0-9]{{2}})\b', 1)) AS s FROM q),
r AS (SELECT id, unnest(range(left(s, 4)::INT, right(s, 4)::INT + 1))::INT AS y FROM s),
u AS (SELECT * FROM y UNION SELECT * FROM r)
SELECT id, coalesce(list_sort(list(y) FILTER (y IS NOT NULL)), []) AS years FROM q LEFT JOIN u USING (id) GROUP BY 1""")
def s_question_years(spark: SparkSession, sf: str) -> DataFrame:
    return _asked(spark, sf).select("id", S.years(F.col("question")).alias("years"))


def _like(c: str, words) -> str:
    return "(" + " OR ".join(f"{c} LIKE '%{w.replace('%', '!%')}%' ESCAPE '!'" for w in words) + ")"


@query(f"""SELECT id, CASE WHEN {_like("lower(question)", S.SEPARATE_WORDS)} THEN 'separate' WHEN {_like("lower(question)", S.CONSOLIDATED_WORDS)} THEN 'consolidated' END AS variant FROM {_DQ}""")
def s_question_variant(spark: SparkSession, sf: str) -> DataFrame:
    return _asked(spark, sf).select("id", S.variant(F.col("question")).alias("variant"))


@query(f"SELECT query_id AS id, scope AS ticker FROM ({_SCOPED_Q})")
def s_literal_tickers(spark: SparkSession, sf: str) -> DataFrame:
    return _scoped(spark, sf)[1].select(F.col("query_id").alias("id"), F.col("scope").alias("ticker"))


def _fold_sql(c: str) -> str:
    src, dst = (x.replace("'", "''") for x in (ONE_SRC, ONE_DST))
    return f"lower(replace(replace(strip_accents(translate({c}, '{src}', '{dst}')), 'đ', 'd'), 'Đ', 'D'))"


def _name_words(c: str) -> str:
    noise = "(" + ", ".join(f"'{w}'" for w in S.PHRASE_NOISE) + ")"
    return f"list_transform(list_filter({words_sql(c)}, lambda t: t NOT IN {noise}), lambda t: {_fold_sql('t')})"


_YEARS_SQL = r"""yq AS (SELECT id, coalesce(question, '') AS q FROM __DQ),
y1 AS (SELECT id, unnest(regexp_extract_all(q, '\b((?:19|20)[0-9]{2})\b', 1))::INT AS y FROM yq),
y2 AS (SELECT id, unnest(regexp_extract_all(q, '(?i)\b((?:19|20)[0-9]{2}\s*(?:-|–|—|đến|tới)\s*(?:19|20)[0-9]{2})\b', 1)) AS s FROM yq),
y3 AS (SELECT id, unnest(range(left(s, 4)::INT, right(s, 4)::INT + 1))::INT AS y FROM y2),
years AS (SELECT id, coalesce(list_sort(list(y) FILTER (y IS NOT NULL)), []) AS years FROM yq LEFT JOIN (SELECT * FROM y1 UNION SELECT * FROM y3) USING (id) GROUP BY 1)""".replace("__DQ", _DQ)
_PHRASES = f"""nm AS (SELECT ticker, {_name_words("name")} AS c FROM companies),
n1 AS (SELECT ticker, c, len(c) AS n, unnest(range(1, len(c) + 1)) AS s FROM nm WHERE len(c) > 0),
n2 AS (SELECT *, unnest(range(1, n - s + 2)) AS w FROM n1),
rn AS (SELECT ticker, n, s, w, array_to_string(c[s:s + w - 1], ' ') AS run, list_max(list_transform(c[s:s + w - 1], lambda t: length(t))) AS longest FROM n2),
q0 AS (SELECT id, question, {_name_words("question")} AS t FROM {_DQ}),
q1 AS (SELECT id, t, unnest(range(1, len(t) + 1)) AS s FROM q0),
q2 AS (SELECT id, t, s, unnest(range(1, greatest(1, least((SELECT max(w) FROM rn), len(t) - s + 1)) + 1)) AS w FROM q1),
q3 AS (SELECT DISTINCT id, array_to_string(t[s:s + w - 1], ' ') AS run FROM q2),
b0 AS (SELECT id, ticker, n, run, w, longest FROM q3 JOIN rn USING (run) QUALIFY row_number() OVER (PARTITION BY id, ticker ORDER BY w DESC, s) = 1),
b1 AS (SELECT * FROM b0 WHERE (n = 1 AND w = 1 AND longest >= 4) OR (w = n AND w >= 2) OR (w * 2 >= n AND (w >= 4 OR (w >= 3 AND longest >= 5)))),
ph AS (SELECT id, ticker FROM b1 a WHERE NOT EXISTS (SELECT 1 FROM b1 o WHERE o.id = a.id AND o.w > a.w AND contains(' ' || o.run || ' ', ' ' || a.run || ' ')))"""
_PLAIN_NAME = f"list_distinct(list_filter({words_sql('name')}, lambda t: t NOT IN ({', '.join(repr(w) for w in S.NAME_NOISE)})))"
_RESOLVED = f"""{_PHRASES},
lt AS (SELECT id, list(DISTINCT code) AS literal FROM (SELECT id, unnest({_CODES}) AS code FROM {_DQ}) WHERE code IN (SELECT ticker FROM companies) GROUP BY 1),
pp AS (SELECT id, list(DISTINCT ticker) AS phrase, list_distinct(flatten(list(c))) AS words FROM ph JOIN nm USING (ticker) GROUP BY 1),
pl AS (SELECT ticker, {_PLAIN_NAME} AS plain FROM companies),
ov AS (SELECT id, ticker, any_value(plain) AS plain, count(*) AS n FROM (SELECT id, unnest(list_distinct({words_sql("question")})) AS term FROM {_DQ}) q JOIN (SELECT ticker, plain, unnest(plain) AS term FROM pl) p USING (term) GROUP BY ALL HAVING count(*) >= 3),
os AS (SELECT id, list(ticker) AS strong FROM ov GROUP BY 1), ob AS (SELECT id, count(*) AS nb, any_value(ticker) AS bt, any_value(plain) AS bp FROM ov o WHERE n = (SELECT max(n) FROM ov i WHERE i.id = o.id) GROUP BY 1),
rs AS (SELECT id, coalesce(literal, []) AS l, coalesce(phrase, []) AS p, coalesce(strong, []) AS s, words, nb, bt, bp FROM {_DQ} LEFT JOIN lt USING (id) LEFT JOIN pp USING (id) LEFT JOIN os USING (id) LEFT JOIN ob USING (id)),
resolved AS (SELECT id, list_sort(list_distinct(CASE WHEN len(p) > 0 AND len(l) > 0 THEN list_filter(l, lambda t: NOT coalesce(list_contains(words, lower(t)), false)) || p WHEN len(p) > 0 THEN p WHEN len(l) = 0 THEN s
  WHEN nb = 1 AND len(list_filter(l, lambda t: list_contains(bp, lower(t)))) > 0 THEN list_filter(l, lambda t: NOT list_contains(bp, lower(t))) || [bt] ELSE l END)) AS tickers FROM rs)"""


@query(f"WITH {_PHRASES} SELECT id, ticker FROM ph")
def s_phrase_matches(spark: SparkSession, sf: str) -> DataFrame:
    return S.phrase_matches(_asked(spark, sf), table(spark, sf, "companies"))


@query(f"WITH {_RESOLVED} SELECT id, tickers FROM resolved")
def s_resolved_tickers(spark: SparkSession, sf: str) -> DataFrame:
    return S.resolved_tickers(_asked(spark, sf), table(spark, sf, "companies"))


def _munch_sql() -> str:
    rest = "lower(nfc_normalize(coalesce(question, '')))"
    steps = [f"s0 AS (SELECT id, {rest} AS t, {rest} AS rest, [] ::VARCHAR[] AS found FROM {_DQ})"]
    for i, p in enumerate(sorted(S.LINE_ITEMS, key=lambda x: (-len(x), S.LINE_ITEMS.index(x))), 1):
        steps.append(f"s{i} AS (SELECT id, t, replace(rest, '{p}', repeat('#', {len(p)})) AS rest, CASE WHEN contains(rest, '{p}') THEN list_append(found, '{p}') ELSE found END AS found FROM s{i - 1})")
    ratios = " || ".join(f"CASE WHEN contains(t, '{k}') THEN {v!r} ELSE [] END" for k, v in S.RATIOS.items())
    return f"WITH {', '.join(steps)}, l AS (SELECT id, {ratios} || found AS l FROM s{len(S.LINE_ITEMS)}) SELECT id, list_filter(l, lambda x, i: list_position(l, x) = i) AS concepts FROM l"


@query(_munch_sql())
def s_concepts(spark: SparkSession, sf: str) -> DataFrame:
    return S.concepts(_asked(spark, sf))


@query("SELECT n_nationkey AS n_companies, CASE WHEN n_nationkey <= 1 THEN 10 ELSE greatest(2, 15 // n_nationkey) END::INT AS budget FROM nation")
def s_concept_budget(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("n_companies"), S.concept_budget(F.col("n_nationkey")).alias("budget"))


# ---- rerank, dense, fusion


_CITED = f"(SELECT DISTINCT q.id, q.question, t.record_id, t.row_labels, t.section_header, t.table_identity FROM {_DQ} q JOIN dev_answers a USING (id) JOIN norm_tables t USING (table_key))"


def _cited(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "dev_answers").select("id", "table_key").dropna().distinct()
    t = _tables(spark, sf).select("table_key", "record_id", "row_labels", "section_header", "table_identity")
    return _asked(spark, sf).join(a, "id").join(t, "table_key")


@query(f"""WITH p AS (SELECT id, record_id, list_distinct({words_sql("question")}) AS q, unnest(row_labels).label AS l FROM {_CITED}),
w AS (SELECT id, record_id, q, list_distinct({words_sql("l")}) AS t FROM p),
j AS (SELECT id, record_id, len(list_intersect(q, t)) AS i, len(list_distinct(q || t)) AS u FROM w)
SELECT id, record_id, round(max(CASE WHEN u = 0 THEN 0 ELSE i::DOUBLE / u END), 6) AS overlap FROM j GROUP BY ALL""")
def k_label_overlap(spark: SparkSession, sf: str) -> DataFrame:
    c = _cited(spark, sf).filter(F.size("row_labels") > 0)
    return c.select("id", "record_id", F.round(R.label_overlap(R.token_set(F.col("question")), R.label_sets(F.transform("row_labels", lambda x: x["label"]))), 6).alias("overlap")).distinct()


@query(f"""SELECT DISTINCT id, record_id, (CASE WHEN section_header IN ('balance_sheet', 'income_statement', 'cash_flow') THEN 1e0 ELSE 0e0 END)
 - (CASE WHEN section_header = 'notes' AND lower(coalesce(table_identity, '')) LIKE '%bên liên quan%' AND NOT coalesce(lower(question) LIKE '%bên liên quan%', false) THEN 2e0 ELSE 0e0 END) AS score FROM {_CITED}""")
def k_section_scores(spark: SparkSession, sf: str) -> DataFrame:
    c = _cited(spark, sf).select("id", "record_id", F.coalesce("question", F.lit("")).alias("question"), F.array().cast("array<string>").alias("q_set"), F.array().cast("array<array<string>>").alias("label_sets"), F.col("section_header").alias("section"), F.col("table_identity").alias("identity"), F.lit(0.0).alias("score"))
    return R.reranked(c, weight=0.0).select("id", "record_id", "score").distinct()


_RERANKED = f"""
SELECT query_id, scope, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id, scope ORDER BY score DESC, doc_id::VARCHAR) AS rank FROM (
 SELECT query_id, sc.scope, doc_id, round(score + 24 * coalesce(ov, 0) + CASE WHEN section_header IN ('balance_sheet', 'income_statement', 'cash_flow') THEN 1 ELSE 0 END
   - CASE WHEN section_header = 'notes' AND contains(lower(coalesce(table_identity, '')), 'bên liên quan') AND NOT contains(lower(coalesce(q.text, '')), 'bên liên quan') THEN 2 ELSE 0 END, 6) AS score
 FROM sc JOIN queries q USING (query_id, scope) JOIN norm_tables t ON t.record_id = sc.doc_id,
 LATERAL (SELECT max(CASE WHEN len(list_distinct(qw || lw)) = 0 THEN 0 ELSE len(list_intersect(qw, lw)) / len(list_distinct(qw || lw))::DOUBLE END) AS ov
   FROM (SELECT list_distinct({words_sql("q.text")}) AS qw, list_distinct({words_sql("l.label")}) AS lw FROM (SELECT unnest(t.row_labels[1:{N.MAX_LABELS}]) AS l))))) WHERE rank <= 10"""


@query(_bm25_sql(_SCOPED_DOCS, _SCOPED_Q, _RERANKED).replace("dl / avgdl)))), 6) AS score", "dl / avgdl)))), 15) AS score"))
def k_reranked(spark: SparkSession, sf: str) -> DataFrame:
    names = F.broadcast(table(spark, sf, "companies").select("ticker", "name"))  # the fixed registry
    t = _tables(spark, sf).select("record_id", "ticker", "year", "searchable_text", "row_labels", "section_header", "table_identity").join(names, "ticker", "left")
    text = I.enriched([F.col("ticker"), F.col("name"), F.col("year")], F.col("searchable_text"))
    labels = R.label_sets(F.slice(F.transform("row_labels", lambda x: x["label"]), 1, N.MAX_LABELS))
    docs = t.select(F.col("record_id").alias("doc_id"), F.array("ticker").alias("scopes"), I.tokens(text, I.STOP_WORDS).alias("t"), labels.alias("label_sets"), F.col("section_header").alias("section"), F.col("table_identity").alias("identity"))
    scored = best_in_scopes(docs, _scoped(spark, sf)[1], 10, digits=6)
    return I.ranked(scored, 10, ("query_id", "scope"), 6).select("query_id", "scope", "doc_id", "score", "rank")


_VEC = "(SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"
_KNN = """SELECT q.vec_id AS query_id, d.vec_id AS doc_id, {extra} round(list_cosine_similarity(q.v, d.v), 6) AS score
FROM {vec} q JOIN {vec} d ON {cond} WHERE q.vec_id % 20 = 0"""


def _knn_sql(cond: str, extra: str = "") -> str:
    base = _KNN.format(extra=extra, vec=_VEC, cond=cond)
    return f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id::VARCHAR) AS rank FROM ({base})) WHERE rank <= 10)"


def _vectors(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"), F.col("label").alias("scope"))
    return e, e.filter("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id")


def _knn(spark: SparkSession, sf: str, scoped: bool) -> DataFrame:
    e, q = _vectors(spark, sf)
    if not scoped:
        e, q = e.drop("scope"), q.drop("scope")
    return R.nearest(e, q, 10, scoped).select("query_id", "doc_id", "score", "rank")


@query(f"SELECT query_id, doc_id, score, rank FROM {_knn_sql('true')}")
def d_knn_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The stated query set, every vector whose id is divisible by 20, against all vectors."""
    return _knn(spark, sf, False)


@query(f"SELECT query_id, doc_id, score, rank FROM {_knn_sql('q.label = d.label')}")
def d_knn_scoped(spark: SparkSession, sf: str) -> DataFrame:
    return _knn(spark, sf, True)


@query(f"""WITH r AS (SELECT query_id, doc_id, rank FROM {_knn_sql("true")} UNION ALL SELECT query_id, doc_id, rank FROM {_knn_sql("q.label = d.label")}),
s AS (SELECT query_id, doc_id, round(sum(1e0 / (60 + rank)), 9) AS score FROM r GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id::VARCHAR) AS rank FROM s)
SELECT query_id, doc_id, score, rank FROM k WHERE rank <= 10""")
def f_rrf(spark: SparkSession, sf: str) -> DataFrame:
    both = _knn(spark, sf, False).unionByName(_knn(spark, sf, True))
    return R.rrf(both, 10).select("query_id", "doc_id", "score", "rank")


@query(f"""WITH p AS (SELECT query_id, doc_id, rank FROM {_knn_sql("q.label = d.label")}), s AS (SELECT query_id, doc_id, rank FROM {_knn_sql("true")} a
 WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.query_id = a.query_id AND p.doc_id = a.doc_id)),
n AS (SELECT query_id, max(rank) AS last FROM p GROUP BY 1),
t AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY rank, doc_id) AS r FROM s)
SELECT query_id, doc_id, rank, 'primary' AS source FROM p UNION ALL SELECT query_id, doc_id, coalesce(last, 0) + r, 'secondary' FROM t LEFT JOIN n USING (query_id) WHERE r <= 5""")
def f_backfill(spark: SparkSession, sf: str) -> DataFrame:
    return R.backfilled(_knn(spark, sf, True), _knn(spark, sf, False), 5)


@query(f"""WITH v AS (SELECT record_id AS i, list_transform(embedding, lambda x: x::DOUBLE) AS v, t.ticker, t.year, t.variant, t.table_key FROM norm_tables t JOIN embeddings e ON e.vec_id = t.record_id),
{{resolved}}, {{years}},
q AS (SELECT id, tickers, years, CASE WHEN {_like("lower(question)", S.SEPARATE_WORDS)} THEN 'separate' WHEN {_like("lower(question)", S.CONSOLIDATED_WORDS)} THEN 'consolidated' END AS want, list_transform(embedding, lambda x: x::DOUBLE) AS qv
  FROM {_DQ} JOIN resolved USING (id) JOIN years USING (id) JOIN embeddings e ON e.vec_id = id % 500 WHERE id % 20 = 0),
s AS (SELECT id, i AS table_key, round(list_cosine_similarity(qv, v), 6) AS score FROM q JOIN v ON len(tickers) = 0 OR (list_contains(tickers, ticker) AND (len(years) <> 1 OR coalesce(list_contains(years, year), false)) AND (want IS NULL OR coalesce(variant = want, false))))
SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, table_key::VARCHAR) AS rank FROM s QUALIFY rank <= 10""".replace("{resolved}", _RESOLVED).replace("{years}", _YEARS_SQL))
def d_rankings(spark: SparkSession, sf: str) -> DataFrame:
    """Every twentieth question against all tables that have a vector (by record), in the scopes of the sparse search; a question's vector is that of another text."""
    e = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    v = _tables(spark, sf).select(F.col("record_id").alias("doc_id"), "ticker", "year", "variant").join(e, F.col("doc_id") == F.col("vec_id")).drop("vec_id")
    q = _asked(spark, sf).filter("id % 20 = 0").withColumn("vec_id", F.col("id") % 500).join(e, "vec_id").drop("vec_id")
    return dense.dense_rankings(q, table(spark, sf, "companies"), v)


@query("""SELECT record_id, array_to_string(list_transform((list_filter(l, lambda x, i: list_position(l, x) = i))[1:200], lambda x: CASE WHEN length(x) > 200 THEN left(x, 199) || '…' ELSE x END), ' | ') AS labels
FROM (SELECT record_id, list_filter(list_transform(coalesce(row_labels, []), lambda y: y.label), lambda x: x IS NOT NULL AND x <> '') AS l FROM norm_tables)""")
def k_label_texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "norm_tables").select("record_id", R.label_text(F.transform("row_labels", lambda x: x["label"])).alias("labels"))


# ---- linking


@query(f"""SELECT id, CASE {" ".join(f"WHEN {_like('q', w)} THEN '{n}'" for n, w in L.FAMILIES)} WHEN len(list_intersect({_CODES.replace("question", "raw")}, (SELECT list(ticker) FROM companies))) > 1
 THEN 'cross_company_comparison' WHEN {_like("q", L.COMPARISON_WORDS)} THEN 'comparison' ELSE 'direct_lookup' END AS family
 FROM (SELECT id, question AS raw, lower(coalesce(question, '')) AS q FROM {_DQ})""")
def l_family(spark: SparkSession, sf: str) -> DataFrame:
    q = _asked(spark, sf)
    listed = q.select("id", F.explode(S.code_words(F.col("question"))).alias("ticker")).join(table(spark, sf, "companies").select("ticker"), "ticker", "left_semi")
    listed = listed.groupBy("id").agg(F.collect_set("ticker").alias("available"))
    none = F.array().cast("array<string>")
    return q.join(listed, "id", "left").select("id", L.family(F.col("question"), F.coalesce("available", none)).alias("family"))


@query(rf"""SELECT id, nullif(trim(regexp_extract(coalesce(question, ''), '(?i)((?:nghìn\s*tỷ|tỷ|triệu|nghìn)?\s*(?:đồng|vnd|%))', 1)), '') AS unit FROM {_DQ}""")
def l_requested_unit(spark: SparkSession, sf: str) -> DataFrame:
    return _asked(spark, sf).select("id", L.requested_unit(F.col("question")).alias("unit"))


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "dev_answers").select("id", "table_key").dropna().distinct()


def _one_delivery(t: DataFrame) -> DataFrame:
    """Tables delivered twice once, the smallest record first."""
    twice = t.groupBy("table_key").agg(F.min("record_id").alias("_kept"), F.count("record_id").alias("_n")).filter("_n > 1").drop("_n")
    # Only the keys of what came twice go to the tables, which stay where they lie.
    return join_checked(t.filter("table_key IS NOT NULL AND record_id IS NOT NULL"), settle(twice), "table_key", "left", 80).filter("_kept IS NULL OR record_id = _kept").drop("_kept")


@query(f"""WITH one AS (SELECT * FROM norm_tables QUALIFY row_number() OVER (PARTITION BY table_key ORDER BY record_id) = 1),
{_CELLS},
v AS (SELECT o.table_key, cs.r, cs.c, cs.raw, {number_sql("replace(cs.raw, chr(160), ' ')")} AS x, o.column_metadata AS m, o.row_labels AS l, o.grid[1][cs.c + 1] AS h FROM one o JOIN cs USING (record_id)),
p AS (SELECT *, coalesce(nullif(list_filter(m, lambda y: y.column_index = c)[1].header_path, ''), left(coalesce(regexp_replace(h, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g'), ''), 160)) AS path FROM v WHERE c > 0 AND x IS NOT NULL AND len(list_filter(l, lambda y: y.row_index = r)) > 0)
SELECT table_key, r::INT AS row_index, c::INT AS column_index, raw AS raw_value, x AS numeric_value FROM p
WHERE regexp_replace(replace(strip_accents(lower(path)), 'đ', 'd'), '[^\\p{{L}}\\p{{N}}]', '', 'g') NOT IN ({", ".join(f"'{w}'" for w in L.ROLE_WORDS)})""")
def l_value_cells(spark: SparkSession, sf: str) -> DataFrame:
    return L.value_cells(_one_delivery(_tables(spark, sf))).select("table_key", "row_index", "column_index", "raw_value", "numeric_value")


# ---- plans


@query("""WITH y AS (SELECT o_custkey AS id, year(o_orderdate) AS y, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY ALL)
SELECT id, arg_max(y, (v, -y))::INT AS max_year, max(v) AS max_value, arg_min(y, (v, y))::INT AS min_year, min(v) AS min_value, count(*) AS n_years FROM y GROUP BY 1""")
def g_extremum_year(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("year")).agg(F.round(F.sum("o_totalprice"), 2).alias("numeric_value"))
    named = F.array_sort(F.collect_set("year").over(Window.partitionBy("id")))
    ops = o.select("id", "year", "numeric_value", named.alias("asked_years"), F.concat(F.lit("orders|"), F.col("year").cast("string")).alias("table_key"), F.lit(1).alias("row_index"), F.lit(1).alias("column_index"), F.lit("value").alias("column_header"), F.lit(1.0).alias("score"))
    return P.extremum_year(ops)


@query("""SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total, round(avg(l_quantity), 6) AS mean, max(l_discount) AS most, min(l_tax) AS least, (count(*) FILTER (l_quantity > 25))::DOUBLE AS many,
 (count(*) FILTER (l_quantity <= 5))::DOUBLE AS few FROM lineitem GROUP BY 1""")
def g_reductions(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    quantity, price = "l_quantity", "l_extendedprice"
    j = P.reduced(li, [("many", "count_gt", 25.0, quantity), ("few", "count_le", 5.0, quantity), ("mean", "avg", None, quantity), ("total", "sum", None, price), ("most", "max", None, "l_discount"), ("least", "min", None, "l_tax")], ["l_suppkey"])
    return j.select("l_suppkey", F.round("total", 2).alias("total"), F.round("mean", 6).alias("mean"), "most", "least", "many", "few")


@query("""WITH y AS (SELECT o_custkey AS id, sum(o_totalprice) FILTER (year(o_orderdate) = 1997) AS a, sum(o_totalprice) FILTER (year(o_orderdate) = 1996) AS b FROM orders GROUP BY 1)
SELECT id, round((a - b) / abs(b) * 100, 4) AS change FROM y WHERE a IS NOT NULL AND b IS NOT NULL""")
def g_expression(spark: SparkSession, sf: str) -> DataFrame:
    o, y = table(spark, sf, "orders"), F.year("o_orderdate")
    t = o.groupBy(F.col("o_custkey").alias("id")).agg(F.sum(F.when(y == 1997, F.col("o_totalprice"))).alias("a"), F.sum(F.when(y == 1996, F.col("o_totalprice"))).alias("b")).filter("a is not null and b is not null")
    return t.select("id", F.round(P.compiled("(a - b) / abs(b) * 100", {"a": F.col("a"), "b": F.col("b")}), 4).alias("change"))


@query(f"""WITH u AS (SELECT DISTINCT expected_unit AS t FROM dev_answers), s AS (SELECT 'triệu đồng' AS s UNION ALL SELECT 'nghìn tỷ đồng' UNION ALL SELECT 'x'),
 f AS (SELECT t, s, ({scale_sql("t")})::BIGINT AS ft, ({scale_sql("s")})::BIGINT AS fs FROM u, s)
SELECT t AS target_unit, s AS source_unit, CASE WHEN ft IS NULL THEN 1e0 ELSE fs::DOUBLE / ft END AS factor FROM f""")
def g_scale_factor(spark: SparkSession, sf: str) -> DataFrame:
    u = table(spark, sf, "dev_answers").select(F.col("expected_unit").alias("target_unit")).distinct()
    u = u.withColumn("source_unit", F.explode(F.array(*map(F.lit, ("triệu đồng", "nghìn tỷ đồng", "x")))))
    return u.withColumn("factor", P.scale_factor(F.col("source_unit"), F.col("target_unit")))


@query(f"""WITH {_CELLS}, k AS (SELECT DISTINCT table_key, r, c FROM cs JOIN norm_tables USING (record_id) WHERE r > 0 AND c > 1)
SELECT DISTINCT id, 'x' AS alias, 'cell not allowed' AS error FROM dev_answers a WHERE table_key IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM k WHERE k.table_key = a.table_key AND k.r = a.row_index AND k.c = a.column_index)
UNION SELECT DISTINCT id, 'x', 'duplicate alias' FROM (SELECT id, count(*) AS n FROM dev_answers WHERE table_key IS NOT NULL GROUP BY 1) WHERE n > 1""")
def g_coordinate_errors(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "dev_answers").filter("table_key is not null").select("id", F.lit("x").alias("alias"), "table_key", "row_index", "column_index")
    t = _tables(spark, sf).filter(F.size("grid") > 0).select("table_key", F.posexplode("grid").alias("row_index", "row")).select("table_key", "row_index", F.posexplode("row").alias("column_index", "cell"))
    allowed = a.select("id", "table_key").distinct().join(t.filter("row_index > 0 and column_index > 1"), "table_key")
    return P.coordinate_errors(a, allowed)


# ---- metrics


def _judged(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Nearest vectors as retrieved, vectors of the same label in the same block of a hundred ids as relevant."""
    e, q = _vectors(spark, sf)
    block = lambda c: F.floor(F.col(c) / 100)
    rel = q.select("query_id", "scope", block("query_id").alias("b")).join(e.select(F.col("doc_id").alias("key"), "scope", block("doc_id").alias("b")), ["scope", "b"]).select("query_id", "key")
    return _knn(spark, sf, False).select("query_id", F.col("doc_id").alias("key"), "rank"), rel


_JUDGED = f"""got AS (SELECT query_id, doc_id AS key, rank FROM {_knn_sql("true")}),
rel AS (SELECT q.vec_id AS query_id, d.vec_id AS key FROM embeddings q JOIN embeddings d ON d.label = q.label AND d.vec_id // 100 = q.vec_id // 100 WHERE q.vec_id % 20 = 0),
hit AS (SELECT query_id, count(*) AS n_correct FROM got JOIN rel USING (query_id, key) GROUP BY 1),
base AS (SELECT query_id, count(*) AS n_relevant FROM rel GROUP BY 1), ret AS (SELECT query_id, count(*) AS n_retrieved FROM got GROUP BY 1),
s AS (SELECT query_id, coalesce(n_retrieved, 0) AS n_retrieved, n_relevant, coalesce(n_correct, 0) AS n_correct FROM base LEFT JOIN ret USING (query_id) LEFT JOIN hit USING (query_id)),
prf AS (SELECT *, CASE WHEN n_retrieved = 0 THEN 0e0 ELSE n_correct::DOUBLE / n_retrieved END AS precision, n_correct::DOUBLE / n_relevant AS recall FROM s),
scores AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0e0 ELSE 5e0 * precision * recall / (4e0 * precision + recall) END AS f2 FROM prf)"""


@query(f"WITH {_JUDGED} SELECT query_id, n_retrieved, n_relevant, n_correct, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f2, 6) AS f2 FROM scores")
def m_prf(spark: SparkSession, sf: str) -> DataFrame:
    s = M.prf(*_judged(spark, sf))
    return s.select("query_id", "n_retrieved", "n_relevant", "n_correct", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f2")])


@query(f"WITH {_JUDGED} SELECT count(*) AS n_queries, round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro, round(avg(f2), 6) AS f2_macro, round(avg(f2) * count(*) / (count(*) + 10), 6) AS f2_projected FROM scores")
def m_macro(spark: SparkSession, sf: str) -> DataFrame:
    m = M.macro(M.prf(*_judged(spark, sf)))
    m = m.withColumn("f2_projected", M.zero_credit(F.col("f2_macro"), F.col("n_queries"), F.col("n_queries") + 10))
    return m.select("n_queries", *[F.round(c, 6).alias(c) for c in ("precision_macro", "recall_macro", "f2_macro", "f2_projected")])


@query(f"""WITH {_JUDGED}, x AS (SELECT s.*, e.label, CASE WHEN n_relevant > 8 THEN 'wide' ELSE 'narrow' END AS width FROM scores s JOIN embeddings e ON e.vec_id = query_id)
SELECT label, width, count(*) AS n_queries, round(avg(recall), 6) AS recall_macro, round(avg(f2), 6) AS f2_macro FROM x GROUP BY GROUPING SETS ((label), (width))""")
def m_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    s = M.prf(*_judged(spark, sf)).join(_vectors(spark, sf)[1].select("query_id", F.col("scope").alias("label")), "query_id")
    s = s.withColumn("width", F.when(F.col("n_relevant") > 8, "wide").otherwise("narrow"))
    return M.breakdown(s, "label", "width").select("label", "width", "n_queries", F.round("recall_macro", 6).alias("recall_macro"), F.round("f2_macro", 6).alias("f2_macro"))


@query(f"""WITH {_JUDGED}, h AS (SELECT query_id, min(rank) AS r FROM got JOIN rel USING (query_id, key) WHERE rank BETWEEN 2 AND 5 GROUP BY 1)
SELECT query_id, round(coalesce(1e0 / r, 0e0), 6) AS rr FROM base LEFT JOIN h USING (query_id)""")
def m_reciprocal_rank(spark: SparkSession, sf: str) -> DataFrame:
    got, rel = _judged(spark, sf)
    # A vector is its own nearest, so rank 1 says nothing.
    return M.reciprocal_rank(got.filter("rank > 1"), rel, 5).select("query_id", F.round("rr", 6).alias("rr"))


_ANS = f"""one AS (SELECT * FROM norm_tables QUALIFY row_number() OVER (PARTITION BY table_key ORDER BY record_id) = 1),
a AS (SELECT DISTINCT id, expected_answer, expected_unit, table_key, row_index, column_index FROM dev_answers),
b AS (SELECT a.*, o.table_key IS NOT NULL AS there, replace(o.grid[a.row_index + 1][a.column_index + 1], chr(160), ' ') AS cell FROM a LEFT JOIN one o USING (table_key)),
d AS (SELECT *, {number_sql("cell")} AS answer FROM b)"""


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "dev_answers").select("id", "expected_answer", "expected_unit", "table_key", "row_index", "column_index").distinct()
    t = _one_delivery(_tables(spark, sf)).select("table_key", "grid", F.lit(True).alias("there"))
    return a.join(t, "table_key", "left").withColumn("answer", number(F.get(F.get("grid", F.col("row_index")), F.col("column_index")))).drop("grid")


_CLOSE = "coalesce(abs(answer - expected_answer) <= greatest(1e-6 * greatest(abs(answer), abs(expected_answer)), 1e-6), false)"


@query(f"""WITH {_ANS} SELECT expected_unit, count(*) AS n, count(answer) AS n_executed, count(*) FILTER ({_CLOSE}) AS n_right, round((count(*) FILTER ({_CLOSE}))::DOUBLE / count(*), 6) AS accuracy FROM d GROUP BY 1""")
def m_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    a = M.accuracy(_answers(spark, sf).withColumnRenamed("expected_answer", "expected"), ["expected_unit"])
    return a.withColumn("accuracy", F.round("accuracy", 6))


@query(f"""WITH {_ANS}, s AS (SELECT CASE WHEN table_key IS NULL THEN 'unscored' WHEN NOT there THEN 'retrieval' WHEN cell IS NULL THEN 'schema_linking' WHEN answer IS NULL THEN 'generation'
 WHEN expected_answer IS NULL THEN 'executed' WHEN {_CLOSE} THEN 'correct' ELSE 'correctness' END AS stage FROM d) SELECT stage, count(*) AS n FROM s GROUP BY 1""")
def m_first_failure(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "dev_answers").select("id", "expected_answer", "expected_unit", "table_key", "row_index", "column_index").distinct()
    t = _one_delivery(_tables(spark, sf)).select("table_key", "grid", F.lit(True).alias("there"))
    j = a.join(t, "table_key", "left").withColumn("cell", F.get(F.get("grid", F.col("row_index")), F.col("column_index")))
    j = j.select(F.col("table_key").isNotNull().alias("has_gold"), F.coalesce("there", F.lit(False)).alias("in_retrieved"), F.col("cell").isNotNull().alias("in_linked"), number(F.col("cell")).alias("answer"), F.col("expected_answer").alias("expected"))
    return M.first_failure(j).groupBy("stage").agg(F.count("*").alias("n"))




# ---- packages, signs of wrong answers, events


_CITES = f"""one AS (SELECT * FROM norm_tables QUALIFY row_number() OVER (PARTITION BY table_key ORDER BY record_id) = 1),
c AS (SELECT DISTINCT id, table_key FROM dev_answers WHERE table_key IS NOT NULL),
a AS (SELECT id, max(expected_answer) AS answer FROM dev_answers GROUP BY 1)"""


def _best_answers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "dev_answers").groupBy("id").agg(F.max("expected_answer").alias("answer"))


@query(f"""WITH {_CITES}, t AS (SELECT id, list_sort(list(table_key)) AS relevant_tables FROM c GROUP BY 1)
SELECT q.id, q.question, a.answer, coalesce(relevant_tables, []) AS relevant_tables, coalesce(list_sort(list_distinct(list_transform(relevant_tables, lambda k: regexp_extract(k, '^(.*)\\|[^|]*$', 1)))), []) AS relevant_docs
FROM {_DQ} q LEFT JOIN a USING (id) LEFT JOIN t USING (id)""")
def e_package(spark: SparkSession, sf: str) -> DataFrame:
    t = _pairs(spark, sf).withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("table_key")))
    p = K.assembled(_asked(spark, sf), _best_answers(spark, sf), t)
    return p.withColumn("relevant_docs", F.array_sort("relevant_docs"))


@query(f"""WITH {_CITES} SELECT q.id, 'not finite' AS error FROM {_DQ} q LEFT JOIN a USING (id) WHERE a.answer IS NULL
UNION ALL SELECT id, 'answer differs' FROM a WHERE answer < -1e-9""")
def e_check(spark: SparkSession, sf: str) -> DataFrame:
    """The package against answers of which the negative ones were doubled, so that the check has something to find."""
    t = _pairs(spark, sf).withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("table_key")))
    again = _best_answers(spark, sf).withColumn("answer", F.when(F.col("answer") < 0, F.col("answer") * 2).otherwise(F.col("answer")))
    q = _asked(spark, sf)
    return K.check(K.assembled(q, _best_answers(spark, sf), t), q, again)


@query("""SELECT q.id, coalesce(c.answer, a.answer) AS answer, CASE WHEN c.id IS NOT NULL THEN 'both' ELSE 'other' END AS origin
FROM (SELECT DISTINCT id FROM dev_answers) q LEFT JOIN (SELECT id, max(expected_answer) AS answer FROM dev_answers WHERE table_key IS NOT NULL GROUP BY 1) c USING (id)
LEFT JOIN (SELECT id, max(expected_answer) AS answer FROM dev_answers GROUP BY 1) a USING (id)""")
def e_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Answers that cite a cell before all others."""
    cited = table(spark, sf, "dev_answers").filter("table_key is not null").groupBy("id").agg(F.max("expected_answer").alias("answer"))
    return K.merged(cited, _best_answers(spark, sf)).select("id", "answer", "origin")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def t_hourly_events(spark: SparkSession, sf: str) -> DataFrame:
    e = windowed_counts(table(spark, sf, "events"))
    return e.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


# ---- whole retrieval and answers


def _ranking(spark: SparkSession, sf: str) -> DataFrame:
    return V.ranked_tables(_asked(spark, sf), _one_delivery(_tables(spark, sf)), table(spark, sf, "companies"))


@query()
def s_ranked_tables(spark: SparkSession, sf: str) -> DataFrame:
    r = _ranking(spark, sf)
    return r.select("id", "pos", "scope", "table_key", F.round("score", 6).alias("score"), "part")


@query()
def m_retrieval(spark: SparkSession, sf: str) -> DataFrame:
    """Mean precision, recall and F2 of the ranked tables against the tables that answers cite."""
    got = _ranking(spark, sf).select(F.col("id").alias("query_id"), F.col("table_key").alias("key"))
    rel = _pairs(spark, sf).select(F.col("id").alias("query_id"), F.col("table_key").alias("key"))
    return M.macro(M.prf(got, rel))

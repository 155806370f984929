"""Queries from linked cells to answers, packages, repair and evaluation, each with the SQL it must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import number
from ..operators import diagnose as D, ground as G, link as L, metrics as M, plan as P, scope as S
from ..session import settle, table
from . import jobs
from .search_queries import _CODES, _DQ, _YEARS_SQL, _asked, _knn, _knn_sql, _like, _one_delivery, _pairs, _ranking, _tables, _vectors
from .table_queries import _CELLS, _NUM, _STRIP, _UNITS, number_sql, scale_sql

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_STOP = "(" + ", ".join(f"'{w}'" for w in L.LINK_STOP) + ")"


def link_words(c: str) -> str:
    return f"list_distinct(list_filter(regexp_extract_all(lower(nfc_normalize(coalesce({c}, ''))), '[\\p{{L}}\\p{{N}}_]+'), lambda t: t NOT IN {_STOP}))"


_RATIO_WORDS = " || ".join(f"CASE WHEN contains(lq, '{k}') THEN ' {' '.join(v)}' ELSE '' END" for k, v in S.RATIOS.items())


def _concept_steps() -> str:
    rest = "lower(nfc_normalize(coalesce(question, '')))"
    steps = [f"s0 AS (SELECT id, {rest} AS t, {rest} AS rest, []::VARCHAR[] AS found FROM {_DQ})"]
    for i, p in enumerate(sorted(S.LINE_ITEMS, key=lambda x: (-len(x), S.LINE_ITEMS.index(x))), 1):
        steps.append(f"s{i} AS (SELECT id, t, replace(rest, '{p}', repeat('#', {len(p)})) AS rest, CASE WHEN contains(rest, '{p}') THEN list_append(found, '{p}') ELSE found END AS found FROM s{i - 1})")
    ratios = " || ".join(f"CASE WHEN contains(t, '{k}') THEN {v!r} ELSE [] END" for k, v in S.RATIOS.items())
    return f"{', '.join(steps)}, concepts AS (SELECT id, list_distinct({ratios} || found) AS concepts FROM s{len(S.LINE_ITEMS)})"


_HEAD = f"left(coalesce({_STRIP.format('o.grid[1][cs.c + 1]')}, ''), 160)"
_YEARS = _YEARS_SQL

#: CTEs up to ordered: the operands of the tables that answers cite, in order.
_OPS = f"""one AS (SELECT * FROM norm_tables QUALIFY row_number() OVER (PARTITION BY table_key ORDER BY record_id) = 1),
{_CELLS}, {_concept_steps()}, {_YEARS},
pr AS (SELECT DISTINCT id, table_key FROM dev_answers WHERE id IS NOT NULL AND table_key IS NOT NULL),
vc AS (SELECT o.table_key, o.ticker, o.year, o.variant, o.table_identity, cs.r::INT AS r, cs.c::INT AS c, cs.raw, {number_sql("replace(cs.raw, chr(160), ' ')")} AS x, list_filter(o.row_labels, lambda l: l.row_index = cs.r)[1].label AS label, {_HEAD} AS h,
   list_filter(o.column_metadata, lambda m: m.column_index = cs.c)[1].header_path AS path FROM one o JOIN cs USING (record_id) WHERE o.table_key IN (SELECT table_key FROM pr)),
vk AS (SELECT * FROM vc WHERE c > 0 AND x IS NOT NULL AND label IS NOT NULL AND regexp_replace(replace(strip_accents(lower(coalesce(nullif(path, ''), h))), 'đ', 'd'), '[^\\p{{L}}\\p{{N}}]', '', 'g') NOT IN ({", ".join(f"'{w}'" for w in L.ROLE_WORDS)})),
ql AS (SELECT id, question, lower(nfc_normalize(coalesce(question, ''))) AS lq, lower(question) AS lw FROM {_DQ}),
qw AS (SELECT id, question, lw, {link_words(f"coalesce(question, '') || {_RATIO_WORDS}")} AS w, years, CASE WHEN {_like("lw", S.SEPARATE_WORDS)} THEN 'separate' WHEN {_like("lw", S.CONSOLIDATED_WORDS)} THEN 'consolidated' END AS want, concepts
  FROM ql JOIN years USING (id) JOIN concepts USING (id)),
sc AS (SELECT *, len(list_intersect(w, lt)) / greatest(len(lt), 1) + CASE WHEN coalesce(list_contains(years, year), false) THEN 0.05e0 ELSE 0e0 END AS score,
   (want IS NOT NULL AND coalesce(variant NOT IN ('', 'unspecified') AND variant <> want, false))::INT
   + (len(years) > 0 AND NOT coalesce(list_contains(years, year), false) AND len(list_filter(years, lambda y: contains(h, y::VARCHAR))) = 0)::INT AS tier
  FROM (SELECT *, {link_words("label")} AS lt FROM vk JOIN pr USING (table_key)) JOIN qw USING (id)),
op AS (SELECT *, len(concepts) >= 2 AS several FROM sc QUALIFY score > 0 OR max(score) OVER (PARTITION BY id) <= 0),
cv AS (SELECT id, table_key, count(DISTINCT k) AS covers FROM (SELECT id, table_key, label, unnest(concepts) AS k FROM op) WHERE contains(lower(nfc_normalize(label)), k) GROUP BY ALL),
tn AS (SELECT op.*, coalesce(covers, 0) AS covers, row_number() OVER (PARTITION BY id, tier, table_key ORDER BY score DESC, r, c) AS turn, max(score) OVER (PARTITION BY id, tier, table_key) AS lead FROM op LEFT JOIN cv USING (id, table_key)),
ordered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY tier, CASE WHEN several THEN turn END, CASE WHEN several THEN -covers END, CASE WHEN several THEN -lead END, CASE WHEN several THEN table_key END, score DESC, table_key, r, c) AS pos FROM tn QUALIFY pos <= {L.MOST_OPERANDS})"""


def _ordered(spark: SparkSession, sf: str) -> DataFrame:
    pairs = _pairs(spark, sf)
    wanted = _tables(spark, sf).join(pairs.select("table_key").distinct(), "table_key", "left_semi")
    return L.ordered(L.operands(_asked(spark, sf), pairs, L.value_cells(_one_delivery(wanted))), S.concepts(_asked(spark, sf)))


ORACLE_OF_LINKS = {
    "l_operands": f"WITH {_OPS} SELECT id, pos, tier, table_key, r AS row_index, c AS column_index, label AS row_label, h AS column_header, x AS numeric_value, round(score, 6) AS score FROM ordered",
    "l_relevant_tables": f"""WITH {_OPS}, f AS (SELECT id, table_key, min(pos) AS pos FROM ordered GROUP BY ALL)
SELECT id, table_key, row_number() OVER (PARTITION BY id ORDER BY pos) AS rank FROM f QUALIFY rank <= {L.RELEVANT_TABLES}""",
}

@query(ORACLE_OF_LINKS["l_operands"])
def l_operands(spark: SparkSession, sf: str) -> DataFrame:
    o = _ordered(spark, sf)
    return o.select("id", "pos", "tier", "table_key", "row_index", "column_index", "row_label", "column_header", "numeric_value", F.round("score", 6).alias("score"))


@query(ORACLE_OF_LINKS["l_relevant_tables"])
def l_relevant_tables(spark: SparkSession, sf: str) -> DataFrame:
    return L.relevant_tables(_ordered(spark, sf))


_TICKERS = f"""av AS (SELECT DISTINCT pr.id, o.ticker, c.name FROM pr JOIN one o USING (table_key) LEFT JOIN companies c ON c.ticker = o.ticker WHERE o.ticker IS NOT NULL),
al AS (SELECT id, list_sort(list(ticker)) AS available FROM av GROUP BY 1),
cd AS (SELECT id, unnest({_CODES.replace("NOT IN ('BCTC', 'CTCP', 'TMCP', 'TCT', 'TNHH', 'VND')", "NOT IN (" + ", ".join(f"'{w}'" for w in L.NOT_TICKERS) + ")")}) AS code FROM {_DQ}),
sp AS (SELECT cd.* FROM cd JOIN av ON av.id = cd.id AND av.ticker = cd.code),
ne AS (SELECT sp.id, sp.code, count(*) AS n, any_value(av.ticker) AS t FROM sp JOIN av ON av.id = sp.id AND av.ticker <> sp.code AND list_contains({link_words("av.name")}, lower(sp.code)) GROUP BY ALL),
tk AS (SELECT sp.id, list_sort(list(DISTINCT CASE WHEN n = 1 THEN t ELSE sp.code END)) AS tickers FROM sp LEFT JOIN ne ON ne.id = sp.id AND ne.code = sp.code GROUP BY 1),
tickers AS (SELECT id, coalesce(tickers, []) AS tickers, coalesce(available, []) AS available FROM {_DQ} LEFT JOIN tk USING (id) LEFT JOIN al USING (id))"""


@query(f"WITH {_OPS}, {_TICKERS} SELECT id, tickers FROM tickers")
def l_tickers(spark: SparkSession, sf: str) -> DataFrame:
    av = G.available_tickers(_pairs(spark, sf), _one_delivery(_tables(spark, sf)))
    return G.precise_tickers(_asked(spark, sf), av, table(spark, sf, "companies"))


# The unit by a column's own header cells, else the stored scale, else the first row, else the table's units if they agree.
_SCALES = f"""hh AS (SELECT record_id, c, t, min(r) AS r FROM cs WHERE r < 6 AND t <> '' AND NOT {_NUM.format("t")} GROUP BY ALL),
hp AS (SELECT record_id, c, string_agg(t, ' | ' ORDER BY r) AS path FROM hh GROUP BY ALL),
hu AS (SELECT record_id, c, regexp_extract_all(path, '(?i)({_UNITS})', 1)[1] AS u FROM hp),
du AS (SELECT table_key, unnest(detected_units) AS u FROM one),
dn AS (SELECT table_key, min(s) AS s, count(DISTINCT s) AS n FROM (SELECT table_key, ({scale_sql("u")})::BIGINT AS s FROM du) WHERE s IS NOT NULL GROUP BY 1),
scales AS (SELECT o.table_key, a.c::INT AS c, coalesce(({scale_sql("hu.u")})::BIGINT, list_filter(o.column_metadata, lambda m: m.column_index = a.c)[1].scale_to_vnd, ({scale_sql("o.grid[1][a.c + 1]")})::BIGINT, CASE WHEN dn.n = 1 THEN dn.s END) AS s
  FROM (SELECT DISTINCT record_id, c FROM cs) a JOIN one o USING (record_id) LEFT JOIN hu ON hu.record_id = a.record_id AND hu.c = a.c LEFT JOIN dn ON dn.table_key = o.table_key)"""


@query(f"WITH {_OPS}, {_SCALES} SELECT table_key, c AS column_index, s AS source_scale FROM scales WHERE table_key IN (SELECT table_key FROM pr)")
def g_source_scales(spark: SparkSession, sf: str) -> DataFrame:
    t = _one_delivery(_tables(spark, sf)).join(_pairs(spark, sf).select("table_key").distinct(), "table_key", "left_semi").filter(F.size("grid") > 0)
    none = lambda c: F.array().cast(t.schema[c].dataType)
    return t.select("table_key", F.posexplode(G.column_scales(F.col("grid"), F.coalesce("column_metadata", none("column_metadata")), F.coalesce("detected_units", none("detected_units")))).alias("column_index", "source_scale"))


_UNIT = r"nullif(trim(regexp_extract(coalesce(question, ''), '(?i)((?:nghìn\s*tỷ|tỷ|triệu|nghìn)?\s*(?:đồng|vnd|%))', 1)), '')"
_MAX, _MIN = _like("lower(coalesce(question, ''))", P.MAX_WORDS), _like("lower(coalesce(question, ''))", P.MIN_WORDS)
_ROUTES = f"""fam AS (SELECT id, question, tickers, years, {_UNIT} AS unit, CASE {" ".join(f"WHEN {_like('lower(coalesce(question, {}))'.format(chr(39) * 2), w)} THEN '{n}'" for n, w in L.FAMILIES)}
   WHEN len(list_filter(list_intersect({_CODES.replace(" AND t NOT IN ('BCTC', 'CTCP', 'TMCP', 'TCT', 'TNHH', 'VND')", "")}, available), lambda t: t NOT IN ({", ".join(f"'{w}'" for w in L.NOT_TICKERS)}))) > 1 THEN 'cross_company_comparison'
   WHEN {_like("lower(coalesce(question, ''))", L.COMPARISON_WORDS)} THEN 'comparison' ELSE 'direct_lookup' END AS family,
   CASE WHEN {_MAX} THEN 'max' WHEN {_MIN} THEN 'min' END AS dir FROM {_DQ} JOIN tickers USING (id) JOIN years USING (id)),
routes AS (SELECT *, CASE WHEN family <> 'direct_lookup' THEN 'model' WHEN dir IS NOT NULL AND len(years) >= 2 THEN 'extremum' ELSE 'lookup' END AS route FROM fam)"""
_CANDIDATES = f"""ca AS (SELECT o.id, o.table_key, o.r, o.c, o.x, o.h, o.label, o.score, o.year, o.table_identity, o.lw, route, tickers, unit, s, ro.years,
   len(tickers) = 0 OR coalesce(list_contains(tickers, o.ticker), false) AS ok1,
   (CASE WHEN {_like("o.lw", G.PARENT_WORDS)} THEN coalesce(o.variant = 'separate', false) WHEN {_like("o.lw", G.GROUP_WORDS)} THEN coalesce(o.variant = 'consolidated', false) ELSE true END)
   AND o.r > 0 AND o.c > 0 AND trim(h) <> '' AND NOT {_like("lower(h)", P.NO_VALUE_HEADERS)} AS fit
  FROM ordered o JOIN routes ro ON ro.id = o.id LEFT JOIN scales sl ON sl.table_key = o.table_key AND sl.c = o.c)"""
_LOOKUPS = f"""c2 AS (SELECT *, ok1 AND fit AS ok2, list_distinct(regexp_extract_all(lw, '\\b(20[0-9]{{2}})\\b', 1)) AS ny, lower(label || ' ' || h) AS wh,
   CASE WHEN contains(lw, 'cuối năm') THEN 'cuối năm' WHEN contains(lw, 'đầu năm') THEN 'đầu năm' END AS per FROM ca WHERE route = 'lookup'),
c3 AS (SELECT *, coalesce(list_contains(ny, year::VARCHAR), false) AS iny, ok2 AND (len(ny) = 0 OR coalesce(list_contains(ny, year::VARCHAR), false) OR len(list_filter(ny, lambda y: contains(h, y))) > 0) AS ok3 FROM c2),
c4 AS (SELECT *, CASE WHEN bool_or(ok3 AND per IS NOT NULL AND (contains(wh, 'cuối năm') OR contains(wh, 'đầu năm'))) OVER (PARTITION BY id) THEN ok3 AND coalesce(contains(wh, per), false) ELSE ok3 END AS ok4 FROM c3),
c5 AS (SELECT *, count(*) FILTER (ok1) OVER w AS n1, count(*) FILTER (ok2) OVER w AS n2, count(*) FILTER (ok3) OVER w AS n3, count(*) FILTER (ok4) OVER w AS n4,
   row_number() OVER (PARTITION BY id ORDER BY ok4 DESC, round(score * 100 + (CASE WHEN iny THEN 20 ELSE 0 END) + (CASE WHEN iny AND contains(lower(h), 'năm nay') THEN 10 ELSE 0 END)
     - (CASE WHEN {_like("lower(coalesce(table_identity, ''))", P.NARRATIVE)} THEN 25 ELSE 0 END), 6) DESC, table_key DESC, r, c) AS k FROM c4 WINDOW w AS (PARTITION BY id)),
lk AS (SELECT ro.id, ro.unit, table_key, r, c, x, s, {scale_sql("ro.unit")} AS ts, CASE WHEN coalesce(n1, 0) = 0 THEN '{G.REASONS[0]}' WHEN n2 = 0 THEN '{G.REASONS[1]}' WHEN n3 = 0 THEN '{G.REASONS[2]}' WHEN n4 = 0 THEN '{G.REASONS[3]}'
   WHEN s IS NULL AND {scale_sql("ro.unit")} IS NOT NULL THEN '{G.REASONS[4]}' END AS reason FROM routes ro LEFT JOIN c5 ON c5.id = ro.id AND k = 1 WHERE ro.route = 'lookup')"""
_ALL = f"{_OPS}, {_TICKERS}, {_SCALES}, {_ROUTES}, {_CANDIDATES}, {_LOOKUPS}"


def _linked(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs, tables and ordered operands with units of the tables that answers cite."""
    t = _one_delivery(_tables(spark, sf))
    return _pairs(spark, sf), t, G.with_scales(settle(_ordered(spark, sf)), t)


@query(f"WITH {_ALL} SELECT id, question, family, tickers, route FROM routes")
def g_routes(spark: SparkSession, sf: str) -> DataFrame:
    return G.routes(_asked(spark, sf), _pairs(spark, sf), _one_delivery(_tables(spark, sf)), table(spark, sf, "companies"))


@query(f"""WITH {_ALL} SELECT id, CASE WHEN reason IS NULL THEN table_key END AS table_key, CASE WHEN reason IS NULL THEN r END AS row_index, CASE WHEN reason IS NULL THEN c END AS column_index, CASE WHEN reason IS NULL THEN x END AS numeric_value,
 CASE WHEN reason IS NULL THEN round(x * CASE WHEN ts IS NULL OR s IS NULL THEN 1e0 ELSE s::DOUBLE / ts END, 6) END AS answer, unit, reason FROM lk""")
def g_lookups(spark: SparkSession, sf: str) -> DataFrame:
    """Lookup questions answered from the tables that answers cite, or the reason why not."""
    pairs, t, ops = _linked(spark, sf)
    r = settle(G.routes(_asked(spark, sf), pairs, t, table(spark, sf, "companies")).filter("route = 'lookup'").select("id", "question", "tickers"))
    return G.lookups(ops, r).select("id", "table_key", "row_index", "column_index", "numeric_value", F.round("answer", 6).alias("answer"), "unit", "reason")


def chain(spark: SparkSession, sf: str) -> DataFrame:
    """All questions from retrieval to answer, without a model: what `jobs.answer_all` writes."""
    t = _one_delivery(_tables(spark, sf))
    rankings = settle(_ranking(spark, sf))
    return jobs.predictions(_asked(spark, sf), rankings, t, table(spark, sf, "companies"))


@query()
def e_answers(spark: SparkSession, sf: str) -> DataFrame:
    return chain(spark, sf)


# ---- signs, actions, repair


_FAMILY = f"""CASE {" ".join(f"WHEN {_like('q', w)} THEN '{n}'" for n, w in L.FAMILIES)} WHEN {_like("q", L.COMPARISON_WORDS)} THEN 'comparison' ELSE 'direct_lookup' END"""
#: Predictions from the answers: the largest expected answer of each question, with the tables and cells that answers cite.
_SIGNS = f"""one AS (SELECT * FROM norm_tables QUALIFY row_number() OVER (PARTITION BY table_key ORDER BY record_id) = 1), {_YEARS},
us AS (SELECT a.id, list_distinct(list(ticker) FILTER (ticker IS NOT NULL)) AS ut, list_distinct(list(year) FILTER (year IS NOT NULL)) AS uy, list_distinct(list(variant) FILTER (variant IS NOT NULL)) AS uv, count(*) AS nt
  FROM (SELECT DISTINCT id, table_key FROM dev_answers WHERE table_key IS NOT NULL) a JOIN one USING (table_key) GROUP BY 1),
nc AS (SELECT id, count(*) AS nc, max(expected_answer) AS answer FROM (SELECT DISTINCT id, table_key, row_index, column_index, expected_answer FROM dev_answers) GROUP BY 1),
pd AS (SELECT id, question, lower(coalesce(question, '')) AS q, {_CODES} AS codes, years, ut, uy, uv, nt, nc, answer FROM {_DQ} JOIN us USING (id) JOIN nc USING (id) JOIN years USING (id)),
sg AS (SELECT id, question, q, answer, {_FAMILY} AS fam, list_filter([
  CASE WHEN {_FAMILY} IN ({", ".join(f"'{x}'" for x in ("ratio_or_derived", "growth", "aggregation", "comparison", "cross_company_comparison"))}) AND nt <= 1 THEN 'collapse' END,
  CASE WHEN len(codes) > 0 AND len(ut) > 0 AND NOT list_has_any(codes, ut) THEN 'entity' END,
  CASE WHEN len(years) > 0 AND len(uy) > 0 AND NOT list_has_any(years, uy) THEN 'year' END,
  CASE WHEN len(uv) > 0 AND NOT list_contains(uv, CASE WHEN {_like("q", S.SEPARATE_WORDS)} THEN 'separate' WHEN {_like("q", S.CONSOLIDATED_WORDS)} THEN 'consolidated' END) THEN 'variant' END,
  CASE WHEN {_FAMILY} IN ('comparison', 'growth', 'ratio_or_derived') AND nc <= 1 THEN 'structure' END,
  CASE WHEN isnan(answer) OR abs(answer) > 1e15 OR (answer <> 0 AND abs(answer) < 1e-9) THEN 'magnitude' END], lambda x: x IS NOT NULL) AS codes FROM pd)"""


def _signed(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "dev_answers")
    t = _one_delivery(_tables(spark, sf)).select("table_key", "ticker", "year", "variant")
    own = lambda c: F.array_sort(F.collect_set(c)).alias(f"used_{c}s")
    used = _pairs(spark, sf).join(t, "table_key").groupBy("id").agg(own("ticker"), own("year"), own("variant"), F.count("*").alias("n_tables"))
    n = a.select("id", "table_key", "row_index", "column_index", "expected_answer").distinct().groupBy("id").agg(F.count("*").alias("n_cells"), F.max("expected_answer").alias("answer"))
    return _asked(spark, sf).join(used, "id").join(n, "id")


@query(f"WITH {_SIGNS} SELECT id, codes FROM sg")
def r_signs(spark: SparkSession, sf: str) -> DataFrame:
    return D.signs(_signed(spark, sf)).select("id", "codes")


@query(f"WITH {_SIGNS} SELECT array_to_string(list_sort(codes), '+') AS combination, count(*) AS n FROM sg GROUP BY 1")
def r_sign_summary(spark: SparkSession, sf: str) -> DataFrame:
    return D.summary(D.signs(_signed(spark, sf)))


_UNSUPPORTED = f"({_like('q', D.SUPERLATIVES)} AND {_like('q', D.WHICH_COMPANY)})"


@query(f"""WITH {_SIGNS} SELECT id, CASE WHEN {_UNSUPPORTED} THEN 'mark_unsupported' WHEN len(codes) = 0 THEN 'keep' WHEN fam = 'direct_lookup' THEN 'rebuild_deterministic'
 WHEN list_has_any(codes, ['entity', 'year', 'variant']) THEN 'relink_then_regenerate' ELSE 'regenerate' END AS action FROM sg""")
def r_actions(spark: SparkSession, sf: str) -> DataFrame:
    return D.diagnosed(_signed(spark, sf)).select("id", "action")


@query(f"""WITH {_ALL}, u AS (SELECT lk.id, lk.reason, lower(coalesce(question, '')) AS q FROM lk JOIN {_DQ} USING (id) WHERE reason IS NOT NULL)
SELECT id, CASE WHEN {_UNSUPPORTED} THEN 'mark_unsupported' WHEN reason = '{G.REASONS[4]}' THEN 'resolve_unit_deterministic' ELSE 'relink_then_regenerate' END AS action, CASE WHEN {_UNSUPPORTED} THEN 0 WHEN reason = '{G.REASONS[4]}' THEN 1 ELSE 2 END AS budget FROM u""")
def r_failure_actions(spark: SparkSession, sf: str) -> DataFrame:
    """What to do about the lookups that have no answer."""
    failed = g_lookups(spark, sf).filter("reason is not null").select("id", "reason").join(_asked(spark, sf), "id")
    return D.diagnosed_failures(failed).select("id", "action", "budget")


# Candidates: the smallest expected answer of each question in place of the largest; every third has its last sign less.
@query(f"""WITH {_SIGNS}, o AS (SELECT id, codes FROM sg WHERE id % 5 <> 0), c AS (SELECT sg.id, lo AS answer, CASE WHEN sg.id % 3 = 0 THEN codes[:-2] ELSE codes END AS codes, hi = lo AS same
  FROM sg JOIN (SELECT id, min(expected_answer) AS lo, max(expected_answer) AS hi FROM dev_answers GROUP BY 1) USING (id)),
j AS (SELECT c.id, CASE WHEN c.answer IS NULL THEN 'not executed' WHEN o.id IS NOT NULL AND same AND c.id % 2 = 0 THEN 'the same plan' WHEN o.id IS NULL AND len(c.codes) > 0 THEN 'recovered with signs' WHEN o.id IS NULL THEN 'recovered'
  WHEN len(c.codes) >= len(o.codes) THEN 'no fewer signs' ELSE 'fewer signs' END AS why FROM c LEFT JOIN o USING (id)) SELECT id, why, why IN ('recovered', 'fewer signs') AS accepted FROM j""")
def r_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    o, c = _repair_sides(spark, sf)
    return D.outcomes(c, o).select("id", "why", "accepted")


def _repair_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    s = D.signs(_signed(spark, sf)).select("id", "codes")
    a = table(spark, sf, "dev_answers").groupBy("id").agg(F.min("expected_answer").alias("lo"), F.max("expected_answer").alias("hi"))
    cells = F.array().cast("array<string>").alias("cells")
    o = s.filter("id % 5 <> 0").select("id", "codes", F.lit("x").alias("expression"), cells)
    fewer = F.when(F.col("id") % 3 == 0, F.slice("codes", F.lit(1), F.greatest(F.size("codes") - 1, F.lit(0)))).otherwise(F.col("codes"))
    c = s.join(a, "id").select("id", F.col("lo").alias("answer"), F.when((F.col("lo") == F.col("hi")) & (F.col("id") % 2 == 0), "x").otherwise("y").alias("expression"), cells, F.col("lo").isNotNull().alias("executed"), fewer.alias("codes"))
    return o, c


@query(f"""WITH {_SIGNS}, k AS (SELECT id, id % 5 <> 0 AS o, id % 3 = 0 AS a FROM sg)
SELECT count(*) AS n_total, count(*) FILTER (o AND NOT a) AS n_unchanged, count(*) FILTER (o AND a) AS n_repaired, count(*) FILTER (NOT o AND a) AS n_recovered FROM k WHERE o OR a""")
def r_final_report(spark: SparkSession, sf: str) -> DataFrame:
    ids = _signed(spark, sf).select("id")
    return D.final_report(ids.filter("id % 5 <> 0"), ids.filter("id % 3 = 0"))


# ---- evaluation


_NEAR = f"""got AS (SELECT query_id, q.label || '|' || doc_id AS key, rank FROM (SELECT k.query_id, k.rank, k.doc_id, e.label FROM {_knn_sql("true")} k JOIN embeddings e ON e.vec_id = k.doc_id) q),
rel AS (SELECT q.vec_id AS query_id, d.label || '|' || d.vec_id AS key FROM embeddings q JOIN embeddings d ON d.label = q.label AND d.vec_id // 50 = q.vec_id // 50 WHERE q.vec_id % 20 = 0)"""


def _near(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Nearest vectors as retrieved tables, vectors of the same label and block of ids as relevant ones; the label is the document."""
    e, q = _vectors(spark, sf)
    key = F.concat_ws("|", F.col("scope").cast("string"), F.col("doc_id").cast("string"))
    got = _knn(spark, sf, False).join(e.select("doc_id", "scope"), "doc_id").select("query_id", key.alias("key"), "rank")
    block = lambda c: F.floor(F.col(c) / 50)
    rel = q.select("query_id", "scope", block("query_id").alias("b")).join(e.select("doc_id", "scope", block("doc_id").alias("b")), ["scope", "b"]).select("query_id", key.alias("key"))
    return got, rel


def _sheet_sql(level: str, of: str) -> str:
    return f"""SELECT '{level}' AS level, count(*) AS n_queries, round(avg(p), 6) AS precision_macro, round(avg(r), 6) AS recall_macro, round(avg(CASE WHEN p + r = 0 THEN 0 ELSE 5e0 * p * r / (4e0 * p + r) END), 6) AS f2_macro, round(avg(rr), 6) AS mrr FROM (
 SELECT query_id, coalesce(n_both / nullif(n_got, 0)::DOUBLE, 0) AS p, n_both / n_rel::DOUBLE AS r, coalesce(rr, 0) AS rr FROM (SELECT query_id, count(DISTINCT {of.format("key")}) AS n_rel FROM rel GROUP BY 1)
 LEFT JOIN (SELECT query_id, count(DISTINCT {of.format("key")}) AS n_got FROM got GROUP BY 1) USING (query_id)
 LEFT JOIN (SELECT g.query_id, count(DISTINCT {of.format("g.key")}) AS nb, min(CASE WHEN rank <= 5 THEN rank END) AS mr, 1e0 / min(CASE WHEN rank <= 5 THEN rank END) AS rr FROM got g JOIN (SELECT DISTINCT query_id, {of.format("key")} AS key FROM rel) w ON w.query_id = g.query_id AND w.key = {of.format("g.key")} GROUP BY 1) b USING (query_id),
 LATERAL (SELECT coalesce(nb, 0) AS n_both))"""


@query(f"WITH {_NEAR} {_sheet_sql('tables', '{}')} UNION ALL {_sheet_sql('documents', chr(39).join(['split_part({}, ', '|', ', 1)']))}")
def m_sheet(spark: SparkSession, sf: str) -> DataFrame:
    got, rel = _near(spark, sf)
    s = M.sheet(got, rel, F.substring_index("key", "|", 1))
    return s.select("level", "n_queries", *[F.round(c, 6).alias(c) for c in ("precision_macro", "recall_macro", "f2_macro", "mrr")])


@query(f"""WITH {_NEAR}, ks AS (SELECT unnest([1, 2, 5, 8, 10]) AS k), base AS (SELECT query_id, count(*) AS n FROM rel GROUP BY 1),
s AS (SELECT base.query_id, k, n, count(g.key) AS ng, count(r.key) AS nb FROM base CROSS JOIN ks LEFT JOIN got g ON g.query_id = base.query_id AND g.rank <= k LEFT JOIN rel r ON r.query_id = g.query_id AND r.key = g.key GROUP BY ALL),
p AS (SELECT k, coalesce(nb / nullif(ng, 0)::DOUBLE, 0) AS p, nb / n::DOUBLE AS r FROM s)
SELECT k, count(*) AS n_queries, round(avg(p), 6) AS precision_macro, round(avg(r), 6) AS recall_macro, round(avg(CASE WHEN p + r = 0 THEN 0 ELSE 5e0 * p * r / (4e0 * p + r) END), 6) AS f2_macro FROM p GROUP BY 1""")
def m_k_sweep(spark: SparkSession, sf: str) -> DataFrame:
    m = M.at_ks(*_near(spark, sf), (1, 2, 5, 8, 10))
    return m.select("k", "n_queries", *[F.round(c, 6).alias(c) for c in ("precision_macro", "recall_macro", "f2_macro")])


@query()
def m_retrieval_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """The ranked tables of all questions against the tables that answers cite, by tables, for several k."""
    got = _ranking(spark, sf).select(F.col("id").alias("query_id"), F.col("table_key").alias("key"), F.col("pos").alias("rank"))
    return M.at_ks(got, _pairs(spark, sf).select(F.col("id").alias("query_id"), F.col("table_key").alias("key")), (5, 8, 10, 12, 15, 20, 30))


@query(f"""WITH one AS (SELECT * FROM norm_tables QUALIFY row_number() OVER (PARTITION BY table_key ORDER BY record_id) = 1),
a AS (SELECT DISTINCT id, expected_answer, table_key, row_index, column_index FROM dev_answers), b AS (SELECT a.*, replace(o.grid[a.row_index + 1][a.column_index + 1], chr(160), ' ') AS cell FROM a LEFT JOIN one o USING (table_key)),
d AS (SELECT *, {number_sql("cell")} AS answer FROM b)
SELECT CASE WHEN answer IS NULL THEN CASE WHEN table_key IS NULL THEN 'generation_or_validation_failed' ELSE 'execution_crashed' END WHEN expected_answer IS NULL THEN 'executed_unscored'
 WHEN coalesce(abs(answer - expected_answer) <= greatest(1e-6 * greatest(abs(answer), abs(expected_answer)), 1e-6), false) THEN 'correct' ELSE 'executed_wrong' END AS outcome, count(*) AS n FROM d GROUP BY 1""")
def m_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Cited cells taken for answers, by what became of them."""
    a = table(spark, sf, "dev_answers").select("id", "expected_answer", "table_key", "row_index", "column_index").distinct()
    cells = _one_delivery(_tables(spark, sf)).join(a.select("table_key").distinct(), "table_key", "left_semi").select("table_key", "grid")
    d = a.join(cells, "table_key", "left").select("expected_answer", "table_key", number(F.get(F.get("grid", F.col("row_index")), F.col("column_index"))).alias("answer"))
    o = M.outcome(F.col("answer").isNotNull(), F.when(F.col("table_key").isNull(), "generation").otherwise("execution"), F.col("answer"), F.col("expected_answer"))
    return d.groupBy(o.alias("outcome")).agg(F.count("*").alias("n"))


@query(rf"""WITH t AS (SELECT o_orderkey % 7 AS k, o_orderkey % 2 = 0 AS even, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE round(o_totalprice, 2) * CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END END AS expected, round(o_totalprice, 2) AS a FROM orders)
SELECT CASE WHEN expected IS NULL THEN 'no_expected_answer' WHEN k = 0 THEN 'no_formula' WHEN abs(v - expected) <= greatest(1e-6 * greatest(abs(v), abs(expected)), 1e-6) THEN 'pass' ELSE 'fail' END AS status, count(*) AS n
FROM (SELECT *, CASE WHEN even THEN a ELSE a END AS v FROM t) GROUP BY 1""")
def m_derivations(spark: SparkSession, sf: str) -> DataFrame:
    """Formulas written beside order totals, of which every third expected answer is wrong, every fifth missing, every seventh text without a formula."""
    two = lambda c: F.format_string("%.2f", c)
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.round("o_totalprice", 2).cast("double").alias("a"))
    even = F.concat(F.lit("Lấy ("), two(F.col("a") * 2), F.lit(" - "), two(F.col("a")), F.lit(") / 100.0 * 100"))
    odd = F.concat(F.lit("(9 - 1) rồi "), two(F.col("a") * 1e6), F.lit(" VND / 1e6"))
    text = F.when(F.col("k") % 7 == 0, "theo bảng").when(F.col("k") % 2 == 0, even).otherwise(odd)
    expected = F.when(F.col("k") % 5 != 0, F.col("a") * F.when(F.col("k") % 3 == 0, 2.0).otherwise(1.0))
    return o.groupBy(M.derivation_status(expected, text).alias("status")).agg(F.count("*").alias("n"))

"""Queries p2, p4 and p6 over the report-table data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import ONE_DST, ONE_SRC
from ..operators import amounts, intake, shred
from ..session import settle, table

CHILDREN = {
    "tables": {"line_position": "bigint", "page": "bigint", "section_header": "string", "currency_hint": "string"},
    "column_metadata": {"column_index": "bigint", "header_path": "string", "source_unit": "string", "scale_to_vnd": "bigint"},
    "period_labels": {"row_index": "bigint", "column_index": "bigint", "label": "string"},
    "row_labels": {"row_index": "bigint", "column_index": "bigint", "label": "string"},
    "sub_labels": {"row_index": "bigint", "column_index": "bigint", "label": "string"},
}


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return _levels(spark, sf).select("store_id", "path")


def _levels(spark: SparkSession, sf: str) -> DataFrame:
    """Elements of the arrays that the merged schema lists; a lone value counts as an element of the five named ones, listed or not."""
    t = table(spark, sf, "table_store").select("store_id", "payload")
    listed = shred.listed_arrays(t, "payload")
    levels = shred.flatten_levels(t, "store_id", "payload", tuple(dict.fromkeys((*shred.LABEL_ARRAYS, *listed))))
    return levels.filter(F.col("name").isin(*shred.LABEL_ARRAYS))


def p2_elements(spark: SparkSession, sf: str) -> DataFrame:
    """Elements of every array that the merged schema lists, whatever its name."""
    levels = shred.flatten_levels(table(spark, sf, "table_store"), "store_id", "payload")
    return levels.select("store_id", "path", "parent_path", "name", "ordinal", "level")


def p2_schema(spark: SparkSession, sf: str) -> DataFrame:
    return shred.merged_schema(table(spark, sf, "table_store"), "payload").groupBy("level", "kind").agg(F.sum("n").alias("n"))


def p2_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return shred.rejected(table(spark, sf, "table_store"), "store_id", "payload")


def p2_row_labels(spark: SparkSession, sf: str) -> DataFrame:
    kids = shred.child_tables(_levels(spark, sf), "store_id", CHILDREN)
    return kids["row_labels"].unionByName(kids["sub_labels"]).select("store_id", "path", "parent_path", "ordinal", "row_index", "column_index", "label")


def _store_child(spark: SparkSession, sf: str, array: str) -> DataFrame:
    return shred.child_tables(_levels(spark, sf), "store_id", {array: CHILDREN[array]})[array]


def p2_tables(spark: SparkSession, sf: str) -> DataFrame:
    return _store_child(spark, sf, "tables")


def p2_columns(spark: SparkSession, sf: str) -> DataFrame:
    return _store_child(spark, sf, "column_metadata")


def p2_period_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Periods of tables have their fields, those of columns are texts in value."""
    return _store_child(spark, sf, "period_labels")


def p2_norm_columns(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "norm_tables")
    return shred.flatten_typed(t, "record_id", "column_metadata", F.col("table_key")).drop("period_labels")


def p2_norm_column_periods(spark: SparkSession, sf: str) -> DataFrame:
    return shred.flatten_nested(table(spark, sf, "norm_tables"), "record_id", "column_metadata", F.col("table_key"))["column_metadata.period_labels"]


def p2_norm_period_labels(spark: SparkSession, sf: str) -> DataFrame:
    return shred.flatten_nested(table(spark, sf, "norm_tables"), "record_id", "period_labels", F.col("table_key"))["period_labels"]


def p2_norm_row_labels(spark: SparkSession, sf: str) -> DataFrame:
    return shred.flatten_typed(table(spark, sf, "norm_tables"), "record_id", "row_labels", F.col("table_key"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return intake.rejected(table(spark, sf, "raw_feed")).select("line_id", "reason")


def p4_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return intake.loaded(table(spark, sf, "raw_feed"), "candidates")


def p4_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return intake.loaded(table(spark, sf, "raw_feed"), "anomalies")


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    return amounts.off_answers(table(spark, sf, "dev_answers"), table(spark, sf, "norm_tables"), table(spark, sf, "fx_rates"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return _answers(spark, sf).filter("off").select("id").distinct()


def p6_answers_vnd(spark: SparkSession, sf: str) -> DataFrame:
    return _answers(spark, sf).select("id", "table_key", "row_index", "column_index", "cell_value", "cell_vnd", "answer_vnd", "off")


def p6_cells_vnd(spark: SparkSession, sf: str) -> DataFrame:
    return amounts.table_amounts(table(spark, sf, "norm_tables"), table(spark, sf, "fx_rates"))


def p6_unit_shifts(spark: SparkSession, sf: str) -> DataFrame:
    """Segments of every series with what its stated units say to each change."""
    return amounts.unit_shifts(amounts.amount_points(table(spark, sf, "norm_tables")))


def p6_history(spark: SparkSession, sf: str) -> DataFrame:
    """Every amount with its series, also in the unit of the series' latest segment."""
    points = settle(amounts.amount_points(table(spark, sf, "norm_tables")))
    return amounts.reversed_history(points, amounts.unit_shifts(points))


def p6_cells_stated(spark: SparkSession, sf: str) -> DataFrame:
    """The cells of p6_cells_vnd whose unit is stated; SQL can't search for changepoints."""
    t = table(spark, sf, "norm_tables").drop("detected_units", "currency_hint", "ticker")
    return amounts.table_amounts(t, table(spark, sf, "fx_rates")).filter("unit_source = 'stated'").select("record_id", "row_index", "column_index", "value", "value_vnd")


QUERIES = {f.__name__: f for f in (p2_found, p2_schema, p2_elements, p2_rejected, p2_row_labels, p2_tables, p2_columns, p2_period_labels, p2_norm_columns, p2_norm_column_periods, p2_norm_period_labels, p2_norm_row_labels, p4_found, p4_candidates, p4_anomalies, p6_found, p6_answers_vnd, p6_cells_vnd, p6_cells_stated, p6_unit_shifts, p6_history)}

_NAMES = "tables|column_metadata|period_labels|row_labels|sub_labels"
_LONE = rf"'\.({_NAMES})(\.|$)', '.\1[0]\2', 'g'"
_FIELD = '"(?:[^"]|"")*"|[^",]*'

_P4_BASE = rf"""
WITH q AS (SELECT line_id, feed, coalesce(raw_line, '') AS r FROM raw_feed),
f AS (SELECT *, regexp_full_match(r, '(?s)(?:{_FIELD})(?:,(?:{_FIELD}))*') AS good,
      list_transform(regexp_extract_all(',' || r, '(?s),({_FIELD})', 1),
        lambda x: CASE WHEN x[1] = '"' THEN replace(x[2:-2], '""', '"') ELSE x END) AS c FROM q),
j AS (SELECT line_id, feed, c, CASE WHEN NOT good THEN 'quoting'
   WHEN feed IS NULL OR len(c) <> CASE feed WHEN 'candidates' THEN 10 WHEN 'anomalies' THEN 5 ELSE -1 END THEN 'column_count'
   WHEN feed = 'candidates' AND NOT (c[1] <> '' AND regexp_full_match(c[2], '[0-9]*[1-9][0-9]*')
     AND regexp_full_match(c[3], '|[0-9]*[1-9][0-9]*') AND c[5] IN ('success', 'parsed_with_warnings', 'failed')
     AND regexp_full_match(c[6], '[0-9]+') AND regexp_full_match(c[7], '[0-9]+')
     AND regexp_full_match(c[9], '(?s)[ \t\r\n]*\[[ \t\r\n]*(?:"(?:[^"\\\x00-\x1f]|\\["\\/bfnrt]|\\u[0-9a-fA-F]{{4}})*"[ \t\r\n]*(?:,[ \t\r\n]*"(?:[^"\\\x00-\x1f]|\\["\\/bfnrt]|\\u[0-9a-fA-F]{{4}})*"[ \t\r\n]*)*)?\][ \t\r\n]*')) THEN 'invalid_value'
   WHEN feed = 'anomalies' AND NOT (c[1] = c[2] || '|' || c[3] AND c[2] <> '' AND regexp_full_match(c[3], '[0-9]*[1-9][0-9]*')
     AND CASE WHEN regexp_full_match(c[5], 'n_rows>200:[0-9]+') THEN try_cast(c[5][12:] AS HUGEINT) > 200
              WHEN regexp_full_match(c[5], 'n_cols>50:[0-9]+') THEN try_cast(c[5][11:] AS HUGEINT) > 50 ELSE false END) THEN 'invalid_value'
   END AS reason FROM f)
"""


def _child_sql(array: str, drop_value: bool = False) -> str:
    """Child table of one array of table_store, by the paths of json_tree."""
    fields = ", ".join(f"try_cast(v ->> '$.{f}' AS {'VARCHAR' if t == 'string' else 'BIGINT'}) AS {f}" for f, t in CHILDREN[array].items())
    value = "" if drop_value else ",\n  CASE WHEN ty NOT IN ('OBJECT', 'ARRAY') THEN v ->> '$' END AS value"
    return rf"""
WITH n AS (SELECT t.store_id, j.type AS ty, j.value AS v, regexp_replace(regexp_replace(replace(replace(j.fullkey, '"', ''), '$', ''), {_LONE}), {_LONE}) AS p, j.fullkey AS k
  FROM table_store t, json_tree(t.payload) j WHERE json_valid(t.payload))
SELECT store_id, p[2:] AS path, nullif(regexp_replace(p[2:], '\.?{array}\[[0-9]+\]$', ''), '') AS parent_path, regexp_extract(p, '\[([0-9]+)\]$', 1)::INT AS ordinal, {fields}{value}
FROM n WHERE ty <> 'NULL' AND regexp_matches(p, '\.{array}\[[0-9]+\]$') AND NOT (ty = 'ARRAY' AND regexp_matches(replace(k, '"', ''), '\.{array}$'))"""


# Units in SQL, written for themselves: a phrase is what stands between signs that are no letters or digits.
def _one_sql(c: str) -> str:
    src, dst = (x.replace("'", "''") for x in (ONE_SRC, ONE_DST))
    return f"translate({c}, '{src}', '{dst}')"


def _plain_sql(c: str) -> str:
    folded = f"replace(lower(strip_accents({_one_sql(c)})), 'đ', 'd')"
    return rf"trim(regexp_replace(regexp_replace({folded}, '\s+', ' ', 'g'), '\b(hop|hoi|hoat|lao|bien|cong|tac|co|dong) dong', '', 'g'))"


_BIG = r"(?:nghin|ngan) (?:ty|ti)|ty|ti|billion|trieu|tr\.?|million|nghin|ngan|thousand|1[.,]000"
_MONEY = r"do la singapore|sgd|do la my|do la|usd|us\$|\$|euro|eur|nhan dan te|cny|yen nhat|yen|jpy|dong viet nam|dong vn|dong|vnd|d"
_PHRASE = rf"((?:(?:{_BIG}) ?)?(?:{_MONEY})(?: (?:billion|million|thousand))?)(?:[^a-z0-9]|$)"


def _phrase_sql(c: str, before: str = "(?:^|[^a-z0-9])") -> str:
    return f"regexp_extract_all({_plain_sql(c)}, '{before}{_PHRASE}', 1)"


def _factor_sql(u: str) -> str:
    scale = rf"""CASE WHEN regexp_matches({u}, '^(nghin|ngan) (ty|ti) ') THEN 1e12 WHEN regexp_matches({u}, '^(ty|ti|billion) | billion$') THEN 1e9
 WHEN regexp_matches({u}, '^(trieu|million) |^tr\.?d| million$') THEN 1e6 WHEN regexp_matches({u}, '^(nghin|ngan|thousand|1[.,]000) | thousand$') THEN 1e3 ELSE 1e0 END"""
    return scale


def _currency_sql(u: str) -> str:
    return rf"""CASE WHEN regexp_matches({u}, 'singapore|sgd') THEN 'SGD' WHEN regexp_matches({u}, 'do la|usd|\$') THEN 'USD' WHEN {u} LIKE '%eur%' THEN 'EUR' WHEN regexp_matches({u}, 'nhan dan te|cny') THEN 'CNY'
 WHEN regexp_matches({u}, 'yen|jpy') THEN 'JPY' WHEN {u} IS NOT NULL THEN 'VND' END"""


_P6 = rf"""
WITH one AS (SELECT * FROM norm_tables WHERE len(grid) > 0 QUALIFY row_number() OVER (PARTITION BY table_key ORDER BY record_id) = 1),
a AS (SELECT DISTINCT id, expected_answer, expected_unit, table_key, row_index AS r, column_index AS c FROM dev_answers WHERE table_key IS NOT NULL AND row_index IS NOT NULL AND column_index IS NOT NULL),
j AS (SELECT a.*, grid[r + 1][c + 1] AS cell, coalesce(year, try_cast(regexp_extract(report_id, '_(20[0-9]{{2}})(_|$)', 1) AS INT)) AS y, caption_context, unit_declaration,
   list_transform(grid[1:least(r, 6)], lambda x: x[c + 1]) AS above FROM a JOIN one USING (table_key)),
h AS (SELECT *, list_filter(list_transform(above, lambda x: {_phrase_sql("x")}[-1]), lambda x: x IS NOT NULL)[1] AS hu,
   list_filter(list_transform(caption_context, lambda x: {_phrase_sql("x", "(?:^|[^a-z])(?:don vi(?: tinh)?(?: tien te)?|dvt|unit|currency)[^a-z0-9]*")}[1]), lambda x: x IS NOT NULL)[-1] AS cu,
   {_phrase_sql("unit_declaration")}[-1] AS du, {_phrase_sql("expected_unit")}[-1] AS eu,
   regexp_replace(regexp_replace({_one_sql("cell")}, '\s', '', 'g'), '[−–—]', '-', 'g') AS t FROM j),
n AS (SELECT *, coalesce(hu, cu, du) AS u, replace(regexp_replace(t, '[-+()]', '', 'g'), ',', '.') AS d FROM h),
v AS (SELECT *, CASE WHEN regexp_full_match(t, '[-+(]*[0-9]+([.,][0-9]+)*\)?') THEN
   (CASE WHEN t LIKE '-%' OR t LIKE '(%)' THEN -1 ELSE 1 END) * CASE WHEN d NOT LIKE '%.%' OR length(split_part(d, '.', -1)) = 3 THEN replace(d, '.', '')::DOUBLE
     ELSE replace(d, '.', '')::DOUBLE / pow(10e0, length(split_part(d, '.', -1))) END END AS x FROM n),
w AS (SELECT v.*, x * {_factor_sql("u")} * CASE WHEN {_currency_sql("u")} = 'VND' THEN 1e0 ELSE f.vnd_per_unit END AS cell_vnd,
   expected_answer * {_factor_sql("eu")} * CASE WHEN {_currency_sql("eu")} = 'VND' THEN 1e0 ELSE g.vnd_per_unit END AS answer_vnd
  FROM v LEFT JOIN fx_rates f ON f.currency = {_currency_sql("u")} AND f.fx_year = y LEFT JOIN fx_rates g ON g.currency = {_currency_sql("eu")} AND g.fx_year = y)
"""

_P6_CELLS = rf"""
WITH rows_ AS (SELECT record_id, generate_subscripts(grid, 1) - 1 AS r, unnest(grid) AS row FROM norm_tables WHERE len(grid) > 0),
cells AS (SELECT record_id, r, generate_subscripts(row, 1) - 1 AS c, unnest(row) AS cell FROM rows_),
hw AS (SELECT record_id, c, r, {_phrase_sql("cell")}[-1] AS u FROM cells WHERE r < 6),
hu AS (SELECT record_id, c, arg_min(u, r) AS u FROM hw WHERE u IS NOT NULL GROUP BY ALL),
tu AS (SELECT record_id, coalesce(list_filter(list_transform(caption_context, lambda x: {_phrase_sql("x", "(?:^|[^a-z])(?:don vi(?: tinh)?(?: tien te)?|dvt|unit|currency)[^a-z0-9]*")}[1]), lambda x: x IS NOT NULL)[-1],
   {_phrase_sql("unit_declaration")}[-1]) AS u, coalesce(year, try_cast(regexp_extract(report_id, '_(20[0-9]{{2}})(_|$)', 1) AS INT)) AS y FROM norm_tables),
v AS (SELECT record_id, r, c, coalesce(hu.u, tu.u) AS u, y, regexp_replace(regexp_replace({_one_sql("cell")}, '\s', '', 'g'), '[−–—]', '-', 'g') AS t
  FROM cells LEFT JOIN hu USING (record_id, c) JOIN tu USING (record_id) WHERE r > 0 AND c > 0),
n AS (SELECT *, replace(regexp_replace(t, '[-+()]', '', 'g'), ',', '.') AS d FROM v WHERE u IS NOT NULL AND regexp_full_match(t, '[-+(]*[0-9]+([.,][0-9]+)*\)?')),
x AS (SELECT *, (CASE WHEN t LIKE '-%' OR (t LIKE '(%' AND t LIKE '%)') THEN -1 ELSE 1 END) * CASE WHEN d NOT LIKE '%.%' OR length(split_part(d, '.', -1)) = 3 THEN replace(d, '.', '')::DOUBLE
     ELSE replace(d, '.', '')::DOUBLE / pow(10e0, length(split_part(d, '.', -1))) END AS value FROM n)
SELECT record_id, r::INT AS row_index, c::INT AS column_index, value, value * {_factor_sql("u")} * CASE WHEN {_currency_sql("u")} = 'VND' THEN 1e0 ELSE f.vnd_per_unit END AS value_vnd
FROM x LEFT JOIN fx_rates f ON f.currency = {_currency_sql("u")} AND f.fx_year = y"""

ORACLE = {
    "p6_found": _P6 + "SELECT DISTINCT id FROM w WHERE abs(answer_vnd - cell_vnd) > 0.01e0 * abs(cell_vnd)",
    "p6_answers_vnd": _P6 + """SELECT id, table_key, r AS row_index, c AS column_index, x AS cell_value, cell_vnd, answer_vnd, abs(answer_vnd - cell_vnd) > 0.01e0 * abs(cell_vnd) AS off FROM w""",
    "p6_cells_stated": _P6_CELLS,
    "p2_found": rf"""
WITH n AS (SELECT t.store_id, j.type AS ty, regexp_replace(regexp_replace(replace(replace(j.fullkey, '"', ''), '$', ''), {_LONE}), {_LONE}) AS p, j.fullkey AS k
  FROM table_store t, json_tree(t.payload) j WHERE json_valid(t.payload))
SELECT store_id, p[2:] AS path FROM n
WHERE ty <> 'NULL' AND regexp_matches(p, '\.({_NAMES})\[[0-9]+\]$')
  AND NOT (ty = 'ARRAY' AND regexp_matches(replace(k, '"', ''), '\.({_NAMES})$'))""",
    "p2_schema": r"""
WITH n AS (SELECT regexp_replace(replace(replace(j.fullkey, '"', ''), '$', ''), '\[[0-9]+\]', '', 'g') AS p, j.fullkey AS k, j.type AS ty FROM table_store t, json_tree(t.payload) j WHERE json_valid(t.payload))
SELECT p[2:] AS level, CASE WHEN ty = 'NULL' THEN 'null' WHEN ty IN ('ARRAY', 'OBJECT') THEN lower(ty) ELSE 'scalar' END AS kind, count(*) AS n FROM n WHERE p <> '' AND NOT k LIKE '%]' GROUP BY ALL""",
    "p2_rejected": """
WITH k AS (SELECT t.store_id, j.fullkey, count(*) AS n FROM table_store t, json_tree(t.payload) j WHERE json_valid(t.payload) GROUP BY ALL)
SELECT store_id, CASE WHEN payload IS NULL THEN 'missing' ELSE 'not_json' END AS reason FROM table_store WHERE payload IS NULL OR NOT json_valid(payload)
UNION ALL SELECT DISTINCT store_id, 'repeated_field' FROM k WHERE n > 1""",
    "p2_row_labels": _child_sql("row_labels", drop_value=True) + " UNION ALL " + "SELECT * FROM (" + _child_sql("sub_labels", drop_value=True) + ")",
    "p2_tables": _child_sql("tables"),
    "p2_columns": _child_sql("column_metadata"),
    "p2_period_labels": _child_sql("period_labels"),
    "p2_norm_columns": """
WITH e AS (SELECT record_id, table_key, unnest(column_metadata) AS m, generate_subscripts(column_metadata, 1) - 1 AS ordinal FROM norm_tables)
SELECT record_id, table_key AS parent_key, ordinal::INT AS ordinal, m.column_index, m.header_path, m.source_unit, m.scale_to_vnd FROM e WHERE m IS NOT NULL""",
    "p2_norm_column_periods": """
WITH e AS (SELECT record_id, table_key, unnest(column_metadata) AS m, generate_subscripts(column_metadata, 1) - 1 AS o FROM norm_tables),
p AS (SELECT record_id, table_key, o, unnest(m.period_labels) AS value, generate_subscripts(m.period_labels, 1) - 1 AS ordinal FROM e WHERE m IS NOT NULL)
SELECT record_id, table_key AS parent_key, o::INT AS column_metadata_ordinal, ordinal::INT AS ordinal, value FROM p WHERE value IS NOT NULL""",
    "p2_norm_period_labels": """
WITH e AS (SELECT record_id, table_key, unnest(period_labels) AS m, generate_subscripts(period_labels, 1) - 1 AS ordinal FROM norm_tables)
SELECT record_id, table_key AS parent_key, ordinal::INT AS ordinal, m.row_index, m.column_index, m.label FROM e WHERE m IS NOT NULL""",
    "p2_norm_row_labels": """
WITH e AS (SELECT record_id, table_key, unnest(row_labels) AS m, generate_subscripts(row_labels, 1) - 1 AS ordinal FROM norm_tables)
SELECT record_id, table_key AS parent_key, ordinal::INT AS ordinal, m.row_index, m.column_index, m.label FROM e WHERE m IS NOT NULL""",
    "p4_found": _P4_BASE + "SELECT line_id, reason FROM j WHERE reason IS NOT NULL",
    "p4_candidates": _P4_BASE
    + """SELECT line_id, c[1] AS report_id, c[2]::BIGINT AS line_position, try_cast(c[3] AS BIGINT) AS page, c[4] AS section_header, c[5] AS status,
 c[6]::BIGINT AS n_rows, c[7]::BIGINT AS n_cols, c[8] AS preceding_unit_declaration, json_extract_string(c[9], '$[*]') AS warnings, c[10] AS source_path
FROM j WHERE reason IS NULL AND feed = 'candidates'""",
    "p4_anomalies": _P4_BASE + "SELECT line_id, c[1] AS table_key, c[2] AS report_id, c[3]::BIGINT AS line_position, c[4] AS source_path, c[5] AS anomaly FROM j WHERE reason IS NULL AND feed = 'anomalies'",
}

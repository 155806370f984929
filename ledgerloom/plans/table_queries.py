"""Queries over extraction, normalization and cells, each with the SQL it must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import number
from ..operators import extract as X, normalize as N
from ..session import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_STRIP = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_NUM = r"regexp_full_match({}, '[\s\p{{Z}}()\-+.,%\p{{Nd}}]+')"
_PERIOD = r"20[0-9]{2}|31\s*[./-]\s*12|01\s*[./-]\s*01|số\s+(?:cuối|đầu)\s+(?:năm|kỳ)|năm\s+(?:nay|trước)"
_UNITS = X.UNIT_WORDS
_SCALE = """CASE WHEN {u} LIKE '%nghin ty%' THEN 1000000000000 WHEN {u} LIKE '%ty%' THEN 1000000000 WHEN {u} LIKE '%trieu%' THEN 1000000
 WHEN {u} LIKE '%nghin%' THEN 1000 WHEN {u} LIKE '%vnd%' OR {u} LIKE '%dong%' THEN 1 END"""
_FOLD = "replace(strip_accents(lower({})), 'đ', 'd')"


def scale_sql(c: str) -> str:
    return _SCALE.format(u=f"regexp_replace({_FOLD.format(c)}, '\\s+', ' ', 'g')")


_CELLS = f"""
rows_ AS (SELECT record_id, generate_subscripts(grid, 1) - 1 AS r, unnest(grid) AS row FROM norm_tables WHERE len(grid) > 0),
cells AS (SELECT record_id, r, generate_subscripts(row, 1) - 1 AS c, unnest(row) AS raw FROM rows_),
cs AS (SELECT record_id, r, c, raw, {_STRIP.format("raw")} AS t FROM cells)"""

# Report text made from the stored tables: page mark, heading, unit line, numbered line and the table.
HEADINGS = {"balance_sheet": "BẢNG CÂN ĐỐI KẾ TOÁN", "income_statement": "BÁO CÁO KẾT QUẢ KINH DOANH", "cash_flow": "BÁO CÁO LƯU CHUYỂN TIỀN TỆ", "notes": "Thuyết minh báo cáo"}


def report_texts(tables: DataFrame) -> DataFrame:
    """reports (report_id, source_path, content) that hold each stored table once, by line position and record."""
    heading = F.lit("Phụ lục")
    for k, v in HEADINGS.items():
        heading = F.when(F.col("section_header") == k, v).otherwise(heading)
    one_line = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"[\r\n]+", " ")
    safe = lambda c: F.replace(F.replace(F.replace(one_line(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    rows = F.transform(F.coalesce("grid", F.array().cast("array<array<string>>")), lambda r: F.concat(F.lit("<tr>"), F.array_join(F.transform(r, lambda c: F.concat(F.lit("<td>"), safe(c), F.lit("</td>"))), ""), F.lit("</tr>")))
    html = F.concat(F.lit("<table>"), F.array_join(rows, ""), F.lit("</table>"))
    page = F.concat(F.lit("===== PAGE "), F.coalesce("page", F.lit(0)).cast("string"), F.lit(" ====="))
    block = F.array_join(F.array_compact(F.array(page, heading, one_line(F.col("unit_declaration")).alias("u"), F.concat(F.lit("Mục "), F.col("record_id").cast("string")), html)), "\n")
    block = F.when(F.col("unit_declaration").isNull(), F.array_join(F.array(page, heading, F.concat(F.lit("Mục "), F.col("record_id").cast("string")), html), "\n")).otherwise(block)
    t = tables.select("report_id", "source_path", F.struct("line_position", "record_id", block.alias("b")).alias("s"))
    # A report is one file and bounded as such; its tables are what one text holds.
    return t.groupBy("report_id").agg(F.min("source_path").alias("source_path"), F.array_join(F.transform(F.sort_array(F.collect_list("s")), lambda s: s["b"]), "\n").alias("content"))


_BLOCKS = f"""
b AS (SELECT report_id, record_id, line_position, page, unit_declaration, section_header, grid,
   4 + (unit_declaration IS NOT NULL)::INT AS n FROM norm_tables),
p AS (SELECT *, sum(n) OVER w AS line_no,
   last_value(CASE WHEN section_header IN ('balance_sheet', 'income_statement', 'cash_flow', 'notes') THEN section_header END IGNORE NULLS) OVER w AS sec,
   last_value(CASE WHEN regexp_matches(unit_declaration, '(?i){X.UNIT_DECLARATION}') THEN {_STRIP.format("unit_declaration")} END IGNORE NULLS) OVER w AS unit
  FROM b WINDOW w AS (PARTITION BY report_id ORDER BY line_position, record_id ROWS UNBOUNDED PRECEDING))"""


@query(f"""WITH {_BLOCKS}
SELECT report_id, line_no::INT AS line_position, coalesce(page, 0) AS page, coalesce(sec, 'unclassified') AS section_header, unit AS preceding_unit_declaration,
  CASE WHEN unit_declaration IS NULL THEN 2 ELSE 3 END AS n_captions, 'Mục ' || record_id AS last_caption FROM p""")
def x_line_state(spark: SparkSession, sf: str) -> DataFrame:
    c = X.candidates(report_texts(table(spark, sf, "norm_tables")))
    return c.select("report_id", "line_position", "page", "section_header", "preceding_unit_declaration", F.size("caption_context").alias("n_captions"), F.element_at("caption_context", -1).alias("last_caption"))


@query(f"""WITH {_BLOCKS}
SELECT report_id, line_no::INT AS line_position, CASE WHEN len(grid) > 0 THEN 'success' ELSE 'failed' END AS status, coalesce(len(grid), 0)::INT AS n_rows,
  coalesce(list_max(list_transform(grid, lambda r: len(r))), 0)::INT AS n_cols,
  coalesce(list_transform(grid, lambda r: list_transform(r, lambda c: {_STRIP.format("regexp_replace(coalesce(c, ''), '[\\r\\n]+', ' ', 'g')")})), []) AS grid FROM p""")
def x_table_grids(spark: SparkSession, sf: str) -> DataFrame:
    return X.candidates(report_texts(table(spark, sf, "norm_tables"))).select("report_id", "line_position", "status", "n_rows", "n_cols", "grid")


@query("""SELECT record_id, 'n_rows>200:' || n_rows AS anomaly FROM norm_tables WHERE n_rows > 200
UNION ALL SELECT record_id, 'n_cols>50:' || n_cols FROM norm_tables WHERE n_cols > 50""")
def x_shape_flags(spark: SparkSession, sf: str) -> DataFrame:
    return X.shape_flags(table(spark, sf, "norm_tables"), "record_id")


@query("""SELECT record_id, 'n_rows>12:' || n_rows AS anomaly FROM norm_tables WHERE n_rows > 12
UNION ALL SELECT record_id, 'n_cols>6:' || n_cols FROM norm_tables WHERE n_cols > 6""")
def x_shape_flags_low(spark: SparkSession, sf: str) -> DataFrame:
    """Bounds that small tables exceed too."""
    return X.shape_flags(table(spark, sf, "norm_tables"), "record_id", most_rows=12, most_cols=6)


def _marked_up(grid):
    """A table written carelessly: a title over all columns, a first column over all rows, cells and rows left open, a cell behind the last row."""
    safe = lambda c: F.regexp_replace(F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), r"[\r\n]+", " ")
    width = F.aggregate(grid, F.lit(0), lambda m, r: F.greatest(m, F.size(r)))
    side = F.concat(F.lit("<TD rowspan='"), F.size(grid).cast("string"), F.lit("'>side</TD>"))
    row = lambda r, i: F.concat(F.lit("<tr>"), F.when(i == 0, side).otherwise(""), F.array_join(F.transform(r, lambda c: F.concat(F.lit("<td class=x>"), safe(c))), ""), F.when(i % 2 == 0, F.lit("</tr>")).otherwise(""))
    return F.concat(F.lit("<table><tr><th colspan=\""), (width + 1).cast("string"), F.lit("\">T &amp; <b>title</b></th></tr>"), F.array_join(F.transform(grid, row), ""), F.lit("</tr><td>last</td></table>"))


@query(f"""WITH g AS (SELECT record_id, list_transform(grid, lambda r: list_transform(r, lambda c: {_STRIP.format("regexp_replace(coalesce(c, ''), '[\\r\\n]+', ' ', 'g')")})) AS b, list_max(list_transform(grid, lambda r: len(r))) AS w
  FROM norm_tables WHERE len(grid) > 0 AND len(list_filter(grid, lambda r: len(r) = 0)) = 0)
SELECT record_id, 'parsed_with_warnings' AS status, (len(b) + 2)::INT AS n_rows, (w + 1)::INT AS n_cols,
 [list_transform(range(w + 1), lambda i: 'T & title')] || list_transform(b, lambda r: ['side'] || r || list_transform(range(w - len(r)), lambda i: '')) || [['last'] || list_transform(range(w), lambda i: '')] AS grid FROM g""")
def x_markup(spark: SparkSession, sf: str) -> DataFrame:
    """Careless markup with spans is read back as the grid it was made from."""
    t = table(spark, sf, "norm_tables", widen=True).filter((F.size("grid") > 0) & ~F.exists("grid", lambda r: F.size(r) == 0))
    return X.parsed_grids(t.select("record_id", _marked_up(F.col("grid")).alias("text"))).select("record_id", "status", "n_rows", "n_cols", "grid")


@query(rf"""WITH l AS (SELECT doc_id::VARCHAR AS report_id, unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS raw FROM documents),
t AS (SELECT report_id, {_STRIP.format("raw")} AS text FROM l)
SELECT report_id, count(*) AS n_lines, sum(length(text))::BIGINT AS n_chars, count(*) FILTER (regexp_full_match(text, '===== PAGE ([0-9]+) =====')) AS n_pages,
 count(*) FILTER (text LIKE '%<table>%') AS n_table_lines, count(*) FILTER (regexp_full_match(text, '-{{5,}}|={{5,}}|_{{5,}}|\.{{5,}}|\*{{5,}}|~{{5,}}')) AS n_noise_lines,
 count(*) FILTER (text LIKE '%<table>%' AND text NOT LIKE '%</table>%') AS n_open_tables FROM t GROUP BY 1""")
def x_file_stats(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("report_id"), F.lit("").alias("source_path"), F.col("text").alias("content"))
    return X.file_stats(docs)


@query("""SELECT DISTINCT report_id, split_part(report_id, '_', 1) AS ticker, try_cast(regexp_extract(report_id, '(20[0-9]{2})', 1) AS INT) AS year,
 CASE WHEN lower(report_id) LIKE '%consolidated%' THEN 'consolidated' WHEN lower(report_id) LIKE '%separate%' THEN 'separate' WHEN lower(report_id) LIKE '%aggregated%' THEN 'aggregated'
  WHEN lower(report_id) LIKE '%explanation%' OR lower(report_id) LIKE '%explanatory%' THEN 'explanatory' ELSE 'unspecified' END AS variant,
 try_cast(regexp_extract(report_id, '_([0-9]{1,2})$', 1) AS INT) AS part FROM norm_tables""")
def n_report_parts(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "norm_tables").select("report_id").distinct()
    return t.withColumns(N.report_parts(F.col("report_id")))


@query(f"WITH u AS (SELECT record_id, regexp_extract_all(coalesce(searchable_text, ''), '(?i)({_UNITS})', 1) AS l FROM norm_tables) SELECT record_id, list_filter(l, lambda x, i: list_position(l, x) = i) AS units FROM u")
def n_units(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "norm_tables").select("record_id", N.units_in(F.col("searchable_text")).alias("units"))


@query(f"SELECT DISTINCT expected_unit, {scale_sql('expected_unit')}::BIGINT AS scale FROM dev_answers")
def n_unit_scale(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "dev_answers").select("expected_unit").distinct().withColumn("scale", N.unit_scale(F.col("expected_unit")))


@query(f"WITH {_CELLS} SELECT record_id, r::INT AS row_index, c::INT AS column_index, t AS label FROM cs WHERE r < 6 AND t <> '' AND regexp_matches(t, '(?i){_PERIOD}')")
def n_period_labels(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "norm_tables")
    return t.filter(F.size("grid") > 0).select("record_id", F.explode(N.period_labels(F.col("grid"))).alias("l")).select("record_id", "l.*")


@query(f"""WITH {_CELLS} SELECT record_id, r::INT AS row_index, min(c)::INT AS column_index, arg_min(t, c) AS label FROM cs WHERE t <> '' AND NOT {_NUM.format("t")} GROUP BY record_id, r""")
def n_row_labels(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "norm_tables")
    return t.filter(F.size("grid") > 0).select("record_id", F.explode(N.row_labels(F.col("grid"))).alias("l")).select("record_id", "l.*")


@query(f"""WITH {_CELLS},
h AS (SELECT record_id, c, t, min(r) AS r FROM cs WHERE r < 6 AND t <> '' AND NOT {_NUM.format("t")} GROUP BY ALL),
p AS (SELECT record_id, c, string_agg(t, ' | ' ORDER BY r) AS path FROM h GROUP BY ALL),
a AS (SELECT DISTINCT record_id, c FROM cs),
u AS (SELECT a.record_id, a.c, coalesce(p.path, '') AS path, coalesce(regexp_extract_all(coalesce(p.path, ''), '(?i)({_UNITS})', 1)[1],
   regexp_extract_all(coalesce(n.unit_declaration, ''), '(?i)({_UNITS})', 1)[1]) AS unit
  FROM a LEFT JOIN p USING (record_id, c) JOIN norm_tables n USING (record_id))
SELECT record_id, c::INT AS column_index, path AS header_path, unit AS source_unit, {scale_sql("unit")}::BIGINT AS scale_to_vnd FROM u""")
def n_column_metadata(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "norm_tables").filter(F.size("grid") > 0)
    cols = N.column_metadata(F.col("grid"), F.col("unit_declaration"))
    return t.select("record_id", F.explode(cols).alias("m")).select("record_id", "m.column_index", "m.header_path", "m.source_unit", "m.scale_to_vnd")


@query(f"""WITH {_CELLS},
g AS (SELECT record_id, r, count(*) FILTER (t <> '') AS filled, count(*) FILTER (t <> '' AND {_NUM.format("t")}) AS nums FROM cs WHERE r < 6 GROUP BY ALL)
SELECT record_id, coalesce(min(r) FILTER (filled = 0 OR nums > 0), max(r) + 1)::INT AS header_depth FROM g GROUP BY 1""")
def n_header_depth(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "norm_tables").filter(F.size("grid") > 0).select("record_id", N.header_depth(F.col("grid")).alias("header_depth"))


@query("SELECT record_id, left(sha256(to_json(grid)::VARCHAR), 16) AS content_hash FROM norm_tables WHERE grid IS NOT NULL")
def n_content_hash(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "norm_tables").filter("grid is not null").select("record_id", N.content_hash(F.col("grid")).alias("content_hash"))


@query(r"""SELECT record_id, nullif(regexp_extract(coalesce(searchable_text, ''), '(?i)(\busd\b|us\$|\beur\b|\bjpy\b|\bcny\b|\bsgd\b)', 1), '') AS currency_hint FROM norm_tables""")
def n_currency_hint(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "norm_tables").select("record_id", N.currency_hint(F.col("searchable_text")).alias("currency_hint"))


@query(f"""WITH {_CELLS} SELECT n.record_id, coalesce(string_agg(t, ' ' ORDER BY r, c) FILTER (t <> ''), '') AS searchable_text FROM norm_tables n LEFT JOIN cs USING (record_id) GROUP BY 1""")
def n_searchable_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "norm_tables").select("record_id", N.cell_text(F.coalesce("grid", F.array().cast("array<array<string>>"))).alias("searchable_text"))


_KEPT = "list_filter({0}, lambda x, i: list_position({0}, x) = i)"
_SHORT = "CASE WHEN length({0}) > 200 THEN left({0}, 199) || '…' ELSE {0} END"


def _part(name: str, c: str, most: int) -> str:
    short = f"list_transform(({c})[1:{most}], lambda x: {_SHORT.format('x')})"
    return f"CASE WHEN len({c}) > 0 THEN '{name} ' || array_to_string({short}, ' | ') || '.' END"


@query(f"""WITH {_CELLS},
pl AS (SELECT record_id, list(t ORDER BY r, c) AS l FROM cs WHERE r < 6 AND t <> '' AND regexp_matches(t, '(?i){_PERIOD}') GROUP BY 1),
rl AS (SELECT record_id, list(t ORDER BY r) AS l FROM (SELECT record_id, r, arg_min(t, c) AS t FROM cs WHERE t <> '' AND NOT {_NUM.format("t")} GROUP BY ALL) GROUP BY 1),
h AS (SELECT record_id, c, t, min(r) AS r FROM cs WHERE r < 6 AND t <> '' AND NOT {_NUM.format("t")} GROUP BY ALL),
cl AS (SELECT record_id, list(path ORDER BY c) AS l FROM (SELECT record_id, c, string_agg(t, ' | ' ORDER BY r) AS path FROM h GROUP BY ALL) GROUP BY 1),
st AS (SELECT record_id, string_agg(t, ' ' ORDER BY r, c) AS s FROM cs WHERE t <> '' GROUP BY 1),
u AS (SELECT n.record_id, regexp_extract_all(concat_ws(' ', coalesce(s, ''), array_to_string(list_filter(caption_context, lambda x: x IS NOT NULL), ' ')), '(?i)({_UNITS})', 1) AS own, regexp_extract_all(coalesce(unit_declaration, ''), '(?i)({_UNITS})', 1) AS said FROM norm_tables n LEFT JOIN st USING (record_id)),
d AS (SELECT record_id, CASE WHEN len(own) > 0 THEN {_KEPT.format("own")} ELSE {_KEPT.format("said")} END AS units FROM u),
p AS (SELECT DISTINCT report_id, split_part(report_id, '_', 1) AS ticker, try_cast(regexp_extract(report_id, '(20[0-9]{{2}})', 1) AS INT) AS year, CASE WHEN lower(report_id) LIKE '%consolidated%' THEN 'consolidated' WHEN lower(report_id) LIKE '%separate%' THEN 'separate'
  WHEN lower(report_id) LIKE '%aggregated%' THEN 'aggregated' WHEN lower(report_id) LIKE '%explanation%' OR lower(report_id) LIKE '%explanatory%' THEN 'explanatory' ELSE 'unspecified' END AS variant FROM norm_tables)
SELECT n.record_id, d.units AS detected_units, array_to_string(list_filter(coalesce(n.caption_context, []) || [n.section_header], lambda x: x IS NOT NULL), ' | ') AS table_identity,
 concat_ws(' ', 'TICKER ' || p.ticker || '.', CASE WHEN c.name <> '' THEN 'COMPANY ' || c.name || '.' END, 'YEAR ' || p.year || '.', CASE WHEN p.variant <> 'unspecified' THEN 'VARIANT ' || p.variant || '.' END,
  CASE WHEN n.section_header NOT IN ('', 'unclassified') THEN 'SECTION ' || n.section_header || '.' END,
  CASE WHEN len(n.caption_context) > 0 THEN 'CAPTION ' || array_to_string(list_transform(n.caption_context, lambda x: {_SHORT.format("x")}), ' | ') || '.' END,
  CASE WHEN len(d.units) > 0 THEN 'UNIT ' || array_to_string(d.units, ', ') || '.' END, {_part("PERIODS", _KEPT.format("pl.l"), N.MAX_PERIODS)}, {_part("COLUMNS", _KEPT.format("cl.l"), N.MAX_HEADERS)}, {_part("ROWS", _KEPT.format("rl.l"), N.MAX_LABELS)}) AS retrieval_text
FROM norm_tables n JOIN p USING (report_id) JOIN d USING (record_id) LEFT JOIN companies c ON c.ticker = p.ticker LEFT JOIN pl USING (record_id) LEFT JOIN cl USING (record_id) LEFT JOIN rl USING (record_id)""")
def n_retrieval_text(spark: SparkSession, sf: str) -> DataFrame:
    """Normalization of the stored candidates: units, identity and the labelled text."""
    t = table(spark, sf, "norm_tables").select("record_id", "report_id", "line_position", "section_header", "caption_context", F.col("unit_declaration").alias("preceding_unit_declaration"), "grid")
    return N.normalize(t, table(spark, sf, "companies")).select("record_id", "detected_units", "table_identity", "retrieval_text")


_HEADING = "CASE section_header " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in HEADINGS.items()) + " ELSE 'Phụ lục' END"
_LINE = "regexp_replace({}, '[\\r\\n]+', ' ', 'g')"


@query(f"""WITH {_BLOCKS},
nt AS (SELECT record_id, report_id, line_no, coalesce(sec, 'unclassified') AS section_header, unit AS unit_declaration, [{_HEADING}] || CASE WHEN unit_declaration IS NULL THEN [] ELSE [{_STRIP.format(_LINE.format("unit_declaration"))}] END || ['Mục ' || record_id] AS caption_context,
   coalesce(list_transform(grid, lambda r: list_transform(r, lambda c: {_STRIP.format(_LINE.format("coalesce(c, '')"))})), []) AS grid FROM p),
base AS ({ORACLE["n_retrieval_text"].replace("norm_tables", "nt")}), {_CELLS.replace("norm_tables", "nt")},
hd AS (SELECT record_id, r, count(*) FILTER (t <> '') AS filled, count(*) FILTER (t <> '' AND {_NUM.format("t")}) AS nums FROM cs WHERE r < 6 GROUP BY ALL),
dp AS (SELECT record_id, coalesce(min(r) FILTER (filled = 0 OR nums > 0), max(r) + 1)::INT AS header_depth FROM hd GROUP BY 1)
SELECT report_id || '|' || line_no::INT AS table_key, split_part(report_id, '_', 1) AS ticker, try_cast(regexp_extract(report_id, '(20[0-9]{{2}})', 1) AS INT) AS year,
 CASE WHEN lower(report_id) LIKE '%consolidated%' THEN 'consolidated' WHEN lower(report_id) LIKE '%separate%' THEN 'separate' WHEN lower(report_id) LIKE '%aggregated%' THEN 'aggregated'
  WHEN lower(report_id) LIKE '%explanation%' OR lower(report_id) LIKE '%explanatory%' THEN 'explanatory' ELSE 'unspecified' END AS variant, try_cast(regexp_extract(report_id, '_([0-9]{{1,2}})$', 1) AS INT) AS part,
 detected_units, table_identity, coalesce(header_depth, 0) AS header_depth, left(sha256(to_json(grid)::VARCHAR), 16) AS content_hash, retrieval_text
FROM nt JOIN base USING (record_id) LEFT JOIN dp USING (record_id)""")
def n_normalized(spark: SparkSession, sf: str) -> DataFrame:
    c = X.candidates(report_texts(table(spark, sf, "norm_tables")))
    return N.normalize(c, table(spark, sf, "companies")).select("table_key", "ticker", "year", "variant", "part", "detected_units", "table_identity", "header_depth", "content_hash", "retrieval_text")


@query("""SELECT count(*) AS n_tables, count(DISTINCT report_id) AS n_reports, count(*) FILTER (status = 'parsed_with_warnings') AS n_warned, count(*) FILTER (status = 'failed') AS n_failed,
 count(*) FILTER (n_rows > 200) AS n_long, count(*) FILTER (n_cols > 50) AS n_wide FROM norm_tables""")
def n_catalog_summary(spark: SparkSession, sf: str) -> DataFrame:
    return N.catalog_summary(table(spark, sf, "norm_tables"))


@query("""SELECT record_id, n.table_key, n.report_id FROM norm_tables n WHERE table_key IN (SELECT table_key FROM dev_answers)""")
def n_store_lookup(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "norm_tables").select("record_id", "table_key", "report_id")
    keys = table(spark, sf, "dev_answers").filter("table_key is not null").select("table_key").distinct()
    return t.join(keys, "table_key", "left_semi").select("record_id", "table_key", "report_id")


def number_sql(c: str) -> str:
    s = f"regexp_replace({c}, '^ +| +$', '', 'g')"
    body = f"regexp_replace({c}, '[^0-9,.-]', '', 'g')"
    plain = rf"""CASE WHEN regexp_full_match({body}, '-?[0-9]{{1,3}}(\.[0-9]{{3}})+|-?[0-9]{{1,3}}(,[0-9]{{3}})+') THEN replace(replace({body}, '.', ''), ',', '')
 WHEN {body} LIKE '%.%' AND {body} LIKE '%,%' AND strpos(reverse({body}), ',') < strpos(reverse({body}), '.') THEN replace(replace({body}, '.', ''), ',', '.')
 WHEN {body} LIKE '%.%' AND {body} LIKE '%,%' THEN replace({body}, ',', '') ELSE replace({body}, ',', '.') END"""
    value = rf"CASE WHEN regexp_full_match({plain}, '-?([0-9]+\.?[0-9]*|\.[0-9]+)') THEN try_cast({plain} AS DOUBLE) END"
    return f"CASE WHEN {s} IN ('', '-', '–', '—') THEN NULL WHEN {s} LIKE '(%)' THEN -abs({value}) ELSE {value} END"


@query(f"""WITH {_CELLS}, d AS (SELECT DISTINCT replace(raw, chr(160), ' ') AS v, raw FROM cs) SELECT raw AS cell, {number_sql("v")} AS value FROM d""")
def n_numbers(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "norm_tables").select(F.explode(F.flatten("grid")).alias("cell")).distinct()
    return c.select("cell", number(F.col("cell")).alias("value"))

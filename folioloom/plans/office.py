"""Queries over office files: blocks are written as packages and read again, so that every reader meets all of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.operators import office_list as O
from folioloom.operators.tables import cells
from folioloom.runtime import read
from folioloom.sources.office import office_blocks
from folioloom.sources.office_writer import packages

#: What office texts of the queries hold: plain characters, as XML readers turn others into blanks or drop them.
_PLAIN = "[^\\t\\n\\x20-\\x{D7FF}\\x{E000}-\\x{FFFD}\\x{10000}-\\x{10FFFF}]"


def _blocks(spark: SparkSession, root: str, kinds: tuple[str, ...]) -> DataFrame:
    b = read(spark, root, "blocks", "block_id", "doc_id", "type", "content", "html", "title_level").where(F.col("type").isin(*kinds) & F.col("doc_id").isNotNull())
    text = F.trim(F.regexp_replace(F.regexp_replace("content", _PLAIN, ""), r"\s+", " "))
    return b.select("doc_id", "block_id", "type", text.alias("text"), F.coalesce("title_level", F.lit(1)).alias("level"), "html").where("type = 'table' OR text <> ''")


def _texts(spark: SparkSession, root: str, kind: str, kinds: tuple[str, ...] = ("title", "text", "list")) -> DataFrame:
    return office_blocks(packages(_blocks(spark, root, kinds), "doc_id", ["block_id"], kind), "doc_id", "content")


def q_office_docx(spark: SparkSession, root: str) -> DataFrame:
    """Texts, headings and lists of each file, written as a text document and read again."""
    return _texts(spark, root, "docx").select("doc_id", "block_no", "type", "level", "text")


def q_office_pptx(spark: SparkSession, root: str) -> DataFrame:
    """Texts and headings of each file as slides."""
    return _texts(spark, root, "pptx", ("title", "text")).select("doc_id", "page_idx", "block_no", "type", "text")


def q_office_tables(spark: SparkSession, root: str) -> DataFrame:
    """Tables of each file, written into text documents and read again, in their cells."""
    b = _blocks(spark, root, ("table",)).where("html LIKE '<table>%</table>'")
    t = office_blocks(packages(b, "block_id", ["doc_id"], "docx"), "block_id", "content").where("type = 'table'")
    return cells(t, "block_id", "html").select("block_id", "row_no", "cell_no", "col_no", "colspan", "rowspan", "text")


def q_office_sheets(spark: SparkSession, root: str) -> DataFrame:
    """Tables without spans as sheets of workbooks, in their cells."""
    b = _blocks(spark, root, ("table",)).where("html LIKE '<table>%</table>' AND html NOT LIKE '%span=%'")
    t = office_blocks(packages(b, "block_id", ["doc_id"], "xlsx"), "block_id", "content").where("type = 'table'")
    return cells(t, "block_id", "html").select("block_id", "row_no", "cell_no", "text")


def q_office_content(spark: SparkSession, root: str) -> DataFrame:
    """The flat content list of text documents."""
    return O.content_list(O.entries(_texts(spark, root, "docx"), "doc_id"), "doc_id").select("doc_id", "block_no", "type", "text", "text_level", "list_items")


def q_office_pages(spark: SparkSession, root: str) -> DataFrame:
    """The content list of slides per page, as JSON."""
    return O.page_content(O.entries(_texts(spark, root, "pptx", ("title", "text")), "doc_id"), "doc_id")


def q_office_markdown(spark: SparkSession, root: str) -> DataFrame:
    """Text documents as Markdown."""
    return O.document_markdown(O.entries(_texts(spark, root, "docx"), "doc_id"), "doc_id")


QUERIES = {f.__name__: f for f in (q_office_docx, q_office_pptx, q_office_tables, q_office_sheets, q_office_content, q_office_pages, q_office_markdown)}

_T = r"trim(regexp_replace(regexp_replace(content, '[^\t\n\x20-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]', '', 'g'), '\s+', ' ', 'g'), ' ')"
_ESC = r"""coalesce(array_to_string(list_transform(regexp_extract_all(t, '(?s)\\.|[*_`~$]|[^\\*_`~$]+|\\'), lambda x: CASE WHEN x IN ('*', '_', '`', '~', '$') THEN '\' || x ELSE x END), ''), '')"""
_PRE = rf"regexp_replace({_ESC}, '^([ \t]{{0,3}})(#{{1,6}}|[+-])([ \t])', '\1\\\2\3')"


def _own(kinds: str) -> str:
    return f"""b AS (SELECT doc_id, block_id, type, least(9, greatest(1, coalesce(title_level, 1))) AS level, {_T} AS t FROM blocks WHERE type IN ({kinds}) AND doc_id IS NOT NULL),
    o AS (SELECT *, (row_number() OVER (PARTITION BY doc_id ORDER BY block_id) - 1)::INT AS n FROM b WHERE t <> '')"""


_ENTRIES = f"""{_own("'title', 'text', 'list'")},
    g AS (SELECT *, CASE WHEN type = 'list' AND lag(type) OVER (PARTITION BY doc_id ORDER BY n) = 'list' THEN 0 ELSE 1 END AS fresh FROM o),
    k AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY n) AS entry FROM g),
    r AS (SELECT *, level - min(level) OVER (PARTITION BY doc_id, entry) AS deep FROM k),
    e AS (SELECT doc_id, min(n) AS n, any_value(type) AS type, any_value(level) AS level, any_value(t) AS t, CASE WHEN any_value(type) = 'list' THEN list(repeat('    ', deep) || '- ' || {_ESC} ORDER BY n) END AS items FROM r GROUP BY doc_id, entry)"""
_CELLS = r"""t AS (SELECT block_id, regexp_extract_all(html, '(?is)<tr[^>]*>(.*?)</tr>', 1) AS tr FROM blocks WHERE type = 'table' AND doc_id IS NOT NULL AND html LIKE '<table>%</table>'),
    r AS (SELECT block_id, unnest(tr) AS inside, generate_subscripts(tr, 1) - 1 AS row_no FROM t),
    c AS (SELECT block_id, row_no, unnest(regexp_extract_all(inside, '(?is)<t[dh][^>]*>.*?</t[dh]>')) AS cell, generate_subscripts(regexp_extract_all(inside, '(?is)<t[dh][^>]*>.*?</t[dh]>'), 1) - 1 AS cell_no FROM r),
    f AS (SELECT block_id, row_no::INT AS row_no, cell_no::INT AS cell_no, coalesce(nullif(regexp_extract(cell, '^<[^>]*colspan="([0-9]+)"', 1), '')::INT, 1) AS colspan, coalesce(nullif(regexp_extract(cell, '^<[^>]*rowspan="([0-9]+)"', 1), '')::INT, 1) AS rowspan,
        trim(replace(replace(replace(replace(replace(regexp_replace(cell, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&')) AS text FROM c)"""

SQL = {
    "q_office_docx": f"WITH {_own(chr(39) + 'title' + chr(39) + ', ' + chr(39) + 'text' + chr(39) + ', ' + chr(39) + 'list' + chr(39))} SELECT doc_id, n AS block_no, type, CASE WHEN type = 'title' THEN level END AS level, t AS text FROM o",
    "q_office_pptx": f"""WITH {_own("'title', 'text'")}, s AS (SELECT *, sum(CASE WHEN type = 'title' OR n = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) - 1 AS p FROM o) SELECT doc_id, p::INT AS page_idx, n AS block_no, type, t AS text FROM s""",
    "q_office_tables": f"""WITH {_CELLS} SELECT block_id, row_no, cell_no, (sum(colspan) OVER (PARTITION BY block_id, row_no ORDER BY cell_no) - colspan + (EXISTS (SELECT 1 FROM f g WHERE g.block_id = f.block_id AND g.cell_no = 0 AND g.row_no < f.row_no AND g.row_no + g.rowspan > f.row_no))::INT)::INT AS col_no, colspan, rowspan, text FROM f""",
    "q_office_sheets": f"""WITH {_CELLS} SELECT block_id, row_no, cell_no, text FROM f WHERE block_id IN (SELECT block_id FROM blocks WHERE html NOT LIKE '%span=%')""",
    "q_office_content": f"""WITH {_ENTRIES} SELECT doc_id, n AS block_no, CASE WHEN type = 'title' THEN 'text' ELSE type END AS type, CASE WHEN type <> 'list' THEN {_PRE} END AS text, CASE WHEN type = 'title' THEN level END AS text_level, items AS list_items FROM e""",
    "q_office_pages": f"""WITH {_own("'title', 'text'")}, s AS (SELECT *, sum(CASE WHEN type = 'title' OR n = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) - 1 AS p FROM o)
        SELECT doc_id, p::INT AS page_idx, '[' || string_agg(CASE WHEN type = 'title' THEN '{{"type":"title","content":{{"title_content":[{{"type":"text","content":' || to_json(t) || '}}],"level":1}}}}' ELSE '{{"type":"paragraph","content":{{"paragraph_content":[{{"type":"text","content":' || to_json(t) || '}}]}}}}' END, ',' ORDER BY n) || ']' AS items FROM s GROUP BY ALL""",
    "q_office_markdown": f"""WITH {_ENTRIES} SELECT doc_id, string_agg(CASE WHEN type = 'title' THEN repeat('#', least(level, 6)) || ' ' || {_ESC} WHEN type = 'list' THEN array_to_string(items, chr(10)) ELSE {_PRE} END, chr(10) || chr(10) ORDER BY n) AS markdown FROM e GROUP BY doc_id""",
}

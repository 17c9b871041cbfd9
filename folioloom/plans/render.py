"""Queries that write blocks out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.functions import text as X
from folioloom.operators import render as D
from folioloom.operators.shred import flatten
from folioloom.plans.nested import SQL as SHREDDED
from folioloom.runtime import read, spread

PAGE = ["doc_id", "page_idx"]


def _blocks(spark: SparkSession, root: str) -> DataFrame:
    b = read(spark, root, "blocks", "block_id", *PAGE, "block_index", "type", "title_level", "content", "html", "bbox", "parent_index")
    return D.with_children(b.where("type IS NOT NULL"), PAGE)


def q_block_markdown(spark: SparkSession, root: str) -> DataFrame:
    """Each body block as Markdown."""
    return D.markdown(_blocks(spark, root).where(~F.col("type").isin(*D.DISCARDED))).select("block_id", "md")


def q_markdown(spark: SparkSession, root: str) -> DataFrame:
    """Each file as one Markdown text."""
    r = D.markdown(_blocks(spark, root).where(~F.col("type").isin(*D.DISCARDED)))
    return D.document_markdown(r, ["doc_id"], ["page_idx", "block_id"])


def q_text_markdown(spark: SparkSession, root: str) -> DataFrame:
    """Files as Markdown without tables and images."""
    r = D.markdown(_blocks(spark, root).where(~F.col("type").isin(*D.DISCARDED)), visuals=False)
    return D.document_markdown(r, ["doc_id"], ["page_idx", "block_id"])


def _items(spark: SparkSession, root: str) -> DataFrame:
    size = read(spark, root, "doc_pages", *PAGE, "width", "height").groupBy(*PAGE).agg(F.max("width").alias("width"), F.max("height").alias("height"))
    return D.content_list(_blocks(spark, root).join(size, PAGE, "left"))


def q_content_list(spark: SparkSession, root: str) -> DataFrame:
    """The flat list of all blocks."""
    return _items(spark, root).select("block_id", "page_idx", F.col("item_type").alias("type"), F.col("item_text").alias("text"), "text_level", "text_format", "list_items", "captions", "footnotes", "table_body", "code_body", F.col("item_bbox").alias("bbox"))


def q_content_pages(spark: SparkSession, root: str) -> DataFrame:
    """The list per page as JSON."""
    return D.page_lists(_items(spark, root), ["doc_id"], "page_idx", ["block_id"])


def q_styled_spans(spark: SparkSession, root: str) -> DataFrame:
    """Spans of the parse records with styles, in Markdown and HTML; styles are given by the length of their text."""
    s = flatten(spread(read(spark, root, "middle_json", "rec_id", "payload")), "span").where("type = 'text' AND content IS NOT NULL")
    n = F.length("content") % 5
    styles = F.when(n == 0, F.array(F.lit("bold"))).when(n == 1, F.array(F.lit("bold"), F.lit("italic"))).when(n == 2, F.array(F.lit("strikethrough"))).when(n == 3, F.array(F.lit("underline"), F.lit("italic"))).otherwise(F.array().cast("array<string>"))
    return s.select("rec_id", "page_no", "block_list", "block_path", "line_no", "span_no", D.styled(F.col("content"), styles, False).alias("md"), D.styled(F.col("content"), styles, True).alias("html"))


def q_list_items(spark: SparkSession, root: str) -> DataFrame:
    """Titles of files as a nested list."""
    b = read(spark, root, "blocks", "block_id", "doc_id", "type", "content", "title_level").where("type = 'title' AND content IS NOT NULL")
    items = b.select("doc_id", "block_id", (F.coalesce("title_level", F.lit(2)) - 1).alias("ilevel"), (F.coalesce("title_level", F.lit(2)) % 2 == 0).alias("ordered"), F.lit(None).cast("int").alias("start"), F.col("content").alias("text"))
    return D.flatten_items(items, ["doc_id"], ["block_id"]).select("block_id", "line")


QUERIES = {f.__name__: f for f in (q_block_markdown, q_markdown, q_text_markdown, q_content_list, q_content_pages, q_styled_spans, q_list_items)}

_ALNUM = f"trim(translate(coalesce(content, ''), '{X.WIDE_ALNUM}', '{X.NARROW_ALNUM}'), ' ')"
_ESC = r"""coalesce(array_to_string(list_transform(regexp_extract_all({}, '(?s)\\.|[*_`~$]|[^\\*_`~$]+|\\'), lambda x: CASE WHEN x IN ('*', '_', '`', '~', '$') THEN '\' || x ELSE x END), ''), '')"""
_PREFIX = r"regexp_replace({}, '^([ \t]{{0,3}})(#{{1,6}}|[+-])([ \t])', '\1\\\2\3')"
_KIDS = f"""b AS (SELECT *, {_ALNUM} AS t FROM blocks WHERE type IS NOT NULL),
    kid AS (SELECT b.* FROM b WHERE type IN ('image_caption', 'table_caption', 'image_footnote', 'table_footnote', 'chart_caption', 'chart_footnote') AND parent_index IS NOT NULL AND trim(content, ' ') <> ''
        AND EXISTS (SELECT 1 FROM b p WHERE p.type IN ('image', 'table', 'chart') AND p.doc_id = b.doc_id AND p.page_idx = b.page_idx AND p.block_index = b.parent_index)),
    c AS (SELECT doc_id, page_idx, parent_index AS block_index, list(t ORDER BY block_id) FILTER (NOT suffix(type, 'footnote')) AS captions, list(t ORDER BY block_id) FILTER (suffix(type, 'footnote')) AS footnotes FROM kid GROUP BY ALL),
    k AS (SELECT b.* REPLACE (CASE WHEN b.type IN ('image_caption', 'table_caption', 'image_footnote', 'table_footnote', 'chart_caption', 'chart_footnote') THEN 'text' ELSE b.type END AS type),
        CASE WHEN b.type IN ('image', 'table', 'chart') THEN coalesce(captions, []) ELSE [] END AS captions, CASE WHEN b.type IN ('image', 'table', 'chart') THEN coalesce(footnotes, []) ELSE [] END AS footnotes
        FROM b LEFT JOIN c USING (doc_id, page_idx, block_index) WHERE block_id NOT IN (SELECT block_id FROM kid))"""
_ET, _EP = _ESC.format("t"), _PREFIX.format(_ESC.format("t"))
_FENCE = r"trim(regexp_replace(regexp_replace(trim(content, ' '), '^```[^\n]*\n?', ''), '\n?```$', ''), ' ')"
_MD = f"""m AS (SELECT *, nullif(CASE type
    WHEN 'title' THEN CASE WHEN t <> '' THEN CASE WHEN coalesce(title_level, 1) > 0 THEN repeat('#', least(coalesce(title_level, 1), 6)) || ' ' ELSE '' END || {_ET} END
    WHEN 'interline_equation' THEN CASE WHEN t <> '' THEN '$$' || chr(10) || trim(content, ' ') || chr(10) || '$$' END
    WHEN 'code' THEN CASE WHEN t <> '' THEN '```' || chr(10) || {_FENCE} || chr(10) || '```' END
    WHEN 'table' THEN concat_ws(chr(10), nullif(array_to_string(captions, '  ' || chr(10)), ''), nullif(coalesce(trim(html, ' '), ''), ''), nullif(array_to_string(footnotes, '  ' || chr(10)), ''))
    WHEN 'image' THEN concat_ws(chr(10), '![](images/' || sha256('image_' || block_id) || '.jpg)', nullif(array_to_string(captions, '  ' || chr(10)), ''), nullif(array_to_string(footnotes, '  ' || chr(10)), ''))
    ELSE CASE WHEN t <> '' THEN {_EP} END END, '') AS md FROM k WHERE type NOT IN ('header', 'footer', 'page_number', 'aside_text', 'page_footnote'))"""

_CONTENT = f"""WITH {_KIDS}, z AS (SELECT doc_id, page_idx, max(width) AS w, max(height) AS h FROM doc_pages GROUP BY ALL)
        SELECT block_id, page_idx, CASE WHEN type IN ('text', 'title', 'list', 'index', 'abstract') THEN 'text' WHEN type = 'interline_equation' THEN 'equation' WHEN type = 'ref_text' THEN 'list' ELSE type END AS type,
            CASE WHEN type IN ('image', 'table', 'chart', 'ref_text', 'code') THEN NULL WHEN type = 'interline_equation' THEN '$$' || chr(10) || trim(content, ' ') || chr(10) || '$$' ELSE {_EP} END AS text,
            CASE WHEN type = 'title' AND coalesce(title_level, 1) <> 0 THEN coalesce(title_level, 1) END AS text_level, CASE WHEN type = 'interline_equation' THEN 'latex' END AS text_format,
            CASE WHEN type = 'ref_text' THEN list_filter(list_transform(string_split(content, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') END AS list_items, captions, footnotes,
            CASE WHEN type = 'table' THEN html END AS table_body, CASE WHEN type = 'code' THEN {_FENCE} END AS code_body,
            CASE WHEN bbox.x0 IS NOT NULL AND bbox.y1 IS NOT NULL AND w > 0 AND h > 0 THEN [trunc(least(bbox.x0, bbox.x1) * 1000 / w)::INT, trunc(least(bbox.y0, bbox.y1) * 1000 / h)::INT, trunc(greatest(bbox.x0, bbox.x1) * 1000 / w)::INT, trunc(greatest(bbox.y0, bbox.y1) * 1000 / h)::INT] END AS bbox
        FROM k LEFT JOIN z USING (doc_id, page_idx)"""

SQL = {
    "q_block_markdown": f"WITH {_KIDS}, {_MD} SELECT block_id, md FROM m",
    "q_markdown": f"WITH {_KIDS}, {_MD} SELECT doc_id, string_agg(md, chr(10) || chr(10) ORDER BY page_idx NULLS FIRST, block_id) AS markdown FROM m WHERE md IS NOT NULL GROUP BY doc_id",
    "q_text_markdown": f"WITH {_KIDS}, {_MD} SELECT doc_id, string_agg(md, chr(10) || chr(10) ORDER BY page_idx NULLS FIRST, block_id) AS markdown FROM m WHERE md IS NOT NULL AND type NOT IN ('table', 'image', 'chart') GROUP BY doc_id",
    "q_content_list": _CONTENT,
    "q_content_pages": f"""WITH i AS (SELECT * FROM ({_CONTENT})), p AS (SELECT i.*, b.doc_id FROM i JOIN (SELECT block_id, doc_id FROM blocks) b USING (block_id)),
        j AS (SELECT doc_id, page_idx, block_id, '{{"type":' || to_json(type) || ',"content":{{' || concat_ws(',', '"text":' || to_json(text), '"text_level":' || text_level, '"list_items":' || to_json(list_items), '"table_body":' || to_json(table_body), '"code_body":' || to_json(code_body), CASE WHEN len(captions) > 0 THEN '"captions":' || to_json(captions) END) || '}}' || coalesce(',"bbox":' || to_json(bbox), '') || '}}' AS item FROM p)
        SELECT doc_id, page_idx, '[' || string_agg(item, ',' ORDER BY block_id) || ']' AS items FROM j GROUP BY ALL""",
    "q_styled_spans": f"""SELECT rec_id, page_no, block_list, block_path, line_no, span_no,
            CASE length(content) % 5 WHEN 0 THEN '**' || content || '**' WHEN 1 THEN '***' || content || '***' WHEN 2 THEN '~~' || content || '~~' ELSE content END AS md,
            CASE length(content) % 5 WHEN 0 THEN '<strong>' || content || '</strong>' WHEN 1 THEN '<em><strong>' || content || '</strong></em>' WHEN 2 THEN '<s>' || content || '</s>' WHEN 3 THEN '<em><u>' || content || '</u></em>' ELSE content END AS html
        FROM ({SHREDDED['p1_spans']}) WHERE type = 'text' AND content IS NOT NULL""",
    "q_list_items": """WITH t AS (SELECT doc_id, block_id, greatest(0, coalesce(title_level, 2) - 1) AS ilevel, coalesce(title_level, 2) % 2 = 0 AS ordered, content FROM blocks WHERE type = 'title' AND content IS NOT NULL),
        s AS (SELECT a.*, (SELECT count(*) FROM t b WHERE b.doc_id IS NOT DISTINCT FROM a.doc_id AND b.block_id <= a.block_id AND b.ilevel < a.ilevel) AS run FROM t a),
        n AS (SELECT *, sum(ordered::INT) OVER (PARTITION BY doc_id, ilevel, run ORDER BY block_id) AS n FROM s)
        SELECT block_id, repeat('    ', ilevel) || CASE WHEN ordered THEN n || '. ' ELSE '- ' END || content AS line FROM n""",
}

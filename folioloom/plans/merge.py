"""Queries over texts that go on, captions, rows and products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.functions import geometry as G
from folioloom.functions.text import is_continuation
from folioloom.operators import merge as M
from folioloom.runtime import read

PAGE, ORDER = ["doc_id", "page_idx"], ["page_idx", "block_id"]


def q_text_continuations(spark: SparkSession, root: str) -> DataFrame:
    """Texts that go on from another block, with lines of eighty characters."""
    b = read(spark, root, "blocks", "block_id", *PAGE, "type", "content", "bbox").withColumn("box", G.upright(F.col("bbox")))
    n = F.coalesce(F.when(F.length(F.trim("content")) > 0, F.ceil(F.length("content") / 80)), F.lit(0)).cast("int")
    shaped = b.select("block_id", *PAGE, "type", "box", n.alias("n_lines"), (F.col("box.x0") + F.col("block_id") % 3 * 3).alias("first_x0"), (F.col("box.x1") - F.col("block_id") % 5 * 4).alias("last_x1"), F.lit(10.0).alias("line_height"), F.regexp_replace("content", "^[A-ZÀ-Þ]", "x").alias("first_text"), F.regexp_replace("content", "[.]$", "").alias("last_text"))
    return M.text_continuations(shaped, ["doc_id"], ORDER, "block_id").select("block_id", "goes_on")


def q_contiguous_captions(spark: SparkSession, root: str) -> DataFrame:
    """Captions of a figure whose numbers follow each other."""
    b = read(spark, root, "blocks", "block_id", *PAGE, "type", "block_index", "parent_index").where("type IN ('table_caption', 'image_caption') AND parent_index IS NOT NULL AND block_index IS NOT NULL")
    one = b.groupBy(*PAGE, "parent_index", "block_index").agg(F.min("block_id").alias("block_id"))
    return M.contiguous_captions(one, [*PAGE, "parent_index"], "block_index", "parent_index").select("block_id", "kept")


def q_leading_continuations(spark: SparkSession, root: str) -> DataFrame:
    """Captions and texts at the head of a page that announce more of a table; every third text does."""
    b = read(spark, root, "blocks", "block_id", *PAGE, "type", "content")
    kind = F.when(F.col("type") == "table_caption", "text").otherwise(F.col("type"))
    text = is_continuation(F.concat(F.coalesce("content", F.lit("")), F.when(F.col("block_id") % 3 == 0, " (continued)").otherwise("")))
    return M.leading_continuations(b.withColumn("type", kind), PAGE, ["block_id"], text).select("block_id", "kind")


def q_cell_rows(spark: SparkSession, root: str) -> DataFrame:
    """Lines of scanned pages in rows by their tops."""
    s = read(spark, root, "spans", *PAGE, "span_id", "bbox").where("bbox.x0 IS NOT NULL AND bbox.y1 IS NOT NULL").distinct().select(*PAGE, "span_id", F.least("bbox.y0", "bbox.y1").alias("top"))
    one = s.groupBy(*PAGE, "span_id").agg(F.min("top").alias("top"))
    return M.cell_rows(one, PAGE, ["span_id"], "top").select(*PAGE, "span_id", "row_no")


def q_overlay(spark: SparkSession, root: str) -> DataFrame:
    """Boxes to draw over the pages."""
    b = read(spark, root, "blocks", "block_id", *PAGE, "type", "bbox").where("bbox.x0 IS NOT NULL")
    o = M.overlay(b.withColumn("x0", F.col("bbox.x0")), PAGE, ["block_id"], "x0")
    return o.select("block_id", "order_no", "x0", F.array_join("rgb", ",").alias("rgb"))


QUERIES = {f.__name__: f for f in (q_text_continuations, q_contiguous_captions, q_leading_continuations, q_cell_rows, q_overlay)}

_MARKS = " OR ".join(f"suffix(c, '{m}')" for m in ("(续)", "(续表)", "(续上表)", "(continued)", "(cont.)", "(cont’d)", "(…continued)", "续表"))
SQL = {
    "q_text_continuations": """WITH b AS (SELECT block_id, doc_id, page_idx, coalesce(type, '') AS type, least(bbox.x0, bbox.x1) AS x0, least(bbox.y0, bbox.y1) AS y0, greatest(bbox.x0, bbox.x1) AS x1, greatest(bbox.y0, bbox.y1) AS y1,
            coalesce(CASE WHEN length(trim(content, ' ')) > 0 THEN ceil(length(content) / 80) END, 0)::INT AS n, regexp_replace(content, '^[A-ZÀ-Þ]', 'x') AS ft, regexp_replace(content, '[.]$', '') AS lt, row_number() OVER (PARTITION BY doc_id ORDER BY page_idx, block_id) AS k FROM blocks),
        s AS (SELECT * FROM b WHERE type NOT IN ('image', 'table', 'chart', 'code')),
        m AS (SELECT c.*, (SELECT max(s.k) FROM s WHERE s.doc_id = c.doc_id AND s.k < c.k) AS pk FROM b c WHERE type = 'text')
        SELECT m.block_id, CASE WHEN p.type = 'text' AND m.n > 0 AND p.n > 0 AND m.block_id % 3 * 3 < 5 AND p.block_id % 5 * 4 < 10 AND left(ltrim(m.ft, ' '), 1) <> '' AND right(rtrim(p.lt, ' '), 1) <> ''
            AND right(rtrim(p.lt, ' '), 1) NOT IN ('.', '!', '?', '。', '！', '？', ')', '）', '"', '”', ':', '：', ';', '；') AND NOT regexp_matches(left(ltrim(m.ft, ' '), 1), '[\\p{Nd}\\p{Lu}]')
            AND least(m.x1 - m.x0, p.x1 - p.x0) > 0 AND abs((m.x1 - m.x0) - (p.x1 - p.x0)) < least(m.x1 - m.x0, p.x1 - p.x0) AND (m.n > 1 OR p.n > 1) AND (p.page_idx <> m.page_idx OR m.y0 < p.y1)
            AND m.x0 IS NOT NULL AND p.x1 IS NOT NULL THEN p.block_id END AS goes_on FROM m LEFT JOIN s p ON p.doc_id = m.doc_id AND p.k = m.pk""",
    "q_contiguous_captions": """WITH o AS (SELECT doc_id, page_idx, parent_index, block_index, min(block_id) AS block_id FROM blocks WHERE type IN ('table_caption', 'image_caption') AND parent_index IS NOT NULL AND block_index IS NOT NULL GROUP BY ALL),
        l AS (SELECT *, lag(block_index) OVER (PARTITION BY doc_id, page_idx, parent_index ORDER BY block_index DESC) AS below FROM o)
        SELECT block_id, bool_and(below IS NULL OR block_index = below - 1 OR block_index = below - 2 AND parent_index = below - 1) OVER (PARTITION BY doc_id, page_idx, parent_index ORDER BY block_index DESC ROWS UNBOUNDED PRECEDING) AS kept FROM l""",
    "q_leading_continuations": f"""WITH t AS (SELECT block_id, doc_id, page_idx, CASE WHEN type = 'table_caption' THEN 'text' ELSE type END AS type, lower(trim(coalesce(content, '') || CASE WHEN block_id % 3 = 0 THEN ' (continued)' ELSE '' END, ' ')) AS c FROM blocks),
        m AS (SELECT *, coalesce(type NOT IN ('header', 'footer', 'page_number'), true) AS solid, coalesce(type = 'text', false) AND ({_MARKS} OR regexp_matches(c, '(^|[^\\p{{L}}])continued$') OR contains(c, '(continued)')) AS lead FROM t),
        o AS (SELECT block_id, doc_id, page_idx, coalesce(type, '') AS type FROM m WHERE solid AND NOT lead)
        SELECT block_id, CASE WHEN lead AND (SELECT arg_min(o.type, o.block_id) FROM o WHERE o.doc_id = m.doc_id AND o.page_idx = m.page_idx) = 'table' AND NOT EXISTS (SELECT 1 FROM o WHERE o.doc_id = m.doc_id AND o.page_idx = m.page_idx AND o.block_id < m.block_id) THEN 'caption' ELSE type END AS kind FROM m""",
    "q_cell_rows": """WITH o AS (SELECT doc_id, page_idx, span_id, min(least(bbox.y0, bbox.y1)) AS top FROM spans WHERE bbox.x0 IS NOT NULL AND bbox.y1 IS NOT NULL GROUP BY ALL), l AS (SELECT *, coalesce(abs(top - lag(top) OVER (PARTITION BY doc_id, page_idx ORDER BY span_id)) > 10, false)::INT AS m FROM o)
        SELECT doc_id, page_idx, span_id, sum(m) OVER (PARTITION BY doc_id, page_idx ORDER BY span_id) AS row_no FROM l""",
    "q_overlay": f"""SELECT block_id, row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY block_id) AS order_no, bbox.x0 AS x0, CASE type {' '.join(f"WHEN '{k}' THEN '{r},{g},{b}'" for k, (r, g, b) in M.COLOURS.items())} ELSE '0,0,0' END AS rgb FROM blocks WHERE bbox.x0 IS NOT NULL""",
}

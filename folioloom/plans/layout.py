"""Queries over layout detections and office blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.functions import geometry as G
from folioloom.operators import layout as L
from folioloom.plans.geometry import _B, _boxes
from folioloom.runtime import read

PAGE = ["doc_id", "page_idx"]


def _spans(spark: SparkSession, root: str) -> DataFrame:
    s = read(spark, root, "spans", *PAGE, "span_id", "type", "bbox").where("bbox.x0 IS NOT NULL AND bbox.y1 IS NOT NULL").distinct()
    return s.select(*PAGE, "span_id", "type", G.upright(F.col("bbox")).alias("box"))


def q_outside_containers(spark: SparkSession, root: str) -> DataFrame:
    """Spans whose centre lies in no table, image or formula block."""
    c = _boxes(spark, root).where(F.col("type").isin(*L.CONTAINERS)).select(*PAGE, F.col("box").alias("container_box"))
    return L.outside_containers(_spans(spark, root), c, PAGE, ["span_id", "box"]).select(*PAGE, "span_id", F.col("box.x0").alias("x0"))


def q_title_kinds(spark: SparkSession, root: str) -> DataFrame:
    """Titles against the image blocks of their page, which stand for a layout model's document titles."""
    b = _boxes(spark, root)
    return L.title_kinds(b.where("type = 'title'"), b.where("type IN ('image', 'text')").select(*PAGE, F.col("box").alias("mark_box")), PAGE, "block_id", 0.1).select("block_id", "kind")


def q_border_kinds(spark: SparkSession, root: str) -> DataFrame:
    return L.border_kinds(_boxes(spark, root).withColumn("height", F.lit(792.0)), PAGE).select("block_id", "kind")


def q_match_cells(spark: SparkSession, root: str) -> DataFrame:
    """Spans with the block they overlap best, as words and cells of a table."""
    words = _spans(spark, root).where("box.x1 > box.x0 AND box.y1 > box.y0").select(*PAGE, F.concat_ws("/", "span_id", "type").alias("word"), F.col("box").alias("word_box"))
    cells = _boxes(spark, root).select(*PAGE, F.col("block_id").alias("cell"), F.col("box").alias("cell_box"))
    return L.match_cells(words, cells, PAGE, "word", "cell")


def q_office_captions(spark: SparkSession, root: str) -> DataFrame:
    """Captions by the figures around them."""
    b = read(spark, root, "blocks", "block_id", *PAGE, "type", "content")
    kind = F.when(F.col("type").isin("table_caption", "image_caption"), "caption").otherwise(F.col("type"))
    return L.office_captions(b.withColumn("type", kind), PAGE, ["block_id"]).select("block_id", "kind")


def _sized(spark: SparkSession, root: str) -> DataFrame:
    b = read(spark, root, "blocks", "block_id", *PAGE, "type").where("type IN ('text', 'title')")
    size = F.when(F.col("type") == "title", 14.0 + F.col("block_id") % 5 * 3).otherwise(10.0 + F.col("block_id") % 2)
    return b.select(*PAGE, "block_id", size.alias("size"), (F.col("type") == "title").alias("bold"))


def q_common_size(spark: SparkSession, root: str) -> DataFrame:
    return L.common_size(_sized(spark, root), ["doc_id"], "size")


def q_promoted_titles(spark: SparkSession, root: str) -> DataFrame:
    return L.promoted_titles(_sized(spark, root), PAGE, "block_id").select("block_id", "level")


def q_linked_entries(spark: SparkSession, root: str) -> DataFrame:
    """List blocks as entries that point to title blocks by number."""
    b = read(spark, root, "blocks", "block_id", "doc_id", "type")
    entries = b.where("type = 'list'").select("doc_id", "block_id", F.concat(F.lit(" a"), (F.col("block_id") % 7).cast("string")).alias("anchor"))
    anchors = b.where("type = 'title'").select("doc_id", F.concat(F.lit("a"), (F.col("block_id") % 7).cast("string"), F.lit(" ")).alias("anchor"))
    return L.linked_entries(entries, anchors, ["doc_id"]).select("block_id", "anchor")


def q_separators(spark: SparkSession, root: str) -> DataFrame:
    """Separators between the parts of figures; kinds of blocks stand for kinds of parts."""
    from pyspark.sql import Window

    kind = F.when(F.col("type") == "table", "html_block").when(F.col("type") == "code", "details_block").otherwise("markdown_line")
    b = read(spark, root, "blocks", "block_id", *PAGE, "type").withColumn("kind", kind)
    before = F.lag("kind").over(Window.partitionBy(*PAGE).orderBy("block_id"))
    return b.withColumn("before", before).where("before IS NOT NULL").select("block_id", L.separator(F.col("before"), F.col("kind")).alias("separator"))


def q_image_uris(spark: SparkSession, root: str) -> DataFrame:
    """Inline images by content; texts of documents stand for their bytes."""
    kind = F.element_at(F.array(*[F.lit(k) for k in ("png", "jpeg", "svg+xml", "")]), (F.col("doc_id") % 4 + 1).cast("int"))
    uri = F.concat(F.lit("data:image/"), kind, F.lit(";base64,"), F.base64(F.encode(F.substring(F.coalesce("source", F.lit("?")), 1, 30), "UTF-8")))
    return read(spark, root, "documents", "doc_id", "source").select("doc_id", L.data_uri_name(uri).alias("name"))


QUERIES = {f.__name__: f for f in (q_outside_containers, q_title_kinds, q_border_kinds, q_match_cells, q_office_captions, q_common_size, q_promoted_titles, q_linked_entries, q_separators, q_image_uris)}

_S = """s AS (SELECT DISTINCT doc_id, page_idx, span_id, type, least(bbox.x0, bbox.x1) AS x0, least(bbox.y0, bbox.y1) AS y0, greatest(bbox.x0, bbox.x1) AS x1, greatest(bbox.y0, bbox.y1) AS y1 FROM spans WHERE bbox.x0 IS NOT NULL AND bbox.y1 IS NOT NULL)"""
_I = "(greatest(least(p.x1, q.x1) - greatest(p.x0, q.x0), 0) * greatest(least(p.y1, q.y1) - greatest(p.y0, q.y0), 0))"
_A = "((p.x1 - p.x0) * (p.y1 - p.y0))", "((q.x1 - q.x0) * (q.y1 - q.y0))"
_SAME = "p.doc_id = q.doc_id AND p.page_idx = q.page_idx"
_Z = "z AS (SELECT block_id, doc_id, page_idx, CASE WHEN type = 'title' THEN 14.0 + block_id % 5 * 3 ELSE 10.0 + block_id % 2 END::DOUBLE AS size, type = 'title' AS bold FROM blocks WHERE type IN ('text', 'title'))"

SQL = {
    "q_outside_containers": f"""WITH {_B}, {_S} SELECT p.doc_id, p.page_idx, span_id, p.x0 FROM s p WHERE NOT EXISTS (SELECT 1 FROM b q WHERE {_SAME} AND q.type IN ('table', 'image', 'chart', 'interline_equation')
        AND (p.x0 + p.x1) / 2 BETWEEN q.x0 AND q.x1 AND (p.y0 + p.y1) / 2 BETWEEN q.y0 AND q.y1)""",
    "q_title_kinds": f"""WITH {_B} SELECT block_id, CASE WHEN EXISTS (SELECT 1 FROM b q WHERE {_SAME} AND q.type IN ('image', 'text') AND {_I} / least({_A[0]}, {_A[1]}) >= 0.1) THEN 'doc_title' ELSE 'paragraph_title' END AS kind FROM b p WHERE type = 'title'""",
    "q_border_kinds": f"""WITH {_B}, t AS (SELECT *, CASE WHEN type = 'header' AND (y0 + y1) / 2 > 396 THEN 'footer' WHEN type = 'footer' AND (y0 + y1) / 2 < 396 THEN 'header' ELSE type END AS t FROM b),
        a AS (SELECT *, max(y1) FILTER (t = 'header') OVER (PARTITION BY doc_id, page_idx) AS low, min(y0) FILTER (t = 'footer') OVER (PARTITION BY doc_id, page_idx) AS high FROM t)
        SELECT block_id, CASE WHEN coalesce(t IN ('text', 'title', 'list', 'ref_text', 'number'), false) AND y0 >= high THEN 'footer' WHEN coalesce(t IN ('text', 'title', 'list', 'ref_text', 'number'), false) AND y1 <= low THEN 'header' ELSE t END AS kind FROM a""",
    "q_match_cells": f"""WITH {_B}, {_S}, j AS (SELECT p.doc_id, p.page_idx, span_id || '/' || p.type AS word, q.block_id AS cell, p.x0, p.y0, p.x1, p.y1, {_I} / ({_A[0]} + {_A[1]} - {_I}) AS iou,
            abs(p.x0 - q.x0) + abs(p.y0 - q.y0) AS d1, abs(p.x1 - q.x1) + abs(p.y1 - q.y1) AS d2 FROM s p JOIN b q ON {_SAME} WHERE p.x1 > p.x0 AND p.y1 > p.y0)
        SELECT doc_id, page_idx, word, cell FROM j WHERE iou > 1e-8 QUALIFY row_number() OVER (PARTITION BY doc_id, page_idx, word ORDER BY iou DESC, d1 + d2 + least(d1, d2), cell) = 1""",
    "q_office_captions": r"""WITH c AS (SELECT block_id, doc_id, page_idx, CASE WHEN type IN ('table_caption', 'image_caption') THEN 'caption' ELSE type END AS type, lower(trim(coalesce(content, ''), ' ')) AS t FROM blocks),
        l AS (SELECT *, lag(type) OVER (PARTITION BY doc_id, page_idx ORDER BY block_id) AS before FROM c),
        k AS (SELECT *, CASE WHEN type = 'text' AND (before = 'table' AND regexp_matches(t, '^(表|table)') OR before = 'image' AND regexp_matches(t, '^(图|fig)')) THEN 'caption' ELSE type END AS k FROM l),
        o AS (SELECT *, CASE WHEN coalesce(k, '') <> 'caption' THEN coalesce(k, '') END AS other FROM k),
        d AS (SELECT *, last_value(other IGNORE NULLS) OVER (PARTITION BY doc_id, page_idx ORDER BY block_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS up, first_value(other IGNORE NULLS) OVER (PARTITION BY doc_id, page_idx ORDER BY block_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS down FROM o)
        SELECT block_id, CASE WHEN k = 'caption' THEN CASE WHEN up IN ('table', 'image', 'chart') THEN up || '_caption' WHEN down IN ('table', 'image', 'chart') THEN down || '_caption' ELSE 'text' END ELSE k END AS kind FROM d""",
    "q_common_size": f"WITH {_Z}, n AS (SELECT doc_id, size, count(*) AS n FROM z GROUP BY ALL) SELECT doc_id, size FROM n QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, size) = 1",
    "q_promoted_titles": f"""WITH {_Z}, m AS (SELECT doc_id, page_idx, size AS body FROM (SELECT doc_id, page_idx, size, count(*) AS n FROM z WHERE NOT bold GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY n DESC, size) = 1),
        r AS (SELECT z.*, body, max(size) OVER (PARTITION BY doc_id, page_idx) AS first FROM z LEFT JOIN m USING (doc_id, page_idx) WHERE bold),
        s AS (SELECT *, max(size) FILTER (size < first) OVER (PARTITION BY doc_id, page_idx) AS second, count(*) FILTER (size = first) OVER (PARTITION BY doc_id, page_idx) AS n FROM r),
        t AS (SELECT *, n = 1 AND (body IS NULL OR first >= body + 4) AND (second IS NULL OR first >= second + 2) AS two FROM s)
        SELECT block_id, CASE WHEN two AND size = first THEN 2 ELSE 3 END AS level FROM t WHERE two AND (size = first OR size = second AND body IS NOT NULL AND second >= body + 2 AND second <= first - 2)""",
    "q_linked_entries": """WITH t AS (SELECT DISTINCT doc_id, 'a' || block_id % 7 AS a FROM blocks WHERE type = 'title') SELECT block_id, CASE WHEN NOT EXISTS (SELECT 1 FROM t WHERE t.doc_id = b.doc_id) THEN ' a' || block_id % 7
        WHEN EXISTS (SELECT 1 FROM t WHERE t.doc_id = b.doc_id AND t.a = 'a' || b.block_id % 7) THEN 'a' || block_id % 7 END AS anchor FROM blocks b WHERE type = 'list'""",
    "q_separators": """WITH k AS (SELECT block_id, doc_id, page_idx, CASE type WHEN 'table' THEN 'html_block' WHEN 'code' THEN 'details_block' ELSE 'markdown_line' END AS k FROM blocks),
        l AS (SELECT *, lag(k) OVER (PARTITION BY doc_id, page_idx ORDER BY block_id) AS p FROM k)
        SELECT block_id, CASE WHEN p IN ('html_block', 'details_block') OR k = 'details_block' THEN chr(10) || chr(10) WHEN k = 'html_block' THEN chr(10) ELSE '  ' || chr(10) END AS separator FROM l WHERE p IS NOT NULL""",
    "q_image_uris": """WITH u AS (SELECT doc_id, doc_id % 4 AS m, 'data:image/' || ['png', 'jpeg', 'svg+xml', ''][(doc_id % 4 + 1)::INT] || ';base64,' || base64(left(coalesce(source, '?'), 30)::BLOB) AS u FROM documents)
        SELECT doc_id, CASE WHEN m < 3 THEN sha256(u) || '.' || ['png', 'jpg', 'svg'][(m + 1)::INT] END AS name FROM u""",
}

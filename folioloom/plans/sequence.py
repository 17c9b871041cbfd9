"""Queries along the reading order of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioloom.functions import geometry as G
from folioloom.functions.text import section_parts
from folioloom.operators import sequence as Q
from folioloom.runtime import read

DOC, PAGE, ORDER = ["doc_id"], ["doc_id", "page_idx"], ["page_idx", "block_id"]


def _blocks(spark: SparkSession, root: str) -> DataFrame:
    return read(spark, root, "blocks", "block_id", *PAGE, "type", "content", "title_level", "bbox")


def q_block_groups(spark: SparkSession, root: str) -> DataFrame:
    return Q.text_groups(_blocks(spark, root), DOC, ORDER).select("block_id", "group_no")


def q_para_merge(spark: SparkSession, root: str) -> DataFrame:
    """Paragraphs out of text blocks, with lines as long as eighty characters."""
    b = _blocks(spark, root).withColumn("box", G.upright(F.col("bbox")))
    lines = F.when(F.length(F.trim("content")) > 0, F.ceil(F.length("content") / 80)).otherwise(0).cast("int")
    shaped = b.select(
        "block_id", *PAGE, "type", "box", F.coalesce(lines, F.lit(0)).alias("n_lines"), (F.col("box.x0") + F.col("block_id") % 3 * 3).alias("first_x0"), (F.col("box.x1") - F.col("block_id") % 5 * 4).alias("last_x1"), F.lit(10.0).alias("line_height"), F.lit(10.0).alias("last_height"), F.regexp_replace("content", "^[A-ZÀ-Þ]", "x").alias("first_text"), F.regexp_replace("content", "[.]$", "").alias("last_text")
    )
    return Q.paragraphs(shaped, DOC, ORDER).select("block_id", "group_no", "para_no")


def q_list_detect(spark: SparkSession, root: str) -> DataFrame:
    """Text, list or index: scanned pages as blocks of lines."""
    s = read(spark, root, "spans", *PAGE, "span_id", "type", "content", "bbox").where("type = 'text' AND content IS NOT NULL AND bbox.x0 IS NOT NULL AND bbox.y1 IS NOT NULL").distinct()
    lines = s.select("doc_id", "page_idx", F.col("span_id").alias("line_no"), F.trim("content").alias("text"), G.upright(F.col("bbox")).alias("box"), F.lit(612.0).alias("page_width"))
    return Q.block_kinds(lines, PAGE)


def q_ref_runs(spark: SparkSession, root: str) -> DataFrame:
    return Q.runs(_blocks(spark, root), PAGE, ["block_id"], "ref_text")


def q_formula_numbers(spark: SparkSession, root: str) -> DataFrame:
    """Short captions stand for the numbers of formulas."""
    number, equation = F.col("type").isin("table_caption", "image_caption"), F.col("type") == "interline_equation"
    return Q.formula_numbers(_blocks(spark, root), DOC, ORDER, number, equation).select("block_id", "joins")


def q_previous_text(spark: SparkSession, root: str) -> DataFrame:
    b = _blocks(spark, root).where("type IS NOT NULL")
    out = Q.previous_eligible(b, DOC, ORDER, ("image", "table", "table_caption", "image_caption", "header", "footer", "page_number"))
    return out.where("type = 'text'").select("block_id", F.col("previous.block_id").alias("previous_id"))


def q_caption_parent(spark: SparkSession, root: str) -> DataFrame:
    b = _blocks(spark, root).where("bbox.x0 IS NOT NULL AND bbox.x1 IS NOT NULL AND bbox.y0 IS NOT NULL AND bbox.y1 IS NOT NULL")
    b = b.select(*PAGE, F.col("block_id").alias("index"), F.coalesce("type", F.lit("")).alias("type"), G.upright(F.col("bbox")).alias("box"))
    return Q.caption_parents(b, PAGE, ("table_caption", "image_caption"), ("table", "image")).select("child", "parent")


def q_section_numbers(spark: SparkSession, root: str) -> DataFrame:
    level = F.coalesce("title_level", F.lit(2))
    h = _blocks(spark, root).where("type = 'title' AND doc_id IS NOT NULL")
    h = h.select("doc_id", "page_idx", "block_id", level.alias("level"), (F.col("block_id") % 2 == 0).alias("numbered"), section_parts(F.coalesce("content", F.lit("")), level).alias("literal"))
    return Q.section_numbers(h, "doc_id", ["page_idx", "block_id"])


def q_title_levels(spark: SparkSession, root: str) -> DataFrame:
    """Levels of headings without a model: the first of a file is its title, the others are paragraph titles; plain and vertical text are one kind."""
    w = Window.partitionBy("doc_id").orderBy(*ORDER)
    first = F.min(F.when(F.col("type") == "title", F.struct(*ORDER))).over(Window.partitionBy("doc_id"))
    b = _blocks(spark, root).withColumn("first", first)
    level = F.when(F.col("type") == "title", F.when((F.col("first.block_id") == F.col("block_id")) & (F.col("first.page_idx") == F.col("page_idx")), 1).otherwise(2))
    return b.select("block_id", F.when(F.col("type").isin("text", "vertical_text"), "text").otherwise(F.col("type")).alias("kind"), level.alias("level"))


QUERIES = {f.__name__: f for f in (q_block_groups, q_para_merge, q_list_detect, q_ref_runs, q_formula_numbers, q_previous_text, q_caption_parent, q_section_numbers, q_title_levels)}

_BREAK = "type IN ('abstract', 'interline_equation', 'doc_title', 'paragraph_title', 'title')"
_W = "(PARTITION BY doc_id ORDER BY page_idx, block_id)"
_UP = "least(bbox.x0, bbox.x1) AS x0, least(bbox.y0, bbox.y1) AS y0, greatest(bbox.x0, bbox.x1) AS x1, greatest(bbox.y0, bbox.y1) AS y1"

_PARTS = "CASE WHEN n <> '' AND len(p) = coalesce(title_level, 2) THEN list_transform(p, lambda x: x::INT) END"

SQL = {
    "q_block_groups": f"""SELECT block_id, group_no FROM (SELECT block_id, type, sum(coalesce(({_BREAK})::INT, 0)) OVER (PARTITION BY doc_id ORDER BY page_idx, block_id ROWS UNBOUNDED PRECEDING) AS group_no FROM blocks)
        WHERE type IN ('text', 'index', 'vertical_text')""",
    "q_para_merge": f"""WITH b AS (SELECT block_id, doc_id, page_idx, type, {_UP}, content,
            coalesce(CASE WHEN length(trim(content, ' ')) > 0 THEN ceil(length(content) / 80) ELSE 0 END, 0)::INT AS n,
            sum(coalesce(({_BREAK})::INT, 0)) OVER (PARTITION BY doc_id ORDER BY page_idx, block_id ROWS UNBOUNDED PRECEDING) AS group_no FROM blocks),
        t AS (SELECT *, regexp_replace(content, '^[A-ZÀ-Þ]', 'x') AS ft, regexp_replace(content, '[.]$', '') AS lt, x0 + block_id % 3 * 3 AS fx, x1 - block_id % 5 * 4 AS lx FROM b WHERE type IN ('text', 'index', 'vertical_text')),
        l AS (SELECT *, lag(x0) OVER w AS px0, lag(y1) OVER w AS py1, lag(x1) OVER w AS px1, lag(lx) OVER w AS plx, lag(n) OVER w AS pn, right(rtrim(lag(lt) OVER w, ' '), 1) AS pend, lag(type) OVER w AS ptype,
            max(n) OVER (PARTITION BY doc_id, group_no) <= 3 AND NOT bool_or(type = 'vertical_text') OVER (PARTITION BY doc_id, group_no) AS listlike
            FROM t WINDOW w AS (PARTITION BY doc_id, group_no ORDER BY page_idx, block_id)),
        f AS (SELECT *, coalesce(type = 'text' AND ptype = 'text' AND NOT listlike AND abs(x0 - fx) < 5 AND abs(px1 - plx) < 10 AND pend NOT IN ('.', '!', '?', '。', '！', '？', ')', '）', '"', '”', ':', '：', ';', '；')
            AND abs((x1 - x0) - (px1 - px0)) < least(x1 - x0, px1 - px0) AND left(ltrim(ft, ' '), 1) <> '' AND NOT regexp_matches(left(ltrim(ft, ' '), 1), '[\\p{{Nd}}\\p{{Lu}}]') AND y0 < py1 AND n > 0 AND pn > 0, false) AS fits FROM l),
        d AS (SELECT *, CASE WHEN NOT fits THEN false WHEN n > 1 OR coalesce(pn, 0) > 1 THEN true END AS sure FROM f),
        m AS (SELECT *, coalesce(first_value(sure IGNORE NULLS) OVER (PARTITION BY doc_id, group_no ORDER BY page_idx, block_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), false) OR coalesce(type = ptype AND type IN ('list', 'index'), false) AS folds FROM d)
        SELECT block_id, group_no, sum(CASE WHEN folds THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, group_no ORDER BY page_idx, block_id ROWS UNBOUNDED PRECEDING) - 1 AS para_no FROM m""",
    "q_list_detect": f"""WITH s AS (SELECT DISTINCT doc_id, page_idx, span_id, trim(content, ' ') AS t, {_UP} FROM spans WHERE type = 'text' AND content IS NOT NULL AND bbox.x0 IS NOT NULL AND bbox.y1 IS NOT NULL),
        g AS (SELECT doc_id, page_idx, count(*) AS n, arg_min(y1 - y0, span_id) AS h, arg_min(x0, span_id) AS fx0, arg_max(x0, span_id) AS lx0, arg_max(x1, span_id) AS lx1, min(x0) AS bx0, max(x1) AS bx1, min(y0) AS by0, max(y1) AS by1, string_agg(t, '') AS txt FROM s GROUP BY ALL),
        c AS (SELECT *, CASE WHEN length(regexp_replace(txt, '[^\\x{{3040}}-\\x{{30ff}}\\x{{4e00}}-\\x{{9fff}}\\x{{ac00}}-\\x{{d7af}}]', '', 'g')) * 2 > length(txt) OR (bx1 - bx0) / 612 >= 0.5 THEN 0.26 ELSE 0.36 END * (bx1 - bx0) AS far FROM g),
        k AS (SELECT doc_id, page_idx, any_value(n) AS n, any_value(h) AS h, any_value(fx0) AS fx0, any_value(lx0) AS lx0, any_value(lx1) AS lx1, any_value(bx0) AS bx0, any_value(bx1) AS bx1, any_value(by1 - by0) AS bh,
            count(*) FILTER (x0 - bx0 > 0.7 * h AND bx1 - x1 > 0.7 * h) AS inside, count(*) FILTER (abs((x0 + x1) / 2 - (bx0 + bx1) / 2) < h / 2) AS centred, count(*) FILTER (abs(x0 - bx0) < h / 2) AS flush,
            count(*) FILTER (abs(x0 - bx0) >= h / 2 AND x0 - bx0 > h) AS indented, count(*) FILTER (abs(bx1 - x1) < h) AS flush_right, count(*) FILTER (abs(bx1 - x1) >= h AND bx1 - x1 > far) AS ragged,
            count(*) FILTER (right(t, 1) IN ('.', '。', ';', '；')) AS ended, count(*) FILTER (regexp_matches(t, '^\\p{{Nd}}')) AS df, count(*) FILTER (regexp_matches(t, '\\p{{Nd}}$')) AS dl FROM s JOIN c USING (doc_id, page_idx) GROUP BY ALL)
        SELECT doc_id, page_idx, CASE WHEN n < 2 THEN 'text' WHEN (flush / n >= 0.8 OR flush_right / n >= 0.8) AND (df / n >= 0.8 OR dl / n >= 0.8) THEN 'index'
            WHEN inside >= 2 AND centred = n AND inside / n >= 0.5 AND coalesce(bh / nullif(bx1 - bx0, 0) > 0.4, false) THEN 'list'
            WHEN flush >= 2 AND (ragged >= 2 OR ended / n >= 0.8 OR indented >= 2) AND NOT (fx0 - bx0 > h / 2 AND abs(lx0 - bx0) < h / 2 AND bx1 - lx1 > h) THEN 'list' ELSE 'text' END AS kind FROM k""",
    "q_ref_runs": """WITH b AS (SELECT *, coalesce(type = 'ref_text', false) AS r FROM blocks), l AS (SELECT *, r AND NOT coalesce(lag(r) OVER (PARTITION BY doc_id, page_idx ORDER BY block_id), false) AS s FROM b),
        n AS (SELECT *, sum(s::INT) OVER (PARTITION BY doc_id, page_idx ORDER BY block_id ROWS UNBOUNDED PRECEDING) AS run FROM l)
        SELECT doc_id, page_idx, run - 1 AS run_no, min(block_id) AS block_id, count(*) AS n FROM n WHERE r GROUP BY doc_id, page_idx, run""",
    "q_formula_numbers": f"""SELECT block_id, joins FROM (SELECT block_id, type, CASE WHEN lag(type) OVER {_W} = 'interline_equation' THEN 'before'
        WHEN lead(type) OVER {_W} = 'interline_equation' AND coalesce(lead(type, 2) OVER {_W}, '') NOT IN ('table_caption', 'image_caption') THEN 'after' ELSE 'text' END AS joins FROM blocks) WHERE type IN ('table_caption', 'image_caption')""",
    "q_previous_text": """WITH s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_idx, block_id) AS k FROM blocks WHERE type IS NOT NULL),
        e AS (SELECT * FROM s WHERE type NOT IN ('image', 'table', 'table_caption', 'image_caption', 'header', 'footer', 'page_number')),
        p AS (SELECT s.block_id, s.doc_id, max(e.k) AS pk FROM s LEFT JOIN e ON s.doc_id = e.doc_id AND e.k < s.k WHERE s.type = 'text' GROUP BY ALL)
        SELECT p.block_id, CASE WHEN e.type = 'text' THEN e.block_id END AS previous_id FROM p LEFT JOIN e ON p.doc_id = e.doc_id AND p.pk = e.k""",
    "q_caption_parent": f"""WITH b AS (SELECT block_id, doc_id, page_idx, coalesce(type, '') AS type, {_UP}, row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY block_id) AS pos FROM blocks
            WHERE bbox.x0 IS NOT NULL AND bbox.x1 IS NOT NULL AND bbox.y0 IS NOT NULL AND bbox.y1 IS NOT NULL),
        p AS (SELECT c.doc_id, c.page_idx, c.block_id AS child, m.block_id AS parent, c.type AS ctype, m.type AS mtype, least(c.pos, m.pos) AS lo, greatest(c.pos, m.pos) AS hi,
            c.x0 AS cx0, c.y0 AS cy0, c.x1 AS cx1, c.y1 AS cy1, m.x0 AS mx0, m.y0 AS my0, m.x1 AS mx1, m.y1 AS my1,
            CASE WHEN c.y1 <= m.y0 THEN c.y1 WHEN m.y1 <= c.y0 THEN m.y1 END AS ga, CASE WHEN c.y1 <= m.y0 THEN m.y0 WHEN m.y1 <= c.y0 THEN c.y0 END AS gb
            FROM b c JOIN b m ON c.doc_id = m.doc_id AND c.page_idx = m.page_idx WHERE c.type IN ('table_caption', 'image_caption') AND m.type IN ('table', 'image')),
        f AS (SELECT *, (SELECT count(*) FROM b x WHERE x.doc_id = p.doc_id AND x.page_idx = p.page_idx AND x.pos > p.lo AND x.pos < p.hi AND x.type = p.ctype) AS same,
            (SELECT count(*) FROM b x WHERE x.doc_id = p.doc_id AND x.page_idx = p.page_idx AND x.pos > p.lo AND x.pos < p.hi AND x.type <> p.ctype AND NOT coalesce(ga IS NOT NULL
                AND NOT (least(x.x1, cx1) > greatest(x.x0, cx0) AND least(x.y1, cy1) > greatest(x.y0, cy0)) AND NOT (least(x.x1, mx1) > greatest(x.x0, mx0) AND least(x.y1, my1) > greatest(x.y0, my0)) AND (x.y1 <= ga OR x.y0 >= gb), false)) AS blockers FROM p),
        n AS (SELECT *, hi - lo - same AS diff, sqrt(pow(greatest(mx0 - cx1, cx0 - mx1, 0), 2) + pow(greatest(my0 - cy1, cy0 - my1, 0), 2)) AS edge,
            sqrt(pow((cx0 + cx1) / 2 - (mx0 + mx1) / 2, 2) + pow((cy0 + cy1) / 2 - (my0 + my1) / 2, 2)) AS centre FROM f WHERE blockers = 0 QUALIFY diff = min(hi - lo - same) OVER (PARTITION BY child)),
        r AS (SELECT *, max(edge) OVER (PARTITION BY child) - min(edge) OVER (PARTITION BY child) AS spread, bool_and(mtype = 'table') OVER (PARTITION BY child) AS tables FROM n)
        SELECT child, parent FROM r QUALIFY row_number() OVER (PARTITION BY child ORDER BY CASE WHEN spread > 2 THEN edge WHEN tables THEN -parent ELSE centre END, parent) = 1""",
    "q_section_numbers": f"""WITH RECURSIVE t AS (SELECT doc_id, page_idx, block_id, coalesce(title_level, 2) AS level, block_id % 2 = 0 AS numbered, {_PARTS} AS literal, row_number() OVER (PARTITION BY doc_id ORDER BY page_idx NULLS FIRST, block_id) AS k FROM (
            SELECT *, string_split(n, '.') AS p FROM (SELECT *, regexp_extract(coalesce(content, '') || ' ', '^\\s*([0-9]+(?:\\.[0-9]+)*)\\.?\\s', 1) AS n FROM blocks WHERE type = 'title' AND doc_id IS NOT NULL))),
        r AS (SELECT doc_id, 0::BIGINT AS k, []::INT[] AS counters, NULL::BIGINT AS block_id, NULL::INT AS page_idx, NULL::VARCHAR AS number FROM (SELECT DISTINCT doc_id FROM t)
            UNION ALL SELECT doc_id, k, CASE WHEN kind = 'literal' THEN literal WHEN kind = 'count' THEN up ELSE counters END, block_id, page_idx, CASE WHEN kind = 'count' THEN array_to_string(up, '.') END FROM (
                SELECT t.doc_id, t.k, r.counters, t.block_id, t.page_idx, t.literal, CASE WHEN level < 1 THEN 'none' WHEN len(literal) = level THEN 'literal' WHEN NOT numbered THEN 'none' ELSE 'count' END AS kind,
                    list_transform(range(1, level + 1), lambda i: CASE WHEN i = level THEN coalesce(r.counters[i], 0) + 1 ELSE greatest(1, coalesce(r.counters[i], 0)) END::INT) AS up
                FROM r JOIN t ON t.doc_id = r.doc_id AND t.k = r.k + 1))
        SELECT doc_id, page_idx, block_id, number FROM r WHERE k > 0""",
    "q_title_levels": """SELECT block_id, CASE WHEN type IN ('text', 'vertical_text') THEN 'text' ELSE type END AS kind,
        CASE WHEN type = 'title' THEN CASE WHEN row_number() OVER (PARTITION BY doc_id, type ORDER BY page_idx NULLS FIRST, block_id) = 1 THEN 1 ELSE 2 END END AS level FROM blocks""",
}

"""Queries over the text layer and over objects of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.functions import geometry as G
from folioloom.functions.text import LINE_STOPS
from folioloom.operators import objects as B
from folioloom.operators import textlayer as L
from folioloom.runtime import read, spread

PAGE, ORDER = ["doc_id", "page_idx"], ["page_idx", "block_id"]


def q_surrogates(spark: SparkSession, root: str) -> DataFrame:
    """Characters of texts out of their code units; every third text ends in half a pair."""
    d = spread(read(spark, root, "documents", "doc_id", "text").where("text IS NOT NULL"))
    half = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit(0xD835))).otherwise(F.array().cast("array<int>"))
    # made once a row: a function over an array must not make it anew for each of its elements
    u = d.select("doc_id", F.concat(L.code_units(F.col("text")), half).alias("u"))
    c = u.select("doc_id", L.joined_units(F.col("u")).alias("c"))
    mixed = F.aggregate(F.transform("c", lambda x, i: x["code"].cast("long") * (i % 1009 + 1)), F.lit(0).cast("long"), lambda a, x: a + x)
    return c.select("doc_id", F.size("c").alias("n"), F.size(F.filter("c", lambda x: x["code"] > 0xFFFF)).alias("far"), mixed.alias("mixed"))


def _page_spans(spark: SparkSession, root: str) -> DataFrame:
    s = B.upright_boxes(read(spark, root, "spans", *PAGE, "span_id", "type", "content", "bbox").where("type = 'text' AND length(trim(content)) > 0"), "span_box")
    one = s.repartition(*PAGE).groupBy(*PAGE, "span_id").agg(F.min(F.struct("content", "span_box")).alias("s"))  # whole pages are needed later
    return one.select(*PAGE, "span_id", "s.content", "s.span_box")


def q_char_fill(spark: SparkSession, root: str) -> DataFrame:
    """Scanned lines taken apart into characters without blanks, evenly wide, and filled with them again."""
    return L.refilled_spans(_page_spans(spark, root), PAGE)


def q_map_errors(spark: SparkSession, root: str) -> DataFrame:
    """Files with the share of characters that were lost on their way."""
    return L.map_errors(read(spark, root, "blocks", "doc_id", "content").where("doc_id IS NOT NULL"), "doc_id", "content")


def q_table_objects(spark: SparkSession, root: str) -> DataFrame:
    """Pictures and formulas in tables, whose boxes are taken a hundred points larger on each side."""
    b = B.upright_boxes(read(spark, root, "blocks", *PAGE, "block_id", "type", "content", "bbox"), "box")
    far = F.struct(*[(F.col(f"box.{k}") + d).alias(k) for k, d in (("x0", -100), ("y0", -100), ("x1", 100), ("y1", 100))])
    tables = b.where("type = 'table'").select(*PAGE, F.col("block_id").alias("table"), far.alias("table_box"))
    items = b.where("type IN ('image', 'interline_equation')").select(*PAGE, F.col("block_id").alias("item"), F.col("box").alias("item_box"))
    kinds = b.select(F.col("block_id").alias("item"), B.table_token(F.col("type"), F.coalesce("content", F.lit("")), F.concat(F.lit("images/"), F.col("block_id").cast("string"), F.lit(".jpg"))).alias("token"))
    found = B.inside_tables(items, tables, PAGE).join(kinds, "item")
    return found.select("item", "table", "token", *[F.round(f"rel.{k}", 4).alias(k) for k in ("x0", "y0", "x1", "y1")])


def q_pruned_text(spark: SparkSession, root: str) -> DataFrame:
    """Blocks without recognised texts that are blank; plain text stands for recognised one."""
    return B.without_blank_text(read(spark, root, "blocks", "block_id", "type", "content"), "type", "content", "text").select("block_id")


def q_vertical_merge(spark: SparkSession, root: str) -> DataFrame:
    """Texts as if they ran from top to bottom, with those that go on from the one before."""
    b = B.upright_boxes(read(spark, root, "blocks", "block_id", *PAGE, "type", "content", "bbox"), "box")
    y0, y1 = F.col("box.y0") + F.col("block_id") % 3 * 3, F.col("box.y1") - F.col("block_id") % 5 * 4
    shaped = b.select("block_id", *PAGE, "type", "box", y0.alias("first_y0"), F.lit(10.0).alias("first_width"), y1.alias("last_y1"), F.lit(10.0).alias("last_width"), F.regexp_replace("content", "^[A-ZÀ-Þ]", "x").alias("first_text"), F.regexp_replace("content", "[.]$", "").alias("last_text"))
    return B.vertical_continuations(shaped, ["doc_id"], ORDER, "block_id").select("block_id", "goes_on")


def q_grid_spans(spark: SparkSession, root: str) -> DataFrame:
    """Blocks of pages as cells of a grid."""
    b = B.upright_boxes(read(spark, root, "blocks", "block_id", *PAGE, "bbox").where("doc_id IS NOT NULL AND page_idx IS NOT NULL"), "box")
    return B.grid_spans(b.select("block_id", *PAGE, "box"), PAGE).select("block_id", "row_no", "col_no", "rowspan", "colspan")


QUERIES = {f.__name__: f for f in (q_surrogates, q_char_fill, q_map_errors, q_table_objects, q_pruned_text, q_vertical_merge, q_grid_spans)}

_UP = "least(bbox.x0, bbox.x1) AS x0, least(bbox.y0, bbox.y1) AS y0, greatest(bbox.x0, bbox.x1) AS x1, greatest(bbox.y0, bbox.y1) AS y1"
_WHOLE = " AND ".join(f"bbox.{k} IS NOT NULL" for k in ("x0", "y0", "x1", "y1"))
_LIGATURES = "t"
for _a, _b in L.LIGATURES.items():
    _LIGATURES = f"replace({_LIGATURES}, '{_a}', '{_b}')"


def _edges(low: str, name: str) -> str:
    return f"""{name} AS (SELECT doc_id, page_idx, list(edge ORDER BY edge) AS {name} FROM (SELECT doc_id, page_idx, line, min(edge) AS edge FROM (
        SELECT *, sum(fresh) OVER (PARTITION BY doc_id, page_idx ORDER BY edge) AS line FROM (SELECT *, CASE WHEN edge - lag(edge) OVER (PARTITION BY doc_id, page_idx ORDER BY edge) <= 10 THEN 0 ELSE 1 END AS fresh FROM (SELECT DISTINCT doc_id, page_idx, {low} AS edge FROM b))) GROUP BY ALL) GROUP BY ALL)"""


def _spanned(edges: str, low: str, high: str) -> str:
    at = f"len(list_filter({edges}, lambda e: e <= {low} + 1e-9)) - 1"
    return f"{at}, greatest(1, len(list_filter({edges}, lambda e: e < {high} - 10)) - ({at}))"


SQL = {
    "q_surrogates": """WITH t AS (SELECT doc_id, string_split(text || CASE WHEN doc_id % 3 = 0 THEN chr(65533) ELSE '' END, '') AS c FROM documents WHERE text IS NOT NULL),
        e AS (SELECT doc_id, unnest(c) AS c, generate_subscripts(c, 1) - 1 AS i FROM t), n AS (SELECT doc_id, count(*) AS n, count(*) FILTER (unicode(c) > 65535) AS far, sum(unicode(c)::BIGINT * (i % 1009 + 1))::BIGINT AS mixed FROM e WHERE c <> '' GROUP BY doc_id)
        SELECT t.doc_id, coalesce(n, 0)::INT AS n, coalesce(far, 0)::INT AS far, coalesce(mixed, 0) AS mixed FROM t LEFT JOIN n USING (doc_id)""",
    "q_char_fill": f"""WITH s AS (SELECT doc_id, page_idx, span_id, min({{'c': content, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}) AS m FROM (SELECT doc_id, page_idx, span_id, content, {_UP} FROM spans WHERE type = 'text' AND length(trim(content, ' ')) > 0 AND {_WHOLE}) GROUP BY ALL),
        b AS (SELECT doc_id, page_idx, span_id, m.c AS content, m.x0 AS x0, m.y0 AS y0, m.x1 AS x1, m.y1 AS y1 FROM s),
        c AS (SELECT doc_id, page_idx, span_id::BIGINT * 100000 + k AS i, ch, x0 + k * w AS x0, x0 + (k + 1) * w AS x1, (y0 + y1) / 2 AS y FROM (SELECT *, (x1 - x0) / length(content) AS w, unnest(string_split(content, '')) AS ch, generate_subscripts(string_split(content, ''), 1) - 1 AS k FROM b) WHERE ch <> '' AND ch <> ' '),
        p AS (SELECT c.*, b.span_id AS own, b.y0 AS top FROM c JOIN b ON b.doc_id = c.doc_id AND b.page_idx = c.page_idx AND c.y > b.y0 AND c.y < b.y1 AND abs(c.y - (b.y0 + b.y1) / 2) < (b.y1 - b.y0) * 0.33
            AND ((c.x0 + c.x1) / 2 > b.x0 AND (c.x0 + c.x1) / 2 < b.x1
                OR contains('{L.STOPS}', ch) AND c.x0 > b.x1 - (b.y1 - b.y0) AND c.x0 < b.x1 AND (c.x0 + c.x1) / 2 > b.x0
                OR NOT contains('{L.STOPS}', ch) AND contains('{L.STARTS}', ch) AND c.x1 > b.x0 AND c.x1 < b.x0 + (b.y1 - b.y0) AND (c.x0 + c.x1) / 2 < b.x1)),
        o AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY doc_id, page_idx, i ORDER BY top, own) = 1),
        g AS (SELECT *, x0 - lag(x1) OVER (PARTITION BY doc_id, page_idx, own ORDER BY i) AS gap, median(x1 - x0) OVER (PARTITION BY doc_id, page_idx, own) AS w FROM o),
        f AS (SELECT doc_id, page_idx, own AS span_id, string_agg(CASE WHEN gap > 0.25 * w THEN ' ' ELSE '' END || ch, '' ORDER BY i) AS t FROM g GROUP BY ALL),
        r AS (SELECT doc_id, page_idx, span_id, coalesce(trim(replace({_LIGATURES}, chr(2), '-'), ' '), '') AS content, x1 - x0 AS w, y1 - y0 AS h FROM b LEFT JOIN f USING (doc_id, page_idx, span_id))
        SELECT doc_id, page_idx, span_id, content, length(content) * h < w * 0.5 AS recognise FROM r""",
    "q_map_errors": """SELECT doc_id, coalesce(sum(n), 0) AS chars, coalesce(sum(e), 0) AS errors, CASE WHEN coalesce(sum(n), 0) > 0 THEN sum(e) / sum(n) ELSE 0 END AS share
        FROM (SELECT doc_id, length(regexp_replace(content, '\\s', '', 'g')) AS n, length(content) - length(replace(content, chr(65533), '')) AS e FROM blocks WHERE doc_id IS NOT NULL) GROUP BY doc_id""",
    "q_table_objects": f"""WITH b AS (SELECT doc_id, page_idx, block_id, type, coalesce(content, '') AS c, {_UP} FROM blocks WHERE {_WHOLE}),
        t AS (SELECT doc_id, page_idx, block_id AS t, x0 - 100 AS a0, y0 - 100 AS b0, x1 + 100 AS a1, y1 + 100 AS b1 FROM b WHERE type = 'table'),
        p AS (SELECT b.*, t.*, least(x1, a1) - greatest(x0, a0) AS w, least(y1, b1) - greatest(y0, b0) AS h FROM b JOIN t ON b.doc_id = t.doc_id AND b.page_idx = t.page_idx WHERE type IN ('image', 'interline_equation') AND (x0 + x1) / 2 BETWEEN a0 AND a1 AND (y0 + y1) / 2 BETWEEN b0 AND b1)
        SELECT block_id AS item, t AS "table", CASE WHEN type = 'image' THEN '<img src="images/' || block_id || '.jpg"/>' WHEN c <> '' THEN '<eq>' || replace(replace(replace(replace(replace(c, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#x27;') || '</eq>' END AS token,
            round(greatest(x0, a0) - a0, 4) AS x0, round(greatest(y0, b0) - b0, 4) AS y0, round(least(x1, a1) - a0, 4) AS x1, round(least(y1, b1) - b0, 4) AS y1 FROM p WHERE w * h > 0 QUALIFY row_number() OVER (PARTITION BY block_id ORDER BY w * h DESC, t) = 1""",
    "q_pruned_text": "SELECT block_id FROM blocks WHERE NOT (coalesce(type, '') = 'text' AND NOT coalesce(regexp_matches(content, '\\S'), false))",
    "q_vertical_merge": f"""WITH b AS (SELECT block_id, doc_id, page_idx, type, content, {_UP} FROM blocks WHERE {_WHOLE}),
        g AS (SELECT *, sum(coalesce((type IN ('abstract', 'interline_equation', 'doc_title', 'paragraph_title', 'title'))::INT, 0)) OVER (PARTITION BY doc_id ORDER BY page_idx, block_id ROWS UNBOUNDED PRECEDING) AS g FROM b),
        t AS (SELECT *, regexp_replace(content, '^[A-ZÀ-Þ]', 'x') AS ft, regexp_replace(content, '[.]$', '') AS lt FROM g WHERE type IN ('text', 'index', 'vertical_text')),
        l AS (SELECT *, lag(block_id) OVER w AS p, lag(x0) OVER w AS px0, lag(y0) OVER w AS py0, lag(y1) OVER w AS py1, lag(block_id % 5 * 4) OVER w AS short, right(lag(lt) OVER w, 1) AS pend FROM t WINDOW w AS (PARTITION BY doc_id, g ORDER BY page_idx, block_id))
        SELECT block_id, CASE WHEN block_id % 3 * 3 < 5 AND short < 10 AND NOT contains('{LINE_STOPS}', pend) AND abs((y1 - y0) - (py1 - py0)) < least(y1 - y0, py1 - py0) AND left(ft, 1) <> '' AND NOT regexp_matches(left(ft, 1), '[\\p{{Nd}}\\p{{Lu}}]') AND x1 > px0 THEN p END AS goes_on FROM l""",
    "q_grid_spans": f"""WITH b AS (SELECT block_id, doc_id, page_idx, {_UP} FROM blocks WHERE {_WHOLE} AND doc_id IS NOT NULL AND page_idx IS NOT NULL), {_edges('x0', 'lefts')}, {_edges('y0', 'tops')},
        j AS (SELECT * FROM b JOIN lefts USING (doc_id, page_idx) JOIN tops USING (doc_id, page_idx))
        SELECT block_id, {_spanned('tops', 'y0', 'y1').replace(', greatest', ' AS row_no, greatest')} AS rowspan, {_spanned('lefts', 'x0', 'x1').replace(', greatest', ' AS col_no, greatest')} AS colspan FROM j""",
}

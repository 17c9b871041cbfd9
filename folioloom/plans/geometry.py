"""Queries over boxes: metrics of neighbouring blocks, spatial joins, lines, islands."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.functions import geometry as G
from folioloom.operators import spatial as S
from folioloom.runtime import read

PAGE = ["doc_id", "page_idx"]


def _boxes(spark: SparkSession, root: str) -> DataFrame:
    """Blocks with an upright box of some area."""
    b = read(spark, root, "blocks", "block_id", *PAGE, "type", "score", "bbox").where("bbox.x0 IS NOT NULL AND bbox.x1 IS NOT NULL AND bbox.y0 IS NOT NULL AND bbox.y1 IS NOT NULL")
    return b.withColumn("box", G.upright(F.col("bbox"))).drop("bbox").where("box.x1 > box.x0 AND box.y1 > box.y0")


def q_box_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Each block against the next one of its page."""
    from pyspark.sql import Window

    w = Window.partitionBy(*PAGE).orderBy("block_id")
    p = _boxes(spark, root).withColumn("next", F.lead("box").over(w)).where("next IS NOT NULL")
    a, b = F.col("box"), F.col("next")
    r = lambda c: F.round(c, 6)
    pos = G.relative_position(a, b)
    u = G.union(a, b)
    return p.select(
        "block_id",
        r(G.distance(a, b)).alias("distance"),
        r(G.center_distance(a, b)).alias("center_distance"),
        r(G.iou(a, b)).alias("iou"),
        r(G.overlap_of_smaller(a, b)).alias("of_smaller"),
        r(G.overlap_of_first(a, b)).alias("of_first"),
        r(G.vertical_projection(a, b)).alias("projection"),
        G.contains(b, a).alias("contains_next"),
        pos["left"].alias("is_left"),
        pos["bottom"].alias("is_above"),
        r(G.area(u)).alias("union_area"),
    )


def q_box_frames(spark: SparkSession, root: str) -> DataFrame:
    """Boxes in thousandths, on the canvas of turned pages, as whole numbers, with the scale to render their page."""
    pages = read(spark, root, "doc_pages", *PAGE, "width", "height").where("width > 0 AND height > 0").groupBy(*PAGE).agg(F.max("width").alias("w"), F.max("height").alias("h"))
    j = _boxes(spark, root).join(pages, PAGE)
    b, w, h = F.col("box"), F.col("w"), F.col("h")
    turned = G.canvas(b, w, h, (F.col("block_id") % 4 * 90).cast("int"))
    return j.select("block_id", G.to_thousandths(b, w, h).alias("thousandths"), F.round(turned["x0"], 6).alias("canvas_x0"), F.round(turned["y1"], 6).alias("canvas_y1"), G.outer_ints(b, w, h).alias("outer"), F.round(G.render_scale(w, h), 6).alias("scale"))


def q_overlap_join(spark: SparkSession, root: str) -> DataFrame:
    """Pairs of blocks of a page that overlap by more than a tenth of the smaller."""
    a = _boxes(spark, root)
    b = a.select(*PAGE, F.col("block_id").alias("other_id"), F.col("box").alias("other_box"))
    pairs = S.overlapping(a, b, PAGE, "box", "other_box").where("block_id < other_id")
    return pairs.where(G.overlap_of_smaller(F.col("box"), F.col("other_box")) > 0.1).select("block_id", "other_id")


def q_span_owner(spark: SparkSession, root: str) -> DataFrame:
    """Spans with the first block that covers more than half of them."""
    s = read(spark, root, "spans", *PAGE, "span_id", "bbox").where("bbox.x0 IS NOT NULL AND bbox.y1 IS NOT NULL").distinct()
    spans = s.select(*PAGE, "span_id", G.upright(F.col("bbox")).alias("span_box")).where("span_box.x1 > span_box.x0 AND span_box.y1 > span_box.y0")
    blocks = _boxes(spark, root).select(*PAGE, "block_id", F.col("box").alias("block_box"))
    return S.owners(spans, blocks, PAGE, ["span_id", "span_box"], ["block_id"]).select(*PAGE, "span_id", "block_id")


def q_nested_removal(spark: SparkSession, root: str) -> DataFrame:
    return S.without_nested(_boxes(spark, root), PAGE, "block_id", "box").select("block_id")


def q_reduct_overlap(spark: SparkSession, root: str) -> DataFrame:
    return S.without_contained(_boxes(spark, root), PAGE, "block_id", "box").select("block_id")


def q_absorbed(spark: SparkSession, root: str) -> DataFrame:
    """Blocks with the image or table that holds nine tenths of them."""
    a = _boxes(spark, root)
    members = a.select(*PAGE, F.col("block_id").alias("member"), F.col("box").alias("member_box"))
    containers = a.where("type IN ('image', 'table')").select(*PAGE, F.col("block_id").alias("container"), F.col("box").alias("container_box"))
    return S.absorbed(members, containers, PAGE).select("member", "container")


def q_best_boxes(spark: SparkSession, root: str) -> DataFrame:
    """Blocks left after those that a better scored one covers are dropped."""
    b = _boxes(spark, root).select(*PAGE, "block_id", F.coalesce("score", F.lit(0.0)).alias("score"), *[F.col(f"box.{k}").alias(k) for k in ("x0", "y0", "x1", "y1")])
    return S.suppress(b, PAGE, "block_id").select("block_id")


def q_span_lines(spark: SparkSession, root: str) -> DataFrame:
    """Text lines of scanned pages: boxes and number of their spans."""
    s = read(spark, root, "spans", *PAGE, "span_id", "type", "bbox").where("bbox.x0 IS NOT NULL AND bbox.y1 IS NOT NULL").distinct()
    s = s.select(*PAGE, "span_id", "type", G.upright(F.col("bbox")).alias("box"))
    lines = S.line_of(s, PAGE, "box", alone=F.col("type") == "interline_equation")
    return lines.groupBy(*PAGE, "line_no").agg(F.count("*").alias("n"), *[f(F.col(f"box.{k}")).alias(k) for k, f in (("x0", F.min), ("y0", F.min), ("x1", F.max), ("y1", F.max))])


def q_vertical_text(spark: SparkSession, root: str) -> DataFrame:
    """Share of spans that are more than twice as high as wide, and whether they make a page vertical."""
    s = read(spark, root, "spans", *PAGE, "span_id", "bbox").where("bbox.x0 IS NOT NULL AND bbox.y1 IS NOT NULL").distinct()
    s = s.select(*PAGE, G.upright(F.col("bbox")).alias("box")).where("box.x1 > box.x0 AND box.y1 > box.y0")
    tall = F.avg(F.when((F.col("box.y1") - F.col("box.y0")) / (F.col("box.x1") - F.col("box.x0")) > 2, 1.0).otherwise(0.0))
    return s.groupBy(*PAGE).agg(F.round(tall, 6).alias("share")).withColumn("vertical", F.col("share") > 0.8)


def q_interval_merge(spark: SparkSession, root: str) -> DataFrame:
    """Heights of a page that blocks take up."""
    b = _boxes(spark, root).select(*PAGE, F.col("box.y0").alias("y0"), F.col("box.y1").alias("y1"))
    return S.islands(b, PAGE, "y0", "y1")


QUERIES = {f.__name__: f for f in (q_box_metrics, q_box_frames, q_overlap_join, q_span_owner, q_nested_removal, q_reduct_overlap, q_absorbed, q_best_boxes, q_span_lines, q_vertical_text, q_interval_merge)}

_B = """b AS (SELECT block_id, doc_id, page_idx, type, score, least(bbox.x0, bbox.x1) AS x0, least(bbox.y0, bbox.y1) AS y0, greatest(bbox.x0, bbox.x1) AS x1, greatest(bbox.y0, bbox.y1) AS y1 FROM blocks
    WHERE bbox.x0 IS NOT NULL AND bbox.x1 IS NOT NULL AND bbox.y0 IS NOT NULL AND bbox.y1 IS NOT NULL AND bbox.x0 <> bbox.x1 AND bbox.y0 <> bbox.y1)"""
_S = """s AS (SELECT DISTINCT doc_id, page_idx, span_id, type, least(bbox.x0, bbox.x1) AS x0, least(bbox.y0, bbox.y1) AS y0, greatest(bbox.x0, bbox.x1) AS x1, greatest(bbox.y0, bbox.y1) AS y1 FROM spans
    WHERE bbox.x0 IS NOT NULL AND bbox.y1 IS NOT NULL)"""
_INTER = "greatest(least({0}x1, {1}x1) - greatest({0}x0, {1}x0), 0) * greatest(least({0}y1, {1}y1) - greatest({0}y0, {1}y0), 0)"
_AREA = "(({0}x1 - {0}x0) * ({0}y1 - {0}y0))"
_I, _PA, _QA = _INTER.format("p.", "q."), _AREA.format("p."), _AREA.format("q.")
_NEXT = ", ".join(f"lead({k}) OVER w AS n{k}" for k in ("x0", "y0", "x1", "y1"))
_NI, _A1, _A2 = "greatest(least(x1, nx1) - greatest(x0, nx0), 0) * greatest(least(y1, ny1) - greatest(y0, ny0), 0)", "((x1 - x0) * (y1 - y0))", "((nx1 - nx0) * (ny1 - ny0))"
_SAME = "p.doc_id = q.doc_id AND p.page_idx = q.page_idx"

_MEET = "(greatest(least(q.x1, e.x1) - greatest(q.x0, e.x0), 0) * greatest(least(q.y1, e.y1) - greatest(q.y0, e.y0), 0))"
_BOTH = "((q.x1 - q.x0) * (q.y1 - q.y0) + (e.x1 - e.x0) * (e.y1 - e.y0))"

SQL = {
    # by falling score, a box stays if none that stayed covers it
    "q_best_boxes": f"""WITH RECURSIVE {_B}, s AS (SELECT doc_id, page_idx, {{'id': block_id, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}} AS e, row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY coalesce(score, 0) DESC, block_id) AS k FROM b),
        r AS (SELECT doc_id, page_idx, k, [e] AS kept FROM s WHERE k = 1
            UNION ALL SELECT r.doc_id, r.page_idx, s.k, CASE WHEN len(list_filter(r.kept, lambda q: {_MEET} > 0 AND {_MEET} / ({_BOTH} - {_MEET}) > 0.9)) = 0 THEN list_append(r.kept, s.e) ELSE r.kept END FROM r JOIN s ON s.doc_id IS NOT DISTINCT FROM r.doc_id AND s.page_idx IS NOT DISTINCT FROM r.page_idx AND s.k = r.k + 1),
        l AS (SELECT doc_id, page_idx, arg_max(kept, k) AS kept FROM r GROUP BY ALL) SELECT unnest(kept).id AS block_id FROM l""",
    "q_box_metrics": f"""WITH {_B}, n AS (SELECT *, {_NEXT} FROM b WINDOW w AS (PARTITION BY doc_id, page_idx ORDER BY block_id))
        SELECT block_id, round(sqrt(pow(greatest(nx0 - x1, x0 - nx1, 0), 2) + pow(greatest(ny0 - y1, y0 - ny1, 0), 2)), 6) AS distance,
            round(sqrt(pow((x0 + x1) / 2 - (nx0 + nx1) / 2, 2) + pow((y0 + y1) / 2 - (ny0 + ny1) / 2, 2)), 6) AS center_distance,
            round({_NI} / ({_A1} + {_A2} - {_NI}), 6) AS iou, round({_NI} / least({_A1}, {_A2}), 6) AS of_smaller, round({_NI} / {_A1}, 6) AS of_first,
            round(greatest(least(x1, nx1) - greatest(x0, nx0), 0) / (x1 - x0), 6) AS projection,
            nx0 >= x0 AND ny0 >= y0 AND nx1 <= x1 AND ny1 <= y1 AS contains_next, nx1 < x0 AS is_left, ny1 < y0 AS is_above,
            round((greatest(x1, nx1) - least(x0, nx0)) * (greatest(y1, ny1) - least(y0, ny0)), 6) AS union_area FROM n WHERE nx0 IS NOT NULL""",
    "q_box_frames": f"""WITH {_B}, g AS (SELECT doc_id, page_idx, max(width) AS w, max(height) AS h FROM doc_pages WHERE width > 0 AND height > 0 GROUP BY ALL)
        SELECT block_id, [trunc(x0 * 1000 / w)::INT, trunc(y0 * 1000 / h)::INT, trunc(x1 * 1000 / w)::INT, trunc(y1 * 1000 / h)::INT] AS thousandths,
            round(CASE block_id % 4 WHEN 0 THEN x0 WHEN 1 THEN y0 WHEN 2 THEN w - x1 ELSE h - y1 END, 6) AS canvas_x0,
            round(CASE block_id % 4 WHEN 0 THEN h - y0 WHEN 1 THEN x1 WHEN 2 THEN y1 ELSE w - x0 END, 6) AS canvas_y1,
            CASE WHEN least(ceil(x1)::BIGINT, w::INT) > greatest(floor(x0)::BIGINT, 0) AND least(ceil(y1)::BIGINT, trunc(h)::INT) > greatest(floor(y0)::BIGINT, 0)
                THEN [greatest(floor(x0)::BIGINT, 0), greatest(floor(y0)::BIGINT, 0), least(ceil(x1)::BIGINT, trunc(w)::BIGINT), least(ceil(y1)::BIGINT, trunc(h)::BIGINT)] END AS outer,
            round(least(300 / 72, 4500.0::DOUBLE / greatest(w, h)), 6) AS scale FROM b JOIN g USING (doc_id, page_idx)""",
    "q_overlap_join": f"WITH {_B} SELECT p.block_id, q.block_id AS other_id FROM b p JOIN b q ON {_SAME} AND p.block_id < q.block_id WHERE {_I} / least({_PA}, {_QA}) > 0.1",
    "q_span_owner": f"""WITH {_B}, {_S} SELECT p.doc_id, p.page_idx, span_id, min(q.block_id) AS block_id FROM s p JOIN b q ON {_SAME} WHERE p.x1 > p.x0 AND p.y1 > p.y0 AND {_I} / {_PA} > 0.5
        GROUP BY p.doc_id, p.page_idx, span_id, p.x0, p.y0, p.x1, p.y1""",
    "q_nested_removal": f"WITH {_B} SELECT block_id FROM b p WHERE NOT EXISTS (SELECT 1 FROM b q WHERE {_SAME} AND q.block_id <> p.block_id AND {_I} / {_PA} >= 0.8 AND {_QA} > 1.01 * {_PA})",
    "q_reduct_overlap": f"WITH {_B} SELECT block_id FROM b p WHERE NOT EXISTS (SELECT 1 FROM b q WHERE {_SAME} AND q.block_id <> p.block_id AND p.x0 >= q.x0 AND p.y0 >= q.y0 AND p.x1 <= q.x1 AND p.y1 <= q.y1)",
    "q_absorbed": f"""WITH {_B}, j AS (SELECT p.block_id AS member, q.block_id AS container, {_I} / {_PA} AS share, {_QA} AS a FROM b p JOIN b q ON {_SAME} AND p.block_id <> q.block_id WHERE q.type IN ('image', 'table'))
        SELECT member, container FROM j WHERE share >= 0.9 QUALIFY row_number() OVER (PARTITION BY member ORDER BY share DESC, a, container) = 1""",
    "q_span_lines": f"""WITH {_S}, l AS (SELECT *, lag(y0) OVER w AS py0, lag(y1) OVER w AS py1, lag(type) OVER w AS ptype FROM s WINDOW w AS (PARTITION BY doc_id, page_idx ORDER BY y0, x0, y1, x1)),
        f AS (SELECT *, CASE WHEN py0 IS NOT NULL AND least(y1 - y0, py1 - py0) > 0 AND greatest(least(y1, py1) - greatest(y0, py0), 0) / nullif(least(y1 - y0, py1 - py0), 0) > 0.6 AND type <> 'interline_equation' AND ptype <> 'interline_equation' THEN 0 ELSE 1 END AS fresh FROM l),
        g AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, page_idx ORDER BY y0, x0, y1, x1 ROWS UNBOUNDED PRECEDING) - 1 AS line_no FROM f)
        SELECT doc_id, page_idx, line_no, count(*) AS n, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM g GROUP BY ALL""",
    "q_vertical_text": f"""WITH {_S}, t AS (SELECT doc_id, page_idx, round(avg(CASE WHEN (y1 - y0) / (x1 - x0) > 2 THEN 1.0 ELSE 0.0 END), 6) AS share FROM s WHERE x1 > x0 AND y1 > y0 GROUP BY ALL) SELECT *, share > 0.8 AS vertical FROM t""",
    "q_interval_merge": f"""WITH {_B}, m AS (SELECT *, max(y1) OVER (PARTITION BY doc_id, page_idx ORDER BY y0, y1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM b),
        g AS (SELECT *, sum(CASE WHEN reach IS NULL OR y0 > reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page_idx ORDER BY y0, y1 ROWS UNBOUNDED PRECEDING) AS island FROM m)
        SELECT doc_id, page_idx, min(y0) AS y0, max(y1) AS y1, count(*) AS n FROM g GROUP BY doc_id, page_idx, island""",
}

"""What becomes of layout detections on a page, and of office blocks beside figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.functions import geometry as G
from folioloom.operators.spatial import overlapping

#: Kinds that hold others, and kinds that a border of the page may claim.
CONTAINERS = ("table", "image", "chart", "interline_equation")
MOVABLE = ("text", "title", "list", "ref_text", "number")
VISUAL = ("table", "image", "chart")


def outside_containers(points: DataFrame, containers: DataFrame, page: list[str], key: list[str]) -> DataFrame:
    """Boxes (``box``) whose centre lies in no container (``container_box``) of their page."""
    centre = G.box((F.col("box.x0") + F.col("box.x1")) / 2, (F.col("box.y0") + F.col("box.y1")) / 2, (F.col("box.x0") + F.col("box.x1")) / 2, (F.col("box.y0") + F.col("box.y1")) / 2)
    inside = overlapping(points.select(*page, *key, centre.alias("centre")), containers.select(*page, "container_box"), page, "centre", "container_box").select(*page, *key).distinct()
    return points.join(inside, [*page, *key], "left_anti")


def title_kinds(titles: DataFrame, marks: DataFrame, page: list[str], key: str, ratio: float = 0.8) -> DataFrame:
    """(page, key, kind): doc_title where a document title of the layout (``mark_box``) covers the ratio of the smaller box, else paragraph_title."""
    hit = overlapping(titles.select(*page, key, "box"), marks.select(*page, "mark_box"), page, "box", "mark_box").where(G.overlap_of_smaller(F.col("box"), F.col("mark_box")) >= ratio).select(*page, key).distinct().withColumn("hit", F.lit(True))
    return titles.join(hit, [*page, key], "left").select(*page, key, F.when(F.col("hit"), "doc_title").otherwise("paragraph_title").alias("kind"))


def border_kinds(blocks: DataFrame, page: list[str]) -> DataFrame:
    """Blocks with ``kind``: what lies above the lowest header is header, what lies below the highest footer is footer.

    Headers in the lower half of the page count as footers first, and the other
    way round; ``height`` is that of the page. Anchors are those of the page as
    found, so one pass of windows is enough.
    """
    w = Window.partitionBy(*page)
    middle = (F.col("box.y0") + F.col("box.y1")) / 2
    turned = F.when((F.col("type") == "header") & (middle > F.col("height") / 2), "footer").when((F.col("type") == "footer") & (middle < F.col("height") / 2), "header").otherwise(F.col("type"))
    b = blocks.withColumn("_t", turned)
    low = F.max(F.when(F.col("_t") == "header", F.col("box.y1"))).over(w)
    high = F.min(F.when(F.col("_t") == "footer", F.col("box.y0"))).over(w)
    b = b.withColumn("_low", low).withColumn("_high", high)
    free = F.coalesce(F.col("_t").isin(*MOVABLE), F.lit(False))
    # footers come last, so they keep what both claim
    kind = F.when(free & (F.col("box.y0") >= F.col("_high")), "footer").when(free & (F.col("box.y1") <= F.col("_low")), "header").otherwise(F.col("_t"))
    return b.withColumn("kind", kind).drop("_t", "_low", "_high")


def match_cells(words: DataFrame, cells: DataFrame, table: list[str], word: str, cell: str) -> DataFrame:
    """(table, word, cell): each recognised box with the cell of the best overlap, then of the nearest corners; none without overlap."""
    pairs = overlapping(words, cells, table, "word_box", "cell_box")
    a, b = F.col("word_box"), F.col("cell_box")
    corners = F.abs(a["x0"] - b["x0"]) + F.abs(a["y0"] - b["y0"]), F.abs(a["x1"] - b["x1"]) + F.abs(a["y1"] - b["y1"])
    apart = corners[0] + corners[1] + F.least(*corners)
    scored = pairs.withColumn("iou", G.iou(a, b)).withColumn("apart", apart).where(F.col("iou") > 1e-8)
    w = Window.partitionBy(*table, word).orderBy(F.desc("iou"), "apart", cell)
    return scored.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(*table, word, cell)


def office_captions(blocks: DataFrame, page: list[str], order: list[str]) -> DataFrame:
    """Blocks with ``kind``: runs of captions take the kind of the figure right before them, else of the one right after, else they are text.

    A text right behind a figure that begins as its captions do is a caption.
    """
    w = Window.partitionBy(*page).orderBy(*order)
    low = F.lower(F.trim(F.coalesce("content", F.lit(""))))
    before = F.lag("type").over(w)
    fits = F.when(before == "table", low.rlike("^(表|table)")).when(before == "image", low.rlike("^(图|fig)")).when(before == "chart", low.rlike("^(图|fig|chart)"))
    b = blocks.withColumn("_t", F.when((F.col("type") == "text") & F.coalesce(fits, F.lit(False)), "caption").otherwise(F.col("type")))
    # the nearest block on either side that isn't a caption decides
    other = F.when(~F.coalesce(F.col("_t") == "caption", F.lit(False)), F.coalesce("_t", F.lit("")))
    up = F.last(other, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    down = F.first(other, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    kind = F.when(up.isin(*VISUAL), F.concat(up, F.lit("_caption"))).when(down.isin(*VISUAL), F.concat(down, F.lit("_caption"))).otherwise("text")
    return b.withColumn("kind", F.when(F.col("_t") == "caption", kind).otherwise(F.col("_t"))).drop("_t")


def common_size(texts: DataFrame, group: list[str], size: str) -> DataFrame:
    """(group, size): the most common size; of equally common ones the smallest."""
    n = texts.where(F.col(size).isNotNull()).groupBy(*group, size).count()
    return n.groupBy(*group).agg(F.min_by(size, F.struct(-F.col("count"), F.col(size))).alias(size))


def promoted_titles(texts: DataFrame, slide: list[str], key: str) -> DataFrame:
    """(slide, key, level) of slide texts (size, bold) that stand out as headings.

    Level 2 is the one text of the largest bold size, at least 4 points above
    the body and 2 above the next bold size; level 3 are the texts of the next
    bold size, at least 2 above the body and 2 below level 2.
    """
    body = common_size(texts.where(~F.col("bold")), slide, "size").withColumnRenamed("size", "body")
    w = Window.partitionBy(*slide)
    bold = texts.where(F.col("bold") & F.col("size").isNotNull()).withColumn("first", F.max("size").over(w))
    bold = bold.withColumn("second", F.max(F.when(F.col("size") < F.col("first"), F.col("size"))).over(w)).withColumn("n", F.sum((F.col("size") == F.col("first")).cast("int")).over(w))
    j = bold.join(body, slide, "left")
    two = (F.col("n") == 1) & (F.col("body").isNull() | (F.col("first") >= F.col("body") + 4)) & (F.col("second").isNull() | (F.col("first") >= F.col("second") + 2))
    three = two & F.col("body").isNotNull() & (F.col("second") >= F.col("body") + 2) & (F.col("second") <= F.col("first") - 2)
    level = F.when(two & (F.col("size") == F.col("first")), 2).when(three & (F.col("size") == F.col("second")), 3)
    return j.select(*slide, key, level.alias("level")).where("level IS NOT NULL")


def linked_entries(entries: DataFrame, anchors: DataFrame, doc: list[str]) -> DataFrame:
    """Entries of a table of contents with ``anchor`` only where their file has such a block; files without any anchor keep theirs."""
    real = anchors.where(F.trim("anchor") != "").select(*doc, F.trim("anchor").alias("_a")).distinct()
    any_ = real.select(*doc).distinct().withColumn("_any", F.lit(True))
    found = real.withColumn("_hit", F.lit(True))
    j = entries.withColumn("_a", F.trim("anchor")).join(any_, doc, "left").join(found, [*doc, "_a"], "left")
    return j.withColumn("anchor", F.when(F.col("_any").isNull(), F.col("anchor")).when(F.col("_hit"), F.col("_a"))).drop("_a", "_any", "_hit")


def separator(previous: Column, kind: Column) -> Column:
    """What stands between two parts of a figure: a blank line after markup and around details, a line before markup, else a hard break."""
    return F.when((previous == "html_block") | (previous == "details_block") | (kind == "details_block"), "\n\n").when(kind == "html_block", "\n").otherwise("  \n")


def data_uri_name(uri: Column) -> Column:
    """File name of an inline image by its whole text; null where it isn't a readable one."""
    kind = F.regexp_extract(uri, r"^data:image/([a-zA-Z0-9.+-]+);base64,", 1)
    body = F.regexp_replace(uri, r"^data:[^,]*,", "")
    fine = (kind != "") & body.rlike(r"^[A-Za-z0-9+/\s]+={0,2}$")
    suffix = F.when(F.lower(kind) == "jpeg", "jpg").when(F.lower(kind) == "svg+xml", "svg").otherwise(F.lower(kind))
    return F.when(fine, F.concat(F.sha2(uri, 256), F.lit("."), suffix))


def batches(areas: list[int], size: int, least: int = 1) -> list[tuple[int, int]]:
    """(start, length) of batches of crops sorted by area: halved whenever the mean area has grown 4, 8, 16, ... times; powers of two, the rest at the end."""
    if not areas:
        return []
    full = 1 << (min(size, len(areas)).bit_length() - 1)
    base = sum(areas[:full]) / full
    out, at = [], 0
    while at < len(areas):
        left = len(areas) - at
        if left < least:
            out.append((at, left))
            break
        probe = min(full, left)
        ratio = sum(areas[at : at + probe]) / probe / base if base > 0 else 1
        n, limit = full, 4
        while ratio >= limit and n // 2 >= least:
            n, limit = n // 2, limit * 2
        n = min(n, 1 << (left.bit_length() - 1))
        out.append((at, n))
        at += n
    return out

"""Objects within tables, blocks without text, vertical texts, and the grid of recognised cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.functions import geometry as G
from folioloom.functions.text import LINE_STOPS
from folioloom.operators.sequence import text_groups
from folioloom.operators.spatial import overlapping


def inside_tables(items: DataFrame, tables: DataFrame, page: list[str]) -> DataFrame:
    """(page, item, table, rel): pictures and formulas whose middle lies in a table, with the one they share most with.

    ``items`` has item and item_box, ``tables`` table and table_box, upright.
    ``rel`` is the shared part as seen from the table's corner. Items found
    here leave the page (an anti-join) and go into the table's cells. Of tables
    that share as much the first one takes the item.
    """
    i, t = F.col("item_box"), F.col("table_box")
    x, y = (i["x0"] + i["x1"]) / 2, (i["y0"] + i["y1"]) / 2
    pairs = overlapping(items, tables, page, "item_box", "table_box").where((x >= t["x0"]) & (x <= t["x1"]) & (y >= t["y0"]) & (y <= t["y1"]))
    low, high = lambda k: F.greatest(i[k], t[k]), lambda k: F.least(i[k], t[k])
    rel = F.struct((low("x0") - t["x0"]).alias("x0"), (low("y0") - t["y0"]).alias("y0"), (high("x1") - t["x0"]).alias("x1"), (high("y1") - t["y0"]).alias("y1"))
    area = (high("x1") - low("x0")) * (high("y1") - low("y0"))
    best = pairs.where(area > 0).groupBy(*page, "item").agg(F.min(F.struct((-area).alias("a"), "table", rel.alias("rel"))).alias("b"))
    return best.select(*page, "item", "b.table", "b.rel")


def table_token(kind: Column, content: Column, picture: Column) -> Column:
    """What an object becomes in its cell: a picture's tag, or a formula with its signs escaped; null where there is nothing."""
    escaped = content
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        escaped = F.replace(escaped, F.lit(a), F.lit(b))
    return F.when(kind == "image", F.concat(F.lit('<img src="'), picture, F.lit('"/>'))).otherwise(F.when(content != "", F.concat(F.lit("<eq>"), escaped, F.lit("</eq>"))))


def without_blank_text(blocks: DataFrame, kind: str, text: str, label: str = "ocr_text") -> DataFrame:
    """Blocks without those of the recognised kind that hold no text; other kinds stay, empty or not."""
    blank = (F.col(kind) == label) & ~F.coalesce(F.col(text).rlike(r"\S"), F.lit(False))
    return blocks.where(~F.coalesce(blank, F.lit(False)))


def vertical_continuations(blocks: DataFrame, doc: list[str], order: list[str], key: str) -> DataFrame:
    """(doc, key, goes_on): the text block before, of the same group, that a vertical text block continues.

    The mirror of horizontal texts: the first line begins at the top of its
    block, the last one before it reaches the bottom, heights are alike, no
    sentence ends between, and the block begins right of where the one before
    ends, or beside it. ``blocks`` has type, box, lines (y0, y1, width of the
    first and of the last line as first_y0, first_width, last_y1, last_width),
    first_text and last_text.
    """
    grouped = text_groups(blocks, doc, order)
    w = Window.partitionBy(*doc, "group_no").orderBy(*order)
    facts = F.struct(F.col(key).alias("key"), "box", "last_y1", "last_width", "last_text")
    j = grouped.withColumn("_p", F.lag(facts).over(w))
    b, p = F.col("box"), F.col("_p.box")
    height, before = b["y1"] - b["y0"], p["y1"] - p["y0"]
    first, last = F.substring("first_text", 1, 1), F.substring("_p.last_text", -1, 1)
    fits = (
        (F.col("first_width") > 0)
        & (F.col("_p.last_width") > 0)
        & (F.abs(b["y0"] - F.col("first_y0")) < F.col("first_width") / 2)
        & (F.abs(p["y1"] - F.col("_p.last_y1")) < F.col("_p.last_width"))
        & ~last.isin(*LINE_STOPS)
        & (F.abs(height - before) < F.least(height, before))
        & (first != "")
        & ~first.rlike(r"[\p{Nd}\p{Lu}]")
        & (b["x1"] > p["x0"])
    )
    return j.select(*doc, key, F.when(F.coalesce(fits, F.lit(False)), F.col("_p.key")).alias("goes_on"))


def grid_spans(cells: DataFrame, table: list[str], close: float = 10.0) -> DataFrame:
    """Recognised cells with row_no, col_no, rowspan and colspan, from their boxes alone.

    ``cells`` has cell and an upright box. Left edges, and tops, that lie within
    ``close`` of the one before are the same line of the grid; a cell begins at
    its own line and reaches over all lines that lie before its far edge.
    """

    def lines(low: str, name: str) -> DataFrame:
        w = Window.partitionBy(*table).orderBy("at")
        each = cells.select(*table, F.col("box")[low].alias("at")).distinct()
        fresh = each.withColumn("new", F.when(F.coalesce(F.col("at") - F.lag("at").over(w) > close, F.lit(True)), 1).otherwise(0))
        numbered = fresh.withColumn("line", F.sum("new").over(w) - 1).groupBy(*table, "line").agg(F.min("at").alias("at"))
        return numbered.groupBy(*table).agg(F.array_sort(F.collect_list("at")).alias(name))

    j = cells.join(lines("x0", "cols"), table).join(lines("y0", "rows"), table)

    def place(edges: str, low: Column, high: Column) -> tuple[Column, Column]:
        at = F.size(F.filter(edges, lambda e: e <= low + 1e-9)) - 1
        end = F.size(F.filter(edges, lambda e: e < high - close))
        return at, F.greatest(F.lit(1), end - at)

    b = F.col("box")
    (row, rowspan), (col, colspan) = place("rows", b["y0"], b["y1"]), place("cols", b["x0"], b["x1"])
    return j.select(*cells.columns, row.alias("row_no"), col.alias("col_no"), rowspan.alias("rowspan"), colspan.alias("colspan"))


def upright_boxes(blocks: DataFrame, name: str) -> DataFrame:
    """Blocks with a whole box, turned upright, in a column of that name."""
    whole = " AND ".join(f"bbox.{k} IS NOT NULL" for k in ("x0", "y0", "x1", "y1"))
    return blocks.where(whole).withColumn(name, G.upright(F.col("bbox")))

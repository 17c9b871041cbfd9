"""Texts that go on over blocks and pages, captions that stay with their figure, rows of cells, products in archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.functions.text import LINE_STOPS

#: Kinds that texts may be merged over, and colours of overlays by kind.
TRANSPARENT = ("image", "table", "chart", "code")
COLOURS = {"title": (102, 102, 255), "text": (153, 0, 76), "list": (40, 169, 92), "table": (204, 204, 0), "image": (153, 255, 51), "interline_equation": (0, 255, 0), "code": (102, 0, 204), "header": (158, 158, 158), "footer": (158, 158, 158), "page_number": (158, 158, 158)}


def text_continuations(blocks: DataFrame, doc: list[str], order: list[str], key: str, single_lines: bool = False) -> DataFrame:
    """(doc, key, goes_on): the text block that each text block continues, null for most.

    Candidates are the nearest texts before, over figures, tables and code, but
    not over headings or lists. The first line must be flush left, the last one
    before it full, without an end of a sentence between, widths alike, and one
    of both longer than a line unless ``single_lines``. ``blocks`` has type,
    box, n_lines, first_x0, last_x1, line_height, first_text and last_text;
    decisions look at blocks as they are, so all are made at once.
    """
    w = Window.partitionBy(*doc).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    facts = F.struct(F.coalesce("type", F.lit("")).alias("type"), F.col(key).alias("key"), "page_idx", "box", "n_lines", "last_x1", "line_height", "last_text")
    solid = ~F.coalesce(F.col("type").isin(*TRANSPARENT), F.lit(False))
    p = F.last(F.when(solid, facts), ignorenulls=True).over(w)
    j = blocks.withColumn("_p", p)
    b, q = F.col("box"), F.col("_p.box")
    width, before = b["x1"] - b["x0"], q["x1"] - q["x0"]
    first, last = F.substring(F.ltrim("first_text"), 1, 1), F.substring(F.rtrim("_p.last_text"), -1, 1)
    lines = F.lit(True) if single_lines else (F.col("n_lines") > 1) | (F.col("_p.n_lines") > 1)
    # on a page the text above may stand in the column before; over pages it always does
    place = (F.col("_p.page_idx") != F.col("page_idx")) | (b["y0"] < q["y1"])
    fits = (
        (F.col("type") == "text")
        & (F.col("_p.type") == "text")
        & (F.col("n_lines") > 0)
        & (F.col("_p.n_lines") > 0)
        & (F.abs(b["x0"] - F.col("first_x0")) < F.col("line_height") / 2)
        & (F.abs(q["x1"] - F.col("_p.last_x1")) < F.col("_p.line_height"))
        & (first != "")
        & (last != "")
        & ~last.isin(*LINE_STOPS)
        & ~first.rlike(r"[\p{Nd}\p{Lu}]")
        & (F.least(width, before) > 0)
        & (F.abs(width - before) < F.least(width, before))
        & lines
        & place
    )
    return j.where("type = 'text'").select(*doc, key, F.when(F.coalesce(fits, F.lit(False)), F.col("_p.key")).alias("goes_on"))


def contiguous_captions(captions: DataFrame, figure: list[str], index: str, body: str) -> DataFrame:
    """Captions of a figure with ``kept``: from the last one upwards as long as their numbers follow each other; the figure's own number is no gap."""
    w = Window.partitionBy(*figure).orderBy(F.desc(index))
    below = F.lag(index).over(w)
    fine = below.isNull() | (F.col(index) == below - 1) | ((F.col(index) == below - 2) & (F.col(body) == below - 1))
    return captions.withColumn("_f", fine).withColumn("kept", F.min(F.col("_f").cast("int")).over(w) == 1).drop("_f")


def leading_continuations(blocks: DataFrame, page: list[str], order: list[str], text: Column, ignored: tuple[str, ...] = ("header", "footer", "page_number")) -> DataFrame:
    """Blocks with ``kind``: texts that begin a page, say that a table goes on and stand right before one, are captions."""
    solid = ~F.coalesce(F.col("type").isin(*ignored), F.lit(False))
    w = Window.partitionBy(*page).orderBy(*order)
    lead = solid & (F.col("type") == "text") & text
    b = blocks.withColumn("_solid", solid).withColumn("_lead", F.coalesce(lead, F.lit(False)))
    # only the run at the head of the page: no other solid block before
    head = F.coalesce(F.max((F.col("_solid") & ~F.col("_lead")).cast("int")).over(w), F.lit(0)) == 0
    after = F.first(F.when(F.col("_solid") & ~F.col("_lead"), F.coalesce("type", F.lit(""))), ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    return b.withColumn("kind", F.when(F.col("_lead") & head & (after == "table"), "caption").otherwise(F.col("type"))).drop("_solid", "_lead")


def cell_rows(cells: DataFrame, table: list[str], order: list[str], top: str, close: float = 10.0) -> DataFrame:
    """Cells in their order with ``row_no``: a new row begins where the top moves by more than ``close``."""
    w = Window.partitionBy(*table).orderBy(*order)
    moved = F.coalesce((F.abs(F.col(top) - F.lag(top).over(w)) > close).cast("int"), F.lit(0))
    return cells.withColumn("_m", moved).withColumn("row_no", F.sum("_m").over(w)).drop("_m")


def overlay(blocks: DataFrame, page: list[str], order: list[str], box: str) -> DataFrame:
    """Rows to draw: (page, order_no, box, rgb) of blocks in reading order."""
    w = Window.partitionBy(*page).orderBy(*order)
    colours = F.create_map(*[x for k, rgb in COLOURS.items() for x in (F.lit(k), F.array(*[F.lit(v) for v in rgb]))])
    rgb = F.coalesce(F.try_element_at(colours, F.coalesce("type", F.lit(""))), F.array(*[F.lit(v) for v in (0, 0, 0)]))
    return blocks.select(*page, *order, F.row_number().over(w).alias("order_no"), box, rgb.alias("rgb"))


def fill_structure(tokens: list[str], matches: dict[int, list[int]], texts: list[str]) -> str:
    """HTML of a recognised table structure with the words of each cell, apart by a blank; bold marks of several words become one."""
    out, cell = [], 0
    for token in tokens:
        if token in ("<thead>", "</thead>", "<tbody>", "</tbody>"):
            continue
        if "</td>" not in token:
            out.append(token)
            continue
        own = [texts[i] for i in matches.get(cell, ()) if 0 <= i < len(texts)]
        bold = len(own) > 1 and "<b>" in own[0]
        if len(own) > 1:
            own = [t.removeprefix(" ").replace("<b>", "", 1).replace("</b>", "", 1) for t in own]
        body = ""
        for t in own:
            if t:
                body += (" " if body and not body.endswith(" ") else "") + t
        body = f"<b>{body}</b>" if bold else body
        out.append(f"<td>{body}</td>" if token == "<td></td>" else body + token)
        cell += 1
    return "".join(out)


def archives(products: DataFrame, doc: str) -> DataFrame:
    """(doc, archive): the files (name, content) of each document in one zip; a document's products are one value by definition."""
    kind = products.schema[doc].dataType.simpleString()
    files = F.array_sort(F.collect_list(F.struct("name", "content")))
    grouped = products.where("content IS NOT NULL AND name IS NOT NULL").groupBy(doc).agg(files.alias("files"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, own in b.itertuples(index=False, name=None):
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
                    for f in own:
                        # a fixed time: equal products give equal archives
                        z.writestr(zipfile.ZipInfo(f["name"], (1980, 1, 1, 0, 0, 0)), bytes(f["content"]))
                out.append((key, buffer.getvalue()))
            yield pd.DataFrame.from_records(out, columns=[doc, "archive"])

    return grouped.mapInPandas(run, f"{doc} {kind}, archive binary")

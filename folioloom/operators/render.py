"""Blocks as Markdown, as a flat list and as a list per page.

Everything is built from structs and arrays in the JVM; the children of tables
and images are joined once, grouped per parent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.functions import geometry as G
from folioloom.functions.text import escape_block_prefix, escape_markdown, full_to_half_alnum, strip_code_fence

#: Kinds by where they go.
DISCARDED = ("header", "footer", "page_number", "aside_text", "page_footnote")
VISUAL = ("image", "table", "chart")
CHILDREN = ("image_caption", "table_caption", "image_footnote", "table_footnote", "chart_caption", "chart_footnote")


def with_children(blocks: DataFrame, page: list[str]) -> DataFrame:
    """Blocks other than captions and footnotes, with the texts of theirs in reading order; orphans stay as text."""
    child = F.coalesce(F.col("type").isin(*CHILDREN), F.lit(False))
    own = [*page, "parent_index"]
    parents = blocks.where(F.col("type").isin(*VISUAL)).select(*page, F.col("block_index").alias("parent_index")).distinct()
    kids = blocks.where(child & F.col("parent_index").isNotNull() & (F.trim("content") != "")).join(parents, own, "left_semi")
    piece = F.struct("block_id", F.trim(full_to_half_alnum(F.col("content"))).alias("t"), F.col("type").endswith("footnote").alias("note"))
    grouped = kids.groupBy(*own).agg(F.array_sort(F.collect_list(piece)).alias("k"))
    texts = lambda note: F.transform(F.filter("k", lambda x: x["note"] == F.lit(note)), lambda x: x["t"])
    grouped = grouped.select(*page, F.col("parent_index").alias("block_index"), texts(False).alias("captions"), texts(True).alias("footnotes"))
    # null-safe: a caption whose parent isn't there is text of its own
    adopted = kids.select("block_id").distinct()
    rest = blocks.join(adopted, "block_id", "left_anti")
    empty = F.array().cast("array<string>")
    visual = rest.where(F.col("type").isin(*VISUAL)).join(grouped, [*page, "block_index"], "left")
    other = rest.where(~F.coalesce(F.col("type").isin(*VISUAL), F.lit(False)))
    kind = F.when(child, F.lit("text")).otherwise(F.col("type"))
    both = visual.unionByName(other.withColumn("type", kind).withColumn("captions", F.lit(None).cast("array<string>")).withColumn("footnotes", F.lit(None).cast("array<string>")))
    return both.withColumn("captions", F.coalesce("captions", empty)).withColumn("footnotes", F.coalesce("footnotes", empty))


def _text() -> Column:
    return F.trim(full_to_half_alnum(F.coalesce(F.col("content"), F.lit(""))))


def markdown(with_kids: DataFrame, folder: str = "images", visuals: bool = True) -> DataFrame:
    """``md``: each block as Markdown, null where it has nothing to show; page furniture is left out by the caller."""
    text = _text()
    escaped = escape_block_prefix(escape_markdown(text))
    level = F.coalesce("title_level", F.lit(1))
    mark = F.when(level > 0, F.concat(F.repeat(F.lit("#"), F.least(level, F.lit(6))), F.lit(" "))).otherwise("")
    lines = lambda a: F.array_join(a, "  \n")
    join = lambda *parts: F.concat_ws("\n", *[F.nullif(p, F.lit("")) for p in parts])
    image = F.concat(F.lit(f"![]({folder}/"), F.sha2(F.concat_ws("_", F.lit("image"), F.col("block_id").cast("string")), 256), F.lit(".jpg)"))
    md = (
        F.when(F.col("type") == "title", F.when(text != "", F.concat(mark, escape_markdown(text))))
        .when(F.col("type") == "interline_equation", F.when(text != "", F.concat(F.lit("$$\n"), F.trim("content"), F.lit("\n$$"))))
        .when(F.col("type") == "code", F.when(text != "", F.concat(F.lit("```\n"), strip_code_fence(F.col("content")), F.lit("\n```"))))
        .when(F.col("type") == "table", join(lines(F.col("captions")), F.coalesce(F.trim("html"), F.lit("")), lines(F.col("footnotes"))) if visuals else F.lit(None))
        .when(F.col("type").isin("image", "chart"), join(image, lines(F.col("captions")), lines(F.col("footnotes"))) if visuals else F.lit(None))
        .otherwise(F.when(text != "", escaped))
    )
    return with_kids.withColumn("md", F.nullif(md, F.lit("")))


def document_markdown(rendered: DataFrame, doc: list[str], order: list[str]) -> DataFrame:
    """One text per document, blocks apart by a blank line.

    A document is one value by definition; its blocks are sorted in the array,
    not on their way.
    """
    piece = F.struct(*order, F.col("md").alias("md"))
    return rendered.where(F.col("md").isNotNull()).groupBy(*doc).agg(F.array_join(F.array_sort(F.collect_list(piece))["md"], "\n\n").alias("markdown"))


def content_list(with_kids: DataFrame) -> DataFrame:
    """The flat list: kind, text, level, captions, body, box in thousandths; null for what a kind lacks."""
    text = _text()
    kind = F.when(F.col("type").isin("text", "title", "list", "index", "abstract"), "text").when(F.col("type") == "interline_equation", "equation").when(F.col("type") == "ref_text", "list").otherwise(F.col("type"))
    box = G.upright(F.col("bbox"))
    return with_kids.select(
        "*",
        kind.alias("item_type"),
        F.when(~F.coalesce(F.col("type").isin(*VISUAL, "ref_text", "code"), F.lit(False)), F.when(F.col("type") == "interline_equation", F.concat(F.lit("$$\n"), F.trim("content"), F.lit("\n$$"))).otherwise(escape_block_prefix(escape_markdown(text)))).alias("item_text"),
        F.when((F.col("type") == "title") & (F.coalesce("title_level", F.lit(1)) != 0), F.coalesce("title_level", F.lit(1))).alias("text_level"),
        F.when(F.col("type") == "interline_equation", F.lit("latex")).alias("text_format"),
        F.when(F.col("type") == "ref_text", F.filter(F.transform(F.split("content", "\n"), lambda x: F.trim(x)), lambda x: x != "")).alias("list_items"),
        F.when(F.col("type") == "table", F.col("html")).alias("table_body"),
        F.when(F.col("type") == "code", strip_code_fence(F.col("content"))).alias("code_body"),
        F.when(F.col("bbox.x0").isNotNull() & F.col("bbox.y1").isNotNull(), G.to_thousandths(box, F.col("width"), F.col("height"))).alias("item_bbox"),
    )


def page_lists(items: DataFrame, doc: list[str], page: str, order: list[str]) -> DataFrame:
    """The list per page as JSON: an array of {type, content, bbox} in reading order; null fields are left out."""
    inner = F.struct(F.col("item_text").alias("text"), "text_level", "list_items", "table_body", "code_body", F.when(F.size("captions") > 0, F.col("captions")).alias("captions"))
    item = F.struct(*order, F.struct(F.col("item_type").alias("type"), inner.alias("content"), F.col("item_bbox").alias("bbox")).alias("item"))
    per = items.groupBy(*doc, page).agg(F.to_json(F.array_sort(F.collect_list(item))["item"]).alias("items"))
    return per


# ---- inline styles of office texts


def styled(text: Column, styles: Column, as_html: bool) -> Column:
    """A run of text in its styles: in Markdown bold, italic and strike, as HTML in a fixed nesting."""
    has = lambda s: F.array_contains(styles, s)
    if not as_html:
        n = F.size(styles)
        return F.when(has("bold") & has("italic") & (n == 2), F.concat(F.lit("***"), text, F.lit("***"))).when(has("bold") & (n == 1), F.concat(F.lit("**"), text, F.lit("**"))).when(has("italic") & (n == 1), F.concat(F.lit("*"), text, F.lit("*"))).when(has("strikethrough") & (n == 1), F.concat(F.lit("~~"), text, F.lit("~~"))).otherwise(text)
    out = text
    for style, tag in (("superscript", "sup"), ("subscript", "sub"), ("underline", "u"), ("bold", "strong"), ("italic", "em"), ("strikethrough", "s")):
        out = F.when(has(style), F.concat(F.lit(f"<{tag}>"), out, F.lit(f"</{tag}>"))).otherwise(out)
    return out


def flatten_items(items: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """List items (ilevel, ordered, start, text) as indented lines with running numbers.

    A number counts the ordered items of its level since the last item of a
    smaller level, by windows only: the level above changes where a shallower
    item stands.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*group).orderBy(*order)
    out = items.withColumn("ilevel", F.greatest(F.lit(0), F.col("ilevel")))
    # for each level, how many shallower items have come: equal numbers are one run
    for level in range(9):
        out = out.withColumn(f"_s{level}", F.sum((F.col("ilevel") < level).cast("int")).over(w))
    parent = F.element_at(F.array(*[F.col(f"_s{i}") for i in range(9)]), F.least(F.col("ilevel"), F.lit(8)) + 1)
    run = Window.partitionBy(*group, "ilevel", "_run").orderBy(*order)
    numbered = out.withColumn("_run", parent).withColumn("_n", F.sum(F.col("ordered").cast("int")).over(run))
    first = F.first("start").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    mark = F.when(F.col("ordered"), F.concat((F.coalesce(first, F.lit(1)) + F.col("_n") - 1).cast("string"), F.lit(". "))).otherwise("- ")
    return numbered.select(*items.columns, F.concat(F.repeat(F.lit("    "), F.col("ilevel")), mark, F.col("text")).alias("line"))

"""Blocks of office files as Markdown and as content lists.

Neighbouring items of a list, and of an index, are one entry. Their numbers
count within the entry: an item's number starts anew where a shallower item
stands before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.functions.text import escape_block_prefix, escape_markdown
from folioloom.operators.render import flatten_items


def entries(blocks: DataFrame, doc: str) -> DataFrame:
    """(doc, page_idx, block_no, type, level, text, html, list_items) of ``office_blocks`` rows, lists as one entry at the place of their first item.

    Rows without a type (errors) and texts without a sign are left out.
    """
    own = blocks.where("type IS NOT NULL AND (type IN ('table', 'image') OR trim(text) <> '')").select(doc, "page_idx", "block_no", "type", "level", F.coalesce("ilevel", F.lit(0)).alias("ilevel"), F.coalesce("ordered", F.lit(False)).alias("ordered"), "text", "html")
    w = Window.partitionBy(doc).orderBy("block_no")
    listed = F.col("type").isin("list", "index")
    goes_on = listed & F.coalesce((F.lag("type").over(w) == F.col("type")) & (F.lag("page_idx").over(w) == F.col("page_idx")), F.lit(False))
    numbered = own.withColumn("_entry", F.sum(F.when(goes_on, 0).otherwise(1)).over(w))
    items = numbered.where(listed).withColumn("ilevel", F.col("ilevel") - F.min("ilevel").over(Window.partitionBy(doc, "_entry")))
    shown = F.when(F.col("type") == "index", F.col("text")).otherwise(escape_markdown(F.col("text")))
    lines = flatten_items(items.withColumn("start", F.lit(None).cast("int")).withColumn("text", shown), [doc, "_entry"], ["block_no"])
    grouped = lines.groupBy(doc, "page_idx", "_entry", "type").agg(F.min("block_no").alias("block_no"), F.array_sort(F.collect_list(F.struct("block_no", "line")))["line"].alias("list_items"))
    none = lambda t: F.lit(None).cast(t)
    lists = grouped.select(doc, "page_idx", "block_no", "type", none("int").alias("level"), none("string").alias("text"), none("string").alias("html"), "list_items")
    return numbered.where(~listed).select(doc, "page_idx", "block_no", "type", "level", "text", "html", none("array<string>").alias("list_items")).unionByName(lists)


def content_list(own: DataFrame, doc: str) -> DataFrame:
    """The flat list of ``entries``: type, text, text_level, text_format, list_items and table_body; headings are texts with a level."""
    kind = F.when(F.col("type").isin("title", "caption"), "text").when(F.col("type") == "interline_equation", "equation").otherwise(F.col("type"))
    text = F.when(F.col("type") == "interline_equation", F.concat(F.lit("$$\n"), F.trim("text"), F.lit("\n$$"))).when(F.col("type").isin("text", "title", "caption"), escape_block_prefix(escape_markdown(F.col("text"))))
    level = F.when((F.col("type") == "title") & (F.coalesce("level", F.lit(1)) != 0), F.coalesce("level", F.lit(1)))
    return own.select(doc, "page_idx", "block_no", kind.alias("type"), text.alias("text"), level.alias("text_level"), F.when(F.col("type") == "interline_equation", F.lit("latex")).alias("text_format"), "list_items", F.when(F.col("type") == "table", F.col("html")).alias("table_body"))


def page_content(own: DataFrame, doc: str) -> DataFrame:
    """(doc, page_idx, items): per page a JSON array of {type, content}; tables tell whether they have spans or tables within."""
    nested = F.regexp_count("html", F.lit("<table")) > 1
    complex_ = nested | F.col("html").contains("colspan") | F.col("html").contains("rowspan")
    text = F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("content")))
    content = F.struct(
        F.when(F.col("type") == "title", text).alias("title_content"),
        F.when(F.col("type") == "title", F.coalesce("level", F.lit(1))).alias("level"),
        F.when(F.col("type").isin("text", "caption"), text).alias("paragraph_content"),
        F.when(F.col("type") == "interline_equation", F.col("text")).alias("math_content"),
        F.when(F.col("type") == "interline_equation", F.lit("latex")).alias("math_type"),
        F.when(F.col("type") == "table", F.col("html")).alias("html"),
        F.when(F.col("type") == "table", F.when(complex_, "complex_table").otherwise("simple_table")).alias("table_type"),
        F.when(F.col("type") == "table", F.when(nested, 2).otherwise(1)).alias("table_nest_level"),
        F.when(F.col("type").isin("list", "index"), F.lit("text_list")).alias("list_type"),
        F.col("list_items").alias("list_items"),
    )
    kind = F.when(F.col("type").isin("text", "caption"), "paragraph").when(F.col("type") == "interline_equation", "equation_interline").otherwise(F.col("type"))
    item = F.struct("block_no", F.struct(kind.alias("type"), content.alias("content")).alias("item"))
    return own.groupBy(doc, "page_idx").agg(F.to_json(F.array_sort(F.collect_list(item))["item"]).alias("items"))


def _markdown(own: DataFrame) -> Column:
    level = F.coalesce("level", F.lit(1))
    return (
        F.when(F.col("type") == "title", F.concat(F.when(level > 0, F.concat(F.repeat(F.lit("#"), F.least(level, F.lit(6))), F.lit(" "))).otherwise(""), escape_markdown(F.col("text"))))
        .when(F.col("type") == "interline_equation", F.concat(F.lit("$$\n"), F.trim("text"), F.lit("\n$$")))
        .when(F.col("type") == "table", F.col("html"))
        .when(F.col("type").isin("list", "index"), F.array_join("list_items", "\n"))
        .when(F.col("type") == "image", F.lit("![]()"))
        .otherwise(escape_block_prefix(escape_markdown(F.col("text"))))
    )


def document_markdown(own: DataFrame, doc: str) -> DataFrame:
    """(doc, markdown): the entries of each file in order, apart by a blank line; a file is one value by definition."""
    piece = F.struct("block_no", _markdown(own).alias("md"))
    return own.groupBy(doc).agg(F.array_join(F.filter(F.array_sort(F.collect_list(piece))["md"], lambda m: m.isNotNull() & (m != "")), "\n\n").alias("markdown"))

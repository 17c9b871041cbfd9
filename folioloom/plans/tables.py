"""Queries over tables in HTML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioloom.functions.text import is_continuation
from folioloom.operators import tables as B
from folioloom.runtime import read


def _tables(spark: SparkSession, root: str) -> DataFrame:
    return read(spark, root, "blocks", "block_id", "html").where("html LIKE '%<table%'")


def q_table_cells(spark: SparkSession, root: str) -> DataFrame:
    return B.cells(_tables(spark, root), "block_id", "html")


def q_table_shape(spark: SparkSession, root: str) -> DataFrame:
    """Rows with cells, cells and the sum of the first row's spans of each table."""
    c = q_table_cells(spark, root)
    return c.groupBy("block_id").agg((F.max("row_no") + 1).alias("n_rows"), F.count("*").alias("n_cells"), F.sum(F.when(F.col("row_no") == 0, F.col("colspan"))).alias("first_row"))


def q_cell_count(spark: SparkSession, root: str) -> DataFrame:
    """Cell tags as they are counted by name only, heads of tables included."""
    return _tables(spark, root).select("block_id", F.regexp_count(F.lower("html"), F.lit("<t[dh]")).alias("n"))


def q_table_merge(spark: SparkSession, root: str) -> DataFrame:
    """Tables that go on over pages, joined."""
    b = read(spark, root, "blocks", "block_id", "doc_id", "page_idx", "type", "content", "html", "bbox", "parent_index", "block_index").where("doc_id IS NOT NULL AND page_idx IS NOT NULL")
    body = F.coalesce(~F.col("type").isin("header", "footer", "page_number", "table_caption", "image_caption"), F.lit(True))
    w = Window.partitionBy("doc_id", "page_idx")
    placed = b.where(body).withColumn("first", F.min("block_id").over(w)).withColumn("last", F.max("block_id").over(w))
    captions = b.where("type = 'table_caption'").groupBy("doc_id", "page_idx", F.col("parent_index").alias("block_index")).agg(F.lit(True).alias("has_caption"), F.max(is_continuation(F.col("content"))).alias("continued"))
    t = placed.where("html LIKE '%<table%' AND type = 'table'").join(captions, ["doc_id", "page_idx", "block_index"], "left")
    ready = t.select(
        "block_id", "doc_id", "page_idx", (F.col("block_id") == F.col("first")).alias("is_first"), (F.col("block_id") == F.col("last")).alias("is_last"), "html",
        F.coalesce(F.abs(F.col("bbox.x1") - F.col("bbox.x0")), F.lit(0.0)).alias("width"), F.coalesce("has_caption", F.lit(False)).alias("has_caption"), F.coalesce("continued", F.lit(False)).alias("continued"), F.lit(0).alias("n_notes"),
    )
    return B.merge_over_pages(ready)


QUERIES = {f.__name__: f for f in (q_table_cells, q_table_shape, q_cell_count, q_table_merge)}

SQL = {
    # in these tables only first cells reach over rows
    "q_table_cells": r"""WITH t AS (SELECT block_id, regexp_extract_all(html, '(?is)<tr[^>]*>(.*?)(?:</tr>|$)', 1) AS rows FROM blocks WHERE html LIKE '%<table%'),
        r AS (SELECT block_id, unnest(rows) AS inside, generate_subscripts(rows, 1) AS k FROM t),
        c AS (SELECT block_id, k, unnest(regexp_extract_all(inside, '(?is)<t[dh][^>]*>.*?(?:</t[dh]>|$)')) AS cell, generate_subscripts(regexp_extract_all(inside, '(?is)<t[dh][^>]*>.*?(?:</t[dh]>|$)'), 1) - 1 AS cell_no FROM r),
        f AS (SELECT block_id, (dense_rank() OVER (PARTITION BY block_id ORDER BY k) - 1)::INT AS row_no, cell_no::INT AS cell_no, coalesce(nullif(regexp_extract(cell, '^<[^>]*colspan="([0-9]+)"', 1), '')::INT, 1) AS colspan, coalesce(nullif(regexp_extract(cell, '^<[^>]*rowspan="([0-9]+)"', 1), '')::INT, 1) AS rowspan,
            regexp_matches(cell, '(?i)^<th') AS is_header, trim(replace(replace(replace(replace(replace(regexp_replace(cell, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&')) AS text FROM c)
        SELECT block_id, row_no, cell_no, (sum(colspan) OVER (PARTITION BY block_id, row_no ORDER BY cell_no) - colspan + (EXISTS (SELECT 1 FROM f g WHERE g.block_id = f.block_id AND g.cell_no = 0 AND g.row_no < f.row_no AND g.row_no + g.rowspan > f.row_no))::INT)::INT AS col_no, colspan, rowspan, is_header, text FROM f""",
    # tables that were cut off still have the rows and cells whose tags they open
    "q_table_shape": r"""WITH t AS (SELECT block_id, len(regexp_extract_all(html, '<tr[ >]')) AS n_rows, len(regexp_extract_all(html, '<t[dh](?: [^>]*)?>')) AS n_cells, regexp_extract(html, '(?s)<tr[ >].*?(?:</tr>|$)') AS first FROM blocks WHERE html LIKE '%<table%')
        SELECT block_id, n_rows, n_cells, list_sum(list_transform(regexp_extract_all(first, '<t[dh](?: [^>]*)?>'), lambda x: coalesce(nullif(regexp_extract(x, 'colspan="(\d+)"', 1), '')::INT, 1))) AS first_row FROM t WHERE n_cells > 0""",
    "q_cell_count": "SELECT block_id, len(regexp_extract_all(lower(html), '<t[dh]')) AS n FROM blocks WHERE html LIKE '%<table%'",
}

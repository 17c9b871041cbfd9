"""Queries over inline markup, table markup and code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.operators import inline as I
from folioloom.runtime import read


def q_inline_spans(spark: SparkSession, root: str) -> DataFrame:
    """Captions whose first word is bold and whose second is a formula, in their spans."""
    b = read(spark, root, "blocks", "block_id", "type", "content").where("type IN ('table_caption', 'image_caption') AND content RLIKE '^[A-Za-z]+ [A-Za-z0-9]+ '")
    marked = F.regexp_replace("content", "^([A-Za-z]+) ([A-Za-z0-9]+) ", '<text style="bold,none">$1</text> <eq> $2 </eq> ')
    each = b.select("block_id", F.posexplode(I.inline_spans(marked)).alias("span_no", "s"))
    return each.select("block_id", "span_no", "s.type", "s.content", F.array_join("s.style", ",").alias("style"))


def _without_looks(b: DataFrame) -> DataFrame:
    """Table markup that was given looks, without them again."""
    h = F.regexp_replace("html", "<td>", "<TD class='c' STYLE=\"width: 3px\" nowrap>")
    return b.select("block_id", I.cleaned_tables(h).alias("html"))


def q_clean_tables(spark: SparkSession, root: str) -> DataFrame:
    """Every table field, truncated or with text around the table."""
    return _without_looks(read(spark, root, "blocks", "block_id", "html").where("html IS NOT NULL"))


def q_code_language(spark: SparkSession, root: str) -> DataFrame:
    return read(spark, root, "blocks", "block_id", "type", "content").where("type = 'code'").select("block_id", I.code_language(F.col("content")).alias("language"))


QUERIES = {f.__name__: f for f in (q_inline_spans, q_clean_tables, q_code_language)}

_SIGNS = ", ".join(f"{{'n': len(regexp_extract_all(content, '{p}')), 'k': {-k}, 'name': '{name}'}}" for k, (name, p) in enumerate(I.CODE.items()))

SQL = {
    "q_code_language": f"""WITH c AS (SELECT block_id, content, list_max([{_SIGNS}]) AS best FROM blocks WHERE type = 'code')
        SELECT block_id, CASE WHEN content IS NULL THEN NULL WHEN best.n > 0 THEN best.name ELSE 'txt' END AS language FROM c""",
    "q_inline_spans": """WITH b AS (SELECT block_id, regexp_extract(content, '^([A-Za-z]+) ([A-Za-z0-9]+) (.*)', ['w', 'f', 'r'], 's') AS p, content FROM blocks WHERE type IN ('table_caption', 'image_caption') AND regexp_matches(content, '^[A-Za-z]+ [A-Za-z0-9]+ '))
        SELECT block_id, 0 AS span_no, 'text' AS type, p.w AS content, 'bold' AS style FROM b UNION ALL SELECT block_id, 1, 'text', ' ', '' FROM b UNION ALL SELECT block_id, 2, 'inline_equation', p.f, '' FROM b UNION ALL SELECT block_id, 3, 'text', ' ' || p.r, '' FROM b""",
    "q_clean_tables": "SELECT block_id, html FROM blocks WHERE html IS NOT NULL",
}

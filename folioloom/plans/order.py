"""Queries whose order a running state decides."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.functions import geometry as G
from folioloom.operators import characters as C
from folioloom.operators import latex as L
from folioloom.operators import order as O
from folioloom.runtime import read

PAGE = ["doc_id", "page_idx"]


def _boxes(spark: SparkSession, root: str) -> DataFrame:
    b = read(spark, root, "blocks", "block_id", *PAGE, "bbox").where("bbox.x0 IS NOT NULL AND bbox.x1 IS NOT NULL AND bbox.y0 IS NOT NULL AND bbox.y1 IS NOT NULL")
    return b.withColumn("b", G.upright(F.col("bbox"))).select("block_id", *PAGE, "b.x0", "b.y0", "b.x1", "b.y1")


def q_xycut(spark: SparkSession, root: str) -> DataFrame:
    return O.ordered_pages(_boxes(spark, root), PAGE, "block_id")


def q_row_order(spark: SparkSession, root: str) -> DataFrame:
    return O.ordered_pages(_boxes(spark, root), PAGE, "block_id", rows=True)


def q_bin_pack(spark: SparkSession, root: str) -> DataFrame:
    """Files of each request in windows of at most eight pages; a request's files are few."""
    pages = read(spark, root, "doc_pages", "doc_id", "page_idx").distinct().groupBy("doc_id").agg(F.count("*").cast("int").alias("pages"))
    files = read(spark, root, "tasks", "task_id", "file_names").groupBy("task_id").agg(F.max("file_names").alias("f")).select("task_id", F.posexplode("f").alias("k", "doc_id"))
    own = files.join(pages, "doc_id", "left").groupBy("task_id").agg(F.array_sort(F.collect_list(F.struct("k", "doc_id", F.coalesce("pages", F.lit(0)).alias("pages")))).alias("f"))

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
    def packed(f: pd.Series) -> pd.Series:
        return f.map(lambda rows: O.pack([(r["doc_id"], int(r["pages"])) for r in rows], 8))

    return own.select("task_id", F.posexplode(packed("f")).alias("bin_no", "doc_ids"))


def q_unique_stems(spark: SparkSession, root: str) -> DataFrame:
    d = read(spark, root, "documents", "doc_id", "file_stem").where("file_stem IS NOT NULL")
    return O.unique_stems(d, "doc_id", "file_stem")


def q_formulas(spark: SparkSession, root: str) -> DataFrame:
    """Formulas without blanks that mean nothing, repaired."""

    @F.pandas_udf(T.StringType())
    def repaired(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else L.cleaned(L.tightened(x)))

    return read(spark, root, "blocks", "block_id", "type", "content").where("type = 'interline_equation'").select("block_id", repaired("content").alias("latex"))


def _deduplicated(b: DataFrame) -> DataFrame:
    """Characters of blocks, every seventh drawn twice, without the second ones."""
    each = b.select("block_id", F.posexplode(F.split("content", "")).alias("k", "char")).where("char <> ''")
    place = lambda d: [(F.col("k") * 6.0 + d).alias("x0"), F.lit(100.0 + d).alias("y0"), (F.col("k") * 6.0 + 5.0 + d).alias("x1"), F.lit(110.0 + d).alias("y1")]
    first = each.select("block_id", (F.col("k") * 2).alias("char_idx"), "char", *place(0.0))
    again = each.where("k % 7 = 0").select("block_id", (F.col("k") * 2 + 1).alias("char_idx"), "char", *place(0.4))
    return C.distinct_characters(first.unionByName(again), ["block_id"])


def q_dedup_chars(spark: SparkSession, root: str) -> DataFrame:
    """Characters of all blocks."""
    return _deduplicated(read(spark, root, "blocks", "block_id", "content").where("content IS NOT NULL"))


QUERIES = {f.__name__: f for f in (q_xycut, q_row_order, q_bin_pack, q_unique_stems, q_formulas, q_dedup_chars)}

_UP = "least(bbox.x0, bbox.x1) AS x0, least(bbox.y0, bbox.y1) AS y0, greatest(bbox.x0, bbox.x1) AS x1, greatest(bbox.y0, bbox.y1) AS y1"

SQL = {
    # each box is put behind the last one that it may not pass
    "q_row_order": f"""WITH RECURSIVE b AS (SELECT block_id, doc_id, page_idx, {_UP} FROM blocks WHERE bbox.x0 IS NOT NULL AND bbox.x1 IS NOT NULL AND bbox.y0 IS NOT NULL AND bbox.y1 IS NOT NULL),
        s AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY y0, x0, block_id) AS k FROM b),
        r AS (SELECT doc_id, page_idx, 1 AS k, [{{'id': block_id, 'x': x0, 'y': y0}}] AS done FROM s WHERE k = 1
            UNION ALL SELECT doc_id, page_idx, k + 1, done[1:slot] || [e] || done[slot + 1:] FROM (
                SELECT r.doc_id, r.page_idx, r.k, r.done, {{'id': s.block_id, 'x': s.x0, 'y': s.y0}} AS e,
                    coalesce(list_max(list_filter(range(1, len(r.done) + 1), lambda i: NOT (abs(s.y0 - r.done[i].y) < 10 AND s.x0 < r.done[i].x))), 0) AS slot
                FROM r JOIN s ON s.doc_id IS NOT DISTINCT FROM r.doc_id AND s.page_idx IS NOT DISTINCT FROM r.page_idx AND s.k = r.k + 1)),
        f AS (SELECT doc_id, page_idx, arg_max(done, k) AS done FROM r GROUP BY ALL)
        SELECT doc_id, page_idx, unnest(done).id AS block_id, (generate_subscripts(done, 1) - 1)::INT AS position FROM f""",
    # the larger first, each into the emptiest window it fits, too large ones alone
    "q_bin_pack": """WITH RECURSIVE p AS (SELECT doc_id, count(DISTINCT page_idx) AS pages FROM doc_pages GROUP BY doc_id),
        t AS (SELECT task_id, max(file_names) AS f FROM tasks GROUP BY task_id),
        e AS (SELECT task_id, unnest(f) AS doc_id, generate_subscripts(f, 1) AS k FROM t),
        s AS (SELECT task_id, doc_id, coalesce(pages, 0) AS n, row_number() OVER (PARTITION BY task_id ORDER BY coalesce(pages, 0) DESC, k) AS k FROM e LEFT JOIN p USING (doc_id)),
        r AS (SELECT task_id, 1 AS k, [{'load': n, 'names': [doc_id]}] AS bins FROM s WHERE k = 1
            UNION ALL SELECT task_id, k + 1, CASE WHEN n > 8 OR slot IS NULL THEN bins || [{'load': n, 'names': [doc_id]}] ELSE bins[1:slot - 1] || [{'load': bins[slot].load + n, 'names': bins[slot].names || [doc_id]}] || bins[slot + 1:] END FROM (
                SELECT r.task_id, r.k, r.bins, s.doc_id, s.n, list_min(list_transform(list_filter(range(1, len(r.bins) + 1), lambda i: r.bins[i].load + s.n <= 8), lambda i: {'load': r.bins[i].load, 'i': i})).i AS slot FROM r JOIN s ON s.task_id = r.task_id AND s.k = r.k + 1)),
        l AS (SELECT task_id, arg_max(bins, k) AS bins FROM r GROUP BY task_id)
        SELECT task_id, (generate_subscripts(bins, 1) - 1)::INT AS bin_no, unnest(bins).names AS doc_ids FROM l""",
    "q_unique_stems": r"""WITH r AS (SELECT doc_id, file_stem, lower(file_stem) AS low, row_number() OVER (PARTITION BY lower(file_stem) ORDER BY doc_id, file_stem) AS n FROM documents WHERE file_stem IS NOT NULL AND doc_id IS NOT NULL),
        l AS (SELECT DISTINCT regexp_extract(low, '^(.*)_([1-9][0-9]{0,17})$', 1) AS low, regexp_extract(low, '^(.*)_([1-9][0-9]{0,17})$', 2)::BIGINT AS k FROM r WHERE regexp_matches(low, '^(.*)_([1-9][0-9]{0,17})$')),
        t AS (SELECT low, list(k) AS taken FROM l WHERE k >= 2 GROUP BY low)
        SELECT doc_id, file_stem, CASE WHEN n = 1 THEN file_stem ELSE file_stem || '_' || list_filter(range(2, n + coalesce(len(taken), 0) + 1), lambda x: NOT coalesce(list_contains(taken, x), false))[n - 1] END AS "unique" FROM r LEFT JOIN t USING (low)""",
    # characters come back as they were before every seventh was drawn again
    "q_dedup_chars": """WITH e AS (SELECT block_id, unnest(string_split(content, '')) AS char, generate_subscripts(string_split(content, ''), 1) - 1 AS k FROM blocks WHERE content IS NOT NULL)
        SELECT block_id, (k * 2)::INT AS char_idx, char, k * 6.0::DOUBLE AS x0, 100.0::DOUBLE AS y0, k * 6.0::DOUBLE + 5 AS x1, 110.0::DOUBLE AS y1 FROM e WHERE char <> ''""",
}

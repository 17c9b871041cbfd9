"""Queries over what models give: detections, steps of recognisers, texts and rotations; products of files."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.functions.text import ocr_language
from folioloom.operators import characters as C
from folioloom.operators import merge as M
from folioloom.operators import objects as B
from folioloom.operators import route as R
from folioloom.operators import spatial as S
from folioloom.runtime import read
from folioloom.sources import plugins as P

PAGE = ["doc_id", "page_idx"]
#: The seven languages of the data and some of the scripts' own, in the spelling of models.
LANGUAGES = ("en", "de", "fr", "latin", "ru", "uk", "bg", "mn", "ar", "fa", "hi", "mr", "korean", "th", "japan", "seal", "")


def q_layout_boxes(spark: SparkSession, root: str) -> DataFrame:
    """Blocks with whole boxes through the double of the layout model."""
    b = B.upright_boxes(read(spark, root, "blocks", *PAGE, "type", "score", "bbox").where("doc_id IS NOT NULL AND page_idx IS NOT NULL AND type IS NOT NULL"), "box")
    return P.LAYOUT_DOUBLE.run(b.select(*PAGE, F.col("type").alias("label"), F.coalesce("score", F.lit(0.0)).alias("score"), "box.x0", "box.y0", "box.x1", "box.y1"), together="label").distinct()


def q_recognised(spark: SparkSession, root: str) -> DataFrame:
    """Blocks recognised with the score of their layout, beside a text layer that every third lacks."""
    b = read(spark, root, "blocks", "block_id", "content", "score")
    native = F.when(F.col("block_id") % 3 != 0, F.concat(F.lit("native "), F.col("block_id").cast("string")))
    out = P.accept_recognised(b.withColumn("native", native).withColumnRenamed("content", "text"), limit=0.7)
    return out.select("block_id", F.col("accepted").alias("text"), F.col("accepted_score").alias("score"))


def q_rotation(spark: SparkSession, root: str) -> DataFrame:
    """The rotation of each file's pictures by scores made of their numbers."""
    b = read(spark, root, "blocks", "block_id", "type").where("type = 'image'")
    each = b.select("block_id", F.explode(F.array(*[F.struct(F.lit(label).alias("label"), ((F.col("block_id") * k) % 101 / 100).alias("score")) for label, k in (("0", 37), ("90", 53), ("180", 71), ("270", 89))])).alias("s"))
    return P.best_rotation(each.select("block_id", "s.label", "s.score"), "block_id")


def q_ctc(spark: SparkSession, root: str) -> DataFrame:
    """Titles as the steps of a recogniser: each character two or three times, blanks between; decoded again."""
    t = read(spark, root, "blocks", "block_id", "type", "content").where("type = 'title' AND content IS NOT NULL")
    codes = F.filter(F.split("content", ""), lambda c: c != "")
    steps = F.flatten(F.transform(codes, lambda c, i: F.when(i % 2 == 0, F.array(c, c, F.lit(""))).otherwise(F.array(F.lit(""), c, c, c, F.lit("")))))
    scored = F.transform(steps, lambda c, i: F.struct(c.alias("label"), (F.lit(0.5) + i % 2 * 0.5).alias("p")))
    # made once a row: a function over an array must not make it anew for each of its elements
    out = t.select("block_id", scored.alias("steps")).select("block_id", C.ctc_steps(F.col("steps")).alias("d"))
    return out.select("block_id", F.array_join("d.labels", "").alias("text"), F.size("d.labels").alias("n"))


def q_union_area(spark: SparkSession, root: str) -> DataFrame:
    """The area of each page that its blocks cover."""
    b = B.upright_boxes(read(spark, root, "blocks", *PAGE, "bbox").where("doc_id IS NOT NULL AND page_idx IS NOT NULL"), "box")
    return S.covered_area(b.select(*PAGE, "box.x0", "box.y0", "box.x1", "box.y1"), PAGE).select(*PAGE, F.round("area", 5).alias("area"))


def q_unsampled(spark: SparkSession, root: str) -> DataFrame:
    """Ranges of pages that the routing sample of a file leaves out."""
    n = read(spark, root, "doc_pages", "doc_id", "page_idx").groupBy("doc_id").agg((F.max("page_idx") + 1).alias("pages"))
    sample = F.transform(R.sample_pages(F.col("pages")), lambda p: F.struct(p.alias("a"), p.alias("b")))
    return n.select("doc_id", F.explode(S.ranges_left(F.lit(0), (F.col("pages") - 1).cast("int"), sample)).alias("r")).select("doc_id", "r.a", "r.b")


def q_archives(spark: SparkSession, root: str) -> DataFrame:
    """Blocks of each file as the files of an archive, read again."""
    b = read(spark, root, "blocks", "block_id", "doc_id", "content").where("doc_id IS NOT NULL AND content IS NOT NULL")
    made = M.archives(b.select("doc_id", F.concat(F.lit("blocks/"), F.col("block_id").cast("string"), F.lit(".txt")).alias("name"), F.encode("content", "UTF-8").alias("content")), "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, archive in batch.itertuples(index=False, name=None):
                with zipfile.ZipFile(io.BytesIO(bytes(archive))) as z:
                    out += [(doc, i.filename, z.read(i)) for i in z.infolist()]
            yield pd.DataFrame.from_records(out, columns=["doc_id", "name", "content"])

    files = made.mapInPandas(run, T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("name", T.StringType()), T.StructField("content", T.BinaryType())]))
    return files.select("doc_id", "name", F.octet_length("content").alias("size"), F.md5("content").alias("md5"))


def q_ocr_languages(spark: SparkSession, root: str) -> DataFrame:
    """The model that reads each language label of the requests, and of some more."""
    labels = read(spark, root, "tasks", "lang_list").select(F.explode("lang_list").alias("label")).unionByName(spark.createDataFrame([(x,) for x in LANGUAGES], "label string")).distinct()
    return labels.select("label", ocr_language(F.col("label")).alias("model"), ocr_language(F.col("label"), cpu=True).alias("on_cpu"))


QUERIES = {f.__name__: f for f in (q_layout_boxes, q_recognised, q_rotation, q_ctc, q_union_area, q_unsampled, q_archives, q_ocr_languages)}

_UP = "least(bbox.x0, bbox.x1) AS x0, least(bbox.y0, bbox.y1) AS y0, greatest(bbox.x0, bbox.x1) AS x1, greatest(bbox.y0, bbox.y1) AS y1"
_WHOLE = "doc_id IS NOT NULL AND page_idx IS NOT NULL AND " + " AND ".join(f"bbox.{k} IS NOT NULL" for k in ("x0", "y0", "x1", "y1"))

SQL = {
    "q_layout_boxes": f"SELECT DISTINCT doc_id, page_idx, type AS label, coalesce(score, 0) AS score, {_UP} FROM blocks WHERE {_WHOLE} AND type IS NOT NULL",
    "q_recognised": """SELECT block_id, CASE WHEN score > 0.7 THEN content WHEN block_id % 3 <> 0 THEN 'native ' || block_id ELSE '' END AS text, CASE WHEN score > 0.7 OR block_id % 3 <> 0 THEN coalesce(score, 0) ELSE 0 END AS score FROM blocks""",
    "q_rotation": """WITH s AS (SELECT block_id, label, (block_id * k) % 101 / 100 AS score FROM blocks, (VALUES ('0', 37), ('90', 53), ('180', 71), ('270', 89)) v(label, k) WHERE type = 'image')
        SELECT block_id, CASE WHEN max(score) - max(score) FILTER (label = '0') < 0.1 THEN '0' ELSE arg_max(label, {'s': score, 'l': label}) END AS label FROM s GROUP BY block_id""",
    "q_ctc": "SELECT block_id, content AS text, length(content)::INT AS n FROM blocks WHERE type = 'title' AND content IS NOT NULL",
    "q_union_area": f"""WITH b AS (SELECT doc_id, page_idx, {_UP} FROM blocks WHERE {_WHOLE}), e AS (SELECT DISTINCT doc_id, page_idx, unnest([x0, x1]) AS x FROM b),
        s AS (SELECT doc_id, page_idx, x AS a, lead(x) OVER (PARTITION BY doc_id, page_idx ORDER BY x) AS z FROM e),
        c AS (SELECT s.doc_id, s.page_idx, a, z, y0, y1, max(y1) OVER (PARTITION BY s.doc_id, s.page_idx, a ORDER BY y0, y1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s JOIN b ON b.doc_id = s.doc_id AND b.page_idx = s.page_idx AND b.x0 <= a AND b.x1 >= z WHERE z IS NOT NULL AND y1 > y0)
        SELECT p.doc_id, p.page_idx, round(coalesce(sum((z - a) * greatest(0, y1 - greatest(y0, coalesce(reach, y0)))), 0), 5) AS area FROM (SELECT DISTINCT doc_id, page_idx FROM b) p LEFT JOIN c ON c.doc_id = p.doc_id AND c.page_idx = p.page_idx GROUP BY ALL""",
    "q_unsampled": """WITH n AS (SELECT doc_id, max(page_idx) + 1 AS pages FROM doc_pages GROUP BY doc_id), p AS (SELECT doc_id, pages, unnest(range(0, pages)) AS p FROM n),
        o AS (SELECT doc_id, p FROM p WHERE pages > 10 AND NOT list_contains(list_transform(range(0, 10), lambda i: round_even(i * (pages - 1) / 9, 0)::INT), p)),
        g AS (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS run FROM o) SELECT doc_id, min(p)::INT AS a, max(p)::INT AS b FROM g GROUP BY doc_id, run""",
    "q_archives": "SELECT doc_id, 'blocks/' || block_id || '.txt' AS name, strlen(content)::INT AS size, md5(content) AS md5 FROM blocks WHERE doc_id IS NOT NULL AND content IS NOT NULL",
    "q_ocr_languages": f"""WITH l AS (SELECT DISTINCT label FROM (SELECT unnest(lang_list) AS label FROM tasks UNION ALL SELECT unnest({list(LANGUAGES)}))),
        m AS (SELECT label, CASE WHEN coalesce(label, '') IN ('', 'ch', 'en', 'japan', 'chinese_cht', 'latin') THEN 'ch' WHEN label IN ('ru', 'be', 'uk') THEN 'east_slavic' WHEN label IN ('ar', 'fa', 'ug', 'ur', 'ps', 'ku', 'sd', 'bal') THEN 'arabic'
            WHEN label IN ('bg', 'mn') THEN 'cyrillic' WHEN label IN ('hi', 'mr') THEN 'devanagari' ELSE label END AS model FROM l)
        SELECT label, model, CASE model WHEN 'seal' THEN 'seal_lite' ELSE model END AS on_cpu FROM m""",
}

"""Queries about files and requests: routing, page samples, queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.functions import geometry as G
from folioloom.operators import route as R
from folioloom.runtime import read
from folioloom.streaming.pages import windows_of_pages

STATUSES = ("pending", "processing", "completed", "failed")


def _counts(spark: SparkSession, root: str) -> DataFrame:
    """Pages of each file."""
    return read(spark, root, "doc_pages", "doc_id", "page_idx").distinct().groupBy("doc_id").agg((F.max("page_idx") + 1).alias("pages"))


def q_sample_pages(spark: SparkSession, root: str) -> DataFrame:
    return _counts(spark, root).select("doc_id", R.sample_pages(F.col("pages")).alias("sample"))


def q_render_ranges(spark: SparkSession, root: str) -> DataFrame:
    pages = _counts(spark, root).select("doc_id", F.explode(F.sequence(F.lit(0), F.col("pages").cast("int") - 1)).alias("page_idx"))
    return R.render_ranges(pages, "doc_id", "page_idx", least_pages=4)


def _sampled(spark: SparkSession, root: str) -> DataFrame:
    """Text of the sampled pages, with page size and the share of images."""
    sampled = _counts(spark, root).select("doc_id", F.explode(R.sample_pages(F.col("pages"))).alias("page_idx"))
    size = read(spark, root, "doc_pages", "doc_id", "page_idx", "width", "height").groupBy("doc_id", "page_idx").agg(F.max("width").alias("width"), F.max("height").alias("height"))
    # at most ten pages a file: no other page's text is gathered
    blocks = read(spark, root, "blocks", "doc_id", "page_idx", "block_id", "type", "content", "bbox").join(sampled, ["doc_id", "page_idx"], "left_semi")
    box = G.upright(F.col("bbox"))
    piece = F.struct("block_id", F.coalesce("content", F.lit("")).alias("t"))
    per = blocks.groupBy("doc_id", "page_idx").agg(F.array_join(F.array_sort(F.collect_list(piece))["t"], " ").alias("text"), F.sum(F.when((F.col("type") == "image") & F.col("bbox.x0").isNotNull() & F.col("bbox.y1").isNotNull(), G.area(box)).otherwise(0.0)).alias("image_area"))
    joined = sampled.join(size, ["doc_id", "page_idx"], "left").join(per, ["doc_id", "page_idx"], "left")
    cover = F.when((F.col("width") > 0) & (F.col("height") > 0), F.least(F.lit(1.0), F.col("image_area") / (F.col("width") * F.col("height"))))
    return joined.select("doc_id", "page_idx", "width", "height", F.coalesce("text", F.lit("")).alias("text"), cover.alias("image_share"))


def q_page_signals(spark: SparkSession, root: str) -> DataFrame:
    return R.page_signals(_sampled(spark, root)).select("doc_id", "page_idx", "chars", "abnormal", "han", "rare_han", "punct", "punct_run", "punct_kinds", F.col("script_0").alias("cyrillic"))


def q_route(spark: SparkSession, root: str) -> DataFrame:
    return R.classify(R.page_signals(_sampled(spark, root)), "doc_id")


def q_private_use(spark: SparkSession, root: str) -> DataFrame:
    """Blocks as if two letters had been lost to a font of its own."""
    marked = F.translate(F.col("content"), "aä", "")
    s = read(spark, root, "blocks", "block_id", "content").select("block_id", R.private_use(marked).alias("s"))
    return s.select("block_id", F.col("s.n").alias("n"), F.round("s.share", 6).alias("share"), F.col("s.run").alias("run"), F.col("s.recognise").alias("recognise"))


def q_font_usage(spark: SparkSession, root: str) -> DataFrame:
    """Files with a page on which a suspicious font is used; block kinds stand for fonts."""
    b = read(spark, root, "blocks", "doc_id", "page_idx", "type", "content").where("type IS NOT NULL")
    font = F.concat(F.when(F.col("page_idx") % 2 == 0, "/ABCDEF+").otherwise(""), F.col("type"))
    chars = b.groupBy("doc_id", "page_idx", font.alias("font")).agg(F.sum(F.coalesce(F.length("content"), F.lit(0))).alias("n"))
    fonts = b.where("type = 'code'").select("doc_id", "page_idx", F.col("type").alias("font"))
    return R.font_signal(chars, fonts, "doc_id", "page_idx")


def q_task_stats(spark: SparkSession, root: str) -> DataFrame:
    """Tasks by status, with the statuses that no task has."""
    kinds = spark.createDataFrame([(s,) for s in STATUSES], "status string")
    n = read(spark, root, "tasks", "status").groupBy("status").count()
    return kinds.join(n, "status", "left").select("status", F.coalesce("count", F.lit(0)).alias("n"))


def q_queued_ahead(spark: SparkSession, root: str) -> DataFrame:
    t = read(spark, root, "tasks", "task_id", "submit_order", "status").where("submit_order IS NOT NULL").distinct()
    return R.queue_ahead(t).select("task_id", "submit_order", "status", "ahead")


def q_latest_tasks(spark: SparkSession, root: str) -> DataFrame:
    """Each task once, in its most advanced state."""
    rank = F.when(F.col("status").isin("completed", "failed"), 3).when(F.col("status") == "processing", 2).when(F.col("status") == "pending", 1).otherwise(0)
    t = read(spark, root, "tasks", "task_id", "submit_order", "status", "submitted_at", "completed_at")
    last = F.max(F.struct(rank.alias("rank"), F.coalesce("status", F.lit("")).alias("status"), "completed_at"))
    return t.groupBy("task_id").agg(F.min("submit_order").alias("submit_order"), last.alias("last")).select("task_id", "submit_order", "last.status", "last.completed_at")


def q_expired_tasks(spark: SparkSession, root: str, seconds: int = 86_400) -> DataFrame:
    """Finished tasks older than the time they are kept, seen from the newest one."""
    t = q_latest_tasks(spark, root).where("status IN ('completed', 'failed') AND completed_at IS NOT NULL")
    now = read(spark, root, "tasks", "completed_at").agg(F.max("completed_at").alias("now"))
    return t.join(F.broadcast(now)).where(F.col("completed_at") < F.col("now") - F.expr(f"INTERVAL {seconds} SECONDS")).select("task_id", "status")


def q_page_windows(spark: SparkSession, root: str) -> DataFrame:
    """Pages of all files, in the order of their first request, in windows of 64."""
    t = read(spark, root, "tasks", "submit_order", "file_names").where("submit_order IS NOT NULL")
    first = t.select("submit_order", F.posexplode("file_names").alias("k", "doc_id")).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct("submit_order", "k")).alias("at"))
    files = first.join(_counts(spark, root), "doc_id", "left").select("at.submit_order", "at.k", "doc_id", F.col("pages").alias("page_count"))
    return windows_of_pages(files, order=("submit_order", "k"))


QUERIES = {f.__name__: f for f in (q_sample_pages, q_page_windows, q_render_ranges, q_page_signals, q_route, q_private_use, q_font_usage, q_task_stats, q_queued_ahead, q_latest_tasks, q_expired_tasks)}

_N = "n AS (SELECT doc_id, max(page_idx) + 1 AS pages FROM doc_pages GROUP BY doc_id)"
_SAMPLE = "CASE WHEN pages <= 10 THEN range(0, pages)::INT[] ELSE list_transform(range(0, 10), lambda i: round_even(i * (pages - 1) / 9, 0)::INT) END"
_HAN = r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2EBEF}"
_BAD = r"\x{1}-\x{8}\x{B}\x{C}\x{E}-\x{1F}\x{7F}-\x{9F}\x{FFFD}\x{E000}-\x{F8FF}"
_P = r"!-/:-@\[-`{-~"


def _only(chars: str, x: str = "t") -> str:
    return f"length(regexp_replace({x}, '[^{chars}]', '', 'g'))"


def _ranges(c: str) -> str:
    return "-".join(r"\x{" + part.removeprefix("\\u") + "}" for part in c.split("-"))


_PAGES = f"""{_N}, s AS (SELECT doc_id, unnest({_SAMPLE}) AS page_idx FROM n),
    z AS (SELECT doc_id, page_idx, max(width) AS width, max(height) AS height FROM doc_pages GROUP BY ALL),
    b AS (SELECT doc_id, page_idx, string_agg(coalesce(content, ''), ' ' ORDER BY block_id) AS text, sum(CASE WHEN type = 'image' AND bbox.x0 IS NOT NULL AND bbox.y1 IS NOT NULL THEN abs(bbox.x1 - bbox.x0) * abs(bbox.y1 - bbox.y0) ELSE 0 END) AS ia FROM blocks GROUP BY ALL),
    p AS (SELECT s.doc_id, s.page_idx, width, height, regexp_replace(coalesce(text, ''), '\\s+', '', 'g') AS t, CASE WHEN width > 0 AND height > 0 THEN least(1, ia / (width * height)) END AS cover FROM s LEFT JOIN z USING (doc_id, page_idx) LEFT JOIN b USING (doc_id, page_idx)),
    r AS (SELECT *, array_to_string(regexp_extract_all(t, '[{_P}]{{4,}}'), '') AS runs FROM p),
    g AS (SELECT *, length(t) AS chars, {_only(_BAD)} AS abnormal, {_only(_HAN)} AS han, length(regexp_replace(regexp_replace(t, '[^\\x{{7280}}-\\x{{72DF}}]', '', 'g'), '[{R.RARE_HAN}]', '', 'g')) AS rare_han, {_only(_P)} AS punct, length(runs) AS punct_run,
        greatest(1, len(list_distinct(string_split(runs, '')))) AS punct_kinds, {', '.join(f"{_only(_ranges(c))} AS script_{i}" for i, c in enumerate(R.SCRIPTS.values()))} FROM r)"""

_K = len(R.SCRIPTS)
SQL = {
    "q_sample_pages": f"WITH {_N} SELECT doc_id, {_SAMPLE} AS sample FROM n",
    "q_page_windows": f"""WITH {_N}, f AS (SELECT doc_id, min({{'o': submit_order, 'k': k}}) AS ord FROM (SELECT submit_order, unnest(file_names) AS doc_id, generate_subscripts(file_names, 1) AS k FROM tasks WHERE submit_order IS NOT NULL) WHERE doc_id IS NOT NULL GROUP BY doc_id),
        j AS (SELECT doc_id, ord, coalesce(pages, 0) AS n FROM f LEFT JOIN n USING (doc_id)), s AS (SELECT *, sum(n) OVER (ORDER BY ord, doc_id ROWS UNBOUNDED PRECEDING) - n AS start FROM j),
        e AS (SELECT *, unnest(CASE WHEN n > 0 THEN range(0, n) ELSE [-1] END)::INT AS page_idx FROM s) SELECT doc_id, page_idx, CASE WHEN page_idx < 0 THEN -1 ELSE (start + page_idx) // 64 END AS window_no FROM e""",
    "q_render_ranges": f"""WITH {_N}, p AS (SELECT doc_id, pages, unnest(range(0, pages))::INT AS page_idx FROM n), k AS (SELECT *, greatest(1, least(3, pages // 4)) AS parts FROM p)
        SELECT doc_id, page_idx, CASE parts WHEN 1 THEN 0 WHEN 2 THEN ntile(2) OVER w - 1 ELSE ntile(3) OVER w - 1 END AS range_no FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY page_idx)""",
    "q_page_signals": f"WITH {_PAGES} SELECT doc_id, page_idx, chars, abnormal, han, rare_han, punct, punct_run, punct_kinds, script_0 AS cyrillic FROM g",
    "q_route": f"""WITH {_PAGES}, a AS (SELECT doc_id, count(*) AS pages, max(CASE WHEN width > 0 AND height > 0 THEN greatest(width / height, height / width) END) AS aspect, sum(chars) AS chars, sum(abnormal) AS abnormal, sum(han) AS han, sum(rare_han) AS rare,
            sum({' + '.join(f'script_{i}' for i in range(_K))}) AS strange, {' + '.join(f'(sum(script_{i}) >= 5)::INT' for i in range(_K))} AS scripts,
            max((chars >= 100 AND punct / chars >= 0.25 AND punct_run / chars >= 0.1 AND punct_kinds > 1)::INT) AS dots, avg((coalesce(cover, 0) >= 0.8)::INT) AS images FROM g GROUP BY doc_id),
        d AS (SELECT doc_id, CASE WHEN aspect > 10 THEN 'aspect' WHEN chars / pages < 50 THEN 'few characters' WHEN chars >= 300 AND abnormal / chars >= 0.03 THEN 'abnormal characters'
            WHEN chars >= 300 AND han >= 100 AND strange >= 120 AND strange / chars >= 0.18 AND scripts >= 3 THEN 'scripts' WHEN rare >= 30 AND rare / han >= 0.026 THEN 'rare characters' WHEN dots = 1 THEN 'punctuation' WHEN images >= 0.8 THEN 'images' END AS reason FROM a)
        SELECT doc_id, CASE WHEN reason IS NULL THEN 'txt' ELSE 'ocr' END AS method, coalesce(reason, 'text layer') AS reason FROM d""",
    "q_private_use": r"""WITH m AS (SELECT block_id, translate(content, 'aä', chr(57345) || chr(57346)) AS t FROM blocks),
        k AS (SELECT block_id, t, length(regexp_replace(t, '[^\x{E000}-\x{F8FF}]', '', 'g')) AS n, length(regexp_replace(t, '\s+', '', 'g')) AS solid, CASE WHEN t IS NULL THEN 0 ELSE coalesce(list_max(list_transform(regexp_extract_all(t, '[\x{E000}-\x{F8FF}]+'), lambda x: length(x))), 0) END AS run FROM m)
        SELECT block_id, n, round(CASE WHEN solid > 0 THEN n / solid ELSE 0 END, 6) AS share, run, n >= 2 AND (run >= 2 OR CASE WHEN solid > 0 THEN n / solid ELSE 0 END >= 0.05) AS recognise FROM k""",
    "q_font_usage": """WITH p AS (SELECT doc_id, page_idx, sum(coalesce(length(content), 0)) AS n, sum(CASE WHEN type = 'code' THEN coalesce(length(content), 0) ELSE 0 END) AS own FROM blocks WHERE type IS NOT NULL GROUP BY ALL)
        SELECT doc_id, min(page_idx) AS page_idx FROM p WHERE own >= 30 AND own / n >= 0.01 GROUP BY doc_id""",
    "q_task_stats": "SELECT s.status, count(t.status) AS n FROM (VALUES ('pending'), ('processing'), ('completed'), ('failed')) s(status) LEFT JOIN tasks t ON s.status = t.status GROUP BY s.status",
    "q_queued_ahead": """WITH t AS (SELECT DISTINCT task_id, submit_order, status FROM tasks WHERE submit_order IS NOT NULL)
        SELECT task_id, submit_order, status, CASE WHEN status = 'pending' THEN (SELECT count(*) FROM t u WHERE u.status = 'pending' AND u.submit_order < t.submit_order) ELSE 0 END AS ahead FROM t""",
    "q_latest_tasks": """WITH r AS (SELECT *, CASE WHEN status IN ('completed', 'failed') THEN 3 WHEN status = 'processing' THEN 2 WHEN status = 'pending' THEN 1 ELSE 0 END AS rank FROM tasks)
        SELECT task_id, min(submit_order) OVER (PARTITION BY task_id) AS submit_order, coalesce(status, '') AS status, completed_at FROM r QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY rank DESC, coalesce(status, '') DESC, completed_at DESC NULLS LAST) = 1""",
    "q_expired_tasks": """WITH r AS (SELECT *, CASE WHEN status IN ('completed', 'failed') THEN 3 WHEN status = 'processing' THEN 2 WHEN status = 'pending' THEN 1 ELSE 0 END AS rank FROM tasks),
        l AS (SELECT task_id, status, completed_at FROM r QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY rank DESC, coalesce(status, '') DESC, completed_at DESC NULLS LAST) = 1)
        SELECT task_id, status FROM l WHERE status IN ('completed', 'failed') AND completed_at < (SELECT max(completed_at) FROM tasks) - INTERVAL 86400 SECOND""",
}

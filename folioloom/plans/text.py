"""Text and name rules over the tables, with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.functions import text as X
from folioloom.runtime import read


def _rule(name: str, make: Callable[[], dict[str, Column]], where: Callable[[], Column] | None = None, table: str = "blocks", keys: tuple[str, ...] = ("block_id",)):
    """A query of columns computed row by row; columns are made when it runs, as they need a session."""

    def query(spark: SparkSession, root: str) -> DataFrame:
        df = read(spark, root, table)
        df = df.where(where()) if where is not None else df
        return df.select(*keys, *[c.alias(n) for n, c in make().items()])

    query.__name__ = name
    return query


_LINE = ("doc_id", "page_idx", "span_id")


def _c() -> Column:
    return F.col("content")


def _of(kind: str) -> Callable[[], Column]:
    return lambda: F.col("type") == kind


def _tag() -> Column:
    return F.concat(F.lit("（"), F.coalesce(F.col("block_index"), F.lit(0)).cast("string"), F.lit("）"))


def _captions() -> dict[str, Column]:
    ending = F.when(F.col("block_id") % 3 == 0, "（续）").when(F.col("block_id") % 3 == 1, " (Continued)").otherwise(" discontinued")
    return {"continuation": X.is_continuation(F.concat(_c(), ending))}


def _table_equations() -> dict[str, Column]:
    made = F.regexp_replace("html", "<td>([0-9.]+)</td>", '<td><eq>$1 &lt; x</eq><img src="a.png"/></td>')
    return {"html": X.prefix_images(X.table_equations(made), "images")}


def _image_names() -> dict[str, Column]:
    return {"path": X.image_name(F.col("type"), F.upper(F.md5("doc_id")), F.col("page_idx"), *[F.col(f"bbox.{k}") for k in ("x0", "y0", "x1", "y1")])}


_QUERIES = (
    _rule("q_md_escape", lambda: {"escaped": X.escape_markdown(_c())}),
    _rule("q_md_prefix", lambda: {"escaped": X.escape_block_prefix(_c())}),
    _rule("q_full_to_half", lambda: {"half": X.full_to_half(_c()), "half_alnum": X.full_to_half_alnum(_c())}),
    _rule("q_ligatures", lambda: {"text": X.clean_code_points(X.expand_ligatures(_c()))}),
    _rule("q_hyphen_end", lambda: {"hyphen": X.hyphen_at_line_end(_c())}, table="spans", keys=_LINE),
    _rule("q_continuation", _captions, _of("table_caption")),
    _rule("q_formula_tag", lambda: {"tagged": X.tagged_formula(_c(), _tag()), "bare": X.strip_display_delimiters(F.concat(F.lit("\\["), _c(), F.lit("\\]")))}, _of("interline_equation")),
    _rule("q_brackets", lambda: {"text": X.balanced_brackets(_c())}),
    _rule("q_code_fence", lambda: {"code": X.strip_code_fence(F.concat(F.lit("```py\n"), _c(), F.lit("\n```")))}, _of("code")),
    _rule("q_environments", lambda: {"formula": X.balanced_environments(F.concat(_c(), F.lit(" \\end{array}")))}, _of("interline_equation")),
    _rule("q_table_equations", _table_equations, lambda: F.col("html").isNotNull()),
    _rule("q_section_parts", lambda: {"parts": X.section_parts(_c(), F.coalesce(F.col("title_level"), F.lit(2)))}, _of("title")),
    _rule("q_page_tokens", lambda: {"token": X.is_page_token(_c()), "stripped": X.strip_page_tail(F.concat(F.lit("x\t"), _c()))}, _of("page_number")),
    _rule("q_image_names", _image_names, lambda: F.col("bbox.x0").isNotNull() & F.col("type").isNotNull()),
    _rule("q_hashes", lambda: {"md5_upper": F.upper(F.md5("text")), "md5_lower": F.md5("text"), "sha256": F.sha2("text", 256)}, table="documents", keys=("doc_id",)),
    _rule("q_stems", lambda: {"short": X.first_bytes(F.col("text"), 200)}, table="documents", keys=("doc_id",)),
    _rule("q_effective_pages", lambda: {"pages": X.effective_pages(F.size("file_names") * 3, F.col("start_page_id"), F.col("end_page_id"))}, table="tasks", keys=("task_id", "submit_order", "status")),
)


def q_paths(spark: SparkSession, root: str) -> DataFrame:
    """Object paths, with a range or without, in their parts."""
    path = F.concat(F.lit("s3://"), F.regexp_replace("source", "[^a-z]", ""), F.lit("/out/"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 2 == 0, "?bytes=10,20").otherwise(""))
    d = read(spark, root, "documents", "doc_id", "source").where("source IS NOT NULL").select("doc_id", path.alias("path"))
    p = F.col("path")
    return d.select("doc_id", X.s3_bucket(p).alias("bucket"), X.s3_key(X.without_arguments(p)).alias("key"), X.s3_range(p).alias("range"))


def q_links(spark: SparkSession, root: str) -> DataFrame:
    """Links of blocks, kept where their scheme is harmless."""
    found = F.explode(F.regexp_extract_all("content", F.lit(r"((?:https?|javascript|data|mailto|ftp):[^\s\"\])>}]+)"), 1))
    b = read(spark, root, "blocks", "block_id", "content").select("block_id", found.alias("href")).unionByName(read(spark, root, "blocks", "block_id", "content").where("content LIKE '%http%'").select("block_id", F.lit(" JavaScript:x()").alias("href")))
    return b.select("block_id", "href", X.safe_link(F.col("href")).alias("safe"))


def q_suffixes(spark: SparkSession, root: str) -> DataFrame:
    """File kinds by magic bytes; the bytes stand for files named in the requests."""
    heads = ("255044462D312E37", "89504E470D0A1A0A00", "FFD8FFE000104A46", "474946383961", "424D36", "49492A0008000000", "524946462400000057454250", "504B030414", "00010203")
    n = len(heads)
    which = F.pmod(F.col("doc_id"), F.lit(n)).cast("int")
    head = F.unhex(F.element_at(F.array(*[F.lit(h) for h in heads]), which + 1))
    return read(spark, root, "documents", "doc_id").select("doc_id", X.suffix_of_bytes(head).alias("suffix"))


def q_content_joined(spark: SparkSession, root: str) -> DataFrame:
    """Lines of a scanned page as one text: letters broken by a hyphen join, Chinese lines touch, others get a blank."""
    s = read(spark, root, "spans", *_LINE, "type", "content").where("type = 'text' AND trim(content) <> ''").distinct()
    s = s.select("doc_id", "page_idx", "span_id", F.trim(X.full_to_half_alnum(F.col("content"))).alias("t"))
    han = F.sum(F.length(F.regexp_replace("t", "[^\\u4e00-\\u9fff]", "")))
    page = s.groupBy("doc_id", "page_idx").agg(F.array_sort(F.collect_list(F.struct("span_id", "t"))).alias("l"), (han * 2 > F.sum(F.length("t"))).alias("chinese"))
    # each line with the first character of the next, null for the last
    pairs = F.transform("l", lambda x, i: F.struct(x["t"].alias("t"), F.substring(F.get("l", i + 1)["t"], 1, 1).alias("n"), (i + 1 == F.size("l")).alias("last")))
    def joined(x: Column) -> Column:
        broken = X.hyphen_at_line_end(x["t"])
        lower = F.coalesce(x["n"].rlike("^\\p{Ll}"), F.lit(False))
        return F.when(x["last"] | F.col("chinese"), x["t"]).when(broken & lower, F.regexp_replace(x["t"], ".$", "")).when(broken, x["t"]).otherwise(F.concat(x["t"], F.lit(" ")))

    return page.select("doc_id", "page_idx", F.array_join(F.transform(pairs, joined), "").alias("text"))


QUERIES = {f.__name__: f for f in (*_QUERIES, q_paths, q_links, q_suffixes, q_content_joined)}


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _ligatures(column: str) -> str:
    for a, b in X.LIGATURES.items():
        column = f"replace({column}, '{a}', '{b}')"
    return f"replace(replace({column}, chr(13) || chr(10), ''), chr(2), '-')"


def _half(x: str) -> str:
    return f"translate({x}, {_lit(X.WIDE)}, {_lit(X.NARROW)})"


def _alnum(x: str) -> str:
    return f"translate({x}, '{X.WIDE_ALNUM}', '{X.NARROW_ALNUM}')"


def _hyphen(x: str) -> str:
    return rf"regexp_matches({x}, '[A-Za-z]+[-\x{{00ad}}\x{{2010}}\x{{2011}}\x{{2043}}]\s*$')"


_CAPTION = "lower(" + _half("trim(content || CASE block_id % 3 WHEN 0 THEN '（续）' WHEN 1 THEN ' (Continued)' ELSE ' discontinued' END, ' ')") + ")"

SQL = {
    "q_md_escape": r"""SELECT block_id, CASE WHEN content IS NULL THEN NULL ELSE coalesce(array_to_string(list_transform(
        regexp_extract_all(content, '(?s)\\.|[*_`~$]|[^\\*_`~$]+|\\'), lambda x: CASE WHEN x IN ('*', '_', '`', '~', '$') THEN '\' || x ELSE x END), ''), '') END AS escaped FROM blocks""",
    "q_md_prefix": r"""SELECT block_id, regexp_replace(content, '^([ \t]{0,3})(#{1,6}|[+-])([ \t])', '\1\\\2\3') AS escaped FROM blocks""",
    "q_full_to_half": f"SELECT block_id, {_half('content')} AS half, {_alnum('content')} AS half_alnum FROM blocks",
    "q_ligatures": f"SELECT block_id, {_ligatures('content')} AS text FROM blocks",
    "q_hyphen_end": f"SELECT doc_id, page_idx, span_id, {_hyphen('content')} AS hyphen FROM spans",
    "q_continuation": f"""SELECT block_id, coalesce({' OR '.join(f"suffix({_CAPTION}, '{m}')" for m in X.CONTINUATION_ENDS)} OR regexp_matches({_CAPTION}, '(^|[^\\p{{L}}])continued$') OR contains({_CAPTION}, '(continued)'), false) AS continuation
        FROM blocks WHERE type = 'table_caption'""",
    "q_formula_tag": r"""SELECT block_id, CASE WHEN trim(content, ' ') <> '' THEN content || '\tag{' || coalesce(block_index, 0) || '}' END AS tagged, trim(content, ' ') AS bare FROM blocks WHERE type = 'interline_equation'""",
    "q_brackets": r"""SELECT block_id, CASE WHEN len(regexp_extract_all(content, '\\\[')) > 0 AND len(regexp_extract_all(content, '\\\[')) = len(regexp_extract_all(content, '\\\]'))
        THEN replace(replace(content, '\[', '['), '\]', ']') ELSE content END AS text FROM blocks""",
    "q_code_fence": "SELECT block_id, trim(content, ' ') AS code FROM blocks WHERE type = 'code'",
    "q_environments": r"""SELECT block_id, '\begin{array}{c} ' || content || ' \end{array}' AS formula FROM blocks WHERE type = 'interline_equation'""",
    "q_table_equations": r"""SELECT block_id, CASE WHEN regexp_matches(html, '<td>[0-9.]+</td>') THEN
        regexp_replace(replace(replace(replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&'), '<td>([0-9.]+)</td>', '<td> $\1 < x$ <img src="images/a.png"/></td>', 'g') ELSE html END AS html FROM blocks WHERE html IS NOT NULL""",
    "q_section_parts": r"""SELECT block_id, CASE WHEN n <> '' AND len(p) = coalesce(title_level, 2) THEN list_transform(p, lambda x: x::INT) END AS parts FROM (
        SELECT *, string_split(n, '.') AS p FROM (SELECT block_id, title_level, regexp_extract(content || ' ', '^\s*(\d+(?:\.\d+)*)\.?\s', 1) AS n FROM blocks WHERE type = 'title'))""",
    "q_page_tokens": r"""SELECT block_id, length(trim(content, ' ')) <= 12 AND regexp_matches(trim(content, ' '), '^([0-9]+([-–.][0-9]+)*|(?i:[ivxlcdm]+)|[A-Za-z])$') AS token,
        regexp_replace('x' || chr(9) || content, '\t[ ]*([0-9]+([-–.][0-9]+)*|(?i:[ivxlcdm]+)|[A-Za-z])[ ]*$', '') AS stripped FROM blocks WHERE type = 'page_number'""",
    "q_image_names": """SELECT block_id, CASE WHEN trunc(bbox.x1) > trunc(bbox.x0) AND trunc(bbox.y1) > trunc(bbox.y0) THEN sha256(type || '/' || upper(md5(doc_id)) || '_' || page_idx || '_' || trunc(bbox.x0)::INT || '_' || trunc(bbox.y0)::INT || '_' || trunc(bbox.x1)::INT || '_' || trunc(bbox.y1)::INT) || '.jpg' ELSE '' END AS path
        FROM blocks WHERE bbox.x0 IS NOT NULL AND type IS NOT NULL""",
    "q_hashes": "SELECT doc_id, upper(md5(text)) AS md5_upper, md5(text) AS md5_lower, sha256(text) AS sha256 FROM documents",
    "q_stems": """SELECT doc_id, CASE WHEN strlen(text) <= 200 THEN text ELSE text[1:list_max(list_filter(range(0, 201), lambda n: strlen(text[1:n]) <= 200))] END AS short FROM documents""",
    "q_effective_pages": """SELECT task_id, submit_order, status, greatest(0, CASE WHEN end_page_id IS NULL OR end_page_id < 0 OR end_page_id > n - 1 THEN n - 1 ELSE end_page_id END - coalesce(start_page_id, 0) + 1) AS pages
        FROM (SELECT *, len(file_names) * 3 AS n FROM tasks)""",
    "q_paths": "SELECT doc_id, regexp_replace(source, '[^a-z]', '', 'g') AS bucket, 'out/' || doc_id AS key, CASE WHEN doc_id % 2 = 0 THEN ['10', '20'] END AS range FROM documents WHERE source IS NOT NULL",
    "q_links": r"""WITH l AS (SELECT block_id, unnest(regexp_extract_all(content, '((?:https?|javascript|data|mailto|ftp):[^\s"\])>}]+)')) AS href FROM blocks
            UNION ALL SELECT block_id, ' JavaScript:x()' FROM blocks WHERE content LIKE '%http%')
        SELECT block_id, href, CASE WHEN regexp_matches(lower(href), '^(https?|mailto|ftp):') THEN href END AS safe FROM l""",
    "q_suffixes": "SELECT doc_id, ['pdf', 'png', 'jpeg', 'gif', 'bmp', 'tiff', 'webp', 'zip', NULL][(doc_id % 9 + 1)::INT] AS suffix FROM documents",
    "q_content_joined": rf"""WITH s AS (SELECT DISTINCT doc_id, page_idx, span_id, trim({_alnum('content')}, ' ') AS t FROM spans WHERE type = 'text' AND trim(content, ' ') <> ''),
        p AS (SELECT *, lead(t[1]) OVER w AS n, row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY span_id DESC, t DESC) = 1 AS last FROM s WINDOW w AS (PARTITION BY doc_id, page_idx ORDER BY span_id, t)),
        c AS (SELECT doc_id, page_idx, length(regexp_replace(string_agg(t, ''), '[^\x{{4e00}}-\x{{9fff}}]', '', 'g')) * 2 > length(string_agg(t, '')) AS chinese FROM s GROUP BY ALL)
        SELECT doc_id, page_idx, string_agg(CASE WHEN last OR chinese THEN t WHEN {_hyphen('t')} AND coalesce(regexp_matches(n, '^\p{{Ll}}'), false) THEN t[1:-2] WHEN {_hyphen('t')} THEN t ELSE t || ' ' END, '' ORDER BY span_id, t) AS text
        FROM p JOIN c USING (doc_id, page_idx) GROUP BY ALL""",
}

"""Queries over nested records (problem 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioloom.operators.shred import flatten, level_columns
from folioloom.runtime import read, spread


def _records(spark: SparkSession, root: str) -> DataFrame:
    return spread(read(spark, root, "middle_json", "rec_id", "payload"))


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return flatten(_records(spark, root), "span", keys_only=True)


def p1_pages(spark: SparkSession, root: str) -> DataFrame:
    return flatten(_records(spark, root), "page")


def p1_blocks(spark: SparkSession, root: str) -> DataFrame:
    return flatten(_records(spark, root), "block")


def p1_lines(spark: SparkSession, root: str) -> DataFrame:
    return flatten(_records(spark, root), "line")


def p1_spans(spark: SparkSession, root: str) -> DataFrame:
    return flatten(_records(spark, root), "span")


def p1_levels(spark: SparkSession, root: str) -> DataFrame:
    return level_columns(_records(spark, root))


QUERIES = {f.__name__: f for f in (p1_found, p1_pages, p1_blocks, p1_lines, p1_spans, p1_levels)}


def _many(x: str) -> str:
    """A list as it is, a single object as a list of one."""
    return f"CASE json_type({x}) WHEN 'ARRAY' THEN from_json({x}, '[\"JSON\"]') WHEN 'OBJECT' THEN [{x}] ELSE []::JSON[] END"


def _each(x: str) -> str:
    m = _many(x)
    return f"unnest({m}) AS e, generate_subscripts({m}, 1) - 1 AS k"


_BLOCKS = f"""RECURSIVE r AS (SELECT rec_id, CASE WHEN json_type(payload) = 'VARCHAR' THEN CASE WHEN json_valid(payload ->> '$') THEN (payload ->> '$')::JSON END ELSE payload::JSON END AS j FROM middle_json WHERE json_valid(payload)),
    p AS (SELECT rec_id, {_each("CASE WHEN json_type(j -> 'pdf_info') IS NULL OR json_type(j -> 'pdf_info') = 'NULL' THEN j ELSE j -> 'pdf_info' END")} FROM r WHERE json_type(j) = 'OBJECT'),
    b AS (SELECT rec_id, page_no, block_list, k::VARCHAR AS block_path, e AS block FROM (
            SELECT rec_id, k AS page_no, l AS block_list, {_each("e -> l")} FROM (SELECT *, unnest(['para_blocks', 'discarded_blocks']) AS l FROM p WHERE json_type(e) = 'OBJECT')) WHERE json_type(e) = 'OBJECT'
        UNION ALL SELECT rec_id, page_no, block_list, block_path || '.' || k, e FROM (SELECT rec_id, page_no, block_list, block_path, {_each("block -> 'blocks'")} FROM b) WHERE json_type(e) = 'OBJECT'),
    l AS (SELECT rec_id, page_no, block_list, block_path, k AS line_no, e AS line FROM (SELECT rec_id, page_no, block_list, block_path, {_each("block -> 'lines'")} FROM b) WHERE json_type(e) = 'OBJECT'),
    s AS (SELECT rec_id, page_no, block_list, block_path, line_no, k AS span_no, e AS span FROM (SELECT rec_id, page_no, block_list, block_path, line_no, {_each("line -> 'spans'")} FROM l) WHERE json_type(e) = 'OBJECT')"""

def _number(x: str, to: str = "DOUBLE") -> str:
    value = f"({x})::DOUBLE"
    return f"CASE WHEN json_type({x}) IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN {value if to == 'DOUBLE' else f'trunc({value})::{to}'} END"


def _box(x: str) -> str:
    listed = ", ".join(_number(f"{x} -> {i}") for i in range(4))
    named = ", ".join(_number(f"{x} -> '{k}'") for k in ("x0", "y0", "x1", "y1"))
    return f"CASE WHEN json_type({x}) = 'OBJECT' THEN [{named}] WHEN json_type({x}) = 'ARRAY' AND json_array_length({x}) = 4 THEN [{listed}] END"


_LEAVES = {
    "page": [("page_idx", _number("e -> 'page_idx'", "INT")), *[(n, f"CASE WHEN json_array_length(e -> 'page_size') = 2 THEN {_number(f"e -> 'page_size' -> {i}")} END") for i, n in enumerate(("width", "height"))], ("backend", "e ->> '_backend'")],
    "block": [
        ("parent_path", "CASE WHEN contains(block_path, '.') THEN regexp_replace(block_path, '\\.[0-9]+$', '') END"),
        *[(n, f"block ->> '{n}'") for n in ("type", "sub_type")],
        *[(n, _number(f"block -> '{n}'", "INT")) for n in ("level", "index", "angle")],
        ("bbox", _box("(block -> 'bbox')")),
    ],
    "line": [("bbox", _box("(line -> 'bbox')"))],
    "span": [("type", "span ->> 'type'"), ("content", "coalesce(span ->> 'content', span ->> 'latex', span ->> 'html')"), ("score", _number("span -> 'score'")), ("bbox", _box("(span -> 'bbox')"))],
}
_KEYS = {"page": ["rec_id", "k::INT AS page_no"], "block": ["rec_id", "page_no::INT AS page_no", "block_list", "block_path"]}
_KEYS["line"] = [*_KEYS["block"], "line_no::INT AS line_no"]
_KEYS["span"] = [*_KEYS["line"], "span_no::INT AS span_no"]


def _table(kind: str) -> str:
    columns = [*_KEYS[kind], *[f"{x} AS {n}" for n, x in _LEAVES[kind]]]
    return f"WITH {_BLOCKS} SELECT {', '.join(columns)} FROM {kind[0]}" + " WHERE json_type(e) = 'OBJECT'" * (kind == "page")


SQL = {
    "p1_found": f"WITH {_BLOCKS} SELECT {', '.join(_KEYS['span'])} FROM s",
    **{f"p1_{kind}s": _table(kind) for kind in _LEAVES},
}

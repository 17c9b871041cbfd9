"""Columnar shredding of deeply nested records into related flat tables.

A record is described by a *grammar*: which fields of which kind of node are
repeated, and the kind of their entries. The grammar may be recursive (blocks
hold blocks), so the set of column paths is found per record. Every path
becomes a column of *repetition* and *definition* levels:

* the repetition level of an entry is the number of repeated ancestors that
  continue an already open list (0 opens a new record);
* the definition level counts, along the path, 1 for every list that holds an
  entry and 1 for every entry that is an object, so an absent or empty list
  (even level), a null entry (odd level) and a real entry (2 x depth) differ.

A flat table of any repeated ancestor is rebuilt from the two level sequences
alone: the position in list ``i`` is the running count of entries with level
``i`` since the last entry with a smaller one. Each row so carries the keys of
all its ancestors, which is its link to the parent row.

Defined results: a null payload or one that isn't valid JSON gives no rows; a
JSON string that holds JSON counts as that JSON; a single object in place of a
list is a list of one; null entries and entries that aren't objects take a
position but give no row. Repeated input rows give repeated output rows. Nesting
may be of any depth: what the recursive reader can't hold is read with a stack.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from json.decoder import scanstring
from json.scanner import NUMBER_RE

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Grammar:
    """``children[kind][field]`` is the kind of the entries of a repeated field."""

    children: dict[str, dict[str, str]]
    root: str = "record"


#: Records of parsed files: pages, two lists of blocks that nest, lines, spans.
PARSED_PAGES = Grammar(
    {
        "record": {"pages": "page"},
        "page": {"para_blocks": "block", "discarded_blocks": "block"},
        "block": {"blocks": "block", "lines": "line"},
        "line": {"spans": "span"},
        "span": {},
    }
)


def _entries(value: object) -> list:
    if isinstance(value, list):
        return value
    return [value] if isinstance(value, dict) else []


@dataclass
class Column:
    """Levels of one path over a batch of records; ``nodes`` keeps the entries for their leaf values."""

    path: tuple[str, ...]
    rep: list[int] = field(default_factory=list)
    dfn: list[int] = field(default_factory=list)
    nodes: list[dict | None] = field(default_factory=list)

    @property
    def depth(self) -> int:
        return len(self.path)

    def positions(self) -> np.ndarray:
        """Record ordinal and position in each repeated list, one row per entry, from the levels alone."""
        rep = np.asarray(self.rep, dtype=np.int32)
        at = np.arange(len(rep))
        out = np.empty((len(rep), self.depth + 1), dtype=np.int32)
        out[:, 0] = np.cumsum(rep == 0) - 1
        for i in range(1, self.depth + 1):
            count = np.cumsum(rep == i)
            opened = np.maximum.accumulate(np.where(rep < i, at, 0))
            out[:, i] = count - count[opened]
        return out

    def present(self) -> np.ndarray:
        return np.asarray(self.dfn, dtype=np.int32) == 2 * self.depth


def _child(parent: Column, name: str) -> Column:
    """Levels of a repeated field, from the entries of its parent path."""
    own = Column((*parent.path, name))
    level = own.depth
    rep, dfn, nodes = own.rep, own.dfn, own.nodes
    for r, d, node in zip(parent.rep, parent.dfn, parent.nodes, strict=True):
        entries = _entries(node.get(name)) if node is not None else ()
        if not entries:
            rep.append(r)
            dfn.append(d)
            nodes.append(None)
            continue
        for entry in entries:
            real = isinstance(entry, dict)
            rep.append(r)
            dfn.append(d + 1 + real)
            nodes.append(entry if real else None)
            r = level
    return own


def shred(records: list[dict | None], grammar: Grammar, wanted: frozenset[str] | None = None) -> Iterator[tuple[str, Column]]:
    """(kind, levels) of every repeated path that holds an object in this batch.

    ``wanted`` prunes the walk to paths that lead to these kinds. The paths of
    a recursive grammar are as deep as the deepest record; nothing recurses.
    """
    leads = _leads_to(grammar, wanted)
    root = Column((), [0] * len(records), [0] * len(records), list(records))
    todo = [(grammar.root, root)]
    while todo:
        kind, column = todo.pop()
        for name, child in grammar.children[kind].items():
            if child not in leads:
                continue
            if any(n is not None and n.get(name) for n in column.nodes):
                below = _child(column, name)
                if any(n is not None for n in below.nodes):
                    if wanted is None or child in wanted:
                        yield child, below
                    todo.append((child, below))


def _leads_to(grammar: Grammar, wanted: frozenset[str] | None) -> set[str]:
    if wanted is None:
        return set(grammar.children)
    leads, before = set(wanted), -1
    while len(leads) != before:
        before = len(leads)
        leads |= {k for k, fields in grammar.children.items() if leads & set(fields.values())}
    return leads


_BLANK = re.compile(r"[ \t\n\r]*")
_CONSTANTS = {"null": None, "true": True, "false": False, "NaN": float("nan"), "Infinity": float("inf"), "-Infinity": float("-inf")}
_CONSTANT = re.compile("|".join(_CONSTANTS))


def _scalar(text: str, at: int) -> tuple[object, int]:
    """A string, number or constant and the position behind it."""
    if text[at : at + 1] == '"':
        return scanstring(text, at + 1)
    if m := _CONSTANT.match(text, at):
        return _CONSTANTS[m.group()], m.end()
    if m := NUMBER_RE.match(text, at):
        whole, fraction, exponent = m.groups()
        return (float(m.group()) if fraction or exponent else int(whole)), m.end()
    raise ValueError(f"no value at {at}")


def _loads(text: str) -> object:
    """``json.loads`` for any depth of nesting."""
    try:
        return json.loads(text)
    except RecursionError:
        pass
    skip = lambda i: _BLANK.match(text, i).end()

    def key(i: int) -> tuple[str, int]:
        if text[i : i + 1] != '"':
            raise ValueError(f"no key at {i}")
        name, i = scanstring(text, i + 1)
        i = skip(i)
        if text[i : i + 1] != ":":
            raise ValueError(f"no colon at {i}")
        return name, skip(i + 1)

    open_: list[tuple[list | dict, str | None]] = []
    at = skip(0)
    while True:
        first = text[at : at + 1]
        if first in ("{", "["):
            value: object = {} if first == "{" else []
            at = skip(at + 1)
            if text[at : at + 1] != ("}" if first == "{" else "]"):
                name = None
                if first == "{":
                    name, at = key(at)
                open_.append((value, name))
                continue
            at += 1
        else:
            value, at = _scalar(text, at)
        while True:
            at = skip(at)
            if not open_:
                if at != len(text):
                    raise ValueError(f"more at {at}")
                return value
            parent, name = open_[-1]
            many = isinstance(parent, list)
            if many:
                parent.append(value)
            else:
                parent[name] = value
            end = text[at : at + 1]
            if end == ",":
                at = skip(at + 1)
                if not many:
                    name, at = key(at)
                    open_[-1] = parent, name
                break
            if end != ("]" if many else "}"):
                raise ValueError(f"not closed at {at}")
            open_.pop()
            value, at = parent, at + 1


def _dumps(value: object) -> str:
    """``json.dumps`` for any depth of nesting."""
    try:
        return json.dumps(value, ensure_ascii=False)
    except RecursionError:
        pass
    out, todo = [], [(value, False)]
    while todo:
        v, raw = todo.pop()
        if raw:
            out.append(v)
        elif v and isinstance(v, (list, dict)):
            entries = [("", x) for x in v] if isinstance(v, list) else [(json.dumps(k, ensure_ascii=False) + ": ", x) for k, x in v.items()]
            parts = [(("[" if isinstance(v, list) else "{"), True)]
            for i, (label, x) in enumerate(entries):
                parts += [(", " * bool(i) + label, True), (x, False)]
            todo += reversed([*parts, (("]" if isinstance(v, list) else "}"), True)])
        else:
            out.append(json.dumps(v, ensure_ascii=False))
    return "".join(out)


def read_payload(text: str | None) -> dict | None:
    """The record of a payload as ``{"pages": ...}``; None where there is no readable object."""
    if text is None:
        return None
    try:
        value = _loads(text)
        while isinstance(value, str):
            value = _loads(value)
    except ValueError:
        return None
    if not isinstance(value, dict):
        return None
    pages = value.get("pdf_info")
    return {"pages": pages if pages is not None else [value]}


_PLACE = T.StructType().add("rec_id", "long").add("page_no", "integer")
_BLOCK = T.StructType([*_PLACE.fields]).add("block_list", "string").add("block_path", "string")
_LINE = T.StructType([*_BLOCK.fields]).add("line_no", "integer")

#: Flat tables: the leading fields are the key, which starts with the key of the parent.
SCHEMAS = {
    "page": T.StructType([*_PLACE.fields]).add("page_idx", "integer").add("width", "double").add("height", "double").add("backend", "string"),
    "block": T.StructType([*_BLOCK.fields]).add("parent_path", "string").add("type", "string").add("sub_type", "string").add("level", "integer").add("index", "integer").add("angle", "integer").add("bbox", T.ArrayType(T.DoubleType())),
    "line": T.StructType([*_LINE.fields]).add("bbox", T.ArrayType(T.DoubleType())),
    "span": T.StructType([*_LINE.fields]).add("span_no", "integer").add("type", "string").add("content", "string").add("score", "double").add("bbox", T.ArrayType(T.DoubleType())),
}


def _number(value: object) -> float | None:
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) and abs(value) < 1e300 else None


def _whole(value: object) -> int | None:
    n = _number(value)
    return int(n) if n is not None and -(2**31) <= n < 2**31 else None


def _text(value: object) -> str | None:
    """Strings as they are (without lone surrogates, which no column can hold), other values as JSON."""
    if value is None:
        return None
    if not isinstance(value, str):
        value = _dumps(value)
    try:
        value.encode()
        return value
    except UnicodeEncodeError:
        return value.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _box(value: object) -> list[float | None] | None:
    if isinstance(value, dict):
        value = [value.get(k) for k in ("x0", "y0", "x1", "y1")]
    return [_number(v) for v in value] if isinstance(value, list) and len(value) == 4 else None


def _leaves(kind: str, node: dict) -> tuple:
    if kind == "page":
        size = node.get("page_size")
        w, h = (size[0], size[1]) if isinstance(size, list) and len(size) == 2 else (None, None)
        return _whole(node.get("page_idx")), _number(w), _number(h), _text(node.get("_backend"))
    if kind == "block":
        return _text(node.get("type")), _text(node.get("sub_type")), _whole(node.get("level")), _whole(node.get("index")), _whole(node.get("angle")), _box(node.get("bbox"))
    if kind == "line":
        return (_box(node.get("bbox")),)
    content = next((node[k] for k in ("content", "latex", "html") if node.get(k) is not None), None)
    return _text(node.get("type")), _text(content), _number(node.get("score")), _box(node.get("bbox"))


def _rows(kind: str, column: Column, ids: list, names: list[str]) -> dict[str, list]:
    """The rows of one path, with only the named fields."""
    here = np.flatnonzero(column.present())
    at = column.positions()[here]
    out: dict[str, list] = {"rec_id": [ids[i] for i in at[:, 0]], "page_no": at[:, 1].tolist()}
    if kind != "page":
        first, last = 2, column.depth + 1 - {"block": 0, "line": 1, "span": 2}[kind]
        steps = at[:, first:last].astype(str).tolist()
        out["block_list"] = [column.path[1]] * len(here)
        out["block_path"] = [".".join(s) for s in steps]
        if kind == "block":
            out["parent_path"] = [".".join(s[:-1]) or None for s in steps]
        if kind in ("line", "span"):
            out["line_no"] = at[:, last].tolist()
        if kind == "span":
            out["span_no"] = at[:, last + 1].tolist()
    leaf = [f.name for f in SCHEMAS[kind].fields if f.name not in out]
    if set(leaf) & set(names):
        values = [_leaves(kind, column.nodes[i]) for i in here]
        out |= {n: [v[j] for v in values] for j, n in enumerate(leaf)}
    return {n: out[n] for n in names}


def flatten(records: DataFrame, kind: str, id_col: str = "rec_id", payload_col: str = "payload", keys_only: bool = False) -> DataFrame:
    """One row per page, block, line or span object found at any depth of ``payload``.

    ``kind`` names the table (see SCHEMAS). Runs batch by batch without a
    shuffle; only the id and the payload are read, whatever else the input has.
    """
    leaf = {"page": 2, "block": 4, "line": 5, "span": 6}[kind]
    schema = T.StructType(SCHEMAS[kind].fields[:leaf] if keys_only else SCHEMAS[kind].fields)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = part.column(0).to_pylist()
                found = [read_payload(p) for p in part.column(1).to_pylist()]
                for k, column in shred(found, PARSED_PAGES, frozenset([kind])):
                    if k == kind:
                        yield pa.RecordBatch.from_pydict(_rows(kind, column, ids, names), schema=arrow)

    source = records.select(records[id_col].cast("long").alias("rec_id"), records[payload_col].cast("string").alias("payload"))
    return source.mapInArrow(run, schema)


def level_columns(records: DataFrame, id_col: str = "rec_id", payload_col: str = "payload") -> DataFrame:
    """The level sequences themselves: one row per record and repeated path."""
    schema = "rec_id long, path string, rep array<int>, dfn array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = [c for _, c in shred([read_payload(text)], PARSED_PAGES)]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i] * len(found), pa.int64()), pa.array([".".join(c.path) for c in found]), pa.array([c.rep for c in found], pa.list_(pa.int32())), pa.array([c.dfn for c in found], pa.list_(pa.int32()))],
                        names=["rec_id", "path", "rep", "dfn"],
                    )

    source = records.select(records[id_col].cast("long").alias("rec_id"), records[payload_col].cast("string").alias("payload"))
    return source.mapInArrow(run, schema)

"""HTML tables as grids, and tables that go on over pages.

A table is parsed once into rows of cells with their spans; everything else
works on that grid and writes HTML once at the end.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from folioloom.functions.text import NARROW, WIDE
from folioloom.runtime import ordered_fold

#: Leading rows that are compared as headers, and the most that a span may claim.
MAX_HEADER, MAX_SPAN = 5, 1000
_HALF = str.maketrans(WIDE, NARROW)


@dataclass
class Cell:
    text: str = ""
    colspan: int = 1
    rowspan: int = 1
    tag: str = "td"
    inner: str = ""

    @property
    def key(self) -> str:
        """Text to compare by: half width, without blanks."""
        return "".join(self.text.translate(_HALF).split())


Row = list[Cell]


class _Parser(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[Row] = []
        self.cell: Cell | None = None
        self.depth = 0

    @staticmethod
    def _span(attrs: dict, name: str) -> int:
        value = re.match(r"\s*(\d+)", attrs.get(name) or "")
        return min(MAX_SPAN, max(1, int(value.group(1)))) if value else 1

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.depth += 1
        if self.cell is not None and self.depth > 1:
            self.cell.inner += self.get_starttag_text() or ""
        elif tag == "tr":
            self._close()
            self.rows.append([])
        elif tag in ("td", "th"):
            self._close()
            if not self.rows:
                self.rows.append([])
            a = dict(attrs)
            self.cell = Cell("", self._span(a, "colspan"), self._span(a, "rowspan"), tag)
        elif self.cell is not None:
            self.cell.inner += self.get_starttag_text() or ""

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if self.cell is not None:
            self.cell.inner += self.get_starttag_text() or ""

    def handle_endtag(self, tag: str) -> None:
        if self.cell is not None and self.depth > 1:
            self.cell.inner += f"</{tag}>"
        elif tag in ("td", "th", "tr"):
            self._close()
        elif self.cell is not None and tag != "table":
            self.cell.inner += f"</{tag}>"
        if tag == "table":
            self.depth = max(0, self.depth - 1)

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.text += data
            self.cell.inner += entities.escape(data, quote=False)

    def _close(self) -> None:
        if self.cell is not None:
            self.rows[-1].append(self.cell)
            self.cell = None


def parse(html: str | None) -> list[Row]:
    """Rows of a table; empty for text without one."""
    if not html or "<t" not in html.lower():
        return []
    p = _Parser()
    p.feed(html)
    p.close()
    p._close()
    return p.rows


def write(rows: list[Row]) -> str:
    """HTML of a grid."""
    span = lambda c: "".join(f' {n}="{v}"' for n, v in (("colspan", c.colspan), ("rowspan", c.rowspan)) if v > 1)
    return "<table>" + "".join("<tr>" + "".join(f"<{c.tag}{span(c)}>{c.inner}</{c.tag}>" for c in r) + "</tr>" for r in rows) + "</table>"


@dataclass
class Grid:
    """What a scan of the rows finds: per row its occupied width, its own columns and its cells; where each cell stands."""

    effective: list[int]
    actual: list[int]
    visual: list[int]
    columns: list[list[int]]
    #: For each row, the source (row, cell) of each occupied column.
    sources: list[dict[int, tuple[int, int]]]
    #: Columns that rowspans occupy below the last row.
    tail: dict[int, set[int]] = field(default_factory=dict)

    @property
    def total(self) -> int:
        below = max((c for cols in self.tail.values() for c in cols), default=-1) + 1
        return max([0, below, *self.effective])

    def segments(self, row: int) -> int:
        """Cells as drawn in a row: runs of columns from one source."""
        if not 0 <= row < len(self.sources):
            return 0
        last, n = None, 0
        own = self.sources[row]
        for c in range(max(own, default=-1) + 1):
            mark = own.get(c)
            n += mark is not None and mark != last
            last = mark
        return n


def scan(rows: list[Row], before: dict[int, set[int]] | None = None) -> Grid:
    """``before``: columns that rowspans from above the first row occupy, by row."""
    taken: dict[int, dict[int, tuple[int, int]]] = {r: {c: (-1, c) for c in cols} for r, cols in (before or {}).items() if cols}
    g = Grid([], [], [], [], [])
    for r, row in enumerate(rows):
        own = taken.setdefault(r, {})
        at, columns, actual = 0, [], 0
        for k, cell in enumerate(row):
            while at in own:
                at += 1
            columns.append(at)
            actual += cell.colspan
            for dr in range(cell.rowspan):
                target = taken.setdefault(r + dr, {})
                for c in range(at, at + cell.colspan):
                    target[c] = (r, k)
            at += cell.colspan
        g.effective.append(max(own, default=-1) + 1)
        g.actual.append(actual)
        g.visual.append(len(row))
        g.columns.append(columns)
        g.sources.append(own)
    g.tail = {r - len(rows): set(cols) for r, cols in taken.items() if r >= len(rows) and cols}
    return g


def common_header(a: list[Row], b: list[Row]) -> int:
    """Leading rows that both tables share: by structure and text, else by text and the cells as drawn."""
    ga, gb = scan(a), scan(b)
    most = min(len(a), len(b), MAX_HEADER)

    def prefix(same) -> int:
        n = 0
        while n < most and same(n):
            n += 1
        return n

    texts = lambda k: [c.key for c in a[k]] == [c.key for c in b[k]]
    spans = lambda k: [(c.colspan, c.rowspan) for c in a[k]] == [(c.colspan, c.rowspan) for c in b[k]]
    strict = prefix(lambda k: ga.effective[k] == gb.effective[k] and spans(k) and texts(k))
    return strict or prefix(lambda k: texts(k) and ga.segments(k) == gb.segments(k))


def covered_header(rows: list[Row], n: int) -> int:
    """Header rows with those that their rowspans reach into."""
    n = min(n, len(rows))
    r = 0
    while r < n:
        for c in rows[r]:
            n = min(len(rows), max(n, r + c.rowspan))
        r += 1
    return n


def rows_match(previous: list[Row], current: list[Row]) -> bool:
    """The last row of a table and the first below the header of the next have as many columns, by any measure."""
    filled = [i for i, r in enumerate(previous) if r]
    if not filled:
        return False
    last, first = filled[-1], covered_header(current, common_header(previous, current))
    if first >= len(current):
        return False
    gp, gc = scan(previous), scan(current)
    return gp.effective[last] == gc.effective[first] or gp.actual[last] == gc.actual[first] or gp.segments(last) == gc.segments(first)


def can_merge(previous: list[Row], current: list[Row], previous_width: float | None, current_width: float | None) -> bool:
    """Widths differ by less than a tenth of the narrower, and columns agree."""
    if previous_width and current_width and previous_width > 0 and current_width > 0 and abs(previous_width - current_width) / min(previous_width, current_width) >= 0.1:
        return False
    if not previous or not current:
        return False
    return scan(previous).total == scan(current).total or rows_match(previous, current)


def merged(previous: list[Row], current: list[Row]) -> list[Row]:
    """The rows of both: without the repeated header, blank cells below an open rowspan, or narrower rows than the table."""
    skip = covered_header(current, common_header(previous, current))
    tail = scan(previous).tail
    body = [[Cell(c.text, c.colspan, c.rowspan, c.tag, c.inner) for c in r] for r in current[skip:]]
    # a blank cell that only repeats the place of a rowspan from above is dropped
    for r, columns in sorted(tail.items()):
        if r < len(body):
            width = sum(c.colspan for c in body[r])
            total = scan(previous).total
            while body[r] and width + len(columns) > total and not body[r][0].text.strip() and 0 in columns:
                width -= body[r][0].colspan
                del body[r][0]
    goal = max(scan(previous).total, scan(body, tail).total)
    out = previous + body
    for row, width in zip(out, scan(out).effective, strict=True):
        if row and 0 < width < goal:
            row[-1].colspan += goal - width
    return out


class MergeTables:
    """Joins the last table of a page with the first of the next, from the end of such a chain to its start.

    A chain goes on as long as a page's only block is a table; the later
    tables of a chain are merged first, so that earlier decisions see the
    enlarged table.
    """

    def __init__(self) -> None:
        self.chain: list[dict] = []
        self.page: int | None = None

    def __call__(self, row: tuple) -> Iterator[tuple]:
        block_id, doc, page, first, last, html, width, caption, continued, notes = row
        own = {"block_id": block_id, "doc": doc, "page": page, "first": first, "last": last, "rows": parse(html), "width": width, "caption": caption, "continued": continued, "notes": notes}
        goes_on = self.chain and own["first"] and self.chain[-1]["last"] and page == self.chain[-1]["page"] + 1
        if not goes_on:
            yield from self.finish()
        self.chain.append(own)
        if not last:
            yield from self.finish()

    def finish(self) -> Iterator[tuple]:
        into: dict[int, int] = {}
        for k in range(len(self.chain) - 1, 0, -1):
            p, c = self.chain[k - 1], self.chain[k]
            gate = c["continued"] and p["notes"] <= 1 if c["caption"] else p["notes"] == 0
            if gate and can_merge(p["rows"], c["rows"], p["width"], c["width"]):
                p["rows"] = merged(p["rows"], c["rows"])
                p["notes"] += c["notes"]
                into[k] = k - 1
        for k, t in enumerate(self.chain):
            end = k
            while end in into:
                end = into[end]
            yield t["block_id"], t["doc"], self.chain[end]["block_id"], (write(t["rows"]) if end == k else None), (len(t["rows"]) if end == k else 0), scan(t["rows"]).total
        self.chain = []


def merge_over_pages(tables: DataFrame) -> DataFrame:
    """(block_id, doc_id, merged_into, html, n_rows, n_cols) of tables in page order.

    ``tables`` has block_id, doc_id, page_idx, is_first, is_last, html, width,
    has_caption, continued and n_notes; merged tables point to the first of
    their chain and have no html of their own.
    """
    columns = ["block_id", "doc_id", "page_idx", "is_first", "is_last", "html", "width", "has_caption", "continued", "n_notes"]
    return ordered_fold(tables.select(*columns), ["doc_id"], ["page_idx", "block_id"], "block_id long, doc_id string, merged_into long, html string, n_rows int, n_cols int", MergeTables)


def cells(tables: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """One row per cell: (id, row_no, cell_no, col_no, colspan, rowspan, is_header, text); nothing for null or tableless html."""
    kind = tables.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), *[T.StructField(c, T.IntegerType()) for c in ("row_no", "cell_no", "col_no", "colspan", "rowspan")], T.StructField("is_header", T.BooleanType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            out = []
            for i, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = parse(html)
                for r, (row, columns) in enumerate(zip(rows, scan(rows).columns, strict=True)):
                    out += [(i, r, k, at, c.colspan, c.rowspan, c.tag == "th", c.text.strip()) for k, (c, at) in enumerate(zip(row, columns, strict=True))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    return tables.select(id_col, html_col).mapInArrow(run, schema)


def render_html(headers: list[str], columns: list[list[str]]) -> str:
    """Columns of any length as a table, short ones filled up."""
    n = max((len(c) for c in columns), default=0)
    cell = lambda tag, v: f"<{tag}>{entities.escape(str(v))}</{tag}>"
    head = "<tr>" + "".join(cell("th", h) for h in headers) + "</tr>"
    body = "".join("<tr>" + "".join(cell("td", c[r] if r < len(c) else "") for c in columns) + "</tr>" for r in range(n))
    return f"<table>{head}{body}</table>"


def choose_wired(wired_cells: int, wireless_cells: int, wired_text: int, wireless_text: int, wired_cols: int = 0, wireless_cols: int = 0, wired_rows: int = 0, wireless_rows: int = 0) -> bool:
    """Which of two recognised structures to take, by their counts."""
    gap = wireless_cells - wired_cells
    more = wireless_cols >= wired_cols + 2 and wireless_rows >= wired_rows + 2 and gap > 3
    few = 0 <= gap <= 5 and wired_cells <= round(wireless_cells * 0.75) or gap == 0 and wired_cells <= 4
    poor = wireless_text >= 10 and wired_text <= 0.6 * wireless_text
    return not (more or few or poor)

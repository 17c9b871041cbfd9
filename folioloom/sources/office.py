"""Office packages (docx, pptx, xlsx) as rows of blocks, with the standard library only.

A package is one value of a binary column; it is opened, its parts are read in
document order and every block becomes a row. Broken packages give one row
with their error and no block, so that a bad file doesn't end a job.
"""

from __future__ import annotations

import datetime as dt
import io
import math
import posixpath
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from folioloom.operators.order import sheet_tables, xy_order
from folioloom.operators.tables import Cell, write
from folioloom.sources.omml import M, latex

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
C = "{http://schemas.openxmlformats.org/drawingml/2006/chart}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"

#: Largest part that is read, in bytes: packages may unpack to far more than they are.
MOST = 256 << 20


@dataclass
class Block:
    page: int
    type: str
    text: str
    level: int | None = None
    ilevel: int | None = None
    ordered: bool | None = None
    html: str | None = None


class Package:
    """Parts of a package by their names; relationships resolve to parts."""

    def __init__(self, content: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        self.names = {n.lower(): n for n in self.zip.namelist()}
        #: Parts that are there but can't be read, and why.
        self.problems: dict[str, str] = {}

    def xml(self, name: str) -> ET.Element | None:
        real = self.names.get(name.lstrip("/").lower())
        if real is None:
            return None
        if self.zip.getinfo(real).file_size > MOST:
            self.problems[real] = f"larger than {MOST} bytes"
            return None
        try:
            return ET.fromstring(self.zip.read(real))
        except ET.ParseError as e:
            self.problems[real] = str(e)
            return None

    def related(self, name: str) -> dict[str, str]:
        """Relationship id -> part name; outside links as they are."""
        folder, base = posixpath.split(name)
        root = self.xml(f"{folder}/_rels/{base}.rels" if folder else f"_rels/{base}.rels")
        out = {}
        for r in root if root is not None else ():
            target = r.get("Target") or ""
            inside = r.get("TargetMode") != "External"
            out[r.get("Id") or ""] = posixpath.normpath(posixpath.join("/" + folder, target)).lstrip("/") if inside else target
        return out

    def kind(self) -> str | None:
        """docx, pptx or xlsx: the main part's relationship and its declared content must agree."""
        root = self.xml("_rels/.rels")
        main = next((r.get("Target", "").lstrip("/").lower() for r in root if (r.get("Type") or "").endswith("/officeDocument")), None) if root is not None else None
        types = self.xml("[Content_Types].xml")
        for o in types if types is not None else ():
            if (o.get("PartName") or "").lstrip("/").lower() == main:
                for mark, suffix in (("wordprocessingml", "docx"), ("presentationml", "pptx"), ("spreadsheetml", "xlsx")):
                    if mark in (o.get("ContentType") or ""):
                        return suffix
        return None


# ---- text documents


def _runs(p: ET.Element) -> str:
    """Text of a paragraph with its formulas in place."""
    out = []
    for e in p:
        tag = e.tag
        if tag == M + "oMath":
            out.append(f"<eq>{latex(e).strip()}</eq>")
        elif tag == M + "oMathPara":
            out += [f"<eq>{latex(x).strip()}</eq>" for x in e.findall(M + "oMath")]
        elif tag == W + "r":
            for t in e:
                out.append(t.text or "" if t.tag == W + "t" else "\t" if t.tag == W + "tab" else "\n" if t.tag in (W + "br", W + "cr") else "")
        elif tag in (W + "hyperlink", W + "ins", W + "smartTag", W + "sdt", W + "sdtContent"):
            out.append(_runs(e))
    return "".join(out)


def _style_levels(package: Package) -> tuple[dict[str, int], dict[str, str]]:
    """Heading level of each style, through the styles it is based on, and the names of styles."""
    root = package.xml("word/styles.xml")
    base, own, names = {}, {}, {}
    for s in root.findall(W + "style") if root is not None else ():
        key = s.get(W + "styleId") or ""
        name = s.find(W + "name")
        names[key] = (name.get(W + "val") if name is not None else key) or key
        parent = s.find(W + "basedOn")
        base[key] = parent.get(W + "val") if parent is not None else None
        outline = s.find(f"{W}pPr/{W}outlineLvl")
        m = re.search(r"heading\s*(\d+)|(\d+)\s*heading", names[key].lower())
        if names[key].lower() == "title":
            own[key] = 1
        elif m:
            own[key] = int(m.group(1) or m.group(2))
        elif outline is not None and (outline.get(W + "val") or "9").isdigit() and int(outline.get(W + "val")) < 9:
            own[key] = int(outline.get(W + "val")) + 1
    out = {}
    for key in base:
        at, seen = key, set()
        while at and at not in seen:
            seen.add(at)
            if at in own:
                out[key] = own[at]
                break
            at = base.get(at)
    return out, names


def _numbering(package: Package) -> dict[tuple[str, int], bool]:
    """(list, level) -> whether it is numbered."""
    root = package.xml("word/numbering.xml")
    if root is None:
        return {}
    abstract = {}
    for a in root.findall(W + "abstractNum"):
        for level in a.findall(W + "lvl"):
            form = level.find(W + "numFmt")
            abstract[a.get(W + "abstractNumId"), int(level.get(W + "ilvl") or 0)] = form is not None and form.get(W + "val") not in ("bullet", "none")
    out = {}
    for n in root.findall(W + "num"):
        link = n.find(W + "abstractNumId")
        for (a, level), ordered in abstract.items():
            if link is not None and link.get(W + "val") == a:
                out[n.get(W + "numId"), level] = ordered
    return out


def _word_table(t: ET.Element) -> str:
    """HTML of a table: grid spans, and vertical merges as rowspans."""
    rows: list[list[Cell]] = []
    open_: dict[int, Cell] = {}
    for tr in t.findall(W + "tr"):
        row, at = [], 0
        for tc in tr.findall(W + "tc"):
            props = tc.find(W + "tcPr")
            span = props.find(W + "gridSpan") if props is not None else None
            width = int(span.get(W + "val") or 1) if span is not None else 1
            merge = props.find(W + "vMerge") if props is not None else None
            if merge is not None and merge.get(W + "val") != "restart" and at in open_:
                open_[at].rowspan += 1
                at += width
                continue
            text = "\n".join(x for x in (_word_table(e) if e.tag == W + "tbl" else _runs(e) for e in tc if e.tag in (W + "p", W + "tbl")) if x)
            cell = Cell(text, width, 1, "td", text if "<table>" in text else _escaped(text))
            row.append(cell)
            open_.pop(at, None)
            if merge is not None:
                open_[at] = cell
            at += width
        rows.append(row)
    return write(rows)


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<eq>", "\x00").replace("</eq>", "\x01").replace("<", "&lt;").replace(">", "&gt;").replace("\x00", "<eq>").replace("\x01", "</eq>").replace("\n", "<br>")


def read_docx(package: Package) -> Iterator[Block]:
    """Blocks of the body in order; a section break begins a page."""
    root = package.xml("word/document.xml")
    body = root.find(W + "body") if root is not None else None
    if body is None:
        return
    levels, names = _style_levels(package)
    numbered = _numbering(package)
    page = 0
    todo = list(body)
    while todo:
        e = todo.pop(0)
        if e.tag == W + "sdt":
            inner = e.find(W + "sdtContent")
            todo = list(inner if inner is not None else ()) + todo
        elif e.tag == W + "tbl":
            yield Block(page, "table", "", html=_word_table(e))
        elif e.tag == W + "p":
            props = e.find(W + "pPr")
            style = props.find(W + "pStyle") if props is not None else None
            key = (style.get(W + "val") if style is not None else None) or ""
            text = _runs(e).strip()
            num = props.find(W + "numPr") if props is not None else None
            instr = "".join(x.text or "" for x in e.iter(W + "instrText"))
            if text:
                if names.get(key, "").lower().startswith("toc") or key.lower().startswith("toc"):
                    m = re.search(r"(\d+)$", key)
                    yield Block(page, "index", re.sub(r"\t\s*\w{1,12}$", "", text), ilevel=int(m.group(1)) - 1 if m else 0)
                elif key in levels:
                    yield Block(page, "title", text, level=levels[key])
                elif num is not None and num.find(W + "numId") is not None and num.find(W + "numId").get(W + "val") != "0":
                    level = num.find(W + "ilvl")
                    i = int(level.get(W + "val") or 0) if level is not None else 0
                    yield Block(page, "list", text, ilevel=i, ordered=numbered.get((num.find(W + "numId").get(W + "val"), i), False))
                elif re.search(r"\bSEQ\b", instr):
                    yield Block(page, "caption", text)
                elif re.fullmatch(r"<eq>[^<]*</eq>", text):
                    yield Block(page, "interline_equation", text[4:-5])
                else:
                    yield Block(page, "text", text)
            elif any(True for _ in e.iter(A + "blip")):
                yield Block(page, "image", "")
            if props is not None and props.find(W + "sectPr") is not None:
                page += 1


# ---- slides


def _shape_box(e: ET.Element, t: tuple[float, float, float, float]) -> tuple[float, float, float, float] | None:
    x = e.find(f".//{A}xfrm")
    x = e.find(P + "xfrm") if x is None else x
    if x is None or x.find(A + "off") is None or x.find(A + "ext") is None:
        return None
    off, ext = x.find(A + "off"), x.find(A + "ext")
    sx, sy, dx, dy = t
    x0, y0 = float(off.get("x", 0)) * sx + dx, float(off.get("y", 0)) * sy + dy
    return x0, y0, x0 + float(ext.get("cx", 0)) * sx, y0 + float(ext.get("cy", 0)) * sy


def _shapes(tree: ET.Element, t=(1.0, 1.0, 0.0, 0.0)) -> Iterator[tuple[ET.Element, tuple | None]]:
    """Shapes of a slide with their boxes; groups are flattened with their transforms."""
    for e in tree:
        if e.tag == P + "grpSp":
            x = e.find(f"{P}grpSpPr/{A}xfrm")
            own = t
            if x is not None and all(x.find(A + k) is not None for k in ("off", "ext", "chOff", "chExt")):
                num = lambda k, a, x=x: float(x.find(A + k).get(a, 0))
                sx, sy = num("ext", "cx") / (num("chExt", "cx") or 1), num("ext", "cy") / (num("chExt", "cy") or 1)
                own = (t[0] * sx, t[1] * sy, t[0] * (num("off", "x") - num("chOff", "x") * sx) + t[2], t[1] * (num("off", "y") - num("chOff", "y") * sy) + t[3])
            yield from _shapes(e, own)
        elif e.tag in (P + "sp", P + "pic", P + "graphicFrame"):
            yield e, _shape_box(e, t)


def _slide_blocks(page: int, e: ET.Element) -> Iterator[Block]:
    table = e.find(f".//{A}tbl")
    if table is not None:
        rows = []
        for tr in table.findall(A + "tr"):
            row = []
            for tc in tr.findall(A + "tc"):
                if tc.get("hMerge") in ("1", "true") or tc.get("vMerge") in ("1", "true"):
                    continue
                text = "\n".join("".join(x.text or "" for x in p.iter(A + "t")) for p in tc.iter(A + "p"))
                row.append(Cell(text, int(tc.get("gridSpan") or 1), int(tc.get("rowSpan") or 1), "td", _escaped(text)))
            rows.append(row)
        yield Block(page, "table", "", html=write(rows))
        return
    if e.tag == P + "pic":
        yield Block(page, "image", "")
        return
    place = e.find(f".//{P}nvPr/{P}ph")
    kind = place.get("type") if place is not None else None
    for p in e.iter(A + "p"):
        text = "".join(x.text or "" for x in p.iter(A + "t")).strip()
        if not text:
            continue
        props = p.find(A + "pPr")
        level = int(props.get("lvl") or 0) if props is not None else 0
        auto, bullet = (props.find(A + "buAutoNum"), props.find(A + "buChar")) if props is not None else (None, None)
        if kind in ("title", "ctrTitle"):
            yield Block(page, "title", text, level=1)
        elif auto is not None or bullet is not None or level:
            yield Block(page, "list", text, ilevel=level, ordered=auto is not None)
        else:
            yield Block(page, "text", text)


def read_pptx(package: Package) -> Iterator[Block]:
    """Blocks of slides, shapes in the order of a recursive cut, notes last."""
    root = package.xml("ppt/presentation.xml")
    links = package.related("ppt/presentation.xml")
    for page, s in enumerate(root.iter(P + "sldId") if root is not None else ()):
        name = links.get(s.get(R + "id") or "", "")
        slide = package.xml(name)
        tree = slide.find(f"{P}cSld/{P}spTree") if slide is not None else None
        shapes = list(_shapes(tree)) if tree is not None else []
        placed = [x for x in shapes if x[1] is not None]
        # without a place of its own a shape has that of its layout: before the others
        order = [x for x in shapes if x[1] is None] + [placed[i] for i in xy_order([b for _, b in placed])]
        for e, _ in order:
            yield from _slide_blocks(page, e)
        note = next((n for n in package.related(name).values() if "notesslide" in n.lower()), None)
        notes = package.xml(note) if note else None
        for e in notes.iter(P + "sp") if notes is not None else ():
            place = e.find(f".//{P}nvPr/{P}ph")
            if place is not None and place.get("type") == "body":
                yield from (Block(page, "text", b.text) for b in _slide_blocks(page, e))


# ---- sheets


def excel_date(serial: float, base_1904: bool = False) -> str | None:
    """ISO form of a serial date; below 1 a time of day. The day that 1900 never had is stepped over."""
    if not math.isfinite(serial) or serial < 0 or serial > 2_958_466:
        return None
    if serial < 1 and not base_1904:
        return (dt.datetime(1900, 1, 1) + dt.timedelta(seconds=round(serial * 86_400))).time().isoformat()
    start = dt.datetime(1904, 1, 1) if base_1904 else dt.datetime(1899, 12, 30 if serial >= 60 else 31)
    try:
        at = start + dt.timedelta(days=int(serial), seconds=round((serial - int(serial)) * 86_400))
    except OverflowError:
        return None
    return at.date().isoformat() if at.time() == dt.time() else at.isoformat(sep=" ")


def cell_place(reference: str) -> tuple[int, int] | None:
    """(row, column) from 0 of a reference such as B12."""
    m = re.fullmatch(r"\$?([A-Za-z]{1,3})\$?(\d{1,7})", reference or "")
    if not m:
        return None
    col = 0
    for c in m.group(1).upper():
        col = col * 26 + ord(c) - 64
    return int(m.group(2)) - 1, col - 1


def parse_range(formula: str) -> tuple[str | None, tuple[int, int, int, int]] | None:
    """Sheet and bounds (row, column, row, column) of 'Sheet 1'!$A$1:$B$9."""
    sheet, mark, rest = formula.lstrip("=").rpartition("!")
    first, _, last = rest.partition(":")
    a, b = cell_place(first), cell_place(last or first)
    if a is None or b is None:
        return None
    return (sheet.strip("'").replace("''", "'") if mark else None), (min(a[0], b[0]), min(a[1], b[1]), max(a[0], b[0]), max(a[1], b[1]))


def _plain(v: str) -> str:
    try:
        f = float(v)
    except ValueError:
        return v
    return str(int(f)) if f.is_integer() and abs(f) < 1e15 else v


def read_xlsx(package: Package) -> Iterator[Block]:
    """Tables of sheets; single cells are text, sheet names are titles if several sheets hold anything."""
    book = package.xml("xl/workbook.xml")
    links = package.related("xl/workbook.xml")
    strings = [("".join(t.text or "" for t in si.iter(S + "t"))) for si in (package.xml("xl/sharedStrings.xml") if package.xml("xl/sharedStrings.xml") is not None else ())]
    pages = []
    for s in book.iter(S + "sheet") if book is not None else ():
        sheet = package.xml(links.get(s.get(R + "id") or "", ""))
        values: dict[tuple[int, int], str] = {}
        for c in sheet.iter(S + "c") if sheet is not None else ():
            place, v = cell_place(c.get("r") or ""), c.find(S + "v")
            kind = c.get("t")
            text = "".join(t.text or "" for t in c.iter(S + "t")) if kind == "inlineStr" else (v.text or "") if v is not None else ""
            if kind == "s" and text.isdigit():
                text = strings[int(text)] if int(text) < len(strings) else ""
            elif kind == "b":
                text = "TRUE" if text == "1" else "FALSE"
            elif kind is None or kind == "n":
                text = _plain(text)
            if place and text.strip():
                values[place] = text
        spans = {}
        for m in sheet.iter(S + "mergeCell") if sheet is not None else ():
            found = parse_range(m.get("ref") or "")
            if found:
                r0, c0, r1, c1 = found[1]
                spans[r0, c0] = (r1 - r0 + 1, c1 - c0 + 1)
        cells = [(r, c, *spans.get((r, c), (1, 1))) for r, c in sorted(values)]
        blocks = []
        for r0, c0, r1, c1 in sheet_tables(cells) if cells else ():
            inside = {(r, c): v for (r, c), v in values.items() if r0 <= r <= r1 and c0 <= c <= c1}
            if len(inside) == 1:
                blocks.append(("text", next(iter(inside.values())), None))
                continue
            covered = {(i, j) for (r, c), (h, w) in spans.items() for i in range(r, r + h) for j in range(c, c + w) if (i, j) != (r, c)}
            rows = []
            for r in range(r0, r1 + 1):
                row = []
                for c in range(c0, c1 + 1):
                    if (r, c) not in covered:
                        h, w = spans.get((r, c), (1, 1))
                        text = values.get((r, c), "")
                        row.append(Cell(text, w, h, "th" if r == r0 else "td", _escaped(text)))
                rows.append(row)
            blocks.append(("table", "", write(rows)))
        pages.append((s.get("name") or "", blocks))
    several = sum(bool(b) for _, b in pages) > 1
    for page, (name, blocks) in enumerate(pages):
        if several and blocks:
            yield Block(page, "title", name, level=1)
        for kind, text, html in blocks:
            yield Block(page, kind, text, html=html)


def chart_table(root: ET.Element) -> str:
    """A chart's cached values as a table: a column of categories, then one per series."""
    series = []
    for s in root.iter(C + "ser"):
        points = lambda name, s=s: [v.text or "" for v in s.findall(f"{C}{name}//{C}v")]
        series.append((("".join(points("tx")) or f"Series {len(series) + 1}"), points("cat") or points("xVal"), [_plain(v) for v in points("val") or points("yVal")]))
    if not series:
        return ""
    categories = max((c for _, c, _ in series), key=len, default=[])
    from folioloom.operators.tables import render_html

    return render_html(["", *[n for n, _, _ in series]], [categories, *[v for _, _, v in series]])


def read_charts(package: Package) -> Iterator[str]:
    for low, name in sorted(package.names.items()):
        if re.search(r"/charts/chart\d*\.xml$", low):
            root = package.xml(name)
            if root is not None:
                yield chart_table(root)


READERS = {"docx": read_docx, "pptx": read_pptx, "xlsx": read_xlsx}


def office_blocks(files: DataFrame, id_col: str, content_col: str) -> DataFrame:
    """(id, suffix, block_no, page_idx, type, level, ilevel, ordered, text, html, error) of office files.

    A file that is no package, or that can't be read, gives one row with its
    error and no type, and so does each part that is too large or broken, after
    the blocks that could be read; null contents give none.
    """
    kind = files.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, suffix string, block_no int, page_idx int, type string, level int, ilevel int, ordered boolean, text string, html string, error string"
    names = [x.strip().split(" ")[0] for x in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, content in batch.itertuples(index=False, name=None):
                suffix, rows, error, package = None, [], None, None
                try:
                    package = Package(bytes(content))
                    suffix = package.kind()
                    if suffix is None:
                        raise ValueError("no office document")
                    for n, b in enumerate(READERS[suffix](package)):
                        rows.append((key, suffix, n, b.page, b.type, b.level, b.ilevel, b.ordered, b.text, b.html, None))
                except (zipfile.BadZipFile, ValueError, KeyError, ET.ParseError, NotImplementedError, OSError, RuntimeError) as e:
                    error = f"{type(e).__name__}: {e}"[:200]
                problems = [error] if error is not None else []
                problems += [f"{name}: {why}"[:200] for name, why in package.problems.items()] if package is not None else []
                if error is not None:
                    rows = []
                rows += [(key, suffix, None, None, None, None, None, None, None, None, why) for why in problems]
                if rows:
                    yield pd.DataFrame.from_records(rows, columns=names).astype({c: "Int32" for c in ("block_no", "page_idx", "level", "ilevel")} | {"ordered": "boolean"})

    return files.where(f"{content_col} IS NOT NULL").select(id_col, content_col).mapInPandas(run, schema)

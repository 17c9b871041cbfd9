"""Writing blocks as office packages: text documents, slides and sheets.

The packages hold what the readers of this package, and office programs, need:
the main part, styles and numbering; no looks. Characters that XML can't hold
are left out.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.operators.tables import parse, scan

_W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
_P = 'xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
_S = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
_RELS = "http://schemas.openxmlformats.org/package/2006/relationships"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_MAIN = {"docx": ("word/document.xml", "wordprocessingml.document"), "pptx": ("ppt/presentation.xml", "presentationml.presentation"), "xlsx": ("xl/workbook.xml", "spreadsheetml.sheet")}
#: What XML 1.0 has no way to write.
_FORBIDDEN = re.compile("[^\t\n\r\x20-퟿-�\U00010000-\U0010ffff]")
#: A fixed time: equal blocks give equal packages.
_TIME = (1980, 1, 1, 0, 0, 0)


def _text(s: str | None) -> str:
    return escape(_FORBIDDEN.sub("", s or ""))


def _package(kind: str, parts: dict[str, str]) -> bytes:
    main, content = _MAIN[kind]
    parts = {
        "[Content_Types].xml": f'<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/{main}" ContentType="application/vnd.openxmlformats-officedocument.{content}.main+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{_RELS}"><Relationship Id="rId1" Type="{_OFFICE}/officeDocument" Target="{main}"/></Relationships>',
        **parts,
    }
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in parts.items():
            z.writestr(zipfile.ZipInfo(name, _TIME), '<?xml version="1.0" encoding="UTF-8"?>' + body)
    return buffer.getvalue()


def _runs(text: str | None) -> str:
    """Runs of a paragraph; tabs and line ends are elements of their own."""
    out = []
    for part in re.split(r"(\t|\r\n|\n|\r)", text or ""):
        if part == "\t":
            out.append("<w:r><w:tab/></w:r>")
        elif part in ("\n", "\r", "\r\n"):
            out.append("<w:r><w:br/></w:r>")
        elif part:
            out.append(f'<w:r><w:t xml:space="preserve">{_text(part)}</w:t></w:r>')
    return "".join(out)


def _word_table(html: str | None) -> str:
    rows = parse(html)
    if not rows:
        return ""
    grid, out = scan(rows), []
    for r, row in enumerate(rows):
        begins = {c: k for k, c in enumerate(grid.columns[r])}
        cells, c, own = [], 0, grid.sources[r]
        while c <= max(own, default=-1):
            source = own.get(c)
            if source is None:
                cells.append("<w:tc><w:p/></w:tc>")
                c += 1
                continue
            cell = rows[source[0]][source[1]]
            span = f'<w:gridSpan w:val="{cell.colspan}"/>' if cell.colspan > 1 else ""
            first = source[0] == r and c in begins
            merge = ('<w:vMerge w:val="restart"/>' if first else "<w:vMerge/>") if cell.rowspan > 1 else ""
            cells.append(f"<w:tc><w:tcPr>{span}{merge}</w:tcPr><w:p>{_runs(cell.text.strip()) if first else ''}</w:p></w:tc>")
            c += cell.colspan
        out.append(f"<w:tr>{''.join(cells)}</w:tr>")
    return f"<w:tbl>{''.join(out)}</w:tbl>"


def docx(blocks: Iterable[tuple[str, str | None, int | None, str | None]]) -> bytes:
    """A text document of (type, text, level, html): headings of nine levels, lists by level, tables with spans, all else as paragraphs."""
    body = []
    for kind, text, level, html in blocks:
        if kind == "table":
            body.append(_word_table(html))
        else:
            n = min(9, max(1, int(level or 1)))
            props = f'<w:pPr><w:pStyle w:val="Heading{n}"/></w:pPr>' if kind == "title" else f'<w:pPr><w:numPr><w:ilvl w:val="{n - 1}"/><w:numId w:val="1"/></w:numPr></w:pPr>' if kind == "list" else ""
            body.append(f"<w:p>{props}{_runs(text)}</w:p>")
    styles = "".join(f'<w:style w:type="paragraph" w:styleId="Heading{n}"><w:name w:val="heading {n}"/></w:style>' for n in range(1, 10))
    levels = "".join(f'<w:lvl w:ilvl="{n}"><w:numFmt w:val="bullet"/></w:lvl>' for n in range(9))
    return _package(
        "docx",
        {
            "word/document.xml": f"<w:document {_W}><w:body>{''.join(body)}<w:sectPr/></w:body></w:document>",
            "word/styles.xml": f"<w:styles {_W}>{styles}</w:styles>",
            "word/numbering.xml": f'<w:numbering {_W}><w:abstractNum w:abstractNumId="0">{levels}</w:abstractNum><w:num w:numId="1"><w:abstractNumId w:val="0"/></w:num></w:numbering>',
            "word/_rels/document.xml.rels": f'<Relationships xmlns="{_RELS}"><Relationship Id="rId1" Type="{_OFFICE}/styles" Target="styles.xml"/><Relationship Id="rId2" Type="{_OFFICE}/numbering" Target="numbering.xml"/></Relationships>',
        },
    )


def pptx(slides: Iterable[list[tuple[str, str | None]]]) -> bytes:
    """Slides of (type, text): titles in their place, all else as text boxes from top to bottom."""
    parts, ids, links = {}, [], []
    for k, shapes in enumerate(slides, 1):
        out = []
        for y, (kind, text) in enumerate(shapes):
            lines = "".join(f"<a:p><a:r><a:t>{_text(x)}</a:t></a:r></a:p>" for x in re.split(r"[\r\n]+", text or ""))
            place = '<p:ph type="title"/>' if kind == "title" else ""
            out.append(f'<p:sp><p:nvSpPr><p:cNvPr id="{y + 2}" name="s{y}"/><p:cNvSpPr/><p:nvPr>{place}</p:nvPr></p:nvSpPr><p:spPr><a:xfrm><a:off x="0" y="{y * 1000}"/><a:ext cx="9000" cy="900"/></a:xfrm></p:spPr><p:txBody><a:bodyPr/>{lines}</p:txBody></p:sp>')
        parts[f"ppt/slides/slide{k}.xml"] = f"<p:sld {_P}><p:cSld><p:spTree>{''.join(out)}</p:spTree></p:cSld></p:sld>"
        ids.append(f'<p:sldId id="{255 + k}" r:id="rId{k}"/>')
        links.append(f'<Relationship Id="rId{k}" Type="{_OFFICE}/slide" Target="slides/slide{k}.xml"/>')
    return _package("pptx", {"ppt/presentation.xml": f"<p:presentation {_P}><p:sldIdLst>{''.join(ids)}</p:sldIdLst></p:presentation>", "ppt/_rels/presentation.xml.rels": f'<Relationships xmlns="{_RELS}">{"".join(links)}</Relationships>', **parts})


def xlsx(sheets: Iterable[tuple[str, list[list[str]]]]) -> bytes:
    """Sheets of (name, rows of texts); blank cells are left out."""

    def column(c: int) -> str:
        name = ""
        while c >= 0:
            name, c = chr(65 + c % 26) + name, c // 26 - 1
        return name

    parts, names, links = {}, [], []
    for k, (name, rows) in enumerate(sheets, 1):
        out = "".join(f'<row r="{r}">' + "".join(f'<c r="{column(c)}{r}" t="inlineStr"><is><t xml:space="preserve">{_text(v)}</t></is></c>' for c, v in enumerate(row) if v and v.strip()) + "</row>" for r, row in enumerate(rows, 1))
        parts[f"xl/worksheets/sheet{k}.xml"] = f"<worksheet {_S}><sheetData>{out}</sheetData></worksheet>"
        names.append(f'<sheet name={quoteattr(_FORBIDDEN.sub("", name)[:31])} sheetId="{k}" r:id="rId{k}"/>')
        links.append(f'<Relationship Id="rId{k}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{k}.xml"/>')
    return _package("xlsx", {"xl/workbook.xml": f"<workbook {_S}><sheets>{''.join(names)}</sheets></workbook>", "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_RELS}">{"".join(links)}</Relationships>', **parts})


def packages(blocks: DataFrame, doc: str, order: list[str], kind: str) -> DataFrame:
    """(doc, content): the blocks (type, text, level, html) of each file as one package; a file is one value by definition.

    Slides take a block each after a title; sheets take a table each. Null
    types count as text.
    """
    key = blocks.schema[doc].dataType.simpleString()
    piece = F.struct(*order, F.coalesce("type", F.lit("text")).alias("type"), "text", "level", "html")
    grouped = blocks.where(F.col(doc).isNotNull()).groupBy(doc).agg(F.array_sort(F.collect_list(piece)).alias("b"))

    def one(b: list) -> bytes:
        rows = [(x["type"], x["text"], None if pd.isna(x["level"]) else int(x["level"]), x["html"]) for x in b]
        if kind == "docx":
            return docx(rows)
        if kind == "pptx":
            slides: list[list] = []
            for t, text, _, _ in rows:
                if t == "title" or not slides:
                    slides.append([])
                slides[-1].append((t, text))
            return pptx(slides)
        return xlsx([(f"Sheet{k}", [[c.text.strip() for c in r] for r in parse(html)]) for k, (_, _, _, html) in enumerate(rows, 1)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({doc: batch[doc], "content": [one(b) for b in batch["b"]]})

    return grouped.mapInPandas(run, f"{doc} {key}, content binary")

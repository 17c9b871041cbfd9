"""Office packages that the tests write themselves."""

import io
import xml.etree.ElementTree as ET
import zipfile

import pytest

from folioloom.operators.tables import parse
from folioloom.sources import documents as D
from folioloom.sources import office as O
from folioloom.sources.omml import latex

MAIN = {"docx": ("word/document.xml", "wordprocessingml.document"), "pptx": ("ppt/presentation.xml", "presentationml.presentation"), "xlsx": ("xl/workbook.xml", "spreadsheetml.sheet")}
NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:m="http://schemas.openxmlformats.org/officeDocument/2006/math" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
RELS = "http://schemas.openxmlformats.org/package/2006/relationships"


def package(kind, parts):
    main, content = MAIN[kind]
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("_rels/.rels", f'<Relationships xmlns="{RELS}"><Relationship Id="r1" Type="http://x/officeDocument" Target="{main}"/></Relationships>')
        z.writestr("[Content_Types].xml", f'<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Override PartName="/{main}" ContentType="application/vnd.openxmlformats-officedocument.{content}.main+xml"/></Types>')
        for name, text in parts.items():
            z.writestr(name, text)
    return b.getvalue()


def p(text, style="", extra=""):
    return f'<w:p><w:pPr>{f"<w:pStyle w:val={chr(34)}{style}{chr(34)}/>" if style else ""}{extra}</w:pPr><w:r><w:t>{text}</w:t></w:r></w:p>'


DOCX = package(
    "docx",
    {
        "word/styles.xml": f'<w:styles {NS}><w:style w:styleId="H1"><w:name w:val="heading 1"/></w:style><w:style w:styleId="Own"><w:name w:val="Own"/><w:basedOn w:val="H1"/></w:style><w:style w:styleId="T"><w:name w:val="Title"/></w:style></w:styles>',
        "word/numbering.xml": f'<w:numbering {NS}><w:abstractNum w:abstractNumId="0"><w:lvl w:ilvl="0"><w:numFmt w:val="decimal"/></w:lvl><w:lvl w:ilvl="1"><w:numFmt w:val="bullet"/></w:lvl></w:abstractNum><w:num w:numId="5"><w:abstractNumId w:val="0"/></w:num></w:numbering>',
        "word/document.xml": f"""<w:document {NS}><w:body>{p("The title", "T")}{p("Chapter", "Own")}{p("Plain &lt;text&gt;")}{p("one", extra='<w:numPr><w:ilvl w:val="0"/><w:numId w:val="5"/></w:numPr>')}{p("sub", extra='<w:numPr><w:ilvl w:val="1"/><w:numId w:val="5"/></w:numPr>')}
        <w:p><m:oMath><m:f><m:num><m:r><m:t>a</m:t></m:r></m:num><m:den><m:r><m:t>b</m:t></m:r></m:den></m:f></m:oMath></w:p>
        <w:p><w:r><w:t>so </w:t></w:r><m:oMath><m:r><m:t>α</m:t></m:r></m:oMath><w:r><w:t> is</w:t></w:r></w:p>
        <w:tbl><w:tr><w:tc><w:tcPr><w:vMerge w:val="restart"/></w:tcPr>{p("A")}</w:tc><w:tc><w:tcPr><w:gridSpan w:val="2"/></w:tcPr>{p("B")}</w:tc></w:tr><w:tr><w:tc><w:tcPr><w:vMerge/></w:tcPr>{p("")}</w:tc><w:tc>{p("C")}</w:tc><w:tc>{p("D")}</w:tc></w:tr></w:tbl>
        <w:p><w:pPr><w:sectPr/></w:pPr><w:r><w:t>end of page</w:t></w:r></w:p>
        <w:p><w:r><w:t>Figure </w:t></w:r><w:r><w:instrText> SEQ Figure </w:instrText></w:r><w:r><w:t>1</w:t></w:r></w:p>{p("Intro&#9;7", "TOC2")}</w:body></w:document>""",
    },
)


def test_docx():
    got = [(b.page, b.type, b.text, b.level, b.ilevel, b.ordered) for b in O.read_docx(O.Package(DOCX)) if b.type != "table"]
    assert got == [
        (0, "title", "The title", 1, None, None), (0, "title", "Chapter", 1, None, None), (0, "text", "Plain <text>", None, None, None), (0, "list", "one", None, 0, True), (0, "list", "sub", None, 1, False),
        (0, "interline_equation", r"\frac{a}{b}", None, None, None), (0, "text", r"so <eq>\alpha</eq> is", None, None, None), (0, "text", "end of page", None, None, None), (1, "caption", "Figure 1", None, None, None), (1, "index", "Intro", None, 1, None),
    ]
    table = next(b for b in O.read_docx(O.Package(DOCX)) if b.type == "table")
    assert [[(c.text, c.colspan, c.rowspan) for c in r] for r in parse(table.html)] == [[("A", 1, 2), ("B", 2, 1)], [("C", 1, 1), ("D", 1, 1)]]


def sp(text, x, y, kind="", extra=""):
    return f'<p:sp><p:nvSpPr><p:nvPr>{f"<p:ph type={chr(34)}{kind}{chr(34)}/>" if kind else ""}</p:nvPr></p:nvSpPr><p:spPr><a:xfrm><a:off x="{x}" y="{y}"/><a:ext cx="100" cy="20"/></a:xfrm></p:spPr><p:txBody><a:p>{extra}<a:r><a:t>{text}</a:t></a:r></a:p></p:txBody></p:sp>'


def test_pptx():
    slide = f'<p:sld {NS}><p:cSld><p:spTree>{sp("right", 400, 100)}{sp("left", 0, 100)}{sp("Head", 0, 0, "title")}<p:grpSp><p:grpSpPr><a:xfrm><a:off x="0" y="300"/><a:ext cx="100" cy="100"/><a:chOff x="0" y="0"/><a:chExt cx="100" cy="100"/></a:xfrm></p:grpSpPr>{sp("grouped", 0, 0, extra="<a:pPr><a:buAutoNum/></a:pPr>")}</p:grpSp></p:spTree></p:cSld></p:sld>'
    content = package(
        "pptx",
        {
            "ppt/presentation.xml": f'<p:presentation {NS}><p:sldIdLst><p:sldId r:id="r7"/></p:sldIdLst></p:presentation>',
            "ppt/_rels/presentation.xml.rels": f'<Relationships xmlns="{RELS}"><Relationship Id="r7" Target="slides/slide1.xml"/></Relationships>',
            "ppt/slides/slide1.xml": slide,
            "ppt/slides/_rels/slide1.xml.rels": f'<Relationships xmlns="{RELS}"><Relationship Id="n" Target="../notesSlides/notesSlide1.xml"/></Relationships>',
            "ppt/notesSlides/notesSlide1.xml": f'<p:notes {NS}><p:cSld><p:spTree>{sp("a note", 0, 0, "body")}</p:spTree></p:cSld></p:notes>',
        },
    )
    got = [(b.type, b.text, b.ordered) for b in O.read_pptx(O.Package(content))]
    assert sorted(got[:4], key=str) == sorted([("title", "Head", None), ("text", "left", None), ("text", "right", None), ("list", "grouped", True)], key=str) and got[4] == ("text", "a note", None)
    assert got.index(("text", "left", None)) < got.index(("text", "right", None))


def test_xlsx():
    s = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    sheet = f'<worksheet {s}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>k&lt;1</t></is></c></row><row r="2"><c r="A2"><v>3.0</v></c><c r="B2"><v>2.5</v></c></row><row r="9"><c r="F9" t="b"><v>1</v></c></row></sheetData></worksheet>'
    content = package(
        "xlsx",
        {
            "xl/workbook.xml": f'<workbook {s} {NS}><sheets><sheet name="One" r:id="a"/></sheets></workbook>',
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{RELS}"><Relationship Id="a" Target="worksheets/s1.xml"/></Relationships>',
            "xl/sharedStrings.xml": f"<sst {s}><si><r><t>Na</t></r><r><t>me</t></r></si></sst>",
            "xl/worksheets/s1.xml": sheet,
        },
    )
    blocks = list(O.read_xlsx(O.Package(content)))
    assert [[(c.text, c.tag) for c in r] for r in parse(blocks[0].html)] == [[("Name", "th"), ("k<1", "th")], [("3", "td"), ("2.5", "td")]]
    assert (blocks[1].type, blocks[1].text) == ("text", "TRUE") and len(blocks) == 2


def test_frame_of_files(spark):
    df = spark.createDataFrame([(1, DOCX, "x"), (2, b"no zip", "x"), (3, None, "x"), (4, b"", "x"), (5, DOCX[:400], "x")], "k int, content binary, text string")
    rows = O.office_blocks(df, "k", "content").collect()
    assert {r.k for r in rows} == {1, 2, 4, 5} and all(r.error and r.type is None for r in rows if r.k != 1)
    assert sum(r.k == 1 for r in rows) == 11 and all(r.suffix == "docx" and r.error is None for r in rows if r.k == 1)


@pytest.mark.parametrize(("serial", "base", "iso"), [(1, False, "1900-01-01"), (59, False, "1900-02-28"), (61, False, "1900-03-01"), (43831, False, "2020-01-01"), (43831.5, False, "2020-01-01 12:00:00"), (0.25, False, "06:00:00"), (0, True, "1904-01-01"), (float("nan"), False, None), (1e9, False, None)])
def test_excel_dates(serial, base, iso):
    assert O.excel_date(serial, base) == iso


def test_references():
    assert O.parse_range("'My ''Sheet'!$A$1:$B$9") == ("My 'Sheet", (0, 0, 8, 1)) and O.parse_range("C3") == (None, (2, 2, 2, 2)) and O.parse_range("x") is None
    assert O.cell_place("AA10") == (9, 26)


def test_chart():
    c = "http://schemas.openxmlformats.org/drawingml/2006/chart"
    v = lambda *x: "".join(f"<c:pt><c:v>{i}</c:v></c:pt>" for i in x)
    root = ET.fromstring(f'<c:chart xmlns:c="{c}"><c:ser><c:tx>{v("S")}</c:tx><c:cat>{v("a", "b")}</c:cat><c:val>{v("1.0", "2.5")}</c:val></c:ser></c:chart>')
    assert [[x.text for x in r] for r in parse(O.chart_table(root))] == [["", "S"], ["a", "1"], ["b", "2.5"]]


def om(inner):
    return latex(ET.fromstring(f'<m:oMath xmlns:m="http://schemas.openxmlformats.org/officeDocument/2006/math">{inner}</m:oMath>')).strip()


r_ = "<m:r><m:t>{}</m:t></m:r>".format


@pytest.mark.parametrize(
    ("xml", "want"),
    [
        (f"<m:sSup><m:e>{r_('x')}</m:e><m:sup>{r_('2')}</m:sup></m:sSup>", "x^{2}"),
        (f"<m:rad><m:deg>{r_('3')}</m:deg><m:e>{r_('x')}</m:e></m:rad>", r"\sqrt[3]{x}"),
        (f'<m:d><m:dPr><m:begChr m:val="["/><m:endChr m:val=""/></m:dPr><m:e>{r_("x")}</m:e></m:d>', r"\left[x\right."),
        (f'<m:nary><m:naryPr><m:chr m:val="∑"/></m:naryPr><m:sub>{r_("i")}</m:sub><m:sup>{r_("n")}</m:sup><m:e>{r_("x")}</m:e></m:nary>', r"\sum_{i}^{n} x"),
        (f"<m:func><m:fName>{r_('sin')}</m:fName><m:e>{r_('x')}</m:e></m:func>", r"\sin {x}"),
        (f"<m:m><m:mr><m:e>{r_('a')}</m:e><m:e>{r_('b')}</m:e></m:mr></m:m>", r"\begin{matrix}a & b\end{matrix}"),
        (f'<m:bar><m:barPr><m:pos m:val="top"/></m:barPr><m:e>{r_("x")}</m:e></m:bar>', r"\overline{x}"),
        (f"<m:limLow><m:e>{r_('lim')}</m:e><m:lim>{r_('x→0')}</m:lim></m:limLow>", r"\lim _{x\to 0}"),
        (f"<m:sPre><m:e>{r_('x')}</m:e></m:sPre>", ""),
        (r_("a&lt;5%"), r"a<5\%"),
    ],
)
def test_formulas(xml, want):
    assert om(xml) == want


def test_collect_files(spark, tmp_path):
    for name, content in (("b.PDF", b"%PDF-1.7 x"), ("a.docx", DOCX), ("c.txt", b"text"), ("d.png", b"\x89PNG\r\n\x1a\nxx"), ("B.docx", DOCX), ("e.zip", DOCX)):
        (tmp_path / name).write_bytes(content)
    files = D.with_unique_stems(D.collect(spark, str(tmp_path)))
    assert sorted((r.stem, r.suffix, r.unique) for r in files.collect()) == [("B", "docx", "B"), ("a", "docx", "a"), ("b", "pdf", "b_2"), ("d", "png", "d")]
    from pyspark.sql import functions as F

    part = spark.createDataFrame([(b"abcdef",)], "c binary").select(D.ranged(F.col("c"), F.lit(2), F.lit(3)).alias("x"), D.ranged(F.col("c"), F.lit(4), F.lit(-1)).alias("y")).first()
    assert bytes(part.x) == b"cde" and bytes(part.y) == b"ef"
    folder = spark.range(1).select(D.parse_folder(F.lit("n"), F.lit("hybrid-engine"), F.lit("ocr"), F.lit(False)).alias("h"), D.parse_folder(F.lit("n"), F.lit("pipeline"), F.lit("txt"), F.lit(False)).alias("p")).first()
    assert (folder.h, folder.p) == ("n/hybrid_ocr", "n/txt")

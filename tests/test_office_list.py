"""Packages that are written, read and listed; parts that can't be read."""

import json

import pytest

from folioloom.operators import office_list as O
from folioloom.sources import office, office_writer as W

ROWS = [("title", "Head & <tail>", 2, None), ("text", "a\tb\nc\x0b", None, None), ("list", "one", 1, None), ("list", "deep", 3, None), ("list", "two", 1, None), ("table", None, None, '<table><tr><td rowspan="2">A</td><td>B</td></tr><tr><td>C</td></tr></table>'), ("text", "* star", None, None)]


def frame(spark, rows):
    return spark.createDataFrame([("d", k, *r, "x") for k, r in enumerate(rows)], "doc_id string, block_id int, type string, text string, level int, html string, content string")


@pytest.fixture(scope="module")
def read(spark):
    return office.office_blocks(W.packages(frame(spark, ROWS), "doc_id", ["block_id"], "docx"), "doc_id", "content").cache()


def test_round_trip(read):
    got = [(r.type, r.text, r.level, r.ilevel) for r in read.orderBy("block_no").collect() if r.type != "table"]
    assert got == [("title", "Head & <tail>", 2, None), ("text", "a\tb\nc", None, None), ("list", "one", None, 0), ("list", "deep", None, 2), ("list", "two", None, 0), ("text", "* star", None, None)]
    table = read.where("type = 'table'").first().html
    assert 'rowspan="2"' in table and table.count("<td") == 3


def test_lists_are_one_entry(read):
    items = {r.block_no: r for r in O.content_list(O.entries(read, "doc_id"), "doc_id").collect()}
    assert list(items[2].list_items) == ["- one", "        - deep", "- two"] and items[2].type == "list"
    assert items[0].type == "text" and items[0].text_level == 2 and items[5].type == "table" and items[6].text == "\\* star"
    page = json.loads(O.page_content(O.entries(read, "doc_id"), "doc_id").first()["items"])
    assert [x["type"] for x in page] == ["title", "paragraph", "list", "table", "paragraph"] and page[3]["content"]["table_type"] == "complex_table"
    md = O.document_markdown(O.entries(read, "doc_id"), "doc_id").first().markdown
    assert md.startswith("## Head & <tail>\n\na\tb\nc\n\n- one\n        - deep\n- two\n\n<table>")


def test_numbered_lists_start_anew(spark):
    rows = [("d", 0, k, "list", None, lv, True, t, None, None) for k, (lv, t) in enumerate([(1, "a"), (1, "b"), (2, "c"), (1, "d"), (2, "e")])]
    df = spark.createDataFrame(rows, "doc_id string, page_idx int, block_no int, type string, level int, ilevel int, ordered boolean, text string, html string, error string")
    assert list(O.entries(df, "doc_id").first().list_items) == ["1. a", "2. b", "    1. c", "3. d", "    1. e"]
    assert O.entries(df.limit(0), "doc_id").count() == 0


def test_sheets_and_slides(spark):
    tables = [("table", None, None, "<table><tr><td>k</td><td>1.50</td></tr><tr><td></td><td>x</td></tr></table>"), ("table", None, None, "<table><tr><td>solo</td></tr></table>"), ("table", None, None, None)]
    got = office.office_blocks(W.packages(frame(spark, tables), "doc_id", ["block_id"], "xlsx"), "doc_id", "content").orderBy("block_no").collect()
    assert [(r.page_idx, r.type, r.text) for r in got] == [(0, "title", "Sheet1"), (0, "table", ""), (1, "title", "Sheet2"), (1, "text", "solo")]
    slides = office.office_blocks(W.packages(frame(spark, ROWS[:2] + [("title", "Next", 1, None), (None, None, None, None)]), "doc_id", ["block_id"], "pptx"), "doc_id", "content").orderBy("block_no").collect()
    assert [(r.page_idx, r.type, r.text) for r in slides] == [(0, "title", "Head & <tail>"), (0, "text", "a\tb"), (0, "text", "c"), (1, "title", "Next")]
    assert W.packages(frame(spark, ROWS).limit(0), "doc_id", ["block_id"], "docx").count() == 0


def test_parts_that_cannot_be_read(spark, monkeypatch):
    good = W.docx(ROWS[:2])
    broken = W._package("docx", {"word/document.xml": "<w:document"})
    df = spark.createDataFrame([(1, bytearray(good)), (2, bytearray(broken)), (3, bytearray(b"no zip")), (4, None)], "id int, content binary")
    out = office.office_blocks(df, "id", "content").collect()
    assert {r.id for r in out if r.error} == {2, 3} and sum(r.id == 1 for r in out) == 2
    assert "word/document.xml" in next(r.error for r in out if r.id == 2)
    package = office.Package(good)
    monkeypatch.setattr(office, "MOST", 10)
    assert list(office.read_docx(package)) == [] and "larger than" in package.problems["word/document.xml"]

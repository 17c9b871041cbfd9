"""Texts that go on, captions, rows and archives on small inputs."""

import io
import zipfile

from pyspark.sql import functions as F

from folioloom.operators import merge as M

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"
SCHEMA = f"doc string, page_idx int, k int, type string, box {BOX}, n_lines int, first_x0 double, last_x1 double, line_height double, first_text string, last_text string"


def text(k, page=0, kind="text", y=100.0, first="goes on", last="and so", n=2, x0=0.0):
    return ("d", page, k, kind, (0.0, y, 100.0, y + 20), n, x0, 100.0, 10.0, first, last)


def test_continuations(spark):
    rows = [text(1, y=500.0), text(2, kind="image"), text(3, y=100.0), text(4, page=1, y=600.0), text(5, page=1, kind="title"), text(6, page=1), text(7, page=1, first="Upper"), text(8, page=2, x0=8.0), text(9, page=2, last="end."), text(10, page=3), text(11, page=3, n=0), text(12, page=3)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.k: r.goes_on for r in M.text_continuations(df, ["doc"], ["page_idx", "k"], "k").collect()}
    assert got == {1: None, 3: 1, 4: 3, 6: None, 7: None, 8: None, 9: 8, 10: None, 11: None, 12: None}


def test_captions_without_gap(spark):
    df = spark.createDataFrame([(1, 3, 6), (1, 4, 6), (1, 5, 6), (1, 7, 6), (2, 1, 9), (2, 8, 9)], "fig int, idx int, body int")
    assert {(r.fig, r.idx): r.kept for r in M.contiguous_captions(df, ["fig"], "idx", "body").collect()} == {(1, 7): True, (1, 5): True, (1, 4): True, (1, 3): True, (2, 8): True, (2, 1): False}


def test_leading_continuations(spark):
    rows = [(0, 1, "header", ""), (0, 2, "text", "Table 2 (continued)"), (0, 3, "table", ""), (0, 4, "text", "(continued)"), (1, 1, "text", "x"), (1, 2, "text", "(continued)"), (1, 3, "table", ""), (2, 1, "text", "(continued)"), (2, 2, "image", "")]
    df = spark.createDataFrame(rows, "page int, k int, type string, content string")
    got = M.leading_continuations(df, ["page"], ["k"], F.col("content").contains("(continued)")).collect()
    assert {(r.page, r.k) for r in got if r.kind == "caption"} == {(0, 2)}


def test_structure_with_words():
    tokens = ["<table>", "<thead>", "<tr>", "<td></td>", "<td", ' colspan="2"', ">", "</td>", "</tr>", "</thead>", "</table>"]
    assert M.fill_structure(tokens, {0: [0, 1], 1: [2, 9]}, ["<b>a</b>", " <b>b</b>", "c"]) == '<table><tr><td><b>a b</b></td><td colspan="2">c</td></tr></table>'
    assert M.fill_structure([], {}, []) == ""


def test_archives(spark):
    df = spark.createDataFrame([("d", "b.md", b"two"), ("d", "a.json", b"one"), ("e", None, b"x"), ("e", "n", None)], "doc string, name string, content binary")
    (row,) = M.archives(df, "doc").collect()
    with zipfile.ZipFile(io.BytesIO(bytes(row.archive))) as z:
        assert z.namelist() == ["a.json", "b.md"] and z.read("b.md") == b"two"


def test_rows_and_overlay(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (1, 2, 4.0), (1, 3, 20.0), (1, 4, 5.0)], "t int, k int, top double")
    assert [r.row_no for r in sorted(M.cell_rows(df, ["t"], ["k"], "top").collect(), key=lambda r: r.k)] == [0, 0, 1, 2]
    o = M.overlay(spark.createDataFrame([(1, 1, "text", 0), (1, 2, None, 0)], "p int, k int, type string, box int"), ["p"], ["k"], "box").collect()
    assert [(r.order_no, r.rgb) for r in o] == [(1, [153, 0, 76]), (2, [0, 0, 0])]

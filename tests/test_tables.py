"""Grids of HTML tables and tables over pages."""

import pytest

from folioloom.operators import tables as B


def table(*rows):
    return "<table>" + "".join("<tr>" + "".join(r) + "</tr>" for r in rows) + "</table>"


def td(text, c=1, r=1, tag="td"):
    return f'<{tag} colspan="{c}" rowspan="{r}">{text}</{tag}>'


def test_grid_with_spans():
    rows = B.parse(table([td("a", 1, 2), td("b", 2)], [td("c"), td("d")], [td("e", 3)]))
    g = B.scan(rows)
    assert g.effective == [3, 3, 3] and g.actual == [3, 2, 3] and g.visual == [2, 2, 1] and g.total == 3
    assert g.columns == [[0, 1], [1, 2], [0]] and [g.segments(i) for i in range(3)] == [2, 3, 1]


def test_tail_of_an_open_rowspan():
    g = B.scan(B.parse(table([td("a", 1, 3), td("b")])))
    assert g.tail == {0: {0}, 1: {0}} and g.total == 2
    assert B.scan(B.parse(table([td("x")])), g.tail).columns == [[1]]


@pytest.mark.parametrize("html", [None, "", "text", "<table>", "<td>x", "<table><tr><td>a<td>b<tr><td>c", "<table><tr><td colspan='x' rowspan='-3'>a</td></tr>", "<tr></tr>"])
def test_broken_html(html):
    rows = B.parse(html)
    assert B.scan(rows).total >= 0 and isinstance(B.write(rows), str)


def test_header_prefix_and_rowspan_cover():
    head = [td("H1", 1, 2), td("H2")], [td("h")]
    a = B.parse(table(*head, [td("1"), td("2")]))
    b = B.parse(table(*head, [td("3"), td("4")]))
    assert B.common_header(a, b) == 2 and B.covered_header(b, 1) == 2
    # full width counts as half width
    assert B.common_header(B.parse(table([td("Ａ 1")])), B.parse(table([td("A1")]))) == 1


def page(i, doc, p, html, first=True, last=True, width=100.0, caption=False, continued=False, notes=0):
    return (i, doc, p, first, last, html, width, caption, continued, notes)


SCHEMA = "block_id long, doc_id string, page_idx int, is_first boolean, is_last boolean, html string, width double, has_caption boolean, continued boolean, n_notes int"


def test_merge_over_three_pages(spark):
    t = lambda *cells: table([td("H"), td("K")], *[[td(c), td(c)] for c in cells])
    rows = [
        page(1, "a", 0, t("1")), page(2, "a", 1, t("2"), caption=True, continued=True), page(3, "a", 2, t("3"), width=104.0),
        page(4, "b", 0, t("1")), page(5, "b", 1, t("2"), width=150.0),  # too wide
        page(6, "c", 0, t("1")), page(7, "c", 1, t("2"), caption=True),  # a table of its own
        page(8, "d", 0, t("1")), page(9, "d", 2, t("2")),  # a page between
        page(10, "e", 0, t("1"), notes=1), page(11, "e", 1, t("2")),  # a note closes the table
        page(12, "f", 0, None), page(13, "f", 1, t("2")),
        page(14, "g", 0, t("1"), last=False), page(15, "g", 1, t("2")),
    ]
    got = {r.block_id: r for r in B.merge_over_pages(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert [got[i].merged_into for i in range(1, 16)] == [1, 1, 1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15]
    assert [[c.text for c in r] for r in B.parse(got[1].html)] == [["H", "K"], ["1", "1"], ["2", "2"], ["3", "3"]] and got[1].n_rows == 4 and got[2].html is None
    assert B.merge_over_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rows_are_widened_to_the_table():
    out = B.merged(B.parse(table([td("a"), td("b"), td("c")])), B.parse(table([td("x"), td("y")])))
    assert [c.colspan for c in out[1]] == [1, 2]


def test_rendering_and_choice():
    assert B.render_html(["a", "b"], [["1", "2"], ["<"]]) == "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>&lt;</td></tr><tr><td>2</td><td></td></tr></table>"
    assert B.choose_wired(20, 20, 100, 100) and not B.choose_wired(4, 4, 9, 9) and not B.choose_wired(20, 20, 5, 100)


def test_cells(spark):
    df = spark.createDataFrame([(1, table([td("a", 2), td(" b ", 1, 1, "th")]), "x"), (2, None, "x"), (3, "no table", "x")], "k long, html string, text string")
    assert [tuple(r) for r in B.cells(df, "k", "html").collect()] == [(1, 0, 0, 0, 2, 1, False, "a"), (1, 0, 1, 2, 1, 1, True, "b")]

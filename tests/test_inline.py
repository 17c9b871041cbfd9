"""Inline markup, table markup and code."""

import pytest
from pyspark.sql import functions as F

from folioloom.operators import inline as I
from folioloom.plans import inline as P


def test_spans():
    text = 'a <eq>x^2</eq><text style="bold, italic,odd">b</text> <hyperlink><text style="underline">c</text><url>http://x</url></hyperlink><text>d</text><eq> </eq><eq>open'
    assert I.spans(text) == [("text", "a ", [], None), ("inline_equation", "x^2", [], None), ("text", "b", ["bold", "italic"], None), ("text", " ", [], None), ("hyperlink", "c", ["underline"], "http://x"), ("text", "d", [], None), ("text", "<eq>open", [], None)]
    assert I.spans(None) == I.spans("") == []


def test_boundaries():
    assert I.boundary_blank("x)", "y", True) and not I.boundary_blank("x", "y", True) and not I.boundary_blank("x)", " y", True) and not I.boundary_blank("x)", "y", False) and not I.boundary_blank("x)", "y", True, "hyperlink")


@pytest.mark.parametrize(
    ("html", "clean"),
    [
        ('<TABLE border=1><tr class="a"><td style="x" colspan=2>a</td></tr></TABLE>', '<table><tr><td colspan="2">a</td></tr></TABLE>'),
        ('<a href="JavaScript:x()" id="1">l</a><a href="p?a=1&amp;b=2">k</a>', '<a>l</a><a href="p?a=1&amp;b=2">k</a>'),
        ("<img src='a.png' class=c alt='x'/><br/>", '<img src="a.png" alt="x"/><br/>'),
        ("3 < 5 and 9 > 7", "3 < 5 and 9 > 7"),
        ("", ""),
        (None, None),
    ],
)
def test_clean_table(html, clean):
    assert I.clean_table(html) == clean


def test_code_languages(spark):
    rows = [("def f(x):\n    return self.x",), ("#include <a.h>\nint main() {}",), ("run --x | sort > $(y)",), ("SELECT a FROM b",), ("lorem ipsum",), (None,)]
    assert [r[0] for r in spark.createDataFrame(rows, "c string").select(I.code_language(F.col("c"))).collect()] == ["python", "c", "bash", "sql", "txt", None]


def test_every_table_field_is_cleaned(spark, tmp_path):
    fields = {
        "<table><tr><td>a</td><td>b": "<table><tr><td>a</td><td>b",
        '<table border="1"><tr><td>a</td><td colspan="2" cla': '<table><tr><td>a</td><td colspan="2" cla',
        "Table 1 <table id=x><tr><td>3 < 5</td></tr></table> note": "Table 1 <table><tr><td>3 < 5</td></tr></table> note",
        "<tr><td>a</td></tr></table>": "<tr><td>a</td></tr></table>",
        "<table><tr><td>a</td></tr></table>": "<table><tr><td>a</td></tr></table>",
        "no markup": "no markup",
        "": "",
        None: None,
    }
    spark.createDataFrame(list(enumerate(fields)), "block_id long, html string").write.parquet(f"{tmp_path}/blocks.parquet")
    assert sorted(map(tuple, P.q_clean_tables(spark, str(tmp_path)).collect())) == [(i, v) for i, v in enumerate(fields.values()) if v is not None]

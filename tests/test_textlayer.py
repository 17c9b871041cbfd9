"""Code units, characters in their spans, objects of pages, grids."""

import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioloom.operators import objects as B
from folioloom.operators import textlayer as L
from folioloom.plans import textlayer as P

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


@pytest.mark.parametrize(
    ("units", "want"),
    [
        ([0xD835, 0xDC4B], [(0x1D44B, 0)]),
        ([ord("f"), 0xD835, 0xDC4B, ord("=")], [(ord("f"), 0), (0x1D44B, 1), (ord("="), 3)]),
        ([0xD835, ord("!")], [(0xFFFD, 0), (ord("!"), 1)]),
        ([0xDC4B, ord("!")], [(0xFFFD, 0), (ord("!"), 1)]),
        ([0xD835], [(0xFFFD, 0)]),
        ([0xD835, 0xD835, 0xDC4B], [(0xFFFD, 0), (0x1D44B, 1)]),
        ([0xD835, 0xDC4B, 0xDC4B], [(0x1D44B, 0), (0xFFFD, 2)]),
        ([], []),
        (None, None),
    ],
)
def test_units(spark, units, want):
    got = spark.createDataFrame([(units,)], "u array<int>").select(L.joined_units(F.col("u")).alias("c")).first().c
    assert (None if got is None else [tuple(r) for r in got]) == want


def filled(spark, spans, chars):
    s = spark.createDataFrame([("d", 0, *r, "x") for r in spans], f"doc_id string, page_idx int, span_id int, span_box {BOX}, content_ string")
    c = spark.createDataFrame([("d", 0, k, ch, box, "x") for k, (ch, box) in enumerate(chars)], f"doc_id string, page_idx int, char_idx long, char string, char_box {BOX}, span_box_ string")
    return {r.span_id: (r.content, r.recognise) for r in L.filled_spans(s, c, ["doc_id", "page_idx"]).collect()}


def test_characters_find_their_span(spark):
    word = lambda text, x, y: [(ch, (x + 5.0 * k, float(y), x + 5.0 * k + 5, y + 10.0)) for k, ch in enumerate(text)]
    spans = [(1, (0.0, 0.0, 50.0, 10.0)), (2, (0.0, 12.0, 50.0, 22.0)), (3, (200.0, 0.0, 400.0, 10.0)), (4, None)]
    chars = word("ab", 0, 0) + word("cd", 20, 0) + word("ﬁn", 5, 12)
    chars += [(".", (49.0, 0.0, 54.0, 10.0)), ("x", (49.0, 0.0, 54.0, 10.0))]  # a stop may stand half outside, a letter not
    chars += [("(", (-3.0, 12.0, 1.0, 22.0)), ("\r", (30.0, 12.0, 31.0, 22.0)), ("z", (20.0, 8.0, 25.0, 18.0)), ("q", None)]  # off the axis of both lines, without a place
    got = filled(spark, spans, chars)
    assert got[1] == ("ab cd .", False) and got[2] == ("fin(", False)
    # nothing in a wide span: to be recognised; without a box as well
    assert got[3] == ("", True) and got[4] == ("", True)


def test_ties_private_use_and_empty_tables(spark):
    twice = [(7, (0.0, 0.0, 50.0, 10.0)), (5, (0.0, 0.0, 50.0, 10.0))]
    got = filled(spark, twice, [("", (0.0, 0.0, 5.0, 10.0)), ("", (5.0, 0.0, 10.0, 10.0))])
    assert got[5] == ("", True) and got[7] == ("", True)
    assert filled(spark, [], []) == {}
    assert filled(spark, twice, []) == {5: ("", True), 7: ("", True)}


PAGE = ["doc_id", "page_idx"]
LINES = f"doc_id string, page_idx int, span_id int, content string, span_box {BOX}"


def odd_lines():
    """Lines with boxes that cross, tie, are flat, missing or endless, and contents with marks, blanks, ligatures and no letters."""
    r, rows = random.Random(7), {}
    for _ in range(900):
        page = (r.choice(["a", "b", "c", None]), r.choice([0, 1, 2, 3, 4, 5, 6, 7, 8, None]))
        x, y, h = r.choice([0.0, 3.0, 40.0, r.uniform(-90, 90)]), r.choice([0.0, 12.0, r.uniform(-99, 300)]), r.choice([10.0, 10.0, 12.5, 300.0, 0.0])
        box = (x, y, x + r.choice([0.0, 4.0, 60.0, r.uniform(1, 99)]), y + h)
        box = r.choice([box] * 9 + [None, (x, y, math.nan, y + h), (x, y, math.inf, y + h), (x, -math.inf, x + 50, y), (x, y, x + 50, math.nan), (x, -9e6, x + 50, 9e6)])
        text = "".join(r.choices("abc  .,)(「》ﬁ\u0002\r\n\ue000\U0001d44b", k=r.choice([1, 5, 5, 20, 33])))
        span = r.choice([None, *range(-3, 40)])
        rows[page, span] = (*page, span, text, box)
    return list(rows.values())


def taken_apart(s):
    """The characters of lines as rows, for ``filled_spans``."""
    each = s.select(*PAGE, "span_id", "span_box", F.length("content").alias("n"), F.posexplode(F.split("content", "")).alias("k", "char")).where("char <> '' AND char <> ' '")
    b, w = F.col("span_box"), F.expr("(span_box.x1 - span_box.x0) / n")
    box = F.struct((b["x0"] + F.col("k") * w).alias("x0"), b["y0"].alias("y0"), (b["x0"] + (F.col("k") + 1) * w).alias("x1"), b["y1"].alias("y1"))
    return each.select(*PAGE, (F.col("span_id").cast("long") * 100000 + F.col("k")).alias("char_idx"), "char", F.when(b.isNotNull(), box).alias("char_box"))


def test_lines_are_refilled_as_from_rows_of_characters(spark):
    long = [("z", 0, 1, "ab" * 50_002 + " cd", (0.0, 0.0, 1e6, 10.0)), ("z", 0, 2, "xyz. u", (5e5, 1.0, 1.3e6, 11.0)), ("z", 1, 1, None, (0.0, 0.0, 9.0, 9.0)), ("z", 1, 2, "", (0.0, 0.0, 9.0, 9.0))]
    s = spark.createDataFrame(odd_lines(), LINES)
    for lines in (s, spark.createDataFrame(long, LINES)):
        want, got = (sorted(df.collect(), key=str) for df in (L.filled_spans(lines.drop("content"), taken_apart(lines), PAGE), L.refilled_spans(lines, PAGE)))
        assert got == want and len(got) > 3
    assert sum(" " in r.content for r in L.refilled_spans(s, PAGE).collect()) > 50
    assert L.refilled_spans(s.limit(0), PAGE).count() == 0


def test_refilled_in_any_portions(spark, monkeypatch):
    rows = sorted(odd_lines(), key=lambda r: tuple((v is not None, v) for v in r[:3]))
    table = spark.createDataFrame(rows, LINES).coalesce(1).toArrow()
    whole = pa.Table.from_batches(L._refill(iter(table.to_batches()), PAGE))
    assert whole.num_rows == len(rows)
    for held, batch in ((1, 1), (7, 3), (60, 40), (500, 1000)):
        monkeypatch.setattr(L, "HELD", held)
        assert pa.Table.from_batches(L._refill(iter(table.to_batches(max_chunksize=batch)), PAGE))["text"].to_pylist() == whole["text"].to_pylist()


def test_no_character_is_shuffled(spark, tmp_path):
    row = ("a", 0, 1, "text", "one line", (0.0, 0.0, 90.0, 10.0))
    spark.createDataFrame([row, row], f"doc_id string, page_idx int, span_id int, type string, content string, bbox {BOX}").write.parquet(f"{tmp_path}/spans.parquet")
    df = P.q_char_fill(spark, str(tmp_path))
    assert [tuple(r) for r in df.collect()] == [("a", 0, 1, "one line", False)]
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Generate" not in plan


def test_map_errors(spark):
    df = spark.createDataFrame([("a", "x� y"), ("a", None), ("b", None), ("c", "")], "doc_id string, content string")
    assert {r.doc_id: (r.chars, r.errors, r.share) for r in L.map_errors(df, "doc_id", "content").collect()} == {"a": (3, 1, pytest.approx(1 / 3)), "b": (0, 0, 0.0), "c": (0, 0, 0.0)}


def test_objects_in_tables(spark):
    tables = spark.createDataFrame([("d", 0, 1, (0.0, 0.0, 100.0, 100.0)), ("d", 0, 2, (50.0, 0.0, 150.0, 100.0)), ("e", 0, 3, (0.0, 0.0, 10.0, 10.0))], f"doc_id string, page_idx int, table long, table_box {BOX}")
    items = spark.createDataFrame([("d", 0, 9, (60.0, 10.0, 120.0, 20.0)), ("d", 0, 8, (60.0, 10.0, 70.0, 20.0)), ("d", 0, 7, (300.0, 0.0, 310.0, 9.0)), ("d", 1, 6, (0.0, 0.0, 9.0, 9.0))], f"doc_id string, page_idx int, item long, item_box {BOX}")
    got = {r.item: (r.table, tuple(r.rel)) for r in B.inside_tables(items, tables, ["doc_id", "page_idx"]).collect()}
    assert got == {9: (2, (10.0, 10.0, 70.0, 20.0)), 8: (1, (60.0, 10.0, 70.0, 20.0))}
    assert B.inside_tables(items.limit(0), tables, ["doc_id", "page_idx"]).count() == 0


def test_blank_text_goes(spark):
    df = spark.createDataFrame([(1, "ocr_text", " "), (2, "ocr_text", None), (3, "ocr_text", "a"), (4, "text", ""), (5, None, None)], "id int, label string, text string")
    assert sorted(r.id for r in B.without_blank_text(df, "label", "text").collect()) == [3, 4, 5]


def test_vertical_texts(spark):
    rows = [
        (1, "text", (50.0, 0.0, 60.0, 100.0), 0.0, 10.0, 100.0, 10.0, "始", "中"),
        (2, "text", (38.0, 0.0, 55.0, 90.0), 0.0, 10.0, 60.0, 10.0, "続", "。"),
        (3, "text", (20.0, 0.0, 37.0, 90.0), 0.0, 10.0, 60.0, 10.0, "次", "x"),
        (4, "title", (0.0, 0.0, 1.0, 1.0), None, None, None, None, None, None),
        (5, "text", None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame([("d", 0, *r) for r in rows], f"doc_id string, page_idx int, block_id int, type string, box {BOX}, first_y0 double, first_width double, last_y1 double, last_width double, first_text string, last_text string")
    got = {r.block_id: r.goes_on for r in B.vertical_continuations(df, ["doc_id"], ["page_idx", "block_id"], "block_id").collect()}
    assert got == {1: None, 2: 1, 3: None, 5: None}


def test_grid_of_cells(spark):
    rows = [(1, (0.0, 0.0, 50.0, 40.0)), (2, (52.0, 1.0, 150.0, 20.0)), (3, (51.0, 21.0, 100.0, 40.0)), (4, (101.0, 22.0, 150.0, 41.0))]
    df = spark.createDataFrame([("t", *r) for r in rows], f"table_id string, cell int, box {BOX}")
    got = {r.cell: (r.row_no, r.col_no, r.rowspan, r.colspan) for r in B.grid_spans(df, ["table_id"]).collect()}
    assert got == {1: (0, 0, 2, 1), 2: (0, 1, 1, 2), 3: (1, 1, 1, 1), 4: (1, 2, 1, 1)}
    assert B.grid_spans(df.limit(0), ["table_id"]).count() == 0

"""Layout rules on small pages."""

from pyspark.sql import functions as F

from folioloom.operators import layout as L

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def test_borders(spark):
    rows = [(1, "header", (0.0, 0.0, 9.0, 30.0)), (2, "text", (0.0, 5.0, 9.0, 20.0)), (3, "text", (0.0, 25.0, 9.0, 40.0)), (4, "footer", (0.0, 90.0, 9.0, 99.0)), (5, "text", (0.0, 92.0, 9.0, 98.0)), (6, "image", (0.0, 1.0, 9.0, 2.0)), (7, None, (0.0, 1.0, 9.0, 2.0))]
    df = spark.createDataFrame([(0, k, t, b, 100.0) for k, t, b in rows], f"page int, k int, type string, box {BOX}, height double")
    assert {r.k: r.kind for r in L.border_kinds(df, ["page"]).collect()} == {1: "header", 2: "header", 3: "text", 4: "footer", 5: "footer", 6: "image", 7: None}
    # a header at the foot of the page is a footer
    df = spark.createDataFrame([(0, 1, "header", (0.0, 80.0, 9.0, 90.0), 100.0), (0, 2, "text", (0.0, 85.0, 9.0, 95.0), 100.0)], df.schema)
    assert {r.kind for r in L.border_kinds(df, ["page"]).collect()} == {"footer"}


def test_caption_runs(spark):
    rows = [(1, "caption", ""), (2, "table", ""), (3, "caption", ""), (4, "caption", ""), (5, "image", ""), (6, "text", "Figure 2"), (7, "text", "x"), (8, "caption", ""), (9, "text", "Fig")]
    df = spark.createDataFrame([(0, *r) for r in rows], "page int, k int, type string, content string")
    got = {r.k: r.kind for r in L.office_captions(df, ["page"], ["k"]).collect()}
    assert [got[i] for i in range(1, 10)] == ["table_caption", "table", "table_caption", "table_caption", "image", "image_caption", "text", "text", "text"]


def test_batches():
    assert L.batches([], 8) == []
    assert L.batches([1] * 10, 4) == [(0, 4), (4, 4), (8, 2)]
    assert L.batches([1] * 4 + [100] * 4, 4) == [(0, 4), (4, 1), (5, 1), (6, 1), (7, 1)]
    assert sum(n for _, n in L.batches(sorted(range(1, 200)), 16, 2)) == 199


def test_cells_and_uris(spark):
    w = spark.createDataFrame([(1, "a", (0.0, 0.0, 4.0, 4.0)), (1, "b", (50.0, 50.0, 51.0, 51.0))], f"t int, w string, word_box {BOX}")
    c = spark.createDataFrame([(1, 7, (0.0, 0.0, 5.0, 5.0)), (1, 8, (3.0, 3.0, 9.0, 9.0))], f"t int, c int, cell_box {BOX}")
    assert [tuple(r) for r in L.match_cells(w, c, ["t"], "w", "c").collect()] == [(1, "a", 7)]
    uris = spark.createDataFrame([("data:image/png;base64,QUJD",), ("data:image/png;base64,??",), ("x",), (None,)], "u string")
    assert [r[0] is None for r in uris.select(L.data_uri_name(F.col("u"))).collect()] == [False, True, True, True]


def test_promotion_of_titles(spark):
    rows = [("s", 1, 30.0, True), ("s", 2, 24.0, True), ("s", 3, 24.0, True), ("s", 4, 12.0, False), ("s", 5, 12.0, False), ("s", 6, None, True), ("u", 7, 14.0, True), ("u", 8, 12.0, False)]
    df = spark.createDataFrame(rows, "slide string, k int, size double, bold boolean")
    assert {r.k: r.level for r in L.promoted_titles(df, ["slide"], "k").collect()} == {1: 2, 2: 3, 3: 3}
    assert L.common_size(df, ["slide"], "size").where("slide = 's'").first().size == 12.0

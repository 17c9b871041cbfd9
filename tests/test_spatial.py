"""Spatial operators against plain loops."""

import random

from pyspark.sql import functions as F

from folioloom.operators import spatial as S


def boxes(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        x, y = r.uniform(0, 400), r.uniform(0, 600)
        out.append((i, r.random(), (x, y, x + r.uniform(1, 150), y + r.uniform(1, 120))))
    return out


def test_overlap_pairs_equal_a_double_loop(spark):
    rows = [(k % 3, k, b) for k, _, b in boxes(150, 1)]
    df = spark.createDataFrame([(p, k, *b) for p, k, b in rows], "page int, key int, x0 double, y0 double, x1 double, y1 double")
    a = df.select("page", F.col("key").alias("a"), F.struct("x0", "y0", "x1", "y1").alias("a_box"))
    b = df.select("page", F.col("key").alias("b"), F.struct("x0", "y0", "x1", "y1").alias("b_box"))
    got = sorted((r.a, r.b) for r in S.overlapping(a, b, ["page"], "a_box", "b_box").collect())
    touch = lambda p, q: p[0] <= q[2] and q[0] <= p[2] and p[1] <= q[3] and q[1] <= p[3]
    assert got == sorted((i, j) for pi, i, p in rows for pj, j, q in rows if pi == pj and touch(p, q))


def test_best_boxes():
    kept = S.keep_best([(1, 0.5, (0, 0, 10, 10)), (2, 0.9, (0, 0, 10, 10.2)), (3, 0.4, (50, 50, 60, 60)), (4, 0.5, (0, 0, 10, 5))])
    assert kept == [2, 3, 4]
    assert S.keep_best([]) == []


def test_merged_boxes_reach_a_fixpoint():
    rows = [(k, b) for k, _, b in boxes(60, 2)]
    out = S.merge_boxes(rows)
    assert all(S._smaller_share(p, q) < 0.7 for i, (_, p) in enumerate(out) for _, q in out[i + 1 :])
    assert S.merge_boxes([(1, (0, 0, 10, 10)), (2, (1, 1, 9, 9)), (3, (40, 40, 50, 50))]) == [(1, (0, 0, 10, 10)), (3, (40, 40, 50, 50))]


def test_subtraction():
    r = random.Random(3)
    for _ in range(300):
        masks = [(a, a + r.randint(0, 8)) for a in (r.randint(-5, 45) for _ in range(r.randint(0, 5)))]
        left = {x for x in range(0, 41) if not any(a <= x <= b for a, b in masks)}
        got = S.subtract((0, 40), masks)
        assert {x for a, b in got for x in range(a, b + 1)} == left and all(b[0] > a[1] + 1 for a, b in zip(got, got[1:], strict=False))


def test_union_area():
    r = random.Random(4)
    for _ in range(100):
        bs = [(x, y, x + r.randint(1, 6), y + r.randint(1, 6)) for x, y in ((r.randint(0, 9), r.randint(0, 9)) for _ in range(6))]
        assert S.union_area(bs) == len({(x, y) for a, b, c, d in bs for x in range(a, c) for y in range(b, d)})


def test_islands_and_lines(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", 3, 5), ("a", 7, 8), ("b", 0, 1), ("a", 2, 2)], "g string, s int, e int")
    assert sorted(map(tuple, S.islands(df, ["g"], "s", "e").collect())) == [("a", 1, 5, 3), ("a", 7, 8, 1), ("b", 0, 1, 1)]
    rows = [(1, 0.0, 0.0, 5.0, 10.0), (2, 6.0, 1.0, 9.0, 11.0), (3, 0.0, 20.0, 5.0, 30.0), (4, 8.0, 27.0, 9.0, 37.0)]
    d = spark.createDataFrame(rows, "k int, x0 double, y0 double, x1 double, y1 double").select(F.lit(1).alias("page"), "k", F.struct("x0", "y0", "x1", "y1").alias("box"))
    assert {r.k: r.line_no for r in S.line_of(d, ["page"], "box").collect()} == {1: 0, 2: 0, 3: 1, 4: 2}


def test_empty(spark):
    e = spark.createDataFrame([], "page int, key int, box struct<x0:double,y0:double,x1:double,y1:double>")
    assert S.without_nested(e, ["page"], "key", "box").count() == 0 == S.without_contained(e, ["page"], "key", "box").count()

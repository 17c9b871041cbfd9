"""Steps of recognisers, covered areas, ranges that are left, language models."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from folioloom.functions.text import ocr_language
from folioloom.operators import characters as C
from folioloom.operators import spatial as S
from folioloom.operators.order import unique_stems
from folioloom.runtime import running_sum
from folioloom.streaming.pages import windows_of_pages


def test_steps_decode(spark):
    steps = "array<struct<label:string,p:double>>"
    df = spark.createDataFrame([(1, [("a", 0.5), ("a", 0.9), ("", 1.0), ("a", 0.7), ("b", 0.6)]), (2, []), (3, None), (4, [("", 1.0)])], f"id int, s {steps}")
    got = {r.id: r.d for r in df.select("id", C.ctc_steps(F.col("s")).alias("d")).collect()}
    assert list(got[1].labels) == ["a", "a", "b"] and got[1].confidence == pytest.approx(0.6)
    assert list(got[2].labels) == [] == list(got[4].labels) and got[2].confidence == 0.0 and got[3] is None
    assert C.ctc([(1, 0.5), (1, 0.9), (0, 1.0), (1, 0.7), (2, 0.6)]) == ([1, 1, 2], pytest.approx(0.6))


def test_covered_area_by_cells(spark):
    rng = random.Random(3)
    rows = [(k % 7, float(x), float(y), float(x + rng.randrange(5)), float(y + rng.randrange(5))) for k in range(60) for x, y in [(rng.randrange(12), rng.randrange(12))]]
    want = {}
    for p in range(7):
        own = [r[1:] for r in rows if r[0] == p]
        want[p] = sum(any(b[0] <= i < b[2] and b[1] <= j < b[3] for b in own) for i, j in itertools.product(range(20), range(20)))
    df = spark.createDataFrame([*rows, (9, None, 0.0, 1.0, 1.0)], "page int, x0 double, y0 double, x1 double, y1 double")
    assert {r.page: r.area for r in S.covered_area(df, ["page"]).collect()} == pytest.approx({**want, 9: 0.0})
    assert S.covered_area(df.limit(0), ["page"]).count() == 0


def test_ranges_left(spark):
    rng = random.Random(5)
    rows = [(k, 0, rng.randrange(0, 20), [(a, a + rng.randrange(4)) for a in (rng.randrange(-3, 22) for _ in range(rng.randrange(5)))]) for k in range(60)]
    df = spark.createDataFrame(rows, "id int, a int, b int, m array<struct<a:int,b:int>>")
    for r in df.select("id", "a", "b", "m", S.ranges_left(F.col("a"), F.col("b"), F.col("m")).alias("left")).collect():
        left = {x for a, b in r.left for x in range(a, b + 1)}
        assert left == set(range(r.a, r.b + 1)) - {x for a, b in r.m for x in range(a, b + 1)}
        assert [tuple(x) for x in r.left] == S.subtract((r.a, r.b), [tuple(x) for x in r.m])


def test_languages_of_recognisers(spark):
    df = spark.createDataFrame([(x,) for x in (None, "", "en", "ru", "kk", "hi", "fa", "seal", "korean")], "l string")
    got = [tuple(r) for r in df.select(ocr_language(F.col("l")), ocr_language(F.col("l"), cpu=True)).collect()]
    assert got == [("ch", "ch")] * 3 + [("east_slavic",) * 2, ("cyrillic",) * 2, ("devanagari",) * 2, ("arabic",) * 2, ("seal", "seal_lite"), ("korean",) * 2]


def test_running_sums_over_stretches(spark):
    rng = random.Random(2)
    rows = [("a" if rng.random() < 0.8 else "b", rng.randrange(40_000), k, rng.randrange(5)) for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, v long, k int, n int")
    got = {r.k: r.s for r in running_sum(df, ["g"], "v", ["k"], F.col("n"), "s").collect()}
    for g in "ab":
        total = 0
        for _, _, k, n in sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2])):
            total += n
            assert got[k] == total


def test_stems_of_one_name(spark):
    names = ["Scan"] * 30 + ["scan_2", "SCAN_4", "scan_4", "scan_12345678", "other", None]
    rows = list(enumerate(names))
    random.Random(1).shuffle(rows)
    got = {r.id: r.unique for r in unique_stems(spark.createDataFrame(rows, "id long, stem string"), "id", "stem").collect()}
    taken, want = {n.lower() for n in names if n}, {}
    seen: dict[str, int] = {}
    for k, name in enumerate(names):
        if name is None:
            continue
        if name.lower() not in seen:
            seen[name.lower()], want[k] = 1, name
            continue
        n = seen[name.lower()] + 1
        while f"{name.lower()}_{n}" in taken:
            n += 1
        seen[name.lower()], want[k] = n, f"{name}_{n}"
    assert got == want and len({v.lower() for v in got.values()}) == len(got)


def test_requests_of_many_files(spark):
    files = spark.createDataFrame([(o, k, f"{o}-{k:05}", 1 + k % 3) for o in (1, 2) for k in range(2000)], "submit_order long, k int, doc_id string, page_count int")
    got = {(r.doc_id, r.page_idx): r.window_no for r in windows_of_pages(files, order=("submit_order", "k")).collect()}
    at = 0
    for o in (1, 2):
        for k in range(2000):
            for p in range(1 + k % 3):
                assert got[f"{o}-{k:05}", p] == at // 64
                at += 1


def test_far_boxes_are_few_rows(spark):
    box = "struct<x0:double,y0:double,x1:double,y1:double>"
    a = spark.createDataFrame([(0, 1, (0.0, -1e9, 10.0, 1e9)), (0, 2, (5.0, 9e8, 6.0, 9.1e8))], f"page int, a int, a_box {box}")
    b = spark.createDataFrame([(0, 3, (0.0, 5e8, 9.0, 9.5e8)), (0, 4, (0.0, 0.0, 9.0, 1.0))], f"page int, b int, b_box {box}")
    got = sorted((r.a, r.b) for r in S.overlapping(a, b, ["page"], "a_box", "b_box").collect())
    assert got == [(1, 3), (1, 4), (2, 3)]

"""Orders, packing, sheets, characters and formulas."""

import random

import pytest

from folioloom.operators import characters as C
from folioloom.operators import latex as L
from folioloom.operators import order as O
from folioloom.operators.sequence import SectionNumbers
from folioloom.plans import order as P


def test_xy_order_of_two_columns():
    page = [(0, 0, 200, 20), (0, 40, 90, 60), (110, 40, 200, 60), (0, 70, 90, 90), (110, 70, 200, 90)]
    # the gap between the columns (20) is wider than those between rows (10 and 20 below the title)
    assert O.xy_order(page) == [0, 1, 3, 2, 4]
    assert O.xy_order([(0, 0, 10, 10), None, (0, 20, 10, 20)]) == [0] and O.xy_order([None]) == [0] and O.xy_order([]) == []


def test_xy_order_is_a_permutation():
    r = random.Random(1)
    for _ in range(200):
        boxes = [(x, y, x + r.randint(1, 60), y + r.randint(1, 30)) for x, y in ((r.randint(0, 200), r.randint(0, 300)) for _ in range(r.randint(0, 25)))]
        assert sorted(O.xy_order(boxes)) == list(range(len(boxes)))


def test_row_order():
    assert O.row_order([(50, 0, 60, 10), (0, 4, 10, 14), (0, 30, 5, 40)]) == [1, 0, 2]
    assert O.row_order([(50, 0, 60, 10), (0, 9, 10, 14), (30, 18, 40, 28)]) == [1, 0, 2]


def test_packing():
    assert O.pack([("a", 5), ("b", 9), ("c", 3), ("d", 3), ("e", 2)], 8) == [["b"], ["a", "c"], ["d", "e"]]
    r = random.Random(2)
    docs = [(str(i), r.randint(1, 12)) for i in range(60)]
    bins = O.pack(docs, 10)
    size = dict(docs)
    assert sorted(x for b in bins for x in b) == sorted(size) and all(len(b) == 1 or sum(size[x] for x in b) <= 10 for b in bins)


def test_unique_stems(spark):
    names = ["a", "A", "a_2", "a", "b", "a_4", "B_2", "b", "c"]
    df = spark.createDataFrame(list(enumerate(names)), "k int, stem string")
    got = [r.unique for r in sorted(O.unique_stems(df, "k", "stem").collect())]
    assert len({g.lower() for g in got}) == len(got) and got[0] == "a" and got[2] == "a_2" and got[4] == "b" and got[8] == "c"
    assert got[1] == "A_3" and got[3] == "a_5" and got[7] == "b_3"


def test_sheet_regions():
    block = lambda r, c, h, w: [(i, j, 1, 1) for i in range(r, r + h) for j in range(c, c + w)]
    cells = block(0, 0, 3, 3) + block(0, 5, 2, 2) + block(8, 0, 1, 1)
    assert O.regions(cells, 0) == [(0, 0, 2, 2), (0, 5, 1, 6), (8, 0, 8, 0)]
    assert O.regions(cells, 2) == [(0, 0, 2, 6), (8, 0, 8, 0)]
    assert O.regions([(0, 0, 2, 3), (2, 2, 1, 1)], 0) == [(0, 0, 2, 2)]
    assert O.sheet_tables(block(0, 0, 3, 3) + block(10, 0, 3, 3)) == [(0, 0, 2, 2), (10, 0, 12, 2)] and O.sheet_tables([]) == []


def test_surrogates():
    assert C.join_surrogates([0xD835, 0xDC4B]) == [(0x1D44B, 0)]
    assert C.join_surrogates([0x66, 0xD835, 0xDC4B, 0x3D]) == [(0x66, 0), (0x1D44B, 1), (0x3D, 3)]
    assert [c for c, _ in C.join_surrogates([0xD835, 0x21])] == [0xFFFD, 0x21] and [c for c, _ in C.join_surrogates([0xDC4B])] == [0xFFFD] and C.join_surrogates([]) == []


B, A = (100.0, 200.0, 105.0, 210.0), (90.0, 200.0, 95.0, 210.0)


@pytest.mark.parametrize(
    ("chars", "text"),
    [
        ([("d", A), ("f", B), ("f", B)], "dff"),
        ([("a", A), ("t", B), ("t", B)], "att"),
        ([("x", B), ("y", (200.0, 200.0, 205.0, 210.0)), ("x", B)], "xy"),
        ([("f", B), ("i", B)], "fi"),
        ([("f", B), ("f", (100.4, 200.4, 105.4, 210.4))], "f"),
        ([("f", B), ("f", (102.0, 202.0, 107.0, 212.0))], "f"),
        ([("f", B), ("f", (106.0, 200.0, 111.0, 210.0))], "ff"),
    ],
)
def test_characters_drawn_twice(chars, text):
    seen = C.Distinct()
    assert "".join(t for t, b in chars if seen.keep(C.Char(t, b))) == text


def test_content_of_characters():
    row = lambda s, y=0.0, h=10.0, x=0.0: [C.Char(c, (x + 6 * i, y, x + 6 * i + 5, y + h)) for i, c in enumerate(s)]
    assert C.content(row("ab") + row("cd", x=20.0)) == "ab cd"
    assert C.content(row("x") + row("2", y=-4.0, h=6.0, x=6.0) + row("y", x=12.0)) == "x<sup>2</sup>y"
    assert C.content(row("eﬃ")) == "effi" and C.content([]) == ""
    assert C.ctc([(0, 0.9), (3, 0.8), (3, 0.7), (0, 0.9), (3, 0.6), (5, 1.0)]) == ([3, 3, 5], pytest.approx(0.8))


def test_formulas():
    assert L.balanced_braces("a}{b}{c") == "a{b}c"
    assert L.paired_delimiters(r"\left( x \right)") == r"\left( x \right)"
    assert L.paired_delimiters(r"{\left( x} \right)") == r"{( x} )"
    assert L.tightened(r"\frac { a } { b } + \alpha x") == r"\frac{a}{b}+\alpha x"
    assert L.cleaned(None) is None and L.cleaned(r"\lefteqn{a}") == "{a}"


def test_section_numbers(spark):
    n = SectionNumbers()
    assert [n(*x) for x in [(1, True, None), (2, True, None), (2, True, None), (1, True, None), (3, True, None), (2, False, None), (2, False, [4, 7]), (2, True, None), (0, True, None)]] == ["1", "1.1", "1.2", "2", "2.1.1", None, None, "4.8", None]


def test_characters_of_all_blocks(spark, tmp_path):
    texts = ["aa bb\n", "the long content of a block " * 200, "é\U0001d44b漢", "", None, "title"]
    kinds = ["text", "list", None, "code", "text", "title"]
    spark.createDataFrame(list(zip(range(6), kinds, texts, strict=True)), "block_id long, type string, content string").write.parquet(f"{tmp_path}/blocks.parquet")
    got = sorted(map(tuple, P.q_dedup_chars(spark, str(tmp_path)).collect()))
    assert got == [(i, 2 * k, c, 6.0 * k, 100.0, 6.0 * k + 5, 110.0) for i, t in enumerate(texts) for k, c in enumerate(t or "")]

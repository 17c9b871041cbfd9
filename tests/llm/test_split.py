"""Pieces of oversized texts: limits, overlap, losslessness and the best cuts."""

import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioloom.llm import split as S

TEXTS = st.lists(st.sampled_from(["word", " ", ". ", "\n", "\n\n", ", ", "长文本", "。", "\u00e9", "e\u0301", "x" * 30, "👩\u200d🔬", "\r\n", "    "]), max_size=150).map("".join)


@settings(max_examples=300, deadline=None)
@given(text=TEXTS, size=st.integers(1, 60), overlap=st.integers(0, 70), code=st.booleans())
def test_limits_hold(text, size, overlap, code):
    pieces = S.split(text, size, overlap, code)
    assert pieces[0].start == 0 and pieces[-1].end == len(text)
    assert all(p.end - p.start <= size for p in pieces)
    assert "".join(text[p.start + p.overlap : p.end] for p in pieces) == text
    if len(text) > size:
        want = overlap if overlap < size else size // 2
        assert all(b.overlap == want and b.start == a.end - want for a, b in itertools.pairwise(pieces))


def test_large_overlaps_are_exact():
    for overlap in (51, 70, 99):
        pieces = S.split("word " * 60, 100, overlap)
        assert len(pieces) > 1 and all(b.start == a.end - overlap for a, b in itertools.pairwise(pieces))
    assert [p.overlap for p in S.split("word " * 60, 100, 100)][1:3] == [50, 50]


def best_cost(text, size, overlap, code):
    """Every set of cuts, tried out."""
    step = size - overlap
    at, price, _ = S.boundaries(text, step, code)
    n, m = len(text), len(at)
    count = 1 + -(-(n - size) // step)
    even = (n + overlap * (count - 1)) / count
    best = np.inf
    for k in range(m - 1):
        for inner in itertools.combinations(range(1, m - 1), k):
            ends = [*inner, m - 1]
            starts = [0, *[at[i] - overlap for i in inner]]
            if any(at[i] <= overlap for i in inner):
                continue
            sizes = [at[e] - s for s, e in zip(starts, ends, strict=True)]
            if all(x <= size for x in sizes):
                best = min(best, sum(price[e] + S.PIECE + S.UNEVEN * ((x - even) / even) ** 2 for e, x in zip(ends, sizes, strict=True)))
    return best


@pytest.mark.parametrize("text", ["aa bb. cc, dd\n\nee ff gg. hh", "一二三。四五六，七八九。十", "a b c d e f g h i j k"])
@pytest.mark.parametrize(("size", "overlap"), [(8, 0), (9, 2), (12, 3), (12, 8)])
def test_cuts_are_optimal(text, size, overlap):
    pieces = S.split(text, size, overlap)
    at, price, _ = S.boundaries(text, size - overlap, False)
    count = 1 + -(-(len(text) - size) // (size - overlap))
    even = (len(text) + overlap * (count - 1)) / count
    cost = sum(dict(zip(at, price, strict=True))[p.end] + S.PIECE + S.UNEVEN * ((p.end - p.start - even) / even) ** 2 for p in pieces)
    assert cost == pytest.approx(best_cost(text, size, overlap, False))


def test_prefers_natural_boundaries():
    text = "First sentence here. Second one follows.\n\nA new paragraph begins and goes on."
    assert [text[p.start : p.end] for p in S.split(text, 50)] == ["First sentence here. Second one follows.\n\n", "A new paragraph begins and goes on."]
    assert all(p.end % 2 == 0 for p in S.split("e\u0301" * 100, 31))


def test_frames(spark):
    blocks = spark.createDataFrame(
        [(1, "text", None, "x"), (2, "text", "", "x"), (3, None, "a" * 50, "x"), (4, "text", "a b " * 10, "x"), (4, "text", "a b " * 10, "x"), (5, "other", "a" * 50, "x"), (6, "bad", "a" * 50, "x"), (7, "text", "ab " * 100_000, "x")],
        "block_id long, type string, content string, max_chars string",
    )
    limits = spark.createDataFrame([("text", 20, 5), ("text", 20, 5), ("bad", 0, 1), ("bad", None, None)], "type string, max_chars int, overlap_chars int")
    out = S.split_blocks(blocks, limits).collect()
    assert {r.block_id for r in out} == {4, 7}
    four = sorted((r.piece_no, r.piece) for r in out if r.block_id == 4)
    assert four[::2] == four[1::2] and all(len(p) <= 20 for _, p in four)
    assert S.split_blocks(blocks.limit(0), limits).count() == 0 == S.split_blocks(blocks, limits.limit(0)).count()

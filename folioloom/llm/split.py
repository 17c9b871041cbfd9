"""Cutting oversized texts at natural boundaries (problem 5).

Dynamic programming over the boundary positions of a text: a cut costs a
penalty by its kind (paragraph 0, line, sentence, clause, blank, inside a
word) and each piece the square of its deviation from an even size, subject to
the largest size and an overlap of exactly so many characters between
consecutive pieces. Without their overlaps the pieces give back the text.

Defined results: sizes are Unicode characters. Null texts, types without a
limit and limits that are null or below 1 give no rows. Texts within the limit
aren't split. An overlap of the limit or more would leave no room for new text
and is shortened to half of the limit; any smaller one is kept exactly. Where two limits name a type, the smaller size and the smaller overlap
hold. Stretches without any boundary are cut between whole grapheme clusters,
inside of one only where it alone exceeds the limit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.llm.arrow import map_rows

#: Kinds of cuts and their penalties in prose and in code, where sentences mean nothing.
KINDS = ("paragraph", "line", "sentence", "clause", "blank", "word")
PROSE = np.array([0.0, 0.15, 0.3, 1.0, 2.0, 8.0])
CODE = np.array([0.0, 0.15, 3.0, 3.0, 2.5, 8.0])
#: What each piece costs, and the weight of its uneven size.
PIECE, UNEVEN = 0.5, 1.0

_BOUNDARY = re.compile(
    r"(?P<paragraph>\r?\n[^\S\n]*(?:\r?\n\s*)+)|(?P<line>\r?\n[^\S\n]*)|(?P<sentence>[.!?…]+[\"'”’»)\]]*[^\S\r\n]+|[。！？…]+[”’」』）]*)"
    r"|(?P<clause>[,;:][^\S\r\n]+|[^\S\r\n]+[–—][^\S\r\n]+|[，；：、])|(?P<blank>[^\S\r\n]+)"
)
#: Characters that never begin a piece: marks, joiners, variation selectors, skin tones.
_INNER = re.compile("[\\u0300-\\u036f\\u0483-\\u0489\\u0591-\\u05bd\\u0610-\\u061a\\u064b-\\u065f\\u0900-\\u0903\\u093a-\\u094f\\u0e31-\\u0e4e\\u1ab0-\\u1aff\\u1dc0-\\u1dff\\u200c\\u200d\\u20d0-\\u20ff\\u3099\\u309a\\ufe00-\\ufe0f\\ufe20-\\ufe2f\U0001f3fb-\U0001f3ff\U000e0100-\U000e01ef]")


@dataclass(frozen=True)
class Piece:
    start: int
    end: int
    overlap: int
    cut: str | None


def _whole_clusters(text: str, at: int, low: int, high: int) -> int:
    """The position nearest to ``at``, above ``low`` and up to ``high``, that doesn't cut a cluster; ``at`` if there is none."""

    def cuts(k: int) -> bool:
        return bool(_INNER.match(text[k])) or text[k - 1] == "\u200d" or text[k - 1 : k + 1] == "\r\n"

    for k in (*range(at, low, -1), *range(at + 1, min(high, len(text) - 1) + 1)):
        if not cuts(k):
            return k
    return at


def boundaries(text: str, step: int, code: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, penalties and kinds of possible cuts, with both ends of the text."""
    n = len(text)
    at, kinds = [0], [0]
    prices = CODE if code else PROSE
    fine = max(1, step // 16)
    for m in [*_BOUNDARY.finditer(text), None]:
        end = n if m is None else m.end()
        if code and m is not None and m.lastgroup in ("paragraph", "line"):
            end = m.start() + text[m.start() : end].rindex("\n") + 1  # the indent belongs to its line
        if end <= at[-1]:
            continue
        while end - at[-1] > step:  # nothing natural in reach
            k = _whole_clusters(text, at[-1] + fine, at[-1], at[-1] + step)
            at.append(k)
            kinds.append(5)
        at.append(end)
        kinds.append(0 if m is None else KINDS.index(m.lastgroup))
    positions, kind = np.array(at), np.array(kinds)
    price = prices[kind].copy()
    if code:  # a line that is indented belongs to the one above
        price += [0.6 if k == 1 and p < n and text[p] in " \t})" else 0.0 for p, k in zip(at, kinds, strict=True)]
    price[-1] = 0.0
    return positions, price, kind


def split(text: str, max_chars: int, overlap: int = 0, code: bool = False) -> list[Piece]:
    """Pieces in order; one for a text within the limit."""
    n = len(text)
    if n <= max_chars:
        return [Piece(0, n, 0, None)]
    overlap = max(overlap, 0) if overlap < max_chars else max_chars // 2
    step = max_chars - overlap
    at, price, kind = boundaries(text, step, code)
    pieces = 1 + -(-(n - max_chars) // step)
    even = (n + overlap * (pieces - 1)) / pieces
    m = len(at)
    cost = np.full(m, np.inf)
    cost[0] = 0.0
    back = np.zeros(m, np.int64)
    # the first piece has no overlap before it, so it may reach further
    lowest = np.searchsorted(at, at - step)
    start = at - overlap
    start[0] = 0
    for j in range(1, m):
        if at[j] <= overlap:
            continue  # a piece that ends here would be too short for the overlap of the next
        low = lowest[j] if at[j] > max_chars else 0
        size = at[j] - start[low:j]
        total = cost[low:j] + PIECE + UNEVEN * ((size - even) / even) ** 2
        total[size > max_chars] = np.inf
        best = int(np.argmin(total))
        cost[j] = total[best] + price[j]
        back[j] = low + best
    cuts, j = [m - 1], m - 1
    while j:
        j = int(back[j])
        cuts.append(j)
    cuts.reverse()
    return [Piece(int(start[a]), int(at[b]), overlap if a else 0, KINDS[kind[b]] if b < m - 1 else None) for a, b in zip(cuts, cuts[1:], strict=False)]


def split_blocks(blocks: DataFrame, limits: DataFrame, id_col: str = "block_id", text_col: str = "content", type_col: str = "type") -> DataFrame:
    """The ordered pieces of every text longer than the limit of its type.

    Lengths are compared in the scan's stage; only oversized texts reach
    Python. ``limits`` has a row per type, so it is broadcast by its measured
    size; nothing else moves.
    """
    bound = limits.groupBy(F.col("type").alias("_type")).agg(F.min("max_chars").alias("_max"), F.min(F.coalesce("overlap_chars", F.lit(0))).alias("_overlap")).where("_max >= 1")
    own = blocks.select(F.col(id_col).alias("_id"), F.col(type_col).alias("_type"), F.col(text_col).alias("_text"))
    over = own.join(bound, "_type").where(F.length("_text") > F.col("_max"))
    schema = T.StructType(
        [
            T.StructField(id_col, blocks.schema[id_col].dataType),
            T.StructField("type", T.StringType()),
            *[T.StructField(c, T.IntegerType()) for c in ("piece_no", "n_pieces", "start_char", "end_char", "overlap")],
            T.StructField("cut", T.StringType()),
            T.StructField("piece", T.StringType()),
        ]
    )

    def rows(columns: list[list]) -> Iterator[tuple]:
        for i, kind, text, size, overlap in zip(*columns, strict=True):
            pieces = split(text, size, overlap, code=kind == "code")
            for k, p in enumerate(pieces):
                yield i, kind, k, len(pieces), p.start, p.end, p.overlap, p.cut, text[p.start : p.end]

    return map_rows(over, {c: c for c in ("_id", "_type", "_text", "_max", "_overlap")}, schema, rows)

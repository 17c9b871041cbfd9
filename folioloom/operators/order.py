"""Reading order of boxes, and orders that a running state decides.

Pages, sheets and plans are folded one at a time; each is as small as the page
it describes. What can be a window elsewhere is one.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.runtime import running_sum

Box = tuple[float, float, float, float]

#: Fixed values of the recursive cut.
MIN_GAP, NARROW = 5.0, 0.1


# ---- recursive XY cut


def _widest_gap(spans: list[tuple[float, float]]) -> tuple[float, float]:
    """(position, width) of the widest gap that no span covers; the first of equal ones."""
    best, at, reach = 0.0, 0.0, None
    for low, high in sorted(spans):
        if reach is not None and low > reach and low - reach > best:
            best, at = low - reach, (low + reach) / 2
        reach = high if reach is None else max(reach, high)
    return at, best


def xy_order(boxes: list[Box | None]) -> list[int]:
    """Positions of the boxes in reading order.

    A region is cut at its widest gap of at least MIN_GAP, across or down (down
    if both are as wide); where wide elements bridge the columns, narrow ones
    may be left out of the search. What can't be cut goes from top to bottom,
    then left to right. Invalid boxes drop out, unless there is but one.
    """
    if len(boxes) <= 1:
        return list(range(len(boxes)))
    valid = [i for i, b in enumerate(boxes) if b is not None and all(v is not None for v in b) and b[2] > b[0] and b[3] > b[1]]
    out: list[int] = []
    todo = [valid]
    while todo:
        region = todo.pop()
        if len(region) <= 1:
            out += region
            continue
        across = _widest_gap([(boxes[i][1], boxes[i][3]) for i in region])
        down = _widest_gap([(boxes[i][0], boxes[i][2]) for i in region])
        if down[1] < MIN_GAP and len(region) >= 3:
            width = max(boxes[i][2] for i in region) - min(boxes[i][0] for i in region)
            wide = [i for i in region if boxes[i][2] - boxes[i][0] >= width * NARROW]
            if 2 <= len(wide) < len(region):
                again = _widest_gap([(boxes[i][0], boxes[i][2]) for i in wide])
                if again[1] > down[1] and again[1] >= MIN_GAP:
                    down = again
        horizontal = across[1] >= MIN_GAP and (down[1] < MIN_GAP or across[1] > down[1])
        if not horizontal and down[1] < MIN_GAP:
            out += sorted(region, key=lambda i: (boxes[i][1], boxes[i][0]))
            continue
        k, cut = (1, across[0]) if horizontal else (0, down[0])
        first = [i for i in region if (boxes[i][k] + boxes[i][k + 2]) / 2 < cut]
        rest = [i for i in region if (boxes[i][k] + boxes[i][k + 2]) / 2 >= cut]
        if not first or not rest:
            out += sorted(region, key=lambda i: (boxes[i][1], boxes[i][0]))
        else:
            todo += [rest, first]
    return out


def row_order(boxes: list[Box], close: float = 10.0) -> list[int]:
    """From top to bottom; neighbours whose tops differ by less than ``close`` change places until they run left to right."""
    order = sorted(range(len(boxes)), key=lambda i: (boxes[i][1], boxes[i][0]))
    for i in range(len(order) - 1):
        for j in range(i, -1, -1):
            a, b = boxes[order[j]], boxes[order[j + 1]]
            if abs(b[1] - a[1]) < close and b[0] < a[0]:
                order[j], order[j + 1] = order[j + 1], order[j]
            else:
                break
    return order


def ordered_pages(blocks: DataFrame, page: list[str], key: str, rows: bool = False) -> DataFrame:
    """(page, key, position) by the recursive cut, or by rows; ``blocks`` has x0, y0, x1, y1.

    The boxes of a page are one array, so many pages go to Python in a batch.
    """
    kind = blocks.schema[key].dataType

    @F.pandas_udf(T.ArrayType(T.StructType([T.StructField(key, kind), T.StructField("position", T.IntegerType())])))
    def ordered(pages: pd.Series) -> pd.Series:
        def one(boxes) -> list[tuple]:
            flat = [tuple(b[c] for c in ("x0", "y0", "x1", "y1")) for b in boxes]
            order = row_order(flat) if rows else xy_order([None if any(pd.isna(v) for v in b) else b for b in flat])
            return [(boxes[i][key], n) for n, i in enumerate(order)]

        return pages.map(one)

    boxes = F.array_sort(F.collect_list(F.struct(key, "x0", "y0", "x1", "y1")))
    per = blocks.groupBy(*page).agg(boxes.alias("boxes"))
    return per.select(*page, F.explode(ordered("boxes")).alias("o")).select(*page, f"o.{key}", "o.position")


# ---- plans


def pack(documents: Iterable[tuple[str, int]], window: int) -> list[list[str]]:
    """Documents (name, pages) in bins of at most ``window`` pages: the larger first, each into the emptiest bin it fits; too large ones alone."""
    bins: list[tuple[int, list[str]]] = []
    for k, (name, pages) in sorted(enumerate(documents), key=lambda x: (-x[1][1], x[0])):
        fits = [(load, i) for i, (load, _) in enumerate(bins) if load + pages <= window]
        if pages > window or not fits:
            bins.append((pages, [name]))
        else:
            load, i = min(fits)
            bins[i] = (load + pages, [*bins[i][1], name])
    return [names for _, names in bins]


def unique_stems(stems: DataFrame, key: str, stem: str) -> DataFrame:
    """(key, stem, unique): later stems that equal an earlier one but for case get _2, _3, ...

    Numbers that would collide with a literal name of the same root are
    skipped: of the numbers taken, in order t1, t2, ..., the i-th moves all
    namesakes from the (ti - i + 1)-th on by one. Ranks are running counts in
    two steps, so a stem that a third of all files share is no one task's.
    Keys are whole numbers; null stems drop out.
    """
    named = stems.select(key, stem).where(F.col(stem).isNotNull() & F.col(key).isNotNull()).withColumn("_low", F.lower(stem))
    ranked = running_sum(named, ["_low"], key, [stem], F.lit(1), "_n")
    # literal names "root_number" of other files
    form = r"^(.*)_([1-9]\d{0,17})$"
    literal = named.select(F.regexp_extract("_low", form, 1).alias("_low"), F.regexp_extract("_low", form, 2).try_cast("bigint").alias("_k")).where("_k >= 2").distinct()
    again = ranked.where("_n = 2").select("_low")
    taken = running_sum(literal.join(again, "_low", "left_semi"), ["_low"], "_k", [], F.lit(1), "_i").select("_low", (F.col("_k") - F.col("_i") + 1).alias("_n"))
    # how many thresholds lie at or below each rank
    empty = [F.lit(None).cast(named.schema[c].dataType).alias(c) for c in (key, stem)]
    both = ranked.select(key, stem, "_low", "_n", F.lit(0).alias("_t")).unionByName(taken.select(*empty, "_low", "_n", F.lit(1).alias("_t")))
    moved = running_sum(both.withColumn("_order", 1 - F.col("_t")), ["_low"], "_n", ["_order"], F.col("_t"), "_moved")
    number = (F.col("_n") + F.col("_moved")).cast("string")
    return moved.where("_t = 0").select(key, stem, F.when(F.col("_n") == 1, F.col(stem)).otherwise(F.concat(F.col(stem), F.lit("_"), number)).alias("unique"))


# ---- sheets


def regions(cells: Iterable[tuple[int, int, int, int]], gap: int) -> list[tuple[int, int, int, int]]:
    """Bounds (row, col, row, col) of the tables of a sheet: cells connected over at most ``gap`` empty ones, merged cells as a whole."""
    owner: dict[tuple[int, int], int] = {}
    areas = []
    for k, (r, c, h, w) in enumerate(cells):
        areas.append((r, c, r + max(1, h) - 1, c + max(1, w) - 1))
        for i in range(r, r + max(1, h)):
            for j in range(c, c + max(1, w)):
                owner[i, j] = k
    seen: set[int] = set()
    out = []
    reach = gap + 1
    for start in range(len(areas)):
        if start in seen:
            continue
        seen.add(start)
        queue, bounds = deque([start]), list(areas[start])
        while queue:
            r0, c0, r1, c1 = areas[queue.popleft()]
            bounds = [min(bounds[0], r0), min(bounds[1], c0), max(bounds[2], r1), max(bounds[3], c1)]
            near = [(i, j) for i in range(r0, r1 + 1) for d in range(1, reach + 1) for j in (c0 - d, c1 + d)] + [(i, j) for j in range(c0, c1 + 1) for d in range(1, reach + 1) for i in (r0 - d, r1 + d)]
            for place in near:
                k = owner.get(place)
                if k is not None and k not in seen:
                    seen.add(k)
                    queue.append(k)
        out.append(tuple(bounds))
    return sorted(out)


def gap_penalty(tables: list[dict]) -> float:
    """How bad a division of a sheet into tables is: blank lines within, single cells, sparse or overlapping tables."""
    n = len(tables)
    if not n:
        return 0.0
    share = lambda f: sum(map(f, tables)) / n
    severe = share(lambda t: t["longest_blank"] >= 2)
    return 6 * severe + 2.5 * share(lambda t: t["blank_lines"] > 0) + 1.5 * share(lambda t: t["blank"] > 0.6) + share(lambda t: t["cells"] == 1) + 0.5 * share(lambda t: t["blank"]) + share(lambda t: t["overlap"])


def summarize(bounds: tuple[int, int, int, int], filled: set[tuple[int, int]]) -> dict:
    """Blank share, blank lines and the longest run of them within a table."""
    r0, c0, r1, c1 = bounds
    rows = [any((r, c) in filled for c in range(c0, c1 + 1)) for r in range(r0, r1 + 1)]
    cols = [any((r, c) in filled for r in range(r0, r1 + 1)) for c in range(c0, c1 + 1)]
    area = (r1 - r0 + 1) * (c1 - c0 + 1)
    own = sum((r, c) in filled for r in range(r0, r1 + 1) for c in range(c0, c1 + 1))
    longest = lambda flags: max((len(m) for m in re.findall("0+", "".join("01"[f] for f in flags))), default=0)
    return {"blank": 1 - own / area, "blank_lines": rows.count(False) + cols.count(False), "longest_blank": max(longest(rows), longest(cols)), "cells": own, "overlap": 0}


def sheet_tables(cells: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Tables of a sheet at the gap, of 0, 1 and 2, whose division is least bad; among those within .15 of it, the one with fewest broken tables, then gap 1, 0, 2."""
    filled = {(i, j) for r, c, h, w in cells for i in range(r, r + max(1, h)) for j in range(c, c + max(1, w))}
    found = []
    for gap in (0, 1, 2):
        tables = regions(cells, gap)
        facts = [summarize(t, filled) for t in tables]
        severe = sum(f["longest_blank"] >= 2 for f in facts)
        found.append((gap_penalty(facts), severe, (1, 0, 2).index(gap), sum(f["blank_lines"] for f in facts), tables))
    least = min(f[0] for f in found)
    return min((f for f in found if f[0] <= least + 0.15), key=lambda f: (f[1], f[2], f[3], f[0]))[4]

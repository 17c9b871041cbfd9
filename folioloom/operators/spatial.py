"""Joins and filters of boxes within pages.

Pairs of boxes are found by a grid: both sides are spread over the horizontal
bands they touch and joined on page and band, so no page is crossed with
itself; a pair that shares several bands is kept in the first of them only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.functions import geometry as G

#: Height of a band in points, about three lines of text.
BAND = 40.0


#: Bands beyond these limits are one, so that a box of any size is at most so many rows.
FAR = 2048


def _bands(df: DataFrame, box: str, band: float) -> DataFrame:
    at = lambda y: F.greatest(F.lit(-FAR), F.least(F.lit(FAR), F.floor(F.col(box)[y] / band))).cast("int")
    low, high = at("y0"), at("y1")
    return df.withColumn("_low", low).withColumn("_band", F.explode(F.sequence(low, high)))


def at_points(points: DataFrame, boxes: DataFrame, page: list[str], y: Column, box: str, band: float = BAND) -> DataFrame:
    """Rows of both sides where a point may lie in a box: it is looked up in the one band of its height, so no pair comes twice."""
    at = F.greatest(F.lit(-FAR), F.least(F.lit(FAR), F.floor(y / band))).cast("int")
    return points.withColumn("_band", at).join(_bands(boxes, box, band).drop("_low"), [*page, "_band"]).drop("_band")


def overlapping(a: DataFrame, b: DataFrame, page: list[str], a_box: str, b_box: str, band: float = BAND) -> DataFrame:
    """Pairs of boxes that touch or overlap on a page, each once; boxes must be upright and not null."""
    left = _bands(a, a_box, band).withColumnRenamed("_low", "_a")
    right = _bands(b, b_box, band).withColumnRenamed("_low", "_b")
    joined = left.join(right, [*page, "_band"]).where(F.col("_band") == F.greatest("_a", "_b"))
    p, q = F.col(a_box), F.col(b_box)
    return joined.where((p["x0"] <= q["x1"]) & (q["x0"] <= p["x1"]) & (p["y0"] <= q["y1"]) & (q["y0"] <= p["y1"])).drop("_a", "_b", "_band")


def owners(spans: DataFrame, blocks: DataFrame, page: list[str], span_key: list[str], order: list[str], threshold: float = 0.5) -> DataFrame:
    """Spans with the first block, in reading order, that covers more than ``threshold`` of them.

    Blocks that take their spans in order, each span once, come to the same.
    """
    pairs = overlapping(spans, blocks, page, "span_box", "block_box").where(G.overlap_of_first(F.col("span_box"), F.col("block_box")) > threshold)
    w = Window.partitionBy(*page, *span_key).orderBy(*order)
    return pairs.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def without_nested(boxes: DataFrame, page: list[str], key: str, box: str, ratio: float = 0.8, larger: float = 1.01) -> DataFrame:
    """Boxes of which no clearly larger one covers the ratio."""
    other = boxes.select(*page, F.col(key).alias("_key"), F.col(box).alias("_box"))
    pairs = overlapping(boxes.select(*page, key, box), other, page, box, "_box").where(F.col(key) != F.col("_key"))
    inside = pairs.where((G.overlap_of_first(F.col(box), F.col("_box")) >= ratio) & (G.area(F.col("_box")) > larger * G.area(F.col(box))))
    return boxes.join(inside.select(*page, key).distinct(), [*page, key], "left_anti")


def without_contained(boxes: DataFrame, page: list[str], key: str, box: str) -> DataFrame:
    """Boxes that lie in no other; of equal ones none stays."""
    other = boxes.select(*page, F.col(key).alias("_key"), F.col(box).alias("_box"))
    pairs = overlapping(boxes.select(*page, key, box), other, page, box, "_box").where((F.col(key) != F.col("_key")) & G.contains(F.col(box), F.col("_box")))
    return boxes.join(pairs.select(*page, key).distinct(), [*page, key], "left_anti")


def absorbed(members: DataFrame, containers: DataFrame, page: list[str], ratio: float = 0.9) -> DataFrame:
    """Members (member, member_box) with the container (container, container_box) that covers most of them, at least the ratio; then the smaller, then the first."""
    pairs = overlapping(members, containers, page, "member_box", "container_box").where(F.col("member") != F.col("container"))
    share = G.overlap_of_first(F.col("member_box"), F.col("container_box"))
    w = Window.partitionBy(*page, "member").orderBy(F.desc("share"), G.area(F.col("container_box")), "container")
    return pairs.withColumn("share", share).where(F.col("share") >= ratio).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


# ---- passes whose order matters: a page at a time


def _iou(a: tuple, b: tuple) -> float:
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    inter = w * h
    total = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
    return inter / total if total > 0 else 0.0


def _smaller_share(a: tuple, b: tuple) -> float:
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    least = min((a[2] - a[0]) * (a[3] - a[1]), (b[2] - b[0]) * (b[3] - b[1]))
    return w * h / least if w > 0 and h > 0 and least > 0 else 0.0


def keep_best(rows: list[tuple[int, float, tuple]], limit: float = 0.9) -> list[int]:
    """Keys that stay when, by falling score, each box drops the later ones it overlaps more than the limit."""
    kept: list[tuple[int, tuple]] = []
    first = lambda k: (k is None, k or 0)
    for key, _, box in sorted(rows, key=lambda r: (-r[1], first(r[0]))):
        if all(_iou(box, other) <= limit for _, other in kept):
            kept.append((key, box))
    return sorted((k for k, _ in kept), key=first)


def merge_boxes(rows: list[tuple[int, tuple]], limit: float = 0.7) -> list[tuple[int, tuple]]:
    """Boxes that cover the limit of each other's smaller one become their union, until none do; the first key stays."""
    todo = sorted(rows)
    changed = True
    while changed:
        changed = False
        for i in range(len(todo)):
            for j in range(i + 1, len(todo)):
                if _smaller_share(todo[i][1], todo[j][1]) >= limit:
                    a, b = todo[i][1], todo[j][1]
                    todo[i] = (todo[i][0], (min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])))
                    del todo[j]
                    changed = True
                    break
            if changed:
                break
    return todo


def suppress(dets: DataFrame, page: list[str], key: str, limit: float = 0.9) -> DataFrame:
    """(page, key) of detections (key, score, x0..y1) that no better one covers.

    The boxes of a page are one array, so many pages go to Python in a batch.
    """

    @F.pandas_udf(T.ArrayType(dets.schema[key].dataType))
    def kept(pages: pd.Series) -> pd.Series:
        return pages.map(lambda boxes: keep_best([(b[key], b["score"], (b["x0"], b["y0"], b["x1"], b["y1"])) for b in boxes], limit))

    per = dets.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct(key, "score", "x0", "y0", "x1", "y1"))).alias("boxes"))
    return per.select(*page, F.explode(kept("boxes")).alias(key))


# ---- intervals


def islands(df: DataFrame, group: list[str], start: str, end: str) -> DataFrame:
    """Unions of intervals that touch: (group, start, end, n)."""
    w = Window.partitionBy(*group).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(before.isNull() | (F.col(start) > before), 1).otherwise(0)
    return df.withColumn("_new", fresh).withColumn("_island", F.sum("_new").over(w)).groupBy(*group, "_island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("_island")


def subtract(original: tuple[int, int], masks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What of a range of whole numbers lies outside all masks."""
    out, at = [], original[0]
    for a, b in sorted(masks):
        if b < at or a > original[1]:
            continue
        if a > at:
            out.append((at, a - 1))
        at = max(at, b + 1)
    if at <= original[1]:
        out.append((at, original[1]))
    return out


def union_area(boxes: list[tuple[float, float, float, float]]) -> float:
    """Exact area covered by boxes: strips between their vertical edges."""
    edges = sorted({x for b in boxes for x in (b[0], b[2])})
    total = 0.0
    for a, b in zip(edges, edges[1:], strict=False):
        reach, covered = None, 0.0
        for y0, y1 in sorted((r[1], r[3]) for r in boxes if r[0] <= a and r[2] >= b and r[3] > r[1]):
            low = y0 if reach is None else max(y0, reach)
            if y1 > low:
                covered += y1 - low
                reach = y1
        total += covered * (b - a)
    return total


def covered_area(boxes: DataFrame, page: list[str]) -> DataFrame:
    """(page, area): the exact area that a page's boxes (x0, y0, x1, y1) cover; flat and null ones cover nothing.

    The boxes of a page are one array, so many pages go to Python in a batch.
    """

    @F.pandas_udf(T.DoubleType())
    def area(pages: pd.Series) -> pd.Series:
        return pages.map(lambda own: union_area([tuple(b[c] for c in ("x0", "y0", "x1", "y1")) for b in own if not any(pd.isna(b[c]) for c in ("x0", "y0", "x1", "y1"))]))

    per = boxes.groupBy(*page).agg(F.collect_list(F.struct("x0", "y0", "x1", "y1")).alias("boxes"))
    return per.select(*page, area("boxes").alias("area"))


def ranges_left(first: Column, last: Column, masks: Column) -> Column:
    """array<struct<a, b>>: what of a range of whole numbers lies outside all masks (array of structs a, b), in order."""
    inside = F.array_sort(F.transform(F.filter(masks, lambda m: (m["b"] >= first) & (m["a"] <= last)), lambda m: F.struct(m["a"].alias("a"), m["b"].alias("b"))))
    zero = F.struct(first.cast("int").alias("at"), F.array().cast("array<struct<a:int,b:int>>").alias("out"))

    def step(acc: Column, m: Column) -> Column:
        gap = F.array(F.struct(acc["at"].alias("a"), (m["a"] - 1).cast("int").alias("b")))
        out = F.when(m["a"] > acc["at"], F.concat(acc["out"], gap)).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], (m["b"] + 1).cast("int")).alias("at"), out.alias("out"))

    rest = lambda acc: F.when(acc["at"] <= last, F.concat(acc["out"], F.array(F.struct(acc["at"].alias("a"), last.cast("int").alias("b"))))).otherwise(acc["out"])
    return F.aggregate(inside, zero, step, rest)


def line_of(df: DataFrame, group: list[str], box: str, ratio: float = 0.6, alone: Column | None = None) -> DataFrame:
    """Spans numbered by the text line they stand in (``line_no`` from 0).

    Sorted from the top, a span goes on with the line of the one before if
    their heights overlap by more than the ratio of the smaller; kinds that
    stand alone begin a line and end it.
    """
    w = Window.partitionBy(*group).orderBy(F.col(box)["y0"], F.col(box)["x0"], F.col(box)["y1"], F.col(box)["x1"])
    alone = F.lit(False) if alone is None else alone
    b, a = F.col(box), F.lag(box).over(w)
    shared = F.greatest(F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]), F.lit(0.0))
    least = F.least(a["y1"] - a["y0"], b["y1"] - b["y0"])
    same = a.isNotNull() & (least > 0) & (shared / F.when(least > 0, least) > ratio) & ~alone & ~F.coalesce(F.lag(alone).over(w), F.lit(False))
    fresh = F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)
    return df.withColumn("_fresh", fresh).withColumn("line_no", F.sum("_fresh").over(w) - 1).drop("_fresh")


def interval_pieces(rows: Iterator[tuple[int, tuple[int, int], list[tuple[int, int]]]]) -> Iterator[tuple[int, int, int]]:
    for key, original, masks in rows:
        for a, b in subtract(original, masks):
            yield key, a, b

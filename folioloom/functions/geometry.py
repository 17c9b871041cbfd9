"""Boxes (structs of x0, y0, x1, y1) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))


def upright(b: Column) -> Column:
    """Swapped corners put right."""
    return box(F.least(b["x0"], b["x1"]), F.least(b["y0"], b["y1"]), F.greatest(b["x0"], b["x1"]), F.greatest(b["y0"], b["y1"]))


def area(b: Column) -> Column:
    return (b["x1"] - b["x0"]) * (b["y1"] - b["y0"])


def overlap(a: Column, b: Column) -> Column:
    w = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    h = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def contains(inner: Column, outer: Column) -> Column:
    return (inner["x0"] >= outer["x0"]) & (inner["y0"] >= outer["y0"]) & (inner["x1"] <= outer["x1"]) & (inner["y1"] <= outer["y1"])


def relative_position(a: Column, b: Column) -> Column:
    """Where b lies of a, strictly."""
    return F.struct((b["x1"] < a["x0"]).alias("left"), (a["x1"] < b["x0"]).alias("right"), (b["y1"] < a["y0"]).alias("bottom"), (a["y1"] < b["y0"]).alias("top"))


def distance(a: Column, b: Column) -> Column:
    """0 where boxes meet, else that of their nearest edges or corners."""
    dx = F.greatest(b["x0"] - a["x1"], a["x0"] - b["x1"], F.lit(0.0))
    dy = F.greatest(b["y0"] - a["y1"], a["y0"] - b["y1"], F.lit(0.0))
    return F.sqrt(dx * dx + dy * dy)


def center_distance(a: Column, b: Column) -> Column:
    dx = (a["x0"] + a["x1"]) / 2 - (b["x0"] + b["x1"]) / 2
    dy = (a["y0"] + a["y1"]) / 2 - (b["y0"] + b["y1"]) / 2
    return F.sqrt(dx * dx + dy * dy)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def iou(a: Column, b: Column) -> Column:
    inter = overlap(a, b)
    return F.when((area(a) > 0) & (area(b) > 0), inter / (area(a) + area(b) - inter)).otherwise(0.0)


def overlap_of_smaller(a: Column, b: Column) -> Column:
    return _ratio(overlap(a, b), F.least(area(a), area(b)))


def overlap_of_first(a: Column, b: Column) -> Column:
    return _ratio(overlap(a, b), area(a))


def vertical_projection(a: Column, b: Column) -> Column:
    """Share of a's width below or above b."""
    return _ratio(F.greatest(F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]), F.lit(0.0)), a["x1"] - a["x0"])


def smaller_if_overlapping(a: Column, b: Column, ratio: float) -> Column:
    return F.when(overlap_of_smaller(a, b) > ratio, F.when(area(a) <= area(b), a).otherwise(b))


def union(a: Column, b: Column) -> Column:
    return box(F.least(a["x0"], b["x0"]), F.least(a["y0"], b["y0"]), F.greatest(a["x1"], b["x1"]), F.greatest(a["y1"], b["y1"]))


def to_thousandths(b: Column, width: Column, height: Column) -> Column:
    """Box in thousandths of its page, cut off to whole numbers; null without a page size."""
    scaled = [(b[c] * 1000 / s).cast("int") for c, s in (("x0", width), ("y0", height), ("x1", width), ("y1", height))]
    return F.when((width > 0) & (height > 0), F.array(*scaled))


def to_unit(b: Column, width: Column, height: Column) -> Column:
    part = lambda v, s: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v / s))
    return box(part(b["x0"], width), part(b["y0"], height), part(b["x1"], width), part(b["y1"], height))


def to_pixels(unit: Column, width: Column, height: Column) -> Column:
    """Model output in [0, 1] as whole points with its corners put right."""
    c = [(unit[k] * s).cast("int").cast("double") for k, s in (("x0", width), ("y0", height), ("x1", width), ("y1", height))]
    return upright(box(*c))


def relative_to(child: Column, parent: Column) -> Column:
    """A child's box in parts of its parent's, clamped, three digits."""
    w, h = parent["x1"] - parent["x0"], parent["y1"] - parent["y0"]
    part = lambda v, s: F.when(s > 0, F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), v / s)), 3)).otherwise(0.0)
    return box(part(child["x0"] - parent["x0"], w), part(child["y0"] - parent["y0"], h), part(child["x1"] - parent["x0"], w), part(child["y1"] - parent["y0"], h))


def outer_ints(b: Column, width: Column, height: Column) -> Column:
    """Whole numbers around the box within the page, null if nothing is left."""
    x0, y0 = F.greatest(F.floor(b["x0"]), F.lit(0)), F.greatest(F.floor(b["y0"]), F.lit(0))
    x1, y1 = F.least(F.ceil(b["x1"]), width.cast("long")), F.least(F.ceil(b["y1"]), height.cast("long"))
    return F.when((x1 > x0) & (y1 > y0), F.array(x0, y0, x1, y1))


def canvas(b: Column, width: Column, height: Column, rotation: Column) -> Column:
    """Page coordinates (y down) on the canvas of a page that is turned by 0, 90, 180 or 270 degrees."""
    turned = (
        F.when(rotation == 90, box(b["y0"], b["x0"], b["y1"], b["x1"]))
        .when(rotation == 180, box(width - b["x1"], b["y0"], width - b["x0"], b["y1"]))
        .when(rotation == 270, box(height - b["y1"], width - b["x1"], height - b["y0"], width - b["x0"]))
    )
    return F.coalesce(turned, box(b["x0"], height - b["y1"], b["x1"], height - b["y0"]))


def render_scale(width: Column, height: Column, dpi: int = 300, most: int = 4500) -> Column:
    """Scale of a rendered page whose long side has at most ``most`` pixels."""
    return F.least(F.lit(dpi / 72), F.lit(float(most)) / F.greatest(width, height))


def compose(outer: Column, inner: Column) -> Column:
    """Affine transforms (scale and offset per axis) of nested groups."""
    return F.struct(
        (outer["sx"] * inner["sx"]).alias("sx"),
        (outer["sy"] * inner["sy"]).alias("sy"),
        (outer["sx"] * inner["dx"] + outer["dx"]).alias("dx"),
        (outer["sy"] * inner["dy"] + outer["dy"]).alias("dy"),
    )

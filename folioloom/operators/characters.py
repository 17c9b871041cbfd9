"""Characters of a page's text layer, before they are spans."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.functions.text import LIGATURES
from folioloom.runtime import ordered_fold

Box = tuple[float, float, float, float]


@dataclass(frozen=True)
class Char:
    text: str
    box: Box
    font: str = ""
    size: float = 0.0
    rotation: float = 0.0


def join_surrogates(units: list[int]) -> list[tuple[int, int]]:
    """(code point, position of its first unit): pairs become one character, halves without the other U+FFFD."""
    out, i = [], 0
    while i < len(units):
        u = units[i]
        if 0xD800 <= u < 0xDC00 and i + 1 < len(units) and 0xDC00 <= units[i + 1] < 0xE000:
            out.append((0x10000 + ((u - 0xD800) << 10) + units[i + 1] - 0xDC00, i))
            i += 2
            continue
        out.append((0xFFFD if 0xD800 <= u < 0xE000 else u, i))
        i += 1
    return out


def _same_place(a: Box, b: Box, tolerance: float = 1.0) -> bool:
    return all(abs(x - y) <= tolerance for x, y in zip(a, b, strict=True))


def _shadow(a: Char, b: Char) -> bool:
    """b is a drawn again a little down and aside."""
    dx, dy = b.box[0] - a.box[0], b.box[1] - a.box[1]
    if a.text != b.text or not (1.0 < abs(dx) <= 2.5 and 1.0 < abs(dy) <= 2.5):
        return False
    if abs(b.box[2] - a.box[2] - dx) > 0.1 or abs(b.box[3] - a.box[3] - dy) > 0.1:
        return False
    w, h = min(a.box[2], b.box[2]) - max(a.box[0], b.box[0]), min(a.box[3], b.box[3]) - max(a.box[1], b.box[1])
    area = lambda q: (q[2] - q[0]) * (q[3] - q[1])
    least = min(area(a.box), area(b.box))
    return w > 0 and h > 0 and least > 0 and w * h / least >= 0.45


class Distinct:
    """Characters without those drawn twice: at the place of any earlier one, or as shadow of the last.

    The parts of one ligature lie at exactly the same place, one after the
    other, and stay. Places are looked up in a grid of cells around them.
    """

    def __init__(self) -> None:
        self.cells: dict[tuple[str, int, int], list[Char]] = {}
        self.last: Char | None = None

    def keep(self, c: Char) -> bool:
        last = self.last
        if last is not None and last.text == c.text and last.box == c.box:
            self.last = c  # an expanded ligature
            return True
        x, y = int(c.box[0] // 2), int(c.box[1] // 2)
        near = (o for i in (-1, 0, 1) for j in (-1, 0, 1) for o in self.cells.get((c.text, x + i, y + j), ()))
        if any(_same_place(o.box, c.box) for o in near) or last is not None and _shadow(last, c):
            return False
        self.cells.setdefault((c.text, x, y), []).append(c)
        self.last = c
        return True


def distinct_characters(chars: DataFrame, page: list[str]) -> DataFrame:
    """Characters (char_idx, char, x0, y0, x1, y1) of pages, without those drawn twice."""
    columns = [*page, "char_idx", "char", "x0", "y0", "x1", "y1"]
    schema = ", ".join(f"{c} {chars.schema[c].dataType.simpleString()}" for c in columns)
    n = len(page)

    def start():
        seen = Distinct()
        return lambda row: [row] if seen.keep(Char(row[n + 1], tuple(row[n + 2 :]))) else []

    return ordered_fold(chars.select(*columns), page, ["char_idx"], schema, start)


def content(chars: list[Char]) -> str:
    """Text of a span's characters: a blank where a gap is wider than a quarter of the median width, raised and lowered runs marked."""
    chars = [c for c in chars if c.text not in ("\r", "\n")]
    if not chars:
        return ""
    widths = [c.box[2] - c.box[0] for c in chars]
    gap = 0.25 * median(widths)
    heights = [c.box[3] - c.box[1] for c in chars]
    tall = [c for c, h in zip(chars, heights, strict=True) if h >= 0.9 * max(heights)]
    middle = median((c.box[1] + c.box[3]) / 2 for c in tall)
    body = median(c.box[3] - c.box[1] for c in tall)

    def role(c: Char) -> str:
        off = (c.box[1] + c.box[3]) / 2 - middle
        return "sup" if off < -0.15 * body else "sub" if off > 0.15 * body else ""

    out, at = [], ""
    for k, c in enumerate(chars):
        now = role(c)
        if now != at:
            out.append(f"</{at}>" * bool(at) + f"<{now}>" * bool(now))
            at = now
        if k and c.box[0] - chars[k - 1].box[2] > gap and c.text != " " and chars[k - 1].text != " ":
            out.append(" ")
        out.append(LIGATURES.get(c.text, c.text))
    out.append(f"</{at}>" * bool(at))
    return "".join(out).replace("\u0002", "-").strip()


def upright_only(lines: Iterator[tuple[int, list[Char]]]) -> Iterator[tuple[int, list[Char]]]:
    """Characters of lines: of 0, 90, 180 and 270 degrees; turned ones only in lines that also have upright ones."""
    for key, chars in lines:
        right = [c for c in chars if c.rotation % 90 == 0]
        if any(c.rotation % 360 == 0 for c in right):
            yield key, right
        else:
            yield key, []


def ctc(steps: list[tuple[int, float]], blank: int = 0) -> tuple[list[int], float]:
    """Labels of a recogniser's steps without repeats and blanks, and their mean confidence."""
    kept = [(label, p) for k, (label, p) in enumerate(steps) if label != blank and (k == 0 or label != steps[k - 1][0])]
    return [label for label, _ in kept], sum(p for _, p in kept) / len(kept) if kept else 0.0


def ctc_steps(steps: Column, blank: str = "") -> Column:
    """struct<labels, confidence> of steps (label, p), as ``ctc``; an empty array has confidence 0, null stays null."""
    before = lambda i: F.get(steps, i - 1)["label"]
    kept = F.filter(steps, lambda x, i: (x["label"] != F.lit(blank)) & ((i == 0) | (F.coalesce(before(i), F.lit(blank)) != x["label"])))
    total = F.aggregate(kept, F.lit(0.0), lambda a, x: a + x["p"])
    return F.when(steps.isNotNull(), F.struct(F.transform(kept, lambda x: x["label"]).alias("labels"), F.when(F.size(kept) > 0, total / F.size(kept)).otherwise(0.0).alias("confidence")))

"""Repetition inside a single document (problem 10).

A text is a sequence of units: words reduced to their letters (case, digits,
punctuation and blanks don't count) and single Han characters. A *window* is
the shortest stretch of units from a position on that weighs at least one, a
word weighing 1/8 and a Han character 1/15. A window that occurred before, at
any smaller position, is repeated content; the share is that of the letters of
all units in such windows. Windows of long or mixed texts are found by hashes
and confirmed unit by unit, so the share is exact.

Which measured share rejects a document is not guessed: ``calibrate`` takes a
labelled holdout and chooses, for each stratum, the smallest cutoff on a grid
for which the exact (Clopper-Pearson) upper bound of the rate of false
rejections stays below a limit, with the confidence divided by the number of
strata; here the holdout is made of all documents. The labels don't come from the measure: ``planted`` takes texts of the
corpus, reduces them to what is new in them and repeats a passage of them until
it makes up a share drawn beforehand, so that the true share is known by
construction.

Defined results: null, empty and letterless texts have no units and share 0.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.llm.arrow import map_rows

#: Weights in 120ths: eight words or fifteen Han characters make a window.
WORD, HAN, WINDOW = 15, 8, 120
#: Texts of up to so many units are compared window by window, longer ones by hashes.
SHORT = 4096
#: The share from which a document counts as repetitive.
LIMIT = 1 / 3

_NOT_LETTER = re.compile(r"[\W\d_]+")
_HAN_CLASS = "[㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff]"
_UNIT = re.compile(f"{_HAN_CLASS}|(?:(?!{_HAN_CLASS}).)+")
_HAS_HAN = re.compile(_HAN_CLASS)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = 0xD1342543DE82EF95


def units(text: str) -> list[str]:
    """Lower-case letters of each word, Han characters one by one."""
    out = []
    for word in text.lower().split():
        if not word.isalpha():
            word = _NOT_LETTER.sub("", word)
        if not word:
            continue
        if word.isascii() or not _HAS_HAN.search(word):
            out.append(word)
        else:
            out += _UNIT.findall(word)
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(1)) * _MIX[0]
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        return x ^ (x >> np.uint64(31))


def _again(parts: list[str]) -> tuple[list[int], list[int]]:
    """(starts, sizes) of the windows that occurred before, in order."""
    if not parts or len(parts) > SHORT:
        return _again_by_hash(parts)
    if max(parts) < "㐀":
        size = -(-WINDOW // WORD)
    elif min(parts) >= "㐀" and all(map(_HAS_HAN.match, parts)):
        size = -(-WINDOW // HAN)
    else:
        return _again_by_hash(parts)
    # units of one weight: all windows are as long
    windows = list(zip(*(parts[k:] for k in range(size)), strict=False))
    first = dict(zip(reversed(windows), range(len(windows) - 1, -1, -1), strict=True))
    if len(first) == len(windows):
        return [], []
    starts = [i for i, w in enumerate(windows) if first[w] != i]
    return starts, [size] * len(starts)


def _again_by_hash(parts: list[str]) -> tuple[list[int], list[int]]:
    n, none = len(parts), ([], [])
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(p, len(number)) for p in parts), np.int64, n)
    if len(number) == n:
        return none
    han = np.fromiter((HAN if p >= "㐀" and len(p) == 1 and _HAS_HAN.match(p) else WORD for p in parts), np.int64, n)
    reach = np.concatenate([[0], np.cumsum(han)])
    stop = np.searchsorted(reach, reach[:-1] + WINDOW)
    starts = np.flatnonzero(stop <= n)
    if len(starts) < 2:
        return none
    size = stop[starts] - starts
    with np.errstate(over="ignore"):
        # h[i] sums mixed ids times powers; a window's hash is its part of the sum, shifted to a common power
        power = np.full(n + 1, _BASE, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        h = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(ids.astype(np.uint64)) * power[:n], dtype=np.uint64)])
        key = (h[starts + size] - h[starts]) * power[n - starts] + size.astype(np.uint64)
    _, first, back = np.unique(key, return_index=True, return_inverse=True)
    earlier = first[back]
    again = np.flatnonzero(earlier < np.arange(len(starts)))
    if not len(again):
        return none
    a, b, k = starts[again], starts[earlier[again]], size[again]
    same = np.ones(len(again), bool)
    for step in range(int(k.max())):
        inside = step < k
        same[inside] &= ids[a[inside] + step] == ids[b[inside] + step]
    return a[same].tolist(), k[same].tolist()


def measure(text: str | None) -> tuple[int, int]:
    """(letters, letters in repeated windows) of a text."""
    return measure_units(units(text) if text else [])


def measure_units(parts: list[str]) -> tuple[int, int]:
    """``measure`` of the text that these are the units of."""
    letters = list(accumulate(map(len, parts), initial=0))
    again = end = 0
    for start, size in zip(*_again(parts), strict=True):
        again += letters[start + size] - letters[max(start, end)]
        end = start + size
    return letters[-1], again


def shares(texts: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The kept columns, letters, repeated_letters and repeated_share; one row per input row."""
    schema = T.StructType(
        [texts.schema[c] for c in keep] + [T.StructField("letters", T.LongType()), T.StructField("repeated_letters", T.LongType()), T.StructField("repeated_share", T.DoubleType())]
    )

    def rows(columns: list[list]) -> Iterator[tuple]:
        for *kept, text in zip(*columns, strict=True):
            n, again = measure(text)
            yield *kept, n, again, again / n if n else 0.0

    return map_rows(texts, {**{c: c for c in keep}, "\x00text": text_col}, schema, rows)


def upper_bound(failures: int, trials: int, error: float) -> float:
    """Clopper-Pearson: the largest rate at which so few failures still have the chance ``error``."""
    if failures >= trials:
        return 1.0
    log_choose = [math.lgamma(trials + 1) - math.lgamma(k + 1) - math.lgamma(trials - k + 1) for k in range(failures + 1)]

    def chance(p: float) -> float:
        return sum(math.exp(c + k * math.log(p) + (trials - k) * math.log1p(-p)) for k, c in enumerate(log_choose))

    low, high = 0.0, 1.0
    for _ in range(60):
        p = (low + high) / 2
        low, high = (p, high) if 0 < p < 1 and chance(p) > error else (low, p)
    return high


def calibrate(holdout: DataFrame, strata: list[str], score: str = "score", label: str = "label", rate: float = 0.02, error: float = 0.05, grid: int = 60) -> list[tuple[str, float, int, int, float]]:
    """(stratum, cutoff, sound, falsely rejected, bound) for each stratum.

    ``label`` is true for documents that deserve rejection; ``stratum`` is a
    column of ``holdout``. With probability 1 - error no chosen cutoff rejects
    more than ``rate`` of the sound documents of its stratum: ``error`` is
    divided by the number of strata, and within one the cutoffs are tested in
    a fixed sequence, strictest first, up to the first that fails. A stratum
    whose holdout is too small for any proof takes the cutoff of all strata
    together, which is one test more; without proof there either, infinity.
    """
    cells = holdout.where(~F.col(label)).groupBy("stratum").agg(F.count("*").alias("n"), *[F.sum((F.col(score) >= k / grid).cast("long")).alias(f"k{k}") for k in range(1, grid + 1)])
    found = {r["stratum"]: r.asDict() for r in cells.collect()}  # one row per stratum
    together = {c: sum(r[c] for r in found.values()) for c in ("n", *[f"k{k}" for k in range(1, grid + 1)])}

    def smallest(r: dict) -> tuple[float, int, float]:
        best = (math.inf, 0, 1.0)
        for k in range(grid, 0, -1):
            # the bound is never below the rate itself; of a large holdout it is dear
            if r[f"k{k}"] > rate * r["n"]:
                break
            bound = upper_bound(r[f"k{k}"], r["n"], error / (len(strata) + 1))
            if bound > rate:
                break
            best = (k / grid, r[f"k{k}"], bound)
        return best

    all_, out = smallest(together), []
    for s in strata:
        r = found.get(s)
        best = smallest(r) if r else (math.inf, 0, 1.0)
        if best[0] == math.inf:
            r, best = together, all_
        out.append((s, best[0], r["n"], best[1], best[2]))
    return out


def plant(text: str | None, luck: float) -> tuple[str, float] | None:
    """(text with a planted repetition, its true share): at most 2 / 3, drawn by ``luck`` in [0, 1); None where the text is too short.

    Of the text, the stretch up to its first repeated window is kept. A passage
    of it, a window long or longer, is put in again behind itself, as often as
    the share needs. All letters of the copies are repeated, no others.
    """
    made = _planted_units(units(text or ""), luck)
    return made and (" ".join(made[0]), made[1])


def _planted_units(parts: list[str], luck: float) -> tuple[list[str], float] | None:
    starts, sizes = _again(parts)
    if starts:
        parts = parts[: starts[0] + sizes[0] - 1]  # up to there every window is new
    reach = list(accumulate((HAN if p >= "㐀" and _HAS_HAN.match(p) else WORD for p in parts), initial=0))
    letters = list(accumulate(map(len, parts), initial=0))
    base = letters[-1]
    wanted = luck * 2 / 3
    # the passage is at least a window; one copy of it is at least that share
    start = int(luck * 7919) % max(1, len(parts) // 2)
    j = start
    while j < len(parts) and (letters[j] - letters[start]) * (1 - wanted) < wanted * base / 4 or reach[min(j, len(parts))] - reach[start] < WINDOW:
        j += 1
        if j > len(parts):
            return None
    passage = parts[start:j]
    size = letters[j] - letters[start]
    copies = round(wanted * base / (1 - wanted) / size)
    # units that no text holds, each once, keep windows from running on over the borders of the copies
    marks = ["ǃ" * (k + 2) for k in range(copies + 1)]
    full = [*parts[:j], *[u for k in range(copies) for u in (marks[k], *passage)], marks[copies], *parts[j:]]
    return full, copies * size / (base + copies * size + sum(map(len, marks)))


def planted(documents: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(stratum, score, label): the measured share of a text with a planted repetition, and whether its true share reaches the limit."""
    schema = T.StructType([T.StructField("stratum", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("label", T.BooleanType())])
    luck = F.pmod(F.xxhash64(id_col, F.lit("plant")), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def rows(columns: list[list]) -> Iterator[tuple]:
        for stratum, text, drawn in zip(*columns, strict=True):
            made = _planted_units(units(text or ""), drawn)
            if made:
                n, again = measure_units(made[0])
                yield stratum, again / n if n else 0.0, made[1] >= LIMIT

    return map_rows(documents, {"stratum": "stratum", "text": text_col, "luck": luck}, schema, rows)


def brute_share(text: str | None) -> float:
    """The share by its definition, window by window: checks ``measure``."""
    parts = units(text or "")
    weight = [HAN if _HAS_HAN.match(p) else WORD for p in parts]
    seen: set[tuple[str, ...]] = set()
    marked: set[int] = set()
    for i in range(len(parts)):
        j = i
        while j < len(parts) and sum(weight[i:j]) < WINDOW:
            j += 1
        if sum(weight[i:j]) >= WINDOW:
            window = tuple(parts[i:j])
            if window in seen:
                marked |= set(range(i, j))
            seen.add(window)
    total = sum(map(len, parts))
    return sum(len(parts[i]) for i in marked) / total if total else 0.0

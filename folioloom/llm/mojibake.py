"""Finding and restoring text that was decoded with a wrong character encoding (problem 7).

The characters of a text are mapped back to the bytes of a legacy encoding; an
automaton over byte structure finds the maximal well-formed multibyte spans
(UTF-8, or the two-byte Chinese and Japanese sets), and only those are decoded.
Well-formed UTF-8 decides by itself, unless its characters could stand side by
side in sound text (``_excused``: letters, or a capital before a closing sign).
Only then, and where the structure is weaker, a small model of neighbouring
characters judges, fitted on the whole corpus: such a span is decoded
only if what comes out is clearly more usual than what stood there. Rounds
repeat, so text that was damaged twice is restored twice. Confusions of two
single-byte encodings have no byte structure; there the words with unusual
neighbours are read in the other encoding, under the same judge.

Defined results: null and empty texts are sound. Replacement characters and
control characters of the C1 range mark a text as damaged even where nothing
can be restored; what can't be restored stays as it is.
"""

from __future__ import annotations

import math
import operator
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.llm.arrow import SLICE, local, map_rows, portions
from folioloom.llm.canon import canonical
from folioloom.runtime import checkpointed

#: Single-byte encodings that files are wrongly read or written with. Undefined bytes of "windows" sets show as control characters.
SINGLE = ("cp1252", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "koi8_r", "cp866", "mac_cyrillic", "iso8859_2", "iso8859_15")
#: Multibyte encodings that UTF-8 is wrongly read with.
DOUBLE = ("gbk",)
#: By how much (nats per character) a decoded span must be more usual, and the least gain in all of a long span or of a pass over words.
MARGIN, LEAST = 1.0, 5.0
ROUNDS = 4
#: Sound words, unusual words, runs and spans with their readings, that a worker remembers; when full, it starts anew. Only speed depends on it.
MEMO = 100_000

#: Neighbours in a smaller share of the texts are unusual.
RARE = 0.0005
_CLASS = dict.fromkeys("0123456789", "0") | dict.fromkeys("\t\n\r\u00a0\u3000", " ")
_NONE = "￿"
#: The automata: well-formed UTF-8 of more than one byte, and rows 01-87 of the Chinese set, on bytes as characters.
_UTF8 = re.compile("(?:[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})+")
_GB = re.compile("(?:[\xa1-\xa9\xb0-\xf7][\xa1-\xfe]){2,}")
#: Pinyin letters and punctuation of the Chinese set, which also stand alone among Latin letters.
_GB_LATIN = re.compile("(?:\xa1[\xa4\xa7\xaa-\xb1]|\xa8[\xa1-\xba])+")
#: East Asian sets: the automaton of at least four characters, and the first bytes of their frequent characters.
_EAST = {
    "gb18030": (re.compile("(?:[\x81-\xfe][\x40-\x7e\x80-\xfe]){4,}"), re.compile("[\xa1-\xa3\xb0-\xd7][\xa1-\xfe]")),
    "big5": (re.compile("(?:[\xa1-\xf9][\x40-\x7e\xa1-\xfe]){4,}"), re.compile("[\xa1\xa4-\xc6][\x40-\x7e\xa1-\xfe]")),
    "shift_jis": (re.compile("(?:[\x81-\x9f\xe0-\xef][\x40-\x7e\x80-\xfc]){4,}"), re.compile("[\x81-\x83\x88-\x97][\x40-\x7e\x80-\xfc]")),
}
#: Encodings whose characters for the bytes of UTF-8 hardly meet in sound text.
CERTAIN = ("cp1252", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "iso8859_15")
#: Letters and signs that any corpus may hold.
_FAMILIAR = re.compile("[\u00a0-\u00ff\u0152\u0153\u2013\u2014\u2018-\u201e\u2022\u2026\u20ac\u2122\u0401\u0410-\u044f\u0451\u3000-\u3002\u4e00-\u9fff\uff01-\uff5e]")
_RUN = re.compile("[^\x00-\x7f]{2,}")
_HIGH = re.compile("[\x80-\xff]")
#: Characters beyond ASCII whose kind is an ASCII character.
_BECOMES_ASCII = re.compile("[\u00a0\u0130\u212a\u3000]")
_LOST = re.compile("[�\x80-\x9f]")
_WORD = re.compile(r"\S+")
_INNER_CAPITAL = regex.compile(r"\p{L}\p{Lu}\p{Ll}|\p{Ll}\p{Lu}")


_HAN = "一"


def _han(c: str) -> bool:
    return "㐀" <= c <= "鿿"


def _kind(c: str) -> str:
    return _HAN if "㐀" <= c <= "鿿" else _CLASS.get(c) or (c if c.isascii() else c.lower()[0])


class _Kinds(dict):
    """For str.translate: each character as its kind."""

    def __missing__(self, code: int) -> str:
        self[code] = found = _kind(chr(code))
        return found


_KINDS = _Kinds()


class _Looked(dict):
    """What a function gives, kept."""

    def __init__(self, find: Callable[[str], object]):
        super().__init__()
        self.find = find

    def __missing__(self, key: str) -> object:
        self[key] = found = self.find(key)
        return found

    def __reduce__(self) -> tuple:
        return _Looked, (self.find,)


@dataclass
class Model:
    """In how many texts each character and each pair of neighbours occurs.

    In pairs, all digits are one character, all Chinese characters another, and
    letters beyond ASCII count without their case.
    """

    texts: int
    single: dict[str, int]
    pair: dict[str, int]

    def __post_init__(self) -> None:
        self.least = max(2, self.texts * RARE)
        self.han = sum(n for c, n in self.single.items() if _han(c)) + 1
        self.known: dict[str, float] = _Looked(self.log)
        self.odd: dict[str, bool] = _Looked(self.strange)

    def log(self, pair: str) -> float:
        """log of the chance of the second after the first, at least -10; half that of a Chinese character among its kind."""
        a, b = pair
        x, y = _kind(a), _kind(b)
        n = self.pair.get(x + y, 0)
        chance = ((n if n >= 2 else 0) + 0.3 * (self.single.get(y, 0) + 0.02) / (self.texts + 1)) / (self.single.get(x, 0) + 1)
        found = math.log(chance)
        if y == _HAN:
            n = self.single.get(b, 0)
            found = max(found, -5.0) + (math.log(n / self.han) / 2 if n > 1 else -6.0)
        return max(-10.0, found)

    def strange(self, pair: str) -> bool:
        """Unusual neighbours, one of them not ASCII."""
        a, b = pair
        return not pair.isascii() and (_han(b) and self.single.get(b, 0) < 2 or self.pair.get(_kind(a) + _kind(b), 0) < self.least)

    def unusual(self, line: str) -> bool:
        """Whether some neighbours of a line are strange."""
        return any(map(self.odd.__getitem__, map(operator.add, line, line[1:])))

    def mean(self, before: str, text: str, after: str) -> float:
        line = before + text + after
        return sum(map(self.known.__getitem__, map(operator.add, line, line[1:]))) / max(1, len(line) - 1)


def _tally(texts: Iterable[str]) -> tuple[int, Counter[str], Counter[str]]:
    """(texts, in how many each character occurs, in how many each pair)."""
    n = 0
    single: Counter[str] = Counter()
    pair: Counter[str] = Counter()
    for text in texts:
        n += 1
        padded = f" {' '.join(text.split())} "
        kinds = padded.translate(_KINDS)
        single.update(set(padded) | set(kinds))
        pair.update(a + b for a, b in set(zip(kinds, kinds[1:], strict=False)))
    return n, single, pair


def _count(texts: list[str]) -> Model:
    n, single, pair = _tally(texts)
    return Model(n, {c: k for c, k in single.items() if k > 1}, {p: k for p, k in pair.items() if k > 1})


def fit(texts: Iterable[str]) -> Model:
    """The model of a sample.

    Damaged texts of the sample would make their own damage usual. So it is
    fitted twice: first on the sample without its certain spans, then on the
    sample as repaired by the first model, without the texts in which
    characters were lost.
    """
    sample = sorted(set(texts))
    results = Repair(_count(_all_without_certain(sample))).all(sample)
    return _count([r.text for r in results if "lost" not in r.kinds])


class _Holds:
    """Which text (row) holds which sign (column)."""

    def __init__(self, texts: int, signs: int):
        self.texts, self.signs, self.width = texts, signs, -(-signs // 8) * 8
        self.held = np.zeros(texts * self.width, np.uint8)

    def put(self, rows: np.ndarray, signs: np.ndarray) -> None:
        """The signs of all texts, and the text of each."""
        at = rows * self.width
        at += signs
        self.held[at] = 1

    def sums(self) -> np.ndarray:
        """In how many texts each sign is. Eight columns are added as one number, as no sum of 255 rows leaves its byte."""
        rows, out = self.held.view(np.uint64).reshape(self.texts, -1), np.zeros(self.width, np.int64)
        for start in range(0, self.texts, 255):
            out += np.add.reduce(rows[start : start + 255], axis=0).view(np.uint8)
        return out[: self.signs]

    def any_of(self, columns: list[int]) -> int:
        return int(np.count_nonzero(self.held.reshape(self.texts, -1)[:, columns].any(axis=1)))


def _numbered(values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(the different values, ascending; the place of each among them)."""
    different = np.flatnonzero(np.bincount(values, minlength=most))
    place = np.zeros(most, np.int64)
    place[different] = np.arange(len(different))
    return different, place


def _single_blanks(signs: np.ndarray, blank: int, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signs of all texts, length of each) with one blank where several stand together; texts begin and end with one."""
    ends = np.cumsum(lengths)
    keep = signs != blank
    keep[1:] |= keep[:-1]  # a blank behind something else
    keep[ends - lengths] = True
    lengths = np.add.reduceat(keep, ends - lengths, dtype=np.int64)
    # of nothing but blanks, the first and the last stay
    keep[ends[lengths == 1] - 1] = True
    return signs[keep], np.maximum(lengths, 2)


class _Tally:
    """``_tally`` of many texts, by stratum: characters are counted in arrays, a bounded number of texts at a time."""

    def __init__(self) -> None:
        self.sums: dict[int, Counter[str]] = defaultdict(Counter)
        self.waiting: dict[int, list[str]] = defaultdict(list)
        self.size: Counter[int] = Counter()
        #: Number of each character among those seen (all blanks are the first), and number of the kind of each.
        self.number = np.full(0x110000, -1, np.int64)
        self.chars: list[str] = [" "]
        self.kinds: dict[str, int] = {" ": 0}
        self.kind_of: list[int] = [0]

    def add(self, stratum: int, text: str) -> None:
        self.waiting[stratum].append(f" {text} ")
        self.size[stratum] += len(text)
        if self.size[stratum] > 1 << 20 or len(self.waiting[stratum]) >= 2048:
            self.count(stratum)

    def change(self, stratum: int, text: str, sign: int) -> None:
        n, single, pair = _tally([text])
        for key, k in (("", n), *single.items(), *pair.items()):
            self.sums[stratum][key] += sign * k

    def count(self, stratum: int) -> None:
        texts, sums = self.waiting.pop(stratum, []), self.sums[stratum]
        self.size[stratum] = 0
        if not texts:
            return
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        # no number is out of range, and without the check "take" needs no copy
        numbers = self.number.take(codes, mode="clip")
        if numbers.min() < 0:
            for c in np.unique(codes[numbers < 0]).tolist():
                if chr(c).isspace():
                    self.number[c] = 0
                    continue
                self.number[c] = len(self.chars)
                self.chars.append(chr(c))
                self.kind_of.append(self.kinds.setdefault(_kind(chr(c)), len(self.kinds)))
            numbers = self.number.take(codes, mode="clip")
        numbers, lengths = _single_blanks(numbers, 0, np.fromiter(map(len, texts), np.int64, len(texts)))
        rows = np.repeat(np.arange(len(texts)), lengths)
        letters, place = _numbered(numbers, len(self.chars))
        own = place.take(numbers, mode="clip")
        holds = _Holds(len(texts), len(letters))
        holds.put(rows, own)
        alphabet, of = np.unique(np.array(self.kind_of)[letters], return_inverse=True)
        width = len(alphabet)
        kind = of.take(own, mode="clip")
        pairs = kind * width
        pairs[:-1] += kind[1:]
        pairs[np.cumsum(lengths) - 1] = width * width  # the end of a text has no neighbour
        if width <= 2048:
            found, at = _numbered(pairs, width**2 + 1)
            back = at.take(pairs, mode="clip")
        else:
            found, back = np.unique(pairs, return_inverse=True)
        meets = _Holds(len(texts), len(found))
        meets.put(rows, back)
        sums[""] += len(texts)
        names = list(self.kinds)
        signs: dict[str, list[int]] = defaultdict(list)
        for i, k in enumerate(letters.tolist()):
            for c in {self.chars[k], names[self.kind_of[k]]}:
                signs[c].append(i)
        alone = holds.sums().tolist()
        for c, columns in signs.items():
            sums[c] += alone[columns[0]] if len(columns) == 1 else holds.any_of(columns)
        alphabet_ = [names[k] for k in alphabet.tolist()]
        for p, k in zip(found.tolist(), meets.sums().tolist(), strict=True):
            if p < width * width:
                sums[alphabet_[p // width] + alphabet_[p % width]] += k

    def rows(self) -> Iterator[tuple[int, str, int]]:
        for stratum in list(self.waiting):
            self.count(stratum)
        for stratum, sums in self.sums.items():
            yield from ((stratum, key, k) for key, k in sums.items() if k)
        self.sums.clear()


def fit_frame(texts: DataFrame, text_col: str = "text", quotas: dict[str, int] | None = None) -> Model:
    """``fit`` on all texts by all executors: each counts its part, and only the sums of characters and pairs reach the driver.

    With ``quotas``, each ``stratum`` counts as so many texts at most: its sums,
    taken over all its texts, are scaled down to them, so that no language and
    no table outweighs the others. The second fit only counts what the first
    model changes.
    """
    spark, names = texts.sparkSession, list(quotas or {"": 0})
    number = F.array_position(F.array(*map(F.lit, names)), F.col("stratum") if quotas else F.lit("")).cast("int") - 1
    parts = max(spark.sparkContext.defaultParallelism, texts.rdd.getNumPartitions())
    whole = texts.select(F.col(text_col).alias("text"), number.alias("k")).where("text IS NOT NULL").repartition(parts, "text").groupBy("text").agg(F.min("k").alias("k"))

    def summed(step: Callable[[_Tally, list[int], list[str]], None], chosen: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def made() -> Iterator[pa.RecordBatch]:
                rows = list(tally.rows())
                for i in range(0, len(rows), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(v, x) for v, x in zip(zip(*rows[i : i + 50_000], strict=True), (pa.int32(), pa.string(), pa.int64()), strict=True)], names=["k", "key", "n"])

            tally = _Tally()
            for batch in batches:
                for start in range(0, batch.num_rows, SLICE):
                    own, strata = (c.to_pylist() for c in batch.slice(start, SLICE).columns)
                    step(tally, strata, own)
                if sum(map(len, tally.sums.values())) > 1_000_000:
                    yield from made()
            yield from made()

        rows = chosen.select("text", "k").mapInArrow(run, "k int, key string, n long")
        return rows.groupBy("key").agg(*[F.sum(F.when(F.col("k") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(len(names))])

    def model(sums: DataFrame) -> Model:
        rows = sums.where(" + ".join(f"n{i}" for i in range(len(names))) + " > 1 OR key = ''").collect()
        found = {r[0]: r[1:] for r in rows}
        sizes = found.pop("", (0,) * len(names))
        scale = [min(1.0, quotas[s] / n) if quotas and n else 1 for s, n in zip(names, sizes, strict=True)]
        counts = {key: sum(n * w for n, w in zip(own, scale, strict=True)) for key, own in found.items()}
        return Model(round(sum(n * w for n, w in zip(sizes, scale, strict=True))), *({key: n for key, n in counts.items() if len(key) == size and n > 1} for size in (1, 2)))

    def counted(tally: _Tally, strata: list[int], own: list[str]) -> None:
        for k, text in zip(strata, _all_without_certain(own), strict=True):
            tally.add(k, text)

    first = checkpointed(summed(counted, whole))
    shared = spark.sparkContext.broadcast(model(first))

    def changed(tally: _Tally, strata: list[int], own: list[str]) -> None:
        for k, text, r in zip(strata, own, local(shared, Repair).all(own), strict=True):
            if not r.damaged:
                continue  # certain spans would have been found
            before, lost = _without_certain(text), "lost" in r.kinds
            if lost or r.text != before:
                tally.change(k, before, -1)
                if not lost:
                    tally.change(k, r.text, 1)

    # a text of ASCII is never damaged
    both = first.unionByName(summed(changed, whole.where("octet_length(text) > length(text)")))
    return model(both.groupBy("key").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(names))]))


@lru_cache(maxsize=None)
def _to_bytes(codec: str) -> dict[int, str]:
    """Character -> its byte as a character; undefined bytes are the control characters they show as."""
    table = {}
    for b in range(128, 256):
        try:
            table[ord(bytes([b]).decode(codec))] = chr(b)
        except UnicodeDecodeError:
            pass
    if codec.startswith(("cp125", "iso")):
        for b in range(128, 160):
            table.setdefault(b, chr(b))
    return table


class _Bytes(dict):
    """For str.translate: what the encoding lacks becomes no byte."""

    def __missing__(self, code: int) -> str:
        self[code] = found = chr(code) if code < 128 else _NONE
        return found


@lru_cache(maxsize=None)
def _table(codec: str) -> _Bytes:
    return _Bytes(_to_bytes(codec))


@lru_cache(maxsize=None)
def _swap(shown: str, meant: str) -> _Bytes:
    """Character as shown by one encoding -> what its byte means in the other."""
    out = _Bytes()
    for code, b in _to_bytes(shown).items():
        try:
            out[code] = b.encode("latin-1").decode(meant)
        except UnicodeDecodeError:
            out[code] = _NONE
    return out


def _plausible(text: str, without: tuple[str, ...] = ("Cc", "Cn", "Co", "Cs")) -> bool:
    return not any(unicodedata.category(c) in without for c in text)


#: Certain spans hold at least two characters beyond ASCII side by side; most texts have none.
_TWO = re.compile("[^\x00-\x7f]{2}")


@lru_cache(maxsize=1)
def _gate() -> re.Pattern:
    """What can be a character of UTF-8 in any of the certain encodings."""
    parts, leads = [], set("\u00a1\u00a8")
    for codec in CERTAIN:
        two, three, four, rest = ("".join(re.escape(chr(c)) for c, b in _to_bytes(codec).items() if low <= ord(b) < high) for low, high in ((0xC2, 0xE0), (0xE0, 0xF0), (0xF0, 0xF5), (0x80, 0xC0)))
        leads |= {chr(c) for c, b in _to_bytes(codec).items() if 0xC2 <= ord(b) < 0xF5}
        # punctuation before a letter is common; it counts only in a row
        marks = "".join(re.escape(c) for c in map(chr, _to_bytes(codec)) if 0xC2 <= ord(_to_bytes(codec)[ord(c)]) < 0xE0 and unicodedata.category(c)[0] == "P")
        plain = "".join(c for c in two if c not in marks and c != "\\")
        parts += [f"[{plain}][{rest}]", f"[{three}][{rest}]{{2}}", f"[{four}][{rest}]{{3}}"] + ([f"(?:[{marks}][{rest}]){{4}}"] if marks else [])
    return re.compile(f"(?=[{re.escape(''.join(sorted(leads)))}])(?:{'|'.join(dict.fromkeys(parts))}|\u00a1[\u00a4\u00a7\u00aa-\u00b1]|\u00a8[\u00a1-\u00ba])")


def _excused(text: str, a: int, b: int, new: str) -> bool:
    """Whether the characters of a well-formed span could also meet in sound text, so that its structure proves nothing."""
    lead, cont = text[a], text[a + 1]
    before, after = (text[a - 1] if a else " "), (text[b] if b < len(text) else " ")
    if b - a == 3 and _han(new[0]):
        return True  # a letter before two closing signs
    kind = unicodedata.category(lead)
    if kind[0] == "P":
        return b - a < 3 or lead != "‚" and b - a < 8
    if kind[0] != "L":
        return "─" <= cont <= "▟" and not (before.isalpha() or after.isalpha())  # drawn tables
    if b - a > 2:
        return False
    if cont.isalpha():
        return not (lead.isupper() and before.islower() or cont in "ªºµ" and after.isalpha())
    closing = unicodedata.category(cont) in ("Pf", "Pi", "Pd", "Pe", "Po") or cont in "°®™"
    return closing and (before.isupper() or not before.isalpha() and not after.isalpha())


def _high(c: str) -> bool:
    return "\x80" <= c <= "\xff"


@lru_cache(maxsize=1 << 14)
def _through(run: str, codec: str) -> tuple[str, str, bool] | None:
    """(text, the same without lost characters, whether it holds Chinese) of a run whose bytes in a two-byte encoding are UTF-8; None if they tell nothing."""
    # no character takes "?" as a byte, so it stands for those that the encoding lacks
    raw = b"\x80".join(part.encode(codec, "replace").replace(b"?", b"\xff") for part in run.split("€"))
    # bytes that belong to no whole character were lost
    decoded = re.sub("�+", "�", raw.decode("utf-8", "replace"))
    read = decoded.replace("�", "")
    if not read or read.isascii() or 2 * (len(decoded) - len(read)) > len(decoded) or not _plausible(read):
        return None
    return decoded, read, any(map(_han, read))


@lru_cache(maxsize=None)
def _ends(codec: str, meant: str) -> tuple[frozenset[str], frozenset[str]]:
    """The characters that show the first and the further bytes of a span."""
    (low, high), (least, most) = ((0xC2, 0xF5), (0x80, 0xC0)) if meant == "utf-8" else ((0xA1, 0xF8), (0xA1, 0xFF))
    bytes_ = _to_bytes(codec).items()
    return frozenset(chr(c) for c, b in bytes_ if low <= ord(b) < high), frozenset(chr(c) for c, b in bytes_ if least <= ord(b) < most)


def _can_hold(signs: set[str], codec: str, meant: str) -> bool:
    first, further = _ends(codec, meant)
    return not (first.isdisjoint(signs) or further.isdisjoint(signs))


#: The readings of ``_certain``.
_SURE = (*((c, "utf-8", _UTF8) for c in CERTAIN), ("cp1252", "gb2312", _GB_LATIN))


def _certain(text: str) -> tuple[str, str] | None:
    """(encodings, text) with the spans decoded that are well-formed and not excused, under the encoding that explains most of the text."""
    if not _TWO.search(text) or not _gate().search(text):
        return None
    found: dict[int, list[tuple[int, int, str]]] = defaultdict(list)
    for m in _RUN.finditer(text):
        a, b = m.span()
        read = _certain_spans if b - a <= 24 else _certain_spans.__wrapped__
        for k, s, e, new in read(text[a - 1 : a], m.group(), text[b : b + 1]):
            found[k].append((a + s, a + e, new))
    if not found:
        return None
    k = max(sorted(found), key=lambda k: sum(b - a for a, b, _ in found[k]))
    parts, last = [], 0
    for a, b, new in found[k]:
        parts += [text[last:a], new]
        last = b
    codec, meant, _ = _SURE[k]
    return f"{meant} as {codec}", "".join([*parts, text[last:]])


@lru_cache(maxsize=1 << 14)
def _certain_spans(before: str, run: str, after: str) -> list[tuple[int, int, int, str]]:
    """(number of the reading, start, end, text) of the spans of a run beyond ASCII; all that they depend on is in it and beside it."""
    out, line, at, signs = [], before + run + after, len(before), set(run)
    for k, (codec, meant, automaton) in enumerate(_SURE):
        if not _can_hold(signs, codec, meant):
            continue
        shown = run.translate(_table(codec))
        for m in automaton.finditer(shown):
            a, b = m.span()
            if _high(shown[a - 1 : a]) or _high(shown[b : b + 1]):
                continue  # part of a run that is something else
            try:
                new = m.group().encode("latin-1").decode(meant)
            except UnicodeDecodeError:
                continue
            # damaged more than once: what lies between may look like nothing
            new = next((n for n in Repair._deeper(new, codec, meant) if all(map(_FAMILIAR.match, n))), None)
            if new is None or meant == "utf-8" and _excused(line, at + a, at + b, new):
                continue
            if codec == "cp1251" and b - a < 4 and new.isalpha() and not (line[at + a - 1 : at + a] + line[at + b : at + b + 1]).isascii():
                continue  # among Cyrillic letters a single one proves nothing
            out.append((k, a, b, new))
    return out


#: Places of characters in the tables of the screens.
_CODES = 0x110000


@lru_cache(maxsize=1)
def _certain_parts() -> tuple[np.ndarray, ...]:
    """What each character can be in the certain encodings, a bit for each: the first of two bytes, of three, of four, a punctuation mark as the first of two, a further byte."""
    two, three, four, marks, rest = out = tuple(np.zeros(_CODES, np.uint8) for _ in range(5))
    for i, codec in enumerate(CERTAIN):
        for code, b in _to_bytes(codec).items():
            if "\xc2" <= b < "\xe0":
                (marks if unicodedata.category(chr(code))[0] == "P" else two)[code] |= 1 << i
            elif "\xe0" <= b < "\xf5":
                (three if b < "\xf0" else four)[code] |= 1 << i
            elif b < "\xc0":
                rest[code] |= 1 << i
    return out


class _Line:
    """The characters of many texts beyond ASCII with their neighbours, in arrays; a blank stands around each text."""

    def __init__(self, texts: list[str]):
        self.n = len(texts)
        self.codes = codes = np.frombuffer(f" {' '.join(texts)}   ".encode("utf-32-le", "surrogatepass"), np.uint32)
        self.at = np.flatnonzero(codes >= 128)
        self.ends = np.cumsum(np.fromiter(map(len, texts), np.int64, self.n) + 1)
        self.before, self.own, self.after = codes[self.at - 1], codes[self.at], codes[self.at + 1]

    def texts(self, chosen: np.ndarray) -> np.ndarray:
        """Which texts hold chosen characters."""
        found = np.zeros(self.n, bool)
        found[np.searchsorted(self.ends, self.at[chosen], side="left")] = True
        return found

    def certain(self) -> np.ndarray:
        """Which texts can hold certain spans: all that ``_gate`` finds, and few more."""
        two, three, four, marks, rest = _certain_parts()
        lead, next_ = self.own, rest[self.after]
        found = two[lead] & next_ != 0
        found |= (lead == 0xA1) & (self.after >= 0xA4) & (self.after <= 0xB1) | (lead == 0xA8) & (self.after >= 0xA1) & (self.after <= 0xBA)
        longer = np.flatnonzero((three[lead] | four[lead] | marks[lead]) & next_)
        at = self.at[longer]
        lead, next_, third, fourth = lead[longer], next_[longer], self.codes[at + 2], rest[self.codes[at + 3]]
        found[longer] |= next_ & (three[lead] & rest[third] | four[lead] & rest[third] & fourth | marks[lead] & marks[third] & fourth) != 0
        return self.texts(found)


class _Screen:
    """Finds, of many texts at once, those that a model can take for damaged: lost characters, rare Chinese ones, unusual neighbours."""

    def __init__(self, model: Model):
        usual = [p for p, n in model.pair.items() if n >= model.least]
        signs = sorted({c for p in usual for c in p})
        self.place = np.full(_CODES, -1, np.int32)  # of the kind of each character seen, len(signs) for unknown kinds
        self.of = {c: i for i, c in enumerate(signs)}
        self.width = len(signs) + 1
        self.marked = np.zeros(_CODES, bool)
        self.marked[0x3400:0xA000] = True
        self.marked[[ord(c) for c, n in model.single.items() if _han(c) and n >= 2]] = False
        self.marked[0x80:0xA0] = self.marked[0xFFFD] = True
        if self.width <= 4096:
            self.table = np.zeros(self.width**2, bool)
            self.table[[self.of[p[0]] * self.width + self.of[p[1]] for p in usual]] = True
        else:
            pairs = np.sort(np.array([self.of[p[0]] * self.width + self.of[p[1]] for p in usual], np.int64))
            self.table = pairs

    def _usual(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pairs = a.astype(np.int64) * self.width + b
        if self.table.dtype == bool:
            return self.table[pairs]
        return self.table[np.minimum(np.searchsorted(self.table, pairs), len(self.table) - 1)] == pairs

    def _kinds(self, codes: np.ndarray) -> np.ndarray:
        found = self.place[codes]
        new = np.unique(codes[found < 0])
        if len(new):
            self.place[new] = [self.of.get(_kind(chr(c)), self.width - 1) for c in new.tolist()]
            found = self.place[codes]
        return found

    def suspect(self, line: _Line) -> np.ndarray:
        own = self._kinds(line.own)
        return line.texts(self.marked[line.own] | ~self._usual(self._kinds(line.before), own) | ~self._usual(own, self._kinds(line.after)))


def _all_without_certain(texts: list[str]) -> list[str]:
    return [_without_certain(t) if c else t for part in portions(texts) for t, c in zip(part, _Line(part).certain().tolist(), strict=True)]


def _without_certain(text: str) -> str:
    for _ in range(ROUNDS):
        found = None if text.isascii() else _certain(text)
        if found is None:
            break
        text = found[1]
    return text


@dataclass
class Result:
    text: str | None
    kinds: tuple[str, ...] = ()

    @property
    def damaged(self) -> bool:
        return bool(self.kinds)


class Repair:
    def __init__(self, model: Model):
        self.model = model
        self.usual: set[str] = set()
        self.read: dict[tuple[str, ...], list[tuple[int, int, float, str]]] = {}
        self.runs: dict[tuple[str, str, str], list[tuple[tuple[str, str], int, int, float, str]]] = {}
        self.meant: dict[str, list[tuple[int, str, float]]] = {}
        self.screen: _Screen | None = None

    def all(self, texts: list[str | None]) -> list[Result]:
        """The results of many texts; only what can be damaged is looked at one by one."""
        if self.screen is None:
            self.screen = _Screen(self.model)
        suspect: list[bool] = []
        certain: list[bool] = []
        for part in portions([t or "" for t in texts]):
            line = _Line(part)
            suspect += self.screen.suspect(line).tolist()
            certain += line.certain().tolist()
        sure = [_certain(t) if c else None for t, c in zip(texts, certain, strict=True)]
        return [self._repaired(t, found) if s or found else Result(t) for t, s, found in zip(texts, suspect, sure, strict=True)]

    def __call__(self, text: str | None) -> Result:
        return Result(text) if not text or text.isascii() else self._repaired(text, _certain(text))

    def _repaired(self, text: str, sure: tuple[str, str] | None) -> Result:
        """``sure`` is what ``_certain`` gives for the text."""
        kinds: list[str] = []
        for k in range(2 * ROUNDS):
            if k:
                sure = _certain(text)
            if sure:
                kinds.append(sure[0])
                text = sure[1]
                continue
            if not self._suspect(text):
                break
            # the reading that explains most; byte structure counts more than none
            utf8, gb = self._spans(text)
            found = max(utf8, self._through_double(text), gb, self._words(text), key=lambda f: f[0])
            if found[0] <= 0 or found[1].startswith("gb2312"):
                east = self._east(text)
                if east[0] > 0 and (found[0] <= 0 or 2 * len(_HIGH.findall(east[2])) < len(_HIGH.findall(found[2]))):
                    found = east
            if found[0] <= 0:
                break
            _, kind, text = found
            kinds.append(kind)
        if _LOST.search(text):
            kinds.append("lost")
        return Result(text, tuple(dict.fromkeys(kinds)))

    def _odd(self, word: str) -> bool:
        line, model = f" {word} ", self.model
        if not _BECOMES_ASCII.search(word):
            kinds = line.translate(_KINDS)
            if any(model.pair.get(x + y, 0) < model.least for x, y in set(zip(kinds, kinds[1:], strict=False)) if not (x + y).isascii()):
                return True
            return _HAN in kinds and any(_han(c) and model.single.get(c, 0) < 2 for c in set(word))
        return model.unusual(line)

    def _suspect(self, text: str) -> bool:
        """Some neighbours, one of them not ASCII, are unusual. Words that were sound before needn't be looked at again."""
        usual = self.usual
        for word in set(text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")):
            if word.isascii() or word in usual:
                continue
            if self._odd(word):
                # look-alikes, joiners and odd blanks are no damage
                form = canonical(word)
                if form == word or self._odd(form):
                    return True
            if len(word) <= 24:
                if len(usual) >= MEMO:
                    usual.clear()
                usual.add(word)
        return False

    def _gain(self, line: str, start: int, end: int, new: str) -> float:
        unknown = sum(not self.model.single.get(_kind(c)) for c in new)
        if 2 * unknown > len(new):
            return -math.inf
        before, after = (line[start - 1] if start else " "), (line[end] if end < len(line) else " ")
        return self.model.mean(before, new, after) - self.model.mean(before, line[start:end], after)

    def _spans(self, text: str) -> list[tuple[float, str, str]]:
        """Well-formed spans of UTF-8, and of the Chinese set, each under the single-byte encoding that explains most."""
        found: dict[tuple[str, str], list[tuple[int, int, float, str]]] = defaultdict(list)
        for m in _RUN.finditer(text):
            a, b = m.span()
            for encodings, s, e, gain, new in self._run(text[a - 1 : a] or " ", m.group(), text[b : b + 1] or " "):
                found[encodings].append((a + s, a + e, gain, new))
        out = []
        for meant in ("utf-8", "gb2312"):
            best, most, name = "", 0.0, ""
            for codec in SINGLE:
                parts, last, total = [], 0, 0.0
                for a, b, gain, new in found.get((codec, meant), ()):
                    parts += [text[last:a], new]
                    last, total = b, total + (gain + 3 * (meant == "utf-8")) * (b - a)
                if total > most:
                    best, most, name = "".join([*parts, text[last:]]), total, f"{meant} as {codec}"
            out.append((most, name, best))
        return out

    def _run(self, before: str, run: str, after: str) -> list[tuple[tuple[str, str], int, int, float, str]]:
        """(encodings, start, end, gain, text) of the pieces of a run beyond ASCII that are clearly more usual when decoded; runs come again and are remembered."""
        key = before, run, after
        found = self.runs.get(key)
        if found is None:
            found, line, signs = [], before + run + after, set(run)
            for codec in SINGLE:
                shown = ""
                for meant, automaton in (("utf-8", _UTF8), ("gb2312", _GB)):
                    if not _can_hold(signs, codec, meant):
                        continue
                    shown = shown or run.translate(_table(codec))
                    for m in automaton.finditer(shown):
                        a, b = m.span()
                        found += [((codec, meant), a + s, a + e, gain, new) for s, e, gain, new in self._read(codec, meant, m.group(), line[a], run[a:b], line[b + 1])]
            if len(run) <= 24:
                if len(self.runs) >= MEMO:
                    self.runs.clear()
                self.runs[key] = found
        return found

    def _read(self, codec: str, meant: str, shown: str, before: str, span: str, after: str) -> list[tuple[int, int, float, str]]:
        """(start, end, gain, text) of the pieces of a span that are clearly more usual when decoded; words come again and are remembered."""
        key = codec, meant, before, span, after
        found = self.read.get(key)
        if found is None:
            found, line = [], before + span + after
            for s, e, options in self._pieces(shown, 0, len(shown), codec, meant):
                gain, new = max((self._gain(line, s + 1, e + 1, n), n) for n in options)
                if new == "\ufeff":
                    gain, new = 2 * LEAST, ""
                if gain > MARGIN and gain * (e - s) > LEAST / 2 or gain > MARGIN / 4 and gain * (e - s) > LEAST:
                    found.append((s, e, gain, new))
            if len(span) <= 24:
                if len(self.read) >= MEMO:
                    self.read.clear()
                self.read[key] = found
        return found

    @staticmethod
    def _deeper(new: str, codec: str, meant: str) -> list[str]:
        """What a span means, and what that means if it was damaged more than once: between the steps nothing looks usual."""
        out = [new]
        if meant == "utf-8":
            for again in dict.fromkeys((codec, "cp1252")):
                deep = new
                for _ in range(ROUNDS):
                    shown = deep.translate(_table(again))
                    parts, last = [], 0
                    for m in _UTF8.finditer(shown):
                        parts += [deep[last : m.start()], m.group().encode("latin-1").decode("utf-8")]
                        last = m.end()
                    if not parts:
                        break
                    deep = "".join([*parts, deep[last:]])
                    out.append(deep)
        return out

    def _pieces(self, shown: str, a: int, b: int, codec: str, meant: str) -> Iterator[tuple[int, int, list[str]]]:
        """The readings of a maximal span, or where a part of it gives no plausible text, of the characters that do."""

        def readings(s: int, e: int) -> list[str]:
            try:
                new = shown[s:e].encode("latin-1").decode(meant)
            except UnicodeDecodeError:
                return []
            return [n for n in self._deeper(new, codec, meant) if _plausible(n)]

        whole = readings(a, b)
        if whole:
            yield a, b, whole
            return
        width = {"utf-8": lambda c: 2 if c < "\xe0" else 3 if c < "\xf0" else 4}.get(meant, lambda c: 2)
        while a < b:
            e = min(b, a + width(shown[a]))
            options = readings(a, e)
            if options:
                yield a, e, options
            a = e

    def _through_double(self, text: str) -> tuple[float, str, str]:
        """UTF-8 that was read as a two-byte encoding: bytes no longer lie one to a character.

        A run may have swallowed the ASCII letter behind it, or be a single
        character that stands for one accented letter.
        """
        for codec in DOUBLE:
            parts, last, total = [], 0, 0.0
            for m in re.finditer("[^\x00-\x7f]+", text):
                run = m.group()
                found = _through(run, codec)
                if found is None:
                    continue
                decoded, read, han = found
                before, after = text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1]
                if len(read) < 2 and (han or not (before.isalpha() or after.isalpha())):
                    continue
                bare = run.replace("�", "")
                if han:
                    before = after = ""
                gain = self.model.mean(before, read, after) - self.model.mean(before, bare, after)
                if gain > MARGIN:
                    parts += [text[last : m.start()], decoded]
                    last, total = m.end(), total + (gain + 3) * len(run)
            if parts:
                return total, f"utf-8 as {codec}", "".join([*parts, text[last:]])
        return 0.0, "", text

    def _east(self, text: str) -> tuple[float, str, str]:
        """Spans of an East Asian set whose characters are nearly all among its frequent ones, which other text isn't by chance."""
        shown = text.translate(_table("cp1252"))
        best, most, name = text, 0.0, ""
        for meant, (automaton, frequent) in _EAST.items():
            parts, last, total = [], 0, 0.0
            for m in automaton.finditer(shown):
                raw = m.group()
                try:
                    new = raw.encode("latin-1").decode(meant)
                except UnicodeDecodeError:
                    continue
                share = sum(bool(frequent.match(raw, i)) for i in range(0, len(raw), 2)) / (len(raw) / 2)
                if share >= 0.8 and _plausible(new) and not any(c.isascii() for c in new) and not any(map(_han, text[m.start() : m.end()])):
                    parts += [text[last : m.start()], new]
                    last, total = m.end(), total + share * len(raw)
            if total > most:
                best, most, name = "".join([*parts, text[last:]]), total, f"{meant} as cp1252"
        return most, name, best

    def _words(self, text: str) -> tuple[float, str, str]:
        """Words with unusual neighbours, read in another single-byte encoding."""
        found: dict[int, list[tuple[int, str, str, float]]] = defaultdict(list)
        for m in _WORD.finditer(text):
            w = m.group()
            if not w.isascii():
                for pair, new, gain in self._meant(w):
                    found[pair].append((m.start(), w, new, gain))
        best, most, name = None, LEAST, ""
        for pair in sorted(found):
            changes, total = found[pair], 0.0
            for *_, gain in changes:
                total += gain
            # a lone sign that would be a letter elsewhere proves nothing
            if total > most and any(len(w) > 1 or not new.isalpha() for _, w, new, _ in changes):
                shown, meant = divmod(pair, len(SINGLE))
                best, most, name = changes, total, f"{SINGLE[meant]} as {SINGLE[shown]}"
        if best is None:
            return 0.0, "", text
        parts, last = [], 0
        for start, w, new, _ in best:
            parts += [text[last:start], new]
            last = start + len(w)
        return most, name, "".join([*parts, text[last:]])

    def _meant(self, word: str) -> list[tuple[int, str, float]]:
        """(number of the pair of encodings, text, gain) of the readings of an unusual word that are clearly more usual; words come again and are remembered."""
        found = self.meant.get(word)
        if found is None:
            found = self._readings(word) if self._misread(word) else []
            if len(word) <= 24:
                if len(self.meant) >= MEMO:
                    self.meant.clear()
                self.meant[word] = found
        return found

    def _misread(self, word: str) -> bool:
        if not self.model.unusual(f" {word} "):
            return False
        form = canonical(word)  # look-alikes are no damage
        return form == word or form is not None and not form.isascii() and self.model.mean(" ", form, " ") < self.model.mean(" ", word, " ") + 0.5

    def _readings(self, word: str) -> list[tuple[int, str, float]]:
        found, known = [], self.model.mean(" ", word, " ")
        # 0 for what can't be meant; pairs of encodings often give the same word
        gains: dict[str, float] = {word: 0.0}
        by_bytes: dict[str, list[tuple[int, str, float]]] = {}
        for k, shown in enumerate(SINGLE):
            own = word.translate(_table(shown))
            if _NONE in own:
                continue
            options = by_bytes.get(own)
            if options is None:
                options = by_bytes[own] = []
                for i, meant in enumerate(SINGLE):
                    new = word.translate(_swap(shown, meant))
                    gain = gains.get(new)
                    if gain is None:
                        gain = 0.0
                        if _NONE not in new and not self.model.unusual(f" {new} ") and _plausible(new, ("Cc", "Cf", "Cn", "Co", "Cs", "Zs")) and (_INNER_CAPITAL.search(word) or not _INNER_CAPITAL.search(new)):
                            gain = (self.model.mean(" ", new, " ") - known) * (len(word) + 1)
                        gains[new] = gain
                    if gain > 1.5:
                        options.append((i, new, gain))
            found += [(k * len(SINGLE) + i, new, gain) for i, new, gain in options if i != k]
        return found


def share(texts: DataFrame, text_col: str = "text", quotas: dict[str, int] | None = None) -> Broadcast:
    """The fitted model for the executors; with quotas it holds what occurs in more than one of the texts these add up to."""
    return texts.sparkSession.sparkContext.broadcast(fit_frame(texts, text_col, quotas))


def repaired(texts: DataFrame, model: Broadcast, keep: list[str], text_col: str = "content") -> DataFrame:
    """The kept columns, ``restored``, ``damaged`` and ``kinds``; one row per input row."""
    schema = T.StructType([texts.schema[c] for c in keep] + [T.StructField("restored", T.StringType()), T.StructField("damaged", T.BooleanType()), T.StructField("kinds", T.ArrayType(T.StringType(), False))])

    def rows(columns: list[list]) -> Iterator[tuple]:
        for *kept, r in zip(*columns[:-1], local(model, Repair).all(columns[-1]), strict=True):
            yield *kept, r.text, r.damaged, list(r.kinds)

    return map_rows(texts, {**{c: c for c in keep}, "\x00text": text_col}, schema, rows)

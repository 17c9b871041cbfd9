"""Languages of documents and of their mixed segments (problem 3).

Every n-gram of letters is looked up in bit-sliced Bloom filters: one byte per
slot, one bit of it per language, so that the AND of a few slots gives all
languages that hold the n-gram at once. A sentence counts, per language, the
n-grams whose answer has its bit (a popcount of the slice); what false
positives add is taken off, and the largest corrected share decides.

The filters are fitted on all labelled documents. Labels may be
wrong: an n-gram gets the bit of a language only if it is about as frequent
there as where it is most frequent, and the filters are fitted a second time on
the documents as labelled by the first.

Defined results: null, empty and letterless texts have no segment. A stretch
too short to tell takes the language of the segment before it, else after it;
where nothing tells, there is no segment.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.llm.arrow import SLICE, local, map_rows, portions
from folioloom.llm.labels import LANGUAGES, file_label
from folioloom.llm.training import PER_LABEL
from folioloom.runtime import checkpointed

#: Slots of the filters (a power of two) and slots per n-gram.
SLOTS, HASHES = 1 << 20, 3
#: An n-gram belongs to languages in which it has at least this part of its highest rate, and occurs in so many texts.
PART, LEAST_TEXTS = 0.2, 3
#: Sizes of n-grams; Chinese characters also count alone.
SIZES = (2, 3, 4)
#: A sentence needs so many n-grams to have a language of its own, and so large a corrected share and lead.
LEAST_GRAMS, LEAST_SHARE, LEAST_LEAD = 12, 0.4, 0.1

#: The confidence is the share of the language among all shares, each raised to this power.
SHARPEN = 6
#: A sentence whose end was lost counts as whole if it has so many letters (Chinese: so many characters).
LONG, LONG_HAN = 60, 20
#: Words of a whole sentence at least; identifiers and codes have none.
LEAST_WORDS = 3

_PRIME = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64)
#: Ends of sentences: marks of the end with what closes quotes, then a blank or nothing; line ends.
_END = re.compile(r"[.!?…。！？\n](?:(?<=[.!?…])[.!?…]*[\"'”’»)\]]*(?=\s|$)|(?<=[。！？])[。！？]*[”’」』）\"]*|(?<=\n)\n*)")

_HAN_RUN = re.compile("[\u4e00-\u9fff]{3}")
#: Marks of the end, and what may stand behind them.
_MARKS, _CLOSING = tuple(".!?…。！？"), "-–—\"'”’»)]」』）"


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Lower-case code point of each character of the first two planes, a blank for what is no letter; marks of an accent count as letters."""
    out = np.full(0x20000, 32, np.uint32)
    for code in (*range(0xD800), *range(0xE000, 0x20000)):
        c = chr(code)
        if c.isalpha() or 0x300 <= code < 0x370:
            low = c.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def _letters(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    table = _folded()
    if len(codes) and codes.max() >= len(table):
        # the rarer planes hold Chinese letters and signs
        far = codes >= len(table)
        return np.where(far, np.where(codes < 0x32000, codes, 32), table[np.where(far, 32, codes)])
    return table[codes]


#: N-grams are hashed and looked up so many at a time, as these stay in a core's cache.
BLOCK = 1 << 15


def _by_size(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, positions of the last letter, ascending) of the n-grams of each size, then of the single Chinese characters."""
    return _by_size_of(_letters(text))


def _by_size_of(letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    codes = np.full(len(letters) + 2, 32, np.uint64)
    codes[1:-1] = letters
    blank = codes == 32
    inner, last = ~blank, max(0, len(letters) - 1)
    for n in SIZES:
        m = max(0, len(codes) - n + 1)
        good = inner[:m] | inner[n - 1 : n - 1 + m]
        for i in range(1, n - 1):
            good &= inner[i : i + m]
        keys = [_hashed(codes[a : a + BLOCK + n - 1], n)[good[a : a + BLOCK]] for a in range(0, m, BLOCK)]
        # one blank was put before the text; an n-gram that ends in the closing blank counts for the last letter
        yield np.concatenate(keys or [codes[:0]]), np.clip(np.flatnonzero(good) + (n - 2), 0, last)
    han = np.flatnonzero((codes >= 0x3400) & (codes < 0xA000))
    yield _hashed(codes[han], 1), np.clip(han - 1, 0, last)


def _hashed(codes: np.ndarray, n: int) -> np.ndarray:
    """The keys of all stretches of n codes."""
    m = max(0, len(codes) - n + 1)
    h = np.full(m, n, np.uint64)
    high = np.empty(m, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            h ^= codes[i : i + m]
            h *= _PRIME[i % 4]
            h ^= np.right_shift(h, np.uint64(29), out=high)
    return h


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(keys, positions of the last letter) of all n-grams; words are padded with one blank, none reaches over it."""
    keys, ends = zip(*_by_size(text), strict=True)
    return np.concatenate(keys), np.concatenate(ends)


def _texts_with(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, in how many of the texts each occurs)."""
    joined, starts = "\n".join(texts), np.cumsum([0, *(len(t) + 1 for t in texts)])
    kept = []
    for keys, ends in _by_size(joined):
        # each text's keys are sorted, then all but the first of equal ones fall away
        bounds = np.searchsorted(ends, starts).tolist()
        for a, b in zip(bounds, bounds[1:], strict=False):
            keys[a:b].sort()
        first = np.ones(len(keys), bool)
        np.not_equal(keys[1:], keys[:-1], out=first[1:])
        first[[a for a in bounds if a < len(keys)]] = True
        kept.append(keys[first])
    return np.unique(np.concatenate(kept), return_counts=True)


def _slots(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        first = keys * _PRIME[1]
        second = (keys ^ (keys >> np.uint64(31))) * _PRIME[2] | np.uint64(1)
        return np.stack([((first + np.uint64(i) * second) >> np.uint64(20)) & np.uint64(SLOTS - 1) for i in range(HASHES)]).astype(np.int64)


#: The languages of each mask.
_BITS = (np.arange(256)[:, None] >> np.arange(len(LANGUAGES))) & 1


@dataclass
class Filters:
    """``slices[slot]`` has a bit per language; ``chance`` is each language's rate of false positives."""

    slices: np.ndarray
    chance: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, masks: np.ndarray) -> Filters:
        slices = np.zeros(SLOTS, np.uint8)
        for row in _slots(keys):
            np.bitwise_or.at(slices, row, masks)
        return cls.filled(slices)

    @classmethod
    def filled(cls, slices: np.ndarray) -> Filters:
        filled = np.array([(slices >> b & 1).mean() for b in range(len(LANGUAGES))])
        return cls(slices, filled**HASHES)

    def masks(self, keys: np.ndarray) -> np.ndarray:
        out = np.empty(len(keys), np.uint8)
        for a in range(0, len(keys), BLOCK):
            part = keys[a : a + BLOCK]
            with np.errstate(over="ignore"):
                slot, step = part * _PRIME[1], (part ^ (part >> np.uint64(31))) * _PRIME[2] | np.uint64(1)
                found = self.slices[(slot >> np.uint64(20) & np.uint64(SLOTS - 1)).view(np.int64)]
                for _ in range(HASHES - 1):  # as _slots
                    slot += step
                    found &= self.slices[(slot >> np.uint64(20) & np.uint64(SLOTS - 1)).view(np.int64)]
            out[a : a + BLOCK] = found
        return out


def fit(samples: list[tuple[str, str]]) -> Filters:
    """Filters from (label, text) pairs; texts with other labels are left out of the first fit."""
    known = {lang: i for i, lang in enumerate(LANGUAGES)}
    sets = [np.unique(grams(t)[0]) for _, t in samples]
    labels = [known.get(lang, -1) for lang, _ in samples]
    return _fit(sets, Judge(_fit(sets, labels)).relabelled(labels, [t for _, t in samples]))


def _fit(sets: list[np.ndarray], labels: list[int]) -> Filters:
    keys = np.concatenate([s for s, k in zip(sets, labels, strict=True) if k >= 0] or [np.zeros(0, np.uint64)])
    own = np.concatenate([np.full(len(s), k) for s, k in zip(sets, labels, strict=True) if k >= 0] or [np.zeros(0, np.int64)])
    unique, back = np.unique(keys, return_inverse=True)
    counts = np.bincount(back * len(LANGUAGES) + own, minlength=len(unique) * len(LANGUAGES)).reshape(-1, len(LANGUAGES))
    texts = Counter(k for k in labels if k >= 0)
    masks = _belongs(counts, np.array([max(1, texts[k]) for k in range(len(LANGUAGES))]), LEAST_TEXTS)
    return Filters.of(unique[masks > 0], masks[masks > 0])


def fit_frame(documents: DataFrame) -> Filters:
    """``fit`` on all (label, text) rows by all executors.

    An n-gram must occur in as large a share of a language's texts as
    ``LEAST_TEXTS`` is of ``PER_LABEL``, so the filters don't fill up with what
    any large corpus holds a few times. Texts are counted as bits of slots;
    at most a row per slot reaches the driver.
    """
    known = {lang: i for i, lang in enumerate(LANGUAGES)}
    spark, width = documents.sparkSession, len(LANGUAGES)
    names = [f"n{i}" for i in range(width)]

    def counted(moves: Callable[[list[int], list[str]], Iterator[tuple[int, int, list[str]]]]) -> DataFrame:
        """The sums of the texts that ``moves`` puts to a language (sign 1) or takes from it (sign -1)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def made() -> pa.RecordBatch:
                keys, n = _summed(waiting, width)
                waiting.clear()
                columns = [pa.array(keys.view(np.int64)), *(pa.array(n[:, i]) for i in range(width))]
                return pa.RecordBatch.from_arrays(columns, names=["key", *names])

            waiting: list[tuple[np.ndarray, np.ndarray]] = []
            texts = np.zeros((1, width), np.int64)
            for batch in batches:
                for start in range(0, batch.num_rows, SLICE):
                    labels, own = (c.to_pylist() for c in batch.slice(start, SLICE).columns)
                    for k, sign, moved in moves([known.get(label, -1) for label in labels], own):
                        texts[0, k] += sign * len(moved)
                        for part in portions(moved):
                            keys, n = _texts_with(part)
                            counts = np.zeros((len(keys), width), np.int64)
                            counts[:, k] = sign * n
                            waiting.append((keys, counts))
                    if sum(len(keys) for keys, _ in waiting) > 2_000_000:
                        waiting[:] = [_summed(waiting, width)]
                        if len(waiting[0][0]) > 1_000_000:
                            yield made()
            # the number of texts has a key that no n-gram is given
            waiting.append((np.full(1, _TEXTS, np.uint64), texts))
            yield made()

        rows = documents.select("label", "text").mapInArrow(run, "key long, " + ", ".join(f"{n} long" for n in names))
        return rows.groupBy("key").agg(*[F.sum(n).alias(n) for n in names])

    def fitted(sums: DataFrame) -> Filters:
        total = sums.where(F.col("key") == _TEXTS).first()
        if total is None:
            return Filters.of(np.zeros(0, np.uint64), np.zeros(0, np.uint8))
        sizes = np.maximum(1, np.array(total[1:]))
        least = LEAST_TEXTS * np.maximum(1.0, sizes / PER_LABEL)

        def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            slices = np.zeros(SLOTS, np.uint8)
            for batch in batches:
                keys = batch.column(0).to_numpy().view(np.uint64)
                counts = np.stack([batch.column(i + 1).to_numpy() for i in range(width)], axis=1)
                masks = _belongs(counts, sizes, least)
                chosen = (masks > 0) & (keys != np.uint64(_TEXTS))
                for row in _slots(keys[chosen]):
                    np.bitwise_or.at(slices, row, masks[chosen])
            filled = np.flatnonzero(slices)
            yield pa.RecordBatch.from_arrays([pa.array(filled.astype(np.int32)), pa.array(slices[filled].astype(np.int32))], names=["slot", "mask"])

        table = sums.mapInArrow(slots, "slot int, mask int").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
        slices = np.zeros(SLOTS, np.uint8)
        slices[table["slot"].to_numpy()] = table["mask"].to_numpy()
        return Filters.filled(slices)

    def labelled(labels: list[int], own: list[str]) -> Iterator[tuple[int, int, list[str]]]:
        for k in range(width):
            if k in labels:
                yield k, 1, [t for t, label in zip(own, labels, strict=True) if label == k]

    def relabelled(labels: list[int], own: list[str]) -> Iterator[tuple[int, int, list[str]]]:
        # texts that keep their label were counted with it
        moved = [(was, now, t) for was, now, t in zip(labels, local(shared, Judge).relabelled(labels, own), own, strict=True) if was != now]
        for k in range(width):
            for side, sign in ((0, -1), (1, 1)):
                texts = [m[2] for m in moved if m[side] == k]
                if texts:
                    yield k, sign, texts

    first = checkpointed(counted(labelled))
    shared = spark.sparkContext.broadcast(fitted(first))
    both = first.unionByName(counted(relabelled)).groupBy("key").agg(*[F.sum(n).alias(n) for n in names])
    return fitted(checkpointed(both))


#: The key of the number of texts.
_TEXTS = 0


def _summed(parts: list[tuple[np.ndarray, np.ndarray]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(different keys, sums of their counts)."""
    keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    rows = np.concatenate([n for _, n in parts])
    return keys, np.stack([np.bincount(back, rows[:, i], len(keys)).astype(np.int64) for i in range(width)], axis=1)


def _belongs(counts: np.ndarray, sizes: np.ndarray, least: np.ndarray | int) -> np.ndarray:
    """The mask of the languages that each n-gram belongs to."""
    rates = counts / sizes
    belongs = (rates >= PART * rates.max(axis=1, keepdims=True, initial=0)) & (counts >= least)
    return (belongs * (1 << np.arange(len(LANGUAGES)))).sum(axis=1).astype(np.uint8)


def _whole(sentence: str) -> bool:
    """Ends as a sentence does and has as many words as one (Chinese has no blanks); or its end may be among its lost characters and it is as long as one."""
    if sentence.rstrip().rstrip(_CLOSING).endswith(_MARKS):
        return len(sentence.split(None, LEAST_WORDS)) >= LEAST_WORDS or bool(_HAN_RUN.search(sentence))
    return "\ufffd" in sentence and sum(map(str.isalpha, sentence)) >= (LONG_HAN if _HAN_RUN.search(sentence) else LONG)


@dataclass(frozen=True)
class Segment:
    start: int
    end: int
    lang: str
    confidence: float
    sentences: int


#: Words that a worker remembers, and their characters; when there are more, it starts anew. Only speed depends on it.
WORDS, WORD_CHARS = 100_000, 2_000_000


class _Words(dict):
    """The number of each word; ``new`` are those without hits yet."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = found = len(self)
        self.new.append(word)
        return found


class Judge:
    def __init__(self, filters: Filters):
        self.filters = filters
        self._forget()

    def _forget(self) -> None:
        self.words, self.chars = _Words(), 0
        #: Per word: how many of its n-grams each language holds, and how many there are.
        self.hits = np.zeros((1024, len(LANGUAGES) + 1), np.int32)

    def _hits(self, words: list[str]) -> np.ndarray:
        """The hits of each word. No n-gram reaches over a word, so each word is looked up once."""
        if len(self.words) > WORDS or self.chars > WORD_CHARS:
            self._forget()
        own = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        new, count = self.words.new, len(self.words)
        if new:
            if count > len(self.hits):
                self.hits = np.concatenate([self.hits, np.zeros((count, self.hits.shape[1]), np.int32)])
            codes = np.frombuffer(" ".join(new).encode("utf-32-le"), np.uint32)
            # a blank counts for the word before it
            word, masks = np.cumsum(codes == 32) - (codes == 32), 1 << len(LANGUAGES)
            counts = np.zeros(len(new) * masks, np.int64)
            for keys, ends in _by_size_of(codes):
                counts += np.bincount(word[ends] * masks + self.filters.masks(keys), minlength=len(counts))
            # how often each mask occurs in each word, then how often each language; most masks don't
            seen = np.flatnonzero(counts)
            rows, n = seen // masks, counts[seen]
            bits = _BITS[seen % masks] * n[:, None]
            for b in range(len(LANGUAGES)):
                self.hits[count - len(new) : count, b] = np.bincount(rows, bits[:, b], len(new))
            self.hits[count - len(new) : count, -1] = np.bincount(rows, n, len(new))
            self.chars += len(codes)
            self.words.new = []
        return self.hits[own]

    def _corrected(self, hits: np.ndarray, n: int) -> np.ndarray:
        f = self.filters.chance
        return np.clip((hits - n * f) / (1 - f), 0, None) / max(n, 1)

    def shares(self, text: str) -> tuple[np.ndarray, int]:
        keys, _ = grams(text)
        return self.shares_of(keys), len(keys)

    def shares_of(self, keys: np.ndarray) -> np.ndarray:
        found = np.bincount(self.filters.masks(keys), minlength=256)
        return self._corrected(found @ _BITS, len(keys))

    def _shares_by(self, text: str, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(corrected shares, number of n-grams) of each piece of a text, given their ends."""
        # a piece ends behind its last word, never in one
        letters = _letters(text)
        inner = letters != 32
        starts = np.flatnonzero(inner & ~np.concatenate([[False], inner[:-1]]))
        sums = np.zeros((len(starts) + 1, len(LANGUAGES) + 1), np.int64)
        np.cumsum(self._hits(letters.tobytes().decode("utf-32-le").split()), axis=0, out=sums[1:])
        pieces = np.diff(sums[np.searchsorted(starts, cuts)], axis=0, prepend=sums[:1])
        hits, sizes = pieces[:, :-1], pieces[:, -1]
        f = self.filters.chance
        return np.clip((hits - sizes[:, None] * f) / (1 - f), 0, None) / np.maximum(sizes, 1)[:, None], sizes

    def relabelled(self, labels: list[int], texts: list[str]) -> list[int]:
        """The language each text is clearly in, -1 where none is; the given label of texts too short to tell."""
        best: list[int] = []
        for part in portions(texts):
            # a line end keeps texts apart; it belongs to the text before
            shares, n = self._shares_by("\n".join(part), np.cumsum([len(t) + 1 for t in part]))
            top = np.sort(shares, axis=1)
            sure = (n >= LEAST_GRAMS) & (top[:, -1] - top[:, -2] >= LEAST_LEAD)
            best += np.where(sure, shares.argmax(axis=1), np.where(n < LEAST_GRAMS, -2, -1)).tolist()
        return [label if k == -2 else k for label, k in zip(labels, best, strict=True)]

    def segments(self, text: str | None) -> list[Segment]:
        """Stretches of whole sentences in one language each."""
        return self.segments_of([text])[0]

    def segments_of(self, texts: list[str | None]) -> list[list[Segment]]:
        """The segments of each text; the n-grams of many are looked up at once."""
        return [found for part in portions([t or "" for t in texts]) for found in self._segments_at_once(part)]

    def _segments_at_once(self, texts: list[str]) -> list[list[Segment]]:
        out: list[list[Segment]] = [[] for _ in texts]
        own = [k for k, t in enumerate(texts) if t and not t.isspace()]
        if not own:
            return out
        cuts: list[int] = []
        pieces: list[tuple[int, list[int], int]] = []
        base = 0
        for k in own:
            text = texts[k]
            ends = [m.end() for m in _END.finditer(text)]
            if not ends or ends[-1] < len(text):
                ends.append(len(text))
            pieces.append((k, ends, len(cuts)))
            cuts += [base + e for e in ends]
            base += len(text) + 1  # a line end keeps texts apart; it belongs to the text before
            cuts[-1] = base
        share, sizes = self._shares_by("\n".join(texts[k] for k in own), np.array(cuts))
        top = np.sort(share, axis=1)
        sure = (sizes >= LEAST_GRAMS) & (top[:, -1] >= LEAST_SHARE) & (top[:, -1] - top[:, -2] >= LEAST_LEAD)
        names = [LANGUAGES[b] for b in share.argmax(axis=1).tolist()]
        power = share**SHARPEN
        confidence = power.max(axis=1) / np.maximum(power.sum(axis=1), 1e-300)
        told = [pair if s else None for *pair, s in zip(names, confidence.tolist(), sure.tolist(), strict=True)]
        weights = sizes.tolist()
        for k, ends, at in pieces:
            text, stop = texts[k], at + len(ends)
            full = [_whole(text[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
            out[k] = self._joined(ends, full, told[at:stop], weights[at:stop])
        return out

    @staticmethod
    def _joined(cuts: list[int], full: list[bool], told: list[list | None], sizes: list[int]) -> list[Segment]:
        out: list[list] = []
        weight = start = 0
        for end, whole, t, n in zip(cuts, full, told, sizes, strict=True):
            last = out[-1] if out else None
            if t is None:
                # too short to tell: part of the segment before it, or of the one that comes
                if last:
                    last[1] = start = end
                continue
            lang, confidence = t
            if last and last[2] == lang:
                last[1], last[3] = end, (last[3] * weight + confidence * n) / (weight + n)
                last[4] += whole
                weight += n
            else:
                out.append([start, end, lang, confidence, int(whole)])
                weight = n
            start = end
        return [Segment(*s) for s in out]


def _letters_in(texts: list[str], found: list[list[Segment]]) -> Iterator[list[int]]:
    """How many letters each segment of each text has."""
    rest = iter(found)
    for part in portions(texts):
        codes = np.frombuffer("".join(part).encode("utf-32-le"), np.uint32)
        table, far = _folded(), codes >= 0x20000
        letter = (table[np.where(far, 32, codes)] != 32) & ~((codes >= 0x300) & (codes < 0x370))
        letter[far] = [chr(c).isalpha() for c in codes[far].tolist()]
        sums = np.concatenate([[0], np.cumsum(letter)])
        base = 0
        for text, segments in zip(part, rest):  # noqa: B905
            ends = np.array([(s.start, s.end) for s in segments], np.int64).reshape(-1, 2) + base
            yield (sums[ends[:, 1]] - sums[ends[:, 0]]).tolist()
            base += len(text)


def segment_texts(texts: DataFrame, filters: Broadcast, keep: list[str], text_col: str = "content", prepare: Callable[[], Callable[[list[str | None]], list[str | None]]] | None = None) -> DataFrame:
    """The kept columns, seg_no, start_char, end_char, lang, confidence and the number of whole sentences, for each segment.

    ``prepare`` makes, in each worker, a function that brings texts into the
    form that is judged (positions then refer to that form).
    """
    schema = T.StructType(
        [texts.schema[c] for c in keep]
        + [T.StructField(c, T.IntegerType()) for c in ("seg_no", "start_char", "end_char")]
        + [T.StructField("lang", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("sentences", T.IntegerType()), T.StructField("letters", T.IntegerType())]
    )

    def rows(columns: list[list]) -> Iterator[tuple]:
        judge = local(filters, Judge)
        form = prepare() if prepare else None
        *kept_columns, raw = columns
        texts = form(raw) if form else raw
        found = judge.segments_of(texts)
        for *kept, segments, letters in zip(*kept_columns, found, _letters_in(texts, found), strict=True):
            for k, (s, n) in enumerate(zip(segments, letters, strict=True)):
                yield *kept, k, s.start, s.end, s.lang, s.confidence, s.sentences, n

    return map_rows(texts.where(F.col(text_col).isNotNull()), {**{c: c for c in keep}, "\x00text": text_col}, schema, rows)


def file_labels(tasks: DataFrame) -> DataFrame:
    """(doc_id, label): what each file of the requests is labelled as, null where the label names no language.

    A file sent again keeps the label of the latest request that has one; rows
    delivered twice change nothing.
    """
    each = tasks.where(F.col("file_names").isNotNull()).select("submit_order", "file_names", "lang_list", F.posexplode("file_names").alias("position", "doc_id"))
    label: Column = file_label(F.col("file_names"), F.col("lang_list"), F.col("position"))
    named = each.select("doc_id", label.alias("label"), "submit_order").where(F.col("doc_id").isNotNull())
    return named.groupBy("doc_id").agg(F.max_by("label", F.when(F.col("label").isNotNull(), F.struct("submit_order", "label"))).alias("label"))

"""Repairing the text of scanned pages (problem 2).

Three averaged perceptrons, all fitted on bounded samples that the corpus
labels itself:

* *furniture*: running headers, footers and page numbers, from the position on
  the page, the shape of the line and how often its letters, or its number in
  step with the pages, come again in the file;
* *editor*: for each character of a word keep, replace, delete or insert. Its
  examples are rare words beside a far more frequent one that differs by a
  character or two; a correction must be a word of the corpus;
* *join*: whether a hyphen at a line's end was put there by the line break.

Words are counted over all lines. The vocabulary holds the words that make up
at least a fixed share of all tokens, so its size is bounded whatever the
corpus (at most 1 / share words), and is checked before it is broadcast.

Defined results: lines without text are no cases and don't stand between two
halves of a word; null or swapped boxes only take the position away; repeated
spans count once. Spans of other types (formulas) are no cases and stand between
no halves of a word; they are kept as they are among the body lines.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.llm.arrow import local, map_rows
from folioloom.llm.perceptron import Perceptron
from folioloom.runtime import checkpointed

#: The least share of all tokens, and the least number, that make a word known.
KNOWN_SHARE, KNOWN_LEAST = 1e-6, 4
#: Words below this share of all tokens may be misread ones.
RARE_SHARE = 2e-4
#: Rows at most in each sample a model is fitted on, and words at most that are broadcast.
SAMPLE, VOCABULARY = 4000, 1_000_000
#: A correction must be so many times as frequent as what stands there; as a word below the second share of all tokens, only so many times.
RATIO, SELDOM_SHARE, SELDOM_RATIO = 20, 1e-5, 5
#: What a line's end may be hyphenated with.
HYPHENS = "-‐­¬"
#: Dirt that was read as punctuation: signs alone at the ends of a line.
SPECKS = r"^\s*(?:[.,·:;'`~^*]\s+)+|(?:\s+[.,·:;'`~^*])+\s*$"
#: Marks, noncharacters of Unicode, around spans of other types and behind broken words while a paragraph is put together.
_OTHER, _BROKEN = "\ufdd0", "\ufdd1"
#: Headers and numbers that come again are broadcast up to so many.
FEW = 100_000
#: Pages are handled in stretches of so many, so that no file is one task.
STRETCH = 64

_PUNCT = " \t.,;:()[]„“”\"'‘’–—?…«»"
_PARTS = re.compile(r"[-–—‐'’/\s]+")


# ---- words


def _raw_tokens(content: Column) -> Column:
    """What stands between the blanks of a line, in lower case; its first word may be the second half of a broken one and is left out."""
    parts = F.split(F.lower(F.trim(content)), r"\s+")
    return F.slice(parts, F.lit(2), F.size(parts))


def _words_of(token: Column) -> Column:
    """The words of a token without the punctuation around them, and the token itself if it is a compound; none if it ends in a hyphen, as it may be a half."""
    sign = r"[\p{P}\p{S}&&[^@|!]]+"
    plain = F.regexp_replace(F.translate(token, "-–—‐'’/", " " * 7), rf"(?:(?<=\s)|^){sign}|{sign}(?=\s|$)", "")
    compound = F.regexp_extract_all(token, F.lit(r"\p{L}+(?:-\p{L}+)+"), F.lit(0))
    return F.when(~token.rlike(rf"[{HYPHENS}]$"), F.concat(F.split(plain, r"\s+"), compound))


def word_counts(lines: DataFrame) -> DataFrame:
    """(word, n) over all lines.

    Raw tokens are summed on the map side first; only the different ones are
    cleaned and cut.
    """
    raw = lines.select(F.explode(_raw_tokens(F.col("content"))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    words = raw.select(F.explode(_words_of(F.col("token"))).alias("word"), "n")
    return words.where(F.col("word").rlike(r"\p{L}")).groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Words:
    count: dict[str, int]
    total: int

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.count), default=0)

    def known(self, word: str) -> int:
        return self.count.get(word, 0)


def collect_words(lines: DataFrame) -> tuple[Words, list[tuple[str, int]]]:
    """(known words, a bounded sample of rare ones)."""
    counts = checkpointed(word_counts(lines))
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(KNOWN_LEAST, math.ceil(total * KNOWN_SHARE))
    known = counts.where(F.col("n") >= least)
    if known.count() > VOCABULARY:
        raise ValueError(f"more than {VOCABULARY} known words")
    rare = counts.where((F.col("n") < max(5 * least, total * RARE_SHARE)) & (F.length("word") >= 4)).orderBy(F.xxhash64("word"), "word").limit(SAMPLE)
    return Words({r.word: r.n for r in known.collect()}, total), [(r.word, r.n) for r in rare.collect()]


# ---- the editor


def _deletes(word: str, most: int = 2) -> set[str]:
    out = {word}
    for _ in range(most):
        out |= {w[:i] + w[i + 1 :] for w in out for i in range(len(w))}
    return out


def _align(noisy: str, clean: str) -> list[str] | None:
    """Action for each character of ``noisy``: "=", "" (delete) or the characters that replace it."""
    n, m = len(noisy), len(clean)
    cost = [[i + j if not i or not j else 0 for j in range(m + 1)] for i in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            cost[i][j] = min(cost[i - 1][j - 1] + (noisy[i - 1] != clean[j - 1]), cost[i - 1][j] + 1, cost[i][j - 1] + 1)
    if cost[n][m] > 2:
        return None
    actions, i, j, extra = [""] * n, n, m, ""
    while i:
        same = j and noisy[i - 1] == clean[j - 1]
        if not same and cost[i][j] == cost[i - 1][j] + 1 and (i < 2 or j < 1 or noisy[i - 2] != clean[j - 1]):
            if extra:
                actions[i - 1], extra = extra, ""
            i -= 1
        elif j and cost[i][j] == cost[i - 1][j - 1] + (noisy[i - 1] != clean[j - 1]):
            actions[i - 1] = "=" if noisy[i - 1] == clean[j - 1] and not extra else clean[j - 1] + extra
            i, j, extra = i - 1, j - 1, ""
        elif cost[i][j] == cost[i - 1][j] + 1:
            if extra:
                actions[i - 1], extra = extra, ""
            i -= 1
        else:
            extra, j = clean[j - 1] + extra, j - 1
    return None if j or extra else actions


def _around(word: str, i: int) -> list[str]:
    w = f"^^{word}$$"
    k = i + 2
    c = w[k]
    odd = any(not x.isalpha() for x in word)
    return [f"0{c}", f"1{w[k - 1]}{c}", f"2{c}{w[k + 1]}", f"3{w[k - 1]}{c}{w[k + 1]}", f"4{w[k - 2 : k + 1]}", f"5{w[k : k + 3]}", f"6{c}{odd}", f"7{w[k - 1]}_{w[k + 1]}"]


@dataclass
class Editor:
    """``choices[c]``: what a character was ever replaced by."""

    model: Perceptron
    choices: dict[str, tuple[str, ...]]

    def correct(self, word: str, words: Words) -> tuple[str, int] | None:
        """(correction, position of the first edit) of a lower-case word, None if it stays."""
        own = words.known(word)
        # two edits can't shorten a word by more than two letters
        if own > words.total / 2000 or not 2 <= len(word) <= words.longest + 2 or not any(c.isalpha() for c in word):
            return None
        edits = []
        for i, c in enumerate(word):
            options = self.choices.get(c)
            if options:
                s = self.model.scores(_around(word, i), ("=", *options))
                edits += [(s[o] - s["="], i, o) for o in options]
        edits.sort(reverse=True)
        best, most = None, -math.inf
        seldom = own < words.total * SELDOM_SHARE
        need = (SELDOM_RATIO if seldom else RATIO) * own if own else 1

        def consider(gain: float, *chosen: tuple[int, str]) -> None:
            nonlocal best, most
            out = list(word)
            for i, o in chosen:
                out[i] = o
            new = "".join(out)
            n = words.known(new)
            if n >= need and n and new != word:
                value = gain + math.log(n) / 2
                if value > most and (gain > 0 or seldom):
                    best, most = (new, min(i for i, _ in chosen)), value

        for gain, i, o in edits:
            consider(gain, (i, o))
        for a in range(len(edits)):
            for b in range(a + 1, len(edits)):
                if edits[a][1] != edits[b][1]:
                    consider(edits[a][0] + edits[b][0] - 1.0, edits[a][1:], edits[b][1:])
        return best


def fit_editor(words: Words, rare: list[tuple[str, int]]) -> Editor:
    """From rare words beside a far more frequent one; equally many known words show what to keep."""
    frequent = sorted((w for w in words.count if 3 <= len(w) <= 20), key=lambda w: (-words.count[w], w))[:8000]
    index: dict[str, list[str]] = defaultdict(list)
    for w in frequent:
        for d in _deletes(w):
            index[d].append(w)
    pairs = []
    for noisy, n in rare:
        if len(noisy) > 20:
            continue
        near = {w for d in _deletes(noisy) for w in index.get(d, ()) if w != noisy and words.count[w] >= RATIO * n}
        scored = sorted((sum(x != "=" for x in a), -words.count[w], w) for w in near if (a := _align(noisy, w)) is not None)
        # a single character, or two neighbours that were one or became one
        if scored and len(noisy) >= 4 and (len(scored) == 1 or scored[0][0] < scored[1][0] or -scored[0][1] > RATIO * -scored[1][1]):
            actions = _align(noisy, scored[0][2])
            changed = [i for i, x in enumerate(actions) if x != "="]
            if changed and changed[-1] - changed[0] < 2:
                pairs.append((noisy, actions))
    seen: Counter[tuple[str, str]] = Counter((c, x) for noisy, actions in pairs for c, x in zip(noisy, actions, strict=True) if x != "=")
    choices: dict[str, list[str]] = defaultdict(list)
    for (c, x), n in sorted(seen.items()):
        if n >= 2:
            choices[c].append(x)
    fixed = {c: tuple(o) for c, o in choices.items()}
    examples = []
    noisy = {w for w, _ in pairs}
    keep = [(w, ["="] * len(w)) for w in [w for w in frequent if w not in noisy][: 2 * len(pairs)]]
    for w, actions in pairs + keep:
        for i, x in enumerate(actions):
            options = ("=", *fixed.get(w[i], ()))
            if len(options) > 1 and x in options:
                examples.append((_around(w, i), x, options))
    return Editor(Perceptron.fit(examples), fixed)


# ---- joining lines


def _bin(n: int) -> str:
    return "0" if n <= 0 else str(min(9, int(math.log10(n) * 2) + 1))


def _split_end(content: str) -> tuple[str, str] | None:
    """(first half, hyphen) of the word that a line's end breaks."""
    line = content.rstrip()
    if len(line) < 2 or line[-1] not in HYPHENS or not line[-2].isalpha():
        return None
    return _PARTS.split(line[:-1].split()[-1])[-1].strip(_PUNCT), line[-1]


def _opening(following: str) -> str:
    first = following.split()[0] if following.split() else ""
    return _PARTS.split(first)[0].strip(_PUNCT)


def _join_features(first: str, hyphen: str, second: str, words: Words) -> list[str]:
    a, b = first.lower(), second.lower()
    joined, compound = words.known(a + b), words.known(f"{a}-{b}")
    return [
        f"h{hyphen}",
        f"j{_bin(joined)}",
        f"c{_bin(compound)}",
        f"jc{joined > compound}{joined > 0}{compound > 0}",
        f"l{second[:1].islower()}",
        f"a{_bin(words.known(a))}b{_bin(words.known(b))}",
        f"ab{words.known(a) > 0}{words.known(b) > 0}{joined > 0}",
        f"hc{hyphen}{compound > 0}",
    ]


def fit_join(ends: list[tuple[str, str]], words: Words) -> Perceptron:
    """From (line, next line) pairs in which only the joined word, or only the compound, is known."""
    examples = []
    for line, following in ends:
        half = _split_end(line)
        second = _opening(following)
        if half and half[0] and second:
            a, b = half[0].lower(), second.lower()
            joined, compound = words.known(a + b), words.known(f"{a}-{b}")
            if joined and not compound or compound and not joined:
                examples.append((_join_features(half[0], half[1], second, words), "yes" if joined else "no", ("yes", "no")))
    return Perceptron.fit(examples)


@dataclass
class Repairer:
    words: Words
    editor: Editor
    join: Perceptron

    def __post_init__(self) -> None:
        self.memo: dict[str, tuple[str, int] | None] = {}
        self.tokens: dict[str, str] = {}

    def _correct(self, word: str) -> tuple[str, int] | None:
        low = word.lower()
        if low not in self.memo:
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[low] = self.editor.correct(low, self.words)
        return self.memo[low]

    def line(self, content: str, following: str | None, broken_before: str | None) -> tuple[str, bool, bool]:
        """(repaired line, misread, broken): the line before breaks off with ``broken_before``, the next starts with ``following``.

        A line that is broken comes without its hyphen; the rest of the word follows without a blank.
        """
        half = _split_end(content) if following is not None else None
        second = _opening(following) if half else ""
        first_half = _split_end(broken_before) if broken_before else None
        own = content.split()
        tail = half[0] if half and half[0] and second else None
        broken = misread = False
        if tail:
            fix = self._correct(tail + second) if not self.words.known((tail + second).lower()) else None
            whole = tail + second if fix is None else fix[0]
            broken = self.join.margin(_join_features(whole[: len(tail)], half[1], whole[len(tail) :], self.words)) > 0
            if not self.join.weights:  # nothing to learn from
                broken = self.words.known(whole.lower()) > self.words.known(f"{tail}-{second}".lower())
            if broken and fix and fix[1] < len(tail):
                misread = True
        head = _opening(content) if first_half and first_half[0] else None
        out = []
        for k, token in enumerate(own):
            if k == len(own) - 1 and tail and broken:
                out.append(token.rstrip()[:-1])
                continue
            if k == 0 and head:
                joined = first_half[0] + head
                if self.words.known(joined.lower()):
                    out.append(token)
                    continue
                fix = self._correct(joined)
                if fix:
                    # the error may lie in the half on the line above
                    if fix[1] >= len(first_half[0]):
                        misread = True
                        rest = fix[0][len(first_half[0]) :]
                        out.append(token.replace(head, rest, 1) if rest else token)
                        continue
                    out.append(token)
                    continue
                if not self.words.known(head.lower()) and self.words.known(f"{first_half[0]}-{head}".lower()):
                    out.append(token)
                    continue
            new = self._token(token)
            misread |= new != token
            out.append(new)
        return " ".join(out), misread, broken

    def _token(self, token: str) -> str:
        new = self.tokens.get(token)
        if new is None:
            if len(self.tokens) > 200_000:
                self.tokens.clear()
            new = self.tokens[token] = self._repaired(token)
        return new

    def _repaired(self, token: str) -> str:
        parts = _PARTS.split(token)
        new = token
        for part in parts:
            for form in dict.fromkeys((part.strip(_PUNCT + "!"), part.strip(_PUNCT))):
                if len(form) < 2 or not any(c.isalpha() for c in form):
                    continue
                if form == part.strip(_PUNCT + "!") and self.words.known(form.lower()) and not self._correct(form):
                    break
                fix = self._correct(form)
                if fix:
                    better = fix[0].upper() if form.isupper() and len(form) > 1 else fix[0].capitalize() if form[0].isupper() else fix[0]
                    new = new.replace(form, better, 1)
                    break
        return new


# ---- furniture

_ROMAN = re.compile(r"[ivxlcdm]+", re.I)
_DIGIT = re.compile(r"\d")


def _shape(content: str) -> list[str]:
    s = content.strip()
    letters = any(map(str.isalpha, s))
    digits = _DIGIT.search(s) is not None
    words = s.split()
    kind = (
        "digits" if s.isdigit() else "roman" if _ROMAN.fullmatch(s) else "dash" if s[:1] in "-–—" and re.fullmatch(r"[-–—]\s*\w+\s*[-–—]", s) else "number" if not letters else "count" if digits and len(words) <= 5 and re.search(r"\d+\s*\D{1,8}\s*\d+$", s) else "upper" if s.isupper() else "title" if s.istitle() else "lower" if s[:1].islower() else "mixed"
    )
    edge = "" if not digits else "both" if re.match(r"\d+\s{2,}\D", s) or re.search(r"\D\s{2,}\d+$", s) else "tail" if re.search(r"\d+$", s) and letters else ""
    return [f"k{kind}", f"e{edge}", f"p{s[-1:] if s[-1:] in '.,;:-' else ''}", f"n{min(len(words), 8)}", f"L{min(len(s) // 10, 8)}", f"u{s[:1].isupper()}{letters}"]


def _place(y: float | None) -> str:
    return "?" if y is None else str(int(min(max(y, -1), 2000) // 12))


def _furniture_features(content: str, y: float | None, same: int, step: int) -> list[str]:
    place, shape = _place(y), _shape(content)
    r, q = _bin(same), _bin(step)
    return [f"y{place}", f"r{r}", f"q{q}", f"yr{place}{same > 1}", f"yq{place}{step > 1}", *shape, *[f"y{place}{x}" for x in shape[:3]], f"{shape[0]}{same > 1}{step > 1}", f"{shape[0]}{shape[2]}{shape[3]}", f"no{y is None}{same > 2}{step > 2}{shape[0]}"]


def marked(lines: DataFrame) -> DataFrame:
    """Lines with what may come again: their letters, and their number less that of the page."""
    s = F.trim("content")
    key = F.when(s.rlike(r"(?i)^[ivxlcdm]+$"), F.lit("#roman")).otherwise(F.trim(F.regexp_replace(F.lower(s), r"[^\p{L}]+", " ")))
    number = F.regexp_extract(s, r"(?<![\d.,])(\d{1,6})(?![\d.,]*\d)", 1).try_cast("int")
    return lines.select("*", F.xxhash64(key).alias("letters"), (number - F.col("page_idx")).alias("offset"))


def _border(frame: float) -> Column:
    return (F.col("y") < 0.06 * frame) | (F.col("y") > 0.95 * frame)


def furniture_candidates(lines: DataFrame, frame: float) -> DataFrame:
    """All lines, whatever they end in, with how often their letters come in the file, and how often of these at the border of a page, and their number in step with the pages."""
    found = (lines if "letters" in lines.columns else marked(lines)).select("doc_id", "stretch", "page_idx", "span_id", "content", "y", "letters", "offset")
    # counted on the map side, so the many page numbers or headers of one file are no hot group; only what comes again is joined back
    same = found.groupBy("doc_id", "letters").agg(F.count("*").alias("same"), F.count_if(_border(frame)).alias("edge")).where("same > 1")
    step = found.where("offset IS NOT NULL").groupBy("doc_id", "letters", "offset").agg(F.count("*").alias("step")).where("step > 1").groupBy("doc_id", "letters").agg(F.map_from_entries(F.collect_list(F.struct("offset", "step"))).alias("steps"))
    again = checkpointed(same.join(step, ["doc_id", "letters"], "left"))
    # where few enough come again the lines stay where they are
    joined = found.join(F.broadcast(again) if again.count() <= FEW else again, ["doc_id", "letters"], "left")
    own_step = F.when(F.col("offset").isNotNull(), F.coalesce(F.try_element_at("steps", F.col("offset")), F.lit(1))).otherwise(0)
    return joined.select("doc_id", "stretch", "page_idx", "span_id", "content", "y", F.coalesce("same", F.lit(1)).alias("same"), F.coalesce("edge", F.lit(0)).alias("edge"), own_step.alias("step"))


def page_height(lines: DataFrame) -> float:
    """About where the lowest lines of pages begin."""
    return lines.agg(F.percentile_approx("y", 0.99, 1000)).first()[0] or 792.0


def fit_furniture(candidates: DataFrame, frame: float) -> Perceptron:
    """Seeds: what comes again at the border of pages, against what stands between and long unique lines."""
    y = F.col("y")
    border = _border(frame)
    # the last words of a paragraph come again too, but anywhere on a page; numbers share their lack of letters with those of tables
    placed = (2 * F.col("edge") > F.col("same")) | ~F.col("content").rlike(r"\p{L}")
    again = ((F.col("same") >= 3) & placed) | (F.col("step") >= 3)
    seed = F.when(border & again & (F.length(F.trim("content")) > 0), "yes").when(y.between(0.08 * frame, 0.9 * frame) | (border & (F.col("same") == 1) & (F.col("step") <= 1) & (F.length("content") > 45)), "no")
    rows = []
    # headings of chapters read like the headers they give: they are a sample of their own
    for label, chosen in (("yes", F.lit(True)), ("no", F.lit(True)), ("no", F.col("same") > 1)):
        chosen = candidates.withColumn("seed", seed).where((F.col("seed") == label) & chosen)
        rows += chosen.orderBy(F.xxhash64("doc_id", "page_idx", "span_id"), "doc_id", "page_idx", "span_id").limit(SAMPLE).select("content", "y", "same", "step", "seed").collect()
    examples = [(_furniture_features(r.content, r.y, r.same, r.step), r.seed, ("yes", "no")) for r in rows]
    # without a box only shape and repetition tell
    examples += [(_furniture_features(r.content, None, r.same, r.step), r.seed, ("yes", "no")) for r in rows[::4]]
    return Perceptron.fit(examples)


def furniture(candidates: DataFrame, frame: float) -> DataFrame:
    """(doc_id, stretch, furniture): for each stretch that has any, a map of its pages to the span_ids of their furniture."""
    shared = candidates.sparkSession.sparkContext.broadcast(fit_furniture(candidates, frame))
    keys = ("doc_id", "stretch", "page_idx", "span_id")
    schema = T.StructType([candidates.schema[c] for c in keys])

    def rows(columns: list[list]) -> Iterator[tuple]:
        model, known = shared.value, {}
        for doc, stretch, page, span, content, y, same, step in zip(*columns, strict=True):
            # all that the features are made of
            key = (_place(y), _bin(same), _bin(step), same > 1, same > 2, step > 1, step > 2, *_shape(content))
            is_so = known.get(key)
            if is_so is None:
                is_so = known[key] = model.margin(_furniture_features(content, y, same, step)) > 0
            if is_so:
                yield doc, stretch, page, span

    found = map_rows(candidates, {c: c for c in (*keys, "content", "y", "same", "step")}, schema, rows).repartition("doc_id", "stretch")
    pages = found.groupBy("doc_id", "stretch", "page_idx").agg(F.collect_set("span_id").alias("spans"))
    return pages.groupBy("doc_id", "stretch").agg(F.map_from_entries(F.collect_list(F.struct("page_idx", "spans"))).alias("furniture"))


# ---- lines in reading order


def text_lines(spans: DataFrame) -> DataFrame:
    """(doc_id, stretch, page_idx, span_id, content, y) of the text spans that hold any text, without specks at their ends."""
    content = F.regexp_replace("content", SPECKS, "")
    text = spans.where((F.col("type") == "text") & content.rlike(r"\S") & F.col("doc_id").isNotNull() & F.col("page_idx").isNotNull() & F.col("span_id").isNotNull())
    return text.select("doc_id", F.floor(F.col("page_idx") / STRETCH).alias("stretch"), "page_idx", "span_id", content.alias("content"), F.least("bbox.y0", "bbox.y1").alias("y"))


def other_lines(spans: DataFrame) -> DataFrame:
    """Spans of other types than text that hold anything, unedited and without defects, in the columns of ``repaired_lines``."""
    other = spans.where(~F.col("type").eqNullSafe("text") & F.col("content").rlike(r"\S") & F.col("doc_id").isNotNull() & F.col("page_idx").isNotNull() & F.col("span_id").isNotNull())
    kept = other.select("doc_id", "page_idx", "span_id", F.coalesce("type", F.lit("")).alias("type"), "content").distinct()
    return kept.select("*", F.col("content").alias("repaired"), *[F.lit(False).alias(c) for c in ("furniture", "hyphen", "misread")])


def body_and_furniture(spans: DataFrame) -> DataFrame:
    """The lines of ``repaired_lines``, and the spans of other types that stand among them."""
    return repaired_lines(spans).unionByName(other_lines(spans))


def with_neighbours(body: DataFrame) -> DataFrame:
    """Each body line with the body lines before and after it in its file.

    Neighbours are found within stretches of pages; only the first and last
    line of each stretch go into the window over the file, so that a file of
    any length is handled in many tasks.
    """
    order = ["page_idx", "span_id", "content"]
    w = Window.partitionBy("doc_id", "stretch").orderBy(*order)
    columns = body.columns
    if "stretch" not in columns:
        body = body.withColumn("stretch", F.floor(F.col("page_idx") / STRETCH))
    inside = body.select("*", F.lead("content").over(w).alias("_next"), F.lag("content").over(w).alias("_before"))
    ends = body.groupBy("doc_id", "stretch").agg(F.min(F.struct(*order)).alias("first"), F.max(F.struct(*order)).alias("last"))
    f = Window.partitionBy("doc_id").orderBy("stretch")
    ends = ends.select("doc_id", "stretch", F.lead("first.content").over(f).alias("_after_stretch"), F.lag("last.content").over(f).alias("_before_stretch"))
    joined = inside.join(ends, ["doc_id", "stretch"])
    return joined.select(*columns, F.coalesce("_next", "_after_stretch").alias("next"), F.coalesce("_before", "_before_stretch").alias("before"))


def repaired_lines(spans: DataFrame) -> DataFrame:
    """(doc_id, page_idx, span_id, type, content, repaired, furniture, hyphen, misread), a row for each line with text."""
    spark: SparkSession = spans.sparkSession
    # the one shuffle of all lines: what follows by file and stretch stays where it puts them
    own = ["doc_id", "stretch", "page_idx", "span_id", "content"]
    lines = checkpointed(marked(text_lines(spans).repartition("doc_id", "stretch").groupBy(*own).agg(F.min("y").alias("y"))))
    words, rare = collect_words(lines)
    frame = page_height(lines)
    on_page = checkpointed(furniture(checkpointed(furniture_candidates(lines, frame)), frame))
    flagged = lines.join(on_page, ["doc_id", "stretch"], "left").withColumn("is_furniture", F.coalesce(F.array_contains(F.try_element_at("furniture", F.col("page_idx")), F.col("span_id")), F.lit(False)))
    flagged = flagged.select(*own, "is_furniture")
    own = flagged.where(~F.col("is_furniture")).drop("is_furniture")
    body = with_neighbours(own)
    ends = _line_ends(own)
    model = Repairer(words, fit_editor(words, rare), fit_join([(r.content, r.next) for r in ends], words))
    fixed = _repair(body, spark.sparkContext.broadcast(model))
    rest = flagged.where("is_furniture").select("doc_id", "page_idx", "span_id", "content", F.lit(None).cast("string").alias("repaired"), F.lit(True).alias("furniture"), F.lit(False).alias("hyphen"), F.lit(False).alias("misread"))
    return fixed.unionByName(rest).withColumn("type", F.lit("text"))


def _line_ends(body: DataFrame) -> list:
    """A bounded sample of (line, next line of its page) where the first ends in a hyphen.

    Only lines of pages chosen by their hash, about four times as many as the
    sample needs, are put in order for it.
    """
    hyphen_end = F.col("content").rlike(rf"\p{{L}}[{HYPHENS}]\s*$")
    found = body.where(hyphen_end).count()
    one_in = max(1, found // (4 * SAMPLE))
    pages = body.where(F.pmod(F.xxhash64("doc_id", "page_idx"), F.lit(one_in)) == 0)
    w = Window.partitionBy("doc_id", "page_idx").orderBy("span_id", "content")
    ends = pages.withColumn("next", F.lead("content").over(w)).where(hyphen_end & F.col("next").isNotNull())
    return ends.select("content", "next", F.xxhash64("content", "next").alias("h")).orderBy("h", "content").limit(SAMPLE).collect()


def _repair(body: DataFrame, model: Broadcast) -> DataFrame:
    keys = ["doc_id", "page_idx", "span_id", "content"]
    schema = T.StructType([body.schema[c] for c in keys] + [T.StructField("repaired", T.StringType())] + [T.StructField(c, T.BooleanType()) for c in ("furniture", "hyphen", "misread")])

    def rows(columns: list[list]) -> Iterator[tuple]:
        repairer = local(model, lambda m: m)
        for doc, page, span, content, following, before in zip(*columns, strict=True):
            text, misread, broken = repairer.line(content, following, before)
            yield doc, page, span, content, text, False, broken, misread

    # a neighbour matters only where a hyphen lies between
    end = rf"\p{{L}}[{HYPHENS}]\s*$"
    following = F.when(F.col("content").rlike(end), F.regexp_extract("next", r"^\s*(\S+)", 1))
    before = F.when(F.col("before").rlike(end), F.regexp_extract("before", r"(\S+)\s*$", 1))
    return map_rows(body, {**{c: c for c in keys}, "following": following, "before": before}, schema, rows)


def paragraphs(lines: DataFrame) -> DataFrame:
    """(doc_id, page_idx, span_id of the first line, n_lines, text) of the continuous paragraphs of each file.

    A paragraph ends with a line that closes a sentence clearly short of the
    usual width of its page, or before or after a heading (a line without
    closing punctuation that the next one doesn't go on from); furniture is
    left out, broken words are joined. A paragraph may run over any number of
    pages: paragraphs are put together within stretches of pages, and one row
    per stretch goes into a window over the file, which tells whether the first
    paragraph of a stretch goes on from the one before. Spans of other types
    than text neither start nor end a paragraph; one between the halves of a
    broken word follows the whole word.
    """
    body = lines.where(~F.col("furniture") & F.col("repaired").rlike(r"\S")).withColumn("stretch", F.floor(F.col("page_idx") / STRETCH))
    page = Window.partitionBy("doc_id", "stretch", "page_idx")
    order = Window.partitionBy("doc_id", "stretch").orderBy("page_idx", "span_id", "content")
    is_text = F.col("type") == "text"
    wide = F.max(F.when(is_text, F.length("content"))).over(page)
    short = F.length("content") < 0.8 * wide
    closed = F.col("repaired").rlike(r"[.!?…][\"”’»)]*\s*$")
    heading = short & ~F.col("hyphen") & ~F.col("repaired").rlike(r"[.,;:!?…\"”’»)-]\s*$") & F.col("repaired").rlike(r"^[\p{Lu}\d]")
    state = F.when(is_text, F.struct((short & (closed | heading)).alias("ends"), heading.alias("heading"), closed.alias("closed")))
    marked = body.select("*", state.alias("_s"))
    before = F.last("_s", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    # whether the first line of a stretch is a start isn't known here
    starts = is_text & (before["ends"] | (F.col("_s.heading") & before["closed"]))
    numbered = marked.select("*", F.sum(F.when(starts, 1).otherwise(0)).over(order).alias("_p"))
    piece = F.struct("page_idx", "span_id", "content", "repaired", "hyphen", "_s")
    grouped = numbered.groupBy("doc_id", "stretch", "_p").agg(F.array_sort(F.collect_list(piece)).alias("l"))
    text = F.aggregate("l", F.lit(""), lambda acc, x: F.concat(acc, F.when(x["_s"].isNull(), F.concat(F.lit(_OTHER), x["repaired"], F.lit(_OTHER + " "))).otherwise(F.concat(x["repaired"], F.when(x["hyphen"], _BROKEN).otherwise(" ")))))
    states = F.filter("l._s", lambda s: s.isNotNull())
    # used twice, and the repair below it is dear
    parts = checkpointed(grouped.select("doc_id", "stretch", "_p", F.element_at("l", 1).alias("_first"), F.try_element_at(states, F.lit(1)).alias("_opening"), F.try_element_at(states, F.lit(-1)).alias("_closing"), F.size("l").alias("n_lines"), text.alias("text")))
    f = Window.partitionBy("doc_id").orderBy("stretch")
    ends = parts.groupBy("doc_id", "stretch").agg(F.min_by("_opening", "_p").alias("opening"), F.max_by("_closing", "_p").alias("closing"), F.max("_p").alias("n"))
    before = F.last("closing", ignorenulls=True).over(f.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("opening").isNotNull() & (before["ends"] | (F.col("opening.heading") & before["closed"])), 1).otherwise(0)
    base = ends.select("doc_id", "stretch", "n", opens.alias("opens")).select("doc_id", "stretch", (F.sum(F.col("opens") + F.col("n")).over(f) - F.col("n")).alias("base"))
    own = F.struct("_first.page_idx", "_first.span_id", "stretch", "n_lines", "text")
    whole = parts.join(base, ["doc_id", "stretch"]).groupBy("doc_id", (F.col("base") + F.col("_p")).alias("_p")).agg(F.array_sort(F.collect_list(own)).alias("l"))
    joined = F.regexp_replace(F.concat_ws("", F.col("l.text")), rf"{_BROKEN}((?:{_OTHER}[^{_OTHER}]*{_OTHER} )+)([^\s{_BROKEN}{_OTHER}]+ ?)", "$2$1")
    clean = F.trim(F.translate(joined, _BROKEN + _OTHER, ""))
    return whole.select("doc_id", F.col("l")[0]["page_idx"].alias("page_idx"), F.col("l")[0]["span_id"].alias("span_id"), F.aggregate("l.n_lines", F.lit(0), lambda acc, n: acc + n).alias("n_lines"), clean.alias("text"))

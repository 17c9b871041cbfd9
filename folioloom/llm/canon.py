"""One consistent form for text that looks the same (problem 4).

Most text is already in the form wanted, and a *quick check* tells so: each
character that can change, alone or with its neighbours, is listed once from
the Unicode properties (no composed form, a compatibility form of typeface or
width, invisible, a blank or hyphen of another kind, a look-alike letter). Only
the stretches of non-blank characters around such a character are normalised -
no composition and no look-alike reaches over a blank, so a stretch with its
borders is context enough - and the results are spliced into the unchanged
rest.

What counts as the same: typeface and width, ligatures, radicals, composed and
decomposed accents, kinds of blanks, invisible characters, shapes of hyphens
and apostrophes, letters of another script that look alike. What stays
different: case, accents, raised and lowered digits, fractions, spelling.

Defined results: null stays null, an empty text stays empty.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.llm.arrow import map_rows

# Letters of Cyrillic and Greek that look like Latin ones.
CYRILLIC = "аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅҺԌԚԜ"
AS_CYRILLIC = "aeopcyxijshdqwABEKMHOPCTYXIJSHGQW"
GREEK = "ονΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"
AS_GREEK = "ovABEZHIKMNOPTYX"

# Letters that look like Latin ones but mean something by themselves (Greek signs), or stand in scripts
# that are rarer than their misuse. They only count as Latin in words that hold a Latin letter.
WEAK = "αρικυϲϳӏӀɡɑոսհօցՍՏՕԼᎠᎡᎢᎥᎩᎪᎫᎬᎳᎷᎻᏀᏃᏏᏒᏔᏙᏚᏞᏟᏢᏦᏧⲞⲟⲢⲣⲤⲥⲦⲬⲒⲔⲘⲚⲎꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ"
AS_WEAK = "apikucjlIganuhogUSOLDRTiYAJEWMHGZbRWVSLCPKdOoPpCcTXIKMNHBPDTGKJCZFMNLSRVHWXYAEIOU"
_WEAK = dict(zip(map(ord, WEAK), AS_WEAK, strict=True))
_HAS_WEAK = re.compile(f"[{WEAK}]")
_HAS_LATIN = re.compile("[A-Za-z]")

_LOOK_ALIKE = re.compile(f"[{CYRILLIC}{GREEK}{WEAK}]")

# Radicals without a compatibility form, and the same character as an ideograph.
RADICALS = "⺁⺂⺃⺅⺆⺈⺉⺊⺌⺍⺎⺏⺐⺒⺓⺔⺖⺘⺙⺛⺜⺝⺞⺠⺡⺢⺣⺥⺦⺨⺩⺫⺬⺭⺮⺯⺰⺱⺲⺶⺹⺺⺻⺽⺾⺿⻀⻁⻂⻃⻄⻅⻆⻈⻉⻊⻋⻌⻍⻎⻏⻐⻑⻒⻓⻔⻖⻗⻘⻙⻚⻛⻜⻝⻟⻠⻢⻣⻤⻥⻦⻧⻨⻩⻪⻫⻬⻭⻮⻯⻰⻱⻲"
IDEOGRAPHS = "厂乛乚亻冂刀刂卜小小尢尣尢巳幺彑忄扌攵旡日月歹民氵氺灬爫丬犭王目示礻竹糹纟罓罒羊耂肀聿臼艹艹艹虎衤覀西见角讠贝足车辶辶辶阝钅長镸长门阝雨青韦页风飞食飠饣马骨鬼鱼鸟卤麦黄黾斉齐歯齿竜龙龜亀"

HYPHENS = "‐‑⁃﹣－"
#: Dashes that a heading's hyphen is also printed as; in running text they keep their meaning.
DASHES = "‒–—−˗➖"
APOSTROPHES = "’‘ʼʹ′‛＇`´ˈ"
#: Kinds of compatibility forms that only tell typeface, width or joining.
_SAME = ("<font>", "<wide>", "<narrow>", "<compat>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>", "<vertical>", "<small>")
#: Where joiners carry meaning: Arabic to Indic scripts and emoji.
_JOINING = re.compile("[؀-෿က-႟ក-៿☀-➿️\U0001f000-\U0001faff]")
_ZERO_WIDTH_JOINERS = "‌‍"


def _invisible(c: str) -> bool:
    return unicodedata.category(c) == "Cf" or c in "͏ᅟᅠ឴឵ㅤﾠ" or "︀" <= c <= "︎" or "᠋" <= c <= "᠏" or "\U000e0100" <= c <= "\U000e01ef"


@lru_cache(maxsize=1)
def tables() -> tuple[dict[int, str], re.Pattern, frozenset[str], dict[str, str], dict[str, str]]:
    """(character map, quick check, the characters it looks for, look-alike -> Latin, Latin -> Cyrillic)."""
    change: dict[int, str] = {}
    unstable: list[str] = []
    seconds = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}  # what composes with the character before it
    for code in (*range(0x80, 0xD800), *range(0xE000, 0x20000), *range(0x2F800, 0x2FA20), *range(0xE0000, 0xE01F0)):
        c = chr(code)
        kind = unicodedata.category(c)
        if kind in ("Cn", "Co", "Cs"):
            continue
        to = None
        if _invisible(c):
            to = ""
        elif kind == "Zs":
            to = " "
        elif c in HYPHENS:
            to = "-"
        else:
            form = unicodedata.decomposition(c)
            if form and form[0] != "<" and " " in form:
                seconds.add(chr(int(form.split()[1], 16)))
            sign = 0x2100 <= code < 0x2150 and not form.startswith("<font>")  # a sign of its own, such as that for "number"
            if form.startswith(_SAME) and not sign and not unicodedata.normalize("NFKC", c).startswith(" "):
                to = unicodedata.normalize("NFKC", c)
        if to is not None and to != c:
            change[code] = to
        if to is not None or not unicodedata.is_normalized("NFC", c) or unicodedata.combining(c) or kind == "Mn":
            unstable.append(c)
    for a, b in zip(RADICALS, IDEOGRAPHS, strict=True):
        change[ord(a)] = b
        unstable.append(a)
    for c in APOSTROPHES:
        if c not in "`´":
            change[ord(c)] = "'"
            unstable.append(c)
    latin = dict(zip(CYRILLIC + GREEK, AS_CYRILLIC + AS_GREEK, strict=True))
    unstable += [*latin, *WEAK, *seconds]
    cyrillic = {b: a for a, b in zip(CYRILLIC, AS_CYRILLIC, strict=True) if a in "аеорсухАВЕКМНОРСТУХ"}
    codes = sorted({ord(c) for c in unstable})
    return change, _one_of(codes), frozenset(map(chr, codes)), latin, cyrillic


def _one_of(codes: list[int]) -> re.Pattern:
    spans, start = [], codes[0]
    for a, b in zip(codes, [*codes[1:], None], strict=True):
        if b != a + 1:
            spans.append(f"\\U{start:08x}-\\U{a:08x}")
            start = b
    return re.compile(f"[{''.join(spans)}]")


@lru_cache(maxsize=1)
def _first_plane() -> re.Pattern:
    """The quick check for texts of the first plane; without the ranges beyond it, it takes a fraction of the time."""
    return _one_of(sorted(ord(c) for c in tables()[2] if c <= "\uffff"))


def _script(c: str) -> str:
    if c < "Ͱ":
        return "L" if c.isalpha() else ""
    return "G" if c < "Ѐ" or "ἀ" <= c <= "῿" else "C" if c < "԰" else ""


def _one_script(word: str, context: Callable[[], str]) -> str:
    """Look-alikes of a decomposed stretch, brought into the script of its unambiguous letters.

    A stretch without any takes the script of the text around it; where that
    tells nothing either, a pure one stays and a mixed one becomes Latin.
    """
    *_, latin, cyrillic = tables()
    if _HAS_WEAK.search(word) and _HAS_LATIN.search(word):
        word = word.translate(_WEAK)
    scripts = {_script(c) for c in word} - {""}
    if scripts <= {"L"}:
        return word
    sure = {_script(c) for c in word if c not in latin and c not in cyrillic} - {""}
    if not sure:
        around = context()
        sure = {around} if around else scripts if len(scripts) == 1 else {"L"}
    if sure == {"C"}:
        return "".join(cyrillic.get(c, c) for c in word)
    if sure == {"L"}:
        return "".join(latin.get(c, c) for c in word)
    return word


_WORDS = re.compile(r"[^\W\d_]+(?:[̀-ͯ]+[^\W\d_]*)*")


def canonical(text: str | None) -> str | None:
    """The consistent form of a text; text that is in it already comes back as the same object."""
    if text is None or text.isascii():
        return text
    change, quick, unstable, latin, _ = tables()
    if unstable.isdisjoint(text):
        return text
    context: list[str] = []

    def around() -> str:
        # the script of the letters that can't be mistaken, for words that hold none
        if not context:
            sure = {_script(c) for c in text if c not in latin and not c.isascii()} & {"C", "G"}
            plain = any(c.isalpha() and c not in latin and c not in AS_CYRILLIC and _script(c) in ("L", "") for c in text)
            context.append("C" if sure == {"C"} and not plain else "L" if plain and not sure else "")
        return context[0]

    def fix(s: str) -> str:
        if _CYRILLIC_WORD.fullmatch(s):
            return s
        for joiner in _ZERO_WIDTH_JOINERS:
            if joiner in s and _JOINING.search(s):
                s = re.sub(f"(?<={_JOINING.pattern}){joiner}(?={_JOINING.pattern})", chr(0xF0000 + ord(joiner)), s)
        emoji = "️" in s and bool(_JOINING.search(s))
        s = unicodedata.normalize("NFD", s.translate(change if not emoji else {k: v for k, v in change.items() if k != 0xFE0F}))
        if _LOOK_ALIKE.search(s):
            s = _WORDS.sub(lambda w: _one_script(w.group(), around), s)
        s = unicodedata.normalize("NFC", s)
        return s.replace(chr(0xF0000 + 0x200C), "‌").replace(chr(0xF0000 + 0x200D), "‍")

    out, last = [], 0
    if len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text):
        quick = _first_plane()
    while m := quick.search(text, last):
        a = max(last, 1 + max(text.rfind(blank, last, m.start()) for blank in _BLANKS))
        after = _BLANK.search(text, m.end())
        b = after.start() if after else len(text)
        out += [text[last:a], fix(text[a:b])]
        last = b
    return "".join([*out, text[last:]])


#: What ends a stretch; other blanks are part of what changes.
_BLANKS = " \t\r\n"
_BLANK = re.compile(r"[ \t\r\n]")
#: Plain words of one script with a letter that no other has: nothing in them changes.
_CYRILLIC_WORD = re.compile("[«(„]?[а-яёА-ЯЁ]*[бвгджзийклмнптфцчшщъыьэюяБГДЖЗИЙЛПФЦЧШЩЪЫЬЭЮЯёЁ][а-яёА-ЯЁ]*[-.,;:!?»)]*")

_RARE_WORD = re.compile(rf"(?<!\w)[{''.join(c for c in WEAK if c >= 'Ա')}]{{2,}}(?!\w)")
_KEY = str.maketrans({**{c: "-" for c in DASHES}, **{c: "'" for c in APOSTROPHES}, "\t": " ", "\n": " ", "\r": " "})


def key(text: str | None) -> str | None:
    """What two headings share if they read the same: also dashes as hyphens, no blanks at the ends, words of look-alikes only as Latin."""
    c = canonical(text)
    if c is None:
        return None
    c = c.translate(_KEY).strip()
    if c.isascii() or not _LOOK_ALIKE.search(c):
        return c
    *_, latin, _ = tables()
    c = unicodedata.normalize("NFD", c)
    c = _WORDS.sub(lambda m: "".join(latin[x] for x in m.group()) if all(x in latin for x in m.group()) else m.group(), c)
    # words of the rarer scripts that hold nothing but look-alikes; Greek signs stay
    c = _RARE_WORD.sub(lambda m: m.group().translate(_WEAK), c)
    return unicodedata.normalize("NFC", c)


def canonical_texts(texts: DataFrame, keep: list[str], text_col: str = "content") -> DataFrame:
    """The kept columns, ``canonical`` and ``changed`` (false for null); one row per input row."""
    schema = T.StructType([texts.schema[c] for c in keep] + [T.StructField("canonical", T.StringType()), T.StructField("changed", T.BooleanType())])

    def rows(columns: list[list]) -> Iterator[tuple]:
        for *kept, text in zip(*columns, strict=True):
            c = canonical(text)
            yield *kept, c, c != text

    return map_rows(texts, {**{c: c for c in keep}, "\x00text": text_col}, schema, rows)


def keyed(texts: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """The kept columns and ``key``; rows without a readable character are left out."""
    schema = T.StructType([texts.schema[c] for c in keep] + [T.StructField("key", T.StringType())])

    def rows(columns: list[list]) -> Iterator[tuple]:
        for *kept, text in zip(*columns, strict=True):
            k = key(text)
            if k:
                yield *kept, k

    return map_rows(texts.where(F.col(text_col).isNotNull()), {**{c: c for c in keep}, "\x00text": text_col}, schema, rows)


def same_reading(texts: DataFrame, terms: DataFrame, id_col: str = "block_id", text_col: str = "content", term_id: str = "term_id", term_col: str = "term") -> DataFrame:
    """(id, term id) of texts that read as a term but are written otherwise.

    Terms with the same reading all match. The side with the terms is small
    and broadcast by its measured size, else the keys are shuffled.
    """
    a = keyed(texts.select(id_col, F.col(text_col).alias("_text")), [id_col, "_text"], "_text")
    b = keyed(terms.select(term_id, F.col(term_col).alias("_term")), [term_id, "_term"], "_term")
    return a.join(b, "key").where(F.col("_text") != F.col("_term")).select(id_col, term_id).distinct()

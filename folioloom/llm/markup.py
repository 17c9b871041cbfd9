"""Clean text out of HTML, Markdown, wiki and LaTeX markup (problem 6).

Whole pages first lose what isn't content: each container of a page is scored
by its own text against its links, the scores of generalised tag-class paths
are summed per host in Spark, and the path that wins the vote of its host says
which part of each of its pages is extracted again. Fragments, which hold
nothing but content, are converted whole.

Conversion recognises constructs, not signs: an HTML tag must be one of the
language, a command one of LaTeX's or followed by its argument, a formula must
look like one, a bullet is no list. What is recognised is replaced by plain
structure: headings keep "#", list items "-", table rows their cells between
"|", code and formulas their wording. Everything else stays as it is.

Defined results: null gives null, empty text stays empty, text without markup
comes back unchanged.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.llm.arrow import map_rows

# Element names of HTML by what they mean for text.
_BLOCK = set("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form header hgroup html legend main nav p section summary template".split())
_INLINE = set("a abbr acronym b bdi bdo big cite data del dfn em eq font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr code hyperlink".split())
_VOID = set("area base br col embed frame hr img input keygen link meta param source track".split())
_TABLE = set("table thead tbody tfoot tr td th caption colgroup".split())
_LIST = set("ul ol li menu dir".split())
_HEAD = {f"h{i}": i for i in range(1, 7)}
_SKIP = set("script style head title noscript iframe object svg math canvas audio video map select option button textarea".split())
_CODE = {"pre", "listing", "xmp", "plaintext"}
TAGS = _BLOCK | _INLINE | _VOID | _TABLE | _LIST | set(_HEAD) | _SKIP | _CODE

# Commands of LaTeX that stand without an argument, and what is left of those with one.
_BARE = "item hline toprule midrule bottomrule newpage clearpage pagebreak noindent maketitle tableofcontents centering par newline linebreak medskip bigskip smallskip hfill vfill ldots dots quad qquad appendix".split()
# Commands that are a sign, and the sign.
_SIGNS = dict(zip("alpha beta gamma delta lambda mu pi sigma omega sum prod int infty cdot times leq geq neq pm approx".split(), "αβγδλμπσω∑∏∫∞·×≤≥≠±≈", strict=True))
_HEADINGS = {"part": 1, "chapter": 1, "section": 1, "subsection": 2, "subsubsection": 3, "paragraph": 4, "subparagraph": 5}
_KEEP_ARGUMENT = "textbf textit texttt textsc textrm textsf textsl textup textmd emph underline uline mbox text title author caption mathrm mathbf sout footnotesize textsuperscript textsubscript enquote".split()
_DROP = "cite citep citet parencite autocite ref eqref autoref cref pageref label footnote footnotemark thanks vspace hspace bibliographystyle bibliography includegraphics usepackage documentclass index input include nocite".split()
_MATH_ENV = "equation align gather multline eqnarray displaymath math alignat flalign".split()
_VERBATIM_ENV = "verbatim lstlisting minted Verbatim alltt".split()
_LIST_ENV = "itemize enumerate description".split()
_TABLE_ENV = "tabular tabularx longtable array tabulary".split()

_TAG = re.compile(r"</?([A-Za-z][A-Za-z0-9]*)(?=[\s/>])(?:[^<>\"']|\"[^\"]*\"|'[^']*')*/?>")
_COMMENT = re.compile(r"<!--.*?-->|<!DOCTYPE[^>]*>|<\?xml[^>]*\?>|<!\[CDATA\[.*?\]\]>", re.S | re.I)
_ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|([A-Za-z][A-Za-z0-9]{1,31}));")
_ESCAPED = re.compile(r"&(?:amp;)?lt;/?([A-Za-z][A-Za-z0-9]*)\b[^<>]*?&(?:amp;)?gt;|&(?:amp;)?lt;!--.*?--&(?:amp;)?gt;", re.S)
_ANY = re.compile(r"[<>&*_`#~|\\${}\[\]=^]")
_ANY_LINE = re.compile(r"[ ]{0,3}[-+] |-{3,}[ ]*$", re.M)
_ANY_NEXT_LINE = re.compile(rf"\n(?:{_ANY_LINE.pattern})", re.M)


def _any(text: str) -> bool:
    """Whether a text holds a sign of markup; most hold none."""
    return bool(_ANY.search(text) or "''" in text or _ANY_LINE.match(text) or _ANY_NEXT_LINE.search(text))


def _is_tag(m: re.Match) -> bool:
    return m.group(1).lower() in TAGS


@dataclass
class _Work:
    """A text on its way: protected pieces are held aside under private characters."""

    text: str
    kinds: list[str] = field(default_factory=list)
    held: list[str] = field(default_factory=list)

    def hold(self, piece: str) -> str:
        self.held.append(piece)
        return f"\U000f0000{len(self.held) - 1}\U000f0001"

    def sub(self, kind: str, pattern: re.Pattern, to, count: int = 0) -> None:
        """Replace and note the kind where something was recognised; ``to`` may return None to leave a match alone."""
        seen = False

        def one(m: re.Match) -> str:
            nonlocal seen
            new = m.expand(to) if isinstance(to, str) else to(m)
            if new is None:
                return m.group()
            seen = True
            return new

        self.text = pattern.sub(one, self.text, count)
        if seen:
            self.kinds.append(kind)

    def release(self) -> str:
        for _ in range(5):  # held pieces may hold others
            if "\U000f0000" not in self.text:
                break
            self.text = re.sub("\U000f0000(\\d+)\U000f0001", lambda m: self.held[int(m.group(1))] if int(m.group(1)) < len(self.held) else "", self.text)
        return self.text


def _row(cells: list[str]) -> str:
    return "| " + " | ".join(" ".join(c.split()) for c in cells) + " |"


class _Html(HTMLParser):
    """HTML to text with plain structure."""

    def __init__(self, work: _Work):
        super().__init__(convert_charrefs=True)
        self.work, self.out, self.stack = work, [], []
        self.skip = self.pre = 0
        self.rows: list[list[str]] = []
        self.cell: list[str] | None = None
        self.lists: list[list] = []

    def put(self, text: str) -> None:
        (self.cell if self.cell is not None else self.out).append(text)

    def brk(self, n: int = 1) -> None:
        self.put(" " if self.cell is not None else "\n" * n)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _SKIP:
            self.skip += tag not in ("head",) and tag in ("script", "style", "title", "noscript", "iframe", "object", "svg", "canvas", "audio", "video", "map", "select", "textarea")
        elif tag in _HEAD:
            self.brk(2)
            self.put("#" * _HEAD[tag] + " ")
        elif tag in _CODE:
            self.pre += 1
            self.brk()
        elif tag == "table":
            self.brk()
        elif tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            self._end_cell()
            self.cell = []
        elif tag in ("ul", "ol", "menu", "dir"):
            self.lists.append([tag, 0])
            self.brk()
        elif tag == "li":
            depth = max(1, len(self.lists))
            self.brk()
            if self.lists and self.lists[-1][0] == "ol":
                self.lists[-1][1] += 1
                self.put("  " * (depth - 1) + f"{self.lists[-1][1]}. ")
            else:
                self.put("  " * (depth - 1) + "- ")
        elif tag == "br":
            self.brk()
        elif tag == "hr":
            self.brk(2)
        elif tag == "img":
            self.put(dict(attrs).get("alt") or "")
        elif tag in ("sub", "sup"):
            self.put("_" if tag == "sub" else "^")
        elif tag in _BLOCK or tag == "caption":
            self.brk(2 if tag == "p" else 1)

    def handle_endtag(self, tag: str) -> None:
        if tag in _SKIP:
            self.skip = max(0, self.skip - (tag in ("script", "style", "title", "noscript", "iframe", "object", "svg", "canvas", "audio", "video", "map", "select", "textarea")))
        elif tag in ("td", "th"):
            self._end_cell()
        elif tag == "tr":
            self._end_row()
        elif tag == "table":
            self._end_row()
            self.brk()
        elif tag in _CODE:
            self.pre = max(0, self.pre - 1)
            self.brk()
        elif tag in ("ul", "ol", "menu", "dir"):
            if self.lists:
                self.lists.pop()
            self.brk()
        elif tag in _HEAD or tag == "p":
            self.brk(2)
        elif tag in _BLOCK or tag == "caption":
            self.brk()

    def _end_cell(self) -> None:
        if self.cell is not None:
            text, self.cell = "".join(self.cell), None
            if not self.rows:
                self.rows.append([])
            self.rows[-1].append(text)

    def _end_row(self) -> None:
        self._end_cell()
        for cells in self.rows:
            if cells:
                self.out.append("\n" + _row(cells) + "\n")
        self.rows = []

    def handle_data(self, data: str) -> None:
        if self.skip:
            return
        if self.pre:
            self.put(self.work.hold(data))
        elif self.rows and self.cell is None and not data.strip():
            return
        else:
            self.put(re.sub(r"[ \t\f\v]+", " ", data))

    def result(self) -> str:
        self.close()
        self._end_row()
        return "".join(self.out)


def _html(w: _Work) -> None:
    if _ESCAPED.search(w.text):
        known = [m for m in _ESCAPED.finditer(w.text) if not m.group(1) or m.group(1).lower() in TAGS]
        if known:
            w.text = entities.unescape(entities.unescape(w.text) if "&amp;lt;" in w.text else w.text)
            w.kinds.append("escaped html")
    w.sub("html comment", _COMMENT, lambda m: m.group()[9:-3] if m.group().startswith("<![CDATA[") else "")
    if any(_is_tag(m) for m in _TAG.finditer(w.text)):
        w.kinds.append("html")
        # signs that open no known tag are text
        safe = []
        last = 0
        for m in _TAG.finditer(w.text):
            if _is_tag(m):
                safe += [w.text[last : m.start()].replace("<", "&lt;"), m.group()]
                last = m.end()
        safe.append(w.text[last:].replace("<", "&lt;"))
        parser = _Html(w)
        parser.feed("".join(safe))
        w.text = parser.result()
    else:
        w.sub("entity", _ENTITY, lambda m: entities.unescape(m.group()) if not m.group(1) or m.group() != entities.unescape(m.group()) else None)


_ARGUMENT = r"\{((?:[^{}]|\{(?:[^{}]|\{[^{}]*\})*\})*)\}"
_OPTION = r"(?:\[[^\]\n]*\])?"
_FORMULA = re.compile(r"(?<![\\$\w])\$(?!\s)((?:[^$\n\\]|\\.)+?)(?<!\s)\$(?![\d\w$])")
_MATHISH = re.compile(r"[\\^_{}=]|^[A-Za-z]'?$|^[A-Za-z0-9+\-*/() ]*[+*/<>][A-Za-z0-9+\-*/() ]*$")


def _environment(names: list[str]) -> re.Pattern:
    return re.compile(r"\\begin\{(" + "|".join(names) + r")\*?\}" + _OPTION + r"(.*?)\\end\{\1\*?\}", re.S)


_VERBATIM, _MATHS, _LISTS = _environment(_VERBATIM_ENV), _environment(_MATH_ENV), _environment(_LIST_ENV)
_TABLES = re.compile(r"\\begin\{(" + "|".join(_TABLE_ENV) + r")\*?\}" + _OPTION + r"(?:\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\})?(.*?)\\end\{\1\*?\}", re.S)
_RULES = re.compile(r"\\(?:hline|toprule|midrule|bottomrule)\b|\\cline\{[^}]*\}")
_BEGIN_END = re.compile(r"\\(?:begin|end)\{[A-Za-z]+\*?\}" + _OPTION)
_HEADING_COMMAND = re.compile(r"[ \t]*\\(" + "|".join(_HEADINGS) + r")\*?" + _OPTION + _ARGUMENT + r"[ \t]*\n?")
_KEPT = re.compile(r"\\(?:" + "|".join(_KEEP_ARGUMENT) + r")" + _OPTION + _ARGUMENT)
_DROPPED = re.compile(r"[ ~]?\\(?:" + "|".join(_DROP) + r")\*?(?:\[[^\]\n]*\])*" + _ARGUMENT)
_HREF = re.compile(r"\\href" + _ARGUMENT + _ARGUMENT + r"|\\url" + _ARGUMENT)
_OTHER_COMMAND = re.compile(r"(?<![A-Za-z:\\])\\[A-Za-z]{2,}\*?" + _OPTION + _ARGUMENT)
_BARE_COMMAND = re.compile(r"(?<![\w:\\])\\(?:" + "|".join(_BARE) + r")\b(?!\\)[ ]?")
_SIGN_COMMAND = re.compile(r"(?<![\w:\\])\\(" + "|".join(_SIGNS) + r")\b(?!\\)")
_LATEX_ESCAPE = re.compile(r"\\([%&$#_{}])")


def _maths(w: _Work) -> None:
    w.sub("latex", _VERBATIM, lambda m: w.hold(m.group(2).strip("\n")))
    w.sub("latex formula", _MATHS, lambda m: w.hold("$$" + m.group(2).strip() + "$$"))
    w.sub("latex formula", re.compile(r"(?<!\\)\$\$(.+?)\$\$", re.S), lambda m: w.hold("$$" + m.group(1).strip() + "$$"))
    w.sub("latex formula", re.compile(r"\\\[(.+?)\\\]|\\\((.+?)\\\)", re.S), lambda m: w.hold(f"$${m.group(1).strip()}$$" if m.group(1) else f"${m.group(2).strip()}$"))
    w.sub("latex formula", _FORMULA, lambda m: w.hold(m.group()) if _MATHISH.search(m.group(1)) else None)


def _latex_table(m: re.Match) -> str:
    body = _RULES.sub("", m.group(2))
    rows = [[c.strip() for c in re.split(r"(?<!\\)&", r)] for r in re.split(r"\\\\(?:\[[^\]]*\])?", body) if r.strip()]
    return "\n" + "\n".join(_row(r) for r in rows) + "\n"


def _latex_list(m: re.Match) -> str:
    mark = iter(range(1, 1 << 30)) if m.group(1) == "enumerate" else None
    items = [i.strip() for i in re.split(r"\\item\b" + _OPTION, m.group(2))[1:]]
    return "\n" + "\n".join((f"{next(mark)}. " if mark else "- ") + " ".join(i.split()) for i in items) + "\n"


def _latex(w: _Work) -> None:
    if "\\" not in w.text:
        return
    w.sub("latex", _TABLES, _latex_table)
    w.sub("latex", _LISTS, _latex_list)
    w.sub("latex", _HEADING_COMMAND, lambda m: "\n" + "#" * _HEADINGS[m.group(1)] + " " + m.group(2).strip() + "\n")
    w.sub("latex", _DROPPED, "")
    w.sub("latex", _HREF, lambda m: m.group(2) if m.group(2) is not None else m.group(3))
    for _ in range(3):
        w.sub("latex", _KEPT, r"\1")
    w.sub("latex", _BEGIN_END, "")
    w.sub("latex", _OTHER_COMMAND, r"\1")
    w.sub("latex", _BARE_COMMAND, lambda m: {"item": "- ", "par": "\n\n", "newline": "\n", "ldots": "…", "dots": "…"}.get(m.group().strip().lstrip("\\"), ""))
    w.sub("latex", _SIGN_COMMAND, lambda m: _SIGNS[m.group(1)])
    w.sub("latex", _LATEX_ESCAPE, r"\1")
    if any(k.startswith("latex") for k in w.kinds):
        w.text = re.sub(r"(?<=\S)~(?=\S)", " ", w.text).replace("\\\\\n", "\n")


def _wiki_table(m: re.Match) -> str:
    rows: list[list[str]] = [[]]
    for line in m.group().split("\n")[1:]:
        s = line.strip()
        if s.startswith("|-"):
            rows.append([])
        elif s.startswith("|}"):
            break
        elif s.startswith("|+"):
            continue
        elif s[:1] in "|!" and s:
            for cell in re.split(r"\|\||!!", s[1:]):
                # attributes before a single bar belong to the cell, not to its text
                rows[-1].append(re.sub(r"^[^|\[{]*=\s*\"[^|]*\|(?!\|)", "", cell).strip())
    return "\n" + "\n".join(_row(r) for r in rows if r) + "\n"


def _wiki_bullets(m: re.Match) -> str | None:
    """Lines of * or # are a list if one is nested or links; signs of a footnote are not."""
    lines = m.group().rstrip("\n").split("\n")
    if not any(re.match(r"[*#]{2,} ?\S", x) for x in lines) and not ("[[" in m.group() and lines[0][0] in "*#"):
        return None
    if len(lines) < 2:
        return None
    return "".join("  " * (len(re.match(r"[*#]+", x).group()) - 1) + "- " + x.lstrip("*#").strip() + "\n" for x in lines)


def _wiki(w: _Work) -> None:
    w.sub("wiki", re.compile(r"\{\|[^\n]*\n.*?\n\|\}", re.S), _wiki_table)
    for _ in range(4):
        w.sub("wiki", re.compile(r"\{\{[^{}]*\}\}"), "")
    w.sub("wiki", re.compile(r"(?m)^(?:[*#]+ ?[^\n]+(?:\n|$))+"), _wiki_bullets)
    w.sub("wiki", re.compile(r"\[\[(?:Category|Kategorie|Catégorie|Categoría|Categoria|Категория|分类|File|Image|Datei|Fichier)\s*:[^\]\n]*\]\]\n?", re.I), "")
    w.sub("wiki", re.compile(r"\[\[(?:[^\]|\n]*\|)?([^\]|\n]+)\]\]"), r"\1")
    w.sub("wiki", re.compile(r"\[(?:https?|ftp|mailto):\S+\s+([^\]\n]+)\]"), r"\1")
    w.sub("wiki", re.compile(r"'''''(?=\S)(.+?)'''''|'''(?=\S)(.+?)'''|''(?=[^\s'])(.+?)(?<=[^\s'])''"), lambda m: next(g for g in m.groups() if g is not None))
    w.sub("wiki", re.compile(r"(?m)^(={2,6})[ \t]*([^=\n](?:[^\n]*[^=\n])?)[ \t]*\1[ \t]*$"), lambda m: "#" * (len(m.group(1)) - 1) + " " + m.group(2).strip())
    w.sub("wiki", re.compile(r"__(?:NO)?(?:TOC|FORCETOC|EDITSECTION|GALLERY|INDEX|NEWSECTIONLINK)__\n?"), "")
    w.sub("wiki", re.compile(r"~{3,5}(?!~)(?=\s|$)"), "")


_LEFT, _RIGHT = r"(?<![\w\\*])", r"(?![\w*])"


def _markdown(w: _Work) -> None:
    w.sub("markdown", re.compile(r"(?m)^[ ]{0,3}(```+|~~~+)[^\n`]*\n(.*?)\n?[ ]{0,3}\1[ \t]*$", re.S | re.M), lambda m: w.hold(m.group(2)))
    w.sub("markdown", re.compile(r"(?<![`\\])(`+)(?!`)([^\n]*?[^`\n])\1(?!`)"), lambda m: w.hold(m.group(2).strip()) if m.group(2).strip() else None)
    w.sub("markdown", re.compile(r"(?m)^[ ]{0,3}\|?[^\n]*\|[^\n]*\n[ ]{0,3}\|?[ ]*:?-{2,}:?[ ]*(?:\|[ ]*:?-+:?[ ]*)*\|?[ ]*(?:\n|$)(?:[ ]{0,3}\|?[^\n|]*\|[^\n]*(?:\n|$))*"), _markdown_table)
    w.sub("markdown", re.compile(r"(?m)^[ ]{0,3}\[\^[^\]\n]+\]:[ \t]*"), "")
    w.sub("markdown", re.compile(r"(?m)^[ ]{0,3}\[[^\]\n^]+\]:[ \t]*\S+(?:[ \t]+[\"'(][^\n]*)?[ \t]*(?:\n|$)"), "")
    refs = w.kinds and w.kinds[-1] == "markdown"
    w.sub("markdown", re.compile(r"\[\^[^\]\n]+\]"), "")
    w.sub("markdown", re.compile(r"!\[([^\]\n]*)\]\([^)\n]*\)|!\[([^\]\n]*)\]\[[^\]\n]*\]"), lambda m: m.group(1) if m.group(1) is not None else m.group(2))
    w.sub("markdown", re.compile(r"\[([^\]\n]+)\]\((?:<[^>\n]*>|[^)\s]*)(?:\s+[\"'(][^)\n]*)?\)"), lambda m: m.group(1) if re.search(r"\]\((?:<|[a-z]+:|[./#]|\w+[./#]|www\.)|\]\(\)", m.group()) else None)
    if refs:
        w.sub("markdown", re.compile(r"\[([^\]\n]+)\] ?\[[^\]\n]*\]"), r"\1")
    else:
        w.sub("markdown", re.compile(r"\[([^\]\n\d][^\]\n]*)\]\[[^\]\n]+\]"), r"\1")
    w.sub("markdown", re.compile(r"<(?:https?|ftp|mailto):[^<>\s]+>"), lambda m: m.group()[1:-1])
    w.sub("markdown", re.compile(r"(?m)^([ ]{0,3})(#{1,6})[ \t]+(\S[^\n]*?)(?:[ \t]+#+)?[ \t]*$"), lambda m: f"{m.group(2)} {m.group(3)}")
    w.sub("markdown", re.compile(r"(?m)^([^\n\s][^\n]*)\n[ ]{0,3}(={3,}|-{3,})[ \t]*$"), lambda m: ("# " if m.group(2)[0] == "=" else "## ") + m.group(1).strip())
    w.sub("markdown", re.compile(r"(?m)^[ ]{0,3}(?:(?:\*[ ]*){3,}|(?:-[ ]*){3,}|(?:_[ ]*){3,})$\n?"), "")
    w.sub("markdown", re.compile(r"(?m)^([ ]*)[-*+][ ]+\[[ xX]\][ ]+"), r"\1- ")
    w.sub("markdown", re.compile(r"(?m)^[ ]{0,3}>(?:[ ]?>)*(?:[ ]|$)"), "")
    w.sub("markdown", re.compile(r"(?m)(?:^[ ]{0,12}[-+] [^\n]+(?:\n|$)){2,}|(?:^[ ]{0,3}\* [^\n]+(?:\n|$)){2,}"), lambda m: re.sub(r"(?m)^([ ]*)[-*+] +", r"\1- ", m.group()))
    w.sub("markdown", re.compile(r"~~(?=[^\s~])(.+?)(?<=[^\s~])~~"), r"\1")
    w.sub("markdown", re.compile(r"(?<!\\)(\*{2,3})(?=[^\s*])([^\n]+?)(?<=[^\s*])\1(?!\*)"), r"\2")
    w.sub("markdown", re.compile(r"(?<![\w\\_])(_{2,3})(?=[^\s_])([^\n]+?)(?<=[^\s_])\1(?![\w_])"), r"\2")
    w.sub("markdown", re.compile(r"(?<![*\\\d)])\*(?=[^\s*\d])([^\n*]+?)(?<=[^\s*\\])\*(?![*\d])"), r"\1")
    w.sub("markdown", re.compile(r"(?<![\w\\])_(?=[^\s_])([^\n_]+?)(?<=[^\s_])_(?!\w)"), r"\1")
    w.sub("markdown", re.compile(r"\\([*_`#\[\]~>|!-])"), lambda m: m.group(1) if not re.search(r"[A-Za-z0-9]$", w.text[max(0, m.start() - 1) : m.start()]) else None)


def _markdown_table(m: re.Match) -> str | None:
    lines = [x for x in m.group().rstrip("\n").split("\n") if x.strip()]
    cells = [re.split(r"(?<!\\)\|", x.strip().strip("|")) for x in lines]
    if "|" not in lines[1] and not lines[1].strip().startswith("|") and len(cells[0]) > 1 and ":" not in lines[1]:
        return None
    return "".join(_row(c) + "\n" for i, c in enumerate(cells) if i != 1)


def convert(text: str | None) -> tuple[str | None, list[str]]:
    """(clean text, kinds of markup found)."""
    if not text or not _any(text):
        return text, []
    w = _Work(text)
    _maths(w)
    _markdown_code_first = w.text.count("```") >= 2 or "`" in w.text and "<" in w.text
    if _markdown_code_first:
        w.sub("markdown", re.compile(r"(?m)^[ ]{0,3}(```+)[^\n`]*\n(.*?)\n?[ ]{0,3}\1[ \t]*$", re.S | re.M), lambda m: w.hold(m.group(2)))
        w.sub("markdown", re.compile(r"(?<![`\\])`([^`\n]+)`(?!`)"), lambda m: w.hold(m.group(1)))
    _html(w)
    _wiki(w)
    _latex(w)
    _markdown(w)
    if not w.kinds:
        return text, []
    clean = w.release()
    clean = re.sub(r"[ \t]+\n", "\n", clean)
    clean = re.sub(r"\|\n{2,}(?=\| )", "|\n", clean)  # the rows of a table stay together
    clean = re.sub(r"\n{3,}", "\n\n", clean).strip("\n")
    return clean, list(dict.fromkeys(w.kinds))


# ---- consensus paths of whole pages

#: A page is markup with a body; its container must hold this share of the page's words to stand for it.
_PAGE = re.compile(r"<(?:html|body)[\s>]", re.I)
_VARIABLE = re.compile(r"\d+")


class _Containers(HTMLParser):
    """Own text and link text below each container of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.path: list[str] = []
        self.text: dict[tuple[str, ...], int] = defaultdict(int)
        self.links: dict[tuple[str, ...], int] = defaultdict(int)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in _VOID:
            # generalised: no numbers in classes, no more than the first class
            kind = (dict(attrs).get("class") or "").split()
            self.path.append(tag + ("." + _VARIABLE.sub("", kind[0]) if kind else ""))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.path) - 1, -1, -1):
            if self.path[i].split(".")[0] == tag:
                del self.path[i:]
                break

    def handle_data(self, data: str) -> None:
        size = len(data.split())
        names = [p.split(".")[0] for p in self.path]
        if not size or _SKIP & set(names):
            return
        for i in range(1, len(self.path) + 1):
            if names[i - 1] in _BLOCK or names[i - 1] == "table":
                key = tuple(self.path[:i])
                self.text[key] += size
                self.links[key] += size if "a" in names else 0


def container_scores(html: str) -> list[tuple[str, float]]:
    """(path, score) of each container: its words, less three for each in links, and a word for depth, so that the innermost full container wins."""
    parser = _Containers()
    parser.feed(html)
    return [("/".join(p), n - 3.0 * parser.links[p] + len(p)) for p, n in parser.text.items()]


def consensus_paths(pages: DataFrame, host_col: str, html_col: str) -> DataFrame:
    """(host, path): for each host the container path with the highest total score over its pages; ties go to the deeper, then the first path.

    Scores are summed on the map side before the shuffle, so a host with a
    third of all pages costs one row per path and task.
    """
    schema = T.StructType([T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("score", T.DoubleType())])

    def rows(columns: list[list]) -> Iterator[tuple]:
        for host, html in zip(*columns, strict=True):
            for path, score in container_scores(html):
                yield host, path, score

    whole = pages.where(F.col(html_col).rlike("(?i)<(html|body)[\\s>]"))
    votes = map_rows(whole, {"host": F.col(host_col).cast("string"), "html": html_col}, schema, rows).groupBy("host", "path").agg(F.sum("score").alias("score"))
    best = Window.partitionBy("host").orderBy(F.desc("score"), F.desc(F.size(F.split("path", "/"))), "path")
    return votes.withColumn("n", F.row_number().over(best)).where("n = 1").select("host", "path", "score")


class _Cut(HTMLParser):
    """The inner markup of the elements at one generalised path."""

    def __init__(self, path: str):
        super().__init__(convert_charrefs=False)
        self.want, self.path, self.out, self.depth = path.split("/"), [], [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        raw = self.get_starttag_text() or ""
        if tag in _VOID:
            if self.depth:
                self.out.append(raw)
            return
        kind = (dict(attrs).get("class") or "").split()
        self.path.append(tag + ("." + _VARIABLE.sub("", kind[0]) if kind else ""))
        if self.depth or self.path == self.want:
            self.depth += 1
            self.out.append(raw)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.path) - 1, -1, -1):
            if self.path[i].split(".")[0] == tag:
                closed = len(self.path) - i
                del self.path[i:]
                if self.depth:
                    self.out.append(f"</{tag}>")
                    self.depth = max(0, self.depth - closed)
                break

    def handle_data(self, data: str) -> None:
        if self.depth:
            self.out.append(data)

    def handle_entityref(self, name: str) -> None:
        self.handle_data(f"&{name};")

    def handle_charref(self, name: str) -> None:
        self.handle_data(f"&#{name};")


def extract(html: str, path: str | None) -> str:
    """The part of a page at a path; the page itself where it has no such part or isn't whole."""
    if not path or not _PAGE.search(html):
        return html
    parser = _Cut(path)
    parser.feed(html)
    parser.close()
    part = "".join(parser.out)
    return part if part.strip() else html


#: Types of blocks whose content is no prose: it is kept as it is.
VERBATIM = ("code", "interline_equation")


def clean_fields(blocks: DataFrame, id_col: str = "block_id", host_col: str = "doc_id", fields: tuple[str, ...] = ("content", "html"), keep: tuple[str, ...] = ("type",)) -> DataFrame:
    """(id, kept columns, field_name, clean, kinds, path) of each field that isn't null; rows are as many as such fields.

    Of a whole page only the part at the winning path of its host is judged and
    cleaned; ``path`` names it, and is null where the whole field was taken.

    The content of code and formulas comes back unchanged, and no markup is
    looked for in it. Paths are voted for in one pass over the markup fields and joined back on
    the host; a row per host is small beside its pages, and a hot host's pages
    are spread by AQE's skew join or by broadcast of the measured side.
    """
    own = blocks.select(F.col(id_col).alias("_id"), F.col(host_col).cast("string").alias("_host"), *[F.col(c).alias(f"_keep_{c}") for c in keep], *[F.col(f).alias(f"_field_{f}") for f in fields])
    long = own.select("_id", "_host", *[f"_keep_{c}" for c in keep], F.explode(F.array(*[F.struct(F.lit(f).alias("name"), F.col(f"_field_{f}").alias("text")) for f in fields])).alias("f")).select("*", "f.name", "f.text").drop("f").where(F.col("text").isNotNull())
    pages = own.select("_host", *[F.col(f"_field_{f}").alias(f) for f in fields if f == "html"])
    paths = consensus_paths(pages, "_host", "html") if "html" in fields else None
    if paths is not None:
        whole = (F.col("name") == "html") & F.col("text").rlike("(?i)<(html|body)[\\s>]")
        found = long.where(whole).join(paths.select(F.col("host").alias("_host"), F.col("path").alias("_path")), "_host", "left")
        long = found.unionByName(long.where(~whole).withColumn("_path", F.lit(None).cast("string")))
    else:
        long = long.withColumn("_path", F.lit(None).cast("string"))
    schema = T.StructType(
        [T.StructField(id_col, blocks.schema[id_col].dataType), *[T.StructField(c, blocks.schema[c].dataType) for c in keep], T.StructField("field_name", T.StringType()), T.StructField("clean", T.StringType()), T.StructField("kinds", T.ArrayType(T.StringType(), False)), T.StructField("path", T.StringType())]
    )

    kind = keep.index("type") if "type" in keep else None

    def rows(columns: list[list]) -> Iterator[tuple]:
        for i, *kept, name, text, path in zip(*columns, strict=True):
            if name == "content" and kind is not None and kept[kind] in VERBATIM:
                yield i, *kept, name, text, [], None
                continue
            part = extract(text, path) if path else text
            clean, kinds = convert(part)
            found = path if part is not text else None
            # a part of a page is markup that was already taken off
            yield i, *kept, name, clean, ["html", *[k for k in kinds if k != "html"]] if found else kinds, found

    return map_rows(long, {c: c for c in ("_id", *[f"_keep_{c}" for c in keep], "name", "text", "_path")}, schema, rows)

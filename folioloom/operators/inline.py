"""Inline markup of office texts, table markup without its looks, languages of code."""

from __future__ import annotations

import html as entities
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Styles a run of text may have.
STYLES = ("bold", "italic", "underline", "emphasis", "strikethrough", "superscript", "subscript")

_TEXT = r'<text(?:\s+style="([^"]*)")?>(.*?)</text>'
_MARK = re.compile(rf"<eq>(.*?)</eq>|<hyperlink>{_TEXT}<url>(.*?)</url></hyperlink>|{_TEXT}", re.S)

SPAN = T.StructType([T.StructField("type", T.StringType()), T.StructField("content", T.StringType()), T.StructField("style", T.ArrayType(T.StringType())), T.StructField("url", T.StringType())])


def _styles(value: str | None) -> list[str]:
    return [s for s in (x.strip() for x in (value or "").split(",")) if s in STYLES]


def spans(content: str | None) -> list[tuple]:
    """(type, content, style, url) of a text with formulas, links and styled runs; marks that aren't closed stay text, empty parts give nothing."""
    out, last = [], 0
    text = content or ""

    def plain(s: str) -> None:
        if s:
            out.append(("text", s, [], None))

    for m in _MARK.finditer(text):
        plain(text[last : m.start()])
        last = m.end()
        formula, link_style, link, url, style, run = m.groups()
        if formula is not None:
            if formula.strip():
                out.append(("inline_equation", formula.strip(), [], None))
        elif link is not None:
            if link:
                out.append(("hyperlink", link, _styles(link_style), url))
        elif run:
            out.append(("text", run, _styles(style), None))
    plain(text[last:])
    return out


@F.pandas_udf(T.ArrayType(SPAN))
def inline_spans(content: pd.Series) -> pd.Series:
    return content.map(spans)


def boundary_blank(before: str, after: str, wrapped: bool, after_type: str = "text") -> bool:
    """A wrapper that ends in a sign needs a blank before a letter or digit, or Markdown won't see its end."""
    if not wrapped or after_type != "text" or not before.strip() or not after.strip() or before[-1].isspace() or after[0].isspace():
        return False
    return unicodedata.category(before.rstrip()[-1])[0] in "PS" and unicodedata.category(after.lstrip()[0])[0] in "LN"


_TAG = re.compile(r"<([A-Za-z]\w*)((?:\s+[^<>]*?)?)\s*(/?)>")
_ATTRIBUTE = re.compile(r"([\w-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_KEPT = {"img": {"src", "alt", "width", "height"}, "a": {"href"}}


def safe_href(href: str) -> str:
    """A link with a harmless scheme, or a relative one, ready for an attribute; else nothing."""
    h = entities.unescape(href).strip()
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", re.sub(r"[\x00-\x20]", "", h))
    if not h or scheme and scheme.group(1).lower() not in ("http", "https", "mailto", "ftp"):
        return ""
    return entities.escape(h, quote=True)


def clean_table(html: str | None) -> str | None:
    """Table markup with only what makes its structure: spans, pictures and harmless links; null stays null."""
    if html is None:
        return None

    def tag(m: re.Match) -> str:
        name, wanted, kept = m.group(1).lower(), {"colspan", "rowspan"} | _KEPT.get(m.group(1).lower(), set()), []
        for a in _ATTRIBUTE.finditer(m.group(2)):
            key, value = a.group(1).lower(), next((v for v in a.groups()[1:] if v is not None), "")
            if key == "href" and name == "a":
                value = safe_href(value)
                if not value:
                    continue
            if key in wanted:
                kept.append(f' {key}="{value}"')
        return f"<{name}{''.join(kept)}{'/' * bool(m.group(3))}>"

    return _TAG.sub(tag, html)


@F.pandas_udf(T.StringType())
def cleaned_tables(html: pd.Series) -> pd.Series:
    return html.map(clean_table)


#: Signs of languages of code, each counted once per occurrence.
CODE = {
    "python": r"(?m)^\s*(?:def \w+\(.*\):|import \w+|from \w+ import|elif .*:|class \w+.*:)|\bself\.|print\(",
    "c": r"(?m)^\s*#include\s*[<\"]|\b(?:int|void|char|double|float)\s+\*?\w+\s*\(|->|\bprintf\(|\bsizeof\(",
    "java": r"\bpublic\s+(?:static|class|void)\b|\bMap<|\bnew \w+\(|System\.out|@Override",
    "javascript": r"\b(?:const|let|var)\s+\w+\s*=|=>|\bfunction\s*\w*\(|console\.log",
    "sql": r"(?i)\bselect\b[\s\S]+?\bfrom\b|\binsert into\b|\bcreate table\b",
    "bash": r"(?m)^\s*(?:\$ |#!/bin/|export \w+=|set \w+)|\$\(|\|\s*(?:sort|grep|awk|sed)\b|\bfi\b|\bdone\b",
    "html": r"</?(?:html|div|span|table|body|p)\b",
}


def code_language(code: Column) -> Column:
    """The language of code by its signs: the one with most of them, the first named of equal ones; "txt" without any."""
    counts = [F.struct(F.regexp_count(code, F.lit(p)).alias("n"), F.lit(-k).alias("k"), F.lit(name).alias("name")) for k, (name, p) in enumerate(CODE.items())]
    best = F.array_max(F.array(*counts))
    return F.when(code.isNull(), None).when(best["n"] > 0, best["name"]).otherwise("txt")

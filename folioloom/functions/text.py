"""Text rules of the block model as column expressions: JVM only, null in, null out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SPECIAL = "*_`~$"
LIGATURES = {"ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "ft", "ﬆ": "st"}
LINE_STOPS = ".!?。！？)）\"”:：;；"
LIST_ENDS = ".。;；"
CONTINUATION_ENDS = ("(续)", "(续表)", "(续上表)", "(continued)", "(cont.)", "(cont’d)", "(…continued)", "续表")
WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))
NARROW = "".join(map(chr, range(0x21, 0x7F)))
WIDE_ALNUM = "".join(c for c in WIDE if chr(ord(c) - 0xFEE0).isalnum())
NARROW_ALNUM = "".join(chr(ord(c) - 0xFEE0) for c in WIDE_ALNUM)


def full_to_half(text: Column) -> Column:
    return F.translate(text, WIDE, NARROW)


def full_to_half_alnum(text: Column) -> Column:
    """Letters and digits only; punctuation keeps its width."""
    return F.translate(text, WIDE_ALNUM, NARROW_ALNUM)


def hyphen_at_line_end(text: Column) -> Column:
    return text.rlike("[A-Za-z]+[-\\u00ad\\u2010\\u2011\\u2043]\\s*$")


def escape_markdown(text: Column) -> Column:
    """A backslash before each special character that an odd number of backslashes doesn't precede."""
    return F.regexp_replace(text, r"(?<!\\)((?:\\\\)*)([*_`~$])", r"$1\\$2")


def escape_block_prefix(text: Column) -> Column:
    """A heading or bullet mark at the start of a block must stay text."""
    return F.regexp_replace(text, r"^([ \t]{0,3})(#{1,6}|[+-])(?=[ \t])", r"$1\\$2")


def expand_ligatures(text: Column) -> Column:
    for a, b in LIGATURES.items():
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def clean_code_points(text: Column) -> Column:
    """Line ends of Windows go, the control character for a soft break becomes a hyphen."""
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("")), F.lit("\u0002"), F.lit("-"))


def is_continuation(text: Column) -> Column:
    """The caption of a table that goes on from the page before."""
    t = F.lower(full_to_half(F.trim(text)))
    ends = F.lit(False)
    for mark in CONTINUATION_ENDS:
        ends = ends | t.endswith(mark.lower())
    return F.coalesce(ends | t.rlike(r"(^|[^\p{L}])continued$") | t.contains("(continued)"), F.lit(False))


def strip_display_delimiters(formula: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(formula), r"^\\\[", ""), r"\\\]$", ""))


def balanced_brackets(text: Column) -> Column:
    r"""``\[`` and ``\]`` become plain brackets where they pair up."""
    opening, closing = F.regexp_count(text, F.lit(r"\\\[")), F.regexp_count(text, F.lit(r"\\\]"))
    return F.when((opening > 0) & (opening == closing), F.regexp_replace(F.regexp_replace(text, r"\\\[", "["), r"\\\]", "]")).otherwise(text)


def strip_code_fence(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"^```[^\n]*\n?", ""), r"\n?```$", ""))


def formula_tag(number: Column) -> Column:
    """The number of a formula without its width and one bracket on each side."""
    half = F.trim(full_to_half(number))
    return F.regexp_replace(F.regexp_replace(half, r"^\(", ""), r"\)$", "")


def tagged_formula(formula: Column, number: Column) -> Column:
    """Null where there is no formula to tag."""
    return F.when(F.trim(formula) != "", F.concat(formula, F.lit("\\tag{"), formula_tag(number), F.lit("}")))


def table_equations(html: Column) -> Column:
    """``<eq>`` elements of a table as inline formulas."""
    inner = F.regexp_replace(html, r"(?s)<eq>(.*?)</eq>", r" \$$1\$ ")
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&amp;", "&")):
        inner = F.when(html.contains("<eq>"), F.replace(inner, F.lit(entity), F.lit(sign))).otherwise(inner)
    return inner


def prefix_images(html: Column, folder: str) -> Column:
    return F.regexp_replace(html, r'src="(?!data:)([^"]+)"', f'src="{folder}/$1"')


def safe_link(href: Column) -> Column:
    """Links with a harmless scheme, and relative ones; others become null."""
    h = F.lower(F.regexp_replace(F.trim(href), r"[\x00-\x20]", ""))
    scheme = F.regexp_extract(h, r"^([a-z][a-z0-9+.-]*):", 1)
    return F.when((h != "") & ((scheme == "") | scheme.isin("http", "https", "mailto", "ftp")), F.trim(href))


def is_page_token(token: Column) -> Column:
    """The page number at the end of a table of contents: digits, Roman numerals or a letter."""
    t = F.trim(token)
    return (F.length(t) <= 12) & t.rlike(r"^([0-9]+([-–.][0-9]+)*|(?i)[ivxlcdm]+|[A-Za-z])$")


def strip_page_tail(entry: Column) -> Column:
    return F.regexp_replace(entry, r"\t[ ]*([0-9]+([-–.][0-9]+)*|(?i:[ivxlcdm]+)|[A-Za-z])[ ]*$", "")


def section_parts(title: Column, level: Column) -> Column:
    """The literal number of a heading, where it has as many parts as the heading has levels."""
    number = F.regexp_extract(title, r"^\s*(\d+(?:\.\d+)*)\.?(?=\s|$)", 1)
    parts = F.transform(F.split(number, r"\."), lambda x: x.try_cast("int"))
    return F.when((number != "") & (F.size(parts) == level), parts)


def heading_level(style: Column) -> Column:
    """Of "Heading 3" or "3 Heading"; 1 for a title."""
    low = F.lower(F.trim(style))
    number = F.coalesce(F.nullif(F.regexp_extract(low, r"heading\s*(\d+)", 1), F.lit("")), F.nullif(F.regexp_extract(low, r"(\d+)\s*heading", 1), F.lit("")))
    return F.when(low == "title", F.lit(1)).otherwise(number.cast("int"))


def balanced_environments(formula: Column, names: tuple[str, ...] = ("array", "matrix", "pmatrix", "bmatrix", "cases", "aligned", "gathered")) -> Column:
    r"""Missing ``\begin`` or ``\end`` of an environment is added at the border."""
    out = formula
    for name in names:
        begins, ends = F.regexp_count(formula, F.lit(rf"\\begin\{{{name}\}}")), F.regexp_count(formula, F.lit(rf"\\end\{{{name}\}}"))
        option = "{c}" if name == "array" else ""
        out = F.concat(F.repeat(F.lit(f"\\begin{{{name}}}{option} "), F.greatest(F.lit(0), ends - begins)), out, F.repeat(F.lit(f" \\end{{{name}}}"), F.greatest(F.lit(0), begins - ends)))
    return out


# ---- names and paths


def image_name(kind: Column, page_md5: Column, page: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Content-addressed file name of a cut-out; empty where the box has no area."""
    ints = [c.cast("int").cast("string") for c in (x0, y0, x1, y1)]
    name = F.concat(F.sha2(F.concat(kind, F.lit("/"), F.concat_ws("_", page_md5, page.cast("string"), *ints)), 256), F.lit(".jpg"))
    return F.when((x1.cast("int") > x0.cast("int")) & (y1.cast("int") > y0.cast("int")), name).otherwise("")


def s3_bucket(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, r"^s3a?://([^/]+)/(.*)$", 1), F.lit(""))


def s3_key(path: Column) -> Column:
    return F.when(path.rlike(r"^s3a?://[^/]+/"), F.regexp_extract(path, r"^s3a?://([^/]+)/(.*)$", 2))


def s3_range(path: Column) -> Column:
    got = F.regexp_extract(path, r"\?bytes=([^&]*)", 1)
    return F.when(got != "", F.split(got, ","))


def without_arguments(path: Column) -> Column:
    return F.substring_index(path, "?", 1)


def first_bytes(text: Column, most: int) -> Column:
    """The longest prefix of whole characters within ``most`` bytes of UTF-8."""
    sizes = F.transform(F.sequence(F.lit(0), F.least(F.length(text), F.lit(most))), lambda n: F.struct(n.alias("n"), F.octet_length(F.substring(text, F.lit(1), n)).alias("b")))
    fitting = F.array_max(F.transform(F.filter(sizes, lambda s: s["b"] <= most), lambda s: s["n"]))
    return F.when(F.octet_length(text) <= most, text).otherwise(F.substring(text, F.lit(1), fitting))


def suffix_of_bytes(content: Column) -> Column:
    """File kind by its first bytes; OOXML packages are told apart by ``sources.documents``."""
    head = F.hex(F.substring(content, 1, 12))
    rules = [
        ("^25504446", "pdf"),
        ("^89504E470D0A1A0A", "png"),
        ("^FFD8FF", "jpeg"),
        ("^47494638", "gif"),
        ("^424D", "bmp"),
        ("^(49492A00|4D4D002A)", "tiff"),
        ("^52494646.{8}57454250", "webp"),
        ("^0000000C6A5020200D0A870A", "jp2"),
        ("^504B0304", "zip"),
    ]
    out = F.lit(None).cast("string")
    for pattern, kind in reversed(rules):
        out = F.when(head.rlike(pattern), kind).otherwise(out)
    return out


def effective_pages(pages: Column, start: Column, end: Column) -> Column:
    """Pages left after clamping a range; a null or negative end means the last page."""
    last = F.when(end.isNull() | (end < 0) | (end > pages - 1), pages - 1).otherwise(end)
    return F.greatest(F.lit(0), last - F.coalesce(start, F.lit(0)) + 1)


# Codes of languages by the recogniser that reads their script.
READ_BY = {
    "ch": ("", "en", "japan", "chinese_cht", "latin"),
    "east_slavic": ("ru", "be", "uk"),
    "arabic": ("ar", "fa", "ug", "ur", "ps", "ku", "sd", "bal"),
    "cyrillic": ("rs_cyrillic", "bg", "mn", "abq", "ady", "kbd", "ava", "dar", "inh", "che", "lbe", "lez", "tab", "kk", "ky", "tg", "mk", "tt", "cv", "ba", "mhr", "mo", "udm", "kv", "os", "bua", "xal", "tyv", "sah", "kaa"),
    "devanagari": ("hi", "mr", "ne", "bh", "mai", "ang", "bho", "mah", "sck", "new", "gom", "sa", "bgc"),
}


def ocr_language(label: Column, cpu: bool = False) -> Column:
    """The recogniser that reads a language label; null and empty labels take the first one, labels of no script stay as they are."""
    own = F.coalesce(label, F.lit(""))
    model = own
    for name, codes in READ_BY.items():
        model = F.when(own.isin(*codes), name).otherwise(model)
    return F.when(model == "seal", "seal_lite").otherwise(model) if cpu else model

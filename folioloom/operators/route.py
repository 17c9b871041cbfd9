"""Choosing how a file's text is read: from its text layer or by recognition.

All signals are sums and extremes over a sample of pages, computed in one
aggregation; the decision is an ordered chain, which also gives its reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Thresholds of the decision.
MAX_PAGES, MIN_CHARS_PER_PAGE, IMAGE_COVER = 10, 50, 0.8
MIN_QUALITY_CHARS, BAD_QUALITY = 300, 0.03
MAX_ASPECT = 10.0
RARE_HAN, RARE_HAN_COUNT, RARE_HAN_SHARE = "犀犁犄犊犒犟犬犯状犷犹狂狄狈狐狗狙狞", 30, 0.026
PUNCT_CHARS, PUNCT_SHARE, PUNCT_RUN_SHARE = 100, 0.25, 0.10
CROSS_CHARS, CROSS_HAN, CROSS_COUNT, CROSS_SHARE, CROSS_SCRIPTS, CROSS_EACH = 300, 100, 120, 0.18, 3, 5
#: Scripts that don't mix into Chinese text.
SCRIPTS = {
    "Cyrillic": "\\u0400-\\u052F", "Arabic": "\\u0600-\\u06FF", "Syriac": "\\u0700-\\u074F", "Thaana": "\\u0780-\\u07BF", "NKo": "\\u07C0-\\u07FF",
    "Samaritan": "\\u0800-\\u083F", "Mandaic": "\\u0840-\\u085F", "Devanagari": "\\u0900-\\u097F", "Kannada": "\\u0C80-\\u0CFF", "Myanmar": "\\u1000-\\u109F",
    "Hangul Jamo": "\\u1100-\\u11FF", "Ethiopic": "\\u1200-\\u137F", "Cherokee": "\\u13A0-\\u13FF", "Canadian Syllabics": "\\u1400-\\u167F", "Mongolian": "\\u1800-\\u18AF",
    "Tai Tham": "\\u1A20-\\u1AAF", "Glagolitic": "\\u2C00-\\u2C5F", "Yi": "\\uA000-\\uA48F", "Arabic Supplement": "\\u0750-\\u077F", "Syriac Supplement": "\\u0860-\\u086F", "Arabic Extended-B": "\\u0870-\\u089F",
}
HAN = "\\u3400-\\u4DBF\\u4E00-\\u9FFF\\uF900-\\uFAFF\\x{20000}-\\x{2EBEF}"
ABNORMAL = "\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F-\\x9F\\uFFFD\\uE000-\\uF8FF"
PUNCT = "!-/:-@\\[-`{-~"


def _count(text: Column, chars: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{chars}]"))


def sample_pages(pages: Column, most: int = MAX_PAGES) -> Column:
    """Positions of at most ``most`` evenly spaced pages of a file with so many; halves round to even."""
    even = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.bround(i * (pages - 1) / F.lit(most - 1)).cast("int"))
    return F.when(pages <= 0, F.array().cast("array<int>")).when(pages <= most, F.sequence(F.lit(0), pages.cast("int") - 1)).otherwise(even)


def page_signals(pages: DataFrame) -> DataFrame:
    """Counts of a page's text without blanks (``text``); runs are of four or more punctuation marks."""
    t = F.col("cleaned")
    runs = F.regexp_extract_all(t, F.lit(f"[{PUNCT}]{{4,}}"), F.lit(0))
    rare = "\\u7280-\\u72DF"
    # the many scripts are counted on what is left without Latin
    other = F.col("_other")
    cleaned = pages.withColumn("cleaned", F.regexp_replace("text", r"\s+", "")).withColumn("_other", F.regexp_replace("cleaned", "[\\x00-\\u024F]+", ""))
    return cleaned.select(
        *[c for c in cleaned.columns if c != "_other"],
        F.length(t).alias("chars"),
        _count(t, ABNORMAL).alias("abnormal"),
        _count(other, HAN).alias("han"),
        F.length(F.regexp_replace(F.regexp_replace(other, f"[^{rare}]", ""), f"[{RARE_HAN}]", "")).alias("rare_han"),
        _count(t, PUNCT).alias("punct"),
        F.length(F.array_join(runs, "")).alias("punct_run"),
        F.size(F.array_distinct(F.split(F.array_join(runs, ""), ""))).alias("punct_kinds"),
        *[_count(other, c).alias(f"script_{i}") for i, c in enumerate(SCRIPTS.values())],
    )


def classify(signals: DataFrame, doc: str) -> DataFrame:
    """(doc, method, reason) from the signals of the sampled pages, which also have width, height and image_share."""
    dense = sum((F.sum(f"script_{i}") >= CROSS_EACH).cast("int") for i in range(len(SCRIPTS)))
    strange = sum(F.sum(f"script_{i}") for i in range(len(SCRIPTS)))
    chars = F.sum("chars")
    aspect = F.when((F.col("width") > 0) & (F.col("height") > 0), F.greatest(F.col("width") / F.col("height"), F.col("height") / F.col("width")))
    dots = (F.col("chars") >= PUNCT_CHARS) & (F.col("punct") / F.col("chars") >= PUNCT_SHARE) & (F.col("punct_run") / F.col("chars") >= PUNCT_RUN_SHARE) & (F.col("punct_kinds") > 1)
    a = signals.groupBy(doc).agg(
        F.count("*").alias("pages"), F.max(aspect).alias("aspect"), chars.alias("chars"), F.sum("abnormal").alias("abnormal"), F.sum("han").alias("han"), F.sum("rare_han").alias("rare"), strange.alias("strange"), dense.alias("scripts"), F.max(dots.cast("int")).alias("dots"), F.avg((F.coalesce("image_share", F.lit(0.0)) >= IMAGE_COVER).cast("double")).alias("images")
    )
    share = lambda n, d: F.when(d > 0, n / d).otherwise(0.0)
    reason = (
        F.when(F.coalesce(F.col("aspect") > MAX_ASPECT, F.lit(False)), "aspect")
        .when(F.col("chars") / F.col("pages") < MIN_CHARS_PER_PAGE, "few characters")
        .when((F.col("chars") >= MIN_QUALITY_CHARS) & (share(F.col("abnormal"), F.col("chars")) >= BAD_QUALITY), "abnormal characters")
        .when((F.col("chars") >= CROSS_CHARS) & (F.col("han") >= CROSS_HAN) & (F.col("strange") >= CROSS_COUNT) & (share(F.col("strange"), F.col("chars")) >= CROSS_SHARE) & (F.col("scripts") >= CROSS_SCRIPTS), "scripts")
        .when((F.col("rare") >= RARE_HAN_COUNT) & (share(F.col("rare"), F.col("han")) >= RARE_HAN_SHARE), "rare characters")
        .when(F.col("dots") == 1, "punctuation")
        .when(F.col("images") >= IMAGE_COVER, "images")
    )
    return a.select(doc, F.when(reason.isNull(), "txt").otherwise("ocr").alias("method"), F.coalesce(reason, F.lit("text layer")).alias("reason"))


def font_signal(chars: DataFrame, fonts: DataFrame, doc: str, page: str, least: int = 30, ratio: float = 0.01) -> DataFrame:
    """Files with a page on which a font of the suspicious set makes up enough characters.

    ``chars`` has (doc, page, font, n); names count without their subset prefix.
    """
    name = lambda c: F.regexp_replace(c, r"^/?([A-Z]{6}\+)?", "")
    bad = fonts.select(doc, page, name(F.col("font")).alias("font")).distinct()
    each = chars.withColumn("font", name(F.col("font"))).join(bad.withColumn("bad", F.lit(True)), [doc, page, "font"], "left")
    per = each.groupBy(doc, page).agg(F.sum("n").alias("all"), F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("own"))
    return per.where((F.col("own") >= least) & (F.col("own") / F.col("all") >= ratio)).groupBy(doc).agg(F.min(page).alias(page))


def private_use(text: Column) -> Column:
    """Private-use characters of a text: their number, share of all but blanks, longest run, and whether it needs recognition."""
    pua = "\\uE000-\\uF8FF"
    n = _count(text, pua)
    solid = F.length(F.regexp_replace(text, r"\s+", ""))
    run = F.coalesce(F.array_max(F.transform(F.regexp_extract_all(text, F.lit(f"[{pua}]+"), F.lit(0)), F.length)), F.lit(0))
    share = F.when(solid > 0, n / solid).otherwise(0.0)
    return F.struct(n.alias("n"), share.alias("share"), run.alias("run"), ((n >= 2) & ((run >= 2) | (share >= 0.05))).alias("recognise"))


def render_ranges(pages: DataFrame, doc: str, page: str, most: int = 3, least_pages: int = 30) -> DataFrame:
    """Pages of a file in at most ``most`` balanced ranges of at least ``least_pages``; earlier ranges take the rest.

    By page numbers alone: page k of n falls into a range by arithmetic, so no
    window over a file is needed.
    """
    n = pages.groupBy(doc).agg(F.count("*").alias("n"))
    parts = F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.col("n") / least_pages))).cast("int")
    size, rest = F.floor(F.col("n") / F.col("parts")), F.col("n") % F.col("parts")
    k = F.col(page)
    border = rest * (size + 1)
    part = F.when(k < border, F.floor(k / (size + 1))).otherwise(rest + F.floor((k - border) / size)).cast("int")
    return pages.join(n.withColumn("parts", parts), doc).select(doc, page, part.alias("range_no"))


def queue_ahead(tasks: DataFrame) -> DataFrame:
    """Pending tasks before each pending one; 0 for others.

    Counted in two steps, within stretches of the submit order and over the
    stretches, so that no window holds all tasks.
    """
    one = F.when(F.col("status") == "pending", 1).otherwise(0)
    cut = tasks.withColumn("_one", one).withColumn("_stretch", F.floor(F.col("submit_order") / 4096))
    per = cut.groupBy("_stretch").agg(F.sum("_one").alias("_n"))
    before = per.select("_stretch", (F.sum("_n").over(Window.orderBy("_stretch")) - F.col("_n")).alias("_before"))  # a row per 4096 tasks
    w = Window.partitionBy("_stretch").orderBy("submit_order").rangeBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("_one").over(w), F.lit(0)) + F.col("_before")
    return cut.join(before, "_stretch").select(*tasks.columns, F.when(F.col("_one") == 1, ahead).otherwise(0).alias("ahead"))

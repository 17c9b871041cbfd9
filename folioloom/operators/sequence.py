"""Operators along the reading order: groups, paragraphs, lists, captions, numbers.

Everything is a window or a comparison of neighbours; none iterates over
blocks, and a file's window holds its blocks, not its lines or words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.functions import geometry as G
from folioloom.functions.text import LINE_STOPS, LIST_ENDS
from folioloom.runtime import ordered_fold, running_sum

#: Kinds that begin a new group of text, and kinds that are text.
BREAKERS = ("abstract", "interline_equation", "doc_title", "paragraph_title", "title")
TEXT_KINDS = ("text", "index", "vertical_text")


def text_groups(blocks: DataFrame, doc: list[str], order: list[str]) -> DataFrame:
    """Text blocks with the number of their group; a new one starts where a breaker comes next.

    ``order`` begins with the page; breakers are counted within stretches of
    pages and over them, so that a file of any length is many tasks.
    """
    breaks = F.coalesce(F.col("type").isin(*BREAKERS).cast("int"), F.lit(0))
    placed = blocks.withColumn("_at", F.coalesce(F.col(order[0]), F.lit(-1)))
    return running_sum(placed, doc, "_at", order, breaks, "group_no", stretch=64).drop("_at").where(F.col("type").isin(*TEXT_KINDS))


def merge_flags(n_lines: Column, previous_n: Column, fits: Column, w: Window) -> Column:
    """Whether a block folds into the one before it.

    Folding runs from the last block to the first, and of the conditions only
    "either has more than one line" sees what was folded before: a block of one
    line after a block of one line folds if the next one folds into it. So the
    first sure answer from here on decides.
    """
    sure = F.when(~fits, False).when((n_lines > 1) | (previous_n > 1), True)
    ahead = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return F.coalesce(F.first(sure, ignorenulls=True).over(ahead), F.lit(False))


def paragraphs(blocks: DataFrame, doc: list[str], order: list[str]) -> DataFrame:
    """Text blocks with ``para_no`` in their group: the blocks of a number are one paragraph.

    ``blocks`` has type, box, n_lines, first_x0, last_x1, line_height (of the
    first line), last_height, first_text and last_text.
    """
    grouped = text_groups(blocks, doc, order)
    w = Window.partitionBy(*doc, "group_no").orderBy(*order)
    all_ = Window.partitionBy(*doc, "group_no")
    listlike = (F.max("n_lines").over(all_) <= 3) & ~F.max(F.col("type") == "vertical_text").over(all_)
    box, before = F.col("box"), F.lag("box").over(w)
    width, width_before = box["x1"] - box["x0"], before["x1"] - before["x0"]
    stops = F.col("_last").isin(*LINE_STOPS)
    step = grouped.select("*", F.substring(F.rtrim(F.lag("last_text").over(w)), -1, 1).alias("_last"), before.alias("_before"), F.lag("type").over(w).alias("_type"), F.lag("n_lines").over(w).alias("_n"), F.lag("last_x1").over(w).alias("_x1"), F.lag("last_height").over(w).alias("_h"), listlike.alias("_list"))
    before = F.col("_before")
    width_before = before["x1"] - before["x0"]
    first = F.substring(F.ltrim("first_text"), 1, 1)
    fits = (
        (F.col("type") == "text")
        & (F.col("_type") == "text")
        & ~F.col("_list")
        & (F.abs(box["x0"] - F.col("first_x0")) < F.col("line_height") / 2)
        & (F.abs(before["x1"] - F.col("_x1")) < F.col("_h"))
        & ~stops
        & (F.abs(width - width_before) < F.least(width, width_before))
        & (first != "")
        & ~first.rlike(r"[\p{Nd}\p{Lu}]")
        & (box["y0"] < before["y1"])
        & (F.col("n_lines") > 0)
        & (F.col("_n") > 0)
    )
    # one block after another of the same list or index always goes on
    always = F.col("type").isin("list", "index") & (F.col("type") == F.col("_type"))
    flagged = step.select("*", F.coalesce(fits, F.lit(False)).alias("_fits"), always.alias("_always"))
    folds = F.col("_always") | merge_flags(F.col("n_lines"), F.coalesce("_n", F.lit(0)), F.col("_fits"), w)
    marked = flagged.select("*", F.when(F.coalesce(folds, F.lit(False)), 0).otherwise(1).alias("_new"))
    return marked.withColumn("para_no", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("_last", "_before", "_type", "_n", "_x1", "_h", "_list", "_fits", "_always", "_new")


def block_kinds(lines: DataFrame, block: list[str]) -> DataFrame:
    """(block, kind): text, list or index by the borders of its lines and their text.

    ``lines`` has line_no, box, text, and the page width.
    """
    first = F.min_by("box", "line_no")
    last = F.max_by("box", "line_no")
    shape = lines.groupBy(*block).agg(
        F.count("*").alias("n"), first.alias("f"), last.alias("l"), F.min("box.x0").alias("bx0"), F.max("box.x1").alias("bx1"), F.min("box.y0").alias("by0"), F.max("box.y1").alias("by1"), F.max("page_width").alias("pw"), (F.sum(F.length(F.regexp_replace("text", "[^\\u3040-\\u30ff\\u4e00-\\u9fff\\uac00-\\ud7af]", ""))) * 2 > F.sum(F.length("text"))).alias("chinese")
    )
    j = lines.join(shape.select(*block, (F.col("f.y1") - F.col("f.y0")).alias("h"), "bx0", "bx1", "pw", "chinese"), block)
    h, left, right = F.col("h"), F.col("box.x0") - F.col("bx0"), F.col("bx1") - F.col("box.x1")
    width = F.col("bx1") - F.col("bx0")
    ragged = F.when(F.col("chinese") | (F.coalesce(width / F.nullif(F.col("pw"), F.lit(0.0)), F.lit(0.0)) >= 0.5), 0.26).otherwise(0.36) * width
    t = F.trim("text")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    facts = j.groupBy(*block).agg(
        count((left > 0.7 * h) & (right > 0.7 * h)).alias("inside"),
        count(F.abs((F.col("box.x0") + F.col("box.x1")) / 2 - (F.col("bx0") + F.col("bx1")) / 2) < h / 2).alias("centred"),
        count(F.abs(left) < h / 2).alias("flush"),
        count((F.abs(left) >= h / 2) & (left > h)).alias("indented"),
        count(F.abs(right) < h).alias("flush_right"),
        count((F.abs(right) >= h) & (right > ragged)).alias("ragged"),
        count(F.substring(t, -1, 1).isin(*LIST_ENDS)).alias("ended"),
        count(t.rlike(r"^\p{Nd}")).alias("digit_first"),
        count(t.rlike(r"\p{Nd}$")).alias("digit_last"),
    )
    s = shape.join(facts, block)
    n, hh = F.col("n"), F.col("f.y1") - F.col("f.y0")
    numbered = (F.col("digit_first") / n >= 0.8) | (F.col("digit_last") / n >= 0.8)
    several = (F.col("f.x0") - F.col("bx0") > hh / 2) & (F.abs(F.col("l.x0") - F.col("bx0")) < hh / 2) & (F.col("bx1") - F.col("l.x1") > hh)
    tall = (F.col("by1") - F.col("by0")) / F.nullif(F.col("bx1") - F.col("bx0"), F.lit(0.0)) > 0.4
    centred = (F.col("inside") >= 2) & (F.col("centred") == n) & (F.col("inside") / n >= 0.5) & F.coalesce(tall, F.lit(False))
    listed = (F.col("flush") >= 2) & ((F.col("ragged") >= 2) | (F.col("ended") / n >= 0.8) | (F.col("indented") >= 2)) & ~several
    kind = F.when(n < 2, "text").when(((F.col("flush") / n >= 0.8) | (F.col("flush_right") / n >= 0.8)) & numbered, "index").when(centred | listed, "list").otherwise("text")
    return s.select(*block, kind.alias("kind"))


def runs(blocks: DataFrame, doc: list[str], order: list[str], kind: str) -> DataFrame:
    """Neighbouring blocks of a kind as one: (doc, run_no, first order values, n)."""
    w = Window.partitionBy(*doc).orderBy(*order)
    is_kind = F.coalesce(F.col("type") == kind, F.lit(False))
    starts = is_kind & ~F.coalesce(F.lag(is_kind).over(w), F.lit(False))
    numbered = blocks.withColumn("_k", is_kind).withColumn("_run", F.sum(F.when(starts, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("_k")
    return numbered.groupBy(*doc, "_run").agg(F.min(F.struct(*order)).alias("first"), F.count("*").alias("n")).select(*doc, (F.col("_run") - 1).alias("run_no"), *[F.col(f"first.{c}").alias(c) for c in order], "n")


def formula_numbers(blocks: DataFrame, page: list[str], order: list[str], number: Column, equation: Column) -> DataFrame:
    """For each number: ``before``, ``after`` or ``text``, what becomes of it.

    It joins the equation before it, else the next one unless another number
    follows that, else it is plain text. Neighbours are those of the original
    sequence.
    """
    w = Window.partitionBy(*page).orderBy(*order)
    f = lambda c: F.coalesce(c, F.lit(False))
    took = F.when(f(F.lag(equation).over(w)), "before").when(f(F.lead(equation).over(w)) & ~f(F.lead(number, 2).over(w)), "after").otherwise("text")
    return blocks.withColumn("joins", took).where(number)


def previous_eligible(blocks: DataFrame, doc: list[str], order: list[str], transparent: tuple[str, ...], wanted: str = "text") -> DataFrame:
    """Each block with the order values of the nearest block before it that isn't transparent, if that is of the wanted kind."""
    w = Window.partitionBy(*doc).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    seen = F.when(~F.coalesce(F.col("type").isin(*transparent), F.lit(False)), F.struct(F.coalesce("type", F.lit("")).alias("type"), *order))
    last = F.last(seen, ignorenulls=True).over(w)
    return blocks.withColumn("_last", last).withColumn("previous", F.when(F.col("_last.type") == wanted, F.col("_last").dropFields("type"))).drop("_last")


def caption_parents(blocks: DataFrame, page: list[str], children: tuple[str, ...], mains: tuple[str, ...]) -> DataFrame:
    """(page, child, parent): the nearest table or image of each caption or footnote.

    ``blocks`` has ``index``, ``type`` and an upright ``box``. Between a child and
    its parent only children of its kind, or blocks that stay out of the
    vertical gap between the two, may stand; children of the same kind in
    between cost nothing. Ties go by the edge distance if it differs by more
    than 2, captions between tables to the later, footnotes to the earlier
    one, others to the nearer centre.
    """
    w = Window.partitionBy(*page).orderBy("index")
    placed = blocks.withColumn("pos", F.row_number().over(w))
    for kind in children:
        placed = placed.withColumn(f"_n_{kind}", F.sum((F.col("type") == kind).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    counts = F.create_map(*[x for k in children for x in (F.lit(k), F.col(f"_n_{k}"))])
    placed = placed.withColumn("counts", counts).select(*page, "index", "type", "box", "pos", "counts")
    side = lambda df, name: df.select(*page, *[F.col(c).alias(f"{name}_{c}") for c in ("index", "type", "box", "pos", "counts")])
    child = side(placed.where(F.col("type").isin(*children)), "c")
    main = side(placed.where(F.col("type").isin(*mains)), "m")
    # a page's captions against its tables and images: both few, and joined on the page
    pairs = child.join(main, page)
    is_note = F.col("c_type").endswith("footnote")
    pairs = pairs.where(~is_note | (F.col("c_index") > F.col("m_index")))
    low, high = F.least("c_pos", "m_pos"), F.greatest("c_pos", "m_pos")
    c, m = F.col("c_box"), F.col("m_box")
    gap = F.when(c["y1"] <= m["y0"], F.struct(c["y1"].alias("a"), m["y0"].alias("b"))).when(m["y1"] <= c["y0"], F.struct(m["y1"].alias("a"), c["y0"].alias("b")))
    pairs = pairs.withColumn("low", low).withColumn("high", high).withColumn("gap", gap)
    between = placed.select(*page, F.col("pos").alias("b_pos"), F.col("type").alias("b_type"), F.col("box").alias("b_box"))
    key = [*page, "c_index", "m_index"]
    stands = pairs.join(between, page).where((F.col("b_pos") > F.col("low")) & (F.col("b_pos") < F.col("high")))
    allowed = F.when(is_note, F.coalesce(F.col("b_type").isin(*children), F.lit(False))).otherwise(F.coalesce(F.col("b_type") == F.col("c_type"), F.lit(False)))
    b = F.col("b_box")
    meets = (G.overlap(b, c) > 0) | (G.overlap(b, m) > 0)
    outside = F.col("gap").isNotNull() & ~meets & ((b["y1"] <= F.col("gap.a")) | (b["y0"] >= F.col("gap.b")))
    blocked = stands.where(~allowed & ~F.coalesce(outside, F.lit(False))).select(*key).distinct()
    free = pairs.join(blocked, key, "left_anti")
    same = lambda df: F.abs(F.element_at(F.col("c_counts"), F.col("c_type")) - F.element_at(F.col("m_counts"), F.col("c_type")))
    # children strictly between: prefix counts differ by those between and the child itself if it comes later
    inner = same(None) - F.when(F.col("c_pos") > F.col("m_pos"), 1).otherwise(0)
    scored = free.withColumn("diff", F.col("high") - F.col("low") - inner).withColumn("edge", G.distance(c, m)).withColumn("centre", G.center_distance(c, m))
    pc = Window.partitionBy(*page, "c_index")
    near = scored.withColumn("best", F.min("diff").over(pc)).where("diff = best")
    near = near.withColumn("spread", F.max("edge").over(pc) - F.min("edge").over(pc)).withColumn("tables", F.min(F.col("m_type") == "table").over(pc))
    rank = F.when(F.col("spread") > 2, F.struct(F.col("edge").alias("a"), F.col("m_index").cast("double").alias("b"))).when(is_note, F.struct(F.col("m_index").cast("double").alias("a"), F.lit(0.0).alias("b"))).when(F.col("tables"), F.struct((-F.col("m_index")).cast("double").alias("a"), F.lit(0.0).alias("b"))).otherwise(F.struct(F.col("centre").alias("a"), F.col("m_index").cast("double").alias("b")))
    return near.withColumn("_n", F.row_number().over(pc.orderBy(rank))).where("_n = 1").select(*page, F.col("c_index").alias("child"), F.col("m_index").alias("parent"))


# ---- counters that depend on all before


class SectionNumbers:
    """Numbers of headings, one after the other.

    A numbered heading counts its level up, deeper ones start anew and missing
    ancestors count as 1; a literal number as deep as the level sets the
    counters and needs no number of its own.
    """

    def __init__(self) -> None:
        self.counters: list[int] = []

    def __call__(self, level: int, numbered: bool, literal: list[int] | None) -> str | None:
        if level < 1:
            return None
        if literal is not None and len(literal) == level:
            self.counters = [int(x) for x in literal]
            return None
        if not numbered:
            return None
        own = (self.counters + [0] * level)[:level]
        self.counters = [max(1, c) for c in own[:-1]] + [own[-1] + 1]
        return ".".join(map(str, self.counters))


def section_numbers(headings: DataFrame, doc: str, order: list[str]) -> DataFrame:
    """(doc, order..., number) of headings with level, numbered and literal."""
    kinds = {c: headings.schema[c].dataType.simpleString() for c in (doc, *order)}
    schema = ", ".join([*[f"{c} {t}" for c, t in kinds.items()], "number string"])
    n = 1 + len(order)

    def start():
        count = SectionNumbers()
        return lambda row: [(*row[:n], count(int(row[n]), bool(row[n + 1]), None if row[n + 2] is None else [int(x) for x in row[n + 2]]))]

    return ordered_fold(headings.select(doc, *order, "level", "numbered", "literal"), [doc], order, schema, start)

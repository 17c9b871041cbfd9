"""Mixing sources to target weights (problem 9).

The size of the mix is the largest at which every source that has any text can
give its target share without using a document more often than allowed. The
expected copies of a document are raked: token weights of the cells source x
language x topic are fitted in turn to the targets of the sources and to the
natural shares of languages and topics (iterative proportional fitting), never
above the cap of the source, with the sources fitted last, so that their shares
hold. Every topic keeps its marginal, however rare. Documents are then drawn
with those weights: whole copies to all of a cell, and one more to the documents
with the smallest quotients of chance and weight (sequential Poisson sampling)
until the tokens of the source are used up, so that each source is within half
a document of its target.

Up to ``MOST_CELLS`` cells are fitted on the driver, which sees nothing but
their sums; more are fitted in the same steps by the executors (``rake_frame``),
with only the sums of sources and languages on the driver. Everything per
document stays distributed.

Defined results: documents without a targeted source or without tokens (null
and empty texts) aren't used. A source without text gets nothing, and its share
falls to the others in proportion. Targets that are null or not above 0, and
caps below 1, count as no target; a source listed twice counts with its first
target in order of size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.runtime import checkpointed

#: Cells at most that are fitted on the driver, and whose weights are broadcast.
MOST_CELLS = 200_000
#: Rounds of fitting, and the largest change of a weight, relative to the largest weight, at which it ends earlier.
ROUNDS, CLOSE = 40, 1e-6
#: Steps into which quotients are cut, and each of these again, to find where a source's tokens are used up.
STEPS, FINE = 1 << 10, 1 << 12
#: Quotients from here on count alike; the ones wanted lie around 1.
FAR = 16.0


@dataclass
class Rake:
    """``weight[i]``: expected copies of each document of cell i."""

    weight: np.ndarray
    size: float
    rounds: int


def rake(tokens: np.ndarray, source: np.ndarray, others: list[np.ndarray], share: np.ndarray, cap: np.ndarray, rounds: int = ROUNDS) -> Rake:
    """Weights of cells with so many tokens; ``source`` and ``others`` are the classes of each cell.

    ``share`` and ``cap`` are by source class. The marginals of ``others`` are
    their shares of all tokens, as far as the caps and the sources allow.
    """
    has = np.bincount(source, tokens, len(share))
    usable = (has > 0) & (share > 0)
    if not usable.any():
        return Rake(np.zeros(len(tokens)), 0.0, 0)
    size = float((cap * has)[usable].__truediv__(share[usable]).min())
    goal = np.where(usable, share * size, 0.0)
    most = cap[source].astype(float)
    w = np.where(usable[source], np.minimum((goal / np.where(has > 0, has, 1))[source], most), 0.0)
    natural = [np.bincount(k, tokens * (w > 0)) for k in others]
    natural = [n / n.sum() for n in natural]
    n = 0
    for n in range(1, rounds + 1):
        before = w.copy()
        for k, wanted in zip(others, natural, strict=True):
            now = np.bincount(k, w * tokens, len(wanted))
            w = np.minimum(w * (wanted * now.sum() / np.where(now > 0, now, 1))[k], most)
        w = _fit_sources(w, tokens, source, goal, most)
        if np.abs(w - before).max() <= CLOSE * max(1.0, w.max()):
            break
    return Rake(w, size, n)


def _fit_sources(w: np.ndarray, tokens: np.ndarray, source: np.ndarray, goal: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Scales the cells of each source to its goal; what the cap cuts off goes to the cells below it."""
    for _ in range(60):
        now = np.bincount(source, w * tokens, len(goal))
        missing = goal - now
        if (np.abs(missing) <= 1e-9 * np.maximum(goal, 1)).all():
            break
        free = w < most * (1 - 1e-12)
        room = np.bincount(source, w * tokens * free, len(goal))
        grow = np.where(missing < 0, goal / np.where(now > 0, now, 1), 1 + missing / np.where(room > 0, room, 1))
        w = np.where(free | (missing < 0)[source], np.minimum(w * grow[source], most), w)
    return w


def topic_of(file_stem: Column) -> Column:
    """The kind of file a stem names: the stem without the number at its end."""
    return F.coalesce(F.nullif(F.regexp_replace(file_stem, r"[-_. ]*\d*$", ""), F.lit("")), F.lit("other"))


def rake_frame(cells: DataFrame, goals: dict[str, tuple[float, int]], rounds: int | None = None) -> DataFrame:
    """The cells with ``weight``: the steps of ``rake`` as aggregates and windows over (source, lang, topic, tokens).

    Cells stay partitioned by topic, where the topics' step needs no exchange;
    the steps of sources and languages need their few sums only.
    """
    names = sorted(goals)
    has = {r.source: float(r.t) for r in cells.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    usable = [s for s in names if has.get(s, 0) > 0 and goals[s][0] > 0]
    if not usable:
        return cells.withColumn("weight", F.lit(0.0))
    size = min(goals[s][1] * has[s] / goals[s][0] for s in usable)
    goal = {s: goals[s][0] * size for s in usable}

    def lookup(values: dict[str, float], key: str) -> Column:
        return F.coalesce(F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col(key)], F.lit(0.0)) if values else F.lit(0.0)

    cap = lookup({s: float(goals[s][1]) for s in usable}, "source")
    mass = F.col("weight") * F.col("tokens")
    own = F.sum(mass).over(Window.partitionBy("topic"))
    cells = cells.select("source", "lang", "topic", F.col("tokens").cast("double").alias("tokens")).repartition("topic")
    cells = cells.withColumn("weight", F.least(lookup({s: goal[s] / has[s] for s in usable}, "source"), cap))
    first = F.sum(F.when(F.col("weight") > 0, F.col("tokens")).otherwise(0.0))
    langs = {r.lang: r.t for r in cells.groupBy("lang").agg(first.alias("t")).collect()}
    whole = sum(langs.values()) or 1.0
    cells = checkpointed(cells.withColumn("natural", first.over(Window.partitionBy("topic")) / F.lit(whole)))

    def sums(key: str) -> dict[str, float]:
        return {r[0]: r.t for r in cells.groupBy(key).agg(F.sum(mass).alias("t")).collect()}

    for _ in range(ROUNDS if rounds is None else rounds):
        before = F.col("weight").alias("before")
        cells = cells.select("source", "lang", "topic", "tokens", "natural", "weight", before)
        now = sums("lang")
        total = sum(now.values())
        cells = cells.withColumn("weight", F.least(F.col("weight") * lookup({k: langs[k] / whole * total / now[k] for k in now if now[k] > 0}, "lang"), cap))
        total = sum(sums("lang").values())
        cells = checkpointed(cells.withColumn("weight", F.least(F.coalesce(F.try_divide(F.col("weight") * F.col("natural") * F.lit(total), own), F.lit(0.0)), cap)))
        for _ in range(60):
            free = F.col("weight") < cap * (1 - 1e-12)
            of = {r.source: r for r in cells.groupBy("source").agg(F.sum(mass).alias("now"), F.sum(F.when(free, mass).otherwise(0.0)).alias("room")).collect()}
            now, room = {s: r.now for s, r in of.items()}, {s: r.room for s, r in of.items()}
            missing = {s: goal[s] - now.get(s, 0.0) for s in usable}
            if all(abs(m) <= CLOSE * max(goal[s], 1) for s, m in missing.items()):
                break
            grow = {s: goal[s] / now[s] if m < 0 else 1 + m / (room.get(s) or 1.0) for s, m in missing.items() if now.get(s)}
            shrinks = F.col("source").isin([s for s, m in missing.items() if m < 0])
            cells = cells.withColumn("weight", F.when(free | shrinks, F.least(F.col("weight") * lookup(grow, "source"), cap)).otherwise(F.col("weight")))
        cells = checkpointed(cells)
        moved = cells.agg(F.max(F.abs(F.col("weight") - F.col("before"))).alias("d"), F.max("weight").alias("m")).first()
        if moved.d <= CLOSE * max(1.0, moved.m):
            break
    return cells.select("source", "lang", "topic", "tokens", "weight")


def _weights(usable: DataFrame, goals: dict[str, tuple[float, int]], most_cells: int) -> DataFrame:
    """(source, lang, topic, weight): broadcast where the cells are few enough to be fitted on the driver."""
    sums = usable.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens"))
    cells = sums.limit(most_cells + 1).collect()
    if len(cells) > most_cells:
        return rake_frame(checkpointed(sums), goals).drop("tokens")
    cells.sort(key=lambda r: (r.source, r.lang, r.topic))
    names = sorted(goals)
    code = lambda values: np.unique(values, return_inverse=True)[1].astype(np.int64)
    rows = []
    if cells:
        fitted = rake(
            np.array([float(r.tokens) for r in cells]),
            np.array([names.index(r.source) for r in cells]),
            [code([r.lang for r in cells]), code([r.topic for r in cells])],
            np.array([goals[s][0] for s in names]),
            np.array([goals[s][1] for s in names]),
        )
        rows = [(r.source, r.lang, r.topic, float(w)) for r, w in zip(cells, fitted.weight, strict=True)]
    return F.broadcast(usable.sparkSession.createDataFrame(rows, "source string, lang string, topic string, weight double"))


def mix(counted: DataFrame, targets: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """(doc_id, source, n_tokens, copies >= 1) of the mix.

    ``counted`` has doc_id, source, lang, topic and n_tokens.
    """
    first = Window.partitionBy("source").orderBy("target_share", "max_repeats")
    wanted = targets.where("source IS NOT NULL AND target_share > 0 AND max_repeats >= 1").withColumn("_n", F.row_number().over(first)).where("_n = 1")
    goals = {r.source: (r.target_share, r.max_repeats) for r in wanted.select("source", "target_share", "max_repeats").collect()}
    usable = counted.where(F.col("source").isin(list(goals)) & (F.col("n_tokens") > 0)).select("doc_id", "source", "lang", "topic", "n_tokens")
    weighted = usable.join(_weights(usable, goals, most_cells), ["source", "lang", "topic"])
    # a weight within rounding of a whole number is one
    whole = F.floor(F.col("weight") + 1e-9).cast("int")
    rest = F.greatest(F.col("weight") - whole, F.lit(0.0))
    luck = (F.pmod(F.xxhash64("doc_id", F.lit("draw")), F.lit(1 << 30)) + 1) / F.lit(float(1 << 30))
    quotient = F.least(F.when(rest > 1e-9, luck / rest), F.lit(FAR))
    drawn = weighted.select("doc_id", "source", "n_tokens", whole.alias("whole"), (rest * F.col("n_tokens")).alias("due"), quotient.alias("q"))
    scale = F.col("q") * STEPS
    drawn = drawn.withColumn("step", F.floor(scale).cast("int")).withColumn("fine", F.floor((scale - F.floor(scale)) * FINE).cast("int"))

    def crossing(rows: DataFrame, level: str, base: DataFrame) -> DataFrame:
        """(source, level, left): the step in which the tokens due of each source are used up, and what is left of them there."""
        per = rows.groupBy("source", level).agg(F.sum("n_tokens").alias("t")).join(F.broadcast(base), "source")
        running = F.sum("t").over(Window.partitionBy("source").orderBy(level)) - F.col("t")
        # a row a source: the last step that begins before the tokens are used up
        return per.withColumn("left", F.col("left") - running).where("left > 0").groupBy("source").agg(F.max_by(F.struct(level, "left"), level).alias("x")).select("source", f"x.{level}", "x.left")

    due = drawn.groupBy("source").agg(F.sum("due").alias("left"))
    extra = drawn.where("q IS NOT NULL")
    at = checkpointed(crossing(extra, "step", due))
    inside = extra.join(F.broadcast(at.select("source", "step")), ["source", "step"])
    near = checkpointed(crossing(inside, "fine", at.select("source", "left")))
    # what is left to decide are the rows of one fine step a source
    last = inside.join(F.broadcast(near), ["source", "fine"])
    running = F.sum("n_tokens").over(Window.partitionBy("source").orderBy("q", F.xxhash64("doc_id"), "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0))
    # the document that crosses the target is taken if that brings the source nearer to it
    chosen = last.select("doc_id", "source", "n_tokens", "whole", "q", (running - F.col("n_tokens") / 2 <= F.col("left")).alias("more"))
    border = at.select("source", F.col("step").alias("_step")).join(near.select("source", F.col("fine").alias("_fine")), "source", "left")
    rest_rows = drawn.join(F.broadcast(border), "source", "left")
    before = (F.col("step") < F.col("_step")) | (F.col("step") == F.col("_step")) & (F.col("fine") < F.col("_fine"))
    undecided = F.coalesce((F.col("step") == F.col("_step")) & (F.col("fine") == F.col("_fine")), F.lit(False))
    sure = rest_rows.where(~undecided).select("doc_id", "source", "n_tokens", "whole", "q", F.coalesce(before, F.lit(False)).alias("more"))
    copies = F.col("whole") + F.when(F.col("more") & F.col("q").isNotNull(), 1).otherwise(0)
    return sure.unionByName(chosen).select("doc_id", "source", "n_tokens", copies.cast("int").alias("copies")).where("copies >= 1")


def shares(mixed: DataFrame, counted: DataFrame, targets: DataFrame) -> DataFrame:
    """What each source of the targets was to give, could give and gives."""
    has = counted.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"))
    got = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.count("*").alias("documents"), F.max("copies").alias("most_copies"))
    total = F.sum("mixed_tokens").over(Window.partitionBy())  # one row per source
    joined = targets.join(has, "source", "left").join(got, "source", "left")
    return joined.select("source", "target_share", "max_repeats", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("available_tokens", "mixed_tokens", "documents", "most_copies")], (F.coalesce("mixed_tokens", F.lit(0)) / total).alias("actual_share"))

"""Models as injectable batch functions.

A model is a function from rows to rows: it gets the columns it names and
gives those of its schema. It is made once in each worker, runs on Arrow
batches, and rows of one language or size may be brought together before it.
The doubles here are deterministic, so that plans can be run without weights.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Batch = Callable[[pd.DataFrame], pd.DataFrame]


@dataclass(frozen=True)
class Model:
    """``load`` makes the function; ``reads`` are its columns, ``schema`` those it gives."""

    name: str
    load: Callable[[], Batch]
    reads: tuple[str, ...]
    schema: str

    def run(self, rows: DataFrame, together: str | None = None, partitions: int | None = None) -> DataFrame:
        """Applies the model; rows that share ``together`` meet in a partition, salted so that a hot value is spread."""
        chosen = rows.select(*self.reads)
        if together:
            n = partitions or rows.sparkSession.sparkContext.defaultParallelism
            chosen = chosen.repartition(n, together, F.pmod(F.xxhash64(*[c for c in self.reads if c != together]), F.lit(n)))
        load = self.load

        def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = load()
            for b in it:
                yield model(b)

        return chosen.mapInPandas(batches, self.schema)


def boxes_from_table() -> Batch:
    """Double of a layout model: its detections are those a table already has."""
    return lambda b: b[["doc_id", "page_idx", "label", "score", "x0", "y0", "x1", "y1"]]


LAYOUT_DOUBLE = Model("layout", boxes_from_table, ("doc_id", "page_idx", "label", "score", "x0", "y0", "x1", "y1"), "doc_id string, page_idx int, label string, score double, x0 double, y0 double, x1 double, y1 double")


def accept_recognised(rows: DataFrame, text: str = "text", score: str = "score", fallback: str = "native", limit: float = 0.5) -> DataFrame:
    """Recognised text where its score is above the limit, else the text that was there, else nothing with score 0."""
    good = F.coalesce(F.col(score) > limit, F.lit(False))
    return rows.withColumn("accepted", F.when(good, F.col(text)).otherwise(F.coalesce(fallback, F.lit("")))).withColumn("accepted_score", F.when(good | F.col(fallback).isNotNull(), F.coalesce(score, F.lit(0.0))).otherwise(0.0))


def best_rotation(scores: DataFrame, key: str, margin: float = 0.1) -> DataFrame:
    """(key, label): the rotation with the best score; upright unless another is better by the margin."""
    best = F.max_by("label", F.struct("score", "label"))
    return scores.groupBy(key).agg(best.alias("best"), F.max("score").alias("top"), F.max(F.when(F.col("label") == "0", F.col("score"))).alias("upright")).select(key, F.when(F.coalesce(F.col("top") - F.col("upright") < margin, F.lit(False)), "0").otherwise(F.col("best")).alias("label"))

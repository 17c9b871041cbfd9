"""Session helpers shared by every plan: reading tables, parallelism, cutting lineage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, root: str, name: str, *columns: str) -> DataFrame:
    """One parquet table of a data directory; ``columns`` prunes the scan."""
    df = spark.read.parquet(f"{root}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """Give a CPU-bound Python stage at least one partition per core.

    A table that was written as one small file is scanned by one task; only
    then are its rows redistributed. Inputs with enough splits pass unchanged,
    so nothing is shuffled at scale. Rows and results never change.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Where it is unset, a
    session on one machine gets a folder of its own, removed at its end; a
    cluster is refused, as its machines share no such folder.
    """
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all machines of the cluster share")
            folder = tempfile.mkdtemp(prefix="folioloom-checkpoints-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def running_sum(df: DataFrame, group: list[str], value: str, order: list[str], what: Column, name: str, stretch: int = 4096) -> DataFrame:
    """``df`` with ``name``: the sum of ``what`` over the rows of its group up to its own, by (value, order).

    In two steps, within stretches of the whole number ``value`` and over the
    sums of stretches, so that a group with a third of all rows is no one
    task's. ``value`` must not be null; null groups are groups.
    """
    cut = df.withColumn("_stretch", F.floor(F.col(value) / stretch)).withColumn("_what", what)
    per = cut.groupBy(*group, "_stretch").agg(F.sum("_what").alias("_sum"))
    base = per.select(*[F.col(g).alias(f"_of_{g}") for g in group], F.col("_stretch").alias("_of_stretch"), (F.sum("_sum").over(Window.partitionBy(*group).orderBy("_stretch")) - F.col("_sum")).alias("_base"))
    own = F.sum("_what").over(Window.partitionBy(*group, "_stretch").orderBy(value, *order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    same = F.col("_stretch") == F.col("_of_stretch")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return cut.withColumn("_own", own).join(base, same).select(*df.columns, (F.col("_own") + F.col("_base")).alias(name))


def ordered_fold(df: DataFrame, group: list[str], order: list[str], schema: str, start: Callable[[], Callable[[tuple], Iterator[tuple]]]) -> DataFrame:
    """A fold over the rows of each group in order, for rules whose state no window can hold.

    ``start`` makes the step of a new group: it takes a row (as a tuple of the
    columns of ``df``) and gives output rows; a step with a ``finish`` is asked
    for its last rows when its group ends. Rows stream through in batches of
    the sorted partition, so a group of any size takes no more memory than its
    state; nothing is collected per group.
    """
    k = [df.columns.index(c) for c in group]
    names = [part.strip().split(" ")[0] for part in _top_level(schema)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, step = None, None
        ended = lambda: getattr(step, "finish", list)()
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False, name=None):
                own = tuple(row[i] for i in k)
                if step is None or own != at:
                    out.extend(ended())
                    at, step = own, start()
                out.extend(step(row))
            if out:
                yield pd.DataFrame.from_records(out, columns=names)
        out = list(ended())
        if out:
            yield pd.DataFrame.from_records(out, columns=names)

    return df.repartition(*group).sortWithinPartitions(*group, *order).mapInPandas(run, schema)


def _top_level(schema: str) -> list[str]:
    """The fields of a schema string; commas within types don't divide them."""
    out, depth = [""], 0
    for c in schema:
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out

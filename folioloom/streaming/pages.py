"""Files that arrive page by page, and tasks that change state, as streams."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from folioloom.runtime import running_sum


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, those that touch as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _pages_in(ranges: list[tuple[int, int]]) -> int:
    return sum(b - a + 1 for a, b in ranges)


def completed_documents(pages: DataFrame, timeout: str | None = None) -> DataFrame:
    """(doc_id, n_pages, complete) of files as soon as all their pages are there.

    ``pages`` is a stream of (doc_id, page_idx, page_count). The state of a file
    is the set of pages seen, as ranges, so pages that come twice or late in any
    order don't matter, and its size follows the gaps, not the page numbers; it
    is dropped when the file is complete. With a timeout a file
    that gets no page for so long is given out incomplete.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, need = state.get if state.exists else (b"", -1)
        flat = array("q")
        flat.frombytes(seen)
        ranges = list(zip(flat[::2], flat[1::2], strict=True))
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([(key[0], _pages_in(ranges), False)], columns=["doc_id", "n_pages", "complete"])
            return
        new = []
        for b in batches:
            for page, count in b[["page_idx", "page_count"]].itertuples(index=False):
                if not pd.isna(count):
                    need = max(need, int(count))
                if not pd.isna(page) and page >= 0:
                    new.append((int(page), int(page)))
        ranges = _joined(ranges + new)
        have = _pages_in(ranges)
        if 0 <= need <= have:
            if state.exists:
                state.remove()
            yield pd.DataFrame([(key[0], have, True)], columns=["doc_id", "n_pages", "complete"])
            return
        state.update((array("q", [x for r in ranges for x in r]).tobytes(), need))
        if timeout:
            state.setTimeoutDuration(timeout)

    kind = GroupStateTimeout.ProcessingTimeTimeout if timeout else GroupStateTimeout.NoTimeout
    return pages.groupBy("doc_id").applyInPandasWithState(step, "doc_id string, n_pages int, complete boolean", "seen binary, need int", "append", kind)


def task_states(tasks: DataFrame, delay: str = "1 day") -> DataFrame:
    """The newest state of each task in a stream of (task_id, status, submitted_at), forgotten ``delay`` after the watermark passes it."""
    rank = F.when(F.col("status").isin("completed", "failed"), 3).when(F.col("status") == "processing", 2).otherwise(1)
    own = tasks.withWatermark("submitted_at", delay).dropDuplicatesWithinWatermark(["task_id", "status"])
    return own.groupBy("task_id", F.window("submitted_at", delay)).agg(F.max_by("status", rank).alias("status"), F.count("*").alias("n_states")).select("task_id", "status", "n_states")


def windows_of_pages(pages: DataFrame, size: int = 64, order: tuple[str, ...] = ("ord",)) -> DataFrame:
    """Pages of all files in windows of so many, as they are handed to the models.

    ``order`` begins with a whole number. Files with no page come first, in a
    window of their own number -1. Positions are running sums of page counts
    over files, in two steps, so that no window holds all files.
    """
    f = pages.select(*order, "doc_id", F.greatest(F.lit(0), F.coalesce("page_count", F.lit(0))).alias("n"))
    placed = running_sum(f, [], order[0], [*order[1:], "doc_id"], F.col("n"), "_end").withColumn("_at", F.col("_end") - F.col("n"))
    each = placed.select("doc_id", "_at", F.explode(F.when(F.col("n") > 0, F.sequence(F.lit(0), F.col("n").cast("int") - 1)).otherwise(F.array(F.lit(-1)))).alias("page_idx"))
    return each.select("doc_id", "page_idx", F.when(F.col("page_idx") < 0, -1).otherwise(F.floor((F.col("_at") + F.col("page_idx")) / size)).cast("int").alias("window_no"))

"""Running a plain function over text columns in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

#: Rows handled at a time: texts may be long, so a batch is cut before its results are built.
SLICE = 512


#: Characters handled at a time where texts are joined.
PORTION = 1 << 20


def portions(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in parts of no more characters than PORTION or of a single text."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > PORTION:
            yield texts[start:i]
            start, size = i, 0
        size += len(text)
    if texts:
        yield texts[start:]


def map_rows(df: DataFrame, columns: dict[str, Column | str], schema: T.StructType, rows: Callable[[list[list]], Iterator[tuple] | list[tuple]]) -> DataFrame:
    """``rows`` gets the chosen columns as lists and gives result rows, any number of them.

    Only the chosen columns are read and sent; no shuffle takes place.
    """
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                found = list(rows([c.to_pylist() for c in part.columns]))
                if found:
                    arrays = [pa.array(v, f.type) for v, f in zip(zip(*found, strict=True), arrow, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    chosen = df.select(*[(df[c] if isinstance(c, str) else c).alias(n) for n, c in columns.items()])
    return chosen.mapInArrow(run, schema)


_LOCAL: dict[int, object] = {}


def local(shared: Broadcast, build: Callable[[object], object]) -> object:
    """What ``build`` makes of a broadcast value, made once in each Python worker."""
    key = shared._jbroadcast.id() if getattr(shared, "_jbroadcast", None) is not None else hash(shared._path or id(shared))
    if key not in _LOCAL:
        if len(_LOCAL) >= 4:  # a worker outlives its queries
            _LOCAL.clear()
        _LOCAL[key] = build(shared.value)
    return _LOCAL[key]

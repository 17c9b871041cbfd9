"""The labelled texts on which the small models of this package are fitted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm.labels import normal_label

#: As how many texts those of a language label (or of none) count at most, and all blocks beside them.
PER_LABEL, BLOCKS = 500, 3000


def training_texts(documents: DataFrame) -> DataFrame:
    """(label or "other", text) of all texts that aren't null or blank; the models allow for damaged, repeated and mislabelled ones."""
    rows = documents.select(F.coalesce(normal_label(F.col("lang")), F.lit("other")).alias("label"), "text")
    return rows.where(F.length(F.trim("text")) >= 1)

"""Files as rows, their kinds, and where their products are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.functions.text import suffix_of_bytes
from folioloom.operators.order import unique_stems
from folioloom.runtime import checkpointed

#: Suffixes that are read.
IMAGES = ("png", "jpeg", "jp2", "webp", "gif", "bmp", "jpg", "tiff")
OFFICE = ("docx", "pptx", "xlsx")
SUFFIXES = ("pdf", *IMAGES, *OFFICE)


def collect(spark: SparkSession, path: str) -> DataFrame:
    """(ord, path, stem, suffix, length, content) of the readable files of a folder, not below it, in the order of their paths.

    The kind comes from the bytes; packages by the name they have until they
    are opened. Contents are only read where they are used.
    """
    files = spark.read.format("binaryFile").load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    by_name = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    sniffed = suffix_of_bytes(F.col("content"))
    suffix = F.when(sniffed == "zip", F.when(by_name.isin(*OFFICE), by_name)).otherwise(sniffed)
    kept = files.select("path", F.regexp_replace(name, r"\.[A-Za-z0-9]+$", "").alias("stem"), suffix.alias("suffix"), "length", "content").where(F.col("suffix").isin(*SUFFIXES))
    return kept


def with_unique_stems(files: DataFrame) -> DataFrame:
    """Stems made unique but for case, in the order of the paths."""
    # numbers that grow with the paths; fixed, as ranges of a sort may differ when it is repeated
    placed = checkpointed(files.select("path", "stem").orderBy("path").withColumn("_at", F.monotonically_increasing_id()))
    named = unique_stems(placed, "_at", "stem").select("_at", "unique").join(placed.select("_at", "path"), "_at")
    return files.join(named.select("path", "unique"), "path")


def ranged(content: Column, offset: Column, limit: Column) -> Column:
    """Bytes from an offset on; a negative limit means all that follow."""
    return F.when(limit < 0, F.substring(content, offset + 1, F.octet_length(content))).otherwise(F.substring(content, offset + 1, limit))


def parse_folder(name: Column, backend: Column, method: Column, is_office: Column) -> Column:
    """Folder of a file's products below the output: by its backend, with the method where it matters."""
    leaf = F.when(is_office, "office").when(backend.startswith("pipeline"), method).when(backend.startswith("vlm"), F.lit("vlm")).otherwise(F.concat(F.lit("hybrid_"), method))
    return F.concat_ws("/", name, leaf)


def write_products(documents: DataFrame, path: str, columns: dict[str, bool]) -> None:
    """Each chosen product of the documents as a table of its own; the others aren't computed."""
    for name, wanted in columns.items():
        if wanted:
            documents.where(F.col(name).isNotNull()).select("doc_id", name).write.mode("overwrite").parquet(f"{path}/{name}")

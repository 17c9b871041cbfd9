"""Queries of the training-text operators and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioloom.llm import bpe, canon, language, markup, mixing, mojibake, repetition, scan, split
from folioloom.llm.arrow import local
from folioloom.llm.labels import LANGUAGES, SPELLINGS, normal_label
from folioloom.llm.training import BLOCKS, PER_LABEL, training_texts
from folioloom.runtime import checkpointed, read, spread


def p8_ids(spark: SparkSession, root: str) -> DataFrame:
    return bpe.encode(spread(read(spark, root, "documents", "doc_id", "text")))


def p8_round_trip(spark: SparkSession, root: str) -> DataFrame:
    """Texts decoded from their ids, to be compared with the texts themselves."""
    return bpe.decode(p8_ids(spark, root))


def _spans(spark: SparkSession, root: str) -> DataFrame:
    return spread(read(spark, root, "spans", "doc_id", "page_idx", "span_id", "type", "content", "bbox"))


def p2_lines(spark: SparkSession, root: str) -> DataFrame:
    return scan.body_and_furniture(_spans(spark, root))


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    kinds = F.array(*[F.when(F.col(k), F.lit(k)) for k in ("furniture", "hyphen", "misread")])
    found = scan.repaired_lines(_spans(spark, root)).where("furniture OR hyphen OR misread").select("doc_id", "page_idx", "span_id", F.explode(F.array_compact(kinds)).alias("defect"))
    return found.distinct()


def p2_paragraphs(spark: SparkSession, root: str) -> DataFrame:
    return scan.paragraphs(p2_lines(spark, root))


def _judged_form(model: Broadcast) -> Callable[[], Callable[[list[str | None]], list[str]]]:
    """Texts are judged as restored, without markup and in one form: garbled text counts by its original language, markup and odd letters don't count."""

    def prepare() -> Callable[[list[str | None]], list[str]]:
        repair = local(model, mojibake.Repair)
        return lambda texts: [canon.canonical(markup.convert(r.text)[0]) or "" for r in repair.all(texts)]

    return prepare


def _segments(spark: SparkSession, root: str, chosen: Column) -> DataFrame:
    filters = spark.sparkContext.broadcast(language.fit_frame(training_texts(spread(read(spark, root, "documents", "text", "lang")))))
    blocks = spread(read(spark, root, "blocks", "block_id", "doc_id", "type", "content")).where(chosen)
    return language.segment_texts(blocks, filters, ["block_id", "doc_id", "type"], prepare=_judged_form(_encoding_model(spark, root)))


def p3_segments(spark: SparkSession, root: str) -> DataFrame:
    """The languages of every block with content, whatever its type; content too short to tell gives no row."""
    return _segments(spark, root, F.length("content") >= 1).drop("doc_id", "type")


def p3_labels(spark: SparkSession, root: str) -> DataFrame:
    return language.file_labels(read(spark, root, "tasks", "submit_order", "file_names", "lang_list"))


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    spoken = _segments(spark, root, (F.col("type") == "text") & (F.length("content") >= 60)).where("sentences > 0").select("block_id", "doc_id", "lang").distinct()
    other = ~F.col("lang").eqNullSafe(F.col("label"))
    return spoken.join(p3_labels(spark, root), "doc_id", "left").where(other).select("block_id", "lang").distinct()


#: Types of blocks whose words needn't be in the language of their file.
NO_PROSE = ("code", "interline_equation", "ref_text")


def p3_files(spark: SparkSession, root: str) -> DataFrame:
    """Each file with its label, the language most of its letters are in, their share, and the language to use.

    Every block with content is judged; code, formulas and references, whose
    words aren't the file's own, only count where nothing else tells. The label
    stays where it names the language of at least a third of the letters, or
    where the file has no text to judge.
    """
    prose = ~F.coalesce(F.col("type"), F.lit("")).isin(*NO_PROSE)
    counted = _segments(spark, root, F.length("content") >= 1).groupBy("doc_id", prose.alias("prose"), "lang").agg(F.sum("letters").alias("n"), (F.sum(F.col("confidence") * F.col("letters")) / F.sum("letters")).alias("c"))
    letters = counted.withColumn("any", F.max("prose").over(Window.partitionBy("doc_id"))).where(F.col("prose") == F.col("any"))
    share = (F.col("n") / F.sum("n").over(Window.partitionBy("doc_id"))).alias("share")
    shares = letters.select("doc_id", "lang", share, "c").groupBy("doc_id").agg(F.max(F.struct("share", "lang", "c")).alias("top"), F.map_from_entries(F.collect_list(F.struct("lang", "share"))).alias("all"))
    joined = p3_labels(spark, root).join(shares, "doc_id", "left")
    keep = F.col("label").isNotNull() & (F.col("top").isNull() | (F.coalesce(F.try_element_at("all", F.col("label")), F.lit(0.0)) >= 1 / 3))
    lang = F.when(keep, F.col("label")).otherwise(F.col("top.lang"))
    return joined.select("doc_id", "label", F.col("top.lang").alias("detected"), lang.alias("lang"), F.when(F.col("top").isNotNull(), F.coalesce(F.try_element_at("all", lang), F.lit(0.0)) * F.col("top.c")).alias("confidence"))


def p4_canonical(spark: SparkSession, root: str) -> DataFrame:
    return canon.canonical_texts(spread(read(spark, root, "blocks", "block_id", "content")), ["block_id"])


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return canon.same_reading(spread(read(spark, root, "blocks", "block_id", "content")), read(spark, root, "heading_terms", "term_id", "term"))


def p5_pieces(spark: SparkSession, root: str) -> DataFrame:
    return split.split_blocks(spread(read(spark, root, "blocks", "block_id", "type", "content")), read(spark, root, "split_limits"))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return p5_pieces(spark, root).where("piece_no = 0 AND n_pieces > 1").select("block_id").distinct()


def p5_joined(spark: SparkSession, root: str) -> DataFrame:
    """The pieces put together again without their overlaps."""
    own = F.expr("struct(piece_no, substring(piece, overlap + 1) AS own)")
    whole = F.array_sort(F.collect_list(own))["own"]
    return p5_pieces(spark, root).groupBy("block_id").agg(F.concat_ws("", whole).alias("content"))


def p6_clean(spark: SparkSession, root: str) -> DataFrame:
    return markup.clean_fields(spread(read(spark, root, "blocks", "block_id", "doc_id", "type", "content", "html")))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    plain = F.coalesce(F.col("type"), F.lit("")).isin("code", "interline_equation")
    return p6_clean(spark, root).where((F.size("kinds") > 0) & ~plain).select("block_id", "field_name").distinct()


def p6_paths(spark: SparkSession, root: str) -> DataFrame:
    """The container path that won the vote of each file's pages."""
    return markup.consensus_paths(spread(read(spark, root, "blocks", "doc_id", "html")), "doc_id", "html")


def _encoding_model(spark: SparkSession, root: str) -> Broadcast:
    """Fitted on all documents and all blocks, as blocks hold bullets and references that documents lack; each label counts as at most PER_LABEL texts, the blocks as at most BLOCKS."""
    documents = training_texts(read(spark, root, "documents", "text", "lang")).select("text", F.col("label").alias("stratum"))
    blocks = read(spark, root, "blocks", "content").select(F.col("content").alias("text"), F.lit("blocks").alias("stratum"))
    quotas = dict.fromkeys((*LANGUAGES, "other"), PER_LABEL) | {"blocks": BLOCKS}
    return mojibake.share(documents.unionByName(blocks).where(F.length(F.trim("text")) >= 1), quotas=quotas)


def p7_restored(spark: SparkSession, root: str) -> DataFrame:
    model = _encoding_model(spark, root)
    return mojibake.repaired(spread(read(spark, root, "blocks", "block_id", "content")), model, ["block_id"])


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    return p7_restored(spark, root).where("damaged").select("block_id").distinct()


def _counted(spark: SparkSession, root: str) -> DataFrame:
    """Documents with their sizes in tokens of byte_bpe_50k and the classes they are raked by."""
    documents = spread(read(spark, root, "documents", "doc_id", "text", "source", "lang", "file_stem"))
    classes = documents.select("doc_id", "source", F.coalesce(normal_label(F.col("lang")), F.lit("other")).alias("lang"), mixing.topic_of(F.col("file_stem")).alias("topic"), "text")
    # counted once: the mix needs the sizes for its cells, its steps and its draws
    return checkpointed(bpe.count_tokens(classes, ["doc_id", "source", "lang", "topic"]))


def p9_mix(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mix(_counted(spark, root), read(spark, root, "mix_targets"))


def p9_shares(spark: SparkSession, root: str) -> DataFrame:
    counted, targets = _counted(spark, root), read(spark, root, "mix_targets")
    return mixing.shares(mixing.mix(counted, targets), counted, targets)


#: Strata of the calibration.
STRATA = (*LANGUAGES, "other")


def _by_stratum(spark: SparkSession, root: str) -> DataFrame:
    documents = spread(read(spark, root, "documents", "doc_id", "text", "lang"))
    return documents.select("doc_id", "text", F.coalesce(normal_label(F.col("lang")), F.lit("other")).alias("stratum"))


def _cutoffs(spark: SparkSession, root: str) -> list[tuple]:
    """Calibrated on all documents, each with a repetition planted in it."""
    return repetition.calibrate(repetition.planted(_by_stratum(spark, root), "doc_id"), list(STRATA))


def p10_cutoffs(spark: SparkSession, root: str) -> DataFrame:
    return spark.createDataFrame(_cutoffs(spark, root), "stratum string, cutoff double, sound long, falsely_rejected long, bound double")


def p10_share(spark: SparkSession, root: str) -> DataFrame:
    return repetition.shares(spread(read(spark, root, "documents", "doc_id", "text")), ["doc_id"])


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    """Documents whose share reaches the calibrated cutoff of their stratum; where a corpus is too small for any proof, the limit of the definition."""
    cutoffs = {s: min(c, 1.0) if c < float("inf") else repetition.LIMIT for s, c, *_ in _cutoffs(spark, root)}
    cutoff = F.create_map(*[F.lit(x) for pair in cutoffs.items() for x in pair])[F.col("stratum")]
    scored = repetition.shares(_by_stratum(spark, root), ["doc_id", "stratum"])
    return scored.where((F.col("repeated_share") >= cutoff) & (F.col("letters") > 0)).select("doc_id").distinct()


QUERIES = {f.__name__: f for f in (p2_found, p2_lines, p2_paragraphs, p3_found, p3_segments, p3_labels, p3_files, p4_found, p4_canonical, p5_found, p5_pieces, p5_joined, p6_found, p6_clean, p6_paths, p7_found, p7_restored, p8_ids, p8_round_trip, p9_mix, p9_shares, p10_found, p10_share, p10_cutoffs)}

_OVERSIZED = "FROM blocks b JOIN (SELECT type, min(max_chars) AS m FROM split_limits GROUP BY type) l ON b.type = l.type WHERE l.m >= 1 AND length(b.content) > l.m"

_SPELLED = " ".join(f"WHEN x IN ({', '.join(repr(s) for s in names)}) THEN '{lang}'" for lang, names in SPELLINGS.items())
_NAMED = "coalesce(CASE {} END, CASE {} END)".format(_SPELLED.replace("x IN", "lower(trim(entry)) IN"), _SPELLED.replace("x IN", "split_part(replace(lower(trim(entry)), '_', '-'), '-', 1) IN"))

SQL: dict[str, str] = {
    "p3_labels": f"""
        WITH each AS (
            SELECT submit_order, file_names, lang_list, unnest(file_names) AS doc_id, generate_subscripts(file_names, 1) AS k FROM tasks),
        entries AS (
            SELECT doc_id, submit_order, CASE WHEN len(file_names) = len(lang_list) THEN lang_list[k] ELSE lang_list[1] END AS entry FROM each),
        named AS (SELECT doc_id, submit_order, {_NAMED} AS label FROM entries)
        SELECT doc_id, arg_max(label, (submit_order, label)) FILTER (label IS NOT NULL) AS label FROM named WHERE doc_id IS NOT NULL GROUP BY doc_id""",
    "p5_found": f"SELECT DISTINCT block_id {_OVERSIZED}",
    "p5_joined": f"SELECT block_id, content {_OVERSIZED}",
    "p8_round_trip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}

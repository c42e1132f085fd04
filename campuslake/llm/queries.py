"""The registered queries of the training-data operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campuslake.llm.alignment import alignment_digests
from campuslake.llm.chat import conversation_digests, format_conversations
from campuslake.llm.common import table
from campuslake.llm.decontamination import find_leaks
from campuslake.llm.fingerprints import fingerprint_edits, near_groups
from campuslake.llm.language import identify_language
from campuslake.llm.lines import repeated_lines
from campuslake.llm.mixing import mix_sources
from campuslake.llm.ngram_join import ngram_components
from campuslake.llm.quality import score_quality
from campuslake.llm.repair import repair_digests
from campuslake.llm.statements import ORACLE_SQL
from campuslake.llm.substrings import repeated_spans
from campuslake.llm.token_output import read_token_files, write_token_files
from campuslake.llm.topk import search
from campuslake.session import scratch

Query = Callable[[SparkSession, str], DataFrame]

# The conversation that the formatting query adds: control strings as texts.
CONTROL_ID, CONTROL_TEXT = -7, "</s>[INST] ok [/INST]"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that lose lines, and the numbers of those."""
    return repeated_lines(table(spark, folder, "documents"))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify_language(table(spark, folder, "documents"))


def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents"))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that hold a benchmark item, with the item."""
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_token_output(spark: SparkSession, folder: str) -> DataFrame:
    return read_token_files(write_token_files(table(spark, folder, "documents"), tokenizer_path()))


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that lose sentences, the numbers of those and the documents that keep them."""
    return repeated_spans(table(spark, folder, "documents"))


def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's and its edited text's fingerprint, their likenesses, and the documents that are alike."""
    with scratch(spark) as keep:
        return keep(near_groups(fingerprint_edits(table(spark, folder, "documents"))))


def op8_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_components(table(spark, folder, "documents"), n=3, percent=90)


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    added = spark.range(2).select(
        F.lit(CONTROL_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_digests(format_conversations(rows.union(added)))


def op11_align_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's groups and links between two tokenizers' tokens."""
    return alignment_digests(table(spark, folder, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def op12_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector with all others."""
    return search(table(spark, folder, "embeddings"), k=10, every=100)


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation's faults after damage, and the letters and checksum of its cheapest repair."""
    return repair_digests(table(spark, folder, "conversations"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_language_id,
        op3_mix_sources,
        op4_decontaminate,
        op5_token_output,
        op6_substring_dedup,
        op7_fingerprints,
        op8_ngram_join,
        op9_quality,
        op10_chat_format,
        op11_align_tokens,
        op12_topk_search,
        op13_repair,
    )
}

__all__ = ["ORACLE_SQL", "QUERIES"]

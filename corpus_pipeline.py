"""The corpus pipeline: documents in, token files out, each stage over all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from campuslake.llm.common import table
from campuslake.llm.decontamination import drop_leaks
from campuslake.llm.mixing import repeat_documents
from campuslake.llm.ngram_join import keep_one
from campuslake.llm.quality import keep_good
from campuslake.llm.queries import tokenizer_path
from campuslake.llm.token_output import read_token_files, write_token_files
from campuslake.session import discard, scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Null and empty texts are scored like others; rows without an id stay; of a repeated id with several texts all
    rows go if one is rejected. Without labels none goes. No rows: none.
    """
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, similarity 0.8.

    The smallest id of a group stays, with one row: the longest text, ties by text and the other columns. Texts
    without words are no copies of each other; rows without an id stay.
    """
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts and rows without an id hold none."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it.

    A text without words, and a row without an id, is kept once. Equal sampling keys are ordered by id.
    """
    return repeat_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and what they hold; null text is its end id alone, repeated rows stand side by side."""
    return read_token_files(write_token_files(docs, tokenizer_path()))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_files", token_files),
]

# Classifier, tokenizer and samples can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again; what a stage read goes when it is written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            following = keep(stage(spark, docs, sf_dir))
        discard(docs)
        docs = following
    return STAGES[-1][1](spark, docs, sf_dir)

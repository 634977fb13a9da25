"""From raw documents to packed training sequences, in stages that each read what the one before wrote."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidewake.llm import jaccard_join, language_id, line_dedup, packing, pii
from tidewake.llm.common import TEXT_BATCH, documents, remove_tree, shared_dir, small_batches


def stage(of):
    """A stage whose rows hold whole texts when they are written: few of them to an Arrow batch. ``run`` sets the session back."""

    @wraps(of)
    def planned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH))
        return of(spark, docs, sf_dir)

    return planned


@stage
def clear_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language compression tells; the rest go, those of null text and without a letter among them.

    With no labelled row nothing can be told and all go; equal texts share a fate; a null ``doc_id`` is judged by its text.
    """
    return language_id.accepted(docs)


@stage
def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in five documents or more stay in the one of largest ``doc_id``.

    Null text becomes empty; a text that loses all lines stays as an empty one; rows without a ``doc_id`` stay whole.
    """
    return line_dedup.cleaned(docs)


@stage
def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles, that of smallest ``doc_id``.

    Texts without words are in no group and stay; rows that repeat the ``doc_id`` that stays are that document and stay;
    rows without a ``doc_id`` stay.
    """
    return jaccard_join.one_of_each(docs)


@stage
def surrogates_for_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets give way to surrogates; null text stays null, rows without any stay as they are."""
    return pii.pseudonymised(docs, pii.surrogate_key(spark))


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens; null text packs as the end id alone."""
    return packing.packed_documents(docs)


STAGES = [
    ("language", clear_language),
    ("lines", unrepeated_lines),
    ("near copies", one_of_near_copies),
    ("personal data", surrogates_for_personal_data),
    ("packing", packed),
]

#: Compression, set similarity and tokenization have no SQL form; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what a stage wrote is deleted when the next one has read it.

    All stages take very long texts whole, empty tables give empty ones, and columns of any name are carried to the last stage.
    """
    docs, before = documents(spark, sf_dir), None
    with small_batches(spark):
        for name, of in STAGES:
            path = shared_dir(spark, f"pipeline-{name.replace(' ', '-')}")
            of(spark, docs, sf_dir).write.parquet(path)
            if before:
                remove_tree(spark, before)
            docs, before = spark.read.parquet(path), path
    return docs
